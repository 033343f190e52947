import pytest
from pyspark.sql import functions as F

from pulcra.operators import metrics as M
from pulcra.operators import profiling as A
from pulcra.operators import validation as V
from pulcra.plans.cleaning import clean
from pulcra.plans.compare import quality_before_after
from pulcra.profile import CHECKS
from pulcra.profiles.schools import CHECK_NAMES, SCHOOLS
from tests.rows import clean_table, raw_table

BLANK = {c: "" for c in SCHOOLS.columns}
RAW = [
    {"ESTABLECIMIENTO": " liceo  san José", "TELEFONO": "5555-1234 / 23456789", "DIRECTOR": "-- ANA-MARIA"},
    {"DEPARTAMENTO": "Ciudad Capital", "MUNICIPIO": "zona 7", "DEPARTAMENTAL": "Guatemala Norte", "DISTRITO": "01-"},
    {"DEPARTAMENTO": "QUICHÉ", "MUNICIPIO": "SAN MIGUEL USPANTAN", "DEPARTAMENTAL": "QUICHÉ", "DIRECTOR": "SIN DATO"},
    {"DEPARTAMENTO": "PETEN", "MUNICIPIO": "ATLANTIS", "DEPARTAMENTAL": "PETÉN", "DIRECCION": "- . -"},
    BLANK, BLANK,
]


@pytest.fixture(scope="module")
def cleaned(spark, places):
    return clean(raw_table(spark, RAW), SCHOOLS, places)


def test_cleaned_values(cleaned):
    rows = {r.row_id: r for r in cleaned.data.collect()}
    assert sorted(rows) == [0, 1, 2, 3]
    assert tuple(cleaned.data.columns) == ("row_id", *SCHOOLS.clean_columns)
    assert (rows[0].ESTABLECIMIENTO, rows[0].TELEFONO, rows[0].DIRECTOR) == ("LICEO SAN JOSÉ", "23456789", "ANA-MARIA")
    assert (rows[1].DEPARTAMENTO, rows[1].MUNICIPIO, rows[1].ZONA_CAPITAL, rows[1].DISTRITO) == (
        "GUATEMALA", "GUATEMALA", "ZONA 7", None)
    assert (rows[2].DEPARTAMENTO, rows[2].MUNICIPIO, rows[2].DEPARTAMENTAL, rows[2].DIRECTOR) == (
        "QUICHE", "USPANTAN", "QUICHE", None)
    assert (rows[3].MUNICIPIO, rows[3].DIRECCION) == (None, None)


def test_audit_log(cleaned):
    log = {(r.variable, r.step): r.affected for r in cleaned.audit.collect()}
    assert log["TODAS", "drop_empty"] == 2
    assert log["CODIGO", "standardise"] == 2 and log["ESTABLECIMIENTO", "standardise"] == 3
    assert log["CODIGO", "identifier"] == 0 and log["DISTRITO", "identifier"] == 1
    assert log["TELEFONO", "identifier"] == 1
    assert log["ZONA_CAPITAL", "zone"] == 1 and log["DEPARTAMENTO", "parent"] == 2
    assert log["MUNICIPIO", "child"] == 2 and log["MUNICIPIO", "catalogue"] == 1
    assert log["DIRECTOR", "dashes"] == 1 and log["DEPARTAMENTAL", "category"] == 2
    assert ("NIVEL", "category") not in log and log["TODAS", "review"] == 0


def test_observed_counts_equal_a_second_pass(spark, places, cleaned):
    apart = clean(raw_table(spark, RAW), SCHOOLS, places, materialize=False)
    assert sorted(map(str, apart.audit.collect())) == sorted(map(str, cleaned.audit.collect()))
    empty = clean(raw_table(spark, RAW).limit(0), SCHOOLS, places)
    assert empty.data.count() == 0 and {r.affected for r in empty.audit.collect()} == {0}


def test_cleaning_is_idempotent(spark, places, cleaned):
    again = clean(cleaned.data.drop("ZONA_CAPITAL"), SCHOOLS, places)
    columns = [c for c in SCHOOLS.clean_columns if c != "ZONA_CAPITAL"]
    assert sorted(map(str, again.data.select(*columns).collect())) == sorted(
        map(str, cleaned.data.select(*columns).collect()))


def test_metrics_and_corrections(spark, places, cleaned):
    raw = raw_table(spark, RAW)
    got = {r.metric: r for r in quality_before_after(raw, SCHOOLS, places, cleaned).collect()}
    assert set(got) == set(M.METRICS)
    assert (got["records"].before, got["records"].after) == (6, 4)
    assert (got["variables"].before, got["variables"].after) == (17, 18)
    assert got["exact_duplicates"].before == 1 and got["exact_duplicates"].after == 0
    assert got["missing_cells"].before == 2 * 17 + 2
    assert got["inconsistent_format"].before_columns == "DISTRITO, DIRECCION, TELEFONO, DIRECTOR, DEPARTAMENTAL"
    assert got["inconsistent_format"].after == 0
    assert (got["inconsistent_categories"].before, got["inconsistent_categories"].after) == (2, 0)
    fixes = {r.correction: r.affected for r in M.corrections(raw, cleaned.audit, SCHOOLS).collect()}
    assert len(fixes) == 10
    assert fixes["removed_rows"] == 2 and fixes["dashes_removed"] == 1 and fixes["punctuation_to_null"] == 1
    assert fixes["parents_normalised"] == 2 and fixes["PLAN_normalised"] == 0
    said = got["corrections"]
    assert (said.before, said.after, said.before_columns) == (0, sum(fixes.values()), "")
    assert said.after_columns == "; ".join(sorted(f"{k}={v}" for k, v in fixes.items()))


def states(df, places):
    return {r.check: r for r in V.summary(df, SCHOOLS, places).collect()}


def test_valid_table_passes_all_seven(spark, places):
    rows = V.summary(clean_table(spark, [{}, {}]), SCHOOLS, places).orderBy("position").collect()
    assert [r.check for r in rows] == [CHECK_NAMES[c] for c in CHECKS]
    assert all(r.state == "APROBADO" and r.errors == 0 for r in rows)
    assert len(V.gate(clean_table(spark, [{}, {}]), SCHOOLS, places)) == 7


MUTATIONS = {
    "text_spaces": {"ESTABLECIMIENTO": " LICEO"},
    "phone_format": {"TELEFONO": "123"},
    "official_places": {"DEPARTAMENTO": "ATLANTIS"},
    "category_variants": {"SECTOR": "privado"},
    "invalid_values": {"SECTOR": "OTRO"},
}


@pytest.mark.parametrize("check", MUTATIONS)
def test_mutation_fails_its_check(spark, places, check):
    df = clean_table(spark, [{}, MUTATIONS[check]])
    assert states(df, places)[CHECK_NAMES[check]].errors > 0
    with pytest.raises(V.InvalidTable, match=CHECK_NAMES[check]):
        V.gate(df, SCHOOLS, places)
    assert V.examples(df, SCHOOLS, places).where(F.col("check") == CHECK_NAMES[check]).count() > 0
    assert next(iter(MUTATIONS[check])) in states(df, places)[CHECK_NAMES[check]].detail


def test_copied_row_fails_duplicates(spark, places):
    df = clean_table(spark, [{}, {}])
    df = df.unionByName(df.where("row_id = 0").withColumn("row_id", F.lit(9).cast("bigint")))
    assert states(df, places)["Duplicados exactos"].errors == 1
    assert {r.row_id for r in V.duplicate_examples(df, SCHOOLS).collect()} == {0, 9}
    shown = V.examples(df, SCHOOLS, places).where(F.col("check") == "Duplicados exactos").collect()
    assert [(r.row_id, r.value, r.rank) for r in shown] == [(0, "2", 1), (9, "2", 2)]


def test_dropped_column_fails_schema(spark, places):
    got = states(clean_table(spark, [{}]).drop("TELEFONO"), places)
    assert got["Esquema y tipos"].errors == 1 and got["Formato de teléfonos"].errors == 1
    shown = V.examples(clean_table(spark, [{}]).drop("TELEFONO"), SCHOOLS, places).collect()
    assert {r.check for r in shown} == {"Esquema y tipos", "Formato de teléfonos"}


def test_a_cell_counts_under_every_rule_it_breaks(spark, places):
    df = clean_table(spark, [{"SECTOR": None, "CODIGO": None}])
    found = [(r.variable, r.rule) for r in V.violations(df, SCHOOLS, places).collect()]
    assert sorted(v for v, _ in found) == ["CODIGO", "CODIGO", "SECTOR", "SECTOR"]


def test_zone_range(spark, places):
    zones = ["ZONA 25", "ZONA 26", "ZONA 07"]
    df = clean_table(spark, [{"ZONA_CAPITAL": z, "MUNICIPIO": "GUATEMALA"} for z in zones])
    bad = {r.value for r in V.violations(df, SCHOOLS, places).where("variable = 'ZONA_CAPITAL'").collect()}
    assert bad == {"ZONA 26", "ZONA 07"}


def test_examples_need_a_limit_of_zero_or_more(spark, places):
    with pytest.raises(ValueError):
        V.examples(clean_table(spark), SCHOOLS, places, limit=-1)


def test_duplicate_count_is_surplus(spark):
    df = spark.createDataFrame([("a", None)] * 23 + [("a", "")], "x string, y string")
    assert A.exact_duplicates(df, ["x", "y"]).first().duplicates == 22


def test_empty_table(spark, places):
    empty = clean_table(spark, [{}]).limit(0)
    total = A.missing_total(empty, list(SCHOOLS.clean_columns)).first()
    assert (total.missing_cells, total.total_cells, total.percent) == (0, 0, 0.0)


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_counts_and_groups_come_from_one_scan(spark, places, tmp_path):
    clean_table(spark, [{}, {}, {"SECTOR": "privado"}, {"TELEFONO": "1"}]).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert scans(V.summary(df, SCHOOLS, places)) == 1
    review = spark.createDataFrame([], "row_id_1 bigint, row_id_2 bigint")
    assert scans(M.stage_metrics(df, SCHOOLS, raw=True, review=review)) == 1


def test_a_decided_review_takes_the_table_it_came_from(spark, places, monkeypatch):
    from pulcra.plans import cleaning

    monkeypatch.setattr(cleaning, "clean_stages", None)  # the table is not cleaned a second time
    done = cleaning.Cleaned(clean_table(spark, [{}, {}, {}]), None, None, None)
    decided = spark.createDataFrame([(0, 1, "ELIMINAR"), (0, 2, "CONSERVAR")], "row_id_1 long, row_id_2 long, decision string")
    left = cleaning.clean_with_decisions(raw_table(spark, RAW), SCHOOLS, places, decided, done)
    assert sorted(r.row_id for r in left.collect()) == [0, 2]


def test_the_registry_is_dealt_over_tasks_and_parts_are_not_broadcast(spark, tmp_path):
    from checks.demo import registry

    rows = {
        "customer": spark.createDataFrame([(k, f"Customer#{k:09d}", k % 2, 1.0, "BUILDING") for k in [*range(40), 7]],
                                          "c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string"),
        "nation": spark.createDataFrame([(0, "NATION_0", 0), (1, "NATION_1", 0)], "n_nationkey long, n_name string, n_regionkey long"),
        "region": spark.createDataFrame([(0, "AFRICA")], "r_regionkey long, r_name string"),
        "part": spark.createDataFrame([(k, "ring", "Brand#1", "LARGE", 3) for k in range(30)],
                                      "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
    }
    for name, df in rows.items():
        df.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    found = registry(spark, str(tmp_path))
    assert "SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString()
    assert found.where("code <> ''").select(F.spark_partition_id()).distinct().count() > 4
    assert found.count() == 41 + 1 + 2  # one planted copy (9), one blank row a nation
