"""The demo registry: customers as institutions, with planted dirt.

Every customer becomes one row and takes its wording from its own part, so the
table, its blocks and its duplicates scale with the data. The same text runs
in both engines and is the definition of the fixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from checks.base import table
from pulcra.functions.chars import DIGIT
from pulcra.profile import PUBLISHED_REVIEW, Profile, Zone

COLUMNS = (
    "code", "district", "parent", "child", "name", "address", "phone", "director",
    "segment", "status", "office",
)

REGISTRY_SQL = """
SELECT row_id, code, district, parent, child, name, address, phone, director, segment, status, office
FROM (
  SELECT base.*, CASE WHEN copy = 1 THEN 500000000 ELSE 0 END + nk * 1000000000 + k AS row_id,
    CASE WHEN k % 211 = 5 THEN '' WHEN k % 199 = 7 THEN concat('CUST', CAST(k AS STRING))
         WHEN k % 151 = 3 THEN 'CUSTOMER#000000001' WHEN k % 83 = 2 THEN c_name
         ELSE upper(c_name) END AS code,
    CASE k % 6 WHEN 0 THEN '' WHEN 2 THEN concat(n2, '-', n2, '-', lpad(CAST(k % 10000 AS STRING), 4, '0'))
         WHEN 3 THEN concat(n2, '-') WHEN 4 THEN concat(' ', n2, ' - ', k3) ELSE concat(n2, '-', k3) END AS district,
    CASE WHEN k % 31 = 0 THEN 'CAPITAL CITY' WHEN k % 97 = 1 THEN 'ATLANTIS'
         WHEN k % 41 = 3 THEN concat(lower(r_name), ' ') ELSE r_name END AS parent,
    CASE WHEN k % 31 = 0 THEN concat('ZONE ', CAST(k % 28 AS STRING))
         WHEN k % 13 = 2 THEN concat(' ', lower(n_name), '  ')
         WHEN k % 43 = 8 THEN concat('OLD ', n_name) ELSE n_name END AS child,
    CASE k % 23 WHEN 0 THEN '' WHEN 1 THEN ' N/A ' WHEN 2 THEN '...'
         WHEN 3 THEN concat('-- École ', grp, ' ', p_name) WHEN 4 THEN concat('  ', p_name, '   école ', grp)
         ELSE concat('École ', grp, ' ', p_name, CASE k % 7 WHEN 3 THEN 's' WHEN 5 THEN ' Annex, No. 2' ELSE '' END)
         END AS name,
    CASE WHEN k % 29 = 4 THEN '-' WHEN k % 37 = 6 THEN '- . -' WHEN k % 4 = 1 THEN concat(p_type, ' road ', size)
         ELSE concat('Avenue ', p_brand, ' Zone ', size) END AS address,
    CASE WHEN k % 11 = 0 THEN '' WHEN k % 17 = 0 THEN '123' WHEN k % 19 = 3 THEN concat('tel. ', ph, ' o 12345678')
         WHEN k % 5 = 0 THEN concat(ph, '/55551234') ELSE ph END AS phone,
    CASE k % 12 WHEN 0 THEN '' WHEN 1 THEN 'Sin dato' WHEN 2 THEN '-----' WHEN 3 THEN '- . -'
         WHEN 4 THEN concat('--- José ', p_brand) WHEN 5 THEN concat('-', p_type, ' Muñoz')
         ELSE concat('María ', p_type, ' ', p_brand) END AS director,
    CASE WHEN k % 53 = 0 THEN lower(c_mktsegment) WHEN k % 59 = 1 THEN 'MACHINÉRY' WHEN k % 61 = 2 THEN 'UNKNOWN'
         WHEN k % 67 = 3 THEN concat(c_mktsegment, '.') ELSE c_mktsegment END AS segment,
    CASE WHEN k % 71 = 4 THEN '' WHEN k % 73 = 5 THEN 'ÓPEN' WHEN c_acctbal < 0 THEN 'CLOSED' ELSE 'OPEN' END AS status,
    CASE WHEN k % 31 = 0 THEN 'AMERICA NORTE' WHEN k % 10 = 1 THEN concat(r_name, ' NORTE')
         WHEN k % 47 = 2 THEN 'ATLANTIS' WHEN k % 10 = 3 THEN replace(r_name, 'A', 'Á') ELSE r_name END AS office
  FROM (
    SELECT c.c_custkey AS k, c.c_name, c.c_mktsegment, c.c_acctbal, n.n_name, r.r_name, p.p_name, p.p_brand, p.p_type,
      CAST(p.p_size AS STRING) AS size, CAST(c.c_nationkey AS BIGINT) AS nk,
      lpad(CAST(c.c_nationkey AS STRING), 2, '0') AS n2, lpad(CAST(c.c_custkey % 1000 AS STRING), 3, '0') AS k3,
      CAST(CAST((c.c_custkey - c.c_custkey % 4000) / 4000 AS BIGINT) AS STRING) AS grp,
      CAST((CAST((c.c_custkey - c.c_custkey % 6) / 6 AS BIGINT) * 332857) % 60000000 + 20000000 AS STRING) AS ph,
      copies.copy
    FROM {customer} c
    JOIN {nation} n ON c.c_nationkey = n.n_nationkey
    JOIN {region} r ON n.n_regionkey = r.r_regionkey
    LEFT JOIN {part} p ON p.p_partkey = c.c_custkey
    JOIN (SELECT * FROM (VALUES (0, 0), (1, 0), (1, 1)) v(planted, copy)) copies
      ON copies.planted = CASE WHEN c.c_custkey % 103 = 9 THEN 1 ELSE 0 END
  ) base
) filled
UNION ALL
SELECT CAST(n_nationkey AS BIGINT) * 1000000000 + 999999999, '', '', '', '', '', '', '', '', '', '', ''
FROM {nation}
"""

# Rows of one nation are contiguous in row_id order and end with one blank row.
REGISTRY = "registry AS (" + REGISTRY_SQL.format(
    customer="customer", nation="nation", region="region", part="part"
) + ")"
CATALOGUE = (
    "catalogue AS (SELECT r_name AS parent, n_name AS child FROM nation "
    "JOIN region ON n_regionkey = r_regionkey)"
)
CHILD_MAP = {
    "OLD NATION_1": "NATION_1", "OLD NATION_2": "NATION_2", "OLD NATION_7": "NATION_7",
    "OLD NATION_12": "NATION_12", "NATION_3": "NATION_3",
}
CHILD_MAP_SQL = ", ".join(f"('{a}', '{b}')" for a, b in CHILD_MAP.items())
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")

_UNIT = ("parent", "child", "segment", "status", "office")

DEMO = Profile(
    name="demo",
    columns=COLUMNS,
    code="code",
    code_patterns=(rf"CUSTOMER#{DIGIT}{{9}}",),
    parent="parent",
    child="child",
    title="name",
    address="address",
    phone="phone",
    identifiers={"district": (rf"{DIGIT}{{2}}-{DIGIT}{{3}}", rf"{DIGIT}{{2}}-{DIGIT}{{2}}-{DIGIT}{{4}}")},
    free_text=("name", "address", "director"),
    dashed="director",
    categories=("segment", "status", "office"),
    reported_categories=("segment", "office"),
    variant_columns=("parent", "child", "zone", "segment", "status", "office"),
    domains={
        "parent": REGIONS, "segment": SEGMENTS, "status": ("OPEN", "CLOSED"),
        "office": REGIONS + tuple(f"{r} NORTE" for r in REGIONS),
    },
    required=("code", *_UNIT),
    label="office",
    zone=Zone(
        column="zone", capital="CAPITAL CITY", derive_pattern=rf"ZONE {DIGIT}{{1,2}}",
        valid_pattern=rf"ZONE (?:[1-9]|1{DIGIT}|2[0-5])", parent="AMERICA", child="NATION_1",
    ),
    parent_map={"CAPITAL CITY": "AMERICA"},
    child_map=CHILD_MAP,
    unit=_UNIT,
    compared=("district", "name", "address", "phone", "director", *_UNIT),
    **PUBLISHED_REVIEW,
)


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files are small beside the rows made of them, so Spark would read them
    in a few tasks and send all parts through the driver: customers are dealt over
    a few tasks for each core, and parts meet them by a merge join."""
    names = ("customer", "nation", "region", "part")
    given = {n: table(spark, sf_dir, n) for n in names}
    given["customer"] = given["customer"].repartition(2 * spark.sparkContext.defaultParallelism, "c_custkey")
    given["part"] = given["part"].hint("merge")
    return spark.sql(REGISTRY_SQL, **given)


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        region.r_name.alias("parent"), nation.n_name.alias("child")
    )
