"""Checked publication."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pulcra.functions import predicates as P
from pulcra.functions.rowhash import digest_number, row_digest
from pulcra.functions.text import pinned
from pulcra.operators.catalog import coverage
from pulcra.operators.profiling import all_blank
from pulcra.operators.validation import gate
from pulcra.profile import Profile
from pulcra.session import broadcast_if_small, joined_to_unique, written
from pulcra.sources.csv import read_for_validation, write_csv

_CHUNK = 1 << 20


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row (rows, xor, total) over 60-bit row digests. It ignores
    order and file layout, and as the sum is kept next to the xor, repeated
    rows do not cancel out. Mergeable, so it needs no shuffle of rows."""
    return df.select(digest_number(columns or df.columns).alias("d")).agg(*_print_of(F.col("d")))


def _print_of(digest: Column) -> list[Column]:
    return [
        F.count(digest).alias("rows"),
        F.coalesce(F.bit_xor(digest), F.lit(0)).alias("xor"),
        F.coalesce(F.sum(digest.cast("decimal(20,0)")), F.lit(0)).cast("string").alias("total"),
    ]


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Equal as multisets of rows, by fingerprint."""
    return a.columns == b.columns and fingerprint(a).first() == fingerprint(b).first()


BUCKETS = 4096


def row_differences(a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """X7, the exact form: rows of only one side with their surplus count.

    A digest tree of two levels. Rows fall into ``buckets`` by their digest;
    each side's buckets are summed up (rows, xor and sum of digests, one row a
    bucket and task) and compared. Only rows of buckets that differ are counted
    by digest, and only rows whose digests differ are shuffled as rows. Equal
    tables are told by the first level alone. A side that is costly to derive
    should be written first: it is read once per level."""
    columns = a.columns
    number = digest_number(columns)
    tagged = a.select("*", F.lit(1).alias("__n")).unionByName(b.select("*", F.lit(-1).alias("__n")))
    bucket = F.pmod(number, F.lit(buckets))
    sums = tagged.select("__n", number.alias("__d")).groupBy(F.pmod("__d", F.lit(buckets)).alias("__bucket")).agg(
        F.sum("__n").alias("rows"), F.bit_xor("__d").alias("xor"), F.sum((F.col("__n") * F.col("__d")).cast("decimal(38,0)")).alias("total"))
    # At most ``buckets`` rows, whatever the tables hold.
    torn = F.broadcast(written(sums.where("rows <> 0 OR xor <> 0 OR total <> 0").select("__bucket"), "torn"))
    digest = row_digest(columns).alias("__digest")
    digests = tagged.select("__n", digest, bucket.alias("__bucket")).join(torn, "__bucket", "left_semi")
    surplus = written(digests.groupBy("__digest").agg(F.sum("__n").alias("surplus")).where("surplus <> 0"), "surplus")
    held = tagged.select(*[f"`{c}`" for c in columns], "__n", digest, bucket.alias("__bucket")).join(torn, "__bucket", "left_semi").drop("__bucket")
    # A row with a surplus is on the side that has more of it.
    found = joined_to_unique(held, surplus, "__digest", F.xxhash64(F.spark_partition_id())).where("sign(__n) = sign(surplus)")
    return found.groupBy(*[F.col(f"`{c}`") for c in columns], "__digest", "surplus").agg(F.count(F.lit(1))).select(*[f"`{c}`" for c in columns], "surplus")


def prepare(df: DataFrame, p: Profile, catalogue: DataFrame) -> DataFrame:
    """Gate, contractual columns, sorted by the code. The sort is a range
    partitioning: file order is key order, no single task sees everything."""
    gate(df, p, catalogue)
    return df.select(*p.clean_columns).orderBy(F.col(p.code).asc_nulls_first())


@dataclass(frozen=True)
class Published:
    path: str
    rows: int
    fingerprint: tuple
    checks: list


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def publish(
    df: DataFrame, p: Profile, catalogue: DataFrame, path: str, *, csv: bool = False, name: str | None = None
) -> Published:
    """Validate, write next to the target, read back, validate again,
    compare fingerprints, and only then rename into place. Any failure removes
    the staging folder and leaves the target as it was.

    The table is Parquet, or with ``csv`` a folder of CSV files with headers,
    NULL as the empty field; as CSV does not tell NULL from '', a table that
    holds '' fails the comparison. ``name`` is the only last part of ``path``
    that is accepted. The rename needs a store that can rename."""
    if name is not None and path.rstrip("/").rsplit("/", 1)[-1] != name:
        raise ValueError(f"the published table must be called {name}")
    spark = df.sparkSession
    fs, target = _file_system(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    final = prepare(df, p, catalogue)
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    _, staged = _file_system(spark, staging)
    try:
        if csv:
            write_csv(final, staging)
        else:
            final.write.parquet(staging)
        back = _version(spark, staging, final.schema, csv)
        checks = gate(_named(back, p), p, catalogue)
        mark = tuple(fingerprint(back).first())
        if mark != tuple(fingerprint(df.select(*p.clean_columns)).first()):
            raise ValueError("the reloaded table differs from the candidate")
        if not fs.rename(staged, target):
            raise OSError(f"could not move {staging} to {path}")
    except Exception:
        fs.delete(staged, True)
        raise
    return Published(path, mark[0], mark, checks)


POINTER = "CURRENT"


def publish_version(
    df: DataFrame, p: Profile, catalogue: DataFrame, root: str, *, csv: bool = False
) -> Published:
    """X2 for stores that cannot rename folders: the table is written to a
    folder of its own under ``root`` and checked there; then the one small file
    CURRENT is replaced, which is what makes the version visible. A reader of
    :func:`current_table` sees the version before or the one after. Versions
    that failed, or are no longer current, stay until :func:`drop_versions`.

    The candidate's fingerprint is observed while it is written, so it is
    derived once; gate and fingerprint of the stored copy decide."""
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    path = f"{root.rstrip('/')}/{version}"
    final = df.select(*p.clean_columns).orderBy(F.col(p.code).asc_nulls_first())
    seen = Observation()
    # After the sort, whose sampling would count rows twice.
    observed = final.observe(seen, *_print_of(digest_number(final.columns)))
    if csv:
        write_csv(observed, path)
    else:
        observed.write.parquet(path)
    back = _version(spark, path, final.schema, csv)
    checks = gate(_named(back, p), p, catalogue)
    mark = tuple(fingerprint(back).first())
    if mark != tuple(seen.get[c] for c in ("rows", "xor", "total")):
        raise ValueError("the reloaded table differs from the candidate")
    _point(spark, root, version)
    return Published(path, mark[0], mark, checks)


def _named(back: DataFrame, p: Profile) -> DataFrame:
    """A stored table with a row id, which the examples of a failure show;
    pinned, because every rule would otherwise carry its expression along."""
    return pinned(back, {p.row_id: digest_number([p.code])})


def _version(spark: SparkSession, path: str, schema, csv: bool) -> DataFrame:
    if csv:
        # Pinned: the rules would repeat the reader's expressions many times over.
        back = read_for_validation(spark, path, columns=schema.fieldNames(), multiline=True)
        return pinned(back, {c: F.col(c) for c in back.columns})
    return spark.read.schema(schema).parquet(path)


def _point(spark: SparkSession, root: str, version: str) -> None:
    """Replace the pointer by one file operation: on a file system a rename over
    it, on an object store a put, which both show the old file or the new one."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(f"{root.rstrip('/')}/{POINTER}")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    in_place = files.getUri().getScheme() in ("s3", "s3a", "gs", "abfs", "abfss", "wasb")
    written_to = target if in_place else hadoop.Path(f"{root.rstrip('/')}/.{POINTER}-{version}")
    stream = files.create(written_to, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    if not in_place:
        context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
        options = spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
        options[0] = hadoop.Options.Rename.OVERWRITE
        context.rename(written_to, target, options)


def current_version(spark: SparkSession, root: str) -> str | None:
    """The name of the folder that is current; None before the first one."""
    files, target = _file_system(spark, f"{root.rstrip('/')}/{POINTER}")
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def current_table(spark: SparkSession, root: str, p: Profile, *, csv: bool = False) -> DataFrame:
    """The published table. The version is chosen once, when this is called."""
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in p.clean_columns])
    return _version(spark, f"{root.rstrip('/')}/{version}", schema, csv)


def drop_versions(spark: SparkSession, root: str, keep: Sequence[str] = ()) -> list[str]:
    """Delete all versions but the current one and those to ``keep`` (versions
    that are being written or read); returns the names of those deleted."""
    files, folder = _file_system(spark, root)
    kept = {current_version(spark, root), *keep}
    names = [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()]
    gone = sorted(n for n in names if n.startswith("v-") and n not in kept)
    for name in gone:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}"), True)
    return gone


def file_number(file: Column | str) -> Column:
    """The number in a part file's name: names sort as text, and a hundred
    thousand files have longer numbers than ninety-nine thousand."""
    return F.regexp_extract(file, r"part-(\d+)", 1).try_cast("bigint")


def order_breaks(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Neighbouring rows of a stored Parquet table that are out of order.

    Rows are compared inside chunks of one file; chunks then compare their
    bounds. Only the chunk bounds - one row per million - meet in one place.
    """
    rows = spark.read.parquet(path).select(
        key, F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("at"),
    ).withColumn("chunk", F.floor(F.col("at") / _CHUNK))
    inside = Window.partitionBy("file", "chunk").orderBy("at")
    chunks = rows.withColumn("bad", F.lag(key).over(inside) > F.col(key)).groupBy("file", "chunk").agg(
        F.count_if("bad").alias("inside"), F.min(key).alias("low"), F.max(key).alias("high"))
    across = Window.orderBy(file_number("file"), "file", "chunk")
    return chunks.withColumn("across", (F.lag("high").over(across) > F.col("low")).cast("int")).agg(
        (F.coalesce(F.sum("inside"), F.lit(0)) + F.coalesce(F.sum("across"), F.lit(0))).alias("violations")
    )


def invariants(
    df: DataFrame, p: Profile, expected_parents: DataFrame, *, rows: int | None = None,
    path: str | None = None,
) -> DataFrame:
    """(invariant, violations) of a published table; all must be zero.
    With the ``path`` of the stored table, its order is checked too."""
    columns = [c for c in df.columns if c != p.row_id]
    base = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(all_blank(columns)).alias("empty_rows"),
        F.count_if(F.col(p.code).isNull()).alias("missing_keys"),
    )
    wrong_rows = F.lit(0) if rows is None else (F.col("rows") != rows).cast("int")
    helper = [c for c in columns if c.startswith("Unnamed:")]
    named = {
        "row_count": wrong_rows,
        "empty_rows": F.col("empty_rows"),
        "missing_keys": F.col("missing_keys"),
        "schema": F.lit(int(tuple(columns) != p.clean_columns)
                        + len(helper) + len(columns) - len(set(columns))),
    }
    out = base.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("invariant"), v.cast("bigint").alias("violations"))
        for k, v in named.items()
    ])))
    repeated = df.select(p.code).where(F.col(p.code).isNotNull()).groupBy(p.code).agg(
        F.count(F.lit(1)).alias("n")).where("n > 1")
    out = out.unionByName(repeated.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit("repeated_keys").alias("invariant"), "violations"))
    seen = df.select(p.parent).where(F.col(p.parent).isNotNull())
    if path is not None:
        out = out.unionByName(order_breaks(df.sparkSession, path, p.code).select(
            F.lit("key_order").alias("invariant"), "violations"))
    gaps = coverage(seen, expected_parents.select(F.col(expected_parents.columns[0]).alias(p.parent)),
                    p.parent)
    return out.unionByName(gaps.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit("parent_coverage").alias("invariant"), "violations"))


def check_dictionary(
    df: DataFrame, dictionary: DataFrame, fields: tuple[str, ...], constants: dict[str, str],
    p: Profile, domain_field: str | None = None,
) -> DataFrame:
    """Problems of a data dictionary given as (variable, position, field,
    value) rows: variables absent, extra or out of place, fields missing,
    cells blank, constants that differ, observed values outside the domain."""
    spark = df.sparkSession
    columns = [c for c in df.columns if c != p.row_id]
    have = spark.createDataFrame([(c, i + 1) for i, c in enumerate(columns)], "variable string, at int")
    described = dictionary.groupBy("variable").agg(F.min("position").alias("position"))
    joined = have.join(described, "variable", "full_outer")
    problems = joined.select("variable", F.lit("").alias("field"), (
        F.when(F.col("position").isNull(), "not documented")
        .when(F.col("at").isNull(), "not in the data")
        .when(F.col("at") != F.col("position"), "out of order")
    ).alias("problem")).where("problem IS NOT NULL")
    wanted = described.select("variable", F.explode(F.array(*[F.lit(f) for f in fields])).alias("field"))
    cells = wanted.join(dictionary.select("variable", "field", "value"), ["variable", "field"], "left")
    constant = F.lit(None).cast("string")
    for field, value in constants.items():
        constant = F.when(F.col("field") == field, F.lit(value)).otherwise(constant)
    problems = problems.unionByName(cells.select("variable", "field", (
        F.when(~P.is_nonblank(F.col("value")), "blank or missing")
        .when(F.col("value") != constant, "differs from the constant")
    ).alias("problem")).where("problem IS NOT NULL"))
    if domain_field is not None:
        legal = dictionary.where(F.col("field") == domain_field).select(
            "variable", F.explode(F.split("value", ", ")).alias("value"))
        limited = [c for c in p.domains if c in columns]
        observed = df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("variable"), F.col(c).alias("value")) for c in limited
        ]))).where(F.col("value").isNotNull()).distinct()
        stray = observed.join(broadcast_if_small(legal), ["variable", "value"], "left_anti")
        problems = problems.unionByName(stray.groupBy("variable").agg(F.count(F.lit(1)).alias("n")).select(
            "variable", F.lit(domain_field).alias("field"),
            F.lit("observed value not documented").alias("problem")))
    return problems


def apply_corrections(
    df: DataFrame, ledger: DataFrame, p: Profile
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Approved corrections (key, variable, before, after). A cell changes
    only where both the key and its current value match. Returns the corrected
    table, the ledger entries that match nothing, and the entries in conflict:
    same key, variable and before, different after. Conflicts change nothing.

    Only cells of rows that the ledger names are unpivoted; they meet unique
    entries, so a key that very many rows hold skews the row side alone. A row
    is known by ``p.row_id``.
    """
    columns = [c for c in df.columns if c != p.row_id]
    cell = ["key", "variable", "before"]
    entry = ledger.groupBy(*cell).agg(
        F.min(F.struct("after")).alias("fix"),
        (F.min(F.struct("after")) != F.max(F.struct("after"))).alias("conflict"))
    keys = broadcast_if_small(ledger.select(F.col("key").alias("__key")).distinct())
    named = df.join(keys, df[p.code] == keys["__key"]).select(F.col(p.row_id).alias("__row"), "__key", F.inline(F.array(*[
        F.struct(F.lit(c).alias("__variable"), F.col(c).cast("string").alias("__value")) for c in columns
    ])))
    hits = named.join(
        broadcast_if_small(entry),
        (F.col("__key") == F.col("key")) & (F.col("__variable") == F.col("variable"))
        & F.col("__value").eqNullSafe(F.col("before")))
    fixes = hits.where(~F.col("conflict")).groupBy("__row").agg(*[
        F.max(F.when(F.col("variable") == c, F.col("fix"))).alias(f"__fix_{i}") for i, c in enumerate(columns)
    ])
    joined = df.join(fixes, df[p.row_id] == fixes["__row"], "left")
    corrected = joined.withColumns({
        c: F.when(F.col(f"__fix_{i}").isNotNull(), F.col(f"__fix_{i}")["after"]).otherwise(F.col(c))
        for i, c in enumerate(columns)
    }).select(*df.columns)

    # A struct makes NULL a value that joins.
    named_entries = ledger.withColumn("__was", F.struct("before"))
    matched = hits.select("key", "variable", F.struct("before").alias("__was")).distinct()
    stale = named_entries.join(matched, ["key", "variable", "__was"], "left_anti")
    torn = entry.where("conflict").select(
        F.struct("key", "variable", "before").alias("__cell"))
    conflicts = ledger.withColumn("__cell", F.struct(*cell)).join(torn, "__cell", "left_semi")
    return corrected, stale.select(*ledger.columns), conflicts.select(*ledger.columns)
