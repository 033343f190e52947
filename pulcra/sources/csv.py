"""CSV in and out (S1-S5, S8, S10), always all-text and schema first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulcra.functions.predicates import is_nonblank

# What a default tabular reader takes for "not available".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of the first file only; no data is inferred."""
    return spark.read.option("header", True).option("escape", '"').csv(path).columns


def read_raw(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None, *,
    multiline: bool = False, position: str | None = None, file: str | None = None,
) -> DataFrame:
    """Every column text, markers literal, empty fields as ''.

    All paths are one scan. Every task checks the header of its own file
    against ``columns`` (default: the first file's header), so a file with
    other names or another order fails the read. Files are split among tasks; a
    row that a quoted line break cuts has too few fields and fails the read.
    ``multiline`` keeps such line breaks and reads each file in one task. ``position`` adds an id that grows in file order.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise ValueError("no paths given")
    columns = list(columns or header_of(spark, paths[0]))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = (
        spark.read.schema(schema).option("header", True).option("enforceSchema", False)
        .option("multiLine", multiline).option("escape", '"').option("encoding", "UTF-8")
        .option("mode", "FAILFAST").csv(paths)
    )
    extra: list[Column] = []
    if position:
        extra.append(F.monotonically_increasing_id().alias(position))
    if file:
        extra.append(F.col("_metadata.file_name").alias(file))
    text_columns = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns]
    return df.select(*extra, *text_columns)


def read_for_validation(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """Literal markers stay, only the empty field is missing."""
    df = read_raw(spark, paths, **options)
    return df.select(*[
        F.nullif(F.col(f"`{f.name}`"), F.lit("")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def read_default_na(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    """S3: the usual not-available tokens are missing too."""
    df = read_raw(spark, paths, **options)
    return df.select(*[
        F.when(~F.col(f"`{f.name}`").isin(*NA_TOKENS), F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def drop_blank_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows blank in every column go (blank means only whitespace)."""
    keep = F.lit(False)
    for c in columns:
        keep = keep | is_nonblank(F.col(c))
    return df.where(keep)


def union_files(
    spark: SparkSession, paths: Sequence[str], *, drop_blank: bool = False, **options
) -> DataFrame:
    """Several files of one layout as one table."""
    df = read_raw(spark, paths, **options)
    return drop_blank_rows(df, df.columns) if drop_blank else df


def write_csv(df: DataFrame, path: str, *, files: int | None = None) -> None:
    """UTF-8, header, LF, NULL as an empty field; many part files."""
    out = df if files is None else df.repartition(files)
    (
        out.write.option("header", True).option("lineSep", "\n").option("encoding", "UTF-8")
        .option("nullValue", "").option("emptyValue", "").option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def expect_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns in this order."""
    if list(df.columns) != list(columns):
        raise ValueError(f"expected columns {list(columns)}, found {df.columns}")
    return df


def constant_breaks(df: DataFrame, column: str, value: str, where: Column | None = None) -> DataFrame:
    """Rows in which a column that must be constant is not."""
    rows = df if where is None else df.where(where)
    return rows.where(~F.col(column).eqNullSafe(F.lit(value)))


