"""Blocks between separator rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def separator_blocks(
    df: DataFrame, position: str, separator: Column, *, chunk_rows: int = 1 << 20
) -> DataFrame:
    """Number the blocks of a table whose blocks end with a separator row.

    A row's block is one plus the separators before it. A running sum over the
    whole table would put it into one task, so it is taken inside chunks of
    the position range, and chunk totals - one row per chunk - are summed up
    separately and joined back.
    """
    marked = df.withColumns({
        "__sep": F.coalesce(separator, F.lit(False)).cast("int"),
        "__chunk": F.floor(F.col(position) / chunk_rows),
    })
    totals = marked.groupBy("__chunk").agg(F.sum("__sep").alias("__seps"))
    before = Window.orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "__chunk", F.coalesce(F.sum("__seps").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__chunk").orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    running = marked.withColumn("__run", F.coalesce(F.sum("__sep").over(inside), F.lit(0)))
    return running.join(offsets, "__chunk").withColumn(
        "block_no", F.col("__offset") + F.col("__run") + 1
    ).withColumn("is_separator", F.col("__sep") == 1).drop("__sep", "__chunk", "__run", "__offset")
