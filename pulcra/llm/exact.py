"""Exact duplicates: local winners, salted digest groups, global winners.

Copies are combined in three steps, each of which groups by the whole text
beside its digest, so equal digests alone never make two texts equal:

1. inside a map task (the partial aggregate before the first exchange), where
   a text that a task holds a thousand times becomes one row;
2. per (digest, salt), the salt coming from the map task, so the winners of a
   text that every task holds are spread over ``salts`` reducers;
3. per digest, over at most ``salts`` winners of a text.

Only groups of two and more rows are joined back, once per salt of the row's
id, so a group with a third of all rows is met in ``salts`` tasks.

Defined cases: a null text equals an empty one. A null id never wins over an
id; a group of nulls only keeps one of its rows. Of rows that repeat text and
id exactly one is kept. An empty table gives an empty result. Other columns are
carried unread, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulcra.llm._base import SALTS, query, salt_of, salted, stored, table


def normalised(text: Column) -> Column:
    """Runs of ASCII white space as one space; only runs that are not one space
    already are rewritten."""
    runs = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
    return F.regexp_replace(F.coalesce(text, F.lit("")), runs, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def duplicate_groups(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """``rows`` (_id, _digest, _text) to the groups of two and more equal
    texts: _digest, _texts (different texts of this digest), and _groups
    holding (text or null, keep, size) - the text only where digests collide."""
    local = rows.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    winners = local.groupBy("_digest", "_salt", "_text").agg(
        F.min("_id").alias("_keep"), F.count(F.lit(1)).alias("_size"))
    return (
        winners.repartition("_digest").groupBy("_digest", "_text")
        .agg(F.min("_keep").alias("_keep"), F.sum("_size").alias("_size"))
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                salts: int = SALTS, carry: bool = False,
                digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept and the text's
    digest. ``carry=True`` adds the whole input row as the struct ``row``."""
    text = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text")).withColumn(
        "_digest", digest(F.col("_text")))
    texts = duplicate_groups(rows, salts)
    groups = stored(
        texts.groupBy("_digest").agg(
            F.count(F.lit(1)).alias("_texts"), F.min("_keep").alias("_keep"),
            F.sum("_size").alias("_size")).filter("_size > 1"), "exact-groups")
    members = docs.select(
        F.col(id_col).alias("_id"), digest(text).alias("_digest"), text.alias("_text"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
    ).withColumn("_salt", salt_of(F.col("_id"), salts=salts))
    keys = ["_digest", "_salt"]
    if groups.filter("_texts > 1").limit(1).count():
        groups = texts  # some digest has two texts: join on the text as well
        keys = ["_digest", "_salt", "_text"]
    else:
        groups, members = groups.drop("_texts"), members.drop("_text")
    joined = members.join(salted(groups, salts), keys, "left")
    # The same exchange serves the join and this window; it numbers repeated rows only.
    once = F.row_number().over(Window.partitionBy(*keys, "_id").orderBy(F.lit(1)))
    joined = joined.withColumn("_once", once)
    keep = F.coalesce("_keep", "_id")
    return joined.select(
        F.col("_id").alias(id_col), keep.alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (keep.eqNullSafe(F.col("_id")) & (F.col("_once") == 1)).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"), *(["row"] if carry else []))


def unique_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    return exact_dedup(docs, id_col, text_col, carry=True).filter("kept").select("row.*")


EXACT_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM t WINDOW w AS (PARTITION BY t)
"""


@query("op8_exact_dedup", EXACT_SQL)
def op8(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))
