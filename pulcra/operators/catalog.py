"""Lookups against maps and catalogues.

A catalogue is a DataFrame. It is broadcast only after its size was measured;
a larger one goes through a shuffled join on the same unique keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulcra.functions import text
from pulcra.functions.predicates import is_nonblank
from pulcra.session import broadcast_if_small, is_small, joined_to_unique, written


def _hinted(side: DataFrame, plain: DataFrame) -> DataFrame:
    """Broadcast ``side`` if ``plain``, which it only shrinks, is small: what is
    measured is a scan that stops early, never a shuffle."""
    return F.broadcast(side) if is_small(plain) else side


def map_column(df: DataFrame, column: str, mapping: DataFrame, out: str | None = None) -> DataFrame:
    """Replace by a (from, to) table; unmapped keys keep themselves."""
    source, target = mapping.columns[:2]
    plain = mapping.select(F.col(source).alias("__from"), F.col(target).alias("__to"))
    lookup = _hinted(plain.dropDuplicates(["__from"]), plain)
    keyed = df.withColumn("__key", text.clean_text(F.col(column), ascii_only=True))
    joined = keyed.join(lookup, keyed["__key"] == lookup["__from"], "left")
    return joined.withColumn(out or column, F.coalesce("__to", "__key")).drop(
        "__key", "__from", "__to"
    )


def catalogue_keys(catalogue: DataFrame) -> DataFrame:
    """Accent-folded distinct (parent, child) keys of a catalogue."""
    parent, child = catalogue.columns[:2]
    folded = text.nfkc_columns(catalogue.select(parent, child), [parent, child])
    return folded.select(
        text.place_key(F.col(parent)).alias("__parent_key"),
        text.place_key(F.col(child)).alias("__child_key"),
    ).distinct()


def flag_places(
    df: DataFrame, parent: str, child: str, catalogue: DataFrame,
    parent_flag: str = "parent_known", pair_flag: str = "pair_known", small: bool | None = None,
) -> DataFrame:
    """P7/P8 as flag columns: is the parent known, is the pair known. NULL
    parents or children are never known. Expects NFKC input.

    ``small`` (measured by default) broadcasts the catalogue. A large one never
    meets the rows: it meets their distinct pairs, counted out on the map side,
    so a parent that half of all rows have is a few pairs; the pairs with their
    flags then join the rows once, broadcast or dealt over salts. A stream, whose
    pairs are not known beforehand, joins the catalogue as it is."""
    keys = catalogue_keys(catalogue)
    keyed = df.withColumns({
        "__pk": F.when(F.col(parent).isNotNull(), text.place_key(F.col(parent))),
        "__ck": F.when(F.col(child).isNotNull(), text.place_key(F.col(child))),
    })
    # Folding and distinct only shrink the catalogue, so its own size is a bound.
    small = is_small(catalogue.select(*catalogue.columns[:2])) if small is None else small
    if small or df.isStreaming:
        hint = F.broadcast if small else (lambda side: side)
        pairs = hint(keys.withColumn("__pair", F.lit(True)))
        parents = hint(keys.select(F.col("__parent_key").alias("__p")).distinct().withColumn("__known", F.lit(True)))
        joined = keyed.join(parents, keyed["__pk"] == parents["__p"], "left")
        joined = joined.join(
            pairs,
            (joined["__pk"] == pairs["__parent_key"]) & (joined["__ck"] == pairs["__child_key"]),
            "left",
        )
    else:
        seen = keyed.select("__pk", "__ck").where("__pk IS NOT NULL").distinct()
        parents = keys.select(F.col("__parent_key").alias("__pk")).distinct().withColumn("__known", F.lit(True))
        pairs = keys.toDF("__pk", "__ck").withColumn("__pair", F.lit(True))
        known = joined_to_unique(seen, parents, "__pk", "__ck").join(pairs.hint("merge"), ["__pk", "__ck"], "left")
        place = F.struct("__pk", "__ck")
        flags = written(known.select(place.alias("__place"), "__known", "__pair"), "places")
        joined = joined_to_unique(keyed.withColumn("__place", place), flags, "__place", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), "left")
    return joined.withColumns({
        parent_flag: F.coalesce("__known", F.lit(False)),
        pair_flag: F.coalesce("__pair", F.lit(False)),
    }).drop("__pk", "__ck", "__p", "__known", "__parent_key", "__child_key", "__pair", "__place")


def coverage(observed: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Members of exactly one of two sets, with the side they are on.

    Both sides are made distinct by one grouped pass over their union, so a
    hot member is one row per task, and no join is needed.
    """
    tagged = observed.select(F.col(key), F.lit(1).alias("o"), F.lit(0).alias("e")).unionByName(
        expected.select(F.col(key), F.lit(0).alias("o"), F.lit(1).alias("e"))
    )
    sides = tagged.groupBy(key).agg(F.max("o").alias("o"), F.max("e").alias("e"))
    return sides.where(F.col("o") != F.col("e")).select(
        key, F.when(F.col("o") == 1, F.lit("extra")).otherwise(F.lit("absent")).alias("status")
    )


def map_hits(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """How many map keys occur among the observed, normalised values."""
    source = mapping.columns[0]
    folded = text.nfkc_columns(df.select(F.col(column).alias("v")).where("v IS NOT NULL").distinct(), ["v"])
    seen = folded.select(text.canonical(F.col("v"), ascii_only=True).alias("k")).distinct()
    keys = mapping.select(F.col(source).alias("k")).distinct()
    return seen.join(broadcast_if_small(keys), "k", "left_semi").agg(F.count("k").alias("hits"))


def resolved_codes(df: DataFrame, column: str, codes: DataFrame, out: str, known: str = "known") -> DataFrame:
    """Every row with the code of its name, and whether it has one. Names
    of both sides are folded alike (spaces collapsed, upper case); rows are read
    once. Of codes that share a folded name the smallest counts."""
    name, code = codes.columns[:2]
    plain = codes.select(F.col(name).alias("__name"), F.col(code).alias(out))
    folded = plain.groupBy(F.upper(text.collapse(F.col("__name"))).alias("__name")).agg(
        F.min(out).alias(out), F.lit(True).alias(known))
    keyed = df.withColumn("__key", F.upper(text.collapse(F.col(column))))
    table = _hinted(folded, plain)
    joined = keyed.join(table, keyed["__key"] == table["__name"], "left")
    return joined.withColumn(known, F.coalesce(known, F.lit(False))).drop("__key", "__name")


def lookup_codes(
    df: DataFrame, column: str, codes: DataFrame, out: str
) -> tuple[DataFrame, DataFrame]:
    """S11 as two tables, resolved rows and rejects: an unknown key never
    disappears. Where both go to one place, :func:`resolved_codes` reads once."""
    found = resolved_codes(df, column, codes, out, "__known")
    return found.where("__known").drop("__known"), found.where("NOT __known").drop("__known", out)


def outside_catalogue(df: DataFrame, parent: str, child: str, catalogue: DataFrame) -> DataFrame:
    """Rows with both places non-blank whose pair is not in the catalogue."""
    rows = df.where(is_nonblank(F.col(parent)) & is_nonblank(F.col(child)))
    return flag_places(rows, parent, child, catalogue).where(~F.col("pair_known"))
