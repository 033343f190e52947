r"""Personal data: patterns, and terms that give it away.

Base spans come from four patterns (email, ip, card, phone), matched leftmost
and without overlap per kind over the whole text; matches that fail their check
are dropped. Runs of the patterns are possessive and begin where a run begins,
so a text of one endless run costs one pass and no deep recursion.

The information-theoretic part protects entities: every found value, and of an
e-mail address also its local part and its host, which pool the values that share
them. An entity e in df(e) of N documents has the information content IC(e) =
-log2(df(e) / N). A term t (a word of four letters and more, outside base spans)
that is in n documents with e and in df(t) documents at all tells log2(N P / df(e))
of it, P being the lower end of Wilson's interval (Z) for n of df(t): one document
says less than many. That, as a share of IC, is the term's disclosure; the highest
one over the entities of a document counts. From GENERALISE on the term's
occurrences, wherever they are in the document, are generalised to two letters,
from REMOVE on removed. So a name that only the documents with an address have is
protected in them, be it one document. Added spans have the kind ``term`` and
never touch a base span.

Everything is DataFrame functions. Positions come from marking matches and
splitting: odd pieces are matches, and lengths add up to code point offsets.
A disclosure of GENERALISE needs df(t) <= df(e)^GENERALISE N^(1 - GENERALISE), so
occurrences of commoner terms go before anything is paired. Frequent terms (over
N / 200 documents, so at most 200 times the mean number of different words of a
document) are looked up by a broadcast, others by a join without a frequent key.
Entities that occur in the very same documents are one class, so a list of
addresses makes no product with the words around it; entities of a single document
need no counting of pairs at all. Counts are partial sums before a shuffle.

Defined cases: null text is empty; repeated rows are documents of their own; a
null id is one more id; other columns are left alone; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulcra.llm._base import query, salt_of, salted, stored, table

GENERALISE, REMOVE, Z, COMMON = 0.7, 0.9, 1.645, 200
KINDS = ("email", "ip", "card", "phone", "term")
MARK, OTHER = "\x01", "\x02"
WORD = r"\p{L}{4,}"
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
# pattern; a cheaper condition that every text with a valid match meets
PATTERNS = {
    "email": (rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){12}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}


def is_valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.char_length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


def marked_spans(text: Column, pattern: str, valid) -> Column:
    """array<struct<start, end>> of the valid matches; ``text`` has no MARK."""
    pieces = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)
    span = "array<struct<start:int,end:int>>"
    begin = F.struct(F.lit(0).alias("at"), F.lit(False).alias("match"), F.array().cast(span).alias("found"))

    def step(acc, piece):
        end = acc["at"] + F.char_length(piece)
        here = F.array(F.struct(acc["at"].alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), (~acc["match"]).alias("match"),
                        F.when(acc["match"] & valid(piece), F.concat(acc["found"], here)).otherwise(acc["found"]).alias("found"))

    return F.aggregate(pieces, begin, step)["found"]


def base_spans(text: Column) -> Column:
    """array<struct<kind, start, end>>, by kind and start; kind is an index into KINDS."""
    def of(i: int, kind: str) -> Column:
        pattern, gate = PATTERNS[kind]
        found = F.when(text.rlike(gate), marked_spans(text, pattern, lambda m: is_valid(kind, m)))
        tagged = F.transform(found, lambda s: F.struct(F.lit(i).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
        return F.coalesce(tagged, F.array().cast("array<struct<kind:int,start:int,end:int>>"))

    return F.concat(*[of(i, kind) for i, kind in enumerate(PATTERNS)])


def masked(text: Column) -> Column:
    """``text`` with its e-mail addresses, the only base spans that hold letters,
    replaced by as many other characters."""
    pattern, gate = PATTERNS["email"]
    pieces = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)
    other = F.transform(pieces, lambda piece, i: F.when(i % 2 == 1, F.repeat(F.lit(OTHER), F.char_length(piece))).otherwise(piece))
    return F.when(text.rlike(gate), F.array_join(other, "")).otherwise(text)


def found_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per row of ``docs``: _n (its number), _id, _name (of id and text),
    _spans with their values, and _masked, the text to look for terms in; the
    last two are null without a span."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    text = F.when(F.instr(text, MARK) > 0, F.translate(text, MARK, OTHER)).otherwise(text)
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text")).withColumn("_base", base_spans(F.col("_text")))
    name = F.sha2(F.concat_ws("\n", F.coalesce(F.col("_id").cast("string"), F.lit("null")), "_text"), 256)
    valued = F.transform("_base", lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        F.lower(F.substr(F.col("_text"), s["start"] + 1, s["end"] - s["start"])).alias("value")))
    has = F.size("_base") > 0
    return rows.select(F.monotonically_increasing_id().alias("_n"), "_id", F.when(has, name).alias("_name"), valued.alias("_spans"),
                       F.when(has, masked(F.col("_text"))).alias("_masked"))


def entities(found: DataFrame) -> DataFrame:
    """_n and the different entities of each document with spans."""
    value = F.col("s.value")
    parts = F.when(F.col("s.kind") == 0, F.array(
        F.concat(F.lit("local:"), F.substring_index(value, "@", 1)), F.concat(F.lit("host:"), F.substring_index(value, "@", -1))
    )).otherwise(F.array().cast("array<string>"))
    whole = F.array(F.concat("s.kind", F.lit(":"), value))
    rows = found.select("_n", F.explode("_spans").alias("s"))
    return rows.select("_n", F.explode(F.concat(whole, parts)).alias("entity")).distinct()


def classes(found: DataFrame) -> DataFrame:
    """_n, the classes (df, sign) of its entities, and the highest df. A class
    is all entities of the very same documents: their number and the sum of
    their hashes name it."""
    held = entities(found)
    sign = F.sum(F.xxhash64("_n").cast("decimal(38,0)")).alias("sign")
    known = held.groupBy("entity").agg(F.count(F.lit(1)).alias("df"), sign)
    rows = held.withColumn("_salt", salt_of(F.col("_n"))).join(salted(known), ["entity", "_salt"])
    return rows.groupBy("_n").agg(F.collect_set(F.struct("df", "sign")).alias("classes"), F.max("df").alias("top"))


def terms_of(text: Column) -> Column:
    """The different terms of a masked text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.lower(w)))


def word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """term and df: in how many rows of ``docs`` each term is. Texts are masked
    like those that terms are looked up in."""
    words = docs.select(F.explode(terms_of(masked(F.col(text_col)))).alias("term"))
    return words.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def bound(df: Column, n: float) -> Column:
    """The highest df of a term that can disclose an entity of ``df`` documents."""
    return F.pow(df, F.lit(GENERALISE)) * F.lit(n ** (1 - GENERALISE) * 1.000001)


def disclosure(both: Column, term: Column, entity: Column, n: float) -> Column:
    """Of a term in ``both`` of an entity's documents and in ``term`` of all."""
    p, z = both / term, Z * Z
    low = (p + z / (2 * term) - Z * F.sqrt(p * (1 - p) / term + z / (4 * term * term))) / (1 + z / term)
    return F.try_divide(F.log2(n * low / entity), F.log2(n / entity))


def suspects(docs: DataFrame, found: DataFrame, held: DataFrame, text_col: str, n: float) -> DataFrame:
    """_n, term, df: the different terms of documents with entities that are rare
    enough to disclose one of them."""
    counts = stored(word_counts(docs, text_col), "terms")
    rows = found.filter("_masked is not null").join(held.select("_n", "top"), "_n").select(
        "_n", bound(F.col("top"), n).alias("most"), F.explode(terms_of(F.col("_masked"))).alias("term"))
    common = F.col("df") > max(n / COMMON, 16)
    first = rows.join(F.broadcast(counts.filter(common)), "term", "left").filter("df is null or df <= most")
    rare = first.filter("df is null").drop("df").join(counts.filter(~common).hint("merge"), "term").filter("df <= most")
    return rare.unionByName(first.filter("df is not null")).drop("most")


def occurrences(found: DataFrame, told: DataFrame) -> DataFrame:
    """_n, start, end, disclosure: where the telling terms stand. A running sum
    over the pieces of a text gives positions; only texts with a telling term
    are taken apart."""
    rows = found.filter("_masked is not null").join(told.select("_n").distinct(), "_n", "left_semi")
    pieces = rows.select("_n", F.posexplode(F.split(F.regexp_replace("_masked", WORD, f"{MARK}$0{MARK}"), MARK, -1)).alias("at", "piece"))
    order = Window.partitionBy("_n").orderBy("at")
    placed = pieces.withColumn("size", F.char_length("piece")).withColumn("end", F.sum("size").over(order).cast("int"))
    words = placed.filter("at % 2 = 1").select("_n", F.lower("piece").alias("term"), (F.col("end") - F.col("size")).alias("start"), "end")
    return words.join(told, ["_n", "term"]).drop("term")


def telling(near: DataFrame, held: DataFrame, n: float) -> DataFrame:
    """_n, term, disclosure (the highest, GENERALISE at least)."""
    pairs = near.select("_n", "term", F.col("df").alias("term_df")).join(held.select("_n", "classes"), "_n").select(
        "_n", "term", "term_df", F.explode("classes").alias("c")).select("_n", "term", "term_df", "c.df", "c.sign").filter(
        F.col("term_df") <= bound(F.col("df"), n))
    alone = pairs.filter("df = 1").select("_n", "term", disclosure(F.lit(1.0), F.col("term_df"), F.col("df"), n).alias("disclosure"))
    shared = pairs.filter("df > 1")
    both = shared.groupBy("df", "sign", "term", "term_df").agg(F.count(F.lit(1)).alias("both")).select(
        "df", "sign", "term", disclosure(F.col("both"), F.col("term_df"), F.col("df"), n).alias("disclosure")).filter(
        F.col("disclosure") >= GENERALISE)
    met = shared.withColumn("_salt", salt_of(F.col("_n"))).join(salted(both), ["df", "sign", "term", "_salt"]).select("_n", "term", "disclosure")
    return alone.filter(F.col("disclosure") >= GENERALISE).unionByName(met).groupBy("_n", "term").agg(F.max("disclosure").alias("disclosure"))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, _name, and spans as
    array<struct<kind, start, end, action>> by kind and start."""
    found = stored(found_spans(docs, id_col, text_col), "spans")
    n = float(found.count())
    held = stored(classes(found), "classes")
    near = stored(suspects(docs, found, held, text_col, n), "suspects")
    told = stored(telling(near, held, n), "telling")
    action = F.when(F.col("disclosure") >= REMOVE, "remove").otherwise("generalise")
    added = occurrences(found, told).groupBy("_n").agg(F.sort_array(F.collect_list(F.struct(
        F.lit(4).alias("kind"), "start", "end", action.alias("action")))).alias("_added"))
    base = F.transform("_spans", lambda s: F.struct(s["kind"], s["start"], s["end"], F.lit("mask").alias("action")))
    kind = "array<struct<kind:int,start:int,end:int,action:string>>"
    return found.join(added, "_n", "left").select(
        F.col("_id").alias(id_col), "_name",
        F.concat(base.cast(kind), F.coalesce(F.col("_added").cast(kind), F.array().cast(kind))).alias("spans"))


def sanitised(text: Column, found: Column) -> Column:
    """``text`` with its spans replaced; of overlapping spans the first, then
    the longest, counts."""
    order = F.array_sort(found, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(acc, s):
        own = F.substr(text, s["start"] + 1, s["end"] - s["start"])
        new = F.when(s["action"] == "mask", F.element_at(names, s["kind"] + 1)).when(
            s["action"] == "generalise", F.concat(F.substr(own, F.lit(1), F.lit(2)), F.lit("*"))).otherwise("")
        ahead = F.concat(acc["out"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), new)
        over = s["start"] >= acc["at"]
        return F.struct(F.when(over, s["end"]).otherwise(acc["at"]).alias("at"), F.when(over, ahead).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(order, begin, step)
    return F.concat(done["out"], F.substr(text, done["at"] + 1))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text sanitised; texts without a span stay as they are."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    name = F.sha2(F.concat_ws("\n", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.translate(text, MARK, OTHER)), 256)
    found = spans(docs, id_col, text_col).filter("_name is not null").select("_name", F.col("spans").alias("_found")).dropDuplicates(["_name"])
    new = F.when(F.col("_found").isNotNull(), sanitised(F.col(text_col), F.col("_found"))).otherwise(F.col(text_col))
    return docs.withColumn("_name", name).join(found, "_name", "left").select(
        *[new.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    names = F.array(*map(F.lit, KINDS))
    told = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] < 4)
    count = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long")
    return found.select(
        id_col, *[count(i).alias(f"n_{KINDS[i]}") for i in range(4)],
        F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"), count(4).alias("n_term"))


@query("op6_pii")
def op6(spark, sf_dir):
    return digest(spans(table(spark, sf_dir, "documents")))
