r"""WARC archives: write, read back, and assemble transactions.

Writing: each page becomes a response record (or a revisit of the response that
holds the same payload), a request and a metadata record that name it in
WARC-Concurrent-To. Payloads of 1000 bytes and more that are equal (by SHA-256)
are stored once, under the largest page_id. The copies are joined to their
winner per (digest, salt), so a third of all pages with one payload is spread
over tasks. Records are the lines of a gzip text file whose line ends are CRLF.

Reading: the archive's text is split at the version line, which streams records
instead of loading files. A payload may hold that line too; pieces are glued by
Content-Length, in file order, so records come back exactly. Archives are to be
gzip files, of any size and record count, with one member or one per record:
such files are read by one task each, as glueing needs.

Assembly: concurrent-to identifiers link records, whichever side names them. A
request or metadata record that a link ties to a response belongs to it; the
others form connected components over their links, of any length, and a component
belongs to the response that one of its records is tied to (the smallest id, if
several are). One nested row per capture results. A component without a response
forms a row of its own with a null response, named by its smallest id. A
capture's row holds all its records. Records cut off by the end of their file are
in no capture; ``damaged`` lists them.

Defined cases: null html is an empty payload; null urls leave the target away;
line breaks in urls are percent-encoded; of rows that repeat page_id and
payload the first is the response; pages without id are never chosen over an
id; an empty table gives an empty archive and an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from pulcra.llm._base import query, salt_of, salted, stored, table
from pulcra.operators.components import components
from pulcra.session import scratch_path

VERSION, CRLF, MIN_REVISIT = "WARC/1.1\r\n", "\r\n", 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PRIMARY = ("response", "revisit", "resource")
RECORD = (
    "record_id string, type string, concurrent_to array<string>, refers_to string, target_uri string, date string,"
    " header_digest string, payload_bytes long, payload_sha1 string, fields string, complete boolean, payload binary, file string")


def record_id(*parts: Column) -> Column:
    """A URN made from the MD5 of what names the record."""
    h = F.md5(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _record(kind: str | Column, rid: Column, block: Column, content: str, date: str, uri: Column, *more: tuple[str, Column]) -> Column:
    """A record up to its last line end; header lines with a null value are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Date", F.lit(date)), ("WARC-Target-URI", uri), *more,
             ("Content-Type", F.lit(content)), ("Content-Length", F.octet_length(block).cast("string"))]
    return F.concat(F.lit(VERSION), F.concat_ws(CRLF, *[F.concat(F.lit(f"{k}: "), v) for k, v in lines]),
                    F.lit(CRLF * 2), block, F.lit(CRLF))


def with_winners(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, html (never null), _digest, and _winner: the page_id of the
    response with this payload if several rows have it; _once numbers rows that
    repeat page_id and payload."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    digest = F.unhex(F.sha2("html", 256))
    winners = stored(
        rows.filter(F.octet_length("html") >= min_bytes).select("page_id", digest.alias("_digest"))
        .groupBy("_digest").agg(F.max("page_id").alias("_winner"), F.count(F.lit(1)).alias("_n")).filter("_n > 1"), "payloads")
    keys = ["_digest", "_salt"]
    joined = rows.withColumns({"_digest": digest, "_salt": salt_of(F.col("page_id"))}).join(
        salted(winners), keys, "left")
    once = F.row_number().over(Window.partitionBy(*keys, "page_id").orderBy("url"))
    return joined.withColumn("_once", once)


def write_archive(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write the archive of ``pages`` (page_id, url, html) as gzip WARC files."""
    rows = with_winners(pages)
    revisit = F.col("_n").isNotNull() & ~(F.col("page_id").eqNullSafe(F.col("_winner")) & (F.col("_once") == 1))
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("html").cast("string"), F.lit(CRLF * 2))
    own = record_id(F.lit("response"), F.col("page_id"), F.hex("_digest"), F.col("_once"))
    rows = rows.select(
        "page_id", "html", uri.alias("uri"), http.alias("http"), own.alias("own"), revisit.alias("revisit"),
        F.sha1("html").alias("sha1"), record_id(F.lit("response"), F.col("_winner"), F.hex("_digest"), F.lit(1)).alias("winner"))
    host = F.coalesce(F.try_parse_url(F.col("uri"), F.lit("HOST")), F.lit(""))
    place = F.coalesce(F.try_parse_url(F.col("uri"), F.lit("PATH")), F.lit("/"))
    uri, own = F.col("uri"), F.col("own")
    only = lambda c: F.when(F.col("revisit"), c)
    main = _record(
        F.when(F.col("revisit"), "revisit").otherwise("response"), own,
        F.concat("http", F.when(F.col("revisit"), "").otherwise(F.col("html"))), "application/http;msgtype=response", date, uri,
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")), ("WARC-Profile", only(F.lit(PROFILE))),
        ("WARC-Refers-To", only(F.col("winner"))))
    request = _record(
        "request", record_id(F.lit("request"), own), F.concat(F.lit("GET "), place, F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(CRLF * 2)),
        "application/http;msgtype=request", date, uri, ("WARC-Concurrent-To", own))
    metadata = _record(
        "metadata", record_id(F.lit("metadata"), own), F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF)),
        "application/warc-fields", date, uri, ("WARC-Concurrent-To", own))
    rows.select(F.explode(F.array(request, main, metadata)).alias("value")).write.option("lineSep", CRLF).option("compression", "gzip").text(path)


def _head(piece: bytes) -> tuple[dict[str, list[str]], bytes] | None:
    """Header fields of a record, and what follows them; None if they go on."""
    head, end, rest = piece.partition(b"\r\n\r\n")
    if not end:
        return None
    names: dict[str, list[str]] = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if colon:
            names.setdefault(name.strip().lower(), []).append(value.strip())
    return names, rest


def _bytes_of(piece: bytes) -> int:
    """Bytes from the version line to the end of the record's block; 0 if its
    header goes on after ``piece``."""
    found = _head(piece)
    return len(piece) - len(found[1]) + int(found[0].get("content-length", ["0"])[0] or 0) if found else 0


def _parse(piece: bytes, payload: bool) -> tuple:
    """One record from the bytes after its version line."""
    names, rest = _head(piece)
    first = lambda n: names.get(n, [None])[0]
    size = int(first("content-length") or 0)
    block, kind = rest[:size], first("warc-type")
    body = block.partition(b"\r\n\r\n")[2] if (first("content-type") or "").startswith("application/http") else block
    digest = first("warc-payload-digest")
    fields = block.decode("utf-8", "replace") if kind not in PRIMARY else None
    return (first("warc-record-id"), kind, names.get("warc-concurrent-to", []), first("warc-refers-to"), first("warc-target-uri"),
            first("warc-date"), digest.removeprefix("sha1:") if digest else None, len(body), hashlib.sha1(body).hexdigest(), fields,
            True, body if payload and kind in PRIMARY else None)


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of gzip archives (see RECORD). ``payload=False`` leaves the
    payload away once its length and digest are taken. A record cut off by the
    end of its file has ``complete`` false."""
    arrow = to_arrow_schema(StructType.fromDDL(RECORD))
    line = VERSION.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, need, name = [], 0, 0, None
        for batch in batches:
            out: list[tuple] = []
            for data, where in zip(batch.column(0), batch.column(1), strict=True):
                data, where = data.as_py(), where.as_py()
                if where != name:
                    if held:
                        out.append(_broken(held, name))
                    held, size, need, name = [], 0, 0, where
                    if not data.strip():
                        continue  # what stands before a file's first version line
                if held:
                    held.append(line)
                    size += len(line)
                held.append(data)
                size += len(data)
                # Pieces are joined once, when the record they belong to is whole.
                if need == 0:
                    need = _bytes_of(b"".join(held))
                if need and size >= need:
                    out.append((*_parse(b"".join(held), payload), where))
                    held, size, need = [], 0, 0
            if out:
                yield _batch(out)
        if held and b"".join(held).strip():
            yield _batch([_broken(held, name)])

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    def _broken(pieces, where):
        return (None, None, [], None, None, None, None, sum(map(len, pieces)), None, None, False, None, where)

    text = spark.read.option("lineSep", VERSION).text(path)
    return text.select(F.col("value").cast("binary"), F.col("_metadata.file_path").alias("file")).mapInArrow(run, RECORD)


def damaged(records: DataFrame) -> DataFrame:
    """Records cut off by the end of their file: file and bytes that are there."""
    return records.filter("not complete").select("file", F.col("payload_bytes").alias("bytes"))


def captures_of(main: DataFrame, side: DataFrame) -> DataFrame:
    """record_id and _key, the capture, of the side records that are linked to
    anything. A link ties a record to another one, or to an id without a record."""
    mains = main.select(F.col("record_id").alias("_main")).distinct()
    named = side.select("record_id", F.explode("concurrent_to").alias("other")).unionByName(
        main.select(F.explode("concurrent_to").alias("record_id"), F.col("record_id").alias("other")))
    met = named.join(mains, F.col("other") == F.col("_main"), "left")
    direct = met.filter("_main is not null").groupBy("record_id").agg(F.min("_main").alias("_key"))
    linked = components(met.filter("_main is null").select(F.col("record_id").alias("i"), F.col("other").alias("j")))
    tied = linked.join(direct, linked["node"] == direct["record_id"], "left").groupBy("root").agg(F.min("_key").alias("_key"))
    over = linked.join(tied, "root").select(F.col("node").alias("record_id"), F.coalesce("_key", "root").alias("_over"))
    return over.join(direct, "record_id", "full_outer").select("record_id", F.coalesce("_key", "_over").alias("_key"))


def assemble(records: DataFrame) -> DataFrame:
    """Records to one nested row per capture: capture_id, response, requests,
    metadata (arrays of all such records), others."""
    records = records.filter("complete")
    main = records.filter(F.col("type").isin(*PRIMARY))
    side = records.filter(~F.col("type").isin(*PRIMARY) & (F.col("type") != "warcinfo")).select(
        "record_id", "type", "concurrent_to", "target_uri", "fields")
    side = side.join(captures_of(main, side), "record_id", "left").withColumn("_key", F.coalesce("_key", "record_id"))
    one = F.struct("record_id", "type", "target_uri", "fields")
    pick = lambda kind: F.sort_array(F.collect_list(F.when(kind, one)))
    sides = side.groupBy("_key").agg(
        pick(F.col("type") == "request").alias("requests"), pick(F.col("type") == "metadata").alias("metadata"),
        pick(~F.col("type").isin("request", "metadata")).alias("others"))
    response = F.struct("record_id", "type", "target_uri", "date", "refers_to", "payload_bytes", "payload_sha1", "header_digest", "payload")
    return main.select(F.col("record_id").alias("_main"), response.alias("response")).join(
        sides, F.col("_main") == F.col("_key"), "full_outer").select(
        F.coalesce("_main", "_key").alias("capture_id"), "response", "requests", "metadata", "others")


def page_table(captures: DataFrame) -> DataFrame:
    """One row per page: what its capture, or the one it revisits, holds."""
    fields = F.coalesce(F.try_element_at("metadata", F.lit(1))["fields"], F.lit(""))
    page = F.regexp_extract(fields, r"page-id: (-?[0-9]*)", 1)
    rows = stored(captures.filter("response is not null").select(
        F.when(page != "", page.cast("long")).alias("page_id"), F.col("response.type").alias("record_type"),
        F.col("response.record_id").alias("_id"), F.col("response.payload_bytes").alias("_bytes"),
        F.col("response.payload_sha1").alias("_sha1"), F.col("response.header_digest").alias("_digest"),
        F.col("response.refers_to").alias("_refers")), "captures")
    wanted = rows.filter("record_type = 'revisit'").select(F.col("_refers").alias("_id")).distinct()
    held = rows.filter("record_type = 'response'").join(wanted, "_id", "left_semi").select(
        F.col("_id").alias("_refers"), F.col("page_id").alias("_page"), F.col("_bytes").alias("_held"), F.col("_sha1").alias("_held_sha1"))
    revisit = F.col("record_type") == "revisit"
    sha1 = F.when(revisit, F.col("_held_sha1")).otherwise(F.col("_sha1"))
    # Responses refer to nothing; their own id keeps them from meeting in one task.
    keyed = rows.withColumns({"_refers": F.coalesce("_refers", "_id"), "_salt": salt_of(F.col("_id"))})
    return keyed.join(salted(held), ["_refers", "_salt"], "left").select(
        "page_id", F.when(revisit, F.col("_held")).otherwise(F.col("_bytes")).alias("payload_bytes"),
        sha1.alias("payload_digest"), "record_type", F.when(revisit, F.col("_page")).alias("refers_to"),
        (F.col("_digest") == sha1).alias("digest_ok"))


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS m FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN strlen(h) >= 1000 AND page_id <> m THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN strlen(h) >= 1000 AND page_id <> m THEN m END AS refers_to, true AS digest_ok
FROM w
"""


@query("op1_warc", WARC_SQL)
def op1(spark, sf_dir):
    path = scratch_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    records = stored(read_archive(spark, path, payload=False), "records")  # parsed once, used by several joins
    return page_table(assemble(records))
