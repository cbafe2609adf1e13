"""WARC archives: write captures as linked records, read archives back, assemble the records of each transaction.

A capture is written as three records: the request, the response (or a ``revisit`` of an earlier response with the same
payload) and a metadata record; request and metadata name the capture in ``WARC-Concurrent-To``. Records are rows of
Spark's text writer whose line separator is the two line ends that close a record, so executors write archives to any
file system Spark can reach, whole-file gzip included.

``read_records`` parses archives by ``Content-Length`` (a payload may hold anything, record separators too).
``transactions`` joins request, response and metadata records through their concurrent-to identifiers: a record belongs
to the capture it names, to the capture that names it, or to the capture of a record that it is linked with (metadata
of a request). One nested row comes out per capture.

Defined results: a null html is an empty payload; a null url is written as ``urn:page:<id>``; of pages with equal
payloads of at least ``least_bytes`` bytes the one with the smallest id is the response and the others revisit it (rows
repeating a page id are captures of their own, see ``write_captures``); records naming no known capture come out
as nested rows without a response (their own id as capture id); an empty table writes no records.

An archive file is read as one row, so file size bounds a reader's memory: ``write_captures`` starts a new file every
``records_per_file`` records and gives tasks their share by ``partitions``.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import shared_folder, stored

_END = "\r\n"
RECORDS = ("file string, record_id string, warc_type string, target_uri string, date string, refers_to string, "
           "concurrent_to array<string>, content_type string, declared_digest string, headers map<string,string>, "
           "body_at int, payload_bytes long, payload_digest string, block binary")


def _record(kind: str, record_id, headers: list, block):
    """Header lines and block of one record, as one string column. Null header values are left out."""
    lines = [F.concat(F.lit(f"WARC/1.1{_END}WARC-Type: {kind}{_END}WARC-Record-ID: <"), record_id, F.lit(f">{_END}"))]
    lines += [F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_END)), F.lit("")) for name, value in headers]
    lines += [F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(_END + _END), block]
    return F.concat(*lines)


def captured(pages: DataFrame, least_bytes: int) -> DataFrame:
    """``_name, _digest, _mark, _refers_to`` of the payloads (``_name, _page, _digest, _bytes``) that are not plain.

    ``_mark`` tells the payloads of one page id apart: empty for the one with the smallest digest, ``;`` and the start of
    the digest for the others. ``_refers_to`` names the capture of the smallest id with the same payload, if that is
    another page. Both come from aggregations that reduce before their shuffle; no payload enters here.
    """
    light = pages.groupBy("_name", "_digest").agg(F.min("_page").alias("_page"), F.min("_bytes").alias("_bytes"))
    lead = light.groupBy("_name").agg(F.min("_digest").alias("_lead"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    light = light.join(lead, "_name", "left").withColumn("_mark", F.when(
        F.col("_digest") != F.col("_lead"), F.concat(F.lit(";"), F.substring("_digest", 1, 16))).otherwise(F.lit("")))
    mine = F.struct("_page", F.concat("_name", "_mark").alias("name"))
    first = light.where((F.col("_bytes") >= least_bytes) & F.col("_page").isNotNull()).groupBy("_digest").agg(
        F.min(mine).alias("_low"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    low = F.when((F.col("_bytes") >= least_bytes) & (F.col("_page") != F.col("_low._page")), F.col("_low.name"))
    return light.join(first, "_digest", "left").select("_name", "_digest", "_mark", low.alias("_refers_to")).where(
        "_mark <> '' or _refers_to is not null")


def write_captures(pages: DataFrame, path: str | None = None, page_id: str = "page_id", url: str = "url",
                   html: str = "html", least_bytes: int = 100, date: str = "2024-01-01T00:00:00Z",
                   records_per_file: int = 6000, compression: str = "gzip") -> str:
    """Write one capture (request, response or revisit, metadata) per page; returns the folder of the archives.

    Rows that repeat a page id are captures of their own with record ids of their own: the id, followed by ``;`` and the
    start of the payload's digest for all payloads of the id but one, and by ``;`` and a number for repeats of a payload.
    """
    spark = pages.sparkSession
    path = path or f"{shared_folder(spark)}/warc"
    html_or_none = F.coalesce(F.col(html), F.lit(""))
    base = pages.select(F.coalesce(F.col(page_id).cast("string"), F.lit("null")).alias("_name"), F.col(page_id).alias("_page"),
                        F.col(url).alias("_url"), html_or_none.alias("_html"),
                        F.sha2(F.encode(html_or_none, "UTF-8"), 256).alias("_digest"))
    marks = captured(base.select("_name", "_page", "_digest", F.octet_length("_html").alias("_bytes")), least_bytes)
    base = base.hint("merge").join(marks, ["_name", "_digest"], "left")
    # Dealt by these columns already: no second exchange of the payloads.
    turn = F.row_number().over(Window.partitionBy("_name", "_digest").orderBy("_url"))
    base = base.withColumn("_turn", turn)
    page = F.col("_name")
    name = F.concat("_name", F.coalesce("_mark", F.lit("")), F.when(F.col("_turn") > 1, F.concat(
        F.lit(";"), F.col("_turn").cast("string"))).otherwise(F.lit("")))
    uri = F.coalesce(F.regexp_replace("_url", "[\\x00-\\x20]", "%20"), F.concat(F.lit("urn:page:"), page))
    urn = lambda kind, of=name: F.concat(F.lit(f"urn:{kind}:page:"), of)
    digest = F.concat(F.lit("sha256:"), F.col("_digest"))
    common = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", uri)]
    linked = [*common, ("WARC-Concurrent-To", F.concat(F.lit("<"), urn("capture"), F.lit(">")))]
    http = F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}{_END}")
    response = _record("response", urn("capture"), [
        *common, ("WARC-Payload-Digest", digest), ("Content-Type", F.lit("application/http; msgtype=response"))],
        F.concat(http, F.col("_html")))
    revisit = _record("revisit", urn("capture"), [
        *common, ("WARC-Payload-Digest", digest),
        ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ("WARC-Refers-To", F.concat(F.lit("<"), urn("capture", F.col("_refers_to")), F.lit(">"))),
        ("Content-Type", F.lit("application/http; msgtype=response"))], http)
    request = _record("request", urn("request"), [*linked, ("Content-Type", F.lit("application/http; msgtype=request"))],
                      F.concat(F.lit("GET "), uri, F.lit(f" HTTP/1.1{_END}{_END}")))
    metadata = _record("metadata", urn("metadata"), [*linked, ("Content-Type", F.lit("application/warc-fields"))],
                       F.concat(F.lit("page-id: "), page, F.lit(_END)))
    records = base.select(F.explode(F.array(
        request, F.when(F.col("_refers_to").isNull(), response).otherwise(revisit), metadata)).alias("value"))
    # Archives are written once and read once or twice: the fast level of gzip is the cheaper one.
    (records.write.option("lineSep", _END + _END).option("compression", compression)
     .option("zlib.compress.level", "BEST_SPEED")
     .option("maxRecordsPerFile", records_per_file).text(path))
    return path


def parse(content: bytes) -> Iterator[tuple[dict[str, str], list[str], bytes]]:
    """The records of one archive: headers (lower-case names), concurrent-to ids, block."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)  # members one after the other are read as one
    at = 0
    while (at := content.find(b"WARC/", at)) >= 0:
        stop = content.find(b"\r\n\r\n", at)
        if stop < 0:
            return
        headers, linked = {}, []
        for line in content[at:stop].split(b"\r\n")[1:]:
            name, _, value = line.decode("utf-8", "replace").partition(":")
            name, value = name.strip().lower(), value.strip()
            if name == "warc-concurrent-to":
                linked.append(value.strip("<>"))
            headers[name] = value
        size = int(headers.get("content-length", 0))
        yield headers, linked, content[stop + 4:stop + 4 + size]
        at = stop + 4 + size


_MAIN = ("response", "revisit", "resource", "conversion")


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record of the archives under ``path``, one row each (see ``RECORDS``).

    Length and SHA-256 of each payload are taken while parsing; ``payloads=False`` leaves the blocks of captures out.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        fields = ("warc-record-id", "warc-type", "warc-target-uri", "warc-date", "warc-refers-to")
        for batch in batches:
            for i in range(batch.num_rows):
                file, rows, held = batch.column(0)[i].as_py(), [], 0
                for headers, linked, block in parse(batch.column(1)[i].as_py()):
                    at = _body(headers, block)
                    kept = payloads or headers.get("warc-type", "").lower() not in _MAIN
                    rows.append((file, *(h.strip("<>") if (h := headers.get(f)) is not None else None for f in fields),
                                 linked, headers.get("content-type"), headers.get("warc-payload-digest"),
                                 list(headers.items()), at, len(block) - at, hashlib.sha256(memoryview(block)[at:]).hexdigest(),
                                 block if kept else None))
                    held += len(block) * kept
                    if held > 4 << 20 or len(rows) >= 1000:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return files.mapInArrow(run, RECORDS)


def _body(headers: dict[str, str], block: bytes) -> int:
    """Where the payload starts: after the head of an HTTP message, else at 0."""
    at = block.find(b"\r\n\r\n") if headers.get("content-type", "").lower().startswith("application/http") else -1
    return at + 4 if at >= 0 else 0


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    text, names = pa.string(), [f.strip().split(" ")[0] for f in RECORDS.replace("map<string,string>", "map").split(",")]
    kinds = [text] * 6 + [pa.list_(text), text, text, pa.map_(text, text), pa.int32(), pa.int64(), text, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=names)


def transactions(records: DataFrame, payloads: bool = True) -> DataFrame:
    """One nested row per capture: ``capture_id, response, requests, metadata``.

    ``response`` is a struct with the HTTP payload, its length and SHA-256 (null without a response); ``requests`` and
    ``metadata`` are arrays of structs. For a revisit, payload figures are those of the record it refers to.
    ``payloads=False`` leaves payload bytes out, so that only their length and digest are joined.

    The records are written once as a table, without what is not asked for; captures, links and sources are read from it.
    """
    folder = shared_folder(records.sparkSession)
    lower = F.lower("warc_type")
    main = lower.isin(*_MAIN)
    if "payload_digest" not in records.columns:
        whole = F.expr("substring(block, body_at + 1)")
        records = records.withColumns({"payload_bytes": F.octet_length(whole).cast("long"), "payload_digest": F.sha2(whole, 256)})
    block = F.col("block") if payloads else F.when(~main, F.col("block"))
    records = stored(records.select("record_id", "warc_type", "target_uri", "date", "refers_to", "concurrent_to", "content_type",
                                    "declared_digest", "body_at", "payload_bytes", "payload_digest", block.alias("block")),
                     folder, "records")
    body = F.expr("substring(block, body_at + 1)")
    captures = records.where(main).select(
        F.col("record_id").alias("capture_id"), lower.alias("record_type"), "target_uri", "date", "refers_to",
        *([body.alias("payload")] if payloads else []), "payload_bytes", "payload_digest", "declared_digest", "concurrent_to")
    others = records.where(~main).select("record_id", lower.alias("kind"), "target_uri", "date", "content_type",
                                         "block", "concurrent_to")
    ids = captures.select("capture_id")
    links = others.select("record_id", F.explode("concurrent_to").alias("other"))
    named = captures.select(F.col("capture_id"), F.explode("concurrent_to").alias("record_id"))
    direct = links.join(ids, links["other"] == ids["capture_id"]).select("record_id", "capture_id").unionByName(
        named.select("record_id", "capture_id"))
    # A record linked with a record of a capture (either way round) belongs to that capture.
    both = links.unionByName(links.select(F.col("other").alias("record_id"), F.col("record_id").alias("other")))
    hop = both.join(direct.withColumnRenamed("record_id", "_via"), both["other"] == F.col("_via")).select(
        "record_id", "capture_id")
    chosen = direct.withColumn("_far", F.lit(0)).unionByName(hop.withColumn("_far", F.lit(1))).groupBy("record_id").agg(
        F.min(F.struct("_far", "capture_id")).alias("_best")).select("record_id", F.col("_best.capture_id").alias("_of"))
    placed = others.join(chosen, "record_id", "left").withColumn("capture_id", F.coalesce("_of", "record_id"))
    part = F.struct("record_id", "target_uri", "date", "content_type", "block")
    attached = placed.groupBy("capture_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") == "request", part))).alias("requests"),
        F.array_sort(F.collect_list(F.when(F.col("kind") != "request", part))).alias("metadata"))
    # Revisits take the figures of the response they refer to. Other captures do not enter this join, and only the sources
    # that a revisit names do, written first: a source with very many revisits is split or broadcast by its measured size.
    figures = [c for c in ("payload", "payload_bytes", "payload_digest") if c in captures.columns]
    again = F.col("record_type") == "revisit"
    wanted = captures.where(again).select(F.col("refers_to").alias("capture_id")).distinct()
    source = stored(captures.where(~again).join(wanted, "capture_id", "left_semi").groupBy(
        F.col("capture_id").alias("refers_to")).agg(*[F.first(c).alias(f"_{c}") for c in figures]), folder, "sources")
    revisits = captures.where(again).join(source, "refers_to", "left").withColumns({
        c: F.when(F.col("_payload_bytes").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c)) for c in figures})
    full = captures.where(~again).unionByName(revisits.select(captures.columns))
    response = F.struct("record_type", "target_uri", "date", "refers_to", *figures, "declared_digest").alias("response")
    return full.select("capture_id", response).join(attached, "capture_id", "full")
