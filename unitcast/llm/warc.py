"""WARC archives: write captures, read records back, assemble transactions.

Writing makes three records per page: a request, a response (or a revisit, if
another page holds the same payload and is its response) and a metadata
record; request and metadata name the response in ``WARC-Concurrent-To``.
Records are built as strings in the JVM, packed into byte-bounded archives and
written by Spark's text sink with gzip, so archives are committed like any
Spark output.  Reading goes through ``binaryFile`` and follows Content-Length,
so payloads may hold anything.  ``assemble`` brings the record types together
through the concurrent-to identifiers, one nested row per capture.  Archives
written elsewhere may name them on either side and several times, hold several
requests or metadata records of a capture, or lack its response; all records
stay.

Of pages with equal payloads of at least ``min_bytes`` bytes the one with the
largest id is the response; the others are revisits without a payload that
refer to it.  The choice is a map-side combined maximum per payload digest and
a join on the page, so a payload that a third of all pages share is never
gathered.

Edge cases: a null html is an empty payload; a null url becomes
``urn:page:<id>``, white space and control characters in a url are
percent-encoded; a null page id is after all others and comes back as null;
repeated equal rows have equal record ids and are one capture; rows of one id
with other content are captures of their own; an empty table writes no
archive and reads back empty; extra columns are ignored.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from unitcast.llm import common

ARCHIVE_BYTES = 16 << 20      # an archive is closed once it holds so many bytes
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a binary column."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _uuid(*parts: Column) -> Column:
    return F.regexp_replace(F.md5(F.concat_ws("\n", *parts).cast("binary")),
                            "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")


def _record(kind: str, record_id: Column, uri: Column, content_type: str, block: Column, *headers) -> Column:
    head = [F.lit(f"WARC/1.1{END}WARC-Type: {kind}{END}WARC-Record-ID: "), record_id,
            F.lit(f"{END}WARC-Date: {DATE}{END}WARC-Target-URI: "), uri]
    for name, value in headers:
        head += [F.lit(f"{END}{name}: "), value]
    return F.concat(*head, F.lit(f"{END}Content-Type: {content_type}{END}Content-Length: "),
                    F.octet_length(block).cast("string"), F.lit(END + END), block, F.lit(END + END))


def _pages(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html"), F.lit(""))
    page = common.key_of("page_id")
    uri = F.regexp_replace(F.coalesce(F.col("url"), F.concat(F.lit("urn:page:"), page.cast("string"))), "%", "%25")
    for code in [*range(33), 127]:
        uri = F.replace(uri, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    uri = F.when(F.coalesce(F.col("url"), F.lit("")).rlike("[\\x00-\\x20\\x7f]"), uri).otherwise(
        F.coalesce(F.col("url"), F.concat(F.lit("urn:page:"), page.cast("string"))))
    return pages.select(page.alias("_page"), uri.alias("_uri"), html.alias("_html"),
                        base32_sha1(html.cast("binary")).alias("_digest"),
                        F.octet_length(html).cast("long").alias("_bytes"))


def records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``(value)``: the records of each page as text, three rows per page."""
    plain = _pages(pages)
    thin = plain.select("_page", "_uri", "_digest", "_bytes").filter(F.col("_bytes") >= min_bytes)
    first = thin.groupBy("_digest").agg(F.max(F.struct("_page", "_uri")).alias("_first"), F.count(F.lit(1)).alias("_n"))
    revisits = (thin.join(first.filter("_n > 1"), "_digest")
                .filter((F.col("_page") != F.col("_first._page")) | (F.col("_uri") != F.col("_first._uri")))
                .select(F.col("_page").alias("_p"), F.col("_uri").alias("_u"), F.col("_digest").alias("_d"),
                        _uuid(F.col("_first._page").cast("string"), F.col("_first._uri"), F.col("_digest"),
                              F.lit("response")).alias("_refers")).distinct())
    rows = plain.join(revisits, (F.col("_page") == F.col("_p")) & (F.col("_uri") == F.col("_u"))
                      & (F.col("_digest") == F.col("_d")), "left")
    ids = {k: _uuid(F.col("_page").cast("string"), F.col("_uri"), F.col("_digest"), F.lit(k))
           for k in ("response", "request", "metadata")}
    uri, digest = F.col("_uri"), F.concat(F.lit("sha1:"), F.col("_digest"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
                    F.col("_bytes").cast("string"), F.lit(END + END))
    response = _record("response", ids["response"], uri, "application/http; msgtype=response",
                       F.concat(http, F.col("_html")), ("WARC-Payload-Digest", digest))
    revisit = _record("revisit", ids["response"], uri, "application/http; msgtype=response", http,
                      ("WARC-Payload-Digest", digest), ("WARC-Profile", F.lit(PROFILE)),
                      ("WARC-Refers-To", F.col("_refers")))
    host = F.regexp_extract(uri, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    path = F.regexp_extract(uri, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(.*)$", 1)
    request = _record("request", ids["request"], uri, "application/http; msgtype=request",
                      F.concat(F.lit("GET "), F.when(path == "", "/").otherwise(path), F.lit(f" HTTP/1.1{END}Host: "),
                               host, F.lit(END + END)), ("WARC-Concurrent-To", ids["response"]))
    metadata = _record("metadata", ids["metadata"], uri, "application/warc-fields",
                       F.concat(F.lit("page-id: "), F.col("_page").cast("string"), F.lit(END)),
                       ("WARC-Concurrent-To", ids["response"]))
    return rows.select(F.explode(F.array(
        request, F.when(F.col("_refers").isNull(), response).otherwise(revisit), metadata)).alias("value"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write the records of ``pages`` as gzipped archives of bounded size."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def closed():   # the sink ends each row with a line feed, the last byte of a record
            return pa.record_batch([pa.array([b"".join(held)[:-1]], pa.binary())], names=["value"])

        for batch in batches:
            for value in batch.column(0):
                data = value.as_py()
                held.append(data)
                size += len(data)
                if size >= archive_bytes:
                    yield closed()
                    held, size = [], 0
        if held:
            yield closed()

    (records(pages, min_bytes).select(F.col("value").cast("binary").alias("value"))
     .mapInArrow(pack, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(path))


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record of an archive.  The
    values of a repeated header are joined by line feeds."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode("utf-8").split(END)
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers: dict[str, str] = {}
        for name, _, value in (line.partition(":") for line in lines):
            name, value = name.strip().lower(), value.strip()
            headers[name] = f"{headers[name]}\n{value}" if name in headers else value
        at = end + 4
        stop = at + int(headers["content-length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record does not end at byte {stop}")
        yield headers, data[at:stop]
        at = stop + 4


CAPTURES = ("response", "revisit", "resource", "conversion")     # record types that hold a capture
_RECORD = ("record_id string, type string, concurrent_to array<string>, refers_to string, uri string, date string, "
           "digest string, page long, payload_bytes long, http string, fields string, payload binary")
_ARROW = {"string": pa.string(), "array<string>": pa.list_(pa.string()), "long": pa.int64(), "binary": pa.binary()}


def _number_after(name: str, text: str) -> int | None:
    """The number that a line ``name: number`` gives, if there is one."""
    found = re.search(rf"^{name}:\s*(\d+)\s*$", text, re.IGNORECASE | re.MULTILINE)
    return int(found[1]) if found else None


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; responses and other records with content carry the
    payload and its digest anew, metadata records their fields."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64
        import hashlib
        schema = pa.schema([(n, _ARROW[t]) for n, t in (x.split() for x in _RECORD.split(", "))])
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for h, block in parse(gzip.decompress(content.as_buffer())):
                    kind, http, payload, size, page, fields = h["warc-type"], None, None, None, None, None
                    digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    if kind in ("request", "response", "revisit"):
                        head, _, body = block.partition(b"\r\n\r\n")
                        http = head.decode("utf-8", "replace")
                    if kind in ("response", "resource", "conversion"):
                        payload = body if kind == "response" else block
                        size = len(payload)
                        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if digest not in (None, found):
                            raise ValueError(f"payload of {h['warc-record-id']} does not match its digest")
                        digest = found
                    elif kind == "revisit":
                        size = _number_after("content-length", http)
                    elif kind == "metadata":
                        fields = block.decode("utf-8", "replace")
                        page = _number_after("page-id", fields)
                    named = h.get("warc-concurrent-to")
                    rows.append((h["warc-record-id"], kind, named.split("\n") if named else None, h.get("warc-refers-to"),
                                 h.get("warc-target-uri"), h.get("warc-date"), digest, page, size, http, fields, payload))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
            .select("content").mapInArrow(read, _RECORD))


def assemble(found: DataFrame) -> DataFrame:
    """One nested row per capture: its response (or revisit, resource,
    conversion), its requests and its metadata records, brought together by the
    identifiers that either side is concurrent to.  ``requests`` and
    ``metadata_records`` hold all of them, equal ones once, in order of their
    ids; ``request`` and ``metadata`` are the first.  A record that names several
    captures is part of each.  A capture without request or metadata has null
    and empty arrays there.  Requests and metadata whose capture is not in
    ``found`` make a row with a null ``response`` under the identifier they
    name, or under their own if they name none.  Records that describe an
    archive and no capture (``warcinfo``) and continuations are left out.  A
    group holds the few records of one capture; columns of ``found`` that were
    dropped (payload) are left out."""
    keep = [c for c in ("record_id", "type", "refers_to", "uri", "date", "digest", "payload_bytes", "http", "payload")
            if c in found.columns]
    rest = ["record_id", "http", common.id_of("page").alias("page_id"), "fields"]
    captures = found.filter(F.col("type").isin(*CAPTURES))
    named = (captures.select(F.col("record_id").alias("_capture"), F.explode("concurrent_to").alias("_named"))
             .groupBy("_named").agg(F.collect_set("_capture").alias("_captures")))
    parts = (found.filter(F.col("type").isin("request", "metadata"))
             .join(named, F.col("record_id") == F.col("_named"), "left"))
    none = F.array().cast("array<string>")
    linked = F.array_distinct(F.concat(F.coalesce("concurrent_to", none), F.coalesce("_captures", none)))
    linked = F.when(F.size(linked) > 0, linked).otherwise(F.array("record_id"))
    main = captures.select(F.col("record_id").alias("capture"), F.struct(*keep).alias("_main"),
                           F.lit(None).cast("string").alias("_type"),
                           F.lit(None).cast("struct<record_id:string,http:string,page_id:long,fields:string>").alias("_part"))
    parts = parts.select(F.explode(linked).alias("capture"), F.lit(None).cast(main.schema["_main"].dataType).alias("_main"),
                         F.col("type").alias("_type"), F.struct(*rest).alias("_part"))
    all_of = lambda kind: F.array_sort(F.collect_set(F.when(F.col("_type") == kind, F.col("_part"))))
    nested = (main.unionByName(parts).groupBy("capture")
              .agg(F.max("_main").alias("response"), all_of("request").alias("_r"), all_of("metadata").alias("_m")))
    requests = F.transform("_r", lambda x: F.struct(x["record_id"].alias("record_id"), x["http"].alias("http")))
    metadata = F.transform("_m", lambda x: F.struct(x["record_id"].alias("record_id"), x["page_id"].alias("page_id"),
                                                    x["fields"].alias("fields")))
    return (nested.select("capture", "response", requests.alias("requests"), metadata.alias("metadata_records"))
            .withColumn("request", F.get("requests", F.lit(0))).withColumn("metadata", F.get("metadata_records", F.lit(0))))


def resolve(captures: DataFrame) -> DataFrame:
    """Append ``refers_to``: the page of the response a revisit refers to."""
    targets = captures.select(F.col("capture").alias("_target"), F.col("metadata.page_id").alias("refers_to"))
    return captures.join(targets, F.col("response.refers_to") == F.col("_target"), "left").drop("_target")
