import base64
import gzip
import hashlib

import pytest

from unitcast.llm import common, warc

SCHEMA = "page_id long, url string, html string, capture string, type int"


def b32(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def round_trip(spark, pages, **kw):
    path = common.scratch(spark, "warc")
    warc.write_archives(pages, path, **kw)
    return path, warc.resolve(warc.assemble(warc.read_records(spark, path)))


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "http://a.example/x?y=%20z", "<p>one</p>"), (2, None, None), (3, "", ""), (4, "http://b.example", "<p>one</p>"),
            (5, "no scheme \r\nWARC/1.1", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (None, "http://c.example/", "null id"),
            (6, "http://d.example/", "é\U0001f600" * 50_000), (7, "http://e.example/", "<p>one</p>"), (7, "http://e.example/", "<p>one</p>"),
            (8, "http://f.example/", "v1"), (8, "http://f.example/", "v2"), (9, "http://g.example/", "null id")]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)


def test_odd_pages(spark, pages):
    _, captures = round_trip(spark, pages)
    got = sorted((r.metadata.page_id, r.response.payload_bytes, r.response.digest, r.response.type, r.refers_to)
                 for r in captures.collect() if r.metadata.page_id is not None)
    one, n = "<p>one</p>", b32("null id")
    hostile = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"
    exp = sorted([(1, 10, b32(one), "revisit", 7), (2, 0, b32(""), "revisit", 3), (3, 0, b32(""), "response", None),
                  (4, 10, b32(one), "revisit", 7), (5, len(hostile), b32(hostile), "response", None),
                  (6, 300_000, b32("é\U0001f600" * 50_000), "response", None), (7, 10, b32(one), "response", None),
                  (8, 2, b32("v1"), "response", None), (8, 2, b32("v2"), "response", None)], key=str)
    nine = [g for g in got if g[0] == 9]
    assert sorted([g for g in got if g[0] != 9], key=str) == exp
    assert nine == [(9, 7, n, "revisit", None)]              # its response is the page without id, which is last
    null = [r for r in captures.collect() if r.metadata.page_id is None]
    assert len(null) == 1 and null[0].response.type == "response"


def test_nested_row_and_payload(spark, pages):
    _, captures = round_trip(spark, pages)
    r = captures.filter("metadata.page_id = 1").first()
    assert r.response.uri == "http://a.example/x?y=%20z" and r.response.payload is None
    assert r.request.http.startswith("GET /x?y=%20z HTTP/1.1\r\nHost: a.example")
    assert r.response.http.startswith("HTTP/1.1 200 OK")
    assert captures.filter("metadata.page_id = 5").first().response.payload.startswith(b"a\r\n\r\nWARC")


def test_small_payloads_do_not_revisit(spark, pages):
    _, captures = round_trip(spark, pages, min_bytes=8)
    kinds = {r.metadata.page_id: r.response.type for r in captures.filter("metadata.page_id in (2, 3, 1, 4, 7)").collect()}
    assert kinds == {1: "revisit", 2: "response", 3: "response", 4: "revisit", 7: "response"}


def test_archives_are_bounded_and_well_formed(spark, pages):
    path, _ = round_trip(spark, pages, archive_bytes=4096)
    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("content").collect()
    kinds = [h["warc-type"] for f in files for h, _ in warc.parse(gzip.decompress(bytes(f.content)))]
    assert len(files) > 3 and sorted(set(kinds)) == ["metadata", "request", "response", "revisit"]
    assert kinds.count("metadata") == 12


def test_empty_table(spark):
    _, captures = round_trip(spark, spark.createDataFrame([], SCHEMA))
    assert captures.count() == 0


def test_damaged_archive():
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabcdef\r\n\r\n"))
    with pytest.raises(ValueError):
        list(warc.parse(b"HTTP/1.1 200 OK\r\n\r\n"))


def record(kind, rid, block=b"", **headers):
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {rid}", f"Content-Length: {len(block)}"]
    for name, values in headers.items():
        lines += [f"{name.replace('_', '-')}: {v}" for v in values]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_foreign_archive_loses_no_record(spark):
    """Several requests and metadata records, links from either side, repeated headers, absent responses."""
    ok, get = b"HTTP/1.1 200 OK\r\n\r\n", b"GET / HTTP/1.1\r\n\r\n"
    archive = b"".join([
        record("warcinfo", "<w>", b"software: x\r\n"),
        record("response", "<r1>", ok + b"one", WARC_Concurrent_To=["<q1>", "<m2>"]),
        record("request", "<q1>", get), record("request", "<q2>", get, WARC_Concurrent_To=["<r1>"]),
        record("metadata", "<m1>", b"page-id: 7\r\n", WARC_Concurrent_To=["<r1>", "<r2>"]),
        record("metadata", "<m2>", b"via: y\r\n"), record("metadata", "<m2>", b"via: y\r\n"),
        record("resource", "<r2>", b"plain"), record("response", "<r3>", ok),
        record("revisit", "<r4>", b"HTTP/1.1 304 Not Modified\r\n\r\n", WARC_Refers_To=["<r1>"]),
        record("request", "<q3>", get, WARC_Concurrent_To=["<gone>"]),
        record("metadata", "<m3>", b"a: b\r\n", WARC_Concurrent_To=["<gone>"]), record("metadata", "<m4>", b"alone: 1\r\n")])
    path = common.scratch(spark, "foreign")
    # the sink adds the last line feed
    df = spark.createDataFrame([(archive[:-1].decode(),)], "value string")
    df.coalesce(1).write.option("compression", "gzip").option("lineSep", "\n").text(path)
    found = warc.read_records(spark, path)
    rows = {r.capture: r for r in warc.resolve(warc.assemble(found)).collect()}
    ids = lambda records: [x.record_id for x in records]
    got = {k: (r.response and r.response.type, ids(r.requests), ids(r.metadata_records)) for k, r in rows.items()}
    assert got == {"<r1>": ("response", ["<q1>", "<q2>"], ["<m1>", "<m2>"]), "<r2>": ("resource", [], ["<m1>"]),
                   "<r3>": ("response", [], []), "<r4>": ("revisit", [], []),
                   "<gone>": (None, ["<q3>"], ["<m3>"]), "<m4>": (None, [], ["<m4>"])}
    assert rows["<r1>"].metadata.page_id == 7 and rows["<r4>"].refers_to == 7 and rows["<r3>"].request is None
    assert rows["<r2>"].response.payload == b"plain" and rows["<r4>"].response.payload_bytes is None
    assert rows["<m4>"].metadata.fields == "alone: 1\r\n"
