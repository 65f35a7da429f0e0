import hashlib

import numpy as np
from pyspark.sql import functions as F

from unitcast.llm import fim
from unitcast.llm.queries import QUERIES


def by_hand(key, text, unit_of=list):
    """The contract, over a list of units."""
    units = unit_of(text)
    h = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    x, y = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    p, m, s = ("".join(units[a:b]) for a, b in ((0, x), (x, y), (y, None)))
    spm = h4 % 100 < 20
    return len(units), "spm" if spm else "psm", x, y - x, f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def run(df, **options):
    out = fim.transform(df, **options)
    return out.withColumn("_back", fim.restored(F.col("output"), F.col("form"))).collect()


def test_rank_equals_counting():
    rng = np.random.default_rng(5)
    for n in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 6, n).astype(np.uint8)
        matrix, at = fim.WaveletMatrix(symbols), np.arange(n + 1)
        for c in range(8):
            assert matrix.rank(c, at).tolist() == [int((symbols[:i] == c).sum()) for i in at]


def test_odd_documents(odd_docs):
    rows = run(odd_docs.withColumn("form", F.lit("clash")).withColumn("n", F.lit("clash")))
    assert len(rows) == 8
    for r in rows:
        want = by_hand("" if r.doc_id is None else r.doc_id, r.text or "")
        assert (r.n, r.form, r.prefix_units, r.middle_units, r.output) == want
        assert r._back == (r.text or "") and r.ids == "y"


def test_empty_table(no_docs):
    assert run(no_docs) == []


def test_markers_and_their_pieces(spark):
    pieces = ["<", "P", "S", "M", ">", "<S", "<M", "a", "é", "\U0001f600", "\n", "<P>", ""]
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(pieces, rng.integers(0, 12))) for _ in range(2000)]
    rows = run(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        assert (r.n, r.form, r.prefix_units, r.middle_units, r.output) == by_hand(r.doc_id, texts[r.doc_id])
        assert r._back == texts[r.doc_id]


def _words(text):
    """Words with what follows them; what stands before the first belongs to no word's unit but to the prefix."""
    out, inside = [], False
    for c in text:
        word = c.isalnum() or ord(c) > 127
        if word and not inside:
            out.append("")
        if out:
            out[-1] += c
        inside = word
    return out


def test_cuts_at_words_and_lines(spark):
    texts = ["one two  three, four", "über-all the\nplace été", "x", "a\nb\n\nc", "no end\n", "one two\nthree"] * 40
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in run(df, unit="word"):
        assert (r.n, r.form, r.prefix_units, r.middle_units, r.output) == by_hand(r.doc_id, texts[r.doc_id], _words)
    for r in run(df, unit="line"):
        want = by_hand(r.doc_id, texts[r.doc_id], lambda t: t.splitlines(keepends=True))
        assert (r.n, r.form, r.prefix_units, r.middle_units, r.output) == want


def test_blocks_of_any_size_cut_alike(odd_docs, monkeypatch):
    before = sorted((str(r.doc_id), r.output) for r in run(odd_docs))
    monkeypatch.setattr(fim, "BLOCK_BYTES", 1)
    offsets = np.array([0, 5, 5, 9, 400])
    assert [b - a for a, b in fim._blocks(offsets)] == [1, 1, 1, 1]
    assert sorted((str(r.doc_id), r.output) for r in run(odd_docs)) == before


def test_query(spark, smoke_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{smoke_dir}/documents.parquet").collect()}
    rows = QUERIES["op11_fill_in_middle"](spark, smoke_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, form, x, m, output = by_hand(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, x, m)
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
