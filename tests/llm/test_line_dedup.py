import hashlib

from pyspark.sql import functions as F

from unitcast.llm import line_dedup


def brute(docs):
    """docs: {id: text}; -> {id: (n_lines, n_dropped, kept)}."""
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").encode().lower()
    first = {}
    for i in sorted(docs):
        for x in docs[i].split("\n"):
            if len(x.strip(" \t\n\x0b\x0c\r")) >= 10:
                first.setdefault(key(x), i)
    out = {}
    for i, t in docs.items():
        lines = t.split("\n")
        kept = [x for x in lines if first.get(key(x), i) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def as_rows(df):
    return {r.doc_id: (r._kept.n_lines, r._kept.n_dropped, r._kept.kept) for r in df.collect()}


def test_odd_documents(odd_docs):
    got = as_rows(line_dedup.dedup_lines(odd_docs))
    texts = {(1 << 63) - 1 if r.doc_id is None else r.doc_id: r.text or "" for r in odd_docs.collect()}
    exp = brute(texts)
    exp[None] = exp.pop((1 << 63) - 1)
    assert got == exp
    assert got[1][1] == 0 and got[5][1] == 1 and got[None] == (1, 1, "")    # first holder keeps its own repeats
    assert line_dedup.dedup_lines(odd_docs).count() == odd_docs.count()


def test_many_texts_of_null_and_repeated_ids(spark):
    """Lists of lines to drop are as long as a text, not as all texts of an id."""
    line = lambda i, k: f"passage number {i} {k}"
    rows = [(i, "\n".join(line(i, k) for k in range(4))) for i in range(40)]
    for i in (None, 40):
        rows += [(i, "\n".join([*(line(j, k) for k in range(4)), f"a line of {i}", f"own line {i} {j}"])) for j in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {(r.doc_id, r.text): r._kept for r in line_dedup.dedup_lines(df).collect()}
    assert len(got) == len(rows)
    for i, t in rows[40:]:
        assert got[i, t].n_dropped == 4 and got[i, t].kept.split("\n") == t.split("\n")[4:]
    assert all(got[i, t].kept == t for i, t in rows[:40])
    keyed = df.selectExpr(f"coalesce(doc_id, {(1 << 63) - 1}L) AS _id", "text AS _text", "xxhash64(text) AS _text_hash")
    longest = line_dedup.line_drops(keyed).agg(F.max(F.size("_drop"))).first()[0]
    assert longest == 2 * 4


def test_empty_table(no_docs):
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_any_batches_and_fanout_agree(spark):
    rows = [(i, "\n".join(f"shared passage {k}" if (i * 7 + k) % 5 else f"own passage {i} {k}" for k in range(i % 9))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    exp = brute(dict(rows))
    for batches, fanout in ((1, 2), (5, 2), (7, 3)):
        assert as_rows(line_dedup.dedup_lines(df, batches=batches, fanout=fanout)) == exp


def test_runs_are_compacted_into_levels(spark):
    runs = line_dedup.LineRuns(spark, fanout=2, buckets=2)
    for batch in range(5):
        lines = spark.range(batch * 10, batch * 10 + 15).selectExpr(f"{batch}L AS _id", "id AS k1", "id AS k2")
        drops = runs.add(lines)
        assert drops.count() == (5 if batch else 0)      # five hashes of the batch before
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    seen = runs.spark.table(runs.runs[0]).unionByName(runs.spark.table(runs.runs[1]))
    assert seen.count() == seen.distinct().count() == 55
    runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_ascii_case_and_white_space_only(spark):
    rows = [(1, "Straße und Öl\n\x85 next line x"), (2, " straße UND Öl\t\n\x85 next line x"), (3, "straße und öl\n next line x")]
    got = as_rows(line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [got[i][1] for i in (1, 2, 3)] == [0, 2, 0]   # only A-Z folds; \x85 is no white space here


def test_digest_column(spark):
    out = line_dedup.dedup_lines(spark.createDataFrame([(1, "x")], "doc_id long, text string"))
    got = out.select(F.sha2(F.col("_kept.kept").cast("binary"), 256).alias("h")).first().h
    assert got == hashlib.sha256(b"x").hexdigest()
