import random

import numpy as np
import pytest

from unitcast.llm import langid

ROOTS = {"xa": ["tar", "mok", "lin", "pes", "dov"], "yb": ["ñué", "çai", "óre", "eux", "ille"], "zc": ["schw", "ung", "keit", "ver", "öß"]}


def text(rnd, language, n):
    return " ".join("".join(rnd.choice(ROOTS[language]) for _ in range(rnd.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    """Two hosts of one language each, one of all; one declaration in eight is wrong."""
    rnd, rows = random.Random(5), []
    for i in range(600):
        true = ["xa", "yb", "zc"][i % 3]
        host = {"xa": "a.one.xx", "yb": "b.two.yy", "zc": "mixed.org"}[true] if i % 4 else "mixed.org"
        declared = true if i % 8 else ["yb", "zc", "xa"][i % 3]
        rows.append((i, text(rnd, true, rnd.choice([2, 10, 80])), f"{declared.upper()}-Latn", f"http://{host}/p{i}", true))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, url string, true string").repartition(4)


def run(df, **kw):
    found = langid.identify(df, "doc_id", "text", declared_col="lang", url_col="url", **kw).collect()
    return {(r["_id"], r["_row"]): r for r in found}


def test_held_out_accuracy(corpus):
    """The model sees about 20 rows per language; the other rows are held out."""
    found = {k[0]: r for k, r in run(corpus, sample=20).items()}
    truth = {r.doc_id: r.true for r in corpus.collect()}
    right = np.mean([found[i].language == truth[i] for i in truth])
    assert right > 0.98 and all(r.keep for r in found.values())
    wrong = [i for i in truth if found[i].declared != truth[i]]
    assert np.mean([found[i].language == truth[i] for i in wrong]) > 0.9     # text and host outweigh a wrong declaration


def test_evidence_decides_where_the_text_does_not(spark, corpus):
    rows = [(1000, "", None, "http://a.one.xx/", None), (1001, None, "zc", None, None), (1002, "1", None, "http://new.two.yy/", None)]
    df = corpus.unionByName(spark.createDataFrame(rows, corpus.schema))
    found = {k[0]: r for k, r in run(df).items()}
    assert [found[i].language for i in (1000, 1001, 1002)] == ["xa", "zc", "yb"]    # host, declaration, domain and suffix


def test_gibberish_is_rejected_and_columns_stay(spark, corpus):
    noise = [(2000, "9#@! 83&% ~~ 0x7f {}[] 55;; ||" * 8, None, "http://a.one.xx/", "x")]
    df = corpus.unionByName(spark.createDataFrame(noise, corpus.schema)).selectExpr("*", "1 AS keep", "2 AS _gone_x")
    kept = langid.accepted(df, declared_col="lang", url_col="url")
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == set(range(600))


def test_rare_languages_stay(spark):
    """2 of 2,000 rows (0.1 %) each in another script and in the common one."""
    rnd, rare = random.Random(6), {"el": ["και", "του", "μέν", "ώρα", "σις"], "qz": ["wub", "zog", "kri", "fah", "ujo"]}
    word = lambda roots: "".join(rnd.choice(roots) for _ in range(rnd.randint(1, 3)))
    rows = [(i, text(rnd, x := ["xa", "yb", "zc"][i % 3], rnd.choice([10, 80])), x, "src1") for i in range(1996)]
    rows += [(2000 + 2 * k + j, " ".join(word(roots) for _ in range(60)), x, "src1")
             for k, (x, roots) in enumerate(rare.items()) for j in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    found = {r["_id"]: r for r in langid.identify(df, "doc_id", "text", declared_col="lang", host_col="source").collect()}
    assert [found[i].language for i in range(2000, 2004)] == ["el", "el", "qz", "qz"]
    assert all(found[i].language == x for i, _, x, _ in rows)
    assert langid.accepted(df, declared_col="lang", host_col="source").count() == len(rows)


def test_every_declared_language_is_modelled(spark):
    codes = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    rows = [(i, chr(0x4E00 + 40 * (i % 100)) * 9 + chr(0x4E01 + 40 * (i % 100)) * 9, codes[i % 100]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df.selectExpr("doc_id AS _id", "text AS _text", "lang AS _declared"))
    assert model.languages == [*sorted(codes), langid.UND]
    found = langid.identify(df, "doc_id", "text", declared_col="lang").collect()
    assert all(r.language == r.declared and r.keep for r in found)


def brute_posterior(model, rows, i):
    """Fusion of one row by plain loops; rows: (text, declared, suffix, host, domain)."""
    ll = [model.log_likelihood(r[0]) for r in rows]
    own = [langid.softmax(x) for x in ll]
    n = len(model.languages)
    rest = [sum(own[j][c] for j in range(len(rows)) if j != i) for c in range(n)]
    count = lambda k, c: sum(own[j][c] for j in range(len(rows)) if j != i and rows[j][k] == rows[i][k])
    score = list(ll[i])
    for k in (1, 2):
        if rows[i][k] is not None:
            kinds = len({r[k] for r in rows if r[k] is not None})
            for c in range(n):
                score[c] += np.log((count(k, c) + langid.EVIDENCE_PSEUDO / kinds) / (rest[c] + langid.EVIDENCE_PSEUDO))
    prior = [(rest[c] + 1 / n) / (sum(rest) + 1) for c in range(n)]
    for k in (4, 3):
        if rows[i][k] is not None:
            found = [count(k, c) for c in range(n)]
            prior = [(found[c] + langid.PRIOR_ROWS * prior[c]) / (sum(found) + langid.PRIOR_ROWS) for c in range(n)]
    return langid.softmax(np.array(score) + np.log(prior))


def test_fusion_equals_brute_force(spark, corpus):
    df = corpus.filter("doc_id < 90")
    rows = df.orderBy("doc_id").collect()
    plain = df.selectExpr("doc_id AS _id", "text AS _text", "lower(split(lang, '-')[0]) AS _declared")
    model = langid.train(plain)
    parts = [(r.text, r.lang.split("-")[0].lower(), r.url.split("/")[2].split(".")[-1], r.url.split("/")[2],
              ".".join(r.url.split("/")[2].split(".")[-2:])) for r in rows]
    found = {k[0]: r for k, r in run(df).items()}
    for i in (0, 7, 33, 64, 89):
        p = brute_posterior(model, parts, i)
        assert found[i].language == model.languages[int(p.argmax())]
        assert found[i].confidence == pytest.approx(p.max(), rel=1e-6)


def test_odd_documents(odd_docs, no_docs):
    found = langid.identify(odd_docs, "doc_id", "text", declared_col="lang", host_col="source").collect()
    assert len(found) == 8 and all(r.language is not None for r in found)
    kept = langid.accepted(odd_docs, declared_col="lang", host_col="source")
    assert kept.columns == odd_docs.columns
    assert langid.identify(no_docs, "doc_id", "text", declared_col="lang").count() == 0
    unlabelled = langid.identify(odd_docs, "doc_id", "text").collect()
    assert all(r.language is None and r.keep for r in unlabelled)


def test_pages(spark):
    html = '<!doctype html><HTML dir="x" lang="fr-CA"><script>var x = "<p>no</p>";</script><p>oui</p><!-- non --></html>'
    pages = spark.createDataFrame([(1, "http://x.fr/", html), (2, None, None)], "page_id long, url string, html string")
    one, two = langid.page_rows(pages).orderBy("page_id").collect()
    assert one.declared == "fr-CA" and one.text.split() == ["oui"] and (two.text, two.declared) == ("", "")


def test_pages_query_equals_brute_force(spark, smoke_dir):
    from urllib.parse import urlsplit
    from unitcast.llm.queries import QUERIES
    pages = spark.read.parquet(f"{smoke_dir}/pages.parquet")
    rows = langid.page_rows(pages).orderBy("page_id").collect()
    model = langid.train(langid.page_rows(pages).select(
        langid.common.key_of("page_id").alias("_id"), "text", langid.primary(langid.F.col("declared")).alias("_declared"))
        .withColumnRenamed("text", "_text"))
    parts = []
    for r in rows:
        host = (urlsplit(r.url or "").hostname or "").lower() or None
        labels = host.split(".") if host else []
        deep = len(labels) > 1
        parts.append((r.text, (r.declared or "").split("-")[0].lower() or None, labels[-1] if deep else None, host,
                      ".".join(labels[-2:]) if deep else None))
    got = {r.page_id: r for r in QUERIES["pages_language"](spark, smoke_dir).collect()}
    assert len(got) == len(rows)
    for i in range(0, len(rows), max(1, len(rows) // 12)):
        p = brute_posterior(model, parts, i)
        r = got[rows[i].page_id]
        assert r.language == model.languages[int(p.argmax())] and r.declared == parts[i][1]
        assert r.confidence == pytest.approx(p.max(), rel=1e-6)


def test_many_junk_tags_cost_little(spark, corpus):
    """600 rows of three languages, 400 more rows under tags of their own."""
    rnd = random.Random(9)
    tag = lambda i: "q" + "".join(chr(97 + int(d)) for d in str(i))
    junk = [(5000 + i, text(rnd, "xa", 40), tag(i), "http://a.one.xx/", "xa") for i in range(400)]
    df = corpus.unionByName(spark.createDataFrame(junk, corpus.schema))
    plain = df.selectExpr("doc_id AS _id", "text AS _text", "lower(split(lang, '-')[0]) AS _declared")
    model = langid.train(plain)
    assert len(model.languages) == 404
    assert len(model.gain) < 404 * langid.BUCKETS / 50              # entries that the samples hold, not tags x buckets
    found = {k[0]: r for k, r in run(df).items()}
    assert len(found) == 1000
    truth = {r.doc_id: r.true for r in corpus.collect()}
    assert np.mean([found[i].language == truth[i] for i in truth if truth[i] != "xa"]) > 0.95
    c, ll, own = langid.likely(model, text(rnd, "yb", 200))
    assert len(c) < 20 and abs(own.sum() - 1) < 1e-12 and "yb" in [model.languages[i] for i in c]


def test_model_equals_counting(spark, corpus):
    """Sparse entries against probabilities by a plain table."""
    plain = corpus.selectExpr("doc_id AS _id", "text AS _text", "lower(split(lang, '-')[0]) AS _declared")
    model = langid.train(plain)
    counts = np.full((3, langid.BUCKETS), langid.PSEUDO)
    for r in plain.collect():
        np.add.at(counts[model.languages.index(r._declared)], langid.trigrams(r._text), 1)
    log_p = np.log(counts / counts.sum(axis=1, keepdims=True))
    for sample in ("tarmok linpes", "ñuéçai schwung", "0", ""):
        at = langid.trigrams(sample)
        scale = min(langid.OVERLAP * len(at), langid.MOST_EVIDENCE) / max(1, len(at))
        expected = [*(log_p[:, at].sum(axis=1) * scale), -np.log(langid.BUCKETS) * len(at) * scale]
        assert model.log_likelihood(sample) == pytest.approx(expected, rel=1e-9)
