import random
import re

from unitcast.llm import decontaminate as dc


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def runs(w, k):
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(docs, items):
    out = set()
    for item, text in items:
        w = words(text)
        if not w:
            continue
        k = min(5, len(w))
        own = runs(w, k)
        for doc, body in docs:
            m = len(own & runs(words(body), k))
            if m >= 0.8 * len(own) - 1e-9:
                out.add((doc, item, m, len(own)))
    return out


def found(docs, items):
    return {(r.doc_id, r.item_id, r.matched, r.n_shingles) for r in dc.find_leaks(docs, items).collect()}


def test_equals_brute_force(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(3))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([1, 2, 4, 5, 6, 9, 14, 15, 16, 30, 59, 120])]
    docs = []
    for d in range(60):
        body = [word() for _ in range(rnd.choice([0, 10, 300, 2000]))]
        for _ in range(rnd.choice([0, 1, 2])):
            w = rnd.choice(items)[1].split()
            for _ in range(rnd.choice([0, 0, 1, 2])):
                w[rnd.randrange(len(w))] = word()
            at = rnd.randint(0, len(body))
            body[at:at] = [w[0].upper() + ","] + w[1:]
        docs.append((d, rnd.choice([" ", "\n", " - "]).join(body)))
    got = found(spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
                spark.createDataFrame(items, "item_id long, text string"))
    exp = brute(docs, items)
    assert got == exp and len(exp) > 30


def test_odd_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "?!"), (4, "A line, of TEXT!"), (4, "A line, of TEXT!"), (None, "other words")],
                                  "item_id long, text string").selectExpr("*", "'x' AS _h", "1 AS matched")
    leaks = dc.find_leaks(odd_docs, items)
    got = {(r.doc_id, r.item_id) for r in leaks.collect()}
    assert got == {(1, 4), (5, 4), (None, 4), (5, None)} and leaks.count() == 4
    kept = dc.without_leaks(odd_docs, leaks)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 6] and kept.columns == odd_docs.columns
    assert dc.find_leaks(no_docs, items).count() == 0
    assert dc.find_leaks(odd_docs, items.limit(0)).count() == 0


def test_shuffle_joins_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"p q r s t u v w {i}") for i in range(20)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "p q r s t u v w")], "item_id long, text string")
    small = found(docs, items)
    monkeypatch.setattr(dc.checked, "__defaults__", (0,))
    assert found(docs, items) == small and len(small) == 20


def test_main_path_has_no_python(spark, odd_docs):
    items = spark.createDataFrame([(4, "A line of TEXT")], "item_id long, text string")
    plan = dc.find_leaks(odd_docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
