import random
import zlib

import pytest
from pyspark.sql import functions as F

from unitcast.llm import toxicity
from unitcast.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0


def made(n, seed=3):
    """Labelled texts; the toxic ones hold an insult, a third of them inflected."""
    draw = random.Random(seed)
    plain = ["the", "house", "river", "garden", "you", "walk", "green", "stone", "light", "bread", "water", "paper"]
    docs, labels = [], []
    for i in range(n):
        words = draw.choices(plain, k=draw.randint(5, 60))
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(draw.randint(1, 3)):
                words[draw.randrange(len(words))] = draw.choice(["grobian", "wretchling", "snivelknave" + draw.choice(["", "s", "ish"])])
        docs.append((i, " ".join(words), "en", "src0", None))
        labels.append((i, 1, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = made(1200)
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame(labels, LABELS)


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.fit(*tables)


def test_held_out_accuracy(model, tables):
    docs, labels = tables
    rows = toxicity.score(model, docs).join(labels, "doc_id").collect()
    assert len(rows) == 1200
    for r in rows:
        assert r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    out = [r for r in rows if r.held_out]
    assert len(out) > 150 and sum(r.predicted == r.toxic for r in out) >= 0.98 * len(out)


def test_only_training_labels_and_texts_matter(spark, model, tables):
    """Other held-out labels, languages and sources change no score."""
    docs, labels = tables
    other = labels.withColumn("toxic", F.when(toxicity.fold_of("doc_id") == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    before = {r.doc_id: r.score for r in toxicity.score(model, docs).collect()}
    changed = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("z"))
    after = {r.doc_id: r.score for r in toxicity.score(toxicity.fit(changed, other), changed).collect()}
    assert after == pytest.approx(before, abs=1e-9)


def test_features():
    lexicon = toxicity.Lexicon({"stupid": 5.0, "foll*": 2.5, "meh": 1.2})
    f = dict(zip(toxicity.FEATURES, toxicity.features("You STUPID folly! meh, five more words st*pid stuuupid 5tupid x", lexicon)))
    words = len("you stupid folly meh five more words st pid stuuupid tupid x".split())
    assert f["strong"] == f["medium"] == f["mild"] == pytest.approx(100 / words)
    assert f["distinct"] == 3 and f["heaviest"] == 5.0 and f["near_second_person"] == pytest.approx(300 / words)
    assert f["shouted"] == pytest.approx(100 / words) and f["exclamations"] == pytest.approx(100 / words)
    assert f["stretched"] == pytest.approx(100 / words) and f["mixed_words"] == pytest.approx(200 / words) and f["hidden"] == 2
    far = toxicity.features("you " + "word " * 6 + "stupid", lexicon)
    assert far[toxicity.FEATURES.index("near_second_person")] == 0
    assert toxicity.features("", lexicon) == [0.0] * len(toxicity.FEATURES)


def test_lexicon_leaves_out_the_own_fold(spark):
    def own(f):
        return "word" + "abcd"[f - 1] + "x"

    rows = [(f"{own(f)} shared", f, 1) for f in range(1, 5) for _ in range(3)] + [(f"clean{i}", 1 + i % 4, 0) for i in range(40)]
    whole, *apart = toxicity.lexicons(spark.createDataFrame(rows, "_text string, _fold int, _label int"))
    assert {"shared", "word*"} <= whole.keys()
    for f, weights in enumerate(apart, 1):
        assert "shared" in weights and own(f) not in weights and own(f) in whole and "clean" not in weights


def test_odd_documents(spark, odd_docs, model):
    df = odd_docs.withColumn("score", F.lit("clash")).withColumn("predicted", F.lit("clash")).withColumn("_x", F.lit(1))
    rows = toxicity.score(model, df).collect()
    assert len(rows) == 8 and all(0 <= r.score <= 1 and r.held_out == held(r.doc_id) and r.ids == "y" for r in rows)
    empty = {r.score for r in rows if r.doc_id in (2, 3)}
    assert len(empty) == 1


def test_labels_with_nulls_repeats_and_one_class(spark, odd_docs, no_docs, tables):
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (2, None, None), (None, 1, 1), (3, 1, 0), (99, 1, 1)], LABELS)
    model = toxicity.fit(odd_docs, labels)
    trained = [i for i in (1, 3) if not held(i)]
    assert model.calibration is None and model.share == pytest.approx((1 in trained) / max(1, len(trained)))
    assert toxicity.score(model, odd_docs).count() == 8
    for docs, known in ((no_docs, tables[1]), (odd_docs, spark.createDataFrame([], LABELS)), (no_docs, spark.createDataFrame([], LABELS))):
        none = toxicity.fit(docs, known)
        assert none.share == 0.0 and toxicity.score(none, docs).filter("score != 0").count() == 0


def test_sample_is_bounded_and_copies_count_once(spark, monkeypatch, tables):
    docs, labels = tables
    monkeypatch.setattr(toxicity, "SAMPLE", 100)
    texts = toxicity.training_texts(docs.unionByName(docs).unionByName(docs), labels, "doc_id", "text", "toxic").collect()
    assert len(texts) == len({r._text for r in texts}) == 100 and {r._fold for r in texts} <= {1, 2, 3, 4}


def test_query(spark, smoke_dir):
    rows = QUERIES["op12_toxicity"](spark, smoke_dir)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = rows.collect()
    assert len(rows) == spark.read.parquet(f"{smoke_dir}/documents.parquet").count()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in rows)
