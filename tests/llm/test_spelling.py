import random
import re
import zlib
from collections import Counter

import pytest

from unitcast.llm import common, spelling
from unitcast.llm.queries import QUERIES


def words_by_hand(rows):
    out = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def groups_by_hand(words):
    """Near words through the words left by dropping one sign (two words that
    leave the same by dropping the same place, or one the other)."""
    left = {}
    for w in words:
        for i in range(len(w)):
            left.setdefault((i, w[:i] + w[i + 1:]), set()).add(w)
    near = {w: set() for w in words}
    for (_, short), group in left.items():
        for w in group:
            near[w] |= group - {w}
            if short in words:
                near[w].add(short)
                near[short].add(w)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (n, len(near[w]), form[w], words[form[w]] if form[w] else None, root)
    return out


def found(df):
    rows = df.collect()
    out = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}
    assert len(out) == len(rows)
    return out


def made_words(seed, n):
    """Words of few syllables, repeated grams, ends and beginnings edited."""
    draw = random.Random(seed)
    parts = ["on", "an", "ti", "tion", "er", "é", "ß", "aa", "st", "x"]
    base = {"".join(draw.choices(parts, k=draw.randint(3, 6))) for _ in range(n)}
    for w in list(base):
        for _ in range(3):
            i, c = draw.randrange(len(w) + 1), draw.choice("onatixé")
            base.add(draw.choice([w[:i] + c + w[i:], w[:i] + w[i + 1:], w[:i] + c + w[i + 1:]]))
    base |= {"a" * k for k in (6, 7, 8, 9)} | {"ab" * k for k in (3, 4, 5)} | {"z" * 300, "z" * 301, "z" * 150 + "y" + "z" * 150}
    return {w: draw.choice([5, 6, 30, 200, 1000, 6000]) for w in sorted(base) if len(w) >= 6}


@pytest.mark.parametrize("frequent, rows", [(100, 60_000), (3, 500), (0, 50)])
def test_equals_brute_force(spark, monkeypatch, frequent, rows):
    monkeypatch.setattr(spelling, "FREQUENT", frequent)
    monkeypatch.setattr(spelling, "ROWS", rows)
    words = made_words(frequent, 500)
    df = common.stored(spark.createDataFrame(list(words.items()), "word string, n long").repartition(5), "words")
    assert found(spelling.spelling_groups(df)) == groups_by_hand(words)


def test_bound_of_shared_grams():
    """Two words one edit apart share all but ``affected`` grams of each, at least two."""
    draw = random.Random(1)
    frequent = {g: 9 for g in ("on", "ono", "onon", "an", "ti", "tio", "^o", "^on", "aa", "aaa", "aaaa", "n$", "^onon")}
    for w in made_words(4, 300):
        grams = spelling.decompose(w, frequent)
        assert len(grams) == len(w) + 1 and len(grams) - spelling.affected(grams) >= spelling.SHARED
        i, c = draw.randrange(len(w) + 1), draw.choice("onat")
        for other in (w[:i] + c + w[i:], w[:i] + w[i + 1:], w[:i] + c + w[i + 1:]):
            both = Counter(g for _, g in grams) & Counter(g for _, g in spelling.decompose(other, frequent))
            assert sum(both.values()) >= len(grams) - spelling.affected(grams)


def test_dictionary_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(spelling, "FREQUENT", 0)
    monkeypatch.setattr(spelling, "DICTIONARY", 200)
    words = made_words(7, 400)
    df = common.stored(spark.createDataFrame(list(words.items()), "word string, n long"), "words")
    assert 0 < len(spelling.frequent_grams(df)) < 200
    assert found(spelling.spelling_groups(df)) == groups_by_hand(words)


def test_hot_list_and_long_chain(spark):
    """Thousands of words on the same lists, and forms that lead on and on."""
    words = {f"commonstart{chr(97 + i // 676)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}common": 5 + i % 7 for i in range(3000)}
    words |= {"lettered"[:8 - k] + "x" * k: 5 ** (k + 1) for k in range(8)}
    df = common.stored(spark.createDataFrame(list(words.items()), "word string, n long"), "words")
    got = found(spelling.spelling_groups(df))
    assert got == groups_by_hand(words)
    assert got["lettered"][4] == "xxxxxxxx"[:7].rjust(8, "l")


def test_words_of_odd_documents(spark, odd_docs, no_docs):
    docs = odd_docs.unionByName(odd_docs).unionByName(odd_docs)
    got = {r["word"]: r["n"] for r in spelling.word_counts(docs).collect()}
    assert got == words_by_hand([(r.doc_id, r.text) for r in docs.collect()])
    assert found(spelling.spelling_groups(common.stored(spelling.word_counts(no_docs), "words"))) == {}


def test_thinned_runs(spark, monkeypatch):
    """Repeated ids, upper-case letters outside ASCII, a deleted letter of two bytes."""
    texts = [(i % 700 if i % 11 else None, "Élan ÉLANS straßen Straßen STRASSEN thetion÷×") for i in range(3000)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["word"]: r["n"] for r in spelling.word_counts(df).collect()}
    assert got == words_by_hand(texts) and len(got) > 4


def test_query(spark, smoke_dir):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet").collect()
    want = groups_by_hand(words_by_hand([(r.doc_id, r.text) for r in docs]))
    assert found(QUERIES["op13_spelling_variants"](spark, smoke_dir)) == want
