import itertools
import random
import re

import numpy as np
import pytest

from unitcast.llm import common, near_duplicates as nd
from unitcast.llm.components import components


def shingles(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows, threshold=0.8):
    """rows: (id, text) -> {id: (class, text_id, n_links)}"""
    first = {}
    for i, t in sorted(rows):
        first.setdefault(t, i)
    sets = {i: shingles(t) for t, i in first.items()}
    links, root = {i: set() for i in sets}, {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and both >= threshold * len(sets[a] | sets[b]) - 1e-9:
            links[a].add(b)
            links[b].add(a)
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (find(first[t]), first[t], len(links[first[t]])) for i, t in rows}


def corpus():
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    rows = []
    for _ in range(12):
        base = [word() for _ in range(rnd.choice([3, 8, 60, 200]))]
        for _ in range(rnd.choice([1, 3, 9])):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 6])):
                w[rnd.randrange(len(w))] = word()
            rows.append((len(rows), " ".join(w) + rnd.choice(["", ".", "\n"])))
    rows += [(len(rows) + k, rows[5][1]) for k in range(4)]
    return rows


def result(df):
    return {r.doc_id: (r.class_id, r.text_id, r.n_links) for r in nd.near_duplicates(df).collect()}


def test_equals_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    exp = brute(rows)
    assert result(df) == exp and any(e[2] for e in exp.values())
    kept = sorted(r.doc_id for r in nd.one_per_class(df).collect())
    assert kept == sorted({e[0] for e in exp.values()})


def test_large_group_of_near_copies_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 8)
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(base[:i % 90] + [f"x{i}"] + base[i % 90 + 1:])) for i in range(60)]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_five_thousand_near_copies(spark):
    """Links counted exactly where no task could hold a quadratic number of rows."""
    base = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(base[:i % 77] + [f"x{i}"] + base[i % 77 + 1:])) for i in range(5000)]
    # a copy lacks the base's shingles over its place and has as many of its own
    lacks = [{k for k in range(76) if k <= p <= k + 4} for p in range(77)]
    held = [len(range(p, 5000, 77)) for p in range(77)]
    linked = [sum(held[q] for q in range(77) if (both := 76 - len(lacks[p] | lacks[q])) >= 0.8 * (152 - both) - 1e-9) - 1 for p in range(77)]
    got = result(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    assert len(set(linked)) > 5
    assert {i: g[2] for i, g in got.items()} == {i: linked[i % 77] for i in range(5000)}
    assert {g[0] for g in got.values()} == {0}


def test_rows_of_a_large_group_grow_in_proportion(spark):
    """At most SPLIT blocks, so at most SPLIT + 1 rows per node."""
    buckets = spark.range(20_000).selectExpr("unhex(lpad(hex(id), 32, '0')) AS _node", "7L AS _key", "unhex(lpad('0', 32, '0')) AS _least")
    sizes = [r["count"] for r in nd._blocks(buckets).groupBy("_block").count().collect()]
    assert len(sizes) == -(-20_000 // nd.LARGEST) and max(sizes) < 2 * nd.LARGEST
    few = [r["count"] for r in nd._blocks(buckets.limit(10_000)).groupBy("_block").count().collect()]
    assert len(few) == nd.SPLIT


def test_sets_and_links_by_hand(monkeypatch):
    monkeypatch.setattr(nd, "SEGMENT", 7)
    rnd = np.random.default_rng(9)
    sets = [np.unique(rnd.integers(0, 40, rnd.integers(1, 30))) for _ in range(60)]
    exact, plain = nd.Sets(sets), [set(s.tolist()) for s in sets]
    for x in range(60):
        want = [1 - len(plain[x] & p) / len(plain[x] | p) for p in plain]
        assert exact.distances(x).tolist() == pytest.approx(want)
        assert exact.similar(x, np.arange(60), 0.3).tolist() == [w <= 0.7 + 1e-9 for w in want]
    keys, marks = np.ones((60, 1), dtype=np.int64), np.ones((60, nd.CHECKS), dtype=np.uint16)
    pairs = {(a, b) for a in range(60) for b in range(a + 1, 60) if len(plain[a] & plain[b]) >= 0.3 * len(plain[a] | plain[b]) - 1e-9}
    found = nd.link_all(np.arange(60), np.arange(60), True, keys, marks, exact, 0.3, 1e-8)
    assert found.counts.tolist() == [sum(x in p for p in pairs) for x in range(60)]
    half = nd.link_all(np.arange(0, 60, 2), np.arange(1, 60, 2), False, keys, marks, exact, 0.3, 1e-8)
    assert half.counts.sum() == 2 * sum((a + b) % 2 for a, b in pairs)


@pytest.mark.parametrize("most", [0, 10])
def test_repeated_rows_are_one_row_of_their_node(spark, monkeypatch, most):
    """Rows of equal id and text, null ids among them, by broadcast and by shuffle."""
    seen, linked = {}, nd._linked
    monkeypatch.setattr(nd, "MAX_BROADCAST_ROWS", most)
    monkeypatch.setattr(nd, "_linked", lambda bands, first, *a: seen.update(bands=bands, first=first) or linked(bands, first, *a))
    rows = corpus()
    again = [rows[3]] * 50 + [rows[20]] + [(None, rows[8][1] + " more")] * 50 + [(-1, rows[30][1])] * 20
    df = spark.createDataFrame(rows + again, "doc_id long, text string").repartition(5)
    exp = brute([(common.LAST_ID if i is None else i, t) for i, t in rows + again])
    exp[None] = [None if x == common.LAST_ID else x for x in exp[common.LAST_ID][:2]] + [exp.pop(common.LAST_ID)[2]]
    exp[None] = tuple(exp[None])
    assert result(df) == exp
    texts = {t for _, t in rows + again}
    assert seen["first"].count() == len(texts)
    assert seen["bands"].count() == nd.BANDS * len(texts)
    assert nd.one_per_class(df).count() == len({e[0] for e in exp.values()})


def test_odd_documents(odd_docs):
    got = nd.near_duplicates(odd_docs).collect()
    rows = {(r.doc_id if r.doc_id is not None else common.LAST_ID, r.text or "") for r in odd_docs.collect()}
    exp = brute(sorted(rows))
    exp[common.LAST_ID] = (None, None, *exp[common.LAST_ID][2:])
    assert {(r.doc_id if r.doc_id is not None else common.LAST_ID): (r.class_id, r.text_id, r.n_links) for r in got} == exp
    kept = nd.one_per_class(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, 1), (False, 2), (False, 4), (False, 5), (False, 6), (True, None)]


def test_one_id_with_two_texts_is_one_class(spark):
    df = spark.createDataFrame([(1, "a b c d e f g"), (1, "p q r s t u v"), (2, "p q r s t u v")], "doc_id long, text string")
    assert {r.class_id for r in nd.near_duplicates(df).collect()} == {1}
    assert nd.one_per_class(df).count() == 1


def test_empty_table(no_docs):
    assert nd.near_duplicates(no_docs).count() == 0 and nd.one_per_class(no_docs).count() == 0


def test_posterior_bound():
    for n in (16, 64, 128):
        m = nd.fewest_matches(n, 0.8, 1e-8)
        assert 0 < m < 0.8 * n and nd.fewest_matches(n, 0.8, 1e-2) > m
    assert nd.fewest_matches(16, 0.8, 0.0) == 0


def test_min_hash_share_estimates_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(-1 << 62, 1 << 62, 3000)
    a, b = pool[:2000], pool[500:2500]
    values = nd.min_hashes(np.concatenate([a, b]), np.array([2000, 2000]), slice(None))
    assert abs(np.mean(values[0] == values[1]) - 0.6) < 0.06
    whole = nd.min_hashes(a, np.array([2000]), slice(0, 8))
    assert (whole[0] == values[0, :8]).all()


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(5, 5), (1, 2), (2, 1)], [(i, i + 1) for i in range(40)],
                                   [(0, i) for i in range(1, 30)] + [(100, 101), (101, 99)], [(i, (i * 7) % 31) for i in range(31)]])
def test_components(spark, edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "u long, v long")
    assert {r.vertex: r.component for r in components(df).collect()} == {x: find(x) for x in list(root)}


def test_components_with_hubs(spark, monkeypatch):
    """Two stars of which one is met by broadcast, joined by a chain, and a component apart."""
    from unitcast.llm import components as module
    monkeypatch.setattr(module, "HUB_EDGES", 8)
    edges = [(500, i) for i in range(1, 60)] + [(900, i) for i in range(600, 640)] + [(60, 700), (700, 639), (59, 60)]
    edges += [(2000, 2001), (2001, 2002)]
    found = {r.vertex: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{v: 1 for e in edges[:-2] for v in e}, 2000: 2000, 2001: 2000, 2002: 2000}


def test_equal_block_sets_are_paired_once(spark, monkeypatch):
    """300 buckets over the same 16 blocks: the pairs of all buckets, found from one set of blocks."""
    rows = [(k, b) for k in range(300) for b in range(16)] + [(900, 3), (900, 40), (901, 50)]
    held = spark.createDataFrame(rows, "_key long, _block long")
    stored, keep = {}, nd.common.stored
    monkeypatch.setattr(nd.common, "stored", lambda df, name: stored.setdefault(name, keep(df, name)))
    got = {(r._lo, r._hi) for r in nd.block_pairs(held).collect()}
    assert got == {(a, b) for a in range(16) for b in range(a, 16)} | {(3, 3), (3, 40), (40, 40), (50, 50)}
    assert stored["block-sets"].count() == 3


def test_nodes_go_only_where_they_have_candidates(spark):
    """Ten nodes in each of four blocks; node 0 of every block shares a bucket with all the others,
    nodes 1 and 2 of a block share one, the rest lie in buckets of their own: no block meets another whole."""
    node = {(b, i): bytes([b, i]) for b in range(4) for i in range(10)}
    rows = [(node[b, 0], 1) for b in range(4)] + [(node[b, i], 10 + b) for b in range(4) for i in (1, 2)]
    rows += [(n, 100 + k) for k, n in enumerate(node.values())]
    buckets = spark.createDataFrame(rows, "_node binary, _key long")
    blocks = spark.createDataFrame([(n, b) for (b, _), n in node.items()], "_node binary, _block long")
    got = sorted((bytes(r._node), r._block, r._lo, r._hi) for r in nd.dealt(buckets, blocks).collect())
    across = [(node[b, 0], b, *sorted((b, c))) for b in range(4) for c in range(4) if b != c]
    within = [(node[b, i], b, b, b) for b in range(4) for i in (1, 2)]
    assert got == sorted(across + within)


def test_dealing_loses_no_candidate_pair(spark):
    rnd = random.Random(5)
    held = {(bytes([n]), rnd.randrange(40)) for n in range(120) for _ in range(3)}
    block = {bytes([n]): rnd.randrange(6) for n in range(120)}
    buckets = spark.createDataFrame(sorted(held), "_node binary, _key long")
    blocks = spark.createDataFrame(sorted(block.items()), "_node binary, _block long")
    rows = [(bytes(r._node), r._lo, r._hi) for r in nd.dealt(buckets, blocks).collect()]
    assert len(set(rows)) == len(rows)
    for (a, k), (b, m) in itertools.combinations(sorted(held), 2):
        if k == m:
            pair = tuple(sorted((block[a], block[b])))
            assert (a, *pair) in rows and (b, *pair) in rows
    keyed = buckets.join(blocks, "_node").select("_key", "_block").distinct()
    assert {r[1:] for r in rows} <= {tuple(r) for r in nd.block_pairs(keyed).collect()}
