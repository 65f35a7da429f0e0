import math
import zlib

import pytest
import xxhash

from unitcast.llm import sharding


def test_odd_documents(odd_docs):
    rows = sharding.shard_rows(odd_docs, sharding.HashTree.uniform(40), sharding.HashTree.uniform(41)).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in odd_docs.collect()}
    assert len(rows) == 8 and {r.law for r in rows} == {"key"}
    for r in rows:
        assert r["size"] == len(texts[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id])
        assert 0 <= r.shard < 40
    twins = [r for r in rows if r.doc_id == 5]
    assert twins[0].shard == twins[1].shard and {r.slot for r in twins} == {min(r.slot for r in twins), min(r.slot for r in twins) + 1}


def test_empty_table(no_docs):
    assert sharding.shard_rows(no_docs, sharding.HashTree.uniform(4), sharding.HashTree.uniform(5)).count() == 0


def test_gapless_balanced_and_grows_into_itself(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "repeat('a', cast(id % 50 AS int)) AS text").repartition(7)
    rows = sharding.shard_rows(docs, sharding.HashTree.uniform(40), sharding.HashTree.uniform(41)).toPandas()
    for _, part in rows.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    counts = rows.groupby("shard").size()
    assert len(counts) == 40 and counts.min() > 350 and counts.max() < 650
    moved = rows[rows["shard"] != rows["grown_shard"]]
    assert set(moved["grown_shard"]) == {40} and 350 < len(moved) < 650


def test_movement_is_confined_to_changed_subtrees(spark):
    base = {"r0": {"r0/a": {0: 1.0, 1: 1.0}, "r0/b": {2: 2.0}}, "r1": {"r1/a": {3: 1.0, 4: 0.0}, "r1/b": {5: 3.0}}}
    heavier = {"r0": base["r0"], "r1": {"r1/a": {3: 1.0, 4: 0.0}, "r1/b": {5: 6.0}}}
    ids = spark.range(8000)
    out = sharding.HashTree(heavier).place(sharding.HashTree(base).place(ids, "id", "old"), "id", "new").toPandas()
    assert 4 not in set(out["old"])                        # weight 0 is never drawn
    share = out.groupby("old").size() / len(out)
    assert abs(share[5] - 3 / 8) < 0.03 and abs(share[2] - 2 / 8) < 0.03
    moved = out[out["old"] != out["new"]]
    assert set(moved["new"]) <= {3, 5}                     # only into region r1
    assert not len(moved[(moved["old"] == 5)])             # the heavier shard loses nothing


def brute_shard(tree, row_id):
    """Descend by draws recomputed with another hash library: seed, name and id
    (null: left out) hashed in turn, each under the hash before it."""
    def draw(name, weight):
        h = xxhash.xxh64_intdigest(tree.seed.to_bytes(4, "little"), 42)
        h = xxhash.xxh64_intdigest(name.encode(), h)
        if row_id is not None:
            h = xxhash.xxh64_intdigest(row_id.to_bytes(8, "little", signed=True), h)
        return -math.log(((h >> 11) + 0.5) / (1 << 53)) / weight

    def winner(children):
        return min((draw(str(name), weight), name) for name, weight in children if weight > 0)[1]

    racks = tree.regions[winner([(r, sum(w for s in k.values() for w in s.values())) for r, k in tree.regions.items()])]
    return winner(racks[winner([(k, sum(s.values())) for k, s in racks.items()])].items())


@pytest.mark.parametrize("tree", [sharding.HashTree.uniform(40), sharding.HashTree.uniform(41), sharding.HashTree(
    {"r0": {"r0/a": {0: 1.0, 1: 0.0}, "r0/b": {2: 2.5}}, "r1": {"r1/a": {3: 0.5, 4: 4.0}}}, seed=3)])
def test_draws_equal_an_independent_computation(spark, tree):
    ids = [None, 0, -1, 1 << 62, *range(7, 2000, 11)]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    assert {r.id: r.shard for r in tree.place(df, "id", "shard").collect()} == {i: brute_shard(tree, i) for i in ids}


def test_hot_identical_rows_share_a_shard_with_gapless_slots(spark):
    docs = spark.range(9000).selectExpr("if(id % 3 = 0, NULL, if(id % 3 = 1, 5L, id)) AS doc_id", "'same' AS text").repartition(5)
    rows = sharding.shard_rows(docs, sharding.HashTree.uniform(4), sharding.HashTree.uniform(5)).toPandas()
    for _, part in rows.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    assert rows[rows["doc_id"].isna()]["shard"].nunique() == 1 and len(rows) == 9000
