import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from unitcast.llm import bitpack, common

tokenizers = pytest.importorskip("tokenizers")


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 13, 16, 17, 31, 32])
def test_pack_unpack(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 9, 100, 4097):
        ids = rng.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
        data = bitpack.pack(ids, bits)
        assert len(data) == -(-n * bits // 8)
        assert (bitpack.unpack(data, bits, n) == ids).all()
        for start in (0, 3, n // 2):
            if start <= n:
                assert (bitpack.unpack(data, bits, n - start, start) == ids[start:]).all()


def test_width():
    assert [bitpack.width(v) for v in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]


def test_frame_random_access():
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 1 << 17, n, dtype=np.uint32) for n in (5, 0, 100, 33)]
    data = bitpack.frame_bytes(2, 9, [4, 5, 6, 7], docs, 17, block_ids=16) + b"\n"
    (at, frame), = bitpack.frames(data)
    whole = np.concatenate(docs)
    assert (frame.shard, frame.number, frame.n_ids, len(frame.offsets)) == (2, 9, 138, 10)
    for a, b in ((0, 138), (15, 17), (130, 500), (16, 16), (37, 90)):
        assert (frame.ids(a, b) == whole[a:b]).all()
    with pytest.raises(ValueError):
        bitpack.Frame(b"X" * 80)


def library():
    return tokenizers.Tokenizer.from_file(bitpack.default_tokenizer())


def test_words_equal_the_library():
    with open(bitpack.default_tokenizer(), "rb") as f:
        coder, tool, rnd = bitpack.coder(f.read()), library(), random.Random(4)
    signs = ["The", "ING", " ", "\n", "\t", "'s", "É", "é", "ß", "Σ", "中", "\U0001f600", "12", ".", ",", "|", "Word", "ÀÉ", "µª", "ŉ", "İ", "\u0130x", "<|endoftext|>", " ", "́", " ́", "  "]
    texts = [""] + ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    assert coder.words.direct
    for text in texts:
        assert coder.encode(text).tolist() == tool.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("bits", [16, 17, 32])
def test_added_tokens_and_packed_fields(bits):
    with open(bitpack.default_tokenizer(), "rb") as f:
        coder, tool = bitpack.coder(f.read(), bits), library()
    assert coder.encode("a<|endoftext|>b").tolist() == [320, 49407, 321]
    for text in ("a<|endoftext|>b", "<|startoftext|> x<|endoftext|>", "<|ENDOFTEXT|> y", "a < b <| c", "", "plain words", "<|end oftext|>"):
        data, n = coder.packed(text, 2)
        assert bitpack.unpack(data, bits, n).tolist() == tool.encode(text, add_special_tokens=False).ids + [2]


def test_odd_documents(spark, odd_docs):
    path = common.scratch(spark, "ids")
    bitpack.write_ids(odd_docs, path, 2, frame_ids=10, shards=3)
    rows = bitpack.read_ids(spark, path).collect()
    tool, start = library(), 0
    exp = sorted(((r.doc_id if r.doc_id is not None else common.LAST_ID, r.text or "") for r in odd_docs.collect()))
    assert len(rows) == 8
    for (i, text), r in zip(exp, sorted(rows, key=lambda r: r.start)):
        ids = tool.encode(text, add_special_tokens=False).ids + [2]
        assert (r.doc_id if r.doc_id is not None else common.LAST_ID, r.start, r.n_tokens) == (i, start, len(ids))
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        start += len(ids)
    index = bitpack.frame_index(spark, path).orderBy("start").collect()
    assert len(index) > 1 and sum(f.n_ids for f in index) == start
    f = index[-1]       # random access by the index
    with open(f.path.removeprefix("file:"), "rb") as file:
        file.seek(f.offset)
        text = dict(exp)[f.first_doc]
        assert bitpack.Frame(file.read()).ids(0, 1).tolist() == (tool.encode(text, add_special_tokens=False).ids + [2])[:1]


def test_empty_table(spark, no_docs):
    path = common.scratch(spark, "ids")
    bitpack.write_ids(no_docs, path, 2)
    assert bitpack.read_ids(spark, path).agg(F.count("doc_id")).first()[0] == 0
