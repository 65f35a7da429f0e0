"""The pipeline stage by stage against brute force on the smallest tables."""

import hashlib
import os
import re

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from unitcast.llm import bpe, common, langid
from unitcast.llm.queries import DOCUMENT_EVIDENCE, QUERIES
from test_decontaminate import brute as leaks_of
from test_line_dedup import brute as lines_of
from test_near_duplicates import brute as classes_of


@pytest.fixture(scope="module")
def stages(spark, smoke_dir):
    docs = common.table(spark, smoke_dir, "documents")
    found = [docs]
    for _, stage in pipeline.STAGES:
        found.append(common.stored(stage(spark, found[-1], smoke_dir), "stage"))
    return found


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_language_stage(stages):
    before, after = by_id(stages[0]), by_id(stages[1])
    found = langid.identify(stages[0], "doc_id", "text", **DOCUMENT_EVIDENCE).collect()
    assert set(after) == {r["_id"] for r in found if r.keep}
    clean = {i for i, r in before.items() if len(r.text) > 200 and not re.search(r"[0-9#$%&*!]", r.text)}
    assert clean and clean <= set(after)


def test_line_stage(stages):
    exp = lines_of({i: r.text for i, r in by_id(stages[1]).items()})
    after = by_id(stages[2])
    assert {i: r.text for i, r in after.items()} == {i: e[2] for i, e in exp.items()}
    assert all(r.n_chars == len(r.text) for r in after.values())


def test_near_duplicate_stage(stages):
    rows = [(i, r.text) for i, r in by_id(stages[2]).items()]
    assert set(by_id(stages[3])) == {e[0] for e in classes_of(rows).values()}


def test_decontamination_stage(spark, smoke_dir, stages):
    items = [(r.item_id, r.text) for r in common.table(spark, smoke_dir, "benchmark").collect()]
    rows = [(i, r.text) for i, r in by_id(stages[3]).items()]
    assert set(by_id(stages[4])) == {i for i, _ in rows} - {x[0] for x in leaks_of(rows, items)}


def test_encoding_stage(stages):
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern = bpe.default_vocabulary()
    with open(path, "rb") as f:
        ranks = bpe.Vocabulary.parse(f.read()).ranks
    judge = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    before, after = by_id(stages[4]), by_id(stages[5])
    assert set(before) == set(after)
    for i, r in after.items():
        ids = judge.encode_ordinary(before[i].text)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(before[i].text.encode()).hexdigest()


@pytest.mark.parametrize("case", ["odd", "empty"])
def test_odd_tables(spark, smoke_dir, odd_docs, no_docs, case):
    docs = odd_docs if case == "odd" else no_docs
    for i, (_, stage) in enumerate(pipeline.STAGES):
        out = common.stored(stage(spark, docs, smoke_dir), "stage")
        assert i == len(pipeline.STAGES) - 1 or out.columns == docs.columns
        docs = out
    assert docs.count() == (0 if case == "empty" else 5)


def test_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in names if re.match(r"op\d+_", k)}
    assert "pipeline" in names and set(QUERIES) <= set(names)


def test_chat_query_adds_its_conversation(spark, smoke_dir):
    own = QUERIES["op5_chat_round_trip"](spark, smoke_dir).filter("conv_id = -7").first()
    text = "</s>[INST] ok [/INST]"
    assert own.n_turns == 2 and own.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert own.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for d, _, names in os.walk(os.path.join(root, "unitcast")):
        if os.path.basename(d) != "llm":
            for n in names:
                if n.endswith(".py"):
                    with open(os.path.join(d, n)) as f:
                        assert "llm" not in f.read()
