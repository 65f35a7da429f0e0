import hashlib

import numpy as np

from unitcast.llm import fingerprint as fp


def naive(text):
    """Signature by sorting all items per sketch."""
    h = fp.items(text)
    n = len(h)
    low = (h >> np.uint64(32)).astype(np.uint32)
    out = []
    for i in range(fp.SKETCHES):
        drawn = low * fp._FACTORS[i]
        chosen = sorted(sorted(range(n), key=lambda j: (drawn[j], j))[:fp.PICK])
        x = np.array([n if n < fp.PICK else fp.PICK], dtype=np.uint64)
        for j in chosen:
            x = fp._mix(x * np.uint64(0x9E3779B97F4A7C15) + h[j:j + 1])
        out.append(int((fp._mix(x + np.uint64(i)) >> np.uint64(32))[0]))
    return out


def test_signature_equals_naive_selection():
    for text in ("", "a", "abcdefg", "abcdefgh", "abcdefghi", "abab" * 40, "The quick brown fox. " * 9, "é\U0001f600" * 50):
        assert fp.signature(text).tolist() == naive(text)


def test_occurrences_are_numbered():
    a, b = fp.items("abcdefgh" * 3), fp.items("abcdefgh" * 5)
    assert len(set(a.tolist())) == len(a) and set(a.tolist()) <= set(b.tolist())


def test_order_matters_and_sets_do_not_suffice():
    rng = np.random.default_rng(1)
    blocks = ["".join(chr(97 + c) for c in rng.integers(0, 26, 200)) for _ in range(6)]
    text, shuffled = "".join(blocks), "".join(blocks[::-1])
    other = "".join(chr(97 + c) for c in rng.integers(0, 26, 1200))
    same = np.intersect1d(fp.items(text), fp.items(shuffled))
    assert len(same) > 1100                                  # nearly the same k-mers
    swapped = fp.likeness(fp.signature(text), fp.signature(shuffled))
    near = fp.likeness(fp.signature(text), fp.signature(text[:600] + "#" + text[601:]))
    assert near > 0.9 and swapped < 0.65 and fp.likeness(fp.signature(text), fp.signature(other)) == 0


def check(rows, docs):
    order = sorted(docs, key=lambda d: (-d[0], d[1]))
    got = sorted(rows, key=lambda r: (-(r.doc_id if r.doc_id is not None else (1 << 63) - 1), r.n_chars))
    assert len(got) == len(order)
    for k, ((i, text), r) in enumerate(zip(order, got)):
        following = order[(k + 1) % len(order)][1]
        new = fp.edited(text, following)
        a, b, c = map(fp.signature, (text, new, following))
        assert (r.n_chars, r.fingerprint, r.edited_fingerprint) == (len(text), fp.as_text(a), fp.as_text(b))
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert (r.near_edited, r.near_next) == (fp.likeness(a, b), fp.likeness(a, c))


def test_odd_documents(odd_docs):
    docs = [(r.doc_id if r.doc_id is not None else (1 << 63) - 1, r.text or "") for r in odd_docs.collect()]
    for ranges in (1, 3, 20):
        check(fp.neighbour_edits(odd_docs, ranges=ranges).collect(), docs)


def test_few_documents(spark, no_docs):
    assert fp.neighbour_edits(no_docs).count() == 0
    for n in (1, 2):
        docs = [(10 * i, f"text number {i} of the table " * 4) for i in range(n)]
        check(fp.neighbour_edits(spark.createDataFrame(docs, "doc_id long, text string"), ranges=4).collect(), docs)


def test_equal_texts_have_equal_fingerprints(odd_docs):
    marks = {}
    for r in fp.fingerprints(odd_docs).collect():
        marks.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert marks[2] == marks[3] and all(len(m) == 1 for m in marks.values())
