"""MinHash near-duplicates against plain comparison of all sets, and the sketch's own properties."""

import random

import numpy as np
import pytest

from pagemill.llm import minhash, queries

_RNG = random.Random(11)


def plain_set(text):
    words = bytes(text or "", "utf-8").lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 4]) for k in range(max(1, len(words) - 3)))


def expected(rows):
    sets = [plain_set(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[top(a)] = top(b)
    out = []
    for k, (doc_id, *_) in enumerate(rows):
        ids = [i for j, (i, *_) in enumerate(rows) if top(j) == top(k) and i is not None]
        least = (min(ids) if ids else None) if sets[k] else doc_id
        out.append((doc_id, len(sets[k]), least, doc_id is not None and doc_id == least))
    return sorted(out, key=repr)


def corpus():
    vocabulary = [f"w{k}é" for k in range(400)]
    passage = [_RNG.choice(vocabulary) for _ in range(60)]
    texts = [None, "", " \n", "One", "one", "ONE two", "one two three", "One\ttwo  three\x0bfour", "one two three four", "a\x1cb c d e"]
    bases = [[_RNG.choice(vocabulary) for _ in range(_RNG.randint(20, 200))] for _ in range(12)]
    for base in bases:
        for _ in range(12):
            copy = list(base)
            for _ in range(_RNG.randint(0, max(2, len(base) // 18))):
                copy[_RNG.randrange(len(copy))] = _RNG.choice(vocabulary)
            texts.append(" ".join(copy))
    for _ in range(60):  # a passage that many documents share
        texts.append(" ".join(passage + [_RNG.choice(vocabulary) for _ in range(_RNG.randint(5, 60))]))
    texts += [texts[20], texts[20].upper(), "x " * 3000]
    return texts


@pytest.fixture(scope="module")
def rows():
    out = [(None if k in (3, 25) else 1000 - k, t, k, "clash") for k, t in enumerate(corpus())]
    return out + [out[30], (out[31][0], out[60][1], 0, "same id, other text")]


SCHEMA = "doc_id long, text string, n long, node string"


@pytest.mark.parametrize("block", [4, minhash.BLOCK])
def test_against_all_pairs(spark, rows, tmp_path, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_minhash_neardup(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows)


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("block", [4, minhash.BLOCK])
def test_second_step_finds_links_that_no_star_has(spark, monkeypatch, block):
    """Blocks alone, with every set a root of its own, connect what similar pairs of a key connect."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    base = [f"w{k}" for k in range(100)]
    texts = [" ".join(base[:k] + ["new"] + base[k + 1 :]) for k in range(0, 100, 2)]
    texts += [" ".join(base[: 20 + 9 * k]) for k in range(9)] + ["a b c d e f", "a b c d e f"]
    sets = [minhash.shingle_set(t.encode()) for t in texts]
    rows = [(1, k, k, len(s), bytearray(minhash.sketch(s).tobytes()), s.view(np.int64).tolist()) for k, s in enumerate(sets)]
    rest = spark.createDataFrame(rows, "key long, node long, root long, n long, sketch binary, elements array<long>")
    found = [tuple(r) for r in minhash._across(rest).collect()]
    similar = [
        (a, b)
        for b in range(len(sets))
        for a in range(b)
        if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))
    ]
    assert similar and {tuple(sorted(p)) for p in found} <= set(similar)
    assert groups(len(sets), found) == groups(len(sets), similar)
    by_sketch = groups(len(sets), [tuple(r) for r in minhash._across(rest.drop("elements")).collect()])
    assert all(any(part <= whole for whole in by_sketch) for part in groups(len(sets), similar))


def groups(n, pairs):
    group = list(range(n))
    for a, b in pairs:
        group = [group[a] if g == group[b] else g for g in group]
    return {frozenset(k for k in range(n) if group[k] == g) for g in group}


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    for n, common in ((1, 0), (2, 1), (40, 30), (1000, 800), (30_000, 9_000)):
        shared = rng.integers(0, 1 << 63, common, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, n - common, dtype=np.uint64)])) for _ in "ab")
        agree = (minhash.sketch(a) == minhash.sketch(b)).mean()
        assert abs(agree - common / (2 * n - common)) < 0.12
    one = minhash.sketch(np.array([7], dtype=np.uint64))
    assert len(one) == minhash.COORDINATES and np.array_equal(one, minhash.sketch(np.array([7], dtype=np.uint64)))
