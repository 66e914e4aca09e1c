"""Periodic runs against their definition, and the grammar's extensions against plain comparison."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from pagemill.llm import queries, runs
from pagemill.llm.recompression import Grammar

_RNG = random.Random(3)


def plain_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            end = i + q
            if i > start and end - start >= max(6, 4 * q):
                part = w[start:end]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((start, end - start, q))
            i += i == start
    return sorted(out, key=lambda r: (r[0], r[2]))


def sequences():
    for _ in range(400):
        n = _RNG.randint(1, 150)
        w = [_RNG.randrange(_RNG.choice([1, 2, 3, 6])) for _ in range(n)]
        if _RNG.random() < 0.6:
            s = _RNG.randrange(n)
            p = _RNG.randint(1, 1 + (n - s) // 4)
            w = w[:s] + [w[s + (i - s) % p] for i in range(s, n)]
        yield w


def test_extensions():
    for w in sequences():
        if len(w) < 2:
            continue
        grammar = Grammar(np.array(w))
        for _ in range(10):
            a, b = sorted(_RNG.sample(range(len(w)), 2))
            ahead = next((k for k in range(len(w) - b) if w[a + k] != w[b + k]), len(w) - b)
            back = next((k for k in range(a) if w[a - 1 - k] != w[b - 1 - k]), a)
            assert (grammar.extend(a, b), grammar.extend_back(a, b)) == (ahead, back)


@pytest.mark.parametrize("grid_words", [0, runs.GRID_WORDS])
def test_every_run_is_found(monkeypatch, grid_words):
    monkeypatch.setattr(runs, "GRID_WORDS", grid_words)
    for w in sequences():
        assert runs.find_runs(np.array(w)) == plain_runs(w)


def test_long_texts():
    w = np.array([_RNG.randrange(500) for _ in range(60_000)])
    w[1000:41_000] = w[1000 + np.arange(40_000) % 9_000]
    w[50_000:50_007] = 7
    assert runs.find_runs(w) == [(1000, 40_000, 9_000), (50_000, 7, 1)]


def expected(doc_id, text):
    words = [w for w in (text or "").translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, left)]
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *digests)


def test_query(spark, tmp_path):
    prose = "the of and house river café naïve token reads under stone quiet lamp".split()
    texts = [None, "", " \n\t", "a a a a a", "a a a a a a", "ä\x1c ä\x1c\vä\x1c ä\x1c ä\x1c\rä\x1c b", "A a " * 9, "x " * 5000]
    texts += [" ".join(_RNG.choice(prose) for _ in range(n)) for n in (3, 60, 200) for _ in range(30)]
    rows = [(None if k == 4 else k, t, 1, "clash") for k, t in enumerate(texts)] + [(5, texts[5], 2, "again")]
    schema = "doc_id long, text string, runs int, collapsed string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op13_periodic_runs(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(repr(expected(k, t)) for k, t, *_ in rows)
    empty = runs.collapse_runs(spark.createDataFrame([], schema))
    assert empty.collect() == []
