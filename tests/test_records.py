"""Retry acceptance against a walk in plain Python; progress and failures by hand."""

import random

import pytest

from pagemill.operators import records as rc

RECORDS = "rel_path string, chunk_index int, attempt int, pos int, instruction string, input string, output string"
KEYS = "rel_path string, instruction string, output string"


def frame(spark, rows):
    """rows: (file, chunk, attempt, pos, key)"""
    return spark.createDataFrame([(*r[:4], f"{r[4]}?", f"in{r[3]}", "o") for r in rows], RECORDS)


def existing(spark, pairs):
    return spark.createDataFrame([(f, f"{k}?", "o") for f, k in pairs], KEYS)


def kept(df):
    return sorted((r["rel_path"], r["chunk_index"], r["attempt"], r["pos"], r["instruction"][:-1]) for r in df.collect())


def walk(rows, before, max_retries, whole_run):
    """One chunk after the other, one attempt after the other."""
    seen = {k if whole_run else (f, k) for f, k in before}
    out, settled = [], set()
    for f, c, a, p, k in sorted(rows):
        if (f, c) in settled and (f, c, a) not in settled or a > max_retries:
            continue
        key = k if whole_run else (f, k)
        if key not in seen:
            seen.add(key)
            out.append((f, c, a, p, k))
            settled |= {(f, c), (f, c, a)}
    return out


def test_retry_takes_one_attempt(spark):
    rows = [("f", 1, 1, 1, "old"), ("f", 1, 2, 1, "old"), ("f", 1, 2, 2, "new"), ("f", 1, 3, 1, "newer")]
    got = rc.accept_attempts(frame(spark, rows), existing(spark, [("f", "old"), ("g", "new")]))
    assert kept(got) == [("f", 1, 2, 2, "new")]


def test_long_chain_of_dependent_chunks(spark):
    """Every chunk's first attempt repeats what the chunk before ends up with."""
    rows = [("f", 1, 1, 1, "k1")]
    for c in range(2, 9):
        rows += [("f", c, 1, 1, f"k{c - 1}"), ("f", c, 2, 1, f"k{c}")]
    assert kept(rc.accept_attempts(frame(spark, rows))) == walk(rows, [], 3, False)


def test_chain_of_2000_chunks_takes_few_rounds(spark, monkeypatch):
    """Choices that alternate at random along the chain; every step hangs on the one before."""
    rng = random.Random(4)
    rows = [("f", 1, 1, 1, "k1"), ("f", 1, 2, 1, "l1")]
    for c in range(2, 2001):
        held = rng.choice([f"k{c - 1}", f"l{c - 1}", f"m{c - 1}"])
        rows += [("f", c, 1, 1, held), ("f", c, 2, 1, f"k{c}"), ("f", c, 2, 2, f"l{c}")]
        rows += [("f", c, 3, 1, f"m{c}")] if c % 2 else [("f", c, 1, 2, f"l{c - 1}")]
    rounds = []
    for name in ("_settle", "_hop"):
        plain = getattr(rc, name)
        monkeypatch.setattr(rc, name, lambda df, plain=plain: (rounds.append(1), plain(df))[1])
    assert kept(rc.accept_attempts(frame(spark, rows))) == walk(rows, [], 3, False)
    assert 3 <= len(rounds) <= 15


@pytest.mark.parametrize("plain_rounds", [0, rc.PLAIN_ROUNDS])
def test_random_runs(spark, monkeypatch, plain_rounds):
    monkeypatch.setattr(rc, "PLAIN_ROUNDS", plain_rounds)
    for seed, whole_run in ((1, False), (2, False), (3, True)):
        rng = random.Random(seed)
        rows = [
            (f"f{f}", c, a, p, f"k{rng.randint(0, 9 if f < 8 else 40)}")
            for f in range(16)
            for c in range(1, 9)
            for a in range(1, 5)
            for p in range(1, rng.randint(1, 4))
        ]
        before = [(f"f{f}", f"k{f % 3}") for f in range(0, 16, 2)]
        scope = "run" if whole_run else "file"
        got = rc.accept_attempts(frame(spark, rows), existing(spark, before), 3, scope)
        assert kept(got) == walk(rows, before, 3, whole_run)


def test_dedup(spark):
    rows = [("f", 1, 1, 2, "a"), ("f", 1, 1, 1, "a"), ("g", 1, 1, 1, "a"), ("g", 2, 1, 1, "b")]
    assert kept(rc.dedup_within_file(frame(spark, rows))) == sorted(rows[1:])
    assert kept(rc.dedup_global(frame(spark, rows))) == [rows[1], rows[3]]


def test_progress(spark):
    accepted = frame(spark, [("f", 1, 1, 1, "a"), ("f", 3, 1, 1, "b"), ("g", 1, 1, 1, "c")])
    old = spark.createDataFrame([("g", 4), ("h", 2)], "rel_path string, done int")
    small = spark.createDataFrame([("f", 5), ("i", 1)], "rel_path string, chunk_index int")
    marks = {r["rel_path"]: r["done"] for r in rc.advance_progress(old, accepted).collect()}
    assert marks == {"f": 3, "g": 4, "h": 2}
    marks = {r["rel_path"]: r["done"] for r in rc.advance_progress(old, accepted, small).collect()}
    assert marks == {"f": 5, "g": 4, "h": 2, "i": 1}
    pairs = {tuple(r) for r in rc.completed_chunks(accepted, small).collect()}
    assert pairs == {("f", 1), ("f", 3), ("f", 5), ("g", 1), ("i", 1)}


def test_failures(spark):
    checked = spark.createDataFrame(
        [
            ("f", 1, 1, "HTTP 500", False), ("f", 1, 2, None, False), ("f", 1, 3, None, True),
            ("f", 2, 1, None, True), ("f", 2, 2, None, True), ("f", 3, 1, None, True), ("f", 3, 2, None, False),
        ],
        "rel_path string, chunk_index int, attempt int, http_error string, has_list boolean",
    )
    accepted = frame(spark, [("f", 1, 3, 1, "a"), ("f", 3, 1, 1, "b")])
    small = spark.createDataFrame([("f", 4)], "rel_path string, chunk_index int")
    found = {tuple(r)[1:4] for r in rc.classify_failures(checked, accepted, small).collect()}
    assert found == {
        (1, 1, "http_error"), (1, 2, "no_json"), (2, 1, "no_valid_objects"), (2, 2, "no_valid_objects"),
        (4, None, "too_small"),
    }


def test_pair_counts(spark):
    rows = [("f", 1, 1, 1, "a"), ("f", 1, 1, 2, "b"), ("g", 1, 1, 1, "a")]
    assert {tuple(r) for r in rc.pair_counts(frame(spark, rows)).collect()} == {("f", 2), ("g", 1), (None, 3)}
