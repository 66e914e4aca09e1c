"""What a task of the quality rules holds: tables that follow the n-grams it met, and nothing that a batch's size sets."""

import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from pagemill.llm import quality
from pagemill.llm.common import slices, utf8

_RNG = random.Random(4)
WORDS = ["".join(_RNG.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(_RNG.randint(2, 9))) for _ in range(800)]


def texts(n, words):
    return [" ".join(_RNG.choices(WORDS, k=words)).encode() for _ in range(n)]


def model_of(some):
    return quality.KneserNey(*np.unique(quality.grams(some)[0], return_counts=True))


def test_tables_hold_no_more_than_the_three_grams_met():
    codes = quality.grams(texts(50, 200))[0]
    pages = quality.Pages()
    for part in np.array_split(codes, 7):
        at = pages.places(part)
        pages.values[at] = part  # 24 bits: exact
    at = pages.places(codes)
    assert (pages.values[at] == codes).all()
    assert len(pages.values) == len(np.unique(codes >> quality.BITS)) << quality.BITS
    assert pages.at.nbytes <= 1 << 20


def test_what_a_task_holds_is_small_and_scores_are_the_models():
    some = texts(2000, 600)
    model = model_of(some[:200])
    models = {k: SimpleNamespace(value=model) for k in ("a", "b", "c", quality.POOLED)}
    langs = [_RNG.choice(["a", "b", "c"]) for _ in some]
    batch = pa.RecordBatch.from_arrays([pa.array(some, pa.binary()).cast(pa.string()), pa.array(langs)], ["text", "lang"])
    assert batch.nbytes > 6 << 20
    score, found = quality.Scorer(models), []
    tracemalloc.start()
    for part in slices(batch, "text", quality.AT_ONCE):
        found.extend(score(utf8(part.column("text")), part.column("lang").to_pylist())[0])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20, peak
    for k in range(0, len(some), 97):
        assert found[k] == pytest.approx(-model.log_probabilities(quality.grams(some[k : k + 1])[0]).mean(), rel=1e-6)
