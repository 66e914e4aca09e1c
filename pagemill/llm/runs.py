"""Periodic runs of words: harmonic-grid candidates, extended exactly on a recompression grammar.

A run of period q and at least 4 q words holds four multiples of q one after the other, so only grid places
i, a multiple of q, whose words i, i + q, i + 2q and i + 3q agree can lie in one: n ln n places in all. Each
place left is extended both ways by longest common extensions of i and i + q. Grammars are built for
texts with such places only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import as_batch, slices, utf8
from pagemill.llm.recompression import Grammar

#: A run has this many words and periods at least.
LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Up to so many words the grid places of all periods are looked at in one step.
GRID_WORDS = 1 << 14


@lru_cache(maxsize=16)
def _grid(words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, period, last place needed) of every grid place of ``words`` words, by last place."""
    last = LEAST_PERIODS - 1
    periods = range(1, max(1, (words - 1) // last) + 1)
    counts = [max(0, -(-(words - last * q) // q)) for q in periods]
    period = np.repeat(np.arange(1, len(counts) + 1, dtype=np.int32), counts)
    place = np.concatenate([np.arange(c, dtype=np.int32) * np.int32(q) for q, c in zip(periods, counts)])
    end = place + last * period
    order = np.argsort(end, kind="stable")
    return place[order], period[order], end[order]


def candidates(ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(period, its grid places that pass, ascending), by period."""
    n = len(ids)
    if n <= GRID_WORDS:
        place, period, end = _grid(1 << max(3, (n - 1).bit_length()))
        held = np.searchsorted(end, n)
        place, period = place[:held], period[:held]
        for step in range(1, LEAST_PERIODS):
            same = ids[place] == ids[place + step * period]
            place, period = place[same], period[same]
        order = np.lexsort((place, period))
        place, period = place[order], period[order]
        cuts = np.flatnonzero(period[1:] != period[:-1]) + 1
        for at in np.split(np.arange(len(place)), cuts) if len(place) else ():
            yield int(period[at[0]]), place[at].astype(np.int64)
        return
    for q in range(1, n // LEAST_PERIODS + 1):
        on = ids[::q]
        same = on[1:] == on[:-1]
        agree = same[: 1 - (LEAST_PERIODS - 1) or None].copy()
        for step in range(1, LEAST_PERIODS - 1):
            agree &= same[step : len(agree) + step]
        found = np.flatnonzero(agree)
        if len(found):
            yield q, found * q


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the numbered words, by start and period."""
    runs: list[tuple[int, int, int]] = []
    extents: set[tuple[int, int]] = set()
    cover = np.full(len(ids), -1, dtype=np.int64)  # a run at each word
    period_of = np.zeros(0, dtype=np.int64)
    grammar = None
    for q, places in candidates(ids):
        # Where one run of a period that divides q holds i and i + q, the extension is that run.
        at = cover[places]
        if len(period_of):
            known = (at >= 0) & (at == cover[places + q])
            known[known] = q % period_of[at[known]] == 0
            places = places[~known]
        while len(places):
            grammar = grammar or Grammar(ids)
            i = int(places[0])
            start = i - grammar.extend_back(i, i + q)
            end = i + q + grammar.extend(i, i + q)
            places = places[places >= end - q]
            if end - start >= max(LEAST_WORDS, LEAST_PERIODS * q) and (start, end) not in extents:
                extents.add((start, end))
                cover[start:end] = len(runs)
                runs.append((start, end - start, q))
                period_of = np.append(period_of, q)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def number_words(words: list[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)


def dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words lie in a run after its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change)[:n] > 0


def collapse_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    change: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """Per row: doc_id long, runs array<struct<start, length, period>>, collapsed string.

    Words are what lies between ASCII white space. A run is a stretch of words with smallest period q, of at
    least six words and four periods, that no neighbouring word extends; runs come by start, then period.
    ``collapsed`` keeps of each run its first period and joins the words by one space. ``change`` may alter
    the words of a document first. Map only: one text at a time is held, in memory in proportion to it and
    time n log n. A null or empty text has no run and collapses to nothing; rows with a null id and repeated
    rows are answered like any other, an empty table gives an empty one, other columns play no part.
    """
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
            ("collapsed", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                ids = part.column("doc_id").to_pylist()
                found, left = [], []
                for doc_id, text in zip(ids, utf8(part.column("text"))):
                    words = text.split()
                    if change:
                        words = change(doc_id, words)
                    here = find_runs(number_words(words)) if len(words) >= LEAST_WORDS else []
                    if here:
                        words = [w for w, gone in zip(words, dropped(len(words), here).tolist()) if not gone]
                    found.append([{"start": s, "length": n, "period": q} for s, n, q in here])
                    left.append(b" ".join(words))
                yield as_batch(schema, ids, found, left)

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    told = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"
    return chosen.mapInArrow(run, told).withColumn("collapsed", F.col("collapsed").cast("string"))
