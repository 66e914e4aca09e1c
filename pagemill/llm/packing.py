"""Best-fit-decreasing packing of token sequences.

Only lengths matter for the packing, and a length is at most the capacity, so the whole corpus is
described by one count for each length. Best fit decreasing runs on these counts: a segment tree over
remaining capacities finds the tightest open bin in logarithmic time, and bins that stand alike move
together as intervals. The result is a short table from (length, rank) to (bin, offset), the same as
placing the documents one by one, and the pieces are joined to it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import as_batch, slices, utf8
from pagemill.session import cut_lineage

CAPACITY = 2048
END_ID = 0
#: Words a Python worker remembers with their ids; beyond it starts anew. Longer words are not kept.
WORDS_KEPT = 800_000
LONGEST_KEPT = 64


class CapacityTree:
    """A segment tree over remaining capacities 0..capacity that knows which have an open bin."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)

    def put(self, remaining: int, is_open: bool) -> None:
        node = remaining + self.leaves
        self.any[node] = is_open
        while node > 1:
            node //= 2
            self.any[node] = self.any[2 * node] or self.any[2 * node + 1]

    def tightest(self, needed: int) -> int | None:
        """The smallest remaining capacity of at least ``needed`` that has an open bin."""
        node = needed + self.leaves
        while not self.any[node]:
            while node & 1:  # a right child: nothing larger below this parent
                node //= 2
            if node == 0:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.any[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit decreasing for ``counts[length]`` pieces of each length, 1 to ``capacity``.

    Rows (length, first rank, end rank, pieces per bin, first bin, offset): the piece of that length
    with rank r, counted from 0, stands in bin ``first bin + (r - first) // per`` at
    ``offset + (r - first) % per * length``. Of equal pieces the next one always fits tightest into the
    bin that got the last, until it is full; hence "pieces per bin".
    """
    tree, intervals, bins, rows = CapacityTree(capacity), [[] for _ in range(capacity + 1)], 0, []

    def put(remaining: int, first: int, n: int) -> None:
        if n and remaining:
            intervals[remaining].append((first, n))
            tree.put(remaining, True)

    for length in sorted(counts, reverse=True):
        rank, n = 0, counts[length]
        while rank < n:
            remaining = tree.tightest(length)
            if remaining is None:
                remaining, first, there = capacity, bins, -(-(n - rank) // (capacity // length))
                bins += there
            else:
                first, there = intervals[remaining].pop()
                if not intervals[remaining]:
                    tree.put(remaining, False)
            per = remaining // length
            full = min(there, (n - rank) // per)
            rest = min(n - rank - full * per, per - 1) if full < there else 0
            rows.append((length, rank, rank + full * per + rest, per, first, capacity - remaining))
            put(remaining - per * length, first, full)
            put(remaining - rest * length, first + full, 1 if rest else 0)
            put(remaining, first + full + (rest > 0), there - full - (rest > 0))
            rank += full * per + rest
    return rows


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


_KNOWN: dict[str, dict[bytes, bytes]] = {}


def _encode_words(words: list[bytes], tokenizer) -> list[bytes]:
    """Each word's ids; many words go to the tokenizer as one text, and offsets tell whose ids are whose."""
    out = []
    for k in range(0, len(words), 512):
        part = [w.decode() for w in words[k : k + 512]]
        found = tokenizer.encode(" ".join(part), add_special_tokens=False)
        ids = np.array(found.ids, dtype="<u4")
        word_ends = np.cumsum([len(w) + 1 for w in part])
        token_starts = np.array([start for start, _ in found.offsets], dtype=np.int64)
        ends = np.searchsorted(token_starts, word_ends).tolist()
        packed, start = ids.tobytes(), 0
        for end in ends:
            out.append(packed[4 * start : 4 * end])
            start = end
    return out


def token_bytes(texts: list[bytes], path: str) -> list[bytes]:
    """Each text's ids as little-endian unsigned 32-bit integers, as the tokenizer file gives them.

    The file's tokenizer lower-cases and drops white space before it does anything else across words, so
    a text's ids are those of its words, one after the other; a worker asks the tokenizer once for a word
    it knows. Texts with a special token's first characters keep their case, as those are looked for first.
    """
    tokenizer, known = _tokenizer(path), _KNOWN.setdefault(path, {})
    if len(known) > WORDS_KEPT:
        known.clear()
    words = [(t if b"<|" in t else t.lower()).split() for t in texts]
    found = [list(map(known.get, ws)) for ws in words]
    missed = [(n, [k for k, ids in enumerate(f) if ids is None]) for n, f in enumerate(found) if None in f]
    fresh = list({words[n][k] for n, places in missed for k in places})
    new = dict(zip(fresh, _encode_words(fresh, tokenizer), strict=True))
    for n, places in missed:
        own, into = words[n], found[n]
        for k in places:
            into[k] = new[own[k]]
    known.update((w, ids) for w, ids in new.items() if len(w) <= LONGEST_KEPT)
    return list(map(b"".join, found))


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, payload: str = "ids", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, the payload, part and rank: every document's ids, cut at capacity.

    payload: "ids" gives them as binary (little-endian unsigned 32-bit), "ids_crc32" only their checksum.
    part and rank: the task and the place among its pieces of this length.
    """
    kind = {"ids": (pa.binary(), "binary"), "ids_crc32": (pa.int64(), "long")}[payload]
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), (payload, kind[0]), ("part", pa.int32()), ("rank", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, width = TaskContext.get().partitionId(), [0] * (capacity + 1), 4 * capacity
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            for some in slices(batch, "text"):
                rows = []
                found = token_bytes(utf8(some.column("text")), tokenizer)
                for doc_id, ids in zip(some.column("doc_id").to_pylist(), found, strict=True):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), width)):
                        own = ids[at : at + width]
                        n = len(own) // 4
                        rows.append((doc_id, piece, at // 4, n, own if payload == "ids" else zlib.crc32(own), part, seen[n]))
                        seen[n] += 1
                if rows:
                    yield as_batch(schema, *zip(*rows, strict=True))

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, f"doc_id long, piece int, start long, length long, {payload} {kind[1]}, part int, rank long")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, payload: str = "ids", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, the payload (see ``pieces``), sequence_id, offset.

    A null or empty text is the end id alone. Every row is a document of its own, whatever its
    doc_id; other columns are ignored; an empty table gives an empty one. Pieces of one length are
    numbered by task and place; the counts that go to the driver are one for each length.
    """
    spark = docs.sparkSession
    cut = cut_lineage(pieces(docs, tokenizer, capacity, payload, id_col, text_col))
    per_part = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = cut_lineage(per_part.select("part", "length", "n", F.coalesce(before, F.lit(0)).alias("before")))
    counts = {r["length"]: r["n"] for r in starts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.createDataFrame(best_fit(counts, capacity), "length long, first long, end long, per long, bin long, base long")
    ranked = cut.join(starts.drop("n").hint("merge"), ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    # The plan's size is bounded by the capacity alone.
    placed = ranked.join(F.broadcast(plan), "length").where("rank >= first and rank < end")
    return placed.select(
        "doc_id", "piece", "start", "length", payload,
        F.expr("bin + (rank - first) div per").alias("sequence_id"),
        F.expr("base + (rank - first) % per * length").alias("offset"),
    )
