"""Byte-level BPE by tree reduction.

A piece of text is halved down to a few bytes; two encoded halves are joined by encoding a window of
tokens around the boundary anew, grown until the tokens beside it stay. That can be told for certain: a
sequence of tokens is the encoding of its bytes exactly if each two neighbours, encoded together, give
these two tokens again. So a join ends as soon as the window's ends stand well beside their neighbours.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import as_batch, slices, utf8

#: Bytes encoded directly, at the tree's leaves and in small windows.
LEAF = 3
#: Bytes up to which parts and windows are remembered.
SHORT = 16
#: Stands for pairs that no rank merges.
NONE = 1 << 40
#: Entries a worker's memories hold; beyond, they start anew.
KEPT = 500_000
#: Tokens joined at a leaf of the decoding tree.
DECODED_AT_ONCE = 4096


class SpaceBefore(Exception):
    """A chunk that ends in white space, or an empty one: the next space is not its own."""


class TreeBpe:
    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        # The pattern's white space is Unicode's property, without the separators U+001C to U+001F.
        self.pieces = regex.compile(pattern.replace(r"^\s", r"^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.parts: dict[bytes, tuple[int, ...]] = {}
        self.beside: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}

    def directly(self, data: bytes) -> tuple[int, ...]:
        """The lowest-ranked neighbours merge first, the leftmost of equals."""
        if len(data) > 48:
            return self._directly_long(data)
        ranks = self.ranks
        parts = [data[k : k + 1] for k in range(len(data))]
        pairs = [ranks.get(data[k : k + 2], NONE) for k in range(len(data) - 1)]
        while pairs:
            best = min(pairs)
            if best == NONE:
                break
            k = pairs.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del pairs[k]
            if k:
                pairs[k - 1] = ranks.get(parts[k - 1] + parts[k], NONE)
            if k < len(pairs):
                pairs[k] = ranks.get(parts[k] + parts[k + 1], NONE)
        return tuple([ranks[p] for p in parts])

    def _directly_long(self, data: bytes) -> tuple[int, ...]:
        """The same with a heap of merges, stale ones skipped, for long data."""
        ranks, n = self.ranks, len(data)
        end, left, right = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, k, k + 2) for k in range(n - 1) if (r := ranks.get(data[k : k + 2])) is not None]
        heapify(heap)
        while heap:
            _, k, stop = heappop(heap)
            other = end[k]
            if other <= 0 or other >= n or end[other] != stop:
                continue
            end[k], end[other], right[k] = stop, 0, right[other]
            if right[k] < n:
                left[right[k]] = k
                after = end[right[k]]
                if (r := ranks.get(data[k:after])) is not None:
                    heappush(heap, (r, k, after))
            if left[k] >= 0 and (r := ranks.get(data[left[k] : stop])) is not None:
                heappush(heap, (r, left[k], stop))
        return tuple([ranks[data[k : end[k]]] for k in range(n) if end[k] > 0])

    def stand(self, left: int, right: int) -> bool:
        """Whether the two tokens side by side are the encoding of their bytes."""
        found = self.beside.get((left, right))
        if found is None:
            found = self.directly(self.tokens[left] + self.tokens[right]) == (left, right)
            if len(self.beside) > KEPT:
                self.beside.clear()
            self.beside[left, right] = found
        return found

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of both sides' bytes from theirs."""
        if not left or not right or self.stand(left[-1], right[0]):
            return left + right
        a = b = 1
        while True:
            a, b = min(a, len(left)), min(b, len(right))
            window = self.window(b"".join([self.tokens[t] for t in left[len(left) - a :] + right[:b]]))
            left_stands = a == len(left) or self.stand(left[-a - 1], window[0])
            right_stands = b == len(right) or self.stand(window[-1], right[b])
            if left_stands and right_stands:
                return left[: len(left) - a] + window + right[b:]
            a, b = (a if left_stands else 2 * a), (b if right_stands else 2 * b)

    def window(self, data: bytes) -> tuple[int, ...]:
        """A window's own encoding; short ones are remembered with the tree's parts."""
        if len(data) > SHORT:
            return self.directly(data)
        found = self.parts.get(data)
        if found is None:
            found = self._keep(data, self.directly(data))
        return found

    def _keep(self, data: bytes, ids: tuple[int, ...]) -> tuple[int, ...]:
        if len(self.parts) > KEPT:
            self.parts.clear()
        self.parts[data] = ids
        return ids

    def encode_piece(self, data: bytes) -> tuple[int, ...]:
        """A piece that is a token is that token; any other is the join of its halves."""
        rank = self.ranks.get(data)
        return (rank,) if rank is not None else self._half(data)

    def _half(self, data: bytes) -> tuple[int, ...]:
        short = len(data) <= SHORT
        if short and (found := self.parts.get(data)) is not None:
            return found
        if len(data) <= LEAF:
            return self._keep(data, self.directly(data))
        middle = len(data) // 2
        found = self.join(self._half(data[:middle]), self._half(data[middle:]))
        return self._keep(data, found) if short else found

    def encode(self, text: str) -> bytes:
        """The ids of every match of the pattern, as little-endian unsigned 32-bit integers.

        A match never runs from other characters into white space, so what stands between single
        spaces is encoded by itself, and remembered with the space before it. Texts with a space after
        white space are matched whole.
        """
        first, *rest = text.split(" ")
        if rest and first[-1:].isspace():
            return self._matches(text)
        try:
            return self._matches(first) + b"".join([self.known.get(c) or self._chunk(c) for c in rest])
        except SpaceBefore:
            return self._matches(text)

    def _chunk(self, chunk: str) -> bytes:
        if not chunk or chunk[-1].isspace():
            raise SpaceBefore
        ids = self._matches(" " + chunk)
        if len(chunk) <= 40:
            if len(self.known) > KEPT:
                self.known.clear()
            self.known[chunk] = ids
        return ids

    def _matches(self, text: str) -> bytes:
        ids = [t for piece in self.pieces(text) for t in self.encode_piece(piece.encode())]
        return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, dtype="<u4").tobytes()

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids: both halves', one after the other."""
        if len(ids) <= DECODED_AT_ONCE:
            return b"".join(map(self.tokens.__getitem__, ids.tolist()))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


@lru_cache(maxsize=2)
def tree_bpe(path: str, pattern: str) -> TreeBpe:
    return TreeBpe(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ids (binary, little-endian unsigned 32-bit).

    A null or empty text has no ids. Every row is encoded on its own, repeated or not; other columns
    are ignored; an empty table gives an empty one.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tree_bpe(path, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                yield as_batch(schema, part.column("doc_id"), [bpe.encode(t) if t else b"" for t in part.column("text").to_pylist()])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids, with the decoded bytes: doc_id, ids, decoded (binary). Null ids decode to none."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tree_bpe(path, pattern)
        for batch in batches:
            for part in slices(batch, "ids"):
                ids = utf8(part.column("ids"))
                yield as_batch(schema, part.column("doc_id"), part.column("ids"), [bpe.decode(np.frombuffer(i, dtype="<u4")) for i in ids])

    return encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("binary")).mapInArrow(run, "doc_id long, ids binary, decoded binary")
