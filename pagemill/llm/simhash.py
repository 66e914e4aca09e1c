"""SimHash near-duplicates: Golay-code keys find fingerprints that differ in few bits.

A fingerprint's 64 bits are cut into segments of 23, 23 and 18 bits. The binary Golay code puts every
23-bit word within three bits of exactly one codeword. A word's keys are the codewords to which it and
its 23 one-bit neighbours decode: one to six of them. Two words that differ in two bits have a common
neighbour and so a common key; of two words that differ in one bit, one's own codeword is a key of the
other. Four wrong bits fall on three segments either so that

* one segment is free of them, and then of the other two the first has at most two or the second at
  most one: key (exact segment, codeword of one other segment); or
* none is free, and then one has at most two and the others one each: key (three codewords).

Fingerprints that share a key are compared. No other pair can be within four bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import as_batch, slices, utf8
from pagemill.llm.components import components
from pagemill.session import cut_lineage

#: Words a shingle has, and bits by which linked fingerprints may differ.
SHINGLE_WORDS = 4
MAX_BITS = 4
#: (first bit, bits) of each segment.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Shingles hashed at a time within one text, which bounds memory for a very long one.
SHINGLES_AT_ONCE = 1 << 17
#: Key rows that one task compares.
KEYS_PER_TASK = 1 << 20
#: Fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 generates the binary Golay code.
GENERATOR = 0b110001110101


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """64 bits; a bit is set if more than half of the shingles' hashes have it.

    No word: 0. Fewer words than a shingle has: their sequence is the only shingle. Repeated
    shingles count each time.
    """
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    n = max(1, len(parts) - words + 1)
    bounds = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=bounds[1:])
    ends = bounds[words:] if len(parts) >= words else bounds[-1:]
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, n, SHINGLES_AT_ONCE):
        pairs = zip(bounds[k : min(n, k + SHINGLES_AT_ONCE)].tolist(), (ends[k : k + SHINGLES_AT_ONCE] - 1).tolist())
        hashes = np.array([digest(joined[a:b], 42) for a, b in pairs], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long): every row's fingerprint as a signed long; a null text has no word."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = np.array([fingerprint(t, words) for t in utf8(part.column("text"))], dtype=np.uint64)
                yield as_batch(schema, part.column("doc_id"), found.view(np.int64))

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, fp long")


@lru_cache(maxsize=1)
def _decoder() -> tuple[np.ndarray, np.ndarray]:
    """(syndrome parts of each byte of a 23-bit word, error pattern of each of the 2,048 syndromes)."""
    bit = np.zeros(23, dtype=np.int64)
    for k in range(23):
        rest = 1 << k
        for high in range(22, 10, -1):
            if rest >> high & 1:
                rest ^= GENERATOR << (high - 11)
        bit[k] = rest
    parts = np.zeros((3, 256), dtype=np.int64)
    for which in range(3):
        for byte in range(256):
            for k in range(8):
                if byte >> k & 1 and 8 * which + k < 23:
                    parts[which, byte] ^= bit[8 * which + k]
    errors = np.zeros(2048, dtype=np.int64)
    for a in range(23):
        errors[bit[a]] = 1 << a
        for b in range(a):
            errors[bit[a] ^ bit[b]] = 1 << a | 1 << b
            for c in range(b):
                errors[bit[a] ^ bit[b] ^ bit[c]] = 1 << a | 1 << b | 1 << c
    return parts, errors


def codeword_index(words: np.ndarray) -> np.ndarray:
    """The 12 leading bits of the codeword within three bits of each 23-bit word; they tell it."""
    parts, errors = _decoder()
    syndrome = parts[0][words & 255] ^ parts[1][words >> 8 & 255] ^ parts[2][words >> 16]
    return (words ^ errors[syndrome]) >> 11


def _keys_of_segment(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, 6) codeword indices of the words and their neighbours, -1 where there are fewer.

    Second: which of them a word needs so that words one bit apart share one: its own codeword and
    the smaller ones.
    """
    flips = np.concatenate([[0], 1 << np.arange(23)])
    found = codeword_index(words[:, None] ^ flips[None, :])
    own = found[:, :1]
    found = np.sort(found, axis=1)
    fresh = np.concatenate([np.ones((len(words), 1), bool), found[:, 1:] != found[:, :-1]], axis=1)
    place = np.cumsum(fresh, axis=1) - 1
    out = np.full((len(words), 6), -1, dtype=np.int64)
    rows = np.broadcast_to(np.arange(len(words))[:, None], found.shape)
    out[rows[fresh], place[fresh]] = found[fresh]
    return out, (out >= 0) & (out <= own)


def _segments(fps: np.ndarray) -> list[np.ndarray]:
    return [((fps >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]


#: Segment pairs (exact, decoded, all its keys) for fingerprints that agree in one segment.
_EXACT = ((0, 1, True), (0, 2, False), (1, 0, True), (1, 2, False), (2, 0, True), (2, 1, False))


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): every key of every fingerprint; a key's top bits tell its kind."""
    segments = _segments(fps)
    sets = [_keys_of_segment(s) for s in segments]
    rows, out = [], []
    for kind, (exact, other, wide) in enumerate(_EXACT):
        codes, near = sets[other]
        r, c = np.nonzero(codes >= 0 if wide else near)
        rows.append(r)
        out.append((kind + 1) << 40 | segments[exact][r] << 12 | codes[r, c])
    (a, na), (b, nb), (c, nc) = sets
    every = [x >= 0 for x in (a, b, c)]
    cube = lambda x, y, z: x[:, :, None, None] & y[:, None, :, None] & z[:, None, None, :]
    wanted = cube(every[0], nb, nc) | cube(na, every[1], nc) | cube(na, nb, every[2])
    r, i, j, k = np.nonzero(wanted)
    rows.append(r)
    out.append(a[r, i] << 24 | b[r, j] << 12 | c[r, k])
    return np.concatenate(rows), np.concatenate(out)


#: Rows of one key up to which all its pairs are compared.
FEW = 32


def _least_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    same = (a[:, :, None] == b[:, None, :]) & (a >= 0)[:, :, None]
    return np.where(same, a[:, :, None], 1 << 20).min(axis=(1, 2))


def _told_at(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For linked pairs the one key at which the pair is told, so that no other task repeats it."""
    sx, sy = _segments(x), _segments(y)
    wrong = [np.bitwise_count(a ^ b) for a, b in zip(sx, sy, strict=True)]
    kx, ky = ([_keys_of_segment(s) for s in z] for z in (sx, sy))
    told = np.full(len(x), -1, dtype=np.int64)
    for kind, (exact, other, wide) in enumerate(_EXACT):
        pick = [np.where(True if wide else near, codes, -1) for codes, near in (kx[other], ky[other])]
        least = _least_shared(*pick)
        here = (told < 0) & (wrong[exact] == 0) & (least < 1 << 20)
        told[here] = ((kind + 1) << 40 | sx[exact] << 12 | least)[here]
    rest = np.nonzero(told < 0)[0]
    for wide in range(3):  # which segment may have two wrong bits
        pick = [
            [np.where(True if s == wide else k[s][1][rest], k[s][0][rest], -1) for k in (kx, ky)] for s in range(3)
        ]
        least = [_least_shared(*p) for p in pick]
        here = (told[rest] < 0) & np.logical_and.reduce([v < 1 << 20 for v in least])
        told[rest[here]] = (least[0] << 24 | least[1] << 12 | least[2])[here]
    return told


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that keep what is connected by (a, b), fewer than there are nodes."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        least = root.copy()
        np.minimum.at(least, left, root[right])
        np.minimum.at(least, right, root[left])
        np.minimum.at(least, root, least[np.arange(len(nodes))])
        least = least[least]
        if np.array_equal(least, root):
            break
        root = least
    moved = root != np.arange(len(nodes))
    return nodes[root[moved]], nodes[moved]


def links_among(key: np.ndarray, fps: np.ndarray, most_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links between distinct fingerprints that share a key and differ in few enough bits: all that connects them.

    Rows of keys with few rows are compared with the row d places on in key order, for growing d, and a pair is
    told at one of its keys. A key with many rows is searched from one row outwards instead.
    """
    order = np.lexsort((fps, key))
    key, fps = key[order], fps[order]
    first = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    starts = np.nonzero(first)[0]
    sizes = np.diff(np.append(starts, len(key)))
    found = [_forest(*_reached(fps[a : a + n], most_bits)) for a, n in zip(starts, sizes, strict=True) if n > FEW]
    few = np.repeat(sizes <= FEW, sizes)
    key, fps = key[few], fps[few]
    at, d = np.arange(len(key)), 1
    while len(at):
        at = at[at + d < len(key)]
        at = at[key[at] == key[at + d]]
        near = at[np.bitwise_count(fps[at] ^ fps[at + d]) <= most_bits]
        for k in range(0, len(near), 1 << 15):
            part = near[k : k + (1 << 15)]
            x, y = fps[part], fps[part + d]
            told = _told_at(x, y) == key[part]
            found.append((x[told], y[told]))
        d += 1
    if not found:
        return fps[:0], fps[:0]
    return _forest(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))


def _reached(fps: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among the fingerprints, one link for each row that is not a root.

    From a root the rows in reach are found, from these the next, and so on. A row that is reached is not compared
    again, so rows that lie close together cost their number, not its square. Rows not reached yet are kept in order
    of their distance from the root: a row at distance x has its neighbours between x - most_bits and x + most_bits.
    """
    left, right = [], []
    rest = fps
    while len(rest):
        root, rest = rest[0], rest[1:]
        far = np.bitwise_count(rest ^ root).astype(np.int64)
        order = np.argsort(far, kind="stable")
        rest, far = rest[order], far[order]
        front = np.array([root], dtype=np.uint64)
        while len(front) and len(rest):
            fresh = []
            while len(front) and len(rest):
                x = int(np.bitwise_count(front[0] ^ root))
                a, b = np.searchsorted(far, [x - most_bits, x + most_bits + 1])
                near = np.zeros(len(rest), dtype=bool)
                near[a:b] = np.bitwise_count(rest[a:b] ^ front[0]) <= most_bits
                if near.any():
                    reached = rest[near]
                    fresh.append(reached)
                    left.append(np.full(len(reached), front[0]))
                    right.append(reached)
                    rest, far = rest[~near], far[~near]
                front = front[1:]
            front = np.concatenate(fresh) if fresh else front[:0]
    if not left:
        return fps[:0], fps[:0]
    return np.concatenate(left), np.concatenate(right)


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """(fp long), each once, to (a, b): enough links to connect all within MAX_BITS of each other."""
    keyed_schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])
    link_schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            for k in range(0, len(fps), 2048):
                part = fps[k : k + 2048]
                rows, found = keys(part.view(np.uint64))
                yield as_batch(keyed_schema, found, part[rows])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # 16 bytes a row; links of a key with many rows are at most its rows.
        held = [(b.column("key").to_numpy(), b.column("fp").to_numpy()) for b in batches if b.num_rows]
        if held:
            key, fps = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            a, b = links_among(key, fps.view(np.uint64))
            yield as_batch(link_schema, a.view(np.int64), b.view(np.int64))

    spark = distinct.sparkSession
    rows = distinct.count() * 128
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // KEYS_PER_TASK))
    keyed = distinct.select("fp").mapInArrow(emit, "key long, fp long")
    return keyed.repartition(tasks, "key").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, fp (signed long), fingerprint (16 hex digits), component_id.

    component_id is the smallest non-null doc_id reachable over links of at most MAX_BITS bits; rows
    without words have fingerprint 0 and link like any other. Null texts count as empty, rows with a
    null doc_id take part (component_id is null if no linked row has one), repeated rows stay, an
    empty table gives an empty one. Equal fingerprints are one node, combined before any shuffle.
    """
    marked = cut_lineage(fingerprints(docs, id_col=id_col, text_col=text_col))
    nodes = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(fingerprint_links(nodes))
    rooted = (
        nodes.join(roots, nodes.fp == roots.node, "left")
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, that with the smallest doc_id, with all its columns.

    Where all doc_ids differ and none is null, the others are dropped by their ids alone. Else whole rows
    are compared: null ids come last, equal ids are told apart by their text, and of rows that agree in
    both any one stays; the least is combined before the shuffle.
    """
    found = cut_lineage(near_duplicates(docs, id_col, text_col).select("doc_id", "fp", "component_id"))
    rows, ids = found.select(F.count("*"), F.count_distinct("doc_id")).first()
    if rows == ids:
        dropped = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_dropped"))
        return docs.join(dropped, docs[id_col].cast("long") == dropped["_dropped"], "left_anti")

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint((t or "").encode()) for t in texts], dtype=np.uint64).view(np.int64))

    # Rows of one fingerprint have one component; its number here need only be the same for all its fingerprints.
    nodes = cut_lineage(found.groupBy("fp").agg(F.min("component_id").alias("component_id")))
    rooted = nodes.join(components(fingerprint_links(nodes)), nodes.fp == F.col("node"), "left")
    groups = rooted.select(F.col("fp").alias("_fp"), F.coalesce("root", "fp").alias("_group"))
    marked = docs.select(F.struct(*docs.columns).alias("_row")).withColumn("_fp", fp(F.col(f"_row.{text_col}").cast("string")))
    order = F.struct(F.col(f"_row.{id_col}").isNull(), F.col(f"_row.{id_col}"), F.col(f"_row.{text_col}"))
    least = marked.join(groups, "_fp").groupBy("_group").agg(F.min_by("_row", order).alias("_row"))
    return least.select("_row.*")
