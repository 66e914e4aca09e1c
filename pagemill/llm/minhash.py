"""MinHash near-duplicates: fast similarity sketches, bands, and exact verification of every link.

A sketch has COORDINATES places. In round i each element of a set is thrown into one place with a value that
begins with i; a place keeps its smallest value, so places filled in an earlier round never change and rounds
end as soon as all are filled. From round COORDINATES on each round fills one place of its own from all
elements, so every place fills. Two sets agree in a place with the probability of their similarity, and
the share of places that agree is concentrated as with independent hashes, but a set of n elements costs
about n + COORDINATES log COORDINATES hashes rather than their product.

Bands of BAND_PLACES places are keys. Sets with a similarity of 0.8 share no key with a probability of
(1 - 0.8^6)^56, 4e-8. Candidates that share a key are compared by their whole sketches, then verified on their full sets, in two steps: every set
against the first of each of its keys, which settles groups of near copies with as many comparisons as there
are sets; then, in keys that still hold sets of several components, those against each other, in
blocks of bounded size whose sizes can fit: sketches first, which give clusters, then full sets by cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import as_batch, slices, utf8
from pagemill.llm.components import components
from pagemill.session import cut_lineage
from pagemill.sources.buckets import only_possible

SHINGLE_WORDS = 4
#: Percent of the union that the intersection of linked sets has at least.
LEAST_PERCENT = 80
COORDINATES = 336
BAND_PLACES = 6
BANDS = COORDINATES // BAND_PLACES
#: Places in which sketches must agree for a comparison on full sets. At a similarity of 0.8 fewer agree
#: with a probability of 7e-9.
LEAST_AGREEING = 225
#: Expected sets, and elements in them, of one block of the second step.
BLOCK = 512
BLOCK_ELEMENTS = 1 << 20
#: Bits that tell which texts may belong to a candidate, 16 MiB.
ID_BITS = 1 << 27
#: Hashes computed at a time.
_AT_ONCE = 1 << 13
_UNFILLED = np.uint64(0xFFFFFFFFFFFFFFFF)
_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * _A
    x = x ^ (x >> np.uint64(29))
    x = x * _B
    return x ^ (x >> np.uint64(32))


_SEEDS = _mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_set(text: bytes, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; with fewer words their sequence is the only one."""
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    digest = xxhash.xxh3_64_intdigest
    word = np.array([digest(p) for p in parts], dtype=np.uint64)
    length = min(words, len(parts))
    n = len(parts) - length + 1
    out = np.full(n, length, dtype=np.uint64)
    for k in range(length):
        out = _mix(out + word[k : k + n])
    return np.unique(out)


def sketch(elements: np.ndarray) -> np.ndarray:
    """COORDINATES 16-bit digests of the places of a non-empty set."""
    t, low = np.uint64(COORDINATES), np.uint64(0xFFFFFFFF)
    places = np.full(COORDINATES, _UNFILLED)
    rounds = max(1, _AT_ONCE // len(elements))
    for i in range(0, COORDINATES, rounds):
        number = np.arange(i, min(i + rounds, COORDINATES))
        for k in range(0, len(elements), _AT_ONCE):
            h = _mix(elements[None, k : k + _AT_ONCE] ^ _SEEDS[number][:, None])
            at = (h >> np.uint64(32)) * t >> np.uint64(32)
            value = number.astype(np.uint64)[:, None] << np.uint64(32) | h & low
            np.minimum.at(places, at.ravel().astype(np.intp), value.ravel())
        if places.max() < _UNFILLED:
            break
    for place in np.flatnonzero(places == _UNFILLED):
        number = COORDINATES + place
        places[place] = np.uint64(number) << np.uint64(32) | (_mix(elements ^ _SEEDS[number]) & low).min()
    return (_mix(places) >> np.uint64(48)).astype(np.uint16)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """(n, COORDINATES) sketches to (n, BANDS) keys."""
    parts = sketches.reshape(-1, BANDS, BAND_PLACES).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64)[None, :], parts.shape[:2])
    for at in range(0, BAND_PLACES, 3):
        packed = parts[:, :, at]
        for k in range(at + 1, min(at + 3, BAND_PLACES)):
            packed = packed << np.uint64(16) | parts[:, :, k]
        key = _mix(key + _mix(packed + np.uint64(at + 1)))
    return key.view(np.int64)


def _digest(elements: np.ndarray) -> tuple[int, int]:
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(elements.tobytes()), dtype="<i8").tolist())


def sketches(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text) to (doc_id, n, d1, d2, sketch): size and 128-bit digest of each row's set; no sketch if empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("sketch", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = (shingle_set(t, words) for t in utf8(part.column("text")))
                rows = [(len(s), *_digest(s), sketch(s).tobytes() if len(s) else None) for s in sets]
                yield as_batch(schema, part.column("doc_id"), *zip(*rows))

    return docs.mapInArrow(run, "doc_id long, n long, d1 long, d2 long, sketch binary")


def _full_sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, text) to (d1, d2, elements): each row's whole set."""
    schema = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("elements", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                sets = [shingle_set(t, words) for t in utf8(part.column("text"))]
                d1, d2 = zip(*map(_digest, sets))
                yield as_batch(schema, d1, d2, [s.view(np.int64) for s in sets])

    return docs.mapInArrow(run, "d1 long, d2 long, elements array<long>")


def _keyed(nodes: DataFrame) -> DataFrame:
    """(node, sketch) to (key, node), one row for each band."""
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                found = band_keys(_matrix(part.column("sketch")))
                yield as_batch(schema, found.ravel(), np.repeat(part.column("node").to_numpy(), BANDS))

    return nodes.select("node", "sketch").mapInArrow(run, "key long, node long")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, COORDINATES)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    sized = pairs.join(left, "a").join(right, "b").select("a", "b", F.size("x").alias("p"), F.size("y").alias("q"), common.alias("c"))
    return sized.where(F.expr(f"100 * bigint(c) >= {LEAST_PERCENT} * (bigint(p) + q - c)")).select("a", "b")


def _alike(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches agree in LEAST_AGREEING places."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                near = (_matrix(part.column("x")) == _matrix(part.column("y"))).sum(axis=1) >= LEAST_AGREEING
                yield as_batch(schema, *(part.column(c).to_numpy()[near] for c in "ab"))

    left = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("x"))
    right = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _block_links(root, size, places, sets=None) -> list[tuple[int, int]]:
    """Pairs of rows that connect all roots with sketches alike among these, or with ``sets`` all with similar sets."""
    group = np.unique(root, return_inverse=True)[1]
    found = []
    for k in range(len(root) - 1):
        ahead = slice(k + 1, None)
        fits = 100 * np.minimum(size[k], size[ahead]) >= LEAST_PERCENT * np.maximum(size[k], size[ahead])
        at = k + 1 + np.flatnonzero(fits & (group[ahead] != group[k]))
        at = at[(places[at] == places[k]).sum(axis=1) >= LEAST_AGREEING]
        for j in at.tolist():
            if group[j] == group[k]:
                continue
            if sets:
                place = np.searchsorted(sets[k], sets[j])
                place[place == size[k]] = 0
                common = int((sets[k][place] == sets[j]).sum())
                if 100 * common < LEAST_PERCENT * (size[k] + size[j] - common):
                    continue
            found.append((k, j))
            group[group == group[j]] = group[k]
    return found


def _across(rest: DataFrame) -> DataFrame:
    """(key, node, root, n, sketch) to links (a, b) of roots that meet within a key, by sketches; with elements, by full sets.

    Links connect all roots that are alike; with elements they are of nodes that are similar. Sizes of linked sets
    differ by a factor of 1.25 at most, so classes of sizes to a base of 1.26 meet their own and the next class only. A
    class of a key is dealt to blocks of about BLOCK rows and BLOCK_ELEMENTS elements, and each pair of blocks is
    one bounded group; only links leave it, fewer than it has rows.
    """
    exact = "elements" in rest.columns
    sized = rest.withColumn("class", F.floor(F.log("n") / F.log(F.lit(1.26))).cast("int"))
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_ELEMENTS)).cast("int")
    cells = cut_lineage(sized.groupBy("key", "class").agg(blocks.alias("blocks")))
    own = sized.join(cells, ["key", "class"]).withColumn("block", F.expr("int(pmod(xxhash64(node), blocks))"))
    others = cells.select("key", F.col("class").alias("other"), F.col("blocks").alias("others"))
    met = own.withColumn("other", F.explode(F.expr("array(class - 1, class, class + 1)"))).join(others, ["key", "other"])
    met = met.withColumn("other_block", F.explode(F.expr("sequence(0, others - 1)")))
    mine, theirs = F.struct("class", "block"), F.struct(F.col("other").alias("class"), F.col("other_block").alias("block"))
    lo, hi = F.least(mine, theirs).alias("lo"), F.greatest(mine, theirs).alias("hi")
    grouped = met.select("key", lo, hi, *rest.drop("key").columns)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        root, named = group.column("root").to_numpy(), group.column("node" if exact else "root").to_numpy()
        sets = None
        if exact:
            sets = [s.values.to_numpy().view(np.uint64) for column in group.column("elements").chunks for s in column]
        pairs = _block_links(root, group.column("n").to_numpy(), _matrix(group.column("sketch")), sets)
        at = np.array(pairs, dtype=np.int64).reshape(-1, 2)
        return pa.Table.from_batches([as_batch(schema, named[at[:, 0]], named[at[:, 1]])])

    return grouped.groupBy("key", "lo", "hi").applyInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    A row's set holds its distinct shingles of lower-cased words; sets with an intersection of at least 0.8 of
    the union are linked. component_id is the smallest doc_id reachable over links, itself included, and
    kept says that the row has it. A row without words (or text) has an empty set and is linked with nothing.
    Rows with a null doc_id take part: they are not kept, and their component_id is null if no linked row has
    an id. Repeated rows stay, an empty table gives an empty one, other columns play no part.

    Equal sets are one node, combined before the shuffle, and only nodes that share a band key are ever
    verified; their sets are taken from the texts a second time rather than kept for all rows. Of sets whose
    similarity is just below 0.8 a thousand that share a key cost half a million comparisons, in blocks.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    marked = cut_lineage(sketches(texts, words))
    distinct = marked.where("n > 0").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("least"), F.max("n").alias("n"), F.max("sketch").alias("sketch")
    )
    nodes = cut_lineage(distinct.withColumn("node", F.monotonically_increasing_id()))
    keyed = _keyed(nodes)
    # Keys with the same nodes are told by two 64-bit digests of them, the least node and their number.
    told = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"x{k}") for k in (1, 2)]
    shared = keyed.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("rows"), *told).where("rows > 1")
    shared = shared.groupBy("first", "rows", "x1", "x2").agg(F.min("key").alias("key")).select("key", "first", "rows")
    members = cut_lineage(keyed.join(shared, "key"))
    links = cut_lineage(_links(texts, nodes, members, words))
    roots = components(links)
    rooted = nodes.join(roots, "node", "left").select("d1", "d2", "least", F.coalesce("root", "node").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("d1", "d2", "component_id")
    found = marked.join(named, ["d1", "d2"], "left").withColumn(
        "component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    )
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def _links(texts: DataFrame, nodes: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """Verified links (a, b) that connect all similar nodes; ``members`` has (key, node, first, rows)."""
    met = members.select("node").distinct()
    wanted = cut_lineage(only_possible(nodes, "node", met, "node", ID_BITS).join(met, "node"))
    possible = only_possible(texts, "doc_id", wanted, "least", ID_BITS)  # few others move
    # Inner joins: semi joins would be moved below the filters. Null-safe, as a set may have null ids only.
    ids = wanted.select("least").distinct()
    chosen = possible.join(ids, F.col("doc_id").eqNullSafe(F.col("least"))).drop("least")
    sets = _full_sets(chosen, words).groupBy("d1", "d2").agg(F.any_value("elements").alias("elements"))
    sets = cut_lineage(sets.join(wanted.select("node", "d1", "d2"), ["d1", "d2"]).select("node", "elements"))

    stars = members.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    first = cut_lineage(_verified(_alike(stars, wanted), sets))
    placed = members.join(components(first), "node", "left").select("key", "node", "rows", F.coalesce("root", "node").alias("root"))
    # The pair of a key with two members has been compared.
    torn = placed.where("rows > 2").groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    rest = cut_lineage(placed.join(torn.select("key"), "key", "left_semi").select("key", "node", "root"))
    if rest.isEmpty():
        return first
    # Roots alike in some key are a cluster, and each node goes to its cluster once with its set.
    sketched = wanted.select("node", "n", "sketch")
    clusters = components(cut_lineage(_across(rest.join(sketched, "node"))))
    clusters = clusters.select(F.col("node").alias("root"), F.col("root").alias("key"))
    gathered = rest.select("node", "root").distinct().join(clusters, "root")
    return first.unionByName(_across(gathered.join(sketched, "node").join(sets, "node")))
