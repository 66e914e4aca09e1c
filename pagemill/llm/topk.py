"""Exact top-k inner products over buckets of vectors of similar length.

Vectors are ordered by length and cut into buckets. A first bucket gives every query a score that its k-th best
reaches at least. Against any other bucket that score is a threshold for the cosine, from the query's length and
the bucket's largest: over 1, the bucket is skipped; high, candidates must lie in a narrow band of the query's
largest coordinates; low, they must be long enough. What is left is multiplied exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import as_batch
from pagemill.session import cut_lineage, scratch

#: Candidates of a bucket and queries of a block.
BUCKET, BLOCK = 4096, 512
#: Bytes of queries that every task gets at a time, and of first buckets that it gets at most.
PASS_BYTES = 32 << 20
#: From this local cosine on, coordinates prune better than lengths; how many of them are looked at.
COORDINATES_FROM, FOCUS = 0.4, 4
SCALE = 256

_BLOCK = "block long, dims int, longest double, least double, ids binary, data binary"
_BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("dims", pa.int32()), ("longest", pa.float64()), ("least", pa.float64()), ("ids", pa.binary()), ("data", pa.binary())])


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, dims, norm, data): floor(256 x) of each component, whole numbers kept as little-endian doubles.

    Rows whose id or vector is null, or whose vector holds a null, NaN or infinite component (256 x counts), are
    left out.
    """
    schema = pa.schema([("vec_id", pa.int64()), ("dims", pa.int32()), ("norm", pa.float64()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for vec_id, vector in zip(batch.column("vec_id").to_pylist(), batch.column("v"), strict=True):
                if vec_id is None or not vector.is_valid or vector.values.null_count:
                    continue
                with np.errstate(over="ignore"):
                    scaled = np.floor(SCALE * vector.values.to_numpy(zero_copy_only=False).astype(np.float64))
                if np.isfinite(scaled).all():
                    rows.append((vec_id, len(scaled), float(_lengths(scaled[None, :])[0]), scaled.astype("<f8").tobytes()))
            if rows:
                yield as_batch(schema, *zip(*rows, strict=True))

    chosen = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return chosen.mapInArrow(run, "vec_id long, dims int, norm double, data binary")


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows in the order of their partition as blocks of one dimension, at most ``size`` rows each.

    ``longest`` is the largest norm; ``least`` the smallest of the column ``need``, if there is one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, []

        def told():
            nonlocal number
            out = as_batch(
                _BLOCK_SCHEMA, [number], [held[0][1]], [max(r[2] for r in held)], [min(r[4] for r in held)],
                [np.array([r[0] for r in held], dtype="<i8").tobytes()], [b"".join([r[3] for r in held])],
            )
            number += 1
            held.clear()
            return out

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "dims", "norm", "data", "need")), strict=True):
                if held and (len(held) == size or held[0][1] != row[1]):
                    yield told()
                held.append(row)
        if held:
            yield told()

    return rows.select("vec_id", "dims", "norm", "data", "need").mapInArrow(run, _BLOCK)


def _matrix(ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, dtype="<i8")
    return ids, np.frombuffer(data, dtype="<f8").reshape(len(ids), -1)


def _lengths(vectors: np.ndarray) -> np.ndarray:
    """Norms, by the largest component so that no square overflows."""
    largest = np.maximum(np.abs(vectors).max(axis=1, initial=0.0), 1e-300)
    return largest * np.sqrt(((vectors / largest[:, None]) ** 2).sum(1))


def _products(candidates: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer products: in floats while no sum can pass 2^53, else in whole numbers of any size.

    One that no 64-bit integer can hold is given as the largest or smallest that one can.
    """
    if not candidates.size:
        return np.zeros(len(candidates), dtype=np.int64)
    largest = float(np.abs(candidates).max()) * float(np.abs(query).max()) * len(query)
    if largest < 2.0**53:
        return (candidates @ query).astype(np.int64)
    whole = [int(x) for x in query.tolist()]
    sums = (sum(int(x) * y for x, y in zip(row, whole)) for row in candidates.tolist())
    return np.array([min(max(x, -(1 << 63)), (1 << 63) - 1) for x in sums], dtype=np.int64)


def search_bucket(query_ids, queries, thresholds, ids, bucket, k) -> list[tuple[int, int, int]]:
    """(query, candidate, score) of each query's k best in the bucket that can reach its threshold."""
    norms, lengths = _lengths(bucket), _lengths(queries)
    longest = norms.max(initial=0.0)
    units = bucket / np.maximum(norms, 1e-300)[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(thresholds > 0, thresholds / (lengths * longest) - 1e-9, -1.0)
    # One way for the whole bucket, from the thresholds its queries have here.
    by_coordinate = bool(np.median(local) >= COORDINATES_FROM)
    out = []
    for query_id, query, length, threshold, cosine in zip(query_ids, queries, lengths, thresholds, local, strict=True):
        if cosine > 1 or (threshold > 0 and length == 0):
            continue
        chosen = np.ones(len(ids), dtype=bool)
        if cosine > 0 and by_coordinate:
            unit = query / length
            for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
                slack = np.sqrt(max(0.0, (1 - cosine**2) * (1 - unit[f] ** 2))) + 1e-9
                chosen &= np.abs(units[:, f] - unit[f] * cosine) <= slack if cosine >= abs(unit[f]) else (
                    units[:, f] * np.sign(unit[f]) >= abs(unit[f]) * cosine - slack
                )
        elif cosine > 0:
            chosen &= norms >= threshold / length * (1 - 1e-9)
        chosen &= ids != query_id
        at = np.nonzero(chosen)[0]
        scores = _products(bucket[at], query)
        best = np.lexsort((ids[at], ~scores))[:k]
        out += [(int(query_id), int(ids[at[b]]), int(scores[b])) for b in best]
    return out


def _search(pairs: DataFrame, k: int) -> DataFrame:
    """Rows with a query block (q_ids, q_data, q_floor) and a bucket (ids, data) to (query_id, vec_id, score)."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q_ids, q_data, q_floor, ids, data in zip(*(batch.column(c).to_pylist() for c in ("q_ids", "q_data", "q_floor", "ids", "data")), strict=True):
                query_ids, queries = _matrix(q_ids, q_data)
                floors = np.frombuffer(q_floor, dtype="<f8") if q_floor else np.full(len(query_ids), -np.inf)
                found = search_bucket(query_ids, queries, floors, *_matrix(ids, data), k)
                if found:
                    yield as_batch(schema, *zip(*found, strict=True))

    return pairs.select("q_ids", "q_data", "q_floor", "ids", "data").mapInArrow(run, "query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest integer inner products, ties to smaller ids.

    ``is_query`` tells queries by the column vec_id. A candidate has another id than the query and as many
    components; fewer than k are all returned. Equal vectors are candidates each for themselves; rows that
    repeat an id are candidates too, and as queries they are one (their best rows). Null and non-finite
    vectors take no part, other columns are ignored, an empty table gives an empty one. Scores are exact; one beyond
    64 bits is given as the nearest that fits. Every pass over the buckets takes up to about PASS_BYTES of queries.
    """
    spark = vectors.sparkSession
    rows = cut_lineage(integer_vectors(vectors, id_col, vector_col)).withColumn("need", F.lit(0.0))
    queries = rows.where(is_query(F.col("vec_id")))
    buckets = max(1, -(-rows.count() // BUCKET))
    ordered = rows.repartitionByRange(buckets, "dims", F.desc("norm"), "vec_id").sortWithinPartitions("dims", F.desc("norm"), "vec_id")
    bucketed = cut_lineage(_blocks(ordered, BUCKET).drop("least"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), buckets)
    floors = cut_lineage(_first_scores(queries, bucketed, tasks, k))

    known = queries.join(floors, queries.vec_id == floors.query_id, "left").select(
        "vec_id", "dims", "norm", "data", F.coalesce(F.col("floor").cast("double"), F.lit(float("-inf"))).alias("floor"),
    ).withColumn("need", F.when(F.col("floor") > 0, F.col("floor") / F.col("norm")).otherwise(0.0))
    n, n_bytes = queries.agg(F.count("*"), F.sum(F.length("data"))).first()
    dealt = known.repartitionByRange(-(-n // BLOCK) or 1, "dims", "need", "vec_id").sortWithinPartitions("dims", "need", "vec_id")
    passes = max(1, -(-(n_bytes or 0) // PASS_BYTES))
    asked = _with_floors(dealt).withColumn("pass", F.floor(F.spark_partition_id() * passes / (-(-n // BLOCK) or 1)).cast("int"))
    asked = cut_lineage(asked)
    # Buckets stay where they are; a bounded part of the queries at a time goes to all of them.
    spread = cut_lineage(bucketed.where("ids is not null").repartition(tasks, "block"))
    folder = scratch(spark, "best")
    for number in range(passes):
        some = F.broadcast(asked.where(F.col("pass") == number).withColumnRenamed("dims", "q_dims"))
        pairs = spread.join(some, (F.col("q_dims") == F.col("dims")) & (F.col("longest") >= F.col("least") * (1 - 1e-9)))
        _best(_search(pairs, k), k).select("query_id", "rank", "vec_id", "score").write.parquet(f"{folder}/pass={number}")
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(f"{folder}/pass=*")


def _first_scores(queries: DataFrame, bucketed: DataFrame, tasks: int, k: int) -> DataFrame:
    """(query_id, floor): the k-th best score of each query in the bucket of its dimension with the longest vectors."""
    first = bucketed.groupBy("dims").agg(F.max("longest").alias("longest"))
    top = bucketed.join(first, ["dims", "longest"]).groupBy("dims").agg(F.min_by(F.struct("ids", "data"), "block").alias("b"))
    seed = cut_lineage(top.select("dims", "b.*"))
    if (seed.agg(F.sum(F.length("data"))).first()[0] or 0) <= PASS_BYTES:
        seed = F.broadcast(seed)
    dealt = queries.repartition(tasks, "vec_id").sortWithinPartitions("dims", "vec_id")
    asked = _blocks(dealt, BLOCK).select("dims", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
    seeded = _search(asked.withColumn("q_floor", F.lit(None).cast("binary")).join(seed, "dims"), k)
    return seeded.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))


def _with_floors(rows: DataFrame) -> DataFrame:
    """Query blocks with their thresholds: dims, least (length a candidate needs), q_ids, q_data, q_floor."""
    schema = pa.schema([("dims", pa.int32()), ("least", pa.float64()), ("q_ids", pa.binary()), ("q_data", pa.binary()), ("q_floor", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def told():
            out = as_batch(
                schema, [held[0][1]], [min(r[3] for r in held)], [np.array([r[0] for r in held], dtype="<i8").tobytes()],
                [b"".join([r[2] for r in held])], [np.array([r[4] for r in held], dtype="<f8").tobytes()],
            )
            held.clear()
            return out

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "dims", "data", "need", "floor")), strict=True):
                if held and (len(held) == BLOCK or held[0][1] != row[1]):
                    yield told()
                held.append(row)
        if held:
            yield told()

    return rows.select("vec_id", "dims", "data", "need", "floor").mapInArrow(run, "dims int, least double, q_ids binary, q_data binary, q_floor binary")
