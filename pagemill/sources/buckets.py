"""Tables kept by run: rows of documents; by hash bucket too: finished chunks, keys of stored records.

A run's rows are a folder of their own, replaced when the run is repeated. Folders do not grow with the
number of documents or files; a batch reads the buckets its own files fall into and no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .paths import path_exists, version_numbers

BUCKETS = 64
#: Bits of a filter, in bitmaps of 32,768: 2 MiB to send, however many keys it is made of.
FILTER_BITS = 1 << 24
KEY_SCHEMA = "key binary"


def file_bucket() -> Column:
    return F.pmod(F.xxhash64("rel_path"), F.lit(BUCKETS)).cast("int")


def write_bucketed(rows: DataFrame, folder: str, run: int) -> None:
    """``rows`` has ``rel_path`` or, if that is not to be kept, ``bucket`` already.

    The hint gathers a bucket's rows into few files and splits one that is huge over several tasks.
    """
    if "bucket" not in rows.columns:
        rows = rows.withColumn("bucket", file_bucket())
    gathered = rows.hint("rebalance", F.col("bucket"))
    gathered.write.partitionBy("bucket").mode("overwrite").parquet(f"{folder}/run={run}")


def read_bucketed(
    spark: SparkSession,
    folder: str,
    schema: str,
    files: DataFrame | None = None,
    but_run: int | None = None,
) -> DataFrame:
    """All runs' rows but one's, in the buckets of the files (any table with ``rel_path``)."""
    if not path_exists(spark, folder):
        return spark.createDataFrame([], schema)
    columns = [c.strip().split(" ")[0] for c in schema.split(",")]
    rows = spark.read.schema(f"{schema}, run long, bucket int").parquet(folder)
    if but_run is not None:
        rows = rows.where(F.col("run") != but_run)
    if files is not None:
        met = files.select(file_bucket().alias("bucket")).distinct().collect()  # BUCKETS at most
        rows = rows.where(F.col("bucket").isin([r["bucket"] for r in met]))
    return rows.select(*columns)


def write_documents(rows: DataFrame, docs: DataFrame, folder: str, format: str = "parquet") -> int:
    """Replace the rows of ``docs`` (one column ``doc``, each once) by ``rows``; other documents keep theirs.

    Rows go to a run of their own, then the list of its documents, which makes it count. A run that broke off
    before its list was written is replaced by the next. A document of the list without rows has none any more.
    """
    numbers = version_numbers(rows.sparkSession, f"{folder}/documents", "run")
    run = (numbers[-1] if numbers else 0) + 1
    # A document's rows come to lie together; one with very many is split over several tasks.
    gathered = rows.hint("rebalance", F.col("doc"))
    gathered.write.mode("overwrite").format(format).save(f"{folder}/rows/run={run}")
    docs.select("doc").write.mode("overwrite").parquet(f"{folder}/documents/run={run}")
    return run


def read_documents(spark: SparkSession, folder: str, schema: str, format: str = "parquet") -> DataFrame:
    """Every document's rows as its last run wrote them; ``schema`` has a column ``doc``."""
    numbers = version_numbers(spark, f"{folder}/documents", "run")
    if not numbers:
        return spark.createDataFrame([], schema)
    kept = f"run <= {numbers[-1]}"
    rows = spark.read.schema(f"{schema}, run long").format(format).load(f"{folder}/rows").where(kept)
    if len(numbers) > 1:
        docs = spark.read.schema("doc string, run long").parquet(f"{folder}/documents")
        last = docs.where(kept).groupBy("doc").agg(F.max("run").alias("run"))
        rows = rows.join(last, ["doc", "run"], "left_semi")
    return rows.drop("run")


def record_key() -> Column:
    """A stored record's key: 256 bits of file, instruction and output, lengths first to keep them apart."""
    lengths = F.concat_ws(":", F.length("rel_path"), F.length("instruction"), F.lit(""))
    return F.unhex(F.sha2(F.concat(lengths, "rel_path", "instruction", "output"), 256))


def write_keys(records: DataFrame, folder: str, run: int) -> None:
    keyed = records.select(record_key().alias("key"), file_bucket().alias("bucket")).distinct()
    write_bucketed(keyed, folder, run)


def exclude_stored(
    records: DataFrame, folder: str, files: DataFrame | None = None, but_run: int | None = None
) -> DataFrame:
    """Records whose key no run but ``but_run`` has stored.

    Of the stored keys only those in the buckets of ``files`` (by default the records' own) are read, and of
    these only those that may be among the records' are shuffled.
    """
    spark = records.sparkSession
    keyed = records.withColumn("key", record_key())
    stored = read_bucketed(spark, folder, KEY_SCHEMA, records if files is None else files, but_run)
    stored = only_possible(stored, "key", keyed, "key").distinct()
    return keyed.join(stored, "key", "left_anti").drop("key")


def only_possible(
    rows: DataFrame, value: str, wanted: DataFrame, wanted_value: str, bits: int = FILTER_BITS
) -> DataFrame:
    """Rows whose value falls on a bit that some wanted value sets: all that match, and few others.

    The bits go to every task as bitmaps of ``bits`` / 8 bytes together whatever the tables' sizes; the more
    values are wanted, the more other rows stay.
    """
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    told = wanted.select(bit(wanted_value).alias("_bit"))
    maps = told.groupBy(F.bitmap_bucket_number("_bit").alias("_map")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_bits")
    )
    placed = rows.withColumn("_map", F.bitmap_bucket_number(bit(value))).withColumn(
        "_at", F.bitmap_bit_position(bit(value))
    )
    byte = F.conv(F.hex(F.expr("substring(_bits, int(_at div 8) + 1, 1)")), 16, 10).cast("int")
    met = placed.join(F.broadcast(maps), "_map").withColumn("_byte", byte)
    return met.where(F.expr("shiftright(_byte, int(_at % 8)) & 1 = 1")).select(*rows.columns)
