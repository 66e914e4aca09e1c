"""Accepted records to training text and fixed-length rows."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import split_words, strip
from ..session import cut_lineage

# Ids with a meaning of their own, and default lengths.
PAD_ID = 0
UNKNOWN_ID = 1
FIRST_TOKEN_ID = 2
MAX_LEN = 1024
VOCAB_SIZE = 50_000
# Largest vocabulary held in every task's memory; beyond it ids come from a join.
BROADCAST_VOCAB_ROWS = 1_000_000
# Parts that the rows of one token are dealt to in that join.
SALTS = 64
ROW_NUMBER = "__row"


def render_training_text(qa: DataFrame) -> DataFrame:
    """One ``text`` per record; the input block only where there is input."""

    def stripped(name: str) -> Column:
        return strip(F.coalesce(name, F.lit("")))

    given = stripped("input")
    text = F.concat(
        F.lit("Instruction:\n"),
        stripped("instruction"),
        F.lit("\n"),
        F.when(given != "", F.concat(F.lit("Input:\n"), given, F.lit("\n"))).otherwise(""),
        F.lit("Response:"),
        stripped("output"),
    )
    return qa.withColumn("text", text)


def project_text(rendered: DataFrame) -> DataFrame:
    return rendered.select("text")


def tokens(text: Column) -> Column:
    """Words of the stripped text; blank text has none."""
    bare = strip(text)
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(split_words(bare))


def build_vocab(texts: DataFrame, size: int = VOCAB_SIZE) -> DataFrame:
    """The ``size`` most frequent tokens with ids in order of (count, token).

    Counting combines per task before the shuffle. The counts are sorted by range over all tasks and
    written with each row's place in its task; a token's id is that place plus the rows of the tasks
    before. So no task ever holds the vocabulary, whatever ``size`` is.
    """
    counts = (
        texts.select(F.explode(tokens(F.col("text"))).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )
    # The generated number is the task's number in the upper bits, the row's in the lower 33.
    ordered = counts.orderBy(F.desc("n"), "token").withColumn("at", F.monotonically_increasing_id())
    placed = cut_lineage(ordered).select(
        "token", "n", F.shiftright("at", 33).alias("task"), F.col("at").bitwiseAND((1 << 33) - 1).alias("row")
    )
    # One row for each task of the sort: as many as there are shuffle partitions.
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("task").agg(F.count("*").alias("rows")).select(
        "task", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")
    )
    rank = F.col("start") + F.col("row")
    numbered = placed.join(F.broadcast(starts), "task").where(rank < size)
    return numbered.select("token", "n", (rank + FIRST_TOKEN_ID).cast("int").alias("id")).orderBy("id")


def encode_fixed_length(
    texts: DataFrame, vocab: DataFrame, max_len: int = MAX_LEN, key: list[str] | None = None
) -> DataFrame:
    """Adds input_ids, attention_mask and labels of exactly ``max_len`` ids to every row.

    Tokens past ``max_len`` are cut off, shorter rows are padded. The size of the vocabulary is
    checked: within the bound it goes to every task, where a whole Arrow batch is looked up at once
    and no token is shuffled. A table beyond the bound is joined; ``key`` names the columns that
    identify a row, without it the rows are numbered first.
    """
    entries = vocab.select("token", "id").limit(BROADCAST_VOCAB_ROWS + 1).toArrow()
    if entries.num_rows > BROADCAST_VOCAB_ROWS:
        if key:
            return encode_by_join(texts, vocab, max_len, key)
        numbered = cut_lineage(texts.withColumn(ROW_NUMBER, F.monotonically_increasing_id()))
        return encode_by_join(numbered, vocab, max_len, [ROW_NUMBER]).drop(ROW_NUMBER)
    first = F.slice(tokens(F.col("text")), 1, max_len)
    return _finish(texts.withColumn("ids", _lookup(entries)(first)), max_len)


def _lookup(entries: pa.Table):
    """token lists to id lists, one vectorised lookup per batch."""
    words = entries["token"].combine_chunks()
    ids = entries["id"].combine_chunks()

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def to_ids(batch: pa.Array) -> pa.Array:
        found = pc.index_in(batch.flatten(), value_set=words)
        known = pc.fill_null(pc.take(ids, found), pa.scalar(UNKNOWN_ID, pa.int32()))
        lengths = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
        offsets = pa.array([0, *lengths.cumsum().tolist()], pa.int32())
        return pa.ListArray.from_arrays(offsets, known.cast(pa.int32()))

    return to_ids


def encode_by_join(
    texts: DataFrame, vocab: DataFrame, max_len: int, key: list[str]
) -> DataFrame:
    """The same by a join on the token; a row regroups at most ``max_len`` of them.

    Tokens that every row holds are salted by their row: the vocabulary is repeated for each salt.
    """
    first = F.slice(tokens(F.col("text")), 1, max_len)
    salt = F.pmod(F.xxhash64(*key), F.lit(SALTS)).cast("int").alias("salt")
    exploded = texts.select(*key, salt, F.posexplode(first).alias("at", "token"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    ids = vocab.select("token", F.col("id").alias("token_id"), salts)
    known = exploded.join(ids, ["token", "salt"], "left")
    item = F.struct("at", F.coalesce("token_id", F.lit(UNKNOWN_ID)).alias("id"))
    ids = known.groupBy(*key).agg(
        F.transform(F.sort_array(F.collect_list(item)), lambda t: t["id"]).alias("ids")
    )
    empty = F.array().cast("array<int>")
    rows = texts.join(ids, key, "left").withColumn("ids", F.coalesce("ids", empty))
    return _finish(rows, max_len)


def _finish(rows: DataFrame, max_len: int) -> DataFrame:
    padded = F.slice(
        F.concat("ids", F.array_repeat(F.lit(PAD_ID), max_len)), 1, max_len
    ).alias("input_ids")
    rest = [c for c in rows.columns if c not in ("ids", "text")]
    return add_labels(rows.select(*rest, padded, attention_mask(F.size("ids"), max_len)))


def attention_mask(n: Column, max_len: int) -> Column:
    """1 for each of the ``n`` real tokens, 0 for padding."""
    return F.concat(
        F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), max_len - n)
    ).alias("attention_mask")


def add_labels(encoded: DataFrame) -> DataFrame:
    """Labels equal the ids, padding included."""
    return encoded.withColumn("labels", F.col("input_ids"))


def input_files_check(files: DataFrame) -> int:
    """Number of input files in a listing; none is an error."""
    n = files.count()
    if n == 0:
        raise FileNotFoundError("no input files found")
    return n
