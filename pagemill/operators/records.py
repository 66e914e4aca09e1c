"""Deduplication, retry acceptance, progress and failure reports over records and responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.replies import FIELDS, elements
from ..session import cut_lineage, scratch
from .chunks import resume_filter
from .replies import REPLY_KEY

MAX_RETRIES = 3
#: Rounds before chains are followed, and the most attempts of a chunk for which they are: one bit each.
PLAIN_ROUNDS = 2
MOST_MAPPED = 62
RECORD_KEY = ["instruction", "output"]
RECORD_COLUMNS = [*REPLY_KEY, "pos", *FIELDS]


def _first_per_key(records: DataFrame, keys: list[str]) -> DataFrame:
    """First record per key in reply order.

    An aggregate combines copies before the shuffle, so a key that holds a third of all rows costs
    one row per task; a window would sort them all in one.
    """
    rest = [c for c in RECORD_COLUMNS if c not in keys]
    order = [c for c in ["rel_path", "chunk_index", "attempt", "pos"] if c not in keys]
    payload = F.struct(*order, *[c for c in rest if c not in order])
    first = records.groupBy(*keys).agg(F.min(payload).alias("first"))
    return first.select(
        *[F.col(c) if c in keys else F.col(f"first.{c}").alias(c) for c in RECORD_COLUMNS]
    )


def dedup_within_file(records: DataFrame) -> DataFrame:
    """First record per (instruction, output) in each file; ``input`` is not part of the key."""
    return _first_per_key(records, ["rel_path", *RECORD_KEY])


def dedup_global(records: DataFrame) -> DataFrame:
    """First record per (instruction, output) over the whole run."""
    return _first_per_key(records, RECORD_KEY)


def exclude_existing(records: DataFrame, existing: DataFrame) -> DataFrame:
    """Drop records whose key the file already holds."""
    keys = ["rel_path", *RECORD_KEY]
    return records.join(existing.select(*keys).distinct(), keys, "left_anti")


def first_parsed_attempt(parsed: DataFrame) -> DataFrame:
    """Per chunk the first attempt with a non-empty list; its items unchecked and with repeats."""
    usable = F.when(F.col("items").isNotNull(), F.col("attempt"))
    first = parsed.groupBy("rel_path", "chunk_index").agg(
        F.min_by(F.struct("attempt", "items"), usable).alias("first")
    )
    return first.select(
        "rel_path",
        "chunk_index",
        "first.attempt",
        F.posexplode(elements(F.col("first.items"))).alias("i", "item"),
    ).select(*REPLY_KEY, (F.col("i") + 1).cast("int").alias("pos"), "item")


def accept_attempts(
    records: DataFrame,
    existing: DataFrame | None = None,
    max_retries: int = MAX_RETRIES,
    scope: str = "file",
) -> DataFrame:
    """Records kept when chunks are tried in order and each stops at its first useful attempt.

    An attempt is useful if it has a valid record whose key nothing kept before it has: no earlier
    chunk's accepted attempt and no ``existing`` row, within the file or (``scope="run"``) the
    whole run. Its new records are kept; the chunk's later attempts are ignored.

    Which attempt a chunk ends with depends on the chunks before it. Instead of walking a file in
    one task, all chunks are settled side by side in rounds over narrow (scope, place, attempt,
    key) rows. In a round, with keys already seen dropped, a chunk settles on its earliest attempt
    left if that is its last one, or if it holds a key no earlier unsettled chunk might bring. At
    least the first unsettled chunk of every scope does, and usually nearly all do. From the third
    round on, a chunk whose choice hangs on one earlier chunk alone is a map from that one's choice to
    its own; maps along a chain are joined end to end over stretches that double, so a chain settles in as
    many steps as its length has bits. Only the rows of unsettled chunks, a shrinking set, go on
    to the next round.
    """
    records = records.where(F.col("attempt") <= max_retries)
    if existing is not None:
        keys = RECORD_KEY if scope == "run" else ["rel_path", *RECORD_KEY]
        records = records.join(existing.select(*keys).distinct(), keys, "left_anti")
    # Read in every round's first steps and at the end; written once, so replies are parsed once.
    records = cut_lineage(records.select(*RECORD_COLUMNS))

    in_file = scope != "run"
    place = F.col("chunk_index") if in_file else F.struct("rel_path", "chunk_index")
    scope_id = F.col("rel_path") if in_file else F.lit("")
    rows = records.select(
        scope_id.alias("scope"), place.alias("place"), "attempt", _key_hash().alias("key")
    )

    decided = _settle_all(rows, max_retries)
    kept = (
        records.withColumn("scope", scope_id)
        .withColumn("place", place)
        .join(decided, ["scope", "place", "attempt"], "left_semi")
        .drop("scope", "place")
    )
    return dedup_within_file(kept) if in_file else dedup_global(kept)


def _settle_all(rows: DataFrame, max_retries: int) -> DataFrame:
    """(scope, place, attempt, key) to the attempt each chunk ends with. A round's chunks are a folder of one table."""
    spark = rows.sparkSession
    folder = scratch(spark, "rounds")
    number = 0
    while True:
        chunks = _settle(rows)
        if number >= PLAIN_ROUNDS and max_retries <= MOST_MAPPED:
            chunks = _follow(rows, cut_lineage(chunks), max_retries)
        chunks = chunks.select("scope", "place", F.col("current").alias("attempt"), "settled")
        schema = chunks.schema
        chunks.write.parquet(f"{folder}/round={number}")
        chunks = spark.read.schema(schema).parquet(f"{folder}/round={number}")
        settled = chunks.where("settled").select("scope", "place", "attempt")
        unsettled = chunks.where("not settled").select("scope", "place")
        if unsettled.isEmpty():
            rounds = spark.read.schema(schema).parquet(folder)
            return rounds.where("settled").select("scope", "place", "attempt")
        number += 1
        waiting = rows.join(unsettled, ["scope", "place"], "left_semi")
        chosen = rows.join(settled, ["scope", "place", "attempt"], "left_semi")
        seen = chosen.groupBy("scope", "key").agg(F.min("place").alias("seen_at"))
        rows = cut_lineage(
            waiting.join(seen, ["scope", "key"], "left")
            .where(F.col("seen_at").isNull() | (F.col("seen_at") >= F.col("place")))
            .select("scope", "place", "attempt", "key")
        )


def _follow(rows: DataFrame, chunks: DataFrame, max_retries: int) -> DataFrame:
    """Settle chunks whose choice depends, chunk after chunk, on one that has settled in this round."""
    known = chunks.where("settled").select("scope", F.col("place").alias("on"), F.col("current").alias("theirs"))
    links = _links(rows, chunks, max_retries).join(known, ["scope", "on"], "left")
    links = cut_lineage(links.withColumn("choice", F.get("map", F.col("theirs"))).drop("theirs"))
    while True:
        hopped = cut_lineage(_hop(links))
        links = hopped.drop("moved")
        if hopped.where("moved").isEmpty():
            break
    found = links.where("choice is not null").select("scope", "place", "choice")
    return chunks.join(found, ["scope", "place"], "left").select(
        "scope",
        "place",
        F.coalesce("choice", "current").alias("current"),
        (F.col("settled") | F.col("choice").isNotNull()).alias("settled"),
    )


def _links(rows: DataFrame, chunks: DataFrame, max_retries: int) -> DataFrame:
    """(scope, place, on, map): unsettled chunks that hang on the choice of one earlier chunk, ``on``.

    ``map`` has the chunk's own attempt at the index of the other's. Before the attempt it takes at the latest,
    all its keys may come from earlier chunks; here from one. An attempt is useless if the other's
    choice holds all keys of it. A key with two earlier holders makes its chunk wait.
    """
    holders = rows.groupBy("scope", "key", "place").agg(
        F.bit_or(F.expr("shiftleft(1L, attempt)")).alias("attempts")
    )
    first = holders.groupBy("scope", "key").agg(F.min(F.struct("place", "attempts")).alias("first"))
    second = (
        holders.join(first, ["scope", "key"])
        .where(F.col("place") > F.col("first.place"))
        .groupBy("scope", "key")
        .agg(F.min("place").alias("second"))
    )
    waits = chunks.where("not settled").select(
        "scope", "place", F.coalesce("brings_new", "last").alias("latest")
    )
    told = (
        rows.join(waits, ["scope", "place"])
        .where(F.col("attempt") < F.col("latest"))
        .join(first, ["scope", "key"])
        .join(second, ["scope", "key"])
    )
    tries = told.groupBy("scope", "place", "attempt", "latest").agg(
        F.bit_and("first.attempts").alias("useless_after"),
        F.min("first.place").alias("on"),
        F.max("first.place").alias("other"),
        F.bool_or(F.col("second") < F.col("place")).alias("several"),
    )
    hung = tries.groupBy("scope", "place", "latest").agg(
        F.sort_array(F.collect_list(F.struct("attempt", "useless_after"))).alias("tries"),
        F.min("on").alias("on"),
        F.max("other").alias("other"),
        F.bool_or("several").alias("several"),
    )
    useful = "filter(tries, t -> shiftright(t.useless_after, c) & 1 = 0)"
    mapped = F.expr(f"transform(sequence(0, {max_retries}), c -> coalesce(get({useful}, 0).attempt, latest))")
    return hung.where((F.col("on") == F.col("other")) & ~F.col("several")).select(
        "scope", "place", "on", mapped.alias("map")
    )


def _hop(links: DataFrame) -> DataFrame:
    """Links that skip the chunk they hang on: over twice the stretch, or settled; ``moved`` tells which did."""
    ahead = links.select(
        "scope",
        F.col("place").alias("on"),
        F.col("on").alias("further"),
        F.col("map").alias("inner"),
        F.col("choice").alias("theirs"),
    )
    open_ = F.col("choice").isNull() & F.col("inner").isNotNull()
    return links.join(ahead, ["scope", "on"], "left").select(
        "scope",
        "place",
        F.when(open_, F.col("further")).otherwise(F.col("on")).alias("on"),
        F.when(open_, F.expr("transform(inner, c -> map[c])")).otherwise(F.col("map")).alias("map"),
        F.coalesce("choice", F.get("map", F.col("theirs"))).alias("choice"),
        open_.alias("moved"),
    )


def _key_hash() -> Column:
    """A record's key as a 256-bit digest of its two fields, lengths first to keep them apart."""
    length = F.length("instruction").cast("string")
    return F.unhex(
        F.sha2(F.concat(length, F.lit(":"), F.col("instruction"), F.col("output")), 256)
    )


def _settle(rows: DataFrame) -> DataFrame:
    """Per chunk the attempt it is at and whether it settles on it.

    Only aggregates, each combined before its shuffle: a key's first place and the first attempt
    there that holds it, then per chunk its first attempt, its last, and the first with such a key.
    """
    if rows.schema["place"].dataType == T.IntegerType():
        # Packed into one number, which a hash aggregate can keep; a struct would be sorted.
        packed = F.shiftleft(F.col("place").cast("long"), 32) + F.col("attempt")
        first_place = F.shiftright("first", 32).cast("int")
        first_attempt = F.col("first").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    else:
        packed = F.struct("place", "attempt")
        first_place, first_attempt = F.col("first.place"), F.col("first.attempt")
    firsts = rows.groupBy("scope", "key").agg(F.min(packed).alias("first"))
    nothing = F.lit(None).cast("int")
    tries = rows.select("scope", "place", "attempt", nothing.alias("brings_new"))
    news = firsts.select(
        "scope",
        first_place.alias("place"),
        nothing.alias("attempt"),
        first_attempt.alias("brings_new"),
    )
    chunks = tries.unionByName(news).groupBy("scope", "place").agg(
        F.min("attempt").alias("current"),
        F.max("attempt").alias("last"),
        F.min("brings_new").alias("brings_new"),
    )
    settled = (F.col("current") == F.col("last")) | F.coalesce(
        F.col("brings_new") == F.col("current"), F.lit(False)
    )
    return chunks.select("scope", "place", "current", "last", "brings_new", settled.alias("settled"))


def accepted_chunks(accepted: DataFrame) -> DataFrame:
    """Chunks that kept a record, and the attempt that did it."""
    return accepted.groupBy("rel_path", "chunk_index").agg(F.min("attempt").alias("accepted"))


def advance_progress(
    progress: DataFrame, accepted: DataFrame, small: DataFrame | None = None
) -> DataFrame:
    """New high-water mark per file: the highest chunk accepted or too small, never below the old.

    A chunk that failed all its attempts is passed over once a later one succeeds.
    """
    marks = progress.select("rel_path", "done").unionByName(
        accepted.select("rel_path", F.col("chunk_index").alias("done"))
    )
    if small is not None:
        marks = marks.unionByName(small.select("rel_path", F.col("chunk_index").alias("done")))
    return marks.groupBy("rel_path").agg(F.max("done").alias("done"))


def completed_chunks(accepted: DataFrame, small: DataFrame | None = None) -> DataFrame:
    """Finished (rel_path, chunk_index) pairs, for ``resume_failed``."""
    pairs = accepted.select("rel_path", "chunk_index")
    if small is not None:
        pairs = pairs.unionByName(small.select("rel_path", "chunk_index"))
    return pairs.distinct()


def classify_failures(
    checked: DataFrame,
    accepted: DataFrame,
    small: DataFrame | None = None,
    progress: DataFrame | None = None,
    max_retries: int = MAX_RETRIES,
) -> DataFrame:
    """Why attempts failed: every attempt before the accepted one, or all of a chunk's if none was.

    ``checked`` is the output of ``check_replies`` and ``accepted`` that of ``accept_attempts`` on the
    same replies. Chunks up to a file's ``done`` were not asked
    again and are left out.
    """
    tried = checked.where(F.col("attempt") <= max_retries)
    if progress is not None:
        tried = resume_filter(tried, progress)
    failed = tried.join(accepted_chunks(accepted), ["rel_path", "chunk_index"], "left").where(
        F.col("accepted").isNull() | (F.col("attempt") < F.col("accepted"))
    )
    reason = (
        F.when(F.col("http_error").isNotNull(), F.lit("http_error"))
        .when(~F.col("has_list"), F.lit("no_json"))
        .otherwise(F.lit("no_valid_objects"))
    )
    failures = failed.select(
        *REPLY_KEY, reason.alias("reason"), F.col("http_error").alias("detail")
    )
    if small is not None:
        failures = failures.unionByName(
            small.select(
                "rel_path",
                "chunk_index",
                F.lit(None).cast("int").alias("attempt"),
                F.lit("too_small").alias("reason"),
                F.lit(None).cast("string").alias("detail"),
            )
        )
    return failures


def failure_counts(failures: DataFrame) -> DataFrame:
    return failures.groupBy("reason").agg(F.count("*").alias("n"))


def pair_counts(records: DataFrame) -> DataFrame:
    """Pairs per file, and over all files in the row whose ``rel_path`` is null."""
    return records.rollup("rel_path").agg(F.count("*").alias("pairs"))
