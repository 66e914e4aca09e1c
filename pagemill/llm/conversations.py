"""Conversation structure repair: cheapest edits to a legal order of turns, by rank-convergent Viterbi.

Legal are conversations whose role initials read s?(ua)+, and empty ones. A conversation's rows are cut into
chunks; a row is one small number there. Costs run backwards: from the vector of costs that each of
four states has at a chunk's end follows the one at its begin. All chunks start at once from a guess; fix-up
passes then hand every chunk the vector of the chunk behind it and rerun it only until old and new
vectors differ by a constant, from where on all choices are the same. Once no vector changes, the
constants add up to the cost, and each chunk is traced forwards from every state by the least edit that
keeps to the cheapest costs; what the chunks make of states, put one after the other, tells where each begins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from pagemill.session import cut_lineage

#: Rows of a chunk at most, as a power of two.
CHUNK_BITS = 12
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States: nothing yet, after s, after u, after a. The one that a turn of user or assistant leads to from each.
TURN_TO = (2, 2, 3, 2)
#: Costs at the end: what has to be inserted for a legal end.
END = (0, 2 * INSERT, INSERT, 0)
#: Symbols: initial (s, u, a, other), + 4 if the row must go, + 8 if it is truncated.
_GO, _CUT = 4, 8
_WHITE = " \t\n\x0b\x0c\r"
#: A place is 16 times the row's; insertions before a row, the row, and insertions at the very end.
_SLOTS, _ROW_SLOT = 16, 7


class Repair(NamedTuple):
    edits: DataFrame
    summary: DataFrame


@lru_cache(maxsize=1 << 16)
def _before(after: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs before a row from those after it, insertions included."""
    costs = [DELETE + after[s] for s in range(4)]
    if not symbol & _GO:
        cut = TRUNCATED if symbol & _CUT else 0
        initial = symbol & 3
        for s in range(4):
            costs[s] = min(costs[s], REROLE + cut + after[TURN_TO[s]])
            if (to := _kept(s, initial)) is not None:
                costs[s] = min(costs[s], cut + after[to])
    for s in (2, 3, 2, 0, 1):
        costs[s] = min(costs[s], INSERT + costs[TURN_TO[s]])
    return tuple(costs)


def _kept(state: int, initial: int) -> int | None:
    """The state that keeping a row leads to; None if it is not legal there."""
    if initial == 0:
        return 1 if state == 0 else None
    return initial + 1 if initial + 1 == TURN_TO[state] else None


@lru_cache(maxsize=1 << 16)
def _step_back(after: tuple[int, ...], symbol: int) -> tuple[tuple[int, ...], int]:
    costs = _before(after, symbol)
    least = min(costs)
    return tuple(c - least for c in costs), least


@lru_cache(maxsize=1 << 18)
def _step(after: tuple[int, ...], symbol: int, state: int) -> tuple[str, int]:
    """The least of the cheapest edits before and of a row, and the state then."""
    now, edits = _before(after, symbol), ""
    cut = TRUNCATED if symbol & _CUT else 0
    while True:
        if now[state] == DELETE + after[state]:
            return edits + "D", state
        to = TURN_TO[state]
        if now[state] == INSERT + now[to]:
            edits, state = edits + "I", to
            continue
        stays = _kept(state, symbol & 3)
        if not symbol & _GO and stays is not None and now[state] == cut + after[stays]:
            return edits + "K", stays
        return edits + "R", to


def run_back(symbols: list[int], vector: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """(vector before the symbols, least 0, and the constant taken off) from that behind them."""
    total = 0
    for symbol in reversed(symbols):
        vector, least = _step_back(vector, symbol)
        total += least
    return vector, total


def fix_up(symbols: list[int], old: tuple[int, ...], new: tuple[int, ...], before: tuple[int, ...], total: int):
    """As ``run_back`` of ``new``, where ``old`` gave (before, total); and the symbols it took to converge."""
    gap = 0  # of the constants taken off so far, new less old
    for done, symbol in enumerate(reversed(symbols)):
        if old == new:
            return before, total + gap, done
        (old, a), (new, b) = _step_back(old, symbol), _step_back(new, symbol)
        gap += b - a
    return new, total + gap, len(symbols)


def trace(symbols: list[int], vector: tuple[int, ...], state: int, last: bool) -> tuple[list[str], int]:
    """The edits of each symbol from ``state`` on, with ``vector`` behind; one more item of insertions at the end."""
    vectors = [vector]
    for symbol in reversed(symbols[1:]):
        vectors.append(_step_back(vectors[-1], symbol)[0])
    edits = []
    for symbol, after in zip(symbols, reversed(vectors)):
        here, state = _step(after, symbol, state)
        edits.append(here)
    edits.append("")
    while last and END[state]:
        edits[-1] += "I"
        state = TURN_TO[state]
    return edits, state


def _and(df: DataFrame, more: str) -> StructType:
    """The schema of ``df`` and further columns."""
    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])


def _ordered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with text, rows without it by place): ``pos`` grows along each conversation."""
    trimmed = F.expr(f"trim(TRAILING '{_WHITE}' FROM text)")
    rows = conversations.select(
        F.struct(F.col("conv_id")).alias("conv"),  # a struct, so that a null id is a key like any other
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    ).withColumn("text_key", F.sha2("text", 256))
    narrow = rows.select(
        "conv",
        "turn",
        "role",
        "text_key",
        (trimmed == "").alias("blank"),
        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("open"),
    )
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text_key")]
    placed = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    return rows, cut_lineage(placed.withColumn("pos", F.monotonically_increasing_id()))


def _chunks(flagged: DataFrame, chunk_bits: int) -> DataFrame:
    """(conv, chunk, before, behind, pos, symbols): rows by chunk, and the chunks of the conversation beside it.

    A chunk's rows stand one after the other in one range partition, so the next chunk has the next
    number, but for the last in a partition: that of the conversation's next partition follows.
    """
    packed = flagged.groupBy("conv", F.shiftright("pos", chunk_bits).alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "symbol"))).alias("rows")
    )
    packed = packed.select("conv", "chunk", F.expr("rows[0].pos").alias("pos"), F.expr("rows.symbol").alias("symbols"))
    packed = cut_lineage(packed.withColumn("part", F.shiftright("pos", 33)))
    spans = packed.groupBy("conv", "part").agg(F.min("chunk").alias("first"), F.max("chunk").alias("last"))
    along = Window.partitionBy("conv").orderBy("part")  # as many rows as there are partitions at most
    spans = spans.withColumn("from", F.lag("last").over(along)).withColumn("to", F.lead("first").over(along))
    return packed.join(spans, ["conv", "part"]).select(
        "conv",
        "chunk",
        F.when(F.col("chunk") > F.col("first"), F.col("chunk") - 1).otherwise(F.col("from")).alias("before"),
        F.when(F.col("chunk") < F.col("last"), F.col("chunk") + 1).otherwise(F.col("to")).alias("behind"),
        "pos",
        "symbols",
    )


def _passed(chunks: DataFrame) -> DataFrame:
    """Run every chunk whose vector behind it (``given``) is not the one it used, and tell the vector before it."""
    kept = ["conv", "chunk", "before", "behind", "pos", "symbols"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("symbols", "given", "used", "vector", "total"))
            used, vectors, totals = [], [], []
            for symbols, given, old, vector, total in zip(*columns):
                given = tuple(given)
                if old is None:
                    vector, total = run_back(symbols, given)
                elif tuple(old) != given:
                    vector, total, _ = fix_up(symbols, tuple(old), given, tuple(vector), total)
                used.append(given)
                vectors.append(vector)
                totals.append(total)
            told = [pa.array(used, pa.list_(pa.int32())), pa.array(vectors, pa.list_(pa.int32())), pa.array(totals, pa.int64())]
            names = [*kept, "used", "vector", "total"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *told], names=names)

    schema = _and(chunks.select(*kept), "used array<int>, vector array<int>, total bigint")
    return chunks.select(*kept, "given", "used", "vector", "total").mapInArrow(run, schema)


def _costed(chunks: DataFrame) -> DataFrame:
    """Chunks with the vector behind each (``used``), the one before it (``vector``) and their constant (``total``)."""
    end = F.array(*map(F.lit, END)).cast("array<int>")
    none = F.lit(None)
    guess = chunks.select(
        "*", end.alias("given"), none.cast("array<int>").alias("used"), none.cast("array<int>").alias("vector"), none.cast("bigint").alias("total")
    )
    now = cut_lineage(_passed(guess))
    alone = now.where("before is null and behind is null")
    many = cut_lineage(now.where("before is not null or behind is not null"))
    while True:
        told = many.select("conv", F.col("chunk").alias("behind"), F.col("vector").alias("given"))
        met = many.join(told, ["conv", "behind"], "left").withColumn("given", F.coalesce("given", end))
        if met.where("given <> used").isEmpty():
            return alone.unionByName(many)
        many = cut_lineage(_passed(met))


def _traced(costed: DataFrame) -> DataFrame:
    """(conv, place, pos, edit, initial): every edit, ``pos`` that of its row, null for insertions."""
    chunk_columns = ["conv", "chunk", "before", "behind", "pos", "symbols", "used"]

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("symbols", "used"))
            ends = [[trace(s, tuple(v), state, False)[1] for state in range(4)] for s, v in zip(*columns)]
            kept = [batch.column(c) for c in ("conv", "chunk", "before")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(ends, pa.list_(pa.int32()))], names=["conv", "chunk", "before", "exits"])

    many = costed.where("before is not null or behind is not null")
    left = many.select(*chunk_columns).mapInArrow(exits, _and(many.select("conv", "chunk", "before"), "exits array<int>"))
    entries = _entries(cut_lineage(left))
    begun = costed.join(entries, ["conv", "chunk"], "left").withColumn("entry", F.coalesce("entry", F.lit(0)))
    edit_type = pa.list_(pa.struct([("place", pa.int64()), ("pos", pa.int64()), ("edit", pa.string()), ("state", pa.int32())]))

    def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("symbols", "used", "entry", "behind", "pos"))
            found = []
            for symbols, used, state, behind, first in zip(*columns):
                told = []
                for k, steps in enumerate(trace(symbols, tuple(used), state, behind is None)[0]):
                    row = k < len(symbols)
                    pos = first + min(k, len(symbols) - 1)
                    inserted = steps[:-1] if row else steps
                    begin = pos * _SLOTS + (0 if row else _ROW_SLOT + 1)
                    for at in range(len(inserted)):
                        state = TURN_TO[state]
                        told.append((begin + at, None, "I", state))
                    if row:
                        if steps[-1] == "R":
                            state = TURN_TO[state]
                        elif steps[-1] == "K":
                            state = (symbols[k] & 3) + 1
                        told.append((begin + _ROW_SLOT, pos, steps[-1], state))
                found.append([dict(zip(("place", "pos", "edit", "state"), t)) for t in told])
            yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(found, edit_type)], names=["conv", "edits"])

    schema = _and(costed.select("conv"), "edits array<struct<place: bigint, pos: bigint, edit: string, state: int>>")
    told = begun.select("conv", "symbols", "used", "entry", "behind", "pos").mapInArrow(edits, schema)
    return told.select("conv", F.inline("edits"))


def _entries(chunks: DataFrame) -> DataFrame:
    """(conv, chunk, before, exits) to (conv, chunk, entry): the state each chunk begins with.

    Maps of states are put together over stretches that double in length, so a conversation takes as many
    rounds as its number of chunks has bits at most; mostly a map gives one state whatever came before.
    """
    prior = chunks.select("conv", F.col("chunk").alias("before"), F.col("exits").alias("map"))
    known = F.when(F.col("from").isNull(), F.lit(0)).when(F.size(F.array_distinct("map")) == 1, F.col("map")[0])
    now = chunks.select("conv", "chunk", "before").join(prior, ["conv", "before"], "left")
    now = cut_lineage(now.select("conv", "chunk", F.col("before").alias("from"), "map").withColumn("entry", known))
    while not now.where("entry is null").isEmpty():
        earlier = now.select(
            "conv", F.col("chunk").alias("from"), F.col("from").alias("from2"), F.col("map").alias("map2"), F.col("entry").alias("entry2")
        )
        joined = now.join(earlier, ["conv", "from"], "left")
        entry = F.when(F.col("entry").isNull() & F.col("entry2").isNotNull(), F.get("map", F.col("entry2"))).otherwise(F.col("entry"))
        now = joined.select(
            "conv", "chunk", F.col("from2").alias("from"), F.expr("transform(map2, x -> map[x])").alias("map"), entry.alias("entry")
        )
        now = cut_lineage(now.withColumn("entry", F.coalesce("entry", F.when(F.size(F.array_distinct("map")) == 1, F.col("map")[0]))))
    return now.select("conv", "chunk", "entry")


def repair(conversations: DataFrame, chunk_bits: int = CHUNK_BITS) -> Repair:
    """Of (conv_id, turn, role, text): ``edits`` and a ``summary`` of each conversation with rows.

    Rows are taken by turn, nulls first; of equal turns by role, then by the text's digest. A null role or text is
    one space. A row's first fault counts: blank (nothing but ASCII white space), duplicate (role and text of an
    earlier row of the conversation), truncated (last character that is not white space none of ``.!?``).
    Edits: keep (K) 0, change the role to user or assistant (R) 2, delete (D) 3, which blank and duplicate
    rows must be, insert an empty text of user or assistant (I) 2; a truncated row that stays adds 1. The cheapest
    are taken, of these the least in ASCII.

    edits: conv_id, place (grows along the conversation), edit, role, text (both null if deleted). summary:
    conv_id, gaps (turns missing between the least and the greatest), blank, duplicate, truncated, illegal
    (adjacent initials not su, ua or au), cost. A null conv_id is a conversation of its own, repeated rows are
    rows, an empty table gives empty ones, other columns play no part. A conversation of any length is dealt over tasks
    by range; its texts move once, by their digests.
    """
    rows, ordered = _ordered(conversations)
    first = ordered.where("not blank").groupBy("conv", "role", "text_key").agg(F.min("pos").alias("pos"))
    told = ordered.join(first.select("pos", F.lit(True).alias("new")), "pos", "left")
    told = told.withColumn("duplicate", ~F.col("blank") & F.col("new").isNull())
    told = told.withColumn("truncated", ~F.col("blank") & ~F.col("duplicate") & F.col("open"))
    initial = F.expr("case left(role, 1) when 's' then 0 when 'u' then 1 when 'a' then 2 else 3 end")
    must_go = F.col("blank") | F.col("duplicate")
    symbol = initial + F.when(must_go, _GO).otherwise(0) + F.when(F.col("truncated"), _CUT).otherwise(0)
    flagged = cut_lineage(told.select("conv", "turn", "pos", "blank", "duplicate", "truncated", symbol.cast("int").alias("symbol")))

    chunks = cut_lineage(_chunks(flagged, chunk_bits))
    costed = cut_lineage(_costed(chunks))
    edits = cut_lineage(_traced(costed))

    names = ordered.select("pos", "role", "text_key")
    kept = edits.where("edit in ('K', 'R')").join(names, "pos")
    texts = rows.groupBy("conv", "role", "text_key").agg(F.any_value("text").alias("text"))
    turn = F.when(F.col("state") == 2, F.lit("user")).otherwise(F.lit("assistant"))
    new_role = F.when(F.col("edit") == "R", turn).otherwise(F.col("role"))
    staying = kept.join(texts, ["conv", "role", "text_key"]).select("conv", "place", "edit", new_role.alias("role"), "text")
    others = edits.where("edit in ('D', 'I')").select(
        "conv", "place", "edit", F.when(F.col("edit") == "I", turn).alias("role"), F.when(F.col("edit") == "I", F.lit("")).alias("text")
    )
    done = staying.unionByName(others).select("conv.conv_id", "place", "edit", "role", "text")
    return Repair(done, _summary(flagged, costed))


def _summary(flagged: DataFrame, costed: DataFrame) -> DataFrame:
    count = lambda c: F.count_if(c).alias(c)
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counted = flagged.groupBy("conv").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"), count("blank"), count("duplicate"), count("truncated"))
    initials = costed.select("conv", "chunk", "before", "behind", "vector", "total", F.expr("transform(symbols, x -> x & 3)").alias("i"))
    legal = "((x = 0 and y = 1) or (x = 1 and y = 2) or (x = 2 and y = 1))"
    inside = F.expr(f"size(filter(zip_with(slice(i, 1, size(i) - 1), slice(i, 2, size(i)), (x, y) -> {legal}), ok -> not ok))")
    ahead = initials.where("before is not null").select("conv", F.col("chunk").alias("behind"), F.get("i", F.lit(0)).alias("y"))
    edges = initials.join(ahead, ["conv", "behind"], "left").withColumn("x", F.element_at("i", -1))
    between = F.expr(f"if(y is null or {legal}, 0, 1)")
    start = F.when(F.col("before").isNull(), F.col("vector")[0]).otherwise(0)
    costs = edges.groupBy("conv").agg(
        F.sum(inside + between).cast("long").alias("illegal"), F.sum(F.col("total") + start).cast("long").alias("cost")
    )
    return counted.join(costs, "conv").select("conv.conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def digests(edits: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256): edits' initials, and SHA-256 of ``role:text`` lines.

    One pass over sorted rows, in memory for one batch of rows and the audits; a digest is made in order, so a
    conversation's lines pass through one task.
    """
    schema = _and(edits.select("conv_id"), "audit string, repaired_sha256 string")
    own = edits.select(F.struct("conv_id").alias("conv"), "place", "edit", F.concat_ws(":", "role", "text").alias("line"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, audit, state, kind = None, [], None, None

        def told(ready):
            ids, audits, hashes = zip(*ready)
            return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(audits), pa.array(hashes)], names=schema.names)

        for batch in batches:
            ready = []
            column = batch.column("conv").field("conv_id")
            kind = column.type
            for conv, edit, line in zip(column.to_pylist(), batch.column("edit").to_pylist(), batch.column("line").to_pylist()):
                if state is None or conv != current:
                    if state is not None:
                        ready.append((current, "".join(audit), state.hexdigest()))
                    current, audit, state, lines = conv, [], hashlib.sha256(), 0
                audit.append(edit)
                if edit != "D":
                    state.update((b"\n" if lines else b"") + line.encode())
                    lines += 1
            if ready:
                yield told(ready)
        if state is not None:
            yield told([(current, "".join(audit), state.hexdigest())])

    return own.repartition("conv").sortWithinPartitions("conv", "place").mapInArrow(run, schema)
