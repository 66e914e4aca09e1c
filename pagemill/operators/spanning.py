"""Sectioning for documents too long to gather into one row.

``volumes``: doc STRING, volume INT, text STRING; a document's text is its volumes joined by a
blank line. Text is only ever grouped by volume, by section or by part. What has to be known about
a whole document travels in narrow rows of numbers, windowed by document. Results that several
branches read are written once to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import (
    BARE_NUMBER,
    cut_fixed,
    heading_number,
    heading_pieces,
    heading_title,
    is_blank,
    lstrip,
    piece_text,
    rstrip,
    section_name,
    strip,
    word_count,
)
from ..session import cut_lineage
from .pages import PAGE_BREAK


def _joined(order: str, text: str, glue: str = PAGE_BREAK) -> Column:
    ordered = F.sort_array(F.collect_list(F.struct(order, text)))
    return F.array_join(F.transform(ordered, lambda r: r[text]), glue)


def _before(order: str) -> Window:
    return Window.partitionBy("doc").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _with_loose_end(volumes: DataFrame) -> DataFrame:
    """Split off the lines at a volume's end that a heading may still be forming in.

    A number alone on its line takes the next non-blank line as its title, and that line may be
    in a later volume. So a run of such lines at the end (or a volume without other text) is the
    loose end; ``body`` is null where nothing else is there.
    """
    last_line = F.substring_index(strip(F.col("text")), "\n", -1)
    open_ended = is_blank(F.col("text")) | last_line.rlike(BARE_NUMBER)
    lines = F.split("text", "\n")
    settled = F.array_max(
        F.transform(
            lines, lambda line, i: F.when(~is_blank(line) & ~line.rlike(BARE_NUMBER), i + 1)
        )
    )
    cut = volumes.select(
        "doc",
        "volume",
        "text",
        F.when(open_ended, settled).alias("settled"),
        open_ended.alias("open_ended"),
    )
    body = F.array_join(F.slice(lines, F.lit(1), F.col("settled")), "\n")
    rest = F.array_join(F.slice(lines, F.col("settled") + 1, F.size(lines)), "\n")
    return cut.select(
        "doc",
        "volume",
        F.when(~F.col("open_ended"), F.col("text"))
        .when(F.col("settled").isNotNull(), body)
        .alias("body"),
        F.when(F.col("open_ended") & F.col("settled").isNull(), F.col("text"))
        .when(F.col("open_ended"), F.concat(F.lit("\n"), rest))
        .alias("loose"),
    )


def _settled_volumes(volumes: DataFrame) -> DataFrame:
    """Volumes with every loose end moved on to the next volume that has other text.

    After this no heading crosses a volume's end, so each volume can be cut by itself.
    """
    cut = _with_loose_end(volumes)
    later = Window.partitionBy("doc").orderBy(F.desc("volume"))
    later = later.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("doc")
    holder = F.when(F.col("body").isNotNull(), F.col("volume"))
    marks = cut.select(
        "doc", "volume", holder.alias("holder"), F.col("loose").isNotNull().alias("has_loose")
    )
    targets = marks.select(
        "doc",
        "volume",
        "has_loose",
        F.coalesce(
            F.min("holder").over(later), F.max("holder").over(whole), F.max("volume").over(whole)
        ).alias("target"),
    ).where("has_loose")
    moved = (
        cut.where(F.col("loose").isNotNull())
        .join(targets, ["doc", "volume"])
        .groupBy("doc", F.col("target").alias("volume"))
        .agg(
            F.sort_array(
                F.collect_list(F.struct(F.col("volume").alias("from_volume"), F.col("loose")))
            ).alias("ends")
        )
    )

    def ends(keep) -> Column:
        return F.transform(F.filter("ends", keep), lambda e: e["loose"])

    joined = cut.join(moved, ["doc", "volume"], "left")
    front = ends(lambda e: e["from_volume"] < F.col("volume"))
    own = ends(lambda e: e["from_volume"] == F.col("volume"))
    back = ends(lambda e: e["from_volume"] > F.col("volume"))
    # Only a body's own loose end follows it directly: it still starts with its line break.
    middle = F.concat(F.coalesce("body", F.lit("")), F.coalesce(F.array_join(own, ""), F.lit("")))
    parts = F.when(F.col("ends").isNull(), F.array("body")).otherwise(
        F.concat(
            front,
            F.when(
                F.col("body").isNotNull() | (F.size(own) > 0), F.array(middle)
            ).otherwise(F.array().cast("array<string>")),
            back,
        )
    )
    return (
        joined.where(F.col("body").isNotNull() | F.col("ends").isNotNull())
        .select("doc", "volume", F.array_join(parts, PAGE_BREAK).alias("text"))
    )


def heading_rows(volumes: DataFrame) -> DataFrame:
    """(doc, seq, piece): a document's headings with what follows each up to the next.

    Text before a volume's first heading continues an earlier piece.
    """
    pieces = cut_lineage(
        _settled_volumes(volumes).select(
            "doc", "volume", heading_pieces(F.col("text")).alias("pieces")
        )
    )
    counts = pieces.select("doc", "volume", (F.size("pieces") - 1).alias("n"))
    places = counts.select(
        "doc",
        "volume",
        F.coalesce(F.sum("n").over(_before("volume")), F.lit(0)).alias("base"),
        F.max(F.when(F.col("n") > 0, F.col("volume"))).over(_before("volume")).alias("owner"),
    )
    placed = pieces.join(places, ["doc", "volume"])
    continued = (
        placed.where(F.col("owner").isNotNull())
        .select("doc", "owner", "volume", F.element_at("pieces", 1).alias("more"))
        .groupBy("doc", F.col("owner").alias("volume"))
        .agg(_joined("volume", "more").alias("more"))
    )
    n = F.size("pieces")
    last = F.concat(F.element_at("pieces", -1), F.lit(PAGE_BREAK), F.col("more"))
    completed = F.when(F.col("more").isNull(), F.slice("pieces", F.lit(2), n - 1)).otherwise(
        F.concat(F.slice("pieces", F.lit(2), n - 2), F.array(last))
    )
    rows = (
        placed.where(n > 1)
        .join(continued, ["doc", "volume"], "left")
        .select("doc", "base", F.posexplode(completed).alias("i", "piece"))
    )
    return rows.select("doc", (F.col("base") + F.col("i") + 1).cast("int").alias("seq"), "piece")


def _heading_sections(volumes: DataFrame) -> DataFrame:
    content = piece_text(F.col("piece"))
    return heading_rows(volumes).select(
        "doc",
        "seq",
        F.lit("heading").alias("kind"),
        section_name(heading_number(F.col("piece")), heading_title(F.col("piece"))).alias("title"),
        strip(content).alias("content"),
        word_count(content).alias("words"),
    )


def _fixed_parts(
    pieces: DataFrame, part_size: int, min_words: int, skipped: DataFrame | None = None
) -> DataFrame:
    """Cut a document given as ordered ``pieces`` (doc, ord, text) every ``part_size`` code points.

    Each piece learns from running lengths where it lies in the stripped whole and cuts itself at
    the part boundaries; fragments of one part are then put together. Documents in ``skipped`` are
    left out; only the narrow rows are joined by document.
    """
    length = F.length("text")
    blank = is_blank(F.col("text"))
    sizes = pieces.select(
        "doc",
        "ord",
        length.cast("long").alias("len"),
        F.when(~blank, length - F.length(lstrip(F.col("text")))).alias("first"),
        F.when(~blank, F.length(rstrip(F.col("text")))).alias("end"),
    )
    if skipped is not None:
        sizes = sizes.join(skipped, "doc", "left_anti")
    gap = len(PAGE_BREAK)
    placed = sizes.withColumn(
        "at", F.coalesce(F.sum(F.col("len") + gap).over(_before("ord")), F.lit(0).cast("long"))
    )
    bounds = placed.groupBy("doc").agg(
        F.min(F.col("at") + F.col("first")).alias("start"),
        F.max(F.col("at") + F.col("end")).alias("stop"),
    )
    spans = (
        placed.join(bounds, "doc")
        .withColumn("lo", F.greatest("at", "start"))
        .withColumn("hi", F.least(F.col("at") + F.col("len") + gap, F.col("stop")))
        .where(F.col("lo") < F.col("hi"))
        .select("doc", "ord", "at", "lo", "hi", (F.col("lo") - F.col("start")).alias("from"))
    )
    text = F.substring(
        F.concat("text", F.lit(PAGE_BREAK)),
        (F.col("lo") - F.col("at") + 1).cast("int"),
        (F.col("hi") - F.col("lo")).cast("int"),
    )
    inside = pieces.join(spans, ["doc", "ord"]).select("doc", "ord", "from", text.alias("text"))
    # Code points until the next part boundary, then whole parts.
    room = (part_size - F.col("from") % part_size).cast("int")
    cuts = F.concat(
        F.array(F.substring(F.col("text"), F.lit(1), room)),
        cut_fixed(F.substring(F.col("text"), room + 1, F.length("text")), part_size),
    )
    fragments = inside.select(
        "doc", "ord", F.floor(F.col("from") / part_size).alias("k0"), F.posexplode(cuts)
    ).select("doc", (F.col("k0") + F.col("pos")).cast("int").alias("k"), "ord", F.col("col").alias("text"))
    parts = fragments.groupBy("doc", "k").agg(strip(_joined("ord", "text", "")).alias("content"))
    return parts.withColumn("words", word_count(F.col("content"))).where(F.col("words") >= min_words)


def spanning_sections(volumes: DataFrame, min_words: int, part_size: int) -> DataFrame:
    """Sections by heading, or by size for documents without one; already written, to be reread."""
    volumes = cut_lineage(volumes)
    by_heading = cut_lineage(_heading_sections(volumes))
    with_headings = by_heading.select("doc").distinct()
    pieces = volumes.select("doc", F.col("volume").alias("ord"), "text")
    by_size = _fixed_parts(pieces, part_size, min_words, skipped=with_headings).select(
        "doc",
        (F.col("k") + 1).alias("seq"),
        F.lit("part").alias("kind"),
        F.format_string("part_%03d", F.col("k") + 1).alias("title"),
        "content",
        "words",
    )
    return by_heading.unionByName(cut_lineage(by_size))


def merge_short_spanning(short: DataFrame, min_words: int, part_size: int) -> DataFrame:
    """Short sections of a document joined, cut anew and numbered without gaps."""
    pieces = short.select("doc", F.col("seq").alias("ord"), F.col("content").alias("text"))
    parts = cut_lineage(_fixed_parts(pieces, part_size, min_words))
    numbers = parts.select(
        "doc", "k", F.row_number().over(Window.partitionBy("doc").orderBy("k")).alias("seq")
    )
    return parts.join(numbers, ["doc", "k"]).select(
        "doc",
        "seq",
        F.lit("merged_part").alias("kind"),
        F.format_string("merged_part_%03d", F.col("seq")).alias("title"),
        "content",
        "words",
    )
