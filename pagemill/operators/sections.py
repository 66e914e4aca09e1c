"""Documents to sections.

``sections``: doc STRING, seq INT, kind STRING (heading, part, merged_part), title STRING,
content STRING, words INT. ``texts``: doc STRING, text STRING, one row per document.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    bind,
    clean_body,
    cut_fixed,
    heading_number,
    heading_pieces,
    heading_title,
    is_blank,
    piece_text,
    section_name,
    section_name_v0,
    strip,
    word_count,
)
from ..session import cut_lineage
from .pages import (
    VOLUME_PAGES,
    blank_documents,
    empty_pages,
    full_text,
    part_by_length,
    small_documents,
)
from .spanning import heading_rows, merge_short_spanning, spanning_sections

MIN_WORDS = 100
PART_SIZE = 4000
SECTION_COLUMNS = ["doc", "seq", "kind", "title", "content", "words"]


def _section(seq: Column, kind: str, title: Column, content: Column) -> Column:
    return F.struct(
        seq.cast("int").alias("seq"),
        F.lit(kind).alias("kind"),
        title.alias("title"),
        strip(content).alias("content"),
        word_count(content).alias("words"),
    )


def _heading(piece: Column, i: Column) -> Column:
    name = section_name(heading_number(piece), heading_title(piece))
    return _section(i + 1, "heading", name, piece_text(piece))


def _numbered_part(part: Column, i: Column) -> Column:
    return _section(i + 1, "part", F.format_string("part_%03d", i + 1), part)


def _long_enough(min_words: int):
    return lambda s: s["words"] >= min_words


def _parts(text: Column, part_size: int, min_words: int) -> Column:
    """Fixed-size parts of a text, numbered before the short ones are left out."""
    parts = F.transform(cut_fixed(strip(text), part_size), _numbered_part)
    return F.filter(parts, _long_enough(min_words))


def _after_preamble(pieces: Column) -> Column:
    return F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))


def _headings(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc",
        "seq",
        heading_number(F.col("piece")).alias("number"),
        heading_title(F.col("piece")).alias("raw_title"),
        strip(piece_text(F.col("piece"))).alias("content"),
    )


def split_headings(texts: DataFrame) -> DataFrame:
    """One row per numbered heading: number, title as written, text up to the next heading."""
    pieces = texts.select("doc", heading_pieces(F.col("text")).alias("pieces"))
    placed = pieces.select("doc", F.posexplode(_after_preamble(F.col("pieces"))).alias("i", "piece"))
    return _headings(placed.select("doc", (F.col("i") + 1).cast("int").alias("seq"), "piece"))


def _texts_and_volumes(pages: DataFrame, volume_pages: int) -> tuple[DataFrame, DataFrame | None]:
    """Whole texts of documents of one volume, and the volumes of longer ones, written, or None."""
    small_pages, long_pages = part_by_length(pages, volume_pages)
    texts = full_text(small_pages, volume_pages).select("doc", "text")
    return texts, None if long_pages is None else cut_lineage(full_text(long_pages, volume_pages))


def document_headings(pages: DataFrame, volume_pages: int = VOLUME_PAGES) -> DataFrame:
    """``split_headings`` of documents of any length, from their pages; a long one is never gathered."""
    texts, volumes = _texts_and_volumes(pages, volume_pages)
    found = split_headings(texts)
    return found if volumes is None else found.unionByName(_headings(heading_rows(volumes)))


def documents_without_headings(pages: DataFrame, volume_pages: int = VOLUME_PAGES) -> DataFrame:
    """``without_headings`` of documents of any length."""
    texts, volumes = _texts_and_volumes(pages, volume_pages)
    found = without_headings(texts)
    if volumes is None:
        return found
    with_headings = heading_rows(volumes).select("doc").distinct()
    return found.unionByName(volumes.select("doc").distinct().join(with_headings, "doc", "left_anti"))


def section_titles(headings: DataFrame) -> DataFrame:
    return headings.withColumn("title", section_name(F.col("number"), F.col("raw_title")))


def early_sections(headings: DataFrame) -> DataFrame:
    """The early splitter: its own title and body clean-up and no minimum length."""
    return headings.select(
        "doc",
        "seq",
        section_name_v0(F.col("number"), F.col("raw_title")).alias("title"),
        clean_body(F.col("content")).alias("content"),
    )


def without_headings(texts: DataFrame) -> DataFrame:
    """Documents without any heading, which the early splitter rejects."""
    return texts.where(F.size(heading_pieces(F.col("text"))) == 1).select("doc")


def fixed_parts(
    texts: DataFrame, part_size: int = PART_SIZE, min_words: int = MIN_WORDS
) -> DataFrame:
    parts = _parts(F.col("text"), part_size, min_words)
    return texts.select("doc", F.inline(parts))


def _routed(texts: DataFrame, min_words: int, part_size: int) -> DataFrame:
    """Replaces ``text`` by ``found``, an array of sections: by heading if any, else by size."""
    rest = [c for c in texts.columns if c != "text"]
    pieces = texts.select(*rest, "text", heading_pieces(F.col("text")).alias("pieces"))
    has_headings = F.size("pieces") > 1
    by_heading = F.transform(_after_preamble(F.col("pieces")), _heading)
    by_size = _parts(F.col("text"), part_size, min_words)
    return pieces.select(
        *rest,
        is_blank(F.col("text")).alias("blank"),
        has_headings.alias("has_headings"),
        F.when(has_headings, by_heading).otherwise(by_size).alias("found"),
    )


def _rows(routed: DataFrame) -> DataFrame:
    # The outer form keeps the optimizer from deriving a filter that would split a second time.
    rows = routed.select("doc", F.inline_outer("found"))
    return rows.where(F.col("seq").isNotNull())


def routed_sections(
    texts: DataFrame, min_words: int = MIN_WORDS, part_size: int = PART_SIZE
) -> DataFrame:
    """Sections of each document by heading, or by size where it has no heading."""
    return _rows(_routed(texts, min_words, part_size))


def short_sections(sections: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    return sections.where(F.col("words") < min_words)


def long_sections(sections: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    return sections.where(F.col("words") >= min_words)


def _merged(short: Column, part_size: int, min_words: int) -> Column:
    """Short sections of one document joined and cut anew, numbered without gaps."""
    joined = F.array_join(F.transform(short, lambda s: s["content"]), "\n\n")
    return F.transform(
        _parts(joined, part_size, min_words),
        lambda s, i: s.withField("seq", (i + 1).cast("int"))
        .withField("kind", F.lit("merged_part"))
        .withField("title", F.format_string("merged_part_%03d", i + 1)),
    )


def _finished(found: DataFrame, min_words: int, part_size: int) -> DataFrame:
    """Long sections and merged short ones, of equal titles the last, in one pass over each document's array."""
    parted = found.select(
        "doc",
        F.filter("found", _long_enough(min_words)).alias("long"),
        F.filter("found", lambda s: s["words"] < min_words).alias("short"),
    )
    merged = _merged(F.col("short"), part_size, min_words)
    rows = parted.select("doc", F.inline_outer(_last_of_titles(F.concat("long", merged))))
    return rows.where(F.col("seq").isNotNull())


def short_merged(
    texts: DataFrame, min_words: int = MIN_WORDS, part_size: int = PART_SIZE
) -> DataFrame:
    short = _routed(texts, min_words, part_size).select(
        "doc", F.filter("found", lambda s: s["words"] < min_words).alias("short")
    )
    return short.select("doc", F.inline(_merged(F.col("short"), part_size, min_words)))


def last_write_wins(sections: DataFrame) -> DataFrame:
    """Of sections with equal document and title the last one stays.

    Decided on numbers alone, combined before any shuffle; the texts only meet the places that stay.
    """
    last = sections.groupBy("doc", "title").agg(F.max("seq").alias("seq"))
    return sections.join(last, ["doc", "title", "seq"], "left_semi").select(*SECTION_COLUMNS)


def _last_of_titles(sections: Column) -> Column:
    """The same within one document's array, without a shuffle: places sorted by title and number."""

    def places(found: Column) -> Column:
        named = F.transform(found, lambda s, i: F.struct(s["title"], s["seq"], i.alias("at")))
        return F.sort_array(named)

    def last_places(ordered: Column) -> Column:
        following = F.slice(ordered, F.lit(2), F.size(ordered))
        ends = F.zip_with(
            ordered, following, lambda a, b: F.when(b.isNull() | (a["title"] != b["title"]), a["at"])
        )
        return F.sort_array(F.filter(ends, lambda at: at.isNotNull()))

    return bind(
        sections,
        lambda found: F.transform(bind(places(found), last_places), lambda at: F.get(found, at)),
    )


@dataclass(frozen=True)
class RoutedDocuments:
    """Every document's sections before the length rule.

    ``small``: one row per document of at most one volume, its sections in the array ``found``.
    ``long``: section rows of longer documents and ``long_pages`` their pages, or None.
    """

    small: DataFrame
    long: DataFrame | None
    long_pages: DataFrame | None
    min_words: int
    part_size: int

    def kept(self) -> RoutedDocuments:
        """The same, written once for several readers."""
        return replace(self, small=cut_lineage(self.small))

    def docs(self) -> DataFrame:
        """Every document, those without sections included."""
        docs = self.small.select("doc")
        return docs if self.long is None else docs.unionByName(self.long_pages.select("doc").distinct())

    def rows(self) -> DataFrame:
        rows = _rows(self.small)
        return rows if self.long is None else rows.unionByName(self.long)

    def sections(self) -> DataFrame:
        """Long sections and merged short ones; of equal titles the last."""
        sections = _finished(self.small, self.min_words, self.part_size)
        if self.long is None:
            return sections
        of_long = long_sections(self.long, self.min_words).unionByName(self._merged_long())
        return sections.unionByName(last_write_wins(of_long))

    def merged(self) -> DataFrame:
        """Short sections joined and cut anew."""
        short = F.filter("found", lambda s: s["words"] < self.min_words)
        parts = _merged(F.col("short"), self.part_size, self.min_words)
        merged = self.small.select("doc", short.alias("short")).select("doc", F.inline(parts))
        return merged if self.long is None else merged.unionByName(self._merged_long())

    def _merged_long(self) -> DataFrame:
        short = short_sections(self.long, self.min_words)
        return cut_lineage(merge_short_spanning(short, self.min_words, self.part_size))

    def log(self) -> DataFrame:
        """What was left out or merged: doc, event, page_number, title, n."""
        log = _small_log(self.small, self.min_words)
        if self.long is not None:
            log = log.unionByName(_long_log(self.long_pages, self.long, self.min_words))
        return log


def route_documents(
    pages: DataFrame,
    min_words: int = MIN_WORDS,
    part_size: int = PART_SIZE,
    volume_pages: int = VOLUME_PAGES,
) -> RoutedDocuments:
    """Clean and assemble pages, then cut each document by heading or by size.

    Documents of up to ``volume_pages`` pages are assembled in one shuffle by document, which later
    steps by document reuse. Longer ones are never gathered: they go through ``spanning``. Whether
    there are any is asked once, with a page filter the scan's statistics answer.
    """
    small_pages, long_pages = part_by_length(pages, volume_pages)
    small = _routed(small_documents(small_pages), min_words, part_size)
    if long_pages is None:
        return RoutedDocuments(small, None, None, min_words, part_size)
    found = spanning_sections(full_text(long_pages, volume_pages), min_words, part_size)
    return RoutedDocuments(small, found, long_pages, min_words, part_size)


def split_documents(
    pages: DataFrame,
    min_words: int = MIN_WORDS,
    part_size: int = PART_SIZE,
    volume_pages: int = VOLUME_PAGES,
) -> DataFrame:
    """The whole split: clean pages, assemble, section, merge short ones, last write wins."""
    return route_documents(pages, min_words, part_size, volume_pages).sections()


def extraction_log(
    pages: DataFrame,
    min_words: int = MIN_WORDS,
    part_size: int = PART_SIZE,
    volume_pages: int = VOLUME_PAGES,
) -> DataFrame:
    """Empty pages, documents without text or headings, short sections and how many were merged."""
    return route_documents(pages, min_words, part_size, volume_pages).log()


def _event(event: str, **details: Column) -> Column:
    def detail(name: str, of_type: str) -> Column:
        return details.get(name, F.lit(None)).cast(of_type).alias(name)

    return F.struct(
        F.lit(event).alias("event"),
        detail("page_number", "int"),
        detail("title", "string"),
        detail("n", "int"),
    )


def _small_log(routed: DataFrame, min_words: int) -> DataFrame:
    """All events of a document from its one row."""
    none = F.array().cast("array<struct<event:string,page_number:int,title:string,n:int>>")
    short = routed.select(
        "doc",
        "empty_pages",
        "blank",
        "has_headings",
        F.filter("found", lambda s: s["words"] < min_words).alias("short"),
    )
    n_short = F.size("short")
    events = F.concat(
        F.transform("empty_pages", lambda p: _event("empty_page", page_number=p)),
        F.when(F.col("blank"), F.array(_event("no_text")))
        .when(~F.col("has_headings"), F.array(_event("no_headings")))
        .otherwise(none),
        F.transform("short", lambda s: _event("short_section", title=s["title"], n=s["words"])),
        F.when(n_short > 0, F.array(_event("merged_short", n=n_short))).otherwise(none),
    )
    return short.select("doc", F.inline(events))


def _long_log(pages: DataFrame, found: DataFrame, min_words: int) -> DataFrame:
    """The same for documents that are not gathered, from their pages and sections."""
    blank = blank_documents(pages)
    short = short_sections(found, min_words)
    with_headings = found.where(F.col("kind") == "heading").select("doc").distinct()
    no_headings = (
        pages.select("doc")
        .distinct()
        .join(blank, "doc", "left_anti")
        .join(with_headings, "doc", "left_anti")
    )
    n_merged = short.groupBy("doc").agg(F.count("*").alias("n"))
    parts = [
        empty_pages(pages).select(
            "doc", _event("empty_page", page_number=F.col("page_number")).alias("e")
        ),
        blank.select("doc", _event("no_text").alias("e")),
        no_headings.select("doc", _event("no_headings").alias("e")),
        short.select(
            "doc", _event("short_section", title=F.col("title"), n=F.col("words")).alias("e")
        ),
        n_merged.select("doc", _event("merged_short", n=F.col("n")).alias("e")),
    ]
    return reduce(DataFrame.unionByName, parts).select("doc", "e.*")
