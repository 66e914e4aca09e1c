"""Pages to documents. ``pages``: doc STRING, page_number INT, text STRING."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank, strip_control_chars
from ..session import cut_lineage

# Pages gathered into one row at most. A longer document becomes several consecutive volumes.
VOLUME_PAGES = 1000
PAGE_BREAK = "\n\n"
# Longest list of document names sent to every task, and the number of salts beyond it.
BROADCAST_DOCS = 500_000
SALTS = 256


def has_text() -> F.Column:
    return F.coalesce(F.col("text"), F.lit("")) != ""


def drop_empty_pages(pages: DataFrame) -> DataFrame:
    """Pages with null or empty text go; whitespace-only pages stay."""
    return pages.where(has_text())


def empty_pages(pages: DataFrame) -> DataFrame:
    return pages.where(~has_text()).select("doc", "page_number")


def clean_pages(pages: DataFrame) -> DataFrame:
    return drop_empty_pages(pages).select(
        "doc", "page_number", strip_control_chars(F.col("text")).alias("text")
    )


def full_text(pages: DataFrame, volume_pages: int = VOLUME_PAGES) -> DataFrame:
    """Cleaned pages joined by a blank line: one row per document and volume.

    A document of up to ``volume_pages`` pages is exactly one row, volume 0. A longer one gives
    consecutive volumes whose texts, joined by a blank line, are the whole text; so no task ever
    gathers more than ``volume_pages`` pages, whatever a document's size.
    """
    volume = F.floor((F.col("page_number") - 1) / volume_pages).cast("int")
    return _assemble(clean_pages(pages).withColumn("volume", volume), "doc", "volume")


def _assemble(pages: DataFrame, *keys: str) -> DataFrame:
    ordered = F.sort_array(F.collect_list(F.struct("page_number", "text")))
    texts = F.transform(ordered, lambda p: p["text"])
    return pages.groupBy(*keys).agg(F.array_join(texts, PAGE_BREAK).alias("text"))


def small_documents(pages: DataFrame) -> DataFrame:
    """Text of documents of at most one volume, one row for every document, with its empty pages' numbers."""
    page = F.struct("page_number", strip_control_chars(F.col("text")).alias("text"))
    kept = F.sort_array(F.collect_list(F.when(has_text(), page)))
    empty = F.sort_array(F.collect_list(F.when(~has_text(), F.col("page_number"))))
    return pages.groupBy("doc").agg(
        F.array_join(F.transform(kept, lambda p: p["text"]), PAGE_BREAK).alias("text"),
        empty.alias("empty_pages"),
    )


def long_documents(pages: DataFrame, volume_pages: int = VOLUME_PAGES) -> DataFrame:
    """Documents of more than one volume; the page filter reaches the scan's statistics."""
    return pages.where(F.col("page_number") > volume_pages).select("doc").distinct()


def part_by_length(
    pages: DataFrame, volume_pages: int = VOLUME_PAGES
) -> tuple[DataFrame, DataFrame | None]:
    """Pages of documents of one volume, and those of longer documents or None.

    The list of long documents is counted first. Up to ``BROADCAST_DOCS`` it goes to every task and
    no page moves. A longer list is joined with pages salted by page number, so that the pages of
    one huge document never meet in one task.
    """
    long_docs = long_documents(pages, volume_pages)
    if long_docs.isEmpty():
        return pages, None
    long_docs = cut_lineage(long_docs)
    if long_docs.count() <= BROADCAST_DOCS:
        salted, ids, keys = pages, F.broadcast(long_docs), ["doc"]
    else:
        salted = pages.withColumn("salt", F.pmod("page_number", F.lit(SALTS)))
        every_salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        ids, keys = long_docs.select("doc", every_salt.alias("salt")), ["doc", "salt"]
    small = salted.join(ids, keys, "left_anti").select(*pages.columns)
    long = salted.join(ids, keys, "left_semi").select(*pages.columns)
    return small, long


def blank_documents(pages: DataFrame) -> DataFrame:
    """Documents without any text left after cleaning, all-empty ones included."""
    text = strip_control_chars(F.coalesce(F.col("text"), F.lit("")))
    return (
        pages.groupBy("doc")
        .agg(F.bool_or(~is_blank(text)).alias("has_text"))
        .where(~F.col("has_text"))
        .select("doc")
    )


def nonblank_volumes(pages: DataFrame, volume_pages: int = VOLUME_PAGES) -> DataFrame:
    """``full_text`` without the documents that have no text; told from the pages, so any length will do."""
    return full_text(pages, volume_pages).join(blank_documents(pages), "doc", "left_anti")


def drop_blank_documents(texts: DataFrame) -> DataFrame:
    return texts.where(~is_blank(F.col("text")))


def extraction_stats(pages: DataFrame, sections: DataFrame | None = None) -> DataFrame:
    """Per document: pages kept, characters of the full text and, if given, sections."""
    kept = (
        clean_pages(pages)
        .groupBy("doc")
        .agg(
            F.count("*").alias("pages_kept"),
            (F.sum(F.length("text")) + len(PAGE_BREAK) * (F.count("*") - 1)).alias("characters"),
        )
    )
    if sections is None:
        return kept
    counts = sections.groupBy("doc").agg(F.count("*").alias("n_sections"))
    return kept.join(counts, "doc", "left").withColumn(
        "n_sections", F.coalesce("n_sections", F.lit(0).cast("long"))
    )
