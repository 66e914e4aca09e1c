"""Sinks. Writes are whole Spark jobs; nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.replies import FIELDS
from .buckets import write_documents
from .paths import version_numbers


def write_sections(sections: DataFrame, folder: str, docs: DataFrame | None = None) -> None:
    """A document written again replaces its sections and no other's; no folder or file of its own.

    ``docs`` are the documents of this run, those without sections included; by default those with some.
    """
    write_documents(sections, _docs(sections, docs), folder)


def write_extract_log(log: DataFrame, folder: str, docs: DataFrame | None = None) -> None:
    """Per document, replaced on every run."""
    write_documents(log, _docs(log, docs), folder, "json")


def _docs(rows: DataFrame, docs: DataFrame | None) -> DataFrame:
    return (rows if docs is None else docs).select("doc").distinct()


def write_full_text(texts: DataFrame, folder: str) -> None:
    texts.write.mode("overwrite").parquet(folder)


def all_fields(records: DataFrame) -> DataFrame:
    """JSON leaves out nulls, so absent fields become empty text."""
    keys = [c for c in ("rel_path",) if c in records.columns]
    return records.select(*keys, *[F.coalesce(c, F.lit("")).alias(c) for c in FIELDS])


def append_qa(records: DataFrame, folder: str) -> None:
    """Append JSON lines; non-ASCII text is written as it is."""
    all_fields(records).write.mode("append").json(folder)


def write_qa(records: DataFrame, folder: str) -> None:
    all_fields(records).write.mode("overwrite").json(folder)


def write_run(rows: DataFrame, folder: str, run: int, format: str = "json") -> None:
    """One run's rows in a folder of their own, replaced if the run is repeated."""
    rows.write.mode("overwrite").format(format).save(f"{folder}/run={run}")


def write_items(items: DataFrame, folder: str) -> None:
    """Unchecked list items as JSON lines, one item per line."""
    items.select(F.to_json("item").alias("value")).write.mode("overwrite").text(folder)


def append_failures(failures: DataFrame, folder: str) -> None:
    failures.write.mode("append").json(folder)


def write_progress(progress: DataFrame, folder: str, target: int, overlap: int) -> str:
    """Write the whole table as a new version; readers switch once it is complete.

    The version being read is never overwritten, and the window sizes go along.
    """
    numbers = version_numbers(progress.sparkSession, folder)
    path = f"{folder}/version={(numbers[-1] if numbers else 0) + 1}"
    progress.select(
        "rel_path",
        "done",
        F.lit(target).cast("int").alias("target"),
        F.lit(overlap).cast("int").alias("overlap"),
    ).write.mode("overwrite").parquet(path)
    return path
