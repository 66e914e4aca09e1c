"""Incremental runs: new section files to requests, and arriving replies to records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.chunks import (
    build_request,
    chunk_words,
    resume_failed,
    sendable_chunks,
    small_chunks,
    token_budget,
)
from ..operators.records import (
    MAX_RETRIES,
    accept_attempts,
    classify_failures,
    completed_chunks,
)
from ..operators.replies import check_replies, parse_replies, records_of
from ..session import cut_lineage
from ..sources.buckets import exclude_stored, write_bucketed, write_keys
from ..sources.readers import any_case_glob, file_path, qa_path, read_finished, relative_to


def stream_sections(
    spark: SparkSession, folder: str, ext: str = ".txt", max_files: int | None = None
) -> DataFrame:
    """Section files as a stream. A file is read once; editing it in place does not bring it back."""
    reader = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", any_case_glob(ext))
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = reader.load(folder)
    rel_path = relative_to(file_path(), folder)
    return files.select(
        rel_path.alias("rel_path"), qa_path(rel_path).alias("out_path"), F.col("value").alias("text")
    )


def incremental_chunks(
    sections: DataFrame, model: str, max_context: int, requests: str, small: str, checkpoint: str
) -> None:
    """Chunk what is new, write requests and too-small chunks, stop when nothing is left.

    Each batch goes to its own folder with overwrite, so a batch replayed after a crash replaces
    itself.
    """
    budget = token_budget(max_context)

    def write(batch: DataFrame, batch_id: int) -> None:
        chunks = chunk_words(batch, budget.target, budget.overlap)
        body = build_request(sendable_chunks(chunks), model, budget.safe_tokens)
        _write_batch(body, requests, batch_id)
        _write_batch(small_chunks(chunks).drop("chunk"), small, batch_id)

    _run(sections, write, checkpoint)


@dataclass(frozen=True)
class ReplyStore:
    """Where accepted records, progress marks and failures of all batches are kept."""

    folder: str

    @property
    def qa(self) -> str:
        return f"{self.folder}/qa"

    @property
    def progress(self) -> str:
        return f"{self.folder}/progress"

    @property
    def failures(self) -> str:
        return f"{self.folder}/failures"

    @property
    def keys(self) -> str:
        return f"{self.folder}/keys"

    def finished(
        self, spark: SparkSession, files: DataFrame | None = None, batch_id: int | None = None
    ) -> DataFrame:
        """Chunks with accepted records over all batches but ``batch_id``, in the buckets of the files."""
        return read_finished(spark, self.progress, files, batch_id)

    def done(self, spark: SparkSession) -> DataFrame:
        """High-water mark per file, derived from the finished chunks."""
        return self.finished(spark).groupBy("rel_path").agg(F.max("chunk_index").alias("done"))


def accept_batch(
    responses: DataFrame, batch_id: int, store: ReplyStore, max_retries: int = MAX_RETRIES
) -> None:
    """One batch of replies against what all other batches stored; safe to repeat.

    Replies may arrive in any order: only chunks that are finished themselves are passed over, so
    a chunk that failed, or comes after later ones, is still taken. Of what is stored the batch
    reads narrow rows in the buckets of its own files.
    """
    spark = responses.sparkSession
    finished = cut_lineage(store.finished(spark, responses, batch_id))
    checked = cut_lineage(check_replies(parse_replies(resume_failed(responses, finished))))
    records = exclude_stored(records_of(checked), store.keys, checked, batch_id)
    accepted = cut_lineage(accept_attempts(records, max_retries=max_retries))
    _write_batch(accepted, store.qa, batch_id, "json")
    write_keys(accepted, store.keys, batch_id)
    write_bucketed(completed_chunks(accepted), f"{store.progress}/finished", batch_id)
    failures = classify_failures(checked, accepted, max_retries=max_retries)
    _write_batch(failures, store.failures, batch_id, "json")


def incremental_accept(
    responses: DataFrame, store: ReplyStore, checkpoint: str, max_retries: int = MAX_RETRIES
) -> None:
    """Run a stream of replies through ``accept_batch`` until nothing is left."""
    _run(
        responses,
        lambda batch, batch_id: accept_batch(batch, batch_id, store, max_retries),
        checkpoint,
    )


def _run(stream: DataFrame, write, checkpoint: str) -> None:
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _write_batch(rows: DataFrame, folder: str, batch_id: int, format: str = "parquet") -> None:
    rows.write.mode("overwrite").format(format).save(f"{folder}/batch_id={batch_id}")
