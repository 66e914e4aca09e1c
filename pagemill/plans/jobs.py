"""The three jobs end to end: split, generate (up to and after the model call), training rows."""

from __future__ import annotations

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
from ..operators.pages import VOLUME_PAGES
from ..operators.records import (
    MAX_RETRIES,
    accept_attempts,
    advance_progress,
    classify_failures,
    completed_chunks,
)
from ..operators.replies import check_replies, parse_replies, records_of
from ..operators.sections import (
    MIN_WORDS,
    PART_SIZE,
    route_documents,
)
from ..operators.training import (
    MAX_LEN,
    VOCAB_SIZE,
    build_vocab,
    encode_fixed_length,
    input_files_check,
    project_text,
    render_training_text,
)
from ..session import cut_lineage
from ..sources.buckets import exclude_stored, write_bucketed, write_keys
from ..sources.paths import version_numbers
from ..sources.readers import (
    check_chunking,
    qa_files,
    read_existing_keys,
    read_finished,
    read_progress,
    read_qa,
)
from ..sources.writers import (
    all_fields,
    write_extract_log,
    write_progress,
    write_run,
    write_sections,
)


def split_job(
    pages: DataFrame,
    sections_dir: str,
    log_dir: str,
    min_words: int = MIN_WORDS,
    part_size: int = PART_SIZE,
    volume_pages: int = VOLUME_PAGES,
) -> None:
    """Sections and extraction log from one pass over the pages."""
    routed = route_documents(pages, min_words, part_size, volume_pages).kept()
    write_sections(routed.sections(), sections_dir, routed.docs())
    write_extract_log(routed.log(), log_dir, routed.docs())


def request_job(
    sections: DataFrame,
    model: str,
    max_context: int,
    progress_dir: str,
    requests_dir: str,
    retry_failed: bool = False,
) -> DataFrame:
    """Write the requests still to be sent; returns the chunks too small to send.

    ``retry_failed`` also asks again for chunks that failed before the last finished one.
    """
    spark = sections.sparkSession
    budget = token_budget(max_context)
    progress = read_progress(spark, progress_dir)
    check_chunking(progress, budget.target, budget.overlap)
    if retry_failed:
        adopt_marks(progress, progress_dir)
        chunks = chunk_words(sections, budget.target, budget.overlap)
        run = next_run(spark, progress_dir)
        chunks = resume_failed(chunks, read_finished(spark, progress_dir, sections, run))
    else:
        chunks = chunk_words(sections, budget.target, budget.overlap, progress)
    requests = build_request(sendable_chunks(chunks), model, budget.safe_tokens)
    requests.write.mode("overwrite").parquet(requests_dir)
    return small_chunks(chunks).drop("chunk")


def next_run(spark: SparkSession, progress_dir: str) -> int:
    """The run whose progress would be written next; a run that broke off before is this one."""
    return max(version_numbers(spark, progress_dir), default=0) + 1


def adopt_marks(progress: DataFrame, progress_dir: str) -> None:
    """Write the chunks up to progress marks that another program left as finished ones, once, before any run."""
    folder = f"{progress_dir}/finished"
    if not version_numbers(progress.sparkSession, folder, "run"):
        numbers = F.explode(F.expr("sequence(1, done)")).alias("chunk_index")
        write_bucketed(progress.where("done > 0").select("rel_path", numbers), folder, 0)


def adopt_records(spark: SparkSession, qa_dir: str, keys_dir: str, but_run: int) -> None:
    """Write the keys of records that were there before the key store, once."""
    if not version_numbers(spark, keys_dir, "run"):
        write_keys(read_existing_keys(spark, qa_dir, but=f"run={but_run}"), keys_dir, 0)


def accept_job(
    responses: DataFrame,
    small: DataFrame,
    max_context: int,
    qa_dir: str,
    progress_dir: str,
    failures_dir: str,
    max_retries: int = MAX_RETRIES,
) -> None:
    """Replies to new QA records, progress and failures; safe to repeat.

    Each run writes to folders of its own, and progress last. A rerun after a crash replaces them
    and compares with the records of other runs only. Replies are passed over by the finished
    chunks, not by the high-water mark, so a chunk that failed before is taken when it comes again;
    small chunks are finished too and reported once. The keys of stored records are read from the
    buckets of the replies' files.
    """
    spark = responses.sparkSession
    budget = token_budget(max_context)
    progress = read_progress(spark, progress_dir)
    check_chunking(progress, budget.target, budget.overlap)
    run = next_run(spark, progress_dir)
    adopt_marks(progress, progress_dir)
    finished = cut_lineage(read_finished(spark, progress_dir, responses, run))
    checked = cut_lineage(check_replies(parse_replies(resume_failed(responses, finished))))
    small = cut_lineage(resume_failed(small, read_finished(spark, progress_dir, small, run)))
    keys_dir = f"{progress_dir}/keys"
    adopt_records(spark, qa_dir, keys_dir, run)
    records = exclude_stored(records_of(checked), keys_dir, checked, run)
    accepted = cut_lineage(accept_attempts(records, max_retries=max_retries))
    failures = classify_failures(checked, accepted, small, max_retries=max_retries)
    write_run(failures, failures_dir, run)
    write_run(all_fields(accepted), qa_dir, run)
    write_keys(accepted, keys_dir, run)
    write_bucketed(completed_chunks(accepted, small), f"{progress_dir}/finished", run)
    write_progress(
        advance_progress(progress, accepted, small), progress_dir, budget.target, budget.overlap
    )


def training_job(
    spark: SparkSession,
    qa_dir: str,
    vocab_dir: str,
    rows_dir: str,
    vocab_size: int = VOCAB_SIZE,
    max_len: int = MAX_LEN,
) -> None:
    input_files_check(qa_files(spark, qa_dir))
    texts = project_text(render_training_text(read_qa(spark, qa_dir)))
    build_vocab(texts, vocab_size).write.mode("overwrite").parquet(vocab_dir)
    rows = encode_fixed_length(texts, spark.read.parquet(vocab_dir), max_len)
    rows.write.mode("overwrite").parquet(rows_dir)
