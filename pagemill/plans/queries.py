"""One query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.replies import elements, is_object
from ..functions.text import split_words, word_count
from ..operators import chunks as ck
from ..operators import pages as pg
from ..operators import records as rc
from ..operators import replies as rp
from ..operators import sections as sc
from ..operators import training as tr
from ..session import cut_lineage, scratch
from ..sources import buckets as bk
from ..streaming import incremental as inc
from . import inputs

MIN_WORDS = 30
PART_SIZE = 1000
CONTEXT = 4096
VOCAB = 200
ROW_LEN = 64
MODEL = "local-model"
ROW_KEY = ["rel_path", "chunk_index", "attempt", "pos"]


def _documents(spark, sf_dir):
    return inputs.documents(spark, sf_dir).select(F.col("doc_id").alias("doc"), "text")


def _headings(spark, sf_dir):
    return sc.document_headings(inputs.pages(spark, sf_dir))


def _routed(spark, sf_dir):
    return sc.route_documents(inputs.pages(spark, sf_dir), MIN_WORDS, PART_SIZE).kept()


# Chunks and requests


def chunk_fixed(spark, sf_dir):
    return ck.chunk_fixed(inputs.sections(spark, sf_dir))


def chunk_dynamic(spark, sf_dir):
    return ck.chunk_dynamic(inputs.sections(spark, sf_dir), CONTEXT)


def chunk_by_model(spark, sf_dir):
    """Windows sized per row: every document has its own context length."""
    docs = inputs.documents(spark, sf_dir).select(
        F.format_string("d%d.txt", "doc_id").alias("rel_path"),
        "text",
        (F.lit(512) * (F.col("doc_id") % 8 + 1)).cast("int").alias("max_context"),
    )
    budgets = ck.with_token_budget(docs)
    return ck.chunk_words(budgets, F.col("target"), F.col("overlap"))


def token_budgets(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir).select("doc_id", (F.col("n_chars") + 1).alias("max_context"))
    return ck.with_token_budget(docs)


def word_counts(spark, sf_dir):
    return inputs.documents(spark, sf_dir).select(
        "doc_id",
        F.size(split_words(F.col("text"))).alias("edge_words"),
        word_count(F.col("text")).alias("words"),
    )


def small_chunks(spark, sf_dir):
    return ck.small_chunks(chunk_fixed(spark, sf_dir))


def resume_chunks(spark, sf_dir):
    return ck.chunk_words(
        inputs.sections(spark, sf_dir),
        ck.FIXED_WORDS,
        ck.FIXED_OVERLAP,
        inputs.chunk_progress(spark, sf_dir),
    )


def resume_failed(spark, sf_dir):
    """The first chunk of two sections in three is complete, every other chunk comes back."""
    completed = inputs.chunk_progress(spark, sf_dir).select(
        "rel_path", F.col("done").alias("chunk_index")
    )
    return ck.resume_failed(chunk_fixed(spark, sf_dir), completed)


def chunk_labels(spark, sf_dir):
    return chunk_fixed(spark, sf_dir).select(
        "rel_path", "chunk_index", ck.chunk_label().alias("label")
    )


def _request_columns(requests: DataFrame, **more) -> DataFrame:
    request, messages = F.col("request"), F.col("request.messages")
    return requests.select(
        "rel_path",
        "chunk_index",
        request["model"].alias("model"),
        messages[0]["role"].alias("system_role"),
        messages[0]["content"].alias("system_content"),
        messages[1]["role"].alias("user_role"),
        messages[1]["content"].alias("user_content"),
        request["temperature"].alias("temperature"),
        request["max_tokens"].alias("max_tokens"),
        *[c.alias(name) for name, c in more.items()],
    )


def requests(spark, sf_dir):
    chunks = ck.sendable_chunks(chunk_dynamic(spark, sf_dir))
    built = ck.build_request(chunks, MODEL, ck.token_budget(CONTEXT).safe_tokens)
    return _request_columns(built, stream=F.col("request.stream"))


def requests_v0(spark, sf_dir):
    built = ck.build_request_v0(chunk_fixed(spark, sf_dir), MODEL)
    return _request_columns(built, response_format=F.col("request.response_format.type"))


# Pages and sections


def fixed_parts(spark, sf_dir):
    return sc.fixed_parts(_documents(spark, sf_dir))


def clean_pages(spark, sf_dir):
    return pg.clean_pages(inputs.pages(spark, sf_dir))


def empty_pages(spark, sf_dir):
    return pg.empty_pages(inputs.pages(spark, sf_dir))


def full_text(spark, sf_dir):
    return pg.full_text(inputs.pages(spark, sf_dir))


def full_text_volumes(spark, sf_dir):
    """Documents of more than three pages in several volumes."""
    return pg.full_text(inputs.pages(spark, sf_dir), 3)


def blank_documents(spark, sf_dir):
    return pg.blank_documents(inputs.pages(spark, sf_dir))


def extraction_stats(spark, sf_dir):
    pages = inputs.pages(spark, sf_dir)
    return pg.extraction_stats(pages, sc.split_documents(pages, MIN_WORDS, PART_SIZE))


def heading_sections(spark, sf_dir):
    return _headings(spark, sf_dir)


def section_titles(spark, sf_dir):
    return sc.section_titles(_headings(spark, sf_dir)).select("doc", "seq", "title")


def early_sections(spark, sf_dir):
    return sc.early_sections(_headings(spark, sf_dir))


def no_heading_docs(spark, sf_dir):
    return sc.documents_without_headings(inputs.pages(spark, sf_dir))


def routed_sections(spark, sf_dir):
    return sc.route_documents(inputs.pages(spark, sf_dir), MIN_WORDS, PART_SIZE).rows()


def short_sections(spark, sf_dir):
    return sc.short_sections(routed_sections(spark, sf_dir), MIN_WORDS)


def short_merged(spark, sf_dir):
    return _routed(spark, sf_dir).merged()


def last_write_wins(spark, sf_dir):
    return sc.last_write_wins(sc.long_sections(_routed(spark, sf_dir).rows(), MIN_WORDS))


def sections_final(spark, sf_dir):
    return sc.split_documents(inputs.pages(spark, sf_dir), MIN_WORDS, PART_SIZE)


def sections_long_documents(spark, sf_dir):
    """The same result where a document of more than three pages counts as too long to gather."""
    return sc.split_documents(inputs.pages(spark, sf_dir), MIN_WORDS, PART_SIZE, volume_pages=3)


def extraction_log(spark, sf_dir):
    return sc.extraction_log(inputs.pages(spark, sf_dir), MIN_WORDS, PART_SIZE)


def extraction_log_long_documents(spark, sf_dir):
    return sc.extraction_log(inputs.pages(spark, sf_dir), MIN_WORDS, PART_SIZE, volume_pages=3)


def nonblank_documents(spark, sf_dir):
    pages = inputs.pages(spark, sf_dir)
    return pg.nonblank_volumes(pages).select("doc", "text")


# Replies and records


def _parsed(spark, sf_dir):
    return rp.parse_replies(inputs.responses(spark, sf_dir))


def reply_arrays(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        *rp.REPLY_KEY, "http_error", F.size(elements(F.col("items"))).alias("n_items")
    )


def _scanned(spark, sf_dir, **how):
    found = rp.scan_replies(inputs.responses(spark, sf_dir), **how)
    return found.select(*rp.REPLY_KEY, F.size(elements(F.col("items"))).alias("n_items"))


def reply_arrays_scan(spark, sf_dir):
    return _scanned(spark, sf_dir)


def reply_arrays_scan_strict(spark, sf_dir):
    return _scanned(spark, sf_dir, required=("instruction", "output"), fix_commas_first=True)


def reply_records(spark, sf_dir):
    return rp.reply_records(_parsed(spark, sf_dir))


def valid_records(spark, sf_dir):
    return rp.valid_records(_parsed(spark, sf_dir))


def valid_records_strict(spark, sf_dir):
    return rp.valid_records_strict(_parsed(spark, sf_dir))


def dedup_file(spark, sf_dir):
    return rc.dedup_within_file(valid_records(spark, sf_dir))


def dedup_global(spark, sf_dir):
    return rc.dedup_global(valid_records(spark, sf_dir))


def _existing(spark, sf_dir):
    """Keys of every file's third chunk stand for an earlier run's output."""
    return valid_records(spark, sf_dir).where("chunk_index = 3")


def exclude_existing(spark, sf_dir):
    """Against a key store of two runs: the third chunks' keys by file number, even and odd."""
    folder = scratch(spark, "keys")
    valid = cut_lineage(valid_records(spark, sf_dir))
    number = F.regexp_extract("rel_path", "[0-9]+", 0).cast("long")
    for run in (0, 1):
        bk.write_keys(valid.where((F.col("chunk_index") == 3) & (number % 2 == run)), folder, run)
    return bk.exclude_stored(valid, folder)


def first_parsed(spark, sf_dir):
    scanned = rp.scan_replies(inputs.responses(spark, sf_dir))
    item = F.col("item")
    instruction = F.try_variant_get(item, "$.instruction", "string")
    return rc.first_parsed_attempt(scanned).select(
        *ROW_KEY, is_object(item).alias("is_object"), instruction.alias("instruction")
    )


def _fresh(spark, sf_dir):
    """Replies of chunks not yet done, checked."""
    waiting = ck.resume_filter(
        inputs.responses(spark, sf_dir), inputs.reply_progress(spark, sf_dir)
    )
    return rp.check_replies(rp.parse_replies(waiting))


def _accept(spark, sf_dir, fresh):
    return rc.accept_attempts(rp.records_of(fresh), _existing(spark, sf_dir))


def accepted_records(spark, sf_dir):
    return _accept(spark, sf_dir, _fresh(spark, sf_dir))


def accepted_records_run(spark, sf_dir):
    """One scope for the whole run: a key kept in any file is not kept again."""
    return rc.accept_attempts(valid_records(spark, sf_dir), scope="run")


def progress_next(spark, sf_dir):
    return rc.advance_progress(
        inputs.reply_progress(spark, sf_dir), accepted_records(spark, sf_dir)
    )


def completed_chunks(spark, sf_dir):
    return rc.completed_chunks(accepted_records(spark, sf_dir))


def failures(spark, sf_dir):
    fresh = cut_lineage(_fresh(spark, sf_dir))
    return rc.classify_failures(fresh, _accept(spark, sf_dir, fresh))


def failure_counts(spark, sf_dir):
    return rc.failure_counts(failures(spark, sf_dir))


def pair_counts(spark, sf_dir):
    return rc.pair_counts(dedup_file(spark, sf_dir))


# Training rows


def _rendered(spark, sf_dir):
    return tr.render_training_text(valid_records(spark, sf_dir)).select(*ROW_KEY, "text")


def training_text(spark, sf_dir):
    return _rendered(spark, sf_dir)


def project_text(spark, sf_dir):
    return tr.project_text(_rendered(spark, sf_dir))


def vocab(spark, sf_dir):
    return tr.build_vocab(_rendered(spark, sf_dir), VOCAB)


def _as_text(encoded: DataFrame) -> DataFrame:
    lists = ["input_ids", "attention_mask", "labels"]
    return encoded.select(
        *ROW_KEY, *[F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in lists]
    )


def encoded(spark, sf_dir):
    texts = _rendered(spark, sf_dir)
    return _as_text(tr.encode_fixed_length(texts, tr.build_vocab(texts, VOCAB), ROW_LEN))


def encoded_by_join(spark, sf_dir):
    texts = _rendered(spark, sf_dir)
    return _as_text(tr.encode_by_join(texts, tr.build_vocab(texts, VOCAB), ROW_LEN, ROW_KEY))


# Incremental runs


def incremental_chunks(spark, sf_dir):
    """The documents table as a stream of sections; what was sent, read back."""
    folder = scratch(spark, "chunks")
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    stream = (
        spark.readStream.schema(schema)
        .parquet(f"{sf_dir}/documents.parque[t]")  # a pattern matches a file and a folder alike
        .select(F.format_string("d%d.txt", "doc_id").alias("rel_path"), "text")
    )
    sent, small = f"{folder}/requests", f"{folder}/small"
    inc.incremental_chunks(stream, MODEL, CONTEXT, sent, small, f"{folder}/checkpoint")
    return _request_columns(spark.read.parquet(sent), stream=F.col("request.stream"))


def incremental_accept(spark, sf_dir):
    """Replies arriving file by file; each section file's replies arrive together."""
    folder = scratch(spark, "replies")
    replies = inputs.responses(spark, sf_dir)
    replies.repartitionByRange(3, "rel_path").write.parquet(f"{folder}/in")
    stream = (
        spark.readStream.schema(replies.schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{folder}/in")
    )
    store = inc.ReplyStore(f"{folder}/store")
    inc.incremental_accept(stream, store, f"{folder}/checkpoint")
    schema = (
        "rel_path string, chunk_index int, attempt int, pos int, "
        "instruction string, input string, output string"
    )
    return spark.read.schema(schema).json(store.qa).select(*rc.RECORD_COLUMNS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        chunk_fixed,
        chunk_dynamic,
        chunk_by_model,
        token_budgets,
        word_counts,
        small_chunks,
        resume_chunks,
        resume_failed,
        chunk_labels,
        requests,
        requests_v0,
        fixed_parts,
        clean_pages,
        empty_pages,
        full_text,
        full_text_volumes,
        blank_documents,
        extraction_stats,
        heading_sections,
        section_titles,
        early_sections,
        no_heading_docs,
        routed_sections,
        short_sections,
        short_merged,
        last_write_wins,
        sections_final,
        sections_long_documents,
        extraction_log,
        extraction_log_long_documents,
        nonblank_documents,
        reply_arrays,
        reply_arrays_scan,
        reply_arrays_scan_strict,
        reply_records,
        valid_records,
        valid_records_strict,
        dedup_file,
        dedup_global,
        exclude_existing,
        first_parsed,
        accepted_records,
        accepted_records_run,
        progress_next,
        completed_chunks,
        failures,
        failure_counts,
        pair_counts,
        training_text,
        project_text,
        vocab,
        encoded,
        encoded_by_join,
        incremental_chunks,
        incremental_accept,
    )
}
