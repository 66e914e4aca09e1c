"""Queries that write the given tables with the sinks, read them back with the sources, and run the
accepting jobs in the orders that cluster runs meet: interleaved, resumed and repeated."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.replies import is_object
from ..operators import chunks as ck
from ..operators import pages as pg
from ..operators import records as rc
from ..operators import replies as rp
from ..operators import training as tr
from ..session import scratch
from ..sources import readers as rd
from ..sources import writers as wr
from ..streaming import incremental as inc
from . import inputs, jobs
from .queries import CONTEXT, MIN_WORDS, MODEL, PART_SIZE, failures, valid_records

DOCS_PER_FILE = 50
FIELDS = ["instruction", "input", "output"]


def _text_files(spark: SparkSession, sf_dir: str, end: str = "\n") -> str:
    """Every document's text in files of fifty, one folder for each file; texts end with ``end``."""
    folder = scratch(spark, "texts")
    docs = inputs.documents(spark, sf_dir).withColumn("shelf", F.expr(f"doc_id div {DOCS_PER_FILE}"))
    ordered = docs.repartition("shelf").sortWithinPartitions("shelf", "doc_id")
    ordered.select("shelf", "text").write.partitionBy("shelf").option("lineSep", end).text(folder)
    return folder


# Sources


def listed_documents(spark, sf_dir):
    files = rd.list_documents(spark, f"{_text_files(spark, sf_dir)}/shelf=*", ".TXT")
    return files.select(
        F.regexp_extract("path", "shelf=([0-9]+)/", 1).cast("long").alias("shelf"),
        (F.concat("doc", F.lit(".txt")) == F.substring_index("path", "/", -1)).alias("bare_name"),
    )


def text_dumps(spark, sf_dir):
    return rd.read_text_dump(spark, f"{_text_files(spark, sf_dir)}/shelf=*").select("text")


def page_text_files(spark, sf_dir):
    """Files whose pages end with a form feed: every document is a page."""
    folder = _text_files(spark, sf_dir, "\f")
    return rd.read_page_text_files(spark, f"{folder}/shelf=*").select("page_number", "text")


def page_table(spark, sf_dir):
    folder = scratch(spark, "pages")
    inputs.pages(spark, sf_dir).write.parquet(folder)
    return rd.read_pages(spark, folder)


def section_files(spark, sf_dir):
    """Section files below a folder; Spark names files anew in each run, so the name is cut off."""
    sections = rd.read_sections(spark, _text_files(spark, sf_dir))
    return sections.select(
        F.substring_index("rel_path", "/", 1).alias("folder"),
        (F.col("out_path") == F.regexp_replace("rel_path", "txt$", "jsonl")).alias("same_stem"),
        "text",
    )


def input_files(spark, sf_dir):
    folder = _text_files(spark, sf_dir)
    n = tr.input_files_check(rd.qa_files(spark, folder, "*.txt"))
    return spark.range(1).select(F.lit(n).cast("long").alias("n_files"))


# Sinks and their sources


def _split(spark, sf_dir) -> tuple[str, str]:
    folder = scratch(spark, "split")
    sections, log = f"{folder}/sections", f"{folder}/log"
    jobs.split_job(inputs.pages(spark, sf_dir), sections, log, MIN_WORDS, PART_SIZE)
    return sections, log


def section_table(spark, sf_dir):
    """The split job's sections, read as the request job takes them."""
    return rd.read_section_table(spark, _split(spark, sf_dir)[0])


def extract_log_files(spark, sf_dir):
    return rd.read_extract_log(spark, _split(spark, sf_dir)[1])


def full_text_table(spark, sf_dir):
    folder = scratch(spark, "full")
    wr.write_full_text(pg.full_text(inputs.pages(spark, sf_dir)), folder)
    return spark.read.parquet(folder)


def _appended_qa(spark, sf_dir) -> str:
    """Records appended in two goes: first attempts, then the others."""
    folder = scratch(spark, "qa")
    records = valid_records(spark, sf_dir)
    for part in ("attempt <= 1", "attempt > 1"):
        wr.append_qa(records.where(part), folder)
    return folder


def appended_qa(spark, sf_dir):
    return rd.read_qa(spark, _appended_qa(spark, sf_dir))


def rewritten_qa(spark, sf_dir):
    """The second writing replaces the first."""
    folder = scratch(spark, "qa")
    records = valid_records(spark, sf_dir)
    wr.write_qa(records, folder)
    wr.write_qa(rc.dedup_global(records), folder)
    return rd.read_qa(spark, folder)


def existing_keys(spark, sf_dir):
    """Keys out of lines among which every document's first line stands as a broken one."""
    folder = _appended_qa(spark, sf_dir)
    first = F.concat(F.lit("{"), F.substring_index("text", "\n", 1))
    inputs.documents(spark, sf_dir).select(first).write.text(f"{folder}/broken")
    return rd.read_existing_keys(spark, folder, "*.[jt][sx][ot]*")


def progress_versions(spark, sf_dir):
    """Two versions of the progress; the newer one counts."""
    folder = scratch(spark, "progress")
    progress = inputs.reply_progress(spark, sf_dir)
    wr.write_progress(progress.withColumn("done", F.lit(99)), folder, 800, 150)
    wr.write_progress(progress, folder, 800, 150)
    return rd.read_progress(spark, folder)


def progress_objects(spark, sf_dir):
    """Progress as JSON objects of up to fifty files each."""
    folder = scratch(spark, "progress")
    number = F.regexp_extract("rel_path", "[0-9]+", 0).cast("long")
    progress = inputs.reply_progress(spark, sf_dir)
    entries = F.map_from_entries(F.collect_list(F.struct("rel_path", "done")))
    grouped = progress.groupBy(F.floor(number / DOCS_PER_FILE).alias("shelf")).agg(entries.alias("m"))
    whole = grouped.select("shelf", F.to_json("m").alias("value"))
    whole.write.partitionBy("shelf").text(folder)
    return rd.read_progress_json(spark, folder)


def appended_failures(spark, sf_dir):
    folder = scratch(spark, "failures")
    found = failures(spark, sf_dir)
    for part in ("attempt <= 1", "attempt > 1"):
        wr.append_failures(found.where(part), folder)
    schema = "rel_path string, chunk_index int, attempt int, reason string, detail string"
    return spark.read.schema(schema).json(folder)


# Accepting in the orders of real runs


def _stored(spark, folder):
    schema = "rel_path string, " + ", ".join(f"{f} string" for f in FIELDS)
    return spark.read.schema(schema).json(folder).select("rel_path", *FIELDS)


def incremental_accept_interleaved(spark, sf_dir):
    """Three batches that mix a file's chunks, the second one repeated."""
    store = inc.ReplyStore(scratch(spark, "store"))
    replies = inputs.responses(spark, sf_dir)
    for batch in (0, 1, 1, 2):
        inc.accept_batch(replies.where(F.col("chunk_index") % 3 == batch), batch, store)
    return _stored(spark, store.qa)


def settled_interleaved(spark, sf_dir):
    """Batches by attempt, the last first: every chunk answered is finished or among the failures."""
    store = inc.ReplyStore(scratch(spark, "store"))
    replies = inputs.responses(spark, sf_dir)
    for batch, part in enumerate(("attempt > 1", "attempt <= 1")):
        inc.accept_batch(replies.where(part), batch, store)
    failed = spark.read.schema("rel_path string, chunk_index int").json(store.failures)
    failed = failed.select("rel_path", "chunk_index")
    return store.finished(spark).select("rel_path", "chunk_index").unionByName(failed).distinct()


def _accept(spark, replies, folder, progress="progress"):
    small = spark.createDataFrame([], "rel_path string, chunk_index int, n_chunks int")
    places = (f"{folder}/qa", f"{folder}/{progress}", f"{folder}/failures")
    jobs.accept_job(replies, small, CONTEXT, *places)


def accept_resumed_failed(spark, sf_dir):
    """First attempts in one run; what failed comes back with its further attempts in the next."""
    folder = scratch(spark, "accept")
    replies = inputs.responses(spark, sf_dir)
    _accept(spark, replies.where("attempt <= 1"), folder)
    _accept(spark, replies.where("attempt > 1"), folder)
    return _stored(spark, f"{folder}/qa")


def accept_rerun(spark, sf_dir):
    """A run whose progress was lost after its records were written, then repeated twice."""
    folder = scratch(spark, "accept")
    replies = inputs.responses(spark, sf_dir)
    _accept(spark, replies, folder, "lost")
    _accept(spark, replies, folder)
    _accept(spark, replies, folder)
    return _stored(spark, f"{folder}/qa")


def accept_after_marks(spark, sf_dir):
    """Two runs after progress that another program left: chunks up to its marks stay finished in both."""
    folder = scratch(spark, "accept")
    budget = ck.token_budget(CONTEXT)
    marks = inputs.reply_progress(spark, sf_dir)
    wr.write_progress(marks, f"{folder}/progress", budget.target, budget.overlap)
    replies = inputs.responses(spark, sf_dir)
    for part in ("attempt <= 1", "attempt > 1"):
        _accept(spark, replies.where(part), folder)
    return _stored(spark, f"{folder}/qa")


def retry_small(spark, sf_dir):
    """Three runs that ask again for what failed: a small chunk is reported by the first alone."""
    folder = scratch(spark, "retry")
    sections = inputs.sections(spark, sf_dir)
    replies = inputs.responses(spark, sf_dir)
    places = [f"{folder}/{name}" for name in ("qa", "progress", "failures")]
    for attempt in (1, 2, 3):
        asked = f"{folder}/asked{attempt}"
        small = jobs.request_job(sections, MODEL, CONTEXT, places[1], asked, retry_failed=True)
        jobs.accept_job(replies.where(F.col("attempt") == attempt), small, CONTEXT, *places)
    failed = spark.read.schema("rel_path string, chunk_index int, reason string").json(places[2])
    return failed.where("reason = 'too_small'").select("rel_path", "chunk_index")


def written_items(spark, sf_dir):
    """Unchecked items as JSON lines, read back line by line."""
    folder = scratch(spark, "items")
    scanned = rp.scan_replies(inputs.responses(spark, sf_dir))
    wr.write_items(rc.first_parsed_attempt(scanned), folder)
    item = F.try_parse_json("value")
    instruction = F.try_variant_get(item, "$.instruction", "string")
    return spark.read.text(folder).select(is_object(item).alias("is_object"), instruction.alias("instruction"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        listed_documents,
        text_dumps,
        page_text_files,
        page_table,
        section_files,
        input_files,
        section_table,
        extract_log_files,
        full_text_table,
        appended_qa,
        rewritten_qa,
        existing_keys,
        progress_versions,
        progress_objects,
        appended_failures,
        incremental_accept_interleaved,
        settled_interleaved,
        accept_resumed_failed,
        accept_rerun,
        accept_after_marks,
        retry_small,
        written_items,
    )
}
