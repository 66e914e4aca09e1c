"""Sources: document listings, page text, section files, QA files and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.replies import FIELDS
from .buckets import read_bucketed, read_documents
from .paths import absolute_path, latest_version, path_exists

PAGES_SCHEMA = "doc string, page_number int, text string"
QA_SCHEMA = "rel_path string, instruction string, input string, output string"
PROGRESS_SCHEMA = "rel_path string, done int"
FINISHED_SCHEMA = "rel_path string, chunk_index int"
SECTIONS_SCHEMA = "doc string, title string, content string"
LOG_SCHEMA = "doc string, event string, page_number int, title string, n int"
STORED_PROGRESS_SCHEMA = PROGRESS_SCHEMA + ", target int, overlap int"


def any_case_glob(ext: str) -> str:
    """Glob for a file extension in upper or lower case: ``.txt`` gives ``*.[tT][xX][tT]``."""
    letters = [f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in ext]
    return "*" + "".join(letters)


def file_path() -> Column:
    """The scanned file's path, without the escapes of its URI form."""
    escaped = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(escaped)


def relative_to(path: Column, root: str) -> Column:
    """The part of a scanned path below ``root``.

    The folder is made absolute first, so its name may occur elsewhere in the path. A store that
    reports files under another root (a mounted one) falls back to the first place of the name.
    """
    below = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    prefix = absolute_path(SparkSession.getActiveSession(), root).rstrip("/") + "/"
    name = root.split(":", 1)[-1].strip("/") + "/"
    return F.when(
        below.startswith(prefix), F.substring(below, len(prefix) + 1, F.length(below))
    ).otherwise(F.substring(path, F.instr(path, name) + len(name), F.length(path)))


def stem(path: Column) -> Column:
    name = F.substring_index(path, "/", -1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def list_documents(spark: SparkSession, folder: str, ext: str = ".pdf") -> DataFrame:
    """Files directly in ``folder`` by extension, case ignored. Contents are not read."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", any_case_glob(ext)).load(folder)
    )
    return files.select("path", stem(F.col("path")).alias("doc")).orderBy("path")


def read_pages(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """A page table: doc, page_number (from 1), text (may be null)."""
    return spark.read.schema(PAGES_SCHEMA).format(format).load(path)


def read_page_text_files(spark: SparkSession, folder: str, ext: str = ".txt") -> DataFrame:
    """Whole-text files whose pages end or are set apart by form feeds, one row per page."""
    files = spark.read.option("pathGlobFilter", any_case_glob(ext)).text(folder, wholetext=True)
    pages = F.split(F.regexp_replace("value", r"\f\z", ""), r"\f")
    return files.select(
        stem(file_path()).alias("doc"), F.posexplode(pages).alias("i", "text")
    ).select("doc", (F.col("i") + 1).cast("int").alias("page_number"), "text")


def read_sections(spark: SparkSession, folder: str, ext: str = ".txt") -> DataFrame:
    """Section files below ``folder``: rel_path, out_path (its QA file), text."""
    files = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", any_case_glob(ext))
        .text(folder, wholetext=True)
    )
    rel_path = relative_to(file_path(), folder)
    return files.select(
        rel_path.alias("rel_path"), qa_path(rel_path).alias("out_path"), F.col("value").alias("text")
    )


def read_section_table(spark: SparkSession, folder: str) -> DataFrame:
    """Sections as the split job writes them: rel_path, out_path, text, ready for requests."""
    rows = read_documents(spark, folder, SECTIONS_SCHEMA)
    rel_path = F.concat_ws("/", "doc", F.concat("title", F.lit(".txt")))
    return rows.select(
        rel_path.alias("rel_path"), qa_path(rel_path).alias("out_path"), F.col("content").alias("text")
    )


def read_extract_log(spark: SparkSession, folder: str) -> DataFrame:
    """The extraction log as the split job writes it."""
    return read_documents(spark, folder, LOG_SCHEMA, "json")


def read_text_dump(spark: SparkSession, path: str) -> DataFrame:
    """One whole-text file as a document."""
    files = spark.read.text(path, wholetext=True)
    return files.select(stem(file_path()).alias("doc"), F.col("value").alias("text"))


def qa_path(rel_path: Column) -> Column:
    return F.concat(F.regexp_replace(rel_path, r"(?<=[^/])\.[^./]*$", ""), F.lit(".jsonl"))


def _jsonl(spark: SparkSession, folder: str, glob: str):
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)


def read_qa(spark: SparkSession, folder: str, glob: str = "*.json*") -> DataFrame:
    """All QA files below ``folder`` as one table of the three fields.

    No files is an error, and so is a line that is not an object, when it is read.
    """
    schema = ", ".join(f"{name} string" for name in FIELDS)
    if qa_files(spark, folder, glob).isEmpty():
        raise FileNotFoundError(f"no QA files under {folder}")
    return _jsonl(spark, folder, glob).option("mode", "FAILFAST").schema(schema).json(folder)


def qa_files(spark: SparkSession, folder: str, glob: str = "*.json*") -> DataFrame:
    """The QA files themselves; an empty file counts, its content is not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(folder)
        .select("path")
    )


def read_existing_keys(
    spark: SparkSession, folder: str, glob: str = "*.json*", but: str | None = None
) -> DataFrame:
    """Distinct (rel_path, instruction, output) already written, but for the folder ``but`` in it.

    Lines that do not parse or lack a key field are skipped. ``rel_path`` is the line's own, or
    else the QA file's path relative to ``folder``.
    """
    keys = "rel_path string, instruction string, output string"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], keys)
    lines = (
        _jsonl(spark, folder, glob)
        .schema(f"{keys}, _corrupt_record string")
        .json(folder)
        .withColumn("file", relative_to(file_path(), folder))
    )
    usable = (
        F.col("_corrupt_record").isNull()
        & F.col("instruction").isNotNull()
        & F.col("output").isNotNull()
    )
    if but is not None:
        usable = usable & ~F.col("file").startswith(f"{but}/")
    return (
        lines.where(usable)
        .select(F.coalesce("rel_path", "file").alias("rel_path"), "instruction", "output")
        .distinct()
    )


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    """The newest complete progress version; no progress yet is an empty table."""
    version = latest_version(spark, folder)
    if version is None:
        return spark.createDataFrame([], STORED_PROGRESS_SCHEMA)
    return spark.read.schema(STORED_PROGRESS_SCHEMA).parquet(version)


def read_finished(
    spark: SparkSession, folder: str, files: DataFrame | None = None, but_run: int | None = None
) -> DataFrame:
    """Finished (rel_path, chunk_index) pairs of all runs but one, in the buckets of the files."""
    return read_bucketed(spark, f"{folder}/finished", FINISHED_SCHEMA, files, but_run)


def read_progress_json(spark: SparkSession, path: str) -> DataFrame:
    """Progress from a JSON object file; a missing or corrupt file is an empty table."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], PROGRESS_SCHEMA)
    whole = spark.read.text(path, wholetext=True)
    return whole.select(
        F.explode(F.from_json("value", "map<string,int>")).alias("rel_path", "done")
    ).where(F.col("done").isNotNull())


def check_chunking(progress: DataFrame, target: int, overlap: int) -> None:
    """Progress counts chunks, so it is void under other window sizes: refuse it."""
    other = progress.where((F.col("target") != target) | (F.col("overlap") != overlap))
    if not other.isEmpty():
        raise ValueError(f"progress was made with windows other than {target}/{overlap} words")
