"""Inputs for the queries, derived by Spark from the given tables as FIXTURES.md describes.

Every row and every text of ``documents`` and ``conversations`` goes in whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread

LINES_PER_PAGE = 10
LINES_PER_HEADING = 6
CONVERSATIONS_PER_FILE = 8


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as one section file."""
    return documents(spark, sf_dir).select(
        F.format_string("d%d.txt", "doc_id").alias("rel_path"), "text"
    )


def chunk_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to two chunks done per section; a third of the sections has no entry."""
    ids = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id")
    return ids.where(F.col("doc_id") % 3 != 0).select(
        F.format_string("d%d.txt", "doc_id").alias("rel_path"),
        (F.col("doc_id") % 3).cast("int").alias("done"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten lines to a page, a heading line put in front of every sixth line of three documents in
    four; some pages empty, some with control characters, some ending in a dot leader and a line that
    holds only the page's number. Some documents have a blank twin."""
    docs = documents(spark, sf_dir)
    number = "doc_id % 9 + 1"
    marked = F.expr(f"""
        transform(split(text, '\\n'), (line, i) -> CASE
          WHEN doc_id % 4 = 0 OR i % {LINES_PER_HEADING} <> 0 THEN line
          WHEN doc_id % 5 = 0
          THEN format_string('%d.%d Overview .... %d\\n%s', {number}, (i div 6) % 3 + 1, i + 3, line)
          WHEN doc_id % 7 = 0
          THEN format_string('%d.%d\\n%s', {number}, i div 6 + 1, line)
          ELSE format_string('%d.%d %s/%s: topic %d .... %d\\n%s',
                             {number}, i div 6 + 1, lang, source, i div 6 + 1, i + 3, line)
        END)""")
    paged = docs.select("doc_id", marked.alias("lines")).select(
        "doc_id",
        F.posexplode(
            F.expr(f"""
                transform(sequence(0, (size(lines) - 1) div {LINES_PER_PAGE}), p ->
                  array_join(slice(lines, CAST(p * {LINES_PER_PAGE} + 1 AS INT), {LINES_PER_PAGE}),
                             '\\n'))""")
        ).alias("i", "text"),
    ).select("doc_id", (F.col("i") + 1).cast("int").alias("page_number"), "text")
    text = (
        F.when(F.col("page_number") % 14 == 0, F.lit(None).cast("string"))
        .when(F.col("page_number") % 7 == 0, F.lit(""))
        .when(F.col("page_number") % 3 == 0, F.concat(F.lit("\x07\x0c"), F.col("text")))
        .when(
            F.col("page_number") % 5 == 2,
            F.format_string("%s\nto be continued ............ overleaf\n  %d \nend", "text", "page_number"),
        )
        .otherwise(F.col("text"))
    )
    full = paged.select(
        F.format_string("d%d", "doc_id").alias("doc"), "page_number", text.alias("text")
    )
    twins = docs.where(F.col("doc_id") % 13 == 5).select(
        F.format_string("blank%d", "doc_id").alias("doc"),
        F.posexplode(F.array(F.lit(""), F.lit(" \n"))).alias("i", "text"),
    )
    return full.unionByName(
        twins.select("doc", (F.col("i") + 1).cast("int").alias("page_number"), "text")
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation is a chunk, each of its assistant turns an attempt; eight make a file.

    System turns and questions without an answer are attempts too, whose reply is their bare text.

    The turn before and the turn itself, whole but for line breaks (no record may hold one), fill
    twelve kinds of replies: none, empty, broken, wrapped, tagged, repeated, invalid ones and some with
    line separators between the objects.
    """
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    line = F.regexp_replace("text", r"[\r\n]+", " ")
    quoted = F.regexp_extract(F.to_json(F.struct(line.alias("t"))), r'(?s)^\{"t":"(.*)"\}$', 1)
    asked = turns.where("role = 'user'").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), quoted.alias("q")
    )
    told = turns.where("role = 'assistant'").select("conv_id", "turn", quoted.alias("o"))
    pairs = told.join(asked, ["conv_id", "turn"])
    k = "(conv_id * 7 + turn) % 12"
    records = pairs.select(
        "conv_id",
        "turn",
        F.expr(k).alias("k"),
        F.concat(
            F.lit('{"instruction":"Explain '), "q", F.lit('","input":"","output":"'), "o", F.lit('"}')
        ).alias("r1"),
        F.expr(
            """format_string('{"instruction":"What is item %d?","input":["a",%d,null,true],"output":"same"}', conv_id % 3, turn)"""
        ).alias("r2"),
        F.lit('{"instruction":"tell me","input":null,"output":"x"}').alias("r3"),
        F.lit('{"instruction":"Why?","output":"a\\nb"}').alias("r4"),
    )
    raw = F.expr("""
        CASE k WHEN 0 THEN 'no json'
               WHEN 1 THEN '[]'
               WHEN 2 THEN concat('Here: [', r1, ',', r2, ' , ] done')
               WHEN 3 THEN concat('<think>plan</ Think >[', r1, ',', r3, ',"str",5,null]')
               WHEN 4 THEN concat('[1] and [', r1, ']')
               WHEN 5 THEN concat('Note [1]: [', r1, ']')
               WHEN 7 THEN concat('[', r2, ',', r3, ']')
               WHEN 8 THEN concat('[', r4, ',', r3, ']')
               WHEN 6 THEN NULL
               WHEN 10 THEN concat('[', r1, ',\u2028', r2, '\u2029]')
               ELSE concat('[', r1, ',', r2, ',', r3, ',', r4, ',', r1, ']')
        END""")
    answered = F.expr("CAST((turn + 1) div 2 AS INT)").alias("attempt")
    unanswered = F.expr("CAST((turn + IF(role = 'system', 1, 2)) div 2 AS INT)").alias("attempt")
    told_rows = records.select("conv_id", answered, "k", raw.alias("raw"))
    bare = turns.where("role <> 'assistant'").join(
        pairs.select("conv_id", (F.col("turn") - 1).alias("turn")), ["conv_id", "turn"], "left_anti"
    )
    every = told_rows.unionByName(
        bare.select("conv_id", unanswered, F.lit(None).cast("long").alias("k"), F.col("text").alias("raw"))
    )
    return every.select(
        F.expr(f"format_string('f%d.txt', conv_id div {CONVERSATIONS_PER_FILE})").alias("rel_path"),
        F.expr(f"CAST(conv_id % {CONVERSATIONS_PER_FILE} + 1 AS INT)").alias("chunk_index"),
        "attempt",
        "raw",
        F.when(F.col("k") == 6, F.lit("HTTP 500")).alias("http_error"),
    )


def reply_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One chunk done in every second file; a third of the files has no entry."""
    ids = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        F.expr(f"conv_id div {CONVERSATIONS_PER_FILE}").alias("f")
    )
    return (
        ids.distinct()
        .where(F.col("f") % 3 != 0)
        .select(
            F.format_string("f%d.txt", "f").alias("rel_path"),
            (F.col("f") % 2).cast("int").alias("done"),
        )
    )
