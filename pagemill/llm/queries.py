"""One query for each operator of this subpackage, over its whole table, and SQL where it can tell the same."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import byte_bpe, conversations, html_text, language, minhash, ngram_trie, packing, quality, runs, secrets, simhash, topk, urls
from pagemill.llm.common import table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, packed into sequences of at most 2,048."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer, payload="ids_crc32")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return html_text.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op3_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and its component."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url, judged by rule or by its words."""
    return urls.judge(table(spark, sf_dir, "pages"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and places of secrets in every document."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    told = "transform({}, c -> concat_ws(':', c.kind, string(c.start), string(c.stop)))"
    base = "filter(found, c -> c.kind in ('assign', 'access', 'hex'))"
    return found.select(
        "doc_id",
        *(F.expr(f"bigint(size(filter(found, c -> c.kind = '{kind}')))").alias(f"n_{kind}") for kind in secrets.BASE_KINDS),
        F.sha2(F.concat_ws(",", F.expr(told.format(base))), 256).alias("base_sha256"),
        F.concat_ws(",", F.expr(told.format("found"))).alias("spans"),
    )


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability."""
    return ngram_trie.score(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    predicted = language.predict(docs, language.learn(docs))
    return predicted.select("doc_id", language.is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, path, public_tokenizers.PATTERN).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts and whether it stays."""
    return quality.judge(table(spark, sf_dir, "documents"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best partners of every fiftieth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)


def op11_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of similar shingle sets."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults dealt by crc32 of ``conv_id:turn``; a null value is one space, but for ids and turns."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn"))) % 20
    dealt = rows.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fault") == 3, 2).otherwise(1)
    hit = dealt.where("fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("times"))
    return hit.withColumn("times", F.explode(F.expr("sequence(1, times)"))).drop("times")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after damage, its cheapest repair and a digest of what it gives."""
    rows = table(spark, sf_dir, "conversations")
    repaired = conversations.repair(damaged(rows))
    every = rows.select("conv_id").distinct()
    own = lambda df: df.select(F.struct("conv_id").alias("conv"), *df.columns[1:])
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    told = own(repaired.summary).join(own(conversations.digests(repaired.edits)), "conv")
    return own(every).join(told, "conv", "left").select(
        "conv.conv_id",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def loop_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Of a tenth of the documents the words from a place on become periodic; null ids stay as they are."""
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs of words, the greatest of them, and digests of all and of what is left."""
    found = runs.collapse_runs(table(spark, sf_dir, "documents"), change=loop_tail)
    greater = "b is null or r.length * b.period > b.length * r.period"  # exact; ties go to the earlier
    none = "cast(null as struct<start: long, length: long, period: long>)"
    best = F.expr(f"aggregate(runs, {none}, (b, r) -> if({greater}, r, b))")
    lines = "array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')"
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.*",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.expr(lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_html_extraction": op2_html_extraction,
    "op3_simhash_neardup": op3_simhash_neardup,
    "op4_url_filter": op4_url_filter,
    "op5_secret_scan": op5_secret_scan,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_language_id": op7_language_id,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_quality_rules": op9_quality_rules,
    "op10_top_k": op10_top_k,
    "op11_minhash_neardup": op11_minhash_neardup,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_periodic_runs": op13_periodic_runs,
}

#: The other operators' models, tokenizers, hashes and parsers are beyond SQL; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op10_top_k": """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum([p[1] * p[2] FOR p IN list_zip(q.e, c.e)]), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5""",
}
