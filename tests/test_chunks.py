"""Budgets, windows, resuming and requests."""

import json

import pytest
from pyspark.sql import functions as F

from pagemill.operators import chunks as ck


def sections(spark, **texts):
    return spark.createDataFrame(list(texts.items()), "rel_path string, text string")


@pytest.mark.parametrize(
    "context, budget", [(4096, (3276, 2520, 252)), (8192, (6553, 5040, 504)), (100, (80, 500, 50))]
)
def test_token_budget(spark, context, budget):
    b = ck.token_budget(context)
    assert (b.safe_tokens, b.target, b.overlap) == budget
    row = ck.with_token_budget(spark.createDataFrame([(context,)], "max_context int")).first()
    assert (row["safe_tokens"], row["target"], row["overlap"]) == budget


def test_budgets_agree_for_all_contexts(spark):
    rows = ck.with_token_budget(spark.range(1, 20000).withColumnRenamed("id", "max_context"))
    for row in rows.collect():
        b = ck.token_budget(row["max_context"])
        assert (row["safe_tokens"], row["target"], row["overlap"]) == (b.safe_tokens, b.target, b.overlap)


def test_windows_cover_every_word(spark):
    words = [f"w{i}" for i in range(2000)]
    found = ck.chunk_fixed(sections(spark, a=" ".join(words), b="one", c="")).collect()
    of_a = sorted((r["chunk_index"], r["n_chunks"], r["chunk"]) for r in found if r["rel_path"] == "a")
    assert [(i, n) for i, n, _ in of_a] == [(1, 3), (2, 3), (3, 3)]
    assert [c.split()[0] for _, _, c in of_a] == ["w0", "w650", "w1300"]
    assert of_a[-1][2].split()[-1] == "w1999"
    assert [(r["n_chunks"], r["chunk"]) for r in found if r["rel_path"] != "a"] == [(1, "one"), (1, "")]


def test_small_chunks(spark):
    chunks = ck.chunk_fixed(sections(spark, a=" " + "x" * 49 + "\n", b="x" * 50))
    assert [r["rel_path"] for r in ck.small_chunks(chunks).collect()] == ["a"]
    assert [r["rel_path"] for r in ck.sendable_chunks(chunks).collect()] == ["b"]


def test_resume(spark):
    texts = sections(spark, a="a b c d", b="a b c", c="a b")
    progress = spark.createDataFrame([("a", 2), ("b", 5)], "rel_path string, done int")
    every = ck.chunk_words(texts, 2, 1)
    left = {(r["rel_path"], r["chunk_index"], r["n_chunks"]) for r in ck.chunk_words(texts, 2, 1, progress).collect()}
    assert left == {("a", 3, 3), ("c", 1, 1)}
    assert left == {
        (r["rel_path"], r["chunk_index"], r["n_chunks"]) for r in ck.resume_filter(every, progress).collect()
    }
    done = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "rel_path string, chunk_index int")
    assert {(r["rel_path"], r["chunk_index"]) for r in ck.resume_failed(every, done).collect()} == {
        ("a", 2), ("b", 1), ("c", 1)
    }


def test_request_bodies(spark):
    chunks = ck.chunk_words(sections(spark, a=" say é \n"), 10, 1)
    body = ck.build_request(chunks, "m", 3276, prompt=" be brief\n")
    row = body.select(F.to_json("request").alias("j")).first()
    assert json.loads(row["j"]) == {
        "model": "m",
        "messages": [{"role": "system", "content": "be brief"}, {"role": "user", "content": "say é"}],
        "temperature": 0.3,
        "max_tokens": 3276,
        "stream": False,
    }
    early = ck.build_request_v0(chunks, "m").select(F.to_json("request").alias("j")).first()
    parsed = json.loads(early["j"])
    assert parsed["max_tokens"] == 8192 and "stream" not in parsed
    assert parsed["response_format"] == {"type": "json_object"}
    plain = ck.build_request_v0(chunks, "m", json_object=False)
    assert "response_format" not in plain.schema["request"].dataType.names


def test_label(spark):
    chunks = ck.chunk_words(sections(spark, a="a b c"), 2, 1)
    assert sorted(r[0] for r in chunks.select(ck.chunk_label()).collect()) == ["a : chunk 1/2", "a : chunk 2/2"]
