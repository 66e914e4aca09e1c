"""Rendering, vocabulary and fixed-length rows."""

from pagemill.operators import training as tr


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "id int, text string")


def test_render(spark):
    qa = spark.createDataFrame(
        [(" I ", "  ", " O "), ("I", " x\ty ", "O"), ("I", None, None)],
        "instruction string, input string, output string",
    )
    assert [r["text"] for r in tr.render_training_text(qa).collect()] == [
        "Instruction:\nI\nResponse:O",
        "Instruction:\nI\nInput:\nx\ty\nResponse:O",
        "Instruction:\nI\nResponse:",
    ]
    assert tr.project_text(tr.render_training_text(qa)).columns == ["text"]


def test_vocab(spark):
    found = tr.build_vocab(texts(spark, "b a b c", " a\nd ", ""), 3).collect()
    assert [(r["token"], r["n"], r["id"]) for r in found] == [("a", 2, 2), ("b", 2, 3), ("c", 1, 4)]
    every = tr.build_vocab(texts(spark, " ".join(f"t{k % 700:03}" for k in range(2000))), 10**9)
    counted = {f"t{k:03}": 3 if k < 600 else 2 for k in range(700)}
    order = sorted(counted, key=lambda t: (-counted[t], t))
    assert [tuple(r) for r in every.collect()] == [(t, counted[t], k + 2) for k, t in enumerate(order)]
    assert tr.build_vocab(texts(spark, "", None), 3).collect() == []


def rows(df):
    return {r["id"]: (r["input_ids"], r["attention_mask"], r["labels"]) for r in df.collect()}


EXPECTED = {
    0: ([2, 3, 0, 0], [1, 1, 0, 0], [2, 3, 0, 0]),
    1: ([2, 2, 1, 3], [1, 1, 1, 1], [2, 2, 1, 3]),
    2: ([0, 0, 0, 0], [0, 0, 0, 0], [0, 0, 0, 0]),
}


def test_encode(spark, monkeypatch):
    given = texts(spark, " a b", "a a z b a a", "  ")
    vocab = tr.build_vocab(texts(spark, "a a b"), 2)
    assert rows(tr.encode_fixed_length(given, vocab, 4)) == EXPECTED
    assert rows(tr.encode_by_join(given, vocab, 4, ["id"])) == EXPECTED
    monkeypatch.setattr(tr, "BROADCAST_VOCAB_ROWS", 1)
    assert rows(tr.encode_fixed_length(given, vocab, 4, key=["id"])) == EXPECTED
    assert rows(tr.encode_fixed_length(given, vocab, 4)) == EXPECTED
