"""Streams and jobs: rerunning adds nothing, batches replay safely, pieces equal the whole."""

import json

from pagemill.operators.records import RECORD_COLUMNS, accept_attempts
from pagemill.operators.replies import parse_replies, valid_records
from pagemill.plans import jobs
from pagemill.sources import readers as rd
from pagemill.streaming import incremental as inc

RESPONSES = "rel_path string, chunk_index int, attempt int, raw string, http_error string"


def reply(*pairs):
    return json.dumps([{"instruction": q, "input": "", "output": o} for q, o in pairs])


def test_new_files_are_chunked_once(spark, tmp_path):
    source = tmp_path / "sections"
    (source / "doc").mkdir(parents=True)
    long = " ".join(f"word{i}" for i in range(3000))
    (source / "doc" / "a.txt").write_text(long)
    (source / "b.txt").write_text("tiny")
    out = {n: str(tmp_path / n) for n in ("requests", "small", "checkpoint")}

    def run():
        sections = inc.stream_sections(spark, str(source))
        inc.incremental_chunks(sections, "m", 4096, out["requests"], out["small"], out["checkpoint"])
        sent = spark.read.parquet(out["requests"]).select("rel_path", "chunk_index").collect()
        return sorted(tuple(r) for r in sent)

    assert run() == [("doc/a.txt", 1), ("doc/a.txt", 2)]
    assert run() == [("doc/a.txt", 1), ("doc/a.txt", 2)]
    (source / "c.TXT").write_text("x" * 60)
    assert run() == [("c.TXT", 1), ("doc/a.txt", 1), ("doc/a.txt", 2)]
    assert [r["rel_path"] for r in spark.read.parquet(out["small"]).collect()] == ["b.txt"]


FIRST = [
    ("f.txt", 1, 1, reply(("A?", "1")), None),
    ("f.txt", 2, 1, reply(("A?", "1")), None),
    ("f.txt", 2, 2, reply(("A?", "1"), ("B?", "2")), None),
    ("g.txt", 1, 1, None, "HTTP 500"),
]
SECOND = [
    ("f.txt", 2, 3, reply(("Late?", "x")), None),
    ("f.txt", 3, 1, reply(("B?", "2")), None),
    ("f.txt", 3, 2, reply(("C?", "3"), ("C?", "3")), None),
    ("g.txt", 1, 2, reply(("A?", "1")), None),
]


def keys(rows):
    return sorted((r["rel_path"], r["chunk_index"], r["attempt"], r["instruction"]) for r in rows)


def test_batches_equal_one_run_and_replay(spark, tmp_path):
    store = inc.ReplyStore(str(tmp_path / "store"))
    first = spark.createDataFrame(FIRST, RESPONSES)
    second = spark.createDataFrame(SECOND, RESPONSES)
    schema = valid_records(parse_replies(first)).schema

    def stored():
        return keys(spark.read.schema(schema).json(store.qa).select(*RECORD_COLUMNS).collect())

    inc.accept_batch(first, 0, store)
    inc.accept_batch(second, 1, store)
    whole = accept_attempts(valid_records(parse_replies(first.unionByName(second))))
    assert stored() == keys(whole.collect())
    before = stored()
    inc.accept_batch(second, 1, store)  # replay of the last batch
    assert stored() == before
    assert {tuple(r) for r in store.done(spark).collect()} == {("f.txt", 3), ("g.txt", 1)}
    reasons = sorted(
        (r["rel_path"], r["chunk_index"], r["attempt"], r["reason"])
        for r in spark.read.json(store.failures).collect()
    )
    assert reasons == [
        ("f.txt", 2, 1, "no_valid_objects"),
        ("f.txt", 3, 1, "no_valid_objects"),
        ("g.txt", 1, 1, "http_error"),
    ]


def test_jobs_end_to_end(spark, tmp_path):
    def path(name):
        return str(tmp_path / name)

    text = "1.1 Alpha\n" + "alpha words " * 60 + "\n1.2 Beta\n" + "beta words " * 60
    pages = spark.createDataFrame(
        [("doc", 1, text), ("doc", 2, ""), ("plain", 1, "no headings " * 80)],
        "doc string, page_number int, text string",
    )
    jobs.split_job(pages, path("sections"), path("log"))
    sections = rd.read_section_table(spark, path("sections"))
    names = {"doc/1.1_Alpha.txt", "doc/1.2_Beta.txt", "plain/part_001.txt"}
    assert {r["rel_path"] for r in sections.collect()} == names

    small = jobs.request_job(sections, "m", 4096, path("progress"), path("requests"))
    sent = spark.read.parquet(path("requests"))
    assert sent.count() == 3
    answers = {
        "doc/1.1_Alpha.txt": reply(("What is alpha?", "a")),
        "doc/1.2_Beta.txt": reply(("bad", "b")),
        "plain/part_001.txt": reply(("Explain plain", "p")),
    }
    responses = spark.createDataFrame(
        [(r["rel_path"], r["chunk_index"], 1, answers[r["rel_path"]], None) for r in sent.collect()],
        RESPONSES,
    )
    folders = (path("qa"), path("progress"), path("failures"))
    jobs.accept_job(responses, small, 4096, *folders)
    assert rd.read_qa(spark, path("qa")).count() == 2
    jobs.request_job(sections, "m", 4096, path("progress"), path("requests2"))
    again = spark.read.parquet(path("requests2"))
    assert [r["rel_path"] for r in again.collect()] == ["doc/1.2_Beta.txt"]
    jobs.accept_job(responses, small, 4096, *folders)  # the same replies bring nothing new
    assert rd.read_qa(spark, path("qa")).count() == 2

    jobs.training_job(spark, path("qa"), path("vocab"), path("rows"), vocab_size=10, max_len=6)
    rows = spark.read.parquet(path("rows")).collect()
    assert len(rows) == 2 and all(len(r["input_ids"]) == len(r["labels"]) == 6 for r in rows)


def test_replies_out_of_order_are_kept(spark, tmp_path):
    store = inc.ReplyStore(str(tmp_path / "store"))
    late = [("f.txt", 3, 1, reply(("C?", "3")), None)]
    early = [
        ("f.txt", 1, 1, reply(("A?", "1")), None),
        ("f.txt", 2, 1, reply(("C?", "3")), None),
    ]
    again = [("f.txt", 2, 2, reply(("B?", "2")), None), ("f.txt", 3, 2, reply(("D?", "4")), None)]
    for batch_id, rows in enumerate((late, early, again)):
        inc.accept_batch(spark.createDataFrame(rows, RESPONSES), batch_id, store)
    stored = spark.read.json(store.qa)
    assert keys(stored.collect()) == [
        ("f.txt", 1, 1, "A?"),
        ("f.txt", 2, 2, "B?"),
        ("f.txt", 3, 1, "C?"),
    ]
    failed = {(r["chunk_index"], r["attempt"]) for r in spark.read.json(store.failures).collect()}
    assert failed == {(2, 1)}
    assert [tuple(r) for r in store.done(spark).collect()] == [("f.txt", 3)]


def test_failed_chunks_come_back_and_broken_runs_repeat(spark, tmp_path, monkeypatch):
    folders = [str(tmp_path / n) for n in ("qa", "progress", "failures")]
    words = " ".join(f"w{k}" for k in range(4000))
    sections = spark.createDataFrame([("f.txt", words)], "rel_path string, text string")

    def asked(retry):
        jobs.request_job(sections, "m", 4096, folders[1], str(tmp_path / "asked"), retry)
        sent = spark.read.parquet(str(tmp_path / "asked"))
        return sorted(r["chunk_index"] for r in sent.collect())

    def run(*rows):
        small = spark.createDataFrame([], "rel_path string, chunk_index int, n_chunks int")
        jobs.accept_job(spark.createDataFrame(list(rows), RESPONSES), small, 4096, *folders)

    def stored():
        return sorted(r["instruction"] for r in rd.read_qa(spark, folders[0]).collect())

    assert asked(True) == [1, 2]
    first = [("f.txt", 1, 1, "nothing", None), ("f.txt", 2, 1, reply(("B?", "2")), None)]
    run(*first)
    assert stored() == ["B?"] and asked(False) == [] and asked(True) == [1]
    answer = [("f.txt", 1, 1, reply(("A?", "1")), None), ("f.txt", 1, 2, reply(("Z?", "9")), None)]
    with monkeypatch.context() as broken:
        broken.setattr(jobs, "write_progress", lambda *a: (_ for _ in ()).throw(OSError()))
        try:
            run(*answer)
        except OSError:
            pass
    run(*answer)  # the same run again: it replaces what the broken one wrote
    assert stored() == ["A?", "B?"] and asked(True) == []
    run(*first, *answer)
    assert stored() == ["A?", "B?"]
