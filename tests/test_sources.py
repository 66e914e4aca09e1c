"""Readers and writers, round trips on fresh folders."""

import json

import pytest

from pagemill.operators import training as tr
from pagemill.sources import readers as rd
from pagemill.sources import writers as wr

SECTIONS = "doc string, seq int, kind string, title string, content string, words int"
QA = "rel_path string, instruction string, input string, output string"


def test_list_documents(spark, tmp_path):
    for name in ("b.PDF", "a c.pdf", "x.txt"):
        (tmp_path / name).write_bytes(b"x")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "z.pdf").write_bytes(b"x")
    found = rd.list_documents(spark, str(tmp_path))
    assert [r["doc"] for r in found.collect()] == ["a c", "b"]
    assert tr.input_files_check(found) == 2
    with pytest.raises(FileNotFoundError):
        tr.input_files_check(rd.list_documents(spark, str(tmp_path), ".doc"))


def test_read_sections(spark, tmp_path):
    (tmp_path / "d 1+%").mkdir()
    (tmp_path / "d 1+%" / "one.two.TXT").write_text("a\nb\n", encoding="utf-8")
    (tmp_path / "three.md").write_text("no")
    row = rd.read_sections(spark, str(tmp_path)).collect()
    assert [(r["rel_path"], r["out_path"], r["text"]) for r in row] == [
        ("d 1+%/one.two.TXT", "d 1+%/one.two.jsonl", "a\nb\n")
    ]
    dump = rd.read_text_dump(spark, str(tmp_path / "three.md")).first()
    assert (dump["doc"], dump["text"]) == ("three", "no")


def test_pages(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "doc.txt").write_text("p1\nx\fp2\f\fp4\f")
    pages = rd.read_page_text_files(spark, str(tmp_path / "in"))
    assert [tuple(r) for r in pages.orderBy("page_number").collect()] == [
        ("doc", 1, "p1\nx"), ("doc", 2, "p2"), ("doc", 3, ""), ("doc", 4, "p4")
    ]
    for format in ("parquet", "json"):
        path = str(tmp_path / format)
        pages.write.format(format).save(path)
        assert rd.read_pages(spark, path, format).count() == 4


def test_sections_of_a_document_are_replaced_together(spark, tmp_path):
    path = str(tmp_path / "sections")
    wr.write_sections(spark.createDataFrame([("a", 1, "heading", "t1", "x", 1), ("a", 2, "heading", "t2", "x", 1), ("b", 1, "part", "p", "y", 1)], SECTIONS), path)
    wr.write_sections(spark.createDataFrame([("a", 1, "heading", "t3", "z", 1)], SECTIONS), path)

    def found():
        return {(r["rel_path"], r["text"]) for r in rd.read_section_table(spark, path).collect()}

    assert found() == {("a/t3.txt", "z"), ("b/p.txt", "y")}
    none = spark.createDataFrame([], SECTIONS)
    wr.write_sections(none, path, spark.createDataFrame([("b",), ("b",), ("c",)], "doc string"))
    assert found() == {("a/t3.txt", "z")}
    broken = spark.createDataFrame([("a", 1, "heading", "t9", "lost", 1)], SECTIONS)
    broken.write.parquet(f"{path}/rows/run=4")
    assert found() == {("a/t3.txt", "z")}  # a run that broke off before its documents were listed
    wr.write_sections(spark.createDataFrame([("b", 1, "part", "q", "new", 1)], SECTIONS), path)
    assert found() == {("a/t3.txt", "z"), ("b/q.txt", "new")}


def test_folders_do_not_grow_with_documents(spark, tmp_path):
    rows = [(f"d{k}", 1, "part", "p", "x", 1) for k in range(2000)]
    wr.write_sections(spark.createDataFrame(rows, SECTIONS), str(tmp_path / "s"))
    files = [f for f in (tmp_path / "s").rglob("*.parquet")]
    assert len(files) <= 16 and rd.read_section_table(spark, str(tmp_path / "s")).count() == 2000


def test_qa_round_trip(spark, tmp_path):
    path = str(tmp_path / "qa")
    records = spark.createDataFrame([("f.txt", "Q?", None, "é ")], QA)
    wr.append_qa(records, path)
    wr.append_qa(records, path)
    lines = [l for f in (tmp_path / "qa").glob("*.json") for l in f.read_text(encoding="utf-8").split("\n") if l]
    assert len(lines) == 2 and "é" in lines[0]
    assert json.loads(lines[0]) == {"rel_path": "f.txt", "instruction": "Q?", "input": "", "output": "é "}
    assert rd.read_qa(spark, path).count() == 2
    assert [tuple(r) for r in rd.read_existing_keys(spark, path).collect()] == [("f.txt", "Q?", "é ")]
    wr.write_qa(records, path)
    assert rd.read_qa(spark, path).count() == 1
    with pytest.raises(FileNotFoundError):
        rd.read_qa(spark, str(tmp_path), "*.nothing")


def test_existing_keys_of_foreign_files(spark, tmp_path):
    (tmp_path / "doc").mkdir()
    (tmp_path / "doc" / "s.jsonl").write_text(
        '{"instruction":"A?","output":"x"}\nnot json\n{"instruction":"B?"}\n'
        '{"instruction":"A?","input":"i","output":"x"}\n{"output":"x"}\n\n[1]\n'
    )
    found = rd.read_existing_keys(spark, str(tmp_path), "*.jsonl").collect()
    assert [tuple(r) for r in found] == [("doc/s.jsonl", "A?", "x")]
    assert rd.read_existing_keys(spark, str(tmp_path / "none")).count() == 0


def test_progress_versions(spark, tmp_path):
    path = str(tmp_path / "progress")
    assert rd.read_progress(spark, path).count() == 0
    first = spark.createDataFrame([("a", 1)], "rel_path string, done int")
    wr.write_progress(first, path, 2520, 252)
    current = rd.read_progress(spark, path)
    wr.write_progress(current.selectExpr("rel_path", "done + 1 as done"), path, 2520, 252)
    (tmp_path / "progress" / "version=9").mkdir()  # not complete: ignored
    assert [tuple(r) for r in rd.read_progress(spark, path).collect()] == [("a", 2, 2520, 252)]
    rd.check_chunking(rd.read_progress(spark, path), 2520, 252)
    with pytest.raises(ValueError):
        rd.check_chunking(rd.read_progress(spark, path), 800, 150)


def test_progress_json(spark, tmp_path):
    good, bad = tmp_path / "p.json", tmp_path / "bad.json"
    good.write_text('{\n  "a/b.txt": 3,\n  "c.txt": 1\n}')
    bad.write_text('{"a": 3')
    assert {tuple(r) for r in rd.read_progress_json(spark, str(good)).collect()} == {("a/b.txt", 3), ("c.txt", 1)}
    assert rd.read_progress_json(spark, str(bad)).count() == 0
    assert rd.read_progress_json(spark, str(tmp_path / "none.json")).count() == 0


def test_paths_below_a_folder_whose_name_occurs_before(spark, tmp_path, monkeypatch):
    folder = tmp_path / "sections" / "p" / "sections"
    folder.mkdir(parents=True)
    (folder / "a.txt").write_text("x")
    monkeypatch.chdir(tmp_path)
    found = rd.read_sections(spark, str(folder)).first()
    assert (found["rel_path"], found["out_path"]) == ("a.txt", "a.jsonl")
    assert rd.read_sections(spark, str(tmp_path / "sections")).first()["rel_path"] == "p/sections/a.txt"


def test_broken_qa_lines_fail(spark, tmp_path):
    good = json.dumps({"instruction": "A?", "input": "", "output": "x"})
    for name, line in (("cut", good[:-4]), ("list", "[1,2]")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.jsonl").write_text(f"{good}\n{line}\n")
        with pytest.raises(Exception, match="MALFORMED|FAILFAST|[Mm]alformed"):
            rd.read_qa(spark, str(tmp_path / name)).collect()


def test_section_table_keeps_names(spark, tmp_path):
    rows = [("007", 1, "heading", "1.1_A", "text a", 2), ("7", 1, "heading", "1.1_A", "text b", 2)]
    wr.write_sections(spark.createDataFrame(rows, SECTIONS), str(tmp_path / "s"))
    found = rd.read_section_table(spark, str(tmp_path / "s")).collect()
    assert sorted(map(tuple, found)) == [
        ("007/1.1_A.txt", "007/1.1_A.jsonl", "text a"),
        ("7/1.1_A.txt", "7/1.1_A.jsonl", "text b"),
    ]
