"""Sections: hand cases, and the long-document path against plain Python."""

import re
from collections import Counter

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from pagemill.operators import pages as pg
from pagemill.operators import sections as sc

PAGES = "doc string, page_number int, text string"


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.select(*names).collect())


def texts(spark, *values):
    return spark.createDataFrame([(f"d{i}", v) for i, v in enumerate(values)], "doc string, text string")


def test_fixed_parts_keep_numbering_gaps(spark):
    found = sc.fixed_parts(texts(spark, "abcd    efgh"), part_size=4, min_words=1)
    assert rows(found, "title", "content") == [("part_001", "abcd"), ("part_003", "efgh")]


def test_merged_parts_are_numbered_without_gaps(spark):
    text = "1.1 a\n          \n1.2 b"
    found = sc.short_merged(texts(spark, text), min_words=4, part_size=1000)
    assert rows(found, "title", "content") == [("merged_part_001", "1.1 a\n\n1.2 b")]
    found = sc.short_merged(texts(spark, "1.1 aaaa\n1.2 b c d"), min_words=1, part_size=4)
    assert rows(found, "title") == []


def test_later_section_of_the_same_title_wins(spark):
    text = "1.1 X\nfirst one two\n1.1 X\nsecond one two"
    pages = spark.createDataFrame([("d", 1, text)], PAGES)
    for volume_pages in (1000, 0):
        found = sc.split_documents(pages, min_words=3, part_size=100, volume_pages=volume_pages or 1)
        assert rows(found, "title", "content") == [("1.1_X", "1.1 X\nsecond one two")]


def test_all_pages_empty(spark):
    pages = spark.createDataFrame([("d", 1, ""), ("d", 2, None)], PAGES)
    for volume_pages in (1000, 1):
        assert sc.route_documents(pages, volume_pages=volume_pages).rows().count() == 0
        log = sc.extraction_log(pages, volume_pages=volume_pages)
        assert Counter(r["event"] for r in log.collect()) == {"empty_page": 2, "no_text": 1}


def test_log_events(spark):
    pages = spark.createDataFrame(
        [("a", 1, "1.1 Short\nx"), ("b", 1, "no headings here"), ("c", 1, " \n"), ("c", 2, "")], PAGES
    )
    log = sc.extraction_log(pages, 5, 100)
    found = {(r["doc"], r["event"], r["page_number"], r["title"], r["n"]) for r in log.collect()}
    assert found == {
        ("a", "short_section", None, "1.1_Short", 3),
        ("a", "merged_short", None, None, 1),
        ("b", "no_headings", None, None, None),
        ("c", "empty_page", 2, None, None),
        ("c", "no_text", None, None, None),
    }


def test_volumes_join_to_the_whole_text(spark):
    pages = spark.createDataFrame([("d", n, f"p{n}" if n != 4 else "") for n in range(1, 12)], PAGES)
    whole = pg.full_text(pages).collect()
    parts = pg.full_text(pages, 3).orderBy("volume").collect()
    assert len(whole) == 1 and len(parts) == 4
    assert "\n\n".join(r["text"] for r in parts) == whole[0]["text"]
    stats = pg.extraction_stats(pages).first()
    assert (stats["pages_kept"], stats["characters"]) == (10, len(whole[0]["text"]))


# Brute force, written from the rules: lines are walked one by one, headings by their first
# non-blank words.


def brute_sections(page_texts, min_words, part_size):
    kept = [t for t in page_texts if t]
    text = "\n\n".join("".join(c for c in t if c in "\n\t" or c >= " ") for t in kept)
    if not text.strip():
        return {}
    starts, position, consumed = [], 0, 0
    for line in text.split("\n"):
        number = re.match(r"\s*(\d+(\.\d+)+)(?=\s|$)", line)
        if position >= consumed and number:
            rest = text[position + number.end() :]
            at = len(rest) - len(rest.lstrip())
            if at == len(rest):  # nothing but blanks follow: the last one in a line is the title
                at = max((j for j, c in enumerate(rest) if j and c != "\n"), default=0)
            if at:
                title = rest[at:].split("\n")[0]
                starts.append((position, number.group(1), title))
                consumed = position + number.end() + at + len(title)
        position += len(line) + 1

    def parts(whole):
        whole = whole.strip()
        cut = [whole[i : i + part_size].strip() for i in range(0, len(whole), part_size)]
        return [(i + 1, p) for i, p in enumerate(cut) if len(p.split()) >= min_words]

    if not starts:
        return {f"part_{i:03d}": p for i, p in parts(text)}
    ends = [s[0] for s in starts[1:]] + [len(text)]
    written, short = {}, []
    for (start, number, title), end in zip(starts, ends):
        content = text[start:end].strip()
        if len(content.split()) < min_words:
            short.append(content)
            continue
        title = title.rstrip()
        while ".." in title:
            title = re.sub(r"\.\.+", " ", title)
        title = title.rstrip()
        title = title[: len(title) - len(re.search(r"\d*$", title).group())].strip()
        name = re.sub(r"\s+", "_", re.sub(r'[\\/*?:"<>|]', "_", f"{number}_{title}"))
        written[re.sub(r"\.\.+", "_", name).strip("_")] = content
    for n, (_, p) in enumerate(parts("\n\n".join(short)), start=1):
        written[f"merged_part_{n:03d}"] = p
    return written


LINES = st.sampled_from(
    ["1.2", "1.2 Foo .... 3", " 2.1.1 Bar: x 7", "3.1", "word one two", "a b", "", "  ", "4", "4.", "x 1.2 y", "\x07\x0b", " ", "9.9\tTab", "1.2 Foo .... 3"]
)
PAGE = st.one_of(st.none(), st.lists(LINES, max_size=5).map("\n".join))
DOCUMENT = st.lists(PAGE, min_size=1, max_size=7)


@settings(
    max_examples=4,
    phases=[Phase.generate],
    deadline=None,
    derandomize=True,
    suppress_health_check=list(HealthCheck),
)
@given(
    documents=st.lists(DOCUMENT, min_size=60, max_size=120),
    min_words=st.integers(1, 6),
    part_size=st.integers(3, 12),
    volume_pages=st.integers(1, 3),
)
def test_split_equals_brute_force_in_one_volume_and_in_many(
    spark, documents, min_words, part_size, volume_pages
):
    pages = spark.createDataFrame(
        [(f"d{d}", n + 1, t) for d, ps in enumerate(documents) for n, t in enumerate(ps)], PAGES
    )
    expected = {
        (f"d{d}", title, content)
        for d, ps in enumerate(documents)
        for title, content in brute_sections(ps, min_words, part_size).items()
    }
    for size in (1000, volume_pages):
        found = sc.split_documents(pages, min_words, part_size, volume_pages=size)
        got = [(r["doc"], r["title"], r["content"]) for r in found.collect()]
        assert len(got) == len(set(got))
        assert set(got) == expected


def test_long_document_with_one_heading_and_many_volumes(spark):
    pages = spark.createDataFrame(
        [("d", 1, "preamble"), ("d", 2, "1.1"), ("d", 3, "  "), ("d", 4, "Title here 5\nbody")]
        + [("d", n, f"page {n}") for n in range(5, 40)],
        PAGES,
    )
    found = sc.split_documents(pages, 1, 50, volume_pages=1).collect()
    assert [r["title"] for r in found] == ["1.1_Title_here"]
    whole = sc.split_documents(pages, 1, 50).collect()
    assert [r.asDict() for r in found] == [r.asDict() for r in whole]


def test_parts_of_a_long_document_keep_whole_text(spark):
    pages = spark.createDataFrame(
        [("d", n, f"{'x' * (n % 7)} y {n}") for n in range(1, 200)], PAGES
    )
    whole = rows(sc.split_documents(pages, 1, 17), "title", "content")
    parted = rows(sc.split_documents(pages, 1, 17, volume_pages=2), "title", "content")
    assert whole == parted and len(whole) > 50


def test_many_long_documents_are_told_apart_by_salted_join(spark, monkeypatch):
    pages = spark.createDataFrame(
        [(f"d{d}", n, f"1.{n} T\nword {n}") for d in range(9) for n in range(1, d + 2)], PAGES
    )
    expected = rows(sc.split_documents(pages, 1, 50), "doc", "title", "content")
    monkeypatch.setattr(pg, "BROADCAST_DOCS", 1)
    assert rows(sc.split_documents(pages, 1, 50, 3), "doc", "title", "content") == expected


def _odd_pages(spark):
    lines = ["1.1 One", "text", "2.3", "", "Title below", "1.1 One", "more words here", "9", "4.5.6  Deep  .... 12", " "]
    pages = []
    for d in range(12):
        for n in range(1, 14):
            some = [lines[(d * 7 + n * k + k * k) % len(lines)] for k in range(d % 4 + (n % 5 > 0))]
            pages.append((f"d{d}", n, "\n".join(some) if d != 5 else " "))
    return spark.createDataFrame(pages, PAGES).repartition(5)


def test_single_steps_do_not_depend_on_the_volumes(spark):
    """Each step where a document of more than three pages is too long to gather, and where none is."""
    pages = _odd_pages(spark)
    steps = {
        "headings": (sc.document_headings, ["doc", "seq", "number", "raw_title", "content"]),
        "none": (sc.documents_without_headings, ["doc"]),
        "routed": (lambda p, v: sc.route_documents(p, 3, 40, v).rows(), sc.SECTION_COLUMNS),
        "merged": (lambda p, v: sc.route_documents(p, 3, 40, v).merged(), sc.SECTION_COLUMNS),
        "final": (lambda p, v: sc.split_documents(p, 3, 40, v), sc.SECTION_COLUMNS),
        "nonblank": (lambda p, v: pg.nonblank_volumes(p, v).select("doc").distinct(), ["doc"]),
    }
    for name, (step, columns) in steps.items():
        whole, cut = (rows(step(pages, volume_pages), *columns) for volume_pages in (1000, 3))
        assert whole and whole == cut, name


def test_last_write_wins_in_the_array_as_over_rows(spark):
    pages = _odd_pages(spark)
    kept = sc.route_documents(pages, 2, 40).kept()
    every = sc.long_sections(kept.rows(), 2).unionByName(kept.merged())
    assert rows(kept.sections(), *sc.SECTION_COLUMNS) == rows(sc.last_write_wins(every), *sc.SECTION_COLUMNS)
    assert kept.sections().count() < every.count()


def test_the_split_moves_each_text_once(spark):
    """The written plan after assembly: no shuffle or sort of texts but the one into the document folders."""
    sections = sc.route_documents(_odd_pages(spark), 2, 40).kept().sections()
    plan = sections.hint("rebalance", "doc")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SortAggregate" not in plan and "Join" not in plan
