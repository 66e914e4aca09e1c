"""Hand-written cases for the text functions."""

import pytest
from pyspark.sql import functions as F

from pagemill.functions import text as tx


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def apply(spark, function, text, *args):
    return value(spark, function(F.lit(text), *args))


def test_spaces_are_those_python_strips():
    assert sorted(tx.SPACES) == [chr(c) for c in range(0x110000) if chr(c).isspace()]


@pytest.mark.parametrize("text", ["", " ", " a b\x1f\x85", "a", "\n\t x y \x1c", "​x"])
def test_strip_words_and_counts(spark, text):
    assert apply(spark, tx.strip, text) == text.strip()
    assert apply(spark, tx.word_count, text) == len(text.split())


@pytest.mark.parametrize("text, words", [("", [""]), ("  a b  ", ["", "a", "b", ""]), ("a\x1fb　c", ["a", "b", "c"])])
def test_split_words_keeps_edges(spark, text, words):
    assert apply(spark, tx.split_words, text) == words


def test_control_chars(spark):
    assert apply(spark, tx.strip_control_chars, "a\x07b\r\n\tc\x7f\x85\x1c") == "ab\n\tc\x7f\x85"


@pytest.mark.parametrize(
    "title, clean",
    [("Foo ..... 12", "Foo"), ("Pentium 4", "Pentium"), ("A..B 3", "A B"), ("12", ""), ("x 1 2 ", "x 1"), ("a.b", "a.b")],
)
def test_clean_title(spark, title, clean):
    assert apply(spark, tx.clean_title, title) == clean


@pytest.mark.parametrize(
    "name, safe",
    [("1.2_a/b: c", "1.2_a_b__c"), ("_x__", "x"), ("a...b", "a_b"), ('\\*?"<>|q', "q"), ("a \t b", "a_b")],
)
def test_safe_filename(spark, name, safe):
    assert apply(spark, tx.safe_filename, name) == safe


@pytest.mark.parametrize(
    "number, title, name",
    [("1.2", " Foo ..... 12", "1.2_Foo"), ("1.2", "a..b  c", "1.2_ab_c"), ("3.4", "... Foo", "3.4__Foo"), ("3.4", "_x_", "3.4__x_")],
)
def test_early_section_name(spark, number, title, name):
    assert value(spark, tx.section_name_v0(F.lit(number), F.lit(title))) == name


@pytest.mark.parametrize(
    "body, clean",
    [
        ("a..........b", "ab"),
        ("a.........b", "a.........b"),
        ("a\n 12 \nb", "a\nb"),
        ("a\n12\n13\nb", "a\n13\nb"),
        ("a\n\n\n7\n\n\nb", "a\nb"),
        ("12\nb", "12\nb"),
    ],
)
def test_clean_body(spark, body, clean):
    assert apply(spark, tx.clean_body, body) == clean


@pytest.mark.parametrize(
    "text, headings",
    [
        ("pre\n\n1.2 Foo ..... 12\nbody\n  3.4.5 Bar 7\nb", [("1.2", "Foo ..... 12"), ("3.4.5", "Bar 7")]),
        ("1.2\n3.4 Foo\nx", [("1.2", "3.4 Foo")]),
        ("1.1\n2.2\n3.3\n4.4\n5.5 x", [("1.1", "2.2"), ("3.3", "4.4"), ("5.5", "x")]),
        ("1 Intro\ntext", []),
        ("a 1.2 b", []),
        ("a\r1.2 Foo", []),
        ("1.2", []),
        ("1.2\n\n\n", []),
        ("١.٢ Foo", [("١.٢", "Foo")]),
        ("1.2.x Foo\n1..2 Foo\n1.2x", []),
        ("a\x01\n1.1 b\x01c", [("1.1", "b\x01c")]),
        ("a\x01\x03\n1.1 b", [("1.1", "b")]),
    ],
)
def test_headings(spark, text, headings):
    pieces = apply(spark, tx.heading_pieces, text)[1:]
    found = [
        (apply(spark, tx.heading_number, p), apply(spark, tx.heading_title, p)) for p in pieces
    ]
    assert found == headings


@pytest.mark.parametrize(
    "text, target, overlap, windows",
    [
        ("a b c", 2, 1, ["a b", "b c"]),
        ("a b", 2, 1, ["a b"]),
        ("", 2, 1, [""]),
        ("a b c d e", 3, 1, ["a b c", "c d e"]),
        ("a b c d e f", 3, 1, ["a b c", "c d e", "e f"]),
    ],
)
def test_windows(spark, text, target, overlap, windows):
    assert apply(spark, tx.word_windows, text, target, overlap) == windows


def test_cut_counts_code_points(spark):
    assert apply(spark, tx.cut_fixed, "a\U0001f600b\nc", 2) == ["a\U0001f600", "b\n", "c"]
    assert apply(spark, tx.cut_fixed, "", 2) == []
