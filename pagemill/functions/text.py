"""Column functions on text. All are native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that count as whitespace, and the patterns built on them.
# Java's Unicode \s leaves out U+001C..U+001F, so the class names them.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
SPACE = r"[\s\x1c-\x1f]"
SPACE_IN_LINE = r"[\s\x1c-\x1f&&[^\n]]"
NUMBER = r"\d++(?:\.\d++)++"
# A heading: a dotted number first on its line, then a title on that line or the next non-blank
# one. (?d): only \n ends a line. Possessive quantifiers keep long runs linear.
HEADING = rf"(?mdU)^{SPACE_IN_LINE}*+({NUMBER}){SPACE}+([^\n]+)"
BARE_NUMBER = rf"(?U)\A{SPACE}*+{NUMBER}{SPACE}*+\z"
RESERVED_IN_NAMES = r'[\\/*?:"<>|]'
CONTROL_CHARS = r"[\x00-\x08\x0B-\x1F]"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(SPACES))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(SPACES))


def is_blank(c: Column) -> Column:
    return strip(c) == ""


def strip_control_chars(c: Column) -> Column:
    """Drop code points below 32 other than newline and tab."""
    return F.regexp_replace(c, CONTROL_CHARS, "")


def split_words(c: Column) -> Column:
    """Split on whitespace runs; an empty word at either edge is kept."""
    return F.split(c, rf"(?U){SPACE}+")


def word_count(c: Column) -> Column:
    """Number of whitespace-separated words; 0 for blank text."""
    return F.when(is_blank(c), F.lit(0)).otherwise(F.size(split_words(strip(c))))


def cut_fixed(c: Column, size: int) -> Column:
    """Consecutive pieces of ``size`` code points, in one pass over the text."""
    return F.regexp_extract_all(c, F.lit(f"(?s).{{1,{int(size)}}}"), F.lit(0))


def heading_pieces(text: Column) -> Column:
    """Text cut in front of every heading; the first element is what precedes them all.

    A two-character marker goes in front of each heading. Its first character is escaped where
    the text already has it, so no input can be mistaken for a marker.
    """
    escaped = F.replace(text, F.lit("\x01"), F.lit("\x01\x02"))
    return F.split(F.regexp_replace(escaped, HEADING, "\x01\x03$0"), "\x01\x03")


def piece_text(piece: Column) -> Column:
    return F.replace(piece, F.lit("\x01\x02"), F.lit("\x01"))


def heading_number(piece: Column) -> Column:
    return F.regexp_extract(piece, HEADING, 1)


def heading_title(piece: Column) -> Column:
    return piece_text(F.regexp_extract(piece, HEADING, 2))


def drop_trailing_number(title: Column) -> Column:
    """Remove a page number at the end of a title, and blanks after it."""
    return F.regexp_replace(rstrip(title), r"(?U)(?<!\d)\d+\z", "")


def clean_title(title: Column) -> Column:
    """Dot leaders become a blank; a trailing page number goes."""
    return strip(drop_trailing_number(F.regexp_replace(title, r"\.{2,}", " ")))


def safe_filename(name: Column) -> Column:
    name = F.regexp_replace(name, RESERVED_IN_NAMES, "_")
    name = F.regexp_replace(name, rf"(?U){SPACE}+", "_")
    name = F.regexp_replace(name, r"\.{2,}", "_")
    return F.btrim(name, F.lit("_"))


def section_name(number: Column, title: Column) -> Column:
    return safe_filename(F.concat(number, F.lit("_"), clean_title(title)))


def section_name_v0(number: Column, title: Column) -> Column:
    """Early naming rule: dot leaders vanish, edge underscores and single dot runs stay."""
    title = drop_trailing_number(F.regexp_replace(strip(title), r"\.{2,}", ""))
    name = strip(F.concat(number, F.lit("_"), title))
    name = F.regexp_replace(name, RESERVED_IN_NAMES, "_")
    return F.regexp_replace(name, rf"(?U){SPACE}+", "_")


def clean_body(content: Column) -> Column:
    """Delete dot leaders and lines that hold only a page number."""
    content = F.regexp_replace(content, r"\.{10,}", "")
    return F.regexp_replace(content, rf"(?U)\n{SPACE}*\d+{SPACE}*\n", "\n")


def word_windows(text: Column, target: Column | int, overlap: Column | int) -> Column:
    """Overlapping windows of ``target`` words joined by one blank; the last reaches the end."""
    target, overlap = _int(target), _int(overlap)
    step = target - overlap

    def windows(words: Column) -> Column:
        extra = F.greatest(F.size(words) - target, F.lit(0))
        n = F.ceil(extra / step).cast("int") + 1
        return F.transform(
            F.sequence(F.lit(1), n),
            lambda i: F.array_join(F.slice(words, (i - 1) * step + 1, target), " "),
        )

    return bind(split_words(text), windows)


def _int(value: Column | int) -> Column:
    return value if isinstance(value, Column) else F.lit(int(value))
