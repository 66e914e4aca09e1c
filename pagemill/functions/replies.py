"""Column functions on model replies and on the JSON values in them."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import SPACE, bind, strip

FIELDS = ("instruction", "input", "output")

# The words an instruction may start with.
OPENING_WORDS = (
    "Explain", "Describe", "List", "Give", "Summarize", "Create", "Formulate", "Generate",
    "Why", "How", "What", "When", "Where", "Who",
)

# A value no reply holds, put behind a text to see that parsing got there.
END = "\x01end\x02"
END_ESCAPED = r"\u0001end\u0002"

# Type of a list of objects whose values a plain cast to text prints right.
TEXT_OBJECTS = r"^ARRAY<OBJECT<(?:[^:<>,]+: (?:STRING|BIGINT|VOID)(?:, )?)+>>$"


def strip_think_tags(raw: Column) -> Column:
    """Remove think tags; what stands between them stays."""
    tagless = F.regexp_replace(raw, rf"(?iU)<{SPACE}*/?{SPACE}*think{SPACE}*>", "")
    return F.when(raw.contains("<"), tagless).otherwise(raw)


def fix_trailing_commas(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U),{SPACE}*\]", "]")


def strip_line_separators(c: Column) -> Column:
    return F.translate(c, "\u2028\u2029", "")


def enclosed(text: Column) -> Column:
    """The text parsed as the first of two elements, null where that fails."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{END_ESCAPED}"]')))


def enclosed_array(outer: Column) -> Column:
    """The list in an ``enclosed`` text that is one non-empty JSON list (a variant), else null.

    The text starts with ``[``. The parser stops after a first complete value and ignores what
    follows, so the second element must be found right behind the first.
    """
    ends = F.try_variant_get(outer, "$[1]", "string") == END
    nothing_more = F.try_variant_get(outer, "$[2]", "variant").isNull()
    not_empty = F.try_variant_get(outer, "$[0][0]", "variant").isNotNull()
    return F.when(ends & nothing_more & not_empty, F.try_variant_get(outer, "$[0]", "variant"))


def parse_array(text: Column) -> Column:
    return bind(enclosed(text), enclosed_array)


def array_span(raw: Column) -> Column:
    """Cleaned reply from its first ``[`` to its last ``]``; empty if there is none.

    Cut out before cleaning, which moves neither bracket and then has less to do.
    """
    start = F.instr(raw, "[")
    after = F.length(F.substring_index(raw, "]", -1))
    span = F.substring(raw, start, F.length(raw) - after - start + 1)
    return F.when(start > 0, fix_trailing_commas(strip_think_tags(span))).otherwise("")


def list_at_end(text: Column) -> Column:
    """The text from the ``[`` that its last ``]`` closes, up to that ``]``; empty if there is none.

    Brackets are counted from the right. Quotes seen on the way tell which of them stand inside strings; an
    escaped quote is none. One pass: each bracket and quote is looked at once.
    """
    span = F.regexp_extract(text, r"(?s)^.*\]", 0)
    marks = F.reverse(F.regexp_extract_all(span, F.lit(r'(\\["\\]|["\[\]])'), F.lit(1)))
    start = F.struct(
        F.lit(0).alias("depth"), F.lit(False).alias("quoted"), F.lit(0).alias("opened"), F.lit(0).alias("found")
    )

    def step(state: Column, mark: Column) -> Column:
        bare = ~state.quoted
        depth = state.depth + F.when(bare & (mark == "]"), 1).when(bare & (mark == "["), -1).otherwise(0)
        opened = state.opened + (mark == "[").cast("int")
        closes = (state.found == 0) & (mark == "[") & bare & (depth == 0)
        return F.struct(
            depth.alias("depth"),
            (state.quoted != (mark == '"')).alias("quoted"),
            opened.alias("opened"),
            F.when(closes, opened).otherwise(state.found).alias("found"),
        )

    return bind(
        F.struct(span.alias("span"), F.aggregate(marks, start, step, lambda state: state.found).alias("found")),
        lambda s: F.when(
            s["found"] > 0, F.concat(F.lit("["), F.call_function("substring_index", s["span"], F.lit("["), -s["found"]))
        ).otherwise(""),
    )


def scan_for_array(
    raw: Column, required: tuple[str, ...] = ("instruction",), fix_commas_first: bool = False
) -> Column:
    """The first ``[`` from which the text up to the last ``]`` parses as a list.

    It must name every required key. Of all ``[`` only the one that the last ``]`` closes can begin
    such a list, so one text is parsed, however many brackets there are.
    """
    text = strip_line_separators(strip_think_tags(raw))
    if fix_commas_first:
        text = fix_trailing_commas(text)

    def attempt(candidate: Column) -> Column:
        named = candidate != ""
        for key in required:
            named = named & candidate.contains(f'"{key}"')
        ready = candidate if fix_commas_first else fix_trailing_commas(candidate)
        return F.when(named, parse_array(ready))

    return bind(list_at_end(text), attempt)


def elements(items: Column) -> Column:
    return F.try_variant_get(items, "$", "array<variant>")


def field(item: Column, name: str) -> Column:
    return F.try_variant_get(item, f"$.{name}", "variant")


def is_object(item: Column) -> Column:
    return F.schema_of_variant(item).startswith("OBJECT<")


def holds_only_text(items: Column) -> Column:
    """True if every element is an object (or null) of strings, whole numbers or null."""
    return F.schema_of_variant(items).rlike(TEXT_OBJECTS)


def text_fields(items: Column) -> Column:
    """The three fields of each element by one cast; exact where ``holds_only_text``."""
    fields = ", ".join(f"{name}: string" for name in FIELDS)
    return F.try_variant_get(items, "$", f"array<struct<{fields}>>")


_RECORD = T.StructType([T.StructField(name, T.StringType()) for name in FIELDS])


@F.pandas_udf(T.ArrayType(_RECORD))
def printed_fields(spans):
    """The three fields of each element where some value is not text.

    A list prints as its elements joined by a blank, an object as JSON, null as nothing, the rest
    as Python prints it: forms of floats, booleans and nested values that no cast gives. Half a
    surrogate pair prints as a question mark, as in replies of text alone. Called with null for
    replies that hold only text, which pass through untouched.
    """
    printed = {
        type(None): lambda value: "",
        list: lambda value: " ".join(str(element) for element in value),
        dict: lambda value: json.dumps(value, ensure_ascii=False),
    }

    def whole(text):
        return text.encode("utf-8", "replace").decode("utf-8")

    def fields(element):
        if not isinstance(element, dict):
            return None
        values = {name: element.get(name) for name in FIELDS}
        return {name: whole(printed.get(type(v), str)(v)) for name, v in values.items()}

    return spans.map(lambda span: span and [fields(element) for element in json.loads(span)])


def is_valid(instruction: Column, input: Column, output: Column) -> Column:
    """The acceptance rule for stripped fields."""
    one_line = F.lit(True)
    for c in (instruction, input, output):
        one_line = one_line & ~c.rlike(r"[\n\r]")
    opens = instruction.rlike(rf"(?iu)^({'|'.join(OPENING_WORDS)})")
    return (
        (instruction != "") & (output != "") & one_line & (instruction.endswith("?") | opens)
    )


def stripped(c: Column) -> Column:
    """Stripped text; a missing field is empty."""
    return strip(F.coalesce(c, F.lit("")))
