"""Model replies to records.

``responses``: rel_path STRING, chunk_index INT, attempt INT, raw STRING, http_error STRING.
``records``: rel_path, chunk_index, attempt, pos INT, instruction, input, output.
All narrow: a reply is parsed where it is read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.replies import (
    FIELDS,
    array_span,
    elements,
    enclosed,
    enclosed_array,
    field,
    holds_only_text,
    is_object,
    is_valid,
    printed_fields,
    scan_for_array,
    stripped,
    text_fields,
)
from ..session import prepare

REPLY_KEY = ["rel_path", "chunk_index", "attempt"]


def _answered():
    return F.col("http_error").isNull() & F.col("raw").isNotNull()


def parse_replies(responses: DataFrame) -> DataFrame:
    """Adds ``items``, the reply's JSON list (null where no non-empty one was found), and ``span``,
    its text."""
    prepare(responses.sparkSession)
    span = F.when(_answered(), array_span(F.col("raw")))
    cut = responses.select(*REPLY_KEY, "http_error", span.alias("span"))
    outer = cut.withColumn("outer", enclosed(F.col("span")))
    return outer.select(
        *REPLY_KEY, "http_error", "span", enclosed_array(F.col("outer")).alias("items")
    )


def scan_replies(
    responses: DataFrame,
    required: tuple[str, ...] = ("instruction",),
    fix_commas_first: bool = False,
) -> DataFrame:
    """As ``parse_replies``, trying every ``[`` as the start."""
    prepare(responses.sparkSession)
    found = scan_for_array(F.col("raw"), required, fix_commas_first)
    return responses.select(*REPLY_KEY, "http_error", F.when(_answered(), found).alias("items"))


def explode_records(parsed: DataFrame) -> DataFrame:
    """One row per list item, in order; ``pos`` counts from 1."""
    return (
        parsed.select(*REPLY_KEY, F.posexplode(elements(F.col("items"))).alias("i", "item"))
        .select(*REPLY_KEY, (F.col("i") + 1).cast("int").alias("pos"), "item")
    )


def _with_texts(parsed: DataFrame) -> DataFrame:
    """Adds ``texts``: per item a struct of the three fields as text, null for non-objects.

    Nearly all replies hold nothing but text and take one cast. Only the others are printed in
    Python, a batch at a time.
    """
    checked = parsed.withColumn("only_text", holds_only_text(F.col("items")))
    printed = printed_fields(F.when(~F.col("only_text"), F.col("span")))
    return checked.withColumn("printed", printed).select(
        *REPLY_KEY,
        "http_error",
        F.col("items").isNotNull().alias("has_list"),
        F.when(F.col("only_text"), text_fields(F.col("items")))
        .otherwise(F.col("printed"))
        .alias("texts"),
    )


def _numbered(record: Column, i: Column, finish: Callable[[Column], Column]) -> Column:
    texts = [finish(record[name]).alias(name) for name in FIELDS]
    return F.when(record.isNotNull(), F.struct((i + 1).cast("int").alias("pos"), *texts))


def reply_records(parsed: DataFrame) -> DataFrame:
    """The three fields of every object item as text; other items are left out."""
    as_text = F.transform(
        F.col("texts"), lambda t, i: _numbered(t, i, lambda c: F.coalesce(c, F.lit("")))
    )
    objects = F.filter(as_text, lambda r: r.isNotNull())
    return _with_texts(parsed).select(*REPLY_KEY, F.inline(objects))


def check_replies(parsed: DataFrame) -> DataFrame:
    """One row per reply: http_error, has_list and ``records``, those that pass the rule.

    Checked inside the array, so each field is worked out once and only good records are exploded.
    """
    stripped_texts = F.transform(F.col("texts"), lambda t, i: _numbered(t, i, stripped))
    good = F.filter(stripped_texts, lambda r: is_valid(*[r[name] for name in FIELDS]))
    return _with_texts(parsed).select(*REPLY_KEY, "http_error", "has_list", good.alias("records"))


def records_of(checked: DataFrame) -> DataFrame:
    rows = checked.select(*REPLY_KEY, F.inline_outer("records"))
    return rows.where(F.col("pos").isNotNull())


def valid_records(parsed: DataFrame) -> DataFrame:
    """Records that pass the acceptance rule, fields flattened and stripped."""
    return records_of(check_replies(parsed))


def valid_records_strict(parsed: DataFrame) -> DataFrame:
    """The same without flattening: a field that is there must be a string."""

    def texts(item: Column, i: Column) -> Column:
        all_strings = is_object(item)
        for name in FIELDS:
            value = field(item, name)
            all_strings = all_strings & (
                value.isNull() | (F.schema_of_variant(value) == "STRING")
            )
        fields = [
            stripped(F.try_variant_get(item, f"$.{name}", "string")).alias(name)
            for name in FIELDS
        ]
        return F.when(all_strings, F.struct((i + 1).cast("int").alias("pos"), *fields))

    found = F.transform(elements(F.col("items")), texts)
    good = F.filter(found, lambda r: is_valid(*[r[name] for name in FIELDS]))
    return parsed.select(*REPLY_KEY, F.inline(good))
