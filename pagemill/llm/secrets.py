"""Secret scans: all rules in one automaton, one pass over a text's bytes.

The pass tells where some rule has a match that ends. From there the rule's reversed automaton runs back to
the leftmost start and its own automaton forward to the longest end; matches of a kind do not overlap, and
matches that fail a rule's length are dropped after they have taken their place.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from operator import getitem, itemgetter
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.automaton import compile_rules, parse
from pagemill.llm.common import as_batch, slices, utf8


class Rule(NamedTuple):
    kind: str
    pattern: bytes
    #: Characters a match needs; of an assigned secret, its value.
    least: int


#: The name of an assigned secret (letters in either case), what may stand between, the value.
NAME, BETWEEN, VALUE = rb"(?:password|passwd|secret|token|api_?key)", rb"[\"']?\x20*[:=]\x20*[\"']?", rb"[A-Za-z0-9+/_.=-]+"
#: The three base kinds come first, in the order in which equal starts are told.
RULES = (
    Rule("assign", NAME + BETWEEN + VALUE, 6),
    Rule("access", rb"AKIA[A-Z0-9]+", 20),
    # Runs below the least length are dropped anyway; a short count here keeps the automaton small.
    Rule("hex", rb"[0-9a-f]{5,}", 24),
    Rule("github", rb"gh[opsur]_[A-Za-z0-9]+", 40),
    Rule("slack", rb"xox[abeprs]-[A-Za-z0-9-]+", 24),
    Rule("web_token", rb"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    Rule("private_key", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1),
)
BASE_KINDS = ("assign", "access", "hex")
#: Bytes scanned at a time; the state goes on.
BYTES_AT_ONCE = 1 << 18


class _Machine:
    def __init__(self, automaton):
        self.classes, self.start, self.masks = automaton.classes, automaton.rows()[0], automaton.masks()

    def longest(self, data: bytes, at: int, stop: int, step: int = 1) -> int:
        """How many bytes the longest match from ``at`` on takes, before ``stop``; 0: none."""
        row, classes, best = self.start, self.classes, 0
        for n, k in enumerate(range(at, stop, step), 1):
            row = row[classes[data[k]]]
            if row[-1]:
                best = n
            elif row[-2]:
                break
        return best

    def ends(self, data: bytes) -> Iterator[tuple[int, int]]:
        """(end, rules) wherever matches that began anywhere can end."""
        row = self.start
        for at in range(0, len(data), BYTES_AT_ONCE):
            rows = list(accumulate(data[at : at + BYTES_AT_ONCE].translate(self.classes), getitem, initial=row))
            row = rows[-1]
            codes = np.frombuffer(bytes(map(itemgetter(-1), rows)), dtype=np.uint8)
            for k in np.nonzero(codes[1:])[0].tolist():
                yield at + k + 1, self.masks[codes[k + 1]]


@lru_cache(maxsize=1)
def _machines() -> tuple[_Machine, list[_Machine], list[_Machine], _Machine]:
    """All rules at once, each rule forward, each backward, and what comes before an assigned value."""
    head = ("then", [parse(NAME, ignore_case=True), parse(BETWEEN)])
    trees = [("then", [head, parse(VALUE)]) if r.kind == "assign" else parse(r.pattern) for r in RULES]
    return (
        _Machine(compile_rules(trees, anywhere=True)),
        [_Machine(compile_rules([t], anywhere=False)) for t in trees],
        [_Machine(compile_rules([t], anywhere=False, reverse=True)) for t in trees],
        _Machine(compile_rules([head], anywhere=False)),
    )


def byte_spans(data: bytes) -> list[tuple[int, int, int]]:
    """(start, end, rule number) of every match, in bytes, by start and then rule."""
    every, forward, back, head = _machines()
    found, free = [], [0] * len(RULES)
    for end, mask in every.ends(data):
        for which, rule in enumerate(RULES):
            if not mask >> which & 1 or end <= free[which]:
                continue
            length = back[which].longest(data, end - 1, free[which] - 1, -1)
            if not length:
                continue
            start = end - length
            stop = start + forward[which].longest(data, start, len(data))
            free[which] = stop
            counted = start + head.longest(data, start, stop) if rule.kind == "assign" else start
            if stop - counted >= rule.least:
                found.append((start, stop, which))
    return sorted(found, key=lambda s: (s[0], s[2]))


def spans(data: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every secret of a UTF-8 text, in code points, end exclusive."""
    found = byte_spans(data)
    if not found:
        return []
    if data.isascii():
        return [(RULES[which].kind, start, stop) for start, stop, which in found]
    points = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80, out=points[1:])
    return [(RULES[which].kind, int(points[start]), int(points[stop])) for start, stop, which in found]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, found (array of struct kind, start, stop), by start and then rule.

    Null and empty texts have none. Every row is scanned on its own, repeated or not; other columns are
    ignored; an empty table gives an empty one.
    """
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("found", pa.list_(item))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [[dict(zip(("kind", "start", "stop"), s, strict=True)) for s in spans(t)] for t in utf8(part.column("text"))]
                yield as_batch(schema, part.column("doc_id"), found)

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, found array<struct<kind:string,start:long,stop:long>>")


def redact_text(data: bytes) -> str | None:
    """The text with each secret as its kind in brackets, overlapping ones as one; None: no secret."""
    out, at = [], 0
    for start, stop, which in byte_spans(data):
        if stop <= at:
            continue
        if start >= at:
            out.append(data[at:start] + b"[" + RULES[which].kind.encode() + b"]")
        at = stop
    return b"".join([*out, data[at:]]).decode() if out else None


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns, secrets in the text replaced by their kind; null stays null."""

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or (r := redact_text(t.encode())) is None else r for t in texts], dtype=object)

    return docs.withColumn(text_col, cleaned(F.col(text_col).cast("string")))
