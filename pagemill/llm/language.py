"""Language identification by error-correcting output codes.

Every language has a codeword of bits. For each bit a binary classifier over hashed byte n-grams of letters tells
the languages with a one from those with a zero; a text's language is the one whose codeword has the least
logistic loss against the classifiers' margins, each weighted by how well it tells its two sides apart. A text
whose second-best codeword is almost as near is flagged as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import as_batch, slices, utf8
from pagemill.session import cut_lineage

#: Hashed n-gram features, and bytes of an n-gram.
FEATURES, GRAM = 1 << 15, 3
#: Languages whose counts a task holds at a time.
MOST_HELD = 64
#: Up to so many languages every split of them is a bit of the code; beyond, so many random bits a doubling.
EXHAUSTIVE, BITS_A_DOUBLING = 6, 16
#: Margins are means over a text's n-grams, times this many n-grams at most.
MOST_GRAMS = 64
#: Below this score a text is ambiguous.
LEAST_SCORE = 0.6
UNKNOWN = "und"

#: Letters lower-cased and bytes of other characters as they are, anything else as zero.
_LETTERS = bytes((b | 32 if b < 128 and chr(b).isalpha() else b if b >= 128 else 0) for b in range(256))


class Model(NamedTuple):
    langs: tuple[str, ...]
    #: (languages, bits) of -1 and 1.
    code: np.ndarray
    #: (features, bits): log odds of a bit for one n-gram.
    weights: np.ndarray
    #: How much each bit counts.
    trust: np.ndarray


def gram_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(the feature that ends at each byte of the texts one after the other, or -1; ends of the texts).

    N-grams of white space alone have no feature; a text begins after white space.
    """
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    symbols = np.frombuffer(b"".join(texts).translate(_LETTERS), dtype=np.uint8).astype(np.uint32)
    mixed, any_letter = symbols * np.uint32(0x9E3779B1), symbols > 0
    for back in range(1, GRAM):
        shifted = np.zeros_like(symbols)
        shifted[back:] = symbols[:-back]
        for at in range(back):
            first = ends[:-1] + at
            shifted[first[first < len(symbols)]] = 0
        mixed = (mixed ^ shifted) * np.uint32(0x85EBCA6B + 2 * back)
        any_letter |= shifted > 0
    found = ((mixed ^ mixed >> np.uint32(15)) % np.uint32(FEATURES)).astype(np.int32)
    found[~any_letter] = -1
    return found, ends


def is_held_out(doc_id: Column) -> Column:
    """Documents that are not learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def output_code(n: int, seed: int = 7) -> np.ndarray:
    """(n, bits) of -1 and 1: every split of a few languages; for more, random ones with none alike."""
    if n == 1:
        return np.ones((1, 1), dtype=np.float32)
    if n <= EXHAUSTIVE:
        masks = np.arange(1, 1 << (n - 1))
        bits = masks[None, :] >> np.arange(n)[:, None] & 1
    else:
        rng = np.random.default_rng(seed)
        bits = np.zeros((n, 0), dtype=np.int64)
        while bits.shape[1] < BITS_A_DOUBLING * int(np.ceil(np.log2(n))):
            column = rng.permutation(np.arange(n) % 2)
            bits = np.column_stack([bits, column])
    return (2 * bits - 1).astype(np.float32)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of every language in the rows that are not held out and have a text; none if there are none."""
    labelled = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    labelled = labelled.where(~is_held_out(F.col("doc_id")) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    langs = tuple(sorted(r["lang"] for r in labelled.select("lang").distinct().collect()))
    return fit(langs, cut_lineage(feature_counts(labelled))) if langs else fit((), None)


def feature_counts(labelled: DataFrame) -> DataFrame:
    """(lang, feature, n) over all rows (lang, text), summed by task and then by Spark."""
    schema = pa.schema([("lang", pa.string()), ("feature", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def told():
            for lang, row in held.items():
                seen = np.nonzero(row)[0]
                yield as_batch(schema, [lang] * len(seen), seen.astype(np.int32), row[seen])
            held.clear()

        for batch in batches:
            for part in slices(batch, "text"):
                texts: dict[str, list[bytes]] = {}
                for text, lang in zip(utf8(part.column("text")), part.column("lang").to_pylist(), strict=True):
                    texts.setdefault(lang, []).append(text)
                for lang, own in texts.items():
                    found, _ = gram_features(own)
                    if lang not in held and len(held) >= MOST_HELD:
                        yield from told()
                    held.setdefault(lang, np.zeros(FEATURES, dtype=np.int64))
                    held[lang] += np.bincount(found[found >= 0], minlength=FEATURES)
        yield from told()

    return labelled.mapInArrow(count, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))


def _numbered(batch: pa.RecordBatch, place: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.array([place[x] for x in batch.column("lang").to_pylist()], dtype=np.int64), batch.column("feature").to_numpy(), batch.column("n").to_numpy()


def fit(langs: tuple[str, ...], counts: DataFrame | None) -> Model:
    """Binary classifiers from each language's n-gram counts: log odds between the mean of the languages with a
    one and the mean of those with a zero, all languages alike.

    Spark sums over languages; the driver holds the code and numbers by feature and bit, and by language and bit.
    """
    if not langs:
        return Model((), np.zeros((0, 1), np.float32), np.zeros((FEATURES, 1), np.float32), np.ones(1, np.float32))
    spark = counts.sparkSession
    place, code = {lang: k for k, lang in enumerate(langs)}, output_code(len(langs))
    bits = code.shape[1]
    totals = np.full(len(langs), 0.5 * FEATURES)  # half a count more for each feature
    for row in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect():
        totals[place[row["lang"]]] += row["n"]
    sides = np.concatenate([code > 0, code < 0], axis=1) / totals[:, None]
    schema = pa.schema([("feature", pa.int32()), ("sums", pa.binary())])
    sent = spark.sparkContext.broadcast((place, sides))

    def by_feature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shares = sent.value
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            lang, feature, n = _numbered(batch, number)
            for k in range(0, len(n), 4096):
                own, to = np.unique(feature[k : k + 4096], return_inverse=True)
                sums = np.zeros((len(own), shares.shape[1]))
                np.add.at(sums, to, n[k : k + 4096, None] * shares[lang[k : k + 4096]])
                for f, row in zip(own.tolist(), sums, strict=True):
                    held[f] = held[f] + row if f in held else row
        yield as_batch(schema, [*held], [row.tobytes() for row in held.values()])

    means = np.zeros((FEATURES, 2 * bits))
    for row in counts.repartition("feature").mapInArrow(by_feature, "feature int, sums binary").toLocalIterator():
        means[row["feature"]] = np.frombuffer(row["sums"])
    means = (means + 0.5 * sides.sum(0)) / np.maximum((sides > 0).sum(0), 1)
    ones, zeros = means[:, :bits], means[:, bits:]
    both = (code > 0).any(0) & (code < 0).any(0)
    weights = np.zeros((FEATURES, bits))
    weights[:, both] = np.log(ones[:, both]) - np.log(zeros[:, both])

    sums_schema = pa.schema([("lang", pa.int32()), ("bit", pa.int32()), ("margin", pa.float64())])
    weighed = spark.sparkContext.broadcast((place, weights))

    def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, own = weighed.value
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            lang, feature, n = _numbered(batch, number)
            for k in set(lang.tolist()):
                at = np.nonzero(lang == k)[0]
                held[k] = held.get(k, 0.0) + n[at] @ own[feature[at]]
        for k, row in held.items():
            yield as_batch(sums_schema, [k] * len(row), range(len(row)), row)

    expected = np.tile(0.5 * weights.sum(0), (len(langs), 1))  # each language's mean margin for one n-gram
    for row in counts.mapInArrow(by_language, "lang int, bit int, margin double").groupBy("lang", "bit").agg(F.sum("margin").alias("margin")).collect():
        expected[row["lang"], row["bit"]] += row["margin"]
    expected /= totals[:, None]
    trust = np.where(both, (expected * code).min(0), 1.0)
    trust = np.clip(trust, 0.05, None)
    return Model(langs, code, weights.astype(np.float32), (trust / trust.sum()).astype(np.float32))


def predict_texts(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """(language, score) of every text; ``und`` and 0 without a letter. A tie goes to the first language."""
    data = [(t or "").encode() for t in texts]
    lettered = [t is not None and any(map(str.isalpha, t)) for t in texts]
    rows = [k for k, ok in enumerate(lettered) if ok]
    langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not rows or not model.langs:
        return langs, scores
    found, ends = gram_features([data[k] for k in rows])
    margins, counted = np.zeros((len(rows), model.code.shape[1])), np.zeros(len(rows))
    starts = np.concatenate([[0], ends[:-1]])
    for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
        own = found[a:b]
        own = own[own >= 0]
        counted[k] = len(own)
        if len(own) > FEATURES // 8:  # a long text: by feature
            margins[k] = np.bincount(own, minlength=FEATURES) @ model.weights
        else:
            margins[k] = model.weights[own].sum(0, dtype=np.float64)
    margins *= (np.minimum(counted, MOST_GRAMS) / np.maximum(counted, 1))[:, None]
    ones, zeros = np.logaddexp(0, -margins) * model.trust, np.logaddexp(0, margins) * model.trust
    losses = ones @ (model.code > 0).T + zeros @ (model.code < 0).T
    best = losses.argmin(1)
    likely = np.exp(losses.min(1, keepdims=True) - losses)
    for k, row in enumerate(rows):
        langs[row] = model.langs[best[k]]
    scores[rows] = 1 / likely.sum(1)
    return langs, scores


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred, score (0 to 1), ambiguous.

    A null text and one without a letter are ``und`` with score 0, and so is every row if no language was
    learned. Rows are judged one by one by their text alone; other columns are ignored; an empty table
    gives an empty one.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                langs, scores = predict_texts(sent.value, part.column("text").to_pylist())
                yield as_batch(schema, part.column("doc_id"), langs, scores, scores < LEAST_SCORE)

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows with a language that is not ambiguous, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def clear(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for k in range(0, len(texts), 256):
                langs, scores = predict_texts(sent.value, [None if t is None else t for t in texts[k : k + 256]])
                out += [lang != UNKNOWN and bool(s >= LEAST_SCORE) for lang, s in zip(langs, scores, strict=True)]
            yield pd.Series(out, dtype=bool)

    return docs.where(clear(F.col(text_col).cast("string")))
