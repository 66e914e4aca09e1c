"""Quality rules: counts of a text's words and lines, and the perplexity of its characters.

A modified Kneser-Ney model for each language is counted by Spark over all distinct texts. Its symbols are 64 classes
of characters that keep the letters of a script apart, so a language has at most 64^4 four-grams whatever the corpus
(some ten thousand in practice): the model is kept in sorted arrays of n-gram hashes, twelve bytes an n-gram, and sent
to all tasks. Texts whose perplexity is outside their language's band are rejected. A language with few distinct texts
would only be held against itself: it is judged by the model and the band of all texts.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import as_batch, slices, utf8
from pagemill.session import cut_lineage

ORDER = 4
BITS = 6  # of a symbol
#: The model of all texts, which those without a language and those of small languages take.
POOLED = ""
#: Distinct texts from which a language has a model and a band of its own.
LEAST_TEXTS = 8
#: Languages whose tables of looked-up n-grams a task holds at a time.
MOST_HELD = 8
#: Words below which, and percentage of words in repeated windows above which, a text fails.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: The band below and above the median of log perplexity: distances to the quartile on that side, and at least so
#: wide.
BELOW, ABOVE = (8.0, 0.08), (10.0, 0.15)
#: Steps of log perplexity in which its distribution is counted.
STEP = 0.005
#: Four-grams that a task sums up before it passes them on.
MOST_SUMS = 1 << 21
#: Bytes of text whose four-grams are looked at together; what is held for them takes up to forty times as much.
AT_ONCE = 1 << 20


@cache
def _symbols() -> np.ndarray:
    """The symbol of each character of the basic plane.

    White space; 26 ASCII letters without case; digits; marks of sentences, other marks and controls in ASCII; marks
    elsewhere; letters elsewhere, without case, by place: 32 neighbours never share a symbol.
    """
    out = np.empty(1 << 16, dtype=np.uint8)
    for code in range(1 << 16):
        sign = chr(code)
        if sign in " \t\n\x0b\x0c\r":
            out[code] = 0
        elif code < 128 and sign.isalpha():
            out[code] = 1 + (code | 32) - 97
        elif code < 128:
            out[code] = 27 if sign.isdigit() else 28 if sign in ".,;:!?'\"()-" else 29 if sign.isprintable() else 30
        else:
            out[code] = 32 + ord(sign.lower()[0]) % 32 if sign.isalpha() else 31
    return out


def symbols(text: bytes) -> np.ndarray:
    """The symbol of each character of a UTF-8 text; characters beyond the basic plane go by place."""
    if text.isascii():
        return _symbols()[np.frombuffer(text, dtype=np.uint8)]
    codes = np.frombuffer(text.decode().encode("utf-32-le"), dtype=np.uint32)
    return np.where(codes < 1 << 16, _symbols()[np.minimum(codes, 0xFFFF)], 32 + codes % 32).astype(np.uint8)


class Counts(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int

    def failed(self) -> bool:
        return self.n_words < LEAST_WORDS or 100 * self.n_repeat_words > MOST_REPEATED * self.n_words


def count_text(data: bytes) -> Counts:
    """The base counts of a UTF-8 text; no bytes have none of anything."""
    words = data.split()
    blanks = sum(map(data.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    points = len(data) if data.isascii() else len(data.decode())
    symbols = sum(map(data.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")))
    lines = [line for line in data.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen = Counter(windows)
        covered = bytearray(len(words))
        for k, window in enumerate(windows):
            if seen[window] > 1:
                covered[k : k + 3] = b"\1\1\1"
        repeated = sum(covered)
    return Counts(len(words), points - blanks, symbols, len(lines) - len(set(lines)), repeated)


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(the four-gram that ends at each character of the texts one after the other, ends of the texts)."""
    parts = [symbols(t) for t in texts]
    ends = np.cumsum([len(x) for x in parts], dtype=np.int64)
    own = np.concatenate([*parts, np.zeros(0, dtype=np.uint8)]).astype(np.int32)
    codes = own.copy()
    for back in range(1, ORDER):
        shifted = np.zeros_like(own)
        shifted[back:] = own[:-back]
        for at in range(back):  # before a text's first character there is white space
            first = ends[:-1] + at
            shifted[first[first < len(own)]] = 0
        codes |= shifted << (BITS * back)
    return codes, ends


class Pages:
    """A number for every four-gram, not known at first; kept only for those first three symbols that came up.

    A page is one last symbol, 256 bytes: pages of two symbols took some 30 MB a language, mostly never asked for.
    """

    def __init__(self):
        self.at = np.full(1 << (ORDER - 1) * BITS, -1, dtype=np.int32)
        self.values = np.zeros(0, dtype=np.float32)

    def places(self, codes: np.ndarray) -> np.ndarray:
        """Where in ``values`` the four-grams are; makes room for new ones."""
        page = codes >> BITS
        at = self.at[page]
        if (at < 0).any():
            fresh = np.unique(page[at < 0])
            self.at[fresh] = len(self.values) + np.arange(len(fresh)) * (1 << BITS)
            self.values = np.concatenate([self.values, np.full(len(fresh) << BITS, np.nan, dtype=np.float32)])
            at = self.at[page]
        return at + (codes & ((1 << BITS) - 1))


def distinct_texts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(text, langs): every text once, with the languages its copies are labelled with; combined by task first."""
    chosen = docs.select(F.col(text_col).cast("string").alias("text"), F.nullif(F.col(lang_col).cast("string"), F.lit(POOLED)).alias("lang"))
    return chosen.groupBy(text_hash("text").alias("hash")).agg(F.first("text").alias("text"), F.collect_set("lang").alias("langs")).drop("hash")


def text_hash(text_col: str) -> Column:
    """By which copies are told; null is as no bytes."""
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def own_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang): those with ``LEAST_TEXTS`` distinct texts or more, by the texts' hashes."""
    hashes = docs.select(F.col(lang_col).cast("string").alias("lang"), text_hash(text_col).alias("hash")).distinct()
    return hashes.groupBy("lang").agg(F.count("*").alias("n")).where((F.col("n") >= LEAST_TEXTS) & (F.col("lang") != POOLED)).select("lang")


def gram_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n) over all distinct texts, and over those of each language with enough of them.

    Tasks sum by the set of a text's languages, so a text is gone through once; Spark sums these up.
    """
    schema = pa.schema([("langs", pa.list_(pa.string())), ("gram", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, ...], tuple[np.ndarray, np.ndarray]] = {}

        def told():
            for langs, (seen, n) in held.items():
                for k in range(0, len(seen), 1 << 16):
                    part = slice(k, k + (1 << 16))
                    yield as_batch(schema, [langs] * len(seen[part]), seen[part], n[part])
            held.clear()

        size = 0
        for batch in batches:
            for part in slices(batch, "text", AT_ONCE):
                groups: dict[tuple[str, ...], list[bytes]] = {}
                for text, langs in zip(utf8(part.column("text")), part.column("langs").to_pylist(), strict=True):
                    groups.setdefault(tuple(sorted(langs)), []).append(text)
                for langs, texts in groups.items():
                    seen, n = np.unique(grams(texts)[0], return_counts=True)
                    if langs in held:
                        seen, where = np.unique(np.concatenate([held[langs][0], seen]), return_inverse=True)
                        n = np.bincount(where, np.concatenate([held[langs][1], n])).astype(np.int64)
                    size += len(seen) - (len(held[langs][0]) if langs in held else 0)
                    held[langs] = seen, n
                    if size > MOST_SUMS:
                        yield from told()
                        size = 0
        yield from told()

    summed = distinct_texts(docs, text_col, lang_col).mapInArrow(run, "langs array<string>, gram int, n long").groupBy("langs", "gram").agg(F.sum("n").alias("n"))
    pooled = F.array(F.lit(POOLED))
    each = summed.select(F.explode(F.concat(pooled, "langs")).alias("lang"), "gram", "n").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    own = own_languages(docs, text_col, lang_col).withColumnRenamed("lang", "own")
    return each.join(own, F.col("lang") == F.col("own"), "left").where((F.col("lang") == POOLED) | F.col("own").isNotNull()).drop("own")


class KneserNey:
    """An interpolated modified Kneser-Ney model in sorted hash arrays, by order."""

    def __init__(self, seen: np.ndarray, counts: np.ndarray):
        """``seen``: different four-grams; ``counts``: how often each came up."""
        by = np.argsort(seen)
        raw = {ORDER: (seen[by].astype(np.int64), counts[by].astype(np.float64))}
        for order in range(ORDER - 1, 0, -1):  # in how many contexts, one symbol longer, it was seen
            shorter, n = np.unique(raw[order + 1][0] & ((1 << BITS * order) - 1), return_counts=True)
            raw[order] = shorter, n.astype(np.float64)
        self.keys: list[np.ndarray] = []
        self.values: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = []
        self.backoffs: list[np.ndarray] = []
        shorter, lower = np.arange(1 << BITS), np.full(1 << BITS, 1 / (1 << BITS))
        for order in range(1, ORDER + 1):
            own, c = raw[order]
            n = [max(1, int((c == k).sum())) for k in (1, 2, 3, 4)]
            share = n[0] / (n[0] + 2 * n[1])
            discounts = np.array([0, *(min(max(k - (k + 1) * share * n[k] / n[k - 1], 0.1), k - 0.05) for k in (1, 2, 3))])
            taken = discounts[np.minimum(c, 3).astype(np.int64)]
            contexts, starts, which = np.unique(own >> BITS, return_index=True, return_inverse=True)
            total = np.add.reduceat(c, starts) if len(own) else np.zeros(0)
            backoff = (np.add.reduceat(taken, starts) if len(own) else np.zeros(0)) / total
            below = lower[np.searchsorted(shorter, own & ((1 << BITS * max(1, order - 1)) - 1))]
            full = (c - taken) / total[which] + backoff[which] * below
            self._keep(order, own, full, contexts, backoff)
            shorter, lower = own, full
        self.unseen = -np.log(1 << BITS)

    def _keep(self, order: int, seen: np.ndarray, values: np.ndarray, contexts: np.ndarray, backoffs: np.ndarray) -> None:
        for grams_, numbers, keys, out in ((seen, values, self.keys, self.values), (contexts, backoffs, self.contexts, self.backoffs)):
            hashed = gram_hash(grams_, order)
            by = np.argsort(hashed)
            keys.append(hashed[by])
            out.append(np.log(numbers[by]).astype(np.float32))

    def log_probabilities(self, wanted: np.ndarray) -> np.ndarray:
        """Natural log of each four-gram's last symbol after its first three."""
        out = np.zeros(len(wanted))
        open_ = np.ones(len(wanted), dtype=bool)
        for order in range(ORDER, 0, -1):
            own = wanted & ((1 << BITS * order) - 1)
            found, value = _look_up(self.keys[order - 1], self.values[order - 1], gram_hash(own, order))
            hit = open_ & found
            out[hit] += value[hit]
            open_ &= ~found
            known, backoff = _look_up(self.contexts[order - 1], self.backoffs[order - 1], gram_hash(own >> BITS, order))
            back = open_ & known
            out[back] += backoff[back]
        out[open_] += self.unseen
        return out


def gram_hash(grams_: np.ndarray, order: int) -> np.ndarray:
    """A 64-bit hash of an n-gram and its order; different n-grams of an order never share one."""
    return (grams_.astype(np.uint64) * np.uint64(8) + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, values[at]


def language_models(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, Broadcast]:
    """The pooled model and one for each language with enough texts, sent one by one; none for a table without text.

    A model is built where its counts are; the driver passes on one after the other and keeps none.
    """
    schema = pa.schema([("lang", pa.string()), ("model", pa.binary())])

    def build(rows: pa.Table) -> pa.Table:
        model = KneserNey(rows.column("gram").to_numpy(), rows.column("n").to_numpy())
        return pa.table([[rows.column("lang")[0].as_py()], [pickle.dumps(model)]], schema=schema)

    built = cut_lineage(gram_counts(docs, text_col, lang_col).groupBy("lang").applyInArrow(build, "lang string, model binary"))
    send = docs.sparkSession.sparkContext.broadcast
    return {row["lang"]: send(pickle.loads(row["model"])) for row in built.toLocalIterator()}


class Scorer:
    """Log perplexity a character of texts, by the model of their language and by the pooled one.

    A task meets the models of its own texts' languages; of ``MOST_HELD`` it holds the values looked up so far.
    """

    def __init__(self, models: dict[str, Broadcast]):
        self.models = models
        self.held: dict[str, Pages] = {}

    def _values(self, lang: str, codes: np.ndarray) -> np.ndarray:
        """Log probability at each place; the table used longest ago goes first."""
        known = self.held.pop(lang, None)
        if known is None:
            if len(self.held) >= MOST_HELD:
                del self.held[next(iter(self.held))]
            known = Pages()
        self.held[lang] = known
        at = known.places(codes)
        values = known.values[at]
        new = np.isnan(values)
        if new.any():
            fresh, where = np.unique(codes[new], return_index=True)
            known.values[at[new][where]] = self.models[lang].value.log_probabilities(fresh)
            values = known.values[at]
        return values

    def __call__(self, texts: list[bytes], langs: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(by the language's model, by the pooled model) for each text; 0 for no bytes."""
        out, pooled = np.zeros(len(texts)), np.zeros(len(texts))
        which = [lang if lang in self.models else POOLED for lang in langs]
        for lang in sorted(set(which)):
            rows = [k for k, own in enumerate(which) if own == lang and texts[k]]
            if not rows:
                continue
            codes, ends = grams([texts[k] for k in rows])
            starts = np.concatenate([[0], ends[:-1]])
            pooled[rows] = -np.add.reduceat(self._values(POOLED, codes), starts, dtype=np.float64) / (ends - starts)
            out[rows] = pooled[rows] if lang == POOLED else -np.add.reduceat(self._values(lang, codes), starts, dtype=np.float64) / (ends - starts)
        return out, pooled


MEASURES = "struct<lang: string, " + ", ".join(f"{n}: long" for n in Counts._fields) + ", base_failed: boolean, log_perplexity: double, pooled_perplexity: double>"


def measure(models: dict[str, Broadcast], text: Column, lang: Column) -> Column:
    """A struct: lang (of the text's model), the base counts, base_failed, both log perplexities (0: no bytes)."""
    names = [*Counts._fields]

    @F.arrow_udf(MEASURES)
    def measured(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        score = Scorer(models)
        for own_texts, own_langs in batches:
            rows = []
            for part in slices(pa.RecordBatch.from_arrays([own_texts, own_langs], ["text", "lang"]), "text", AT_ONCE):
                texts, langs = utf8(part.column("text")), part.column("lang").to_pylist()
                for counts, own, value, pooled in zip(map(count_text, texts), langs, *score(texts, langs), strict=True):
                    rows.append({"lang": own if own in models else POOLED, **counts._asdict(), "base_failed": counts.failed(), "log_perplexity": value, "pooled_perplexity": pooled})
            kinds = [("lang", pa.string()), *((n, pa.int64()) for n in names), ("base_failed", pa.bool_()), ("log_perplexity", pa.float64()), ("pooled_perplexity", pa.float64())]
            yield pa.array(rows, pa.struct(kinds))

    return measured(text.cast("string"), lang.cast("string"))


def features(docs: DataFrame, models: dict[str, Broadcast], id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: doc_id, hash of the text and its measures."""
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(text_col).alias("hash"), measure(models, F.col(text_col), F.col(lang_col)).alias("measures"))
    return chosen.select("doc_id", "hash", "measures.*")


def bands(measured: DataFrame) -> dict[str, tuple[float, float]]:
    """Each model's lower and upper log perplexity, from the texts that pass the base rules; the pooled one's from all.

    Copies count once, so that no group of them narrows a band to itself. The distribution is counted in steps, so
    what is sent and ordered has a bound: the models times the steps.
    """
    step = lambda name: F.round(F.col(name) / STEP).cast("int").alias("step")
    good = measured.where("not base_failed")
    steps = good.where(F.col("lang") != POOLED).select("lang", "hash", step("log_perplexity")).union(good.select(F.lit(POOLED), "hash", step("pooled_perplexity"))).distinct()
    counted: dict[str, list[tuple[int, int]]] = {}
    for row in steps.groupBy("lang", "step").agg(F.count("*").alias("n")).collect():  # models x ln(64) / STEP
        counted.setdefault(row["lang"], []).append((row["step"], row["n"]))
    out = {}
    for lang, pairs in counted.items():
        at, n = np.array(sorted(pairs)).T
        low, middle, high = (at[np.searchsorted(np.cumsum(n), q * n.sum())] * STEP for q in (0.25, 0.5, 0.75))
        out[lang] = (middle - max(BELOW[0] * (middle - low), BELOW[1]), middle + max(ABOVE[0] * (high - middle), ABOVE[1]))
    return out


def _limits(docs: DataFrame, measured: DataFrame) -> DataFrame:
    """One row for each model: lang, low, high."""
    return F.broadcast(docs.sparkSession.createDataFrame([(lang, *map(float, ends)) for lang, ends in bands(measured).items()], "lang string, low double, high double"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, log_perplexity, kept.

    A null or empty text has no words and fails. A null or empty language and one with fewer than ``LEAST_TEXTS``
    distinct texts take the model and the band of all texts. Repeated rows are judged alike; other columns are ignored;
    an empty table gives an empty one.
    """
    models = language_models(docs, text_col, lang_col)
    measured = cut_lineage(features(docs, models, id_col, text_col, lang_col))
    inside = F.coalesce(F.col("log_perplexity").between(F.col("low"), F.col("high")), F.lit(False))
    joined = measured.join(_limits(docs, measured), "lang", "left")
    return joined.withColumn("kept", ~F.col("base_failed") & inside).drop("lang", "hash", "pooled_perplexity", "low", "high")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows that ``judge`` keeps, with all their columns. Texts are measured once and written beside their rows."""
    models = language_models(docs, text_col, lang_col)
    beside = "__measures"
    measured = cut_lineage(docs.withColumn(beside, measure(models, F.col(text_col), F.col(lang_col))))
    narrow = measured.select(text_hash(text_col).alias("hash"), f"{beside}.*")
    limits = _limits(docs, narrow).select(F.col("lang").alias("__lang"), F.col("low").alias("__low"), F.col("high").alias("__high"))
    inside = F.col(f"{beside}.log_perplexity").between(F.col("__low"), F.col("__high"))
    kept = measured.where(~F.col(f"{beside}.base_failed")).join(limits, F.col(f"{beside}.lang") == F.col("__lang")).where(inside)
    return kept.select(*docs.columns)
