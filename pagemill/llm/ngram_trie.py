"""Scores of texts by a bigram model in Elias-Fano tries.

The trie's first level holds words, each with its unigram probability; below a word stand its neighbours, each with
the smoothed probability of the pair. Words are 64-bit hashes. Both levels are monotone, Elias-Fano coded, searched
by successors, and probabilities are quantised.

A word is frequent from a share of all tokens on, and so is a pair of frequent words, so both have a fixed bound:
this head is a trie of its own that every task gets, a pre-aggregation that changes no score. Everything else is
dealt to shards by hash. What a document needs of a shard travels there in bulk (word, neighbour, how often); the
shard counts the pairs of training documents, builds its trie, maps it into memory, answers, and each document's sums
come back.

The model smooths pairs by the unigrams: p(c | b) = (n(b c) + M p(c)) / (n(b) + M), with p(c) = (n(c) + 1) / (N + V + 1);
an unseen word has n(c) = 0. Before a text's first word stands the end. Every word is a context. After a rare b the
probability is told in two places: (n(b c) + M p(c)) / M where the pair is counted (with c, or with b if c is frequent
and its probability known everywhere), M / (n(b) + M) where b is counted, once for each time b stands in the text.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import as_batch, slices, utf8
from pagemill.llm.elias_fano import EliasFano
from pagemill.session import cut_lineage

#: Share of the training tokens from which words, and pairs of them, are frequent; at most its inverse of each.
LEAST_SHARE = 1 / 65536
#: Tokens that the unigrams weigh in a pair's probability.
PRIOR = 400.0
#: Log10 probabilities are kept in steps below a most value (the part of a pair after a rare word may be above 1).
STEP, MOST = 1 / 2048, 8.0
#: Neighbours in 32 bits: a rare word before by 31 bits of its hash, then the numbers of the frequent words before,
#: then those of the frequent words that follow a rare one.
RARE = 1 << 31
#: Hash of the end of a text; no word has it but by chance.
END = 0x656E64206F662061
#: Documents and tokens that travel together, tokens for each shard, words counted at a time.
GROUP_DOCS, GROUP_TOKENS, SHARD_TOKENS, WORDS_AT_ONCE = 60_000, 1_000_000, 1_000_000, 300_000
#: Searched at a time, which bounds what a search holds beside the trie.
ASKED_AT_ONCE = 1 << 18


def is_held_out(doc_id: Column) -> Column:
    """Documents that are not learned from: crc32 of the id as text, modulo 7, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


class Trie:
    """Words and their neighbours, with quantised log10 probabilities."""

    def __init__(self, words: EliasFano, starts: EliasFano, beside: EliasFano, unigram: np.ndarray, bigram: np.ndarray, width: int):
        self.words, self.starts, self.beside, self.unigram, self.bigram, self.width = words, starts, beside, unigram, bigram, width

    @classmethod
    def build(cls, hashes: np.ndarray, unigram: np.ndarray, node: np.ndarray, beside: np.ndarray, bigram: np.ndarray, width: int) -> Trie:
        """``hashes`` ascending; (node, beside) ascending; ``beside`` below ``width``."""
        quantise = lambda logs: np.clip(np.rint((MOST - logs) / STEP), 0, 65535).astype(np.uint16)
        starts = np.searchsorted(node, np.arange(len(hashes) + 1))
        # A node's neighbours are numbered on from the node, so the whole level is monotone.
        level = node.astype(np.uint64) * np.uint64(width) + beside.astype(np.uint64)
        return cls(EliasFano.of(hashes), EliasFano.of(starts), EliasFano.of(level), quantise(unigram), quantise(bigram), width)

    def mapped(self, folder: str) -> Trie:
        """The same trie with its levels mapped from a file in ``folder``."""
        path = os.path.join(folder, "trie")
        levels = [(x, name) for x in (self.words, self.starts, self.beside) for name in EliasFano.ARRAYS]
        arrays = [getattr(x, name) for x, name in levels] + [self.unigram, self.bigram]
        with open(path, "wb") as out:
            for a in arrays:
                out.write(a.tobytes() + bytes(-a.nbytes % 8))
        views, at = [], 0
        for a in arrays:
            views.append(np.memmap(path, dtype=a.dtype, mode="r", offset=at, shape=a.shape) if a.size else a)
            at += a.nbytes + -a.nbytes % 8
        coded = [EliasFano(x.n, x.low_bits, *views[3 * k : 3 * k + 3]) for k, x in enumerate((self.words, self.starts, self.beside))]
        return Trie(*coded, views[-2], views[-1], self.width)

    def log_probabilities(self, hashes: np.ndarray, beside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log10 of each word, and of it beside a neighbour; nan for what the trie does not hold."""
        some = [slice(k, k + ASKED_AT_ONCE) for k in range(0, len(hashes), ASKED_AT_ONCE)]
        told = [(np.zeros(0), np.zeros(0)), *(self._log_probabilities(hashes[s], beside[s]) for s in some)]
        words, pairs = (np.concatenate(x) for x in zip(*told, strict=True))
        return words, pairs

    def _log_probabilities(self, hashes: np.ndarray, beside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words, pairs = np.full((2, len(hashes)), np.nan)
        node = self.words.successor(hashes)
        inside = np.nonzero(node < self.words.n)[0]
        inside = inside[self.words.get(node[inside]) == hashes[inside].astype(np.uint64)]
        words[inside] = MOST - STEP * self.unigram[node[inside]]
        if len(inside) and self.beside.n:
            wanted = node[inside].astype(np.uint64) * np.uint64(self.width) + beside[inside].astype(np.uint64)
            place = self.beside.successor(wanted)
            end = self.starts.get(node[inside] + 1).astype(np.int64)
            fits = np.nonzero(place < end)[0]  # the successor stands below the same word
            fits = fits[self.beside.get(place[fits]) == wanted[fits]]
            pairs[inside[fits]] = MOST - STEP * self.bigram[place[fits]]
        return words, pairs


class Head(NamedTuple):
    """The frequent words, ascending by hash, and what every task needs to know."""

    hashes: np.ndarray
    counts: np.ndarray
    #: number of the word before * words + number of the word, ascending.
    pairs: np.ndarray
    pair_counts: np.ndarray
    tokens: int
    vocabulary: int

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of (n + 1) / (N + V + 1)."""
        return np.log10(counts + 1.0) - np.log10(self.tokens + self.vocabulary + 1.0)

    @staticmethod
    def weight(counts: np.ndarray) -> np.ndarray:
        """log10 of the unigrams' weight after words so often seen."""
        return np.log10(PRIOR / (counts + PRIOR))

    @staticmethod
    def pair_log(pair_counts: np.ndarray, unigram: np.ndarray) -> np.ndarray:
        """log10 of a pair's probability, but for the weight of the word before."""
        return np.log10(pair_counts / PRIOR + 10.0**unigram)

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """The frequent word's number, -1 for others."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def trie(self) -> Trie:
        width = max(1, len(self.hashes))
        before, node = self.pairs // width, self.pairs % width
        order = np.lexsort((before, node))
        before, node, n = before[order], node[order], self.pair_counts[order]
        unigram = self.base(self.counts)
        logs = self.pair_log(n, unigram[node]) + self.weight(self.counts)[before]
        return Trie.build(self.hashes, unigram, node, before, logs, width)


class Tokens:
    """A group of texts as one sequence of local word numbers; 0 is the end of a text."""

    def __init__(self):
        self.names: dict[bytes, int] = {b"": 0}
        self.sequence: list[int] = []
        self.lengths: list[int] = []

    def add(self, text: bytes) -> None:
        names = self.names
        own = [names.setdefault(w, len(names)) for w in text.lower().split()]
        own.append(0)
        self.sequence += own
        self.lengths.append(len(own))

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash of each name, name of each token, name before it, text of each token)."""
        digest = xxhash.xxh64_intdigest
        hashes = np.array([END, *(digest(w) for w in list(self.names)[1:])], dtype=np.uint64)
        names = np.array(self.sequence, dtype=np.int64)
        return hashes, names, np.concatenate([[0], names[:-1]]), np.repeat(np.arange(len(self.lengths)), self.lengths)


def word_counts(training: DataFrame) -> DataFrame:
    """(word, n): hash of every token and how often it stands in the texts; counted by task, then by Spark."""
    schema = pa.schema([("word", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Tokens()

        def told():
            hashes, names, _, _ = held.arrays()
            counts = np.bincount(names, minlength=len(hashes))
            seen = counts > 0
            return as_batch(schema, hashes[seen].view(np.int64), counts[seen])

        for batch in batches:
            for part in slices(batch, "text"):
                for text in utf8(part.column("text")):
                    held.add(text)
                if len(held.names) > WORDS_AT_ONCE or len(held.sequence) > 2 * GROUP_TOKENS:
                    yield told()
                    held = Tokens()
        if held.sequence:
            yield told()

    return training.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def head(training: DataFrame) -> Head:
    """The frequent words and pairs; nothing else of the counts leaves Spark."""
    counts = cut_lineage(word_counts(training))
    tokens, vocabulary = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    rows = counts.where(F.col("n") >= max(1.0, LEAST_SHARE * tokens)).toArrow()  # at most 1 / LEAST_SHARE
    hashes, n = rows.column("word").to_numpy().view(np.uint64), rows.column("n").to_numpy()
    order = np.argsort(hashes)
    known = Head(hashes[order], n[order].astype(np.float64), np.zeros(0, np.int64), np.zeros(0), int(tokens), int(vocabulary))
    schema = pa.schema([("pair", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                held = Tokens()
                for text in utf8(part.column("text")):
                    held.add(text)
                names_hashes, names, before, _ = held.arrays()
                number = known.number(names_hashes)
                a, c = number[before], number[names]
                both = (a >= 0) & (c >= 0)
                pairs, counted = np.unique(a[both] * len(known.hashes) + c[both], return_counts=True)
                yield as_batch(schema, pairs, counted)

    paired = training.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    rows = paired.where(F.col("n") >= max(1.0, LEAST_SHARE * tokens)).toArrow()  # at most 1 / LEAST_SHARE
    pairs, n = rows.column("pair").to_numpy(), rows.column("n").to_numpy()
    order = np.argsort(pairs)
    return known._replace(pairs=pairs[order], pair_counts=n[order].astype(np.float64))


_TRAVELS = "shard int, grp long, load binary"
_TRAVELS_SCHEMA = pa.schema([("shard", pa.int32()), ("grp", pa.int64()), ("load", pa.binary())])
#: A document's own row: its id, if it has one, whether it is held out, and the sums known without a shard.
_OWN = np.dtype([("doc_id", "<i8"), ("has_id", "?"), ("held", "?"), ("tokens", "<i8"), ("known", "<i8"), ("base", "<f8"), ("score", "<f8")])


def _pack(*arrays: np.ndarray) -> bytes:
    return b"".join([np.array([len(a) for a in arrays], dtype="<i8").tobytes(), *(a.tobytes() for a in arrays)])


def _unpack(load: bytes, *kinds: str) -> list[np.ndarray]:
    lengths, at, out = np.frombuffer(load, dtype="<i8", count=len(kinds)), 8 * len(kinds), []
    for n, kind in zip(lengths.tolist(), kinds, strict=True):
        out.append(np.frombuffer(load, dtype=kind, count=n, offset=at))
        at += out[-1].nbytes
    return out


def in_parts(keys: np.ndarray, times: np.ndarray, most: int = 32767) -> tuple[np.ndarray, np.ndarray]:
    """Each key as often as its count takes parts of ``most`` at most, the last part the remainder."""
    many = -(-times // most)
    last = np.cumsum(many) - 1
    parts = np.full(many.sum(), most)
    parts[last] = times - (many - 1) * most
    return np.repeat(keys, many), parts


def _travelling(docs: DataFrame, sent, shards: int) -> DataFrame:
    """Rows for shards, and with shard -1 the documents' own, in groups of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Head = sent.value
        trie, width = known.trie(), max(1, len(known.hashes))
        held, ids, outs = Tokens(), [], []
        number = TaskContext.get().partitionId() << 32

        def told() -> Iterator[pa.RecordBatch]:
            nonlocal number
            hashes, names, before, text = held.arrays()
            frequent = known.number(hashes)
            c, b = frequent[names], frequent[before]
            pair = np.where((c >= 0) & (b >= 0), b * width + c, -1)
            at = np.minimum(np.searchsorted(known.pairs, pair), max(0, len(known.pairs) - 1))
            heavy = (pair >= 0) & (known.pairs[at] == pair) if len(known.pairs) else np.zeros(len(pair), bool)
            own = np.zeros(len(ids), dtype=_OWN)
            own["doc_id"], own["has_id"], own["held"] = [i or 0 for i in ids], [i is not None for i in ids], outs
            own["tokens"] = held.lengths
            asked, back = np.unique(pair[heavy], return_inverse=True)
            _, values = trie.log_probabilities(known.hashes[asked % width], asked // width)
            # A frequent word after a rare one is counted here, its score comes from the rare one's shard.
            follows = (c >= 0) & (b < 0)
            here = heavy | follows
            for name, sums in (("known", None), ("base", known.base(known.counts)[c[here]])):
                own[name] = np.bincount(text[here], weights=sums, minlength=len(ids))
            own["score"] = np.bincount(text[heavy], weights=values[back], minlength=len(ids))
            yield as_batch(_TRAVELS_SCHEMA, [-1], [number], [own.tobytes()])
            # The rest, once for each document, by shard and word: a word and the one before, or a rare word and
            # the frequent one that follows.
            rest, size = ~heavy, len(hashes)
            word, beside = np.where(follows, before, names)[rest], np.where(follows, size + names, before)[rest]
            keys, times = np.unique((word * (2 * size) + beside) * GROUP_DOCS + text[rest], return_counts=True)
            keys, times = in_parts(keys, times)
            name, beside, doc = keys // (GROUP_DOCS * 2 * size), keys // GROUP_DOCS % (2 * size), keys % GROUP_DOCS
            mixed = hashes[name]
            split = frequent[name] >= 0  # a frequent word's pairs go to many shards
            mixed[split] ^= frequent[beside[split]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            shard = ((mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)).astype(np.int64) % shards
            order = np.argsort(shard, kind="stable")
            ends = np.searchsorted(shard[order], np.arange(shards + 1))
            signed = np.where(np.array(outs, dtype=bool)[doc], -times, times)
            told_as = np.concatenate([np.where(frequent >= 0, RARE + frequent, (hashes >> np.uint64(33)).astype(np.int64)), RARE + width + frequent])
            beside = told_as[beside]
            for k in range(shards):
                rows = order[ends[k] : ends[k + 1]]
                if len(rows):
                    words = name[rows]
                    first = np.concatenate([[0], np.nonzero(words[1:] != words[:-1])[0] + 1])
                    runs = np.diff(np.concatenate([first, [len(rows)]]))
                    load = _pack(hashes[words[first]], runs.astype("<i4"), (beside[rows] & 65535).astype("<u2"), (beside[rows] >> 16).astype("<u2"), doc[rows].astype("<u2"), signed[rows].astype("<i2"))
                    yield as_batch(_TRAVELS_SCHEMA, [k], [number], [load])
            number += 1

        for batch in batches:
            for part in slices(batch, "text"):
                for doc_id, out, text in zip(part.column("doc_id").to_pylist(), part.column("held").to_pylist(), utf8(part.column("text")), strict=True):
                    held.add(text)
                    ids.append(doc_id)
                    outs.append(out)
                    if len(ids) >= GROUP_DOCS or len(held.sequence) >= GROUP_TOKENS:
                        yield from told()
                        held, ids, outs = Tokens(), [], []
        if ids:
            yield from told()

    return docs.mapInArrow(run, _TRAVELS)


def answer_shard(known: Head, groups: list[int], loads: list[bytes], folder: str) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(group, documents, known, base, score) from all loads of a shard."""
    width = max(1, len(known.hashes))
    parts = [_unpack(x, "<u8", "<i4", "<u2", "<u2", "<u2", "<i2") for x in loads]
    hashes, runs, low, high, doc, signed = (np.concatenate(x) for x in zip(*parts, strict=True))
    keys, to = np.unique(np.repeat(np.arange(len(parts)) * GROUP_DOCS, [len(p[4]) for p in parts]) + doc, return_inverse=True)
    beside = high.astype(np.int64) << 16 | low
    to = to.astype(np.int32)
    del parts, low, high, doc
    words, place = np.unique(hashes, return_inverse=True)
    node = np.repeat(place, runs)
    learned = np.maximum(signed, 0).astype(np.float64)
    is_word = beside < RARE + width  # else the rare word before a frequent one
    counts = np.bincount(node, weights=learned * is_word, minlength=len(words))
    frequent = known.number(words)
    counts[frequent >= 0] = known.counts[frequent[frequent >= 0]]
    span = RARE + 2 * width
    pairs, pair = np.unique(node * span + beside, return_inverse=True)
    pair_counts = np.bincount(pair, weights=learned, minlength=len(pairs))
    pair = pair.astype(np.int32)  # a shard has far fewer
    pair_node, pair_beside = pairs // span, pairs % span
    del learned, pairs, hashes, runs, beside, place

    seen = counts > 0
    unigram = known.base(counts)
    # The word whose probability is told, and the weight of the frequent word before it; a rare one's comes by itself.
    told, weight = unigram[pair_node], np.zeros(len(pair_node))
    follows, after = pair_beside >= RARE + width, (pair_beside >= RARE) & (pair_beside < RARE + width)
    told[follows] = known.base(known.counts)[pair_beside[follows] - RARE - width]
    weight[after] = known.weight(known.counts)[pair_beside[after] - RARE]
    kept = np.nonzero(pair_counts > 0)[0]
    logs = known.pair_log(pair_counts[kept], told[kept]) + weight[kept]
    renumber = np.cumsum(seen) - 1
    trie = Trie.build(words[seen], unigram[seen], renumber[pair_node[kept]], pair_beside[kept], logs, span).mapped(folder)
    alone, values = trie.log_probabilities(words[pair_node], pair_beside)
    alone = np.where(follows, told, np.where(np.isnan(alone), float(known.base(np.zeros(1))[0]), alone))
    values = np.where(np.isnan(values), alone + weight, values)
    own_weight = np.where(frequent < 0, known.weight(counts), 0.0)

    times = np.abs(signed.astype(np.float64))
    sums = [
        np.bincount(to, weights=times * x, minlength=len(keys))
        for x in (is_word & seen[node], is_word * unigram[node], values[pair] + is_word * own_weight[node])
    ]
    out = []
    for k, number in enumerate(groups):
        a, b = np.searchsorted(keys, (k * GROUP_DOCS, (k + 1) * GROUP_DOCS))
        out.append((number, keys[a:b] % GROUP_DOCS, *(s[a:b] for s in sums)))
    return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learned from the rows that ``is_held_out`` does not hold out (a null id is learned from). A null or empty
    text is its end alone. Every row is a document of its own, whatever its id; other columns are ignored; an
    empty table gives an empty one. Equal hashes of different words would share counts.
    """
    spark = docs.sparkSession
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), is_held_out(F.col(id_col)).alias("held"))
    known = head(chosen.where("not held").select("text"))
    sent = spark.sparkContext.broadcast(known)
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")) // 2, -(-known.tokens // SHARD_TOKENS), 1)
    travelling = _travelling(chosen, sent, shards)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(shard, groups, loads):
            with tempfile.TemporaryDirectory() as folder:
                for number, doc, n_known, base, value in answer_shard(sent.value, groups, loads, folder):
                    load = _pack(doc.astype("<u2"), n_known.astype("<i4"), base, value.astype("<f4"))
                    yield as_batch(_TRAVELS_SCHEMA, [shard], [number], [load])

        for shard, rows in _runs(batches, "shard", whole=lambda shard: shard >= 0):
            if shard < 0:
                yield as_batch(_TRAVELS_SCHEMA, *zip(*rows, strict=True))
            else:
                yield from told(shard, [r[1] for r in rows], [r[2] for r in rows])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches, "grp"):
            own = np.frombuffer(next(r[2] for r in rows if r[0] < 0), dtype=_OWN).copy()
            for _, _, load in (r for r in rows if r[0] >= 0):
                doc, n_known, base, value = _unpack(load, "<u2", "<i4", "<f8", "<f4")
                own["known"][doc] += n_known
                own["base"][doc] += base
                own["score"][doc] += value
            ids = pa.array(own["doc_id"], mask=~own["has_id"])
            yield as_batch(schema, ids, own["held"], own["tokens"], own["known"], np.full(len(own), sent.value.tokens), own["base"], own["score"])

    # An answer has a document at most once for each token, so a group's answers have its tokens as a bound.
    # The documents' own rows pass the shards' tasks unread, so that the texts are read and nothing is written twice.
    dealt = F.when(F.col("shard") < 0, -1 - F.col("grp")).otherwise(F.col("shard"))
    answers = travelling.repartition(shards, dealt).sortWithinPartitions("shard", "grp").mapInArrow(answer, _TRAVELS)
    return answers.repartition("grp").sortWithinPartitions("grp", "shard").mapInArrow(
        merge, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def _runs(batches: Iterator[pa.RecordBatch], column: str, whole=lambda value: True) -> Iterator[tuple[int, list[tuple[int, int, bytes]]]]:
    """Consecutive rows (shard, grp, load) that agree in a column; one by one where they need not be ``whole``."""
    now, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("shard", "grp", "load")), strict=True):
            value = row[("shard", "grp").index(column)]
            if held and (value != now or not whole(now)):
                yield now, held
                held = []
            now = value
            held.append(row)
    if held:
        yield now, held
