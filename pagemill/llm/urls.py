"""URL filters: fixed rules for hosts and paths, and a word model for the rest.

Names (runs of letters in host and path) are split into words by a unigram Viterbi search. Its dictionary has the
names that stand alone in two places or more, so the label of one site never vouches for itself. A multinomial naive Bayes model
of the words then tells unwanted urls. Its unwanted class are the urls that a rule blocks and those in which a seed
word is found, the other class are all others; every url counts once, however many rows have it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.session import cut_lineage

#: Fixed values: (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Seed words: urls with one of them, alone or within a name, are examples of the unwanted class.
UNWANTED = ("ad", "ads", "adult", "banner", "bet", "bets", "betting", "bonus", "casino", "cheap", "clicks", "crack", "escort", "farm", "gambling", "loans", "lottery", "malware", "nude", "phishing", "pills", "poker", "popup", "porn", "promo", "sex", "slots", "spam", "track", "tracker", "viagra", "warez", "xxx")
#: Share of all words that a seed word has in the dictionary at least: as dear as five and a half new letters, so that
#: shorter seeds are found only next to other words, not cut out of a new one.
SEED_SHARE = 10**-5.5
#: Places in which a name stands alone, and letters that it has, to be a word of the dictionary. A place is a label
#: of a host, the same on all hosts, or the paths of a host.
LEAST_PLACES, LEAST_LETTERS = 2, 3
#: Cost of a stretch that is no word of the dictionary, and of each of its letters; words cost -log(share).
NEW_WORD, NEW_LETTER = math.log(1e4), math.log(10)
#: Added to each word's count in each class.
SMOOTHING = 0.5
#: A url without a rule is blocked from this probability of the unwanted class on.
LEAST_PROBABILITY = 0.75
#: Words of the rules themselves say nothing about other urls.
_RULE_WORDS = sorted({w for h, p, _ in RULES for w in re.findall("[a-z]+", h + p)})


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty without ``://`` or for null."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    fits = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(fits, host).otherwise(""), F.when(fits, path).otherwise("")


def with_rule(pages: DataFrame, url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """(page_id, host, path, rule, verdict): the longest rule that fits, null if none does."""
    host, path = parts(F.col("_url"))
    split = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("_url")).select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for own_host, own_path, own_verdict in sorted(RULES, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == own_host) | F.col("host").endswith("." + own_host)) & F.col("path").startswith(own_path)
        rule = F.when(fits, own_host + own_path).otherwise(rule)
        verdict = F.when(fits, own_verdict).otherwise(verdict)
    return split.withColumns({"rule": rule, "verdict": verdict})


def segment(name: str, costs: dict[tuple[int, int], float]) -> list[str]:
    """The cheapest split of a name; ``costs`` has the dictionary's words in it by (start, end).

    What no word covers are new words, each as long as it can be. Ties go to fewer letters in new words.
    """
    at_end: dict[int, list[tuple[int, float]]] = {}
    for (start, end), cost in costs.items():
        at_end.setdefault(end, []).append((start, cost))
    best, back = [(0.0, 0)], [0]  # (cost, letters in new words) of the split up to each place, start of its last word
    new = (math.inf, 0, 0)  # the same for splits that end within a new word, and where it starts
    for end in range(1, len(name) + 1):
        begun, going = best[end - 1], new
        new = min(
            (begun[0] + NEW_WORD + NEW_LETTER, begun[1] + 1, end - 1),
            (going[0] + NEW_LETTER, going[1] + 1, going[2]),
        )
        found = [(*new[:2], new[2])]
        found += [(best[start][0] + cost, best[start][1], start) for start, cost in at_end.get(end, ())]
        *value, start = min(found)
        best.append(tuple(value))
        back.append(start)
    out, end = [], len(name)
    while end:
        out.append(name[back[end] : end])
        end = back[end]
    return out[::-1]


def dictionary(tokens: DataFrame) -> DataFrame:
    """(name, place) to (word, cost): names in enough places by their number of places, and the seed words."""
    placed = tokens.select("name", "place").distinct().groupBy("name").agg(F.count("*").alias("n"))
    known = placed.where((F.col("n") >= LEAST_PLACES) & (F.length("name") >= LEAST_LETTERS))
    total = known.agg(F.sum("n")).first()[0] or 1
    words = known.select(F.col("name").alias("word"), (-F.log(F.col("n") / total)).alias("cost"))
    seeds = tokens.sparkSession.createDataFrame(
        [(w, -math.log(SEED_SHARE)) for w in UNWANTED if len(w) >= LEAST_LETTERS], "word string, cost double"
    )
    return words.unionByName(seeds).groupBy("word").agg(F.min("cost").alias("cost"))


def segmented(names: DataFrame, words: DataFrame) -> DataFrame:
    """(name), each once, to (name, words): its stretches of the dictionary's lengths are looked up by a join."""
    lengths = [r[0] for r in words.select(F.length("word")).distinct().collect()]  # as many as there are lengths
    stretch = F.explode(F.expr("sequence(1, length(name) - size + 1)"))
    sized = names.withColumn("size", F.explode(F.array(*map(F.lit, lengths)).cast("array<int>"))).where("size <= length(name)")
    stretches = sized.withColumn("start", stretch).withColumn("word", F.expr("substring(name, start, size)"))
    found = stretches.join(words, "word").groupBy("name").agg(F.collect_list(F.struct("start", "size", "cost")).alias("found"))

    @F.pandas_udf("array<string>")
    def split(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for batch_names, batch_found in batches:
            out = []
            for name, places in zip(batch_names, batch_found, strict=True):
                costs = {} if places is None else {(p["start"] - 1, p["start"] - 1 + p["size"]): p["cost"] for p in places}
                out.append(segment(name, costs))
            yield pd.Series(out)

    return names.join(found, "name", "left").select("name", split("name", "found").alias("words"))


def word_odds(words: DataFrame, urls: DataFrame) -> tuple[DataFrame, float]:
    """Of (url, word) and (url, unwanted): (word, odds), log odds of the unwanted class, and those of the class itself."""
    counts = words.join(urls, "url").groupBy("word").agg(
        F.count_if("unwanted").alias("bad"), F.count_if(~F.col("unwanted")).alias("good")
    )
    counts = cut_lineage(counts)
    bad, good, kinds = counts.agg(F.sum("bad"), F.sum("good"), F.count("*")).first()
    unwanted, every = urls.agg(F.count_if("unwanted"), F.count("*")).first()
    share = lambda c, n: (F.col(c) + SMOOTHING) / ((n or 0) + SMOOTHING * (kinds or 1))
    prior = math.log((unwanted + SMOOTHING) / (every - unwanted + SMOOTHING))
    return counts.select("word", (F.log(share("bad", bad)) - F.log(share("good", good))).alias("odds")), prior


def judge(pages: DataFrame, url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, log_odds (of the unwanted class; null where a rule decides).

    A null url, one without ``://`` and one without words is judged by the share of unwanted urls alone unless a
    rule fits. Repeated rows are judged alike and change nothing; other columns are ignored; an empty table gives an
    empty one. Counts are whole tables in Spark: no word is too rare or too long, nothing of them is collected but
    the lengths of words and a row of sums.
    """
    ruled = with_rule(pages, url_col, id_col)
    urls = cut_lineage(ruled.select("host", "path", "verdict").distinct().withColumn("url", F.monotonically_increasing_id()))
    named = lambda text: F.split(text, "[^a-z]+")
    labels = F.expr("transform(split(host, '[.]'), x -> struct(x as place, x as text))")
    of_path = F.array(F.struct(F.concat("host", F.lit("/")).alias("place"), F.lower("path").alias("text")))
    places = urls.select("url", F.inline(F.concat(labels, of_path)))
    tokens = places.select("url", "place", F.explode(named("text")).alias("name"))
    tokens = tokens.where((F.col("name") != "") & ~F.col("name").isin(_RULE_WORDS))
    tokens = cut_lineage(tokens)
    split = cut_lineage(segmented(tokens.select("name").distinct(), dictionary(tokens)))
    words = tokens.join(split, "name").select("url", F.explode("words").alias("word")).where(~F.col("word").isin(_RULE_WORDS))
    words = cut_lineage(words)
    seeded = words.where(F.col("word").isin(list(UNWANTED))).select("url").distinct().withColumn("seeded", F.lit(True))
    unwanted = F.col("seeded").isNotNull() | F.coalesce(F.col("verdict") == "block", F.lit(False))
    classed = cut_lineage(urls.join(seeded, "url", "left").select("url", unwanted.alias("unwanted")))
    odds, prior = word_odds(words, classed)
    scores = words.join(odds, "word").groupBy("url").agg(F.sum("odds").alias("odds"))
    scored = urls.where("verdict is null").join(scores, "url", "left").select(
        F.col("host").alias("_host"), F.col("path").alias("_path"), (F.coalesce("odds", F.lit(0.0)) + prior).alias("log_odds")
    )
    judged = ruled.join(scored, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")), "left")
    least = math.log(LEAST_PROBABILITY / (1 - LEAST_PROBABILITY))
    method = F.when(F.col("log_odds") >= least, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"), F.when(F.col("rule").isNull(), F.col("log_odds")).alias("log_odds"))
