"""URL judging: splits against all splits, odds against a plain naive Bayes, and what must not change a verdict."""

import itertools
import math
import random
from collections import Counter

import pytest

from pagemill.llm import urls

_RNG = random.Random(9)


def all_splits(name):
    for cuts in itertools.product([False, True], repeat=len(name) - 1):
        places = [0, *(k + 1 for k, c in enumerate(cuts) if c), len(name)]
        yield list(zip(places, places[1:]))


def test_segment_is_the_cheapest_of_all_splits():
    for _ in range(200):
        name = "".join(_RNG.choice("ab") for _ in range(_RNG.randint(1, 9)))
        words = {"".join(_RNG.choice("ab") for _ in range(_RNG.randint(1, 5))): _RNG.uniform(0, 20) for _ in range(6)}
        costs = {(a, b): words[name[a:b]] for a in range(len(name)) for b in range(a + 1, len(name) + 1) if name[a:b] in words}
        price = lambda a, b: min(costs.get((a, b), math.inf), urls.NEW_WORD + (b - a) * urls.NEW_LETTER)
        found = urls.segment(name, costs)
        assert "".join(found) == name
        ends = list(itertools.accumulate(map(len, found), initial=0))
        assert math.isclose(sum(price(a, b) for a, b in zip(ends, ends[1:])), min(sum(price(*x) for x in s) for s in all_splits(name)))


def rows():
    tails = ["/fr/1", "/de/2", "/es/3.html", "/en/44", "/news/house/5", "/x/lamp?q=1", "/river/"]
    names = ["stone", "river", "house", "lamp", "stonehouse", "riverlamp", "casino-win", "cheappills", "megacasino", "alphabet", "m.soundtrack", "essex"]
    hosts = [f"{n}.{t}" for n in names for t in ("example.com", "example.net", "www.example.org", "shop")]
    out = [f"http://{h}{t}" for h in hosts for t in tails]
    return out + [None, "no url", "https://", "HTTP://CASINO.shop", f"http://{'q' * 3000}.net/" + "ab" * 4000]


def judged(spark, table):
    df = spark.createDataFrame([(k, u, k) for k, u in enumerate(table)], "page_id long, url string, host long")
    return {r.page_id: r for r in urls.judge(df.repartition(4)).collect()}


def test_names_are_split_and_words_decide(spark):
    table = rows()
    found = judged(spark, table)
    assert len(found) == len(table)
    open_ = {k: r for k, r in found.items() if r.rule is None}
    unwanted = ("casino", "cheappills", "CASINO")
    for k, r in open_.items():
        url = table[k] or ""
        assert (r.verdict == "block") == any(w in url for w in unwanted), (url, r)
    tokens = spark.createDataFrame([(h, n) for h in ("a", "b") for n in ("stone", "house")] + [("c", "stonehouse")], "place string, name string")
    split = urls.segmented(tokens.select("name").distinct(), urls.dictionary(tokens))
    assert {r.name: r.words for r in split.collect()} == {"stone": ["stone"], "house": ["house"], "stonehouse": ["stone", "house"]}


def test_odds_are_naive_bayes(spark):
    words = [(u, _RNG.choice("abcdef")) for u in range(40) for _ in range(_RNG.randint(0, 6))]
    bad = {u: _RNG.random() < 0.3 for u in range(40)}
    odds, prior = urls.word_odds(
        spark.createDataFrame(words, "url long, word string"), spark.createDataFrame(list(bad.items()), "url long, unwanted boolean")
    )
    counts = {c: Counter(w for u, w in words if bad[u] == c) for c in (True, False)}
    kinds = len(set(counts[True]) | set(counts[False]))
    s = urls.SMOOTHING
    share = lambda c, w: (counts[c][w] + s) / (counts[c].total() + s * kinds)
    for r in odds.collect():
        assert r.odds == pytest.approx(math.log(share(True, r.word) / share(False, r.word)))
    assert prior == pytest.approx(math.log((sum(bad.values()) + s) / (40 - sum(bad.values()) + s)))


def test_copies_change_nothing_and_no_seed_is_needed(spark, monkeypatch):
    table = rows()
    once = judged(spark, table)
    often = judged(spark, table * 50)
    assert all(often[k].verdict == once[k % len(table)].verdict for k in often)
    assert all(often[k].log_odds == pytest.approx(once[k % len(table)].log_odds) for k in often if often[k].rule is None)
    monkeypatch.setattr(urls, "UNWANTED", ())
    learned = [f"http://{n}.com/{p}{k}" for n in ("goodnews", "openriver") for p, m in (("fr/", 30), ("", 30)) for k in range(m)]
    learned += [f"http://{n}.com/{p}{k}" for n in ("darkpool", "fraudpit") for p, m in (("de/", 30), ("", 3)) for k in range(m)]
    found = judged(spark, learned)
    assert all(found[k].verdict == ("block" if "darkpool" in u or "fraudpit" in u else "allow") for k, u in enumerate(learned))


def test_empty_table(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).collect() == []
