"""The operators against brute force on small tables with nulls, empty and long texts, ties and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagemill.llm import byte_bpe, components, html_text, language, ngram_trie, packing, quality, secrets, simhash, topk, urls
from pagemill.llm.automaton import compile_rules, parse
from pagemill.llm.elias_fano import EliasFano

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
_RNG = random.Random(5)
_PROSE = [" ".join(_RNG.choice("the of and house river café naïve token reads under stone quiet lamp".split()) for _ in range(n)) for n in (3, 60, 80, 120, 200)]
TEXTS = [None, "", " \n\t", "One.", "a\x1cb  c", *_PROSE, _PROSE[1], _PROSE[1] + " more", "ä" * 3000, "x " * 5000, "password = 'hunter2222' é AKIA" + "A1" * 10 + " " + "0af" * 9]
ROWS = [(k if k != 3 else None, t, "en" if k % 3 else None, k, "clash", 0) for k, t in enumerate(TEXTS)] + [(5, TEXTS[5], "en", 0, "again", 0)]
SCHEMA = "doc_id long, text string, lang string, n_chars long, ids string, lang_pred int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(rows):
    return sorted(map(tuple, rows), key=lambda r: [(x is None, str(x)) for x in r])


def test_packing_places_every_piece(docs, empty):
    found = packing.pack(docs, WORDS, capacity=64).collect()
    tokenizer = Tokenizer.from_file(WORDS)
    expected = Counter()
    for doc_id, text, *_ in ROWS:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 64)):
            expected[doc_id, piece, at, tuple(ids[at : at + 64])] += 1
    assert Counter((r.doc_id, r.piece, r.start, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in found) == expected
    bins = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(empty, WORDS).collect() == []


def test_best_fit_equals_one_by_one():
    rng = random.Random(1)
    for _ in range(300):
        capacity = rng.randint(1, 30)
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
        left = []
        for length in sorted(lengths, reverse=True):
            fits = [(r, k) for k, r in enumerate(left) if r >= length]
            if fits:
                left[min(fits)[1]] -= length
            else:
                left.append(capacity - length)
        used = Counter()
        for length, first, end, per, start, _ in packing.best_fit(Counter(lengths), capacity):
            for rank in range(first, end):
                used[start + (rank - first) // per] += length
        assert sorted(capacity - u for u in used.values()) == sorted(left)


def test_html():
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li>Menu</li></ul></nav>"
        "<div class='cookie-notice'>We use</div><div class=ad>Buy</div><article><h1>Title</h1><p>First &amp; <b>bo</b>ld"
        "\n  text &eacute;.<br>More text that is long enough to stand<p>Second, unclosed</article>"
        "<section id=comments><article><p>Nice post, thank you all very much indeed</p></article></section>"
        "<form><label>Mail</label></form><script>var a='</p>'</script><footer>&copy; x</footer>"
    )
    assert html_text.main_text(page) == "Title First & bold text é. More text that is long enough to stand Second, unclosed"
    assert html_text.main_text("plain") == "plain"
    assert html_text.main_text("<nav>only") == ""


PROSE = [f"Paragraph {k} tells at some length what was found, why it matters and what is going to be done about it now." for k in range(6)]
PARTS = "".join(f"<p>{p}</p>" for p in PROSE)
MENU = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("Home", "World", "Sport", "Money", "Weather"))


def test_html_ratios_decide():
    whole = " ".join(PROSE)
    # A teaser that is an article does not stand for a page whose prose is beside it.
    assert html_text.main_text(f'<body><div>{PARTS}</div><article class="card"><a href="/x">Read on</a></article></body>') == whole
    # Parts of an article whose names may mean something else stay if they read like it, and go if they are links.
    article = "<article>{}<section id='related-work'><h2>Related work</h2>{}</section><div class='search results'>{}</div></article>"
    assert html_text.main_text(article.format(PARTS, PARTS, PARTS)) == f"{whole} Related work {whole} {whole}"
    assert html_text.main_text(article.format(PARTS, f"<ul>{MENU}</ul>", f"<ul>{MENU}</ul>")) == whole
    # No name tells the menu.
    assert html_text.main_text(f"<body><div><ul>{MENU}</ul></div><div>{PARTS}</div></body>") == whole
    # A line of links between paragraphs; a short line that is none.
    links = "<p>" + " ".join(f'<a href="/{k}">more {k}</a>' for k in range(8)) + "</p>"
    assert html_text.main_text(f"<article><h1>Head</h1>{PARTS}{links}{PARTS}<p>Yes.</p></article>") == f"Head {whole} {whole} Yes."
    # Nothing but links, and links that are never closed.
    assert html_text.main_text(f"<body><div><ul>{MENU}</ul></div></body>") == "Home World Sport Money Weather"
    assert html_text.main_text(f"<article><p><a href=x>{PROSE[0]}</p><p>{PROSE[1]}</p></article>") == " ".join(PROSE[:2])


def _slow_threshold(ratios):
    low, high = min(ratios), max(ratios)
    if high <= 2 * low:
        return 0.0
    while True:
        middle = (low + high) / 2
        below, above = [r for r in ratios if r < middle], [r for r in ratios if r >= middle]
        if not below or not above:
            return middle
        means = sum(below) / len(below), sum(above) / len(above)
        if max(abs(means[0] - low), abs(means[1] - high)) < 1e-9:
            return middle
        low, high = means


def _slow_lines(lines, mains, doubtful):
    """The rules of the module, one line after the other."""
    def measured(lines):
        raw = [len(line.text) / max(1, line.tags) for line in lines]
        out = []
        for k in range(len(raw)):
            near = [(math.exp(-(j - k) ** 2 / 2), raw[j]) for j in range(max(0, k - 2), min(len(raw), k + 3))]
            out.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
        least = _slow_threshold(out)
        return [(line, r >= least, r >= least and 2 * line.linked < len(line.text)) for line, r in zip(lines, out, strict=True)]

    rows = measured(lines)
    article = sum(len(x.text) for x in lines if x.region in mains - doubtful)
    if article and article >= sum(len(x.text) for x, _, reads in rows if reads and x.region not in mains):
        rows = measured([x for x in lines if x.region in mains])
    told = []
    for line, reaches, _ in rows:
        region = [(x, a, b) for x, a, b in rows if x.region == line.region]
        size, linked = sum(len(x.text) for x, *_ in region), sum(x.linked for x, *_ in region)
        if not any(reads for *_, reads in rows):
            fits = any(a for _, a, _ in region) and line.region not in doubtful
        else:
            fits = any(reads for *_, reads in region) and (reaches or 2 * line.linked < len(line.text))
            if line.region in doubtful:
                fits = fits and 10 * size >= article and 4 * linked <= size
        if fits:
            told.append(line)
    return told


def test_html_lines_equal_one_by_one():
    rng = random.Random(8)
    changed = 0
    for _ in range(3000):
        lines = []
        for _ in range(rng.randint(1, 14)):
            size = rng.choice([3, 8, 20, 60, 150, 400])
            lines.append(html_text.Line("x" * size, rng.randint(0, 9), rng.randint(0, 5), rng.choice([0, 0, 0, size // 3, size])))
        mains = set(rng.sample(range(6), rng.randint(0, 3)))
        doubtful = {r for r in mains if rng.random() < 0.3}
        got = html_text.chosen_lines(lines, mains, doubtful)
        assert got == _slow_lines(lines, mains, doubtful)
        changed += 0 < len(got) < len(lines)
    assert changed > 500
    assert html_text.chosen_lines([], set(), set()) == []


def test_html_rows_of_an_empty_table(spark):
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_html_rows(spark):
    rows = [(1, "u", "<p>a</p>", 1), (2, None, None, 2), (3, "u", "", 3), (1, "u", "<p>a</p>", 4)]
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int"))
    assert by_id(found.collect()) == by_id([(1, "u", "a"), (2, None, ""), (3, "u", ""), (1, "u", "a")])


def _slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _slow_components(fps, ids):
    group = list(range(len(fps)))
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    return [min((i for i, g in zip(ids, group, strict=True) if g == own and i is not None), default=None) for own in group]


def test_simhash(docs, empty):
    found = simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect()
    fps = [_slow_fingerprint(r[1]) for r in ROWS]
    expected = [(r[0], f"{fp:016x}", c) for r, fp, c in zip(ROWS, fps, _slow_components(fps, [r[0] for r in ROWS]), strict=True)]
    assert by_id(found) == by_id(expected)
    assert simhash.near_duplicates(empty).collect() == []


@pytest.mark.parametrize("few", [32, 0])
def test_golay_keys_lose_no_link(monkeypatch, few):
    monkeypatch.setattr(simhash, "FEW", few)
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    near = [int(s) ^ sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for s in seeds for k in (1, 2, 3, 4, 4, 5, 6)]
    fps = np.unique(np.concatenate([seeds, np.array(near, dtype=np.uint64)]))
    rows, keys = simhash.keys(fps)
    a, b = simhash.links_among(keys, fps[rows])
    pairs = [(x, y) for k, x in enumerate(fps) for y in fps[:k] if int(x ^ y).bit_count() <= 4]
    whole = simhash._forest(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    mine = simhash._forest(a, b)
    assert all((x.tolist() == y.tolist()) for x, y in zip(whole, mine, strict=True))
    assert simhash._decoder()[1].astype(bool).sum() == 2047  # each other syndrome has one pattern of up to three bits


def test_clusters_lose_no_link():
    """Many fingerprints around one, a chain away from it and a second cluster beside it: the components of all pairs."""
    rng = np.random.default_rng(5)
    flipped = lambda fp, most: fp ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, most + 1), replace=False))
    one = int(rng.integers(0, 1 << 63))
    other = one ^ 0xFFF << 46  # two segments agree, so the clusters share keys
    chain = [one]
    for _ in range(60):
        chain.append(flipped(chain[-1], 4))
    cluster = [flipped(x, most) for x, most in ((one, 2), (other, 2), (one, 6)) for _ in range(400)]
    fps = np.unique(np.array(chain + cluster, dtype=np.uint64))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= simhash.MAX_BITS
    a, b = np.nonzero(np.triu(near, 1))
    rows, keys = simhash.keys(fps)
    assert np.unique(keys, return_counts=True)[1].max() > 4 * simhash.FEW
    x, y = simhash.links_among(keys, fps[rows])
    for got, want in zip(simhash._forest(x, y), simhash._forest(fps[a], fps[b]), strict=True):
        assert got.tolist() == want.tolist()


def test_a_large_cluster_is_not_compared_in_pairs():
    rng = np.random.default_rng(6)
    one = int(rng.integers(0, 1 << 63))
    fps = np.unique(np.array([one ^ sum(1 << int(b) for b in rng.choice(64, 3, replace=False)) for _ in range(6000)], dtype=np.uint64))
    a, b = simhash._reached(fps, 6)
    assert len(a) == len(fps) - 1 and len(set(b.tolist())) == len(b)


def test_components(spark):
    links = spark.createDataFrame([(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (7, 7), (8, 9)], "a long, b long")
    assert dict(map(tuple, components.components(links).collect())) == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8}
    assert components.components(links.limit(0)).collect() == []


def test_keep_one(spark, docs):
    fps = [_slow_fingerprint(r[1]) for r in ROWS]
    groups = len({c if c is not None else ("fp", f) for c, f in zip(_slow_components(fps, list(range(len(fps)))), fps, strict=True)})
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == groups
    unique = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    expected = unique.count() - simhash.near_duplicates(unique).where("doc_id <> component_id").count()
    assert simhash.keep_one(unique).count() == expected


def test_urls(spark):
    rows = [(1, "HTTP://WWW.Example.ORG/es/1?x", 0), (2, "https://a.example.com/de/5#y", 0), (3, "http://spam-farm.example.net/en/1", 0), (4, "http://x.org", 0), (5, None, 0), (6, "no scheme", 0), (7, "https://notexample.org/en/12", 0), (8, "http://sub.example.org/en/12.html", 0), (3, "http://spam-farm.example.net/en/1", 1)]
    found = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, host int")).collect()}
    assert [(found[k].host, found[k].path, found[k].rule, found[k].verdict) for k in range(1, 9)] == [
        ("www.example.org", "/es/1", "example.org/es/", "block"), ("a.example.com", "/de/5", "com/de/", "block"), ("spam-farm.example.net", "/en/1", None, "block"),
        ("x.org", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("notexample.org", "/en/12", "org/", "allow"), ("sub.example.org", "/en/12.html", "example.org/en/1", "block"),
    ]
    assert urls.segment("cheappills", {(0, 5): 2.0, (5, 10): 2.0}) == ["cheap", "pills"]
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).collect() == []


def test_automaton_and_secrets():
    machine = compile_rules([parse(rb"a(b|c)*d{2,3}"), parse(rb"[x-z]+\x20?q", ignore_case=True)], anywhere=False)
    for text in (b"addd", b"abcbdd", b"Xyz q", b"ad", b"zq"):
        state = 0
        for byte in text:
            state = machine.table[state, machine.classes[byte]]
        assert machine.accepts[state] == (re.fullmatch(rb"a(b|c)*d{2,3}", text) is not None) + 2 * (re.fullmatch(rb"(?i)[x-z]+\x20?q", text) is not None)
    own = re.compile(b"(?i:" + secrets.NAME + b")" + secrets.BETWEEN + b"(" + secrets.VALUE + b")")
    rng = random.Random(2)
    parts = ["token", "API_KEY", "secret", "=", ":", " ", '"', "abc", "AKIA", "0123456789abcdef", "deadbeef", "ghp_", "xoxb-", "eyJ", ".", "-----BEGIN ", "PRIVATE KEY-----", "é", "AAAAAAAAAAAAAAAA"]
    for _ in range(2000):
        data = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14))).encode()
        expected = []
        for which, rule in enumerate(secrets.RULES):
            for m in (own if rule.kind == "assign" else re.compile(rule.pattern)).finditer(data):
                if len(m[1] if rule.kind == "assign" else m[0]) >= rule.least:
                    expected.append((m.start(), m.end(), which))
        assert secrets.byte_spans(data) == sorted(expected, key=lambda s: (s[0], s[2]))


def test_secret_rows(docs, empty):
    found = {r.doc_id: [tuple(f) for f in r.found] for r in secrets.scan(docs).collect()}
    last = TEXTS[-1]
    assert found[len(TEXTS) - 1] == [("assign", 0, 22), ("access", last.index("AKIA"), last.index("AKIA") + 24), ("hex", last.index("0af"), len(last))]
    assert found[0] == found[1] == []
    cleaned = secrets.redact(docs).where(f"doc_id = {len(TEXTS) - 1}").first()
    assert cleaned.text == "[assign]' é [access] [hex]" and secrets.redact(docs).columns == docs.columns
    assert secrets.scan(empty).collect() == []


def test_elias_fano():
    rng = np.random.default_rng(1)
    for _ in range(100):
        numbers = np.sort(rng.integers(0, int(rng.choice([3, 5000, 1 << 62])), int(rng.integers(0, 200)), dtype=np.uint64))
        coded = EliasFano.of(numbers)
        wanted = np.concatenate([numbers, numbers + np.uint64(1), rng.integers(0, 1 << 62, 40, dtype=np.uint64)])
        assert not len(numbers) or (coded.get(np.arange(len(numbers))) == numbers).all()
        assert (coded.successor(wanted) == np.searchsorted(numbers, wanted)).all()


def test_scores(docs, empty):
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in ROWS]
    words = [[*(r[1] or "").encode().lower().split(), None] for r in ROWS]
    singles, pairs = Counter(), Counter()
    for out, w in zip(held, words, strict=True):
        if not out:
            singles.update(w)
            pairs.update(zip([None, *w], w, strict=False))
    tokens, size = sum(singles.values()), len(singles)
    expected = []
    for row, out, w in zip(ROWS, held, words, strict=True):
        base = score = 0.0
        for before, word in zip([None, *w], w, strict=False):
            p = (singles[word] + 1) / (tokens + size + 1)
            base += math.log10(p)
            score += math.log10((pairs[before, word] + ngram_trie.PRIOR * p) / (singles[before] + ngram_trie.PRIOR) if singles[before] else p)
        expected.append((row[0], out, len(w), sum(singles[x] > 0 for x in w), tokens, base, score))
    for got, want in zip(by_id(ngram_trie.score(docs).collect()), by_id(expected), strict=True):
        assert got[:5] == want[:5] and got[5] == pytest.approx(want[5], rel=1e-9) and got[6] == pytest.approx(want[6], abs=3e-4 * want[2])
    assert ngram_trie.score(empty).collect() == []


@pytest.mark.parametrize("share", [1 / 60, 1 / 4, 2.0])
def test_shards_and_head_agree(spark, monkeypatch, share):
    """Few frequent words or none, and many shards, give the same sums and scores as one model in one place."""
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 3) for _ in range(rng.randint(0, 80)))) for k in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    whole = by_id(ngram_trie.score(table).collect())
    monkeypatch.setattr(ngram_trie, "LEAST_SHARE", share)
    monkeypatch.setattr(ngram_trie, "SHARD_TOKENS", 100)
    known = ngram_trie.head(table.where(~ngram_trie.is_held_out(table.doc_id)).select("text"))
    assert len(known.hashes) <= 1 / share and len(known.pairs) <= 1 / share
    for got, want in zip(by_id(ngram_trie.score(table).collect()), whole, strict=True):
        assert got[:5] == want[:5] and got[5] == pytest.approx(want[5]) and got[6] == pytest.approx(want[6], abs=6e-4 * want[2])


def test_a_word_repeated_very_often(spark):
    """More than an int16 holds: no token is added on the way to the shards and back."""
    held = next(k for k in range(99) if zlib.crc32(str(k).encode()) % 7 == 2)
    learned = next(k for k in range(99) if zlib.crc32(str(k).encode()) % 7 != 2)
    for n in (32767, 32769, 100_001):
        keys, times = ngram_trie.in_parts(np.array([5, 9]), np.array([n, 1]))
        assert times[keys == 5].sum() == n and times[keys == 9].tolist() == [1] and times.max() <= 32767
    rows = [(held, "rare " * 32_769), (learned, "some other words")]
    found = {r.doc_id: r for r in ngram_trie.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    unseen = math.log10(1 / (4 + 4 + 1))
    assert found[held].n_tokens == 32_770 and found[held].n_known == 1
    assert found[held].base_score == pytest.approx(32_769 * unseen + math.log10(2 / 9), abs=1e-6)


def test_language(spark, docs, empty):
    rng = random.Random(6)
    tongues = {"en": "the thing with other they when that", "de": "über schon nicht zwischen möchte und der", "fr": "être où déjà voilà garçon les que", "es": "año señor corazón niño ella los que"}
    rows = [(k, " ".join(rng.choice(tongues[lang].split()) for _ in range(30)), lang) for k, lang in enumerate(list(tongues) * 60)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(table)
    found = {r.doc_id: r for r in language.predict(table, model).collect()}
    out = [k for k, *_ in rows if zlib.crc32(str(k).encode()) % 4 == 2]
    assert len(out) > 20 and all(found[k].lang_pred == rows[k][2] and 0.9 < found[k].score <= 1 for k in out)
    odd = {r.doc_id: r.lang_pred for r in language.predict(docs, model).collect()}
    assert odd[0] == odd[1] == odd[2] == "und" and odd[4] in tongues
    assert language.keep_identified(docs, model).columns == docs.columns
    assert language.predict(empty, language.learn(empty)).collect() == []
    assert {r.lang_pred for r in language.predict(docs, language.learn(empty)).collect()} == {"und"}
    assert len(np.unique(language.output_code(40), axis=0)) == 40


def test_rare_languages_are_learned(spark, monkeypatch):
    """Twenty languages, one of them in fewer than 1/256 of the rows."""
    rng = random.Random(8)
    make = lambda: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 8))) for _ in range(40)]
    tongues = {f"l{k:02}": make() for k in range(20)}
    rows = [(k, " ".join(rng.choice(tongues[lang]) for _ in range(60)), lang) for k, lang in enumerate([*list(tongues)[:19] * 80, *["l19"] * 5])]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = [lang for k, _, lang in rows if zlib.crc32(str(k).encode()) % 4 != 2]
    assert 0 < learned.count("l19") < len(learned) / 256
    monkeypatch.setattr(language, "MOST_HELD", 3)
    model = language.learn(table)
    assert model.langs == tuple(sorted(tongues))
    found = {r.doc_id: r for r in language.predict(table, model).collect()}
    assert all(found[k].lang_pred == lang and not found[k].ambiguous for k, _, lang in rows)
    # The classifiers are those of the whole table in one place.
    share = np.full((20, language.FEATURES), 0.5)
    for k, text, lang in rows:
        if zlib.crc32(str(k).encode()) % 4 != 2:
            grams, _ = language.gram_features([text.encode()])
            share[model.langs.index(lang)] += np.bincount(grams[grams >= 0], minlength=language.FEATURES)
    share /= share.sum(1, keepdims=True)
    for b, column in enumerate(model.code.T):
        assert model.weights[:, b] == pytest.approx(np.log(share[column > 0].mean(0)) - np.log(share[column < 0].mean(0)), abs=1e-5)
    trust = np.clip([(share @ model.weights[:, b] * column).min() for b, column in enumerate(model.code.T)], 0.05, None)
    assert model.trust == pytest.approx(trust / trust.sum(), rel=1e-3)


def test_bpe_equals_library():
    bpe = byte_bpe.TreeBpe(RANKS, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    rng = random.Random(7)
    texts = [t for t in TEXTS if t] + ["a" * 3000, "".join(rng.choice("abcdefgh") for _ in range(4000))]
    for _ in range(3000):
        letters = rng.choice(["ab", "aeinrst", "0123", " \t\n\x1c\x85 x", "é漢字a ", "ab!?'s", "th eSion"])
        texts.append("".join(rng.choice(letters) for _ in range(rng.randint(0, 50))))
    for text in texts:
        ids = np.frombuffer(bpe.encode(text), "<u4")
        assert ids.tolist() == library.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


def test_bpe_rows(docs, empty):
    encoded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    found = byte_bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).select("doc_id", "decoded").collect()
    assert by_id((r.doc_id, hashlib.sha256(r.decoded).hexdigest()) for r in found) == by_id((r[0], hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in ROWS)
    assert byte_bpe.encode(empty, RANKS, public_tokenizers.PATTERN).collect() == []


def test_quality_counts(docs, empty):
    def slow(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        seen = Counter(windows)
        covered = {k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(3)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)

    extra = ["a b\na b\n\n#|&\n a b", "p q r " * 30, *TEXTS]
    assert [tuple(quality.count_text((t or "").encode())) for t in extra] == [slow(t) for t in extra]
    found = quality.judge(docs).collect()
    assert len(found) == len(ROWS) and all(r.base_failed and not r.kept for r in found if r.n_words < 50)
    assert quality.keep_good(docs).count() == sum(r.kept for r in found) > 0
    assert quality.judge(empty).collect() == [] and quality.keep_good(empty).collect() == []


def _prose(rng, words, n=80):
    return " ".join(rng.choice(words) for _ in range(n))


def test_quality_copies_count_once(spark):
    """A text copied to three quarters of a language neither moves nor narrows its band."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    texts = [_prose(rng, words) for _ in range(60)]
    once = [(k, t, "de") for k, t in enumerate(texts)]
    table = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    alone = {r.doc_id: (round(r.log_perplexity, 6), r.kept) for r in quality.judge(table(once)).collect()}
    copied = {r.doc_id: (round(r.log_perplexity, 6), r.kept) for r in quality.judge(table(once + [(0, texts[0], "de")] * 240)).collect()}
    assert copied == alone and all(kept for _, kept in alone.values())
    assert quality.keep_good(table(once + [(0, texts[0], "de")] * 240)).count() == 300


def test_quality_rare_language_has_its_own_band(spark, monkeypatch):
    """One row in 100 is in a language of its own; its texts are held against each other, not against all texts."""
    rng = random.Random(12)
    make = lambda letters, n: ["".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(n)]
    common, rare = make("etaoinshrdl", 60), make("zqxjkvbwyupgcmf", 400)
    rows = [(k, _prose(rng, rare if k % 100 == 0 else common), "es" if k % 100 == 0 else "en" if k % 6 else None) for k in range(800)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    models = quality.language_models(table)
    assert set(models) == {"", "en", "es"}
    monkeypatch.setattr(quality, "MOST_HELD", 1)
    found = {r.doc_id: r for r in quality.judge(table).collect()}
    assert all(found[k].kept for k in range(0, 800, 100))
    langs = {r.doc_id: r.lang for r in quality.features(table, models).collect()}
    assert all(langs[k] == (lang or "") for k, _, lang in rows)
    assert quality.keep_good(table).count() == sum(r.kept for r in found.values())


def test_kneser_ney_sums_to_one():
    rng = np.random.default_rng(0)
    counts = np.bincount((rng.zipf(1.3, 50_000) * 977) % (1 << 24), minlength=1 << 24)
    seen = np.nonzero(counts)[0]
    model = quality.KneserNey(seen, counts[seen])
    contexts = np.concatenate([seen[:100] >> 6, rng.integers(0, 1 << 18, 50)])
    logs = model.log_probabilities((contexts[:, None] << 6 | np.arange(64)).reshape(-1))
    assert np.exp(logs).reshape(-1, 64).sum(1) == pytest.approx(1, abs=1e-5)


def _plain_kneser_ney(texts):
    """Log probability of a character after three, by dictionaries of tuples."""
    raw = {4: Counter()}
    for text in texts:
        signs = (0, 0, 0, *quality.symbols(text.encode()).tolist())
        raw[4].update(signs[k : k + 4] for k in range(len(signs) - 3))
    for order in (3, 2, 1):
        raw[order] = Counter(gram[1:] for gram in raw[order + 1])
    discounts, totals, taken = {}, {}, {}
    for order, counts in raw.items():
        n = [max(1, sum(c == k for c in counts.values())) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        discounts[order] = [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.1), k - 0.05) for k in (1, 2, 3)]
        for gram, c in counts.items():
            totals[gram[:-1]] = totals.get(gram[:-1], 0) + c
            taken[gram[:-1]] = taken.get(gram[:-1], 0) + discounts[order][min(c, 3) - 1]

    def probability(gram):
        if not gram:
            return 1 / 64
        below, context = probability(gram[1:]), gram[:-1]
        if context not in totals:
            return below
        c = raw[len(gram)][gram]
        return (c - (discounts[len(gram)][min(c, 3) - 1] if c else 0) + taken[context] * below) / totals[context]

    return probability


def _russian(rng, n=90):
    words = "в начале было слово и дом стоял у реки где дети играли летом а старик читал книгу о море которое шумело вдали каждый вечер".split()
    return _prose(rng, words, n)


def test_quality_against_plain_model_bands_and_verdicts(spark):
    """Perplexities, bands and verdicts by dictionaries; the languages are told apart by their own models."""
    rng = random.Random(21)
    english = "the river ran past a small house where children played until evening and nobody knew why they stayed so late".split()
    rows = [(k, _russian(rng), "ru") for k in range(30)] + [(100 + k, _prose(rng, english, 70), "en") for k in range(30)]
    garble = lambda t: "".join(chr(rng.randint(0x430, 0x44F)) if c > "\x7f" else c for c in t)
    rows += [(200, garble(rows[0][1]), "ru"), (201, _prose(rng, english, 60), None), (202, "", "en"), (203, None, None), (204, rows[3][1], "ru")]
    found = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)).collect()}
    distinct = {(t or "", lang) for _, t, lang in rows}
    models = {lang: _plain_kneser_ney([t for t, own in distinct if own == lang]) for lang in ("ru", "en")}
    models[None] = _plain_kneser_ney([t for t in {t for t, _ in distinct}])

    def perplexity(text, lang):
        signs = (0, 0, 0, *quality.symbols(text.encode()).tolist())
        return -sum(math.log(models[lang](signs[k : k + 4])) for k in range(len(signs) - 3)) / max(1, len(text))

    for doc_id, text, lang in rows:
        assert found[doc_id].log_perplexity == pytest.approx(perplexity(text or "", lang), abs=1e-4)
    good = {doc_id for doc_id, *_ in rows if not found[doc_id].base_failed}
    for lang in ("ru", "en", None):
        steps = sorted(round(value / quality.STEP) for value in ({t: perplexity(t, lang) for i, t, own in rows if i in good and lang in (own, None)}).values())
        low, middle, high = (steps[math.ceil(q * len(steps)) - 1] * quality.STEP for q in (0.25, 0.5, 0.75))
        ends = middle - max(8 * (middle - low), 0.08), middle + max(10 * (high - middle), 0.15)
        for doc_id, text, own in rows:
            if own == lang:
                assert found[doc_id].kept == (doc_id in good and ends[0] <= perplexity(text or "", lang) <= ends[1]), doc_id
    assert not found[200].kept and all(found[k].kept for k in [*range(30), *range(100, 130), 204])


def test_quality_small_languages_are_not_their_own_judges(spark):
    rng = random.Random(22)
    junk = lambda: " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(rng.randint(2, 9))) for _ in range(80))
    words = "the river ran past a small house where children played until evening and nobody knew why they stayed so late".split()
    rows = [(k, _prose(rng, words), f"label {k}") for k in range(10_000)]
    rows += [(20_000 + k, junk(), "odd") for k in range(3)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    assert set(quality.language_models(table)) == {""}
    found = {r.doc_id: r.kept for r in quality.judge(table).collect()}
    assert [i for i, kept in found.items() if not kept and i < 20_000] == []
    assert not any(found[20_000 + k] for k in range(3))
    assert quality.keep_good(table.withColumn("low", F.lit(1))).columns == ["doc_id", "text", "lang", "low"]


def test_top_k(spark):
    rng = np.random.default_rng(2)
    vectors = [(int(k), rng.normal(0, 0.3, 6).tolist()) for k in range(300)]
    vectors += [(300 + k, vectors[0][1]) for k in range(8)]  # ties
    odd = [(None, vectors[0][1]), (900, None), (901, [float("nan")] * 6), (902, [None] * 6), (950, [0.0] * 6), (1000, [1.0, 2.0])]
    table = spark.createDataFrame([(*v, "clash") for v in vectors + odd], "vec_id long, embedding array<float>, rank string")
    found = topk.top_k(table, lambda vec_id: vec_id % 50 == 0).collect()
    whole = [(i, np.floor(256 * np.array(v, dtype=np.float32).astype(np.float64)).astype(np.int64)) for i, v in [*vectors, odd[4], odd[5]]]
    expected = set()
    for i, q in whole:
        if i % 50 == 0:
            scores = sorted((-int(q @ v), j) for j, v in whole if j != i and len(v) == len(q))
            expected |= {(i, n, j, -s) for n, (s, j) in enumerate(scores[:5], 1)}
    assert {tuple(r) for r in found} == expected
    assert topk.top_k(table.limit(0), lambda vec_id: vec_id % 50 == 0).collect() == []


@pytest.mark.parametrize("pass_bytes", [200, topk.PASS_BYTES])
def test_top_k_of_large_components_and_in_passes(spark, monkeypatch, pass_bytes):
    monkeypatch.setattr(topk, "PASS_BYTES", pass_bytes)
    monkeypatch.setattr(topk, "BUCKET", 7)
    monkeypatch.setattr(topk, "BLOCK", 2)
    rng = np.random.default_rng(5)
    vectors = [[1.0, 2.0], [1e7, 0.0], [3.0, 1.0], [0.0, 9e6], [1e12, -3.0], [-2e15, 7.5], [1e200, 1e-3], [5e300, -5e300]]
    vectors += [(rng.normal(0, 10.0 ** rng.integers(0, 13), 2)).tolist() for _ in range(60)]
    table = spark.createDataFrame([(k, v) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    whole = [[int(np.floor(256 * x)) for x in v] for v in vectors]
    expected = set()
    for i in range(0, len(whole), 4):
        clip = lambda x: min(max(x, -(1 << 63)), (1 << 63) - 1)
        scores = sorted((-clip(sum(a * b for a, b in zip(whole[i], v))), j) for j, v in enumerate(whole) if j != i)
        expected |= {(i, n, j, -s) for n, (s, j) in enumerate(scores[:5], 1)}
    assert {tuple(r) for r in topk.top_k(table, lambda vec_id: vec_id % 4 == 0).collect()} == expected


@pytest.mark.parametrize("threshold", [-1.0, 2000.0, 20000.0, 60000.0])
def test_pruned_bucket_keeps_what_reaches_the_threshold(threshold):
    rng = np.random.default_rng(8)
    bucket, queries = rng.integers(-90, 90, (500, 8)), rng.integers(-90, 90, (20, 8))
    got = topk.search_bucket(np.arange(1000, 1020), queries, np.full(20, threshold), np.arange(500), bucket, 500)
    for n, q in enumerate(queries):
        scores = bucket @ q
        assert {(k, int(scores[k])) for k in np.nonzero(scores >= threshold)[0]} <= {(c, s) for i, c, s in got if i == 1000 + n}
