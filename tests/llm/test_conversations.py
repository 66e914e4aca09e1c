"""Conversation repair against plain recursion over all edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from pagemill.llm import conversations as C
from pagemill.llm import queries

_RNG = random.Random(7)
LEGAL = re.compile(r"(s?(ua)+)?")


def plain_repair(rows):
    """(cost, audit, lines) of [(role, text, fault)], trying every edit everywhere."""

    @lru_cache(maxsize=None)
    def best(i, state, inserted):  # state: initials so far that matter: "", "s", "u" or "a"
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        follows = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        if inserted < 3:
            cost, audit, lines = best(i, follows, inserted + 1)
            options.append((cost + 2, "I" + audit, ({"u": "user", "a": "assistant"}[follows] + ":",) + lines))
        if i < len(rows):
            role, text, fault = rows[i]
            cost, audit, lines = best(i + 1, state, 0)
            options.append((cost + 3, "D" + audit, lines))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                initial = role[:1]
                if initial == follows or (initial == "s" and state == ""):
                    cost, audit, lines = best(i + 1, initial, 0)
                    options.append((cost + extra, "K" + audit, (f"{role}:{text}",) + lines))
                cost, audit, lines = best(i + 1, follows, 0)
                options.append((cost + 2 + extra, "R" + audit, ({"u": "user", "a": "assistant"}[follows] + ":" + text,) + lines))
        return min(options, default=(10**9, "", ()))

    return best(0, "", 0)


def expected(table):
    out = {}
    for conv_id in {r[0] for r in table}:
        rows = []
        for c, turn, role, text, *_ in table:
            if c != conv_id:
                continue
            role, text = role if role is not None else " ", text if text is not None else " "
            fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if fault == 0:
                continue
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            rows += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, faulty = set(), []
        for turn, role, text in rows:
            solid = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faulty.append((role, text, fault))
        turns = [t for t, *_ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        n = lambda f: sum(x[2] == f for x in faulty)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(faulty, faulty[1:]))
        cost, audit, lines = plain_repair(tuple(faulty))
        assert LEGAL.fullmatch("".join(x[0] for x in lines))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv_id] = (conv_id, gaps, n("blank"), n("duplicate"), n("truncated"), illegal, cost, audit, digest)
    return sorted(out.values(), key=repr)


def some_rows():
    texts = ["One. ", "Two!\n", "Three", "ä?", "", " \t", "a.\x85", None, "A long line.", "B?", "C"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    out = []
    for conv in [*range(60), None]:
        n = _RNG.choice([1, 2, 4, 9, 30])
        turn = 0
        for _ in range(n):
            turn += _RNG.choice([0, 1, 1, 1, 3]) if conv and conv % 7 == 0 else 1
            text = _RNG.choice(texts) if _RNG.random() < 0.5 else f"text {_RNG.random()}."
            role = roles[turn % 2] if _RNG.random() < 0.7 else _RNG.choice(roles)
            out.append((conv, turn if _RNG.random() < 0.97 else None, role, text, 1, "clash"))
    return out + [out[4], out[40]]


SCHEMA = "conv_id long, turn long, role string, text string, pos int, symbol string"


@pytest.mark.parametrize("bits", [1, 3, C.CHUNK_BITS])
def test_query(spark, tmp_path, monkeypatch, bits):
    rows = some_rows()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    plain = C.repair
    monkeypatch.setattr(C, "repair", lambda df: plain(df, bits))
    found = queries.op12_conversation_repair(spark, str(tmp_path))
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert found.columns == names
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows)


def test_edits_and_empty_table(spark):
    rows = [("x", 1, "assistant", "Hello."), ("x", 2, "user", "Yes?"), ("y", 1, "user", " ")]
    edits = C.repair(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")).edits
    got = [tuple(r) for r in edits.orderBy("conv_id", "place").select("conv_id", "edit", "role", "text").collect()]
    assert got == [
        ("x", "I", "user", ""),
        ("x", "K", "assistant", "Hello."),
        ("x", "K", "user", "Yes?"),
        ("x", "I", "assistant", ""),
        ("y", "D", None, None),
    ]
    empty = C.repair(spark.createDataFrame([], SCHEMA))
    assert empty.edits.collect() == [] and empty.summary.collect() == [] and C.digests(empty.edits).collect() == []


def test_fix_up_equals_a_whole_run_and_stops_early():
    for _ in range(500):
        symbols = [_RNG.choice([0, 1, 2, 3, 4, 9, 10]) for _ in range(_RNG.randint(1, 60))]
        old, new = C.END, C.run_back([_RNG.choice([1, 2, 3]) for _ in range(3)], C.END)[0]
        before, total = C.run_back(symbols, old)
        vector, cost, done = C.fix_up(symbols, old, new, before, total)
        assert (vector, cost) == C.run_back(symbols, new)
    symbols = [1, 2] * 5000
    assert C.fix_up(symbols, C.END, (3, 0, 1, 2), *C.run_back(symbols, C.END))[2] < 100


def test_one_long_conversation(spark):
    """Many chunks over several partitions, more than one fix-up pass apart."""
    rows = [(1, k, "user" if _RNG.random() < 0.6 else "assistant", f"{k}.") for k in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    repaired = C.repair(df, 4)
    symbols = [1 if r[2] == "user" else 2 for r in rows]
    steps, _ = C.trace(symbols, C.END, 0, True)
    vector, total = C.run_back(symbols, C.END)
    assert repaired.summary.first().cost == vector[0] + total
    assert C.digests(repaired.edits).first().audit == "".join(steps)
