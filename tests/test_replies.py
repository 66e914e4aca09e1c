"""Reply parsing: hand cases and random replies against Python's own JSON."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from pagemill.functions.replies import scan_for_array
from pagemill.operators import replies as rp

SCHEMA = "rel_path string, chunk_index int, attempt int, raw string, http_error string"


def parsed(spark, *raws, parse=rp.parse_replies, **how):
    rows = [("f", i, 1, raw, None) for i, raw in enumerate(raws)]
    return parse(spark.createDataFrame(rows, SCHEMA), **how)


def items(df):
    rows = df.select("chunk_index", F.to_json("items").alias("j")).collect()
    return [None if r["j"] is None else json.loads(r["j"]) for r in sorted(rows, key=lambda r: r["chunk_index"])]


def records(df, build=rp.valid_records):
    return [
        (r["instruction"], r["input"], r["output"])
        for r in sorted(build(df).collect(), key=lambda r: (r["chunk_index"], r["pos"]))
    ]


def test_arrays(spark):
    cases = {
        "[1] [2]": None,
        "[1],[2]": None,
        '[1],"a":[2]': None,
        "] x [": None,
        '{"a":1}': None,
        '{"a":[1]}': [1],
        "[]": None,
        "no": None,
        "[1,]": [1],
        "[1,}": None,
        "x [1, 2 , ] y": [1, 2],
        '["a,]"]': ["a]"],
        "[[1],]": [[1]],
        "[1": None,
        "[tru]": None,
        '["a\nb"]': None,
        "< THINK >[1]</think>": [1],
        "[01]": None,
        "[1]]": None,
        "[1]]} [2]": None,
        '[1]],"b":[[2]': None,
    }
    assert items(parsed(spark, *cases)) == list(cases.values())
    none = spark.createDataFrame([("f", 1, 1, None, "HTTP 500"), ("f", 2, 1, None, None)], SCHEMA)
    assert items(rp.parse_replies(none)) == [None, None]


def test_scan(spark):
    good = '[{"instruction":"Q?","output":"a"}]'
    cases = {
        f"[1] and {good}": [{"instruction": "Q?", "output": "a"}],
        f"[note] {good} tail": [{"instruction": "Q?", "output": "a"}],
        '[{"q":"Q?"}]': None,
        '[{"instruction":"Q?"},]': [{"instruction": "Q?"}],
        f"{good} ]": None,
        "[[[": None,
        '["instruction"] x': ["instruction"],
        '[ [ "instruction" , ] , 2 ]': [["instruction"], 2],
        "": None,
    }
    assert items(parsed(spark, *cases, parse=rp.scan_replies)) == list(cases.values())
    strict = parsed(
        spark, '[{"instruction":"Q?"},]', good, parse=rp.scan_replies,
        required=("instruction", "output"), fix_commas_first=True,
    )
    assert items(strict) == [None, [{"instruction": "Q?", "output": "a"}]]


def test_repeated_key_keeps_the_last(spark):
    found = parsed(spark, '[{"instruction":"A?","instruction":"B?","output":"o"}]')
    assert records(found) == [("B?", "", "o")]


@pytest.mark.parametrize(
    "value, text",
    [
        ('["a",1,null,true]', "a 1 None True"),
        ("null", ""),
        ("true", "True"),
        ("12", "12"),
        ("1.0", "1.0"),
        ("2.50", "2.5"),
        ("1e5", "100000.0"),
        ("1e22", "1e+22"),
        ("12345678901234567890123", "12345678901234567890123"),
        ('{"b":1, "a":"é"}', '{"b": 1, "a": "é"}'),
        ('[[1,"x"],{"a":null}]', "[1, 'x'] {'a': None}"),
        ("[1.50,false]", "1.5 False"),
        ("[]", ""),
        ('"plain"', "plain"),
    ],
)
def test_flatten(spark, value, text):
    found = rp.reply_records(parsed(spark, f'[{{"instruction":"Q?","input":{value},"output":"o"}}]'))
    assert found.first()["input"] == text


def test_validation(spark):
    def record(instruction, output="o", input=""):
        return {"instruction": instruction, "input": input, "output": output}

    good = [
        record("However we"), record("ok?"), record("  wHo \n"), record("List"), record("Why?", 7),
        record("Q?", "o", " i "), {"instruction": "Q?", "output": "x"},
    ]
    bad = [
        record("tell me"), record("ok?", " "), record("", "o"), record("a\nb?"), record("Q?", "a\rb"),
        record("Q?", "o", "x\ny"), "str", 5, None, [record("Q?")], record(None), {},
    ]
    found = records(parsed(spark, json.dumps(good + bad)))
    assert found == [
        ("However we", "", "o"), ("ok?", "", "o"), ("wHo", "", "o"), ("List", "", "o"),
        ("Why?", "", "7"), ("Q?", "i", "o"), ("Q?", "", "x"),
    ]
    strict = records(parsed(spark, json.dumps(good + bad)), rp.valid_records_strict)
    assert strict == [f for f in found if f[0] != "Why?"]


def test_random_replies(spark):
    rng = random.Random(7)
    values = ["Q?", "Explain it", " x ", "", None, 1, 2.5, True, ["a", None, 3], {"k": [1, {"z": "é"}]}, "a\nb", [[1]]]

    def item():
        if rng.random() < 0.15:
            return rng.choice(["s", 3, None, [1]])
        keys = [k for k in ("output", "instruction", "input", "more") if rng.random() < 0.9]
        return {k: rng.choice(values) for k in keys}

    raws = []
    for _ in range(300):
        text = json.dumps([item() for _ in range(rng.randint(0, 4))], ensure_ascii=rng.random() < 0.5)
        before = rng.choice(["", "x ", "<think>[</think>", "</ think>"])
        raws.append(before + (text[:-1] + " ,\n]" if rng.random() < 0.3 else text) + rng.choice(["", " y", "]"]))

    def expected(raw):
        raw = re.sub(r",\s*\]", "]", re.sub(r"(?i)<\s*/?\s*think\s*>", "", raw))
        try:
            found = json.loads(raw[raw.index("[") : raw.rindex("]") + 1])
        except ValueError:
            return []
        kept = []
        for entry in found if isinstance(found, list) else []:
            if isinstance(entry, dict):
                fields = []
                for name in ("instruction", "input", "output"):
                    v = entry.get(name)
                    if v is None:
                        v = ""
                    elif isinstance(v, list):
                        v = " ".join(map(str, v))
                    elif isinstance(v, dict):
                        v = json.dumps(v, ensure_ascii=False)
                    fields.append(str(v).strip())
                one_line = not any(c in f for f in fields for c in "\r\n")
                if fields[0] and fields[2] and one_line and (fields[0][-1] == "?" or fields[0].startswith("Explain")):
                    kept.append(tuple(fields))
        return kept

    assert records(parsed(spark, *raws)) == [r for raw in raws for r in expected(raw)]


def test_half_a_surrogate_pair_prints_as_a_question_mark(spark):
    raw = r'[{"instruction":"Why \ud800?","input":["a"],"output":"x"}]'
    found = rp.valid_records(parsed(spark, raw)).collect()
    assert [(r["instruction"], r["input"]) for r in found] == [("Why ??", "a")]


def plain_scan(raw):
    """Every ``[`` from the left against Python's own JSON, up to the last ``]``."""
    last = raw.rfind("]")
    for at in (m.start() for m in re.finditer(r"\[", raw[: last + 1])):
        try:
            found = json.loads(raw[at : last + 1])
        except ValueError:
            continue
        return found or None
    return None


def scanned(spark, raws):
    rows = spark.createDataFrame(list(enumerate(raws)), "k int, raw string")
    found = rows.select("k", F.to_json(scan_for_array(F.col("raw"), required=(), fix_commas_first=True)).alias("j"))
    return [r["j"] and json.loads(r["j"]) for r in sorted(found.collect(), key=lambda r: r["k"])]


def test_scan_equals_trying_every_bracket(spark):
    rng = random.Random(11)
    pieces = ["[", "]", '"', "\\", '\\"', "1", ",", '"a"', "[1]", '["]"]', '"["', " ", '"\\\\"', "{", "}", '{"a":[2]}']
    raws = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    raws += ['\\[1]', 'say "[" and ["x"]', '["\\\\"]', '["[", "]"]', "[[[[1]]]", '" [1, "]"]', "] x ["]
    # A trailing comma is mended before the scan, so plain JSON sees the mended text.
    raws = [r for r in raws if not re.search(r",\s*[\]}]", r)]
    want = [plain_scan(r) for r in raws]
    assert sum(w is not None for w in want) > 100
    assert scanned(spark, raws) == want


def test_scan_is_linear_in_brackets(spark):
    n = 100_000
    assert scanned(spark, ["[" * n + "[7]", "[" * n + "]" * n + "x", "[7]" * n]) == [[7], None, [7]]
