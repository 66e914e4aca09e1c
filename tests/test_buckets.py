"""The key store: what it reads, and that nothing but the stored keys is left out."""

import random

from pagemill.sources import buckets as bk

RECORDS = "rel_path string, instruction string, input string, output string"


def records(spark, keys):
    return spark.createDataFrame([(f, i, "", o) for f, i, o in keys], RECORDS)


def test_keys_of_other_runs_are_excluded(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    keys = [(f"f{rng.randint(0, 9)}", f"{rng.randint(0, 30)}?", rng.choice(["a", "ab", "é"])) for _ in range(300)]
    folder = str(tmp_path / "keys")
    assert len(bk.exclude_stored(records(spark, keys), folder).collect()) == len(keys)
    bk.write_keys(records(spark, keys[:100]), folder, 1)
    bk.write_keys(records(spark, keys[100:150]), folder, 2)
    bk.write_keys(records(spark, []), folder, 3)
    for bits in (1 << 15, bk.FILTER_BITS):
        monkeypatch.setattr(bk, "FILTER_BITS", bits)
        for but, stored in ((None, keys[:150]), (1, keys[100:150]), (2, keys[:100])):
            left = bk.exclude_stored(records(spark, keys), folder, but_run=but)
            assert left.columns == ["rel_path", "instruction", "input", "output"]
            found = sorted((r["rel_path"], r["instruction"], r["output"]) for r in left.collect())
            assert found == sorted(k for k in keys if k not in set(stored))
    bk.write_keys(records(spark, keys[150:160]), folder, 2)  # a run replaces itself
    left = bk.exclude_stored(records(spark, keys[150:160]), folder)
    assert left.isEmpty()


def test_lengths_keep_fields_apart(spark, tmp_path):
    folder = str(tmp_path / "keys")
    bk.write_keys(records(spark, [("f", "ab", "c")]), folder, 1)
    assert bk.exclude_stored(records(spark, [("f", "a", "bc"), ("fa", "b", "c")]), folder).count() == 2


def test_only_the_files_buckets_are_read(spark, tmp_path):
    folder = str(tmp_path / "keys")
    bk.write_keys(records(spark, [(f"f{k}", "A?", "b") for k in range(300)]), folder, 1)
    batch = records(spark, [("f7", "A?", "c"), ("f8", "A?", "c")])
    met = {r["b"] for r in batch.select(bk.file_bucket().alias("b")).collect()}
    stored = bk.read_bucketed(spark, folder, bk.KEY_SCHEMA, batch, but_run=2)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    read = {r["name"] for r in stored.selectExpr("_metadata.file_path AS name").collect()}
    assert read and {int(n.split("bucket=")[1].split("/")[0]) for n in read} == met


def test_only_possible_keeps_every_match_and_nulls(spark):
    rows = spark.createDataFrame([(k if k else None, "x") for k in range(5000)], "id long, other string")
    wanted = spark.createDataFrame([(None,), (17,), (4000,)], "w long")
    left = bk.only_possible(rows, "id", wanted, "w").collect()
    assert {None, 17, 4000} <= {r["id"] for r in left} and len(left) < 10
    assert bk.only_possible(rows, "id", wanted.limit(0), "w").isEmpty()
