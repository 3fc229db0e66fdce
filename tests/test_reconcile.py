import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import reconcile as R

SCHEMA = "id bigint, a string, b double"


def pairs(seed):
    rng = random.Random(seed)
    left = {i: (rng.choice(["x", "y", None]), rng.choice([None, 1.5, 2.5])) for i in rng.sample(range(-3000, 9000), 4000)}
    right, expected = dict(left), {}
    for i in rng.sample(sorted(left), 10 if seed else 0):
        kind = rng.choice(["missing", "changed"])
        if kind == "missing":
            del right[i]
        else:
            right[i] = ("z", left[i][1]) if rng.random() < 0.5 else ((None, 1.5) if left[i] != (None, 1.5) else (None, None))
        expected[i] = kind
    for i in (20_000, -50_000, 20_001) if seed else ():
        right[i], expected[i] = (None, None), "extra"
    return left, right, expected


def frame(spark, rows, odd=True):
    made = [(i, *v) for i, v in rows.items()] + ([(None, "q", 1.0)] if odd else [])
    return spark.createDataFrame(made, SCHEMA)


@pytest.mark.parametrize("seed, most", [(0, 500), (1, 500), (2, 2)])
def test_rows_that_differ_are_named(spark, monkeypatch, seed, most):
    monkeypatch.setattr(R, "MOST_STRETCHES", most)
    left, right, expected = pairs(seed)
    got = R.reconcile(frame(spark, left), frame(spark, right, odd=False), "id", ["a", "b"], narrow=16)
    assert {r.id: r.status for r in got.collect()} == expected


def test_few_differences_read_few_rows(spark, tmp_path):
    left, right, expected = pairs(1)
    paths = [str(tmp_path / n) for n in ("l", "r")]
    for path, rows in zip(paths, (left, right)):
        frame(spark, rows).repartitionByRange(8, "id").write.parquet(path)
    sides = [spark.read.parquet(p) for p in paths]
    ranges = R.differing_ranges(*(R.checksums(s, "id", ["a", "b"], 16) for s in sides))
    assert {r.range for r in ranges.collect()} == {i // 16 for i in expected}
    read = R.within(sides[0], "id", ranges, 16)
    assert read.count() < 0.05 * len(left)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id" in plan.split("PushedFilters")[1], "the stretches reach the files"


def test_repeated_keys_are_compared_as_a_group(spark):
    one = spark.createDataFrame([(1, "x", 1.0), (1, "x", 1.0), (2, "y", None)], SCHEMA)
    two = spark.createDataFrame([(1, "x", 1.0), (2, "y", None), (2, "y", None)], SCHEMA)
    got = R.reconcile(one, two, "id", ["a", "b"])
    assert Counter((r.id, r.status) for r in got.collect()) == {(1, "changed"): 1, (2, "changed"): 1}
    assert R.reconcile(one, one, "id", ["a", "b"]).count() == 0
    assert {r.status for r in R.reconcile(one, one.limit(0), "id", ["a", "b"]).collect()} == {"missing"}


def test_as_many_stretches_as_are_filters(spark):
    keys = spark.range(0, 32 * R.MOST_STRETCHES).withColumnRenamed("id", "k")
    copy = keys.withColumn("a", F.when(F.col("k") % 32 == 5, 1).otherwise(0))
    got = R.reconcile(keys.withColumn("a", F.lit(0)), copy, "k", ["a"], narrow=16)
    assert {(r.k, r.status) for r in got.collect()} == {(32 * n + 5, "changed") for n in range(R.MOST_STRETCHES)}
