import random
from datetime import datetime, timedelta
from statistics import median

import pytest

from tidemark.operators.sliding import sliding_median

START = datetime(2026, 4, 1)
SPAN = timedelta(days=7)


def rows_of(seed):
    rng = random.Random(seed)
    rows = []
    for key, n, days in (("hot", 400, 12), ("cold", 9, 40), (None, 30, 15), ("still", 20, 0)):
        for _ in range(n):
            at = START + timedelta(seconds=rng.randrange(days * 86400 + 1))
            rows.append((key, at, rng.choice((0, 1, 5, rng.randrange(1000)))))
    # Rows that are exactly seven days apart, and a microsecond more, at ends of days as well as within them.
    for at in (START, START + timedelta(hours=5)):
        rows += [("edge", at + d, v) for v, d in enumerate((timedelta(0), SPAN, SPAN + timedelta(microseconds=1), 2 * SPAN))]
    return rows + [("hot", None, 3), ("hot", START, None)]


@pytest.mark.parametrize("rows_per_bucket", [1, 7, 60, 100_000])
def test_against_brute_force(spark, rows_per_bucket):
    rows = rows_of(rows_per_bucket)
    frame = spark.createDataFrame(rows, "key string, at timestamp_ntz, value int")
    got = sliding_median(frame, ["key"], "at", "value", rows_per_bucket=rows_per_bucket).collect()
    usable = [r for r in rows if r[1] is not None and r[2] is not None]
    expected = {}
    for key, at, _ in usable:
        before = [v for k, t, v in usable if k == key and at - SPAN <= t < at]
        expected[key, at] = (len(before), float(median(before)) if before else None)
    assert {(r.key, r.at): (r.samples, r.median) for r in got} == expected and len(got) == len(expected)


def test_empty_table(spark):
    assert sliding_median(spark.createDataFrame([], "key string, at timestamp, value long"), ["key"], "at", "value").count() == 0


def test_middles_are_cut_to_what_the_ends_can_reach(spark):
    """Of the whole days between the ends no task gets more than the rows at its ends could move the median by."""
    rows = [("k", START + timedelta(minutes=i), i) for i in range(8 * 1440)]
    frame = spark.createDataFrame(rows, "key string, at timestamp_ntz, value int")
    got = {r.at: r for r in sliding_median(frame, ["key"], "at", "value", rows_per_bucket=90).collect()}
    at = START + timedelta(minutes=8 * 1440 - 1)
    assert got[at].samples == 7 * 1440 and got[at].median == 8 * 1440 - 1 - 3.5 * 1440 - 0.5
