"""Two-level totals, latest rows and global ranks against brute force."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallystick.functions.calendar import hour_slot
from tallystick.operators import ordering
from tallystick.operators.customers import percentile_bucket, share_segment

START = dt.datetime(2020, 1, 1)


def random_rows(seed: int, size: int = 400):
    """Two thirds of the rows belong to one key; minutes repeat, some are missing."""
    draw = random.Random(seed)
    rows = []
    for number in range(size):
        key = 1 if draw.random() < 0.66 else draw.randint(2, 6)
        at = None if draw.random() < 0.03 else START + dt.timedelta(minutes=draw.randint(0, 300))
        rows.append((key, at, number))
    return rows


SCHEMA = "key long, at timestamp_ntz, id long"


@pytest.mark.parametrize("seed", [1, 2])
def test_total_until(spark, seed):
    counts: dict = {}
    for key, at, _ in random_rows(seed):
        if at is not None:
            counts[key, at] = counts.get((key, at), 0) + 1
    counted = spark.createDataFrame(
        [(k, a, n) for (k, a), n in counts.items()], "key long, at timestamp_ntz, n long"
    ).withColumn("_slot", hour_slot(F.col("at")))
    asked = [(k, a, last, i) for i, (k, a) in enumerate(counts) for last in (True, False)]
    readers = spark.createDataFrame(asked, "key long, at timestamp_ntz, last boolean, id long")
    rows = ordering.total_until(
        counted, readers, ["key"], "at", "n", F.col("last"), "total"
    ).collect()
    assert len(rows) == len(asked)
    for row in rows:
        mine = [(a, n) for (k, a), n in counts.items() if k == row.key]
        expected = sum(n for a, n in mine if a < row["at"] or (row.last and a == row["at"]))
        assert row.total == expected


@pytest.mark.parametrize("count", [1, 3, 40, 1000])
@pytest.mark.parametrize("threshold", ["10", "1000"])
def test_latest(spark, count, threshold):
    """A third of the hot key's rows share one moment; the plan does not hang on the threshold."""
    rows = [(k, START if n % 3 == 0 and k == 1 else a, n) for k, a, n in random_rows(3)]
    frame = spark.createDataFrame(rows, SCHEMA)
    name = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, threshold)
    try:
        got = {r.id for r in ordering.latest(frame, ["key"], "at", "id", count).collect()}
    finally:
        spark.conf.set(name, before)
    expected = set()
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or START, r[2]), reverse=True)
        expected |= {r[2] for r in mine[:count]}
    assert got == expected


def test_latest_deals_a_hot_key_to_many_tasks(spark):
    """No task of the first step holds more than a small part of the one key's rows."""
    frame = spark.range(20_000).selectExpr("1L AS key", "CAST(NULL AS timestamp_ntz) AS at", "id")
    plan = ordering.latest(frame, ["key"], "at", "id", 5000)
    assert "_part" in plan._jdf.queryExecution().optimizedPlan().toString()
    assert {r.id for r in plan.collect()} == set(range(15_000, 20_000))
    parts = frame.selectExpr(f"pmod(xxhash64(id), {ordering._PARTS}) AS part").groupBy("part").count()
    assert max(r["count"] for r in parts.collect()) < 20_000 / ordering._PARTS * 1.5


def test_latest_rejects_zero(spark):
    with pytest.raises(ValueError):
        ordering.latest(spark.createDataFrame([], SCHEMA), ["key"], "at", "id", 0)


def test_latest_trims_before_the_shuffle(spark):
    frame = spark.createDataFrame(random_rows(4), SCHEMA)
    plan = ordering.latest(frame, ["key"], "at", "id", 5)._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("size", [1, 7, 100, 101, 1234])
def test_global_rank_and_segments(spark, size):
    draw = random.Random(size)
    rows = [(i, float(draw.randint(0, 5))) for i in range(size)]
    frame = spark.createDataFrame(rows, "id long, value double").repartition(5)
    ranked = ordering.global_rank(frame, [F.col("value").desc(), F.col("id")], "place", "size")
    levels = ("Low", "Medium", "High")
    got = {
        r.id: r
        for r in ranked.withColumn("bucket", percentile_bucket(F.col("place"), F.col("size")))
        .withColumn("level", share_segment(F.col("place"), F.col("size"), levels))
        .collect()
    }
    assert len(got) == size
    bounds = []
    for bucket in range(1, 101):
        bounds += [bucket] * (size // 100 + (1 if bucket <= size % 100 else 0))
    for place, (number, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), start=1):
        row = got[number]
        assert (row.place, row["size"]) == (place, size)
        assert row.bucket == bounds[place - 1]
        share = place * 100
        expected = "High" if share <= 10 * size else "Medium" if share <= 35 * size else "Low"
        assert row.level == expected


def test_shares_equal_percentile_buckets_for_few_customers(spark):
    """Up to a hundred customers the bucket is the place, so both forms agree."""
    frame = spark.createDataFrame([(i, float(-i)) for i in range(60)], "id long, value double")
    ranked = ordering.global_rank(frame, [F.col("value").desc(), F.col("id")], "r", "n")
    rows = ranked.withColumn("b", percentile_bucket(F.col("r"), F.col("n"))).collect()
    assert all(row.b == row.r for row in rows)
