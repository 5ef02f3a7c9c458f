from __future__ import annotations

import collections
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallystick.llm import mixing, queries
from tallystick.llm.oracles import statements
from tests.comparing import compare, duck
from tests.llm.frames import documents


def filled(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """The level is raised step by step: whoever is above its limit is fixed there."""
    total, fixed = share * sum(sizes), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        rest = total - sum(fixed.values())
        targets = {i: rest * weights[i % 3] / sum(weights[j % 3] for j in free) for i in free}
        above = [i for i in free if targets[i] > cap * sizes[i]]
        if not above:
            return [fixed.get(i, targets.get(i)) for i in range(len(sizes))]
        fixed |= {i: cap * sizes[i] for i in above}


def seats_by_turn(votes, seats):
    given_ = [0] * len(votes)
    for _ in range(seats if any(votes) else 0):
        i = max(range(len(votes)), key=lambda i: (votes[i] / (2 * given_[i] + 1), -i))
        given_[i] += 1
    return given_


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1, 1000, 10], [5], [0, 0], [7, 0, 3, 900, 2, 2, 50], [10, 10, 10, 1]])
def test_targets(spark, sizes):
    frame = spark.createDataFrame([(f"s{i:02}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    found = [r["target"] for r in mixing.fill_targets(frame).orderBy("source").collect()]
    assert found == pytest.approx(filled(sizes))


@settings(max_examples=12, deadline=None)
@given(groups=st.lists(st.tuples(st.lists(st.integers(0, 400), min_size=1, max_size=12), st.integers(0, 60)), min_size=1, max_size=6))
def test_apportionment_goes_by_highest_quotients(spark, groups):
    rows = [(g, i, v, seats) for g, (votes, seats) in enumerate(groups) for i, v in enumerate(votes)]
    frame = spark.createDataFrame(rows, "g int, i int, v long, s long")
    found = collections.defaultdict(dict)
    for r in mixing.apportion(frame, ["g"], "i", F.col("v"), F.col("s")).collect():
        found[r["g"]][r["i"]] = r["quota"]
    for g, (votes, seats) in enumerate(groups):
        assert [found[g][i] for i in range(len(votes))] == seats_by_turn(votes, seats)


def test_awkward_rows(spark):
    frame = documents(spark)
    rows = mixing.mix(frame, block_words=4, shard_words=500).collect()
    assert len(rows) == frame.count()
    words = {r["text"]: len((r["text"] or "").encode().split()) for r in frame.collect()}
    assert sorted(r["size"] for r in rows) == sorted(words[r["text"]] for r in frame.collect())
    taken, target = collections.Counter(), {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = (r["target"], r["source_size"])
    for source, (wanted, size) in target.items():
        assert wanted <= 2 * size
        assert abs(taken[source] - wanted) <= 0.01 * wanted + 4 * (2 + size / 500)
    again = mixing.mix(frame.repartition(5), block_words=4, shard_words=500).collect()
    assert collections.Counter(map(tuple, again)) == collections.Counter(map(tuple, rows))


def test_rows_of_size_0_skip_the_shards(spark):
    full = [(i, "a b c d " * (i % 7 + 1), "en", "a" if i % 2 else "b") for i in range(40)]
    blank = [(None, None, "en", "a")] * 200 + [(i, " ", "en", "c") for i in range(100, 200)]
    mixed = mixing.mix(documents(spark, full + blank), block_words=4, shard_words=50)
    assert re.search(r"Filter .*\(size#\d+L > 0\)", mixed._jdf.queryExecution().optimizedPlan().toString())
    rows = mixed.collect()
    assert len(rows) == 340
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert sum(r["size"] == 0 for r in rows) == 300
    alone = mixing.mix(documents(spark, full + [(100, None, "en", "c")]), block_words=4, shard_words=50).collect()
    assert {tuple(r) for r in alone if r["size"]} == {tuple(r) for r in rows if r["size"]}


def test_no_rows(spark):
    assert mixing.mix(documents(spark, [])).collect() == []


def test_against_sql(spark, star_folder):
    _, problems = compare(spark, duck(star_folder), star_folder, queries.op6_mix_sources, statements()["op6_mix_sources"])
    assert not problems


def test_many_shards_against_sql(spark, star_folder, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 700)
    query = lambda s, folder: mixing.mix(s.read.parquet(f"{folder}/documents.parquet"), shard_words=700)
    _, problems = compare(spark, duck(star_folder), star_folder, query, statements()["op6_mix_sources"])
    assert not problems
