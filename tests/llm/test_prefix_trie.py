from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystick.llm import prefix_trie


def by_hand(sequences: dict[int, list[tuple[str, int]]]) -> set[tuple]:
    nodes: dict[tuple, list[int]] = {}
    for conv, turns in sequences.items():
        for depth in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:depth]), []).append(conv)
    rows = set()
    for prefix, members in nodes.items():
        below = [p for p in nodes if p[: len(prefix)] == prefix]
        ending = sorted(c for c in members if len(sequences[c]) == len(prefix))
        rows.add((
            min(members), len(prefix), min(nodes[prefix[:-1]]) if prefix else None, len(members),
            sum(len(p) == len(prefix) + 1 for p in below),
            sum(all(q[:-1] != p or not q for q in nodes) for p in below),
            sum((len(nodes[p]) - 1) * (p[-1][1] if p else 0) for p in below),
            hashlib.sha256(",".join(map(str, ending)).encode()).hexdigest(),
        ))
    return rows


def built(spark, sequences, **sizes):
    rows = [(c, d + 1, hashlib.md5(name.encode()).digest(), size) for c, turns in sequences.items() for d, (name, size) in enumerate(turns)]
    frame = spark.createDataFrame(rows, "conv_id long, depth long, digest binary, bytes long")
    members = spark.createDataFrame([(c,) for c in sequences], "conv_id long")
    return [tuple(r) for r in prefix_trie.trie(frame, members, **sizes).collect()]


@pytest.mark.parametrize("sizes", [{}, {"segment": 3, "block_rows": 8}])
def test_trie_like_a_plain_one(spark, sizes):
    draw = random.Random(5)
    sequences = {c: [("ab"[draw.random() < 0.3], 3) for _ in range(draw.randrange(7))] for c in range(-5, 60)}
    sequences |= {c: [("long", 2)] * 7 + [("end", 9)] * (c % 3) for c in range(100, 106)}  # copies, and one inside another
    sequences |= {c: [("one", 4)] for c in range(200, 240)}  # a group with most rows
    found = built(spark, sequences, **sizes)
    assert len(found) == len(set(found)) and set(found) == by_hand(sequences)


def test_empty_and_turnless(spark):
    assert built(spark, {}) == []
    assert set(built(spark, {3: [], 12: []})) == by_hand({3: [], 12: []})


def test_search_finds_the_extent_of_every_prefix():
    class Row:
        def __init__(self, turns):
            size = len(turns) + 1
            self.seq = b"".join(bytes([t]) * prefix_trie.DIGEST for t in turns)
            self.n = self.least = self.bytes = self.children = self.leaves = self.saved = [1] * size
            self.ends = [None] * size

    draw = random.Random(1)
    turns = sorted({tuple(draw.randrange(3) for _ in range(draw.randrange(6))) for _ in range(150)})
    block = prefix_trie.Block([Row(t) for t in turns])
    for row, depth, left, right in zip(block.row, block.depth, block.left, block.right):
        inside = [i for i, t in enumerate(turns) if len(t) >= depth and t[:depth] == turns[row][:depth]]
        assert (inside[0], inside[-1]) == (left, right)
    assert len(block.row) == len({t[:d] for t in turns for d in range(len(t) + 1)})
    assert np.array_equal(block.left, block.row)


def test_turns_and_rebuilding(spark):
    rows = [
        (0, None, "u", "first"), (0, 2, None, None), (0, 1, "u", "x"), (0, 1, "u", "x"), (None, 1, "u", "nobody's"),
        (7, 5, "u", "own"), (7, 9, "a", "last"), (9, 1, "u", "é"),
    ]
    frame = spark.createDataFrame([(*r, 1, 1) for r in rows], "conv_id long, turn long, role string, text string, place long, digest int")
    turns = prefix_trie.turns_of(frame)
    sizes = {c: [r["bytes"] for r in turns.where(F.col("conv_id") == c).orderBy("place").collect()] for c in (0, 7, 9)}
    assert sizes == {0: [5, 1, 1, 0], 7: [3, 4], 9: [2]}
    c = F.col("conv_id")
    made = prefix_trie.rebuilt(turns, F.lit(1).cast("long"), F.when(c == 9, 8).otherwise(0).cast("long"))
    found = {k: [r["bytes"] for r in made.where(c == k).orderBy("depth").collect()] for k in (0, 7, 9)}
    assert found == {0: [5, 1, 1, 0], 7: [5, 4], 9: []}
    assert prefix_trie.turns_of(frame.limit(0)).count() == 0
