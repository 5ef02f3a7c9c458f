from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
import pytest

from tallystick.llm import lexical_search
from tests.llm.frames import documents


def terms(text):
    small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(lexical_search.TERM, small)


def by_hand(docs, items, k):
    cut = [(i, terms(t)) for i, t in docs if terms(t)]
    n_docs, length = len(cut), sum(len(t) for _, t in cut)
    df = collections.Counter(w for _, t in cut for w in set(t))
    asked = collections.defaultdict(set)
    for item, text in items:
        asked[item] |= set(terms(text))
    rows = set()
    for item, wanted in asked.items():
        scored = []
        for doc, t in cut:
            m = 50 + 50 * len(t) * n_docs // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * tf // (1000 * tf + 20 * m))
                for w, tf in collections.Counter(t).items() if w in wanted
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        for rank, (score, missing, doc) in enumerate(sorted(scored)[:k], 1):
            rows.add((item, rank, None if missing else doc, -score))
    return rows


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(*d, 1, 1.0) for d in docs], "doc_id long, text string, score int, id double").repartition(5),
        spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, term int"),
    )


WORDS = ["Boat", "boat's", "naïve", "éa", "x1", "the", "Sea", "ГОД", "\U0001f600", "a-b", "Z"]


@pytest.mark.parametrize("sizes", [{}, {"block_items": 2}, {"block_terms": 3}])
def test_ranking_like_a_plain_one(spark, sizes):
    draw = random.Random(3)
    text = lambda n: " ".join(draw.choice(WORDS) for _ in range(draw.randrange(n)))
    docs = [(i if i % 9 else None, text(12)) for i in range(120)] + [(500, None), (501, "-- !"), (7, "sea sea sea"), (7, "sea sea sea")]
    items = [(1, "boat sea"), (2, "the The THE x1"), (2, "naïve"), (3, None), (4, "unheard"), (None, "éa ГОД"), (5, "z a b boat sea")]
    found = [tuple(r) for r in lexical_search.ranked(*frames(spark, docs, items), k=10, **sizes).collect()]
    assert len(found) == len(set(found)) and set(found) == by_hand(docs, items, 10)


def test_awkward_rows(spark):
    frame = documents(spark)
    items = [(1, "quiet morning"), (2, "word"), (3, "x" * 100_000), (4, "café naïve")]
    found = {tuple(r) for r in lexical_search.ranked(frame, frames(spark, [], items)[1], k=3).collect()} if items else set()
    assert found == by_hand([(r["doc_id"], r["text"]) for r in frame.collect()], items, 3)


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a b")], [(1, "a")])
    assert lexical_search.ranked(docs.limit(0), items).count() == 0
    assert lexical_search.ranked(docs, items.limit(0)).count() == 0


def test_tiles_stay_exact():
    wanted = np.array([(i, t) for i in range(1100) for t in range(i % 5, 4000, 97)])
    weights = np.full(4000, 3_000_000)
    largest = int(weights.max()) * 1_000_000
    seen = set()
    for first, end, parts in lexical_search._item_tiles(wanted, weights):
        assert end - first <= lexical_search.TILE_ITEMS
        for numbers, ones in parts:
            assert len(numbers) * largest < lexical_search.EXACT
            seen |= {(first + i, numbers[c]) for i, c in ones.tolist()}
    assert seen == {tuple(p) for p in wanted.tolist()}


def test_ties_survive_the_cut():
    import pyarrow as pa

    best = lexical_search._Best(1, 3)
    for ids in ([9, 8, 7], [1, None, 2], [6, 5, 4]):
        best.add(0, np.array([[5, 5, 5]]), pa.array(ids, pa.int64()))
        best._cut()
    (batch,) = best.batches()
    assert batch.column("id").to_pylist() == [1, 2, 4]
