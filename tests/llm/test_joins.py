"""Embedding and substring dedup and decontamination against brute force."""

from __future__ import annotations

import collections
import math
import random

import numpy as np
import pytest

from tallystick.llm import decontaminate, embedding_dedup, queries, substring_dedup
from tallystick.llm.oracles import statements
from tests.comparing import compare, duck
from tests.llm.frames import EDGES, PROSE, documents

VECTORS = "vec_id long, embedding array<float>, label int, size int, row string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label, 9, "x") for i, v, label in rows], VECTORS).repartition(3)


def links(rows, least=embedding_dedup.COSINE):
    def usable(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cosine(a, b):
        a, b = (np.asarray(x, np.float32).astype(float) for x in (a, b))
        return float(a @ b / math.sqrt((a @ a) * (b @ b)))

    return [
        [j for j, (_, w, other) in enumerate(rows) if i != j and usable(v, label) and usable(w, other) and label == other and len(v) == len(w) and cosine(v, w) >= least]
        for i, (_, v, label) in enumerate(rows)
    ]


def expected(rows):
    near = links(rows)
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        smallest = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((vec_id, len(near[i]), smallest, vec_id == smallest))
    return collections.Counter(out)


def test_awkward_vectors(spark):
    rows = [
        (1, [1, 0, 0], 1), (2, [1, 0.1, 0], 1), (2, [1, 0.1, 0], 1), (3, [1, 0, 0], 2), (4, [1, 0, 0], None), (5, None, 1), (6, [], 1), (7, [0, 0, 0], 1),
        (8, [1, None, 0], 1), (9, [float("nan"), 1, 0], 1), (10, [float("inf"), 1, 0], 1), (None, [2, 0, 0], 1), (11, [1, 0], 1), (12, [2, 0.01], 1),
        (13, [5], 1), (14, [7], 1), (15, [-7], 1), (None, [0, 0, 1], 1), (None, [0, 0, 1], 1), (16, [1e20, 0, 0], 1),
    ]
    found = embedding_dedup.near_duplicates(vectors(spark, rows)).collect()
    assert collections.Counter(map(tuple, found)) == expected(rows)


def test_hot_cluster_is_split_into_blocks(spark):
    draw = np.random.default_rng(5)
    centre = draw.standard_normal(64)
    rows = [(i, (centre + 0.2 * draw.standard_normal(64)).tolist(), i % 2) for i in range(160)]
    rows += [(i, draw.standard_normal(64).tolist(), i % 2) for i in range(160, 260)]
    found = embedding_dedup.near_duplicates(vectors(spark, rows), block=16).collect()
    assert collections.Counter(map(tuple, found)) == expected(rows)


def test_recall_at_the_least_cosine():
    draw = np.random.default_rng(8)
    x = embedding_dedup.Code._unit(draw.standard_normal((1500, 64)))
    y = draw.standard_normal((1500, 64))
    y = embedding_dedup.Code._unit(y - (x * y).sum(1, keepdims=True) * x)
    y = embedding_dedup.COSINE * x + math.sqrt(1 - embedding_dedup.COSINE**2) * y
    met = np.zeros(1500, bool)
    for n in range(embedding_dedup.CODES):
        code = embedding_dedup.Code(n, 64, embedding_dedup.COSINE, embedding_dedup.PASSES, embedding_dedup.WORDS)
        met |= [bool(len(np.intersect1d(a, b))) for a, b in zip(code.decode(x), code.decode(y), strict=True)]
    assert met.mean() > 0.99


@pytest.mark.parametrize("size", range(1, 8))
def test_recall_of_short_vectors(size):
    draw = np.random.default_rng([8, size])
    x = embedding_dedup.Code._unit(draw.standard_normal((800, size)))
    y = x
    if size > 1:
        y = draw.standard_normal(x.shape)
        y = embedding_dedup.Code._unit(y - (x * y).sum(1, keepdims=True) * x)
        y = embedding_dedup.COSINE * x + math.sqrt(1 - embedding_dedup.COSINE**2) * y
    met = np.zeros(800, bool)
    for n in range(embedding_dedup.CODES):
        code = embedding_dedup.Code(n, size, embedding_dedup.COSINE, embedding_dedup.PASSES, embedding_dedup.WORDS)
        met |= [bool(len(np.intersect1d(a, b))) for a, b in zip(code.decode(x), code.decode(y), strict=True)]
    assert met.mean() > 0.99


@pytest.mark.parametrize("size", [320, 384, 768])
def test_recall_of_long_vectors(size):
    draw = np.random.default_rng(8)
    x = embedding_dedup.Code._unit(draw.standard_normal((200, size)))
    y = draw.standard_normal((200, size))
    y = embedding_dedup.Code._unit(y - (x * y).sum(1, keepdims=True) * x)
    y = embedding_dedup.COSINE * x + math.sqrt(1 - embedding_dedup.COSINE**2) * y
    met = np.zeros(200, bool)
    for n in range(embedding_dedup.CODES):
        code = embedding_dedup.Code(n, size, embedding_dedup.COSINE, embedding_dedup.PASSES, embedding_dedup.WORDS)
        met |= [bool(len(np.intersect1d(a, b))) for a, b in zip(code.decode(x), code.decode(y), strict=True)]
    assert met.mean() > 0.98


def test_too_few_filters_are_refused():
    with pytest.raises(ValueError, match="share"):
        embedding_dedup.Code(0, 64, embedding_dedup.COSINE, embedding_dedup.PASSES, 1)


def test_copies_of_long_vectors_are_linked(spark):
    draw = np.random.default_rng(6)
    rows = [(i, draw.standard_normal(768).tolist(), 1) for i in range(20)]
    rows += [(100 + i, v, 1) for i, v, _ in rows[:10]]
    found = embedding_dedup.near_duplicates(vectors(spark, rows)).collect()
    assert collections.Counter(map(tuple, found)) == expected(rows)


def test_list_decoding_finds_all_filters():
    code = embedding_dedup.Code(0, 24, 0.93, 4.0, 64)
    x = embedding_dedup.Code._unit(np.random.default_rng(1).standard_normal((30, 24)))
    turned = x @ code.rotation
    every = (turned[:, :12] @ code.left.T)[:, :, None] + (turned[:, 12:] @ code.right.T)[:, None, :]
    for row, found in zip(every, code.decode(x), strict=True):
        assert list(found) == list(np.flatnonzero(row.ravel() >= code.height))


def test_no_vectors(spark):
    assert embedding_dedup.near_duplicates(vectors(spark, [])).collect() == []


@pytest.mark.parametrize("name", ["op1_warc_normalise", "op8_substring_dedup"])
def test_against_sql(spark, star_folder, name):
    _, problems = compare(spark, duck(star_folder), star_folder, queries.registered()[name], statements()[name])
    assert not problems


def test_embeddings_against_sql(spark, star_folder):
    _, problems = compare(spark, duck(star_folder), star_folder, queries.op3_embedding_near_dedup, statements()["op3_embedding_near_dedup"])
    assert not [p for p in problems if not p.startswith("types")]


def plain_removal(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    seen = collections.Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((doc_id, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return collections.Counter(out)


@pytest.mark.parametrize("split", [2000, 3, 0])
def test_substrings(spark, split):
    draw = random.Random(3)
    passage = [f"p{i}" for i in range(14)]
    rows = [(i, t) for i, t, _, _ in EDGES if t is None or len(t) < 50_000]
    for i in range(60):
        words = [f"w{draw.randrange(12)}" for _ in range(draw.randrange(40))]
        if i % 3 == 0:
            at = draw.randrange(len(words) + 1)
            words[at:at] = passage[draw.randrange(3) :]
        rows.append((100 + i, " ".join(words)))
    rows += rows[-3:]
    frame = documents(spark, [(i, t, "en", "a") for i, t in rows])
    for window, prefix in ((9, 3), (6, 6)):
        found = substring_dedup.remove_repeats(frame, window, prefix, split, batch_bytes=1500, group_bytes=4000).collect()
        assert collections.Counter(map(tuple, found)) == plain_removal(rows, window)


@pytest.mark.parametrize("split", [2000, 0])
def test_many_equal_rows(spark, split):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(1, passage)] * 30 + [(None, "a b c")] * 25 + [(2, f"x y {passage}"), (3, None), (3, "z " * 50)] + [(4, None)] * 30
    frame = documents(spark, [(i, t, "en", "a") for i, t in rows])
    found = substring_dedup.remove_repeats(frame, 10, 4, split, copies=20).collect()
    assert collections.Counter(map(tuple, found)) == plain_removal(rows, 10)


def test_equal_rows_do_not_pile_up_in_a_batch(spark):
    frame = documents(spark, [(1, "a b c", "en", "a")] * 300 + [(2, "a b c", "en", "a")])
    folded = substring_dedup._folded(frame.select("doc_id", "text"), substring_dedup.COPIES).collect()
    assert sorted((r["doc_id"], r["times"]) for r in folded) == [(1, 1), (1, 299), (2, 1)]


def test_subtrees_hold_all_common_prefixes():
    draw = np.random.default_rng(5)
    flat = [[b"%d" % x for x in draw.integers(0, 3, draw.integers(6, 40))] for _ in range(30)]
    flat += [flat[0][:20], flat[0][:20]]
    words = np.array([int(w) for s in flat for w in s]) + 1
    lengths = np.array([len(s) for s in flat])
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(words))
    ranks = substring_dedup._ranks(words, left, lengths.max())
    order = np.argsort(ranks[-1], kind="stable")
    suffix = [tuple(words[i : i + left[i]].tolist()) for i in order]
    assert suffix == sorted(suffix)
    plain = [next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))) for a, b in zip(suffix, suffix[1:], strict=False)]
    assert substring_dedup._common(ranks, left, order[:-1], order[1:]).tolist() == plain
    counts = draw.integers(1, 3, len(flat)).astype("<i4")
    requests = [flat[:10], flat[10:]]
    found, sizes = substring_dedup._subtree([[b" ".join(s) for s in r] for r in requests], [counts[:10], counts[10:]], 6)
    seen = collections.Counter()
    for s, n in zip(flat, counts, strict=True):
        for i in range(len(s) - 5):
            seen[tuple(s[i : i + 6])] += int(n)
    assert found.tolist() == [seen[tuple(s[i : i + 6])] > 1 for s in flat for i in range(len(s) - 5)]
    assert sizes == [sum(len(s) - 5 for s in r) for r in requests]


def test_prefixes_grow_to_the_whole_window(spark):
    """Passages that share 3, 8, 16 or all 20 words; with a split of 2 every length is needed."""
    assert substring_dedup.prefixes(8, 35) == [8, 16, 32]
    assert substring_dedup.prefixes(3, 20) == [3, 6, 12]
    passage = [f"p{i}" for i in range(20)]
    rows = []
    for i in range(120):
        shared = (3, 8, 16, 20)[i % 4]
        own = [f"u{i}-{j}" for j in range(20 - shared)] if i % 8 else [f"u{j}" for j in range(20 - shared)]
        rows.append((i, " ".join([f"a{i}", *passage[:shared], *own, f"z{i}"])))
    frame = documents(spark, [(i, t, "en", "a") for i, t in rows])
    found = substring_dedup.remove_repeats(frame, 20, 3, 2, batch_bytes=2000, group_bytes=2000).collect()
    assert collections.Counter(map(tuple, found)) == plain_removal(rows, 20)


def test_a_passage_repeated_very_often(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    frame = spark.range(100_000).selectExpr("id as doc_id", f"concat('a', id, ' b', id, ' {passage} c', id) as text")
    found = substring_dedup.remove_repeats(frame).groupBy("n_words", "n_removed").count().collect()
    assert [tuple(r) for r in found] == [(43, 40, 100_000)]


def test_a_batch_of_too_many_words_is_an_error(monkeypatch):
    monkeypatch.setattr(substring_dedup, "_PLACE_BITS", np.uint64(3))
    with pytest.raises(ValueError):
        substring_dedup.Batch(["a b c d e f g h"], 4, 2)


def test_substrings_of_no_rows(spark):
    assert substring_dedup.remove_repeats(documents(spark, [])).collect() == []


def slow_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_bit_parallel_distance():
    draw = random.Random(1)
    for _ in range(400):
        item, text = ("".join(draw.choice("abc") for _ in range(draw.randint(low, 14))) for low in (1, 0))
        assert decontaminate.best_end(item, text)[0] == slow_distance(item, text)


def test_matches_within_the_budget_are_found():
    draw = random.Random(2)
    letters = "abcdefgh "
    items = ["".join(draw.choice(letters) for _ in range(n)).strip("  ") for n in (30, 60, 90, 40)]
    items = [decontaminate.normalise(t) for t in items]
    matcher = decontaminate.Matcher(items, 0.1)
    for _ in range(150):
        number = draw.randrange(len(items))
        planted = list(items[number])
        for _ in range(draw.randint(0, decontaminate.budget(len(items[number]), 0.1) + 2)):
            at = draw.randrange(len(planted))
            planted[at : at + draw.randint(0, 1)] = draw.choice(["", "x", "yy"])
        text = "".join(draw.choice(letters) for _ in range(50)) + "".join(planted) + "".join(draw.choice(letters) for _ in range(50))
        found = {m[0]: m[1] for m in matcher.find(text)}
        for k, item in enumerate(items):
            least = slow_distance(item, text)
            assert found.get(k) == (least if least <= matcher.errors[k] else None)


BENCHMARK = [(1, "The keeper of the light walked slowly down to the water"), (1, "It was a quiet morning in the harbour and the boats"), (2, None), (3, ""), (4, "too short"), (None, "with a basket of bread for the gulls that waited")]


@pytest.mark.parametrize("block_chars", [decontaminate.BLOCK_CHARS, 60])
def test_contaminated_documents(spark, block_chars):
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in BENCHMARK], "item_id long, text string, doc_id string")
    frame = documents(spark)
    found = decontaminate.contaminated(frame, benchmark, block_chars=block_chars).collect()
    holders = [i for i, t, _, _ in EDGES if t and PROSE in t]
    assert collections.Counter((r["doc_id"], r["item_id"]) for r in found) == collections.Counter((d, i) for d in holders for i in (1, 1, None))
    assert all(r["distance"] == 0 for r in found)
    clean = decontaminate.without_contaminated(frame, benchmark, block_chars=block_chars)
    assert clean.columns == frame.columns
    assert collections.Counter(r["doc_id"] for r in clean.collect()) == collections.Counter(i for i, t, _, _ in EDGES if not (t and PROSE in t))


def test_plan_does_not_grow_with_the_blocks(spark):
    items = [(i, f"{i} " + " ".join(f"item{i}word{j}" for j in range(6))) for i in range(40)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = documents(spark, [(i, f"before {t.upper()} after" if i % 2 else f"nothing {i}", "en", "a") for i, t in items])
    one, many = (decontaminate.contaminated(frame, benchmark, block_chars=n) for n in (10_000, 900))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    assert sorted(r["item_id"] for r in many.collect()) == list(range(1, 40, 2))
    assert len(many._jdf.queryExecution().logical().toString()) < 2000
    clean = decontaminate.without_contaminated(frame, benchmark, block_chars=900)
    assert clean.schema == frame.schema
    assert sorted(r["doc_id"] for r in clean.collect()) == list(range(0, 40, 2))


def test_short_items_match_exactly_as_whole_words(spark):
    items = [(1, "Two plus  two"), (2, "x"), (3, ""), (4, None), (5, "a sentence that is long enough for edits")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = ["what is two plus two?", "two plus twofold", "two plus twu", "(x)", "xy", "a sentence that is lang enough for edits", None]
    frame = documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    found = {(r["doc_id"], r["item_id"], r["distance"]) for r in decontaminate.contaminated(frame, benchmark, short=True).collect()}
    assert found == {(0, 1, 0), (3, 2, 0), (5, 5, 1)}
    assert [r["item_id"] for r in decontaminate.contaminated(frame, benchmark).collect()] == [5]
    assert sorted(r["doc_id"] for r in decontaminate.without_contaminated(frame, benchmark, short=True).collect()) == [1, 2, 4, 6]


def test_decontamination_of_no_rows(spark):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(documents(spark), benchmark).collect() == []
    assert decontaminate.without_contaminated(documents(spark), benchmark).count() == len(EDGES)
    full = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    assert decontaminate.contaminated(documents(spark, []), full).collect() == []


def test_decontamination_query(spark, star_folder):
    texts = dict(spark.read.parquet(f"{star_folder}/documents.parquet").select("doc_id", "text").collect())
    items = [(r["item_id"], decontaminate.normalise(r["text"])) for r in spark.read.parquet(f"{star_folder}/benchmark.parquet").collect()]
    found = {(r["doc_id"], r["item_id"]) for r in queries.op10_benchmark_decontamination(spark, star_folder).collect()}
    exact = {(d, i) for d, t in texts.items() for i, item in items if len(item) >= decontaminate.MIN_CHARS and item in decontaminate.normalise(t)}
    assert exact and exact <= found
    for d, i in found - exact:
        item = dict(items)[i]
        assert decontaminate.best_end(item, decontaminate.normalise(texts[d]))[0] <= decontaminate.budget(len(item))
