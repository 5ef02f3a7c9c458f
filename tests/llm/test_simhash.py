from __future__ import annotations

import numpy as np
import pytest
import xxhash

from tallystick.llm import simhash_dedup as simhash
from tallystick.llm.common import components
from tests.llm.frames import documents


def slow_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({i: " " for i in (*range(9, 14),)}).split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def classes(prints, bits=4):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def expected(rows):
    prints = [slow_fingerprint(t) for _, t in rows]
    roots = classes(prints)
    smallest = {}
    for (i, _), root in zip(rows, roots, strict=True):
        smallest[root] = min((x for x in (i, smallest.get(root)) if x is not None), default=None)
    return sorted(((i, p, smallest[r]) for (i, _), p, r in zip(rows, prints, roots, strict=True)), key=str)


def check(frame):
    rows = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    found = simhash.near_duplicates(frame).collect()
    assert sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in found), key=str) == expected(rows)


def test_awkward_rows(spark):
    check(documents(spark))


def test_no_rows(spark):
    assert simhash.near_duplicates(documents(spark, [])).collect() == []
    assert simhash.deduplicate(documents(spark, [])).collect() == []


def test_given_documents(spark, star_folder):
    check(spark.read.parquet(f"{star_folder}/documents.parquet"))


def test_hot_keys_split_into_blocks(spark):
    """A chain and a cloud around one fingerprint, all in shared keys, with tiny blocks."""
    draw = np.random.default_rng(0)
    values = {0x0123456789ABCDEF}
    while len(values) < 120:
        base = int(draw.choice(np.array(sorted(values), np.uint64)))
        values.add(base ^ sum(1 << int(b) for b in draw.choice(64, 3, replace=False)))
    values |= {int(x) for x in draw.integers(0, 2**64, 60, np.uint64)}
    nodes = spark.createDataFrame([(int(np.int64(np.uint64(v).view(np.int64))),) for v in values], "fp long")
    edges = simhash.links(simhash.with_pivots(nodes), 4, block=8)
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    prints = [r["fp"] for r in nodes.collect()]
    plain = classes([p % (1 << 64) for p in prints])
    ours = [roots.get(p, p) for p in prints]
    assert len(set(zip(plain, ours, strict=True))) == len(set(plain)) == len(set(ours))


def test_pivot_table_discards_pairs_and_keeps_every_link(spark):
    """The table drops most chance pairs before bits are counted, and no linked one."""
    draw = np.random.default_rng(1)
    fps = draw.integers(0, 2**64, 400, np.uint64)
    flips = np.array([sum(1 << int(b) for b in draw.choice(64, 4, replace=False)) for _ in range(200)], np.uint64)
    fps = np.concatenate((fps, fps[:200] ^ flips))
    frame = spark.createDataFrame([(x,) for x in fps.view(np.int64).tolist()], "fp long")
    rows = {r["fp"]: r["pivots"] for r in simhash.with_pivots(frame).collect()}
    table = np.stack([np.frombuffer(rows[x], np.int8) for x in fps.view(np.int64).tolist()])
    for at in range(simhash.PIVOTS):
        assert table[7, at] == int(fps[7] ^ simhash._REFERENCES[at]).bit_count()
    i, j = np.triu_indices(len(fps), 1)
    far = np.abs(table[i].astype(int) - table[j]).max(1) > 4
    linked = np.bitwise_count(fps[i] ^ fps[j]) <= 4
    assert not (far & linked).any() and linked.sum() >= 200
    assert far.sum() > 0.9 * len(i)
    found = simhash.linked_pairs(fps, table, 4)
    assert set(zip(*(x.tolist() for x in found), strict=True)) == set(zip(i[linked].tolist(), j[linked].tolist(), strict=True))
    twos = simhash.linked_twos(np.stack((fps[i], fps[j]), 1), np.stack((table[i], table[j]), 1), 4)
    assert (twos == linked).all()


def test_one_document_of_a_class_stays_with_all_columns(spark):
    frame = documents(spark)
    kept = simhash.deduplicate(frame)
    assert kept.columns == frame.columns
    rows = kept.collect()
    want = {(r["component_fp"]) for r in simhash.near_duplicates(frame).collect()}
    assert len(rows) == len(want)
    assert {r["doc_id"] for r in rows} == {r["component_id"] for r in simhash.near_duplicates(frame).collect()}


@pytest.mark.parametrize("edges", [[(1, 2), (2, 3), (9, 9), (5, 4), (4, 6), (6, 5), (3, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)], []])
def test_components(spark, edges):
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    plain = {}
    for a, b in edges:
        plain.setdefault(a, a), plain.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(plain[a], plain[b])
            changed |= plain[a] != low or plain[b] != low
            plain[a] = plain[b] = low
    assert found == {k: v for k, v in plain.items() if any(k in e and e[0] != e[1] for e in edges)}
