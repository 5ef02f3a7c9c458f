"""Ranked lexical search: dense blocked matrix multiplication over the items' vocabulary.

Items, a stated query set, are taken in blocks of bounded size, one job after the other; only
one block's terms are ever in the driver. Per block, each document is cut into terms once and
staged as its length and its counts of the block's terms. Document frequencies are a grouped
count of those. The scoring tasks then fill dense float64 tiles of documents' impacts and
multiply them by 0/1 tiles of items, whose vocabulary is compacted per tile of items.

An impact is a whole number; a vocabulary tile is so narrow that the sum of its largest
impacts stays below 2^53, so every product is exact, and tiles are added up as 64-bit
integers. Each task keeps the ``k`` best of every item by (score descending, id ascending) and
its partial lists are merged in two steps, so no task sees the scores of all documents.

Cases: NULL and empty texts have no term; they count in no statistic and are never found.
Documents with equal ids are ranked row by row, NULL ids after all others of the same score.
Rows of equal item ids are one item with the terms of all of them, each term once; an item
without a term, or whose terms no document holds, gets no row. Empty tables give no rows.
Only the named columns are read, so others may have any name. Texts are read whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystick.operators.ordering import first_per_key
from tallystick.sources.workspace import staged

# Fixed value: a term is a run of ASCII letters, digits and anything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The same for UTF-8 bytes: letters in lower case, separators as spaces.
_BYTES = bytes(b if chr(b) in _LOWER + "0123456789" or b > 0x7F else b + 32 if chr(b) in _UPPER else 32 for b in range(256))

EXACT = 1 << 53
BLOCK_TERMS = 1 << 20  # (item, term) pairs that reach the driver at once
BLOCK_ITEMS = 4096
TILE_ITEMS, TILE_TERMS, TILE_DOCS = 512, 2048, 1024
MERGE_PARTS = 64

POSTINGS = "id long, n long, term array<int>, tf array<int>"
FOUND = "item int, id long, score long"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(TERM), F.lit(0))


def ranked(documents: DataFrame, items: DataFrame, k: int = 50, block_terms: int = BLOCK_TERMS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item, score above 0."""
    if k < 1:
        raise ValueError("k must be at least 1")
    asked = items.select("item_id", F.explode(terms(F.col("text"))).alias("term")).distinct()
    asked = staged(asked, "item-terms")
    size = asked.agg(F.count("*").alias("terms"), F.count_distinct(F.coalesce(F.col("item_id").cast("string"), F.lit("")))).first()
    blocks = max(1, -(-size[0] // block_terms), -(-size[1] // block_items))
    found: DataFrame | None = None
    for block in range(blocks):
        part = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        best = _block(documents, part, items, k)
        found = best if found is None else staged(found.unionAll(best), "ranked")
    return found


def _block(documents: DataFrame, asked: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """One block's result; the frame reads staged tables only."""
    pairs = asked.orderBy("term", "item_id").toArrow()
    vocabulary = {term: at for at, term in enumerate(dict.fromkeys(pairs["term"].to_pylist()))}
    numbers = {item: at for at, item in enumerate(dict.fromkeys(pairs["item_id"].to_pylist()))}
    wanted = np.array(
        [(numbers[i], vocabulary[t]) for i, t in zip(pairs["item_id"].to_pylist(), pairs["term"].to_pylist(), strict=True)],
        dtype=np.int64,
    ).reshape(-1, 2)
    context = documents.sparkSession.sparkContext
    lookup = context.broadcast({term.encode(): at for term, at in vocabulary.items()})
    counted = staged(_postings(documents, lookup), "postings")
    total, length = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(len(vocabulary), dtype=np.int64)
    for term, df in counted.select(F.explode("term").alias("t")).groupBy("t").count().collect():
        holding[term] = df
    weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1))) for df in holding.tolist()], dtype=np.int64)
    tiles = context.broadcast((_item_tiles(wanted, weights), weights))
    best = staged(_scored(counted, tiles, total, length, k), "best")
    lookup.unpersist()
    tiles.unpersist()
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    ids = documents.sparkSession.createDataFrame(
        [(at, item) for item, at in numbers.items()], items.select(F.lit(0).alias("item"), "item_id").schema
    )
    place = F.row_number().over(Window.partitionBy("item").orderBy(*order)).alias("rank")
    top = best.transform(lambda b: first_per_key(b, ["item", "part"], order, k)).select("item", "id", "score", place).where(F.col("rank") <= k)
    return top.join(ids, "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def _postings(documents: DataFrame, lookup) -> DataFrame:
    """Per document with a term: number of its terms, and counts of the block's terms."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lookup.value.get
        for batch in batches:
            keep, n, ends, found, tf = [], [], [0], [], []
            for at, text in enumerate(batch.column(1)):
                words = text.as_buffer().to_pybytes().translate(_BYTES).split() if text.is_valid else ()
                if words:
                    counts = Counter(map(known, words))
                    counts.pop(None, None)
                    keep.append(at)
                    n.append(len(words))
                    found.extend(counts.keys())
                    tf.extend(counts.values())
                    ends.append(len(found))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int32())) for v in (found, tf)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()), *lists], names=["id", "n", "term", "tf"]
            )

    return documents.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text")).mapInArrow(cut, POSTINGS)


def _item_tiles(wanted: np.ndarray, weights: np.ndarray) -> list[tuple[int, int, list[tuple[np.ndarray, np.ndarray]]]]:
    """(first item, end, vocabulary tiles): a vocabulary tile is its term numbers, sorted, and
    the (item, column) places of the ones. Its width keeps sums of impacts below 2^53."""
    largest = max(int(weights.max(initial=0)), 1) * 1_000_000
    width = max(1, min(TILE_TERMS, (EXACT - 1) // largest))
    wanted = wanted[np.lexsort((wanted[:, 1], wanted[:, 0]))]
    count = int(wanted[:, 0].max(initial=-1)) + 1
    tiles = []
    for first in range(0, count, TILE_ITEMS):
        end = min(first + TILE_ITEMS, count)
        mine = wanted[(wanted[:, 0] >= first) & (wanted[:, 0] < end)]
        compact, columns = np.unique(mine[:, 1], return_inverse=True)
        parts = []
        for left in range(0, len(compact), width):
            inside = (columns >= left) & (columns < left + width)
            parts.append((compact[left : left + width], np.stack([mine[inside, 0] - first, columns[inside] - left], 1)))
        tiles.append((first, end, parts))
    return tiles


def _scored(counted: DataFrame, tiles, total: int, length: int, k: int) -> DataFrame:
    """The k best documents of every item among each task's, with the task's ``part``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_tiles, weights = tiles.value
        best = _Best(item_tiles[-1][1] if item_tiles else 0, k)
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_DOCS):
                _score_tile(batch.slice(at, TILE_DOCS), item_tiles, weights, total, length, best)
        yield from best.batches()

    rows = counted.mapInArrow(score, FOUND)
    return rows.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGE_PARTS)))


def _score_tile(batch: pa.RecordBatch, item_tiles, weights: np.ndarray, total: int, length: int, best: _Best) -> None:
    term, tf = (batch.column(name).flatten().to_numpy().astype(np.int64) for name in ("term", "tf"))
    n = batch.column("n").to_numpy()
    held = batch.column("term").value_lengths().to_numpy().astype(np.int64)
    row = np.repeat(np.arange(batch.num_rows), held)
    norm = 50 + (50 * n * total) // max(length, 1)
    impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * norm[row]))
    for first, end, parts in item_tiles:
        scores = np.zeros((end - first, batch.num_rows), dtype=np.int64)
        for numbers, ones in parts:
            column = np.searchsorted(numbers, term)
            inside = (column < len(numbers)) & (numbers[np.minimum(column, len(numbers) - 1)] == term)
            if not inside.any():
                continue
            used, narrow = np.unique(column[inside], return_inverse=True)  # terms these documents hold
            documents = np.zeros((len(used), batch.num_rows))
            documents[narrow, row[inside]] = impact[inside]
            place = np.searchsorted(used, ones[:, 1])
            there = (place < len(used)) & (used[np.minimum(place, len(used) - 1)] == ones[:, 1])
            items = np.zeros((end - first, len(used)))
            items[ones[there, 0], place[there]] = 1
            scores += (items @ documents).astype(np.int64)
        best.add(first, scores, batch.column("id"))


class _Best:
    """The k best of every item: candidates at least as good as the k-th so far are gathered
    and cut back by (score descending, id ascending, NULL ids last)."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.least = np.ones(items, dtype=np.int64)
        self.held = [np.zeros((0, 4), dtype=np.int64)]
        self.size = 0

    def add(self, first: int, scores: np.ndarray, ids: pa.Array) -> None:
        missing = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
        known = ids.fill_null(0).to_numpy()
        item, doc = np.nonzero(scores >= self.least[first : first + len(scores), None])
        if len(item):
            self.held.append(np.stack([item + first, scores[item, doc], missing[doc], known[doc]], 1))
            self.size += len(item)
            if self.size > max(1 << 18, 2 * self.k * len(self.least)):
                self._cut()

    def _cut(self) -> None:
        rows = np.concatenate(self.held)
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        place = np.arange(len(rows)) - np.searchsorted(rows[:, 0], rows[:, 0])
        rows = rows[place < self.k]
        kth = place[place < self.k] == self.k - 1
        self.least[rows[kth, 0]] = rows[kth, 1]
        self.held, self.size = [rows], 0

    def batches(self) -> Iterator[pa.RecordBatch]:
        self._cut()
        rows = self.held[0]
        for at in range(0, len(rows), 1 << 16):
            part = rows[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[:, 0].astype(np.int32)),
                    pa.array(part[:, 3], mask=part[:, 2].astype(bool)),
                    pa.array(part[:, 1]),
                ],
                names=["item", "id", "score"],
            )
