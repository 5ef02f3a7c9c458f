"""Embedding near-dedup by spherical-cap filters with structured random product codes.

Two vectors are linked if their labels are equal and the cosine of the angle between them, in
double precision, is at least ``COSINE``. A filter is a direction; a vector passes it if its
cosine with the direction exceeds a height. The directions are a product code: after a seeded
rotation a vector is cut in two halves, each half has its own random unit code words, and a
direction joins a word of either half. A vector's filters are list-decoded: only words of the
first half that can still reach the height with the best word of the second are followed.
Vectors that pass a common filter meet there, and every meeting pair is verified exactly.

The search is probabilistic. ``CODES`` independent codes are used, because a vector that lies
badly to the words of one code passes few of its filters; ``PASSES`` is the number of filters of
a code that a pair at the least cosine is expected to share, which fixes the height (worked out
per dimension on seeded pairs). Filters of short vectors are few and uneven, so there the height
also falls until at most ``LONELY`` of the pairs share no filter of a code. At 64 dimensions about one pair in a thousand at exactly the
least cosine is missed, and none of the nearer ones. Lengths at which pairs share fewer than half
of ``PASSES`` are refused with an error. More rows call for more ``WORDS``: filters
get narrower at the same expected number.

A filter passed by a single vector cannot hold a pair and is dropped by counting. A filter
with more than ``BLOCK`` vectors is split into blocks, each pair of blocks being one group, so
a task holds at most two blocks. A pair is counted in the lowest filter it shares, in one
group; groups return counts per vector and the spanning forest of their links, never pairs.

Cases: vectors that are NULL, empty, zero or hold NULL or non-finite components, and vectors
with a NULL label, link with nothing; vectors of different lengths are not compared; equal
vectors link like any others; NULL and repeated ids are ordinary rows, a class's id being the
smallest id that is not NULL; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystick.llm.common import components
from tallystick.llm.simhash_dedup import forest
from tallystick.sources.workspace import staged

COSINE = 0.93
CODES = 6
PASSES = 4.0
WORDS = 1024
BLOCK = 512
SHORT = 7
LONELY = 0.25
SEED = 31
_ROWS = 256


class Code:
    """The filters for vectors of one length; short vectors take fewer words."""

    def __init__(self, number: int, size: int, cosine: float, passes: float, words: int, height: float | None = None):
        draw = np.random.default_rng([SEED, size, number])
        self.number = number
        self.size, self.cut = size, (size + 1) // 2
        self.words = min(words, 4**self.cut)
        self.rotation = np.linalg.qr(draw.standard_normal((size, size)))[0]
        self.left = self._unit(draw.standard_normal((self.words, self.cut))) / np.sqrt(2)
        self.right = self._unit(draw.standard_normal((self.words, max(size - self.cut, 1)))) / np.sqrt(2)
        # Pairs at exactly the least cosine, to place the height.
        short = size <= SHORT
        x = self._unit(draw.standard_normal((256 if short else 64, size)))
        y = draw.standard_normal(x.shape)
        y = self._unit(y - (x * y).sum(1, keepdims=True) * x)
        y = cosine * x + np.sqrt(max(1 - cosine**2, 0)) * y
        # Reachable heights shrink with the root of the length, and so must the step.
        low, high = 0.0, 1.0
        while height is None and high - low > min(0.003, 0.024 / np.sqrt(size)):
            middle = (low + high) / 2
            shared = self._shared(x, y, middle)
            enough = shared.mean() > passes and (not short or (shared == 0).mean() <= LONELY)
            low, high = (middle, high) if enough else (low, middle)
        self.height = low if height is None else height
        if height is None and (shared := self._shared(x, y, low).mean()) < passes / 2:
            raise ValueError(f"pairs of length {size} share {shared:.2f} filters, {passes} wanted: more words or a higher cosine needed")

    @staticmethod
    def _unit(rows: np.ndarray) -> np.ndarray:
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)

    def _shared(self, x: np.ndarray, y: np.ndarray, height: float) -> np.ndarray:
        """Number of filters that each row pair shares at a height."""
        self.height = height
        return np.array([len(np.intersect1d(a, b)) for a, b in zip(self.decode(x), self.decode(y), strict=True)])

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """Numbers of the filters that each unit vector passes, ascending."""
        turned = unit @ self.rotation
        a = turned[:, : self.cut] @ self.left.T
        b = turned[:, self.cut :] @ self.right.T if self.size > self.cut else np.zeros((len(unit), self.words))
        found = []
        for row_a, row_b in zip(a, b, strict=True):
            first = np.flatnonzero(row_a >= self.height - row_b.max())
            i, j = np.nonzero(row_a[first, None] + row_b[None, :] >= self.height)
            found.append((self.number * self.words + first[i]) * self.words + j)
        return found


@lru_cache(64)
def _code(number: int, size: int, cosine: float, passes: float, words: int, height: float) -> Code:
    return Code(number, size, cosine, passes, words, height)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])


def links(vectors: DataFrame, cosine: float, codes: int, passes: float, words: int, block: int) -> DataFrame:
    """(row, label, size, vector) -> (a, b, n): n links counted at row a, in one group.

    b is the smallest row reachable within the group.
    """
    lengths = [r["size"] for r in vectors.select("size").distinct().collect()]
    heights = {(n, size): Code(n, size, cosine, passes, words).height for size in lengths for n in range(codes)}

    def pass_filters(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, part in batch.groupby("size"):
                for at in range(0, len(part), _ROWS):
                    rows = part.iloc[at : at + _ROWS]
                    unit = Code._unit(_matrix(rows["vector"]))
                    for n in range(codes):
                        passed = _code(n, int(size), cosine, passes, words, heights[n, int(size)]).decode(unit)
                        counts = [len(x) for x in passed]
                        yield pd.DataFrame({"row": np.repeat(rows["row"].to_numpy(), counts), "filter": np.concatenate(passed).astype(np.int64)})

    filters = vectors.select("row", "size", "vector").mapInPandas(pass_filters, "row long, filter long")
    filters = staged(filters.join(vectors.select("row", "label", "size"), "row"), "filters")
    where = ["label", "size", "filter"]
    sizes = filters.groupBy(*where).agg(F.count("*").alias("n")).where("n > 1")
    met = filters.join(sizes, where).withColumn("blocks", F.ceil(F.col("n") / block))
    # Only filters where vectors meet matter for finding the lowest one that a pair shares.
    shared = met.groupBy("row").agg(F.array_sort(F.collect_list("filter")).alias("filters"))
    met = met.join(vectors.select("row", "vector").join(shared, "row"), "row")
    met = met.withColumn("own", F.pmod(F.xxhash64("row"), F.col("blocks")))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    groups = met.groupBy(*where, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    member = F.struct("row", "own", "vector", "filters")
    gathered = groups.agg(F.collect_list(member).alias("members")).where(F.size("members") > 1)
    columns = [F.col(f"members.{c}").alias(c) for c in ("row", "own", "vector", "filters")]

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            wanted = np.ones(len(batch), bool)
            pairs = np.flatnonzero(batch["row"].map(len) == 2)
            lengths = np.array([len(batch["vector"].iat[k][0]) for k in pairs])
            for length in np.unique(lengths):  # most groups are chance pairs, which one product drops
                same = pairs[lengths == length]
                both = np.stack([_matrix(batch["vector"].iat[k]) for k in same])
                wanted[same] = exact_cosine(both[:, 0], both[:, 1]) >= cosine
            out = [
                _verified(number, low, high, np.asarray(row, np.int64), np.asarray(own, np.int64), _matrix(vector), filters, cosine)
                for number, low, high, row, own, vector, filters in batch[wanted].itertuples(index=False)
            ]
            if out:
                a, b, n = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pd.DataFrame({"a": a, "b": b, "n": n})

    return gathered.select("filter", "low", "high", *columns).mapInPandas(verify, "a long, b long, n long")


def _verified(number: int, low: int, high: int, row: np.ndarray, own: np.ndarray, vectors: np.ndarray, filters: list, cosine: float) -> tuple:
    unit = Code._unit(vectors)
    cosines = unit @ unit.T
    # Rounding differs from one batch to another, so the border is decided by one formula.
    i, j = np.nonzero(np.triu(cosines >= cosine + 1e-9, 1))
    k, m = np.nonzero(np.triu(np.abs(cosines - cosine) < 1e-9, 1))
    border = exact_cosine(vectors[k], vectors[m]) >= cosine
    i, j = np.concatenate((i, k[border])), np.concatenate((j, m[border]))
    if low != high:
        apart = own[i] != own[j]
        i, j = i[apart], j[apart]
    if not len(i):
        none = np.zeros(0, np.int64)
        return none, none, none
    involved = np.unique(np.concatenate((i, j)))
    flat = np.concatenate([np.asarray(filters[k], np.int64) for k in involved])
    holder = np.repeat(np.arange(len(involved)), [len(filters[k]) for k in involved])
    values, column, held_by = np.unique(flat[flat < number], return_inverse=True, return_counts=True)
    holder, column = holder[flat < number][held_by[column] > 1], column[held_by[column] > 1]
    common = np.zeros((len(involved), len(involved)), np.float32)
    for at in range(0, len(values), 512):
        inside = (column >= at) & (column < at + 512)
        held = np.zeros((len(involved), 512), np.float32)
        held[holder[inside], column[inside] - at] = 1
        common += held @ held.T
    earlier = common[np.searchsorted(involved, i), np.searchsorted(involved, j)] > 0
    i, j = i[~earlier], j[~earlier]
    counts = np.bincount(np.concatenate((i, j)), minlength=len(row))
    order = np.argsort(row, kind="stable")
    rank = np.empty(len(row), np.int64)
    rank[order] = np.arange(len(row))
    root = row[order][forest(len(row), rank[i], rank[j])][rank]
    linked = counts > 0
    return row[linked], root[linked], counts[linked]


def exact_cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Double-precision cosine of row pairs, the same whatever batch they come in."""
    return (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1))


def near_duplicates(
    embeddings: DataFrame, cosine: float = COSINE, codes: int = CODES, passes: float = PASSES, words: int = WORDS, block: int = BLOCK
) -> DataFrame:
    """(vec_id, embedding, label, ...) -> (vec_id, n_links, component_id, kept), a row per vector."""
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    single = embeddings.schema["embedding"].dataType.simpleString() == "array<float>"
    vector = F.col("embedding") if single else F.col("embedding").cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & (F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0)
    rows = embeddings.select("vec_id", "label", vector.alias("vector")).withColumn("row", F.monotonically_increasing_id())
    rows = staged(rows.withColumn("size", F.size("vector")).withColumn("usable", F.coalesce(usable, F.lit(False))), "vectors")
    found = staged(links(rows.where("usable").select("row", "label", "size", "vector"), cosine, codes, passes, words, block), "links")
    counted = found.groupBy("a").agg(F.sum("n").alias("n_links"))
    roots = components(found.select("a", "b"))
    named = rows.select("vec_id", "row").join(counted, F.col("row") == F.col("a"), "left").drop("a")
    named = named.join(roots, F.col("row") == F.col("node"), "left").withColumn("class", F.coalesce("root", "row"))
    smallest = named.groupBy("class").agg(F.min("vec_id").alias("component_id"))
    result = named.join(smallest, "class")
    return result.select(
        F.col("vec_id").cast(kind).alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
