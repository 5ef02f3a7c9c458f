"""SimHash near-duplicates verified through pivot distance tables.

A document's fingerprint takes a bit where more than half of its shingle hashes have it.
Documents with equal fingerprints are one node; nodes within ``max_bits`` differing bits are
linked, and a document's class is its connected component.

The pivot table holds every distinct fingerprint's Hamming distances to ``PIVOTS`` fixed
reference fingerprints. It is worked out once, written to the shared folder, and a fingerprint
carries its row of the table into every group. By the triangle inequality a pair within
``max_bits`` differs by at most that much in every coordinate, so any pair, also one that meets
alone, whose largest coordinate difference exceeds it is discarded without comparing its
fingerprints; survivors are verified by counting differing bits. A whole-fingerprint
coordinate is Binomial(64, 1/2), so such a band alone holds more than half of all rows and
cannot serve as a join key. Pairs are therefore first met by pigeonhole: of ``max_bits`` + 2
segments at least two agree entirely in a linked pair, and each choice of two segments is a
key. All steps are exact; nothing is sampled or capped.

A key shared by more than ``BLOCK`` fingerprints is split into blocks of that size, and each
pair of blocks is one group. A group returns the spanning forest of its links, not the links,
so what leaves it grows with its members, not with their square.

Cases: a NULL, empty or blank text has fingerprint zero and is linked like any other; NULL ids
do not count for the smallest id (a class of NULL ids only has a NULL one); repeated rows stay
repeated; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystick.llm.common import components
from tallystick.sources.workspace import staged

SHINGLE = 4
MAX_BITS = 4
BLOCK = 2048
PIVOTS = 16
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the whole text; XXH64 with seed 42 over word shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    size = min(shingle, len(words))
    starts = np.concatenate(([0], ends[: len(words) - size] + 1)).tolist()
    stops = ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), _CHUNK):
        spans = zip(starts[at : at + _CHUNK], stops[at : at + _CHUNK], strict=True)
        hashes = np.array([digest(joined[a:b], 42) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<i8")[0])


def fingerprint_column(text: str, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text column, computed in Arrow batches."""

    @F.pandas_udf("long")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return score(F.col(text))


def _keys(fp: Column, max_bits: int) -> Column:
    """One key for each choice of two segments; the choice itself is part of the key."""
    parts = max_bits + 2
    edges = [round(64 * i / parts) for i in range(parts + 1)]
    segments = [
        F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) for lo, hi in zip(edges, edges[1:], strict=False)
    ]
    return F.array(
        *(
            F.struct(F.lit(n).alias("pair"), (F.shiftleft(segments[i], 32) + segments[j]).alias("bits"))
            for n, (i, j) in enumerate(combinations(range(parts), 2))
        )
    )


_REFERENCES = np.random.default_rng(64).integers(0, 2**64, PIVOTS, np.uint64)


def pivot_distances(fps: np.ndarray) -> np.ndarray:
    """Distances of each fingerprint (uint64) to each reference, one row per fingerprint."""
    return np.bitwise_count(fps[:, None] ^ _REFERENCES[None, :]).astype(np.int8)


def with_pivots(nodes: DataFrame) -> DataFrame:
    """The pivot table: rows with fp get their distances, one byte for each reference."""

    @F.pandas_udf("binary")
    def distances(fps: pd.Series) -> pd.Series:
        rows = pivot_distances(fps.to_numpy(np.int64).view(np.uint64))
        return pd.Series([row.tobytes() for row in rows], dtype=object)

    return nodes.withColumn("pivots", distances("fp"))


def _table(pivots: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(pivots), np.int8).reshape(-1, PIVOTS)


def linked_pairs(fps: np.ndarray, pivots: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of fingerprints (uint64) within max_bits; pivots are their table rows."""
    table = np.ascontiguousarray(pivots.T)
    left, right = [], []
    for at in range(0, len(fps), 256):
        close = np.ones((min(256, len(fps) - at), len(fps) - at), bool)
        for row in table:
            close &= np.abs(row[at : at + 256, None] - row[None, at:]) <= max_bits
        i, j = np.nonzero(np.triu(close, 1))
        near = np.bitwise_count(fps[at + i] ^ fps[at + j]) <= max_bits
        left.append(at + i[near])
        right.append(at + j[near])
    return np.concatenate(left), np.concatenate(right)


def linked_twos(fps: np.ndarray, pivots: np.ndarray, max_bits: int) -> np.ndarray:
    """Which groups of two are linked; fps is (groups, 2), pivots (groups, 2, PIVOTS)."""
    linked = np.abs(pivots[:, 0] - pivots[:, 1]).max(1) <= max_bits
    left = np.flatnonzero(linked)
    linked[left] = np.bitwise_count(fps[left, 0] ^ fps[left, 1]) <= max_bits
    return linked


def forest(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable by the links, for each index."""
    label = np.arange(size)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        label = label[label]
        if (label == before).all():
            break
    return label


def links(nodes: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Distinct fingerprints (fp, pivots) -> edges (a, b) with the components of all links."""
    keyed = nodes.select("fp", "pivots", F.explode(_keys(F.col("fp"), max_bits)).alias("key"))
    keyed = keyed.select("fp", "pivots", "key.pair", "key.bits")
    sizes = keyed.groupBy("pair", "bits").agg(F.count("*").alias("n")).where("n > 1")
    met = keyed.join(sizes, ["pair", "bits"]).withColumn("blocks", F.ceil(F.col("n") / block))
    met = met.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    groups = met.groupBy("pair", "bits", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    gathered = groups.agg(F.collect_list(F.struct("fp", "pivots")).alias("members")).where(F.size("members") > 1)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = [], []
            alone = batch["fps"].map(len).to_numpy() == 2
            if alone.any():
                fps = np.stack(batch["fps"][alone].to_numpy()).astype(np.int64)
                pivots = _table(p for both in batch["pivots"][alone] for p in both).reshape(-1, 2, PIVOTS)
                linked = linked_twos(fps.view(np.uint64), pivots, max_bits)
                a.append(fps[linked, 0])
                b.append(fps[linked, 1])
            for values, rows in zip(batch["fps"][~alone], batch["pivots"][~alone], strict=True):
                fps = np.asarray(values, np.int64)
                label = forest(len(fps), *linked_pairs(fps.view(np.uint64), _table(rows), max_bits))
                inner = label != np.arange(len(fps))
                a.append(fps[inner])
                b.append(fps[label[inner]])
            if a:
                yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    members = gathered.select(F.col("members.fp").alias("fps"), F.col("members.pivots").alias("pivots"))
    return members.mapInPandas(search, "a long, b long")


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text, ...) -> (doc_id, fp, component_fp, component_id), a row per document.

    component_fp names the class even where it has no id.
    """
    return _classes(staged(_prints(documents, shingle), "fingerprints"), max_bits)


def _prints(documents: DataFrame, shingle: int) -> DataFrame:
    return documents.select("doc_id", fingerprint_column("text", shingle).alias("fp"))


def _classes(prints: DataFrame, max_bits: int) -> DataFrame:
    nodes = staged(with_pivots(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))), "nodes")
    roots = components(links(nodes, max_bits))
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("component_fp"))
    smallest = named.groupBy("component_fp").agg(F.min("first_id").alias("component_id"))
    classes = named.join(smallest, "component_fp").select("fp", "component_fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_fp", "component_id")


def deduplicate(documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each class, all its columns: the one with the smallest id.

    Equal ids within a class: the row with the smallest fingerprint, then the one whose text
    sorts first; a class without ids keeps one row. Ids that occur once need no fingerprint to
    be found again, so texts are fingerprinted once and shuffled once, by id.
    """
    prints = staged(_prints(documents, shingle), "fingerprints")
    own = _classes(prints, max_bits).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keep = own.groupBy("component_fp").agg(F.min("fp").alias("keep_fp"), F.first("component_id").alias("keep_id"))
    keep = staged(keep.select("keep_fp", "keep_id"), "kept")
    repeated = staged(prints.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("again")), "repeated")
    is_repeated = F.col("keep_id").eqNullSafe(F.col("again"))
    once = documents.join(keep.join(repeated, is_repeated, "left_anti"), F.col("doc_id").eqNullSafe(F.col("keep_id")), "left_semi")
    if repeated.isEmpty():
        return once
    several = documents.join(repeated, F.col("doc_id").eqNullSafe(F.col("again")), "left_semi")
    rows = several.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row"))
    rows = staged(rows.withColumn("fp", fingerprint_column("row.text", shingle)), "several")
    kept = rows.join(keep, (F.col("fp") == F.col("keep_fp")) & F.col("row.doc_id").eqNullSafe(F.col("keep_id")), "left_semi")
    first = F.min_by("row", F.coalesce("row.text", F.lit("")))
    return once.unionAll(kept.groupBy("fp", "row.doc_id").agg(first.alias("kept_row")).select("kept_row.*"))
