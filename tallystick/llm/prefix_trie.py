"""Prefix trie of conversations: sorted sequences, LCPs, sparse-table range minima.

A turn is known by 128 bits of the SHA-256 of its role and text, a conversation by the row of
its turns' digests. Rows are range-partitioned and sorted; within a block of bounded size the
lengths of the common prefixes of neighbours (LCPs) go into a sparse table of range minima. A
node is a candidate (row, depth) at the row where its prefix comes up first; each candidate
searches its left and right ends by bisection over the table, independently of all others and
without a stack. What a node's subtree adds up to is a stretch of the candidates in preorder.

Nodes on the first or last row of a block may go on in the next block. Those rows, with what
the block knows of each of their prefixes, are the rows of a next, much smaller level; the
last level is one block. So no task holds more than a block, whatever prefix all rows share.

* Equal conversations are folded into one row first, by a grouped count.
* Positions of turns come from a range-partitioned sort, not from a window over a conversation.
* Turns are packed in segments of ``SEGMENT``. Only as many segments of a conversation are
  sorted as it shares with a different one, plus one; the nodes after these form a chain
  without branches, stated in closed form. A conversation is thus never one row, unless a
  different one shares all of it. There is one round per segment that different ones share.
* The ids of members that end at a node are packed into texts where they lie sorted, and each
  node's texts are hashed as a stream.

Cases: turns of equal number are ordered by their digest; NULL turns come first, NULL roles and
texts are empty; rows with a NULL conv_id belong to no conversation; repeated rows are turns of
their own; an empty table gives no node. Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystick.operators.ordering import global_rank
from tallystick.sources.workspace import staged

SEGMENT = 256  # turns
BLOCK_ROWS, BLOCK_TURNS = 4096, 1 << 18
LEAST_ROWS = 8  # of a block: it hands on two, so every level is smaller than the one before
DIGEST = 16  # bytes
CHUNK_IDS = 1 << 14

ROW = (
    "seq binary, bytes array<long>, n array<long>, least array<long>, children array<long>, "
    "leaves array<long>, saved array<long>, ends array<string>"
)
NODE = (
    "key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 1, digest, bytes) of every turn, from one global sort."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.substring(F.sha2(named, 256), 1, 2 * DIGEST)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("digest").asc()]
    ranked = staged(global_rank(turns, order, "_rank", "_size"), "turns")
    starts = ranked.groupBy("conv_id").agg(F.min("_rank").alias("_start"), F.count("*").alias("turns"))
    return ranked.join(starts, "conv_id").select("conv_id", (F.col("_rank") - F.col("_start") + 1).alias("place"), "digest", "bytes", "turns")


def rebuilt(turns: DataFrame, shared: Column, base: Column) -> DataFrame:
    """(conv_id, depth, digest, bytes) of every conversation made anew: the first ``shared`` turns
    of conversation ``base``, all if it has fewer, then its own after its first ``shared``.
    Both columns are functions of conv_id."""
    turns = staged(turns, "placed")
    conversations = turns.groupBy("conv_id").agg(F.max("turns").alias("own")).select("conv_id", "own", shared.alias("h"), base.alias("base"))
    known = conversations.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    conversations = staged(
        conversations.join(known, "base", "left").withColumn("kept", F.least("h", F.coalesce("there", F.lit(0)))), "conversations"
    )
    borrowed = conversations.where("kept > 0").select("conv_id", "base", F.explode(F.sequence(F.lit(1).cast("long"), "kept")).alias("depth"))
    furthest = conversations.agg(F.max("kept")).first()[0] or 0
    heads = turns.where(F.col("place") <= furthest).select(F.col("conv_id").alias("base"), F.col("place").alias("depth"), "digest", "bytes")
    heads = borrowed.join(heads, ["base", "depth"]).select("conv_id", "depth", "digest", "bytes")
    tails = turns.join(conversations.select("conv_id", "h", "kept"), "conv_id").where("place > h")
    return heads.unionByName(tails.select("conv_id", (F.col("place") - F.col("h") + F.col("kept")).alias("depth"), "digest", "bytes"))


def trie(sequences: DataFrame, members: DataFrame, segment: int = SEGMENT, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per node of the trie of ``sequences`` (conv_id, depth from 1, digest, bytes).

    ``members`` holds every conv_id once; those without a sequence end at the root.
    """
    if segment < 1 or block_rows < LEAST_ROWS:
        raise ValueError(f"segment must be at least 1, block_rows at least {LEAST_ROWS}")
    folded, segments = _folded(sequences, members, segment)
    paths, chains = _split(folded, segments, segment)
    return _levels(paths, block_rows).unionByName(chains)


def _folded(sequences: DataFrame, members: DataFrame, segment: int) -> tuple[DataFrame, DataFrame]:
    """Different sequences: (u, n, least, ends, depth, bytes), and their segments
    (u, part, seq, bytes, through), where u identifies a sequence by its segments' hashes."""
    part = F.floor((F.col("depth") - 1) / segment).cast("int")
    packed = sequences.groupBy("conv_id", part.alias("part")).agg(F.sort_array(F.collect_list(F.struct("depth", "digest", "bytes"))).alias("t"))
    digests = F.aggregate("t.digest", F.lit("").cast("binary"), lambda whole, d: F.concat(whole, d))
    packed = staged(packed.select("conv_id", "part", digests.alias("seq"), F.col("t.bytes").alias("bytes")), "segments")
    hashes = packed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("part", F.unhex(F.sha2("seq", 256)).alias("hash")))).alias("h"),
        F.sum(F.length("seq") / DIGEST).cast("long").alias("depth"),
        F.sum(F.aggregate("bytes", F.lit(0).cast("long"), lambda a, b: a + b)).alias("bytes"),
    )
    u = F.sha2(F.aggregate("h.hash", F.lit("").cast("binary"), lambda whole, d: F.concat(whole, d)), 256)
    none = {"depth": 0, "bytes": 0}
    named = members.join(hashes.select("conv_id", u.alias("u"), "depth", "bytes"), "conv_id", "left").fillna(none).fillna(NO_ENDS, ["u"])
    named = staged(named, "named")
    counts = named.groupBy("u").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.max("depth").alias("depth"), F.max("bytes").alias("bytes"))
    folded = staged(counts.join(_listed(named.select("u", "conv_id")), "u"), "folded")
    kept = packed.join(folded.select(F.col("least").alias("conv_id"), "u"), "conv_id").drop("conv_id")
    return folded, staged(kept, "kept")


def _listed(members: DataFrame) -> DataFrame:
    """(u, ends): SHA-256 of each u's ids in ascending order, joined by commas.

    A range partition holds a stretch of the (u, conv_id) order and writes it as texts; a u
    that fills many partitions is thus one row per CHUNK_IDS ids when its texts meet.
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        u, ids = None, []

        def packed() -> pd.DataFrame:
            return pd.DataFrame({"u": [u], "first": [ids[0]], "ids": [",".join(map(str, ids))]})

        for batch in batches:
            for name, at in zip(batch["u"], batch["conv_id"].tolist(), strict=True):
                if ids and (name != u or len(ids) == CHUNK_IDS):
                    yield packed()
                    ids = []
                u = name
                ids.append(at)
        if ids:
            yield packed()

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        u, state = None, None
        for batch in batches:
            done = []
            for name, text in zip(batch["u"], batch["ids"], strict=True):
                if name == u:
                    state.update(b",")
                else:
                    if state:
                        done.append((u, state.hexdigest()))
                    u, state = name, hashlib.sha256()
                state.update(text.encode())
            yield pd.DataFrame(done, columns=["u", "ends"], dtype=object)
        if state:
            yield pd.DataFrame({"u": [u], "ends": [state.hexdigest()]})

    ordered = members.repartitionByRange("u", "conv_id").sortWithinPartitions("u", "conv_id")
    texts = ordered.mapInPandas(pack, "u string, first long, ids string")
    return texts.repartition("u").sortWithinPartitions("u", "first").mapInPandas(hashed, "u string, ends string")


def _split(folded: DataFrame, segments: DataFrame, segment: int) -> tuple[DataFrame, DataFrame]:
    """ROWs for the sort, and the finished nodes of the chains below them.

    A round compares the segments at one place of all sequences that agree in all before it.
    """
    empty = F.lit("").cast("binary")
    state = folded.select("u", F.sha2(empty, 256).alias("key"), F.lit(0).alias("parts"))
    part, open_ = 0, state
    done: DataFrame | None = None
    while open_ is not None:
        nexts = segments.where(F.col("part") == part).select("u", F.col("seq").alias("_seq"))
        joined = open_.join(nexts, "u", "left")
        going = joined.where(F.col("_seq").isNotNull())
        going = staged(going.select("u", F.sha2(F.concat(F.unhex("key"), "_seq"), 256).alias("key"), F.lit(part + 1).alias("parts")), "round")
        shared = going.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1").select("key")
        ended = joined.where(F.col("_seq").isNull()).select("u", "parts")
        shared_rows = going.join(shared, "key", "left_semi")
        alone = going.join(shared, "key", "left_anti").select("u", "parts")
        finished = ended.unionByName(alone)
        done = staged(finished if done is None else done.unionByName(finished), "depths")
        open_ = staged(shared_rows, "open")
        part += 1
        if open_.isEmpty():
            open_ = None
    depths = folded.join(done, "u").withColumn("inside", F.least("depth", F.col("parts") * segment))
    placed = segments.join(depths.select("u", "n", "least", "parts", "depth", "ends"), "u")
    head = placed.where("part < parts").groupBy("u").agg(F.sort_array(F.collect_list(F.struct("part", "seq", "bytes"))).alias("p"))
    joined = depths.join(head, "u", "left").withColumn("p", F.coalesce("p", F.array().cast(head.schema["p"].dataType)))
    seq = F.aggregate("p.seq", empty, lambda whole, s: F.concat(whole, s))
    inner = F.concat(F.array(F.lit(0).cast("long")), F.flatten("p.bytes"))
    below = F.col("depth") > F.col("inside")
    tail = F.col("bytes") - F.aggregate(inner, F.lit(0).cast("long"), lambda a, b: a + b)
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def at_end(value: Column) -> Column:
        return F.concat(F.array_repeat(zero, F.col("inside").cast("int")), F.array(value))

    rows = joined.select(
        seq.alias("seq"),
        inner.alias("bytes"),
        F.array_repeat("n", F.col("inside").cast("int") + 1).alias("n"),
        F.array_repeat("least", F.col("inside").cast("int") + 1).alias("least"),
        at_end(F.when(below, one).otherwise(zero)).alias("children"),
        at_end(F.when(below, one).otherwise(zero)).alias("leaves"),
        at_end(F.when(below, (F.col("n") - 1) * tail).otherwise(zero)).alias("saved"),
        F.concat(F.array_repeat(F.lit(None).cast("string"), F.col("inside").cast("int")), F.array(F.when(~below, F.col("ends")))).alias("ends"),
    )
    return staged(rows, "paths"), _chains(placed.where("part >= parts"), segment)


def _chains(placed: DataFrame, segment: int) -> DataFrame:
    """Nodes that one sequence alone passes: sums of bytes from the end, segment by segment."""
    after = Window.partitionBy("u").orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    total = F.aggregate("bytes", F.lit(0).cast("long"), lambda a, b: a + b)
    summed = placed.withColumn("later", F.coalesce(F.sum(total).over(after), F.lit(0)))
    turn = F.posexplode("bytes").alias("i", "b")
    upto = F.aggregate(F.slice("bytes", F.lit(1), F.col("i")), F.lit(0).cast("long"), lambda a, b: a + b)
    nodes = summed.withColumn("total", total).select("*", turn).withColumn("depth_", F.col("part") * segment + F.col("i") + 1)
    last = F.col("depth_") == F.col("depth")
    return nodes.select(
        F.col("least").alias("conv_id"),
        F.col("depth_").cast("long").alias("depth"),
        F.col("least").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("n") - 1) * (F.col("later") + F.col("total") - upto)).alias("saved_tokens"),
        F.when(last, F.col("ends")).otherwise(NO_ENDS).alias("ends_sha256"),
    )


def _levels(rows: DataFrame, block_rows: int) -> DataFrame:
    """Blocks of sorted rows, level by level, until one block holds them all."""
    names = [[c.split()[0] for c in schema.split(", ")] for schema in (NODE, ROW)]
    out: DataFrame | None = None
    level = 0
    while True:
        count = rows.count()
        last = count <= block_rows
        dealt = rows.coalesce(1) if last else rows.repartitionByRange(-(-count // block_rows), "seq")
        made = staged(dealt.sortWithinPartitions("seq").mapInPandas(_blocks(level, last, block_rows), f"{NODE}, {ROW}"), "level")
        nodes = made.where("conv_id is not null").select(*names[0])
        out = nodes if out is None else staged(out.unionByName(nodes), "nodes")
        if last:
            break
        rows = made.where("conv_id is null").select(*names[1])
        level += 1
    known = out.where("parent_key is null").drop("parent_key", "key")
    parents = out.where("key is not null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    asked = out.where("parent_key is not null").drop("parent_conv_id", "key").join(parents, "parent_key")
    return known.unionByName(asked.withColumnRenamed("_parent", "parent_conv_id").select(*known.columns))


def _blocks(level: int, last: bool, block_rows: int):
    """Cuts a partition's sorted rows into blocks; the last level is one block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        turns = 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                held.append(row)
                turns += len(row.n)
                if not last and (len(held) >= block_rows or turns >= BLOCK_TURNS and len(held) >= LEAST_ROWS):
                    yield from Block(held).frames(level, last)
                    held, turns = [], 0
        if held:
            yield from Block(held).frames(level, last)

    return run


class Block:
    """The nodes of a stretch of sorted rows, no two of them equal.

    Every row has a value per depth, from 0 to its length: its share in what the nodes along
    it add up to. Elements are all (row, depth), candidates those where the prefix is new.
    """

    def __init__(self, rows: list):
        self.seqs = [np.frombuffer(bytes(r.seq), dtype=f"V{DIGEST}") for r in rows]
        self.raw = [bytes(r.seq) for r in rows]
        self.length = np.array([len(s) for s in self.seqs], dtype=np.int64)
        shared = [_common(x, y) for x, y in zip(self.seqs, self.seqs[1:])]
        self._search(np.array(shared, dtype=np.int64))
        self._add_up(rows)

    def _search(self, lcp: np.ndarray) -> None:
        """Candidates, and the ends of each one's rows, by bisection over range minima."""
        count = len(self.length)
        new = np.concatenate([[0], lcp + 1])
        each = self.length - new + 1
        self.start = np.concatenate([[0], np.cumsum(each)])
        self.row = np.repeat(np.arange(count), each)
        self.depth = np.arange(self.start[-1]) - self.start[self.row] + new[self.row]
        table = [lcp]
        while 2 << len(table) - 1 < count:
            half = 1 << len(table) - 1
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        self.left, self.right = self.row.copy(), self.row.copy()
        for power in reversed(range(len(table))):
            step, minima = 1 << power, table[power]
            if not len(minima):
                continue
            at = self.right
            fits = (at + step < count) & (minima[np.minimum(at, len(minima) - 1)] >= self.depth)
            self.right = at + step * fits
            at = self.left - step
            fits = (at >= 0) & (minima[np.clip(at, 0, len(minima) - 1)] >= self.depth)
            self.left = self.left - step * fits

    def _add_up(self, rows: list) -> None:
        flat = lambda name: np.concatenate([np.asarray(getattr(r, name), dtype=np.int64) for r in rows])
        at = np.concatenate([[0], np.cumsum(self.length + 1)])
        row = np.repeat(np.arange(len(rows)), self.length + 1)
        depth = np.arange(at[-1]) - at[row]
        order = np.lexsort((row, depth))  # a node's elements are one stretch of this order
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        first, end = place[at[self.left] + self.depth], place[at[self.right] + self.depth] + 1

        def total(name: str) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(flat(name)[order])])
            return sums[end] - sums[first]

        by_place = np.argsort(first)
        self.least = np.empty(len(first), dtype=np.int64)
        self.least[by_place] = np.minimum.reduceat(flat("least")[order], first[by_place])
        node = np.empty(len(order), dtype=np.int64)  # of every element
        node[order] = np.repeat(by_place, (end - first)[by_place])
        self.node, self.at = node, at
        self.count, self.bytes = total("n"), flat("bytes")[at[self.row] + self.depth]
        self.children, self.leaves, self.saved = total("children"), total("leaves"), total("saved")
        self.ends = np.full(len(first), None, dtype=object)
        ends = np.concatenate([np.asarray(r.ends, dtype=object) for r in rows])
        ending = np.flatnonzero([e is not None for e in ends])
        self.ends[node[ending]] = ends[ending]
        self.parent = np.where(self.depth > 0, node[at[self.row] + np.maximum(self.depth - 1, 0)], -1)

    def frames(self, level: int, last: bool) -> Iterator[pd.DataFrame]:
        """Finished nodes; unless this is the last level, the outer rows with their shares."""
        outer = np.zeros(len(self.row), dtype=bool) if last else (self.left == 0) | (self.right == len(self.length) - 1)
        inner = ~outer
        has = (self.parent >= 0) & inner
        children = self.children + np.bincount(self.parent[has], minlength=len(self.row))
        own_leaves = self.leaves + (inner & (children == 0))
        own_saved = self.saved + inner * (self.count - 1) * self.bytes
        stop = self.start[self.right + 1]  # a subtree is a stretch of candidates

        def below(own: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(own)])
            return sums[stop] - sums[np.arange(len(own))]

        leaves, saved = below(own_leaves), below(own_saved)
        yield self._nodes(np.flatnonzero(inner), outer, level, children, leaves, saved)
        if last:
            return
        top = has & outer[np.maximum(self.parent, 0)]  # inner nodes right below an outer one

        def shared(own: np.ndarray, subtree: np.ndarray) -> np.ndarray:
            share = own.copy()
            np.add.at(share, self.parent[top], subtree[top])
            return share

        values = {"n": self.count, "children": children, "leaves": shared(self.leaves, leaves), "saved": shared(self.saved, saved)}
        yield self._rows(values)

    def _key(self, row: int, depth: int) -> bytes:
        return hashlib.sha256(self.raw[row][: depth * DIGEST]).digest()[:DIGEST]

    def _nodes(self, which, outer, level, children, leaves, saved) -> pd.DataFrame:
        parent = self.parent[which]
        asks = (parent >= 0) & outer[np.maximum(parent, 0)]
        frame = pd.DataFrame(
            {
                "conv_id": self.least[which],
                "depth": self.depth[which],
                "n_convs": self.count[which],
                "n_children": children[which],
                "n_leaves": leaves[which],
                "saved_tokens": saved[which],
                "ends_sha256": [e or NO_ENDS for e in self.ends[which]],
            }
        ).astype(object)
        known = (parent >= 0) & ~asks
        frame["parent_conv_id"] = [int(self.least[p]) if k else None for p, k in zip(parent, known)]
        rows, depths = self.row[which].tolist(), self.depth[which].tolist()
        frame["parent_key"] = [self._key(r, d - 1) if a else None for r, d, a in zip(rows, depths, asks)]
        frame["key"] = [self._key(r, d) for r, d in zip(rows, depths)] if level else None
        return _filled(frame)

    def _rows(self, values: dict[str, np.ndarray]) -> pd.DataFrame:
        count = len(self.length)
        made = []
        for row in (0,) if count == 1 else (0, count - 1):
            nodes = self.node[self.at[row] : self.at[row + 1]]
            mine = np.ones(len(nodes), dtype=bool) if row == 0 else self.left[nodes] > 0
            made.append(
                {
                    "seq": self.raw[row],
                    "bytes": self.bytes[nodes].tolist(),
                    "least": self.least[nodes].tolist(),
                    "ends": [e if m else None for e, m in zip(self.ends[nodes], mine)],
                    **{name: (share[nodes] * mine).tolist() for name, share in values.items()},
                }
            )
        return _filled(pd.DataFrame(made, dtype=object))


def _filled(frame: pd.DataFrame) -> pd.DataFrame:
    """All output columns, those without a value as NULL."""
    names = [c.split()[0] for c in f"{NODE}, {ROW}".split(", ")]
    return pd.DataFrame({name: frame[name] if name in frame else pd.Series([None] * len(frame), dtype=object) for name in names})


def _common(x: np.ndarray, y: np.ndarray) -> int:
    size = min(len(x), len(y))
    different = np.flatnonzero(x[:size] != y[:size])
    return int(different[0]) if len(different) else size
