"""Substring dedup by prefix-partitioned suffix trees over words.

A window is ``WINDOW`` consecutive words of one document, that is a suffix cut to that depth.
A window that starts anywhere else as well is repeated, and every word it covers is removed;
windows are judged on the input. In the suffix tree of all documents the repeated windows are
the leaves below internal nodes of depth ``WINDOW`` or more, the maximal repeats.

The suffixes are split by prefixes of variable length into groups that fit a task's memory, and
each group's tree is built by itself. The prefixes are sparse: of every window the ``PREFIX``
words with the least hash are its anchor. Neighbouring windows mostly share their anchor, and
equal windows have equal anchors, so one run of windows travels as one stretch of text instead
of many suffixes.

1. Anchors are counted. A prefix that occurs once is a leaf of its own and is dropped.
2. Prefixes of up to ``SPLIT`` occurrences send their stretches to a group. The group numbers
   its words, sorts all suffixes of its stretches by prefix trebling (the leaves of its tree),
   and takes the common-prefix lengths of neighbours from the same ranks. Neighbours with
   ``WINDOW`` or more words in common lie below one deep internal node.
3. A prefix that occurs more often is lengthened: its stretches, each batch's equal ones once
   with their count, are the texts of another round with anchors of twice the words, and so on.
   Prefixes still too frequent at nearly the whole depth become whole windows, one leaf list
   each, of which only the number matters: Spark sums it, grouped by the window's words.
4. The answers return to the documents, which drop the covered words.

Hashes only deal windows to groups; words decide everywhere whether windows are equal.

Documents are dealt by a hash of id and text into batches of about ``BATCH_BYTES``, groups hold
about ``GROUP_BYTES`` of text; both numbers follow from the input's size. A batch sends a prefix,
stretch or window once with its count, however often it holds it, so that copies and common
passages do not pile up in a group. Rows that occur more than ``COPIES`` times with equal id and
text would all land in one batch; two of them stand in for the rest, each being the other's
repeat, and the answer is given as often as the row occurs. All answers go back by batch, never by way of the driver.

Cases: a NULL or blank text has no words and stays as an empty text; texts of fewer words than
a window are kept whole, copies included; repeated rows are each other's repeats; NULL ids are
ordinary; an empty table gives no rows; a batch of 2^28 words or more, which takes a single text
of that length, is an error. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystick.sources.workspace import staged

WINDOW = 35
PREFIX = 8
SPLIT = 2000
COPIES = 100
BATCH_BYTES = 2 << 20
GROUP_BYTES = 4 << 20
_PLACE_BITS = np.uint64(28)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[32, *range(9, 14)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, size: int) -> np.ndarray:
    factors = np.full(size, base, np.uint64)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


class Batch:
    """The words of some documents, and the runs of windows that share an anchor."""

    def __init__(self, texts: list[str | bytes | None], window: int, prefix: int):
        self.window = window
        parts = [t if isinstance(t, bytes) else (t or "").encode() for t in texts]
        self.data = b"\n".join([*parts, b""])
        units = np.frombuffer(self.data, np.uint8)
        inside = ~_SEPARATOR[units]
        edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
        self.starts, self.stops = edges[::2], edges[1::2]
        bounds = np.cumsum([0, *(len(p) + 1 for p in parts)])
        self.bounds = np.searchsorted(self.starts, bounds)
        count = len(self.starts)
        if count >> int(_PLACE_BITS):
            raise ValueError(f"a batch of {count} words: texts must be shorter than 2^{_PLACE_BITS} words")
        document = np.repeat(np.arange(len(texts)), np.diff(self.bounds))
        sums = np.concatenate(([np.uint64(0)], np.cumsum((units.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(units)), dtype=np.uint64)))
        words = _mix((sums[self.stops] - sums[self.starts]) * _powers(_INVERSE, len(units) + 1)[self.starts])
        none = np.zeros(0, np.int64)
        self.first, self.last, self.text, self.hashes = none, none, none, none.astype(np.uint64)
        self.valid = none
        if count < window:
            return
        grams = np.zeros(count - prefix + 1, np.uint64)
        for i in range(prefix):
            grams = grams * _BASE + words[i : i + len(grams)]
        grams = _mix(grams)
        least = (grams >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
        width, spread = 1, window - prefix + 1
        while width < spread:
            step = min(width, spread - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        valid = np.flatnonzero(document[: count - window + 1] == document[window - 1 :])
        if not len(valid):
            return
        anchor = (least[valid] & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
        new = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(valid, prepend=-2) != 1))
        self.first = valid[new]
        self.last = valid[np.append(new[1:], len(valid)) - 1]
        self.text = document[self.first]
        self.hashes = grams[anchor[new]]
        self.valid = valid

    def stretch(self, first: int, last: int) -> bytes:
        """The words from the first window's start to the last one's end."""
        return b" ".join(self.data[self.starts[first] : self.stops[last + self.window - 1]].split())


def _ordered(rows: pd.DataFrame) -> tuple[list, list]:
    """Ids with times and texts of a batch in an order that does not depend on how they arrived."""
    whole = zip(rows["doc_id"], rows["text"], rows["times"], strict=True)
    whole = sorted(whole, key=lambda x: (x[0] is not None, x[0] or "", x[1] is not None, x[1] or "", x[2]))
    return [(i, n) for i, _, n in whole], [t for _, t, _ in whole]


def _folded(rows: DataFrame, copies: int) -> DataFrame:
    """(doc_id, text) -> also times; of rows that occur more than ``copies`` times two are left."""
    key = F.xxhash64("doc_id", "text")
    many = staged(rows.groupBy(key.alias("many")).agg(F.count("*").alias("n")).where(F.col("n") > copies).select("many"), "copies")
    if many.isEmpty():
        return rows.withColumn("times", F.lit(1).cast("long"))
    single = rows.join(many, key == F.col("many"), "left_anti").withColumn("times", F.lit(1).cast("long"))
    counted = rows.join(many, key == F.col("many"), "left_semi").groupBy("doc_id", "text").agg(F.count("*").alias("n"))
    one = F.lit(1).cast("long")
    times = F.when(F.col("n") > 1, F.array(one, F.col("n") - 1)).otherwise(F.array(one))
    return single.unionByName(counted.select("doc_id", "text", F.explode(times).alias("times")))


def _grouped(groups: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(group, places) for each group, places ascending."""
    order = np.argsort(groups, kind="stable")
    cuts = np.flatnonzero(np.diff(groups[order], prepend=-2))
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=False):
        yield int(groups[order[a]]), order[a:b]


_ASKED = "batch long, group long, what binary, counts binary"
_ANSWERED = "batch long, group long, answer binary"


class Level:
    """One prefix length: from texts dealt to batches to the windows that are repeated.

    ``source`` has a batch's texts either as documents or as the stretches that the level above
    handed on; ``load`` turns the rows of a batch into its texts and their weights.
    """

    def __init__(self, source: DataFrame, load: Callable, window: int, prefixes: list[int], split: int, groups: int):
        self.source, self.load = source, load
        self.window, self.prefix, self.deeper = window, prefixes[0], prefixes[1:]
        self.split, self.groups = split, groups

    def batch_of(self) -> Callable:
        """Rows -> (batch, weight of each run, its distinct anchors, the number of each run's anchor)."""
        load, window, prefix = self.load, self.window, self.prefix

        def read(rows: pd.DataFrame) -> tuple[Batch, np.ndarray, np.ndarray, np.ndarray]:
            texts, weights = load(rows)
            batch = Batch(texts, window, prefix)
            return batch, weights[batch.text], *np.unique(batch.hashes, return_inverse=True)

        return read

    def answers(self) -> DataFrame:
        """(batch, step, group, answer): all that ``found`` needs to tell the repeated windows."""
        read, groups, split, window = self.batch_of(), np.uint64(self.groups), self.split, self.window

        def ask_counts(rows: pd.DataFrame) -> pd.DataFrame:
            _, weights, anchors, which = read(rows)
            counts = np.minimum(np.bincount(which, weights, len(anchors)), np.iinfo(np.int32).max).astype("<i4")
            out = [(g, anchors[at].astype("<u8").tobytes(), counts[at].tobytes()) for g, at in _grouped((anchors % groups).astype(np.int64))]
            return _frame(rows["batch"].iloc[0], out)

        def count(rows: pd.DataFrame) -> pd.DataFrame:
            """0 for an anchor that occurs once, 1 for a shared one, 2 for one that is lengthened."""
            keys = [np.frombuffer(x, "<u8") for x in rows["what"]]
            values, which = np.unique(np.concatenate(keys), return_inverse=True)
            totals = np.bincount(which, np.concatenate([np.frombuffer(x, "<i4") for x in rows["counts"]]), len(values))
            answers = _answers(rows, keys, (1 * (totals > 1) + (totals > split)).astype(np.uint8)[which])
            return answers.assign(long=[2 in answer for answer in answers["answer"]])

        def ask_windows(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
            if not len(rows):
                return _frame(0, [])
            batch, weights, anchors, which = read(rows)
            state, out = _states(anchors, which, answers, groups), []
            for kind in (1, 2):
                runs, stretches, own = _requests(batch, state, kind)
                counts = np.minimum(np.bincount(own, weights[runs], len(stretches)), 2).astype("<i4")
                # Those of longer prefixes stay with their batch, the others go to their prefix's group.
                goes = np.full(len(stretches), -1)
                if kind == 1:
                    goes[own] = (batch.hashes[runs] % groups).astype(np.int64)
                out += [(g, b"\n".join([stretches[i] for i in at]), counts[at].tobytes()) for g, at in _grouped(goes)]
            return _frame(rows["batch"].iloc[0], out)

        def judge(rows: pd.DataFrame) -> pd.DataFrame:
            """1 for each window, in the order of the request, that occurs more than once."""
            repeated, windows = _subtree([x.split(b"\n") for x in rows["what"]], [np.frombuffer(x, "<i4") for x in rows["counts"]], window)
            return _answers(rows, windows, repeated)

        by_batch = self.source.groupBy("batch")
        counted = by_batch.applyInPandas(ask_counts, _ASKED).groupBy("group").applyInPandas(count, _ANSWERED + ", long boolean")
        counted = staged(counted, "prefixes")
        asked = by_batch.cogroup(counted.groupBy("batch")).applyInPandas(ask_windows, _ASKED)
        lengthen = not counted.where("long").isEmpty()
        if lengthen:  # read twice, so that no text is cut into words twice for it
            asked = staged(asked, "requests")
        judged = asked.where("group >= 0").groupBy("group").applyInPandas(judge, _ANSWERED)
        steps = [counted.drop("long"), judged]
        if lengthen:
            steps.append(self.lengthened(staged(asked.where("group < 0"), "stretches")))
        return reduce(DataFrame.unionByName, [x.withColumn("step", F.lit(n)) for n, x in enumerate(steps, 1)])

    def lengthened(self, stretches: DataFrame) -> DataFrame:
        """Flags of all windows of a batch's stretches, in order, judged by longer prefixes."""
        if not self.deeper:
            return _whole_windows(stretches, self.window)
        level = Level(stretches, _stretches, self.window, self.deeper, self.split, self.groups)
        read, found = level.batch_of(), level.found()

        def flags(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(rows):
                batch, _, anchors, which = read(rows)
                held = np.zeros(len(batch.starts), np.uint8)
                held[found(batch, anchors, which, answers)] = 1
                out.append((rows["batch"].iloc[0], 0, held[batch.valid].tobytes()))
            return pd.DataFrame(out, columns=["batch", "group", "answer"])

        return stretches.groupBy("batch").cogroup(level.answers().groupBy("batch")).applyInPandas(flags, _ANSWERED)

    def found(self) -> Callable:
        """(batch, anchors, which, answers) -> places of the repeated windows."""
        groups = np.uint64(self.groups)

        def places(batch: Batch, anchors: np.ndarray, which: np.ndarray, answers: pd.DataFrame) -> np.ndarray:
            state = _states(anchors, which, answers[answers["step"] == 1], groups)
            out = [np.zeros(0, np.int64)]
            for kind, step in ((1, 2), (2, 3)):
                given = answers[answers["step"] == step]
                given = dict(zip(given["group"], given["answer"], strict=True))
                runs, stretches, own = _requests(batch, state, kind)
                goes = np.zeros(len(stretches), np.int64)
                if kind == 1:
                    goes[own] = (batch.hashes[runs] % groups).astype(np.int64)
                size = np.zeros(len(stretches), np.int64)
                size[own] = batch.last[runs] - batch.first[runs] + 1
                flags: list[np.ndarray] = [np.zeros(0, np.uint8)] * len(stretches)
                for g, at in _grouped(goes):
                    for i, part in zip(at, np.split(np.frombuffer(given[g], np.uint8), np.cumsum(size[at])[:-1]), strict=True):
                        flags[i] = part
                out += [a + np.flatnonzero(flags[i]) for i, a in zip(own.tolist(), batch.first[runs].tolist(), strict=True)]
            return np.concatenate(out)

        return places


def _documents(rows: pd.DataFrame) -> tuple[list, np.ndarray]:
    texts = _ordered(rows)[1]
    return texts, np.ones(len(texts))


def _stretches(rows: pd.DataFrame) -> tuple[list, np.ndarray]:
    """A batch's stretches are one row."""
    return rows["what"].iloc[0].split(b"\n"), np.frombuffer(rows["counts"].iloc[0], "<i4").astype(float)


def _states(anchors: np.ndarray, which: np.ndarray, answers: pd.DataFrame, groups: np.uint64) -> np.ndarray:
    """The count's answer for each run."""
    state = np.zeros(len(anchors), np.uint8)
    given = dict(zip(answers["group"], answers["answer"], strict=True))
    for g, at in _grouped((anchors % groups).astype(np.int64)):
        state[at] = np.frombuffer(given[g], np.uint8)
    return state[which]


def _requests(batch: Batch, state: np.ndarray, kind: int) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Runs of one state, their distinct stretches, the number of each run's stretch."""
    runs, numbers = np.flatnonzero(state == kind), {}
    ends = zip(batch.first[runs].tolist(), batch.last[runs].tolist(), strict=True)
    own = [numbers.setdefault(batch.stretch(a, b), len(numbers)) for a, b in ends]
    return runs, list(numbers), np.array(own, np.int64)


def _windows(stretches: bytes, window: int) -> Iterator[bytes]:
    for stretch in stretches.split(b"\n"):
        words = stretch.split(b" ")
        for at in range(len(words) - window + 1):
            yield b" ".join(words[at : at + window])


def _whole_windows(stretches: DataFrame, window: int) -> DataFrame:
    """Flags of all windows of a batch's stretches; equal words meet in one sum, combined before the shuffle."""

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for batch, what, counts in zip(rows["batch"], rows["what"], rows["counts"], strict=True):
                times: dict[bytes, int] = {}
                for stretch, n in zip(what.split(b"\n"), np.frombuffer(counts, "<i4").tolist(), strict=True):
                    for words in _windows(stretch, window):
                        times[words] = min(times.get(words, 0) + n, 2)
                yield pd.DataFrame({"batch": batch, "number": range(len(times)), "words": list(times), "times": list(times.values())})

    def flags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for what, numbers in zip(rows["what"], rows["numbers"], strict=True):
                repeated, order = set(() if numbers is None else numbers), {}
                own = (order.setdefault(words, len(order)) for words in _windows(what, window))
                out.append(bytes(number in repeated for number in own))
            yield pd.DataFrame({"batch": rows["batch"], "group": 0, "answer": out})

    each = staged(stretches.mapInPandas(listed, "batch long, number long, words binary, times long"), "windows")
    often = each.groupBy("words").agg(F.sum("times").alias("n")).where("n > 1").select("words")
    repeated = each.join(often, "words", "left_semi").groupBy("batch").agg(F.collect_list("number").alias("numbers"))
    return stretches.select("batch", "what").join(repeated, "batch", "left").mapInPandas(flags, _ANSWERED)


def prefixes(first: int, window: int) -> list[int]:
    """Prefix lengths that are tried one after the other, each twice the one before."""
    out = [min(first, window)]
    while out[-1] * 2 < window:
        out.append(out[-1] * 2)
    return out


def remove_repeats(
    documents: DataFrame,
    window: int = WINDOW,
    prefix: int = PREFIX,
    split: int = SPLIT,
    batch_bytes: int = BATCH_BYTES,
    group_bytes: int = GROUP_BYTES,
    copies: int = COPIES,
) -> DataFrame:
    """(doc_id, text, ...) -> (doc_id, n_words, n_removed, kept): the words kept, joined by spaces."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    total = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    key = F.pmod(F.xxhash64("doc_id", "text"), F.lit(total // batch_bytes + 1))
    rows = _folded(documents.select("doc_id", "text"), copies)
    dealt = rows.select(key.alias("batch"), F.col("doc_id").cast("string").alias("doc_id"), "text", "times")
    level = Level(dealt, _documents, window, prefixes(prefix, window), split, total // group_bytes + 1)
    read, found = level.batch_of(), level.found()

    def apply(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"doc_id": [], "n_words": [], "n_removed": [], "kept": [], "times": []}, dtype=object)
        batch, _, anchors, which = read(rows)
        return _kept(batch, _ordered(rows)[0], found(batch, anchors, which, answers))

    kept = dealt.groupBy("batch").cogroup(level.answers().groupBy("batch"))
    kept = kept.applyInPandas(apply, "doc_id string, n_words long, n_removed long, kept string, times long")
    again = F.when(F.col("times") > 1, F.sequence(F.lit(1).cast("long"), F.col("times"))).otherwise(F.array(F.lit(1).cast("long")))
    kept = kept.withColumn("time", F.explode(again)).drop("time", "times")
    return kept.withColumn("doc_id", F.col("doc_id").cast(kind))


def _frame(batch: int, rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["group", "what", "counts"])
    frame.insert(0, "batch", batch)
    return frame


def _answers(rows: pd.DataFrame, asked: list, values: np.ndarray) -> pd.DataFrame:
    """Cuts the answers of a group back into those of each batch."""
    parts = np.split(values, np.cumsum([x if isinstance(x, int) else len(x) for x in asked])[:-1])
    return pd.DataFrame({"batch": rows["batch"].to_numpy(), "group": rows["group"].to_numpy(), "answer": [p.tobytes() for p in parts]})


def _subtree(stretches: list[list[bytes]], counts: list[np.ndarray], window: int) -> tuple[np.ndarray, list[int]]:
    """(1 for every window below a node of the window's depth, windows of each request).

    The tree is held as the sorted suffixes of all stretches and the common-prefix lengths of
    neighbours: a run of neighbours with ``window`` or more words in common is what hangs below
    one deep internal node. Leaves count as often as their stretch occurs in its batch.
    """
    flat = [s.split(b" ") for request in stretches for s in request]
    lengths = np.array([len(s) for s in flat])
    words = pd.factorize(np.array([w for s in flat for w in s], dtype=object))[0].astype(np.int64) + 1
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(words))
    ranks = _ranks(words, left, int(lengths.max()))
    leaves = np.flatnonzero(left >= window)
    order = np.argsort(ranks[-1][leaves], kind="stable")
    common = _common(ranks, left, leaves[order[:-1]], leaves[order[1:]])
    node = np.concatenate(([0], np.cumsum(common < window)))
    sizes = lengths - window + 1
    times = np.repeat(np.concatenate(counts), sizes)[order]
    repeated = np.zeros(len(leaves), np.uint8)
    repeated[order] = np.bincount(node, times)[node] > 1
    cuts = np.cumsum([0, *(len(request) for request in stretches)])
    return repeated, [int(sizes[a:b].sum()) for a, b in zip(cuts, cuts[1:], strict=False)]


def _ranks(words: np.ndarray, left: np.ndarray, longest: int) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 3, 9, ... words, the last ones by all of them.

    ``left`` is the number of words from each place to its stretch's end, where a suffix ends.
    """
    ranks, width = [words], 1
    while width < longest:
        joined, most = ranks[-1], int(ranks[-1].max()) + 1
        for part in (1, 2):
            if joined is not ranks[-1] and most >= 1 << 21:  # three ranks do not fit one number
                joined = np.unique(joined, return_inverse=True)[1] + 1
            joined = joined * most
            follows = np.flatnonzero(left > part * width)
            joined[follows] += ranks[-1][follows + part * width]
        ranks.append(np.unique(joined, return_inverse=True)[1] + 1)
        width *= 3
    return ranks


def _common(ranks: list[np.ndarray], left: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of first words that suffixes a and b share, added up from powers of three."""
    shared = np.zeros(len(a), np.int64)
    room = np.minimum(left[a], left[b])
    for power in range(len(ranks) - 1, -1, -1):
        for _ in range(2):
            open_ = np.flatnonzero(room - shared >= 3**power)
            same = ranks[power][a[open_] + shared[open_]] == ranks[power][b[open_] + shared[open_]]
            shared[open_[same]] += 3**power
    return shared


def _kept(batch: Batch, ids: list, found: np.ndarray) -> pd.DataFrame:
    """Drops the words that the found windows cover."""
    change = np.zeros(len(batch.starts) + 1, np.int64)
    np.add.at(change, found, 1)
    np.add.at(change, found + batch.window, -1)
    removed = np.cumsum(change[:-1]) > 0
    out = []
    for number, (doc_id, times) in enumerate(ids):
        a, b = int(batch.bounds[number]), int(batch.bounds[number + 1])
        gone = removed[a:b]
        words = batch.data[batch.starts[a] : batch.stops[b - 1]].split() if b > a else []
        if gone.any():
            words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
        out.append((doc_id, b - a, int(gone.sum()), b" ".join(words).decode(), times))
    return pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept", "times"])
