"""Benchmark decontamination by pigeonhole edit matching.

A test item occurs in a document if some stretch of the document is within the item's error
budget of edits. Texts are compared lower-cased, with each run of white space as one space.
An item of n characters has a budget of k = floor(n * ``ERROR_RATE``) edits and is cut into
k + 1 pieces. A stretch within k edits leaves at least one piece untouched, so finding every
exact occurrence of every piece (one Aho-Corasick pass over a document) finds every candidate.
Candidates are verified with Myers' bit-parallel edit distance around the piece's place.

Items are searched in blocks of at most ``BLOCK_CHARS`` characters: a block's automaton is of
bounded size and is what a task receives, and every document is searched against every block.
An item longer than a block is a block of its own. One block at a time reaches the driver, and
its matches are written before the next one is read, so neither the driver's memory nor the
plan grows with the benchmark. Every block reads the documents once.

Items shorter than ``MIN_CHARS`` after normalising are left out unless ``short`` is asked for,
because a few letters prove nothing; with ``short`` they match where they stand exactly and as
whole words.

Cases: a NULL text has no match, NULL and empty items never match; items with equal ids or
equal texts are matched each on its own; repeated documents give repeated rows; empty tables
give no rows. Only doc_id, text, item_id and text are read, so other columns may clash.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystick.sources.workspace import new_folder, staged

ERROR_RATE = 0.08
MIN_CHARS = 24
BLOCK_CHARS = 4_000_000


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(length: int, rate: float = ERROR_RATE) -> int:
    return int(length * rate)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece): errors + 1 pieces of nearly equal length that make up the item."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def best_end(item: str, stretch: str) -> tuple[int, int]:
    """Myers: (least distance of the item to any substring of the stretch, its end)."""
    size = len(item)
    masks: dict[str, int] = defaultdict(int)
    for at, char in enumerate(item):
        masks[char] |= 1 << at
    full, last = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score = full, 0, size
    best, end = size, 0
    for at, char in enumerate(stretch, 1):
        match = masks.get(char, 0)
        vertical = match | minus
        horizontal = (((match & plus) + plus) ^ plus) | match
        raised = (minus | ~(horizontal | plus)) & full
        lowered = plus & horizontal
        if raised & last:
            score += 1
        elif lowered & last:
            score -= 1
        raised = raised << 1 & full
        lowered = lowered << 1 & full
        plus = (lowered | ~(vertical | raised)) & full
        minus = raised & vertical
        if score < best:
            best, end = score, at
    return best, end


class Matcher:
    """The items of one block: finds all (item number, distance, start, end) in a text."""

    def __init__(self, items: list[str], rate: float = ERROR_RATE, min_chars: int = 0):
        self.items, self.min_chars = items, min_chars
        self.errors = [budget(len(t), rate) if len(t) >= min_chars else 0 for t in items]
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, (item, errors) in enumerate(zip(items, self.errors, strict=True)):
            for offset, piece in pieces(item, errors):
                places[piece].append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """The best match of each item; the first one of equals. Places are in ``text``."""
        starts: dict[int, list[int]] = defaultdict(list)
        if self.items:
            for end, (size, where) in self.automaton.iter(text):
                for number, offset in where:
                    starts[number].append(end + 1 - size - offset)
        found = []
        for number, wanted in starts.items():
            item, errors = self.items[number], self.errors[number]
            best = None
            for low, high in _merged(wanted, errors):
                first = max(0, low - errors)
                if len(item) < self.min_chars and not _whole_words(text, low, low + len(item)):
                    continue
                stretch = text[first : high + len(item) + errors]
                at = stretch.find(item)
                distance, end = (0, at + len(item)) if at >= 0 else best_end(item, stretch)
                if distance <= errors and (best is None or distance < best[0]):
                    begin = first + at if at >= 0 else first + end - _reach(item, stretch[:end])
                    best = (distance, begin, first + end)
                    if not distance:
                        break
            if best:
                found.append((number, *best))
        return found


def _whole_words(text: str, start: int, stop: int) -> bool:
    """Whether the stretch neither begins nor ends within a word."""
    return not any(0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum() for at in (start, stop))


def _merged(starts: list[int], slack: int) -> Iterator[tuple[int, int]]:
    """Ranges of assumed starts; those within the slack of one another are verified together."""
    starts = sorted(set(starts))
    low = high = starts[0]
    for at in starts[1:]:
        if at - high > slack:
            yield low, high
            low = at
        high = at
    yield low, high


def _reach(item: str, stretch: str) -> int:
    """Length of the best match that ends where the stretch ends."""
    return best_end(item[::-1], stretch[::-1])[1]


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    rate: float = ERROR_RATE,
    min_chars: int = MIN_CHARS,
    block_chars: int = BLOCK_CHARS,
    short: bool = False,
) -> DataFrame:
    """(doc_id, item_id, distance, start, stop): a row per document and item that occurs in it.

    start and stop are places in the normalised text of the best match.
    """
    kind = benchmark.schema["item_id"].dataType.simpleString()

    def matches(items: list[tuple]) -> DataFrame:
        found = _found([i for i, _ in items], [t for _, t in items], rate, min_chars, kind)
        return documents.select("doc_id", F.explode(found).alias("m")).select("doc_id", "m.item_id", "m.distance", "m.start", "m.stop")

    count, blocks = _blocks(benchmark, min_chars, block_chars, short)
    if count == 1:
        return matches(next(blocks))
    return _gathered(matches(items) for items in blocks)


def without_contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    rate: float = ERROR_RATE,
    min_chars: int = MIN_CHARS,
    block_chars: int = BLOCK_CHARS,
    short: bool = False,
) -> DataFrame:
    """The documents in which no item occurs, all columns unchanged.

    With several blocks the documents are written once with a row number, and the numbers of
    those that hold an item are gathered block by block.
    """
    count, blocks = _blocks(benchmark, min_chars, block_chars, short)
    if count == 1:
        return documents.where(_clean(F.col("text"), [t for _, t in next(blocks)], rate, min_chars))
    row = F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row")
    rows = staged(documents.select(row, F.monotonically_increasing_id().alias("number")), "numbered")
    held = (rows.where(~_clean(F.col("row.text"), [t for _, t in items], rate, min_chars)).select("number") for items in blocks)
    return rows.join(_gathered(held).distinct(), "number", "left_anti").select("row.*")


def _gathered(parts: Iterator[DataFrame]) -> DataFrame:
    """The rows of several frames of one schema, each written before the next one is made."""
    folder = None
    for part in parts:
        spark, schema = part.sparkSession, part.schema
        folder = folder or new_folder(spark, "matches")
        part.write.mode("append").parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def _found(ids: list, texts: list[str], rate: float, min_chars: int, kind: str) -> Column:
    """The matches in column ``text`` as an array."""

    @F.pandas_udf(f"array<struct<item_id:{kind},distance:int,start:long,stop:long>>")
    def search(column: pd.Series) -> pd.Series:
        matcher = _matcher(texts, rate, min_chars)
        fields = ("item_id", "distance", "start", "stop")
        return pd.Series([[dict(zip(fields, (ids[m[0]], *m[1:]), strict=True)) for m in matcher.find(normalise(t))] for t in column])

    return search(F.col("text"))


def _clean(text: Column, texts: list[str], rate: float, min_chars: int) -> Column:
    @F.pandas_udf("boolean")
    def clean(column: pd.Series) -> pd.Series:
        matcher = _matcher(texts, rate, min_chars)
        return pd.Series([not matcher.find(normalise(t)) for t in column], dtype=bool)

    return clean(text)


_MATCHERS: dict = {}


def _matcher(texts: list[str], rate: float, min_chars: int) -> Matcher:
    """The automaton of a block, built once per Python worker."""
    key = (hash(tuple(texts)), rate, min_chars)
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(texts, rate, min_chars)
    return _MATCHERS[key]


def _blocks(benchmark: DataFrame, min_chars: int, block_chars: int, short: bool) -> tuple[int, Iterator[list[tuple]]]:
    """Number of blocks, and items (id, normalised text) in blocks whose characters are bounded; at least one block.

    A benchmark beyond one block is dealt by hash to twice as many blocks as its length needs,
    inside Spark; one block at a time reaches the driver, which sends it to the tasks.
    """
    least = 1 if short else max(min_chars, 1)
    # Lower-casing at most doubles a text, so shorter ones cannot reach the least length.
    long_enough = benchmark.where(F.length("text") * 2 >= least).select("item_id", "text", F.length("text").alias("n"))
    total = long_enough.agg(F.sum("n")).first()[0] or 0
    count = 1 if total <= block_chars else -(-2 * total // block_chars)
    numbered = long_enough.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(count)))

    def each() -> Iterator[list[tuple]]:
        for number in range(count):
            rows = numbered.where(F.col("block") == number).select("item_id", "text").toLocalIterator()
            items = ((row["item_id"], normalise(row["text"])) for row in rows)
            yield sorted(((i, t) for i, t in items if len(t) >= least), key=lambda x: (str(x[0]), x[1]))

    return count, each()
