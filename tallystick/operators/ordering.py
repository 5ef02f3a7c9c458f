"""Order-dependent steps that stay exact when one key holds most of the rows.

A window partitioned by the key alone would put all rows of a hot key into one task.
These steps work in two levels instead: inside (key, hour), then over the hours of a
key. The second level has at most as many rows per key as there are hours in the data.
Both levels grow with the data, so they are merged, never broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystick.functions.calendar import hour_slot
from tallystick.sources.workspace import staged

# Into so many parts the rows of a key are split to find its latest ones.
PARTS = 128
_PARTS = PARTS  # the name the tests know


def dealt(df: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """Partitioned by the keys, into so many parts if given, which stay as many.

    Without a number adaptive execution merges small parts down to one per core.
    """
    return df.repartition(*keys) if parts is None else df.repartition(parts, *keys)


def total_until(
    counted: DataFrame,
    readers: DataFrame,
    keys: Sequence[str],
    at: str,
    value: str,
    inclusive: Column,
    total: str,
    parts: int | None = None,
) -> DataFrame:
    """Give every reader the total ``value`` of the key's counted rows before its moment.

    Readers for which ``inclusive`` holds also count the rows at their own moment. Readers
    are sorted in among the counted rows, before or after those of the same moment, and
    take the running total there; no reader is joined to the rows it counts.

    Every reader's moment must lie in an hour with a counted row. ``counted`` holds the hour
    as ``_slot`` and is best partitioned by keys and hour already. ``parts`` is for ``dealt``.
    """
    before, row, after = 0, 1, 2
    step = F.when(inclusive, after).otherwise(before)
    payload = [c for c in readers.columns if c not in (*keys, at)]
    # Packed, because the missing values of counted rows would otherwise show up as filters
    # on the tables the result is joined to, and spoil the reuse of their shuffles.
    together = readers.select(
        *keys,
        at,
        step.alias("_step"),
        F.lit(0).cast("long").alias(value),
        F.struct(*payload).alias("_reader"),
    ).unionByName(
        counted.select(*keys, at, F.lit(row).alias("_step"), value), allowMissingColumns=True
    )
    in_slot = (
        Window.partitionBy(*keys, "_slot")
        .orderBy(at, "_step")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = together.withColumn("_slot", hour_slot(F.col(at)))
    read = (
        (placed if parts is None else dealt(placed, [*keys, "_slot"], parts))
        .withColumn("_inside", F.sum(value).over(in_slot))
        .where(F.col("_step") != row)
    )
    earlier = (
        Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    )
    slots = (
        counted.groupBy(*keys, "_slot")
        .agg(F.sum(value).alias("_in_slot"))
        .select(
            *keys, "_slot", F.coalesce(F.sum("_in_slot").over(earlier), F.lit(0)).alias("_before")
        )
    )
    return (
        read.join(slots.hint("merge"), [*keys, "_slot"])
        .select(
            *keys, at, "_reader.*", (F.col("_before") + F.col("_inside")).alias(total)
        )
    )


def latest(df: DataFrame, keys: Sequence[str], at: str, tie: str, count: int) -> DataFrame:
    """The ``count`` latest rows of every key; among equal moments the higher ``tie`` first.

    The rows of a key are dealt by a hash of ``tie`` to ``PARTS`` parts, each of which keeps its
    own latest rows; the key's are among them. So a task holds a small part of a hot key's
    rows, whatever their moments are, and the second step at most ``PARTS * count`` rows of it.
    """
    if count < 1:
        raise ValueError("count must be at least 1")
    newest_first = [F.col(at).desc_nulls_last(), F.col(tie).desc_nulls_last()]
    parted = df.withColumn("_part", F.pmod(F.xxhash64(tie), F.lit(PARTS)))
    return first_per_key(
        first_per_key(parted, [*keys, "_part"], newest_first, count).drop("_part"),
        keys,
        newest_first,
        count,
    )


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], count: int = 1
) -> DataFrame:
    """The first ``count`` rows of every key in the given total order."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= count).drop("_place")


def global_rank(df: DataFrame, order: Sequence[Column], rank: str, size: str) -> DataFrame:
    """Add the row's place (from 1) in a total order, and the number of rows.

    A range-partitioned sort gives every row its place inside its partition. The sorted
    rows are staged, because partition and place must not change between the two reads.
    The partition counts that turn them into global places are one row per partition,
    which bounds the window and the broadcast below whatever the size of ``df``.
    """
    position = F.monotonically_increasing_id()
    placed = staged(df.orderBy(*order).withColumn("_position", position), "ranked").withColumn(
        "_part", F.shiftright("_position", 33)
    )
    by_part = Window.orderBy("_part")
    parts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            "_part",
            F.coalesce(
                F.sum("_rows").over(by_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_before"),
            F.sum("_rows")
            .over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
            .alias(size),
        )
    )
    inside = F.col("_position").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.join(F.broadcast(parts), "_part")
        .withColumn(rank, F.col("_before") + inside + 1)
        .drop("_position", "_part", "_before")
    )
