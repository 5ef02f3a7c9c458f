"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystick.sources.workspace import staged

# Fixed value: a word is a run of anything but these separators.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def discard(spark: SparkSession, folder: str) -> None:
    """Deletes a scratch folder of this run that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo; NULL for a NULL key."""
    return F.pmod(F.crc32(key.cast("string")), F.lit(modulus))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, combine: Callable[[Column, Column], Column], stretch: int = 256) -> Column:
    """Running totals of an array<int> under an associative ``combine`` that 0 does not change.

    An aggregate that collects its steps copies them at every step. Short stretches keep the
    time in proportion to the array: totals within each, then those of all stretches before it.
    """
    nothing = F.array().cast("array<int>")

    def within(part: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), nothing.alias("all"))

        def step(state: Column, x: Column) -> Column:
            return let(combine(state["at"], x), lambda at: F.struct(at.alias("at"), F.concat(state["all"], F.array(at)).alias("all")))

        return F.aggregate(part, start, step, lambda state: state["all"])

    def joined(parts: Column) -> Column:
        ends = F.transform(parts, lambda p: F.element_at(p, -1))
        before = let(within(ends), lambda e: F.concat(F.array(F.lit(0)), F.slice(e, F.lit(1), F.size(e) - 1)))
        return F.flatten(F.zip_with(parts, before, lambda p, b: F.transform(p, lambda x: combine(b, x))))

    def cut(v: Column) -> Column:
        places = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / stretch).cast("int"))
        parts = F.transform(places, lambda k: within(F.slice(v, k * stretch + 1, F.lit(stretch))))
        return F.when(F.size(v) > 0, let(parts, joined)).otherwise(nothing)

    return let(values, cut)


def components(edges: DataFrame) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    ``edges`` has two columns (a, b) of one orderable type; loops and repeated edges are
    allowed. Returns (node, root) for every node with an edge to another one, root being the
    smallest node of its component. A round is two map-side combined minima and two joins
    that Spark may split on hot nodes; its result is written to the shared folder, which
    cuts the lineage. Rounds grow with the logarithm of the longest path.
    """
    a, b = edges.columns
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    pairs = staged(pairs.where("u <> v").distinct(), "edges")
    state = _state(pairs)
    while state[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(lowest, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(
            F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")
        )
        pairs = staged(
            small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct(),
            "edges",
        )
        before, state = state, _state(pairs)
        if state == before:
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root"))
    ).distinct()


def _state(pairs: DataFrame) -> tuple:
    """Size and order-free checksum of a set of edges."""
    checksum = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(pairs.agg(F.count("*"), checksum).first())
