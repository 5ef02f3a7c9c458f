"""Mixing sources to target weights by Sainte-Laguë apportionment; built-in functions only.

The targets come from the weights: a common level fills the sources in proportion to their
weights until the share of all words is given out, and a source stops at ``cap`` times its
size. The total, counted in blocks of ``block_words``, is dealt to the sources as seats by
highest quotients target / (2 k + 1), and each source's seats to its shards in the same way.
A shard lays its documents end to end in seeded order and cuts them into blocks; all blocks
are taken as often as the quota covers the whole shard, and the rest goes once to the blocks
first in a second seeded order. What a document gives is its overlap with the taken blocks.

Cases: a NULL text has size 0; a NULL source is a source of its own, last in order; NULL ids
and repeated rows are ordinary rows (equal rows may swap their shares, the set of rows stays
the same); an empty table gives no rows. Shards hold about ``shard_words`` words, so a hot
source spreads over many tasks; documents of size 0 give nothing and skip the shards. Only rows
of ids and counts are shuffled, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystick.llm.common import word_count
from tallystick.sources.workspace import staged

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
BLOCK_WORDS = 32
SHARD_WORDS = 1 << 20
SEED = "mix-1"


def fill_targets(sources: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size) -> also source_no, weight and target; one row per source."""
    whole = Window.partitionBy()
    by_name = whole.orderBy(F.col("source").asc_nulls_last())
    numbered = sources.withColumn("source_no", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") - 1) % len(weights) + 1)
    )
    limit = F.lit(cap) * F.col("source_size")
    by_ratio = whole.orderBy(limit / F.col("weight"), "source_no")
    below = F.coalesce(F.sum(limit).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    total = F.lit(share) * F.sum("source_size").over(whole)
    levelled = numbered.withColumn("level", (total - below) / open_weight)
    capped = limit <= F.col("level") * F.col("weight")
    level = F.max(F.when(~capped, F.col("level"))).over(whole)
    target = F.least(limit, F.coalesce(level * F.col("weight"), limit))
    return levelled.withColumn("target", target).drop("level")


def apportion(items: DataFrame, group: list[str], item: str, votes: Column, seats: Column) -> DataFrame:
    """Sainte-Laguë seats per item of a group, as column ``quota``.

    Rounded proportional shares are within half a seat per item of the right total; the seats
    still to give (or take back) go by highest (lowest) quotient. Rescaling moves an item by
    at most share * items / (2 * seats) + 1, which bounds the quotients to look at to about
    three per item. Equal quotients: the smaller item is served first.
    """
    whole = Window.partitionBy(*group)
    rows = items.withColumns({"_votes": votes.cast("double"), "_seats": seats.cast("long")})
    rows = rows.withColumn("_fair", F.coalesce(F.try_divide(F.col("_votes") * F.col("_seats"), F.sum("_votes").over(whole)), F.lit(0.0)))
    rows = rows.withColumn("_base", F.floor(F.col("_fair") + 0.5).cast("long"))
    rows = rows.withColumn("_lack", F.when(F.sum("_votes").over(whole) > 0, F.col("_seats") - F.sum("_base").over(whole)).otherwise(0))
    reach = F.ceil(F.col("_fair") * F.count("*").over(whole) / (2 * F.greatest(F.col("_seats"), F.lit(1)))).cast("long") + 1
    rows = rows.withColumn("_reach", F.when(F.col("_lack") < 0, F.least(reach, F.col("_base") - 1)).otherwise(reach))
    tries = F.when((F.col("_lack") != 0) & (F.col("_reach") >= 0) & (F.col("_votes") > 0), F.sequence(F.lit(0).cast("long"), F.col("_reach")))
    open_rows = rows.select(*group, item, "_votes", "_base", "_lack", F.explode(tries).alias("_k"))
    seat = F.when(F.col("_lack") > 0, F.col("_base") + F.col("_k")).otherwise(F.col("_base") - 1 - F.col("_k"))
    quotient = F.col("_votes") / (2 * seat + 1)
    forward = F.col("_lack") > 0
    best = whole.orderBy(F.when(forward, -quotient).otherwise(quotient), F.when(forward, F.col(item)).otherwise(-F.col(item)))
    moved = (
        open_rows.withColumn("_place", F.row_number().over(best))
        .where(F.col("_place") <= F.abs("_lack"))
        .groupBy(*group, item)
        .agg(F.sum(F.signum("_lack")).cast("long").alias("_moved"))
    )
    quota = F.col("_base") + F.coalesce("_moved", F.lit(0))
    return rows.join(moved, [*group, item], "left").withColumn("quota", quota).drop(
        "_votes", "_seats", "_fair", "_base", "_lack", "_reach", "_moved"
    )


def mix(
    documents: DataFrame,
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """(doc_id, text, source, ...) -> (doc_id, source, size, source_size, target, taken)."""
    sized = staged(documents.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    sources = fill_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    seats = F.round(F.lit(share) * F.sum("source_size").over(Window.partitionBy()) / block_words)
    sources = apportion(sources.withColumn("_all", F.lit(0)).withColumn("_total", seats), ["_all"], "source_no", F.col("target"), F.col("_total"))
    shards_of = F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)).cast("long")
    sources = staged(
        sources.select("source", "source_no", "source_size", "target", F.col("quota").alias("source_quota"), shards_of.alias("shards")),
        "sources",
    )
    order = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("size").cast("string")))
    placed = sized.withColumnRenamed("source", "_s").join(sources, F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
    same = ["doc_id", "source", "size", "source_size", "target"]
    empty = placed.where("size = 0").select(*same, F.lit(0).cast("long").alias("taken"))
    placed = (
        placed.where("size > 0")
        .withColumn("order", order)
        .withColumn("shard", F.conv(F.substring("order", 1, 8), 16, 10).cast("long") % F.col("shards"))
    )
    per_shard = placed.groupBy("source_no", "shard").agg(F.sum("size").alias("shard_size"), F.first("source_quota").alias("source_quota"))
    quotas = apportion(per_shard, ["source_no"], "shard", F.col("shard_size"), F.col("source_quota"))
    blocks = F.greatest(F.ceil(F.col("shard_size") / block_words), F.lit(1)).cast("long")
    quotas = quotas.withColumn("_blocks", blocks).withColumn("_quota", F.least(F.col("quota"), F.floor(F.lit(cap) * F.col("_blocks"))))
    quotas = quotas.select(
        "source_no", "shard",
        F.expr("_quota div _blocks").alias("rounds"), F.expr("_quota % _blocks").alias("extra"),
    )
    shard = Window.partitionBy("source_no", "shard")
    laid = shard.orderBy("order", F.col("doc_id").asc_nulls_first(), "size")
    laid_out = (
        placed.join(quotas, ["source_no", "shard"])
        .withColumn("place", F.row_number().over(laid))
        .withColumn("stop", F.sum("size").over(laid.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("start", F.col("stop") - F.col("size"))
    )
    cut = F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(stop - 1) div {block_words}"))
    pieces = laid_out.select("*", F.explode(cut).alias("block"))
    overlap = F.least(F.col("stop"), (F.col("block") + 1) * block_words) - F.greatest(F.col("start"), F.col("block") * block_words)
    drawn = shard.orderBy(F.md5(F.concat_ws("|", F.lit(seed), "source_no", "shard", "block")), "block")
    pieces = pieces.withColumn("draw", F.dense_rank().over(drawn))
    times = F.col("rounds") + F.when(F.col("draw") <= F.col("extra"), 1).otherwise(0)
    keys = ["source_no", "shard", "place"]
    mixed = pieces.withColumn("words", overlap * times).groupBy(*keys).agg(*(F.first(c).alias(c) for c in same), F.sum("words").cast("long").alias("taken"))
    return mixed.drop(*keys).unionByName(empty)
