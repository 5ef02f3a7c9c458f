"""Indices of every product group a customer buys."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystick.functions.calendar import days_between, hour_slot, moment
from tallystick.functions.discounts import ratio
from tallystick.operators.ordering import dealt, latest, total_until
from tallystick.operators.periods import PAIR, mean, pair_profiles, purchase_frequency
from tallystick.operators.purchases import history_of
from tallystick.sources.workspace import staged

GROUP_COLUMNS = [
    *PAIR,
    "group_affinity_index",
    "group_churn_rate",
    "group_stability_index",
    "group_margin",
    "group_discount_share",
    "group_minimum_discount",
    "group_average_discount",
]


@dataclass(frozen=True)
class MarginRule:
    """Which purchases count towards the margin.

    ``count_type`` 1 takes the last ``limit`` days before the analysis, 2 the last
    ``limit`` transactions; without a limit every purchase counts.
    """

    count_type: int = 1
    limit: int | None = None

    def __post_init__(self) -> None:
        if self.count_type not in (1, 2):
            raise ValueError("count_type must be 1 (days) or 2 (transactions)")

    def since(self, as_of: dt.datetime):
        if self.count_type == 1 and self.limit is not None:
            try:
                return moment(as_of - dt.timedelta(days=self.limit))
            except OverflowError:  # reaches back before the calendar: every purchase counts
                return None
        return None

    @property
    def latest_only(self) -> bool:
        return self.count_type == 2 and self.limit is not None


def group_margins(history: DataFrame, rule: MarginRule, as_of: dt.datetime) -> DataFrame:
    """Paid minus cost per pair over the purchases the rule admits.

    Exact to the last digit if the history holds ``basket_margin``, see
    ``purchases.margin_history``; a bare history gives the difference of its rounded sums.
    """
    if "basket_margin" not in history.columns:
        history = history.withColumn("basket_margin", F.col("group_summ_paid") - F.col("group_cost"))
    bought = history.where(F.col("group_id").isNotNull())
    if rule.latest_only:
        bought = latest(bought, PAIR, "transaction_datetime", "transaction_id", rule.limit)
    since = rule.since(as_of)
    if since is not None:
        bought = bought.where(F.col("transaction_datetime") > since)
    return bought.groupBy(*PAIR).agg(F.sum("basket_margin").alias("group_margin"))


def purchase_spans(history: DataFrame) -> DataFrame:
    """First and last purchase of every pair and their number."""
    at = F.col("transaction_datetime")
    return (
        history.where(F.col("group_id").isNotNull())
        .groupBy(*PAIR)
        .agg(
            F.min(at).alias("first_group_purchase_date"),
            F.max(at).alias("last_group_purchase_date"),
            F.count(F.lit(1)).alias("group_purchase"),
        )
    )


def _visits(history: DataFrame, every_row: bool, parts: int | None) -> DataFrame:
    """Transactions per customer and moment, with the hour as ``_slot``.

    One shuffle by (customer, hour) serves all that is counted from here, the totals of the
    hours in ``total_until`` included.
    """
    at = ["customer_id", "_slot", "transaction_datetime"]
    dated = (
        history.where(F.col("transaction_datetime").isNotNull())
        .withColumn("_slot", hour_slot(F.col("transaction_datetime")))
        .select(*at, "transaction_id")
    )
    dated = dealt(dated, ["customer_id", "_slot"], parts)
    # One row per transaction first: a transaction holds one history row per group.
    counted = dated if every_row else dated.distinct()
    return counted.groupBy(*at).agg(F.count("transaction_id").alias("visits"))


def group_affinities(
    history: DataFrame, spans: DataFrame, every_row: bool = False, parts: int | None = None
) -> DataFrame:
    """Transactions with the group over all transactions between its first and last purchase.

    Joining each pair to all transactions in its span would multiply the rows of a busy
    customer. Instead both ends of every span look up the running number of transactions:
    those up to the last purchase less those before the first. ``every_row`` counts
    history rows instead of unique transactions. ``parts``, here and below, is
    ``purchases.parts_for`` the tables the history comes from.
    """
    return _with_affinity(spans, history, every_row, parts).select(*PAIR, "group_affinity_index")


# What a pair's affinity is found by; of no use once it is known.
_SPAN = ("first_group_purchase_date", "last_group_purchase_date")
SPAN_COLUMNS = [*PAIR, *_SPAN, "group_purchase"]


def _with_affinity(
    spans: DataFrame, history: DataFrame, every_row: bool = False, parts: int | None = None
) -> DataFrame:
    """The affinity and all columns of the spans but the dates, reading the spans once.

    Whatever else a pair carries travels with its first end, so nothing is joined back. It
    crosses two shuffles: callers drop what they do not need.
    """
    both_ends = F.array(
        F.struct(F.col("first_group_purchase_date").alias("at"), F.lit(False).alias("last")),
        F.struct(F.col("last_group_purchase_date").alias("at"), F.lit(True).alias("last")),
    )
    carried = [c for c in spans.columns if c not in (*PAIR, *_SPAN)]
    ends = (
        spans.where(F.col("first_group_purchase_date").isNotNull())
        .select(*PAIR, *carried, F.explode(both_ends).alias("end"))
        .select(
            *PAIR,
            *[F.when(~F.col("end.last"), F.col(c)).alias(c) for c in carried],
            F.col("end.at").alias("transaction_datetime"),
            "end.last",
        )
    )
    totals = total_until(
        _visits(history, every_row, parts),
        ends,
        ["customer_id"],
        "transaction_datetime",
        "visits",
        inclusive=F.col("last"),
        total="until",
        parts=parts,
    )
    inside = F.sum(F.when(F.col("last"), F.col("until")).otherwise(-F.col("until")))
    # Of the two rows of a pair only the first end has values: the maximum picks them.
    return totals.groupBy(*PAIR).agg(
        *[F.max(c).alias(c) for c in carried],
        ratio(F.max("group_purchase"), inside).alias("group_affinity_index"),
    )


def _moments(history: DataFrame, parts: int | None) -> DataFrame:
    """Purchases per pair and moment; equal moments melt into one row.

    Partitioned by pair and hour, as the window over them needs it.
    """
    bought = history.where(F.col("group_id").isNotNull()).select(
        *PAIR,
        hour_slot(F.col("transaction_datetime")).alias("slot"),
        "transaction_datetime",
        "transaction_id",
    )
    return (
        (bought if parts is None else dealt(bought, [*PAIR, "slot"], parts))
        .groupBy(*PAIR, "slot", "transaction_datetime")
        .agg(
            F.count(F.lit(1)).alias("purchases"),
            F.min("transaction_id").alias("opening_transaction"),
        )
    )


def _slots(history: DataFrame, parts: int | None) -> tuple[DataFrame, DataFrame]:
    """Purchases per pair and moment with the moment before in the same hour, and the hours of
    every pair with the last moment of the hour before and the pair's frequency.

    A pair has at most one row per hour at the second level, however many purchases it holds.
    """
    at = F.col("transaction_datetime")
    in_slot = Window.partitionBy(*PAIR, "slot").orderBy(at)
    over_slots = Window.partitionBy(*PAIR).orderBy("slot")
    # In the same order as the lag, so that one sort and one pass serve both.
    whole_pair = over_slots.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    moments = _moments(history, parts).withColumn("previous", F.lag(at).over(in_slot))
    slots = (
        moments.groupBy(*PAIR, "slot")
        .agg(
            F.min(F.when(F.col("previous").isNull(), at)).alias("opening"),
            F.max(at).alias("closing"),
            F.sum("purchases").alias("in_slot"),
            F.sum(F.when(at.isNotNull(), F.col("purchases")).otherwise(0)).alias("dated"),
        )
        .select(
            *PAIR,
            "slot",
            "opening",
            "closing",
            "dated",
            F.lag("closing").over(over_slots).alias("before_slot"),
            purchase_frequency(
                F.min("opening").over(whole_pair),
                F.max("closing").over(whole_pair),
                F.sum("in_slot").over(whole_pair),
            ).alias("group_frequency"),
        )
    )
    return moments, slots


def purchase_gaps(history: DataFrame, parts: int | None = None) -> DataFrame:
    """Every distinct purchase moment of a pair with the days since the one before.

    ``gap`` is NULL at the first moment. ``purchases`` made at the same moment stand for
    ``purchases - 1`` further gaps of zero days. A moment that is NULL has no gaps.

    Two levels, as in ``ordering``: the moment before in the same hour, else the last one
    of the hour before.
    """
    moments, slots = _slots(history, parts)
    return moments.join(
        slots.select(*PAIR, "slot", "before_slot", "group_frequency").hint("merge"),
        [*PAIR, "slot"],
    ).select(
        *PAIR,
        "transaction_datetime",
        "purchases",
        "opening_transaction",
        "group_frequency",
        days_between(
            F.coalesce("previous", "before_slot"), F.col("transaction_datetime")
        ).alias("gap"),
    )


def group_intervals(history: DataFrame, parts: int | None = None) -> DataFrame:
    """All gaps between successive purchases of a group, with both deviations from the norm.

    Of the transactions at one moment the lowest id carries the gap, the others carry zero.
    """
    gaps = purchase_gaps(history, parts)
    frequency = F.col("group_frequency")
    gap = F.when(F.col("transaction_id") == F.col("opening_transaction"), F.col("gap")).otherwise(
        F.lit(0.0)
    )
    deviation = F.abs(F.col("gap") - frequency)
    return (
        history.select(*PAIR, "transaction_datetime", "transaction_id")
        .join(gaps.hint("merge"), [*PAIR, "transaction_datetime"])
        .withColumn("gap", gap)
        .where(F.col("gap").isNotNull())
        .select(
            *PAIR,
            "transaction_id",
            "gap",
            deviation.alias("deviation"),
            (deviation / frequency).alias("relative_deviation"),
        )
    )


def group_stabilities(history: DataFrame, parts: int | None = None) -> DataFrame:
    """Average relative deviation of the gaps; NULL after a single purchase."""
    dated = F.col("transaction_datetime").isNotNull()
    # A gap of zero deviates by exactly one frequency.
    deviation = _relative_deviation(F.col("gap")) + (F.col("purchases") - 1)
    gaps = F.sum(F.when(dated, F.col("purchases"))) - 1
    return (
        purchase_gaps(history, parts)
        .groupBy(*PAIR)
        .agg(ratio(F.sum(F.when(dated, deviation)), gaps).alias("group_stability_index"))
    )


def slot_stabilities(history: DataFrame, parts: int | None = None) -> DataFrame:
    """The same as ``group_stabilities`` with one shuffle of the rows per pair and hour, not three.

    Gaps inside an hour are shorter than an hour. If the frequency is not, they add up to the
    time from the hour's first purchase to its last, so rows per pair and hour are enough. Only
    pairs with more than a purchase an hour are joined to their moments again.
    """
    dated = F.col("dated")
    moments, slots = _slots(history.where(F.col("customer_id").isNotNull()), parts)
    frequency = F.col("group_frequency")
    # A gap of zero, as of every further purchase at one moment, deviates by one frequency.
    inside = dated - 1 - days_between(F.col("opening"), F.col("closing")) / frequency
    first = _relative_deviation(days_between(F.col("before_slot"), F.col("opening")))
    stable = slots.groupBy(*PAIR).agg(
        F.sum(F.when(dated > 0, first + inside)).alias("deviation"), F.sum(dated).alias("dated")
    )
    dense = (
        moments.join(
            slots.where((frequency < 1 / 24) & (dated > 0))
            .select(*PAIR, "slot", "before_slot", "group_frequency")
            .hint("merge"),
            [*PAIR, "slot"],
        )
        .withColumn(
            "deviation",
            _relative_deviation(
                days_between(F.coalesce("previous", "before_slot"), F.col("transaction_datetime"))
            )
            + (F.col("purchases") - 1),
        )
        .groupBy(*PAIR)
        .agg(F.sum("deviation").alias("dense_deviation"))
    )
    deviation = F.coalesce("dense_deviation", "deviation")
    return stable.join(dense.hint("merge"), PAIR, "left").select(
        *PAIR, ratio(deviation, dated - 1).alias("group_stability_index")
    )


def _relative_deviation(gap: Column) -> Column:
    """Of a gap from the frequency; zero if there is none."""
    frequency = F.col("group_frequency")
    return F.coalesce(F.abs(gap - frequency) / frequency, F.lit(0.0))


def group_churns(profiles: DataFrame, as_of: dt.datetime) -> DataFrame:
    return profiles.select(*PAIR, _churn_rate(as_of).alias("group_churn_rate"))


def _churn_rate(as_of: dt.datetime):
    return ratio(
        days_between(F.col("last_group_purchase_date"), moment(as_of)), F.col("group_frequency")
    )


def _discount_share(every_line: bool = False):
    counted = "discounted_lines" if every_line else "discounted_transactions"
    return ratio(F.col(counted), F.col("group_purchase"))


def group_discount_shares(profiles: DataFrame, every_line: bool = False) -> DataFrame:
    """Transactions with a reduced line over all; ``every_line`` counts lines instead."""
    return profiles.select(*PAIR, _discount_share(every_line).alias("group_discount_share"))


def group_discounts(profiles: DataFrame) -> DataFrame:
    """Least discount above zero, and paid over full price of the reduced baskets."""
    return profiles.select(*PAIR, *_discounts())


def _discounts():
    least = F.col("group_min_discount")
    return (
        F.when(least > 0, least).alias("group_minimum_discount"),
        ratio(F.col("reduced_paid"), F.col("reduced_summ")).alias("group_average_discount"),
    )


def offer_caps(profiles: DataFrame, margin_share: float) -> DataFrame:
    """Greatest admissible discount per pair, in per cent, from its average margin."""
    return profiles.select(*PAIR, offer_cap(margin_share).alias("max_discount"))


def offer_cap(margin_share: float):
    summ, cost = F.col("average_summ"), F.col("average_cost")
    return F.try_divide((summ - cost) * F.lit(float(margin_share)), cost)


def history_caps(history: DataFrame, margin_share: float) -> DataFrame:
    """The same from a bare purchase history."""
    averages = (
        history.where(F.col("group_id").isNotNull())
        .groupBy(*PAIR)
        .agg(
            mean(F.col("group_summ")).alias("average_summ"),
            mean(F.col("group_cost")).alias("average_cost"),
        )
    )
    return offer_caps(averages, margin_share)


def pair_indices(
    baskets: DataFrame, as_of: dt.datetime, margin: MarginRule | None = None
) -> DataFrame:
    """The indices one aggregation yields, with the span and averages of every pair.

    Offers filter these first, so that affinity is worked out for the remaining pairs only:
    no filter on it could pass through its windows by itself.
    """
    rule = margin or MarginRule()
    indices = profile_indices(pair_profiles(baskets, rule.since(as_of)), as_of)
    if rule.latest_only:
        recent = staged(group_margins(history_of(baskets, "basket_margin"), rule, as_of), "margins", tidy=True)
        indices = indices.drop("group_margin").join(recent.hint("merge"), PAIR, "left")
    return indices


def profile_indices(profiles: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The same from ``periods.profiles_of`` a state, however it came about."""
    return profiles.select(
        *PAIR,
        "first_group_purchase_date",
        "last_group_purchase_date",
        "group_purchase",
        "average_summ",
        "average_cost",
        _churn_rate(as_of).alias("group_churn_rate"),
        "group_margin",
        _discount_share().alias("group_discount_share"),
        *_discounts(),
    )


def with_affinity(
    indices: DataFrame, history: DataFrame, parts: int | None = None
) -> DataFrame:
    """The indices are staged: the shuffles of their sums are gone before those of the ends."""
    return _with_affinity(staged(indices, "indices", tidy=True), history, parts=parts)


def with_stability(
    indices: DataFrame, history: DataFrame, parts: int | None = None
) -> DataFrame:
    """The stability is staged: its shuffles are gone before those of the indices are written."""
    stabilities = staged(slot_stabilities(history, parts), "stabilities", tidy=True)
    return indices.join(stabilities.hint("merge"), PAIR, "left")


def groups_view(
    baskets: DataFrame,
    as_of: dt.datetime,
    margin: MarginRule | None = None,
    parts: int | None = None,
) -> DataFrame:
    """All group indices; ``baskets`` is read by several branches, so stage it first.

    Each branch is staged before the next one shuffles, so that the disk holds one at a time.
    """
    history = history_of(baskets)
    # No index of the view, and of no use for one: the averages would cross three shuffles.
    indices = pair_indices(baskets, as_of, margin).drop("average_summ", "average_cost")
    indices = with_affinity(indices, history, parts)
    return with_stability(indices, history, parts).select(*GROUP_COLUMNS)
