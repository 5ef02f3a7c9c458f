"""Purchase periods per customer and product group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystick.functions.calendar import days_between
from tallystick.functions.discounts import ratio
from tallystick.operators.purchases import check_lines
from tallystick.sources.tables import Tables

PAIR = ["customer_id", "group_id"]

PERIOD_COLUMNS = [
    *PAIR,
    "first_group_purchase_date",
    "last_group_purchase_date",
    "group_purchase",
    "group_frequency",
    "group_min_discount",
]


def mean(value: Column) -> Column:
    """Average as a double over a sum that stays exact for decimals."""
    return ratio(F.sum(value), F.count(value))


def purchase_frequency(first: Column, last: Column, purchases: Column) -> Column:
    """Average days per purchase; one for a single purchase."""
    return F.when(purchases == 1, F.lit(1.0)).otherwise(
        (days_between(first, last) + 1) / purchases
    )


def pair_state(baskets: DataFrame, margin_since: Column | None = None) -> DataFrame:
    """What one aggregation can tell about every (customer, group) pair, in a form that merges.

    Only counts, sums and extremes, never their quotients. ``margin_since`` keeps only later
    purchases in ``group_margin``.
    """
    priced = F.col("priced_lines") > 0
    reduced = priced & (F.col("group_summ_paid") != F.col("group_summ"))
    in_margin = priced if margin_since is None else priced & (
        F.col("transaction_datetime") > margin_since
    )
    summ, cost = (F.when(priced, F.col(c)) for c in ("group_summ", "group_cost"))
    return (
        baskets.where(F.col("group_id").isNotNull())
        .groupBy(*PAIR)
        .agg(
            F.min(F.when(priced, F.col("transaction_datetime"))).alias(
                "first_group_purchase_date"
            ),
            F.max(F.when(priced, F.col("transaction_datetime"))).alias("last_group_purchase_date"),
            F.count(F.when(priced, 1)).alias("group_purchase"),
            F.max("greatest_ratio").alias("greatest_ratio"),
            F.min("least_ratio").alias("least_ratio"),
            F.count(F.when(F.col("discounted_lines") > 0, 1)).alias("discounted_transactions"),
            F.sum("discounted_lines").alias("discounted_lines"),
            F.sum(F.when(in_margin, F.col("basket_margin"))).alias("group_margin"),
            F.sum(F.when(reduced, F.col("group_summ_paid"))).alias("reduced_paid"),
            F.sum(F.when(reduced, F.col("group_summ"))).alias("reduced_summ"),
            F.sum(summ).alias("total_summ"),
            F.count(summ).alias("summed"),
            F.sum(cost).alias("total_cost"),
            F.count(cost).alias("costed"),
        )
    )


# How the columns of two states of one pair become one; all others are added.
_EXTREMES = {
    "first_group_purchase_date": F.min,
    "last_group_purchase_date": F.max,
    "greatest_ratio": F.max,
    "least_ratio": F.min,
}


def merged_states(state: DataFrame, further: DataFrame) -> DataFrame:
    """The state of all baskets from the states of two parts of them.

    Each transaction must lie in one part whole. Types stay those of ``state``, so merging
    time and again does not widen the sums.
    """
    together = state.unionByName(further)
    columns = []
    for field in state.schema.fields:
        if field.name not in PAIR:
            merge = _EXTREMES.get(field.name, F.sum)
            columns.append(merge(field.name).cast(field.dataType).alias(field.name))
    return together.groupBy(*PAIR).agg(*columns)


def profiles_of(state: DataFrame) -> DataFrame:
    """The pairs with a priced purchase, with the quotients of their sums and counts."""
    first, last, purchases = map(
        F.col, ("first_group_purchase_date", "last_group_purchase_date", "group_purchase")
    )
    return (
        state.where(purchases > 0)
        .withColumn("average_summ", ratio(F.col("total_summ"), F.col("summed")))
        .withColumn("average_cost", ratio(F.col("total_cost"), F.col("costed")))
        .drop("total_summ", "summed", "total_cost", "costed")
        .withColumn("group_frequency", purchase_frequency(first, last, purchases))
        .withColumn("group_min_discount", least_discount())
    )


def pair_profiles(baskets: DataFrame, margin_since: Column | None = None) -> DataFrame:
    """Everything about a (customer, group) pair that one aggregation can tell."""
    return profiles_of(pair_state(baskets, margin_since))


def least_discount() -> Column:
    """Zero if no line was ever reduced, else the least ratio above zero."""
    return F.when(F.col("greatest_ratio") == 0, F.lit(0.0)).otherwise(F.col("least_ratio"))


def periods(baskets: DataFrame) -> DataFrame:
    return pair_profiles(baskets).select(*PERIOD_COLUMNS)


def least_discounts(tables: Tables) -> DataFrame:
    """Least discount per pair from the check lines alone, with or without a store price."""
    lines = check_lines(tables).where(F.col("group_id").isNotNull())
    line_ratio = ratio(F.col("sku_discount"), F.col("sku_summ"))
    return (
        lines.withColumn("line_ratio", line_ratio)
        .groupBy(*PAIR)
        .agg(
            F.max("line_ratio").alias("greatest_ratio"),
            F.min(F.when(F.col("line_ratio") > 0, F.col("line_ratio"))).alias("least_ratio"),
        )
        .select(*PAIR, least_discount().alias("group_min_discount"))
    )
