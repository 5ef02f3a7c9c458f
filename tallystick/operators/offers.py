"""Personal offers: larger checks, more visits, cross-selling."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystick.functions.calendar import days_between, moment, to_datetime
from tallystick.functions.discounts import ratio, settled, step_up
from tallystick.operators.groups import offer_cap
from tallystick.operators.ordering import first_per_key, latest
from tallystick.operators.periods import mean
from tallystick.operators.purchases import customer_transactions
from tallystick.sources.tables import Tables

@dataclass(frozen=True)
class Reward:
    """Who may get a group discount: churn and share limits in the offer's own terms."""

    max_churn: float = 3
    max_discount_share: float = 70  # per cent of transactions
    margin_share: float = 30  # per cent of the margin


@dataclass(frozen=True)
class AverageCheck:
    """How to measure the average check: method 1 by period, 2 by the latest transactions."""

    method: int = 2
    start: dt.date | str | None = None
    end: dt.date | str | None = None
    quantity: int | None = 100
    coefficient: float = 1.15

    def __post_init__(self) -> None:
        if self.method == 1:
            if self.start is None or self.end is None:
                raise ValueError("method 1 needs the first and last date of the period")
            if not to_datetime(self.end) > to_datetime(self.start):
                raise ValueError("the last date must be later than the first")
        elif self.method == 2:
            if self.quantity is None or self.quantity < 1:
                raise ValueError("method 2 needs a number of transactions")
        else:
            raise ValueError("method must be 1 (period) or 2 (transactions)")


def eligible_groups(indices: DataFrame, reward: Reward) -> DataFrame:
    """Pairs within the churn and share limits whose rounded least discount is below the cap.

    Needs nothing but ``groups.pair_indices``. A pair that was never reduced has no least
    discount, so it never qualifies.
    """
    depth = step_up(F.col("group_minimum_discount"))
    return (
        indices.where(
            (settled(F.col("group_churn_rate")) <= reward.max_churn)
            & (settled(F.col("group_discount_share")) < reward.max_discount_share / 100)
        )
        .withColumn("offer_discount_depth", depth)
        .where(F.col("offer_discount_depth") < settled(offer_cap(reward.margin_share)))
    )


def _affinity_order() -> list[Column]:
    return [F.col("group_affinity_index").desc_nulls_last(), F.col("group_id").asc()]


def best_groups(eligible: DataFrame) -> DataFrame:
    """The eligible group of greatest affinity of every customer."""
    return first_per_key(eligible, ["customer_id"], _affinity_order())


def selected_transactions(tables: Tables, check: AverageCheck) -> DataFrame:
    """The transactions an average check is measured on."""
    transactions = customer_transactions(tables)
    if check.method == 2:
        return latest(
            transactions,
            ["customer_id"],
            "transaction_datetime",
            "transaction_id",
            check.quantity,
        )
    # Dates outside the analysed period move to its ends; a period that lies wholly before
    # or after it selects nothing.
    span = tables.transactions.agg(
        F.min("transaction_datetime").alias("opening"),
        F.max("transaction_datetime").alias("closing"),
    )

    def clamped(value: dt.date | str) -> Column:
        inside = F.least(F.greatest(moment(value), F.col("opening")), F.col("closing"))
        return span.select(inside).scalar()

    overlaps = span.select(
        (moment(check.start) <= F.col("closing")) & (moment(check.end) >= F.col("opening"))
    ).scalar()
    return transactions.where(
        F.col("transaction_datetime").between(clamped(check.start), clamped(check.end))
        & overlaps
    )


def target_checks(tables: Tables, check: AverageCheck) -> DataFrame:
    """Average of the selected transactions of each customer times the coefficient.

    Transactions without a sum are left out of the average.
    """
    average = mean(F.col("transaction_summ"))
    return (
        selected_transactions(tables, check)
        .groupBy("customer_id")
        .agg((average * F.lit(float(check.coefficient))).alias("required_check_measure"))
    )


def average_check_offers(tables: Tables, rewarded: DataFrame, check: AverageCheck) -> DataFrame:
    """Target check and discount for every rewarded group, best or merely eligible."""
    return (
        rewarded.join(target_checks(tables, check).hint("merge"), "customer_id")
        .join(tables.sku_groups, "group_id")
        .select("customer_id", "required_check_measure", "group_name", "offer_discount_depth")
    )


def visit_growth_offers(
    tables: Tables,
    rewarded: DataFrame,
    customers: DataFrame,
    start: dt.datetime | str,
    end: dt.datetime | str,
    added_transactions: int = 1,
) -> DataFrame:
    """Required visits in the period and the discount that rewards them.

    ``customers`` needs ``customer_id`` and ``customer_frequency`` only. Customers with
    frequency zero have no expected number of visits and get no offer.
    """
    expected = ratio(days_between(moment(start), moment(end)), F.col("customer_frequency"))
    if not to_datetime(end) > to_datetime(start):
        raise ValueError("the last moment must be later than the first")
    frequencies = customers.select("customer_id", "customer_frequency")
    required = F.round(settled(expected)).cast("long") + F.lit(added_transactions)
    return (
        rewarded.join(frequencies.hint("merge"), "customer_id")
        .where(F.col("customer_frequency") != 0)
        .join(tables.sku_groups, "group_id")
        .select(
            "customer_id",
            moment(start).alias("start_date"),
            moment(end).alias("end_date"),
            required.alias("required_transactions_count"),
            "group_name",
            F.col("offer_discount_depth").cast("int").alias("offer_discount_depth"),
        )
    )


def sku_shares(tables: Tables, wanted: DataFrame | None = None) -> DataFrame:
    """Per SKU: transactions with it over transactions with its group, in per cent.

    ``wanted`` holds the SKUs to work out, if not all; groups are counted whole in any case.
    """
    lines = tables.checks.select("transaction_id", "sku_id")
    goods = tables.product_matrix.select("sku_id", "group_id")
    asked = goods if wanted is None else goods.join(wanted.select("sku_id"), "sku_id", "left_semi")
    # Counted before the catalogue is joined, so that a hot SKU is spread over its transactions.
    with_sku = (
        lines.distinct()
        .groupBy("sku_id")
        .agg(F.count("transaction_id").alias("with_sku"))
        .join(asked.distinct().hint("merge"), "sku_id")
    )
    with_group = (
        lines.join(goods.hint("merge"), "sku_id")
        .select("transaction_id", "group_id")
        .distinct()
        .groupBy("group_id")
        .agg(F.count("transaction_id").alias("with_group"))
    )
    return with_sku.join(with_group, "group_id").select(
        "sku_id",
        "group_id",
        (ratio(F.col("with_sku"), F.col("with_group")) * 100).alias("sku_share"),
    )


def best_margin_skus(tables: Tables) -> DataFrame:
    """The SKU with the greatest margin in every store and group.

    It does not depend on the customer, so it is found once per store and group.
    """
    margin = F.col("sku_retail_price") - F.col("sku_purchase_price")
    # Merged: prices and catalogue grow with the data and are larger than their files suggest.
    offered = tables.retail_stores.join(
        tables.product_matrix.hint("merge"), "sku_id"
    ).withColumn("sku_margin", margin)
    return first_per_key(
        offered.where(F.col("group_id").isNotNull()),
        ["transaction_store_id", "group_id"],
        [F.col("sku_margin").desc_nulls_last(), F.col("sku_id").asc()],
    ).select(
        "transaction_store_id",
        "group_id",
        "sku_id",
        "sku_name",
        "sku_retail_price",
        "sku_margin",
    )


@dataclass(frozen=True)
class CrossSell:
    number_of_groups: int = 5
    max_churn: float = 3
    max_stability: float = 0.5
    max_sku_share: float = 100  # per cent
    margin_share: float = 30  # per cent

    def __post_init__(self) -> None:
        if self.number_of_groups < 1:
            raise ValueError("number_of_groups must be at least 1")


def living_groups(indices: DataFrame, params: CrossSell) -> DataFrame:
    return indices.where(settled(F.col("group_churn_rate")) <= params.max_churn)


def steady_groups(indices: DataFrame, params: CrossSell) -> DataFrame:
    """Drops pairs without a stability, too: they were bought once."""
    return indices.where(settled(F.col("group_stability_index")) < params.max_stability)


def cross_sell_offers(
    tables: Tables, groups: DataFrame, primary_stores: DataFrame, params: CrossSell
) -> DataFrame:
    """Per chosen group the best-margin SKU of the primary store, if its discount fits.

    ``groups`` are living and steady. Those of greatest affinity are chosen before prices
    are joined. Besides the offer, ``sku_id`` and ``group_id`` tell SKUs of the same name
    apart.
    """
    share_of_margin = F.lit(float(params.margin_share))
    cap = ratio(F.col("sku_margin"), F.col("sku_retail_price")) * share_of_margin
    depth = step_up(F.col("group_minimum_discount"))
    best = best_margin_skus(tables)
    # A store without any transaction cannot be a primary store.
    offered = (
        first_per_key(groups, ["customer_id"], _affinity_order(), params.number_of_groups)
        .join(primary_stores.hint("merge"), "customer_id")
        .withColumnRenamed("customer_primary_store", "transaction_store_id")
        .join(best, ["transaction_store_id", "group_id"])
        .withColumn("offer_discount_depth", depth)
        .where(F.col("offer_discount_depth") <= settled(cap))
    )
    if params.max_sku_share < 100:  # a share cannot exceed a hundred per cent
        shares = sku_shares(tables, best.select("sku_id").distinct()).select("sku_id", "sku_share")
        # A SKU that was never sold has no share of its group.
        offered = offered.join(shares, "sku_id", "left").where(
            settled(F.coalesce("sku_share", F.lit(0.0))) <= params.max_sku_share
        )
    return offered.select("customer_id", "sku_name", "offer_discount_depth", "sku_id", "group_id")
