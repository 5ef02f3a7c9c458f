"""Customer segments, churn and primary stores."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystick.functions.calendar import days_between, moment
from tallystick.functions.discounts import ratio
from tallystick.operators.ordering import first_per_key, global_rank, latest
from tallystick.operators.purchases import customer_transactions
from tallystick.sources.tables import Tables
from tallystick.sources.workspace import staged

CUSTOMER_COLUMNS = [
    "customer_id",
    "customer_average_check",
    "customer_average_check_segment",
    "customer_frequency",
    "customer_frequency_segment",
    "customer_inactive_period",
    "customer_churn_rate",
    "customer_churn_segment",
    "customer_segment",
    "customer_primary_store",
]

# Segment names from the lowest to the highest third of the number.
CHECK_LEVELS = ("Low", "Medium", "High")
FREQUENCY_LEVELS = ("Rarely", "Occasionally", "Often")
CHURN_LEVELS = ("Low", "Medium", "High")

# Shares of customers, in per cent, in the first and first two segments.
TOP_SHARE = 10
TOP_TWO_SHARE = 35


def store_visits(tables: Tables) -> DataFrame:
    """Per customer and store: transactions, turnover, first and last moment.

    The only aggregation over all transactions; everything about a customer except the
    last three transactions follows from these few rows.
    """
    return (
        customer_transactions(tables)
        .groupBy("customer_id", "transaction_store_id")
        .agg(
            F.count("transaction_id").alias("visits"),
            F.sum("transaction_summ").alias("turnover"),
            F.min("transaction_datetime").alias("first_visit"),
            F.max("transaction_datetime").alias("last_visit"),
        )
    )


def customer_metrics(store_visits: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Average check, frequency, inactive period and churn; no churn rate at frequency zero."""
    last = F.max("last_visit")
    visits = F.sum("visits")
    return (
        store_visits.groupBy("customer_id")
        .agg(
            ratio(F.sum("turnover"), visits).alias("customer_average_check"),
            ratio(days_between(F.min("first_visit"), last), visits).alias("customer_frequency"),
            days_between(last, moment(as_of)).alias("customer_inactive_period"),
        )
        .withColumn(
            "customer_churn_rate",
            ratio(F.col("customer_inactive_period"), F.col("customer_frequency")),
        )
        .withColumn("customer_churn_segment", churn_segment(F.col("customer_churn_rate")))
    )


def churn_segment(rate: Column) -> Column:
    return F.when(rate <= 2, "Low").when(rate <= 5, "Medium").otherwise("High")


def check_order() -> list[Column]:
    return [F.col("customer_average_check").desc_nulls_last(), F.col("customer_id").asc()]


def frequency_order() -> list[Column]:
    return [F.col("customer_frequency").asc_nulls_last(), F.col("customer_id").asc()]


def share_segment(place: Column, size: Column, levels: tuple[str, str, str]) -> Column:
    """First tenth, next quarter and the rest, counted in whole customers."""
    low, middle, top = levels
    return (
        F.when(place * 100 <= size * TOP_SHARE, top)
        .when(place * 100 <= size * TOP_TWO_SHARE, middle)
        .otherwise(low)
    )


def with_check_segment(metrics: DataFrame) -> DataFrame:
    ranked = global_rank(metrics, check_order(), "_rank", "_size")
    segment = share_segment(F.col("_rank"), F.col("_size"), CHECK_LEVELS)
    return ranked.withColumn("customer_average_check_segment", segment).drop("_rank", "_size")


def with_frequency_segment(metrics: DataFrame) -> DataFrame:
    ranked = global_rank(metrics, frequency_order(), "_rank", "_size")
    segment = share_segment(F.col("_rank"), F.col("_size"), FREQUENCY_LEVELS)
    return ranked.withColumn("customer_frequency_segment", segment).drop("_rank", "_size")


def percentile_bucket(place: Column, size: Column, buckets: int = 100) -> Column:
    """Bucket number of a row by its global place, as NTILE would number it."""
    wide = size % buckets  # so many leading buckets hold one row more
    narrow_size = F.floor(size / buckets)
    in_wide = wide * (narrow_size + 1)
    return F.when(
        place <= in_wide, F.floor((place - 1) / (narrow_size + 1)) + 1
    ).otherwise(wide + F.floor(F.try_divide(place - in_wide - 1, narrow_size)) + 1)


def ntile_segments(metrics: DataFrame) -> DataFrame:
    """Variant: percentile buckets compared with shares of the customer count.

    Equal to the share segments for up to a hundred customers; with more of them the
    buckets stay at a hundred while the shares grow, and the first segment swallows all.
    """

    def bucketed(order: list[Column], column: str, levels: tuple[str, str, str]) -> DataFrame:
        needed = metrics.select("customer_id", "customer_average_check", "customer_frequency")
        ranked = global_rank(needed, order, "r", "n")
        bucket = percentile_bucket(F.col("r"), F.col("n"))
        return ranked.select(
            "customer_id",
            bucket.alias(f"{column}_bucket"),
            share_segment(bucket, F.col("n"), levels).alias(f"{column}_segment"),
        )

    checks = bucketed(check_order(), "check", CHECK_LEVELS)
    frequencies = bucketed(frequency_order(), "frequency", FREQUENCY_LEVELS)
    return checks.join(frequencies, "customer_id")


def segment_number(check: Column, frequency: Column, churn: Column) -> Column:
    """1 to 27: check counts nines, frequency threes, churn ones, each from the lowest level."""

    def level(value: Column, levels: tuple[str, str, str]) -> Column:
        return F.when(value == levels[0], 0).when(value == levels[1], 1).when(value == levels[2], 2)

    return (
        level(check, CHECK_LEVELS) * 9
        + level(frequency, FREQUENCY_LEVELS) * 3
        + level(churn, CHURN_LEVELS)
        + 1
    )


def with_segments(metrics: DataFrame) -> DataFrame:
    """Both share segments and the segment number."""
    segmented = with_frequency_segment(with_check_segment(metrics))
    number = segment_number(
        F.col("customer_average_check_segment"),
        F.col("customer_frequency_segment"),
        F.col("customer_churn_segment"),
    )
    return segmented.withColumn("customer_segment", number)


def store_shares(store_visits: DataFrame) -> DataFrame:
    """Share of a customer's transactions per store, and the last one there.

    The window sees one row per store of a customer, not one per transaction.
    """
    total = F.sum("visits").over(Window.partitionBy("customer_id"))
    return store_visits.select(
        "customer_id",
        "transaction_store_id",
        "visits",
        (ratio(F.col("visits"), total) * 100).alias("transaction_percentage"),
        F.when(F.col("transaction_store_id").isNotNull(), F.col("last_visit")).alias(
            "last_transaction"
        ),
    )


def last_three(tables: Tables) -> DataFrame:
    """Per customer: whether the last three transactions share a store, and the latest store."""
    transactions = customer_transactions(tables).drop("transaction_summ")
    recent = latest(transactions, ["customer_id"], "transaction_datetime", "transaction_id", 3)
    store = F.col("transaction_store_id")
    by_recency = F.struct("transaction_datetime", "transaction_id")
    return recent.groupBy("customer_id").agg(
        F.coalesce(F.min(store) == F.max(store), F.lit(False)).alias("loyal"),
        F.max_by(store, by_recency).alias("latest_store"),
    )


def loyal_customers(tables: Tables) -> DataFrame:
    return last_three(tables).where("loyal").select(
        "customer_id", F.col("latest_store").alias("loyal_store")
    )


def primary_stores(store_visits: DataFrame, loyal: DataFrame) -> DataFrame:
    """The loyal store, else the store of most transactions, else of the latest among those."""
    most_visited = first_per_key(
        store_shares(store_visits),
        ["customer_id"],
        [
            F.col("visits").desc(),
            F.col("last_transaction").desc_nulls_last(),
            F.col("transaction_store_id").asc_nulls_last(),
        ],
    )
    loyal = loyal.withColumn("_loyal", F.lit(True)).hint("merge")
    return most_visited.join(loyal, "customer_id", "left").select(
        "customer_id",
        F.when(F.col("_loyal"), F.col("loyal_store"))
        .otherwise(F.col("transaction_store_id"))
        .alias("customer_primary_store"),
    )


def customers_view(tables: Tables, as_of: dt.datetime) -> DataFrame:
    # Read twice: staged, it saves a scan and join of all transactions.
    visits = staged(store_visits(tables), "store-visits")
    metrics = customer_metrics(visits, as_of)
    if not isinstance(tables.transactions.schema["transaction_summ"].dataType, T.DecimalType):
        # Sums of doubles depend on their order. Ranks must not, should a lost task run again.
        metrics = staged(metrics, "metrics")
    segmented = with_segments(metrics)
    stores = primary_stores(visits, loyal_customers(tables))
    return segmented.join(stores, "customer_id").select(*CUSTOMER_COLUMNS)
