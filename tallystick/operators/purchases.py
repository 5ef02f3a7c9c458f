"""Purchase lines, baskets and the purchase history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystick.functions.discounts import ratio
from tallystick.operators.ordering import dealt
from tallystick.sources.tables import Tables

HISTORY_COLUMNS = [
    "customer_id",
    "transaction_id",
    "transaction_datetime",
    "group_id",
    "group_cost",
    "group_summ",
    "group_summ_paid",
]


# Check lines, or rows made of them, of which a task keeps sums.
LINES_PER_TASK = 250_000


def parts_for(tables: Tables) -> int | None:
    """Into how many parts to deal the check lines; none if they are few for every core.

    Adaptive execution would merge partitions down to one per core or to a size in bytes on
    the wire, and sums and sorts of so many rows fill a task's memory.
    """
    parts = -(-tables.checks.count() // LINES_PER_TASK)
    return parts if parts > tables.checks.sparkSession.sparkContext.defaultParallelism else None


def card_owners(tables: Tables) -> DataFrame:
    """Cards of known customers."""
    return tables.customer_cards.join(
        tables.personal_details.select("customer_id").hint("merge"), "customer_id", "left_semi"
    ).select("customer_card_id", "customer_id")


def customer_transactions(tables: Tables, merged: bool = True) -> DataFrame:
    """Transactions of all cards of every known customer.

    Cards are merged: both sides grow with the data, and Spark would broadcast whichever is small
    on the wire, transactions included. They carry no hint if transactions lie bucketed by
    transaction, which then stay where they are as long as the cards are few.
    """
    owners = card_owners(tables)
    return tables.transactions.join(
        owners.hint("merge") if merged and not tables.bucketed else owners, "customer_card_id"
    ).drop("customer_card_id")


def check_lines(tables: Tables, price_join: str | None = None) -> DataFrame:
    """Check lines with customer, product group and, on request, the store's purchase price.

    The two fact tables are merged on the transaction, catalogue and prices on the SKU: they grow
    with the data and are far larger in memory than Spark takes them to be from the size of
    their files, so it would broadcast what neither the driver nor a task can hold.
    """
    lines = (
        customer_transactions(tables)
        .drop("transaction_summ")
        .join(tables.checks.hint("merge"), "transaction_id")
        .join(tables.product_matrix.select("sku_id", "group_id").hint("merge"), "sku_id")
    )
    if price_join is None:
        return lines
    prices = tables.retail_stores.select(
        "transaction_store_id", "sku_id", "sku_purchase_price", F.lit(True).alias("priced")
    )
    return lines.join(prices.hint("merge"), ["transaction_store_id", "sku_id"], price_join)


def _by_transaction(lines: DataFrame, parts: int | None) -> DataFrame:
    """Check lines with prices, dealt by transaction to tasks of a bounded number of lines."""
    return dealt(lines, ["customer_id", "transaction_id"], parts)


_GRAIN = ["customer_id", "transaction_id", "transaction_datetime", "group_id"]


def _line_margin(lines: DataFrame) -> Column:
    """Paid minus cost of a line; decimals keep all digits of the product of two amounts.

    The difference of the sums would not: its type has no room for them and rounds.
    """
    cost = F.col("sku_purchase_price") * F.col("sku_amount")
    if isinstance(lines.schema["sku_purchase_price"].dataType, T.DecimalType):
        cost = cost.cast(T.DecimalType(28, 8))
    return F.col("sku_summ_paid") - cost


def margin_history(tables: Tables) -> DataFrame:
    """The purchase history with the exact margin of every basket, ``basket_margin``."""
    lines = _by_transaction(check_lines(tables, "inner"), parts_for(tables))
    return lines.groupBy(*_GRAIN).agg(
        F.sum(F.col("sku_purchase_price") * F.col("sku_amount")).alias("group_cost"),
        F.sum("sku_summ").alias("group_summ"),
        F.sum("sku_summ_paid").alias("group_summ_paid"),
        F.sum(_line_margin(lines)).alias("basket_margin"),
    )


def purchase_history(tables: Tables) -> DataFrame:
    """One row per transaction and product group; lines without a store price fall out."""
    return margin_history(tables).select(*HISTORY_COLUMNS)


def baskets(tables: Tables) -> DataFrame:
    """The purchase history plus what the lines say about discounts, in one pass.

    See ``baskets_of`` for the columns.
    """
    return baskets_of(basket_lines(tables), parts_for(tables))


def basket_lines(tables: Tables) -> DataFrame:
    """Every check line with a price where there is one: what baskets are summed from."""
    lines = check_lines(tables, "left")
    return lines.drop("transaction_store_id", "sku_id")


def baskets_of(lines: DataFrame, parts: int | None = None) -> DataFrame:
    """The baskets of ``basket_lines``, dealt into ``parts_for`` their tables.

    Costs and sums count priced lines only, discounts count every line. A basket
    without any priced line (``priced_lines`` = 0) is not part of the history.
    """
    priced = F.col("priced")
    line_ratio = ratio(F.col("sku_discount"), F.col("sku_summ"))
    lines = _by_transaction(lines, parts)
    return (
        lines.withColumn("line_ratio", line_ratio)
        .groupBy(*_GRAIN)
        .agg(
            F.sum(F.col("sku_purchase_price") * F.col("sku_amount")).alias("group_cost"),
            F.sum(F.when(priced, F.col("sku_summ"))).alias("group_summ"),
            F.sum(F.when(priced, F.col("sku_summ_paid"))).alias("group_summ_paid"),
            F.sum(_line_margin(lines)).alias("basket_margin"),
            F.count("priced").alias("priced_lines"),
            F.count(F.when(F.col("sku_discount") > 0, 1)).alias("discounted_lines"),
            F.max("line_ratio").alias("greatest_ratio"),
            F.min(F.when(F.col("line_ratio") > 0, F.col("line_ratio"))).alias("least_ratio"),
        )
    )


def history_of(baskets: DataFrame, *further: str) -> DataFrame:
    """The purchase history kept inside the baskets, on request with further columns."""
    return baskets.where(F.col("priced_lines") > 0).select(*HISTORY_COLUMNS, *further)
