"""A star schema (customer, orders, lineitem, part) read as the eight loyalty tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystick.sources.tables import Tables

STORES = 5
MONEY = "decimal(18,4)"


def star_tables(spark: SparkSession, folder: str) -> Tables:
    """Lazy frames only; each query prunes them to the columns it uses."""

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")

    customer, orders, lineitem, part = map(read, ("customer", "orders", "lineitem", "part"))

    # Two cards per customer, told apart by the parity of the order key.
    card = F.col("o_custkey") * 2 + F.col("o_orderkey") % 2
    digits = F.regexp_extract("p_brand", r"(\d+)", 1).cast("long")
    summ = F.col("l_extendedprice").cast(MONEY)
    discount = (F.col("l_extendedprice") * F.col("l_discount")).cast(MONEY)
    margin_step = (F.col("p_partkey") + 7 * F.col("transaction_store_id")) % 40
    dotted = F.lower(F.regexp_replace("c_name", "#", "."))
    # The mail domain takes 2 to 5 letters of the market segment, by nation.
    domain = F.lower(F.expr("substr(c_mktsegment, 1, 2 + c_nationkey % 4)"))

    return Tables(
        personal_details=customer.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("customer_surname"),
            F.concat(dotted, F.lit("@shop."), domain).alias("customer_primary_email"),
            F.concat(
                F.lit("+7"), F.lpad(F.round("c_acctbal").cast("long").cast("string"), 10, "0")
            ).alias("customer_primary_phone"),
        ),
        customer_cards=orders.select(
            card.alias("customer_card_id"), F.col("o_custkey").alias("customer_id")
        ).distinct(),
        transactions=orders.select(
            F.col("o_orderkey").alias("transaction_id"),
            card.alias("customer_card_id"),
            F.col("o_totalprice").cast(MONEY).alias("transaction_summ"),
            F.col("o_orderdate").alias("transaction_datetime"),
            (F.col("o_orderkey") % STORES).alias("transaction_store_id"),
        ),
        sku_groups=part.select(
            digits.alias("group_id"), F.col("p_brand").alias("group_name")
        ).distinct(),
        product_matrix=part.select(
            F.col("p_partkey").alias("sku_id"),
            F.col("p_name").alias("sku_name"),
            digits.alias("group_id"),
        ),
        checks=lineitem.select(
            F.col("l_orderkey").alias("transaction_id"),
            F.col("l_partkey").alias("sku_id"),
            F.col("l_quantity").cast(MONEY).alias("sku_amount"),
            summ.alias("sku_summ"),
            (summ - discount).cast(MONEY).alias("sku_summ_paid"),
            discount.alias("sku_discount"),
        ),
        retail_stores=part.select(
            "p_partkey",
            "p_retailprice",
            F.explode(F.array(*[F.lit(store).cast("long") for store in range(STORES)])).alias(
                "transaction_store_id"
            ),
        ).select(
            "transaction_store_id",
            F.col("p_partkey").alias("sku_id"),
            (F.col("p_retailprice") * (50 + margin_step) / 100)
            .cast(MONEY)
            .alias("sku_purchase_price"),
            F.col("p_retailprice").cast(MONEY).alias("sku_retail_price"),
        ),
        analysis_formation=orders.agg(
            (F.max("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("analysis_formation")
        ),
    )
