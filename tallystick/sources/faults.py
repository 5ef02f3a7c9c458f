"""The input tables with documented faults, so that every quality rule has rows that break it.

A fault is tied to a remainder of the row's key; all other rows stay as they are. Some names
are made to pass the strict pattern as well.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystick.sources.tables import Tables

FAR = 100_000_000  # beyond every key


def _changed(df: DataFrame, column: str, *faults: tuple[Column, Column | str | None]) -> Column:
    """The column with the first fault whose condition holds."""
    value = F.col(column)
    for condition, wrong in reversed(faults):
        new = wrong if isinstance(wrong, Column) else F.lit(wrong)
        value = F.when(condition, new.cast(df.schema[column].dataType)).otherwise(value)
    return value.alias(column)


def _with_faults(df: DataFrame, **faults: list[tuple[Column, Column | str | None]]) -> DataFrame:
    return df.select(*[_changed(df, c, *faults.get(c, [])) for c in df.columns])


def faulty(tables: Tables) -> Tables:
    customer, card, transaction, group, sku = (
        F.col(f"{name}_id") for name in ("customer", "customer_card", "transaction", "group", "sku")
    )
    line = transaction + sku
    price = F.col("transaction_store_id") + sku
    return replace(
        tables,
        personal_details=_with_faults(
            tables.personal_details,
            customer_id=[(customer % 29 == 5, customer - 1), (customer % 31 == 6, None)],
            customer_name=[(customer % 13 == 1, "A" * 101), (customer % 5 == 0, "Anna")],
            customer_surname=[(customer % 17 == 2, "B" * 120), (customer % 7 == 0, "Smith")],
            customer_primary_email=[
                (customer % 19 == 3, "c" * 100 + "@shop.ru"),
                (customer % 37 == 7, "same@shop.com"),
            ],
            customer_primary_phone=[(customer % 23 == 4, "+7" + "1" * 20)],
        ),
        customer_cards=_with_faults(
            tables.customer_cards,
            customer_card_id=[(card % 41 == 8, card - 1), (card % 47 == 1, None)],
            customer_id=[(customer % 43 == 9, customer + FAR)],
        ),
        transactions=_with_faults(
            tables.transactions,
            transaction_id=[(transaction % 61 == 3, transaction - 1)],
            customer_card_id=[(transaction % 53 == 1, None), (transaction % 59 == 2, card + FAR)],
            transaction_summ=[(transaction % 47 == 0, -F.col("transaction_summ"))],
        ),
        sku_groups=_with_faults(
            tables.sku_groups,
            group_id=[(group == 5, F.lit(6)), (group == 7, None)],
            group_name=[(group == 3, "Tea!"), (group == 4, "n" * 300)],
        ),
        product_matrix=_with_faults(
            tables.product_matrix,
            sku_id=[(sku % 41 == 3, sku - 1)],
            sku_name=[(sku % 31 == 1, 'the "best"'), (sku % 37 == 2, "n" * 300)],
            group_id=[(sku % 43 == 4, F.lit(999))],
        ),
        checks=_with_faults(
            tables.checks,
            transaction_id=[(line % 53 == 5, transaction + FAR)],
            sku_id=[(line % 47 == 4, None), (line % 59 == 6, sku + FAR)],
            sku_amount=[(line % 31 == 0, F.lit(0))],
            sku_summ=[(line % 37 == 1, F.lit(-1))],
            sku_summ_paid=[(line % 41 == 2, F.lit(-2))],
            sku_discount=[(line % 43 == 3, F.lit(-3))],
        ),
        retail_stores=_with_faults(
            tables.retail_stores,
            sku_id=[(price % 41 == 2, None), (price % 43 == 3, sku + FAR)],
            sku_purchase_price=[(price % 31 == 0, F.lit(-4))],
            sku_retail_price=[(price % 37 == 1, F.lit(-5))],
        ),
    )
