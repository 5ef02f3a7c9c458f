"""Hand-made tables of a few rows."""

from __future__ import annotations

import datetime as dt

from tallystick.sources.tables import SPECS, Tables

DEFAULTS = {
    "personal_details": [
        (1, "Anna", "Orlova", "anna@shop.com", "+79990000001"),
        (2, "Boris", "Smith", "boris@shop.com", "+79990000002"),
    ],
    "customer_cards": [(10, 1), (11, 1), (20, 2)],
    "sku_groups": [(1, "Tea"), (2, "Bread"), (3, "Milk")],
    "product_matrix": [
        (101, "Green tea", 1),
        (102, "Black tea", 1),
        (201, "Rye bread", 2),
        (301, "Milk", 3),
    ],
    "retail_stores": [
        (store, sku, cost, retail)
        for store in (1, 2, 3)
        for sku, cost, retail in (
            (101, 50.0, 100.0),
            (102, 40.0, 100.0),
            (201, 10.0, 20.0),
            (301, 30.0, 60.0),
        )
    ],
    "transactions": [],
    "checks": [],
    "analysis_formation": [(dt.datetime(2022, 8, 21, 12, 0, 0),)],
}

AS_OF = dt.datetime(2022, 8, 21, 12, 0, 0)


def at(day: int, hour: int = 0, minute: int = 0, month: int = 1) -> dt.datetime:
    return dt.datetime(2022, month, day, hour, minute)


def tables(spark, **rows) -> Tables:
    frames = {}
    for name, spec in SPECS.items():
        data = rows.get(name, DEFAULTS[name])
        frames[name] = spark.createDataFrame(data, spec.schema())
    return Tables(**frames)


def by(df, *keys):
    """Rows as dicts by key."""
    return {tuple(row[k] for k in keys): row.asDict() for row in df.collect()}
