"""Declarations of the eight input tables: types, keys and value rules."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields
from typing import ClassVar

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Value patterns of the data model (`\z` is the absolute end of the text).
PERSON_NAME = r"^([А-ЯA-Z][а-яa-z\- ]+)\z"
PERSON_NAME_ANY_CASE = r"(?iu)^([А-ЯA-Z][а-яa-z\- ]+)\z"
EMAIL = r"(?i)^[A-Za-z0-9._%-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,4}\z"
PHONE = r"^\+7[0-9]{10}\z"
PRODUCT_TEXT = r"^[A-Za-zА-Яа-я0-9\s\-+=@#$%^&*()\[\]{};:,.<>?/|_~]+\z"


@dataclass(frozen=True)
class Column:
    name: str
    kind: str  # "id", "money", "moment" or "text"
    required: bool = False
    max_length: int | None = None
    pattern: str | None = None
    lenient_pattern: str | None = None  # accepted when case is ignored
    minimum: int | None = None
    above: int | None = None  # exclusive lower bound


@dataclass(frozen=True)
class Reference:
    column: str
    table: str
    key: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    file_stem: str
    columns: tuple[Column, ...]
    identity: tuple[str, ...]  # what a report names a row by
    primary_key: str | None = None
    unique: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()

    def schema(self, money: T.DataType | None = None, as_text: bool = False) -> T.StructType:
        """Typed schema; ``as_text`` keeps moments as text for the parser to read."""
        types = {
            "id": T.LongType(),
            "money": money or T.DoubleType(),
            "moment": T.StringType() if as_text else T.TimestampNTZType(),
            "text": T.StringType(),
        }
        return T.StructType([T.StructField(c.name, types[c.kind], True) for c in self.columns])


def _id(name: str, required: bool = False) -> Column:
    return Column(name, "id", required=required)


def _money(name: str, minimum: int | None = 0, above: int | None = None) -> Column:
    return Column(name, "money", minimum=minimum, above=above)


# Listed so that every table comes after the tables it refers to.
SPECS: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            "personal_details",
            "Personal_Data",
            (
                _id("customer_id"),
                Column(
                    "customer_name",
                    "text",
                    max_length=100,
                    pattern=PERSON_NAME,
                    lenient_pattern=PERSON_NAME_ANY_CASE,
                ),
                Column(
                    "customer_surname",
                    "text",
                    max_length=100,
                    pattern=PERSON_NAME,
                    lenient_pattern=PERSON_NAME_ANY_CASE,
                ),
                Column("customer_primary_email", "text", max_length=100, pattern=EMAIL),
                Column("customer_primary_phone", "text", max_length=15, pattern=PHONE),
            ),
            identity=("customer_id",),
            primary_key="customer_id",
            unique=("customer_primary_email", "customer_primary_phone"),
        ),
        TableSpec(
            "customer_cards",
            "Cards",
            (_id("customer_card_id"), _id("customer_id")),
            identity=("customer_card_id",),
            primary_key="customer_card_id",
            references=(Reference("customer_id", "personal_details", "customer_id"),),
        ),
        TableSpec(
            "transactions",
            "Transactions",
            (
                _id("transaction_id"),
                _id("customer_card_id", required=True),
                _money("transaction_summ"),
                Column("transaction_datetime", "moment"),
                _id("transaction_store_id"),
            ),
            identity=("transaction_id",),
            primary_key="transaction_id",
            references=(Reference("customer_card_id", "customer_cards", "customer_card_id"),),
        ),
        TableSpec(
            "sku_groups",
            "Groups_SKU",
            (
                _id("group_id"),
                Column("group_name", "text", max_length=255, pattern=PRODUCT_TEXT),
            ),
            identity=("group_id",),
            primary_key="group_id",
        ),
        TableSpec(
            "product_matrix",
            "SKU",
            (
                _id("sku_id"),
                Column("sku_name", "text", max_length=255, pattern=PRODUCT_TEXT),
                _id("group_id"),
            ),
            identity=("sku_id",),
            primary_key="sku_id",
            references=(Reference("group_id", "sku_groups", "group_id"),),
        ),
        TableSpec(
            "checks",
            "Checks",
            (
                _id("transaction_id"),
                _id("sku_id", required=True),
                _money("sku_amount", minimum=None, above=0),
                _money("sku_summ"),
                _money("sku_summ_paid"),
                _money("sku_discount"),
            ),
            identity=("transaction_id", "sku_id"),
            references=(
                Reference("transaction_id", "transactions", "transaction_id"),
                Reference("sku_id", "product_matrix", "sku_id"),
            ),
        ),
        TableSpec(
            "retail_stores",
            "Stores",
            (
                _id("transaction_store_id"),
                _id("sku_id", required=True),
                _money("sku_purchase_price"),
                _money("sku_retail_price"),
            ),
            identity=("transaction_store_id", "sku_id"),
            references=(Reference("sku_id", "product_matrix", "sku_id"),),
        ),
        TableSpec(
            "analysis_formation",
            "Date_Of_Analysis_Formation",
            (Column("analysis_formation", "moment"),),
            identity=("analysis_formation",),
        ),
    )
}


# The names that import and export calls use for some tables.
ALIASES = {
    "personaldetails": "personal_details",
    "customercards": "customer_cards",
    "transaction": "transactions",
    "skugroups": "sku_groups",
    "productmatrix": "product_matrix",
    "retailstores": "retail_stores",
    "analysisformation": "analysis_formation",
    "dateofanalysisformation": "analysis_formation",
}


def spec_of(table_name: str) -> TableSpec:
    """By name or alias, whatever the case."""
    name = table_name.lower()
    return SPECS[ALIASES.get(name, name)]


@dataclass(frozen=True)
class Tables:
    """The eight logical tables as DataFrames, whatever they were read from."""

    # Whether both fact tables are stored bucketed by transaction, see ``sources.bucketed``.
    bucketed: ClassVar[bool] = False

    personal_details: DataFrame
    customer_cards: DataFrame
    transactions: DataFrame
    sku_groups: DataFrame
    product_matrix: DataFrame
    checks: DataFrame
    retail_stores: DataFrame
    analysis_formation: DataFrame

    def items(self) -> Iterator[tuple[str, DataFrame]]:
        return ((f.name, getattr(self, f.name)) for f in fields(self))

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)
