"""Violation reports on rows a constrained database would refuse."""

from __future__ import annotations

import pathlib

import pytest

from tallystick.operators import quality
from tallystick.sources.faults import faulty as with_faults
from tallystick.sources.star import star_tables
from tests.small import at, tables


def reported(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def faulty(spark):
    return tables(
        spark,
        personal_details=[
            (1, "Anna", "Orlova", "a@shop.com", "+79990000001"),
            (2, "anna", "Лев-Гор", "a@shop.com", "+79990000001"),
            (2, "ЛЕВ", "O'Neil", "no-mail", "89990000001"),
            (None, None, None, None, None),
            (5, "A" * 101, "Anna", "x@y.toolong", None),
        ],
        customer_cards=[(10, 1), (11, 77), (12, None)],
        sku_groups=[(1, "Tea & milk (0.5l) ~ 50%"), (2, "Bad!"), (3, "")],
        product_matrix=[(101, "Чай", 1), (102, None, 9)],
        transactions=[
            (1, 10, -0.5, at(1), 1),
            (2, 99, 0.0, at(1), 1),
            (3, None, None, None, None),
        ],
        checks=[
            (1, 101, 0.0, -1.0, 0.0, None),
            (1, 555, 1.0, 1.0, -2.0, -3.0),
            (8, None, 1.0, 1.0, 1.0, 0.0),
        ],
        retail_stores=[(1, 101, -1.0, 0.0), (2, 666, 1.0, -0.25)],
    )


def test_ranges(faulty):
    assert reported(quality.range_violations(faulty)) == [
        ("checks", "sku_amount > 0", "1|101", "0.0"),
        ("checks", "sku_discount >= 0", "1|555", "-3.0"),
        ("checks", "sku_summ >= 0", "1|101", "-1.0"),
        ("checks", "sku_summ_paid >= 0", "1|555", "-2.0"),
        ("retail_stores", "sku_purchase_price >= 0", "1|101", "-1.0"),
        ("retail_stores", "sku_retail_price >= 0", "2|666", "-0.25"),
        ("transactions", "transaction_summ >= 0", "1", "-0.5"),
    ]


def test_patterns(faulty):
    strict = reported(quality.pattern_violations(faulty))
    assert strict == [
        ("personal_details", "customer_name pattern", "2", "anna"),
        ("personal_details", "customer_name pattern", "2", "ЛЕВ"),
        ("personal_details", "customer_name pattern", "5", "A" * 101),
        ("personal_details", "customer_primary_email pattern", "2", "no-mail"),
        ("personal_details", "customer_primary_email pattern", "5", "x@y.toolong"),
        ("personal_details", "customer_primary_phone pattern", "2", "89990000001"),
        ("personal_details", "customer_surname pattern", "2", "O'Neil"),
        ("personal_details", "customer_surname pattern", "2", "Лев-Гор"),
        ("sku_groups", "group_name pattern", "2", "Bad!"),
        ("sku_groups", "group_name pattern", "3", ""),
    ]
    lenient = reported(quality.pattern_violations(faulty, any_case=True))
    assert [r for r in lenient if r[1] == "customer_name pattern"] == []
    assert [r[3] for r in lenient if r[1] == "customer_surname pattern"] == ["O'Neil"]


def test_missing_and_long_values(faulty):
    assert reported(quality.missing_values(faulty).na.fill("-")) == [
        ("checks", "sku_id not null", "8|NULL", "-"),
        ("transactions", "customer_card_id not null", "3", "-"),
    ]
    assert reported(quality.length_violations(faulty)) == [
        ("personal_details", "customer_name length <= 100", "5", "A" * 101)
    ]


def test_unique(faulty):
    assert reported(quality.unique_violations(faulty)) == [
        ("personal_details", "customer_id primary key", "2", "2"),
        ("personal_details", "customer_id primary key", "NULL", "1"),
        ("personal_details", "customer_primary_email unique", "a@shop.com", "2"),
        ("personal_details", "customer_primary_phone unique", "+79990000001", "2"),
    ]


def test_references(faulty):
    assert reported(quality.reference_violations(faulty)) == [
        ("checks", "sku_id in product_matrix", "555", "1"),
        ("checks", "transaction_id in transactions", "8", "1"),
        ("customer_cards", "customer_id in personal_details", "77", "1"),
        ("product_matrix", "group_id in sku_groups", "9", "1"),
        ("retail_stores", "sku_id in product_matrix", "666", "1"),
        ("transactions", "customer_card_id in customer_cards", "99", "1"),
    ]


def test_all_rules_together(faulty):
    parts = [
        quality.range_violations(faulty),
        quality.pattern_violations(faulty),
        quality.missing_values(faulty),
        quality.length_violations(faulty),
        quality.unique_violations(faulty),
        quality.reference_violations(faulty),
    ]
    expected = sorted(str(tuple(r)) for part in parts for r in part.collect())
    assert sorted(str(tuple(r)) for r in quality.violations(faulty).collect()) == expected


def test_counts_agree_with_reports(faulty):
    counts = {(r.table, r.rule): r for r in quality.rule_counts(faulty).collect()}
    found: dict[tuple[str, str], int] = {}
    rowwise = {"unique", "key"}
    for row in quality.violations(faulty).collect():
        weight = int(row.value) if row.rule.split()[-1] in rowwise or " in " in row.rule else 1
        found[row.table, row.rule] = found.get((row.table, row.rule), 0) + weight
    assert {k: r.broken for k, r in counts.items() if r.broken} == found
    assert counts["checks", "sku_amount > 0"].rows == 3


def test_every_rule_is_broken_by_the_faulty_tables(spark):
    folder = pathlib.Path("/root/testdata/sf0.01")
    if not folder.exists():
        pytest.skip("no test data on this machine")
    counts = quality.rule_counts(with_faults(star_tables(spark, str(folder)))).collect()
    assert len(counts) == 35
    assert all(0 < r.broken < r.rows for r in counts)
