"""Edge cases of the views on hand-made tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallystick.functions.calendar import days_between, hour_slot
from tallystick.functions.discounts import step_up
from tallystick.operators import customers, groups, periods, purchases
from tests.small import AS_OF, at, by, tables


def days(start: dt.datetime, end: dt.datetime) -> float:
    return (end - start).total_seconds() / 86400


def line(transaction, sku, amount=1.0, summ=100.0, paid=None, discount=0.0):
    return (transaction, sku, amount, summ, summ - discount if paid is None else paid, discount)


def test_history_sums_lines_per_transaction_and_group(spark):
    t = tables(
        spark,
        transactions=[(1, 10, 300.0, at(1), 1), (2, 11, 100.0, at(2), 9)],
        checks=[
            line(1, 101, 2.0, 200.0, discount=20.0),
            line(1, 102, 1.0, 100.0),
            line(1, 101, 1.0, 100.0),  # the same SKU twice in a check
            line(1, 201, 3.0, 60.0),
            line(2, 101),  # store 9 has no prices
        ],
    )
    rows = by(purchases.purchase_history(t), "transaction_id", "group_id")
    assert set(rows) == {(1, 1), (1, 2)}
    assert rows[1, 1]["customer_id"] == 1
    assert rows[1, 1]["group_cost"] == 2 * 50 + 40 + 50
    assert rows[1, 1]["group_summ"] == 400 and rows[1, 1]["group_summ_paid"] == 380
    assert rows[1, 2]["group_cost"] == 30


def test_two_prices_for_a_store_and_sku_fan_out(spark):
    t = tables(
        spark,
        transactions=[(1, 10, 100.0, at(1), 1)],
        checks=[line(1, 101, discount=10.0)],
        retail_stores=[(1, 101, 50.0, 100.0), (1, 101, 60.0, 100.0)],
    )
    (row,) = purchases.purchase_history(t).collect()
    assert (row.group_cost, row.group_summ, row.group_summ_paid) == (110.0, 200.0, 180.0)
    assert purchases.history_of(purchases.baskets(t)).collect() == [row]
    (profile,) = periods.pair_profiles(purchases.baskets(t)).collect()
    assert profile.group_purchase == 1 and profile.discounted_transactions == 1


def test_baskets_hold_the_same_history(spark):
    t = tables(
        spark,
        transactions=[(n, 10 + n % 2, 100.0, at(n), 1 + n % 4) for n in range(1, 9)],
        checks=[line(n, s, discount=float(n)) for n in range(1, 9) for s in (101, 201)],
    )
    direct = sorted(map(tuple, purchases.purchase_history(t).collect()))
    kept = sorted(map(tuple, purchases.history_of(purchases.baskets(t)).collect()))
    assert direct == kept and direct


def test_unpriced_lines_still_tell_discounts(spark):
    t = tables(
        spark,
        transactions=[(1, 10, 100.0, at(1), 1), (2, 10, 100.0, at(3), 9)],
        checks=[line(1, 101), line(2, 101, discount=5.0)],
    )
    (row,) = periods.periods(purchases.baskets(t)).collect()
    assert row.group_purchase == 1 and row.group_frequency == 1.0
    assert row.group_min_discount == pytest.approx(0.05)


def test_period_of_one_and_of_several_purchases(spark):
    t = tables(
        spark,
        transactions=[(1, 10, 1.0, at(1), 1), (2, 11, 1.0, at(11, 12), 2), (3, 20, 1.0, at(5), 1)],
        checks=[line(1, 101, discount=10.0), line(2, 102, discount=30.0), line(3, 201)],
    )
    rows = by(periods.periods(purchases.baskets(t)), "customer_id", "group_id")
    both = rows[1, 1]
    assert both["first_group_purchase_date"] == at(1)
    assert both["last_group_purchase_date"] == at(11, 12)
    assert both["group_purchase"] == 2
    assert both["group_frequency"] == pytest.approx((10.5 + 1) / 2)
    assert both["group_min_discount"] == pytest.approx(0.1)
    assert rows[2, 2]["group_frequency"] == 1.0
    assert rows[2, 2]["group_min_discount"] == 0.0


def test_zero_price_lines_have_no_ratio(spark):
    t = tables(
        spark,
        transactions=[(1, 10, 1.0, at(1), 1)],
        checks=[line(1, 101, summ=0.0, paid=0.0, discount=0.0), line(1, 102, discount=20.0)],
    )
    (row,) = periods.periods(purchases.baskets(t)).collect()
    assert row.group_min_discount == pytest.approx(0.2)


def test_customer_with_one_transaction_has_no_churn_rate(spark):
    t = tables(spark, transactions=[(1, 20, 50.0, at(1), 2)])
    (row,) = customers.customers_view(t, AS_OF).collect()
    assert row.customer_frequency == 0
    assert row.customer_churn_rate is None
    assert row.customer_churn_segment == "High"
    assert row.customer_average_check == 50
    assert row.customer_inactive_period == pytest.approx(days(at(1), AS_OF))
    assert row.customer_primary_store == 2


def test_customers_without_transactions_or_owner_are_absent(spark):
    t = tables(
        spark,
        customer_cards=[(10, 1), (11, None), (12, 99)],
        transactions=[(1, 10, 50.0, at(1), 2), (2, 11, 50.0, at(1), 2), (3, 12, 50.0, at(1), 2)],
    )
    assert [r.customer_id for r in customers.customers_view(t, AS_OF).collect()] == [1]


def test_cards_of_a_customer_add_up(spark):
    t = tables(
        spark,
        transactions=[(1, 10, 100.0, at(1), 1), (2, 11, 200.0, at(11), 1), (3, 11, 300.0, at(6), 2)],
    )
    (row,) = customers.customers_view(t, AS_OF).collect()
    assert row.customer_average_check == 200
    assert row.customer_frequency == pytest.approx(10 / 3)
    assert row.customer_churn_rate == pytest.approx(days(at(11), AS_OF) / (10 / 3))


def _stores(spark, visits):
    t = tables(
        spark, transactions=[(n, card, 1.0, when, store) for n, card, when, store in visits]
    )
    stores = customers.primary_stores(customers.store_visits(t), customers.loyal_customers(t))
    return {r.customer_id: r.customer_primary_store for r in stores.collect()}


def test_three_last_visits_outweigh_the_greatest_share(spark):
    visits = [(n, 10, at(n), 1) for n in range(1, 6)] + [(n, 11, at(n), 2) for n in range(6, 9)]
    assert _stores(spark, visits) == {1: 2}


def test_several_loyal_customers(spark):
    visits = [(n, 10, at(n), 1) for n in range(1, 4)] + [(n, 20, at(n), 3) for n in range(4, 7)]
    assert _stores(spark, visits) == {1: 1, 2: 3}


def test_greatest_share_then_latest_visit_then_lowest_store(spark):
    share = [(1, 10, at(1), 1), (2, 10, at(2), 1), (3, 10, at(3), 1), (4, 10, at(4), 2)]
    assert _stores(spark, share) == {1: 1}
    tied = [(1, 10, at(1), 1), (2, 10, at(2), 2), (3, 10, at(3), 2), (4, 10, at(4), 1)]
    assert _stores(spark, tied) == {1: 1}
    equal = [(1, 10, at(1), 3), (2, 10, at(1), 2)]
    assert _stores(spark, equal) == {1: 2}


def test_equal_moments_take_the_higher_transaction_as_later(spark):
    # Transactions 2, 3 and 4 share a moment with 1; the last three are 2, 3 and 4.
    visits = [(1, 10, at(1), 1), (2, 10, at(1), 2), (3, 10, at(1), 2), (4, 10, at(1), 2)]
    t = tables(spark, transactions=[(n, c, 1.0, w, s) for n, c, w, s in visits])
    assert [tuple(r) for r in customers.loyal_customers(t).collect()] == [(1, 2)]


def test_segment_numbers_cover_1_to_27(spark):
    rows = [
        (a, b, c)
        for a in customers.CHECK_LEVELS
        for b in customers.FREQUENCY_LEVELS
        for c in customers.CHURN_LEVELS
    ]
    frame = spark.createDataFrame(rows, "a string, b string, c string").coalesce(1)
    number = customers.segment_number(F.col("a"), F.col("b"), F.col("c"))
    numbers = {(r.a, r.b, r.c): r.n for r in frame.select("a", "b", "c", number.alias("n")).collect()}
    assert sorted(numbers.values()) == list(range(1, 28))
    assert numbers["Low", "Rarely", "Low"] == 1
    assert numbers["Medium", "Rarely", "Low"] == 10
    assert numbers["Low", "Occasionally", "Low"] == 4
    assert numbers["High", "Often", "High"] == 27


def _groups(spark, margin=None, **rows):
    baskets = purchases.baskets(tables(spark, **rows))
    return by(groups.groups_view(baskets, AS_OF, margin), "customer_id", "group_id")


def test_affinity_counts_transactions_of_other_groups_once(spark):
    rows = _groups(
        spark,
        transactions=[(n, 10, 1.0, at(n), 1) for n in range(1, 6)],
        checks=[
            line(1, 201),
            line(2, 101),
            line(3, 201),
            line(3, 301),  # one transaction, two groups
            line(4, 101),
            line(5, 201),
        ],
    )
    assert rows[1, 1]["group_affinity_index"] == pytest.approx(2 / 3)
    assert rows[1, 2]["group_affinity_index"] == pytest.approx(3 / 5)
    assert rows[1, 3]["group_affinity_index"] == 1.0


def test_stability_of_one_two_and_tied_purchases(spark):
    rows = _groups(
        spark,
        transactions=[
            (1, 10, 1.0, at(1), 1),
            (2, 10, 1.0, at(1), 1),
            (3, 10, 1.0, at(1, 0, 30), 1),
            (4, 10, 1.0, at(9), 1),
        ],
        checks=[*(line(n, 101) for n in (1, 2, 3, 4)), line(1, 201), line(4, 301), line(3, 301)],
    )
    assert rows[1, 2]["group_stability_index"] is None
    frequency = (8 + 1) / 4
    gaps = [0.0, days(at(1), at(1, 0, 30)), days(at(1, 0, 30), at(9))]
    expected = sum(abs(g - frequency) / frequency for g in gaps) / 3
    assert rows[1, 1]["group_stability_index"] == pytest.approx(expected)
    gap = days(at(1, 0, 30), at(9))
    frequency = (gap + 1) / 2
    assert rows[1, 3]["group_stability_index"] == pytest.approx(abs(gap - frequency) / frequency)


def test_intervals_list_one_row_per_gap(spark):
    t = tables(
        spark,
        transactions=[(1, 10, 1.0, at(1), 1), (2, 10, 1.0, at(1), 1), (3, 10, 1.0, at(4), 1)],
        checks=[line(n, 101) for n in (1, 2, 3)],
    )
    rows = by(groups.group_intervals(purchases.purchase_history(t)), "transaction_id")
    assert {k: r["gap"] for k, r in rows.items()} == {(2,): 0.0, (3,): 3.0}
    assert rows[(3,)]["deviation"] == pytest.approx(abs(3 - 4 / 3))


def test_pair_never_reduced_is_kept_without_discounts(spark):
    rows = _groups(spark, transactions=[(1, 10, 1.0, at(1), 1)], checks=[line(1, 101)])
    row = rows[1, 1]
    assert row["group_discount_share"] == 0
    assert row["group_minimum_discount"] is None and row["group_average_discount"] is None


def test_discount_share_counts_transactions_not_lines(spark):
    checks = [line(1, 101, discount=10.0), line(1, 102, discount=40.0), line(2, 101)]
    transactions = [(1, 10, 1.0, at(1), 1), (2, 10, 1.0, at(2), 1)]
    row = _groups(spark, transactions=transactions, checks=checks)[1, 1]
    assert row["group_discount_share"] == 0.5
    assert row["group_minimum_discount"] == pytest.approx(0.1)
    assert row["group_average_discount"] == pytest.approx(150 / 200)
    profiles = periods.pair_profiles(
        purchases.baskets(tables(spark, transactions=transactions, checks=checks))
    )
    (as_lines,) = groups.group_discount_shares(profiles, every_line=True).collect()
    assert as_lines.group_discount_share == 1.0


def test_margin_rules(spark):
    rows = {
        "transactions": [(n, 10, 1.0, at(n, month=8), 1) for n in (1, 11, 21)],
        "checks": [line(1, 101, 1.0, 100.0), line(11, 101, 1.0, 90.0), line(21, 101, 1.0, 70.0)],
    }

    def margin(rule):
        return _groups(spark, rule, **rows)[1, 1]["group_margin"]

    assert margin(None) == 50 + 40 + 20
    assert margin(groups.MarginRule(1, 11)) == 40 + 20
    assert margin(groups.MarginRule(1, 10**6)) == 110
    assert margin(groups.MarginRule(2, 1)) == 20
    assert margin(groups.MarginRule(2)) == 110
    # The window opens after the limit, not at it.
    history = purchases.purchase_history(tables(spark, **rows))
    exact = dt.datetime(2022, 8, 21)
    opened = groups.group_margins(history, groups.MarginRule(1, 10), exact).collect()
    assert [r.group_margin for r in opened] == [20]
    with pytest.raises(ValueError):
        groups.MarginRule(3)


def test_days_do_not_depend_on_the_session_time_zone(spark):
    rows = [(dt.datetime(2021, 3, 14, 2, 30), dt.datetime(2021, 3, 15, 2, 30, 0, 864))]
    frame = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz").coalesce(1)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = frame.select(
            days_between(F.col("a"), F.col("b")).alias("d"),
            (hour_slot(F.col("b")) - hour_slot(F.col("a"))).alias("h"),
            hour_slot(F.lit(None).cast("timestamp_ntz")).alias("missing"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row.d == 1.00000001 and row.h == 24 and row.missing < -(10**14)


def test_step_up_ignores_binary_noise(spark):
    shares = [0.05, 0.05000000000001, 0.051, 0.15000000000000002, 0.0001, 0.3]
    frame = spark.createDataFrame([(s,) for s in shares], "s double").coalesce(1)
    assert [r.d for r in frame.select(step_up(F.col("s")).alias("d")).collect()] == [
        5, 5, 10, 15, 5, 30,
    ]
