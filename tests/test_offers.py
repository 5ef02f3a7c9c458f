"""Offer generators: parameters, limits and invariants."""

from __future__ import annotations

import datetime as dt

import pytest

from tallystick import LoyaltyModel
from tallystick.functions.calendar import to_datetime
from tallystick.operators import groups, offers
from tallystick.operators.offers import AverageCheck, CrossSell, Reward
from tallystick.sources.star import star_tables
from tests.small import AS_OF, at, by, tables
from tests.test_views import line

GROUPS = (
    "customer_id long, group_id long, group_affinity_index double, group_churn_rate double, "
    "group_stability_index double, group_discount_share double, group_minimum_discount double, "
    "average_summ double, average_cost double"
)


def pair(customer, group, affinity=0.5, churn=1.0, stability=0.2, share=0.1, least=0.08,
         summ=150.0, cost=100.0):
    return (customer, group, affinity, churn, stability, share, least, summ, cost)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), GROUPS)


def chosen(spark, *rows, reward=Reward(3, 70, 30)):
    best = offers.best_groups(offers.eligible_groups(frame(spark, *rows), reward))
    return {r.customer_id: (r.group_id, r.offer_discount_depth) for r in best.collect()}


def test_best_group_has_the_greatest_affinity_that_passes_everything(spark):
    got = chosen(
        spark,
        pair(1, 1, affinity=0.9, churn=3.1),  # churn too high
        pair(1, 2, affinity=0.8, share=0.7),  # share not below the limit
        pair(1, 3, affinity=0.7, summ=110.0),  # cap 3 per cent, least discount 10
        pair(1, 4, affinity=0.6, least=None),  # never reduced
        pair(1, 5, affinity=0.5, churn=3.0),  # churn at the limit passes
        pair(1, 6, affinity=0.4),
        pair(2, 8, affinity=0.4),
        pair(2, 7, affinity=0.4),  # equal affinity: the lower group
        pair(3, 1, cost=0.0),  # no cap without cost
    )
    assert got == {1: (5, 10), 2: (7, 10)}


def test_discount_must_stay_below_the_cap(spark):
    # (110 - 100) * 50 / 100 = 5 per cent: a rounded least discount of 5 does not pass.
    assert chosen(spark, pair(1, 1, least=0.03, summ=110.0), reward=Reward(3, 70, 50)) == {}
    assert chosen(spark, pair(1, 1, least=0.03, summ=110.1), reward=Reward(3, 70, 50)) == {1: (1, 5)}


def _target(spark, check, transactions):
    t = tables(spark, transactions=transactions)
    return {
        r.customer_id: r.required_check_measure
        for r in offers.target_checks(t, check).collect()
    }


TRANSACTIONS = [
    (1, 10, 100.0, at(1), 1),
    (2, 11, 200.0, at(2), 1),
    (3, 10, 300.0, at(3), 1),
    (4, 11, 500.0, at(3), 1),
    (5, 20, 40.0, at(20), 1),
]


def test_target_check_of_the_latest_transactions(spark):
    check = AverageCheck(2, quantity=2, coefficient=1.5)
    assert _target(spark, check, TRANSACTIONS) == {1: 600.0, 2: 60.0}
    assert _target(spark, AverageCheck(2, quantity=1, coefficient=1), TRANSACTIONS)[1] == 500


def test_target_check_of_a_period(spark):
    def period(start, end):
        check = AverageCheck(1, start=start, end=end, coefficient=1)
        return _target(spark, check, TRANSACTIONS)

    assert period(dt.date(2022, 1, 1), dt.date(2022, 1, 2)) == {1: 150.0}
    # Both dates outside: the whole analysed period.
    assert period(dt.date(1990, 1, 1), dt.date(2050, 1, 1)) == {1: 275.0, 2: 40.0}
    # Wholly before or after the analysed period: nothing is selected.
    assert period(dt.date(2040, 1, 1), dt.date(2050, 1, 1)) == {}
    assert period(dt.date(1990, 1, 1), dt.date(1991, 1, 1)) == {}
    assert period(dt.date(2022, 1, 20), dt.date(2050, 1, 1)) == {2: 40.0}


def test_transactions_without_a_sum_are_left_out_of_the_average(spark):
    rows = [(1, 10, 100.0, at(1), 1), (2, 10, None, at(2), 1), (3, 20, None, at(2), 1)]
    assert _target(spark, AverageCheck(2, quantity=5, coefficient=2), rows) == {1: 200.0, 2: None}


def test_growth_offers_survive_tiny_frequencies(spark):
    t = tables(spark)
    eligible = offers.eligible_groups(frame(spark, pair(1, 1)), Reward(3, 70, 30))
    eligible = offers.best_groups(eligible)
    customers = spark.createDataFrame(
        [(1, 0.0005 / 86_400)], "customer_id long, customer_frequency double"
    )
    rows = offers.visit_growth_offers(t, eligible, customers, at(1), at(21), 1).collect()
    assert rows[0].required_transactions_count == 20 * 86_400 * 2000 + 1


def test_growth_period_must_run_forward(spark):
    with pytest.raises(ValueError):
        offers.visit_growth_offers(tables(spark), None, None, at(11), at(1), 1)


def test_all_latest_transactions_equal_the_whole_period(spark):
    everything = AverageCheck(2, quantity=1000)
    period = AverageCheck(1, start=dt.date(1990, 1, 1), end=dt.date(2050, 1, 1))
    assert _target(spark, everything, TRANSACTIONS) == _target(spark, period, TRANSACTIONS)


def test_parameters_are_checked():
    with pytest.raises(ValueError):
        AverageCheck(1, start=dt.date(2022, 1, 2), end=dt.date(2022, 1, 2))
    with pytest.raises(ValueError):
        AverageCheck(1)
    with pytest.raises(ValueError):
        AverageCheck(2, quantity=0)
    with pytest.raises(ValueError):
        AverageCheck(3)
    with pytest.raises(ValueError):
        CrossSell(number_of_groups=0)


def test_dates_may_be_texts(spark):
    as_text = AverageCheck(1, start="01.01.2022", end="2.1.2022 0:00:00", coefficient=1)
    as_dates = AverageCheck(
        1, start=dt.date(2022, 1, 1), end=dt.date(2022, 1, 2), coefficient=1
    )
    assert _target(spark, as_text, TRANSACTIONS) == _target(spark, as_dates, TRANSACTIONS)
    assert to_datetime("2022-06-20T01:02:03.5") == dt.datetime(2022, 6, 20, 1, 2, 3, 500000)
    assert to_datetime("20/06/2022 1:02") == dt.datetime(2022, 6, 20, 1, 2)
    for wrong in ("20.13.2022", "soon"):
        with pytest.raises(ValueError):
            to_datetime(wrong)


def test_margin_of_one_pair(model):
    every = {(r.customer_id, r.group_id): r.group_margin for r in model.group_margins().collect()}
    customer, group = min(every)
    (row,) = model.group_margins(customer_id=customer, group_id=group).collect()
    assert row.group_margin == every[customer, group]


def test_method_must_match_its_arguments(spark):
    model = LoyaltyModel(spark, tables(spark), AS_OF)
    with pytest.raises(ValueError):
        model.generate_personal_offer(1, 100, 1.15, 3, 70, 30)
    with pytest.raises(ValueError):
        model.generate_personal_offer(2, dt.date(2022, 1, 1), dt.date(2022, 2, 1), 1.15, 3, 70, 30)


def test_average_check_offer_names_the_group(spark):
    t = tables(spark, transactions=TRANSACTIONS)
    eligible = offers.eligible_groups(
        frame(spark, pair(1, 1), pair(1, 2, affinity=0.7), pair(2, 3)), Reward()
    )
    rows = offers.average_check_offers(t, offers.best_groups(eligible), AverageCheck(2))
    got = by(rows, "customer_id")
    assert got[(1,)]["group_name"] == "Bread" and got[(2,)]["group_name"] == "Milk"
    assert rows.columns == [
        "customer_id", "required_check_measure", "group_name", "offer_discount_depth",
    ]
    every = offers.average_check_offers(t, eligible, AverageCheck(2))
    assert sorted(r.group_name for r in every.collect()) == ["Bread", "Milk", "Tea"]


def test_visit_growth_rounds_half_up_and_skips_frequency_zero(spark):
    t = tables(spark)
    customers = spark.createDataFrame(
        [(1, 4.0), (2, 0.0), (3, 3.0)], "customer_id long, customer_frequency double"
    )
    eligible = offers.eligible_groups(frame(spark, pair(1, 1), pair(2, 1), pair(3, 1)), Reward())
    rows = offers.visit_growth_offers(t, eligible, customers, at(1), at(11), 2)
    got = by(rows, "customer_id")
    assert set(got) == {(1,), (3,)}
    assert got[(1,)]["required_transactions_count"] == 3 + 2  # 2.5 rounds to 3
    assert got[(3,)]["required_transactions_count"] == 3 + 2
    assert got[(1,)]["start_date"] == at(1) and got[(1,)]["end_date"] == at(11)


def _cross(spark, pairs, params, stores=((1, 1), (2, 2)), **rows):
    t = tables(spark, **rows)
    homes = spark.createDataFrame(list(stores), "customer_id long, customer_primary_store long")
    steady = offers.steady_groups(offers.living_groups(frame(spark, *pairs), params), params)
    offered = offers.cross_sell_offers(t, steady, homes, params)
    return sorted((r.customer_id, r.group_id, r.sku_id, r.offer_discount_depth) for r in offered.collect())


CHECKS = [line(1, 101), line(2, 101), line(3, 102), line(4, 201), line(5, 301)]


def test_cross_selling_takes_the_margin_of_the_primary_store(spark):
    prices = [
        (1, 101, 50.0, 100.0), (1, 102, 40.0, 100.0),
        (2, 101, 10.0, 100.0), (2, 102, 40.0, 100.0),
    ]
    pairs = [pair(1, 1), pair(2, 1)]
    got = _cross(spark, pairs, CrossSell(), checks=CHECKS, retail_stores=prices)
    assert got == [(1, 1, 102, 10), (2, 1, 101, 10)]


def test_cross_selling_limits(spark):
    pairs = [
        pair(1, 1, affinity=0.9, stability=0.5),  # not below the limit
        pair(1, 2, affinity=0.8),
        pair(1, 3, affinity=0.7),
    ]
    two = _cross(spark, pairs, CrossSell(), checks=CHECKS)
    assert [r[1] for r in two] == [2, 3]
    assert [r[1] for r in _cross(spark, pairs, CrossSell(number_of_groups=1), checks=CHECKS)] == [2]
    # The cap is 30 % of a margin of one half: a discount equal to it passes.
    assert [r[3] for r in _cross(spark, [pair(1, 2, least=0.11)], CrossSell(), checks=CHECKS)] == [15]
    assert _cross(spark, [pair(1, 2, least=0.16)], CrossSell(), checks=CHECKS) == []


def test_sku_share_limit_and_unsold_skus(spark):
    pairs = [pair(1, 1)]
    # SKU 102 is in one of the three transactions with tea.
    assert _cross(spark, pairs, CrossSell(max_sku_share=33), checks=CHECKS) == []
    assert len(_cross(spark, pairs, CrossSell(max_sku_share=34), checks=CHECKS)) == 1
    unsold = [line(1, 101), line(2, 101)]
    assert len(_cross(spark, pairs, CrossSell(max_sku_share=1), checks=unsold)) == 1


def test_sku_shares(spark):
    t = tables(spark, checks=[line(1, 101), line(1, 101), line(1, 102), line(2, 101)])
    shares = {r.sku_id: r.sku_share for r in offers.sku_shares(t).collect()}
    assert shares == {101: 100.0, 102: 50.0}


def test_offer_cap_from_a_bare_history(spark):
    t = tables(
        spark,
        transactions=[(1, 10, 1.0, at(1), 1), (2, 10, 1.0, at(2), 1)],
        checks=[line(1, 101, 1.0, 100.0), line(2, 101, 1.0, 80.0)],
    )
    from tallystick.operators.purchases import purchase_history

    (row,) = groups.history_caps(purchase_history(t), 30).collect()
    assert row.max_discount == pytest.approx((90 - 50) * 30 / 50)


@pytest.fixture(scope="module")
def model(spark, star_folder):
    return LoyaltyModel(spark, star_tables(spark, star_folder))


def test_invariants_of_the_views(model):
    for row in model.groups.collect():
        assert 0 < row.group_affinity_index <= 1
        assert 0 <= row.group_discount_share <= 1
        assert row.group_churn_rate >= 0
        assert row.group_minimum_discount is None or 0 < row.group_minimum_discount <= 1
    for row in model.customers.collect():
        assert 1 <= row.customer_segment <= 27


def test_one_offer_per_customer_in_steps_of_five(model):
    for offered in (
        model.generate_personal_offer(2, 100, 1.15, 3, 70, 30),
        model.generate_growth_offers(at(1, month=6), at(25, month=8)),
    ):
        rows = offered.collect()
        assert rows
        assert len({r.customer_id for r in rows}) == len(rows)
        assert all(r.offer_discount_depth % 5 == 0 for r in rows)


def test_cross_selling_stays_within_the_number_of_groups(model):
    counts: dict[int, int] = {}
    for row in model.generate_cross_selling(2, 10, 1.0, 100, 30).collect():
        counts[row.customer_id] = counts.get(row.customer_id, 0) + 1
    assert counts and max(counts.values()) <= 2


def test_views_answer_sql(model, spark):
    model.register_views()
    one = spark.sql("SELECT count(*) AS n FROM periods WHERE group_purchase > 2").first().n
    other = spark.sql(
        "SELECT count(*) AS n FROM (SELECT customer_id, group_id FROM purchase_history "
        "GROUP BY 1, 2 HAVING count(DISTINCT transaction_id) > 2)"
    ).first().n
    assert one == other > 0
    assert spark.sql("SELECT * FROM customersview").count() == 150
    assert spark.sql("SELECT * FROM groupsview").count() == 2787
