"""Offers and margins called in SQL give the rows of the calls in Python."""

from __future__ import annotations

import pytest

from tallystick import LoyaltyModel
from tallystick.sources.star import star_tables
from tests.small import AS_OF, at, tables


def rows(frame):
    return sorted(map(repr, map(tuple, frame.collect())))


@pytest.fixture(scope="module")
def model(spark, star_folder):
    model = LoyaltyModel(spark, star_tables(spark, star_folder))
    model.register_functions()
    model.periods.createOrReplaceTempView("loyalty_periods")
    yield model
    model.release()


@pytest.mark.parametrize(
    ("call", "same"),
    [
        ("generate_growth_offers('20.06.2022', DATE'2022-08-25')", lambda m: m.generate_growth_offers("2022-06-20", "2022-08-25")),
        ("generate_growth_offers('2022-06-20', '2022-08-25', max_churn => 2, added_transactions => 3)",
         lambda m: m.generate_growth_offers("2022-06-20", "2022-08-25", 3, 2)),
        ("generate_personal_offer(2, 3, 1.3, 5, 90, 40)", lambda m: m.generate_personal_offer(2, 3, 1.3, 5, 90, 40)),
        ("generate_personal_offer(1, '1.1.1990', '2050-01-01', 1, 5, 90, 40)", lambda m: m.generate_personal_offer(1, "1990-01-01", "2050-01-01", 1, 5, 90, 40)),
        ("generate_personal_offer(1, '1.1.2049', '2050-01-01', 1, 5, 90, 40)", lambda m: m.generate_personal_offer(1, "2049-01-01", "2050-01-01", 1, 5, 90, 40)),
        ("generate_cross_selling(2, 9, 0.9, 3.5)", lambda m: m.generate_cross_selling(2, 9, 0.9, 3.5, with_ids=True)),
    ],
)
def test_calls_agree(spark, model, call, same):
    assert rows(spark.sql(f"SELECT * FROM {call}")) == rows(same(model))


@pytest.mark.parametrize(("arguments", "count_type", "limit"), [("", 1, None), (", 1, 365", 1, 365), (", 2, 1", 2, 1), (", 2, 7", 2, 7), (", 1, 10000000000", 1, 10**10)])
def test_margin_in_a_lateral_join(spark, model, arguments, count_type, limit):
    frame = spark.sql(
        f"SELECT p.customer_id, p.group_id, m.group_margin FROM loyalty_periods p, LATERAL fnc_count_margin(p.customer_id, p.group_id{arguments}) m "
        "WHERE m.group_margin IS NOT NULL"
    )
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert rows(frame) == rows(model.group_margins(count_type, limit))


def test_literals_reach_the_filters(spark, model):
    plan = spark.sql("SELECT * FROM generate_growth_offers('2022-06-20', '2022-08-25')")._jdf.queryExecution().executedPlan().toString()
    assert "group_churn_rate" in plan and "Lateral" not in plan and "NestedLoop" not in plan and "Python" not in plan


@pytest.mark.parametrize(
    "call",
    [
        "generate_personal_offer(3, '1', '2', 1, 1, 1)", "generate_personal_offer(2, '1', '2', 1, 1)", "generate_personal_offer(2, '1', '2', 3, 70, 30, 5)",
        "generate_personal_offer(1, '2020-01-01', '2021-01-01', 1, 3, 70)", "generate_personal_offer(1, '2021-01-01', '2020-01-01', 1, 30, 700, 300)",
        "generate_growth_offers('2022-08-25', '2022-06-20', 1, 100, 1000, 1000)", "generate_cross_selling(0, 100, 100)", "generate_personal_offer(2, 0, 1, 1000, 1000, 1000)", "fnc_count_margin(7, 11, 3)",
    ],
)
def test_wrong_calls_fail(spark, model, call):
    with pytest.raises(Exception):  # noqa: B017
        spark.sql(f"SELECT * FROM {call}").collect()


def test_a_backward_period_fails_whichever_side_ends_first(spark, model):
    """Pairs and transactions both raise the error, so neither can turn out empty and cancel the other."""
    frame = spark.sql("SELECT * FROM generate_personal_offer(1, '2021-01-01', '2020-01-01', 1, 30, 700, 300)")
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert sum("raise_error" in line for line in plan.splitlines()) == 2
    for _ in range(3):
        with pytest.raises(Exception, match="the last date must be later"):
            frame.collect()


def test_only_the_asked_for(spark):
    small = LoyaltyModel(spark, tables(spark), AS_OF)
    small.register_functions("fnc_count_margin")
    assert "pairs" not in " ".join(small.workspace._folders)
    small.release()


def test_hand_made_rows(spark):
    small = LoyaltyModel(spark, tables(spark), AS_OF)
    small.register_functions()
    assert rows(spark.sql("SELECT * FROM generate_cross_selling(9, 1000, 1000)")) == rows(small.generate_cross_selling(9, 1000, 1000, with_ids=True))
    assert rows(spark.sql(f"SELECT * FROM generate_growth_offers('{at(1)}', '{at(31)}', 1, 1000, 1000, 99)")) == rows(
        small.generate_growth_offers(str(at(1)), str(at(31)), 1, 1000, 1000, 99)
    )
    small.release()
