"""Every registered query against its SQL counterpart, on the given and on skewed data."""

from __future__ import annotations

import pytest

from tallystick.plans import faulty_oracles, oracles
from tallystick.plans.queries import registered
from tests.comparing import compare, duck

QUERIES = registered()
SQL = oracles.statements() | faulty_oracles.statements()


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(SQL)


@pytest.fixture(scope="module")
def connection(star_folder):
    return duck(star_folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_given_data(spark, star_folder, connection, name):
    _, problems = compare(spark, connection, star_folder, QUERIES[name], SQL[name])
    assert not problems


@pytest.fixture(scope="module")
def skewed(star_folder, tmp_path_factory):
    """A third of the orders belongs to one customer, a third of the lines to one product.

    Order times are packed into a few hours of each month, so that hours hold several
    moments and moments hold several orders; some orders have no date, some lines no price.
    """
    folder = tmp_path_factory.mktemp("skewed")
    source = duck(star_folder)
    source.sql("COPY customer TO '%s/customer.parquet'" % folder)
    source.sql("COPY part TO '%s/part.parquet'" % folder)
    source.sql(
        f"""COPY (SELECT o_orderkey,
                CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey % 20 END AS o_custkey,
                o_totalprice,
                CASE WHEN o_orderkey % 50 = 1 THEN NULL
                     ELSE date_trunc('month', o_orderdate)
                          + to_minutes(CAST((o_orderkey * 7919) % 240 AS BIGINT)) END
                  AS o_orderdate FROM orders)
            TO '{folder}/orders.parquet'"""
    )
    source.sql(
        f"""COPY (SELECT l_orderkey,
                CASE WHEN l_linenumber % 3 = 0 THEN 11 ELSE l_partkey % 40 END AS l_partkey,
                l_quantity, CASE WHEN l_quantity = 13 THEN 0 ELSE l_extendedprice END
                  AS l_extendedprice,
                CASE WHEN l_partkey % 40 < 20 THEN 0 ELSE l_discount END AS l_discount
              FROM lineitem) TO '{folder}/lineitem.parquet'"""
    )
    return str(folder)


@pytest.fixture(scope="module")
def skewed_connection(skewed):
    return duck(skewed)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {n for n in QUERIES if n[:3] == "dq_" or n[:5] == "load_"}))
def test_skewed_data(spark, skewed, skewed_connection, name):
    _, problems = compare(spark, skewed_connection, skewed, QUERIES[name], SQL[name])
    assert not problems


@pytest.mark.parametrize("name", ["groups_view", "offers_cross_sell", "customers_view"])
def test_without_broadcast(spark, skewed, skewed_connection, name):
    """The same results when no side is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, problems = compare(spark, skewed_connection, skewed, QUERIES[name], SQL[name])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32MB")
    assert not problems


def test_stability_reads_the_check_lines_once(spark, star_folder):
    frame = QUERIES["group_stability"](spark, star_folder)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan
    assert plan.count("l_orderkey") and plan.count("FileScan parquet [l_orderkey") == 1
