"""Bucketed fact tables are joined without an exchange."""

from __future__ import annotations

import pytest

from tallystick.operators import purchases
from tallystick.sources.bucketed import bucketed, with_bucketed_facts
from tallystick.sources.star import star_tables
from tallystick.sources.workspace import Workspace


def rows(frame):
    return sorted(map(repr, map(tuple, frame.collect())))


@pytest.mark.parametrize("buckets", [3, 4])
def test_same_rows_without_moving_facts(spark, star_folder, buckets):
    tables, workspace = star_tables(spark, star_folder), Workspace(spark)
    plain = purchases.purchase_history(tables)
    frame = purchases.purchase_history(with_bucketed_facts(tables, workspace, buckets))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [transaction_id" in plan and "hashpartitioning(transaction_id" not in plan
    assert "hashpartitioning(transaction_id" in plain._jdf.queryExecution().executedPlan().toString()
    assert rows(frame) == rows(plain)
    workspace.release()


def test_every_bucket_is_one_file(spark):
    workspace = Workspace(spark)
    frame = bucketed(spark.range(1000).withColumnRenamed("id", "k"), workspace, "numbers", "k", 5)
    assert len(frame.inputFiles()) == 5 and frame.count() == 1000
    with pytest.raises(ValueError):
        bucketed(frame, workspace, "numbers", "k", 0)
    workspace.release()
