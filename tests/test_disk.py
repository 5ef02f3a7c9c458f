"""What plans leave on the executors' disks, and what their shuffles carry."""

from __future__ import annotations

import os
import random
import time

from pyspark.sql import functions as F

from tallystick.operators import groups, purchases
from tallystick.plans.model import LoyaltyModel
from tallystick.sources.star import star_tables
from tallystick.sources.workspace import Workspace
from tests.small import at, tables
from tests.test_views import line


def shuffles(spark) -> set[str]:
    """Blocks that shuffles hold on disk."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    names = (blocks.apply(i).name() for i in range(blocks.size()))
    return {name for name in names if name.startswith("shuffle_")}


def left_behind(spark, before: set[str]) -> set[str]:
    for _ in range(50):  # they go in the background
        if not (new := shuffles(spark) - before):
            break
        time.sleep(0.2)
    return new


def test_staging_leaves_no_shuffle_files(spark):
    frame = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition(3, "count")
    settings = spark.sparkContext.getConf().getAll(), spark.conf.getAll
    before = shuffles(spark)
    workspace = Workspace(spark)
    staged = workspace.staged(frame, "counts", tidy=True)
    assert left_behind(spark, before) == set()
    assert sorted(map(tuple, staged.collect())) == sorted(map(tuple, frame.collect()))
    assert (spark.sparkContext.getConf().getAll(), spark.conf.getAll) == settings
    workspace.release()


def test_staging_keeps_the_settings_of_the_moment(spark):
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    workspace = Workspace(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        rows = spark.range(1000).groupBy(F.col("id") % 100).count().select(F.spark_partition_id().alias("p"))
        assert workspace.staged(rows, "parts", tidy=True).distinct().count() == 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    workspace.release()


def test_stabilities_of_hours_are_those_of_moments(spark):
    """Pairs bought once, at one moment, several times an hour or a second apart; missing moments and keys."""
    chosen = random.Random(5)
    rows = [(1, 1, at(1), 1), (1, 2, at(1), 1), (1, 2, at(1), 2), (2, 1, None, 3), (2, 1, None, 4)]
    rows += [(3, g, at(1, chosen.randrange(3), chosen.randrange(60)), i) for i in range(300) for g in (1, 2)]
    rows += [(4, 1, at(chosen.randrange(1, 28), chosen.randrange(24), chosen.randrange(60)), i) for i in range(40)]
    rows += [(c, None if i % 9 == 0 else i % 3, None if i % 7 == 0 else at(1 + i % 5, i % 2, i % 50), i) for c in (5, None) for i in range(60)]
    history = spark.createDataFrame(rows, "customer_id long, group_id long, transaction_datetime timestamp_ntz, transaction_id long")
    tell = lambda frame: sorted((r[0], r[1], None if r[2] is None else round(r[2], 9)) for r in frame.collect())
    moments = tell(groups.group_stabilities(history))
    assert {r[0] for r in moments} == {1, 2, 3, 4, 5}
    assert tell(groups.slot_stabilities(history)) == moments
    assert tell(groups.slot_stabilities(history, 7)) == moments


def test_views_leave_no_shuffles_of_their_branches(spark, star_folder):
    """Baskets by way of lines that are deleted; each branch staged before the next one shuffles."""
    before = shuffles(spark)
    model = LoyaltyModel(spark, star_tables(spark, star_folder), margin=groups.MarginRule(2, 2))
    view = model.groups
    assert left_behind(spark, before) == set()
    staged = {folder.rsplit("/", 1)[1].rsplit("-", 1)[0] for folder in model.workspace._folders}
    assert staged == {"baskets", "indices", "margins", "stabilities"}
    assert not [path for path in view.inputFiles() if "lineitem" in path or "/lines-" in path]
    model.release()


def test_discarded_tables_go_alone(spark):
    workspace = Workspace(spark)
    kept, gone = (workspace.staged(spark.range(n), "numbers") for n in (3, 4))
    path = gone.inputFiles()[0].removeprefix("file:")
    assert os.path.exists(path)
    workspace.discard(gone)
    assert not os.path.exists(path) and kept.count() == 3
    workspace.release()


def test_baskets_by_way_of_staged_lines(spark):
    """A SKU and a price listed twice, a line without price, a transaction without a date or a store."""
    t = tables(
        spark,
        transactions=[(1, 10, 1.0, at(1), 1), (1, 10, 1.0, at(1), 1), (2, 20, 1.0, None, 2), (3, 11, 1.0, at(3), 9), (4, 11, 1.0, at(3), None)],
        checks=[line(i, sku, 2.0, 100.0, discount=10.0 * i) for i in (1, 2, 3, 4) for sku in (101, 101, 201, 999)],
        product_matrix=[(101, "a", 1), (101, "a", 2), (201, "b", None)],
        retail_stores=[(1, 101, 50.0, 100.0), (1, 101, 60.0, 100.0), (2, 201, 1.0, 2.0)],
    )
    model = LoyaltyModel(spark, t)
    key = lambda r: repr(tuple(r))
    assert model.baskets.schema.simpleString() == purchases.baskets(t).schema.simpleString()
    assert sorted(model.baskets.collect(), key=key) == sorted(purchases.baskets(t).collect(), key=key) != []
    model.release()


def test_shuffles_carry_what_is_needed(spark, star_folder):
    model = LoyaltyModel(spark, star_tables(spark, star_folder))
    written = {}
    keep = model.workspace.staged
    model.workspace.staged = lambda df, label, *tidy, **k: written.setdefault(label, []).append(set(df.columns)) or keep(df, label, *tidy, **k)
    model.generate_growth_offers("20.06.2022", "25.08.2022"), model.generate_cross_selling(), model.groups
    growth, cross, view = (c - set(groups.SPAN_COLUMNS) for c in written["indices"])
    assert growth == {"offer_discount_depth"} and cross == {"group_minimum_discount"}
    assert not {"average_summ", "average_cost"} & view
    model.register_functions("generate_growth_offers")
    assert not {"group_margin", "group_average_discount"} & set(spark.table("loyalty_pairs").columns)
    model.release()
