"""Delimited files, the table store and the shared folder."""

from __future__ import annotations

import dataclasses
import datetime as dt
import decimal
import pathlib
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystick import LoyaltyModel
from tallystick.session import partitions_for
from tallystick.sources import workspace
from tallystick.sources.delimited import (
    TableStore,
    parse_moment,
    read_analysis_date,
    read_delimited,
    write_delimited,
)
from tallystick.sources.tables import SPECS
from tests.small import AS_OF, at, tables

FILES = {
    "Personal_Data_Mini": "1\tЕвгений\tИванов\tjoe@gmail.com\t+74910382990\n"
    "2\tЛев\tПетров\t\t+79005457407\n",
    "Cards_Mini": "1\t1\n2\t2\n3\t2\n4\t\n",
    "Transactions_Mini": "1\t1\t336.3206767\t23.08.2018 0:47:37\t1\n"
    "2\t3\t89.51519966\t22.09.2019 12:32:00\t1\n"
    "3\t2\t50\t2020-01-02 03:04:05.25\t1\n"
    "4\t2\t50\t\t1\n",
    "Groups_SKU_Mini": "1\tЧипсы\n2\tКолбаса\n",
    "SKU_Mini": "1\tЧипсы с солью\t1\n2\tКолбаса\t2",
    "Checks_Mini": "1\t1\t3.2\t336.3206767\t190.2882909\t146.0323858\n"
    "2\t2\t1\t89.51519966\t89.51519966\t0\n"
    "3\t2\t1\t50\t45\t5\n",
    "Stores_Mini": "1\t1\t78.0071743954938\t104.882359988255\n1\t2\t10\t20\n",
    "Date_Of_Analysis_Formation": "21.08.2022 13:10:46\n",
}


@pytest.fixture
def folder(tmp_path):
    for stem, text in FILES.items():
        (tmp_path / f"{stem}.tsv").write_text(text, encoding="utf-8")
    return str(tmp_path)


def test_load_all_and_run_the_model(spark, folder, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    store.load_all(folder)
    loaded = store.tables()
    assert {n: f.count() for n, f in loaded.items()} == {
        "personal_details": 2, "customer_cards": 4, "transactions": 4, "sku_groups": 2,
        "product_matrix": 2, "checks": 3, "retail_stores": 2, "analysis_formation": 1,
    }
    moments = {r.transaction_id: r.transaction_datetime for r in loaded.transactions.collect()}
    assert moments == {
        1: dt.datetime(2018, 8, 23, 0, 47, 37),
        2: dt.datetime(2019, 9, 22, 12, 32),
        3: dt.datetime(2020, 1, 2, 3, 4, 5, 250000),
        4: None,
    }
    assert loaded.customer_cards.where("customer_id is null").count() == 1
    assert [f.dataType for f in loaded.transactions.schema] == [
        T.LongType(), T.LongType(), T.DoubleType(), T.TimestampNTZType(), T.LongType(),
    ]
    assert read_analysis_date(loaded.analysis_formation) == dt.datetime(2022, 8, 21, 13, 10, 46)
    model = LoyaltyModel(spark, loaded)
    assert model.as_of == dt.datetime(2022, 8, 21, 13, 10, 46)
    assert model.purchase_history.count() == 3
    assert model.customers.count() == 2


def test_full_size_names(spark, folder, tmp_path):
    for stem, text in FILES.items():
        (tmp_path / f"{stem.removesuffix('_Mini')}.tsv").write_text(text, encoding="utf-8")
    store = TableStore(spark, str(tmp_path / "full"))
    store.load_all(folder, mini=False)
    assert store.table("checks").count() == 3


def test_import_appends(spark, folder, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    for _ in range(2):
        store.import_data("sku_groups", f"{folder}/Groups_SKU_Mini.tsv")
    assert store.table("sku_groups").count() == 4


@pytest.mark.parametrize("delimiter", ["\t", ",", ";", "|"])
def test_export_and_import_keep_every_value(spark, tmp_path, delimiter):
    spec = SPECS["personal_details"]
    rows = [
        (1, 'quoted "name"', "tab\there", "a,b;c|d", None),
        (2, "", " padded ", "back\\slash", "+70000000000"),
        (3, None, "'", '"', "x"),
    ]
    frame = spark.createDataFrame(rows, spec.schema())
    path = str(tmp_path / "out")
    write_delimited(frame, path, delimiter)
    again = read_delimited(spark, spec, path, delimiter)
    assert sorted(map(tuple, again.collect())) == rows


def test_line_breaks_need_multiline(spark, tmp_path):
    spec = SPECS["sku_groups"]
    frame = spark.createDataFrame([(1, "two\nlines")], spec.schema())
    path = str(tmp_path / "out")
    write_delimited(frame, path)
    assert [tuple(r) for r in read_delimited(spark, spec, path, multiline=True).collect()] == [
        (1, "two\nlines")
    ]


def test_exported_moments_are_iso_text(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    (tmp_path / "d.tsv").write_text("1.2.2022 3:04:05\n")
    store.import_data("analysis_formation", str(tmp_path / "d.tsv"))
    store.export_data("analysis_formation", str(tmp_path / "out"), ",")
    (part,) = pathlib.Path(tmp_path / "out").glob("part-*.csv")
    assert part.read_text() == "2022-02-01 03:04:05\n"


def test_day_first_dates(spark):
    texts = {
        "23.08.2018 0:47:37": dt.datetime(2018, 8, 23, 0, 47, 37),
        "1/2/2020": dt.datetime(2020, 2, 1),
        "01-02-2020 10:11:12": dt.datetime(2020, 2, 1, 10, 11, 12),
        "2020-02-01T10:11:12": dt.datetime(2020, 2, 1, 10, 11, 12),
    }
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.m for r in frame.select("t", parse_moment(F.col("t")).alias("m")).collect()}
    assert got == texts


@pytest.mark.parametrize("bad", ["32.01.2020", "yesterday", "08.23.2018 0:47:37"])
def test_a_wrong_date_fails_the_import(spark, tmp_path, bad):
    (tmp_path / "d.tsv").write_text(f"{bad}\n")
    frame = read_delimited(spark, SPECS["analysis_formation"], str(tmp_path / "d.tsv"))
    with pytest.raises(Exception, match="not a date"):
        frame.collect()


@pytest.mark.parametrize("bad", ["x\t1\n", "1\t2\t3\n", "1\n"])
def test_a_malformed_row_fails_the_import(spark, tmp_path, bad):
    (tmp_path / "c.tsv").write_text(bad)
    frame = read_delimited(spark, SPECS["customer_cards"], str(tmp_path / "c.tsv"))
    with pytest.raises(Exception):
        frame.collect()


def test_analysis_date_must_be_single(spark):
    schema = SPECS["analysis_formation"].schema()
    two = spark.createDataFrame([(dt.datetime(2020, 1, 1),), (dt.datetime(2021, 1, 1),)], schema)
    with pytest.raises(ValueError):
        read_analysis_date(two)
    with pytest.raises(ValueError):
        read_analysis_date(spark.createDataFrame([], schema))


def test_staged_tables_live_in_the_checkpoint_folder(spark):
    folder = workspace.shared_folder(spark)
    assert folder == spark.sparkContext.getCheckpointDir().rstrip("/")
    staged = workspace.staged(spark.range(10).toDF("id"), "numbers")
    assert staged.inputFiles()
    assert all(folder.rsplit("/", 1)[1] in path for path in staged.inputFiles())
    assert staged.count() == 10
    workspace.discard_staged(spark)
    assert not any(pathlib.Path(p.removeprefix("file:")).exists() for p in staged.inputFiles())


def test_released_models_build_their_tables_anew(spark, folder, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    store.load_all(folder)
    model = LoyaltyModel(spark, store.tables())
    before = sorted(map(tuple, model.periods.collect()))
    model.release()
    assert sorted(map(tuple, model.periods.collect())) == before


def _folders(frame):
    return {pathlib.Path(p.removeprefix("file:")).parent for p in frame.inputFiles()}


def test_releasing_one_model_leaves_the_other_alone(spark, folder, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    store.load_all(folder)
    first, second = (LoyaltyModel(spark, store.tables()) for _ in range(2))
    exported = tmp_path / "exported"
    store.export_data("checks", str(exported))
    expected, theirs = first.purchase_history.count(), _folders(second.baskets)
    second.release()
    assert not any(path.exists() for path in theirs)
    assert first.purchase_history.count() == expected
    mine = _folders(first.baskets)
    first.release()
    assert not any(path.exists() for path in mine)
    assert exported.exists()


def test_nothing_is_left_of_a_run_when_its_process_ends(tmp_path):
    code = (
        "from tallystick import build_session\n"
        "from tallystick.sources.workspace import Workspace, staged\n"
        "spark = build_session('left', 'local[1]', 1)\n"
        f"spark.sparkContext.setCheckpointDir({str(tmp_path)!r})\n"
        "kept = Workspace(spark).staged(spark.range(3), 'kept')\n"
        "own = staged(spark.range(3), 'own')\n"
        "print('ROWS', kept.count() + own.count())\n"
    )
    root = str(pathlib.Path(__file__).resolve().parent.parent)
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert "ROWS 6" in done.stdout
    assert not [p for p in tmp_path.rglob("run-*")]


def test_a_model_leaves_the_settings_of_the_session_alone(spark, folder, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    store.load_all(folder)
    mine = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in mine}
    for name, value in mine.items():
        spark.conf.set(name, value)
    try:
        LoyaltyModel(spark, store.tables()).groups.collect()
        assert {name: spark.conf.get(name) for name in mine} == mine
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_aliases_and_repeated_exports(spark, folder, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    store.load_all(folder)
    store.import_data("CustomerCards", f"{folder}/Cards_Mini.tsv")
    assert store.table("customercards").count() == 8
    target = str(tmp_path / "out")
    for _ in range(2):
        store.export_data("productmatrix", target)
    assert read_delimited(spark, SPECS["product_matrix"], target).count() == 2
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        store.export_data("productmatrix", target, mode="error")
    LoyaltyModel(spark, store.tables()).register_views()
    assert spark.sql("SELECT * FROM productmatrix").count() == 2


def test_partitions_follow_the_input():
    assert partitions_for(1) == 200
    assert partitions_for(100 << 40) == 819_200


def test_margins_keep_all_digits(spark):
    lines = {"transactions": [(1, 10, 1, at(1), 1)], "checks": [(1, 101, "0.3333", "2.0000", "1.0000", "1.0000")]}
    t = tables(spark)
    money = T.DecimalType(18, 4)
    cast = lambda df, *names: df.select(*[F.col(c).cast(money).alias(c) if c in names else F.col(c) for c in df.columns])
    checks = spark.createDataFrame(lines["checks"], "transaction_id long, sku_id long, sku_amount string, sku_summ string, sku_summ_paid string, sku_discount string")
    exact = dataclasses.replace(
        t,
        transactions=cast(spark.createDataFrame(lines["transactions"], "transaction_id long, customer_card_id long, transaction_summ int, transaction_datetime timestamp_ntz, transaction_store_id long"), "transaction_summ"),
        checks=cast(checks, "sku_amount", "sku_summ", "sku_summ_paid", "sku_discount"),
        retail_stores=cast(t.retail_stores.withColumn("sku_purchase_price", F.lit("0.1111")), "sku_purchase_price", "sku_retail_price"),
    )
    model = LoyaltyModel(spark, exact, AS_OF)
    assert [r.group_margin for r in model.group_margins().collect()] == [decimal.Decimal("0.96297037")]
    assert [r.group_margin for r in model.group_margins(customer_id=1, group_id=1).collect()] == [decimal.Decimal("0.96297037")]
    assert [r.group_margin for r in model.groups.collect()] == [decimal.Decimal("0.96297037")]
    assert model.group_margins(customer_id=2).collect() == []
