"""Checked, repeatable loads."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallystick.sources.loads import LoadStore
from tallystick.sources.tables import SPECS, spec_of
from tests.test_sources import FILES, folder  # noqa: F401


def rows(frame):
    return sorted(map(repr, map(tuple, frame.collect())))


def broken(done):
    return sorted((r["table"], r["rule"], r["line"].split("\t")[0]) for r in done.rejected.collect())


@pytest.fixture
def store(spark, tmp_path):
    return LoadStore(spark, str(tmp_path / "store"))


def written(tmp_path, name, text):
    path = tmp_path / f"{name}.tsv"
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_second_load_changes_nothing(store, folder):  # noqa: F811
    first = store.load_all(folder)
    before = {name: rows(frame) for name, frame in store.tables().items()}
    assert {n: len(r) for n, r in before.items()} == {n: c["accepted"] for n, c in first.counts.items()}
    again = store.load_all(folder)
    assert not again.counts and len(again.skipped) == 8 and store.loads().count() == 8
    assert {name: rows(frame) for name, frame in store.tables().items()} == before


def test_same_name_with_new_content_is_a_new_file(store, folder, tmp_path):  # noqa: F811
    store.load_all(folder)
    path = written(tmp_path, "Groups_SKU_Mini", "3\tTea\n")
    store.import_data("SKU_Groups", path)
    assert store.table("sku_groups").count() == 3


def test_broken_load_is_invisible(store, folder, tmp_path, monkeypatch):  # noqa: F811
    def fails(self, spec, *rest):
        if spec.name == "checks":
            raise OSError("disk full")
        return kept(self, spec, *rest)

    kept = LoadStore._tagged
    monkeypatch.setattr(LoadStore, "_tagged", fails)
    with pytest.raises(OSError, match="disk full"):
        store.load_all(folder)
    assert all(frame.count() == 0 for _, frame in store.tables().items()) and store.loads().count() == 0
    monkeypatch.undo()
    store.load_all(folder)
    assert store.table("checks").count() == 3


def test_rejected_lines_and_rules(store, folder, tmp_path):  # noqa: F811
    store.load_all(folder)
    text = (
        "5\t1\t10\t1.2.2020 3:04:05\t1\n"  # sound
        "1\t1\t10\t1.2.2020 3:04:05\t1\n"  # stored already
        "6\t9\t10\t1.2.2020\t1\n"  # no such card
        "7\t1\t-1\tsoon\t1\n"  # two rules
        "8\tx\t10\t1.2.2020\t1\n"  # not a number
        "9\t1\n"  # too short
        "10\t1\t10\t1.2.2020\t1\t7\n"  # too long
        "11\t\t10\t\t1\n"  # no card
        "12\t2\t2\t\t1\n12\t2\t1\t\t1\n12\t2\t1\t\t1\n"  # one of three stays
        "\t1\t1\t\t1\n"  # no key
        "\n"
    )
    done = store.import_data("transactions", written(tmp_path, "more", text))
    assert done.counts["transactions"] == {"lines": 12, "accepted": 2, "rejected": 10}
    assert broken(done) == sorted(
        ("transactions", rule, line)
        for rule, line in [
            ("transaction_id primary key", "1"), ("customer_card_id in customer_cards", "6"),
            ("transaction_datetime is a date", "7"), ("transaction_summ >= 0", "7"), ("row of the table", "8"),
            ("row of the table", "9"), ("row of the table", "10"), ("customer_card_id not null", "11"),
            ("transaction_id primary key", "12"), ("transaction_id primary key", "12"), ("transaction_id primary key", ""),
        ]
    )
    kept = {r["transaction_id"]: r["transaction_summ"] for r in store.table("transactions").where("transaction_id > 4").collect()}
    assert kept == {5: 10.0, 12: 1.0}


def test_unique_values_may_be_missing(store, tmp_path):
    text = "1\tAnna\tLee\ta@b.ru\t+71234567890\n2\tAnna\tLee\ta@b.ru\t\n3\tAnna\tLee\t\t\n4\tAnna\tLee\t\t\n"
    done = store.load({"PersonalDetails": written(tmp_path, "people", text)})
    assert broken(done) == [("personal_details", "customer_primary_email unique", "2")]
    assert done.counts["personal_details"]["accepted"] == 3


def test_parents_of_the_same_load_count(store, tmp_path):
    files = {"customercards": written(tmp_path, "c", "1\t1\n2\t8\n"), "personaldetails": written(tmp_path, "p", "1\tAnna\tLee\t\t\n")}
    done = store.load(files)
    assert broken(done) == [("customer_cards", "customer_id in personal_details", "2")]
    with pytest.raises(ValueError):
        store.import_data("checks", files["customercards"], multiline=True)


def test_empty_file(store, tmp_path):
    done = store.load({"sku_groups": written(tmp_path, "g", "")})
    assert not done.counts and done.rejected is None and store.table("sku_groups").count() == 0


def test_names_of_import_calls():
    # The names that import and export calls give the tables.
    called = "personaldetails customercards transactions sku_groups productmatrix checks retailstores analysisformation".split()
    assert [spec_of(name).name for name in called] == [
        "personal_details", "customer_cards", "transactions", "sku_groups", "product_matrix", "checks", "retail_stores", "analysis_formation",
    ]
    assert {spec_of(name).name for name in called} == set(SPECS)


def test_lines_add_up(spark, store, star_folder):
    from tallystick.plans.model import LoyaltyModel
    from tallystick.plans.queries import _checked
    from tallystick.sources.star import star_tables

    _, done = _checked(LoyaltyModel(spark, star_tables(spark, star_folder)), "personal_details", "customer_cards", "transactions")
    for name, counts in done.counts.items():
        lines = done.rejected.where(F.col("table") == name).select("file", "line").distinct().count()
        assert counts["lines"] == counts["accepted"] + counts["rejected"] and lines <= counts["rejected"]
