"""The registered queries: every operator over the star schema's whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystick.functions.calendar import moment
from tallystick.operators import customers, groups, offers, periods, purchases, quality
from tallystick.plans.model import LoyaltyModel
from tallystick.sources.bucketed import with_bucketed_facts
from tallystick.sources.delimited import TableStore, read_delimited, write_delimited
from tallystick.sources.faults import faulty
from tallystick.sources.loads import LoadStore
from tallystick.sources.star import star_tables
from tallystick.sources.tables import SPECS
from tallystick.sources.workspace import staged

# Parameters of the registered calls.
PERIOD = (dt.date(1998, 1, 1), dt.date(2000, 12, 31))
VISIT_PERIOD = (dt.datetime(2022, 6, 20), dt.datetime(2022, 8, 25))
RECENT_DAYS = 365
RECENT_PURCHASES = 2
RECENT_CHECKS = 3
MARGIN_CUSTOMER = 7
MARGIN_GROUP = 11

Query = Callable[[SparkSession, str], DataFrame]


def presented(df: DataFrame) -> DataFrame:
    """Numbers rounded for output, and one integer type."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = F.round(column.cast("double"), 4)
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 6)
        elif isinstance(field.dataType, T.IntegralType):
            column = column.cast("long")
        columns.append(column.alias(field.name))
    return df.select(*columns)


_QUERIES: dict[str, Query] = {}


def _query(build: Callable[[LoyaltyModel], DataFrame]) -> Callable[[LoyaltyModel], DataFrame]:
    """Register under the function's name, without a trailing underscore."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        model = LoyaltyModel(spark, star_tables(spark, folder))
        with model.workspace:
            return presented(build(model))

    _QUERIES[build.__name__.rstrip("_")] = run
    return build


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


# --- purchase history and periods -----------------------------------------------------


@_query
def purchase_history(m):
    return purchases.purchase_history(m.tables)


@_query
def purchase_history_of_group(m):
    return purchases.purchase_history(m.tables).where(F.col("group_id") == 1)


@_query
def purchase_history_bucketed(m):
    """From fact tables bucketed by transaction, which are joined where they lie."""
    buckets = int(m.spark.conf.get("spark.sql.shuffle.partitions"))
    return purchases.purchase_history(with_bucketed_facts(m.tables, m.workspace, buckets))


@_query
def purchase_history_costly(m):
    return purchases.purchase_history(m.tables).where(F.col("group_cost") > 1000)


# One aggregation over unstaged baskets: nothing reads them twice here.


@_query
def periods_(m):
    return periods.periods(purchases.baskets(m.tables))


@_query
def periods_of_group(m):
    return periods.periods(purchases.baskets(m.tables)).where(F.col("group_id") == 4)


@_query
def periods_begun_since(m):
    since = moment("2000-01-01 00:00:00")
    return periods.periods(purchases.baskets(m.tables)).where(
        F.col("first_group_purchase_date") > since
    )


@_query
def periods_frequent(m):
    return periods.periods(purchases.baskets(m.tables)).where(F.col("group_purchase") > 2)


@_query
def group_min_discount(m):
    return periods.least_discounts(m.tables)


# The same from appended data: the state of the old baskets, merged with that of new ones.


def _appended(m, parts: int = 3):
    """Profiles from a stored state that took in the transactions part by part."""
    state = None
    for part in range(parts):
        mine = F.pmod(F.col("transaction_id"), F.lit(parts)) == part
        new = replace(m.tables, transactions=m.tables.transactions.where(mine), checks=m.tables.checks.where(mine))
        further = periods.pair_state(purchases.baskets(new))
        state = staged(further if state is None else periods.merged_states(state, further), "state")
    return periods.profiles_of(state)


@_query
def periods_appended(m):
    return _appended(m).select(*periods.PERIOD_COLUMNS)


@_query
def group_indices_appended(m):
    """Churn, discount share and discounts of every pair."""
    indices = groups.profile_indices(_appended(m), m.as_of)
    return indices.select(*periods.PAIR, "group_churn_rate", "group_discount_share", "group_minimum_discount", "group_average_discount")


# --- customers --------------------------------------------------------------------------


def _metrics(m):
    return customers.customer_metrics(customers.store_visits(m.tables), m.as_of)


@_query
def customer_check_segments(m):
    return customers.with_check_segment(_metrics(m)).select(
        "customer_id", "customer_average_check", "customer_average_check_segment"
    )


@_query
def customer_frequency_segments(m):
    return customers.with_frequency_segment(_metrics(m)).select(
        "customer_id", "customer_frequency", "customer_frequency_segment"
    )


@_query
def customer_churn(m):
    return _metrics(m).select(
        "customer_id",
        "customer_inactive_period",
        "customer_churn_rate",
        "customer_churn_segment",
    )


@_query
def customer_segment_number(m):
    return customers.with_segments(_metrics(m)).select("customer_id", "customer_segment")


@_query
def ntile_segments(m):
    return customers.ntile_segments(_metrics(m))


@_query
def store_share(m):
    return customers.store_shares(customers.store_visits(m.tables)).drop("visits")


@_query
def loyal_customers(m):
    return customers.loyal_customers(m.tables)


@_query
def primary_store(m):
    return m.primary_stores


@_query
def customers_view(m):
    return m.customers


# --- groups -----------------------------------------------------------------------------


def _profiles(m):
    return periods.pair_profiles(purchases.baskets(m.tables))


@_query
def customer_groups(m):
    lines = purchases.check_lines(m.tables)
    return lines.select("customer_id", "group_id").distinct()


def _purchases(m):
    """Who bought which group when: the part of the history several branches read."""
    history = purchases.purchase_history(m.tables)
    return staged(history.select(*periods.PAIR, "transaction_id", "transaction_datetime"), "who")


@_query
def group_affinity(m):
    history = _purchases(m)
    return groups.group_affinities(history, groups.purchase_spans(history), parts=m.parts)


@_query
def group_affinity_rows(m):
    history = _purchases(m)
    return groups.group_affinities(history, groups.purchase_spans(history), every_row=True, parts=m.parts)


@_query
def group_churn(m):
    return groups.group_churns(_profiles(m), m.as_of)


@_query
def group_intervals(m):
    return groups.group_intervals(_purchases(m), m.parts)


@_query
def group_stability(m):
    # Both branches start from one and the same shuffle, so nothing is staged.
    return groups.group_stabilities(purchases.purchase_history(m.tables), m.parts)


def _margin(m, rule):
    return groups.group_margins(purchases.margin_history(m.tables), rule, m.as_of)


@_query
def group_margin_all(m):
    return _margin(m, groups.MarginRule())


@_query
def group_margin_last_days(m):
    return _margin(m, groups.MarginRule(1, RECENT_DAYS))


@_query
def group_margin_last_n(m):
    return _margin(m, groups.MarginRule(2, RECENT_PURCHASES))


@_query
def group_margin_of_customer(m):
    return m.group_margins(2, RECENT_PURCHASES, customer_id=MARGIN_CUSTOMER)


@_query
def group_margin_of_pair(m):
    return m.group_margins(customer_id=MARGIN_CUSTOMER, group_id=MARGIN_GROUP)


@_query
def group_discount_share(m):
    return groups.group_discount_shares(_profiles(m))


@_query
def group_discount_lines(m):
    return groups.group_discount_shares(_profiles(m), every_line=True)


@_query
def group_average_discount(m):
    return groups.group_discounts(_profiles(m))


@_query
def groups_view(m):
    return m.groups


@_query
def groups_view_recent_margin(m):
    recent = groups.MarginRule(2, RECENT_PURCHASES)
    return groups.groups_view(m.baskets, m.as_of, recent, m.parts)


# --- offers -----------------------------------------------------------------------------


@_query
def max_offer_discount(m):
    return groups.history_caps(purchases.purchase_history(m.tables), 30)


@_query
def target_check_last_n(m):
    return offers.target_checks(m.tables, offers.AverageCheck(2, quantity=RECENT_CHECKS))


@_query
def target_check_period(m):
    start, end = PERIOD
    return offers.target_checks(m.tables, offers.AverageCheck(1, start=start, end=end))


@_query
def offers_avg_check_period(m):
    return m.generate_personal_offer(1, *PERIOD, 1.15, 3, 70, 30)


@_query
def offers_avg_check_last_n(m):
    return m.generate_personal_offer(2, 100, 1.15, 3, 70, 30)


@_query
def offers_avg_check_all_groups(m):
    return m.generate_personal_offer(2, 100, 1.15, 3, 70, 30, all_groups=True)


@_query
def offers_visit_growth(m):
    return m.generate_growth_offers(*VISIT_PERIOD, 1, 4, 80, 50)


@_query
def sku_share(m):
    return offers.sku_shares(m.tables)


@_query
def best_margin_sku(m):
    return offers.best_margin_skus(m.tables)


@_query
def offers_cross_sell(m):
    return m.generate_cross_selling(5, 3, 0.5, 100, 30)


@_query
def offers_cross_sell_rare_skus(m):
    return m.generate_cross_selling(5, 10, 1.0, 1.2, 30, with_ids=True)


# The same as table functions called in SQL.


def _called(m, function, statement):
    m.register_functions(function)
    return m.spark.sql(statement)


@_query
def sql_offers_avg_check_period(m):
    start, end = PERIOD
    call = f"generate_personal_offer(1, DATE'{start}', '{end:%d.%m.%Y}', 1.15, 3, 70, 30)"
    return _called(m, "generate_personal_offer", f"SELECT * FROM {call}")


@_query
def sql_offers_avg_check_last_n(m):
    return _called(m, "generate_personal_offer", "SELECT * FROM generate_personal_offer(2, 100, 1.15, 3, 70, 30)")


@_query
def sql_offers_visit_growth(m):
    start, end = VISIT_PERIOD
    call = f"generate_growth_offers('{start:%d.%m.%Y}', TIMESTAMP_NTZ'{end}', margin_share => 50)"
    return _called(m, "generate_growth_offers", f"SELECT * FROM {call}")


@_query
def sql_offers_cross_sell(m):
    return _called(m, "generate_cross_selling", "SELECT customer_id, sku_name, offer_discount_depth FROM generate_cross_selling()")


@_query
def sql_offers_cross_sell_rare_skus(m):
    return _called(m, "generate_cross_selling", "SELECT * FROM generate_cross_selling(5, 10, 1.0, 1.2, 30)")


def _lateral_margins(m, arguments):
    m.periods.createOrReplaceTempView("loyalty_periods")
    call = f"LATERAL fnc_count_margin(p.customer_id, p.group_id{arguments}) m"
    return _called(m, "fnc_count_margin", f"SELECT p.customer_id, p.group_id, m.group_margin FROM loyalty_periods p, {call}")


@_query
def sql_group_margin_all(m):
    return _lateral_margins(m, "")


@_query
def sql_group_margin_last_n(m):
    return _lateral_margins(m, f", 2, {RECENT_PURCHASES}")


@_query
def sql_group_margin_of_pair(m):
    call = f"fnc_count_margin({MARGIN_CUSTOMER}, {MARGIN_GROUP})"
    pair = f"{MARGIN_CUSTOMER} AS customer_id, {MARGIN_GROUP} AS group_id"
    return _called(m, "fnc_count_margin", f"SELECT {pair}, group_margin FROM {call} WHERE group_margin IS NOT NULL")


# --- data quality -----------------------------------------------------------------------


@_query
def dq_unique(m):
    return quality.unique_violations(m.tables)


@_query
def dq_foreign_keys(m):
    return quality.reference_violations(m.tables)


@_query
def dq_ranges(m):
    return quality.range_violations(m.tables)


@_query
def dq_patterns(m):
    return quality.pattern_violations(m.tables)


@_query
def dq_patterns_any_case(m):
    return quality.pattern_violations(m.tables, any_case=True)


@_query
def dq_required(m):
    return quality.missing_values(m.tables)


@_query
def dq_lengths(m):
    return quality.length_violations(m.tables)


@_query
def dq_rule_counts(m):
    return quality.rule_counts(m.tables)


@_query
def dq_all(m):
    return quality.violations(m.tables)


# The same over tables with a documented fault per rule.


@_query
def dq_unique_faulty(m):
    return quality.unique_violations(faulty(m.tables))


@_query
def dq_foreign_keys_faulty(m):
    return quality.reference_violations(faulty(m.tables))


@_query
def dq_ranges_faulty(m):
    return quality.range_violations(faulty(m.tables))


@_query
def dq_patterns_faulty(m):
    return quality.pattern_violations(faulty(m.tables))


@_query
def dq_required_faulty(m):
    return quality.missing_values(faulty(m.tables))


@_query
def dq_lengths_faulty(m):
    return quality.length_violations(faulty(m.tables))


@_query
def dq_rule_counts_faulty(m):
    return quality.rule_counts(faulty(m.tables))


# --- import and export ------------------------------------------------------------------


def _round_trip(m, name, delimiter):
    path = m.workspace.new_folder(f"export-{name}")
    write_delimited(m.tables[name], path, delimiter)
    return read_delimited(m.spark, SPECS[name], path, delimiter, T.DecimalType(18, 4))


@_query
def import_export_roundtrip(m):
    return _round_trip(m, "transactions", "\t")


@_query
def import_export_checks(m):
    return _round_trip(m, "checks", ";")


@_query
def import_export_personal(m):
    return _round_trip(m, "personal_details", ",")


def _loaded(m, mini):
    """All eight tables written as delimited text, then loaded parents first.

    Moments are day-first text, with the time of day taken from the key. Sums are missing where
    the key ends in 3, moments where it ends in 7; by the key's remainder of four, names are
    empty texts (1) and surnames missing (2).
    """
    at = F.expr("transaction_datetime + make_dt_interval(0, 0, 0, transaction_id % 86400)")
    key, customer = F.col("transaction_id"), F.col("customer_id")
    texts = {
        "transactions": m.tables.transactions.select(
            "transaction_id",
            "customer_card_id",
            F.when(key % 10 != 3, F.col("transaction_summ")).alias("transaction_summ"),
            F.when(key % 10 != 7, F.date_format(at, "d.M.yyyy H:mm:ss")).alias("transaction_datetime"),
            "transaction_store_id",
        ),
        "personal_details": m.tables.personal_details.withColumns(
            {
                "customer_name": F.when(customer % 4 == 1, "").otherwise(F.col("customer_name")),
                "customer_surname": F.when(customer % 4 != 2, F.col("customer_surname")),
            }
        ),
    }
    folder = m.workspace.new_folder("incoming")
    for name, spec in SPECS.items():
        small = "_Mini" if mini and name != "analysis_formation" else ""
        write_delimited(texts.get(name, m.tables[name]), f"{folder}/{spec.file_stem}{small}.tsv")
    store = TableStore(m.spark, m.workspace.new_folder("store"), T.DecimalType(18, 4))
    store.load_all(folder, mini)
    return store.tables()


@_query
def load_day_first(m):
    return _loaded(m, mini=True).transactions


@_query
def load_empty_fields(m):
    return _loaded(m, mini=False).personal_details


@_query
def load_all_tables(m):
    counts = [
        frame.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, frame in _loaded(m, mini=False).items()
    ]
    return reduce(DataFrame.unionAll, counts)


# The same files with faults, through the checked and repeatable load.


def _checked(m, *names):
    """The faulty tables as text, with lines that are no row at all, loaded in one load."""
    folder, wrong = m.workspace.new_folder("incoming"), faulty(m.tables)
    files = {name: f"{folder}/{SPECS[name].file_stem}.tsv" for name in names or SPECS}
    for name, path in files.items():
        write_delimited(wrong[name], path)
    key = F.col("transaction_id")
    torn = m.tables.transactions.where(key % 71 == 0).select(F.concat(key.cast("string"), F.lit("\tnobody's")))
    torn.write.mode("append").text(files["transactions"])
    store = LoadStore(m.spark, m.workspace.new_folder("store"), T.DecimalType(18, 4))
    return store, store.load(files)


@_query
def load_checked(m):
    """Lines accepted, and lines that break each rule."""
    store, done = _checked(m)
    accepted = [
        frame.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), F.lit("accepted").alias("outcome"), "rows")
        for name, frame in store.tables().items()
    ]
    broken = done.rejected.groupBy("table", F.col("rule").alias("outcome")).agg(F.count("*").alias("rows"))
    return reduce(DataFrame.unionByName, accepted).unionByName(broken)


@_query
def load_checked_transactions(m):
    store, _ = _checked(m, "personal_details", "customer_cards", "transactions")
    return store.table("transactions").select("transaction_id", "customer_card_id", "transaction_summ")


@_query
def load_repeated(m):
    """The same files three times, then a further one: rows by table, and files in the ledger."""
    folder = m.workspace.new_folder("incoming")
    files = {name: f"{folder}/{SPECS[name].file_stem}.tsv" for name in ("sku_groups", "product_matrix")}
    old = F.col("sku_id") % 10 != 0
    write_delimited(m.tables.sku_groups.coalesce(1), files["sku_groups"])
    write_delimited(m.tables.product_matrix.where(old).coalesce(1), files["product_matrix"])
    store = LoadStore(m.spark, m.workspace.new_folder("store"), T.DecimalType(18, 4))
    for _ in range(3):
        store.load(files)
    write_delimited(m.tables.product_matrix.where(~old).coalesce(1), files["product_matrix"], mode="append")
    store.load(files)
    rows = [store.table(name).agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows") for name in files]
    loaded = store.loads().groupBy(F.concat(F.lit("files of "), "table").alias("table")).agg(F.count("*").alias("rows"))
    return reduce(DataFrame.unionByName, rows).unionByName(loaded)


@_query
def analysis_date(m):
    return m.tables.analysis_formation
