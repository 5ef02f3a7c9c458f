"""Offers and margins as table functions of the session, for callers who write SQL.

Each function is a SQL statement over temporary views of one model. Arguments that are
literals become part of the plan, so filters, limits and partial top-n steps act as if they had been
written out; nothing runs in Python. A function may have default values, named arguments, and
stand in a lateral join. Registering another model's functions in the session replaces these;
releasing the model deletes what they read.

Moments are given as dates, timestamps or texts, ISO or day-first, as elsewhere.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import TYPE_CHECKING

from pyspark.sql import functions as F

from tallystick.functions.calendar import DAY_FIRST
from tallystick.operators import groups, offers
from tallystick.operators.ordering import PARTS
from tallystick.operators.purchases import customer_transactions, history_of

if TYPE_CHECKING:
    from tallystick.plans.model import LoyaltyModel

_DEPTH = "ceil(round(group_minimum_discount * 20, 9)) * 5"


def _moment(name: str) -> str:
    pattern = DAY_FIRST.replace("\\", "\\\\")
    return f"CAST(regexp_replace(trim({name}), '{pattern}', '$3-$2-$1') AS TIMESTAMP_NTZ)"


def _checked(value: str, condition: str, message: str) -> str:
    """The value, or an error. It stands where rows are filtered by it: a filter beside it could
    leave no row to raise the error."""
    return f"CASE WHEN {condition} THEN {value} ELSE raise_error('{message}') END"


def _required(condition: str, message: str) -> str:
    return _checked("true", condition, message)


def _best(churn: str, share: str, margin: str) -> str:
    """The eligible group of greatest affinity of every customer; see ``offers.best_groups``."""
    return f"""
        SELECT customer_id, max(struct(group_affinity_index, -group_id, group_id, {_DEPTH} AS depth)) AS best
        FROM loyalty_pairs
        WHERE round(group_churn_rate, 9) <= {churn} AND round(group_discount_share, 9) < {share} / 100
          AND {_DEPTH} < round(try_divide((average_summ - average_cost) * {margin}, average_cost), 9)
        GROUP BY customer_id"""


def _latest(view: str, keys: str, count: str) -> str:
    """Rows of a view with ``place``, their place from the newest of a key, as in ``ordering.latest``:
    first among the key's rows in a part, then among those of all parts."""
    order = "ORDER BY transaction_datetime DESC NULLS LAST, transaction_id DESC NULLS LAST"
    return f"""
        SELECT *, row_number() OVER (PARTITION BY {keys} {order}) AS place
        FROM (SELECT *, row_number() OVER (PARTITION BY {keys}, pmod(xxhash64(transaction_id), {PARTS}) {order}) AS place_in_part FROM {view})
        WHERE {count} IS NULL OR place_in_part <= {count}"""


def _personal_offer(model: LoyaltyModel) -> str:
    first, last = _moment("argument_1"), _moment("argument_2")
    called = "CASE WHEN chosen_method = 1 AND argument_6 IS NOT NULL THEN 1 WHEN chosen_method = 2 AND argument_6 IS NULL AND argument_5 IS NOT NULL THEN 2 END"
    method = f"coalesce({called}, raise_error('method 1 takes a period, method 2 a number of transactions'))"
    by_method = lambda one, two: f"CASE {method} WHEN 1 THEN {one} WHEN 2 THEN {two} END"
    coefficient = by_method("argument_3", "try_cast(argument_2 AS DOUBLE)")
    churn, share = by_method("argument_4", "argument_3"), by_method("argument_5", "argument_4")
    number = "try_cast(argument_1 AS INT)"
    quantity = by_method("CAST(NULL AS INT)", _checked(number, f"{number} >= 1", "method 2 needs a number of transactions"))
    forward = (f"{last} > {first}", "the last date must be later than the first")
    # Checked on both sides of the join: no transaction lies in a period that runs backwards, and once
    # that side is known to be empty nothing is left of the other.
    inside = _checked(f"transaction_datetime BETWEEN {first} AND {last}", *forward)
    chosen = f"""CASE chosen_method
        WHEN 1 THEN {by_method(inside, "NULL")}
        ELSE place <= {quantity} END"""
    period = by_method(_required(*forward), "true")
    return f"""
        generate_personal_offer(chosen_method INT, argument_1 STRING, argument_2 STRING, argument_3 DOUBLE, argument_4 DOUBLE,
            argument_5 DOUBLE, argument_6 DOUBLE DEFAULT NULL)
        RETURNS TABLE (customer_id BIGINT, required_check_measure DOUBLE, group_name STRING, offer_discount_depth BIGINT)
        COMMENT '(1, first date, last date, coefficient, churn, discount share, margin share) or (2, transactions, coefficient, ...)'
        RETURN SELECT b.customer_id, t.average * {coefficient}, g.group_name, b.best.depth
        FROM ({_best(churn, share, by_method("argument_6", "argument_5"))}) b
        JOIN (SELECT customer_id, try_divide(CAST(sum(transaction_summ) AS DOUBLE), CAST(count(transaction_summ) AS DOUBLE)) AS average
              FROM ({_latest("loyalty_transactions", "customer_id", quantity)}) WHERE {chosen} GROUP BY customer_id) t
          ON t.customer_id = b.customer_id
        JOIN loyalty_sku_groups g ON g.group_id = b.best.group_id
        WHERE {period}"""


def _growth_offers(model: LoyaltyModel) -> str:
    first, last = _moment("first_moment"), _moment("last_moment")
    expected = f"try_divide(timestampdiff(MICROSECOND, {first}, {last}) / 86400000000D, f.customer_frequency)"
    return f"""
        generate_growth_offers(first_moment STRING, last_moment STRING, added_transactions INT DEFAULT 1,
            max_churn DOUBLE DEFAULT 4, max_discount_share DOUBLE DEFAULT 80, margin_share DOUBLE DEFAULT 50)
        RETURNS TABLE (customer_id BIGINT, start_date TIMESTAMP_NTZ, end_date TIMESTAMP_NTZ, required_transactions_count BIGINT,
            group_name STRING, offer_discount_depth INT)
        RETURN SELECT b.customer_id, {first}, {last}, CAST(round(round({expected}, 9)) AS BIGINT) + added_transactions,
            g.group_name, CAST(b.best.depth AS INT)
        FROM ({_best("max_churn", "max_discount_share", "margin_share")}) b
        JOIN loyalty_frequencies f ON f.customer_id = b.customer_id
        JOIN loyalty_sku_groups g ON g.group_id = b.best.group_id
        WHERE f.customer_frequency <> 0 AND {_required(f"{last} > {first}", "the last moment must be later than the first")}"""


def _cross_selling(model: LoyaltyModel) -> str:
    count = _checked("number_of_groups", "number_of_groups >= 1", "number_of_groups must be at least 1")
    cap = "try_divide(CAST(s.sku_margin AS DOUBLE), CAST(s.sku_retail_price AS DOUBLE)) * margin_share"
    return f"""
        generate_cross_selling(number_of_groups INT DEFAULT 5, max_churn DOUBLE DEFAULT 3, max_stability DOUBLE DEFAULT 0.5,
            max_sku_share DOUBLE DEFAULT 100, margin_share DOUBLE DEFAULT 30)
        RETURNS TABLE (customer_id BIGINT, sku_name STRING, offer_discount_depth BIGINT, sku_id BIGINT, group_id BIGINT)
        RETURN SELECT p.customer_id, s.sku_name, p.depth, s.sku_id, p.group_id
        FROM (SELECT customer_id, group_id, {_DEPTH} AS depth,
                row_number() OVER (PARTITION BY customer_id ORDER BY group_affinity_index DESC NULLS LAST, group_id) AS place
              FROM loyalty_pairs WHERE round(group_churn_rate, 9) <= max_churn AND round(group_stability_index, 9) < max_stability) p
        JOIN loyalty_primary_stores h ON h.customer_id = p.customer_id
        JOIN loyalty_best_skus s ON s.transaction_store_id = h.customer_primary_store AND s.group_id = p.group_id
        WHERE p.place <= {count} AND p.depth <= round({cap}, 9)
          AND (max_sku_share >= 100 OR round(coalesce(s.sku_share, 0), 9) <= max_sku_share)"""


def _count_margin(model: LoyaltyModel) -> str:
    kind = model.baskets.agg(F.sum("basket_margin").alias("m")).schema["m"].dataType.simpleString()
    as_of = f"TIMESTAMP_NTZ'{model.as_of.isoformat(sep=' ')}'"
    recent = f"CAST(timestampdiff(MICROSECOND, transaction_datetime, {as_of}) AS DECIMAL(38,0)) < CAST(number AS DECIMAL(20,0)) * 86400000000"
    places = "CASE WHEN count_type = 2 THEN number END"
    chosen = f"number IS NULL OR CASE count_type WHEN 1 THEN {recent} ELSE place <= number END"
    return f"""
        fnc_count_margin(customer BIGINT, product_group BIGINT, count_type INT DEFAULT 1, number BIGINT DEFAULT NULL)
        RETURNS TABLE (group_margin {kind})
        COMMENT 'count_type 1: the last days before the analysis, 2: the last transactions; NULL: all'
        RETURN SELECT sum(basket_margin) FROM ({_latest("loyalty_history", "customer_id, group_id", places)})
        WHERE customer_id = customer AND group_id = product_group AND ({chosen})
          AND {_required("count_type IN (1, 2)", "count_type must be 1 (days) or 2 (transactions)")}"""


# Per function: its statement, and the views it reads. A view's frame is built when it is needed.
FUNCTIONS: dict[str, tuple[Callable[[LoyaltyModel], str], tuple[str, ...]]] = {
    "generate_personal_offer": (_personal_offer, ("loyalty_pairs", "loyalty_transactions", "loyalty_sku_groups")),
    "generate_growth_offers": (_growth_offers, ("loyalty_pairs", "loyalty_frequencies", "loyalty_sku_groups")),
    "generate_cross_selling": (_cross_selling, ("loyalty_pairs", "loyalty_primary_stores", "loyalty_best_skus")),
    "fnc_count_margin": (_count_margin, ("loyalty_history",)),
}


def _pairs(model: LoyaltyModel):
    """Every pair with the indices the functions read, staged: what no filter can pass is worked out
    once for all calls."""
    indices = groups.pair_indices(model.baskets, model.as_of).drop("group_margin", "group_average_discount")
    known = groups.with_affinity(indices, model.purchase_history, model.parts)
    steady = groups.with_stability(known, model.purchase_history, model.parts)
    return model.workspace.staged(steady, "pairs", tidy=True)


def _best_skus(model: LoyaltyModel):
    best = offers.best_margin_skus(model.tables)
    shares = offers.sku_shares(model.tables, best.select("sku_id").distinct()).select("sku_id", "sku_share")
    return model.workspace.staged(best.join(shares, "sku_id", "left"), "best-skus", tidy=True)


# Frequencies and stores carry the hint with them, up to the join with the offers.
VIEWS: dict[str, Callable] = {
    "loyalty_pairs": _pairs,
    "loyalty_history": lambda model: history_of(model.baskets, "basket_margin").where("group_id IS NOT NULL"),
    "loyalty_transactions": lambda model: customer_transactions(model.tables, merged=False),
    "loyalty_frequencies": lambda model: model.customer_frequencies.select("customer_id", "customer_frequency").hint("merge"),
    "loyalty_primary_stores": lambda model: model.primary_stores.hint("merge"),
    "loyalty_best_skus": _best_skus,
    "loyalty_sku_groups": lambda model: model.tables.sku_groups,
}


def register(model: LoyaltyModel, names: tuple[str, ...] = ()) -> None:
    """Create the functions, all or the named ones, in the model's session."""
    chosen = {name: FUNCTIONS[name] for name in names or FUNCTIONS}
    needed = dict.fromkeys(view for _, views in chosen.values() for view in views)
    for view in needed:
        VIEWS[view](model).createOrReplaceTempView(view)
    for statement, _ in chosen.values():
        model.spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {statement(model)}")
