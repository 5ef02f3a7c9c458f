"""SQL counterparts of the quality reports over faulty tables, and of the load path."""

from __future__ import annotations

from tallystick.plans.oracles import _EMAIL, _NAME, _PHONE, _PRODUCT_TEXT, _money, _statement

_FAULTY = """
personal_details AS (
  SELECT CASE WHEN k % 29 = 5 THEN k - 1 WHEN k % 31 = 6 THEN NULL ELSE k END AS customer_id,
    CASE WHEN k % 13 = 1 THEN repeat('A', 101) WHEN k % 5 = 0 THEN 'Anna' ELSE customer_name END AS customer_name,
    CASE WHEN k % 17 = 2 THEN repeat('B', 120) WHEN k % 7 = 0 THEN 'Smith' ELSE customer_surname END AS customer_surname,
    CASE WHEN k % 19 = 3 THEN repeat('c', 100) || '@shop.ru' WHEN k % 37 = 7 THEN 'same@shop.com' ELSE customer_primary_email END AS customer_primary_email,
    CASE WHEN k % 23 = 4 THEN '+7' || repeat('1', 20) ELSE customer_primary_phone END AS customer_primary_phone
  FROM (SELECT customer_id AS k, * FROM people)
), customer_cards AS (
  SELECT CASE WHEN card % 41 = 8 THEN card - 1 WHEN card % 47 = 1 THEN NULL ELSE card END AS customer_card_id,
    CASE WHEN o_custkey % 43 = 9 THEN o_custkey + 100000000 ELSE o_custkey END AS customer_id
  FROM (SELECT DISTINCT o_custkey * 2 + o_orderkey % 2 AS card, o_custkey FROM orders)
), transactions AS (
  SELECT CASE WHEN t % 61 = 3 THEN t - 1 ELSE t END AS transaction_id,
    CASE WHEN t % 53 = 1 THEN NULL WHEN t % 59 = 2 THEN card + 100000000 ELSE card END AS customer_card_id,
    CASE WHEN t % 47 = 0 THEN -summ ELSE summ END AS transaction_summ
  FROM (SELECT o_orderkey AS t, o_custkey * 2 + o_orderkey % 2 AS card, CAST(o_totalprice AS DECIMAL(18,4)) AS summ FROM orders)
), sku_groups AS (
  SELECT CASE g WHEN 5 THEN 6 WHEN 7 THEN NULL ELSE g END AS group_id,
    CASE g WHEN 3 THEN 'Tea!' WHEN 4 THEN repeat('n', 300) ELSE group_name END AS group_name
  FROM (SELECT group_id AS g, group_name FROM named)
), product_matrix AS (
  SELECT CASE WHEN s % 41 = 3 THEN s - 1 ELSE s END AS sku_id,
    CASE WHEN s % 31 = 1 THEN 'the "best"' WHEN s % 37 = 2 THEN repeat('n', 300) ELSE sku_name END AS sku_name,
    CASE WHEN s % 43 = 4 THEN 999 ELSE group_id END AS group_id
  FROM (SELECT sku_id AS s, sku_name, group_id FROM goods)
), checks AS (
  SELECT CASE WHEN m % 53 = 5 THEN t + 100000000 ELSE t END AS transaction_id,
    CASE WHEN m % 47 = 4 THEN NULL WHEN m % 59 = 6 THEN s + 100000000 ELSE s END AS sku_id,
    CAST(CASE WHEN m % 31 = 0 THEN 0 ELSE amount END AS DECIMAL(18,4)) AS sku_amount,
    CAST(CASE WHEN m % 37 = 1 THEN -1 ELSE summ END AS DECIMAL(18,4)) AS sku_summ,
    CAST(CASE WHEN m % 41 = 2 THEN -2 ELSE summ - discount END AS DECIMAL(18,4)) AS sku_summ_paid,
    CAST(CASE WHEN m % 43 = 3 THEN -3 ELSE discount END AS DECIMAL(18,4)) AS sku_discount
  FROM (SELECT transaction_id AS t, sku_id AS s, transaction_id + sku_id AS m, amount, summ, discount FROM lines)
), retail_stores AS (
  SELECT store AS transaction_store_id,
    CASE WHEN m % 41 = 2 THEN NULL WHEN m % 43 = 3 THEN s + 100000000 ELSE s END AS sku_id,
    CAST(CASE WHEN m % 31 = 0 THEN -4 ELSE purchase END AS DECIMAL(18,4)) AS sku_purchase_price,
    CAST(CASE WHEN m % 37 = 1 THEN -5 ELSE retail END AS DECIMAL(18,4)) AS sku_retail_price
  FROM (SELECT store, sku_id AS s, store + sku_id AS m, purchase, retail FROM prices)
)
"""

# What a report names a row by.
_KEYS = {
    "personal_details": ("customer_id",), "customer_cards": ("customer_card_id",), "transactions": ("transaction_id",), "sku_groups": ("group_id",),
    "product_matrix": ("sku_id",), "checks": ("transaction_id", "sku_id"), "retail_stores": ("transaction_store_id", "sku_id"),
}

# (table, column, rule after the column's name, condition that must hold; NULL passes)
_RANGES = [
    ("transactions", "transaction_summ", ">= 0", "transaction_summ >= 0"), ("checks", "sku_amount", "> 0", "sku_amount > 0"),
    ("checks", "sku_summ", ">= 0", "sku_summ >= 0"), ("checks", "sku_summ_paid", ">= 0", "sku_summ_paid >= 0"),
    ("checks", "sku_discount", ">= 0", "sku_discount >= 0"), ("retail_stores", "sku_purchase_price", ">= 0", "sku_purchase_price >= 0"),
    ("retail_stores", "sku_retail_price", ">= 0", "sku_retail_price >= 0"),
]
_PATTERNS = [
    (table, column, "pattern", f"regexp_matches({column}, '{pattern}')")
    for table, column, pattern in (
        ("personal_details", "customer_name", _NAME), ("personal_details", "customer_surname", _NAME),
        ("personal_details", "customer_primary_email", _EMAIL), ("personal_details", "customer_primary_phone", _PHONE),
        ("sku_groups", "group_name", _PRODUCT_TEXT), ("product_matrix", "sku_name", _PRODUCT_TEXT),
    )
]
_REQUIRED = [
    (table, column, "not null", f"{column} IS NOT NULL")
    for table, column in (("transactions", "customer_card_id"), ("checks", "sku_id"), ("retail_stores", "sku_id"))
]
_LENGTHS = [
    (table, column, f"length <= {most}", f"length({column}) <= {most}")
    for table, column, most in (
        ("personal_details", "customer_name", 100), ("personal_details", "customer_surname", 100), ("personal_details", "customer_primary_email", 100),
        ("personal_details", "customer_primary_phone", 15), ("sku_groups", "group_name", 255), ("product_matrix", "sku_name", 255),
    )
]
_UNIQUE = [
    ("personal_details", "customer_id", "primary key", True), ("personal_details", "customer_primary_email", "unique", False),
    ("personal_details", "customer_primary_phone", "unique", False), ("customer_cards", "customer_card_id", "primary key", True),
    ("transactions", "transaction_id", "primary key", True), ("sku_groups", "group_id", "primary key", True), ("product_matrix", "sku_id", "primary key", True),
]
_REFERENCES = [
    ("customer_cards", "customer_id", "personal_details", "customer_id"), ("transactions", "customer_card_id", "customer_cards", "customer_card_id"),
    ("product_matrix", "group_id", "sku_groups", "group_id"), ("checks", "transaction_id", "transactions", "transaction_id"),
    ("checks", "sku_id", "product_matrix", "sku_id"), ("retail_stores", "sku_id", "product_matrix", "sku_id"),
]


def _broken(rules: list[tuple[str, str, str, str]]) -> list[str]:
    def key(table: str) -> str:
        return " || '|' || ".join(f"COALESCE(CAST({c} AS VARCHAR), 'NULL')" for c in _KEYS[table])

    return [
        f"""SELECT '{table}' AS "table", '{column} {rule}' AS rule, {key(table)} AS "key", CAST({column} AS VARCHAR) AS "value"
            FROM {table} WHERE NOT COALESCE({condition}, TRUE)"""
        for table, column, rule, condition in rules
    ]


def _repeated() -> list[str]:
    return [
        f"""SELECT '{table}' AS "table", '{column} {rule}' AS rule, COALESCE(CAST({column} AS VARCHAR), 'NULL') AS "key",
            CAST(COUNT(*) AS VARCHAR) AS "value" FROM {table} GROUP BY {column}
            HAVING {f"COUNT(*) > 1 OR {column} IS NULL" if nulls else f"COUNT(*) > 1 AND {column} IS NOT NULL"}"""
        for table, column, rule, nulls in _UNIQUE
    ]


def _dangling() -> list[str]:
    return [
        f"""SELECT '{table}' AS "table", '{column} in {parent}' AS rule, CAST({column} AS VARCHAR) AS "key", CAST(COUNT(*) AS VARCHAR) AS "value"
            FROM {table} c WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{column}) GROUP BY {column}"""
        for table, column, parent, key in _REFERENCES
    ]


def _counts() -> list[str]:
    rules = [
        f"""SELECT '{table}' AS "table", '{column} {rule}' AS rule, COUNT(*) AS "rows",
            COUNT(*) FILTER (WHERE NOT COALESCE({condition}, TRUE)) AS broken FROM {table}"""
        for table, column, rule, condition in [*_RANGES, *_PATTERNS, *_REQUIRED, *_LENGTHS]
    ]
    rules += [
        f"""SELECT '{table}' AS "table", '{column} {rule}' AS rule, COUNT(*) AS "rows",
            COUNT(*) FILTER (WHERE {f"copies > 1 OR {column} IS NULL" if nulls else f"copies > 1 AND {column} IS NOT NULL"}) AS broken
            FROM (SELECT {column}, COUNT(*) OVER (PARTITION BY {column}) AS copies FROM {table})"""
        for table, column, rule, nulls in _UNIQUE
    ]
    return rules + [
        f"""SELECT '{table}' AS "table", '{column} in {parent}' AS rule, COUNT({column}) AS "rows",
            COUNT({column}) FILTER (WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{column})) AS broken FROM {table} c"""
        for table, column, parent, key in _REFERENCES
    ]


def _over_faulty(parts: list[str]) -> str:
    given = _statement("", "people", "named", "goods", "prices", "lines").rstrip()
    return f"{given},\n{_FAULTY}\n" + "\nUNION ALL\n".join(parts)


# Columns in order, and the tables parents first: what a checked load goes by.
_COLUMNS = {
    "personal_details": "customer_id customer_name customer_surname customer_primary_email customer_primary_phone",
    "customer_cards": "customer_card_id customer_id", "transactions": "transaction_id customer_card_id transaction_summ",
    "sku_groups": "group_id group_name", "product_matrix": "sku_id sku_name group_id",
    "checks": "transaction_id sku_id sku_amount sku_summ sku_summ_paid sku_discount",
    "retail_stores": "transaction_store_id sku_id sku_purchase_price sku_retail_price",
}


def _admitted(outcome: str) -> str:
    """Step by step: sound rows, those whose references exist, and their place among equal keys."""
    given = _statement("", "people", "named", "goods", "prices", "lines").rstrip()
    parts, counts = [], []

    def count(table: str, rule: str, source: str, condition: str) -> None:
        counts.append(f"""SELECT '{table}' AS "table", '{rule}' AS outcome, COUNT(*) AS "rows" FROM {source} c WHERE {condition}""")

    for table, columns in _COLUMNS.items():
        rules = [(c, r, w) for t, c, r, w in [*_RANGES, *_PATTERNS, *_REQUIRED, *_LENGTHS] if t == table]
        rules += [(c, r, f"{c} IS NOT NULL") for t, c, r, null in _UNIQUE if t == table and null]
        references = [(c, p, f"({c} IS NULL OR EXISTS (SELECT 1 FROM {p}_ok p WHERE p.{k} = c.{c}))") for t, c, p, k in _REFERENCES if t == table]
        keys = [(c, r) for t, c, r, _ in _UNIQUE if t == table]
        order = ", ".join(f"{c} NULLS FIRST" for c in [*columns.split(), "rid"])
        places = [f"CASE WHEN {c} IS NULL THEN 1 ELSE row_number() OVER (PARTITION BY {c} ORDER BY {order}) END AS place_{c}" for c, _ in keys]
        parts.append(f"{table}_n AS MATERIALIZED (SELECT row_number() OVER () AS rid, * FROM {table})")
        parts.append(f"{table}_s AS (SELECT * FROM {table}_n WHERE {' AND '.join([f'COALESCE({w}, TRUE)' for _, _, w in rules] or ['TRUE'])})")
        parts.append(f"{table}_r AS (SELECT * FROM {table}_s c WHERE {' AND '.join([w for _, _, w in references] or ['TRUE'])})")
        parts.append(f"{table}_k AS MATERIALIZED (SELECT {', '.join(['*', *places])} FROM {table}_r)")
        parts.append(f"{table}_ok AS MATERIALIZED (SELECT * FROM {table}_k WHERE {' AND '.join([f'place_{c} = 1' for c, _ in keys] or ['TRUE'])})")
        count(table, "accepted", f"{table}_ok", "TRUE")
        for c, r, w in rules:
            count(table, f"{c} {r}", f"{table}_n", f"NOT COALESCE({w}, TRUE)")
        for c, p, w in references:
            count(table, f"{c} in {p}", f"{table}_s", f"NOT {w}")
        for c, r in keys:
            count(table, f"{c} {r}", f"{table}_k", f"place_{c} > 1")
    count("transactions", "row of the table", "orders", "o_orderkey % 71 = 0")
    counts.append("SELECT 'analysis_formation', 'accepted', 1")
    steps = f"{given},\n{_FAULTY},\n" + ",\n".join(parts)
    if outcome == "rows":
        return f"""{steps}\nSELECT transaction_id, customer_card_id, {_money("transaction_summ", "transaction_summ")} FROM transactions_ok"""
    total = 'SELECT "table", outcome, CAST(SUM("rows") AS BIGINT) AS "rows" FROM counted GROUP BY ALL HAVING SUM("rows") > 0 OR outcome = \'accepted\''
    return f"{steps},\ncounted AS (" + "\nUNION ALL\n".join(counts) + f")\n{total}"


_LOADED = "o_orderdate + to_seconds(o_orderkey % 86400)"


def statements() -> dict[str, str]:
    return {
        "dq_unique_faulty": _over_faulty(_repeated()),
        "dq_foreign_keys_faulty": _over_faulty(_dangling()),
        "dq_ranges_faulty": _over_faulty(_broken(_RANGES)),
        "dq_patterns_faulty": _over_faulty(_broken(_PATTERNS)),
        "dq_required_faulty": _over_faulty(_broken(_REQUIRED)),
        "dq_lengths_faulty": _over_faulty(_broken(_LENGTHS)),
        "dq_rule_counts_faulty": _over_faulty(_counts()),
        "load_checked": _admitted("counts"),
        "load_checked_transactions": _admitted("rows"),
        "load_repeated": _statement(
            """SELECT 'sku_groups' AS "table", COUNT(*) AS "rows" FROM named UNION ALL SELECT 'product_matrix', COUNT(*) FROM part
               UNION ALL SELECT 'files of sku_groups', 1 UNION ALL SELECT 'files of product_matrix', 2""",
            "named",
        ),
        "load_day_first": f"""SELECT o_orderkey AS transaction_id, o_custkey * 2 + o_orderkey % 2 AS customer_card_id,
            CASE WHEN o_orderkey % 10 <> 3 THEN {_money("CAST(o_totalprice AS DECIMAL(18,4))", "x").removesuffix(" AS x")} END AS transaction_summ,
            CASE WHEN o_orderkey % 10 <> 7 THEN {_LOADED} END AS transaction_datetime, o_orderkey % 5 AS transaction_store_id FROM orders""",
        "load_empty_fields": _statement(
            """SELECT customer_id, CASE WHEN customer_id % 4 = 1 THEN '' ELSE customer_name END AS customer_name,
               CASE WHEN customer_id % 4 <> 2 THEN customer_surname END AS customer_surname, customer_primary_email, customer_primary_phone FROM people""",
            "people",
        ),
        "load_all_tables": _statement(
            """SELECT 'personal_details' AS "table", COUNT(*) AS "rows" FROM customer
               UNION ALL SELECT 'customer_cards', COUNT(*) FROM (SELECT DISTINCT o_custkey, o_orderkey % 2 FROM orders)
               UNION ALL SELECT 'transactions', COUNT(*) FROM orders UNION ALL SELECT 'sku_groups', COUNT(*) FROM named
               UNION ALL SELECT 'product_matrix', COUNT(*) FROM part UNION ALL SELECT 'checks', COUNT(*) FROM lineitem
               UNION ALL SELECT 'retail_stores', COUNT(*) FROM prices UNION ALL SELECT 'analysis_formation', 1""",
            "named",
            "prices",
        ),
    }
