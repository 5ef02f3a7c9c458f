"""SQL counterparts of the registered queries, written for another engine.

They state each result directly (range joins, self joins, correlated ranks) and share no
code with the plans they check.
"""

from __future__ import annotations

# Named parts in dependency order; a statement gets the ones it names and what those need.
_PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "owners": (
        (),
        """SELECT DISTINCT o_custkey * 2 + o_orderkey % 2 AS card, o_custkey AS customer_id
           FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)""",
    ),
    "visits": (
        ("owners",),
        """SELECT w.customer_id, o.o_orderkey AS transaction_id, o.o_orderdate AS moment,
                  CAST(o.o_totalprice AS DECIMAL(18,4)) AS summ, o.o_orderkey % 5 AS store
           FROM orders o JOIN owners w ON w.card = o.o_custkey * 2 + o.o_orderkey % 2""",
    ),
    "goods": (
        (),
        """SELECT p_partkey AS sku_id, p_name AS sku_name,
                  CAST(regexp_extract(p_brand, '[0-9]+') AS BIGINT) AS group_id FROM part""",
    ),
    "named": (
        (),
        """SELECT DISTINCT CAST(regexp_extract(p_brand, '[0-9]+') AS BIGINT) AS group_id,
                  p_brand AS group_name FROM part""",
    ),
    "prices": (
        (),
        """SELECT s.store, p_partkey AS sku_id,
                  CAST(p_retailprice * (50 + (p_partkey + 7 * s.store) % 40) / 100
                       AS DECIMAL(18,4)) AS purchase,
                  CAST(p_retailprice AS DECIMAL(18,4)) AS retail
           FROM part, (VALUES (0), (1), (2), (3), (4)) s(store)""",
    ),
    "lines": (
        (),
        """SELECT l_orderkey AS transaction_id, l_partkey AS sku_id,
                  CAST(l_quantity AS DECIMAL(18,4)) AS amount,
                  CAST(l_extendedprice AS DECIMAL(18,4)) AS summ,
                  CAST(l_extendedprice * l_discount AS DECIMAL(18,4)) AS discount
           FROM lineitem""",
    ),
    "bought": (
        ("visits", "goods", "lines"),
        """SELECT v.customer_id, v.transaction_id, v.moment, v.store, l.sku_id, g.group_id,
                  l.amount, l.summ, l.summ - l.discount AS paid, l.discount,
                  CAST(l.discount AS DOUBLE) / NULLIF(CAST(l.summ AS DOUBLE), 0) AS share
           FROM visits v JOIN lines l USING (transaction_id) JOIN goods g USING (sku_id)""",
    ),
    "history": (
        ("bought", "prices"),
        """SELECT b.customer_id, b.transaction_id, b.moment, b.group_id,
                  SUM(p.purchase * b.amount) AS cost, SUM(b.summ) AS summ, SUM(b.paid) AS paid
           FROM bought b JOIN prices p ON p.sku_id = b.sku_id AND p.store = b.store
           GROUP BY ALL""",
    ),
    "spans": (
        ("history",),
        """SELECT customer_id, group_id, first_at, last_at, n,
                  CASE WHEN n = 1 THEN 1.0::DOUBLE
                       ELSE (date_diff('microsecond', first_at, last_at) / 86400e6 + 1) / n
                  END AS frequency
           FROM (SELECT customer_id, group_id, MIN(moment) AS first_at, MAX(moment) AS last_at,
                        COUNT(DISTINCT transaction_id) AS n FROM history GROUP BY 1, 2)""",
    ),
    "least": (
        ("bought",),
        """SELECT customer_id, group_id,
                  CASE WHEN MAX(share) = 0 THEN 0.0::DOUBLE
                       ELSE MIN(share) FILTER (WHERE share > 0) END AS least
           FROM bought GROUP BY 1, 2""",
    ),
    "reduced": (
        ("bought",),
        """SELECT customer_id, group_id,
                  COUNT(DISTINCT transaction_id) FILTER (WHERE discount > 0) AS transactions,
                  COUNT(transaction_id) FILTER (WHERE discount > 0) AS check_lines
           FROM bought GROUP BY 1, 2""",
    ),
    "periods": (
        ("spans", "least"),
        "SELECT * FROM spans JOIN least USING (customer_id, group_id)",
    ),
    "affinity": (
        ("spans", "history"),
        """SELECT s.customer_id, s.group_id,
                  CAST(s.n AS DOUBLE) / COUNT(DISTINCT h.transaction_id) AS affinity
           FROM spans s JOIN history h
             ON h.customer_id = s.customer_id AND h.moment BETWEEN s.first_at AND s.last_at
           GROUP BY s.customer_id, s.group_id, s.n""",
    ),
    "gaps": (
        ("history", "spans"),
        """SELECT customer_id, group_id, transaction_id, gap, frequency,
                  ABS(gap - frequency) AS deviation,
                  ABS(gap - frequency) / frequency AS relative
           FROM (SELECT customer_id, group_id, transaction_id,
                        date_diff('microsecond', LAG(moment) OVER w, moment) / 86400e6 AS gap
                 FROM history
                 WINDOW w AS (PARTITION BY customer_id, group_id ORDER BY moment, transaction_id))
           JOIN spans USING (customer_id, group_id)""",
    ),
    "stability": (
        ("gaps",),
        """SELECT customer_id, group_id, AVG(relative) AS stability FROM gaps GROUP BY 1, 2""",
    ),
    "margin": (
        ("history",),
        """SELECT customer_id, group_id, SUM(paid - cost) AS margin,
                  SUM(paid) FILTER (WHERE paid <> summ) AS reduced_paid,
                  SUM(summ) FILTER (WHERE paid <> summ) AS reduced_summ,
                  CAST(SUM(summ) AS DOUBLE) / COUNT(summ) AS average_summ,
                  CAST(SUM(cost) AS DOUBLE) / COUNT(cost) AS average_cost
           FROM history GROUP BY 1, 2""",
    ),
    "recent_margin": (
        ("history",),
        """SELECT customer_id, group_id, SUM(paid - cost) AS margin
           FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id, group_id
                                              ORDER BY moment DESC, transaction_id DESC) AS place
                 FROM history)
           WHERE place <= 2 GROUP BY 1, 2""",
    ),
    "indices": (
        ("periods", "affinity", "stability", "margin", "reduced"),
        """SELECT p.customer_id, p.group_id, a.affinity,
                  date_diff('microsecond', p.last_at, (SELECT MAX(o_orderdate) + INTERVAL 1 DAY FROM orders)) / 86400e6
                    / p.frequency AS churn,
                  s.stability, m.margin, CAST(r.transactions AS DOUBLE) / p.n AS discount_share,
                  CASE WHEN p.least > 0 THEN p.least END AS least,
                  CAST(m.reduced_paid AS DOUBLE) / CAST(m.reduced_summ AS DOUBLE)
                    AS average_discount,
                  m.average_summ, m.average_cost
           FROM periods p
           JOIN affinity a USING (customer_id, group_id)
           JOIN stability s USING (customer_id, group_id)
           JOIN margin m USING (customer_id, group_id)
           JOIN reduced r USING (customer_id, group_id)""",
    ),
    "metrics": (
        ("visits",),
        """SELECT *, inactive / NULLIF(frequency, 0) AS churn_rate
           FROM (SELECT customer_id, COUNT(*) AS n,
                        CAST(SUM(summ) AS DOUBLE) / COUNT(*) AS average_check,
                        date_diff('microsecond', MIN(moment), MAX(moment)) / 86400e6 / COUNT(*)
                          AS frequency,
                        date_diff('microsecond', MAX(moment), (SELECT MAX(o_orderdate) + INTERVAL 1 DAY FROM orders)) / 86400e6
                          AS inactive
                 FROM visits GROUP BY 1)""",
    ),
    "ranked": (
        ("metrics",),
        """SELECT *,
                  ROW_NUMBER() OVER (ORDER BY average_check DESC NULLS LAST, customer_id)
                    AS check_place,
                  ROW_NUMBER() OVER (ORDER BY frequency ASC NULLS LAST, customer_id)
                    AS frequency_place,
                  COUNT(*) OVER () AS size
           FROM metrics""",
    ),
    "segments": (
        ("ranked",),
        """SELECT *,
                  CASE WHEN check_place <= 0.10 * size THEN 'High'
                       WHEN check_place <= 0.35 * size THEN 'Medium' ELSE 'Low' END AS check_level,
                  CASE WHEN frequency_place <= 0.10 * size THEN 'Often'
                       WHEN frequency_place <= 0.35 * size THEN 'Occasionally'
                       ELSE 'Rarely' END AS frequency_level,
                  CASE WHEN churn_rate <= 2 THEN 'Low' WHEN churn_rate <= 5 THEN 'Medium'
                       ELSE 'High' END AS churn_level
           FROM ranked""",
    ),
    "levels": (
        (),
        """SELECT * FROM (VALUES ('Low', 0), ('Medium', 1), ('High', 2)) c(check_level, a),
                         (VALUES ('Rarely', 0), ('Occasionally', 1), ('Often', 2))
                           f(frequency_level, b),
                         (VALUES ('Low', 0), ('Medium', 1), ('High', 2)) x(churn_level, c)""",
    ),
    "numbered": (
        ("segments", "levels"),
        """SELECT s.*, ROW_NUMBER FROM segments s JOIN
             (SELECT check_level, frequency_level, churn_level,
                     ROW_NUMBER() OVER (ORDER BY a, b, c) AS row_number FROM levels)
           USING (check_level, frequency_level, churn_level)""",
    ),
    "shares": (
        ("visits",),
        """SELECT v.customer_id, v.store, COUNT(*) AS n, MAX(v.moment) AS last_at,
                  CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM visits w
                                              WHERE w.customer_id = v.customer_id) * 100 AS share
           FROM visits v GROUP BY 1, 2""",
    ),
    "recent": (
        ("visits",),
        """SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id
                                        ORDER BY moment DESC, transaction_id DESC) AS place
           FROM visits""",
    ),
    "loyal": (
        ("recent",),
        """SELECT customer_id, arg_min(store, place) AS store FROM recent WHERE place <= 3
           GROUP BY 1 HAVING COUNT(DISTINCT store) = 1""",
    ),
    "home": (
        ("shares", "loyal"),
        """SELECT t.customer_id, COALESCE(l.store, t.store) AS store
           FROM (SELECT customer_id, store,
                        ROW_NUMBER() OVER (PARTITION BY customer_id
                                           ORDER BY n DESC, last_at DESC, store) AS place
                 FROM shares) t
           LEFT JOIN loyal l USING (customer_id) WHERE t.place = 1""",
    ),
    "sold": (
        ("lines", "goods"),
        "SELECT DISTINCT transaction_id, sku_id, group_id FROM lines JOIN goods USING (sku_id)",
    ),
    "sku_part": (
        ("sold", "goods"),
        """SELECT s.sku_id, s.group_id,
                  CAST(s.n AS DOUBLE) / g.n * 100 AS share
           FROM (SELECT sku_id, group_id, COUNT(DISTINCT transaction_id) AS n
                 FROM sold GROUP BY 1, 2) s
           JOIN (SELECT group_id, COUNT(DISTINCT transaction_id) AS n
                 FROM sold GROUP BY 1) g USING (group_id)""",
    ),
    "best": (
        ("prices", "goods"),
        """SELECT store, group_id, sku_id, sku_name, retail, retail - purchase AS margin
           FROM prices JOIN goods USING (sku_id)
           QUALIFY ROW_NUMBER() OVER (PARTITION BY store, group_id
                                      ORDER BY retail - purchase DESC, sku_id) = 1""",
    ),
    "people": (
        (),
        """SELECT c_custkey AS customer_id, c_name AS customer_name,
                  c_mktsegment AS customer_surname,
                  lower(replace(c_name, '#', '.')) || '@shop.'
                    || lower(substr(c_mktsegment, 1, 2 + c_nationkey % 4))
                    AS customer_primary_email,
                  '+7' || lpad(CAST(CAST(ROUND(c_acctbal) AS BIGINT) AS VARCHAR), 10, '0')
                    AS customer_primary_phone
           FROM customer""",
    ),
}


def _statement(body: str, *needs: str) -> str:
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in _PARTS[name][0]:
            add(need)
        if name not in wanted:
            wanted.append(name)

    for need in needs:
        add(need)
    if not wanted:
        return body
    parts = ",\n".join(f"{name} AS ({_PARTS[name][1]})" for name in wanted)
    return f"WITH {parts}\n{body}"


def _money(expression: str, name: str) -> str:
    return f"ROUND(CAST({expression} AS DOUBLE), 4) AS {name}"


def _real(expression: str, name: str) -> str:
    return f"ROUND({expression}, 6) AS {name}"


_PAIR = "customer_id, group_id"

_HISTORY = f"""SELECT customer_id, transaction_id, moment AS transaction_datetime, group_id,
  {_money("cost", "group_cost")}, {_money("summ", "group_summ")},
  {_money("paid", "group_summ_paid")} FROM history"""

_PERIODS = f"""SELECT {_PAIR}, first_at AS first_group_purchase_date,
  last_at AS last_group_purchase_date, n AS group_purchase,
  {_real("frequency", "group_frequency")}, {_real("least", "group_min_discount")} FROM periods"""


def _groups(margin: str) -> str:
    return f"""SELECT i.customer_id, i.group_id, {_real("affinity", "group_affinity_index")},
      {_real("churn", "group_churn_rate")}, {_real("stability", "group_stability_index")},
      {_money(margin, "group_margin")}, {_real("discount_share", "group_discount_share")},
      {_real("least", "group_minimum_discount")},
      {_real("average_discount", "group_average_discount")} FROM indices i"""


_DEPTH = "CAST(CEIL(ROUND(least * 20, 9)) * 5 AS BIGINT)"


def _eligible(churn: float, share: float, margin: float) -> str:
    return f"""SELECT *, {_DEPTH} AS depth FROM indices
      WHERE ROUND(churn, 9) <= {churn} AND ROUND(discount_share, 9) < {share} / 100.0
        AND {_DEPTH} < ROUND((average_summ - average_cost) * {margin}::DOUBLE / average_cost, 9)"""


def _best(churn: float, share: float, margin: float) -> str:
    return f"""SELECT * FROM ({_eligible(churn, share, margin)})
      QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id
                                 ORDER BY affinity DESC, group_id) = 1"""


_IN_PERIOD = "moment BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '2000-12-31'"


def _check(source: str, condition: str) -> str:
    return f"""SELECT customer_id, CAST(SUM(summ) AS DOUBLE) / COUNT(summ) * 1.15::DOUBLE AS target
               FROM {source} WHERE {condition} GROUP BY 1"""


def _check_offers(rewarded: str, check: str) -> str:
    return f"""SELECT r.customer_id, {_real("target", "required_check_measure")}, group_name,
      depth AS offer_discount_depth
      FROM ({rewarded}) r JOIN ({check}) USING (customer_id) JOIN named USING (group_id)"""


def _cross(
    groups: int, churn: float, stability: float, sku_share: float, ids: str = ""
) -> str:
    return f"""SELECT c.customer_id, b.sku_name, c.depth AS offer_discount_depth {ids}
      FROM (SELECT *, {_DEPTH} AS depth FROM indices
            WHERE ROUND(churn, 9) <= {churn} AND ROUND(stability, 9) < {stability}
            QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id
                                       ORDER BY affinity DESC, group_id) <= {groups}) c
      JOIN home h ON h.customer_id = c.customer_id
      JOIN best b ON b.store = h.store AND b.group_id = c.group_id
      LEFT JOIN sku_part p ON p.sku_id = b.sku_id
      WHERE ROUND(COALESCE(p.share, 0), 9) <= {sku_share}
        AND c.depth <= ROUND(CAST(b.margin AS DOUBLE) / CAST(b.retail AS DOUBLE) * 30::DOUBLE, 9)"""


# --- data quality -----------------------------------------------------------------------

_PRODUCT_TEXT = r"^[A-Za-zА-Яа-я0-9\s\-+=@#$%^&*()\[\]{};:,.<>?/|_~]+$"
_NAME = r"^([А-ЯA-Z][а-яa-z\- ]+)$"
_EMAIL = r"(?i)^[A-Za-z0-9._%-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,4}$"
_PHONE = r"^\+7[0-9]{10}$"

# table, source, key, value, rule, condition that must hold (NULL passes)
_RANGES = [
    ("transactions", "orders", "o_orderkey", "CAST(o_totalprice AS DECIMAL(18,4))",
     "transaction_summ >= 0", "o_totalprice >= 0"),
    ("checks", "lineitem", "l_orderkey || '|' || l_partkey", "CAST(l_quantity AS DECIMAL(18,4))",
     "sku_amount > 0", "l_quantity > 0"),
    ("checks", "lineitem", "l_orderkey || '|' || l_partkey",
     "CAST(l_extendedprice AS DECIMAL(18,4))", "sku_summ >= 0", "l_extendedprice >= 0"),
    ("checks", "lines", "transaction_id || '|' || sku_id", "summ - discount",
     "sku_summ_paid >= 0", "summ - discount >= 0"),
    ("checks", "lines", "transaction_id || '|' || sku_id", "discount",
     "sku_discount >= 0", "discount >= 0"),
    ("retail_stores", "prices", "store || '|' || sku_id", "purchase",
     "sku_purchase_price >= 0", "purchase >= 0"),
    ("retail_stores", "prices", "store || '|' || sku_id", "retail",
     "sku_retail_price >= 0", "retail >= 0"),
]


def _patterns(name: str) -> list[tuple[str, str, str, str, str, str]]:
    people = [
        (column, pattern)
        for column, pattern in (
            ("customer_name", name),
            ("customer_surname", name),
            ("customer_primary_email", _EMAIL),
            ("customer_primary_phone", _PHONE),
        )
    ]
    return [
        ("personal_details", "people", "customer_id", c, f"{c} pattern",
         f"regexp_matches({c}, '{p}')")
        for c, p in people
    ] + [
        ("sku_groups", "named", "group_id", "group_name", "group_name pattern",
         f"regexp_matches(group_name, '{_PRODUCT_TEXT}')"),
        ("product_matrix", "goods", "sku_id", "sku_name", "sku_name pattern",
         f"regexp_matches(sku_name, '{_PRODUCT_TEXT}')"),
    ]


_REQUIRED = [
    ("transactions", "orders", "o_orderkey", "NULL", "customer_card_id not null",
     "o_custkey * 2 + o_orderkey % 2 IS NOT NULL"),
    ("checks", "lineitem", "l_orderkey || '|' || l_partkey", "NULL", "sku_id not null",
     "l_partkey IS NOT NULL"),
    ("retail_stores", "prices", "store || '|' || sku_id", "NULL", "sku_id not null",
     "sku_id IS NOT NULL"),
]

_LENGTHS = [
    ("personal_details", "people", "customer_id", c, f"{c} length <= {n}", f"length({c}) <= {n}")
    for c, n in (
        ("customer_name", 100),
        ("customer_surname", 100),
        ("customer_primary_email", 100),
        ("customer_primary_phone", 15),
    )
] + [
    ("sku_groups", "named", "group_id", "group_name", "group_name length <= 255",
     "length(group_name) <= 255"),
    ("product_matrix", "goods", "sku_id", "sku_name", "sku_name length <= 255",
     "length(sku_name) <= 255"),
]


def _violations(rules: list[tuple[str, str, str, str, str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{table}' AS "table", '{rule}' AS rule, CAST({key} AS VARCHAR) AS "key",
            CAST({value} AS VARCHAR) AS "value"
            FROM {source} WHERE NOT COALESCE({condition}, TRUE)"""
        for table, source, key, value, rule, condition in rules
    )


def _counts(rules: list[tuple[str, str, str, str, str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{table}' AS "table", '{rule}' AS rule, COUNT(*) AS "rows",
            COUNT(*) FILTER (WHERE NOT COALESCE({condition}, TRUE)) AS broken FROM {source}"""
        for table, source, _, _, rule, condition in rules
    )


def _repeats(table: str, source: str, column: str, rule: str, nulls: bool) -> str:
    missing = f"OR {column} IS NULL" if nulls else f"AND {column} IS NOT NULL"
    return f"""SELECT '{table}' AS "table", '{rule}' AS rule,
        COALESCE(CAST({column} AS VARCHAR), 'NULL') AS "key", CAST(COUNT(*) AS VARCHAR) AS "value"
        FROM {source} GROUP BY {column} HAVING COUNT(*) > 1 {missing}"""


def _dangling(table: str, source: str, column: str, rule: str, parent: str, key: str) -> str:
    return f"""SELECT '{table}' AS "table", '{rule}' AS rule, CAST({column} AS VARCHAR) AS "key",
        CAST(COUNT(*) AS VARCHAR) AS "value" FROM {source}
        WHERE {column} IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = {column})
        GROUP BY {column}"""


def _repeat_counts(table: str, source: str, column: str, rule: str, nulls: bool) -> str:
    missing = f"OR {column} IS NULL" if nulls else f"AND {column} IS NOT NULL"
    return f"""SELECT '{table}' AS "table", '{rule}' AS rule, COUNT(*) AS "rows",
        COUNT(*) FILTER (WHERE copies > 1 {missing}) AS broken
        FROM (SELECT {column}, COUNT(*) OVER (PARTITION BY {column}) AS copies FROM {source})"""


def _dangling_counts(
    table: str, source: str, column: str, rule: str, parent: str, key: str
) -> str:
    return f"""SELECT '{table}' AS "table", '{rule}' AS rule, COUNT({column}) AS "rows",
        COUNT({column}) FILTER (WHERE {column} NOT IN (SELECT {key} FROM {parent})) AS broken
        FROM {source}"""


_UNIQUE = [
    ("personal_details", "people", "customer_id", "customer_id primary key", True),
    ("personal_details", "people", "customer_primary_email", "customer_primary_email unique",
     False),
    ("personal_details", "people", "customer_primary_phone", "customer_primary_phone unique",
     False),
    ("customer_cards", "owners", "card", "customer_card_id primary key", True),
    ("transactions", "orders", "o_orderkey", "transaction_id primary key", True),
    ("sku_groups", "named", "group_id", "group_id primary key", True),
    ("product_matrix", "goods", "sku_id", "sku_id primary key", True),
]

_REFERENCES = [
    ("customer_cards",
     "(SELECT DISTINCT o_custkey, o_custkey * 2 + o_orderkey % 2 AS card FROM orders)",
     "o_custkey", "customer_id in personal_details", "customer", "c_custkey"),
    ("transactions", "(SELECT o_custkey * 2 + o_orderkey % 2 AS used FROM orders)", "used",
     "customer_card_id in customer_cards",
     "(SELECT DISTINCT o_custkey * 2 + o_orderkey % 2 AS card FROM orders)", "card"),
    ("product_matrix", "(SELECT group_id AS used FROM goods)", "used", "group_id in sku_groups",
     "named", "group_id"),
    ("checks", "lineitem", "l_orderkey", "transaction_id in transactions", "orders",
     "o_orderkey"),
    ("checks", "lineitem", "l_partkey", "sku_id in product_matrix", "part", "p_partkey"),
    ("retail_stores", "(SELECT sku_id AS used FROM prices)", "used", "sku_id in product_matrix",
     "part", "p_partkey"),
]


def statements() -> dict[str, str]:
    known = _statements()
    pair = "USING (customer_id, group_id)"
    parts = (known[name] for name in ("group_churn", "group_discount_share", "group_average_discount"))
    # However the data came in, the result is that of all of them.
    known["periods_appended"] = known["periods"]
    known["purchase_history_bucketed"] = known["purchase_history"]
    known["group_indices_appended"] = "SELECT * FROM ({}) a JOIN ({}) b {pair} JOIN ({}) c {pair}".format(*parts, pair=pair)
    # A call in SQL gives the rows of the call in Python.
    for name in (
        "offers_avg_check_period", "offers_avg_check_last_n", "offers_visit_growth", "offers_cross_sell",
        "offers_cross_sell_rare_skus", "group_margin_all", "group_margin_last_n", "group_margin_of_pair",
    ):
        known[f"sql_{name}"] = known[name]
    return known


def _statements() -> dict[str, str]:
    s = _statement
    return {
        "purchase_history": s(_HISTORY, "history"),
        "purchase_history_of_group": s(f"{_HISTORY} WHERE group_id = 1", "history"),
        "purchase_history_costly": s(f"{_HISTORY} WHERE cost > 1000", "history"),
        "periods": s(_PERIODS, "periods"),
        "periods_of_group": s(f"{_PERIODS} WHERE group_id = 4", "periods"),
        "periods_begun_since": s(
            f"{_PERIODS} WHERE first_at > TIMESTAMP '2000-01-01'", "periods"
        ),
        "periods_frequent": s(f"{_PERIODS} WHERE n > 2", "periods"),
        "group_min_discount": s(
            f"SELECT {_PAIR}, {_real('least', 'group_min_discount')} FROM least", "least"
        ),
        "customer_check_segments": s(
            f"""SELECT customer_id, {_real("average_check", "customer_average_check")},
                check_level AS customer_average_check_segment FROM segments""",
            "segments",
        ),
        "customer_frequency_segments": s(
            f"""SELECT customer_id, {_real("frequency", "customer_frequency")},
                frequency_level AS customer_frequency_segment FROM segments""",
            "segments",
        ),
        "customer_churn": s(
            f"""SELECT customer_id, {_real("inactive", "customer_inactive_period")},
                {_real("churn_rate", "customer_churn_rate")},
                churn_level AS customer_churn_segment FROM segments""",
            "segments",
        ),
        "customer_segment_number": s(
            "SELECT customer_id, row_number AS customer_segment FROM numbered", "numbered"
        ),
        "ntile_segments": s(
            """SELECT customer_id, check_bucket,
                 CASE WHEN check_bucket <= 0.10 * size THEN 'High'
                      WHEN check_bucket <= 0.35 * size THEN 'Medium' ELSE 'Low'
                 END AS check_segment,
                 frequency_bucket,
                 CASE WHEN frequency_bucket <= 0.10 * size THEN 'Often'
                      WHEN frequency_bucket <= 0.35 * size THEN 'Occasionally' ELSE 'Rarely'
                 END AS frequency_segment
               FROM (SELECT customer_id, COUNT(*) OVER () AS size,
                       NTILE(100) OVER (ORDER BY average_check DESC NULLS LAST, customer_id)
                         AS check_bucket,
                       NTILE(100) OVER (ORDER BY frequency ASC NULLS LAST, customer_id)
                         AS frequency_bucket
                     FROM metrics)""",
            "metrics",
        ),
        "store_share": s(
            f"""SELECT customer_id, store AS transaction_store_id,
                {_real("share", "transaction_percentage")}, last_at AS last_transaction
                FROM shares""",
            "shares",
        ),
        "loyal_customers": s("SELECT customer_id, store AS loyal_store FROM loyal", "loyal"),
        "primary_store": s(
            "SELECT customer_id, store AS customer_primary_store FROM home", "home"
        ),
        "customers_view": s(
            f"""SELECT customer_id, {_real("average_check", "customer_average_check")},
                check_level AS customer_average_check_segment,
                {_real("frequency", "customer_frequency")},
                frequency_level AS customer_frequency_segment,
                {_real("inactive", "customer_inactive_period")},
                {_real("churn_rate", "customer_churn_rate")},
                churn_level AS customer_churn_segment, row_number AS customer_segment,
                store AS customer_primary_store
                FROM numbered JOIN home USING (customer_id)""",
            "numbered",
            "home",
        ),
        "customer_groups": s(f"SELECT DISTINCT {_PAIR} FROM bought", "bought"),
        "group_affinity": s(
            f"SELECT {_PAIR}, {_real('affinity', 'group_affinity_index')} FROM affinity",
            "affinity",
        ),
        "group_affinity_rows": s(
            f"""SELECT s.customer_id, s.group_id,
                {_real("CAST(s.n AS DOUBLE) / COUNT(h.transaction_id)", "group_affinity_index")}
                FROM spans s JOIN history h
                  ON h.customer_id = s.customer_id AND h.moment BETWEEN s.first_at AND s.last_at
                GROUP BY s.customer_id, s.group_id, s.n""",
            "spans",
        ),
        "group_churn": s(
            f"""SELECT {_PAIR}, {_real(
                "date_diff('microsecond', last_at, (SELECT MAX(o_orderdate) + INTERVAL 1 DAY FROM orders)) / 86400e6 / frequency",
                "group_churn_rate")} FROM spans""",
            "spans",
        ),
        "group_intervals": s(
            f"""SELECT {_PAIR}, transaction_id, {_real("gap", "gap")},
                {_real("deviation", "deviation")}, {_real("relative", "relative_deviation")}
                FROM gaps WHERE gap IS NOT NULL""",
            "gaps",
        ),
        "group_stability": s(
            f"SELECT {_PAIR}, {_real('stability', 'group_stability_index')} FROM stability",
            "stability",
        ),
        "group_margin_all": s(
            f"SELECT {_PAIR}, {_money('margin', 'group_margin')} FROM margin", "margin"
        ),
        "group_margin_last_days": s(
            f"""SELECT {_PAIR}, {_money("SUM(paid - cost)", "group_margin")} FROM history
                WHERE moment > (SELECT MAX(o_orderdate) + INTERVAL 1 DAY FROM orders) - 365 * INTERVAL 1 DAY GROUP BY {_PAIR}""",
            "history",
        ),
        "group_margin_last_n": s(
            f"SELECT {_PAIR}, {_money('margin', 'group_margin')} FROM recent_margin",
            "recent_margin",
        ),
        "group_margin_of_customer": s(
            f"""SELECT {_PAIR}, {_money('margin', 'group_margin')} FROM recent_margin
                WHERE customer_id = 7""",
            "recent_margin",
        ),
        "group_margin_of_pair": s(
            f"""SELECT {_PAIR}, {_money('margin', 'group_margin')} FROM margin
                WHERE customer_id = 7 AND group_id = 11""",
            "margin",
        ),
        "group_discount_share": s(
            f"""SELECT {_PAIR}, {_real("CAST(transactions AS DOUBLE) / n", "group_discount_share")}
                FROM spans JOIN reduced USING ({_PAIR})""",
            "spans",
            "reduced",
        ),
        "group_discount_lines": s(
            f"""SELECT {_PAIR}, {_real("CAST(check_lines AS DOUBLE) / n", "group_discount_share")}
                FROM spans JOIN reduced USING ({_PAIR})""",
            "spans",
            "reduced",
        ),
        "group_average_discount": s(
            f"""SELECT {_PAIR},
                {_real("CASE WHEN least > 0 THEN least END", "group_minimum_discount")},
                {_real("CAST(reduced_paid AS DOUBLE) / CAST(reduced_summ AS DOUBLE)",
                       "group_average_discount")}
                FROM margin JOIN least USING ({_PAIR})""",
            "margin",
            "least",
        ),
        "groups_view": s(_groups("i.margin"), "indices"),
        "groups_view_recent_margin": s(
            f"{_groups('r.margin')} JOIN recent_margin r USING ({_PAIR})",
            "indices",
            "recent_margin",
        ),
        "max_offer_discount": s(
            f"""SELECT {_PAIR},
                {_real("(average_summ - average_cost) * 30::DOUBLE / average_cost",
                       "max_discount")} FROM margin""",
            "margin",
        ),
        "target_check_last_n": s(
            f"""SELECT customer_id, {_real("target", "required_check_measure")}
                FROM ({_check("recent", "place <= 3")})""",
            "recent",
        ),
        "target_check_period": s(
            f"""SELECT customer_id, {_real("target", "required_check_measure")}
                FROM ({_check("visits", _IN_PERIOD)})""",
            "visits",
        ),
        "offers_avg_check_period": s(
            _check_offers(_best(3, 70, 30), _check("visits", _IN_PERIOD)), "indices", "named"
        ),
        "offers_avg_check_last_n": s(
            _check_offers(_best(3, 70, 30), _check("recent", "place <= 100")),
            "indices",
            "named",
            "recent",
        ),
        "offers_avg_check_all_groups": s(
            _check_offers(_eligible(3, 70, 30), _check("recent", "place <= 100")),
            "indices",
            "named",
            "recent",
        ),
        "offers_visit_growth": s(
            f"""SELECT r.customer_id, TIMESTAMP '2022-06-20' AS start_date,
                TIMESTAMP '2022-08-25' AS end_date,
                CAST(ROUND(ROUND(date_diff('microsecond', TIMESTAMP '2022-06-20',
                     TIMESTAMP '2022-08-25') / 86400e6 / m.frequency, 9)) AS BIGINT) + 1
                  AS required_transactions_count,
                group_name, depth AS offer_discount_depth
                FROM ({_best(4, 80, 50)}) r JOIN metrics m USING (customer_id)
                JOIN named USING (group_id) WHERE m.frequency <> 0""",
            "indices",
            "metrics",
            "named",
        ),
        "sku_share": s(
            f"SELECT sku_id, group_id, {_real('share', 'sku_share')} FROM sku_part", "sku_part"
        ),
        "best_margin_sku": s(
            f"""SELECT CAST(store AS BIGINT) AS transaction_store_id, group_id, sku_id, sku_name,
                {_money("retail", "sku_retail_price")}, {_money("margin", "sku_margin")}
                FROM best""",
            "best",
        ),
        "offers_cross_sell": s(
            _cross(5, 3, 0.5, 100), "indices", "home", "best", "sku_part"
        ),
        "offers_cross_sell_rare_skus": s(
            _cross(5, 10, 1.0, 1.2, ", b.sku_id, c.group_id"), "indices", "home", "best", "sku_part"
        ),
        "dq_unique": s(
            "\nUNION ALL\n".join(_repeats(*rule) for rule in _UNIQUE),
            "people",
            "owners",
            "named",
            "goods",
        ),
        "dq_foreign_keys": s(
            "\nUNION ALL\n".join(_dangling(*rule) for rule in _REFERENCES),
            "goods",
            "named",
            "prices",
        ),
        "dq_ranges": s(_violations(_RANGES), "lines", "prices"),
        "dq_patterns": s(_violations(_patterns(_NAME)), "people", "named", "goods"),
        "dq_patterns_any_case": s(
            _violations(_patterns("(?i)" + _NAME)), "people", "named", "goods"
        ),
        "dq_all": s(
            "\nUNION ALL\n".join(
                [
                    _violations([*_RANGES, *_patterns(_NAME), *_REQUIRED, *_LENGTHS]),
                    *(_repeats(*rule) for rule in _UNIQUE),
                    *(_dangling(*rule) for rule in _REFERENCES),
                ]
            ),
            "lines",
            "prices",
            "people",
            "owners",
            "named",
            "goods",
        ),
        "dq_required": s(_violations(_REQUIRED), "prices"),
        "dq_lengths": s(_violations(_LENGTHS), "people", "named", "goods"),
        "dq_rule_counts": s(
            "\nUNION ALL\n".join(
                [
                    _counts([*_RANGES, *_patterns(_NAME), *_REQUIRED, *_LENGTHS]),
                    *(_repeat_counts(*rule) for rule in _UNIQUE),
                    *(_dangling_counts(*rule) for rule in _REFERENCES),
                ]
            ),
            "lines",
            "prices",
            "people",
            "owners",
            "named",
            "goods",
        ),
        "import_export_roundtrip": f"""SELECT o_orderkey AS transaction_id,
            o_custkey * 2 + o_orderkey % 2 AS customer_card_id,
            {_money("CAST(o_totalprice AS DECIMAL(18,4))", "transaction_summ")},
            o_orderdate AS transaction_datetime, o_orderkey % 5 AS transaction_store_id
            FROM orders""",
        "import_export_checks": s(
            f"""SELECT transaction_id, sku_id, {_money("amount", "sku_amount")},
                {_money("summ", "sku_summ")}, {_money("summ - discount", "sku_summ_paid")},
                {_money("discount", "sku_discount")} FROM lines""",
            "lines",
        ),
        "import_export_personal": s("SELECT * FROM people", "people"),
        "analysis_date": """SELECT MAX(o_orderdate) + INTERVAL 1 DAY AS analysis_formation
            FROM orders""",
    }
