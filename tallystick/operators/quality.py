"""Violation reports: what a constrained database would have refused on insert."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column as Expr
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystick.sources.tables import SPECS, Column, Reference, Tables, TableSpec

REPORT_COLUMNS = ["table", "rule", "key", "value"]


def _key(columns: tuple[str, ...]) -> Expr:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns]
    return F.concat_ws("|", *parts)


def _row_report(df: DataFrame, spec: TableSpec, rules: list[tuple[str, Expr, Expr]]) -> DataFrame:
    """All row rules of a table in a single scan; one output row per rule broken.

    Sound rows, nearly all of them, leave before anything is built for the report.
    """
    broken = F.array(
        *[
            F.when(bad, F.struct(F.lit(rule).alias("rule"), value.cast("string").alias("value")))
            for rule, bad, value in rules
        ]
    )
    any_broken = reduce(Expr.__or__, [bad for _, bad, _ in rules])
    return (
        df.where(any_broken)
        .select(_key(spec.identity).alias("key"), F.explode(F.array_compact(broken)).alias("v"))
        .select(F.lit(spec.name).alias("table"), "v.rule", "key", "v.value")
    )


def _fails(condition: Expr) -> Expr:
    """A check that is NULL passes."""
    return ~F.coalesce(condition, F.lit(True))


def _range_rules(column: Column) -> list[tuple[str, Expr, Expr]]:
    value = F.col(column.name)
    rules = []
    if column.minimum is not None:
        rules.append((f"{column.name} >= {column.minimum}", _fails(value >= column.minimum), value))
    if column.above is not None:
        rules.append((f"{column.name} > {column.above}", _fails(value > column.above), value))
    return rules


def _pattern_rules(column: Column, any_case: bool) -> list[tuple[str, Expr, Expr]]:
    pattern = (any_case and column.lenient_pattern) or column.pattern
    if pattern is None:
        return []
    value = F.col(column.name)
    return [(f"{column.name} pattern", _fails(value.rlike(pattern)), value)]


def _required_rules(column: Column) -> list[tuple[str, Expr, Expr]]:
    value = F.col(column.name)
    return [(f"{column.name} not null", value.isNull(), value)] if column.required else []


def _length_rules(column: Column) -> list[tuple[str, Expr, Expr]]:
    value = F.col(column.name)
    if column.max_length is None:
        return []
    too_long = F.coalesce(F.char_length(value) > column.max_length, F.lit(False))
    return [(f"{column.name} length <= {column.max_length}", too_long, value)]


def row_rules(column: Column, any_case: bool = False) -> list[tuple[str, Expr, Expr]]:
    """(rule, whether a row breaks it, the value) for all that a row can break by itself."""
    return [
        *_range_rules(column),
        *_pattern_rules(column, any_case),
        *_required_rules(column),
        *_length_rules(column),
    ]


def _row_reports(tables: Tables, rules_of) -> list[DataFrame]:
    reports = []
    for name, spec in SPECS.items():
        rules = [rule for column in spec.columns for rule in rules_of(column)]
        if rules:
            reports.append(_row_report(tables[name], spec, rules))
    return reports


def _union(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports).select(*REPORT_COLUMNS)


def range_violations(tables: Tables) -> DataFrame:
    return _union(_row_reports(tables, _range_rules))


def pattern_violations(tables: Tables, any_case: bool = False) -> DataFrame:
    """``any_case`` accepts names whose capitals are out of place."""
    return _union(_row_reports(tables, lambda c: _pattern_rules(c, any_case)))


def missing_values(tables: Tables) -> DataFrame:
    return _union(_row_reports(tables, _required_rules))


def length_violations(tables: Tables) -> DataFrame:
    return _union(_row_reports(tables, _length_rules))


def _repeats(
    df: DataFrame, spec: TableSpec, column: str, rule: str, nulls_count: bool
) -> DataFrame:
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    repeated = F.col("rows") > 1
    bad = (repeated | F.col(column).isNull()) if nulls_count else (
        repeated & F.col(column).isNotNull()
    )
    return counted.where(bad).select(
        F.lit(spec.name).alias("table"),
        F.lit(rule).alias("rule"),
        F.coalesce(F.col(column).cast("string"), F.lit("NULL")).alias("key"),
        F.col("rows").cast("string").alias("value"),
    )


def _unique_rules() -> list[tuple[TableSpec, str, str, bool]]:
    rules = []
    for spec in SPECS.values():
        if spec.primary_key:
            rules.append((spec, spec.primary_key, f"{spec.primary_key} primary key", True))
        rules += [(spec, column, f"{column} unique", False) for column in spec.unique]
    return rules


def unique_violations(tables: Tables) -> DataFrame:
    """Repeated or missing primary keys, repeated unique values; the value is the row count."""
    return _union(
        [
            _repeats(tables[spec.name], spec, column, rule, nulls_count)
            for spec, column, rule, nulls_count in _unique_rules()
        ]
    )


def _used_keys(tables: Tables, table: str, ref: Reference) -> DataFrame:
    """Distinct values of a reference with their row counts."""
    return (
        tables[table]
        .where(F.col(ref.column).isNotNull())
        .groupBy(F.col(ref.column).alias("key"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def reference_violations(tables: Tables) -> DataFrame:
    """Values without a row in the table they refer to; the value is the row count.

    The referring side is reduced to its distinct keys first, so no hot key reaches the
    anti join.
    """
    reports = []
    for name, spec in SPECS.items():
        for ref in spec.references:
            known = tables[ref.table].select(F.col(ref.key).alias("key"))
            reports.append(
                _used_keys(tables, name, ref)
                .join(known, "key", "left_anti")
                .select(
                    F.lit(name).alias("table"),
                    F.lit(f"{ref.column} in {ref.table}").alias("rule"),
                    F.col("key").cast("string").alias("key"),
                    F.col("rows").cast("string").alias("value"),
                )
            )
    return _union(reports)


def violations(tables: Tables, any_case: bool = False) -> DataFrame:
    """Every rule at once: (table, rule, key, value)."""
    return _union(
        [
            *_row_reports(tables, lambda c: row_rules(c, any_case)),
            unique_violations(tables),
            reference_violations(tables),
        ]
    )


def _row_rule_counts(df: DataFrame, spec: TableSpec) -> DataFrame | None:
    rules = [rule for column in spec.columns for rule in row_rules(column)]
    if not rules:
        return None
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.when(bad, 1)).alias(f"r{i}") for i, (_, bad, _) in enumerate(rules)],
    )
    each = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.col(f"r{i}").alias("broken"))
            for i, (rule, _, _) in enumerate(rules)
        ]
    )
    return counts.select("rows", F.explode(each).alias("v")).select(
        F.lit(spec.name).alias("table"), "v.rule", "rows", "v.broken"
    )


def rule_counts(tables: Tables) -> DataFrame:
    """Rows checked and rows that break a rule, for every rule, broken or not.

    A row with a repeated or dangling value counts as broken itself.
    """
    rows, broken = F.sum("rows"), F.sum(F.when(F.col("bad"), F.col("rows")))

    def counted(keys: DataFrame, table: str, rule: str) -> DataFrame:
        return keys.agg(
            F.coalesce(rows, F.lit(0)).alias("rows"), F.coalesce(broken, F.lit(0)).alias("broken")
        ).select(F.lit(table).alias("table"), F.lit(rule).alias("rule"), "rows", "broken")

    reports = [_row_rule_counts(tables[name], spec) for name, spec in SPECS.items()]
    for spec, column, rule, nulls_count in _unique_rules():
        missing = F.col(column).isNull()
        bad = (F.col("rows") > 1) | missing if nulls_count else (F.col("rows") > 1) & ~missing
        keys = tables[spec.name].groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
        reports.append(counted(keys.withColumn("bad", bad), spec.name, rule))
    for name, spec in SPECS.items():
        for ref in spec.references:
            known = (
                tables[ref.table]
                .select(F.col(ref.key).alias("key"))
                .distinct()
                .withColumn("known", F.lit(True))
            )
            keys = _used_keys(tables, name, ref).join(known, "key", "left")
            reports.append(
                counted(
                    keys.withColumn("bad", F.col("known").isNull()),
                    name,
                    f"{ref.column} in {ref.table}",
                )
            )
    return reduce(DataFrame.unionByName, [r for r in reports if r is not None])
