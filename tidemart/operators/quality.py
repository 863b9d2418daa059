"""Data-quality rules; every rule yields (check_name, table_name, failing_rows, passed)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Rows of a table for which ``bad`` holds are failures."""

    name: str
    table: str
    bad: Column


def not_null(table: str, column: str) -> Rule:
    return Rule(f"not_null:{column}", table, F.col(column).isNull())


def negative(table: str, column: str) -> Rule:
    return Rule(f"negative:{column}", table, F.col(column) < 0)


def out_of_range(table: str, columns: Sequence[str], low, high) -> Rule:
    tests = [~F.col(c).between(low, high) for c in columns]
    return Rule(f"range:{'+'.join(columns)}", table, reduce(lambda a, b: a | b, tests))


def above(table: str, column: str, limit) -> Rule:
    return Rule(f"above_{limit}:{column}", table, F.col(column) > limit)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys stored more than once, with their row count."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )


def _verdict(df: DataFrame, name: Column | str, table: str) -> DataFrame:
    label = F.lit(name) if isinstance(name, str) else name
    return df.select(
        label.alias("check_name"),
        F.lit(table).alias("table_name"),
        F.col("failing_rows").cast("bigint").alias("failing_rows"),
        (F.col("failing_rows") == 0).alias("passed"),
    )


def check_rows(tables: dict[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """All row rules; each table is scanned once however many rules it has."""
    by_table: dict[str, list[Rule]] = {}
    for rule in rules:
        by_table.setdefault(rule.table, []).append(rule)
    parts = []
    for table, own in by_table.items():
        counts = tables[table].agg(
            *[F.count_if(rule.bad).alias(f"c{i}") for i, rule in enumerate(own)]
        )
        pairs = F.array(
            *[
                F.struct(F.lit(rule.name).alias("name"), F.col(f"c{i}").alias("failing_rows"))
                for i, rule in enumerate(own)
            ]
        )
        long = counts.select(F.explode(pairs).alias("r")).select("r.name", "r.failing_rows")
        parts.append(_verdict(long, F.col("name"), table))
    return reduce(DataFrame.unionByName, parts)


def check_unique(tables: dict[str, DataFrame], keys: Sequence[tuple[str, str]]) -> DataFrame:
    """Uniqueness per (table, column); failing_rows counts duplicated key values."""
    parts = [
        _verdict(
            duplicate_keys(tables[table], column).agg(F.count(F.lit(1)).alias("failing_rows")),
            f"unique:{column}",
            table,
        )
        for table, column in keys
    ]
    return reduce(DataFrame.unionByName, parts)


def check_keys(
    tables: dict[str, DataFrame], unique: Sequence[tuple[str, str]], filled: Sequence[tuple[str, str]]
) -> DataFrame:
    """Uniqueness and not-null rules of whole columns; one scan and one count per table.

    Every row gives one (column, value) pair per column.  Values are counted, combined
    map-side; a column that need not be unique gives no values, only whether it is null.
    """
    parts = []
    for table in dict.fromkeys(t for t, _ in (*unique, *filled)):
        keys = [c for t, c in unique if t == table]
        columns = list(dict.fromkeys([*keys, *(c for t, c in filled if t == table)]))
        pairs = [
            F.struct(
                F.lit(c).alias("column"),
                (F.col(c).cast("string") if c in keys else F.when(F.col(c).isNotNull(), "")).alias("value"),
            )
            for c in columns
        ]
        counted = (
            tables[table].select(F.explode(F.array(*pairs)).alias("p"))
            .groupBy("p.column", "p.value")
            .agg(F.count(F.lit(1)).alias("copies"))
            .groupBy("column")
            .agg(
                F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("copies"))), F.lit(0)).alias("nulls"),
                F.count_if(F.col("value").isNotNull() & (F.col("copies") > 1)).alias("repeated"),
            )
        )
        rules = [(f"not_null:{c}", c, "nulls") for t, c in filled if t == table]
        rules += [(f"unique:{c}", c, "repeated") for c in keys]
        # An empty table has no pairs; its rules hold.
        on_one_row = counted.agg(
            *[
                F.coalesce(F.max(F.when(F.col("column") == c, F.col(kind))), F.lit(0)).alias(f"c{i}")
                for i, (_, c, kind) in enumerate(rules)
            ]
        )
        named = [F.struct(F.lit(n).alias("name"), F.col(f"c{i}").alias("failing_rows")) for i, (n, _, _) in enumerate(rules)]
        long = on_one_row.select(F.explode(F.array(*named)).alias("r")).select("r.name", "r.failing_rows")
        parts.append(_verdict(long, F.col("name"), table))
    return reduce(DataFrame.unionByName, parts)


def check_minimum_rows(tables: dict[str, DataFrame], minima: dict[str, int]) -> DataFrame:
    """Row minima; at most ``minimum`` rows of each table are read."""
    parts = []
    for table, minimum in minima.items():
        short = tables[table].limit(minimum).agg((F.lit(minimum) - F.count(F.lit(1))).alias("failing_rows"))
        parts.append(_verdict(short, f"min_rows:{minimum}", table))
    return reduce(DataFrame.unionByName, parts)


# The columns and tables under test.
UNIQUE_KEYS = (
    ("users", "id"),
    ("users", "email"),
    ("products", "id"),
    ("transactions", "order_id"),
    ("sessions", "session_id"),
    ("stg_users", "user_id"),
    ("stg_products", "product_id"),
    ("stg_transactions", "order_id"),
    ("stg_sessions", "session_id"),
    ("dim_customers", "user_id"),
    ("dim_products", "product_id"),
    ("fct_orders", "order_id"),
)
NOT_NULL = UNIQUE_KEYS + (
    ("dim_customers", "total_revenue"),
    ("agg_rfm_scores", "user_id"),
)
SILVER_NOT_NULL = (
    ("transactions", "order_id"),
    ("transactions", "user_id"),
    ("transactions", "total_amount"),
    ("sessions", "session_id"),
)
MODEL_MINIMUM_ROWS = {"churn": 50, "demand": 30, "drift": 20}


def column_tests(tables: dict[str, DataFrame]) -> DataFrame:
    """The generic unique and not-null tests on sources, staging and gold."""
    return check_keys(tables, UNIQUE_KEYS, NOT_NULL)


def silver_gate(tables: dict[str, DataFrame]) -> DataFrame:
    rules = [not_null(t, c) for t, c in SILVER_NOT_NULL]
    return check_rows(tables, [*rules, negative("transactions", "total_amount")])


def gold_gate(tables: dict[str, DataFrame]) -> DataFrame:
    """Order amounts, score ranges, KPI sanity and row minima of the gold tables."""
    rules = [
        negative("fct_orders", "total_amount"),
        out_of_range("agg_rfm_scores", ["r_score", "f_score", "m_score"], 1, 5),
        negative("agg_daily_revenue", "gross_revenue"),
        negative("agg_daily_revenue", "net_revenue"),
        above("agg_funnel", "overall_conversion_rate", 100),
    ]
    minima = {"agg_daily_revenue": 1, "agg_rfm_scores": 1}
    return check_rows(tables, rules).unionByName(check_minimum_rows(tables, minima))


def require_passed(report: DataFrame) -> None:
    """Raise when any check of a report failed; the report has one row per check."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        lines = [f"{r.table_name}.{r.check_name}: {r.failing_rows} failing" for r in failed]
        raise ValueError("data quality failed: " + "; ".join(lines))
