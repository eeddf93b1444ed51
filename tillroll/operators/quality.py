"""Data-quality checks. A check selects violations; no violation means it passes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.scalars import line_amount
from tillroll.operators.sizes import broadcast_if_small

AMOUNT_TOLERANCE = 0.01

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Check:
    """``kind`` of check on ``table``; ``column`` is empty for checks on whole rows or groups."""

    kind: str
    table: str
    column: str = ""
    options: Mapping[str, Any] = field(default_factory=dict)


def not_null(table: str, column: str) -> Check:
    return Check("not_null", table, column)


def unique(table: str, column: str) -> Check:
    return Check("unique", table, column)


def accepted_values(table: str, column: str, values: list[Any]) -> Check:
    return Check("accepted_values", table, column, {"values": values})


def accepted_range(table: str, column: str, min_value=None, max_value=None) -> Check:
    """Both bounds are inclusive and optional."""
    return Check("accepted_range", table, column, {"min": min_value, "max": max_value})


def relationships(table: str, column: str, parent: str, parent_column: str) -> Check:
    return Check("relationships", table, column, {"parent": parent, "parent_column": parent_column})


def one_current_row(table: str, key: str) -> Check:
    return Check("one_current_row", table, key)


def line_amount_matches(table: str) -> Check:
    return Check("line_amount_matches", table, "line_amount")


def _out_of_range(column: Column, low: Any, high: Any) -> Column:
    bounds = []
    if low is not None:
        bounds.append(column < low)
    if high is not None:
        bounds.append(column > high)
    return reduce(lambda a, b: a | b, bounds, F.lit(False))


def _expected_amount() -> Column:
    return line_amount(F.col("quantity"), F.col("unit_price"), F.col("discount_amount"))


# Checks decided on one row alone: condition that holds on a violating row.
_ROW_RULES: dict[str, Callable[[Check], Column]] = {
    "not_null": lambda c: F.col(c.column).isNull(),
    "accepted_values": lambda c: ~F.col(c.column).isin(c.options["values"]),
    "accepted_range": lambda c: _out_of_range(F.col(c.column), c.options["min"], c.options["max"]),
    "line_amount_matches": lambda c: F.abs(F.col("line_amount") - _expected_amount()) > AMOUNT_TOLERANCE,
}


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Non-null values seen more than once."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.where("n_records > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key is set but has no parent."""
    parents = parent.select(F.col(parent_column).alias("_parent"))
    keyed = child.where(F.col(column).isNotNull())
    return keyed.join(broadcast_if_small(parents), F.col(column) == F.col("_parent"), "left_anti")


def current_row_count(history: DataFrame, key: str) -> DataFrame:
    """Keys that do not have exactly one current row, those with none included."""
    current = F.count_if("is_current").alias("n_current_rows")
    return history.groupBy(key).agg(current).where("n_current_rows <> 1")


_GROUP_RULES: dict[str, Callable[[Check, Tables], DataFrame]] = {
    "unique": lambda c, t: duplicates(t[c.table], c.column),
    "relationships": lambda c, t: orphans(
        t[c.table], c.column, t[c.options["parent"]], c.options["parent_column"]
    ),
    "one_current_row": lambda c, t: current_row_count(t[c.table], c.column),
}


def violations(check: Check, tables: Tables) -> DataFrame:
    """The violating rows or groups."""
    if check.kind in _ROW_RULES:
        return tables[check.table].where(_ROW_RULES[check.kind](check))
    return _GROUP_RULES[check.kind](check, tables)


def _named_counts(checks: list[Check]) -> Column:
    """An array of results from the counts ``_0, _1, ...`` of one row."""
    return F.array(
        *(
            F.struct(
                F.lit(c.kind).alias("check"),
                F.lit(c.table).alias("table"),
                F.lit(c.column).alias("column"),
                F.col(f"_{i}").alias("n_violations"),
            )
            for i, c in enumerate(checks)
        )
    )


def _row_check_counts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All row checks of one table in one pass over it."""
    counts = df.agg(
        *(F.count_if(_ROW_RULES[c.kind](c)).alias(f"_{i}") for i, c in enumerate(checks))
    )
    return counts.select(F.inline(_named_counts(checks)))


def _value(column: Column, dtype: str) -> Column:
    """A value as text that is equal where the value is. Minus zero is zero."""
    return (column + 0.0 if dtype in ("double", "float") else column).cast("string")


def _tallies(df: DataFrame, columns: list[str]) -> DataFrame:
    """``place, value`` for each non-null value of each column, from one scan."""
    dtypes = dict(df.dtypes)
    pairs = (
        F.struct(F.lit(i).alias("place"), _value(F.col(c), dtypes[c]).alias("value")) for i, c in enumerate(columns)
    )
    return df.select(F.inline(F.array(*pairs))).where("value is not null")


def _labelled(counts: DataFrame, checks: list[Check]) -> DataFrame:
    """``counts(place, n)`` by check, those without any as 0."""
    found = counts.groupBy().agg(
        *(F.coalesce(F.max(F.when(F.col("place") == i, F.col("n"))), F.lit(0).cast("long")).alias(f"_{i}") for i in range(len(checks)))
    )
    return found.select(F.inline(_named_counts(checks)))


def _unique_counts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All uniqueness checks of one table: one scan, one shuffle by (column, value)."""
    seen = _tallies(df, [c.column for c in checks]).groupBy("place", "value").agg(F.count(F.lit(1)).alias("times"))
    return _labelled(seen.groupBy("place").agg(F.count_if(F.col("times") > 1).alias("n")), checks)


def _relationship_counts(df: DataFrame, checks: list[Check], tables: Tables) -> DataFrame:
    """All foreign keys of one table: one scan reduces it to its different keys and how often each occurs, and only
    those meet the parents' keys."""
    keys = _tallies(df, [c.column for c in checks]).groupBy("place", "value").agg(F.count(F.lit(1)).alias("times"))
    parents = []
    for i, check in enumerate(checks):
        parent, key = tables[check.options["parent"]], check.options["parent_column"]
        parents.append(parent.select(F.lit(i).alias("place"), _value(F.col(key), dict(parent.dtypes)[key]).alias("value")))
    known = reduce(DataFrame.unionByName, parents)
    missing = keys.join(known, ["place", "value"], "left_anti")
    return _labelled(missing.groupBy("place").agg(F.sum("times").alias("n")), checks)


def _group_check_count(check: Check, tables: Tables) -> DataFrame:
    return violations(check, tables).agg(F.count(F.lit(1)).alias("n_violations")).select(
        F.lit(check.kind).alias("check"),
        F.lit(check.table).alias("table"),
        F.lit(check.column).alias("column"),
        "n_violations",
    )


def run_checks(checks: Iterable[Check], tables: Tables) -> DataFrame:
    """One row per check: check, table, column, n_violations, status.

    The checks of a table are made together: one pass for all that a row decides, one for all unique columns, one
    for all foreign keys. A relationship counts the rows without a parent.
    """
    together: dict[tuple[str, str], list[Check]] = {}
    parts: list[DataFrame] = []
    for check in checks:
        kind = "row" if check.kind in _ROW_RULES else check.kind
        if kind == "one_current_row":
            parts.append(_group_check_count(check, tables))
        else:
            together.setdefault((kind, check.table), []).append(check)
    for (kind, table), group in together.items():
        if kind == "row":
            parts.append(_row_check_counts(tables[table], group))
        elif kind == "unique":
            parts.append(_unique_counts(tables[table], group))
        else:
            parts.append(_relationship_counts(tables[table], group, tables))
    status = F.when(F.col("n_violations") == 0, "pass").otherwise("fail")
    return reduce(DataFrame.unionByName, parts).withColumn("status", status)


def status_histogram(statuses: DataFrame) -> DataFrame:
    """Number of results per status."""
    return statuses.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def table_counts(spark: SparkSession, tables: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """Rows per table. A table that cannot be read reports its error and stops nothing."""
    rows: list[tuple[str, int | None, str | None]] = []
    for name, load in tables.items():
        try:
            rows.append((name, load().count(), None))
        except Exception as error:  # noqa: BLE001 - any failure becomes part of the report
            rows.append((name, None, f"error: {str(error).splitlines()[0]}"))
    return spark.createDataFrame(rows, "table_name string, n_rows long, error string")


def quarantine_count(quarantine: DataFrame | None) -> int:
    """Rejected rows; zero where no quarantine exists. One that cannot be read is an error."""
    return 0 if quarantine is None else quarantine.count()


def retail_checks() -> list[Check]:
    """The standard suite over staging, star schema, marts and reference data: 51 checks."""
    # Which columns each kind of check covers.
    uniques = {
        "stg_sales_events": ["event_id"],
        "dim_customer_scd2": ["customer_sk"],
        "dim_product": ["product_sk", "product_id"],
        "dim_store": ["store_sk", "store_id"],
        "dim_date": ["date_sk"],
        "fct_sales": ["sale_line_sk", "event_id"],
        "mart_customer_ltv": ["customer_sk"],
        "ref_products": ["product_id"],
        "ref_stores": ["store_id"],
        "ref_customer_ids": ["customer_id"],
    }
    required = {
        "stg_sales_events": ["event_id", "product_id", "store_id", "quantity", "unit_price", "event_ts"],
        "stg_customer_profiles": ["customer_id", "loyalty_tier", "snapshot_ts"],
        "dim_customer_scd2": ["customer_sk", "customer_id", "is_current"],
        "dim_product": ["product_sk", "product_id"],
        "dim_store": ["store_sk", "store_id"],
        "dim_date": ["date_sk"],
        "fct_sales": ["sale_line_sk", "event_id", "product_sk", "store_sk", "date_sk", "line_amount"],
        "mart_daily_store_sales": ["store_id", "calendar_date"],
        "mart_customer_ltv": ["customer_sk"],
        "ref_products": ["product_id"],
        "ref_stores": ["store_id"],
        "ref_customer_ids": ["customer_id"],
    }
    tiers = ["bronze", "silver", "gold", "platinum"]
    return [
        *(unique(t, c) for t, columns in uniques.items() for c in columns),
        *(not_null(t, c) for t, columns in required.items() for c in columns),
        accepted_values("stg_customer_profiles", "loyalty_tier", tiers),
        accepted_values("dim_customer_scd2", "loyalty_tier", tiers),
        accepted_range("stg_sales_events", "unit_price", min_value=0),
        accepted_range("ref_products", "list_price", min_value=0),
        relationships("fct_sales", "product_sk", "dim_product", "product_sk"),
        relationships("fct_sales", "store_sk", "dim_store", "store_sk"),
        relationships("fct_sales", "date_sk", "dim_date", "date_sk"),
        one_current_row("dim_customer_scd2", "customer_id"),
        line_amount_matches("fct_sales"),
    ]
