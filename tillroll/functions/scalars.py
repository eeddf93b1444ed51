"""Column expressions of the clean and business layers. All JVM-side, all code-generated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
LATE_AFTER_SECONDS = 3600
LTV_MULTIPLIERS = {"platinum": 2.5, "gold": 1.8, "silver": 1.3}
LTV_MULTIPLIER_OTHERWISE = 1.0

# Money is double in the tables. Sums run in this decimal type, so that their result does not
# depend on the order in which tasks deliver their partial sums.
_AMOUNT = "decimal(18,2)"
# Quotients and products pass through this type before rounding, so that a tie is decided on the
# decimal digits and not on the binary neighbour of the double.
_ROUNDING = "decimal(30,6)"


def parse_ts(value: Column) -> Column:
    """Text, date or timestamp to timestamp; null where the text is not a timestamp."""
    return F.try_to_timestamp(value)


def ts_of(df: DataFrame, name: str) -> Column:
    """The column as timestamp. One that is a timestamp already stays itself, watermark included."""
    column = F.col(name)
    return column if dict(df.dtypes)[name] == "timestamp" else parse_ts(column)


def line_amount(quantity: Column, unit_price: Column, discount: Column) -> Column:
    return F.round(quantity * unit_price - discount, 2)


def is_late(event_ts: Column, ingest_ts: Column) -> Column:
    """More than an hour between event and arrival, counted in whole seconds."""
    return ingest_ts.cast("long") - event_ts.cast("long") > F.lit(LATE_AFTER_SECONDS)


def email_domain(email: Column) -> Column:
    return F.split_part(email, F.lit("@"), F.lit(2))


def ltv_multiplier(tier: Column) -> Column:
    expr = F
    for name, factor in LTV_MULTIPLIERS.items():
        expr = expr.when(tier == name, F.lit(factor))
    return expr.otherwise(F.lit(LTV_MULTIPLIER_OTHERWISE))


def exact_sum_parts(amount: Column) -> tuple[Column, Column]:
    """Two sums that add up to the total and can be summed again: exact, and the rest.

    The first is order-independent, in decimal. The second takes what no decimal can hold (NaN,
    infinities, absurd sizes), so that one such row shows in its own total and fails no job.
    """
    exact = amount.try_cast(_AMOUNT)
    return F.sum(exact), F.sum(F.when(exact.isNull(), amount))


def sum_of_parts(exact: Column, rest: Column) -> Column:
    """The total as double; null if both parts are."""
    return F.coalesce(exact.cast("double") + rest, exact.cast("double"), rest)


def exact_sum(amount: Column) -> Column:
    """Order-independent sum of two-decimal amounts, as double."""
    return sum_of_parts(*exact_sum_parts(amount))


def to_cents(value: Column) -> Column:
    """Half-up rounding to two decimals on the decimal digits, where there are such."""
    return F.coalesce(F.round(value.try_cast(_ROUNDING), 2).cast("double"), F.round(value, 2))


def per_unit(total: Column, count: Column) -> Column:
    """``total / count`` in cents; null where the count is zero or null."""
    return to_cents(total.cast("double") / F.nullif(count, F.lit(0)))
