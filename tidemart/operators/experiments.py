"""A/B experiment: assignment, group summary, chi-squared test."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import AsOf, as_day
from tidemart.functions.numeric import ratio, safe_pct
from tidemart.functions.text import last_char

# Hex digits of the control group, the look-back, the default duration.
CONTROL_DIGITS = tuple("01234567")
LOOKBACK_DAYS = 14
DEFAULT_DURATION = 120
SIGNIFICANCE = 0.05
ERFC_TERMS = 80


def assign_groups(sessions: DataFrame, as_of: AsOf, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Recent sessions with their group, chosen by the last digit of the session id."""
    recent = F.col("session_date") >= F.date_sub(as_day(as_of), days)
    in_control = last_char("session_id").isin(*CONTROL_DIGITS)
    return sessions.filter(recent).select(
        "session_id",
        "user_id",
        F.coalesce("converted", F.lit(False)).alias("converted"),
        F.coalesce("add_to_cart_count", F.lit(0)).alias("add_to_cart_count"),
        F.coalesce("duration_seconds", F.lit(DEFAULT_DURATION)).alias("duration_seconds"),
        "products_viewed",
        "device_type",
        F.when(in_control, "control").otherwise("treatment").alias("group"),
    )


def group_summary(assigned: DataFrame) -> DataFrame:
    return (
        assigned.groupBy("group")
        .agg(F.count("session_id").alias("sessions"), F.count_if("converted").alias("conversions"))
        .withColumn("conversion_rate", safe_pct("conversions", "sessions"))
    )


def contingency(assigned: DataFrame) -> DataFrame:
    """The 2x2 table as one row: group by converted."""
    control = F.col("group") == "control"
    won = F.col("converted")
    return assigned.agg(
        F.count_if(control & won).alias("control_converted"),
        F.count_if(control & ~won).alias("control_not_converted"),
        F.count_if(~control & won).alias("treatment_converted"),
        F.count_if(~control & ~won).alias("treatment_not_converted"),
    )


def lift(table: DataFrame) -> DataFrame:
    """Group rates and the treatment's relative lift in percent, on one row."""
    control = F.col("control_converted") + F.col("control_not_converted")
    treatment = F.col("treatment_converted") + F.col("treatment_not_converted")
    return (
        table.withColumn("__c", ratio(F.col("control_converted") * 100.0, control))
        .withColumn("__t", ratio(F.col("treatment_converted") * 100.0, treatment))
        .select(
            F.round("__c", 4).alias("control_rate"),
            F.round("__t", 4).alias("treatment_rate"),
            F.round(ratio((F.col("__t") - F.col("__c")) * 100, F.col("__c")), 4).alias("lift_pct"),
        )
    )


def chi_squared(table: DataFrame) -> DataFrame:
    """Chi-squared statistic of the 2x2 table with Yates' continuity correction."""
    a, b, c, d = (
        F.col(name).cast("double")
        for name in (
            "control_converted", "control_not_converted",
            "treatment_converted", "treatment_not_converted",
        )
    )
    n = a + b + c + d
    distance = F.greatest(F.abs(a * d - b * c) - n / 2, F.lit(0.0))
    margins = (a + b) * (c + d) * (a + c) * (b + d)
    return table.withColumn("chi2", F.round(ratio(n * distance * distance, margins), 6)).withColumn(
        "dof", F.lit(1)
    )


def erfc(z: Column, terms: int = ERFC_TERMS) -> Column:
    """Complementary error function of a number from 0 on, as a column expression.

    Below 3 by the series of erf, whose terms are all positive; from there on by the
    continued fraction, evaluated from its end.  Right to 1e-15 (series, absolute) and
    1e-13 (fraction, relative).
    """
    square = z * z
    first = F.struct(z.alias("term"), z.alias("total"))

    def add(state: Column, n: Column) -> Column:
        term = state["term"] * (2 * square) / (2 * n + 1)
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    series = F.reduce(F.sequence(F.lit(1), F.lit(terms)), first, add, lambda state: state["total"])
    near = F.lit(1.0) - F.lit(2 / math.sqrt(math.pi)) * F.exp(-square) * series
    fraction = F.reduce(
        F.sequence(F.lit(terms), F.lit(1), F.lit(-1)), F.lit(1.0), lambda rest, n: 1 + n / (2 * square) / rest
    )
    far = F.exp(-square) / (z * math.sqrt(math.pi)) / fraction
    return F.when(z < 3, F.greatest(near, F.lit(0.0))).otherwise(far)


def chi2_upper_tail(statistic: Column) -> Column:
    """P(X > x) for one degree of freedom."""
    return erfc(F.sqrt(statistic / 2))


def significance(table: DataFrame, alpha: float = SIGNIFICANCE) -> DataFrame:
    """Statistic, p-value and verdict; the input is the one-row 2x2 table."""
    return (
        chi_squared(table)
        .withColumn("p_value", chi2_upper_tail(F.col("chi2")))
        .withColumn("significant", F.col("p_value") < alpha)
    )
