"""Measures built from columns or aggregates."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# A reading is out of spec beyond this many standard deviations.
SIGMA_LIMIT = 2
# Out-of-spec percentages above which a finding is high or medium.
HIGH_PCT, MEDIUM_PCT = 6, 4


def rate_pct(part: Column, whole: Column) -> Column:
    """`part` in percent of `whole`, as a decimal with two digits; NULL when `whole` is 0."""
    return F.round(part * F.lit(Decimal("100.0")) / F.nullif(whole, F.lit(0)), 2)


def bandwidth(upper: Column, lower: Column) -> Column:
    return F.round(upper - lower, 3)


def is_out_of_spec(value: Column, mean: Column, sd: Column) -> Column:
    """Strictly beyond the limit; NULL values are in spec."""
    return F.coalesce(F.abs(value - mean) > SIGMA_LIMIT * sd, F.lit(False))


def out_of_spec_flag(value: Column, mean: Column, sd: Column) -> Column:
    return is_out_of_spec(value, mean, sd).cast("int")


def coefficient_of_variation(mean: Column, sd: Column) -> Column:
    """Spread relative to the size of the mean; NULL when the mean is 0."""
    return F.when(F.abs(mean) > 0, sd / F.abs(mean))


def severity(pct: Column) -> Column:
    return F.when(pct > HIGH_PCT, "high").when(pct > MEDIUM_PCT, "medium").otherwise("low")
