"""Column expressions shared by staging, marts and analysis jobs.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def currency_to_double(c: ColumnOrName) -> Column:
    """'$1,234.50' -> 1234.5; text that is not a number becomes NULL.

    Strips '$' and thousands separators, then ``try_cast`` so one bad
    value cannot fail a whole job under ANSI mode.
    """
    return F.regexp_replace(_c(c), r"[$,]", "").try_cast("double")


def round_half_away(c: ColumnOrName, digits: int) -> Column:
    """Round half away from zero, computed in binary floating point.

    ``sign(x) * floor(|x| * 10^d + 0.5) / 10^d`` gives bit-identical
    results in every IEEE engine, unlike decimal-string rounding. From
    2^53 on a scaled double has no fraction, so x is already rounded.
    """
    x = _c(c)
    scale = float(10 ** digits)
    rounded = F.signum(x) * F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
    return F.when(F.abs(x) * F.lit(scale) >= F.lit(float(2 ** 53)), x).otherwise(rounded)


def nullif_zero(c: ColumnOrName) -> Column:
    x = _c(c)
    return F.when(x != 0, x)


def safe_corr(x: ColumnOrName, y: ColumnOrName) -> Column:
    """Pearson correlation that is NULL (not an error) for a constant column.

    Only rows where both values are present take part, as in CORR.
    """
    x, y = _c(x), _c(y)
    both = x.isNotNull() & y.isNotNull()
    xp, yp = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xp, yp), F.stddev_pop(xp) * F.stddev_pop(yp))


def weekend_flag(date_col: ColumnOrName) -> Column:
    """Sunday (1) or Saturday (7); FALSE for a NULL date."""
    return F.coalesce(F.dayofweek(_c(date_col)).isin(1, 7), F.lit(False))


def date_parts(date_col: ColumnOrName) -> dict[str, Column]:
    """The columns of the availability fact that follow from the date alone."""
    d = _c(date_col)
    return {"year": F.year(d), "month": F.month(d), "month_name": F.date_format(d, "MMMM"),
            "day_of_week": F.dayofweek(d), "is_weekend": weekend_flag(d)}


def capped(c: ColumnOrName, upper) -> Column:
    """LEAST(x, upper) that stays NULL for a NULL x."""
    x = _c(c)
    return F.when(x.isNotNull(), F.least(x, F.lit(upper)))
