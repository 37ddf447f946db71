"""Column expressions with the null and division rules that panel features need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column) -> Column:
    """num / den where den > 0, else null."""
    return F.when(den > 0, num / den)


def safe_ln(x: Column) -> Column:
    return F.when(x > 0, F.ln(x))


def safe_corr(x: Column, y: Column) -> Column:
    """Correlation aggregate; null where either side is constant (``corr`` raises there in ANSI mode)."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(a, b), F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0)))


def round6(x: Column) -> Column:
    """``F.round(x, 6)`` of a double, never -0.0; decimal digits are only made where six places more don't tell.

    Below 100,000 the product with a million is right to 0.00002, so a number
    that is further from a half than that rounds as its digits do.
    """
    scaled = F.abs(x) * F.lit(1e6)
    plain = (scaled < 1e11) & (F.abs(scaled - F.floor(scaled) - F.lit(0.5)) > 1e-3)
    return F.when(plain, F.signum(x) * F.floor(scaled + F.lit(0.5)) / F.lit(1e6)).otherwise(F.round(x, 6)) + F.lit(0.0)


def row_stddev(*cols: Column) -> Column:
    """Sample deviation across columns of one row, null if any is null; exactly 0 for equal values."""
    n = len(cols)
    mean = sum(cols[1:], cols[0]) / n
    total = sum(((c - mean) * (c - mean) for c in cols[1:]), (cols[0] - mean) * (cols[0] - mean))
    return F.when(F.greatest(*cols) == F.least(*cols), F.lit(0.0) + (total - total)).otherwise(F.sqrt(total / (n - 1)))


def quarter_of(d: Column) -> Column:
    return F.trunc(d, "quarter")


def add_years(d: Column, years: Column | int) -> Column:
    return F.add_months(d, (years if isinstance(years, Column) else F.lit(years)) * 12)


def month_gap(a: Column, b: Column) -> Column:
    """Month boundaries from a to b."""
    return 12 * (F.year(b) - F.year(a)) + (F.month(b) - F.month(a))


def md5_number(*cols: Column) -> Column:
    """A number from the first 8 hex digits of an md5; the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[c.cast("string") for c in cols])), 1, 8), 16, 10).cast("long")


def md5_bucket(n: int, *cols: Column) -> Column:
    return (md5_number(*cols) % n).cast("int")
