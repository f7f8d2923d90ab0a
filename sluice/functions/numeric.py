"""Statistics expressions with missing = NULL and no error on constant columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def known(c) -> Column:
    """NaN to NULL."""
    return F.nanvl(col(c), F.lit(None).cast("double"))


def non_negative(c) -> Column:
    return F.when(col(c) >= 0, col(c))


def number_or_null(c) -> Column:
    """Dirty text to double; anything that is not a number, and NaN, becomes NULL."""
    return known(col(c).try_cast("double"))


def guarded_corr(a, b, over: WindowSpec | None = None) -> Column:
    """Pearson r over complete pairs; NULL where either side does not vary."""
    a, b = col(a), col(b)
    sa = F.stddev_samp(F.when(b.isNotNull(), a))
    sb = F.stddev_samp(F.when(a.isNotNull(), b))
    cov = F.covar_samp(a, b)
    if over is not None:
        sa, sb, cov = sa.over(over), sb.over(over), cov.over(over)
    return F.try_divide(cov, sa * sb)


def sample_skew(c) -> Column:
    """Bias-corrected skew: 0 for a constant series, NULL below three values."""
    c = col(c)
    n = F.count(c).cast("double")
    raw = F.when(F.min(c) == F.max(c), F.lit(0.0)).otherwise(F.skewness(c))
    return F.when(n >= 3, raw * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))


def z_score(v, mean, std) -> Column:
    return F.try_divide(col(v) - col(mean), col(std))


def percent(part, whole) -> Column:
    return F.try_divide(col(part) * F.lit(100.0), col(whole).cast("double"))

