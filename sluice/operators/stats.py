"""Summaries, profiles, distributions and error measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import guarded_corr, sample_skew, z_score
from .blocks import BLOCK, attach, names, in_blocks, with_keyless, with_moments, with_previous
from .quantiles import exact_quantiles

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def describe(df: DataFrame, key="station", value: str = "value") -> DataFrame:
    """count, mean, std, min, quartiles, max per series."""
    keys = names(key)
    basic = df.groupBy(*keys).agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"),
    )
    return basic.join(exact_quantiles(df, keys, value, QUARTILES), keys, "left")


def series_health(df: DataFrame, key="station", value: str = "value") -> DataFrame:
    return df.groupBy(*names(key)).agg(
        F.count_if(F.col(value).isNull()).alias("n_missing"),
        F.count_if(F.col(value) < 0).alias("n_negative"),
        sample_skew(value).alias("skewness"),
    )


def negative_counts(df: DataFrame, key="station", value: str = "value") -> DataFrame:
    return df.groupBy(*names(key)).agg(F.count_if(F.col(value) < 0).alias("n_negative"))


def profile(df: DataFrame, value: str = "value", agg=F.avg, name: str = "mean", **parts) -> DataFrame:
    """Group mean over calendar parts given as name=expression."""
    return df.groupBy(*[c.alias(n) for n, c in parts.items()]).agg(agg(value).alias(name))


def calendar_pivot(df: DataFrame, row, column, values, value: str = "value", key=(), prefix: str = "y") -> DataFrame:
    """Mean by (row part) x (column part); ``row`` and ``column`` are (name, expression)."""
    base = df.select(*names(key), row[1].alias(row[0]), column[1].alias(column[0]), value)
    out = base.groupBy(*names(key), row[0]).pivot(column[0], list(values)).agg(F.avg(value))
    return out.withColumnsRenamed({str(v): f"{prefix}{v}" for v in values})


def box_stats(df: DataFrame, keys, value: str = "value") -> DataFrame:
    """Quartiles, whisker ends within 1.5 IQR, and the number of points outside."""
    keys = names(keys)
    quartiles = exact_quantiles(df, keys, value, QUARTILES)
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    fence = F.lit(1.5) * (F.col("p75") - F.col("p25"))
    inside = F.col(value).between(F.col("p25") - fence, F.col("p75") + fence)
    return (
        attach(counted, quartiles, keys, value)
        .groupBy(*keys)
        .agg(
            F.max("p25").alias("p25"), F.max("p50").alias("p50"), F.max("p75").alias("p75"),
            F.min(F.when(inside, F.col(value))).alias("low_whisker"),
            F.max(F.when(inside, F.col(value))).alias("high_whisker"),
            F.sum(F.when(inside, F.lit(0)).otherwise(F.col("_c"))).alias("n_outside"),
        )
    )


def monthly_anomaly(df: DataFrame, key="station", value: str = "value", time: str = "time", block: int = BLOCK) -> DataFrame:
    """Value minus the mean of its calendar month over all years; rows without a series or a time have neither."""

    def placed(part: DataFrame) -> DataFrame:
        rows = with_moments(in_blocks(part.withColumn("month", F.month(time)), key, time, block), key, value, ["month"], "_s_")
        return rows.select(*df.columns, "month", (F.col(value) - F.col("_s_mean")).alias("anomaly"))

    return with_keyless(df, [*names(key), time], placed)


def extreme_events(df: DataFrame, key="station", value: str = "value", time: str = "time", q: float = 0.99) -> DataFrame:
    """Rows at or above the q-quantile of their series."""
    limits = exact_quantiles(df, key, value, {"limit": q})
    return attach(df, limits, key, time).filter(F.col(value) >= F.col("limit"))


def histogram(df: DataFrame, bins: int, key="station", value: str = "value", by="time") -> DataFrame:
    """Equal-width bins between the extremes; the last bin is closed on the right."""
    keys = names(key)
    edges = df.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    at = F.floor(F.try_divide(F.col(value) - F.col("_lo"), width))
    return (
        attach(df.filter(F.col(value).isNotNull()), edges, keys, by)
        .withColumn("bin", F.least(F.coalesce(at, F.lit(0)), F.lit(bins - 1)).cast("bigint"))
        .groupBy(*keys, "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.col("_lo") + width * F.col("bin")).alias("low_edge"))
    )


def granularity(df: DataFrame, key="station", value: str = "value", time: str = "time", block: int = BLOCK) -> DataFrame:
    """Rows, median gap to the previous row in seconds, mean, min, max."""
    keys = names(key)
    rows = with_previous(in_blocks(df.select(*keys, time, value), keys, time, block), keys, time, time, "_prev")
    gaps = rows.withColumn(
        "_gap", (F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.col("_prev").cast("timestamp"))) / 1_000_000
    )
    basic = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max")
    )
    return basic.join(exact_quantiles(gaps, keys, "_gap", {"median_gap_seconds": 0.5}), keys, "left")


def flag_outliers(df: DataFrame, key="station", value: str = "value", time: str = "time", method: str = "zscore",
                  z: float = 3.0, block: int = BLOCK) -> DataFrame:
    """Rows with |z| above the bound, or outside the 1.5 IQR fences."""
    if method == "zscore":
        rows = with_moments(in_blocks(df, key, time, block), key, value, prefix="_s_")
        return rows.filter(F.abs(z_score(value, "_s_mean", "_s_std")) > z).select(*df.columns)
    rows = attach(df, exact_quantiles(df, key, value, {"_q1": 0.25, "_q3": 0.75}), key, time)
    fence = F.lit(1.5) * (F.col("_q3") - F.col("_q1"))
    out = (F.col(value) < F.col("_q1") - fence) | (F.col(value) > F.col("_q3") + fence)
    return rows.filter(out).select(*df.columns)


def regression_metrics(df: DataFrame, key="station", truth: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """rmse, mae and r² per series. A missing truth or prediction is an error; a constant truth has
    r² 1 where the fit is exact and 0 otherwise."""
    d = F.col(truth) - F.col(pred)
    # n·var_pop is the total sum of squares in one numerically stable aggregate
    sums = df.groupBy(*names(key)).agg(
        F.count_if(d.isNull()).alias("_bad"), F.count(F.lit(1)).alias("n"), F.sum(d * d).alias("_sse"),
        F.avg(F.abs(d)).alias("mae"), (F.var_pop(truth) * F.count(truth)).alias("_sst"),
    )
    bad = F.raise_error(F.lit("missing value in truth or prediction")).cast("bigint")
    r2 = F.when(F.col("_sst") == 0, F.when(F.col("_sse") == 0, 1.0).otherwise(0.0)).otherwise(
        1 - F.col("_sse") / F.nullif(F.col("_sst"), F.lit(0.0)))
    return sums.withColumn("n", F.when(F.col("_bad") > 0, bad).otherwise(F.col("n"))).select(
        *names(key), "n", F.sqrt(F.col("_sse") / F.col("n")).alias("rmse"), "mae", r2.alias("r2")
    )


def correlation_with(df: DataFrame, target: str, columns, key=()) -> DataFrame:
    """|r| of each column with the target as rows."""
    keys = names(key)
    wide = df.groupBy(*keys).agg(*[F.abs(guarded_corr(c, target)).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("abs_r")) for c in columns])
    return wide.select(*keys, F.explode(pairs).alias("_x")).select(*keys, "_x.feature", "_x.abs_r")


def pair_correlations(df: DataFrame, columns) -> DataFrame:
    """All pairwise correlations of the columns in one aggregate, as rows (a, b, r)."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    wide = df.agg(*[guarded_corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_{i}").alias("r")) for i, (a, b) in enumerate(pairs)])
    return wide.select(F.explode(rows).alias("_x")).select("_x.*")


def vif(df: DataFrame, columns) -> DataFrame:
    """Variance inflation factors: the diagonal of the inverse correlation matrix.

    The correlations are one aggregate over complete rows; only the k x k matrix reaches the driver.
    """
    import numpy as np

    columns = list(columns)
    rows = pair_correlations(df.na.drop(subset=columns), columns).collect()  # k(k-1)/2 rows
    at = {c: i for i, c in enumerate(columns)}
    m = np.eye(len(columns))
    for r in rows:
        if r["r"] is None:
            raise ValueError(f"constant column among {r['a']}, {r['b']}")
        m[at[r["a"]], at[r["b"]]] = m[at[r["b"]], at[r["a"]]] = r["r"]
    diagonal = np.diag(np.linalg.inv(m))
    return df.sparkSession.createDataFrame([(c, float(v)) for c, v in zip(columns, diagonal)], "feature string, vif double")


def pacf_from_acf(acf: list[float]) -> list[float]:
    """Durbin-Levinson recursion on autocorrelations r1..rk."""
    phi: list[float] = []
    out = []
    for k in range(1, len(acf) + 1):
        if k == 1:
            phi = [acf[0]]
        else:
            num = acf[k - 1] - sum(phi[j] * acf[k - 2 - j] for j in range(k - 1))
            den = 1 - sum(phi[j] * acf[j] for j in range(k - 1))
            last = num / den
            phi = [phi[j] - last * phi[k - 2 - j] for j in range(k - 1)] + [last]
        out.append(phi[-1])
    return out


def partial_autocorrelation(curve: DataFrame, key: str = "station") -> DataFrame:
    """(key, lag, pacf) from an autocorrelation curve (key, lag, r) with lags 1..k; one short group per series."""
    import pandas as pd

    def one(group, rows):
        rows = rows.sort_values("lag")
        return pd.DataFrame({key: group[0], "lag": rows["lag"].to_numpy(), "pacf": pacf_from_acf(rows["r"].tolist())})

    schema = f"{key} {curve.schema[key].dataType.simpleString()}, lag bigint, pacf double"
    return curve.groupBy(key).applyInPandas(one, schema)


def value_counts(df: DataFrame, *cols) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def at_maximum(df: DataFrame, col: str, key=()) -> DataFrame:
    """All rows at the maximum of their group; the maximum is combined before it is joined back."""
    keys = names(key)
    top = df.groupBy(*keys).agg(F.max(col).alias(col))
    return df.join(top, [*keys, col], "left_semi")


def eda_bundle(df: DataFrame, key="station", value: str = "value", time: str = "time", method: str = "zscore",
               z: float = 3.0, period: int = 24) -> dict[str, DataFrame]:
    """Summary, health, outliers and decomposition of every series, each a lazy frame."""
    from .decompose import decompose

    known = df.filter(F.col(value).isNotNull())
    return {
        "summary_stats": describe(df, key, value),
        "health": series_health(df, key, value),
        "outliers": flag_outliers(df, key, value, time, method, z),
        "decomposition": decompose(known, period, key, value, time, extrapolate=True),
    }

