"""Scaling, model training and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features, impute
from ..operators.stats import partial_autocorrelation
from ..plans import forecast, sweep
from ..session import checkpoint
from .base import HOURLY, PAIRED, TABLE_BLOCK, clock_grid, hourly, paired, query, tidy
from .cleaning import CLEANED, SEASONAL
from .featured import corr_sql

CLEAN = f"{HOURLY}, {clock_grid('hourly', 'grid', '1 hour')}, {CLEANED.format(src='hourly', k='10')}, clean AS (SELECT station, time, slot + 1 AS rn, {SEASONAL} AS value, count(*) OVER (PARTITION BY station) AS n FROM kept)"


def cleaned(spark, sf):
    """Hourly levels of every station without gaps."""
    return impute.river_clean(hourly(spark, sf), step=3600, block=TABLE_BLOCK, unique=True).select("station", "time", "value")


@query("m02_standard_scaling", f"""WITH {PAIRED}, t AS (SELECT *, row_number() OVER (PARTITION BY station ORDER BY time DESC) > 168 AS train, 3.0::DOUBLE AS constant FROM paired),
s AS (SELECT station, avg(level) AS m, stddev_pop(level) AS d, avg(rain) AS rm, stddev_pop(rain) AS rd FROM t WHERE train GROUP BY 1)
SELECT t.station, t.time, round((level - m) / CASE WHEN d = 0 THEN 1 ELSE d END + 1e-9, 6) AS level, round((rain - rm) / CASE WHEN rd = 0 THEN 1 ELSE rd END + 1e-9, 6) AS rain, CASE WHEN s.m IS NOT NULL THEN 0.0::DOUBLE END AS constant FROM t LEFT JOIN s ON s.station = t.station""")
def m02_standard_scaling(spark, sf):
    """Statistics of the training rows applied to all rows; a station without any keeps its rows, unscaled
    columns being NULL."""
    rows = paired(spark, sf).withColumn("constant", F.lit(3.0))
    train, test = forecast.split_tail(rows, block=TABLE_BLOCK)
    scaler = forecast.Scaler(["level", "rain", "constant"]).fit(train)
    return tidy(scaler.transform(train.unionByName(test)).select("station", "time", "level", "rain", "constant"))


@query("c03_expanding_folds", f"""WITH {HOURLY}, n AS (SELECT station, time, row_number() OVER (PARTITION BY station ORDER BY time) - 1 AS i, count(*) OVER (PARTITION BY station) AS n FROM hourly),
f AS (SELECT *, n - (5 + 1 - fold) * (n // 6) AS s FROM n, range(1, 6) r(fold))
SELECT station, time, fold, CASE WHEN i < s THEN 'train' ELSE 'test' END AS role FROM f WHERE i < s + n // 6""")
def c03_expanding_folds(spark, sf):
    return tidy(forecast.expanding_folds(hourly(spark, sf), 5, block=TABLE_BLOCK).drop("value"))


AR = f"""WITH RECURSIVE {CLEAN}, train AS (SELECT * FROM clean WHERE rn <= n - 168),
d AS (SELECT station, rn, value - lag(value, 1) OVER w - lag(value, 24) OVER w + lag(value, 25) OVER w AS w FROM train WINDOW w AS (PARTITION BY station ORDER BY rn)),
l AS (SELECT station, w, lag(w, 1) OVER v AS a, lag(w, 24) OVER v AS b FROM d WINDOW v AS (PARTITION BY station ORDER BY rn)),
s AS (SELECT station, sum(a * a) AS aa, sum(b * b) AS bb, sum(a * b) AS ab, sum(a * w) AS aw, sum(b * w) AS bw FROM l WHERE w IS NOT NULL AND a IS NOT NULL AND b IS NOT NULL GROUP BY 1),
c AS (SELECT station, (aw * bb - bw * ab) / (aa * bb - ab * ab) AS p, (bw * aa - aw * ab) / (aa * bb - ab * ab) AS q FROM s),
y0 AS (SELECT station, list(value ORDER BY rn) AS ys FROM train WHERE rn > n - 168 - 50 GROUP BY 1),
f AS (SELECT station, 0 AS step, ys FROM y0 UNION ALL
 SELECT f.station, step + 1, list_append(ys, ys[-1] + ys[-24] - ys[-25] + p * (ys[-1] - ys[-2] - ys[-25] + ys[-26]) + q * (ys[-24] - ys[-25] - ys[-48] + ys[-49])) FROM f JOIN c ON c.station = f.station WHERE step < 168),
pred AS (SELECT k.station, k.time, k.value, f.ys[-1] AS prediction FROM f JOIN clean k ON k.station = f.station AND k.rn = k.n - 168 + f.step WHERE f.step > 0)"""


@query("m05_seasonal_ar_coefficients", f"{AR} SELECT station, round(p + 1e-9, 6) AS phi, round(q + 1e-9, 6) AS seasonal_phi FROM c")
def m05_seasonal_ar_coefficients(spark, sf):
    """The two coefficients of every station from one aggregate."""
    train, _ = forecast.split_tail(cleaned(spark, sf), block=TABLE_BLOCK)
    return tidy(forecast.SeasonalAR().coefficients(train))


@query("m05_seasonal_ar_forecast", f"{AR} SELECT station, time, round(value + 1e-9, 6) AS value, round(prediction + 1e-9, 6) AS prediction FROM pred")
def m05_seasonal_ar_forecast(spark, sf):
    """168 hours ahead for every station."""
    _, predictions = forecast.evaluate(cleaned(spark, sf), forecast.SeasonalAR(), block=TABLE_BLOCK)
    return tidy(predictions.select("station", "time", "value", "prediction"))


@query("m06_train_and_evaluate", f"""{AR}, m AS (SELECT *, avg(value) OVER (PARTITION BY station) AS mean FROM pred)
SELECT station, 'SeasonalAR' AS model, count(*) AS n, round(sqrt(avg((value - prediction) ** 2)) + 1e-9, 6) AS rmse, round(avg(abs(value - prediction)) + 1e-9, 6) AS mae,
 round(1 - sum((value - prediction) ** 2) / sum((value - mean) ** 2) + 1e-9, 6) AS r2 FROM m GROUP BY 1""")
def m06_train_and_evaluate(spark, sf):
    """Split, fit, predict and score all stations in one job."""
    metrics, _ = forecast.evaluate(cleaned(spark, sf), forecast.SeasonalAR(), block=TABLE_BLOCK)
    return tidy(metrics.drop("settings"))


TREE_FEATURES = ["value_lag_1h", "value_lag_2h", "value_lag_3h", "value_lag_24h", "hour", "weekday"]


def training_table(spark, sf):
    """Lags and calendar columns of the cleaned levels; written once since fitting reads it many times."""
    rows = features.numbered(cleaned(spark, sf), block=TABLE_BLOCK)
    lagged = features.lead_and_lags(rows, "station", "rn", {"value": [1, 2, 3, 24]}).drop("rn")
    return checkpoint(lagged.withColumns({"hour": F.hour("time"), "weekday": F.weekday("time")}).na.drop())


@query("m03_boosted_trees")
def m03_boosted_trees(spark, sf):
    """Boosted trees at the configured depth, rate and rounds."""
    model = forecast.TreeModel(TREE_FEATURES, kind="boosted")
    return tidy(forecast.evaluate(training_table(spark, sf), model, block=TABLE_BLOCK)[0])


@query("m04_forest_importance")
def m04_forest_importance(spark, sf):
    """Random forest and its feature importances."""
    model = forecast.TreeModel(TREE_FEATURES, kind="forest")
    train, _ = forecast.split_tail(training_table(spark, sf), block=TABLE_BLOCK)
    return tidy(model.fit(train).importance())


@query("m04_forest_metrics")
def m04_forest_metrics(spark, sf):
    model = forecast.TreeModel(TREE_FEATURES, kind="forest")
    return tidy(forecast.evaluate(training_table(spark, sf), model, block=TABLE_BLOCK)[0])


@query("m08_spark_ml_line", f"""WITH {CLEAN}, l AS (SELECT station, time, value, lag(value, 1) OVER w AS x FROM clean WINDOW w AS (PARTITION BY station ORDER BY rn)),
k AS (SELECT *, row_number() OVER (PARTITION BY station ORDER BY time DESC) <= 168 AS test FROM l WHERE x IS NOT NULL),
c AS (SELECT regr_slope(value, x) AS b, regr_intercept(value, x) AS a FROM k WHERE NOT test)
SELECT station, time, round(value + 1e-9, 6) AS value, round(a + b * x + 1e-9, 6) AS prediction FROM k, c WHERE test""")
def m08_spark_ml_line(spark, sf):
    """The plug-in surface with a least squares line over all stations."""
    rows = features.numbered(cleaned(spark, sf), block=TABLE_BLOCK)
    rows = features.lead_and_lags(rows, "station", "rn", {"value": [1]}).drop("rn").na.drop()
    _, predictions = forecast.evaluate(checkpoint(rows), forecast.LinearModel(["value_lag_1h"]), block=TABLE_BLOCK)
    return tidy(predictions.select("station", "time", "value", "prediction"))


@query("c01_pacf", f"""WITH {PAIRED}, s AS (SELECT station, level, {", ".join(f"lag(level, {k}) OVER (PARTITION BY station ORDER BY rn) AS l{k}" for k in (1, 2, 3))} FROM paired),
r AS (SELECT station, {", ".join(f"{corr_sql('level', f'l{k}')} AS r{k}" for k in (1, 2, 3))} FROM s GROUP BY 1)
SELECT station, 1 AS lag, round(r1 + 1e-9, 6) AS pacf FROM r UNION ALL SELECT station, 2, round((r2 - r1 * r1) / (1 - r1 * r1) + 1e-9, 6) FROM r
UNION ALL SELECT station, 3, round((r1 ** 3 - r1 * r2 * (2 - r2) + r3 * (1 - r1 * r1)) / (1 - r2 * r2 - 2 * r1 * r1 * (1 - r2)) + 1e-9, 6) FROM r""".replace("1 AS lag", "1::BIGINT AS lag"))
def c01_pacf(spark, sf):
    """Partial autocorrelations from the three autocorrelations of each station."""
    curve = features.lagged_corr(features.numbered(paired(spark, sf), block=TABLE_BLOCK), "station", "rn", "level", "level", [1, 2, 3])
    return tidy(partial_autocorrelation(curve))


@query("m06_length_sweep", f"""WITH {HOURLY}, n AS (SELECT station, value, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY station) AS n, lag(value, 1) OVER w AS x, lag(value, 2) OVER w AS z
  FROM hourly WINDOW w AS (PARTITION BY station ORDER BY time)),
p AS (SELECT *, CASE WHEN i < n - 5 * (n // 6) THEN 0 ELSE (i - (n - 5 * (n // 6))) // (n // 6) + 1 END AS part FROM n WHERE value IS NOT NULL AND x IS NOT NULL AND z IS NOT NULL),
c AS (SELECT station, fold, count(*) AS n_train, avg(value) AS my, avg(x) AS mx, avg(z) AS mz, var_pop(x) AS xx, var_pop(z) AS zz, covar_pop(x, z) AS xz, covar_pop(x, value) AS xy, covar_pop(z, value) AS zy
  FROM p, range(1, 6) r(fold) WHERE part < fold GROUP BY 1, 2),
b AS (SELECT station, fold, n_train, 1 AS length, xy / xx AS u, 0.0::DOUBLE AS v, my - xy / xx * mx AS a FROM c
  UNION ALL SELECT station, fold, n_train, 2, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS u, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS v, my - u * mx - v * mz FROM c)
SELECT b.station, fold::BIGINT AS fold, length::BIGINT AS length, any_value(n_train) AS n_train, count(*) AS n_test, round(any_value(a) + 1e-9, 6) AS intercept,
  round(sqrt(avg((value - a - u * x - v * z) ** 2)) + 1e-9, 6) AS rmse
FROM b JOIN p ON p.station = b.station AND p.part = b.fold GROUP BY 1, 2, 3""")
def m06_length_sweep(spark, sf):
    """Fits on the last one and two values for five expanding folds, from one scan."""
    return tidy(sweep.length_sweep(hourly(spark, sf), [1, 2], 5, block=TABLE_BLOCK).drop("weights"))
