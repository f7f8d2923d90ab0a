"""Per-station forecasts: splits, scaling, models, evaluation. One job covers all stations."""

from __future__ import annotations

import json
import math
from abc import ABC, abstractmethod
from collections import deque

import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.blocks import BLK, BLOCK, attach, core, in_blocks, inside, names, with_halo, with_row_number
from ..operators.stats import regression_metrics

# Forecast and model settings.
TEST_ROWS = 168
TEST_SHARE = 0.2
SEED = 42
TREE_DEPTH = 6
LEARNING_RATE = 0.1
BOOST_ROUNDS = 100
FOREST_TREES = 100
SEASON = 24


def split_tail(df: DataFrame, test_size: int = TEST_ROWS, key="station", time: str = "time", block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Train and test frames with the position ``rn``, the series length ``n_rows`` and ``n_test``; the
    test set is the last rows of each series."""
    rows = with_row_number(in_blocks(df, key, time, block), key, time, "n_rows").drop(BLK)
    rows = rows.withColumn("n_test", F.lit(test_size))
    is_test = F.col("rn") > F.col("n_rows") - test_size
    return rows.filter(~is_test), rows.filter(is_test)


def expanding_folds(df: DataFrame, k: int, key="station", time: str = "time", block: int = BLOCK) -> DataFrame:
    """Time-series folds: fold f tests the f-th of the last k stretches of n // (k+1) rows and trains
    on everything before it. Adds ``fold`` and ``role``; a row appears once per fold it takes part in."""
    rows = with_row_number(in_blocks(df, key, time, block), key, time, "_n").drop(BLK)
    size = F.floor(F.col("_n") / (k + 1))
    start = F.col("_n") - (k + 1 - F.col("fold")) * size  # first test row, 0-based
    at = F.col("rn") - 1
    return (
        rows.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(k))))
        .filter(at < start + size)
        .withColumn("role", F.when(at < start, "train").otherwise("test"))
        .drop("_n", "rn")
    )


class Scaler:
    """Standard scaling per series with the population deviation; a constant column is only centred.

    ``extra`` are further per-series aggregates of the training rows to attach as columns.
    """

    def __init__(self, columns, key="station", extra=None):
        self.columns, self.key, self.extra, self.stats = list(columns), names(key), extra or {}, None

    def fit(self, train: DataFrame) -> Scaler:
        aggs = []
        for c in self.columns:
            aggs += [F.avg(c).alias(f"_m_{c}"), F.stddev_pop(c).alias(f"_s_{c}")]
        self.stats = train.groupBy(*self.key).agg(*aggs, *[c.alias(n) for n, c in self.extra.items()])
        return self

    def transform(self, df: DataFrame, by="time", suffix: str = "") -> DataFrame:
        """Scaled columns in place, or beside the originals under ``column + suffix``."""
        if self.stats is None:
            raise ValueError("fit the scaler first")
        rows = attach(df, self.stats, self.key, by)
        scaled = {
            c + suffix: (F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_s_{c}"))
            for c in self.columns
        }
        return rows.withColumns(scaled).drop(*[f"_{p}_{c}" for p in "ms" for c in self.columns])


class SeriesModel(ABC):
    """Plug-in surface: fit on the training rows of all stations, predict the test rows."""

    @abstractmethod
    def fit(self, train: DataFrame) -> SeriesModel: ...

    @abstractmethod
    def predict(self, test: DataFrame) -> DataFrame:
        """The test rows with ``prediction``."""

    @abstractmethod
    def params(self) -> dict: ...


class SeasonalAR(SeriesModel):
    """Autoregression of the series differenced by one step and one season, on its lags 1 and season.

    The 2 x 2 normal equations of every station are sums of one aggregate. The forecast recursion
    needs the last 2·season+2 values of a station only (``forecast_path``).
    """

    def __init__(self, season: int = SEASON, value: str = "value", key: str = "station", time: str = "time"):
        self.season, self.value, self.key, self.time = season, value, key, time
        self.state: DataFrame | None = None

    def params(self) -> dict:
        return {"order": [1, 1, 0], "seasonal_order": [1, 1, 0, self.season]}

    def coefficients(self, train: DataFrame) -> DataFrame:
        """``train`` carries a dense ``rn``. One row per station: phi (lag 1) and seasonal_phi."""
        m, v = self.season, self.value
        rows = with_halo(train.select(self.key, "rn", v), self.key, "rn", 2 * m + 2)
        w = inside(self.key, "rn")

        def lagged(k):
            return F.lag(v, k).over(w) if k else F.col(v)

        def differenced(k):
            return lagged(k) - lagged(k + 1) - lagged(k + m) + lagged(k + m + 1)

        d = core(rows.withColumns({"_w": differenced(0), "_a": differenced(1), "_b": differenced(m)}))
        d = d.filter(F.col("_w").isNotNull() & F.col("_a").isNotNull() & F.col("_b").isNotNull())
        s = d.groupBy(self.key).agg(*[
            F.sum(F.col(x) * F.col(y)).alias(x + y) for x, y in (("_a", "_a"), ("_b", "_b"), ("_a", "_b"), ("_a", "_w"), ("_b", "_w"))
        ])
        det = F.col("_a_a") * F.col("_b_b") - F.col("_a_b") * F.col("_a_b")
        return s.select(
            self.key,
            F.try_divide(F.col("_a_w") * F.col("_b_b") - F.col("_b_w") * F.col("_a_b"), det).alias("phi"),
            F.try_divide(F.col("_b_w") * F.col("_a_a") - F.col("_a_w") * F.col("_a_b"), det).alias("seasonal_phi"),
        )

    def fit(self, train: DataFrame) -> SeasonalAR:
        keep = 2 * self.season + 2
        last = F.col("n_rows") - F.col("n_test")  # carried by the split, so the tail is a plain filter
        point = F.struct("rn", F.col(self.value).cast("double").alias("v"))
        recent = train.filter(F.col("rn") > last - keep).groupBy(self.key).agg(
            F.transform(F.array_sort(F.collect_list(point)), lambda s: s["v"]).alias("_ys"), F.max("rn").alias("_end"))
        self.state = self.coefficients(train).join(recent, self.key)
        return self

    def predict(self, test: DataFrame) -> DataFrame:
        horizon = test.groupBy(self.key).agg((F.max("rn") - F.min("rn") + 1).alias("_h"))
        made = forecast_path(self.state.join(horizon, self.key), self.key, self.season)
        return test.join(made, [self.key, "rn"])


def forecast_path(state: DataFrame, key: str, season: int, chunk: int = 10_000) -> DataFrame:
    """(key, rn, prediction) for ``_h`` steps after ``_end``, from the last values ``_ys`` and the coefficients of each series.

    The next value is a fixed combination of the last 2·season+2 ones, which is all a series holds; steps are handed on
    in chunks as they are made, so time is linear in the horizon and memory does not depend on it. A series with too few or unknown last
    values, or without coefficients, has no predictions.
    """
    lags = (1, 2, season, season + 1, season + 2, 2 * season, 2 * season + 1)
    kind = state.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for name, ys, end, phi, seasonal_phi, steps in zip(*(c.to_pylist() for c in batch.columns)):
                known = [math.nan if v is None else v for v in ys][-2 * season - 2:]
                last = deque([math.nan] * (2 * season + 2 - len(known)) + known, maxlen=2 * season + 2)
                p, q = (math.nan if v is None else v for v in (phi, seasonal_phi))
                weights = (1 + p, -p, 1 + q, -1 - p - q, p, -q, q)
                for start in range(0, steps, chunk):
                    size = min(chunk, steps - start)
                    out = []
                    for _ in range(size):
                        last.append(sum(w * last[-k] for w, k in zip(weights, lags)))
                        out.append(last[-1])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * size, batch.schema.field(0).type), pa.array(range(end + start + 1, end + start + size + 1), pa.int64()),
                         pa.array(out, pa.float64(), from_pandas=True)], [key, "rn", "prediction"])

    rows = state.select(key, "_ys", F.col("_end").cast("long"), "phi", "seasonal_phi", F.col("_h").cast("long"))
    return rows.mapInArrow(run, f"`{key}` {kind}, rn long, prediction double")


class TreeModel(SeriesModel):
    """Boosted trees or a random forest over all stations on features scaled per station.

    One distributed fit replaces one local fit per station; rows, not stations, set the parallelism.
    The station enters as its mean training level, which needs no list of stations on the driver.
    """

    def __init__(self, features, label: str = "value", kind: str = "boosted", key: str = "station", **settings):
        self.features, self.label, self.kind, self.key = list(features), label, kind, key
        if kind == "boosted":
            self.estimator = GBTRegressor(maxDepth=TREE_DEPTH, stepSize=LEARNING_RATE, maxIter=BOOST_ROUNDS, seed=SEED)
        elif kind == "forest":
            self.estimator = RandomForestRegressor(numTrees=FOREST_TREES, seed=SEED)
        else:
            raise ValueError("kind must be 'boosted' or 'forest'")
        self.estimator = self.estimator.setParams(labelCol=label, featuresCol="_features", **settings)
        self.model = self.scaler = None

    def params(self) -> dict:
        return {p.name: v for p, v in self.estimator.extractParamMap().items() if p.name in
                ("maxDepth", "stepSize", "maxIter", "numTrees", "seed")}

    def _vectors(self, df: DataFrame) -> DataFrame:
        rows = self.scaler.transform(df, suffix="_z")
        scaled = [f"{c}_z" for c in self.features]
        return VectorAssembler(inputCols=[*scaled, "_level"], outputCol="_features").transform(rows).drop(*scaled, "_level")

    def fit(self, train: DataFrame) -> TreeModel:
        known = train.na.drop(subset=[*self.features, self.label])
        self.scaler = Scaler(self.features, self.key, {"_level": F.avg(self.label)}).fit(known)
        self.model = self.estimator.fit(self._vectors(known).select("_features", self.label))
        return self

    def predict(self, test: DataFrame) -> DataFrame:
        return self.model.transform(self._vectors(test.na.drop(subset=self.features))).drop("_features")

    def importance(self) -> DataFrame:
        rows = [(f, float(v)) for f, v in zip([*self.features, "station_level"], self.model.featureImportances.toArray())]
        return SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double")


class LinearModel(SeriesModel):
    """Least squares over all stations."""

    def __init__(self, features, label: str = "value"):
        self.features, self.label, self.model = list(features), label, None
        self.vectors = VectorAssembler(inputCols=self.features, outputCol="_features")

    def params(self) -> dict:
        return {"features": self.features}

    def fit(self, train: DataFrame) -> LinearModel:
        known = self.vectors.transform(train.na.drop(subset=[*self.features, self.label]))
        self.model = LinearRegression(labelCol=self.label, featuresCol="_features", solver="normal").fit(known)
        return self

    def predict(self, test: DataFrame) -> DataFrame:
        return self.model.transform(self.vectors.transform(test.na.drop(subset=self.features))).drop("_features")


def evaluate(df: DataFrame, model: SeriesModel, test_size: int = TEST_ROWS, key="station", value: str = "value",
             time: str = "time", block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Split, fit, predict, score: (metrics per station with model and settings, predictions)."""
    train, test = split_tail(df, test_size, key, time, block)
    predictions = model.fit(train).predict(test)
    metrics = regression_metrics(predictions, key, value, "prediction")
    return metrics.withColumns({
        "model": F.lit(type(model).__name__), "settings": F.lit(json.dumps(model.params(), sort_keys=True)),
    }), predictions

