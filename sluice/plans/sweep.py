"""Autoregressions of several lengths over expanding folds, all from one scan of the readings.

A least squares fit needs sums of products only. They are formed once per stretch of a series, for the longest length; the training sums
of a fold are running sums over the stretches before it, those of a shorter length a part of the same matrix, and the test
error follows from the sums of the fold's own stretch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.blocks import BLK, BLOCK, core, in_blocks, inside, with_halo, with_row_number


def stretch_sums(df: DataFrame, longest: int, folds: int, key: str = "station", value: str = "value", time: str = "time",
                 block: int = BLOCK) -> DataFrame:
    """(key, stretch, at, s): sums of products of (1, value, lags 1 to ``longest``), ``at`` numbering the pairs of the upper triangle.

    Stretches 1 to ``folds`` are those that ``forecast.expanding_folds`` tests, 0 is what lies before. Rows with an unknown value or
    lag do not count.
    """
    rows = with_row_number(in_blocks(df.select(key, time, value), key, time, block), key, time, "_n").drop(BLK)
    size = F.floor(F.col("_n") / (folds + 1))
    into = F.col("rn") - 1 - (F.col("_n") - folds * size)
    rows = rows.withColumn("_stretch", F.when((into < 0) | (size == 0), F.lit(0)).otherwise(F.floor(into / size) + 1).cast("int"))
    w = inside(key, "rn")
    lags = [f"_l{i}" for i in range(1, longest + 1)]
    rows = core(with_halo(rows, key, "rn", longest).withColumns({c: F.lag(value, i + 1).over(w) for i, c in enumerate(lags)}))
    known = rows.select(key, "_stretch", F.col(value).cast("double").alias("_y"), *[F.col(c).cast("double") for c in lags]).na.drop(subset=["_y", *lags])
    upper = np.triu_indices(longest + 2)
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = np.column_stack([np.ones(batch.num_rows), *(c.to_numpy() for c in batch.columns[2:])])
            names = batch.column(0).dictionary_encode()
            group = names.indices.fill_null(len(names.dictionary)).to_numpy() * (folds + 1) + batch.column(1).to_numpy()
            for g in np.unique(group):
                own = columns[group == g]
                sums = (own.T @ own)[upper]
                row = int(np.flatnonzero(group == g)[0])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([row] * len(sums))), pa.array([int(g) % (folds + 1)] * len(sums), pa.int32()),
                     pa.array(range(len(sums)), pa.int32()), pa.array(sums)], [key, "stretch", "at", "s"])

    return known.mapInArrow(run, f"`{key}` {kind}, stretch int, at int, s double").groupBy(key, "stretch", "at").agg(F.sum("s").alias("s"))


def length_sweep(df: DataFrame, lengths: list[int], folds: int = 5, key: str = "station", value: str = "value", time: str = "time",
                 block: int = BLOCK) -> DataFrame:
    """(key, fold, length, n_train, n_test, intercept, weights, rmse): a fit on the last ``length`` values for every fold and length.

    All lengths are fitted to the same rows, those with ``max(lengths)`` known lags. A fold whose training rows do not determine the fit gets the
    solution of least norm, one without training or test rows is left out.
    """
    longest = max(lengths)
    sums = stretch_sums(df, longest, folds, key, value, time, block)
    before = Window.partitionBy(key, "at").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    both = sums.withColumn("train", F.sum("s").over(before)).filter("stretch > 0 and train is not null")
    matrices = both.groupBy(key, "stretch").agg(F.array_sort(F.collect_list(F.struct("at", "train", "s"))).alias("m"))  # one triangle each
    rows = matrices.select(key, F.col("stretch").alias("fold"), F.col("m.train").alias("train"), F.col("m.s").alias("test"))
    kind, upper = df.schema[key].dataType.simpleString(), np.triu_indices(longest + 2)

    def square(triangle) -> np.ndarray:
        out = np.zeros((longest + 2, longest + 2))
        out[upper] = triangle
        return out + np.triu(out, 1).T

    def run(batches):
        for batch in batches:
            out = []
            for name, fold, train, test in zip(*(c.to_pylist() for c in batch.columns)):
                train, test = square(train), square(test)
                for length in lengths:
                    use = [0, *range(2, length + 2)]
                    fit = np.linalg.lstsq(train[np.ix_(use, use)], train[use, 1], rcond=None)[0]
                    error = test[1, 1] - 2 * fit @ test[use, 1] + fit @ test[np.ix_(use, use)] @ fit
                    out.append((name, fold, length, round(train[0, 0]), round(test[0, 0]), float(fit[0]), fit[1:].tolist(),
                                float(np.sqrt(max(error, 0.0) / test[0, 0]))))
            if out:
                kinds = [batch.schema.field(0).type, pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                 [key, "fold", "length", "n_train", "n_test", "intercept", "weights", "rmse"])

    return rows.mapInArrow(run, f"`{key}` {kind}, fold int, length int, n_train long, n_test long, intercept double, weights array<double>, rmse double")


def best_length(fits: DataFrame, key: str = "station") -> DataFrame:
    """(key, length, rmse): the length of the smallest mean error over the folds; of equals the shortest."""
    means = fits.groupBy(key, "length").agg(F.avg("rmse").alias("rmse"))
    return means.groupBy(key).agg(F.min(F.struct("rmse", "length")).alias("b")).select(key, "b.length", "b.rmse")
