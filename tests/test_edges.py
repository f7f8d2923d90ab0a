"""Small hand-computed cases for every trap."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluice.functions import calendar as cal
from sluice.functions import numeric
from sluice.operators import clean, features, gaps, grid, impute, joins, quality, reshape, stats
from sluice.operators.decompose import decompose
from sluice.operators.quantiles import exact_quantiles
from sluice.sources import payloads

from .conftest import column

OFF_GRID = [("2024-01-01 00:07", 1), ("2024-01-01 00:15", 2), ("2024-01-01 00:22", 3), ("2024-01-01 01:00", 4)]


def test_clock_grid_drops_off_grid_readings(series):
    assert column(grid.on_grid(series(OFF_GRID), "station", 900)) == [None, 2, None, None, 4]


def test_anchored_grid_starts_at_first_reading(series):
    assert column(grid.on_grid(series(OFF_GRID), "station", 900, anchored=True)) == [1, 3, None, None]


def test_duplicate_times_are_an_error(series):
    rows = series([("2024-01-01 00:15", 1), ("2024-01-01 00:15", 2)])
    with pytest.raises(PySparkException, match="duplicate times"):
        grid.on_grid(rows, "station", 900).collect()


def test_repeated_times_stay_rows_of_the_grid_when_asked(series):
    rows = series([("2024-01-01 00:07", 2), ("2024-01-01 00:07", 1), ("2024-01-01 00:22", None), ("2024-01-01 00:22", 5),
                   ("2024-01-01 00:30", 8), ("2024-01-01 00:52", 9), ("2024-01-01 00:52", 9)])
    out = grid.on_grid(rows, "station", 900, anchored=True, repeats=True, block=1200).orderBy("slot").collect()
    assert [(f"{r['time']:%H:%M}", r["slot"], r["value"]) for r in out] == [
        ("00:07", 0, 1.0), ("00:07", 1, 2.0), ("00:22", 2, None), ("00:22", 3, 5.0), ("00:37", 4, None), ("00:52", 5, 9.0), ("00:52", 6, 9.0)]


def test_anchored_grid_query_takes_repeated_times(spark, tmp_path):
    """Two copies of one station's rows under other ids, against the SQL twin."""
    import check
    from sluice.queries import ORACLE, QUERIES

    rows = [(c * 100 + i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), "a", float(i)) for c in range(2) for i, m in enumerate((3, 18, 20, 63))]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, event_type string, value double").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = check.duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    name = "g02_anchored_grid"
    status, note, _ = check.compare(spark, con, str(tmp_path), name, QUERIES[name], ORACLE[name])
    assert status == "ok" and note == "8 rows", note


def test_grid_length_is_guarded(series):
    rows = series([("1970-01-01", 1), ("2024-01-01", 2)])
    with pytest.raises(PySparkException, match="max_slots"):
        grid.on_grid(rows, "station", 900, max_slots=1000).collect()


def test_nearest_tie_takes_the_later(series):
    rows = series([("2024-01-01 00:30", 1), ("2024-01-01 01:30", 2)])
    assert column(grid.nearest_on_grid(rows, "station", 3600)) == [1, 2]


def test_linear_fill_edges(slotted):
    assert column(impute.linear_fill(slotted([None, 1, None, 3, None]))) == [None, 1, 2, 3, 3]


def test_nearest_fill_tie_and_edges(slotted):
    assert column(impute.nearest_fill(slotted([None, 1, None, 3, None, None, 9, None]))) == [None, 1, 1, 3, 3, 9, 9, None]


def test_guarded_fill_respects_gap_bound(slotted):
    values = [1] + [None] * 7 + [9]
    assert column(impute.guarded_linear_fill(slotted(values))) == list(range(1, 10))
    longer = [1] + [None] * 8 + [9]
    assert column(impute.guarded_linear_fill(slotted(longer))) == longer


def test_forward_fill_limit(slotted):
    values = [5] + [None] * 97
    filled = column(impute.forward_fill(slotted(values), limit=96))
    assert filled == [5] * 97 + [None]


def test_season_without_values_stays_null(slotted):
    rows = slotted([None, None, None, None, 2, None], step=900)
    assert column(impute.seasonal_fill(rows)) == [None, None, None, None, 2, 2]


def test_ewma_ages_weight_over_nulls(slotted):
    rows = slotted([None, 1, None, 3, 4, None, 6]).withColumn("rn", F.col("slot") + 1)
    out = column(features.ewma(rows, "station", "rn", {"e": ("value", 3)}, rows=2, fan=2), "e")
    assert out[0] is None
    assert out[1:] == pytest.approx([1, 1, 2.3333333, 3.1666667, 3.1666667, 5.0555556], abs=1e-6)


def test_ewma_span_one_is_a_forward_fill(slotted):
    rows = slotted([None, 1, None, 3]).withColumn("rn", F.col("slot") + 1)
    assert column(features.ewma(rows, "station", "rn", {"e": ("value", 1)}), "e") == [None, 1, 1, 3]


def test_rolling_needs_a_full_window(slotted):
    rows = slotted([1, None, 3, 4, None, 6]).withColumn("rn", F.col("slot") + 1)
    out = features.rolling(rows, "station", "rn", "value", [2], ["mean"])
    assert column(out, "value_rolling_mean_2h") == [None, None, None, 3.5, None, None]


@pytest.mark.parametrize("values, expected", [([1, 2, 3, 10], 1.763633), ([1, 1, 1], 0.0), ([1, 2], None)])
def test_skew(slotted, values, expected):
    got = stats.series_health(slotted(values)).first()["skewness"]
    assert got == (pytest.approx(expected, abs=1e-6) if expected is not None else None)


def test_exact_quantile(slotted):
    assert exact_quantiles(slotted([1, 2, 3, 10]), "station", "value", {"q": 0.99}).first()["q"] == pytest.approx(9.79)


def test_constant_column_has_no_correlation(spark):
    rows = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (3.0, 1.0)], "a double, b double")
    assert stats.correlation_with(rows, "a", ["b"]).first()["abs_r"] is None
    assert features.select_by_correlation(rows, "a", ["b"]).count() == 0


def test_correlation_uses_complete_pairs(spark):
    rows = spark.createDataFrame([(1.0, 1.0), (2.0, None), (3.0, 4.0), (4.0, 3.0)], "a double, b double")
    assert rows.agg(numeric.guarded_corr("a", "b").alias("r")).first()["r"] == pytest.approx(0.785714, abs=1e-6)


def test_null_labels_count_in_total_only(spark):
    rows = spark.createDataFrame([("s", "a"), ("s", None), ("s", "a")], "station string, quality string")
    r = quality.label_distribution(rows).collect()
    assert [(x["quality"], x["n"], x["total_records"], x["pct"]) for x in r] == [("a", 2, 3, 100.0)]


def _labelled(spark, labels, start="2024-01-01", minutes=15):
    t0 = dt.datetime.fromisoformat(start)
    return spark.createDataFrame(
        [("s", t0 + dt.timedelta(minutes=minutes * i), x) for i, x in enumerate(labels)],
        "station string, time timestamp_ntz, quality string")


def test_streaks(spark):
    runs = quality.label_runs(_labelled(spark, ["G", "G", "S", "G", "G", "G", None]), block=1800)
    s = {r["quality"]: r for r in quality.streak_summary(runs).collect()}
    assert set(s) == {"G", "S"}
    assert (s["G"]["longest_streak_minutes"], s["G"]["avg_streak_minutes"], s["S"]["longest_streak_minutes"]) == (45, 37.5, 15)
    lengths = {(r["quality"], r["length"]): r["n_streaks"] for r in quality.streak_lengths(runs).collect()}
    assert lengths == {("G", 2): 1, ("G", 3): 1, ("S", 1): 1}


@pytest.mark.parametrize("n, expected", [(2881, [(30.0, 2881)]), (2880, [])])
def test_training_period_length(spark, n, expected):
    runs = quality.label_runs(_labelled(spark, ["Good"] * n), block=86400)
    assert [(r["length_days"], r["n_records"]) for r in quality.training_periods(runs).collect()] == expected


def test_run_across_many_blocks_with_same_ends(spark):
    runs = quality.label_runs(_labelled(spark, ["G", "S", "G", "G", "S", "G"] * 20), block=2700)
    assert sum(r["n_rows"] for r in runs.collect()) == 120
    assert quality.streak_lengths(runs).filter("quality = 'G'").orderBy("length").collect()[0]["length"] == 1


def test_missing_blocks(slotted):
    one = gaps.missing_blocks(slotted([1, None, 2])).collect()
    assert [(r["n_rows"], r["duration_days"]) for r in one] == [(1, 0.0)]
    four = gaps.missing_blocks(slotted([1, None, None, None, None, 2]), block=1800).collect()
    assert [(r["n_rows"], r["duration_days"]) for r in four] == [(4, 0.03125)]


def test_missing_days_rules(series):
    rows = series([("2024-01-01 00:00", 1), ("2024-01-02 12:00", 1), ("2024-01-03 00:00", 1)])
    r = gaps.missing_days(rows, rule="midnight").first()
    assert (r["n_days"], r["n_missing"], round(r["pct_missing"], 2)) == (3, 1, 33.33)
    assert gaps.missing_days(rows, rule="any").first()["n_missing"] == 0
    with pytest.raises(ValueError):
        gaps.missing_days(rows, rule="noon")


@pytest.mark.parametrize("full, n", [(False, 3), (True, 4)])
def test_sequence_counts(slotted, full, n):
    rows = features.numbered(slotted(range(6)), total="n")
    out = features.sequences(rows, "station", "rn", "n", "value", ["value"], 2, 1, full)
    assert out.count() == n
    first = out.orderBy("i").first()
    assert (first["x"], first["y"]) == ([[0.0], [1.0]], 2.0)


@pytest.mark.parametrize("n, flagged", [(102, 1), (101, 0)])
def test_ten_sigma_needs_enough_rows(slotted, n, flagged):
    out = clean.null_outliers(slotted([0] * (n - 1) + [1]), block=7200)
    assert out.filter("value IS NULL").count() == flagged


def test_single_row_is_never_an_outlier(slotted):
    assert column(clean.null_outliers(slotted([5]))) == [5]


def test_duplicate_accounting(series):
    rows = series([("2024-01-01", 1), ("2024-01-01", 2), ("2024-01-01", 3), ("2024-01-02", 4)]).withColumn("id", F.col("value").cast("int"))
    r = gaps.duplicate_stats(rows).first()
    assert (r["n_duplicate_rows"], r["n_excess"], r["pct_excess"]) == (3, 2, 50.0)
    assert column(clean.keep_first(rows, ["station", "time"], "id")) == [1, 4]
    assert clean.duplicates(rows, ["station", "time"], "id").count() == 3
    assert clean.duplicates(rows, ["station", "time"], "id", later_only=True).count() == 2


def test_keep_first_keeps_a_null_of_the_first_row(series):
    rows = series([("2024-01-01", None), ("2024-01-01", 2)]).withColumn("id", F.when(F.col("value").isNull(), 1).otherwise(2))
    assert column(clean.keep_first(rows, ["station", "time"], "id")) == [None]


def test_metrics(spark):
    rows = spark.createDataFrame([("s", 1.0, 1.0), ("s", 2.0, 2.0), ("s", 3.0, 4.0)], "station string, y_true double, y_pred double")
    m = stats.regression_metrics(rows).first()
    assert (m["rmse"], m["mae"], m["r2"]) == (pytest.approx(0.577350, abs=1e-6), pytest.approx(1 / 3), pytest.approx(0.5))


@pytest.mark.parametrize("pred, r2", [(2.0, 1.0), (3.0, 0.0)])
def test_r2_of_constant_truth(spark, pred, r2):
    rows = spark.createDataFrame([("s", 2.0, pred)] * 3, "station string, y_true double, y_pred double")
    assert stats.regression_metrics(rows).first()["r2"] == r2


def test_metrics_refuse_missing_values(spark):
    rows = spark.createDataFrame([("s", 2.0, None)], "station string, y_true double, y_pred double")
    with pytest.raises(PySparkException, match="missing value"):
        stats.regression_metrics(rows).collect()


def test_decomposition(slotted):
    out = decompose(slotted([1, 3] * 3, step=3600), 2).orderBy("time").collect()
    assert [r["trend"] for r in out] == [None, 2, 2, 2, 2, None]
    assert [r["seasonal"] for r in out] == [-1, 1] * 3
    assert [r["resid"] for r in out] == [None, 0, 0, 0, 0, None]


def test_decomposition_needs_two_periods(slotted):
    with pytest.raises(PySparkException, match="at least"):
        decompose(slotted([1, 2, 3]), 2).collect()


def test_list_literal_with_none(spark):
    rows = spark.createDataFrame([("s", "[{'time': 'x', 'value': None}]"), ("s", "[{'time': '2024-01-01T00:00:00Z', 'value': 1.5}]"), ("s", "[]")], "station string, values string")
    out = payloads.explode_series(rows).collect()
    assert {(r["time"], r["value"]) for r in out} == {(dt.datetime(2024, 1, 1), 1.5), (None, None)}
    broken = spark.createDataFrame([("s", "[{'time'")], "station string, values string")
    assert payloads.unreadable(broken).count() == 1


def test_substring_names(spark):
    ids = spark.createDataFrame([("36",), ("361",)], "id string")
    files = spark.createDataFrame([("Sta_361_weather",)], "name string")
    assert sorted(r["id"] for r in joins.containing_names(ids, files).collect()) == ["36", "361"]


def test_iso_week_with_calendar_year(series):
    r = cal.calendar_parts(series([("2024-12-31", 1)])).first()
    assert (r["week"], r["year"]) == (1, 2024)


def test_leap_year_moves_the_slot_key(series):
    keys = [r[0] for r in series([("2023-03-01", 1), ("2024-03-01", 1)]).orderBy("time").select(cal.year_slot("time")).collect()]
    assert keys == [60 * 96, 61 * 96]


def test_no_feature_limit_when_zero(spark):
    rows = spark.createDataFrame([(float(i), float(i), float(-i)) for i in range(5)], "y double, a double, b double")
    assert features.select_by_correlation(rows, "y", ["a", "b"], 0.1, 0).count() == 2
    assert features.select_by_correlation(rows, "y", ["a", "b"], 0.1, 1).count() == 1


def test_pivot_refuses_repeated_cells(spark):
    rows = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0)], "i int, c string, v double")
    with pytest.raises(PySparkException, match="repeated cell"):
        reshape.widen(rows, "i", "c", "v", ["a"]).collect()


def test_completeness(slotted):
    r = gaps.completeness(slotted([1, None, 3, 4])).first()
    assert (r["n_slots"], r["n_known"], r["pct_complete"]) == (4, 3, 75.0)


def test_histogram_last_bin_is_closed(slotted):
    got = {r["bin"]: r["n"] for r in stats.histogram(slotted([0, 1, 2, 4]), 4).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 1}
    assert {r["bin"]: r["n"] for r in stats.histogram(slotted([3, 3]), 4).collect()} == {0: 2}


def test_hybrid_noise_changes_only_filled_cells(slotted):
    values = [4, None, None, None, 8, None, None, None]
    out = column(impute.hybrid_fill(slotted(values), limit=1, noise=0.05, seed=7))
    assert out[0] == 4 and out[1] == 4 and out[4] == 8 and out[5] == 8
    assert all(v is not None for v in out)


def test_keep_first_with_a_null_tie(spark):
    from sluice.operators.clean import keep_first

    rows = spark.createDataFrame([("a", None, 1.0), ("a", None, 1.0), ("b", None, 2.0), ("b", 7, None), ("b", 9, 3.0)], "k string, tie long, value double")
    assert sorted(tuple(r) for r in keep_first(rows, "k", "tie").collect()) == [("a", None, 1.0), ("b", 7, None)]
