"""File sources with their real names."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException

from sluice.schemas import HOURLY_WEATHER, STATION_TABLE, require
from sluice.sources import gauges, sinks

HEADER = "measure,dateTime,date,value,completeness,quality,qcode\n"


@pytest.fixture
def folder(tmp_path):
    for name, values in (("Millpond", ["0.5", "bad"]), ("Upper-Weir-Bridge", ["1.5", "-0.1"])):
        lines = [f"m,2024-01-01T00:{15 * (1 - i):02d}:00,2024-01-01,{v},Complete,Good," for i, v in enumerate(values)]
        (tmp_path / f"{name}-level-15min-Qualified.csv").write_text(HEADER + "\n".join(lines) + "\n")
    return str(tmp_path)


def test_river_scan(spark, folder):
    rows = gauges.read_river(spark, folder, "Millpond").orderBy("time").collect()
    assert [(r["station"], r["time"], r["value"]) for r in rows] == [
        ("Millpond", dt.datetime(2024, 1, 1, 0, 0), None), ("Millpond", dt.datetime(2024, 1, 1, 0, 15), 0.5)]


def test_all_stations_and_columns(spark, folder):
    rows = gauges.read_qualified(spark, folder)
    require(rows, "measure", "date", "value", "completeness", "quality", "qcode")
    assert rows.count() == 4
    assert sorted(r["station"] for r in gauges.available_stations(spark, folder).collect()) == ["Millpond", "Upper-Weir-Bridge"]


def test_unknown_station(spark, folder):
    with pytest.raises(FileNotFoundError):
        gauges.read_river(spark, folder, "Nowhere")


def test_wrong_header_is_refused(spark, tmp_path):
    (tmp_path / "X-level-15min-Qualified.csv").write_text("a,b,c,d,e,f,g\n1,2,3,4,5,6,7\n")
    with pytest.raises(Exception, match="header|Header|HEADER"):
        gauges.read_river(spark, str(tmp_path)).collect()


def test_unreadable_river_time_is_an_error(spark, tmp_path):
    (tmp_path / "X-level-15min-Qualified.csv").write_text(HEADER + "m,soon,2024-01-01,1,c,Good,\n")
    with pytest.raises(PySparkException):
        gauges.read_river(spark, str(tmp_path)).collect()


def test_missing_column():
    class Fake:
        columns = ["time"]

    with pytest.raises(ValueError, match="value"):
        require(Fake, "time", "value")


def test_weather_union_drops_full_duplicates(spark, tmp_path):
    head = ",".join(f.name for f in HOURLY_WEATHER.fields) + "\n"
    row = "2024-01-01T00:00:00,1,2,3,4,5,6,50.1,-5.1\n"
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "w.csv").write_text(head + row + row)
    assert gauges.read_weather(spark, str(tmp_path), HOURLY_WEATHER, "date").count() == 2
    assert gauges.read_weather(spark, str(tmp_path), HOURLY_WEATHER, "date", keep_station=False).count() == 1


def test_dynamic_overwrite_keeps_other_stations(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "station string, value double")
    sinks.write_series(rows, path)
    sinks.write_series(rows.filter("station = 'a'").selectExpr("station", "9.0D AS value"), path)
    assert sorted((r["station"], r["value"]) for r in spark.read.parquet(path).collect()) == [("a", 9.0), ("b", 2.0)]


def test_station_table_schema_has_all_columns():
    assert len(STATION_TABLE) == 25
