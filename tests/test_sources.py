"""Sources and sinks: CSV folders, zip archives, feed and weather documents, tables."""

import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from headway import schemas
from headway.sources import realtime as RT
from headway.sources import static as ST
from headway.sources import tables as TB
from headway.sources import weather as WS

MEMBERS = {
    "stops.txt": "stop_id,stop_code,stop_name,stop_lat\nS1,C1,First,1.0\nS2,,Second,2.0\n",
    "routes.txt": "route_id,route_short_name\nR1,Red\n",
    "trips.txt": "route_id,service_id,trip_id,direction_id\nR1,WKD,T1,0\n",
    "stop_times.txt": "trip_id,arrival_time,departure_time,stop_id,stop_sequence\nT1,08:00:00,08:00:30,S1,1\nT1,25:10:05,25:10:35,S2,2\n",
}


def test_static_folder_and_missing_member(spark, tmp_dir):
    for name, text in MEMBERS.items():
        with open(os.path.join(tmp_dir, name), "w") as fh:
            fh.write(text)
    t = ST.read_static(spark, tmp_dir)
    assert t["gtfs_stop_times"].where(F.col("arrival_time") == "25:10:05").count() == 1
    assert t["gtfs_trips"].collect()[0].direction_id == 0
    assert "loaded_at" in t["gtfs_stops"].columns and t["gtfs_stops"].count() == 2
    os.remove(os.path.join(tmp_dir, "routes.txt"))
    with pytest.raises(FileNotFoundError):
        ST.read_static(spark, tmp_dir)


def test_static_archives(spark, tmp_dir):
    for i in range(3):
        with zipfile.ZipFile(os.path.join(tmp_dir, f"feed{i}.zip"), "w") as zf:
            for name, text in MEMBERS.items():
                zf.writestr(name, text.replace("T1", f"T{i}"))
    t = ST.read_static_archives(spark, os.path.join(tmp_dir, "*.zip"))
    assert sorted(r.trip_id for r in t["gtfs_trips"].collect()) == ["T0", "T1", "T2"]
    assert t["gtfs_stop_times"].count() == 6
    with zipfile.ZipFile(os.path.join(tmp_dir, "broken.zip"), "w") as zf:
        zf.writestr("stops.txt", MEMBERS["stops.txt"])
    with pytest.raises(FileNotFoundError):
        ST.read_static_archives(spark, os.path.join(tmp_dir, "*.zip"))


def feed_docs(path):
    doc = {
        "poll_timestamp": "2024-01-01T10:00:00+00:00",
        "entity": [
            {"id": "1", "trip_update": {"trip": {"trip_id": "T1", "route_id": "R1"},
                                        "stop_time_update": [
                                            {"stop_id": "A", "stop_sequence": 0, "arrival": {"time": 100}, "departure": {"time": 130}},
                                            {"stop_id": "B", "stop_sequence": 0, "departure": {"time": 230}}]}},
            {"id": "2"},                                                                  # no trip update
            {"id": "3", "trip_update": {"trip": {"trip_id": "T2"}, "stop_time_update": []}},  # no stop updates
            {"id": "4", "trip_update": {"trip": {}, "stop_time_update": [{"stop_id": "C"}]}},
        ],
    }
    with open(path, "w") as fh:
        fh.write(json.dumps(doc) + "\n")


def test_feed_flatten(spark, tmp_dir):
    feed_docs(os.path.join(tmp_dir, "poll1.json"))
    rows = RT.flatten_trip_updates(RT.read_feed_documents(spark, tmp_dir)).collect()
    got = sorted((r.trip_id or "", r.route_id, r.stop_id, r.arrival_time_unix, r.departure_time_unix) for r in rows)
    assert got == [("", None, "C", None, None), ("T1", "R1", "A", 100, 130), ("T1", "R1", "B", None, 230)]
    assert {r.poll_timestamp for r in rows} == {"2024-01-01T10:00:00+00:00"} == {r.loaded_at for r in rows}
    sink = os.path.join(tmp_dir, "log")
    empty = spark.createDataFrame([], schemas.RT_TRIP_UPDATES)
    assert RT.append_polls(empty, sink) is False and not os.path.exists(sink)
    assert RT.append_polls(spark.createDataFrame(rows, schemas.RT_TRIP_UPDATES), sink) is True
    assert spark.read.parquet(sink).count() == 3


def test_weather_documents(spark, tmp_dir):
    doc = {"latitude": 37.7, "longitude": -122.4,
           "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00", "2024-01-08T01:00"],
                      "precipitation": [0.0, 1.5, None], "temperature_2m": [10.0, 11.0, 9.0], "windspeed_10m": [5.0, 25.0, 3.0]}}
    path = os.path.join(tmp_dir, "w.json")
    with open(path, "w") as fh:
        fh.write(json.dumps(doc) + "\n")
    flat = WS.flatten_hourly_weather(WS.read_weather_documents(spark, path), loaded_at="x")
    assert flat.count() == 3 and flat.columns == [f.name for f in schemas.WEATHER_HOURLY.fields]
    assert WS.restrict_days(flat, "2024-01-07", 7).count() == 2
    with open(os.path.join(tmp_dir, "bad.json"), "w") as fh:
        fh.write(json.dumps({"latitude": 1.0}) + "\n")
    with pytest.raises(Exception, match="No hourly weather data returned"):
        WS.flatten_hourly_weather(WS.read_weather_documents(spark, os.path.join(tmp_dir, "bad.json"))).collect()


def test_tables(spark, tmp_dir):
    empty = TB.read_or_empty(spark, os.path.join(tmp_dir, "missing"), schemas.EVENT_WINDOWS)
    assert empty.count() == 0 and empty.schema == schemas.EVENT_WINDOWS
    TB.write_table(spark.range(3), os.path.join(tmp_dir, "t"))
    TB.write_table(spark.range(5), os.path.join(tmp_dir, "t"))
    assert spark.read.parquet(os.path.join(tmp_dir, "t")).count() == 5
    assert TB.safe_table(spark, "no_such_table_xyz") is None
    spark.range(2).createOrReplaceTempView("present_view")
    assert TB.table_presence(spark, ["present_view", "absent_view"]) == {"present_view": True, "absent_view": False}


def test_raw_layer_follows_its_input(spark, tmp_dir):
    """New files under the same path are read anew in the same session."""
    import shutil

    from headway.sources.raw_layer import INPUTS, raw_transit

    for name in INPUTS:
        shutil.copy(f"/root/testdata/sf0.001/{name}.parquet", f"{tmp_dir}/{name}.parquet")
    before = raw_transit(spark, tmp_dir).trips.count()
    few = spark.read.parquet(f"{tmp_dir}/orders.parquet").limit(10).toPandas()
    spark.createDataFrame(few).coalesce(1).write.parquet(f"{tmp_dir}/new.parquet")
    os.remove(f"{tmp_dir}/orders.parquet")
    os.rename(f"{tmp_dir}/new.parquet", f"{tmp_dir}/orders.parquet")
    assert before > 10 and raw_transit(spark, tmp_dir).trips.count() == 10


def test_archive_members_are_partitions_of_their_own(spark, tmp_dir):
    from headway.sources.archives import read_members

    for i, rows in enumerate((3, 40_000)):
        with zipfile.ZipFile(os.path.join(tmp_dir, f"size{i}.zip"), "w") as zf:
            zf.writestr("a.txt", "x,y\n" + "".join(f"{r},v{i}\n" for r in range(rows)))
            zf.writestr("b.txt", "z\n" + "q\n" * (i + 1))
    members = read_members(spark, os.path.join(tmp_dir, "size*.zip"), ["a.txt", "b.txt"])
    a = members["a.txt"]
    assert a.rdd.getNumPartitions() == 2 and a.count() == 40_003
    assert {tuple(r["names"]) for r in members["b.txt"].collect()} == {("z",)} and members["b.txt"].count() == 3
    with pytest.raises(FileNotFoundError):
        read_members(spark, os.path.join(tmp_dir, "size*.zip"), ["c.txt"])


def test_refresh_without_a_gap(spark, tmp_dir):
    from pyspark.sql import functions as F

    from headway.sources.tables import replace_table, table_location

    table = "gapless_" + os.path.basename(tmp_dir).replace("-", "_")
    replace_table(spark.range(3), table, tmp_dir)
    reader = spark.table(table)  # has begun with the first version
    replace_table(spark.range(5), table, tmp_dir)
    assert reader.count() == 3 and spark.table(table).count() == 5
    failing = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        replace_table(failing, table, tmp_dir)
    assert spark.table(table).count() == 5
    with pytest.raises(ValueError):
        replace_table(spark.range(1).selectExpr("id AS other"), table, tmp_dir)
    replace_table(spark.range(7), table, tmp_dir)
    assert spark.table(table).count() == 7
    folder = os.path.join(tmp_dir, table)
    assert len(os.listdir(folder)) == 2 and os.path.basename(table_location(spark, table)) in os.listdir(folder)


def test_inventory_and_description(spark):
    from headway.sources.tables import describe, table_inventory

    spark.range(4).createOrReplaceTempView("there_view")
    found = {r["table_name"]: (r["present"], r["column_count"], r["row_count"]) for r in table_inventory(spark, ["there_view", "nowhere"]).collect()}
    assert found == {"there_view": (True, 1, 4), "nowhere": (False, None, None)}
    df = spark.createDataFrame([("b", 2), (None, 1)], "s string, n int")
    assert [tuple(r) for r in describe(df, "t").collect()] == [("t", 0, "s", "string", 1, "b"), ("t", 1, "n", "int", 2, "1")]


def test_large_tables_make_more_archives(spark, tmp_dir):
    from headway.sources.archives import matching, read_members, write_archives

    table = spark.range(1_000).select(F.col("id").cast("string").alias("stop_id"), F.lit("n").alias("stop_name"))
    write_archives({"stops.txt": (table, "stop_id")}, tmp_dir, 2, archive_rows=100)
    assert len(matching(spark, f"{tmp_dir}/*.zip")) == 10
    rows = read_members(spark, f"{tmp_dir}/*.zip", ["stops.txt"])["stops.txt"]
    assert sorted(int(r["fields"][0]) for r in rows.collect()) == list(range(1_000))
    assert rows.groupBy("archive").count().agg(F.max("count")).first()[0] < 200
