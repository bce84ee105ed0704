"""Streams, sinks and readers."""

import datetime as dt
import json

from pyspark.sql import functions as F

from brisa.sources import files, jdbc, sinks, streams
from brisa.streaming import jobs


def stamp(minute):
    return f"2024-03-05 01:{minute:02d}:00"


def message(code, minute, value, lon=0.5, lat=0.5):
    body = {"station_code": code, "coord": {"lon": lon, "lat": lat}, "data": json.dumps({"pm2_5": value}), "time": stamp(minute)}
    return json.dumps(body)


def land(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def text_stream(spark, folder, max_files=1):
    return streams.file_rows(spark, str(folder), "value string", file_format="text", max_files=max_files)


def dims(spark):
    stations = spark.createDataFrame([("M1", 1)], "station_code string, station_id int")
    cells = spark.createDataFrame([(7, 1, 0.0, 0.0, 1.0, 1.0)], "grid_id int, grid_scale int, min_lat double, min_lon double, max_lat double, max_lon double")
    return stations, cells


def ingest(spark, tmp_path):
    stations, cells = dims(spark)
    jobs.stream_ingest(
        text_stream(spark, tmp_path / "in"), lambda: stations, lambda: cells, 1.0,
        str(tmp_path / "out"), str(tmp_path / "checkpoint"),
    ).awaitTermination()
    rows = sinks.read_latest(spark, str(tmp_path / "out"), ["station_code", "published_at"], "published_at")
    return {(r.station_code, r.published_at.minute): (r.station_id, r.grid_id, json.loads(r.data)["pm2_5"]) for r in rows.collect()}


def test_ingest_over_batches_and_restarts(spark, tmp_path):
    land(tmp_path / "in", "1.txt", [message("M1", 1, 10), message("M2", 1, 20, lon=5.0), "{broken"])
    land(tmp_path / "in", "2.txt", [message("M1", 1, 11), message("M1", 2, 12)])
    assert ingest(spark, tmp_path) == {("M1", 1): (1, 7, 11), ("M2", 1): (None, None, 20), ("M1", 2): (1, 7, 12)}
    land(tmp_path / "in", "3.txt", [message("M1", 2, 13)])
    assert ingest(spark, tmp_path)[("M1", 2)] == (1, 7, 13)


def test_replayed_batch_leaves_the_same_table(spark, tmp_path):
    rows = spark.createDataFrame([(1, dt.datetime(2024, 3, 5), 1)], "k int, at timestamp_ntz, v int")
    path = str(tmp_path / "t")
    for _ in range(2):
        sinks.write_batch(rows, path, 0)
    assert spark.read.parquet(path).count() == 1


def test_compacted_batches_read_the_same(spark, tmp_path):
    schema = "k int, at timestamp_ntz, v int"
    path, into = str(tmp_path / "t"), str(tmp_path / "folded")
    day = dt.datetime(2024, 3, 5)
    sinks.write_batch(spark.createDataFrame([(1, day, 1), (2, day, 2)], schema), path, 0)
    sinks.write_batch(spark.createDataFrame([(1, day, 3)], schema), path, 1)
    sinks.compact_batches(spark, path, into, ["k"], "at")
    sinks.write_batch(spark.createDataFrame([(2, day, 4)], schema), into, 2)
    got = sinks.read_latest(spark, into, ["k"], "at")
    assert sorted((r.k, r.v) for r in got.collect()) == [(1, 3), (2, 4)]


def test_last_seen_equals_batch(spark, tmp_path):
    land(tmp_path / "in", "1.txt", [message("M1", 5, 1), message("M2", 1, 1)])
    land(tmp_path / "in", "2.txt", [message("M1", 3, 1)])  # late: must not win
    land(tmp_path / "in", "3.txt", [message("M2", 9, 1)])
    rows = jobs.parse_messages(text_stream(spark, tmp_path / "in"))
    jobs.stream_last_seen(
        rows, "station_code", "published_at", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    ).awaitTermination()
    got = sinks.read_latest(spark, str(tmp_path / "out"), ["station_code"], "published_at")
    assert {(r.station_code, r.published_at.minute) for r in got.collect()} == {("M1", 5), ("M2", 9)}


def test_tagged_stream_keeps_a_key_once(spark, tmp_path):
    """A message that is delivered again updates its row, in the same batch or a later one."""
    land(tmp_path / "in", "1.txt", [message("M1", 1, 1), message("M1", 1, 1), message("M1", 2, 1, lon=9.0)])
    land(tmp_path / "in", "2.txt", [message("M1", 1, 1)])
    _, cells = dims(spark)
    rows = jobs.parse_messages(text_stream(spark, tmp_path / "in"))
    keys = ["published_at", "station_code"]
    jobs.stream_tag_grid(rows, lambda: cells, (1.0, 1.0), str(tmp_path / "out"), str(tmp_path / "checkpoint"), keys).awaitTermination()
    got = sinks.read_latest(spark, str(tmp_path / "out"), keys, "published_at")
    assert sorted((r.published_at.minute, r.grid_id, str(r.publish_date)) for r in got.collect()) == [
        (1, 7, "2024-03-05"), (2, None, "2024-03-05"),
    ]


def test_minute_presence(spark):
    rows = spark.createDataFrame(
        [(1, dt.datetime(2024, 3, 5, 1, 1, s)) for s in (0, 30)] + [(2, dt.datetime(2024, 3, 5, 1, 2))],
        "station int, ts timestamp_ntz",
    )
    presence = jobs.minute_presence(rows, "station", "ts")
    assert presence.count() == 2
    members = spark.createDataFrame([(2, 17), (1, 3)], "station int, control_area_id int")
    assert jobs.presence_of_area(presence, members, 17, "station").count() == 1


def test_flatten_payload(spark):
    text = json.dumps({"station_code": "O1", "coord": {"lat": 1}, "published_at": "2024-03-05 01:00:00", "data": {"pm2_5": "7", "co": 1}})
    df = spark.createDataFrame([(text,)], "value string")
    r = jobs.flatten_payload(df, ["pm2_5", "co"]).first()
    assert (r.station_code, json.loads(r.coord), r.pm2_5, r.co, r.publish_date) == ("O1", {"lat": 1}, "7", "1", dt.date(2024, 3, 5))


def test_dynamic_overwrite_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "v int, dt string")
    sinks.overwrite_partitions(first, path, ["dt"])
    sinks.overwrite_partitions(spark.createDataFrame([(9, "b")], "v int, dt string"), path, ["dt"])
    assert sorted((r.v, r.dt) for r in spark.read.parquet(path).collect()) == [(1, "a"), (9, "b")]


def test_local_encoding_round_trip(spark, tmp_path):
    path = str(tmp_path / "csv")
    files.write_csv(spark.createDataFrame([(1, "积尘负荷")], "id int, name string"), path, sep="\t", encoding="GBK")
    got = files.read_csv(spark, path, "id int, name string", sep="\t", encoding="GBK")
    assert [tuple(r) for r in got.collect()] == [(1, "积尘负荷")]


def test_period_tables_fill_absent_columns(spark, tmp_path):
    a, b = str(tmp_path / "hourdata_2023"), str(tmp_path / "hourdata_2024")
    spark.range(2).write.parquet(a)
    spark.range(1).withColumn("voc", F.lit(1)).write.parquet(b)
    got = files.read_period_tables(spark, [a, b])
    assert got.count() == 3 and got.filter("voc IS NULL").count() == 2


def test_range_predicates_cover_every_row_once(spark):
    parts = jdbc.range_predicates("v", [50, 53, 78])
    df = spark.createDataFrame([(None,), (1,), (50,), (51,), (53,), (60,), (78,), (79,)], "v int")
    hits = [sum(r) for r in zip(*[[1 if x[0] else 0 for x in df.selectExpr(f"coalesce({p}, false)").collect()] for p in parts])]
    assert hits == [1] * 8
    assert jdbc.equal_predicates("lead", [0.5, 1, 2]) == ["lead = 0.5", "lead = 1", "lead = 2"]


class FakeReader:
    def __init__(self):
        self.calls = []

    @property
    def read(self):
        return self

    def jdbc(self, url, table, **kwargs):
        self.calls.append((url, table, kwargs))


def test_jdbc_calls():
    fake, db = FakeReader(), jdbc.Database("jdbc:x", {"user": "u"})
    jdbc.read_table(fake, db, "t")
    jdbc.read_query(fake, db, "select 1")
    jdbc.read_split(fake, db, "t", ["a = 1", "a = 2"])
    assert fake.calls == [
        ("jdbc:x", "t", {"properties": {"user": "u"}}),
        ("jdbc:x", "(select 1) t", {"properties": {"user": "u"}}),
        ("jdbc:x", "t", {"predicates": ["a = 1", "a = 2"], "properties": {"user": "u"}}),
    ]


def test_shared_dir_uses_the_cluster_folder(spark):
    from brisa.session import shared_dir

    class Conf:
        def get(self, key, default=None):
            return "hdfs://cluster/check/" if key == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()

    assert shared_dir(Session(), "x").startswith("hdfs://cluster/check/x-")


def test_compressed_lines_in_files_of_few_rows(spark, tmp_path):
    path = str(tmp_path / "lines")
    rows = spark.range(0, 1000, 1, 2).select(F.lit("区").alias("a"), F.when(F.col("id") % 3 != 0, F.col("id")).alias("b"))
    files.write_csv(rows, path, sep=";", encoding="GBK", header=False, compression="gzip", rows_per_file=100)
    written = list((tmp_path / "lines").glob("*.csv.gz"))
    assert len(written) == 10 and sum(f.stat().st_size for f in written) < 1000 * 4
    got = files.read_delimited(spark, path, ["a", "b"])
    assert sorted((r.a, r.b or "") for r in got.collect()) == sorted(("区", str(n) if n % 3 else "") for n in range(1000))


def test_track_lines_are_stored_compressed(spark, sf, tmp_path, monkeypatch):
    from brisa.plans import tables
    from brisa.plans.registry import QUERIES

    monkeypatch.setattr(tables, "shared_dir", lambda spark, name: str(tmp_path / name))
    got = QUERIES["S7_delimited_lines"](spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert not list((tmp_path / "lines").glob("*.csv")) and list((tmp_path / "lines").glob("*.csv.gz"))
