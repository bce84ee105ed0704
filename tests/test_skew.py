"""One key with a third of all rows: results stay whole."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from brisa.operators import latest, rollup, score, spatial
from brisa.params import PARAMETERS

ROWS = 30_000


@pytest.fixture(scope="module")
def readings(spark):
    """Readings of 200 stations; station 0 has a third of them."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 200).cast("int")
    start = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    return spark.range(ROWS).select(
        key.alias("station_id"),
        (start + F.make_dt_interval(mins=(F.col("id") * 7 % (60 * 24 * 20)).cast("int"))).alias("published_at"),
        *[((F.col("id") * k) % 100).cast("double").alias(p) for k, p in enumerate(PARAMETERS, start=3)],
        F.col("id"),
    ).repartition(16)


def by_hand(readings):
    return [r.asDict() for r in readings.collect()]


def test_hourly_means_of_a_hot_station(spark, readings):
    hours = readings.withColumn("published_at", F.date_trunc("hour", "published_at").cast("timestamp_ntz"))
    got = {
        (r.station_id, r.published_at): r.o3
        for r in rollup.hourly_means(hours, ["station_id"]).collect()
    }
    sums = {}
    for r in by_hand(hours):
        s = sums.setdefault((r["station_id"], r["published_at"]), [0.0, 0])
        s[0] += r["o3"]
        s[1] += 1
    assert got == {k: s / n for k, (s, n) in sums.items()}


def test_latest_of_a_hot_station(readings):
    got = {r.station_id: r.id for r in latest.latest_per_key(readings, ["station_id"], "published_at", ["id"]).collect()}
    best = {}
    for r in by_hand(readings):
        best[r["station_id"]] = max(best.get(r["station_id"], (dt.datetime.min, -1)), (r["published_at"], r["id"]))
    assert got == {k: v[1] for k, v in best.items()}


def test_scores_of_a_hot_key(readings):
    said = [F.col(p).alias(f"{p}f") for p in PARAMETERS]
    seen = [(F.col(p) + 1).alias(f"{p}r") for p in PARAMETERS]
    index = [
        F.lit(60).alias("aqif"), F.lit(2).alias("gradef"), F.array(F.lit("o3")).alias("prf"),
        F.lit(70).alias("aqir"), F.lit(2).alias("grader"), F.array(F.lit("o3")).alias("prr"),
    ]
    got = score.score_forecast(readings.select("station_id", *said, *seen, *index), ["station_id"])
    rows = got.collect()
    assert len(rows) == 200
    assert all(r.co_rmse == 1.0 and r.accuracy == 100.0 for r in rows)


def test_trajectory_of_a_hot_vehicle(spark):
    rng = random.Random(2)
    start = dt.datetime(2024, 3, 1)
    rows, spot = [], 0
    for second in range(0, 3 * 24 * 3600, 60):
        spot += rng.random() < 0.2
        rows.append(("P0", "hot", start + dt.timedelta(seconds=second), 103.8 + (spot % 300) * 0.002, 30.5, 1))
    rows += [(f"P{i}", f"v{i}", start, 103.8, 30.5, 1) for i in range(1, 200)]
    df = spark.createDataFrame(
        rows, "plate_num string, name string, published_at timestamp_ntz, lon double, lat double, speed int"
    )
    kept = spatial.thin_trajectory(df).groupBy("name").count().collect()
    counts = {r["name"]: r["count"] for r in kept}
    changes = 1 + sum(
        round(a[3], 6) != round(b[3], 6) for a, b in zip(rows, rows[1:]) if b[1] == "hot"
    )
    assert counts["hot"] == changes and sum(counts.values()) == changes + 199


def test_mean_features_near_a_crowded_spot(spark):
    from brisa.operators import features

    points = spark.range(ROWS).select(
        F.when(F.col("id") % 3 == 0, 104.0).otherwise(104.0 + (F.col("id") % 50) * 0.001).alias("lon"),
        F.lit(30.5).alias("lat"),
        (F.col("id") % 10).cast("double").alias("rainfall"),
    )
    stations = spark.createDataFrame([(1, 104.0, 30.5), (2, 110.0, 30.5)], "station_id int, lon double, lat double")
    places = features.sites(stations)
    near = features.mean_features(points, places, ["rainfall"])
    got = {r.station_id: r.rainfall for r in features.station_features(stations, [near]).collect()}
    total = points.agg(F.avg("rainfall").alias("m")).first().m
    assert got == {1: pytest.approx(total), 2: None}
