"""Index expressions against hand-computed values."""

import math

import pytest
from pyspark.sql import functions as F

from brisa.functions import air, register
from brisa.params import BREAKPOINTS, INDEX_LEVELS, PARAMETERS


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


def values(spark, numbers, build):
    df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(numbers)], "i int, v double")
    return [r.x for r in df.select("i", build("v").alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize("scale", ["hour", "day"])
@pytest.mark.parametrize("parameter", PARAMETERS)
def test_knots_give_the_index_levels(spark, parameter, scale):
    knots = BREAKPOINTS[scale][parameter]
    got = values(spark, knots, lambda v: air.iaqi(v, parameter, scale))
    assert got == list(INDEX_LEVELS)


def test_edges_of_the_sub_index(spark):
    got = values(
        spark, [None, -1, 0, 35, 35.001, 75, 500, 500.1, 9999],
        lambda v: air.iaqi(v, "pm2_5", "day"),
    )
    assert got == [None, 0, 0, 50, 51, 100, 500, 500, 500]


def test_sub_index_rounds_up(spark):
    # 50 / 35 * 10 = 14.28..., 100 + 50 / 40 * 1 = 101.25
    assert values(spark, [10, 76], lambda v: air.iaqi(v, "pm2_5")) == [15, 102]


def test_graded_sub_index_has_limits(spark):
    strict = lambda p, scale: lambda v: air.graded_iaqi(v, p, scale, "null")
    assert values(spark, [800, 801, -1, None], strict("so2", "hour")) == [200, None, None, None]
    assert values(spark, [800, 801], strict("o3", "day")) == [300, None]
    assert values(spark, [500, 500.5, 35], strict("pm2_5", "day")) == [500, None, 50]


def test_graded_sub_index_never_falls_as_the_reading_rises(spark):
    assert values(spark, [800, 1600, 2620, 9999, -1, None], lambda v: air.graded_iaqi(v, "so2", "hour")) == [200, 300, 500, 500, None, None]
    assert values(spark, [800, 1200, 1201], lambda v: air.graded_iaqi(v, "o3", "day")) == [300, 500, 500]
    assert values(spark, [500, 620], lambda v: air.graded_iaqi(v, "pm2_5", "day")) == [500, 500]
    for p in PARAMETERS:
        got = values(spark, range(0, 4200, 7), lambda v, p=p: air.graded_iaqi(v, p, "day"))
        assert got == sorted(got)


def test_grades(spark):
    got = values(spark, [None, -1, 0, 50, 50.5, 51, 100, 101, 150, 151, 200, 201, 300, 301], air.grade)
    assert got == [None, None, 1, 1, 2, 2, 2, 3, 3, 4, 4, 5, 5, 6]


def six(spark, **subs):
    row = {f"{p}_iaqi": subs.get(p) for p in PARAMETERS}
    schema = ", ".join(f"{c} bigint" for c in row)
    return spark.createDataFrame([tuple(row.values())], schema)


def test_index_skips_missing_and_lists_ties(spark):
    df = six(spark, pm2_5=80, o3=80, no2=12).withColumn("aqi", air.aqi())
    got = df.select("aqi", air.primary_pollutants().alias("p")).first()
    assert got.aqi == 80 and got.p == ["o3", "pm2_5"]
    clean = six(spark, pm2_5=50).withColumn("aqi", air.aqi())
    assert clean.select(air.primary_pollutants().alias("p")).first().p == []
    empty = six(spark).withColumn("aqi", air.aqi())
    assert empty.first().aqi is None


@pytest.mark.parametrize(
    "numbers, expected",
    [([], 0.0), ([80.0], 0.5), ([160.0, 320.0], (160 + 160 * 0.9) / 160), ([None, 160.0], 1.0)],
)
def test_percentile_index(spark, numbers, expected):
    df = spark.createDataFrame([(v,) for v in numbers], "v double")
    got = df.agg(air.percentile_index("v", "o3").alias("x")).first().x
    assert math.isclose(got, expected, rel_tol=1e-12)


def test_comprehensive_index_counts_missing_as_zero(spark):
    df = spark.createDataFrame([(35.0, None, 40.0, 60.0, 1.0, 0.5)], "pm2_5 double, pm10 double, no2 double, so2 double, o3_index double, co_index double")
    assert df.select(air.comprehensive_index().alias("x")).first().x == 4.5


def test_grade_agreement(spark):
    def points(g, a):
        return one(spark, air.grade_within_points(f"CAST({g} AS INT)", f"CAST({a} AS DOUBLE)"))

    def share(g, a):
        return one(spark, air.grade_within_share(f"CAST({g} AS INT)", f"CAST({a} AS DOUBLE)"))

    assert points(2, 40) == 1  # 55 is grade 2
    assert points(2, 35) == 0  # 50 is still grade 1
    assert points(1, 60) == 1  # 45 is grade 1
    assert points(1, 80) == 0
    assert points("NULL", 80) is None
    assert share(2, 41) == 1  # 51.25 -> 52
    assert share(2, 40) == 0  # exactly 50
    assert share(1, 66) == 1  # 49.5 -> 50
    assert share(1, 67) == 0  # 50.25 -> 51


def test_primary_agreement(spark):
    df = spark.createDataFrame(
        [(["o3"], ["o3", "pm10"]), ([], ["o3"]), (["co"], ["o3"]), ([], [])],
        "a array<string>, b array<string>",
    )
    assert [r.x for r in df.select(air.primary_agrees("a", "b").alias("x")).collect()] == [1, 0, 0, 0]


def test_reported_rounds_halves_up(spark):
    assert values(spark, [0.5, 1.49, 2.5, None], lambda v: air.reported(v, "o3")) == [1, 1, 3, None]
    assert values(spark, [0.25, 1.15, 3.949999], lambda v: air.reported(v, "co")) == [0.3, 1.2, 3.9]


def test_pollutant_texts(spark):
    df = spark.createDataFrame([("PM2.5,O3",), ("—",), ("pm25",), (None,)], "t string")
    assert [r.x for r in df.select(air.pollutant_list(F.col("t")).alias("x")).collect()] == [
        ["pm2_5", "o3"], None, ["pm2_5"], None,
    ]


def test_sql_functions_agree_with_columns(spark):
    names = register.register(spark)
    assert "iaqi_day_o3" in names and "grade" in names
    row = spark.sql(
        "SELECT iaqi_day_o3(130D) AS i, graded_iaqi_hour_so2(900D) AS g,"
        " aqi_hour(80D, 10D, 10D, 1D, 10D, NULL) AS a, grade(101D) AS gr,"
        " primary_hour(80D, 10D, 10D, 1D, 10D, NULL) AS p,"
        " grade_within_points(2, 40D) AS w, primary_agrees(array('co'), array('co')) AS pa"
    ).first()
    assert (row.i, row.g, row.a, row.gr, row.p, row.w, row.pa) == (75, 213, 107, 3, ["pm2_5"], 1, 1)
    more = spark.sql(
        "SELECT comprehensive_index(35D, 70D, array(80D), array(4D, NULL), 40D, 60D) AS c,"
        " comprehensive_index(35D, 70D, array(160D, 320D), array(), 40D, 60D) AS d,"
        " distance_m(104D, 30D, 104D, 30D) AS m, shifted_lon(0D, 0D) AS x,"
        " grid_id_inner(103.727943D, 30.33658D) AS g"
    ).first()
    assert tuple(more) == (5.5, 5.9, 0, 0.0, 100003 * 1000000 + 100002)
    plan = spark.sql("SELECT iaqi_day_o3(id) FROM range(3)")._jdf.queryExecution().toString()
    assert "Python" not in plan


def by_hand(v, parameter, scale):
    knots = BREAKPOINTS[scale][parameter]
    if v < 0:
        return 0
    for lo, hi, i_lo, i_hi in zip(knots, knots[1:], INDEX_LEVELS, INDEX_LEVELS[1:]):
        if lo <= v <= hi:
            return math.ceil((i_hi - i_lo) / (hi - lo) * (v - lo) + i_lo)
    return 500


@pytest.mark.parametrize("scale", ["hour", "day"])
def test_random_concentrations(spark, scale):
    import random

    rng = random.Random(1)
    for parameter in PARAMETERS:
        top = BREAKPOINTS[scale][parameter][-1]
        numbers = [round(rng.uniform(-0.05, 1.1) * top, rng.choice((0, 1, 3))) for _ in range(400)]
        got = values(spark, numbers, lambda v: air.iaqi(v, parameter, scale))
        assert got == [by_hand(float(v), parameter, scale) for v in numbers]
        rising = [i for _, i in sorted(zip(numbers, got))]
        assert rising == sorted(rising)
