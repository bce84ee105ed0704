"""Queries: wide tables and long feeds brought to their layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from brisa.operators import conform
from brisa.params import READING_CODES
from brisa.plans import adapters, sql
from brisa.plans.registry import query
from brisa.session import shared_dir
from brisa.sources import sinks
from brisa.sources.files import read_csv, write_csv

STAMP_SQL = "l_shipdate + to_hours(CAST(l_orderkey % 24 + 1 AS INTEGER))"


def vendor_rows(spark, sf, table):
    """Items as the texts of a wide table: column j of a row holds quantity + j, a dash in every fifth."""
    line, texts = F.col("l_linenumber"), []
    for j, (name, (_, kind)) in enumerate(conform.WIDE[table].items()):
        if kind == "timestamp_ntz":
            value = F.date_format(adapters.item_stamp(), "yyyy-MM-dd HH:mm:ss")
        elif kind == "string":
            value = F.concat(F.lit("V"), line, F.lit("-"), F.lit(j))
        else:
            number = F.col("l_quantity") + j
            number = number.cast("int") if kind == "int" else number + 0.5
            value = F.when((line + j) % 5 == 0, "-").otherwise(number.cast("string"))
        texts.append(value.alias(name))
    return adapters.table(spark, sf, "lineitem").select(*texts)


def _wide_sql(table):
    out = []
    for j, (name, (_, kind)) in enumerate(conform.WIDE[table].items()):
        if kind == "timestamp_ntz":
            value = STAMP_SQL
        elif kind == "string":
            value = f"'V' || l_linenumber || '-{j}'"
        else:
            number = f"CAST(l_quantity + {j} AS INTEGER)" if kind == "int" else f"l_quantity + {j}.5::DOUBLE"
            value = f"CASE WHEN (l_linenumber + {j}) % 5 <> 0 THEN {number} END"
        out.append(f'{value} AS "{name}"')
    return f"SELECT {', '.join(out)} FROM lineitem"


for _table in ("fence_hour", "fence_minute"):

    @query(f"B18_{_table}", _wide_sql(_table))
    def fence(spark, sf, table=_table):
        return conform.conform_wide(vendor_rows(spark, sf, table), table)


@query("B18_remote_sensing", _wide_sql("remote_sensing"))
def remote_sensing(spark, sf):
    """Written and read as tab-separated text with a header, then typed."""
    path = shared_dir(spark, "remote-sensing")
    rows = vendor_rows(spark, sf, "remote_sensing")
    write_csv(rows, path, sep="\t")
    schema = ", ".join(f"`{c}` string" for c in rows.columns)
    return conform.conform_wide(read_csv(spark, path, schema, sep="\t"), "remote_sensing")


@query("B18_fence_upsert", f"""
  WITH k AS (SELECT l_suppkey AS s, {STAMP_SQL} AS avgdate, max(l_quantity) AS q, max(l_extendedprice) AS x, max(l_shipdate) AS d FROM lineitem GROUP BY 1, 2)
  SELECT CAST(s AS INTEGER) AS stationid, avgdate, q AS pm10, CASE WHEN month(avgdate) = 3 THEN x ELSE q + 1 END AS voc FROM k""")
def fence_upsert(spark, sf):
    """Rows of March come again: only their voc changes, and only their days are rewritten."""
    items = adapters.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("stationid"), adapters.item_stamp().alias("avgdate"), "l_quantity", "l_extendedprice"
    )
    means = items.groupBy("stationid", "avgdate").agg(F.max("l_quantity").alias("pm10"), F.max("l_extendedprice").alias("x"))
    month = F.date_trunc("month", "avgdate").cast("date").alias("month")
    first = conform.conform_wide(means.withColumn("voc", F.col("pm10") + 1), "fence_hour").select("stationid", "avgdate", "pm10", "voc", month)
    again = conform.conform_wide(means.withColumns({"voc": F.col("x"), "pm10": F.lit(-1.0)}), "fence_hour")
    again = again.select("stationid", "avgdate", "pm10", "voc", month).where(F.month("avgdate") == 3)
    path, keys = shared_dir(spark, "fence"), ["stationid", "avgdate", "month"]
    sinks.merge_partitions(first, path, keys, "avgdate", ["month"])
    sinks.merge_partitions(again, path, keys, "avgdate", ["month"], update_cols=["voc"])
    return spark.read.schema(first.schema).parquet(path).drop("month")


_CODES = [*READING_CODES, "199"]


def _code_max(name):
    at = _CODES.index(next(c for c, n in READING_CODES.items() if n == name))
    scale = " * 1000" if name in ("so2", "no2", "o3", "pm10", "pm2_5") else ""
    return f"max(v) FILTER (code = {at}){scale} AS {name}"


@query("A15_reading_codes", f"""
  SELECT '510107' || user_id AS station_code, published_at, {', '.join(n for n in READING_CODES.values())} FROM (
    SELECT user_id, date_trunc('hour', ts) AS published_at, {', '.join(_code_max(n) for n in READING_CODES.values())}
    FROM (SELECT *, event_id % {len(_CODES)} AS code, floor(value) AS v FROM events) GROUP BY 1, 2)
  WHERE coalesce({sql.each('@')}) IS NOT NULL""")
def reading_codes(spark, sf):
    """The long feed with its weather codes, and one code that nobody knows."""
    code = F.array(*map(F.lit, _CODES))[(F.col("event_id") % len(_CODES)).cast("int")]
    feed = adapters.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("StationCode"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("TimePoint"),
        code.alias("PollutantCode"), F.floor("value").cast("double").alias("MonValue"),
    )
    return conform.district_readings(feed, "510107")
