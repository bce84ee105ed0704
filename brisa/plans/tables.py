"""Queries: scans, sinks, joins, set operations, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from brisa.params import VOC_TRACK_COLUMNS
from brisa.plans import adapters, sql
from brisa.plans.places import track_cells
from brisa.plans.registry import query
from brisa.session import shared_dir
from brisa.sources import files, sinks, streams
from brisa.streaming import jobs

# --- S: sources and sinks -----------------------------------------------------


@query("S2_pushed_down_scan", """
  SELECT l_returnflag, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_linenumber > 2 GROUP BY l_returnflag""")
def pushed_down_scan(spark, sf):
    since = F.lit("1997-01-01").cast("timestamp_ntz")
    rows = files.read_table(
        spark, f"{sf}/lineitem.parquet", ["l_returnflag", "l_quantity"],
        (F.col("l_shipdate") >= since) & (F.col("l_linenumber") > 2),
    )
    return rows.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


def _dated_events(spark, sf):
    return adapters.table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", F.floor("value").cast("bigint").alias("value"),
        F.to_date("ts").alias("publish_date"),
    )


@query("S4_S13_partition_filter", """
  SELECT event_type, count(*) AS n, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS total FROM events
  WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' GROUP BY event_type""")
def partition_filter(spark, sf):
    """Append to a dated table twice, read three of its partitions."""
    path = shared_dir(spark, "dated")
    events = _dated_events(spark, sf)
    sinks.append_partitions(events.filter("event_type = 'click'"), path, ["publish_date"])
    sinks.append_partitions(events.filter("event_type <> 'click'"), path, ["publish_date"])
    days = F.col("publish_date").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-12").cast("date"))
    rows = files.read_table(spark, path, ["event_type", "value"], days)
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("S14_overwrite_partitions", """
  SELECT CAST(ts AS DATE) AS publish_date, count(*) FILTER (CAST(ts AS DATE) < DATE '2024-01-15' OR event_type = 'view') AS n
  FROM events GROUP BY 1 HAVING count(*) FILTER (CAST(ts AS DATE) < DATE '2024-01-15' OR event_type = 'view') > 0""")
def overwrite_partitions(spark, sf):
    """The second half of the month is replaced by its views; the first stays."""
    path = shared_dir(spark, "replaced")
    events = _dated_events(spark, sf)
    sinks.overwrite_partitions(events, path, ["publish_date"])
    later = events.filter((F.col("publish_date") >= F.lit("2024-01-15").cast("date")) & (F.col("event_type") == "view"))
    sinks.overwrite_partitions(later, path, ["publish_date"])
    return spark.read.parquet(path).groupBy("publish_date").agg(F.count("*").alias("n"))


@query("S6_csv_with_header", """
  SELECT c_custkey, '客户' || c_name AS name, floor(c_acctbal) AS balance FROM customer""")
def csv_with_header(spark, sf):
    """Tab-separated text in a local encoding, header first."""
    path = shared_dir(spark, "csv")
    customers = adapters.table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("客户"), F.col("c_name")).alias("name"),
        F.floor("c_acctbal").alias("balance"),
    )
    files.write_csv(customers, path, sep="\t", encoding="GBK")
    return files.read_csv(
        spark, path, "c_custkey bigint, name string, balance double", sep="\t", encoding="GBK"
    )


@query("S7_delimited_lines", f"""
  SELECT '区' || l_returnflag AS tvoc_time, {', '.join(
      f"CASE WHEN l_linenumber <> {n % 7 + 1} THEN CAST(CAST(l_partkey + {n} AS BIGINT) AS VARCHAR) END AS {c}"
      for n, c in enumerate(VOC_TRACK_COLUMNS[1:]))} FROM lineitem""")
def delimited_lines(spark, sf):
    """All 59 columns of a track file; empty fields are missing.

    The text is many times as long as the table it comes from.  It is compressed, and lines of
    near numbers lie beside each other: they share most of their text.
    """
    path = shared_dir(spark, "lines")
    items = adapters.table(spark, sf, "lineitem").select("l_returnflag", "l_linenumber", "l_partkey")
    rows = items.sortWithinPartitions("l_partkey", "l_linenumber").select(
        F.concat(F.lit("区"), F.col("l_returnflag")).alias(VOC_TRACK_COLUMNS[0]),
        *[
            F.when(F.col("l_linenumber") != n % 7 + 1, F.col("l_partkey") + n).alias(c)
            for n, c in enumerate(VOC_TRACK_COLUMNS[1:])
        ],
    )
    files.write_csv(rows, path, sep=";", encoding="GBK", header=False, compression="gzip", rows_per_file=50_000)
    return files.read_delimited(spark, path, VOC_TRACK_COLUMNS)


@query("S17_period_tables", """
  SELECT CAST(year(l_shipdate) AS INTEGER) AS y, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
    sum(CASE WHEN year(l_shipdate) >= 1998 THEN l_linenumber END)::BIGINT AS extra FROM lineitem GROUP BY 1""")
def period_tables(spark, sf):
    """One table per year; the early ones lack a column."""
    path = shared_dir(spark, "yearly")
    items = adapters.table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("y"), F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_linenumber").cast("bigint").alias("extra"),
    )
    items.filter("y < 1998").drop("extra").write.parquet(f"{path}/hourdata_early")
    items.filter("y >= 1998").write.parquet(f"{path}/hourdata_late")
    merged = files.read_period_tables(spark, [f"{path}/hourdata_early", f"{path}/hourdata_late"])
    return merged.groupBy("y").agg(
        F.count("*").alias("n"), F.sum("quantity").alias("quantity"), F.sum("extra").alias("extra")
    )


# --- J, U: joins and set operations -------------------------------------------


@query("J1_J3_dimension_joins", """
  SELECT o_orderpriority, n_name, count(*) AS orders, count(s_suppkey) AS matched FROM orders
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN supplier ON s_suppkey = o_custkey GROUP BY o_orderpriority, n_name""")
def dimension_joins(spark, sf):
    """Fact to dimensions, inner and left; sizes decide how each join runs."""
    orders = adapters.table(spark, sf, "orders")
    customers = adapters.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nations = adapters.table(spark, sf, "nation").select("n_nationkey", "n_name")
    suppliers = adapters.table(spark, sf, "supplier").select("s_suppkey")
    # orders of one customer are counted before any join
    counted = orders.groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"))
    joined = (
        counted.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(suppliers, F.col("s_suppkey") == F.col("o_custkey"), "left")
    )
    return joined.groupBy("o_orderpriority", "n_name").agg(
        F.sum("n").alias("orders"),
        F.coalesce(F.sum(F.when(F.col("s_suppkey").isNotNull(), F.col("n"))), F.lit(0)).alias("matched"),
    )


@query("J4_left_join_zero", """
  SELECT c_custkey, coalesce(n, 0) AS orders FROM customer LEFT JOIN
    (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def left_join_zero(spark, sf):
    counts = adapters.table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"))
    customers = adapters.table(spark, sf, "customer").select("c_custkey")
    return (
        customers.join(counts, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select("c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"))
    )


@query("J8_full_outer_features", """
  SELECT k AS key, orders, balance, items FROM
    (SELECT DISTINCT k FROM (SELECT o_custkey AS k FROM orders UNION ALL SELECT c_custkey * 2 FROM customer UNION ALL SELECT l_suppkey FROM lineitem))
  LEFT JOIN (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1) ON o_custkey = k
  LEFT JOIN (SELECT c_custkey * 2 AS c, c_acctbal AS balance FROM customer) ON c = k
  LEFT JOIN (SELECT l_suppkey, count(*) AS items FROM lineitem GROUP BY 1) ON l_suppkey = k""")
def full_outer_features(spark, sf):
    """Three feature tables by key: stacked and grouped, one shuffle for all."""
    orders = adapters.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("key")).agg(
        F.count("*").alias("orders")
    )
    balances = adapters.table(spark, sf, "customer").select(
        (F.col("c_custkey") * 2).alias("key"), F.col("c_acctbal").alias("balance")
    )
    items = adapters.table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("key")).agg(
        F.count("*").alias("items")
    )
    stacked = orders.unionByName(balances, allowMissingColumns=True).unionByName(
        items, allowMissingColumns=True
    )
    return stacked.groupBy("key").agg(
        F.max("orders").alias("orders"), F.max("balance").alias("balance"), F.max("items").alias("items")
    )


@query("J9_J10_group_filter_semi", """
  SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
  GROUP BY l_suppkey, l_returnflag HAVING count(*) >= 60""")
def group_filter_semi(spark, sf):
    listed = adapters.table(spark, sf, "supplier").filter("s_acctbal > 0").select(
        F.col("s_suppkey").alias("l_suppkey")
    )
    counted = (
        adapters.table(spark, sf, "lineitem")
        .groupBy("l_suppkey", "l_returnflag")
        .agg(F.count("*").alias("n"))
    )
    return counted.filter("n >= 60").join(listed, on="l_suppkey", how="left_semi")


@query("U1_U2_union_distinct", """
  SELECT DISTINCT key, source FROM (SELECT o_custkey AS key, 'monitoring' AS source FROM orders
    UNION ALL SELECT user_id, 'inference' FROM events)""")
def union_distinct(spark, sf):
    monitored = adapters.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("key"), F.lit("monitoring").alias("source")
    )
    inferred = adapters.table(spark, sf, "events").select(
        F.col("user_id").alias("key"), F.lit("inference").alias("source")
    )
    return monitored.unionByName(inferred).distinct()


@query("U3_difference", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def difference(spark, sf):
    # one row per user: a user with most of the events is combined first
    seen = adapters.table(spark, sf, "events").select(F.col("user_id").alias("c_custkey")).distinct()
    return adapters.table(spark, sf, "customer").select("c_custkey").join(
        seen, on="c_custkey", how="left_anti"
    )


@query("W1_partition_windows", """
  SELECT l_suppkey, l_shipdate, l_linenumber, l_quantity, day_items FROM (SELECT *, count(*) OVER (PARTITION BY l_suppkey, l_shipdate) AS day_items,
    max(l_quantity) OVER (PARTITION BY l_suppkey, l_shipdate) AS top FROM lineitem) WHERE l_quantity = top""")
def partition_windows(spark, sf):
    """Rows that reach their group's largest value.

    The group values are aggregated first and joined back, so a large group is
    combined before the shuffle instead of being sorted in one window.
    """
    items = adapters.table(spark, sf, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_linenumber", "l_quantity"
    )
    groups = items.groupBy("l_suppkey", "l_shipdate").agg(
        F.count("*").alias("day_items"), F.max("l_quantity").alias("l_quantity")
    )
    return items.join(groups, on=["l_suppkey", "l_shipdate", "l_quantity"])


# --- B23: streams -------------------------------------------------------------


#: Days after which a new landing file begins.
LANDINGS = ("2024-01-11", "2024-01-21")


def _event_stream(spark, sf, again=False):
    """Events landed as three files one after the other, read as a batch each.

    With ``again`` the last file also brings the events of the first one once more.
    """
    events = adapters.table(spark, sf, "events")
    path = shared_dir(spark, "landing")
    first, second = (F.lit(day).cast("timestamp_ntz") for day in LANDINGS)
    ts = F.col("ts")
    last = events.where(ts >= second)
    for part in (
        events.where(ts < first),
        events.where((ts >= first) & (ts < second)),
        last.union(events.where(ts < first)) if again else last,
    ):
        part.coalesce(1).write.mode("append").parquet(path)
    return streams.file_rows(spark, path, events.schema, max_files=1)


def _batches(spark, started) -> int:
    """Wait for a drained stream and count the batches that had rows."""
    started.awaitTermination()
    return sum(p.numInputRows > 0 for p in started.recentProgress)


def _messages(spark, sf):
    """Events as the messages of mobile stations."""
    lon, lat = adapters.positions(F.col("event_id"))
    return _event_stream(spark, sf).select(
        F.to_json(
            F.struct(
                F.concat(F.lit("M"), F.col("user_id")).alias("station_code"),
                F.struct(lon.alias("lon"), lat.alias("lat")).alias("coord"),
                F.to_json(F.struct(F.floor("value").alias("pm2_5"), "event_id")).alias("data"),
                F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time"),
            )
        ).alias("value")
    )


def _stations(spark, sf):
    return adapters.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("station_id"),
        F.concat(F.lit("M"), F.col("s_suppkey")).alias("station_code"),
    )


def _cells(spark, sf):
    return track_cells(spark, sf).withColumn("grid_scale", F.lit(1))


_INGESTED = sql.with_views("track_cells", f"""
  SELECT station_code, s_suppkey AS station_id, grid_id, published_at, pm2_5, CAST(event_id AS BIGINT) AS event_id FROM (
    SELECT 'M' || user_id AS station_code, user_id, {sql.place('event_id')}, date_trunc('second', ts) AS published_at,
      CAST(floor(value) AS BIGINT) AS pm2_5, event_id FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('second', ts) ORDER BY
      '{{"pm2_5":' || CAST(floor(value) AS BIGINT) || ',"event_id":' || event_id || '}}' DESC) = 1) p
  LEFT JOIN supplier ON s_suppkey = user_id
  LEFT JOIN track_cells c ON p.lon >= min_lon AND p.lon < max_lon AND p.lat >= min_lat AND p.lat < max_lat""")


@query("B23_T1_stream_ingest", _INGESTED)
def stream_ingest(spark, sf):
    target, checkpoint = shared_dir(spark, "ingest"), shared_dir(spark, "ingest-checkpoint")
    jobs.stream_ingest(
        _messages(spark, sf), lambda: _stations(spark, sf), lambda: _cells(spark, sf), 0.1,
        target, checkpoint,
    ).awaitTermination()
    rows = sinks.read_latest(spark, target, ["station_code", "published_at"], "published_at")
    data = F.from_json("data", "pm2_5 bigint, event_id bigint")
    return rows.select("station_code", "station_id", "grid_id", "published_at", data.alias("d")).select(
        "station_code", "station_id", "grid_id", "published_at", "d.*"
    )


@query("B23_T1_newest_state", _INGESTED)
def ingest_newest(spark, sf):
    """The same rows through a state store: the table holds one row per key and is read as it is."""
    target, checkpoint = shared_dir(spark, "newest"), shared_dir(spark, "newest-checkpoint")
    jobs.ingest_newest(
        _messages(spark, sf), lambda: _stations(spark, sf), lambda: _cells(spark, sf), 0.1,
        target, checkpoint, late="2 days",
    ).awaitTermination()
    data = F.from_json("data", "pm2_5 bigint, event_id bigint")
    columns = ("station_code", "station_id", "grid_id", "published_at")
    return spark.read.parquet(target).select(*columns, data.alias("d")).select(*columns, "d.*")


@query("B23_T5_dimension_refresh", """
  SELECT 'M' || user_id AS station_code, s_suppkey AS station_id, count(*) AS n FROM
    (SELECT DISTINCT user_id, date_trunc('second', ts) AS at, ts >= TIMESTAMP '2024-01-11' AS refreshed FROM events)
  LEFT JOIN supplier ON s_suppkey = user_id AND (refreshed OR s_suppkey % 2 = 0) GROUP BY 1, 2""")
def dimension_refresh(spark, sf):
    """Stations with odd numbers are registered after the first batch."""
    reads = []

    def stations():
        reads.append(1)
        known = _stations(spark, sf)
        return known if len(reads) > 1 else known.where("station_id % 2 = 0")

    target, checkpoint = shared_dir(spark, "refreshed"), shared_dir(spark, "refreshed-checkpoint")
    jobs.stream_ingest(
        _messages(spark, sf), stations, lambda: _cells(spark, sf), 0.1, target, checkpoint
    ).awaitTermination()
    rows = sinks.read_latest(spark, target, ["station_code", "published_at"], "published_at")
    return rows.groupBy("station_code", "station_id").agg(F.count("*").alias("n"))


@query("B23_T6_rate_limit", """
  SELECT 3 AS batches, max(n)::BIGINT AS most, sum(n)::BIGINT AS total FROM (SELECT count(*) AS n FROM events
    GROUP BY CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 1 WHEN ts < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END)""")
def rate_limit(spark, sf):
    """One file a batch at most, though all three are there when the job starts."""
    target, checkpoint = shared_dir(spark, "limited"), shared_dir(spark, "limited-checkpoint")

    def write(batch, batch_id):
        sinks.write_batch(batch.select("event_id"), target, batch_id)

    started = (
        _event_stream(spark, sf).writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(**jobs.DRAIN).start()
    )
    batches = _batches(spark, started)
    sizes = spark.read.parquet(target).groupBy("batch_id").agg(F.count("*").alias("n"))
    return sizes.agg(F.lit(batches).alias("batches"), F.max("n").alias("most"), F.sum("n").alias("total"))


_TAGGED = sql.with_views("cells", """
  SELECT event_id, station_id, published_at, publish_date, a.grid_id, b.grid_id AS grid_id_two FROM
    (SELECT event_id, user_id AS station_id, date_trunc('hour', ts) AS published_at, CAST(ts AS DATE) AS publish_date,
       CAST(event_id % 51 AS DOUBLE) AS lon, CAST(user_id % 51 AS DOUBLE) AS lat FROM events
     QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_id DESC) = 1) p
  LEFT JOIN (SELECT * FROM cells WHERE grid_scale = 1) a ON p.lat > a.min_lat AND p.lat <= a.max_lat AND p.lon > a.min_lon AND p.lon <= a.max_lon
  LEFT JOIN (SELECT * FROM cells WHERE grid_scale = 2) b ON p.lat > b.min_lat AND p.lat <= b.max_lat AND p.lon > b.min_lon AND p.lon <= b.max_lon""")


def _tag_rows(spark, sf):
    """Every message comes twice, and several of a station fall into one hour."""
    return _event_stream(spark, sf).select(
        "event_id", F.col("user_id").alias("station_id"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("published_at"),
        (F.col("event_id") % 51).cast("double").alias("lon"),
        (F.col("user_id") % 51).cast("double").alias("lat"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery"),
    ).drop("delivery")


@query("B23_T2_stream_tag_grid", _TAGGED)
def stream_tag_grid(spark, sf):
    target, checkpoint = shared_dir(spark, "tagged"), shared_dir(spark, "tagged-checkpoint")
    jobs.stream_tag_grid(
        _tag_rows(spark, sf), lambda: adapters.box_cells(spark, sf), (5.0, 10.0), target, checkpoint
    ).awaitTermination()
    keys = ["published_at", "station_id"]
    return sinks.read_latest(spark, target, keys, "published_at").drop("lon", "lat")


@query("B23_T2_newest_state", _TAGGED)
def tag_newest(spark, sf):
    """The same rows through a state store: the table holds one row per key and is read as it is."""
    target, checkpoint = shared_dir(spark, "newest"), shared_dir(spark, "newest-checkpoint")
    jobs.tag_newest(
        _tag_rows(spark, sf), lambda: adapters.box_cells(spark, sf), (5.0, 10.0), target, checkpoint, late="2 days"
    ).awaitTermination()
    return spark.read.parquet(target).drop("lon", "lat")


@query("B23_T3_stream_last_seen", "SELECT user_id, max(ts) AS ts FROM events GROUP BY user_id")
def stream_last_seen(spark, sf):
    target, checkpoint = shared_dir(spark, "seen"), shared_dir(spark, "seen-checkpoint")
    rows = _event_stream(spark, sf).select("user_id", "ts")
    jobs.stream_last_seen(rows, "user_id", "ts", target, checkpoint).awaitTermination()
    return sinks.read_latest(spark, target, ["user_id"], "ts")


@query("B23_T4_stream_append", """
  SELECT 'O' || user_id AS station_code, CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS pm2_5, event_type AS aqi,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS published_at, CAST(ts AS DATE) AS publish_date FROM events""")
def stream_append(spark, sf):
    messages = _event_stream(spark, sf).select(
        F.to_json(
            F.struct(
                F.concat(F.lit("O"), F.col("user_id")).alias("station_code"),
                F.struct(F.floor("value").alias("pm2_5"), F.col("event_type").alias("aqi")).alias("data"),
                F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("published_at"),
            )
        ).alias("value")
    )
    target, checkpoint = shared_dir(spark, "owned"), shared_dir(spark, "owned-checkpoint")
    rows = jobs.flatten_payload(messages, ["pm2_5", "aqi"]).drop("coord")
    jobs.append_stream(rows, ["publish_date"], target, checkpoint).awaitTermination()
    return spark.read.parquet(target)


@query("B23_T7_minute_presence", """
  SELECT DISTINCT user_id, date_trunc('minute', ts) AS ts FROM events WHERE user_id IN
    (SELECT s_suppkey FROM supplier WHERE s_nationkey = 17)""")
def minute_presence(spark, sf):
    events = adapters.table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    members = adapters.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("user_id"), F.col("s_nationkey").alias("control_area_id")
    )
    presence = jobs.minute_presence(events, "user_id", "ts")
    return jobs.presence_of_area(presence, members, 17, "user_id")


@query("B23_T7_stream_presence", "SELECT user_id, date_trunc('minute', ts) AS ts, CAST(ts AS DATE) AS publish_date FROM events GROUP BY ALL")
def stream_presence(spark, sf):
    """Events that come again ten days late find their state gone, and are dropped as late."""
    rows = _event_stream(spark, sf, again=True).select("user_id", "ts")
    minutes = jobs.minute_presence(rows, "user_id", "ts", late="2 days")
    target, checkpoint = shared_dir(spark, "minutes"), shared_dir(spark, "minutes-checkpoint")
    dated = minutes.withColumn("publish_date", F.to_date("ts"))
    jobs.append_stream(dated, ["publish_date"], target, checkpoint).awaitTermination()
    return spark.read.parquet(target).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
