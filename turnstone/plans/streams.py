"""Stream jobs, run to completion and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnstone.registry import query
from turnstone.streaming import boards


@query("t1_hourly_sales", """
  SELECT date_trunc('hour', ts) AS window_start, event_type, COUNT(*) AS sales, ROUND(SUM(value), 2) AS revenue FROM events GROUP BY 1, 2""")
def hourly_sales(t):
    sales = boards.read_sales(t.spark, t.path("events"), t.events, "ts", "2 hours")
    windows = boards.windowed_counts(
        sales, "ts", "1 hour", ["event_type"], [F.count("*").alias("sales"), F.sum("value").alias("revenue")])
    return boards.run_to_table(windows, ["event_type"], "hourly-sales").withColumn("revenue", F.round("revenue", 2))


@query("t2_daily_sales", """
  SELECT date_trunc('day', ts) AS window_start, COUNT(*) AS sales, ROUND(SUM(value), 2) AS revenue FROM events GROUP BY 1""")
def daily_sales(t):
    sales = boards.read_sales(t.spark, t.path("events"), t.events, "ts", "2 hours")
    windows = boards.windowed_counts(
        sales, "ts", "1 day", [], [F.count("*").alias("sales"), F.sum("value").alias("revenue")])
    return boards.run_to_table(windows, [], "daily-sales").withColumn("revenue", F.round("revenue", 2))


@query("t2_last_hour_sales", """
  SELECT date_trunc('minute', ts) - to_minutes((minute(ts) % 15)::INT) - to_minutes(15 * k::INT) AS window_start, COUNT(*) AS sales
  FROM events, generate_series(0, 3) g(k) GROUP BY 1""")
def last_hour_sales(t):
    sales = boards.read_sales(t.spark, t.path("events"), t.events, "ts", "2 hours")
    windows = boards.windowed_counts(sales, "ts", "1 hour", [], [F.count("*").alias("sales")], slide="15 minutes")
    return boards.run_to_table(windows, [], "last-hour-sales")


@query("t2_trailing_hour", """
  WITH d AS (SELECT event_type, date_trunc('minute', ts) AS minute, COUNT(*) AS n, SUM(value) AS v FROM events GROUP BY 1, 2),
  h AS (SELECT event_type, minute, SUM(n) OVER w AS sales, SUM(v) OVER w AS revenue FROM d
        WINDOW w AS (PARTITION BY event_type ORDER BY minute RANGE BETWEEN INTERVAL 59 MINUTE PRECEDING AND CURRENT ROW))
  SELECT event_type, minute, sales::BIGINT AS sales, ROUND(revenue, 2) AS revenue FROM h
  WHERE minute + INTERVAL 1 MINUTE <= (SELECT date_trunc('millisecond', MAX(ts)) - INTERVAL 2 HOUR FROM events)""")
def trailing_hour(t):
    """Exact totals of the hour up to each minute with a sale, as far as the watermark has come."""
    sales = boards.read_sales(t.spark, t.path("events"), t.events, "ts", "2 hours")
    minutes = boards.minute_sales(sales, "ts", "event_type", "value")
    log, _ = boards.run_to_log(minutes, "minute-sales", "event_type")
    hours = boards.trailing_hour(boards.follow_log(t.spark, log, minutes.schema), "event_type")
    found = boards.read_log(t.spark, boards.run_to_log(hours, "trailing-hour", "event_type")[0], hours.schema)
    return found.select("event_type", F.col("minute").cast("timestamp_ntz").alias("minute"), "sales", F.round("revenue", 2).alias("revenue"))
