"""Scans, files, tables and publishing."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnstone.operators.grid import day_axis, dense_grid
from turnstone.registry import query
from turnstone.session import run_folder
from turnstone.sources import tables as io
from turnstone.sources.versions import VersionedTable
from turnstone.sources.views import LINE_TICKETS, line_tickets


@query("s1_table_scan", "SELECT * FROM supplier")
def table_scan(t):
    return t.supplier


@query("s2_query", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'")
def sql_text(t):
    return io.run_sql(
        t.spark,
        "SELECT n_name, r_name FROM {nation} JOIN {region} ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'",
        {"nation": t.nation, "region": t.region},
    )


@query("s3_parameterised", """
  SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 1000""")
def bound_parameters(t):
    return io.run_sql(
        t.spark,
        "SELECT c_custkey, c_name, c_acctbal FROM {c} WHERE c_mktsegment = :segment AND c_acctbal > :floor",
        {"c": t.customer}, segment="BUILDING", floor=1000,
    )


@query("s4_preview", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_preview(t):
    return io.preview(t.orders, 25, [F.col("o_totalprice").desc(), "o_orderkey"])


@query("s5_csv_read", "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def csv_read(t):
    path = io.write_csv(
        t.part.select("p_partkey", "p_name", "p_brand", "p_retailprice"), run_folder(t.spark, "csv-in"))
    return io.read_csv(t.spark, path, "p_partkey BIGINT, p_name STRING, p_brand STRING, p_retailprice DOUBLE")


@query("s6_csv_write", """
  SELECT o_orderpriority, COUNT(*) AS orders, ROUND(SUM(o_totalprice), 2) AS revenue FROM orders GROUP BY 1""")
def csv_write(t):
    report = t.orders.groupBy("o_orderpriority").agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))
    path = io.write_csv(report, run_folder(t.spark, "csv-out"))
    return io.read_csv(t.spark, path, "o_orderpriority STRING, orders BIGINT, revenue DOUBLE")


@query("s7_overwrite_table", """
  SELECT year(l_shipdate)::INT AS ship_year, COUNT(*) AS lines FROM lineitem GROUP BY 1""")
def overwrite_table(t):
    yearly = t.lineitem.groupBy(F.year("l_shipdate").alias("ship_year")).agg(F.count("*").alias("lines"))
    return t.spark.read.parquet(io.write_table(yearly, run_folder(t.spark, "table"), ["ship_year"]))


@query("s8_ctas", """
  SELECT c_mktsegment, COUNT(*) AS orders, ROUND(SUM(o_totalprice), 2) AS revenue
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def create_table_as_select(t):
    return io.create_table_as(
        t.spark,
        """SELECT c_mktsegment, count(*) AS orders, round(sum(o_totalprice), 2) AS revenue
           FROM {o} JOIN {c} ON o_custkey = c_custkey GROUP BY c_mktsegment""",
        run_folder(t.spark, "ctas"),
        {"o": t.orders, "c": t.customer},
    )


@query("s9_staging_publish", f"""
  WITH {LINE_TICKETS}, staged AS (
    SELECT season, arena_level, SUM(paid_seats)::BIGINT AS paid_seats, SUM(gross_revenue) AS revenue
    FROM line_tickets GROUP BY 1, 2)
  SELECT season, arena_level, paid_seats, ROUND(revenue / NULLIF(paid_seats, 0), 4) AS atp FROM staged""")
def staging_publish(t):
    staged = line_tickets(t).groupBy("season", "arena_level").agg(
        F.sum("paid_seats").alias("paid_seats"), F.sum("gross_revenue").alias("revenue"))
    table = VersionedTable(t.spark, run_folder(t.spark, "atp"))
    table.publish(staged, lambda s: s.select(
        "season", "arena_level", "paid_seats",
        F.round(F.col("revenue") / F.nullif("paid_seats", F.lit(0)), 4).alias("atp")))
    return table.read()


@query("s10_keyed_upsert", """
  SELECT c_custkey, c_acctbal, 'old' AS origin FROM customer
  WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01')
  UNION ALL
  SELECT o_custkey, ROUND(SUM(o_totalprice), 2), 'new' FROM orders
  WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY o_custkey""")
def keyed_upsert(t):
    current = t.customer.select("c_custkey", "c_acctbal", F.lit("old").alias("origin"))
    staged = (
        t.orders.where(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("c_acctbal"))
        .withColumn("origin", F.lit("new"))
    )
    return io.upsert(current, staged, ["c_custkey"])


@query("s11_literal_column", """
  SELECT r_regionkey, r_name, CASE r_name WHEN 'AFRICA' THEN 11.5 WHEN 'ASIA' THEN 12.5 END::DOUBLE AS goal FROM region""")
def literal_column(t):
    return io.with_literal_rows(t.region, "r_name", "goal", {"AFRICA": 11.5, "ASIA": 12.5})


@query("s12_product_generator", """
  SELECT CAST(d AS DATE) AS sale_date, o_orderpriority AS level, kind
  FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)
  CROSS JOIN (SELECT DISTINCT o_orderpriority FROM orders) CROSS JOIN (VALUES ('Full'), ('Premier')) v(kind)""")
def product_generator(t):
    days = day_axis(t.orders.select(F.to_date("o_orderdate").alias("d")), "d", "sale_date")
    return dense_grid(days, {"level": t.orders.select("o_orderpriority"), "kind": ["Full", "Premier"]})


@query("s13_csv_export", f"""
  WITH {LINE_TICKETS}
  SELECT season, ticket_type, COUNT(*) AS tickets, SUM(paid_seats)::BIGINT AS paid_seats
  FROM line_tickets GROUP BY 1, 2""")
def csv_export(t):
    report = line_tickets(t).groupBy("season", "ticket_type").agg(
        F.count("*").alias("tickets"), F.sum("paid_seats").alias("paid_seats"))
    path = io.write_csv(report, run_folder(t.spark, "export"))
    return io.read_csv(t.spark, path, "season STRING, ticket_type STRING, tickets BIGINT, paid_seats BIGINT")
