"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnstone.functions import scalars as s
from turnstone.operators import aggregates as agg
from turnstone.operators import scan
from turnstone.operators.joins import first_row_per_key
from turnstone.registry import query
from turnstone.sources.views import GAMES, LINE_TICKETS, SCANS, SEASONS, TICKETS, games, line_tickets, scans, tickets


@query("a1_group_aggregates", """
  SELECT l_returnflag, l_linestatus, COUNT(*) AS n, ROUND(SUM(l_extendedprice), 2) AS total,
         ROUND(AVG(l_discount), 6) AS mean_discount, MIN(l_quantity) AS least, MAX(l_quantity) AS most
  FROM lineitem GROUP BY 1, 2""")
def group_aggregates(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"),
        F.round(F.avg("l_discount"), 6).alias("mean_discount"),
        F.min("l_quantity").alias("least"), F.max("l_quantity").alias("most"))


@query("a2_group_by_expression", """
  SELECT date_trunc('month', o_orderdate)::DATE AS month, COUNT(*) AS orders, ROUND(SUM(o_totalprice), 2) AS revenue
  FROM orders GROUP BY 1""")
def group_by_expression(t):
    month = F.to_date(F.date_trunc("month", "o_orderdate")).alias("month")
    return t.orders.groupBy(month).agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))


@query("a3_global", "SELECT COUNT(*) AS n, ROUND(SUM(l_extendedprice), 2) AS revenue, MAX(l_shipdate) AS latest FROM lineitem")
def global_aggregate(t):
    return t.lineitem.agg(
        F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("revenue"), F.max("l_shipdate").alias("latest"))


@query("a4_count_distinct", """
  SELECT l_returnflag, COUNT(DISTINCT l_orderkey) AS invoices, COUNT(DISTINCT l_partkey) AS items FROM lineitem GROUP BY 1""")
def count_distinct(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.countDistinct("l_orderkey").alias("invoices"), F.countDistinct("l_partkey").alias("items"))


@query("a5_count_distinct_key", """
  SELECT user_id, COUNT(DISTINCT event_type || ' ' || CAST(ts AS DATE)::VARCHAR) AS activities FROM events
  WHERE value > 5 GROUP BY 1""")
def count_distinct_key(t):
    # concat gives null as soon as one part is null, so such rows are not counted
    key = F.concat("event_type", F.lit(" "), F.to_date("ts").cast("string"))
    return t.events.where("value > 5").groupBy("user_id").agg(F.countDistinct(key).alias("activities"))


@query("a6_conditional", f"""
  WITH {LINE_TICKETS}
  SELECT seat_id, SUM(CASE WHEN ticket_type = 'Full' THEN 1 ELSE 0 END)::BIGINT AS times_full,
         SUM(CASE WHEN ticket_type = 'Premier' THEN 1 ELSE 0 END)::BIGINT AS times_premier,
         COUNT(CASE WHEN is_comp THEN 1 END) AS times_comp FROM line_tickets GROUP BY 1""")
def conditional(t):
    kind = F.col("ticket_type")
    return line_tickets(t).groupBy("seat_id").agg(
        F.count_if(kind == "Full").alias("times_full"), F.count_if(kind == "Premier").alias("times_premier"),
        F.count_if("is_comp").alias("times_comp"))


def season_columns(name: str, value: str) -> str:
    """One SQL column for each season of the tables, from an aggregate that has the season's condition in its braces."""
    return ", ".join(f"{value.format(f'season = {s!r}')}::DOUBLE AS {name}_{s.replace('-', '')}" for s in SEASONS)


@query("a7_wide_by_season", f"""
  WITH {TICKETS} SELECT buyer, {season_columns("seats", "SUM(CASE WHEN {} THEN paid_seats END)")}, {season_columns("member", "MAX(CASE WHEN {} THEN member END)")}
  FROM (SELECT *, CASE WHEN ticket_type IN ('Full', 'Premier') THEN 1 ELSE 0 END AS member FROM tickets) GROUP BY 1""")
def wide_by_season(t):
    member = F.col("ticket_type").isin("Full", "Premier").cast("double")
    rows = tickets(t).withColumns({"member": member, "paid_seats": F.col("paid_seats").cast("double")})
    return agg.wide_by(rows, ["buyer"], "season", list(SEASONS), {"seats": ("sum", "paid_seats"), "member": ("max", "member")})


@query("a8_having", "SELECT o_custkey, ROUND(SUM(o_totalprice), 2) AS spend FROM orders GROUP BY 1 HAVING SUM(o_totalprice) > 3000000")
def having(t):
    spend = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("spend"))
    return spend.where("spend > 3000000").withColumn("spend", F.round("spend", 2))


@query("a9_distinct", "SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def distinct(t):
    return t.orders.select("o_custkey", "o_orderpriority").distinct()


@query("a10_presence", "SELECT user_id, event_type FROM events WHERE value > 20 GROUP BY 1, 2")
def presence(t):
    return t.events.where("value > 20").select("user_id", "event_type").distinct()


@query("a11_bool_or", "SELECT o_custkey, BOOL_OR(o_orderstatus = 'F') AS any_filled FROM orders GROUP BY 1")
def bool_or(t):
    return t.orders.groupBy("o_custkey").agg(F.bool_or(F.col("o_orderstatus") == "F").alias("any_filled"))


@query("a12_listagg", """
  SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1""")
def listagg(t):
    # distinct first: a customer contributes at most one row per priority
    pairs = t.orders.select("o_custkey", "o_orderpriority").distinct()
    return pairs.groupBy("o_custkey").agg(
        F.array_join(F.sort_array(F.collect_set("o_orderpriority")), ", ").alias("priorities"))


@query("a13_highest_group", """
  SELECT o_custkey, CASE WHEN string_agg(o_orderpriority) LIKE '%URGENT%' THEN 'All-Star'
    WHEN string_agg(o_orderpriority) LIKE '%HIGH%' THEN 'Pro' ELSE 'Rookie' END AS group_final FROM orders GROUP BY 1""")
def highest_group(t):
    # the strongest group is a maximum of a rank, no list is built
    rank = s.first_match([(F.col("o_orderpriority").contains("URGENT"), 2), (F.col("o_orderpriority").contains("HIGH"), 1)], 0)
    best = t.orders.groupBy("o_custkey").agg(F.max(rank).alias("r"))
    return best.select("o_custkey", s.lookup("r", {2: "All-Star", 1: "Pro", 0: "Rookie"}).alias("group_final"))


@query("a14_tenure", f"""
  WITH RECURSIVE {TICKETS}, held AS (SELECT DISTINCT buyer, left(season, 4)::INT AS y FROM tickets WHERE ticket_type IN ('Full', 'Premier')
    AND left(season, 4)::INT <= 2000),
  r AS (SELECT buyer, 2000 AS y FROM held WHERE y = 2000 UNION ALL
        SELECT h.buyer, h.y FROM held h JOIN r ON h.buyer = r.buyer AND h.y = r.y - 1)
  SELECT h.buyer, COALESCE(n, 0)::INT AS tenure FROM (SELECT DISTINCT buyer FROM held) h
  LEFT JOIN (SELECT buyer, COUNT(*) AS n FROM r GROUP BY 1) c ON h.buyer = c.buyer""")
def tenure(t):
    plans = tickets(t).where(F.col("ticket_type").isin("Full", "Premier")).withColumn(
        "start", F.left("season", F.lit(4)).cast("int"))
    return agg.consecutive_tenure(plans, "buyer", "start", 2000)


@query("a15_ratio_of_sums", f"""
  WITH {LINE_TICKETS} SELECT season, ROUND(SUM(gross_revenue) / NULLIF(SUM(paid_seats), 0), 4) AS atp FROM line_tickets GROUP BY 1""")
def ratio_of_sums(t):
    return line_tickets(t).groupBy("season").agg(
        F.round(s.ratio(F.sum("gross_revenue"), F.sum("paid_seats")), 4).alias("atp"))


@query("a16_rate_as_double", f"""
  WITH {LINE_TICKETS}, {GAMES} SELECT tier, ROUND(SUM(CASE WHEN did_attend THEN paid_seats ELSE 0 END)::DOUBLE / SUM(paid_seats), 6) AS paid_rate
  FROM line_tickets JOIN games USING (event_date) GROUP BY 1""")
def rate_as_double(t):
    per_day = line_tickets(t).groupBy("event_date").agg(
        F.sum(F.when(F.col("did_attend"), F.col("paid_seats")).otherwise(0)).alias("a"), F.sum("paid_seats").alias("p"))
    return per_day.join(games(t).select("event_date", "tier"), "event_date").groupBy("tier").agg(
        F.round(s.ratio(F.sum("a"), F.sum("p")), 6).alias("paid_rate"))


@query("a17_weighted_mean", """
  SELECT l_returnflag, ROUND(SUM(NULLIF(l_discount, 0) * l_quantity) / SUM(l_quantity), 6) AS weighted_discount,
         ROUND(SUM(l_tax * l_quantity) / SUM(l_quantity), 6) AS weighted_tax FROM lineitem GROUP BY 1""")
def weighted_mean(t):
    rows = t.lineitem.select("l_returnflag", "l_quantity", "l_tax", F.nullif("l_discount", F.lit(0.0)).alias("rate"))
    out = agg.weighted_mean(rows, ["l_returnflag"], "l_quantity", {"weighted_discount": "rate", "weighted_tax": "l_tax"})
    return out.withColumns({c: F.round(c, 6) for c in ("weighted_discount", "weighted_tax")})


WEIGHTS = {"1997-98": 0.5, "1998-99": 1.0, "1999-00": 1.5}


@query("a18_season_weights", f"""
  WITH {LINE_TICKETS}, r AS (SELECT season, arena_level, SUM(CASE WHEN did_attend THEN 1 ELSE 0 END)::DOUBLE / COUNT(*) AS rate
    FROM line_tickets GROUP BY 1, 2),
  w AS (SELECT *, CASE season WHEN '1997-98' THEN 0.5 WHEN '1998-99' THEN 1.0 WHEN '1999-00' THEN 1.5 END AS weight FROM r)
  SELECT arena_level, ROUND(SUM(rate * weight) / SUM(weight), 6) AS show_rate FROM w GROUP BY 1""")
def season_weights(t):
    rates = line_tickets(t).groupBy("season", "arena_level").agg(
        s.ratio(F.count_if("did_attend"), F.count("*")).alias("rate"))
    out = agg.season_weighted_mean(rates, ["arena_level"], "season", WEIGHTS, {"show_rate": "rate"})
    return out.withColumn("show_rate", F.round("show_rate", 6))


@query("a19_two_level", f"""
  WITH {LINE_TICKETS}, {GAMES}, g AS (SELECT tier, games.season, event_date, SUM(gross_revenue) AS rev
    FROM line_tickets JOIN games USING (event_date) GROUP BY 1, 2, 3)
  SELECT tier, season, ROUND(AVG(rev), 2) AS mean_revenue FROM g GROUP BY 1, 2""")
def two_level(t):
    per_game = line_tickets(t).groupBy("event_date").agg(F.sum("gross_revenue").alias("rev"))
    return per_game.join(games(t), "event_date").groupBy("tier", "season").agg(
        F.round(F.avg("rev"), 2).alias("mean_revenue"))


@query("a20_sum_and_size", """
  SELECT o_orderpriority, o_orderstatus, ROUND(SUM(o_totalprice), 2) AS revenue, COUNT(*) AS size FROM orders GROUP BY 1, 2""")
def sum_and_size(t):
    return t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(
        F.round(F.sum("o_totalprice"), 2).alias("revenue"), F.count("*").alias("size"))


@query("a21_attendance_count", f"""
  WITH {SCANS} SELECT event_date, COUNT(*) AS attendance FROM scans WHERE attended GROUP BY 1""")
def attendance_count(t):
    return scans(t).where("attended").groupBy("event_date").agg(F.count("*").alias("attendance"))


@query("a22_quantiles", """
  WITH r AS (SELECT o_orderpriority, o_totalprice AS v,
               ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) - 1 AS i,
               COUNT(*) OVER (PARTITION BY o_orderpriority) - 1 AS m FROM orders)
  SELECT o_orderpriority,
         ROUND((MAX(CASE WHEN i = floor(0.25 * m) THEN v END) + MAX(CASE WHEN i = ceil(0.25 * m) THEN v END)) / 2, 4) AS q1,
         ROUND((MAX(CASE WHEN i = floor(0.5 * m) THEN v END) + MAX(CASE WHEN i = ceil(0.5 * m) THEN v END)) / 2, 4) AS q2,
         ROUND((MAX(CASE WHEN i = floor(0.75 * m) THEN v END) + MAX(CASE WHEN i = ceil(0.75 * m) THEN v END)) / 2, 4) AS q3
  FROM r GROUP BY 1""")
def quantiles(t):
    out = scan.exact_quantiles(
        t.orders, ["o_orderpriority"], "o_totalprice", {"q1": 0.25, "q2": 0.5, "q3": 0.75},
        scan.even_buckets(t.orders, F.col("o_totalprice")), "midpoint")
    return out.withColumns({c: F.round(c, 4) for c in ("q1", "q2", "q3")})


@query("a22_quantile_linear", "SELECT ROUND(quantile_cont(l_extendedprice, 0.95), 4) AS p95 FROM lineitem")
def quantile_linear(t):
    prices = t.lineitem.select("l_extendedprice")
    out = scan.exact_quantiles(prices, [], "l_extendedprice", {"p95": 0.95}, scan.even_buckets(prices, F.col("l_extendedprice")))
    return out.withColumn("p95", F.round("p95", 4))


@query("a23_row_at_group_minimum", """
  SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey
  ORDER BY o_totalprice, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def row_at_group_minimum(t):
    return first_row_per_key(
        t.orders, ["o_custkey"], [F.col("o_totalprice"), F.col("o_orderkey")], ["o_orderkey", "o_totalprice"])


@query("a24_across_columns", """
  SELECT l_orderkey, l_linenumber, ROUND(COALESCE(NULLIF(l_discount, 0), 0) + l_tax, 4) AS total,
         ROUND(CASE WHEN NULLIF(l_discount, 0) IS NULL THEN l_tax ELSE (l_discount + l_tax) / 2 END, 4) AS mean FROM lineitem""")
def across_columns(t):
    disc = F.nullif("l_discount", F.lit(0.0))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.round(s.row_sum([disc, "l_tax"]), 4).alias("total"),
        F.round(s.row_mean([disc, "l_tax"]), 4).alias("mean"))


@query("a25_pivot", """
  SELECT o_orderpriority, SUM(CASE WHEN o_orderstatus = 'F' THEN 1 END)::DOUBLE AS F,
         SUM(CASE WHEN o_orderstatus = 'O' THEN 1 END)::DOUBLE AS O, SUM(CASE WHEN o_orderstatus = 'P' THEN 1 END)::DOUBLE AS P
  FROM orders GROUP BY 1""")
def pivot(t):
    counted = t.orders.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1)).cast("double"))
    return counted


@query("a26_unpivot", """
  SELECT l_orderkey, l_linenumber, measure, amount FROM lineitem
  UNPIVOT (amount FOR measure IN (l_quantity, l_extendedprice, l_discount))""")
def unpivot(t):
    return t.lineitem.unpivot(
        ["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice", "l_discount"], "measure", "amount")


@query("a27_value_counts", "SELECT p_type, COUNT(*) AS n FROM part GROUP BY 1")
def value_counts(t):
    return t.part.groupBy("p_type").agg(F.count("*").alias("n"))


@query("a28_missing_report", """
  WITH b AS (SELECT NULLIF(l_discount, 0) AS disc, NULLIF(l_tax, 0) AS tax, l_quantity AS qty FROM lineitem)
  SELECT 'disc' AS column_name, COUNT(*) - COUNT(disc) AS missing, ROUND(100.0 * (COUNT(*) - COUNT(disc)) / COUNT(*), 4) AS missing_percent FROM b
  UNION ALL SELECT 'tax', COUNT(*) - COUNT(tax), ROUND(100.0 * (COUNT(*) - COUNT(tax)) / COUNT(*), 4) FROM b
  UNION ALL SELECT 'qty', COUNT(*) - COUNT(qty), ROUND(100.0 * (COUNT(*) - COUNT(qty)) / COUNT(*), 4) FROM b""")
def missing_report(t):
    rows = t.lineitem.select(
        F.nullif("l_discount", F.lit(0.0)).alias("disc"), F.nullif("l_tax", F.lit(0.0)).alias("tax"), F.col("l_quantity").alias("qty"))
    return agg.missing_report(rows, rows.columns).withColumn("missing_percent", F.round("missing_percent", 4))


@query("a29_correlation", """
  WITH c AS (SELECT corr(l_quantity, l_extendedprice) AS qp, corr(l_quantity, l_discount) AS qd, corr(l_extendedprice, l_discount) AS pd FROM lineitem)
  SELECT 'l_quantity' AS a, 'l_quantity' AS b, 1.0::DOUBLE AS r FROM c UNION ALL SELECT 'l_extendedprice', 'l_extendedprice', 1.0 FROM c
  UNION ALL SELECT 'l_discount', 'l_discount', 1.0 FROM c
  UNION ALL SELECT 'l_quantity', 'l_extendedprice', ROUND(qp, 6) FROM c UNION ALL SELECT 'l_extendedprice', 'l_quantity', ROUND(qp, 6) FROM c
  UNION ALL SELECT 'l_quantity', 'l_discount', ROUND(qd, 6) FROM c UNION ALL SELECT 'l_discount', 'l_quantity', ROUND(qd, 6) FROM c
  UNION ALL SELECT 'l_extendedprice', 'l_discount', ROUND(pd, 6) FROM c UNION ALL SELECT 'l_discount', 'l_extendedprice', ROUND(pd, 6) FROM c""")
def correlation(t):
    return agg.correlation_pairs(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"]).withColumn("r", F.round("r", 6))


@query("a30_total_rows", f"""
  WITH {LINE_TICKETS} SELECT season, ticket_type, SUM(paid_seats)::BIGINT AS paid FROM line_tickets GROUP BY 1, 2
  UNION ALL SELECT season, 'total', SUM(paid_seats)::BIGINT FROM line_tickets GROUP BY 1""")
def total_rows(t):
    return agg.with_total_rows(
        line_tickets(t), ["season"], "ticket_type", "total", [F.sum("paid_seats").alias("paid")])
