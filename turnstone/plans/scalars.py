"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnstone.functions import fixed_values as fixed
from turnstone.functions import scalars as s
from turnstone.operators.encoding import label_codes, one_hot
from turnstone.operators.sampling import keyed_random
from turnstone.registry import query
from turnstone.sources.views import GAMES, LINE_TICKETS, TICKETS, games, line_tickets, tickets


@query("f1_strings", """
  SELECT c_custkey, lower(c_mktsegment) AS low, reverse(c_name) AS rev, c_name || '/' || NULLIF(c_mktsegment, 'BUILDING') AS glued,
         concat_ws('/', c_name, NULLIF(c_mktsegment, 'BUILDING')) AS skipped FROM customer""")
def strings(t):
    part = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return t.customer.select(
        "c_custkey", F.lower("c_mktsegment").alias("low"), F.reverse("c_name").alias("rev"),
        F.concat("c_name", F.lit("/"), part).alias("glued"), F.concat_ws("/", "c_name", part).alias("skipped"))


@query("f2_left_right", """
  SELECT o_orderkey, left(o_orderpriority, 1) AS code, right(o_orderpriority, 3) AS tail, right(left(o_orderpriority, 4), 2) AS inner_code FROM orders""")
def left_right(t):
    p = F.col("o_orderpriority")
    return t.orders.select(
        "o_orderkey", F.left(p, F.lit(1)).alias("code"), F.right(p, F.lit(3)).alias("tail"),
        F.right(F.left(p, F.lit(4)), F.lit(2)).alias("inner_code"))


@query("f3_slices", """
  SELECT p_partkey, substr(p_name, 1, 1) AS one, substr(p_name, 2, 2) AS two_three, p_brand || '-' || p_size::VARCHAR || '-' || p_type AS part_id FROM part""")
def slices(t):
    return t.part.select(
        "p_partkey", F.substring("p_name", 1, 1).alias("one"), F.substring("p_name", 2, 2).alias("two_three"),
        s.seat_key("p_brand", "p_size", "p_type").alias("part_id"))


@query("f4_split_part", """
  SELECT event_id, split_part(split_part(props, ':', 2), '}', 1) AS k, string_split(event_type, 'u')[1] AS head FROM events""")
def split_part(t):
    return t.events.select(
        "event_id", F.split_part(F.split_part("props", F.lit(":"), F.lit(2)), F.lit("}"), F.lit(1)).alias("k"),
        F.split("event_type", "u").getItem(0).alias("head"))


@query("f5_replace_lpad", """
  SELECT n_nationkey, replace(replace(n_name, 'NATION', 'N'), '_', '') AS short, lpad(n_nationkey::VARCHAR, 2, '0') AS code FROM nation""")
def replace_lpad(t):
    short = F.replace(F.replace("n_name", F.lit("NATION"), F.lit("N")), F.lit("_"), F.lit(""))
    return t.nation.select("n_nationkey", short.alias("short"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("code"))


@query("f6_date_trunc", "SELECT event_id, CAST(ts AS DATE) AS day, date_trunc('hour', ts) AS hour FROM events")
def date_trunc(t):
    return t.events.select(
        "event_id", F.to_date("ts").alias("day"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))


@query("f7_datediff", f"WITH {TICKETS} SELECT l_orderkey, l_linenumber, days_out FROM tickets")
def datediff(t):
    return tickets(t).select("l_orderkey", "l_linenumber", "days_out")


@query("f8_date_add", """
  SELECT event_id, ts + INTERVAL 5 HOUR AS later, ts - INTERVAL 1 DAY AS before, ts + to_hours((event_id % 24)::INT) AS shifted FROM events""")
def date_add(t):
    hours = F.make_dt_interval(hours=(F.col("event_id") % 24).cast("int"))
    return t.events.select(
        "event_id", (F.col("ts") + F.expr("INTERVAL 5 HOUR")).alias("later"),
        (F.col("ts") - F.expr("INTERVAL 1 DAY")).alias("before"), (F.col("ts") + hours).alias("shifted"))


@query("f9_date_part", """
  SELECT event_id, year(ts)::INT AS y, month(ts)::INT AS m, hour(ts)::INT AS h, dayofweek(ts)::INT AS dw,
         CASE WHEN dayofweek(ts) IN (5, 6, 7) THEN 1 ELSE 0 END AS weekend FROM events""")
def date_part(t):
    dw = s.dow0("ts")
    return t.events.select(
        "event_id", F.year("ts").alias("y"), F.month("ts").alias("m"), F.hour("ts").alias("h"), dw.alias("dw"),
        dw.isin(5, 6, 7).cast("int").alias("weekend"))


@query("f10_weekday_groups", """
  SELECT o_orderkey, CASE dayofweek(o_orderdate) WHEN 6 THEN 1 WHEN 5 THEN 2 WHEN 0 THEN 2 ELSE 3 END AS week_day,
         strftime(o_orderdate, '%a') AS day_name FROM orders""")
def weekday_groups(t):
    day = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", s.lookup(s.dow0(day), {6: 1, 5: 2, 0: 2}, 3).alias("week_day"), F.date_format(day, "EEE").alias("day_name"))


@query("f11_time_zone", """
  SELECT event_id, (ts - INTERVAL 5 HOUR) AS local_time, CAST(ts - INTERVAL 5 HOUR AS DATE) = DATE '2024-01-15' AS is_today FROM events""")
def time_zone(t):
    # all January, so New York is five hours behind; "now" is an argument
    local = F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), F.col("ts"))
    return t.events.select(
        "event_id", local.alias("local_time"), (F.to_date(local) == F.lit("2024-01-15").cast("date")).alias("is_today"))


@query("f12_null_functions", """
  SELECT l_orderkey, l_linenumber, COALESCE(NULLIF(l_discount, 0), -1) AS disc, GREATEST(NULLIF(l_tax, 0), 0.03) AS tax FROM lineitem""")
def null_functions(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.coalesce(F.nullif("l_discount", F.lit(0.0)), F.lit(-1.0)).alias("disc"),
        F.greatest(F.nullif("l_tax", F.lit(0.0)), F.lit(0.03)).alias("tax"))


@query("f13_casts", """
  SELECT o_orderkey, trunc(o_totalprice)::INT AS whole, o_orderkey::VARCHAR AS text, CAST(o_orderdate AS DATE)::VARCHAR AS day_text, o_orderkey::DOUBLE AS real FROM orders""")
def casts(t):
    return t.orders.select(
        "o_orderkey", F.col("o_totalprice").cast("int").alias("whole"), F.col("o_orderkey").cast("string").alias("text"),
        F.to_date("o_orderdate").cast("string").alias("day_text"), F.col("o_orderkey").cast("double").alias("real"))


@query("f14_logs", """
  SELECT l_orderkey, l_linenumber, ROUND(CASE WHEN l_discount > 0 THEN ln(l_discount) ELSE 0 END, 8) AS log_disc, ROUND(exp(l_tax), 8) AS exp_tax,
         ROUND(ln(1 + l_quantity), 8) AS log1p_qty, ROUND(exp(l_tax) - 1, 8) AS expm1_tax FROM lineitem""")
def logs(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.round(s.log_or_zero("l_discount"), 8).alias("log_disc"), F.round(F.exp("l_tax"), 8).alias("exp_tax"),
        F.round(s.finite_or_zero(F.log1p("l_quantity")), 8).alias("log1p_qty"), F.round(F.expm1("l_tax"), 8).alias("expm1_tax"))


@query("f15_round_abs", """
  SELECT c_custkey, ROUND(c_acctbal / 7, 2) AS rounded, abs(c_acctbal) AS size, round_even(c_custkey / 2.0::DOUBLE, 0) AS half_even FROM customer""")
def round_abs(t):
    return t.customer.select(
        "c_custkey", F.round(F.col("c_acctbal") / 7, 2).alias("rounded"), F.abs("c_acctbal").alias("size"),
        F.bround(F.col("c_custkey") / 2, 0).alias("half_even"))


@query("f16_bins", """
  SELECT c_custkey, CASE WHEN c_custkey <= 0 THEN 0 WHEN c_custkey <= 3 THEN 1 WHEN c_custkey <= 7 THEN 2 WHEN c_custkey <= 15 THEN 3 ELSE 4 END AS touch_group,
         CASE WHEN c_custkey >= 0 AND c_custkey < 1 THEN 'Tier 4' WHEN c_custkey >= 1 AND c_custkey < 6 THEN 'Tier 3'
              WHEN c_custkey >= 6 AND c_custkey < 11 THEN 'Tier 2' WHEN c_custkey >= 11 THEN 'Tier 1' END AS attendance_group,
         CASE WHEN x > 0 AND x <= 0.5 THEN 'Tier 4' WHEN x > 0.5 AND x <= 0.75 THEN 'Tier 3' WHEN x > 0.75 AND x <= 0.9 THEN 'Tier 2'
              WHEN x > 0.9 AND x <= 1 THEN 'Tier 1' END AS score_group
  FROM (SELECT *, c_custkey / 1000.0::DOUBLE AS x FROM customer)""")
def bins(t):
    k = F.col("c_custkey")
    edges, labels = fixed.SCORE_EDGES
    aedges, alabels = fixed.ATTENDANCE_EDGES
    return t.customer.select(
        "c_custkey", s.cut(k, [None, *fixed.TOUCHPOINT_EDGES, None], [0, 1, 2, 3, 4]).alias("touch_group"),
        s.cut(k, aedges, alabels, right=False).alias("attendance_group"),
        s.cut(k / F.lit(1000.0), edges, labels).alias("score_group"))


@query("f17_days_out_bucket", f"""
  WITH {TICKETS} SELECT CASE WHEN days_out <= 0 THEN 'A: Day Of' WHEN days_out <= 3 THEN 'B: 1-3 Days Out' WHEN days_out <= 7 THEN 'C: 4-7 Days Out'
    WHEN days_out <= 14 THEN 'D: 1-2 Weeks Out' WHEN days_out <= 30 THEN 'E: 2-4 Weeks Out' WHEN days_out <= 60 THEN 'F: 1-2 Months Out'
    WHEN days_out <= 90 THEN 'G: 2-3 Months Out' ELSE 'H: 3+ Months Out' END AS bucket, COUNT(*) AS n FROM tickets GROUP BY 1""")
def days_out_bucket(t):
    return tickets(t).groupBy(s.days_out_bucket("days_out").alias("bucket")).agg(F.count("*").alias("n"))


@query("f18_date_range_text", f"""
  WITH {LINE_TICKETS} SELECT sales_rep, CASE WHEN MIN(event_date) = MAX(event_date) THEN strftime(MIN(event_date), '%m/%d/%y')
  ELSE strftime(MIN(event_date), '%m/%d/%y') || ' - ' || strftime(MAX(event_date), '%m/%d/%y') END AS event_range FROM line_tickets GROUP BY 1""")
def date_range_text(t):
    ends = line_tickets(t).groupBy("sales_rep").agg(F.min("event_date").alias("a"), F.max("event_date").alias("b"))
    return ends.select("sales_rep", s.date_range_text("a", "b").alias("event_range"))


@query("f19_display_text", """
  SELECT c_custkey, '$' || format('{:t,}', round_even(abs(c_acctbal), 0)::BIGINT) AS money FROM customer""")
def display_text(t):
    return t.customer.select("c_custkey", F.concat(F.lit("$"), F.format_number(F.abs("c_acctbal"), 0)).alias("money"))


@query("f20_one_hot", f"""
  WITH {GAMES} SELECT event_date, (tier = 'A')::INT AS "A", (tier = 'B')::INT AS "B", (tier = 'C')::INT AS "C", (tier = 'D')::INT AS "D", (tier = 'E')::INT AS "E" FROM games""")
def one_hot_tiers(t):
    return one_hot(games(t).select("event_date", "tier"), "tier", list("ABCDE"))


@query("f21_label_codes", """
  SELECT p_partkey, code FROM part JOIN (SELECT p_brand, (ROW_NUMBER() OVER (ORDER BY p_brand) - 1)::INT AS code FROM (SELECT DISTINCT p_brand FROM part)) USING (p_brand)""")
def label_code(t):
    return label_codes(t.part.select("p_partkey", "p_brand"), "p_brand", "code").select("p_partkey", "code")


@query("f22_noise", """
  SELECT l_orderkey, l_linenumber, ROUND(p, 9) AS p, ROUND(CASE WHEN p >= 0.12::DOUBLE THEN p - (0.09::DOUBLE + u * 0.02::DOUBLE) ELSE p END, 9) AS noised
  FROM (SELECT l_orderkey, l_linenumber, l_discount * 10 AS p, ('0x' || md5(concat_ws(',', 1993, l_orderkey, l_linenumber, l_partkey))[1:8])::BIGINT / 4294967296.0::DOUBLE AS u FROM lineitem)""")
def noise(t):
    p = F.col("l_discount") * 10
    u = F.lit(0.09) + keyed_random(["l_orderkey", "l_linenumber", "l_partkey"], 1993) * 0.02
    noised = F.when(p >= 0.12, p - u).otherwise(p)
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(p, 9).alias("p"), F.round(noised, 9).alias("noised"))


@query("f23_sequence_explode", """
  SELECT seat, n, COUNT(*) AS lines FROM (SELECT l_quantity::INT AS n,
    unnest(generate_series(l_linenumber * 10, l_linenumber * 10 + l_quantity::INT - 1))::INT AS seat FROM lineitem) GROUP BY 1, 2""")
def sequence_explode(t):
    n = F.col("l_quantity").cast("int")
    first = F.col("l_linenumber") * 10
    seats = F.sequence(first, first + n - 1)
    return t.lineitem.select(F.size(seats).alias("n"), F.explode(seats).alias("seat")).groupBy("seat", "n").agg(
        F.count("*").alias("lines"))
