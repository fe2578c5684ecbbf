"""Windows, ordered analytics, top-k and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnstone.functions import scalars as s
from turnstone.operators import grid, joins, scan
from turnstone.operators import sampling
from turnstone.operators import windows as win
from turnstone.registry import query
from turnstone.sources.views import GAMES, LINE_TICKETS, SCANS, TICKETS, games, line_tickets, scans, tickets

DAYS_OUT = list(range(0, 366))


@query("booking_curve", """
  WITH s AS (SELECT o_orderpriority AS level, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') AS day_no, SUM(o_totalprice) AS v
             FROM orders GROUP BY 1, 2),
  g AS (SELECT level, d AS day_no FROM (SELECT DISTINCT o_orderpriority AS level FROM orders),
        (SELECT unnest(generate_series(0, 2404)) AS d)),
  c AS (SELECT g.level, g.day_no, COALESCE(v, 0) AS sold, COALESCE(SUM(v) OVER (PARTITION BY g.level ORDER BY g.day_no), 0) AS cumulative
        FROM g LEFT JOIN s ON g.level = s.level AND g.day_no = s.day_no),
  f AS (SELECT *, MAX(cumulative) OVER (PARTITION BY level) AS final FROM c)
  SELECT level, day_no::INT AS day_no, ROUND(sold, 2) AS sold, ROUND(cumulative, 2) AS cumulative, ROUND(final, 2) AS final,
         ROUND(cumulative / final, 6) AS share_of_final FROM f""")
def booking_curve(t):
    facts = t.orders.select(
        F.col("o_orderpriority").alias("level"),
        s.days_between(F.to_date("o_orderdate"), F.lit("2001-08-01")).alias("day_no"),
        F.col("o_totalprice").alias("value"),
    )
    steps = t.orders.agg(F.max(s.days_between(F.to_date("o_orderdate"), F.lit("2001-08-01"))).alias("m")).select(
        F.explode(F.sequence(F.lit(0), F.greatest("m", F.lit(2404)))).alias("day_no"))
    curve = grid.booking_curve(facts, ["level"], "day_no", "value", steps)
    return curve.select("level", "day_no", *[F.round(c, 2).alias(c) for c in ("sold", "cumulative", "final")],
                        F.round("share_of_final", 6).alias("share_of_final"))


@query("w1_keep_first", """
  SELECT o_custkey, o_orderpriority, n FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY n DESC,
    CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 4 END, o_orderpriority) AS rn
    FROM (SELECT o_custkey, o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1, 2)) WHERE rn = 1""")
def keep_first(t):
    counts = t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"))
    tie = s.lookup("o_orderpriority", {"5-LOW": 1, "3-MEDIUM": 2}, 4)
    return joins.first_row_per_key(
        counts, ["o_custkey"], [-F.col("n"), tie, F.col("o_orderpriority")], ["o_orderpriority", "n"])


@query("w2_value_on_first_row", """
  WITH p AS (SELECT o_custkey, year(o_orderdate)::INT AS y, o_orderpriority AS program, SUM(o_totalprice) AS v FROM orders GROUP BY 1, 2, 3),
  r AS (SELECT o_custkey, y, SUM(v) AS revenue FROM p GROUP BY 1, 2)
  SELECT p.o_custkey, p.y, program, ROUND(revenue, 2) AS revenue,
         CASE WHEN ROW_NUMBER() OVER (PARTITION BY p.o_custkey, p.y ORDER BY program) = 1 THEN ROUND(revenue, 2) ELSE 0 END AS revenue_dedup
  FROM p JOIN r ON p.o_custkey = r.o_custkey AND p.y = r.y""")
def value_on_first_row(t):
    p = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("program")).agg(
        F.sum("o_totalprice").alias("v"))
    revenue = p.groupBy("o_custkey", "y").agg(F.round(F.sum("v"), 2).alias("revenue"))
    rows = p.drop("v").join(revenue, ["o_custkey", "y"])
    return joins.value_on_first_row(rows, ["o_custkey", "y"], "program", "revenue", "revenue_dedup")


@query("w3_running_sum", f"""
  WITH {TICKETS}, d AS (SELECT season, arena_level, days_out, SUM(paid_seats) AS paid FROM tickets GROUP BY 1, 2, 3)
  SELECT season, arena_level, days_out, paid::BIGINT AS paid,
         SUM(paid) OVER (PARTITION BY season, arena_level ORDER BY days_out ROWS UNBOUNDED PRECEDING)::BIGINT AS cumulative FROM d""")
def running_sum(t):
    d = tickets(t).groupBy("season", "arena_level", "days_out").agg(F.sum("paid_seats").alias("paid"))
    return grid.running_total(d, ["season", "arena_level"], ["days_out"], "paid", "cumulative")


@query("w4_cumsum_raw_rows", """
  SELECT user_id, event_id, ROUND(SUM(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 2) AS spent_so_far
  FROM events""")
def cumsum_raw_rows(t):
    out = scan.prefix_scan(
        t.events.select("user_id", "event_id", "ts", "value"), ["user_id"], ["ts", "event_id"],
        scan.even_buckets(t.events, scan.seconds("ts")), sums={"spent_so_far": F.col("value")})
    return out.select("user_id", "event_id", F.round("spent_so_far", 2).alias("spent_so_far"))


@query("w5_forward_fill", f"""
  WITH {TICKETS}, d AS (SELECT season, arena_level, days_out, SUM(gross_revenue) AS sold FROM tickets GROUP BY 1, 2, 3),
  g AS (SELECT season, arena_level, x AS days_out FROM (SELECT DISTINCT season, arena_level FROM tickets), (SELECT unnest(generate_series(0, 365)) AS x))
  SELECT g.season, g.arena_level, g.days_out::INT AS days_out, ROUND(LAST_VALUE(sold IGNORE NULLS) OVER (PARTITION BY g.season, g.arena_level ORDER BY g.days_out
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS sold FROM g LEFT JOIN d USING (season, arena_level, days_out)""")
def forward_fill(t):
    d = tickets(t).groupBy("season", "arena_level", "days_out").agg(F.sum("gross_revenue").alias("sold"))
    g = grid.dense_grid(line_tickets(t).select("season", "arena_level").distinct(), {"days_out": DAYS_OUT})
    filled = grid.fill_forward(g.join(d, ["season", "arena_level", "days_out"], "left"), ["season", "arena_level"], ["days_out"], "sold")
    return filled.withColumn("sold", F.round("sold", 2))


@query("w6_ratio_to_report", f"""
  WITH {GAMES}, g AS (SELECT event_date, tier, date_diff('day', DATE '1994-12-31', event_date) AS days_out FROM games)
  SELECT event_date, tier, ROUND(days_out / SUM(days_out) OVER (PARTITION BY tier), 10) AS share FROM g""")
def ratio_to_report(t):
    g = games(t).select("event_date", "tier", s.days_between(F.lit("1994-12-31"), "event_date").alias("days_out"))
    return win.share_of_group(g, ["tier"], "days_out", "share").select("event_date", "tier", F.round("share", 10).alias("share"))


@query("w7_shift_raw_rows", """
  SELECT user_id, event_id, ROUND(LAG(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 2) AS previous_value FROM events""")
def shift_raw_rows(t):
    out = scan.previous_value(
        t.events.select("user_id", "event_id", "ts", "value"), ["user_id"], ["ts", "event_id"],
        scan.even_buckets(t.events, scan.seconds("ts")), "value", "previous_value")
    return out.select("user_id", "event_id", F.round("previous_value", 2).alias("previous_value"))


@query("w7_rest_days", f"""
  WITH {GAMES} SELECT season, event_date, date_diff('day', LAG(event_date) OVER w, event_date)::DOUBLE AS days_before,
  date_diff('day', event_date, LEAD(event_date) OVER w)::DOUBLE AS days_after FROM games WINDOW w AS (PARTITION BY season ORDER BY event_date)""")
def rest_days(t):
    out = win.day_density(games(t), ["season"], "event_date")
    return out.select("season", "event_date", F.col("days_before").cast("double"), F.col("days_after").cast("double"))


STREAK_SQL = f"""
  WITH {SCANS}, d AS (SELECT client, event_date, MAX(attended::INT) AS attended FROM scans GROUP BY 1, 2),
  b AS (SELECT *, SUM(CASE WHEN attended = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY client ORDER BY event_date) AS run FROM d)
  SELECT client, event_date, attended, SUM(attended) OVER (PARTITION BY client, run ORDER BY event_date)::BIGINT AS streak,
         event_date = (SELECT MAX(event_date) FROM d) AS is_most_recent FROM b"""


@query("w8_streak", STREAK_SQL)
def streak(t):
    return win.streaks(scans(t), "client", "event_date", "attended")


@query("w9_cumcount", """
  SELECT user_id, event_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS visit_no FROM events""")
def cumcount(t):
    bucket = scan.even_buckets(t.events, scan.seconds("ts"))
    out = scan.row_numbers(t.events.select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"], bucket, "visit_no")
    return out.select("user_id", "event_id", "visit_no")


@query("w10_expanding_mean", f"""
  WITH {LINE_TICKETS}, d AS (SELECT season, event_date, CASE WHEN COUNT(*) % 5 = 0 THEN NULL ELSE AVG(gross_revenue) END AS rating FROM line_tickets GROUP BY 1, 2)
  SELECT season, event_date, CASE WHEN rating IS NOT NULL THEN ROUND(AVG(rating) OVER (PARTITION BY season ORDER BY event_date ROWS UNBOUNDED PRECEDING) + 1e-7, 4) END AS running_rating FROM d""")
def expanding_mean(t):
    d = line_tickets(t).groupBy("season", "event_date").agg(
        F.when(F.count("*") % 5 != 0, F.avg("gross_revenue")).alias("rating"))
    out = win.expanding_mean(d, ["season"], ["event_date"], "rating", "running_rating")
    # nudged off exact halves, where two engines may round a last bit differently
    return out.select("season", "event_date", F.round(F.col("running_rating") + 1e-7, 4).alias("running_rating"))


@query("w11_trailing_mean", f"""
  WITH {LINE_TICKETS}, d AS (SELECT arena_level AS team, event_date, SUM(paid_seats) AS pts FROM line_tickets GROUP BY 1, 2)
  SELECT team, event_date, ROUND(AVG(pts) OVER (PARTITION BY team ORDER BY event_date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) AS last_3 FROM d""")
def trailing_mean(t):
    d = line_tickets(t).groupBy(F.col("arena_level").alias("team"), "event_date").agg(F.sum("paid_seats").alias("pts"))
    out = win.trailing_mean(d, ["team"], ["event_date"], "pts", 3, "last_3")
    return out.select("team", "event_date", F.round("last_3", 6).alias("last_3"))


@query("w12_rank_max", """
  SELECT o_orderkey, (COUNT(*) OVER (PARTITION BY o_orderpriority ORDER BY floor(o_totalprice / 1000)))::BIGINT AS rank_max FROM orders""")
def rank_max(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", F.floor(F.col("o_totalprice") / 1000).alias("v"))
    return scan.rank_by_value(rows, ["o_orderpriority"], "v", scan.even_buckets(rows, F.col("v")), "max", name="rank_max").select("o_orderkey", "rank_max")


@query("w12_rank_average", """
  WITH b AS (SELECT o_orderkey, o_orderpriority AS g, floor(o_totalprice / 1000) AS v FROM orders)
  SELECT o_orderkey, RANK() OVER (PARTITION BY g ORDER BY v DESC) + (COUNT(*) OVER (PARTITION BY g, v) - 1) / 2.0::DOUBLE AS rank_avg FROM b""")
def rank_average(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", F.floor(F.col("o_totalprice") / 1000).alias("v"))
    return scan.rank_by_value(rows, ["o_orderpriority"], "v", scan.even_buckets(rows, F.col("v")), "average", True, "rank_avg").select("o_orderkey", "rank_avg")


@query("w13_change_by_season", f"""
  WITH {LINE_TICKETS}, d AS (SELECT arena_level, season, SUM(gross_revenue) AS revenue FROM line_tickets GROUP BY 1, 2)
  SELECT arena_level, season, ROUND(revenue, 2) AS revenue,
  ROUND(COALESCE(revenue / LAG(revenue) OVER (PARTITION BY arena_level ORDER BY season) - 1, 0), 6) AS revenue_change FROM d""")
def change_by_season(t):
    d = line_tickets(t).groupBy("arena_level", "season").agg(F.sum("gross_revenue").alias("revenue"))
    out = win.change_from_previous(d, ["arena_level"], "season", ["revenue"])
    return out.withColumns({"revenue": F.round("revenue", 2), "revenue_change": F.round("revenue_change", 6)})


CURVE_SQL = f"""
  WITH {TICKETS}, d AS (SELECT season, ticket_type, days_out, SUM(paid_seats)::BIGINT AS paid FROM tickets GROUP BY 1, 2, 3),
  c AS (SELECT *, SUM(paid) OVER (PARTITION BY season, ticket_type ORDER BY days_out DESC ROWS UNBOUNDED PRECEDING)::BIGINT AS cumulative FROM d),
  f AS (SELECT *, arg_min(cumulative, days_out) OVER (PARTITION BY season, ticket_type) AS final FROM c)"""


@query("w14_final_in_group", CURVE_SQL + """ SELECT season, ticket_type, days_out::INT AS days_out, cumulative, final FROM f""")
def final_in_group(t):
    d = tickets(t).groupBy("season", "ticket_type", "days_out").agg(F.sum("paid_seats").alias("paid"))
    return win.percent_of_final(d, ["season", "ticket_type"], "days_out", "paid").select(
        "season", "ticket_type", "days_out", "cumulative", "final")


@query("w15_percent_of_final", CURVE_SQL + """
  SELECT season, ticket_type, days_out::INT AS days_out, ROUND(cumulative / NULLIF(final, 0), 6) AS share_in, (final - cumulative + paid)::BIGINT AS "left" FROM f""")
def percent_of_final(t):
    d = tickets(t).groupBy("season", "ticket_type", "days_out").agg(F.sum("paid_seats").alias("paid"))
    return win.percent_of_final(d, ["season", "ticket_type"], "days_out", "paid").select(
        "season", "ticket_type", "days_out", F.round("share_in", 6).alias("share_in"), "left")


@query("w16_latest_flag", """
  SELECT event_id, CAST(ts AS DATE) = (SELECT MAX(CAST(ts AS DATE)) FROM events) AS is_most_recent FROM events""")
def latest_flag(t):
    return win.flag_latest(t.events.select("event_id", F.to_date("ts").alias("d")), "d").drop("d")


@query("w17_density", """
  WITH d AS (SELECT DISTINCT l_suppkey % 20 AS team, CAST(l_shipdate AS DATE) AS day FROM lineitem)
  SELECT team, day, COUNT(*) OVER (PARTITION BY team ORDER BY day RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND INTERVAL 3 DAY FOLLOWING) AS density FROM d""")
def density(t):
    d = t.lineitem.select((F.col("l_suppkey") % 20).alias("team"), F.to_date("l_shipdate").alias("day"))
    return win.day_density(d, ["team"], "day").select("team", "day", "density")


@query("w17_density_in_year", """
  WITH d AS (SELECT DISTINCT l_suppkey % 20 AS team, year(l_shipdate) AS y, CAST(l_shipdate AS DATE) AS day, dayofyear(l_shipdate) AS p,
             dayofyear(make_date(year(l_shipdate), 12, 31)) AS len FROM lineitem)
  SELECT a.team, a.day, COUNT(*) AS density FROM d a JOIN d b ON a.team = b.team AND a.y = b.y
   AND LEAST(abs(a.p - b.p), a.len - abs(a.p - b.p)) <= 3 GROUP BY 1, 2""")
def density_in_year(t):
    d = t.lineitem.select((F.col("l_suppkey") % 20).alias("team"), F.to_date("l_shipdate").alias("day"))
    return win.within_year_density(d, ["team"], "day")


@query("w18_back_to_back", """
  WITH d AS (SELECT DISTINCT l_suppkey % 20 AS team, CAST(l_shipdate AS DATE) AS day FROM lineitem)
  SELECT team, day, CASE WHEN EXISTS (SELECT 1 FROM d b WHERE b.team = d.team AND b.day = d.day - 1) THEN 2
    WHEN EXISTS (SELECT 1 FROM d b WHERE b.team = d.team AND b.day = d.day + 1) THEN 1 ELSE 0 END AS back_to_back FROM d""")
def back_to_back(t):
    d = t.lineitem.select((F.col("l_suppkey") % 20).alias("team"), F.to_date("l_shipdate").alias("day"))
    return win.back_to_back(d, ["team"], "day")


@query("w19_rank_quota", """
  WITH q AS (SELECT o_orderpriority AS ev, COUNT(*) // 10 AS quota FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
  r AS (SELECT o_orderkey, o_orderpriority AS ev, o_orderstatus, RANK() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC)
        + (COUNT(*) OVER (PARTITION BY o_orderpriority, o_totalprice) - 1) / 2.0 AS rk FROM orders)
  SELECT o_orderkey, CASE WHEN rk <= quota THEN 'Plans' WHEN o_orderstatus = 'O' THEN 'Nightly' ELSE 'Not Sold' END AS label FROM r JOIN q USING (ev)""")
def rank_quota(t):
    seats = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("ev"), "o_orderstatus", "o_totalprice")
    quota = seats.where("o_orderstatus = 'F'").groupBy("ev").agg(F.floor(F.count("*") / 10).alias("quota"))
    ranked = scan.rank_by_value(seats, ["ev"], "o_totalprice", scan.even_buckets(seats, F.col("o_totalprice")), "average", True)
    return ranked.join(quota, "ev").select("o_orderkey", s.first_match(
        [(F.col("rank") <= F.col("quota"), "Plans"), (F.col("o_orderstatus") == "O", "Nightly")], "Not Sold").alias("label"))


# --- sort, limit, top-k, sampling ------------------------------------------------------
@query("o1_order_by", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment, c_acctbal DESC, c_custkey")
def order_by(t):
    return t.customer.select("c_custkey", "c_mktsegment", "c_acctbal").orderBy("c_mktsegment", F.col("c_acctbal").desc(), "c_custkey")


@query("o2_top_n_distinct", """
  SELECT DISTINCT CAST(l_shipdate AS DATE) AS event_date FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-06-15' ORDER BY 1 LIMIT 5""")
def top_n_distinct(t):
    after = t.lineitem.where(F.col("l_shipdate") >= F.lit("1999-06-15").cast("timestamp_ntz"))
    return after.select(F.to_date("l_shipdate").alias("event_date")).distinct().orderBy("event_date").limit(5)


@query("o3_fill_to_k", """
  WITH bad AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '5-LOW' AND o_totalprice < 20000),
  rest AS (SELECT o_orderkey, o_totalprice, ROW_NUMBER() OVER (ORDER BY o_totalprice, o_orderkey) AS rn FROM orders
           WHERE NOT (o_orderpriority = '5-LOW' AND o_totalprice < 20000))
  SELECT * FROM bad UNION ALL SELECT o_orderkey, o_totalprice FROM rest WHERE rn <= 500 - (SELECT COUNT(*) FROM bad)""")
def fill_to_k(t):
    must = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_totalprice") < 20000)
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    return sampling.fill_to(rows, must, ["o_totalprice", "o_orderkey"], 500).select("o_orderkey", "o_totalprice")


@query("o4_closest_relabelled", """
  WITH b AS (SELECT o_orderkey, o_orderstatus, abs(o_totalprice - 250000) AS diff FROM orders),
  near AS (SELECT o_orderkey FROM b WHERE o_orderstatus = 'F' ORDER BY diff, o_orderkey LIMIT 9)
  SELECT b.o_orderkey, CASE WHEN n.o_orderkey IS NOT NULL THEN 'X' ELSE o_orderstatus END AS label FROM b LEFT JOIN near n ON b.o_orderkey = n.o_orderkey""")
def closest_relabelled(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.abs(F.col("o_totalprice") - 250000).alias("diff"))
    out = sampling.relabel_closest(rows, F.col("o_orderstatus") == "F", ["diff", "o_orderkey"], 9, ["o_orderkey"])
    return out.select("o_orderkey", F.when(F.col("chosen"), "X").otherwise(F.col("o_orderstatus")).alias("label"))


#: A keyed draw in SQL: the first eight hex digits of an MD5.
DRAW = "('0x' || md5(concat_ws(',', 1993, o_orderkey))[1:8])::BIGINT / 4294967296.0::DOUBLE"


@query("o5_seeded_sample", f"SELECT * FROM orders ORDER BY {DRAW}, o_orderkey LIMIT 100")
def seeded_sample(t):
    return sampling.shuffled_head(t.orders, ["o_orderkey"], 1993, 100)


@query("o6_random_split", f"""
  SELECT CASE WHEN {DRAW} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS part, COUNT(*) AS rows, ROUND(AVG(o_totalprice), 2) AS mean_price FROM orders GROUP BY 1""")
def random_split(t):
    parts = sampling.keyed_split(t.orders, ["o_orderkey"], 0.8, 1993)
    return parts.groupBy("part").agg(F.count("*").alias("rows"), F.round(F.avg("o_totalprice"), 2).alias("mean_price"))


@query("o6_ordered_split", """
  SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) <= floor(0.67::DOUBLE * COUNT(*) OVER () + 1e-9) AS is_train FROM orders""")
def ordered_split(t):
    rows = t.orders.select("o_orderkey")
    return sampling.ordered_split(rows, "o_orderkey", 0.67, scan.even_buckets(rows, F.col("o_orderkey")))
