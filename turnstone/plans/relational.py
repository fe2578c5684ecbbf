"""Projection, predicates, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnstone.functions import fixed_values as fixed
from turnstone.functions import scalars as s
from turnstone.operators import aggregates as agg
from turnstone.operators import joins
from turnstone.operators.grid import dense_grid
from turnstone.registry import query
from turnstone.sources.tables import run_sql
from turnstone.sources.views import GAMES, LINE_TICKETS, TICKETS, games, line_tickets, tickets


def at(text):
    """A zone-less timestamp literal, comparable with the parquet column as stored."""
    return F.lit(text).cast("timestamp_ntz")


# --- projection and predicates --------------------------------------------------
@query("p1_select_rename", "SELECT o_orderkey AS order_id, o_totalprice AS gross_revenue FROM orders")
def select_rename(t):
    return t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("gross_revenue"))


@query("p2_lateral_alias", """
  SELECT s_suppkey, vertical, CASE vertical WHEN 'Sales' THEN 50 WHEN 'Service' THEN 70 ELSE 0 END AS goal
  FROM (SELECT s_suppkey, CASE WHEN s_acctbal > 5000 THEN 'Sales' WHEN s_acctbal > 0 THEN 'Service' ELSE '' END
        AS vertical FROM supplier)""")
def lateral_alias(t):
    return run_sql(
        t.spark,
        """SELECT s_suppkey,
                  CASE WHEN s_acctbal > 5000 THEN 'Sales' WHEN s_acctbal > 0 THEN 'Service' ELSE '' END AS vertical,
                  CASE vertical WHEN 'Sales' THEN 50 WHEN 'Service' THEN 70 ELSE 0 END AS goal
           FROM {s}""",
        {"s": t.supplier},
    )


@query("p3_alias_in_where", """
  SELECT * FROM (SELECT o_orderkey, date_diff('day', o_orderdate, DATE '2001-08-01')::INT AS days_out FROM orders)
  WHERE days_out BETWEEN 0 AND 50""")
def alias_in_where(t):
    days = t.orders.select("o_orderkey", s.days_between(F.to_date("o_orderdate"), F.lit("2001-08-01")).alias("days_out"))
    return days.where(F.col("days_out").between(0, 50))


@query("p4_in_list", """
  SELECT p_partkey, p_type FROM part WHERE p_type IN ('PROMO', 'SMALL') AND p_brand NOT IN ('Brand#1', 'Brand#2')""")
def in_list(t):
    return t.part.where(
        F.col("p_type").isin("PROMO", "SMALL") & ~F.col("p_brand").isin("Brand#1", "Brand#2")
    ).select("p_partkey", "p_type")


@query("p5_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%' AND p_name NOT LIKE 'red%'")
def like(t):
    return t.part.where(F.col("p_name").like("%ring%") & ~F.col("p_name").like("red%")).select("p_partkey", "p_name")


@query("p6_ilike", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RING%' AND p_name NOT ILIKE 'Red%'")
def ilike(t):
    return t.part.where(F.col("p_name").ilike("%RING%") & ~F.col("p_name").ilike("Red%")).select("p_partkey", "p_name")


@query("p7_between", """
  SELECT o_orderkey FROM orders WHERE date_diff('day', o_orderdate, TIMESTAMP '1999-01-01') BETWEEN 0 AND 90""")
def between_computed(t):
    # stated on the stored column, so the range reaches the scan
    return t.orders.where(F.col("o_orderdate").between(at("1998-10-03"), at("1999-01-01"))).select("o_orderkey")


@query("p8_null_guards", """
  SELECT c_custkey, code FROM (SELECT c_custkey, NULLIF(c_mktsegment, 'BUILDING') AS code FROM customer)
  WHERE code IS NOT NULL AND code <> ''""")
def null_guards(t):
    code = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return t.customer.select("c_custkey", code.alias("code")).where(F.col("code").isNotNull() & (F.col("code") != ""))


@query("p9_and_or_precedence", """
  SELECT o_orderkey FROM orders
  WHERE o_orderstatus = 'F' AND o_orderpriority LIKE '1%' OR o_orderpriority LIKE '5%'""")
def and_or_precedence(t):
    prio = F.col("o_orderpriority")
    return t.orders.where(((F.col("o_orderstatus") == "F") & prio.like("1%")) | prio.like("5%")).select("o_orderkey")


@query("p10_contains", "SELECT p_partkey FROM part WHERE contains(p_name, 'widget') OR instr(p_type, 'MED') >= 1")
def contains(t):
    return t.part.where(F.col("p_name").contains("widget") | (F.instr("p_type", "MED") >= 1)).select("p_partkey")


@query("p11_searched_case", """
  SELECT CASE WHEN l_quantity > 40 THEN 'bulk' WHEN l_discount > 0.05 THEN 'deal' ELSE 'plain' END AS kind,
         COUNT(*) AS lines FROM lineitem GROUP BY 1""")
def searched_case(t):
    kind = s.first_match([(F.col("l_quantity") > 40, "bulk"), (F.col("l_discount") > 0.05, "deal")], "plain")
    return t.lineitem.groupBy(kind.alias("kind")).agg(F.count("*").alias("lines"))


SURVEY_WORDS = {
    "1-URGENT": "Definitely", "2-HIGH": "Most likely", "3-MEDIUM": "Neutral", "4-NOT SPECIFIED": "Unlikely",
    "5-LOW": "Definitely not",
}


@query("p12_simple_case_codes", """
  SELECT o_custkey, MAX(CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 1
                        WHEN '4-NOT SPECIFIED' THEN -1 WHEN '5-LOW' THEN -2 ELSE 0 END) AS likelihood
  FROM orders GROUP BY 1""")
def survey_codes(t):
    answer = s.lookup("o_orderpriority", SURVEY_WORDS)
    return t.orders.groupBy("o_custkey").agg(
        F.max(s.lookup(answer, fixed.SURVEY_LIKELIHOOD, 0)).alias("likelihood"))


@query("p13_range_case", """
  SELECT c_custkey, CASE WHEN c_acctbal BETWEEN 0 AND 2999 THEN 1 WHEN c_acctbal BETWEEN 3000 AND 5999 THEN 2
         WHEN c_acctbal BETWEEN 6000 AND 9999 THEN 3 ELSE 0 END AS income_ranking,
         CASE WHEN c_nationkey = 1 THEN 1 WHEN c_nationkey >= 5 THEN 2 WHEN c_nationkey >= 10 THEN 3
              WHEN c_nationkey IS NOT NULL THEN 4 ELSE 0 END AS tenure_group FROM customer""")
def range_case(t):
    bal, n = F.col("c_acctbal"), F.col("c_nationkey")
    return t.customer.select(
        "c_custkey",
        s.first_match([(bal.between(0, 2999), 1), (bal.between(3000, 5999), 2), (bal.between(6000, 9999), 3)], 0)
        .alias("income_ranking"),
        # the >= 10 arm can never be reached; the order is kept on purpose
        s.first_match([(n == 1, 1), (n >= 5, 2), (n >= 10, 3), (n.isNotNull(), 4)], 0).alias("tenure_group"),
    )


@query("p14_map_with_default", f"""
  WITH {GAMES} SELECT event_date, CASE tier WHEN 'A' THEN 5 WHEN 'B' THEN 4 WHEN 'C' THEN 3 WHEN 'D' THEN 2
  WHEN 'E' THEN 1 ELSE 0 END AS tier_num FROM games""")
def map_with_default(t):
    return games(t).select("event_date", s.lookup("tier", fixed.TIER_NUMBER, 0).alias("tier_num"))


@query("p15_list_map", f"""
  WITH {GAMES} SELECT event_date, CASE WHEN start_time IN ('12:30 PM','12:45 PM','1:00 PM','3:00 PM','3:30 PM') THEN 1
  WHEN start_time IN ('4:00 PM','5:00 PM','6:00 PM') THEN 2 ELSE 0 END AS start_time_num FROM games""")
def list_map(t):
    return games(t).select("event_date", s.label_of("start_time", fixed.START_TIME_NUMBER, 0).alias("start_time_num"))


@query("p16_map_without_default", """
  SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 10 WHEN 'N' THEN 20 END::DOUBLE AS code FROM lineitem""")
def map_without_default(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", s.lookup("l_returnflag", {"A": 10.0, "N": 20.0}).alias("code"))


@query("p17_last_match_wins", """
  SELECT o_orderkey, CASE WHEN o_totalprice < 5000 THEN 'Small' WHEN o_orderpriority LIKE '5%' THEN 'Low'
         WHEN o_orderstatus = 'F' THEN 'Filled' ELSE 'Unknown' END AS label FROM orders""")
def last_match_wins(t):
    return t.orders.select("o_orderkey", s.last_match([
        (F.col("o_orderstatus") == "F", "Filled"),
        (F.col("o_orderpriority").like("5%"), "Low"),
        (F.col("o_totalprice") < 5000, "Small"),
    ], "Unknown").alias("label"))


@query("p18_patch_by_key", """
  SELECT n_nationkey, n_name, CASE n_nationkey WHEN 3 THEN 99 WHEN 7 THEN 98 ELSE n_regionkey END AS n_regionkey
  FROM nation""")
def patch_by_key(t):
    patch = s.lookup("n_nationkey", {3: 99, 7: 98})
    return t.nation.withColumn("n_regionkey", F.coalesce(patch, F.col("n_regionkey")))


@query("p19_clamp", """
  SELECT c_custkey, LEAST(GREATEST(c_acctbal, 0), 5000) AS clamped FROM customer""")
def clamp(t):
    return t.customer.select("c_custkey", s.clamp("c_acctbal", F.lit(5000.0)).alias("clamped"))


@query("p20_null_handling", """
  WITH base AS (SELECT l_returnflag, NULLIF(l_discount, 0) AS disc, NULLIF(l_tax, 0) AS tax FROM lineitem),
       means AS (SELECT AVG(disc) AS m FROM base)
  SELECT l_returnflag, ROUND(SUM(COALESCE(disc, m)), 4) AS filled_mean, ROUND(SUM(COALESCE(tax, -1)), 4) AS filled_const,
         COUNT(CASE WHEN disc IS NOT NULL AND tax IS NOT NULL THEN 1 END) AS complete_rows
  FROM base CROSS JOIN means GROUP BY 1""")
def null_handling(t):
    base = t.lineitem.select(
        "l_returnflag", F.nullif("l_discount", F.lit(0.0)).alias("disc"), F.nullif("l_tax", F.lit(0.0)).alias("tax"))
    complete = F.col("disc").isNotNull() & F.col("tax").isNotNull()
    marked = base.withColumn("complete", complete).fillna({"tax": -1.0})
    return agg.fill_with_mean(marked, ["disc"]).groupBy("l_returnflag").agg(
        F.round(F.sum("disc"), 4).alias("filled_mean"),
        F.round(F.sum("tax"), 4).alias("filled_const"),
        F.count_if("complete").alias("complete_rows"),
    )


@query("p21_sentinel_date", """
  SELECT c_custkey, COALESCE(MIN(CAST(o_orderdate AS DATE)), DATE '2030-01-01') AS add_date
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1""")
def sentinel_date(t):
    first = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min(F.to_date("o_orderdate")).alias("d"))
    return t.customer.select("c_custkey").join(first, "c_custkey", "left").select(
        "c_custkey", F.coalesce("d", F.lit("2030-01-01").cast("date")).alias("add_date"))


@query("p22_safe_cast", """
  SELECT part_text, trunc(TRY_CAST(part_text AS DOUBLE)) AS number, COUNT(*) AS n
  FROM (SELECT CASE WHEN p_size % 3 = 0 THEN p_name ELSE (p_size + 0.75)::VARCHAR END AS part_text FROM part)
  GROUP BY 1, 2""")
def safe_cast(t):
    text = F.when(F.col("p_size") % 3 == 0, F.col("p_name")).otherwise(
        F.concat(F.col("p_size").cast("string"), F.lit(".75")))
    return t.part.select(text.alias("part_text")).groupBy("part_text").agg(F.count("*").alias("n")).withColumn(
        "number", s.whole_number("part_text").cast("double"))


@query("p23_truncate", "SELECT c_custkey, trunc(c_acctbal / 7)::INT AS whole FROM customer")
def truncate(t):
    return t.customer.select("c_custkey", (F.col("c_acctbal") / 7).cast("int").alias("whole"))


@query("p24_narrow", "SELECT l_orderkey, l_linenumber::SMALLINT AS line, l_quantity::SMALLINT AS seats FROM lineitem")
def narrow(t):
    return t.lineitem.select(
        "l_orderkey", F.col("l_linenumber").cast("short").alias("line"), F.col("l_quantity").cast("short").alias("seats"))


@query("p25_reorder", "SELECT s_name, s_nationkey, s_acctbal, s_suppkey FROM supplier")
def reorder(t):
    return t.supplier.select(*[c for c in t.supplier.columns if c != "s_suppkey"], "s_suppkey")


# --- joins ------------------------------------------------------------------------
@query("j1_inner", """
  SELECT c_mktsegment, COUNT(*) AS orders, ROUND(SUM(o_totalprice), 2) AS revenue
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def inner(t):
    # the fact is reduced to one row per customer before it moves
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n"), F.sum("o_totalprice").alias("v"))
    return per_customer.join(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey").groupBy("c_mktsegment").agg(
        F.sum("n").alias("orders"), F.round(F.sum("v"), 2).alias("revenue"))


@query("j2_left", """
  SELECT c_custkey, COALESCE(n, 0) AS orders FROM customer
  LEFT JOIN (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def left(t):
    n = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return t.customer.select("c_custkey").join(n, "c_custkey", "left").select(
        "c_custkey", F.coalesce("n", F.lit(0)).alias("orders"))


@query("j3_multi_key", f"""
  WITH {LINE_TICKETS},
  cap AS (SELECT event_date, arena_level, COUNT(*) AS lines FROM line_tickets GROUP BY 1, 2),
  paid AS (SELECT event_date, arena_level, SUM(paid_seats)::BIGINT AS paid FROM line_tickets WHERE NOT is_comp GROUP BY 1, 2)
  SELECT cap.event_date, cap.arena_level, lines, COALESCE(paid, 0) AS paid
  FROM cap LEFT JOIN paid ON cap.event_date = paid.event_date AND cap.arena_level = paid.arena_level""")
def multi_key(t):
    keys = ["event_date", "arena_level"]
    cap = line_tickets(t).groupBy(*keys).agg(F.count("*").alias("lines"))
    paid = line_tickets(t).where(~F.col("is_comp")).groupBy(*keys).agg(F.sum("paid_seats").alias("paid"))
    return cap.join(paid, keys, "left").withColumn("paid", F.coalesce("paid", F.lit(0)))


@query("j4_using", f"""
  WITH {LINE_TICKETS}, {GAMES}
  SELECT tier, COUNT(*) AS tickets, SUM(paid_seats)::BIGINT AS paid
  FROM line_tickets JOIN games USING (event_date, season) GROUP BY 1""")
def using(t):
    per_day = line_tickets(t).groupBy("event_date", "season").agg(
        F.count("*").alias("n"), F.sum("paid_seats").alias("p"))
    return per_day.join(games(t), ["event_date", "season"]).groupBy("tier").agg(
        F.sum("n").alias("tickets"), F.sum("p").alias("paid"))


@query("j5_full_outer_chain", """
  WITH a AS (SELECT user_id, COUNT(*) AS n FROM events WHERE event_type = 'signup' GROUP BY 1),
       b AS (SELECT user_id, COUNT(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1),
       c AS (SELECT user_id, COUNT(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1)
  SELECT DISTINCT c_custkey, COALESCE(a.n, 0) AS n_signup, COALESCE(b.n, 0) AS n_click, COALESCE(c.n, 0) AS n_purchase
  FROM customer FULL OUTER JOIN a ON a.user_id = c_custkey FULL OUTER JOIN b ON b.user_id = c_custkey
  FULL OUTER JOIN c ON c.user_id = c_custkey WHERE c_custkey IS NOT NULL""")
def full_outer_chain(t):
    # every arm compares with the contact key only and right-only rows are
    # filtered at the end, so the chain is a chain of left joins; the three
    # arms are one conditional aggregate over one scan
    kinds = ("signup", "click", "purchase")
    counts = t.events.where(F.col("event_type").isin(*kinds)).groupBy(F.col("user_id").alias("c_custkey")).agg(
        *[F.count_if(F.col("event_type") == k).alias(f"n_{k}") for k in kinds])
    return t.customer.select("c_custkey").join(counts, "c_custkey", "left").fillna(0, [f"n_{k}" for k in kinds])


@query("j6_full_outer_coalesce", """
  WITH a AS (SELECT c_nationkey AS k, COUNT(*) AS customers FROM customer WHERE c_acctbal > 9500 GROUP BY 1),
       b AS (SELECT s_nationkey AS k, COUNT(*) AS suppliers FROM supplier WHERE s_acctbal > 5000 GROUP BY 1)
  SELECT COALESCE(a.k, b.k) AS nation, customers::DOUBLE AS customers, suppliers::DOUBLE AS suppliers FROM a FULL OUTER JOIN b ON a.k = b.k""")
def full_outer_coalesce(t):
    a = t.customer.where("c_acctbal > 9500").groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.count("*").cast("double").alias("customers"))
    b = t.supplier.where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("nation")).agg(
        F.count("*").cast("double").alias("suppliers"))
    return a.join(b, "nation", "outer")


@query("j7_outer_not_null", """
  WITH a AS (SELECT user_id, COUNT(*) AS clicks FROM events WHERE event_type = 'click' GROUP BY 1),
       b AS (SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0)
  SELECT COALESCE(user_id, c_custkey) AS id, clicks, c_acctbal FROM a FULL OUTER JOIN b ON user_id = c_custkey
  WHERE clicks IS NOT NULL""")
def outer_not_null(t):
    a = t.events.where("event_type = 'click'").groupBy(F.col("user_id").alias("id")).agg(F.count("*").alias("clicks"))
    b = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("id"), "c_acctbal")
    return a.join(b, "id", "outer").where(F.col("clicks").isNotNull())


@query("j8_function_key", """
  SELECT lower(n_name) AS nation, COUNT(*) AS customers FROM customer
  JOIN (SELECT n_nationkey, 'Nation_' || n_nationkey::VARCHAR AS label FROM nation) m ON c_nationkey = m.n_nationkey
  JOIN nation n ON lower(m.label) = lower(n.n_name) GROUP BY 1""")
def function_key(t):
    # one normalised key column on each side, then a plain equi join
    mixed = t.customer.select(F.lower(F.concat(F.lit("Nation_"), F.col("c_nationkey").cast("string"))).alias("nation"))
    per_key = mixed.groupBy("nation").agg(F.count("*").alias("customers"))
    return per_key.join(t.nation.select(F.lower("n_name").alias("nation")).distinct(), "nation")


@query("j9_constant_conjunct", """
  SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT'""")
def constant_conjunct(t):
    c = t.customer.select("c_custkey", "c_name")
    on = (F.col("o_custkey") == F.col("c_custkey")) & (F.col("o_orderpriority") == "1-URGENT")
    return t.orders.join(c, on, "left").select("o_orderkey", "c_name")


@query("j10_point_in_time", """
  WITH buys AS (SELECT user_id, MIN(ts) AS bought FROM events WHERE event_type = 'purchase' AND value > 150 GROUP BY 1)
  SELECT e.user_id, COUNT(*) AS events_before FROM events e LEFT JOIN buys b ON e.user_id = b.user_id
  WHERE e.ts <= COALESCE(bought, TIMESTAMP '2024-01-20') GROUP BY 1""")
def point_in_time(t):
    buys = t.events.where("event_type = 'purchase' AND value > 150").groupBy("user_id").agg(F.min("ts").alias("bought"))
    facts = joins.point_in_time(t.events.select("user_id", "ts"), buys, "user_id", "ts", "bought", at("2024-01-20"))
    return facts.groupBy("user_id").agg(F.count("*").alias("events_before"))


@query("j11_grid", f"""
  WITH {LINE_TICKETS}, days AS (SELECT DISTINCT event_date FROM line_tickets),
  lv AS (SELECT DISTINCT arena_level FROM line_tickets), tt AS (SELECT DISTINCT ticket_type FROM line_tickets)
  SELECT event_date, arena_level, ticket_type FROM days CROSS JOIN lv CROSS JOIN tt""")
def grid(t):
    lt = line_tickets(t)
    return dense_grid(lt.select("event_date").distinct(), {
        "arena_level": lt.select("arena_level"), "ticket_type": lt.select("ticket_type")})


@query("j12_semi", """
  SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def semi(t):
    big = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(big, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("j13_exists_flag", """
  SELECT c_custkey, CASE WHEN c_custkey IN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01')
  THEN 1 ELSE 0 END AS did_renew FROM customer""")
def exists_flag(t):
    recent = t.orders.where(F.col("o_orderdate") >= at("2001-01-01")).select(F.col("o_custkey").alias("c_custkey"))
    return joins.exists_flag(t.customer.select("c_custkey"), recent, ["c_custkey"], "did_renew")


@query("j14_not_in", """
  SELECT c_custkey, c_nationkey FROM customer
  WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""")
def not_in(t):
    taken = t.supplier.where("s_acctbal > 5000").select(F.col("s_nationkey").alias("c_nationkey"))
    return joins.not_in(t.customer.select("c_custkey", "c_nationkey"), taken, "c_nationkey", null_aware=True)


@query("j15_composite_anti", """
  SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem l WHERE NOT EXISTS
  (SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R' AND r.l_orderkey = l.l_orderkey AND r.l_linenumber = l.l_linenumber)""")
def composite_anti(t):
    keys = ["l_orderkey", "l_linenumber"]
    returned = t.lineitem.where("l_returnflag = 'R'").select(*keys).distinct()
    return t.lineitem.select(*keys, "l_quantity").join(returned, keys, "left_anti")


@query("j16_asof", """
  SELECT p.user_id, p.event_id, p.ts AS purchase_time, c.ts AS contact_time, c.event_id::DOUBLE AS contact_id
  FROM (SELECT * FROM events WHERE event_type = 'purchase') p
  ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON p.user_id = c.user_id AND p.ts >= c.ts""")
def asof(t):
    buys = t.events.where("event_type = 'purchase'").select("user_id", "event_id", F.col("ts").alias("purchase_time"))
    contacts = t.events.where("event_type = 'click'").select(
        "user_id", F.col("ts").alias("contact_time"), F.col("event_id").cast("double").alias("contact_id"))
    return joins.asof_backward(buys, contacts, "user_id", "purchase_time", "contact_time", carry=["contact_id"])


@query("j17_renewed_next_season", f"""
  WITH {TICKETS}, held AS (SELECT DISTINCT season, buyer FROM tickets WHERE ticket_type IN ('Full', 'Premier'))
  SELECT a.season, a.buyer, CASE WHEN b.buyer IS NULL THEN 0 ELSE 1 END AS did_renew
  FROM held a LEFT JOIN held b ON a.buyer = b.buyer
   AND b.season = (left(a.season, 4)::INT + 1)::VARCHAR || '-' || lpad(((left(a.season, 4)::INT + 2) % 100)::VARCHAR, 2, '0')""")
def renewed_next_season(t):
    held = tickets(t).where(F.col("ticket_type").isin("Full", "Premier")).select("season", "buyer").distinct()
    following = held.select("buyer", F.col("season").alias("_next"))
    now = held.withColumn("_next", s.next_season("season"))
    return joins.exists_flag(now, following, ["buyer", "_next"], "did_renew").drop("_next")


@query("j18_row_at_minimum", f"""
  WITH {TICKETS}, d AS (SELECT event_date, days_out, SUM(paid_seats)::BIGINT AS paid FROM tickets GROUP BY 1, 2)
  SELECT event_date, arg_min(days_out, days_out) AS days_out, arg_min(paid, days_out) AS paid FROM d GROUP BY 1""")
def row_at_minimum(t):
    d = tickets(t).groupBy("event_date", "days_out").agg(F.sum("paid_seats").alias("paid"))
    return d.groupBy("event_date").agg(
        F.min("days_out").alias("days_out"), F.min_by("paid", "days_out").alias("paid"))


@query("j19_matrix_lookup", """
  WITH d AS (SELECT c.c_nationkey AS home, s.s_nationkey % 5 AS away, ROUND(AVG(abs(c_acctbal - s_acctbal)), 4) AS dist
             FROM (SELECT c_nationkey, AVG(c_acctbal) AS c_acctbal FROM customer GROUP BY 1) c
             JOIN (SELECT s_nationkey, AVG(s_acctbal) AS s_acctbal FROM supplier WHERE s_nationkey < 5 GROUP BY 1) s ON TRUE
             GROUP BY 1, 2)
  SELECT c_custkey, c_nationkey % 5 AS away, dist FROM customer
  LEFT JOIN d ON d.home = c_nationkey AND d.away = c_nationkey % 5""")
def matrix_lookup(t):
    # a wide nation x nation table, turned into pairs and joined on two keys
    away = t.supplier.where("s_nationkey < 5").groupBy("s_nationkey").agg(F.avg("s_acctbal").alias("b"))
    homes = t.customer.groupBy(F.col("c_nationkey").alias("home")).agg(F.avg("c_acctbal").alias("a"))
    cols = [str(i) for i in range(5)]
    balances = away.agg(*[F.struct(F.max(F.when(F.col("s_nationkey") == int(c), F.col("b"))).alias("b")).alias(c) for c in cols])
    wide = homes.withColumn("_b", balances.select(F.struct(*[F.col(f"`{c}`.b").alias(c) for c in cols])).scalar())
    matrix = wide.select("home", *[F.round(F.abs(F.col("a") - F.col("_b")[c]), 4).alias(c) for c in cols])
    pairs = joins.pairs_from_matrix(matrix, "home", cols, "away", "dist").withColumn("away", F.col("away").cast("int"))
    games_at = t.customer.select("c_custkey", F.col("c_nationkey").alias("home"), (F.col("c_nationkey") % 5).alias("away"))
    return games_at.join(pairs, ["home", "away"], "left").drop("home")


@query("j20_keyed_glue", """
  SELECT o_orderkey, o_totalprice, ROUND(o_totalprice / a, 4) AS relative
  FROM orders JOIN (SELECT o_custkey AS k, AVG(o_totalprice) AS a FROM orders GROUP BY 1) ON o_custkey = k""")
def keyed_glue(t):
    # results are glued to their rows by key, never by position
    mean = t.orders.groupBy("o_custkey").agg(F.avg("o_totalprice").alias("a"))
    return t.orders.join(mean, "o_custkey").select(
        "o_orderkey", "o_totalprice", F.round(F.col("o_totalprice") / F.col("a"), 4).alias("relative"))


@query("j21_from_dimension", """
  SELECT p_partkey, p_size, COALESCE(sold, 0) AS times_sold FROM part
  LEFT JOIN (SELECT l_partkey, COUNT(*) AS sold FROM lineitem GROUP BY 1) ON p_partkey = l_partkey""")
def from_dimension(t):
    sold = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("sold"))
    return t.part.select("p_partkey", "p_size").join(sold, "p_partkey", "left").select(
        "p_partkey", "p_size", F.coalesce("sold", F.lit(0)).alias("times_sold"))


@query("j22_interval", """
  WITH w AS (SELECT user_id, MIN(ts) AS w_start, MIN(ts) + INTERVAL 10 DAY AS w_end FROM events
             WHERE event_type = 'signup' GROUP BY 1)
  SELECT w.user_id, COUNT(*) AS n, ROUND(SUM(value), 2) AS total FROM events e JOIN w ON e.user_id = w.user_id
  WHERE e.ts BETWEEN w_start AND w_end GROUP BY 1""")
def interval_join(t):
    w = t.events.where("event_type = 'signup'").groupBy("user_id").agg(F.min("ts").alias("w_start")).withColumn(
        "w_end", F.col("w_start") + F.expr("INTERVAL 10 DAY"))
    inside = joins.within_window(t.events.select("user_id", "ts", "value"), w, "user_id", "ts", "w_start", "w_end")
    return inside.groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


# --- set operations ---------------------------------------------------------------
def early_late(t):
    columns = ["event_date", "ticket_type", "paid_seats", "gross_revenue", "season"]
    return [line_tickets(t, None, "1997-98").select(*columns), line_tickets(t, "1998-99").select(*columns)]


@query("u1_union_all", f"""
  WITH {LINE_TICKETS}
  SELECT season, ticket_type, SUM(paid_seats)::BIGINT AS paid, ROUND(SUM(gross_revenue), 2) AS revenue
  FROM line_tickets GROUP BY 1, 2""")
def union_all(t):
    a, b = early_late(t)
    return a.unionByName(b).groupBy("season", "ticket_type").agg(
        F.sum("paid_seats").alias("paid"), F.round(F.sum("gross_revenue"), 2).alias("revenue"))


@query("u2_union_distinct", f"""
  WITH {LINE_TICKETS}
  SELECT event_date, ticket_type FROM line_tickets WHERE season <= '1997-98' UNION
  SELECT event_date, ticket_type FROM line_tickets WHERE season > '1997-98'""")
def union_distinct(t):
    a, b = early_late(t)
    return a.select("event_date", "ticket_type").union(b.select("event_date", "ticket_type")).distinct()


@query("u3_union_missing_columns", """
  SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, NULL::DOUBLE AS nation FROM customer
  UNION ALL SELECT s_suppkey, s_acctbal, NULL, s_nationkey::DOUBLE FROM supplier""")
def union_missing(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"), F.col("s_nationkey").cast("double").alias("nation"))
    return a.unionByName(b, allowMissingColumns=True)


@query("u4_status_precedence", """
  WITH st AS (SELECT l_suppkey AS product, l_partkey % 40 AS section,
     CASE WHEN l_discount = 0.1 AND l_tax = 0 THEN 'COMP' WHEN l_quantity > 45 THEN 'SOLD' WHEN l_quantity > 25 THEN 'HELD' ELSE 'AVAIL' END AS status
     FROM lineitem),
  comp AS (SELECT DISTINCT product, section FROM st WHERE status = 'COMP'),
  sold AS (SELECT DISTINCT product, section FROM st WHERE status = 'SOLD' EXCEPT SELECT * FROM comp),
  held AS (SELECT DISTINCT product, section FROM st WHERE status = 'HELD' EXCEPT (SELECT * FROM comp UNION SELECT * FROM sold)),
  avail AS (SELECT DISTINCT product, section FROM st WHERE status = 'AVAIL'
            EXCEPT (SELECT * FROM comp UNION SELECT * FROM sold UNION SELECT * FROM held))
  SELECT *, 'COMP' AS status FROM comp UNION ALL SELECT *, 'SOLD' FROM sold UNION ALL SELECT *, 'HELD' FROM held
  UNION ALL SELECT *, 'AVAIL' FROM avail""")
def status_precedence(t):
    status = s.first_match([
        ((F.col("l_discount") == 0.1) & (F.col("l_tax") == 0), "COMP"),
        (F.col("l_quantity") > 45, "SOLD"),
        (F.col("l_quantity") > 25, "HELD"),
    ], "AVAIL")
    rows = t.lineitem.select(
        F.col("l_suppkey").alias("product"), (F.col("l_partkey") % 40).alias("section"), status.alias("status"))
    return agg.strongest_status(rows, ["product", "section"], "status", fixed.STATUS_ORDER)
