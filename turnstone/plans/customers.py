"""Customer operators on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnstone.functions import fixed_values as fixed
from turnstone.functions import scalars as s
from turnstone.operators import aggregates as agg
from turnstone.operators import customers as ops
from turnstone.operators import sampling, windows
from turnstone.registry import query
from turnstone.plans.ordered import STREAK_SQL
from turnstone.plans.relational import SURVEY_WORDS
from turnstone.plans.aggregates import season_columns as by_season
from turnstone.sources.views import SEASONS, TICKETS, scans, tickets


# A sign-up is an order, its email the customer's name in mixed case, its program the priority.
SIGNUPS = """signups AS (
  SELECT CASE WHEN o_orderkey % 3 = 0 THEN upper(c_name) ELSE c_name END AS email, o_orderpriority AS program, CAST(o_orderdate AS DATE) AS transaction_date,
    CASE WHEN month(o_orderdate) < 7 THEN (year(o_orderdate)-1)::VARCHAR || '-' || right(year(o_orderdate)::VARCHAR, 2) ELSE year(o_orderdate)::VARCHAR || '-' || right((year(o_orderdate)+1)::VARCHAR, 2) END AS season
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P')"""


def signups(t):
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return t.orders.where("o_orderstatus = 'P'").join(c, "o_custkey").select(
        F.when(F.col("o_orderkey") % 3 == 0, F.upper("c_name")).otherwise(F.col("c_name")).alias("email"),
        F.col("o_orderpriority").alias("program"), F.to_date("o_orderdate").alias("transaction_date"), s.season_of("o_orderdate").alias("season"))


CONTACTS = """contacts AS (SELECT c_custkey AS contact_id, lower(c_name) AS email, (DATE '1995-01-01' + (c_custkey % 2400)::INT)::DATE AS add_date FROM customer),
  bridge AS (SELECT c_custkey AS ticketing_id, c_custkey AS contact_id FROM customer)"""


def contacts(t):
    return t.customer.select(
        F.col("c_custkey").alias("contact_id"), F.lower("c_name").alias("email"),
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 2400).cast("int")).alias("add_date"))


def bridge(t):
    return t.customer.select(F.col("c_custkey").alias("ticketing_id"), F.col("c_custkey").alias("contact_id"))


SPEND = TICKETS + ", " + CONTACTS + """, spend AS (
  SELECT email, season, SUM(gross_revenue) AS gross_revenue, MAX(CASE WHEN ticket_type IN ('Full', 'Premier') THEN 1 ELSE 0 END) AS member
  FROM tickets JOIN bridge ON buyer = ticketing_id JOIN contacts USING (contact_id) GROUP BY 1, 2)"""


def spend(t):
    per = tickets(t).groupBy("buyer", "season").agg(
        F.sum("gross_revenue").alias("gross_revenue"), F.max(F.col("ticket_type").isin("Full", "Premier").cast("int")).alias("member"))
    return ops.with_email(per, bridge(t), contacts(t), "buyer").select("email", "season", "gross_revenue", "member")


@query("c1_first_touch", f"WITH {SIGNUPS} SELECT lower(email) AS email, MIN(transaction_date) AS first_transaction_date, MIN(season) AS first_season FROM signups GROUP BY 1")
def first_touch(t):
    return ops.first_touch(signups(t), "email", "transaction_date", "season")


@query("c2_identity_bridge", f"""
  WITH {TICKETS}, {CONTACTS} SELECT email, MIN(transaction_date) AS min_ticket_date, COUNT(*) AS tickets FROM tickets JOIN bridge ON buyer = ticketing_id JOIN contacts USING (contact_id) GROUP BY 1""")
def identity_bridge(t):
    per = tickets(t).groupBy("buyer").agg(F.min("transaction_date").alias("d"), F.count("*").alias("n"))
    return ops.with_email(per, bridge(t), contacts(t), "buyer").groupBy("email").agg(
        F.min("d").alias("min_ticket_date"), F.sum("n").alias("tickets"))


@query("c3_season_columns", f"""
  WITH {SPEND}, w AS (SELECT email, {by_season("gross_rev", "SUM(CASE WHEN {} THEN gross_revenue END)")}, {by_season("is_stm", "MAX(CASE WHEN {} THEN member END)")} FROM spend GROUP BY 1)
  SELECT email, ROUND(COLUMNS('gross_rev.*'), 2), COLUMNS('is_stm.*') FROM w""")
def season_columns(t):
    wide = agg.wide_by(spend(t), ["email"], "season", list(SEASONS), {"gross_rev": ("sum", "gross_revenue"), "is_stm": ("max", "member")})
    return wide.select("email", *[F.round(c, 2).alias(c) if c.startswith("gross") else F.col(c).cast("double").alias(c) for c in wide.columns[1:]])


EFFECT = f"""WITH {SPEND}, {SIGNUPS}, co AS (SELECT lower(email) AS email, MIN(transaction_date) AS first_transaction_date, MIN(season) AS first_season FROM signups WHERE {{where}} GROUP BY 1),
  j AS (SELECT co.*, COALESCE(add_date, DATE '2030-01-01') AS add_date FROM co LEFT JOIN contacts c ON c.email = co.email)
  SELECT j.email, first_season, first_transaction_date, add_date, ROUND(COALESCE(SUM(CASE WHEN season <= first_season THEN gross_revenue END), 0), 2) AS pre_revenue,
   ROUND(COALESCE(SUM(CASE WHEN season > first_season THEN gross_revenue END), 0), 2) AS post_revenue, COALESCE(SUM(CASE WHEN season <= first_season THEN member END), 0)::BIGINT AS pre_tickets,
   COALESCE(SUM(CASE WHEN season > first_season THEN member END), 0)::BIGINT AS post_tickets, (add_date < first_transaction_date)::INT AS pre_email, (add_date {{op}} first_transaction_date)::INT AS post_email
  FROM j LEFT JOIN spend s ON j.email = s.email GROUP BY ALL"""


def program_effect(t, program=None, strict=False):
    out = ops.program_effect(signups(t), spend(t), contacts(t).select("email", "add_date"), program, strict)
    return out.withColumns({"pre_revenue": F.round("pre_revenue", 2), "post_revenue": F.round("post_revenue", 2)})


@query("c4_pre_post", EFFECT.format(where="TRUE", op=">="))
def pre_post(t):
    return program_effect(t)


@query("c5_email_timing", f"""
  WITH {CONTACTS}, {SIGNUPS}, co AS (SELECT lower(email) AS email, MIN(transaction_date) AS d FROM signups GROUP BY 1)
  SELECT co.email, (add_date < d)::INT AS pre_email, (add_date >= d)::INT AS post_email, (add_date > d)::INT AS post_email_strict FROM co JOIN contacts USING (email)""")
def email_timing(t):
    co = ops.first_touch(signups(t), "email", "transaction_date").join(contacts(t), "email")
    pre, post = ops.email_timing("add_date", "first_transaction_date")
    strict = ops.email_timing("add_date", "first_transaction_date", strict=True)[1]
    return co.select("email", pre.alias("pre_email"), post.alias("post_email"), strict.alias("post_email_strict"))


@query("c6_one_program", EFFECT.format(where="program = '2-HIGH'", op=">"))
def one_program(t):
    return program_effect(t, "2-HIGH", strict=True)


@query("c7_program_timeline", f"""
  WITH {SPEND}, {SIGNUPS}, b AS (SELECT lower(email) AS email, program, MIN(transaction_date) AS joined, MIN(season) AS first_program_season FROM signups GROUP BY 1, 2),
  rev AS (SELECT s.email, season, add_date, gross_revenue FROM spend s JOIN contacts USING (email)), mem AS (SELECT email, season FROM spend WHERE member = 1)
  SELECT b.email, program, first_program_season, r.season AS rev_stm_season, CASE WHEN add_date >= joined THEN 'new_email' ELSE 'email_seen_before' END AS email_status,
   CASE WHEN first_program_season > r.season THEN 'pre_program_data' WHEN first_program_season = r.season THEN 'during_program_data' ELSE 'post_program_data' END AS program_data,
   ROUND(COALESCE(gross_revenue, 0), 2) AS gross_rev, ROUND(CASE WHEN ROW_NUMBER() OVER (PARTITION BY r.season, b.email ORDER BY program) = 1 THEN gross_revenue ELSE 0 END, 2) AS gross_rev_dedup,
   (m.email IS NOT NULL)::INT AS is_stm, CASE WHEN ROW_NUMBER() OVER (PARTITION BY r.season, b.email ORDER BY program) = 1 THEN (m.email IS NOT NULL)::INT ELSE 0 END AS is_stm_dedup
  FROM b LEFT JOIN rev r ON b.email = r.email LEFT JOIN mem m ON m.email = b.email AND m.season = r.season""")
def program_timeline(t):
    sp = spend(t)
    revenue = sp.join(contacts(t).select("email", "add_date"), "email").select("email", "season", "add_date", "gross_revenue")
    out = ops.program_timeline(signups(t), revenue, sp.where("member = 1").select("email", "season"))
    return out.withColumns({"gross_rev": F.round("gross_rev", 2), "gross_rev_dedup": F.round("gross_rev_dedup", 2)})


@query("c8_attendance_streaks", STREAK_SQL)
def attendance_streaks(t):
    return windows.streaks(scans(t), "client", "event_date", "attended")


KINDS = ["view", "click", "signup", "error"]
AS_OF = "2024-01-20 00:00:00"


@query("c9_engagement_counts", """
  WITH b AS (SELECT user_id, MIN(ts) AS cutoff FROM events WHERE event_type = 'purchase' AND value > 150 GROUP BY 1),
  k AS (SELECT e.user_id, e.event_type, CAST(e.ts AS DATE) AS d FROM events e LEFT JOIN b ON e.user_id = b.user_id WHERE e.ts <= COALESCE(cutoff, TIMESTAMP '2024-01-20'))
  SELECT user_id, COUNT(CASE WHEN event_type = 'view' THEN 1 END) AS num_view, COUNT(CASE WHEN event_type = 'click' THEN 1 END) AS num_click, COUNT(CASE WHEN event_type = 'signup' THEN 1 END) AS num_signup, COUNT(CASE WHEN event_type = 'error' THEN 1 END) AS num_error,
   COUNT(DISTINCT CASE WHEN event_type = 'view' THEN d END) AS days_view, COUNT(DISTINCT CASE WHEN event_type = 'click' THEN d END) AS days_click, COUNT(DISTINCT CASE WHEN event_type = 'signup' THEN d END) AS days_signup,
   COUNT(DISTINCT CASE WHEN event_type = 'error' THEN d END) AS days_error FROM k GROUP BY 1""")
def engagement_counts(t):
    cut = t.events.where("event_type = 'purchase' AND value > 150").groupBy("user_id").agg(F.min("ts").alias("cutoff"))
    return ops.engagement_counts(t.events.select("user_id", "ts", "event_type"), cut, "user_id", "ts", "event_type", KINDS, F.lit(AS_OF).cast("timestamp_ntz"))


@query("c10_digital_activity", """
  SELECT c_custkey AS id, COALESCE(f.n, 0) AS form_submissions, COALESCE(c.n, 0) AS contest_activities, COALESCE(x.n, 0) AS transactions, COALESCE(x.m, 0) AS is_plus, COALESCE(s.n, 0) AS survey_responses FROM customer
  LEFT JOIN (SELECT o_custkey, COUNT(*) AS n FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED' GROUP BY 1) s ON s.o_custkey = c_custkey
  LEFT JOIN (SELECT user_id, COUNT(DISTINCT event_id) AS n FROM events WHERE event_type = 'signup' GROUP BY 1) f ON f.user_id = c_custkey
  LEFT JOIN (SELECT user_id, COUNT(DISTINCT event_type || ' ' || CAST(ts AS DATE)::VARCHAR) AS n FROM events WHERE event_type IN ('click', 'view') GROUP BY 1) c ON c.user_id = c_custkey
  LEFT JOIN (SELECT user_id, COUNT(*) AS n, MAX((value > 100)::INT) AS m FROM events WHERE event_type = 'purchase' GROUP BY 1) x ON x.user_id = c_custkey""")
def digital_activity(t):
    # one scan: per person and day, then per person
    kind = F.col("event_type")
    per_day = t.events.groupBy(F.col("user_id").alias("id"), F.to_date("ts").alias("d")).agg(
        F.count_if(kind == "signup").alias("forms"),
        (F.max((kind == "click").cast("int")) + F.max((kind == "view").cast("int"))).alias("contests"),
        F.count_if(kind == "purchase").alias("buys"), F.max(((kind == "purchase") & (F.col("value") > 100)).cast("int")).alias("plus"))
    per = per_day.groupBy("id").agg(
        F.sum("forms").alias("form_submissions"), F.sum("contests").alias("contest_activities"),
        F.sum("buys").alias("transactions"), F.max("plus").alias("is_plus"))
    base = t.customer.select(F.col("c_custkey").alias("id"))
    surveys = t.orders.where("o_orderpriority <> '4-NOT SPECIFIED'").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("survey_responses"))
    return ops.wide_profile(base, [per, surveys], ["id"], ["form_submissions", "contest_activities", "transactions", "is_plus", "survey_responses"])


@query("c11_base_vs_buyers", f"""
  WITH {TICKETS}, b AS (SELECT buyer, MIN(transaction_date) AS cutoff FROM tickets WHERE ticket_type IN ('Full', 'Premier') AND season = '1999-00' AND NOT is_comp GROUP BY 1)
  SELECT DISTINCT t.buyer, CASE WHEN b.buyer IS NULL THEN 0 ELSE 1 END AS did_purchase FROM tickets t LEFT JOIN b ON t.buyer = b.buyer""")
def base_vs_buyers(t):
    tk = tickets(t)
    plans = tickets(t, "1999-00", "1999-00").where(F.col("ticket_type").isin("Full", "Premier"))
    buyers = ops.first_new_purchase(plans, "buyer", "transaction_date", F.col("is_comp"))
    return ops.labelled_base(tk.select("buyer"), buyers.select("buyer"), "buyer")


def calls_and_buys(t):
    contact = t.events.where(F.col("event_type").isin("click", "view")).select(
        "user_id", F.col("ts").alias("contact_date"), F.when(F.col("event_type") == "click", "Call").otherwise("Email").alias("task_type"))
    buys = t.events.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("purchase_date"))
    return contact, buys


@query("c12_snapshot_features", """
  WITH base AS (SELECT DISTINCT user_id FROM events), c AS (SELECT user_id, COUNT(*) AS n, MAX(ts) AS m, COUNT(CASE WHEN event_type = 'click' THEN 1 END) AS calls, COUNT(CASE WHEN event_type = 'view' THEN 1 END) AS mails FROM events
    WHERE event_type IN ('click', 'view') AND ts < TIMESTAMP '2024-01-05' GROUP BY 1),
  p AS (SELECT user_id, COUNT(*) AS n, MAX(ts) AS m, COUNT(CASE WHEN ts >= TIMESTAMP '2024-01-05' - INTERVAL 60 DAY THEN 1 END) AS r FROM events WHERE event_type = 'purchase' AND ts < TIMESTAMP '2024-01-05' GROUP BY 1)
  SELECT base.user_id, COALESCE(c.n, 0) AS total_lifetime_contacts, COALESCE(floor(epoch_us(TIMESTAMP '2024-01-05' - c.m) / 86400000000)::BIGINT, 999) AS days_since_last_contact, COALESCE(calls, 0) AS total_calls, COALESCE(mails, 0) AS total_emails,
   COALESCE(p.n, 0) AS total_purchase_events, COALESCE(floor(epoch_us(TIMESTAMP '2024-01-05' - p.m) / 86400000000)::BIGINT, 999) AS days_since_last_purchase, COALESCE(r, 0) AS purchases_last_60_days
  FROM base LEFT JOIN c ON c.user_id = base.user_id LEFT JOIN p ON p.user_id = base.user_id""")
def snapshot_features(t):
    contact, buys = calls_and_buys(t)
    return ops.snapshot_features(t.events.select("user_id").distinct(), contact, buys, "user_id", "2024-01-05", recent_days=60)


@query("c13_contact_outcomes", """
  WITH c AS (SELECT user_id, ts AS contact_date FROM events WHERE event_type IN ('click', 'view')), p AS (SELECT user_id, ts AS purchase_date FROM events WHERE event_type = 'purchase'),
  w AS (SELECT p.user_id, c.contact_date FROM p ASOF JOIN c ON p.user_id = c.user_id AND p.purchase_date >= c.contact_date WHERE floor(epoch_us(purchase_date - contact_date) / 86400000000) BETWEEN 0 AND 30)
  SELECT user_id, contact_date, 1 AS label FROM w UNION ALL SELECT user_id, contact_date, 0 FROM c WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.user_id = c.user_id AND w.contact_date = c.contact_date)""")
def contact_outcomes(t):
    contact, buys = calls_and_buys(t)
    return ops.contact_outcomes(contact, buys, "user_id", within_days=30)


RENEWAL = TICKETS + """, base AS (SELECT buyer, CASE WHEN MAX((ticket_type = 'Full')::INT) = 1 THEN 'Full' ELSE 'Premier' END AS plan FROM tickets WHERE season = '1999-00' AND ticket_type IN ('Full', 'Premier') GROUP BY 1),
  years AS (SELECT DISTINCT buyer, left(season, 4)::INT AS y FROM tickets WHERE ticket_type IN ('Full', 'Premier') AND season <= '1999-00'),
  ten AS (SELECT buyer, COUNT(*) AS tenure FROM (SELECT buyer, y, ROW_NUMBER() OVER (PARTITION BY buyer ORDER BY y DESC) AS k FROM years) WHERE y = 1999 - k + 1 GROUP BY 1),
  rates AS (SELECT buyer, SUM(CASE WHEN NOT is_comp THEN did_attend::INT END)::DOUBLE / NULLIF(COUNT(CASE WHEN NOT is_comp THEN 1 END), 0) AS paid_rate, SUM(did_attend::INT)::DOUBLE / COUNT(*) AS show_rate,
     COUNT(DISTINCT CASE WHEN did_attend THEN event_date END)::DOUBLE / COUNT(DISTINCT event_date) AS self_rate,
     SUM(gross_revenue) AS spend, COUNT(DISTINCT event_date) AS games FROM tickets WHERE season = '1999-00' GROUP BY 1),
  touch AS (SELECT o_custkey AS buyer, COUNT(DISTINCT o_orderkey) AS touchpoints, MAX(CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 1 WHEN '4-NOT SPECIFIED' THEN -1 ELSE -2 END) AS likely
     FROM orders WHERE o_orderdate >= TIMESTAMP '1999-07-01' GROUP BY 1),
  lv AS (SELECT buyer, arena_level, ROW_NUMBER() OVER (PARTITION BY buyer ORDER BY COUNT(*) DESC, CASE arena_level WHEN 'Premium' THEN 1 WHEN 'Lowers' THEN 2 WHEN 'Clubs' THEN 3 WHEN 'Uppers' THEN 4 ELSE 5 END, arena_level) AS rn
     FROM tickets WHERE season = '1999-00' GROUP BY 1, 2),
  nxt AS (SELECT DISTINCT buyer FROM tickets WHERE season = '2000-01' AND ticket_type IN ('Full', 'Premier'))"""


@query("c14_renewal_features", f"""
  WITH {RENEWAL} SELECT b.buyer, plan, tenure, ROUND(self_rate, 6) AS self_show_rate, (c_nationkey < 5)::INT AS is_local, COALESCE(touchpoints, 0) AS touchpoints, ROUND(paid_rate, 6) AS paid_show_rate, ROUND(show_rate, 6) AS show_rate, games AS num_games, ROUND(spend, 2) AS gross_revenue, lv.arena_level AS arena_level,
   COALESCE(likely, 0) AS renewal_likelihood_survey, CASE WHEN COALESCE(touchpoints, 0) <= 0 THEN 0 WHEN touchpoints <= 3 THEN 1 WHEN touchpoints <= 7 THEN 2 WHEN touchpoints <= 15 THEN 3 ELSE 4 END AS touchpoints_agg,
   CASE WHEN spend <= 0 THEN 0 WHEN spend <= CASE plan WHEN 'Full' THEN 5000 ELSE 2500 END THEN 1 WHEN spend <= CASE plan WHEN 'Full' THEN 10000 ELSE 5000 END THEN 2
    WHEN spend <= CASE plan WHEN 'Full' THEN 20000 ELSE 10000 END THEN 3 WHEN spend <= CASE plan WHEN 'Full' THEN 40000 ELSE 20000 END THEN 4 ELSE 5 END AS gross_revenue_agg, (n.buyer IS NOT NULL)::INT AS did_renew
  FROM base b JOIN ten ON ten.buyer = b.buyer JOIN customer ON c_custkey = b.buyer JOIN rates r ON r.buyer = b.buyer LEFT JOIN touch t ON t.buyer = b.buyer LEFT JOIN lv ON lv.buyer = b.buyer AND rn = 1 LEFT JOIN nxt n ON n.buyer = b.buyer WHERE spend > 0""")
def renewal_features(t):
    return renewal_table(t).select(
        "buyer", "plan", "tenure", F.round("self_show_rate", 6).alias("self_show_rate"), "is_local", "touchpoints", F.round("paid_show_rate", 6).alias("paid_show_rate"), F.round("show_rate", 6).alias("show_rate"), "num_games",
        F.round("gross_revenue", 2).alias("gross_revenue"), "arena_level", "renewal_likelihood_survey", "touchpoints_agg", "gross_revenue_agg", "did_renew")


def renewal_table(t, season: str = "1999-00"):
    """Plan holders of a season: plan, tenure, three show rates (paid tickets, all tickets, days), spend, and whether they renewed.

    Tenure counts the seasons in a row, up to this one, in which a plan was held.
    """
    start = int(season[:4])
    tk = tickets(t, None, f"{start + 1}-{(start + 2) % 100:02}")
    now, held = F.col("season") == season, F.col("ticket_type").isin("Full", "Premier")
    later = F.col("season") > season
    came, paid = F.col("did_attend").cast("int"), ~F.col("is_comp")
    # membership by season, show rates, spend and games in one pass
    per_day = tk.groupBy("buyer", "event_date").agg(
        F.max((now & held).cast("int")).alias("m"), F.max((later & held).cast("int")).alias("next"), F.max(now.cast("int")).alias("g"),
        F.max((now & (F.col("ticket_type") == "Full")).cast("int")).alias("full"), F.max((now & F.col("did_attend")).cast("int")).alias("self"),
        F.max(F.when(held & ~later, F.left("season", F.lit(4)).cast("int"))).alias("year"),
        F.sum(F.when(now & paid, came)).alias("pa"), F.count_if(now & paid).alias("pn"), F.sum(F.when(now, came)).alias("a"),
        F.count_if(now).alias("n"), F.sum(F.when(now, F.col("gross_revenue"))).alias("v"))
    base = per_day.groupBy("buyer").agg(
        F.max("m").alias("m"), F.max("next").alias("did_renew"), s.ratio(F.sum("pa"), F.sum("pn")).alias("paid_show_rate"),
        s.ratio(F.sum("a"), F.sum("n")).alias("show_rate"), s.ratio(F.sum("self"), F.sum("g")).alias("self_show_rate"),
        F.sum("g").alias("num_games"), F.sum("v").alias("gross_revenue"),
        F.when(F.max("full") == 1, "Full").otherwise("Premier").alias("plan"), F.collect_set("year").alias("_years"),
    ).where("m = 1 AND gross_revenue > 0").drop("m")
    # seasons of a buyer, latest first, are as many as the club is old; the run ends at the first gap
    gaps = F.filter(F.sequence(F.lit(1), F.size("_years") + 1), lambda k: ~F.array_contains("_years", F.lit(start) - k))
    base = base.withColumn("tenure", F.element_at(gaps, 1).cast("long")).drop("_years")
    answer = s.lookup(s.lookup("o_orderpriority", SURVEY_WORDS), fixed.SURVEY_LIKELIHOOD, 0)
    touch = t.orders.where(F.col("o_orderdate") >= F.lit(f"{start}-07-01").cast("timestamp_ntz")).groupBy(F.col("o_custkey").alias("buyer")).agg(
        F.countDistinct("o_orderkey").alias("touchpoints"), F.max(answer).alias("renewal_likelihood_survey"))
    level = agg.modal_value(tickets(t, season, season), "buyer", "arena_level", s.lookup("arena_level", fixed.LEVEL_ORDER, 5)).drop("n")
    local = t.customer.select(F.col("c_custkey").alias("buyer"), (F.col("c_nationkey") < 5).cast("int").alias("is_local"))
    out = ops.wide_profile(base.join(local, "buyer"), [touch, level], ["buyer"], ["touchpoints", "renewal_likelihood_survey"])
    return out.withColumns({
        "touchpoints_agg": s.cut("touchpoints", [None, *fixed.TOUCHPOINT_EDGES, None], [0, 1, 2, 3, 4]),
        "gross_revenue_agg": F.when(F.col("plan") == "Full", s.cut("gross_revenue", [None, *fixed.SPEND_EDGES["Full"], None], [0, 1, 2, 3, 4, 5])).otherwise(
            s.cut("gross_revenue", [None, *fixed.SPEND_EDGES["Premier"], None], [0, 1, 2, 3, 4, 5])),
    })


@query("c15_modal_level", f"""
  WITH {TICKETS} SELECT buyer, arena_level, n FROM (SELECT buyer, arena_level, COUNT(*) AS n, ROW_NUMBER() OVER (PARTITION BY buyer ORDER BY COUNT(*) DESC, CASE arena_level WHEN 'Premium' THEN 1 WHEN 'Lowers' THEN 2
    WHEN 'Clubs' THEN 3 WHEN 'Uppers' THEN 4 ELSE 5 END, arena_level) AS rn FROM tickets GROUP BY 1, 2) WHERE rn = 1""")
def modal_level(t):
    return agg.modal_value(tickets(t), "buyer", "arena_level", s.lookup("arena_level", fixed.LEVEL_ORDER, 5))


@query("c16_member_profile", f"""
  WITH {TICKETS}, subs AS (SELECT season, buyer, MAX((ticket_type = 'Full')::INT) AS is_full, MAX((ticket_type = 'Premier')::INT) AS is_premier, SUM(gross_revenue) AS total_spend, MAX((arena_level = 'Premium')::INT) AS is_premium,
     MAX((arena_level = 'Clubs')::INT) AS is_club, MAX((arena_level = 'Lowers')::INT) AS is_lower, MAX((arena_level = 'Uppers')::INT) AS is_upper, MAX((ticket_type = 'Groups')::INT) AS is_community, COUNT(CASE WHEN is_comp THEN 1 END) AS discounts FROM tickets GROUP BY 1, 2 HAVING SUM(gross_revenue) > 0),
  rates AS (SELECT season, buyer, SUM(did_attend::INT)::DOUBLE / COUNT(*) AS show_rate FROM tickets GROUP BY 1, 2),
  income AS (SELECT c_custkey AS buyer, CASE WHEN c_acctbal BETWEEN 0 AND 2999 THEN 1 WHEN c_acctbal BETWEEN 3000 AND 5999 THEN 2 WHEN c_acctbal BETWEEN 6000 AND 9999 THEN 3 ELSE 0 END AS income_ranking, c_mktsegment AS segment, n_name AS home, r_name AS census_region
     FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey),
  ev AS (SELECT user_id AS buyer, COUNT(CASE WHEN event_type = 'view' THEN 1 END) AS opens, MAX((event_type = 'click')::INT) AS has_clicked FROM events GROUP BY 1),
  held AS (SELECT DISTINCT season, buyer FROM tickets)
  SELECT s.season, s.buyer, is_full, is_premier, ROUND(total_spend, 2) AS total_spend, is_premium, is_club, is_lower, is_upper, is_community, discounts, ROUND(show_rate, 6) AS show_rate, income_ranking, segment, home, census_region, COALESCE(opens, 0) AS opens, COALESCE(has_clicked, 0) AS has_clicked,
   (h.buyer IS NOT NULL)::INT AS did_renew FROM subs s LEFT JOIN rates r ON r.season = s.season AND r.buyer = s.buyer LEFT JOIN income i ON i.buyer = s.buyer LEFT JOIN ev ON ev.buyer = s.buyer
  LEFT JOIN held h ON h.buyer = s.buyer AND h.season = (left(s.season, 4)::INT + 1)::VARCHAR || '-' || lpad(((left(s.season, 4)::INT + 2) % 100)::VARCHAR, 2, '0')""")
def member_profile(t):
    now = tickets(t)
    def has(column, value):
        return F.max((F.col(column) == value).cast("int"))
    subs = now.groupBy("season", "buyer").agg(
        has("ticket_type", "Full").alias("is_full"), has("ticket_type", "Premier").alias("is_premier"), F.sum("gross_revenue").alias("total_spend"),
        has("ticket_type", "Groups").alias("is_community"), F.count_if("is_comp").alias("discounts"), has("arena_level", "Premium").alias("is_premium"), has("arena_level", "Clubs").alias("is_club"), has("arena_level", "Lowers").alias("is_lower"), has("arena_level", "Uppers").alias("is_upper"),
        s.ratio(F.sum(F.col("did_attend").cast("int")), F.count("*")).alias("show_rate")).where("total_spend > 0")
    bal = F.col("c_acctbal")
    people = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"), "left").join(t.region, F.col("r_regionkey") == F.col("n_regionkey"), "left")
    income = people.select(F.col("c_custkey").alias("buyer"), F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("home"), F.col("r_name").alias("census_region"), s.first_match(
        [(bal.between(0, 2999), 1), (bal.between(3000, 5999), 2), (bal.between(6000, 9999), 3)], 0).alias("income_ranking"))
    ev = t.events.groupBy(F.col("user_id").alias("buyer")).agg(
        F.count_if(F.col("event_type") == "view").alias("opens"), F.max((F.col("event_type") == "click").cast("int")).alias("has_clicked"))
    held = now.select("buyer", F.col("season").alias("_next")).distinct().withColumn("did_renew", F.lit(1))
    out = ops.wide_profile(subs, [income, ev], ["buyer"], ["opens", "has_clicked"])
    out = ops.wide_profile(out.withColumn("_next", s.next_season("season")), [held], ["buyer", "_next"], ["did_renew"]).drop("_next")
    return out.withColumns({"total_spend": F.round("total_spend", 2), "show_rate": F.round("show_rate", 6)})


@query("c17_score_tiers", """
  SELECT c_custkey, CASE WHEN p > 0 AND p <= 0.5 THEN 'Tier 4' WHEN p > 0.5 AND p <= 0.75 THEN 'Tier 3' WHEN p > 0.75 AND p <= 0.9 THEN 'Tier 2' WHEN p > 0.9 AND p <= 1 THEN 'Tier 1' END AS prediction_group,
   CASE WHEN n < 1 THEN 'Tier 5' WHEN n < 51 THEN 'Tier 4' WHEN n < 101 THEN 'Tier 3' WHEN n < 201 THEN 'Tier 2' ELSE 'Tier 1' END AS num_sent_group, CASE WHEN p >= 0.8 THEN 'HOT' WHEN p >= 0.5 THEN 'WARM' ELSE 'COLD' END AS priority_tier
  FROM (SELECT c_custkey, c_acctbal / 10000 AS p, c_custkey % 300 AS n FROM customer)""")
def score_tiers(t):
    c = t.customer.select("c_custkey", (F.col("c_acctbal") / 10000).alias("p"), (F.col("c_custkey") % 300).alias("n"))
    score, sent = fixed.SCORE_EDGES, fixed.EMAIL_EDGES
    return c.select("c_custkey", s.cut("p", *score).alias("prediction_group"), s.cut("n", *sent, right=False).alias("num_sent_group"), ops.priority("p").alias("priority_tier"))


@query("c18_campaign_list", """
  WITH sc AS (SELECT c_custkey, c_nationkey % 6 - 2 AS survey, (c_acctbal + 1000) / 11000 AS p FROM customer), bad AS (SELECT * FROM sc WHERE survey IN (-1, -2))
  SELECT c_custkey, survey, ROUND(p, 6) AS p FROM bad UNION ALL
  SELECT c_custkey, survey, ROUND(p, 6) FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY p, c_custkey) AS rn FROM sc WHERE survey IN (0, 1, 2)) WHERE rn <= 500 - (SELECT COUNT(*) FROM bad)""")
def campaign_list(t):
    sc = t.customer.select("c_custkey", (F.col("c_nationkey") % 6 - 2).alias("survey"), ((F.col("c_acctbal") + 1000) / 11000).alias("p"))
    answered = sc.where(F.col("survey").between(-2, 2))
    out = sampling.fill_to(answered, F.col("survey") < 0, ["p", "c_custkey"], 500)
    return out.withColumn("p", F.round("p", 6))


@query("c19_survey_segments", """
  SELECT doc_id, split_part(split_part(answer, ',', 2), ':', 2) AS theme_night, split_part(split_part(answer, ',', 3), ':', 2) AS giveaways,
   CASE WHEN tickets LIKE '%Season Tickets%' THEN 'Season Tickets' WHEN tickets LIKE '%Nightly Suites%' THEN 'Nightly Suites' WHEN tickets LIKE '%Groups%' THEN 'Groups' ELSE 'Single Game' END AS ticket_type
  FROM (SELECT doc_id, 'a:' || lang || ',b:' || source || ',c:' || n_chars::VARCHAR AS answer, CASE doc_id % 4 WHEN 0 THEN 'Season Tickets, Groups' WHEN 1 THEN 'Groups' WHEN 2 THEN 'Nightly Suites' ELSE 'none' END AS tickets FROM documents)""")
def survey_segments(t):
    pick = F.col("doc_id") % 4
    d = t.documents.select(
        "doc_id", F.concat(F.lit("a:"), "lang", F.lit(",b:"), "source", F.lit(",c:"), F.col("n_chars").cast("string")).alias("answer"),
        F.when(pick == 0, "Season Tickets, Groups").when(pick == 1, "Groups").when(pick == 2, "Nightly Suites").otherwise("none").alias("tickets"))
    def factor(n):
        return F.split_part(F.split_part("answer", F.lit(","), F.lit(n)), F.lit(":"), F.lit(2))
    kind = F.col("tickets")
    return d.select("doc_id", factor(2).alias("theme_night"), factor(3).alias("giveaways"), s.first_match([
        (kind.like("%Season Tickets%"), "Season Tickets"), (kind.like("%Nightly Suites%"), "Nightly Suites"), (kind.like("%Groups%"), "Groups")], "Single Game").alias("ticket_type"))


COHORTS = TICKETS + """, att AS (SELECT buyer, event_date FROM tickets WHERE did_attend), held AS (SELECT DISTINCT buyer, season FROM tickets WHERE ticket_type = 'Full'), new AS (SELECT DISTINCT buyer, season FROM tickets WHERE ticket_type = 'Premier'),
  co AS (SELECT DISTINCT buyer, '1997-98' AS obs_season, DATE '1997-10-01' AS season_start, DATE '1998-06-30' AS season_end FROM att WHERE event_date BETWEEN DATE '1997-10-01' AND DATE '1998-06-30' AND buyer NOT IN (SELECT buyer FROM held WHERE season = '1997-98')
   UNION ALL SELECT DISTINCT buyer, '1998-99', DATE '1998-10-01', DATE '1999-06-30' FROM att WHERE event_date BETWEEN DATE '1998-10-01' AND DATE '1999-06-30' AND buyer NOT IN (SELECT buyer FROM held WHERE season = '1998-99'))"""


def cohorts(t):
    tk = tickets(t, "1997-98", "1999-00")
    att = tk.where("did_attend")
    def plan(kind, season):
        return tk.where((F.col("ticket_type") == kind) & (F.col("season") == season)).select("buyer")
    one = ops.season_cohort(att, "buyer", "event_date", plan("Full", "1997-98"), plan("Premier", "1998-99"), "1997-98", "1997-10-01", "1998-06-30")
    two = ops.season_cohort(att, "buyer", "event_date", plan("Full", "1998-99"), plan("Premier", "1999-00"), "1998-99", "1998-10-01", "1999-06-30")
    return one.unionByName(two)


@query("c20_season_cohorts", f"""
  WITH {COHORTS} SELECT co.*, (n.buyer IS NOT NULL)::INT AS did_purchase_next_season FROM co LEFT JOIN new n ON n.buyer = co.buyer AND n.season = CASE obs_season WHEN '1997-98' THEN '1998-99' ELSE '1999-00' END""")
def season_cohorts(t):
    return cohorts(t)


@query("c21_window_features", f"""
  WITH {COHORTS} SELECT co.buyer, obs_season, COUNT(DISTINCT event_date) AS num_games, COUNT(*) AS num_tickets, ROUND(SUM(gross_revenue), 2) AS spend FROM co JOIN tickets t ON t.buyer = co.buyer AND event_date BETWEEN season_start AND season_end GROUP BY 1, 2""")
def window_features(t):
    return ops.window_features(cohorts(t), tickets(t, "1997-98", "1998-99").select("buyer", "event_date", "gross_revenue"), "buyer", "event_date", [
        F.countDistinct("event_date").alias("num_games"), F.count("*").alias("num_tickets"), F.round(F.sum("gross_revenue"), 2).alias("spend")])


@query("c22_inference_cohort", f"""
  WITH {COHORTS}, cur AS (SELECT DISTINCT buyer FROM att WHERE event_date BETWEEN DATE '2000-10-01' AND DATE '2001-03-15' AND buyer NOT IN (SELECT buyer FROM held WHERE season = '2000-01'))
  SELECT cur.buyer, COUNT(DISTINCT event_date) AS num_games, ROUND(SUM(gross_revenue), 2) AS spend FROM cur JOIN tickets t ON t.buyer = cur.buyer AND event_date BETWEEN DATE '2000-10-01' AND DATE '2001-03-15' GROUP BY 1""")
def inference_cohort(t):
    tk = tickets(t, "2000-01", "2000-01")
    members = tk.where((F.col("ticket_type") == "Full") & (F.col("season") == "2000-01")).select("buyer")
    now = ops.season_cohort(tk.where("did_attend"), "buyer", "event_date", members, None, "2000-01", "2000-10-01", "2001-03-15")
    return ops.window_features(now, tk.select("buyer", "event_date", "gross_revenue"), "buyer", "event_date", [
        F.countDistinct("event_date").alias("num_games"), F.round(F.sum("gross_revenue"), 2).alias("spend")]).drop("obs_season")
