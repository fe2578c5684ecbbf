"""Forecast compositions that SQL can express too."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from turnstone.functions import fixed_values as fixed
from turnstone.functions import scalars as s
from turnstone.operators import forecasting as ops
from turnstone.operators import windows
from turnstone.operators.aggregates import strongest_status
from turnstone.operators.regression import forecast_by_group
from turnstone.operators.scan import even_buckets
from turnstone.registry import query
from turnstone.sources.views import GAMES, LINE_TICKETS, TICKETS, games, line_tickets, tickets

WEIGHTS = {"1997-98": 0.5, "1998-99": 1.0, "1999-00": 1.5}
WEIGHT_SQL = "CASE season WHEN '1997-98' THEN 0.5 WHEN '1998-99' THEN 1.0 WHEN '1999-00' THEN 1.5 END::DOUBLE"


@query("m1_ols_by_group", f"""
  WITH {LINE_TICKETS}, h AS (SELECT arena_level, event_date, COUNT(*) AS n, SUM(gross_revenue) AS y FROM line_tickets GROUP BY 1, 2),
  m AS (SELECT arena_level, regr_slope(y, n) AS b, regr_intercept(y, n) AS a FROM h WHERE event_date < DATE '2000-07-01' GROUP BY 1)
  SELECT arena_level, event_date, n, ROUND(a + b * n, 2) AS predicted FROM h JOIN m USING (arena_level) WHERE event_date >= DATE '2000-07-01'""")
def ols_by_group(t):
    per = line_tickets(t).groupBy("arena_level", "event_date").agg(F.count("*").alias("n"), F.sum("gross_revenue").alias("y"))
    cut = F.lit("2000-07-01").cast("date")
    out = forecast_by_group(per.where(F.col("event_date") < cut), per.where(F.col("event_date") >= cut).drop("y"), ["arena_level"], ["n"], "y")
    return out.withColumn("predicted", F.round("predicted", 2))


@query("m2_independent_scaling", f"""
  WITH {LINE_TICKETS}, h AS (SELECT arena_level, event_date, COUNT(*) AS n, SUM(gross_revenue) AS y FROM line_tickets GROUP BY 1, 2),
  m AS (SELECT arena_level, regr_slope(y, n) AS b, AVG(y) AS ym, stddev_pop(n) AS sd FROM h WHERE event_date < DATE '2000-07-01' GROUP BY 1),
  u AS (SELECT arena_level, AVG(n) AS um, stddev_pop(n) AS ud FROM h WHERE event_date >= DATE '2000-07-01' GROUP BY 1)
  SELECT arena_level, event_date, n, ROUND(ym + b * sd * (n - um) / ud, 2) AS predicted FROM h JOIN m USING (arena_level) JOIN u USING (arena_level) WHERE event_date >= DATE '2000-07-01'""")
def independent_scaling(t):
    per = line_tickets(t).groupBy("arena_level", "event_date").agg(F.count("*").alias("n"), F.sum("gross_revenue").alias("y"))
    cut = F.lit("2000-07-01").cast("date")
    out = forecast_by_group(
        per.where(F.col("event_date") < cut), per.where(F.col("event_date") >= cut).drop("y"), ["arena_level"], ["n"], "y", scale="independent")
    return out.withColumn("predicted", F.round("predicted", 2))


@query("m3_log_target", f"""
  WITH {TICKETS}, h AS (SELECT arena_level, season, days_out, SUM(paid_seats) AS y, COUNT(*) * 30 AS capacity FROM tickets GROUP BY 1, 2, 3),
  m AS (SELECT arena_level, regr_slope(CASE WHEN y > 0 THEN ln(y) ELSE 0 END, days_out) AS b, regr_intercept(CASE WHEN y > 0 THEN ln(y) ELSE 0 END, days_out) AS a FROM h WHERE season < '1999-00' GROUP BY 1)
  SELECT arena_level, season, days_out::INT AS days_out, ROUND(LEAST(GREATEST(exp(a + b * days_out), 0), capacity), 6) AS predicted FROM h JOIN m USING (arena_level) WHERE season >= '1999-00'""")
def log_target(t):
    per = tickets(t).groupBy("arena_level", "season", "days_out").agg(
        F.sum("paid_seats").alias("y"), (F.count("*") * 30).cast("double").alias("capacity"))
    out = forecast_by_group(
        per.where("season < '1999-00'"), per.where("season >= '1999-00'"), ["arena_level"], ["days_out"], "y", log_target=True, capacity="capacity")
    return out.select("arena_level", "season", "days_out", F.round("predicted", 6).alias("predicted"))


@query("m20_curve_scale_up", f"""
  WITH {TICKETS}, d AS (SELECT date_trunc('month', event_date)::DATE AS ev, arena_level, days_out, SUM(paid_seats) AS v FROM tickets GROUP BY 1, 2, 3),
  c AS (SELECT *, SUM(v) OVER (PARTITION BY ev, arena_level ORDER BY days_out DESC ROWS UNBOUNDED PRECEDING) AS cum, SUM(v) OVER (PARTITION BY ev, arena_level) AS fin FROM d),
  u AS (SELECT arena_level, days_out, AVG(cum / NULLIF(fin, 0)) AS share FROM c WHERE ev < DATE '2000-07-01' GROUP BY 1, 2)
  SELECT ev, arena_level, MIN(days_out)::INT AS days_out, arg_min(cum, days_out)::BIGINT AS cumulative, ROUND(arg_min_null(cum / NULLIF(share, 0), days_out), 4) AS projected
  FROM c LEFT JOIN u USING (arena_level, days_out) WHERE ev >= DATE '2000-07-01' GROUP BY 1, 2""")
def curve_scale_up(t):
    tk = tickets(t).withColumn("ev", F.to_date(F.date_trunc("month", "event_date")))
    out = ops.scale_up_by_curve(tk, "ev", "arena_level", "days_out", "paid_seats", F.col("ev") >= F.lit("2000-07-01").cast("date"))
    return out.withColumn("projected", F.round("projected", 4))


RATES = f"""{LINE_TICKETS}, {GAMES}, rates AS (SELECT games.season, tier, SUM(CASE WHEN did_attend THEN paid_seats ELSE 0 END)::DOUBLE / NULLIF(SUM(paid_seats), 0) AS pr, SUM(CASE WHEN did_attend THEN comp_seats ELSE 0 END)::DOUBLE / NULLIF(SUM(comp_seats), 0) AS cr
    FROM line_tickets JOIN games USING (event_date) GROUP BY 1, 2),
  sold AS (SELECT event_date, tier, SUM(paid_seats)::BIGINT AS paid_seats, SUM(comp_seats)::BIGINT AS comp_seats FROM line_tickets JOIN games USING (event_date) WHERE event_date >= DATE '2000-07-01' GROUP BY 1, 2)"""


def daily_facts(t):
    """Tickets reduced to one row per event day and attendance flag, with the game's fields."""
    per = line_tickets(t).groupBy("event_date", "did_attend").agg(
        F.sum("paid_seats").alias("paid_seats"), F.sum("comp_seats").alias("comp_seats"), F.sum("gross_revenue").alias("gross_revenue"))
    return per.join(games(t), "event_date")


def sold_seats(t):
    return daily_facts(t).where(F.col("event_date") >= F.lit("2000-07-01").cast("date")).groupBy("event_date", "tier").agg(
        F.sum("paid_seats").alias("paid_seats"), F.sum("comp_seats").alias("comp_seats"))


@query("m21_turnstile", f"""
  WITH {RATES}, w AS (SELECT tier, SUM(pr * wt) / SUM(wt) AS wp, SUM(cr * wt) / SUM(wt) AS wc FROM (SELECT *, {WEIGHT_SQL} AS wt FROM rates WHERE season IN ('1997-98', '1998-99', '1999-00')) GROUP BY 1)
  SELECT event_date, tier, paid_seats, comp_seats, ROUND(wp, 8) AS weighted_paid_average, ROUND(wc, 8) AS weighted_comp_average, ROUND(paid_seats * wp, 4) AS predicted_turnstile FROM sold LEFT JOIN w USING (tier)""")
def turnstile(t):
    out = ops.turnstile(ops.show_rates_by(daily_facts(t), ["season", "tier"]), sold_seats(t), "tier", "season", WEIGHTS)
    return out.withColumns({"weighted_paid_average": F.round("weighted_paid_average", 8), "weighted_comp_average": F.round("weighted_comp_average", 8),
                            "predicted_turnstile": F.round("predicted_turnstile", 4)})


@query("m22_expected_attendance", f"""
  WITH {RATES}, r AS (SELECT tier, SUM(CASE WHEN did_attend THEN paid_seats ELSE 0 END)::DOUBLE / NULLIF(SUM(paid_seats), 0) AS pr, SUM(CASE WHEN did_attend THEN comp_seats ELSE 0 END)::DOUBLE / NULLIF(SUM(comp_seats), 0) AS cr
    FROM line_tickets JOIN games USING (event_date) GROUP BY 1)
  SELECT event_date, tier, ROUND(paid_seats * pr + comp_seats * cr, 4) AS predicted_attendance FROM sold LEFT JOIN r USING (tier)""")
def expected_attendance(t):
    out = ops.expected_attendance(sold_seats(t), ops.show_rates_by(daily_facts(t), ["tier"]), "tier")
    return out.select("event_date", "tier", F.round("predicted_attendance", 4).alias("predicted_attendance"))


CURVE = f"""{TICKETS}, {GAMES}, su AS (SELECT DISTINCT tier, event_date, sales_rep, days_out FROM tickets JOIN games USING (event_date) WHERE arena_level = 'Suites' AND NOT is_comp AND days_out BETWEEN 0 AND 57),
  ng AS (SELECT tier, COUNT(*) AS num_games FROM games GROUP BY 1), n AS (SELECT tier, days_out, COUNT(*) AS n FROM su GROUP BY 1, 2),
  curve AS (SELECT tier, d::INT AS days_out, COALESCE(n, 0) / num_games AS avg_sold, SUM(COALESCE(n, 0) / num_games) OVER (PARTITION BY tier ORDER BY d ROWS UNBOUNDED PRECEDING) AS cum
    FROM ng CROSS JOIN (SELECT unnest(generate_series(0, 57)) AS d) LEFT JOIN n ON n.tier = ng.tier AND n.days_out = d)"""
CURVE = CURVE.replace("SELECT tier, d::INT", "SELECT ng.tier, d::INT").replace("PARTITION BY tier ORDER BY d", "PARTITION BY ng.tier ORDER BY d")


def suite_curve(t):
    g = games(t).select("event_date", "tier")
    sold = tickets(t).where((F.col("arena_level") == "Suites") & ~F.col("is_comp") & F.col("days_out").between(0, 57)).select(
        "event_date", "sales_rep", "days_out").distinct().join(g, "event_date")
    return ops.sold_curve(sold, g, "tier", "event_date", "sales_rep", "days_out", 57)


@query("m23_suite_curve", f"WITH {CURVE} SELECT tier, days_out, ROUND(avg_sold, 8) AS avg_sold, ROUND(cum, 8) AS cumulative_avg_sold FROM curve")
def suite_sold_curve(t):
    return suite_curve(t).withColumns({"avg_sold": F.round("avg_sold", 8), "cumulative_avg_sold": F.round("cumulative_avg_sold", 8)})


STATUS = "CASE WHEN l_discount = 0.1 AND l_tax = 0 THEN 'COMP' WHEN l_quantity > 45 THEN 'SOLD' WHEN l_quantity > 25 THEN 'HELD' ELSE 'AVAIL' END"


@query("m23_sell_out", f"""
  WITH {CURVE}, st AS (SELECT CAST(l_shipdate AS DATE) AS event_date, l_suppkey, {STATUS} AS status FROM lineitem),
  best AS (SELECT event_date, l_suppkey, CASE MIN(CASE status WHEN 'COMP' THEN 0 WHEN 'SOLD' THEN 1 WHEN 'HELD' THEN 2 ELSE 3 END) WHEN 0 THEN 'COMP' WHEN 1 THEN 'SOLD' WHEN 2 THEN 'HELD' ELSE 'AVAIL' END AS status FROM st GROUP BY 1, 2),
  c AS (SELECT event_date, tier, (date_diff('day', DATE '1995-01-01', event_date) % 58)::INT AS days_out, COUNT(CASE WHEN status = 'COMP' THEN 1 END) AS num_comp, COUNT(CASE WHEN status = 'SOLD' THEN 1 END) AS num_sold,
    COUNT(CASE WHEN status = 'HELD' THEN 1 END) AS num_held, COUNT(CASE WHEN status = 'AVAIL' THEN 1 END) AS num_avail FROM best JOIN games USING (event_date) GROUP BY 1, 2, 3)
  SELECT c.*, COALESCE(num_avail <= cum * 100, FALSE) AS will_sell_out FROM c LEFT JOIN curve USING (tier, days_out)""")
def sell_out(t):
    status = s.first_match([((F.col("l_discount") == 0.1) & (F.col("l_tax") == 0), "COMP"), (F.col("l_quantity") > 45, "SOLD"), (F.col("l_quantity") > 25, "HELD")], "AVAIL")
    rows = t.lineitem.select(F.to_date("l_shipdate").alias("event_date"), "l_suppkey", status.alias("status"))
    best = strongest_status(rows, ["event_date", "l_suppkey"], "status", fixed.STATUS_ORDER).join(games(t).select("event_date", "tier"), "event_date")
    best = best.withColumn("days_out", s.days_between(F.lit("1995-01-01"), "event_date") % 58)
    # the stand-in curve is scaled up to the size of the stand-in inventory
    curve = suite_curve(t).withColumn("cumulative_avg_sold", F.col("cumulative_avg_sold") * 100)
    return ops.sell_out_flags(best, curve, "event_date", ["tier", "days_out"]).drop("avg_sold", "cumulative_avg_sold")


PARKING = f"""{LINE_TICKETS}, lots AS (SELECT event_date, arena_level AS lot, season, COUNT(*) AS passes, SUM(gross_revenue) AS rev, SUM(did_attend::INT) AS parked, MAX(CASE WHEN NOT is_comp THEN gross_revenue END) AS price, SUM(paid_seats) AS cars, COUNT(CASE WHEN is_comp THEN 1 END) AS gate FROM line_tickets GROUP BY 1, 2, 3),
  gm AS (SELECT lot, covar_pop(g, c) AS gc, covar_pop(g, w) AS gw, var_pop(c) AS cc, var_pop(w) AS ww, covar_pop(c, w) AS cw, AVG(g) AS mg, AVG(c) AS mc, AVG(w) AS mw
    FROM (SELECT lot, gate::DOUBLE AS g, 60.0::DOUBLE - parked AS c, (dayofweek(event_date) IN (0, 6))::INT::DOUBLE AS w FROM lots WHERE event_date < DATE '2000-07-01') GROUP BY 1),
  gb AS (SELECT lot, (gc * ww - gw * cw) / (cc * ww - cw * cw) AS b1, (gw * cc - gc * cw) / (cc * ww - cw * cw) AS b2, mg, mc, mw FROM gm),
  m AS (SELECT lot, regr_slope(cars, passes) AS b, regr_intercept(cars, passes) AS a, SUM(parked)::DOUBLE / SUM(passes) AS show_rate FROM lots WHERE event_date < DATE '2000-07-01' GROUP BY 1),
  p AS (SELECT event_date, lot, passes, rev, price, show_rate, a + b * passes AS pred, 60.0::DOUBLE AS capacity FROM lots JOIN m USING (lot) WHERE event_date >= DATE '2000-07-01'),
  q AS (SELECT *, GREATEST(pred, 0) AS add0, (passes + GREATEST(pred, 0)) * show_rate AS parked0 FROM p),
  z AS (SELECT *, LEAST(capacity - parked0, 0) AS ov FROM q),
  y AS (SELECT *, add0 + ov AS additional, parked0 + ov AS parked, CASE WHEN ov < 0 THEN 0 ELSE capacity - parked0 END AS capacity_remaining FROM z),
  x AS (SELECT *, LEAST(GREATEST(mg + b1 * (capacity_remaining - mc) + b2 * ((dayofweek(event_date) IN (0, 6))::INT - mw), 0), capacity_remaining) AS onsite, rev / passes AS realised, COALESCE(price / 0.75::DOUBLE, rev / passes / 0.75::DOUBLE) * 1.07::DOUBLE AS gate_gross FROM y JOIN gb USING (lot))"""


def parking(t):
    """Prepaid passes by lot, then gate cars by a fit of their own on what is left of the lot and the weekend."""
    lots = line_tickets(t).groupBy("event_date", F.col("arena_level").alias("lot")).agg(
        F.count("*").alias("passes"), F.sum("gross_revenue").alias("current_revenue"), F.sum(F.col("did_attend").cast("int")).alias("came"), F.sum("paid_seats").alias("cars"),
        F.count_if("is_comp").alias("gate")).withColumn("weekend", s.dow0("event_date").isin(0, 6).cast("int"))
    cut = F.lit("2000-07-01").cast("date")
    past, upcoming = lots.where(F.col("event_date") < cut), lots.where(F.col("event_date") >= cut)
    rates = past.groupBy("lot").agg(s.ratio(F.sum("came"), F.sum("passes")).alias("show_rate"))
    predicted = forecast_by_group(past, upcoming, ["lot"], ["passes"], "cars").join(rates, "lot")
    ready = predicted.select("event_date", "lot", "weekend", "current_revenue", "show_rate", F.col("passes").alias("current_prepaid_passes"), F.col("predicted").alias("additional"),
                             F.lit(60.0).alias("capacity"))
    gate = past.select("lot", "weekend", "gate", (F.lit(60.0) - F.col("came")).alias("capacity_remaining"))
    at_gate = forecast_by_group(gate, ops.prepaid_parking(ready), ["lot"], ["capacity_remaining", "weekend"], "gate")
    bounded = ops.onsite_parking(at_gate.withColumnRenamed("predicted", "predicted_onsite"))
    sales = line_tickets(t).select("event_date", F.col("arena_level").alias("lot"), "is_comp", "gross_revenue", F.col("gross_revenue").alias("price"))
    return ops.parking_revenue(bounded.join(ops.gate_prices(sales, ["event_date", "lot"]), ["event_date", "lot"], "left"))


@query("m24_parking", f"""
  WITH {PARKING} SELECT event_date, lot, ROUND(additional, 4) AS additional, ROUND(parked, 4) AS parked, ROUND(capacity_remaining, 4) AS capacity_remaining, ROUND(onsite, 4) AS onsite, ROUND(parked + onsite, 4) AS total_parked,
   ROUND(rev + COALESCE(price, realised) * additional + gate_gross * onsite, 2) AS expected_revenue FROM x""")
def parking_forecast(t):
    p = parking(t)
    return p.select("event_date", "lot", *[F.round(c, 4).alias(c) for c in ("additional", "parked", "capacity_remaining", "onsite", "total_parked")], F.round("expected_revenue", 2).alias("expected_revenue"))


@query("m25_gate_prices", f"""
  WITH {PARKING} SELECT event_date, lot, ROUND(price, 2) AS prepaid_price, ROUND(COALESCE(price / 0.75::DOUBLE, rev / passes / 0.75::DOUBLE), 5) AS gate_price, ROUND(COALESCE(price / 0.75::DOUBLE, rev / passes / 0.75::DOUBLE) * 1.07::DOUBLE, 5) AS gate_price_gross FROM lots""")
def gate_price_chain(t):
    sales = line_tickets(t).select("event_date", F.col("arena_level").alias("lot"), "is_comp", "gross_revenue", F.col("gross_revenue").alias("price"))
    out = ops.gate_prices(sales, ["event_date", "lot"])
    return out.select("event_date", "lot", F.round("prepaid_price", 2).alias("prepaid_price"), F.round("gate_price", 5).alias("gate_price"), F.round("gate_price_gross", 5).alias("gate_price_gross"))


@query("m26_per_caps", f"""
  WITH {LINE_TICKETS}, {GAMES}, a AS (SELECT event_date, SUM(gross_revenue) / NULLIF(COUNT(CASE WHEN did_attend THEN 1 END), 0) AS pc FROM line_tickets GROUP BY 1)
  SELECT tier, is_weekend, ROUND(AVG(pc), 4) AS per_cap, ROUND(AVG(pc) / 26.84::DOUBLE, 6) AS multiplier FROM a JOIN games USING (event_date) WHERE pc IS NOT NULL GROUP BY 1, 2""")
def per_cap_table(t):
    lt = line_tickets(t)
    crowd = lt.where("did_attend").groupBy("event_date").agg(F.count("*").alias("attendance"))
    out = ops.per_caps(lt.select("event_date", "gross_revenue"), crowd, games(t).select("event_date", "tier", "is_weekend"), "event_date", ["tier", "is_weekend"], fixed.FOOD_BASE_PER_CAP)
    return out.withColumns({"per_cap": F.round("per_cap", 4), "multiplier": F.round("multiplier", 6)})


@query("m27_projected_revenue", f"""
  WITH {TICKETS}, atp AS (SELECT season, arena_level, SUM(gross_revenue) / NULLIF(SUM(paid_seats), 0) AS atp FROM tickets WHERE season IN ('1997-98', '1998-99', '1999-00') GROUP BY 1, 2),
  w AS (SELECT arena_level, SUM(atp * wt) / SUM(wt) * 0.85::DOUBLE AS watp FROM (SELECT *, {WEIGHT_SQL} AS wt FROM atp) GROUP BY 1),
  cur AS (SELECT event_date, arena_level, SUM(gross_revenue) AS rev, COUNT(*) * 3 AS predicted FROM tickets WHERE season = '2000-01' GROUP BY 1, 2)
  SELECT event_date, arena_level, predicted, ROUND(watp, 4) AS weighted_atp, ROUND(rev, 2) AS current_revenue, CASE WHEN arena_level = 'Uppers' THEN 100.0 ELSE 0.0 END::DOUBLE AS additional_secondary,
   ROUND(predicted * watp + CASE WHEN arena_level = 'Uppers' THEN 100.0 ELSE 0.0 END + rev, 2) AS projected_gross_revenue FROM cur LEFT JOIN w USING (arena_level)""")
def revenue_projection(t):
    lt = line_tickets(t, "1997-98", "1999-00")
    now = line_tickets(t, "2000-01", "2000-01")
    predicted = now.groupBy("event_date", "arena_level").agg((F.count("*") * 3).alias("predicted"))
    extra = predicted.where("arena_level = 'Uppers'").select("event_date", "arena_level", F.lit(100.0).alias("additional_secondary"))
    out = ops.projected_revenue(predicted, lt, now, extra, ["arena_level"], "event_date", "season", WEIGHTS)
    return out.withColumns({"weighted_atp": F.round("weighted_atp", 4), "current_revenue": F.round("current_revenue", 2), "projected_gross_revenue": F.round("projected_gross_revenue", 2)})


TIER_SHARE = "CASE tier WHEN 'A' THEN 0.07 WHEN 'B' THEN 0.16 WHEN 'C' THEN 0.3 WHEN 'D' THEN 0.25 WHEN 'E' THEN 0.22 END::DOUBLE"
LEVEL_SHARE = "CASE arena_level WHEN 'Suites' THEN 0.1821 WHEN 'Clubs' THEN 0.0851 WHEN 'Uppers' THEN 0.0571 WHEN 'Premium' THEN 0.2509 WHEN 'Lowers' THEN 0.4247 END::DOUBLE"
PLANS = f"""{LINE_TICKETS}, {GAMES}, g AS (SELECT event_date, tier, date_diff('day', DATE '2000-06-30', event_date) AS d FROM games WHERE season = '2000-01'),
  plans AS (SELECT event_date, arena_level, tier, SUM(gross_revenue) AS gross_revenue, SUM(gross_revenue) / NULLIF(SUM(paid_seats), 0) AS atp FROM line_tickets JOIN g USING (event_date) WHERE ticket_type IN ('Full', 'Premier') GROUP BY 1, 2, 3),
  pf AS (SELECT event_date, SUM((gross_revenue + (900000000.0::DOUBLE - (SELECT SUM(gross_revenue) FROM plans)) * {TIER_SHARE} * share * {LEVEL_SHARE}) / NULLIF(atp, 0)) AS projected_tickets FROM plans JOIN (SELECT event_date, d / SUM(d) OVER (PARTITION BY tier) AS share FROM g) USING (event_date) GROUP BY 1)"""


def budget_plans(t):
    g = games(t).where("season = '2000-01'").select("event_date", "tier", s.days_between(F.lit("2000-06-30"), "event_date").alias("d"))
    plans = line_tickets(t, "2000-01", "2000-01").where(F.col("ticket_type").isin("Full", "Premier")).groupBy("event_date", "arena_level").agg(
        F.sum("gross_revenue").alias("gross_revenue"), s.ratio(F.sum("gross_revenue"), F.sum("paid_seats")).alias("current_atp"))
    out = ops.allocate_budget(plans.join(g.select("event_date", "tier"), "event_date"), g, F.lit(900000000.0), "d")
    return out.groupBy("event_date").agg(F.sum("projected_tickets").alias("projected_tickets"))


@query("m28_budget_allocation", f"WITH {PLANS} SELECT event_date, ROUND(projected_tickets, 4) AS projected_tickets FROM pf")
def budget_allocation(t):
    return budget_plans(t).withColumn("projected_tickets", F.round("projected_tickets", 4))


GROUPS = f"""gh AS (SELECT tier, arena_level, SUM(gross_revenue) / 41 AS rev, SUM(paid_seats) / 41 AS seats FROM line_tickets JOIN games USING (event_date) WHERE games.season <> '2000-01' AND ticket_type = 'Groups' GROUP BY 1, 2),
  gp AS (SELECT tier, arena_level, rev * (1 + 0.362147::DOUBLE * {LEVEL_SHARE} / CASE tier WHEN 'A' THEN 2 WHEN 'B' THEN 6 WHEN 'C' THEN 14 WHEN 'D' THEN 10 WHEN 'E' THEN 9 END) / (rev / seats) AS pt FROM gh)"""


def group_plans(t):
    per = line_tickets(t).where("ticket_type = 'Groups'").groupBy("event_date", "arena_level").agg(
        F.sum("gross_revenue").alias("gross_revenue"), F.sum("paid_seats").alias("paid_seats")).join(games(t), "event_date")
    growth = ops.group_growth(per.where("season <> '2000-01'")).select("tier", "arena_level", "projected_tickets")
    return per.where("season = '2000-01'").join(growth, ["tier", "arena_level"]).groupBy("event_date").agg(F.sum("projected_tickets").alias("projected_tickets"))


@query("m29_combined_forecast", f"""
  WITH {PLANS}, {GROUPS}, gg AS (SELECT event_date, SUM(pt) AS projected_tickets FROM (SELECT DISTINCT event_date, arena_level, tier FROM line_tickets JOIN g USING (event_date) WHERE ticket_type = 'Groups') JOIN gp USING (tier, arena_level) GROUP BY 1),
  sg AS (SELECT event_date, COUNT(*) * 1.1::DOUBLE AS projected_tickets FROM line_tickets WHERE ticket_type = 'Singles' AND season = '2000-01' GROUP BY 1),
  u AS (SELECT *, 'plans' AS ty FROM pf UNION ALL SELECT *, 'groups' FROM gg UNION ALL SELECT *, 'nightly' FROM sg)
  SELECT event_date, ROUND(SUM(projected_tickets), 4) AS projected_tickets, ROUND(SUM(CASE WHEN ty = 'plans' THEN projected_tickets END), 4) AS projected_tickets_plans,
   ROUND(SUM(CASE WHEN ty = 'groups' THEN projected_tickets END), 4) AS projected_tickets_groups, ROUND(SUM(CASE WHEN ty = 'nightly' THEN projected_tickets END), 4) AS projected_tickets_nightly FROM u GROUP BY 1""")
def combined_forecast(t):
    singles = line_tickets(t, "2000-01", "2000-01").where("ticket_type = 'Singles'").groupBy("event_date").agg(
        (F.count("*") * 1.1).alias("projected_tickets"))
    out = ops.combine_forecasts({"plans": budget_plans(t), "groups": group_plans(t), "nightly": singles}, "event_date", "projected_tickets")
    return out.select("event_date", *[F.round(c, 4).alias(c) for c in out.columns[1:]])


@query("m30_type_simulation", """
  WITH seats AS (SELECT o_orderpriority AS ev, CASE WHEN o_orderstatus = 'F' THEN 'Plans' WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'Nightly' ELSE 'Not Sold' END AS grp,
    CASE WHEN o_orderkey % 3 = 0 THEN 'Plans' WHEN o_orderkey % 3 = 1 THEN 'Nightly' ELSE 'Not Sold' END AS predicted, o_totalprice AS score FROM orders),
  cur AS (SELECT ev, grp, COUNT(*) AS n FROM seats WHERE grp <> 'Not Sold' GROUP BY 1, 2), q AS (SELECT ev, floor(n * 0.2) AS k FROM cur WHERE grp = 'Plans'),
  r AS (SELECT *, RANK() OVER (PARTITION BY ev ORDER BY score DESC) + (COUNT(*) OVER (PARTITION BY ev, score) - 1) / 2.0 AS rk FROM seats WHERE grp = 'Not Sold'),
  ad AS (SELECT r.ev, CASE WHEN predicted = 'Plans' AND rk <= COALESCE(k, 0) THEN 'Plans' WHEN predicted = 'Nightly' THEN 'Nightly' ELSE 'Not Sold' END AS grp, COUNT(*) AS n FROM r LEFT JOIN q ON q.ev = r.ev GROUP BY 1, 2)
  SELECT COALESCE(cur.ev, ad.ev) AS ev, COALESCE(cur.grp, ad.grp) AS ticket_type_group, cur.n::DOUBLE AS current_tickets, ad.n::DOUBLE AS predicted_additional_tickets FROM cur FULL JOIN ad ON cur.ev = ad.ev AND cur.grp = ad.grp""")
def type_simulation(t):
    odd = F.col("o_orderkey") % 3
    seats = t.orders.select(
        F.col("o_orderpriority").alias("ev"), F.col("o_totalprice").alias("score"),
        s.first_match([(F.col("o_orderstatus") == "F", "Plans"), ((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 2 == 0), "Nightly")], "Not Sold").alias("ticket_type_group"),
        s.first_match([(odd == 0, "Plans"), (odd == 1, "Nightly")], "Not Sold").alias("predicted"))
    out = ops.simulate_types(seats, "ev", F.lit(0.2), "score", even_buckets(seats, F.col("score")))
    return out.withColumns({c: F.col(c).cast("double") for c in ("current_tickets", "predicted_additional_tickets")})


GAME_LOG = """gl AS (SELECT l_suppkey % 20 AS team, CAST(l_shipdate AS DATE) AS day, SUM(l_quantity) AS pts, MIN(l_partkey % 25) AS opponent, MIN(l_linenumber) % 2 AS away FROM lineitem GROUP BY 1, 2),
  ft AS (SELECT *, COUNT(*) OVER (PARTITION BY team ORDER BY day RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND INTERVAL 3 DAY FOLLOWING) AS density, CASE WHEN LAG(day) OVER w = day - 1 THEN 2 WHEN LEAD(day) OVER w = day + 1 THEN 1 ELSE 0 END AS back_to_back,
    AVG(pts) OVER (PARTITION BY team ORDER BY day ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS last_3, CASE WHEN away = 1 THEN opponent ELSE team END AS loc, CASE WHEN LAG(away) OVER w = 1 THEN LAG(opponent) OVER w ELSE team END AS prev_loc FROM gl WINDOW w AS (PARTITION BY team ORDER BY day))"""


def win_features(t):
    """One row per team and day: density, back-to-back, form, and the distance travelled."""
    gl = t.lineitem.groupBy((F.col("l_suppkey") % 20).alias("team"), F.to_date("l_shipdate").alias("day")).agg(
        F.sum("l_quantity").alias("pts"), F.min(F.col("l_partkey") % 25).alias("opponent"), (F.min("l_linenumber") % 2).alias("away"))
    near = windows.day_density(gl, ["team"], "day").select("team", "day", "density", F.when(F.col("days_before") == 1, 2).when(F.col("days_after") == 1, 1).otherwise(0).alias("back_to_back"))
    form = windows.trailing_mean(gl, ["team"], ["day"], "pts", 3, "last_3")
    w = Window.partitionBy("team").orderBy("day")
    place = F.when(F.col("away") == 1, F.col("opponent")).otherwise(F.col("team"))
    placed = form.withColumn("loc", place).withColumn("prev_loc", F.coalesce(F.lag("loc").over(w), F.col("team")))
    return placed.join(near, ["team", "day"]).withColumn("distance", F.abs(F.col("loc") - F.col("prev_loc")) * 100)


@query("m31_win_features", f"""
  WITH {GAME_LOG} SELECT team, day, density, back_to_back, ROUND(last_3, 6) AS last_3, loc, prev_loc, abs(loc - prev_loc) * 100 AS distance FROM ft""")
def win_feature_table(t):
    return win_features(t).select("team", "day", "density", "back_to_back", F.round("last_3", 6).alias("last_3"), "loc", "prev_loc", "distance")


@query("m32_gameday", f"""
  WITH {RATES}, r AS (SELECT tier, SUM(CASE WHEN did_attend THEN paid_seats ELSE 0 END)::DOUBLE / NULLIF(SUM(paid_seats), 0) AS pr, SUM(CASE WHEN did_attend THEN comp_seats ELSE 0 END)::DOUBLE / NULLIF(SUM(comp_seats), 0) AS cr FROM line_tickets JOIN games USING (event_date) GROUP BY 1),
  a AS (SELECT event_date, tier, paid_seats * pr + comp_seats * cr AS att FROM sold LEFT JOIN r USING (tier)),
  pc AS (SELECT tier, is_weekend, AVG(pc) AS pc, AVG(mc) AS mc FROM (SELECT event_date, SUM(gross_revenue) / NULLIF(COUNT(CASE WHEN did_attend THEN 1 END), 0) AS pc,
     SUM(CASE WHEN arena_level = 'Premium' THEN gross_revenue ELSE 0 END) / NULLIF(COUNT(CASE WHEN did_attend THEN 1 END), 0) AS mc FROM line_tickets GROUP BY 1) JOIN games USING (event_date) WHERE pc IS NOT NULL GROUP BY 1, 2),
  pk AS (SELECT tier, regr_slope(cars, att) AS b, regr_intercept(cars, att) AS i FROM (SELECT event_date, COUNT(CASE WHEN arena_level = 'Suites' THEN 1 END) AS cars, SUM(CASE WHEN did_attend THEN paid_seats + comp_seats ELSE 0 END) AS att FROM line_tickets WHERE event_date < DATE '2000-07-01' GROUP BY 1) JOIN games USING (event_date) GROUP BY 1),
  rv AS (SELECT event_date, SUM(gross_revenue) AS rev FROM line_tickets GROUP BY 1)
  SELECT event_date, tier, ROUND(rev, 2) AS gross_revenue, ROUND(att, 4) AS predicted_attendance, ROUND(GREATEST(i + b * att, 0), 4) AS predicted_parking, ROUND(GREATEST(i + b * att, 0) * 42.8::DOUBLE, 4) AS predicted_parking_revenue, ROUND(att * pc, 2) AS predicted_fandb, ROUND(att * mc, 2) AS predicted_merch,
   ROUND(900000000.0::DOUBLE * {TIER_SHARE} / CASE tier WHEN 'A' THEN 2 WHEN 'B' THEN 6 WHEN 'C' THEN 14 WHEN 'D' THEN 10 WHEN 'E' THEN 9 END, 2) AS budget_goal
  FROM a JOIN games USING (event_date, tier) JOIN pc USING (tier, is_weekend) JOIN pk USING (tier) JOIN rv USING (event_date)""")
def gameday(t):
    lt = line_tickets(t)
    attendance = ops.expected_attendance(sold_seats(t), ops.show_rates_by(daily_facts(t), ["tier"]), "tier").select("event_date", "tier", F.col("predicted_attendance").alias("att"))
    # crowd, spend, cars and revenue of a day come from one pass over the fact
    per_day = lt.groupBy("event_date").agg(
        F.count_if("did_attend").alias("attendance"), F.sum("gross_revenue").alias("rev"),
        F.sum(F.when(F.col("arena_level") == "Premium", F.col("gross_revenue")).otherwise(0.0)).alias("merch"),
        F.count_if(F.col("arena_level") == "Suites").alias("cars"), F.sum(F.when(F.col("did_attend"), F.col("paid_seats") + F.col("comp_seats")).otherwise(0)).alias("att"))
    crowd, by = per_day.where("attendance > 0").select("event_date", "attendance"), ["tier", "is_weekend"]
    calendar = games(t).select("event_date", *by)
    caps = ops.per_caps(per_day.select("event_date", F.col("rev").alias("gross_revenue")), crowd, calendar, "event_date", by, fixed.FOOD_BASE_PER_CAP).select(
        *by, F.col("per_cap").alias("food"))
    goods = ops.per_caps(per_day.select("event_date", F.col("merch").alias("gross_revenue")), crowd, calendar, "event_date", by, fixed.MERCH_BASE_PER_CAP).select(
        *by, F.col("per_cap").alias("goods"))
    past = per_day.where(F.col("event_date") < F.lit("2000-07-01").cast("date")).select("event_date", "cars", "att")
    parked = forecast_by_group(past.join(games(t).select("event_date", "tier"), "event_date"), attendance, ["tier"], ["att"], "cars").withColumn(
        "predicted", F.greatest("predicted", F.lit(0.0)))
    out = parked.join(games(t).select("event_date", "is_weekend"), "event_date").join(caps, by).join(goods, by).join(per_day.select("event_date", "rev"), "event_date")
    goal = 900000000.0 * s.lookup("tier", fixed.REVENUE_SHARE_PER_TIER) / s.lookup("tier", fixed.GAMES_PER_TIER)
    return out.select("event_date", "tier", F.round("rev", 2).alias("gross_revenue"), F.round("att", 4).alias("predicted_attendance"), F.round("predicted", 4).alias("predicted_parking"),
                      F.round(F.col("predicted") * fixed.PARKING_AVERAGE_PRICE, 4).alias("predicted_parking_revenue"), F.round(F.col("att") * F.col("food"), 2).alias("predicted_fandb"),
                      F.round(F.col("att") * F.col("goods"), 2).alias("predicted_merch"), F.round(goal, 2).alias("budget_goal"))


@query("m33_stitched", f"""
  WITH {LINE_TICKETS}, {GAMES}, p AS (SELECT event_date, season, SUM(gross_revenue) AS r, COUNT(*) AS n FROM line_tickets GROUP BY 1, 2), m AS (SELECT regr_slope(r, n) AS b, regr_intercept(r, n) AS a FROM p WHERE event_date < DATE '2001-01-01')
  SELECT event_date, season, n, ROUND(r, 2) AS current_gross_revenue, NULL::DOUBLE AS predicted_gross_revenue FROM p WHERE event_date < DATE '2001-01-01' AND season = '2000-01'
  UNION ALL SELECT event_date, season, n, NULL, ROUND(a + b * n, 2) FROM p, m WHERE event_date >= DATE '2001-01-01' AND season = '2000-01'""")
def stitched(t):
    per = line_tickets(t).groupBy("event_date", "season").agg(F.sum("gross_revenue").alias("gross_revenue"), F.count("*").alias("n"))
    cut = F.lit("2001-01-01").cast("date")
    past, upcoming = per.where(F.col("event_date") < cut), per.where(F.col("event_date") >= cut).drop("gross_revenue")
    forecast = forecast_by_group(past, upcoming, [], ["n"], "gross_revenue")
    out = ops.stitch(past, forecast, "2000-01", {"gross_revenue": "current_gross_revenue", "predicted": "predicted_gross_revenue"})
    return out.withColumns({c: F.round(c, 2) for c in ("current_gross_revenue", "predicted_gross_revenue")})
