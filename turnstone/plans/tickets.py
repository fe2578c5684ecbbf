"""Tickets, seats and money."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnstone.functions import fixed_values as fixed
from turnstone.functions import scalars as s
from turnstone.operators import seats
from turnstone.operators import tickets as ops
from turnstone.registry import query
from turnstone.sources.views import BLOCKS, GAMES, LINE_TICKETS, TICKETS, blocks, games, line_tickets, tickets

ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
ID_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def in_list(groups):
    """The lists of a label table as a SQL CASE, for the SQL twins."""
    arms = " ".join(
        "WHEN pc_one IN (" + ", ".join(f"'{c}'" for c in codes) + f") THEN '{label.replace(chr(39), chr(39) * 2)}'"
        for label, codes in groups.items())
    return f"CASE {arms} ELSE 'Other' END"


@query("d1_explode_blocks", f"""
  WITH {BLOCKS} SELECT section_name, seat, COUNT(*) AS seats_sold, ROUND(SUM(block_purchase_price / num_seats), 5) AS price, ROUND(SUM(paid_amount / total_events / num_seats), 3) AS paid
  FROM (SELECT *, unnest(generate_series(seat_num, seat_num + num_seats - 1))::INT AS seat FROM blocks) GROUP BY 1, 2""")
def explode_blocks(t):
    return seats.explode_blocks(blocks(t)).groupBy("section_name", "seat").agg(
        F.count("*").alias("seats_sold"), F.round(F.sum("block_purchase_price"), 5).alias("price"),
        F.round(F.sum("paid_amount"), 3).alias("paid"))


@query("d2_price_code_parts", f"""
  WITH {BLOCKS} SELECT {ID_SQL}, pc_one, pc_two, pc_three, pc_four, pc_one || pc_two AS pc_one_two, pc_two || pc_three AS pc_two_three,
  pc_three || pc_four AS pc_three_four, pc_two || pc_three || pc_four AS pc_two_three_four FROM blocks""")
def price_code_parts(t):
    out = seats.price_code_parts(blocks(t))
    return out.select(*ID, *[c for c in out.columns if c.startswith("pc_")])


@query("d3_places", f"""
  WITH {BLOCKS} SELECT {ID_SQL}, {in_list(fixed.LOCATION_GENERAL)} AS location_general, {in_list(fixed.LOCATION_SPECIFIC)} AS location_specific,
  {in_list(fixed.LOCATION_EVENTS)} AS location_events, {in_list(fixed.LOCATION_EVENTS_GENERAL)} AS location_events_general,
  {in_list(fixed.ARENA_LEVEL)} AS arena_level, {in_list(fixed.ARENA_LEVEL_INTERNAL)} AS arena_level_internal,
  replace({in_list(fixed.LOCATION_GENERAL)}, 'General', 'Bowl') AS hrr_location FROM blocks""")
def places(t):
    return blocks(t).transform(seats.price_code_parts).transform(seats.places).select(*ID, *seats.PLACES, "hrr_location")


@query("d4_level_by_code", f"""
  WITH {BLOCKS} SELECT {in_list(fixed.ARENA_LEVEL_INTERNAL)} AS arena_level_internal, COUNT(*) AS blocks, ROUND(SUM(block_purchase_price), 2) AS gross_revenue FROM blocks GROUP BY 1""")
def level_by_code(t):
    level = s.label_of(F.left("price_code", F.lit(1)), fixed.ARENA_LEVEL_INTERNAL, "Other")
    return blocks(t).groupBy(level.alias("arena_level_internal")).agg(
        F.count("*").alias("blocks"), F.round(F.sum("block_purchase_price"), 2).alias("gross_revenue"))


# The SQL twins state the rules first-match-first, i.e. in reverse order.
LABELS = BLOCKS + f""", p AS (
  SELECT *, CASE WHEN pc_two = 'F' THEN 'Full' WHEN pc_two IN ('A','B','H') THEN 'Half' WHEN pc_two = 'P' THEN 'Premier'
     WHEN pc_two IN ('I','*','') THEN 'Singles' WHEN pc_two = 'X' THEN 'Flex' WHEN pc_two = 'G' THEN 'Groups' ELSE 'Unknown' END AS plan_type,
     {in_list(fixed.LOCATION_GENERAL)} AS location_general, {in_list(fixed.LOCATION_EVENTS_GENERAL)} AS location_events_general,
     pc_two || pc_three IN ('FD', 'GD') AND pc_one NOT IN ('U','V','W') AS is_logitix,
     acct_rep_full_name = 'Sponsor' AS is_sponsor, contains(acct_rep_full_name, 'Trade') AS is_trade,
     pc_three = 'R' AND pc_two || pc_three <> 'GR' AS is_renewal,
     lower(price_code_desc) LIKE '%inclusive%' OR price_code_group = 'AI' AS is_all_inclusive FROM blocks),
  a AS (SELECT *, CASE WHEN is_sponsor OR is_trade THEN 'Sponsor' WHEN is_logitix THEN 'Broker' ELSE 'Standard' END AS account_type,
     pc_three || pc_four = 'RU' AND location_general <> 'Suites' AS is_upgrade FROM p),
  y AS (SELECT *, CASE
     WHEN NOT is_trade AND account_type = 'Broker' THEN 'Secondary'
     WHEN plan_type IN ('Singles','Groups','Flex') AND account_type <> 'Broker' AND pc_one || pc_two = 'YI' AND NOT is_trade THEN 'Nightly Suites'
     WHEN plan_type IN ('Singles','Groups','Flex') AND account_type <> 'Broker' AND location_general = 'Suites' AND NOT is_trade THEN 'Nightly Suites'
     WHEN plan_type = 'Singles' AND account_type <> 'Broker' AND location_general <> 'Suites' AND NOT is_trade THEN 'Singles'
     WHEN plan_type = 'Groups' AND account_type <> 'Broker' AND location_general <> 'Suites' AND NOT is_trade THEN 'Groups'
     WHEN is_trade THEN 'Trade'
     WHEN plan_type IN ('Full','Flex','Premier') AND account_type = 'Sponsor' AND location_general <> 'Suites' THEN 'Sponsor'
     WHEN plan_type IN ('Full','Premier') AND location_general = 'Suites' THEN 'Annual Suites'
     WHEN plan_type = 'Premier' AND account_type = 'Standard' AND location_general <> 'Suites' THEN 'Premier'
     WHEN plan_type = 'Flex' AND account_type = 'Standard' AND location_general <> 'Suites' THEN 'Flex'
     WHEN plan_type = 'Full' AND account_type = 'Standard' AND location_general <> 'Suites' THEN 'Full'
     ELSE 'Unknown' END AS ticket_type FROM a)"""


@query("d5_plan_types", f"""
  WITH {LABELS} SELECT {ID_SQL}, plan_type,
   CASE WHEN pc_two IN ('*','I') THEN 'Singles' WHEN account_type = 'Broker' THEN 'Secondary' WHEN plan_type = 'Full' AND NOT is_renewal THEN 'New Business Strips'
        WHEN plan_type = 'Full' AND pc_four = 'A' THEN 'Add-on Strips' WHEN plan_type = 'Full' THEN 'Renewal Strips' ELSE 'Unknown' END AS ticket_type_playoffs,
   CASE WHEN plan_type = 'Singles' THEN 'Singles' WHEN plan_type = 'Groups' THEN 'Groups' WHEN is_all_inclusive THEN 'All-Inclusive' ELSE 'Plans' END AS hrr_plan_type FROM y""")
def plan_types(t):
    return seats.classified(blocks(t)).select(*ID, "plan_type", "ticket_type_playoffs", "hrr_plan_type")


@query("d6_accounts", f"""
  WITH {LABELS} SELECT {ID_SQL}, is_logitix, pc_four = 'L' OR pc_two || pc_three = 'GL' AS is_logitix_playoffs, is_sponsor, is_trade, account_type,
   CASE WHEN regexp_matches(acct_type_desc, 'Sponsor|Business|Broker|Community|Suite|Marketing|PR|Trade|Box Office') THEN 'Corporate' ELSE 'Personal' END AS acct_type_desc_group,
   CASE acct_type_desc WHEN 'Sponsor' THEN 'Sponsor' WHEN 'Sponsor Trade' THEN 'Sponsor Trade' WHEN 'Trade-Sponsor' THEN 'Sponsor Trade' WHEN 'Marketing Trade' THEN 'Marketing Trade'
     WHEN 'Trade-Marketing' THEN 'Marketing Trade' WHEN 'Trade' THEN 'Trade' ELSE 'Standard' END AS hrr_account_type FROM y""")
def accounts(t):
    return seats.classified(blocks(t)).select(
        *ID, "is_logitix", "is_logitix_playoffs", "is_sponsor", "is_trade", "account_type", "acct_type_desc_group", "hrr_account_type")


@query("d7_ticket_type", f"WITH {LABELS} SELECT {ID_SQL}, ticket_type FROM y")
def ticket_type(t):
    return seats.classified(blocks(t)).select(*ID, "ticket_type")


@query("d8_flags", f"""
  WITH {LABELS} SELECT {ID_SQL}, is_renewal, is_upgrade, CASE WHEN is_upgrade THEN 'Upgrade' WHEN is_renewal THEN 'Renewal' ELSE 'New Business' END AS is_renewal_and_upgrade_text,
   pc_two = '*' AS is_host, is_all_inclusive, contains(row_name, 'GA') OR contains(row_name, 'SRO') AS is_sro, pc_one IN ('U','V','W','X','Z','1','2') AS is_premium FROM y""")
def flags(t):
    return seats.classified(blocks(t)).select(
        *ID, "is_renewal", "is_upgrade", "is_renewal_and_upgrade_text", "is_host", "is_all_inclusive", "is_sro", "is_premium")


@query("d9_seat_counts", f"""
  WITH {LABELS} SELECT ticket_type, SUM(CASE WHEN block_purchase_price = 0 THEN 0 ELSE num_seats END)::BIGINT AS paid_seats,
   SUM(CASE WHEN block_purchase_price = 0 THEN num_seats ELSE 0 END)::BIGINT AS comp_seats, SUM(num_seats)::BIGINT AS total_seats,
   ROUND(SUM(CASE WHEN ticket_type NOT IN ('Singles','Nightly Suites','Groups','Flex') AND pc_two || pc_three <> 'GD' AND block_purchase_price <> 0 THEN num_seats / 42.0::DOUBLE ELSE 0 END), 6) AS fse
  FROM y GROUP BY 1""")
def seat_counts(t):
    out = seats.seat_counts(seats.explode_blocks(seats.classified(blocks(t))))
    return out.groupBy("ticket_type").agg(
        *[F.sum(c).alias(c) for c in ("paid_seats", "comp_seats", "total_seats")], F.round(F.sum("fse_calc"), 6).alias("fse"))


@query("d9_plan_equivalents", f"""
  WITH {BLOCKS} SELECT {ID_SQL}, CASE WHEN block_purchase_price = 0 THEN 0.0 WHEN tier = 'A' THEN 1.0 WHEN tier = 'B' THEN ROUND(25 / 42.0::DOUBLE, 8) ELSE 0.0 END::DOUBLE AS fse FROM blocks""")
def plan_equivalents(t):
    b = blocks(t).withColumns({"is_comp": F.col("block_purchase_price") == 0, "kind": F.right("event_name", F.lit(1))})
    return b.select(*ID, F.round(seats.plan_equivalents("kind", "A", "B"), 8).alias("fse"))


@query("d10_money", f"""
  WITH {BLOCKS}, m AS (SELECT *, CASE WHEN block_purchase_price = 0 THEN 0 WHEN pc_one = 'Z' THEN 25 WHEN pc_one = 'Y' THEN 15 WHEN pc_one = 'X' THEN 35 ELSE 0 END AS food_fee,
    CASE WHEN block_purchase_price = 0 OR pc_three = 'N' THEN 0 WHEN pc_one = 'Z' THEN 25 WHEN pc_one = 'X' THEN 35 ELSE 0 END AS event_food_fee, l_partkey * 1.0::DOUBLE AS pc_ticket, 2.5::DOUBLE AS pc_licfee, 1.5::DOUBLE AS surchg_amount FROM blocks),
  n AS (SELECT *, (block_purchase_price - food_fee) / 1.07::DOUBLE AS net FROM m)
  SELECT {ID_SQL}, food_fee, event_food_fee, ROUND(net, 4) AS net_revenue, ROUND((block_purchase_price * 0.93::DOUBLE - food_fee) / 1.07::DOUBLE, 4) AS net_revenue_resale,
    ROUND(CASE WHEN pc_two = '*' THEN net ELSE (pc_ticket + pc_licfee + surchg_amount) / 1.07::DOUBLE END, 4) AS net_revenue_2223,
    ROUND(CASE WHEN pc_two = '*' THEN net ELSE pc_ticket + pc_licfee + surchg_amount END, 4) AS net_revenue_2324,
    ROUND(net * 1.07::DOUBLE - net, 4) AS total_tax, ROUND(net * percent_paid, 4) AS commissionable_amount,
    ROUND(net + CASE WHEN l_partkey % 3 = 0 THEN num_seats * 5 ELSE 0 END, 4) AS refunded FROM n""")
def money(t):
    b = blocks(t).withColumns({
        "pc_ticket": F.col("l_partkey").cast("double"), "pc_licfee": F.lit(2.5), "surchg_amount": F.lit(1.5),
        "retail_ticket_type": F.when(F.col("l_partkey") % 3 == 0, "J-TYPE").otherwise("A-TYPE")})
    out = seats.money(seats.classified(b)).withColumn("refunded", seats.parking_refund("net_revenue", "num_seats", "retail_ticket_type"))
    numbers = ["net_revenue", "net_revenue_resale", "net_revenue_2223", "net_revenue_2324", "total_tax", "commissionable_amount", "refunded"]
    return out.select(*ID, "food_fee", "event_food_fee", *[F.round(c, 4).alias(c) for c in numbers])


COMMISSION_SQL = """
  CASE WHEN price_code = 'YI' AND rep_department <> 'Premium' THEN 'Hockey Nightly Stable|0.05' WHEN price_code = 'YI' THEN 'Hockey Nightly Stable - Premium|0.1'
   WHEN ticket_type = 'Nightly Suites' AND rep_department <> 'Premium' THEN 'Hockey Nightly Suites|0.05' WHEN ticket_type = 'Nightly Suites' THEN 'Hockey Nightly Suites - Premium|0.1'
   WHEN ticket_type = 'Flex' AND location_general <> 'Suites' THEN 'Flex|0.04'
   WHEN ticket_type = 'Groups' AND pc_one IN ('1','2','X','Z') AND rep_department = 'Premium' THEN 'Hockey Premium Group|0.1'
   WHEN ticket_type = 'Groups' AND tier = 'A' THEN 'Hockey A Tier Group|0.04'
   WHEN ticket_type = 'Groups' AND tier IN ('B','C') AND rep_department = 'Premium' THEN 'Hockey B, C Tier Group - Premium|0.04'
   WHEN ticket_type = 'Groups' AND tier IN ('B','C') THEN 'Hockey B, C Tier Group|0.06' WHEN ticket_type = 'Groups' AND tier IN ('D','E') THEN 'Hockey D, E Tier Group|0.1'
   WHEN ticket_type = 'Full' AND is_upgrade AND rep_department IN ('New Business','Groups') THEN 'Bowl Premier Plus Upgrade|0.1'
   WHEN ticket_type = 'Full' AND is_upgrade AND rep_sales_service = 'Service' THEN 'Bowl Premier Plus Upgrade|0.05'
   WHEN ticket_type IN ('Full','Premier') AND is_renewal AND location_general <> 'Suites' AND rep_sales_service = 'Sales' THEN 'Bowl ' || nm || ' Renewal|0.1'
   WHEN ticket_type IN ('Full','Premier') AND is_renewal AND location_general <> 'Suites' AND rep_department = 'Premium' AND rep_sales_service = 'Service' THEN 'Bowl ' || nm || ' Renewal|0.01'
   WHEN ticket_type IN ('Full','Premier') AND is_renewal AND location_general <> 'Suites' AND rep_department = 'Membership' AND rep_sales_service = 'Service' THEN 'Bowl ' || nm || ' Renewal|0.014'
   WHEN ticket_type IN ('Full','Premier') AND NOT is_renewal AND (location_general = 'Corona' OR pc_one IN ('1','2')) AND rep_department = 'Premium' AND rep_sales_service = 'Sales' THEN 'Premium Sales ' || nm || ' New|0.12'
   WHEN ticket_type IN ('Full','Premier') AND NOT is_renewal AND location_general <> 'Suites' THEN 'Bowl ' || nm || ' New|0.1' ELSE 'Unknown|0.0' END"""


@query("d11_commissions", f"""
  WITH {LABELS}, c AS (SELECT *, {COMMISSION_SQL} AS c FROM (SELECT *, CASE ticket_type WHEN 'Full' THEN 'Premier Plus' ELSE 'Premier' END AS nm FROM y)),
  e AS (SELECT *, split_part(c, '|', 1) AS commission_type, split_part(c, '|', 2)::DOUBLE * CASE WHEN ticket_type = 'Groups' AND add_date BETWEEN DATE '2000-10-03' AND DATE '2000-10-14'
      AND event_name IN ('22H1006E','22H1019C','22H1023D') THEN 2 ELSE 1 END AS rate,
      CASE WHEN block_purchase_price = 0 THEN 0 WHEN pc_one = 'Z' THEN 25 WHEN pc_one = 'Y' THEN 15 WHEN pc_one = 'X' THEN 35 ELSE 0 END AS fee FROM c)
  SELECT {ID_SQL}, commission_type, ROUND(rate, 6) AS commission_rate, ROUND((block_purchase_price - fee) / 1.07::DOUBLE * percent_paid * rate, 4) AS rep_commissions FROM e""")
def commissions(t):
    # the bonus window is years after the driver dates; it is shifted onto them
    shifted = seats.classified(blocks(t).withColumn("tier", F.right("event_name", F.lit(1)))).transform(seats.money)
    moved = shifted.withColumn("add_date", F.add_months("add_date", 264))
    out = seats.commissions(moved)
    return out.select(*ID, "commission_type", F.round("commission_rate", 6).alias("commission_rate"), F.round("rep_commissions", 4).alias("rep_commissions"))


@query("d11_event_commissions", f"""
  WITH {LABELS} SELECT {ID_SQL}, CASE WHEN location_events_general = 'Suites' THEN 'Single Event Suites' WHEN location_events_general IN ('ENN''s','Clubs') THEN 'Single Event Clubs and ENN'
   WHEN pc_two = 'G' THEN 'Single Event Groups' ELSE 'Unknown' END AS commission_type,
   CASE WHEN location_events_general = 'Suites' THEN 0.08 WHEN location_events_general IN ('ENN''s','Clubs') THEN 0.04 WHEN pc_two = 'G' AND rep_department = 'Events' THEN 0.08 WHEN pc_two = 'G' THEN 0.04 ELSE 0.0 END::DOUBLE AS commission_rate FROM y""")
def event_commissions(t):
    out = seats.commissions(seats.classified(blocks(t)), seats.EVENT_COMMISSIONS, doubled=False)
    return out.select(*ID, "commission_type", "commission_rate")


@query("d12_season_of_date", """
  SELECT o_orderkey, CASE WHEN month(o_orderdate) < 7 THEN (year(o_orderdate) - 1)::VARCHAR || '-' || right(year(o_orderdate)::VARCHAR, 2) ELSE year(o_orderdate)::VARCHAR || '-' || right((year(o_orderdate) + 1)::VARCHAR, 2) END AS season,
   CASE WHEN month(o_orderdate) < 9 THEN (year(o_orderdate) - 1)::VARCHAR || '-' || right(year(o_orderdate)::VARCHAR, 2) ELSE year(o_orderdate)::VARCHAR || '-' || right((year(o_orderdate) + 1)::VARCHAR, 2) END AS program_season FROM orders""")
def season_of_date(t):
    return t.orders.select("o_orderkey", s.season_of("o_orderdate", 7).alias("season"), s.season_of("o_orderdate", 9).alias("program_season"))


STARTS = {"1996-97": "1996-02-05", "1997-98": "1997-02-11", "1998-99": "1998-02-05", "1999-00": "1999-03-01"}


@query("d13_day_in_cycle", f"""
  WITH {TICKETS} SELECT l_orderkey, l_linenumber, date_diff('day', CASE season WHEN '1996-97' THEN DATE '1996-02-05' WHEN '1997-98' THEN DATE '1997-02-11' WHEN '1998-99' THEN DATE '1998-02-05'
   WHEN '1999-00' THEN DATE '1999-03-01' END, transaction_date)::DOUBLE AS days_in_sales_cycle FROM tickets""")
def day_in_cycle(t):
    out = ops.days_in_sales_cycle(tickets(t), STARTS)
    return out.select("l_orderkey", "l_linenumber", F.col("days_in_sales_cycle").cast("double").alias("days_in_sales_cycle"))


@query("d14_seat_ids", f"""
  WITH {BLOCKS} SELECT section_name || '-' || row_name || '-' || seat::VARCHAR AS seat_id, event_name || '-' || section_name || '-' || row_name || '-' || seat::VARCHAR AS seat_event_id, COUNT(*) AS n
  FROM (SELECT *, unnest(generate_series(seat_num, seat_num + num_seats - 1)) AS seat FROM blocks) GROUP BY 1, 2""")
def seat_ids(t):
    return seats.seat_ids(seats.explode_blocks(blocks(t))).groupBy("seat_id", "seat_event_id").agg(F.count("*").alias("n"))


@query("d15_event_state", f"""
  WITH {BLOCKS} SELECT {ID_SQL}, tier, date_diff('day', add_date, event_date)::INT AS days_out_from_event, event_date < DATE '1999-06-15' AS is_game_over FROM blocks""")
def event_state(t):
    return seats.event_state(blocks(t), "1999-06-15").select(*ID, "tier", "days_out_from_event", "is_game_over")


@query("d15_gameday_check", f"WITH {GAMES} SELECT COUNT(*) > 0 AS gameday_check FROM games WHERE event_date = DATE '1999-06-15'")
def gameday_check(t):
    return seats.is_gameday(games(t), "1999-06-15")


# --- seat maps and sell-through ---------------------------------------------------------
@query("d16_seat_lifetime", f"""
  WITH {LINE_TICKETS}, f AS (SELECT season, seat_id, SUM(gross_revenue) AS gross_revenue, SUM(paid_seats) AS times_paid, SUM(comp_seats) AS times_comp, SUM(did_attend::INT) AS attended,
    COUNT(CASE WHEN ticket_type = 'Full' THEN 1 END) AS times_full, COUNT(CASE WHEN ticket_type = 'Premier' THEN 1 END) AS times_premier,
    COUNT(CASE WHEN ticket_type IN ('Sponsor','Trade') THEN 1 END) AS times_other, COUNT(CASE WHEN ticket_type IN ('Flex','Groups','Nightly Suites','Secondary','Singles') THEN 1 END) AS times_nightly
    FROM line_tickets GROUP BY 1, 2)
  SELECT p_partkey AS seat_id, p_size AS seat_x, season, ROUND(gross_revenue, 2) AS gross_revenue, times_paid::DOUBLE AS times_paid, times_comp::DOUBLE AS times_comp, attended::DOUBLE AS attended,
    times_full::DOUBLE AS times_full, times_premier::DOUBLE AS times_premier, times_other::DOUBLE AS times_other, times_nightly::DOUBLE AS times_nightly FROM part LEFT JOIN f ON p_partkey = seat_id""")
def seat_lifetime(t):
    manifest = t.part.select(F.col("p_partkey").alias("seat_id"), F.col("p_size").alias("seat_x"))
    sales = [line_tickets(t, None, "1997-98"), line_tickets(t, "1998-99")]
    out = ops.seat_lifetime(manifest, sales, "seat_id")
    counts = ["times_paid", "times_comp", "attended", "times_full", "times_premier", "times_other", "times_nightly"]
    return out.withColumns({"gross_revenue": F.round("gross_revenue", 2), **{c: F.col(c).cast("double") for c in counts}})


MATRIX = LINE_TICKETS + """, ev AS (SELECT DISTINCT date_trunc('month', event_date)::DATE AS event FROM line_tickets),
  sale AS (SELECT seat_id, date_trunc('month', event_date)::DATE AS event, MIN(ticket_type) AS ticket_type, MAX(gross_revenue) AS price FROM line_tickets GROUP BY 1, 2),
  matrix AS (SELECT p_partkey AS seat_id, p_type AS pc, ev.event, COALESCE(ticket_type, 'Not Sold') AS ticket_type_final, GREATEST(COALESCE(price, 0), 0) AS price
    FROM part CROSS JOIN ev LEFT JOIN sale ON sale.seat_id = p_partkey AND sale.event = ev.event)"""


def seat_matrix(t):
    lt = line_tickets(t).withColumn("event", F.to_date(F.date_trunc("month", "event_date")))
    sale = lt.groupBy("seat_id", "event").agg(F.min("ticket_type").alias("ticket_type"), F.max("gross_revenue").alias("price"))
    seat = t.part.select(F.col("p_partkey").alias("seat_id"), F.col("p_type").alias("pc"))
    return ops.seat_event_matrix(seat, lt.select("event"), sale, "seat_id", "event")


@query("d17_seat_event_matrix", f"""
  WITH {MATRIX} SELECT event, pc, CASE WHEN ticket_type_final IN ('Full','Annual Suites','Premier','Flex','Quarter','Sponsor','Trade') THEN 'Plans' WHEN ticket_type_final = 'Groups' THEN 'Groups'
   WHEN ticket_type_final = 'Secondary' THEN 'Secondary' WHEN ticket_type_final = 'Not Sold' THEN 'Not Sold' ELSE 'Nightly' END AS ticket_type_group, COUNT(*) AS seats, ROUND(SUM(price), 2) AS price FROM matrix GROUP BY 1, 2, 3""")
def seat_event_matrix(t):
    return seat_matrix(t).groupBy("event", "pc", "ticket_type_group").agg(F.count("*").alias("seats"), F.round(F.sum("price"), 2).alias("price"))


@query("d18_sell_through", f"""
  WITH {MATRIX}, b AS (SELECT event, pc, COUNT(*) AS total_seats, COUNT(CASE WHEN ticket_type_final <> 'Not Sold' THEN 1 END) AS sold_seats FROM matrix GROUP BY 1, 2),
  r AS (SELECT *, sold_seats / total_seats AS sell_thru FROM b WHERE sold_seats > 0),
  u AS (SELECT *, CASE WHEN sell_thru = 1 THEN sell_thru WHEN sell_thru < 0.7::DOUBLE THEN sell_thru * 1.1::DOUBLE WHEN sell_thru * 1.05::DOUBLE < 1 THEN sell_thru * 1.05::DOUBLE ELSE 1 END AS new_sell_thru FROM r)
  SELECT event, pc, total_seats, sold_seats, ROUND(sell_thru, 6) AS sell_thru, ROUND(new_sell_thru, 6) AS new_sell_thru, trunc(total_seats * new_sell_thru - sold_seats)::INT AS new_seats FROM u""")
def sell_through(t):
    out = ops.sell_through(seat_matrix(t), ["event", "pc"])
    return out.withColumns({"sell_thru": F.round("sell_thru", 6), "new_sell_thru": F.round("new_sell_thru", 6)})


STATUS = """status AS (SELECT CAST(l_shipdate AS DATE) AS event_date, l_linenumber AS level, CASE WHEN l_discount > 0.08 THEN '["Kill"]' END AS locks, CASE WHEN l_tax > 0.07 THEN '["Killed Seats"]' WHEN l_tax > 0.04 THEN '["Owner"]' END AS allocations,
   CASE WHEN l_partkey % 9 = 0 THEN 'SRO' ELSE 'R1' END AS row, CASE WHEN l_quantity > 40 THEN 'SOLD' WHEN l_quantity > 20 THEN 'HELD' ELSE 'AVAIL' END AS status FROM lineitem)"""


def seat_status(t):
    return t.lineitem.select(
        F.to_date("l_shipdate").alias("event_date"), F.col("l_linenumber").alias("level"),
        F.when(F.col("l_discount") > 0.08, '["Kill"]').alias("locks"),
        F.when(F.col("l_tax") > 0.07, '["Killed Seats"]').when(F.col("l_tax") > 0.04, '["Owner"]').alias("allocations"),
        F.when(F.col("l_partkey") % 9 == 0, "SRO").otherwise("R1").alias("row"),
        F.when(F.col("l_quantity") > 40, "SOLD").when(F.col("l_quantity") > 20, "HELD").otherwise("AVAIL").alias("status"))


@query("d19_capacity", f"""
  WITH {STATUS} SELECT event_date, level, SUM(CASE WHEN allocations LIKE '%Kill%' OR locks LIKE '%Kill%' OR (row ILIKE 'SR%' AND status = 'AVAIL') THEN 0 ELSE 1 END)::BIGINT AS capacity FROM status GROUP BY 1, 2""")
def capacity(t):
    return ops.capacity(seat_status(t), ["event_date", "level"])


@query("d20_nightly_matrix", f"""
  WITH {LINE_TICKETS}, su AS (SELECT DISTINCT sales_rep AS section FROM line_tickets WHERE arena_level = 'Suites'), ev AS (SELECT DISTINCT date_trunc('month', event_date)::DATE AS event FROM line_tickets),
  f AS (SELECT sales_rep AS section, date_trunc('month', event_date)::DATE AS event, SUM(gross_revenue) AS r, SUM(paid_seats) AS p FROM line_tickets WHERE arena_level = 'Suites' GROUP BY 1, 2)
  SELECT su.section, ev.event, ROUND(COALESCE(r, 0), 2) AS gross_rev, COALESCE(p, 0)::BIGINT AS paid_seats, ROUND(COALESCE(r / NULLIF(p, 0), 0), 8) AS atp, CASE WHEN r >= 0 THEN 1 ELSE 0 END AS is_sold
  FROM su CROSS JOIN ev LEFT JOIN f ON su.section = f.section AND ev.event = f.event""")
def nightly_matrix(t):
    lt = line_tickets(t).select(
        F.col("sales_rep").alias("section"), F.to_date(F.date_trunc("month", "event_date")).alias("event"), "arena_level", "gross_revenue", "paid_seats")
    suites = lt.where("arena_level = 'Suites'")
    out = ops.nightly_matrix(suites, suites.select("section").distinct(), lt.select("event"), "section", "event")
    return out.withColumns({"gross_rev": F.round("gross_rev", 2), "atp": F.round("atp", 8)})


@query("d21_market_mix", f"""
  WITH {TICKETS}, {GAMES}, m AS (SELECT 'resale' AS marketplace, event_date, arena_level, COUNT(*) AS paid_seats, SUM(gross_revenue) AS gross_revenue FROM tickets WHERE ticket_type = 'Groups' GROUP BY ALL
   UNION ALL SELECT 'box office', event_date, arena_level, SUM(paid_seats)::BIGINT, SUM(gross_revenue) FROM tickets WHERE ticket_type = 'Singles' AND sales_rep % 2 = 0 GROUP BY ALL
   UNION ALL SELECT 'online', event_date, arena_level, SUM(paid_seats)::BIGINT, SUM(gross_revenue) FROM tickets WHERE ticket_type = 'Singles' AND sales_rep % 2 = 1 GROUP BY ALL)
  SELECT marketplace, event_date, arena_level, paid_seats, ROUND(gross_revenue, 2) AS gross_revenue, tier FROM m LEFT JOIN games USING (event_date)""")
def market_mix(t):
    """Singles sold by an even desk count as box office, those of an odd one as online: the tables name no marketplace."""
    tk = tickets(t)
    singles = tk.where("ticket_type = 'Singles'")
    mix = ops.market_mix({
        "resale": (tk.where("ticket_type = 'Groups'"), F.lit(1)),
        "box office": (singles.where("sales_rep % 2 = 0"), F.col("paid_seats")),
        "online": (singles.where("sales_rep % 2 = 1"), F.col("paid_seats")),
    }, ["event_date", "arena_level"])
    return mix.join(games(t).select("event_date", "tier"), "event_date", "left").withColumn("gross_revenue", F.round("gross_revenue", 2))


@query("d21_every_market_sells", f"""
  WITH {TICKETS} SELECT 'resale' AS marketplace, COUNT(*)::BIGINT AS seats, TRUE AS sells FROM tickets WHERE ticket_type = 'Groups'
  UNION ALL SELECT CASE sales_rep % 2 WHEN 0 THEN 'box office' ELSE 'online' END, SUM(paid_seats)::BIGINT, TRUE FROM tickets WHERE ticket_type = 'Singles' GROUP BY 1""")
def every_market_sells(t):
    return market_mix(t).groupBy("marketplace").agg(F.sum("paid_seats").alias("seats"), (F.sum("paid_seats") > 0).alias("sells"))


@query("d22_plan_summary", f"""
  WITH {TICKETS} SELECT ticket_type, season, ROUND(SUM(gross_revenue), 2) AS gross_revenue, SUM(paid_seats)::BIGINT AS paid_seats, COUNT(DISTINCT buyer) AS unique_accounts,
   ROUND(SUM(gross_revenue) / NULLIF(SUM(paid_seats), 0), 4) AS gross_paid_atp FROM tickets GROUP BY 1, 2""")
def plan_summary(t):
    out = ops.plan_summary(tickets(t), ["ticket_type", "season"], "buyer")
    return out.withColumns({"gross_revenue": F.round("gross_revenue", 2), "gross_paid_atp": F.round("gross_paid_atp", 4)})


# --- boards and trackers ----------------------------------------------------------------
NOW = "2024-01-20 15:30:00"


@query("d23_live_board", """
  WITH s AS (SELECT (DATE '2024-01-10' + (user_id % 40)::INT)::DATE AS event_date, ts, 1 AS seats FROM events WHERE ts <= TIMESTAMP '2024-01-20 15:30:00'),
  b AS (SELECT event_date, SUM(seats)::BIGINT AS total_seats, SUM(CASE WHEN ts::DATE = DATE '2024-01-20' THEN seats ELSE 0 END)::BIGINT AS todays_tickets,
   SUM(CASE WHEN ts::DATE = DATE '2024-01-19' THEN seats ELSE 0 END)::BIGINT AS yesterdays_tickets, SUM(CASE WHEN ts >= TIMESTAMP '2024-01-20 14:30:00' THEN seats ELSE 0 END)::BIGINT AS last_hours_tickets FROM s GROUP BY 1),
  n AS (SELECT event_date FROM b WHERE event_date >= DATE '2024-01-20' ORDER BY 1 LIMIT 5),
  l AS (SELECT (DATE '2024-01-10' + (l_suppkey % 40)::INT)::DATE AS event_date, l_extendedprice AS price, CASE WHEN l_quantity > 40 THEN 'SOLD' WHEN l_quantity > 25 THEN 'HELD' ELSE 'AVAIL' END AS status FROM lineitem),
  r AS (SELECT event_date, SUM(price) AS v FROM l GROUP BY 1),
  st AS (SELECT event_date, COUNT(*) AS capacity, COUNT(CASE WHEN status IN ('SOLD', 'HELD') THEN 1 END)::DOUBLE / COUNT(*) AS sell_through FROM l WHERE event_date IN (SELECT event_date FROM n) GROUP BY 1)
  SELECT b.*, b.event_date IN (SELECT event_date FROM n) AS next_5_flag, ROUND(v, 2) AS gross_revenue, capacity, ROUND(COALESCE(sell_through, 0), 8) AS sell_through,
   substr('ABCDE', (day(b.event_date) % 5 + 1)::INT, 1) AS tier, strftime(b.event_date, '%a') AS day_of_week, (day(b.event_date) % 2)::INT AS is_premier
  FROM b LEFT JOIN r ON r.event_date = b.event_date LEFT JOIN st ON st.event_date = b.event_date""")
def live_board(t):
    sales = t.events.select(
        F.date_add(F.lit("2024-01-10").cast("date"), (F.col("user_id") % 40).cast("int")).alias("event_date"), "ts", F.lit(1).alias("seats"))
    day = F.date_add(F.lit("2024-01-10").cast("date"), (F.col("l_suppkey") % 40).cast("int")).alias("event_date")
    status = s.first_match([(F.col("l_quantity") > 40, "SOLD"), (F.col("l_quantity") > 25, "HELD")], "AVAIL")
    seats = t.lineitem.select(day, F.col("l_extendedprice").alias("gross_revenue"), status.alias("status"))
    games = sales.select("event_date").distinct().select(
        "event_date", s.lookup(F.dayofmonth("event_date") % 5, dict(enumerate("ABCDE"))).alias("tier"),
        F.date_format("event_date", "EEE").alias("day_of_week"), (F.dayofmonth("event_date") % 2).alias("is_premier"))
    out = ops.live_board(sales, "event_date", "ts", "seats", NOW, revenue=seats, status=seats, games=games)
    return out.withColumns({"gross_revenue": F.round("gross_revenue", 2), "sell_through": F.round("sell_through", 8)})


@query("d24_hourly_grid", """
  WITH r AS (SELECT date_trunc('hour', ts) AS sales_hour, ts::DATE AS day, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-19' AND ts < TIMESTAMP '2024-01-21'),
  s AS (SELECT sales_hour, event_type, COUNT(*) AS sold FROM r GROUP BY 1, 2),
  g AS (SELECT day + to_hours(h::INT) AS sales_hour, event_type FROM (SELECT DISTINCT day FROM r) CROSS JOIN (SELECT DISTINCT hour(ts) AS h FROM events) CROSS JOIN (SELECT DISTINCT event_type FROM r))
  SELECT g.sales_hour, g.event_type, (CASE WHEN g.sales_hour <= TIMESTAMP '2024-01-20 15:30:00' THEN COALESCE(sold, 0) ELSE sold END)::DOUBLE AS sold
  FROM g LEFT JOIN s ON g.sales_hour = s.sales_hour AND g.event_type = s.event_type""")
def hourly_grid(t):
    out = ops.hourly_board(t.events.select("ts", "event_type"), "ts", "event_type", F.count("*"), NOW)
    return out.withColumn("sold", F.col("sold").cast("double"))


@query("d25_goal_grid", f"""
  WITH {LINE_TICKETS}, g AS (SELECT s_suppkey AS sales_rep, vertical, CASE vertical WHEN 'Sales' THEN 50 ELSE 70 END AS goal FROM (SELECT s_suppkey, CASE WHEN s_acctbal > 5000 THEN 'Sales' ELSE 'Service' END AS vertical FROM supplier)),
  ev AS (SELECT DISTINCT date_trunc('month', event_date)::DATE AS event FROM line_tickets), f AS (SELECT sales_rep, date_trunc('month', event_date)::DATE AS event, SUM(paid_seats) AS p, SUM(gross_revenue) AS r FROM line_tickets
   WHERE ticket_type <> 'Nightly Suites' GROUP BY 1, 2)
  SELECT g.sales_rep, vertical, goal, ev.event, COALESCE(p, 0)::BIGINT AS paid_seats, ROUND(COALESCE(r, 0), 2) AS gross_revenue FROM g CROSS JOIN ev LEFT JOIN f ON f.sales_rep = g.sales_rep AND f.event = ev.event""")
def goal_grid(t):
    vertical = F.when(F.col("s_acctbal") > 5000, "Sales").otherwise("Service")
    reps = t.supplier.select(F.col("s_suppkey").alias("sales_rep"), vertical.alias("vertical")).withColumn("goal", s.lookup("vertical", {"Sales": 50}, 70))
    lt = line_tickets(t).withColumn("event", F.to_date(F.date_trunc("month", "event_date")))
    out = ops.goal_grid(reps, lt.select("event"), lt.where("ticket_type <> 'Nightly Suites'"), "sales_rep", "event", [])
    return out.withColumn("gross_revenue", F.round("gross_revenue", 2))


@query("d25_trailing_week", f"""
  WITH {TICKETS}, r AS (SELECT DISTINCT sales_rep FROM tickets), w AS (SELECT sales_rep, transaction_date, SUM(paid_seats) AS p, SUM(gross_revenue) AS v FROM tickets WHERE transaction_date >= DATE '2001-07-25' GROUP BY 1, 2)
  SELECT r.sales_rep, d.transaction_date, COALESCE(p, 0)::BIGINT AS paid_seats, ROUND(COALESCE(v, 0), 2) AS gross_revenue FROM r CROSS JOIN (SELECT DISTINCT transaction_date FROM w) d LEFT JOIN w ON r.sales_rep = w.sales_rep AND d.transaction_date = w.transaction_date""")
def trailing_week(t):
    out = ops.trailing_days_grid(tickets(t), "sales_rep", "transaction_date", "2001-08-01")
    return out.withColumn("gross_revenue", F.round("gross_revenue", 2))


@query("d26_cycle_tracker", f"""
  WITH {TICKETS}, f AS (SELECT GREATEST(date_diff('day', DATE '1999-03-10', transaction_date), 0) AS dy, ticket_type, arena_level, SUM(paid_seats) AS n, SUM(gross_revenue) AS r FROM tickets GROUP BY 1, 2, 3)
  SELECT d::DATE AS sale_date, date_diff('day', DATE '1999-03-10', d::DATE)::INT AS day_in_sales_cycle, tt AS ticket_type, lv AS arena_level, COALESCE(n, 0)::BIGINT AS num_seats, ROUND(COALESCE(r, 0), 2) AS gross_revenue
  FROM (SELECT unnest(generate_series(DATE '1999-03-10', DATE '2000-03-10', INTERVAL 1 DAY)) AS d) CROSS JOIN (VALUES ('Full'), ('Premier')) a(tt) CROSS JOIN (VALUES ('Clubs'), ('Uppers'), ('Lowers'), ('Premium')) b(lv)
  LEFT JOIN f ON dy = date_diff('day', DATE '1999-03-10', d::DATE) AND ticket_type = tt AND arena_level = lv""")
def cycle_tracker(t):
    out = ops.cycle_tracker(tickets(t), "1999-03-10", "2000-03-10", ["Full", "Premier"], ["Clubs", "Uppers", "Lowers", "Premium"])
    return out.withColumn("gross_revenue", F.round("gross_revenue", 2))


@query("d27_event_series", """
  WITH k AS (SELECT p_brand || year(o_orderdate)::VARCHAR AS event_name_year, CAST(o_orderdate AS DATE) AS d, o_orderkey FROM orders JOIN part ON o_orderkey % 2000 = p_partkey),
  a AS (SELECT event_name_year, COUNT(DISTINCT d) AS num_events, MIN(d) AS lo, MAX(d) AS hi FROM k GROUP BY 1)
  SELECT o_orderkey, event_name_year, num_events, CASE WHEN lo = hi THEN strftime(lo, '%m/%d/%y') ELSE strftime(lo, '%m/%d/%y') || ' - ' || strftime(hi, '%m/%d/%y') END AS event_range FROM k JOIN a USING (event_name_year)""")
def event_series(t):
    named = t.orders.withColumn("p_partkey", F.col("o_orderkey") % 2000).join(t.part.select("p_partkey", "p_brand"), "p_partkey").select(
        "o_orderkey", F.to_date("o_orderdate").alias("d"), "p_brand")
    return ops.event_series(named, "p_brand", "d").select("o_orderkey", "event_name_year", "num_events", "event_range")


@query("d28_game_descriptors", f"""
  WITH {GAMES}, g AS (SELECT season, event_date, month(event_date) AS m, day(event_date) AS dm, year(event_date) AS y, dayofyear(event_date) AS p, dayofyear(make_date(year(event_date), 12, 31)) AS len,
    (5 - (dayofweek(make_date(year(event_date), 11, 1)) + 1) + 7) % 7 + 22 AS tg FROM games),
  h AS (SELECT *, (m = 11 AND dm BETWEEN tg - 3 AND tg + 3)::INT AS is_thanksgiving, (m = 12 AND dm BETWEEN 21 AND 27)::INT AS is_christmas, ((m = 12 AND dm >= 29) OR (m = 1 AND dm <= 4))::INT AS is_nye,
    date_diff('day', LAG(event_date) OVER w, event_date)::DOUBLE AS days_before, date_diff('day', event_date, LEAD(event_date) OVER w)::DOUBLE AS days_after FROM g WINDOW w AS (PARTITION BY season ORDER BY event_date)),
  d AS (SELECT a.event_date, COUNT(*) AS density FROM g a JOIN g b ON a.season = b.season AND a.y = b.y AND LEAST(abs(a.p - b.p), a.len - abs(a.p - b.p)) <= 3 GROUP BY 1)
  SELECT event_date, CASE dayofweek(event_date) WHEN 6 THEN 1 WHEN 5 THEN 2 WHEN 0 THEN 2 ELSE 3 END AS week_day, CASE WHEN m BETWEEN 9 AND 11 THEN 1 WHEN m < 2 OR m = 12 THEN 2 ELSE 3 END AS trimester,
    is_thanksgiving, is_christmas, is_nye, GREATEST(is_thanksgiving, is_christmas, is_nye) AS is_holiday, density, (density >= 3)::INT AS is_dense, days_before, days_after FROM h JOIN d USING (event_date)""")
def game_descriptors(t):
    out = ops.game_descriptors(games(t).select("event_date", "season"))
    return out.select("event_date", "week_day", "trimester", "is_thanksgiving", "is_christmas", "is_nye", "is_holiday", "density", "is_dense",
                      F.col("days_before").cast("double").alias("days_before"), F.col("days_after").cast("double").alias("days_after"))


@query("d29_tier_history", f"""
  WITH {LINE_TICKETS}, {GAMES}, pt AS (SELECT event_date, ticket_type, arena_level, SUM(gross_revenue) AS r, SUM(paid_seats) AS p, SUM(gross_revenue) / NULLIF(SUM(paid_seats), 0) AS atp FROM line_tickets GROUP BY 1, 2, 3),
  pg AS (SELECT event_date, SUM(r) AS r, SUM(p) AS p, AVG(atp) AS atp FROM pt GROUP BY 1), bt AS (SELECT tier, season, AVG(r) AS r, AVG(p) AS p, AVG(atp) AS a FROM pg JOIN games USING (event_date) GROUP BY 1, 2)
  SELECT tier, season, ROUND(r, 2) AS gross_revenue, ROUND(p, 4) AS paid_seats, ROUND(a, 4) AS gross_atp, ROUND(COALESCE(r / LAG(r) OVER w - 1, 0), 6) AS gross_revenue_change,
   ROUND(COALESCE(p / LAG(p) OVER w - 1, 0), 6) AS paid_seats_change, ROUND(COALESCE(a / LAG(a) OVER w - 1, 0), 6) AS gross_atp_change FROM bt WINDOW w AS (PARTITION BY tier ORDER BY season)""")
def tier_history(t):
    out = ops.tier_history(line_tickets(t), games(t))
    digits = {"gross_revenue": 2, "paid_seats": 4, "gross_atp": 4, "gross_revenue_change": 6, "paid_seats_change": 6, "gross_atp_change": 6}
    return out.select("tier", "season", *[F.round(c, n).alias(c) for c, n in digits.items()])


@query("d29_season_equivalents", f"""
  WITH {LINE_TICKETS}, per AS (SELECT season, ticket_type, SUM(paid_seats) AS p FROM line_tickets WHERE ticket_type IN ('Full','Annual Suites','Premier','Half') GROUP BY 1, 2),
  e AS (SELECT season, SUM(CASE WHEN ticket_type IN ('Full','Annual Suites') THEN ROUND(p / 42, 2) WHEN ticket_type = 'Half' THEN p / 20 ELSE p / 25 END) AS f FROM per GROUP BY 1)
  SELECT season, ROUND(f, 4) AS fse_calc, ROUND(COALESCE(f / LAG(f) OVER (ORDER BY season) - 1, 0), 6) AS fse_calc_change FROM e""")
def season_equivalents(t):
    return ops.season_equivalents(line_tickets(t)).withColumns({"fse_calc": F.round("fse_calc", 4), "fse_calc_change": F.round("fse_calc_change", 6)})


@query("d29_singles_share", f"""
  WITH {LINE_TICKETS}, per AS (SELECT season, SUM(CASE WHEN ticket_type = 'Singles' THEN paid_seats ELSE 0 END) / 42 AS s, SUM(CASE WHEN ticket_type <> 'Singles' THEN paid_seats ELSE 0 END) / 42 AS o FROM line_tickets GROUP BY 1)
  SELECT season, ROUND(s, 4) AS singles, ROUND(19500 - o, 4) AS capacity, ROUND(s / (19500 - o), 6) AS per_sold FROM per""")
def singles_share(t):
    out = ops.singles_share(line_tickets(t), fixed.GAMES_PER_SEASON, fixed.VENUE_CAPACITY)
    return out.select("season", F.round("singles", 4).alias("singles"), F.round("capacity", 4).alias("capacity"), F.round("per_sold", 6).alias("per_sold"))


@query("d30_attendance_history", f"""
  WITH {LINE_TICKETS} SELECT season, event_date, arena_level, SUM(paid_seats)::BIGINT AS paid_seats, SUM(comp_seats)::BIGINT AS comp_seats, SUM(CASE WHEN NOT is_comp THEN did_attend::INT ELSE 0 END)::BIGINT AS paid_attended,
   SUM(CASE WHEN is_comp THEN did_attend::INT ELSE 0 END)::BIGINT AS comp_attended FROM line_tickets GROUP BY 1, 2, 3""")
def attendance_history(t):
    return ops.attendance_history([line_tickets(t, None, "1996-97"), line_tickets(t, "1997-98")], ["season", "event_date", "arena_level"])


@query("d31_market_counties", """
  WITH r AS (SELECT CAST(o_orderdate AS DATE) AS event_date, SUM(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS a, SUM(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS b, SUM(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS c FROM orders GROUP BY 1)
  SELECT event_date, ROUND(a, 2) AS ratings, 'Broward' AS county_1, 'Miami-Dade' AS county_2, 'Monroe' AS county_3, NULL AS county_4, NULL AS county_5 FROM r
  UNION ALL SELECT event_date, ROUND(b, 2), 'Palm Beach', 'Okeechobee', 'Indian River', 'St Lucie', 'Martin' FROM r UNION ALL SELECT event_date, ROUND(c, 2), 'Lee', 'Charlotte', 'Collier', NULL, NULL FROM r""")
def market_counties(t):
    by = [F.round(F.sum(F.when(F.col("o_orderstatus") == k, F.col("o_totalprice"))), 2).alias(k) for k in "FOP"]
    r = t.orders.groupBy(F.to_date("o_orderdate").alias("event_date")).agg(*by)
    return ops.market_counties(r, ["event_date"], {"mia_ftl": {"ratings": "F"}, "pb": {"ratings": "O"}, "fm": {"ratings": "P"}})
