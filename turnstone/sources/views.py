"""Business views over the driver tables, and the same views as SQL text.

A ticket is an order line: the order's date is the sale, the ship date is the
event, the buyer is the order's customer.  Filters belong on top of these views;
they are plain projections over one join, so they reach the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.functions.scalars import days_between, dow0, lookup, season_of
from turnstone.sources.tables import Tables

LEVEL_BY_LINE = {
    1: "Lowers", 2: "Lowers", 3: "Clubs", 4: "Uppers", 5: "Uppers", 6: "Suites", 7: "Premium",
}
TYPE_BY_FLAGS = {
    "AF": "Full", "AO": "Premier", "NF": "Singles", "NO": "Groups", "RF": "Flex", "RO": "Nightly Suites",
}
START_TIMES = ["7:00 PM", "1:00 PM", "5:00 PM", "3:30 PM", "7:30 PM"]


def season_lines(t: Tables, first: str | None, last: str | None) -> DataFrame:
    """Order lines of the seasons from ``first`` to ``last``.

    Stated as a range of the stored ship date, so the scan skips the other
    seasons; a test on the computed season text could not reach it.
    """
    lines = t.lineitem
    if first:
        lines = lines.where(F.col("l_shipdate") >= F.lit(f"{first[:4]}-07-01").cast("timestamp_ntz"))
    if last:
        lines = lines.where(F.col("l_shipdate") < F.lit(f"{int(last[:4]) + 1}-07-01").cast("timestamp_ntz"))
    return lines


def line_tickets(t: Tables, first: str | None = None, last: str | None = None) -> DataFrame:
    """Tickets from order lines alone: no buyer, no sale date, no join."""
    comp = F.col("l_discount") == 0
    seats = F.col("l_quantity").cast("int")
    return season_lines(t, first, last).select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_partkey").alias("seat_id"),
        F.col("l_suppkey").alias("sales_rep"),
        F.to_date("l_shipdate").alias("event_date"),
        season_of(F.col("l_shipdate")).alias("season"),
        lookup("l_linenumber", LEVEL_BY_LINE).alias("arena_level"),
        lookup(F.concat("l_returnflag", "l_linestatus"), TYPE_BY_FLAGS).alias("ticket_type"),
        comp.alias("is_comp"),
        F.when(comp, 0).otherwise(seats).alias("paid_seats"),
        F.when(comp, seats).otherwise(0).alias("comp_seats"),
        (F.col("l_tax") >= 0.02).alias("did_attend"),
        F.when(comp, 0.0).otherwise(F.col("l_extendedprice")).alias("gross_revenue"),
    )


#: All seasons of the driver tables.
SEASONS = tuple(f"{y}-{(y + 1) % 100:02}" for y in range(1994, 2002))


LINE_TICKETS = """line_tickets AS (
  SELECT l_orderkey, l_linenumber, l_partkey AS seat_id, l_suppkey AS sales_rep,
         CAST(l_shipdate AS DATE) AS event_date,
         CASE WHEN month(l_shipdate) < 7
              THEN (year(l_shipdate)-1)::VARCHAR || '-' || lpad(((year(l_shipdate)) % 100)::VARCHAR, 2, '0')
              ELSE year(l_shipdate)::VARCHAR || '-' || lpad(((year(l_shipdate)+1) % 100)::VARCHAR, 2, '0') END AS season,
         CASE l_linenumber WHEN 1 THEN 'Lowers' WHEN 2 THEN 'Lowers' WHEN 3 THEN 'Clubs' WHEN 4 THEN 'Uppers'
              WHEN 5 THEN 'Uppers' WHEN 6 THEN 'Suites' WHEN 7 THEN 'Premium' END AS arena_level,
         CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'Full' WHEN 'AO' THEN 'Premier' WHEN 'NF' THEN 'Singles'
              WHEN 'NO' THEN 'Groups' WHEN 'RF' THEN 'Flex' WHEN 'RO' THEN 'Nightly Suites' END AS ticket_type,
         l_discount = 0 AS is_comp,
         CASE WHEN l_discount = 0 THEN 0 ELSE l_quantity::INT END AS paid_seats,
         CASE WHEN l_discount = 0 THEN l_quantity::INT ELSE 0 END AS comp_seats,
         l_tax >= 0.02 AS did_attend,
         CASE WHEN l_discount = 0 THEN 0.0::DOUBLE ELSE l_extendedprice END AS gross_revenue
  FROM lineitem)"""


def tickets(t: Tables, first: str | None = None, last: str | None = None) -> DataFrame:
    """Tickets with buyer and sale date: one equi join on the order key.

    The order date of the driver tables bears no relation to the event, so a sale is
    placed as many days before its event as the two dates lie apart, modulo a year.
    """
    sales = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("buyer"),
        F.to_date("o_orderdate").alias("transaction_date"),
    )
    joined = line_tickets(t, first, last).join(sales, "l_orderkey")
    apart = F.abs(days_between("transaction_date", "event_date")) % 366
    return joined.withColumn("days_out", apart).withColumn("transaction_date", F.date_sub("event_date", F.col("days_out")))


TICKETS = LINE_TICKETS + """, tickets AS (
  SELECT lt.*, o_custkey AS buyer, event_date - (abs(date_diff('day', CAST(o_orderdate AS DATE), event_date)) % 366)::INT AS transaction_date,
         (abs(date_diff('day', CAST(o_orderdate AS DATE), event_date)) % 366)::INT AS days_out
  FROM line_tickets lt JOIN orders ON l_orderkey = o_orderkey)"""


def games(t: Tables) -> DataFrame:
    """One row per event day with a tier, a start time and weekday fields."""
    days = t.lineitem.select(F.to_date("l_shipdate").alias("event_date")).distinct()
    pick = F.dayofmonth("event_date") % 5
    return days.select(
        "event_date",
        season_of("event_date").alias("season"),
        lookup(pick, dict(enumerate("ABCDE"))).alias("tier"),
        lookup(pick, dict(enumerate(START_TIMES))).alias("start_time"),
        F.date_format("event_date", "EEE").alias("day_of_week"),
        dow0("event_date").isin(0, 6).alias("is_weekend"),
        (F.dayofmonth("event_date") % 2).alias("is_premier"),
    )


GAMES = """games AS (
  SELECT event_date,
         CASE WHEN month(event_date) < 7
              THEN (year(event_date)-1)::VARCHAR || '-' || lpad(((year(event_date)) % 100)::VARCHAR, 2, '0')
              ELSE year(event_date)::VARCHAR || '-' || lpad(((year(event_date)+1) % 100)::VARCHAR, 2, '0') END AS season,
         substr('ABCDE', (day(event_date) % 5 + 1)::INT, 1) AS tier,
         CASE day(event_date) % 5 WHEN 0 THEN '7:00 PM' WHEN 1 THEN '1:00 PM' WHEN 2 THEN '5:00 PM'
              WHEN 3 THEN '3:30 PM' ELSE '7:30 PM' END AS start_time,
         strftime(event_date, '%a') AS day_of_week,
         dayofweek(event_date) IN (0, 6) AS is_weekend,
         (day(event_date) % 2)::INT AS is_premier
  FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS event_date FROM lineitem))"""


def scans(t: Tables) -> DataFrame:
    """Gate scans: app events read as visits of a client on a day."""
    return t.events.select(
        "event_id",
        F.col("user_id").alias("client"),
        F.col("ts").alias("scan_time"),
        F.to_date("ts").alias("event_date"),
        "event_type",
        "value",
        (F.col("event_type") != "error").alias("attended"),
    )


SCANS = """scans AS (
  SELECT event_id, user_id AS client, ts AS scan_time, CAST(ts AS DATE) AS event_date, event_type, value,
         event_type <> 'error' AS attended FROM events)"""


def blocks(t: Tables) -> DataFrame:
    """Plan blocks: adjoining seats sold as one line, with a price code."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789"
    pc = F.concat(
        F.substring(F.lit(letters), (F.col("l_partkey") % 35 + 1).cast("int"), F.lit(1)),
        F.substring(F.lit("FPIGXH*CFP"), (F.col("l_suppkey") % 10 + 1).cast("int"), F.lit(1)),
        F.substring(F.lit("RNDXRL"), (F.col("l_orderkey") % 6 + 1).cast("int"), F.lit(1)),
        F.substring(F.lit("AULN"), (F.col("l_orderkey") % 4 + 1).cast("int"), F.lit(1)),
    )
    length = F.when(F.col("l_quantity") > 45, 1).when(F.col("l_quantity") > 40, 2).otherwise(4)
    comp = F.col("l_discount") == 0
    rep = F.col("l_suppkey") % 13
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.concat(F.lit("S"), (F.col("l_partkey") % 40).cast("string")).alias("section_name"),
        F.when(F.col("l_partkey") % 17 == 0, "SRO").otherwise(
            F.concat(F.lit("R"), F.col("l_linenumber").cast("string"))
        ).alias("row_name"),
        (F.col("l_linenumber") * 10).alias("seat_num"),
        (F.col("l_partkey") % 6 + 1).cast("int").alias("num_seats"),
        F.left(pc, length).alias("price_code"),
        F.when(comp, 0.0).otherwise(F.col("l_extendedprice")).alias("block_purchase_price"),
        F.when(comp, 0.0).otherwise(F.col("l_extendedprice") * 0.5).alias("paid_amount"),
        (F.col("l_suppkey") % 41 + 1).cast("int").alias("total_events"),
        (1 - F.col("l_discount")).alias("percent_paid"),
        F.to_date("l_shipdate").alias("event_date"),
        F.date_sub(F.to_date("l_shipdate"), (F.col("l_suppkey") % 120).cast("int")).alias("add_date"),
        F.concat(F.lit("22H"), F.date_format("l_shipdate", "MMdd"),
                 F.substring(F.lit("ABCDE"), (F.col("l_suppkey") % 5 + 1).cast("int"), F.lit(1))).alias("event_name"),
        F.when(rep == 0, "Sponsor").when(rep == 1, "Trade Desk").otherwise("House Rep").alias("acct_rep_full_name"),
        F.element_at(
            F.array(*[F.lit(x) for x in [
                "Individual", "Sponsor", "Business Account", "Trade", "Trade-Sponsor", "Family", "Marketing Trade",
            ]]), (F.col("l_partkey") % 7 + 1).cast("int")).alias("acct_type_desc"),
        F.element_at(
            F.array(*[F.lit(x) for x in ["Premium", "Membership", "New Business", "Groups", "Events"]]),
            (F.col("l_suppkey") % 5 + 1).cast("int")).alias("rep_department"),
        F.when(F.col("l_orderkey") % 2 == 0, "Sales").otherwise("Service").alias("rep_sales_service"),
        F.when(F.col("l_partkey") % 9 == 0, "All Inclusive").otherwise("Standard").alias("price_code_desc"),
        F.when(F.col("l_suppkey") % 9 == 0, "AI").otherwise("BASE").alias("price_code_group"),
    )


BLOCKS = """blocks AS (
  SELECT *, substr(event_name, length(event_name), 1) AS tier,
         coalesce(substr(price_code, 1, 1), '') AS pc_one, coalesce(substr(price_code, 2, 1), '') AS pc_two,
         coalesce(substr(price_code, 3, 1), '') AS pc_three, coalesce(substr(price_code, 4, 1), '') AS pc_four
  FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         'S' || (l_partkey % 40)::VARCHAR AS section_name,
         CASE WHEN l_partkey % 17 = 0 THEN 'SRO' ELSE 'R' || l_linenumber::VARCHAR END AS row_name,
         l_linenumber * 10 AS seat_num, (l_partkey % 6 + 1)::INT AS num_seats,
         left(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', (l_partkey % 35 + 1)::INT, 1)
           || substr('FPIGXH*CFP', (l_suppkey % 10 + 1)::INT, 1)
           || substr('RNDXRL', (l_orderkey % 6 + 1)::INT, 1)
           || substr('AULN', (l_orderkey % 4 + 1)::INT, 1),
           CASE WHEN l_quantity > 45 THEN 1 WHEN l_quantity > 40 THEN 2 ELSE 4 END) AS price_code,
         CASE WHEN l_discount = 0 THEN 0.0::DOUBLE ELSE l_extendedprice END AS block_purchase_price,
         CASE WHEN l_discount = 0 THEN 0.0::DOUBLE ELSE l_extendedprice * 0.5::DOUBLE END AS paid_amount,
         (l_suppkey % 41 + 1)::INT AS total_events, 1 - l_discount AS percent_paid,
         CAST(l_shipdate AS DATE) AS event_date,
         (CAST(l_shipdate AS DATE) - (l_suppkey % 120)::INT)::DATE AS add_date,
         '22H' || strftime(l_shipdate, '%m%d') || substr('ABCDE', (l_suppkey % 5 + 1)::INT, 1) AS event_name,
         CASE l_suppkey % 13 WHEN 0 THEN 'Sponsor' WHEN 1 THEN 'Trade Desk' ELSE 'House Rep' END AS acct_rep_full_name,
         (['Individual','Sponsor','Business Account','Trade','Trade-Sponsor','Family','Marketing Trade'])
            [(l_partkey % 7 + 1)::INT] AS acct_type_desc,
         (['Premium','Membership','New Business','Groups','Events'])[(l_suppkey % 5 + 1)::INT] AS rep_department,
         CASE WHEN l_orderkey % 2 = 0 THEN 'Sales' ELSE 'Service' END AS rep_sales_service,
         CASE WHEN l_partkey % 9 = 0 THEN 'All Inclusive' ELSE 'Standard' END AS price_code_desc,
         CASE WHEN l_suppkey % 9 = 0 THEN 'AI' ELSE 'BASE' END AS price_code_group
  FROM lineitem))"""
