"""Ticket facts: seat maps, sell-through, boards, trackers and history tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstone.functions import fixed_values as fixed
from turnstone.functions.scalars import date_range_text, days_between, first_match, lookup, ratio
from turnstone.operators.grid import dense_grid, zero_fill_past
from turnstone.operators.windows import change_from_previous, day_density, within_year_density


def days_in_sales_cycle(df: DataFrame, starts: Mapping[str, str] = fixed.SALES_START) -> DataFrame:
    """Days from the season's sales start to the sale; null for a season without one."""
    start = lookup("season", starts).cast("date")
    return df.withColumn("days_in_sales_cycle", days_between(start, "transaction_date"))


def seat_lifetime(manifest: DataFrame, sales: Sequence[DataFrame], seat: str) -> DataFrame:
    """Per season and seat: revenue and how often it was paid, comped, attended, and sold as what.

    Seats without a sale stay with nulls.  The facts are reduced before the join.
    """
    rows = sales[0]
    for other in sales[1:]:
        rows = rows.unionByName(other)
    kind = F.col("ticket_type")
    facts = rows.groupBy("season", seat).agg(
        F.sum("gross_revenue").alias("gross_revenue"),
        F.sum("paid_seats").alias("times_paid"),
        F.sum("comp_seats").alias("times_comp"),
        F.sum(F.col("did_attend").cast("int")).alias("attended"),
        F.count_if(kind == "Full").alias("times_full"),
        F.count_if(kind == "Premier").alias("times_premier"),
        F.count_if(kind.isin("Sponsor", "Trade")).alias("times_other"),
        F.count_if(kind.isin("Flex", "Groups", "Nightly Suites", "Secondary", "Singles")).alias("times_nightly"),
    )
    return manifest.join(facts, seat, "left")


def seat_event_matrix(seats: DataFrame, events: DataFrame, sales: DataFrame, seat: str, event: str) -> DataFrame:
    """Every seat at every event with what it was sold as, 'Not Sold' where it was not.

    ``sales`` has one row per seat and event.  Seats are spread over the cluster
    and each explodes over the event list; the event list is bounded by the calendar.
    """
    grid = dense_grid(seats, {event: events})
    sold = grid.join(sales, [seat, event], "left")
    kind = F.coalesce("ticket_type", F.lit("Not Sold"))
    return sold.withColumns({
        "ticket_type_final": kind,
        "price": F.greatest(F.coalesce("price", F.lit(0.0)), F.lit(0.0)),
        "ticket_type_group": first_match([
            (kind.isin("Full", "Annual Suites", "Premier", "Flex", "Quarter", "Sponsor", "Trade"), "Plans"),
            (kind == "Groups", "Groups"),
            (kind == "Secondary", "Secondary"),
            (kind == "Not Sold", "Not Sold"),
        ], "Nightly"),
    })


def sell_through(matrix: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Seats sold of all seats, and the seats an uplift of 10 or 5 percent would add, capped at full."""
    sold = F.count_if(F.col("ticket_type_final") != "Not Sold")
    base = matrix.groupBy(*keys).agg(F.count("*").alias("total_seats"), sold.alias("sold_seats")).where("sold_seats > 0")
    rate = F.col("sell_thru")
    lifted = first_match([
        (rate == 1, rate), (rate < 0.7, rate * 1.1), (rate * 1.05 < 1, rate * 1.05)], F.lit(1.0))
    return (
        base.withColumn("sell_thru", ratio("sold_seats", "total_seats"))
        .withColumn("new_sell_thru", lifted)
        .withColumn("new_seats", (F.col("total_seats") * F.col("new_sell_thru") - F.col("sold_seats")).cast("int"))
    )


def capacity(status: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Seats that can be sold: killed seats and open standing room do not count."""
    killed = F.coalesce(F.col("allocations").contains("Kill"), F.lit(False)) | F.coalesce(
        F.col("locks").contains("Kill"), F.lit(False))
    standing = F.col("row").ilike("SR%") & (F.col("status") == "AVAIL")
    return status.groupBy(*keys).agg(F.sum(F.when(killed | standing, 0).otherwise(1)).alias("capacity"))


def nightly_matrix(facts: DataFrame, places: DataFrame, events: DataFrame, place: str, event: str) -> DataFrame:
    """Each place at each event: revenue, paid seats, average price and whether anything was sold."""
    per = facts.groupBy(place, event).agg(F.sum("gross_revenue").alias("r"), F.sum("paid_seats").alias("p"))
    grid = dense_grid(places, {event: events}).join(per, [place, event], "left")
    return grid.select(
        place,
        event,
        F.coalesce("r", F.lit(0.0)).alias("gross_rev"),
        F.coalesce("p", F.lit(0)).alias("paid_seats"),
        F.coalesce(ratio("r", "p"), F.lit(0.0)).alias("atp"),
        F.coalesce((F.col("r") >= 0).cast("int"), F.lit(0)).alias("is_sold"),
    )


def market_mix(sources: Mapping[str, tuple[DataFrame, Column]], keys: Sequence[str]) -> DataFrame:
    """Seats and revenue per marketplace and key from several sale tables (source, seat expression)."""
    parts = [
        df.groupBy(*keys).agg(F.sum(count).alias("paid_seats"), F.sum("gross_revenue").alias("gross_revenue")).withColumn(
            "marketplace", F.lit(name))
        for name, (df, count) in sources.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def plan_summary(df: DataFrame, keys: Sequence[str], customer: str) -> DataFrame:
    """Revenue, seats, distinct accounts and average price per group."""
    return df.groupBy(*keys).agg(
        F.sum("gross_revenue").alias("gross_revenue"),
        F.sum("paid_seats").alias("paid_seats"),
        F.countDistinct(customer).alias("unique_accounts"),
        ratio(F.sum("gross_revenue"), F.sum("paid_seats")).alias("gross_paid_atp"),
    )


def live_board(
    sales: DataFrame, event: str, when: str, seats: str, as_of, next_n: int = 5,
    revenue: DataFrame | None = None, status: DataFrame | None = None, games: DataFrame | None = None,
) -> DataFrame:
    """Seats sold today, yesterday and in the last hour per event, with a flag on the next events.

    One conditional aggregate; the next events are a top-n of the reduced table.
    ``revenue`` (event, ``gross_revenue``) and ``games`` (event and any fields) are joined
    to events that have them; ``status`` (event, ``status`` of a seat) gives the next events
    their capacity and the share of it sold or held, 0 for all others.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    day, today = F.to_date(when), F.to_date(F.lit(as_of))
    board = sales.where(F.col(when) <= now).groupBy(event).agg(
        F.sum(seats).alias("total_seats"),
        F.sum(F.when(day == today, F.col(seats)).otherwise(0)).alias("todays_tickets"),
        F.sum(F.when(day == F.date_sub(today, 1), F.col(seats)).otherwise(0)).alias("yesterdays_tickets"),
        F.sum(F.when(F.col(when) >= now - F.expr("INTERVAL 1 HOUR"), F.col(seats)).otherwise(0)).alias("last_hours_tickets"),
    )
    upcoming = board.where(F.col(event) >= today).select(event).orderBy(event).limit(next_n).withColumn("_next", F.lit(True))
    board = board.join(upcoming, event, "left").withColumn("next_5_flag", F.coalesce("_next", F.lit(False))).drop("_next")
    if revenue is not None:
        board = board.join(revenue.groupBy(event).agg(F.sum("gross_revenue").alias("gross_revenue")), event, "left")
    if status is not None:
        taken = F.count_if(F.col("status").isin("SOLD", "HELD"))
        seen = status.join(upcoming.select(event), event, "left_semi").groupBy(event).agg(
            F.count("*").alias("capacity"), ratio(taken, F.count("*")).alias("sell_through"))
        board = board.join(seen, event, "left").withColumn("sell_through", F.coalesce("sell_through", F.lit(0.0)))
    return board.join(games, event, "left") if games is not None else board


def hourly_board(sales: DataFrame, when: str, kind: str, value: Column, as_of) -> DataFrame:
    """Sales per hour and kind for today and yesterday on a dense hour grid.

    Hours up to ``as_of`` without a sale are 0, later ones stay null.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    today = F.to_date(F.lit(as_of))
    recent = sales.where((F.col(when) >= F.date_sub(today, 1).cast("timestamp_ntz")) & (F.col(when) < F.date_add(today, 1).cast("timestamp_ntz")))
    hour = F.date_trunc("hour", when).cast("timestamp_ntz")
    sold = recent.groupBy(hour.alias("sales_hour"), kind).agg(value.alias("sold"))
    days = recent.select(F.to_date(when).alias("day")).distinct()
    hours = sales.select(F.hour(when).alias("h"))
    grid = dense_grid(days, {"h": hours, kind: recent.select(kind)})
    at = (F.col("day").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("h")))
    slots = grid.select(at.alias("sales_hour"), kind)
    return slots.join(sold, ["sales_hour", kind], "left").select(
        "sales_hour", kind, zero_fill_past("sales_hour", "sold", now).alias("sold"))


def goal_grid(reps: DataFrame, events: DataFrame, facts: DataFrame, rep: str, event: str, keys: Sequence[str]) -> DataFrame:
    """Each rep at each event with its sales, 0 where there are none."""
    grid = dense_grid(reps, {event: events})
    sums = facts.groupBy(rep, event, *keys).agg(
        F.sum("paid_seats").alias("paid_seats"), F.sum("gross_revenue").alias("gross_revenue"))
    return grid.join(sums, [rep, event], "left").fillna(0, ["paid_seats", "gross_revenue"])


def trailing_days_grid(facts: DataFrame, rep: str, day: str, as_of, days: int = 7) -> DataFrame:
    """Each rep on each sale day of the trailing week with its sales."""
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    sold = facts.where(F.col(day) >= since)
    reps = facts.select(rep).where(F.col(rep).isNotNull()).distinct()
    sums = sold.groupBy(rep, day).agg(F.sum("paid_seats").alias("paid_seats"), F.sum("gross_revenue").alias("gross_revenue"))
    return dense_grid(reps, {day: sold.select(day)}).join(sums, [rep, day], "left").fillna(0, ["paid_seats", "gross_revenue"])


def cycle_tracker(sales: DataFrame, start: str, end: str, kinds: Sequence[str], levels: Sequence[str]) -> DataFrame:
    """Seats and revenue per day of the sales cycle, type and level on a dense grid; early sales count on day 0."""
    first = F.lit(start).cast("date")
    per_day = sales.groupBy(
        F.greatest(days_between(first, "transaction_date"), F.lit(0)).alias("day_in_sales_cycle"), "ticket_type", "arena_level"
    ).agg(F.sum("paid_seats").alias("num_seats"), F.sum("gross_revenue").alias("gross_revenue"))
    days = sales.sparkSession.range(1).select(
        F.explode(F.sequence(first, F.lit(end).cast("date"), F.expr("interval 1 day"))).alias("sale_date"))
    grid = dense_grid(days, {"ticket_type": kinds, "arena_level": levels}).withColumn(
        "day_in_sales_cycle", F.abs(days_between(first, "sale_date")))
    return grid.join(per_day, ["day_in_sales_cycle", "ticket_type", "arena_level"], "left").fillna(0, ["num_seats", "gross_revenue"])


def event_series(df: DataFrame, name: str, when: str) -> DataFrame:
    """Number of events and first-to-last date text per series and year, joined back to the rows."""
    keyed = df.withColumn("event_name_year", F.concat(F.col(name), F.year(when).cast("string")))
    series = keyed.groupBy("event_name_year").agg(
        F.countDistinct(when).alias("num_events"), F.min(when).alias("_a"), F.max(when).alias("_b"))
    return keyed.join(series, "event_name_year").withColumn("event_range", date_range_text("_a", "_b")).drop("_a", "_b")


def game_descriptors(games: DataFrame, day: str = "event_date", season: str = "season") -> DataFrame:
    """Weekday group, trimester, holiday windows, density and rest days per game."""
    d = F.col(day)
    m, dom = F.month(d), F.dayofmonth(d)
    week = F.dayofweek(d) - 1
    # the fourth Thursday of November, which the stated years agree with
    first = F.dayofweek(F.make_date(F.year(d), F.lit(11), F.lit(1)))
    thanksgiving = F.pmod(F.lit(5) - first, F.lit(7)) + 22
    near = {
        "is_thanksgiving": (m == 11) & dom.between(thanksgiving - 3, thanksgiving + 3),
        "is_christmas": (m == 12) & dom.between(21, 27),
        "is_nye": ((m == 12) & dom.between(29, 31)) | ((m == 1) & dom.between(1, 4)),
    }
    holiday = near["is_thanksgiving"] | near["is_christmas"] | near["is_nye"]
    described = games.withColumns({
        "week_day": lookup(week, {6: 1, 5: 2, 0: 2}, 3),
        "trimester": first_match([(m.between(9, 11), 1), ((m < 2) | (m == 12), 2)], 3),
        **{k: v.cast("int") for k, v in near.items()},
        "is_holiday": holiday.cast("int"),
    })
    ring = within_year_density(games, [], day) if season is None else within_year_density(games, [season], day)
    rest = day_density(games, [season], day).select(season, day, "days_before", "days_after")
    return described.join(ring, [season, day]).join(rest, [season, day]).withColumn(
        "is_dense", (F.col("density") >= 3).cast("int"))


def tier_history(facts: DataFrame, games: DataFrame) -> DataFrame:
    """Mean revenue, seats and price per game by tier and season, with the change to the season before."""
    per_type = facts.groupBy("event_date", "ticket_type", "arena_level").agg(
        F.sum("gross_revenue").alias("r"), F.sum("paid_seats").alias("p")).withColumn("atp", ratio("r", "p"))
    per_game = per_type.groupBy("event_date").agg(
        F.sum("r").alias("gross_revenue"), F.sum("p").alias("paid_seats"), F.avg("atp").alias("gross_atp"))
    measures = ["gross_revenue", "paid_seats", "gross_atp"]
    by_tier = per_game.join(games.select("event_date", "season", "tier"), "event_date").groupBy("tier", "season").agg(
        *[F.avg(c).alias(c) for c in measures])
    return change_from_previous(by_tier, ["tier"], "season", measures)


def season_equivalents(facts: DataFrame) -> DataFrame:
    """Full-season equivalents of member tickets per season, with growth.

    ``change_from_previous`` has one row per season here.
    """
    games = lookup("ticket_type", {
        "Annual Suites": fixed.GAMES_PER_SEASON, "Full": fixed.GAMES_PER_SEASON, "Half": fixed.HALF_GAMES, "Premier": fixed.PREMIER_GAMES})
    per = facts.where(F.col("ticket_type").isin("Full", "Annual Suites", "Premier", "Half")).groupBy("season", "ticket_type").agg(
        F.sum("paid_seats").alias("p"))
    equal = F.when(F.col("ticket_type").isin("Annual Suites", "Full"), F.round(F.col("p") / games, 2)).otherwise(F.col("p") / games)
    total = per.groupBy("season").agg(F.sum(equal).alias("fse_calc")).withColumn("_all", F.lit(1))
    return change_from_previous(total, ["_all"], "season", ["fse_calc"]).drop("_all")


def singles_share(facts: DataFrame, games_per_season: int, venue_capacity: float) -> DataFrame:
    """Single-game seats as a share of the capacity that plans leave open, per season."""
    per = facts.groupBy("season").agg(
        (F.sum(F.when(F.col("ticket_type") == "Singles", F.col("paid_seats")).otherwise(0)) / games_per_season).alias("singles"),
        (F.sum(F.when(F.col("ticket_type") != "Singles", F.col("paid_seats")).otherwise(0)) / games_per_season).alias("others"),
    )
    return per.select(
        "season", "singles", (F.lit(venue_capacity) - F.col("others")).alias("capacity"),
        ratio("singles", F.lit(venue_capacity) - F.col("others")).alias("per_sold"))


def attendance_history(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Paid and comp seats sold and attended per key over several tables."""
    rows = tables[0]
    for other in tables[1:]:
        rows = rows.unionByName(other)
    came = F.col("did_attend").cast("int")
    return rows.groupBy(*keys).agg(
        F.sum("paid_seats").alias("paid_seats"),
        F.sum("comp_seats").alias("comp_seats"),
        F.sum(F.when(~F.col("is_comp"), came).otherwise(0)).alias("paid_attended"),
        F.sum(F.when(F.col("is_comp"), came).otherwise(0)).alias("comp_attended"),
    )


def market_counties(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, Mapping[str, str]],
    counties: Mapping[str, Sequence[str | None]] = fixed.MARKET_COUNTIES,
) -> DataFrame:
    """One row per market from one column pair per market, with the market's counties.

    All markets come out of one pass: each row explodes into an array of structs.
    """
    parts = [
        F.struct(
            *[F.col(source).alias(name) for name, source in measures[market].items()],
            *[F.lit(c).cast("string").alias(f"county_{i}") for i, c in enumerate(names, 1)],
        )
        for market, names in counties.items()
    ]
    return df.select(*keys, F.explode(F.array(*parts)).alias("m")).select(*keys, "m.*")
