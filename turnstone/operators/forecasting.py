"""Forecast composition: curves, rates, prices, allocations and stitching."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstone.functions import fixed_values as fixed
from turnstone.functions.scalars import first_match, lookup, ratio
from turnstone.operators.aggregates import season_weighted_mean
from turnstone.operators.grid import dense_grid, running_total
from turnstone.operators.scan import rank_by_value
from turnstone.operators.windows import percent_of_final, share_of_group


def scale_up_by_curve(
    facts: DataFrame, event: str, group: str, days_out: str, value: str, is_current: Column
) -> DataFrame:
    """Final value of running events: what is in so far over the usual share in at that day out.

    Facts are reduced to one row per event and day; the usual share is the mean
    over past events of the same group and day.
    """
    daily = facts.groupBy(event, group, days_out).agg(F.sum(value).alias("v"), F.max(is_current).alias("_now"))
    curves = percent_of_final(daily, [event, group], days_out, "v")
    usual = curves.where(~F.col("_now")).groupBy(group, days_out).agg(F.avg("share_in").alias("avg_share_in"))
    now = curves.where("_now").join(usual, [group, days_out], "left").withColumn(
        "projected", F.col("cumulative") / F.nullif("avg_share_in", F.lit(0.0)))
    return now.groupBy(event, group).agg(
        F.min(days_out).alias(days_out), F.min_by("cumulative", days_out).alias("cumulative"), F.min_by("projected", days_out).alias("projected"))


def show_rates_by(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attended over sold seats for paid and comp tickets, with double division."""
    came = F.col("did_attend")
    return facts.groupBy(*keys).agg(
        ratio(F.sum(F.when(came, F.col("paid_seats")).otherwise(0)), F.sum("paid_seats")).alias("paid_show_rate"),
        ratio(F.sum(F.when(came, F.col("comp_seats")).otherwise(0)), F.sum("comp_seats")).alias("comp_show_rate"),
    )


def turnstile(rates: DataFrame, sold: DataFrame, group: str, season: str, weights: Mapping[str, float]) -> DataFrame:
    """Expected gate count: seats sold times the season-weighted paid and comp show rates of their group."""
    weighted = season_weighted_mean(
        rates.where(F.col(season).isin(list(weights))), [group], season, weights,
        {"weighted_paid_average": "paid_show_rate", "weighted_comp_average": "comp_show_rate"})
    return sold.join(weighted, group, "left").withColumn(
        "predicted_turnstile", F.col("paid_seats") * F.col("weighted_paid_average"))


def expected_attendance(sold: DataFrame, rates: DataFrame, group: str) -> DataFrame:
    """Paid and comp seats times their show rates."""
    return sold.join(rates, group, "left").withColumn(
        "predicted_attendance",
        F.col("paid_seats") * F.col("paid_show_rate") + F.col("comp_seats") * F.col("comp_show_rate"))


def sold_curve(sales: DataFrame, games: DataFrame, group: str, event: str, place: str, days_out: str, last_day: int) -> DataFrame:
    """Places sold per game on average by day out, cumulated, on a dense day grid."""
    sold = sales.select(group, event, place, days_out).distinct().groupBy(group, days_out).agg(F.count("*").alias("n"))
    per_group = games.groupBy(group).agg(F.countDistinct(event).alias("num_games"))
    grid = dense_grid(per_group, {days_out: list(range(0, last_day + 1))}).join(sold, [group, days_out], "left")
    average = grid.withColumn("avg_sold", ratio(F.coalesce("n", F.lit(0)), "num_games"))
    return running_total(average, [group], [days_out], "avg_sold", "cumulative_avg_sold").select(
        group, days_out, "avg_sold", "cumulative_avg_sold")


def sell_out_flags(status: DataFrame, curve: DataFrame, event: str, keys: Sequence[str]) -> DataFrame:
    """Places per status and event, and whether the usual further sales exceed what is open."""
    counts = status.groupBy(event, *keys).agg(
        *[F.count_if(F.col("status") == x).alias(f"num_{x.lower()}") for x in fixed.STATUS_ORDER])
    return counts.join(curve, list(keys), "left").withColumn(
        "will_sell_out", F.coalesce(F.col("num_avail") <= F.col("cumulative_avg_sold"), F.lit(False)))


# --- parking ------------------------------------------------------------------------------
def prepaid_parking(df: DataFrame, compat: bool = False) -> DataFrame:
    """Bound prepaid passes by lot capacity.

    Needs ``additional``, ``current_prepaid_passes``, ``show_rate``, ``capacity``.
    ``compat`` keeps negative additions and reports parked cars as the remainder;
    by default additions start at 0 and the remainder is what is left.
    """
    add = F.col("additional") if compat else F.greatest(F.col("additional"), F.lit(0.0))
    parked = df.withColumn("additional", add).withColumn(
        "total_prepaid", F.col("current_prepaid_passes") + F.col("additional")
    ).withColumn("parked", F.col("total_prepaid") * F.col("show_rate"))
    over = F.least(F.col("capacity") - F.col("parked"), F.lit(0.0))
    bounded = parked.withColumn("_over", over).withColumns({
        "additional": F.col("additional") + F.col("_over"), "parked": F.col("parked") + F.col("_over")})
    left = F.col("parked") if compat else F.col("capacity") - F.col("parked")
    return bounded.withColumn("capacity_remaining", F.when(F.col("_over") < 0, 0.0).otherwise(left)).drop("_over")


def onsite_parking(df: DataFrame) -> DataFrame:
    """Cars that pay at the gate, bounded by what prepaid cars leave open."""
    return df.withColumn(
        "onsite", F.least(F.greatest(F.col("predicted_onsite"), F.lit(0.0)), F.col("capacity_remaining"))
    ).withColumn("total_parked", F.col("parked") + F.col("onsite"))


def gate_prices(sales: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Prepaid price, the gate price it implies, and the realised average to fall back on."""
    paid = ~F.col("is_comp")
    return sales.groupBy(*keys).agg(
        F.max(F.when(paid, F.col("price"))).alias("prepaid_price"),
        ratio(F.sum("gross_revenue"), F.count("*")).alias("realised"),
    ).withColumn("gate_price", F.coalesce(
        F.col("prepaid_price") / fixed.GATE_PRICE_DIVISOR, F.col("realised") / fixed.GATE_PRICE_DIVISOR)
    ).withColumn("gate_price_gross", F.col("gate_price") * fixed.TAX_DIVISOR)


def parking_revenue(df: DataFrame, use_prepaid_count: bool = False) -> DataFrame:
    """Current revenue plus further prepaid passes and gate cars at their prices.

    ``use_prepaid_count`` prices the gate by further prepaid passes instead of gate cars.
    """
    gate = F.col("additional") if use_prepaid_count else F.col("onsite")
    return df.withColumn(
        "expected_revenue",
        F.coalesce("current_revenue", F.lit(0.0))
        + F.coalesce("prepaid_price", F.col("realised")) * F.col("additional")
        + F.col("gate_price_gross") * gate,
    )


# --- money ----------------------------------------------------------------------------------
def per_caps(revenue: DataFrame, attendance: DataFrame, games: DataFrame, event: str, keys: Sequence[str], base: float) -> DataFrame:
    """Spend per head by group as a mean over events, and its multiple of a base per-cap."""
    per = revenue.groupBy(event).agg(F.sum("gross_revenue").alias("r")).join(attendance, event).withColumn(
        "per_cap", ratio("r", "attendance"))
    return per.join(games, event).groupBy(*keys).agg(F.avg("per_cap").alias("per_cap")).withColumn(
        "multiplier", F.col("per_cap") / F.lit(base))


def projected_revenue(
    predicted: DataFrame, history: DataFrame, current: DataFrame, extra: DataFrame | None,
    keys: Sequence[str], event: str, season: str, weights: Mapping[str, float], factor: float = fixed.RESALE_ATP_FACTOR,
) -> DataFrame:
    """Predicted seats at the season-weighted average price, plus resale uplift and revenue to date."""
    atp = history.where(F.col(season).isin(list(weights))).groupBy(season, *keys).agg(
        ratio(F.sum("gross_revenue"), F.sum("paid_seats")).alias("atp"))
    weighted = season_weighted_mean(atp, keys, season, weights, {"weighted_atp": "atp"}).withColumn(
        "weighted_atp", F.col("weighted_atp") * factor)
    to_date = current.groupBy(event, *keys).agg(F.sum("gross_revenue").alias("current_revenue"))
    out = predicted.join(to_date, [event, *keys], "left").join(weighted, list(keys), "left")
    out = out.join(extra, [event, *keys], "left") if extra is not None else out.withColumn("additional_secondary", F.lit(0.0))
    return out.withColumn("additional_secondary", F.coalesce("additional_secondary", F.lit(0.0))).withColumn(
        "projected_gross_revenue",
        F.col("predicted") * F.col("weighted_atp") + F.col("additional_secondary") + F.col("current_revenue"))


def allocate_budget(plans: DataFrame, games: DataFrame, budget: Column, days_out: str) -> DataFrame:
    """Spread the unsold budget over games by tier share, days-out share within tier and level share."""
    weights = share_of_group(games, ["tier"], days_out, "day_share").select("event_date", "day_share")
    left = budget - plans.agg(F.sum("gross_revenue")).scalar()
    shares = lookup("tier", fixed.REVENUE_SHARE_PER_TIER) * F.col("day_share") * lookup("arena_level", fixed.REVENUE_SHARE_PER_LEVEL)
    return plans.join(weights, "event_date").withColumn(
        "total_expected_revenue", F.col("gross_revenue") + left * shares
    ).withColumn("projected_tickets", ratio("total_expected_revenue", "current_atp"))


def group_growth(history: DataFrame) -> DataFrame:
    """Group tickets per tier and level next season from the budgeted growth."""
    base = history.groupBy("tier", "arena_level").agg(
        (F.sum("gross_revenue") / fixed.GROUP_GAMES).alias("rev"), (F.sum("paid_seats") / fixed.GROUP_GAMES).alias("seats"))
    growth = F.lit(fixed.GROUP_GROWTH) * lookup("arena_level", fixed.REVENUE_SHARE_PER_LEVEL) / lookup("tier", fixed.GAMES_PER_TIER)
    return base.withColumn("projected_tickets", (F.col("rev") * (1 + growth)) / F.nullif(ratio("rev", "seats"), F.lit(0.0)))


def combine_forecasts(parts: Mapping[str, DataFrame], event: str, value: str) -> DataFrame:
    """Forecasts by type stacked and summed per event, with one column per type."""
    stacked = None
    for name, df in parts.items():
        part = df.select(event, F.col(value).alias("v"), F.lit(name).alias("type"))
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy(event).agg(
        F.sum("v").alias(value), *[F.sum(F.when(F.col("type") == n, F.col("v"))).alias(f"{value}_{n}") for n in parts])


def simulate_types(
    seats: DataFrame, event: str, plan_growth: Column, score: str, bucket
) -> DataFrame:
    """Current seats per type, and open seats given to the types they are predicted to become.

    Needs ``ticket_type_group``, ``predicted`` and a plan ``score``.  The open seats
    with the highest score become plans, as many as the growth of sold plans
    allows; ranks come from counted values, so no event is sorted in one task.
    """
    sold = seats.where("ticket_type_group <> 'Not Sold'")
    current = sold.groupBy(event, "ticket_type_group").agg(F.count("*").alias("current_tickets"))
    quota = current.where("ticket_type_group = 'Plans'").select(
        event, F.floor(F.col("current_tickets") * plan_growth).alias("plan_add"))
    ranked = rank_by_value(seats.where("ticket_type_group = 'Not Sold'"), [event], score, bucket, "average", True)
    label = first_match([
        ((F.col("predicted") == "Plans") & (F.col("rank") <= F.coalesce("plan_add", F.lit(0))), "Plans"),
        (F.col("predicted") == "Nightly", "Nightly"),
    ], "Not Sold")
    added = ranked.join(quota, event, "left").groupBy(event, label.alias("ticket_type_group")).agg(
        F.count("*").alias("predicted_additional_tickets"))
    return current.join(added, [event, "ticket_type_group"], "outer")


def stitch(actual: DataFrame, forecast: DataFrame, season: str | None = None, rename: Mapping[str, str] | None = None) -> DataFrame:
    """Actual rows followed by forecast rows; columns only one side has are null on the other."""
    out = actual.unionByName(forecast, allowMissingColumns=True)
    if season:
        out = out.where(F.col("season") == season)
    return out.withColumnsRenamed(dict(rename or {}))
