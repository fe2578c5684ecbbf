"""Customers: first touch, programs, engagement, renewal and lead features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstone.functions.scalars import first_match, ratio
from turnstone.operators.joins import asof_backward, exists_flag, within_window


# --- identity and programs -------------------------------------------------------------
def first_touch(df: DataFrame, email: str, when: str, season: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """First date (and season) per lower-cased email; empty addresses are not people."""
    address = F.lower(F.col(email))
    firsts = [F.min(when).alias(f"first_{when}")]
    if season:
        firsts.append(F.min(season).alias(f"first_{season}"))
    return df.where(F.col(email).isNotNull() & (F.col(email) != "")).groupBy(address.alias("email"), *keys).agg(*firsts)


def with_email(facts: DataFrame, bridge: DataFrame, contacts: DataFrame, ticketing_id: str) -> DataFrame:
    """Facts with the contact's email over the identity bridge (ticketing id -> contact -> email)."""
    known = bridge.join(contacts, "contact_id").select(F.col("ticketing_id").alias(ticketing_id), "email", "add_date")
    return facts.join(known, ticketing_id)


def split_by_cohort(
    cohort: DataFrame, facts: DataFrame, key: str, cohort_season: str, season: str, measures: Mapping[str, str]
) -> DataFrame:
    """Measures summed over the seasons up to the cohort's own ("pre") and after it ("post").

    "Pre" includes the cohort season.  Facts are reduced to one row per key and
    season before the join, and members without facts keep zeros.
    """
    per = facts.groupBy(key, season).agg(*[F.sum(v).alias(v) for v in measures.values()])
    early = F.col(season) <= F.col(cohort_season)
    sums = []
    for name, source in measures.items():
        sums.append(F.coalesce(F.sum(F.when(early, F.col(source))), F.lit(0)).alias(f"pre_{name}"))
        sums.append(F.coalesce(F.sum(F.when(~early, F.col(source))), F.lit(0)).alias(f"post_{name}"))
    own = [c for c in cohort.columns if c != key]
    return cohort.join(per, key, "left").groupBy(key, *own).agg(*sums)


def email_timing(add_date: str, joined: str, strict: bool = False) -> tuple[Column, Column]:
    """(pre, post) flags: known before joining, or from then on.

    With ``strict`` an address of the same day is neither.
    """
    a, j = F.col(add_date), F.col(joined)
    after = a > j if strict else a >= j
    return (
        F.coalesce((a < j).cast("int"), F.lit(0)),
        F.coalesce(after.cast("int"), F.lit(0)),
    )


def program_effect(
    signups: DataFrame, facts: DataFrame, added: DataFrame, program: str | None = None, strict: bool = False
) -> DataFrame:
    """One program: first sign-up per email, what the member bought before and after, email timing.

    ``signups``: email, program, season, transaction_date.  ``facts``: email,
    season, gross_revenue, member (0/1).  ``added``: email, add_date.
    """
    chosen = signups if program is None else signups.where(F.col("program") == program)
    cohort = first_touch(chosen, "email", "transaction_date", "season")
    joined = cohort.join(added, "email", "left").withColumn(
        "add_date", F.coalesce("add_date", F.lit("2030-01-01").cast("date")))
    held = facts.groupBy("email", "season").agg(
        F.sum("gross_revenue").alias("gross_revenue"), F.max("member").alias("member"))
    out = split_by_cohort(joined, held, "email", "first_season", "season", {"revenue": "gross_revenue", "tickets": "member"})
    pre, post = email_timing("add_date", "first_transaction_date", strict)
    return out.withColumns({"pre_email": pre, "post_email": post})


def program_timeline(signups: DataFrame, revenue: DataFrame, members: DataFrame) -> DataFrame:
    """Every program of an email against each revenue season: before, during or after, new or seen email.

    Season revenue is repeated per program; ``gross_rev_dedup`` keeps it on the
    email's first program of that season only.
    """
    base = signups.groupBy(F.lower("email").alias("email"), "program").agg(
        F.min("transaction_date").alias("joined"), F.min("season").alias("first_program_season"))
    rows = base.join(revenue, "email", "left").join(
        members.withColumn("is_stm", F.lit(1)), ["email", "season"], "left")
    first = base.groupBy("email").agg(F.min("program").alias("_first"))
    rows = rows.join(first, "email")
    shown = F.col("program") == F.col("_first")
    program, season = F.col("first_program_season"), F.col("season")
    return rows.select(
        "email",
        "program",
        "first_program_season",
        season.alias("rev_stm_season"),
        F.when(F.col("add_date") >= F.col("joined"), "new_email").otherwise("email_seen_before").alias("email_status"),
        first_match([(program > season, "pre_program_data"), (program == season, "during_program_data")], "post_program_data").alias("program_data"),
        F.coalesce("gross_revenue", F.lit(0.0)).alias("gross_rev"),
        F.when(shown, F.col("gross_revenue")).otherwise(0.0).alias("gross_rev_dedup"),
        F.coalesce("is_stm", F.lit(0)).alias("is_stm"),
        F.when(shown, F.coalesce("is_stm", F.lit(0))).otherwise(0).alias("is_stm_dedup"),
    )


# --- engagement ---------------------------------------------------------------------------
def engagement_counts(events: DataFrame, cutoffs: DataFrame, key: str, when: str, kind: str, kinds: Sequence[str], as_of) -> DataFrame:
    """Counts per kind, and distinct-day counts, up to each person's purchase or ``as_of``.

    One scan and one aggregate for all kinds.
    """
    known = events.join(cutoffs, key, "left").where(F.col(when) <= F.coalesce("cutoff", F.lit(as_of)))
    per_day = known.groupBy(key, F.to_date(when).alias("_day")).agg(
        *[F.count_if(F.col(kind) == k).alias(k) for k in kinds])
    return per_day.groupBy(key).agg(
        *[F.sum(k).alias(f"num_{k}") for k in kinds],
        *[F.count_if(F.col(k) > 0).alias(f"days_{k}") for k in kinds],
    )


def first_new_purchase(subscriptions: DataFrame, key: str, when: str, renewal: Column) -> DataFrame:
    """Each buyer's first non-renewal purchase."""
    return subscriptions.where(~renewal).groupBy(key).agg(F.min(when).alias("cutoff")).withColumn("did_purchase", F.lit(1))


def labelled_base(base: DataFrame, buyers: DataFrame, key: str) -> DataFrame:
    """The customer base with 1 for those who bought, 0 for the others."""
    return exists_flag(base.select(key).where(F.col(key).isNotNull()).distinct(), buyers, [key], "did_purchase")


def snapshot_features(
    base: DataFrame, contacts: DataFrame, purchases: DataFrame, key: str, snapshot, recent_days: int = 60
) -> DataFrame:
    """Contact and purchase counts and recency strictly before a moment.

    Missing recency is 999 days, missing counts are 0.
    """
    at = F.lit(snapshot).cast("timestamp_ntz")

    def age(latest: Column) -> Column:
        return F.floor((F.unix_micros(at.cast("timestamp")) - F.unix_micros(latest.cast("timestamp"))) / F.lit(86_400_000_000)).cast("long")

    touched = contacts.where(F.col("contact_date") < at).groupBy(key).agg(
        F.count("*").alias("total_lifetime_contacts"),
        age(F.max("contact_date")).alias("days_since_last_contact"),
        F.count_if(F.col("task_type") == "Call").alias("total_calls"),
        F.count_if(F.col("task_type") == "Email").alias("total_emails"),
    )
    bought = purchases.where(F.col("purchase_date") < at).groupBy(key).agg(
        F.count("*").alias("total_purchase_events"),
        age(F.max("purchase_date")).alias("days_since_last_purchase"),
        F.count_if(F.col("purchase_date") >= at - F.make_dt_interval(days=F.lit(recent_days))).alias("purchases_last_60_days"),
    )
    joined = base.join(touched, key, "left").join(bought, key, "left")
    return joined.fillna(999, ["days_since_last_contact", "days_since_last_purchase"]).fillna(
        0, ["total_lifetime_contacts", "total_calls", "total_emails", "total_purchase_events", "purchases_last_60_days"])


def contact_outcomes(contacts: DataFrame, purchases: DataFrame, key: str, within_days: int = 30) -> DataFrame:
    """Label contacts: 1 per purchase that followed within the window, 0 for contacts no purchase followed."""
    nudged = asof_backward(purchases, contacts.select(key, "contact_date"), key, "purchase_date", "contact_date")
    gap = F.unix_micros(F.col("purchase_date").cast("timestamp")) - F.unix_micros(F.col("contact_date").cast("timestamp"))
    wins = nudged.where(F.floor(gap / F.lit(86_400_000_000)).between(0, within_days)).select(key, "contact_date")
    losses = contacts.select(key, "contact_date").join(wins.distinct(), [key, "contact_date"], "left_anti")
    return wins.withColumn("label", F.lit(1)).unionByName(losses.withColumn("label", F.lit(0)))


# --- cohorts -----------------------------------------------------------------------------
def season_cohort(
    attendance: DataFrame, key: str, day: str, members: DataFrame, buyers: DataFrame | None, season: str, start: str, end: str
) -> DataFrame:
    """Who attended in a window without being a member, and whether they bought new the season after.

    ``buyers=None`` gives the unlabelled cohort to score.
    """
    came = attendance.where(F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select(key).distinct()
    cohort = came.join(members.select(key).distinct(), key, "left_anti").select(
        key, F.lit(season).alias("obs_season"), F.lit(start).cast("date").alias("season_start"), F.lit(end).cast("date").alias("season_end"))
    return cohort if buyers is None else exists_flag(cohort, buyers, [key], "did_purchase_next_season")


def window_features(cohorts: DataFrame, facts: DataFrame, key: str, when: str, aggs: Sequence[Column]) -> DataFrame:
    """Aggregates over each member's own observation window, keyed by member and season."""
    inside = within_window(facts, cohorts.select(key, "obs_season", "season_start", "season_end"), key, when, "season_start", "season_end")
    return inside.groupBy(key, "obs_season").agg(*aggs)


def wide_profile(base: DataFrame, parts: Sequence[DataFrame], keys: Sequence[str], zero: Sequence[str] = ()) -> DataFrame:
    """Feature tables, each one row per key, glued to the base by left joins on the same key."""
    out = base
    for part in parts:
        out = out.join(part, list(keys), "left")
    return out.fillna(0, list(zero)) if zero else out


def show_rates(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attended share of paid, comp and all tickets."""
    came = F.col("did_attend").cast("int")
    paid = ~F.col("is_comp")
    return facts.groupBy(*keys).agg(
        ratio(F.sum(F.when(paid, came)), F.count_if(paid)).alias("paid_show_rate"),
        ratio(F.sum(F.when(~paid, came)), F.count_if(~paid)).alias("comp_show_rate"),
        ratio(F.sum(came), F.count("*")).alias("show_rate"),
    )


def priority(probability: str) -> Column:
    p = F.col(probability)
    return first_match([(p >= 0.8, "HOT"), (p >= 0.5, "WARM")], "COLD")
