import datetime as dt

from pyspark.sql import functions as F

from turnstone.operators import customers as ops


def d(text):
    return dt.date.fromisoformat(text)


def test_cohort_split_includes_the_own_season_in_pre(frame):
    cohort = frame([("a", "2022-23"), ("b", "2022-23")], "email string, first string")
    facts = frame([("a", "2021-22", 1.0), ("a", "2022-23", 2.0), ("a", "2022-23", 3.0), ("a", "2023-24", 4.0), ("z", "2022-23", 9.0)], "email string, season string, v double")
    got = {r["email"]: (r["pre_v"], r["post_v"]) for r in ops.split_by_cohort(cohort, facts, "email", "first", "season", {"v": "v"}).collect()}
    assert got == {"a": (6.0, 4.0), "b": (0.0, 0.0)}


def test_email_timing_flags(frame):
    df = frame([("2024-01-01", "2024-01-02"), ("2024-01-02", "2024-01-02"), ("2024-01-03", "2024-01-02"), (None, "2024-01-02")], "a string, j string")
    df = df.select(F.to_date("a").alias("a"), F.to_date("j").alias("j"))
    pre, post = ops.email_timing("a", "j")
    assert [tuple(r) for r in df.select(pre, post).collect()] == [(1, 0), (0, 1), (0, 1), (0, 0)]
    pre, post = ops.email_timing("a", "j", strict=True)
    assert [tuple(r) for r in df.select(pre, post).collect()] == [(1, 0), (0, 0), (0, 1), (0, 0)]


def test_first_touch_folds_case_and_skips_blanks(frame):
    df = frame([("A@x", d("2024-02-01")), ("a@X", d("2024-01-01")), ("", d("2020-01-01")), (None, d("2020-01-01"))], "email string, day date")
    assert [tuple(r) for r in ops.first_touch(df, "email", "day").collect()] == [("a@x", d("2024-01-01"))]


def test_contact_outcomes(frame):
    contacts = frame([("a", "2024-01-01"), ("a", "2024-03-01"), ("b", "2024-01-01")], "k string, contact_date string").withColumn("contact_date", F.to_timestamp("contact_date"))
    buys = frame([("a", "2024-01-11"), ("a", "2024-01-12"), ("b", "2024-06-01"), ("c", "2024-01-01")], "k string, purchase_date string").withColumn("purchase_date", F.to_timestamp("purchase_date"))
    got = sorted((r["k"], str(r["contact_date"])[:10], r["label"]) for r in ops.contact_outcomes(contacts, buys, "k").collect())
    assert got == [("a", "2024-01-01", 1), ("a", "2024-01-01", 1), ("a", "2024-03-01", 0), ("b", "2024-01-01", 0)]


def test_snapshot_is_strictly_before_and_filled(frame):
    base = frame([("a",), ("b",)], "k string")
    contacts = frame([("a", "2024-12-30 12:00:00", "Call"), ("a", "2025-01-01 00:00:00", "Email")], "k string, contact_date string, task_type string")
    buys = frame([("a", "2024-12-01 00:00:00"), ("a", "2024-01-01 00:00:00")], "k string, purchase_date string")
    ntz = "timestamp_ntz"
    out = ops.snapshot_features(
        base, contacts.withColumn("contact_date", F.col("contact_date").cast(ntz)), buys.withColumn("purchase_date", F.col("purchase_date").cast(ntz)), "k", "2025-01-01")
    a, b = [r.asDict() for r in out.orderBy("k").collect()]
    assert (a["total_lifetime_contacts"], a["days_since_last_contact"], a["total_calls"], a["total_emails"]) == (1, 1, 1, 0)
    assert (a["total_purchase_events"], a["days_since_last_purchase"], a["purchases_last_60_days"]) == (2, 31, 1)
    assert b["days_since_last_contact"] == 999 and b["total_purchase_events"] == 0


def test_season_cohort_and_its_window(frame):
    att = frame([("a", d("2024-01-05")), ("b", d("2024-01-05")), ("c", d("2020-01-05"))], "k string, day date")
    members, buyers = frame([("b",)], "k string"), frame([("a",)], "k string")
    cohort = ops.season_cohort(att, "k", "day", members, buyers, "2023-24", "2023-10-01", "2024-06-30")
    assert [(r["k"], r["did_purchase_next_season"]) for r in cohort.collect()] == [("a", 1)]
    facts = frame([("a", d("2023-10-01")), ("a", d("2024-06-30")), ("a", d("2024-07-01"))], "k string, day date")
    assert ops.window_features(cohort, facts, "k", "day", [F.count("*").alias("n")]).first()["n"] == 2
    assert "did_purchase_next_season" not in ops.season_cohort(att, "k", "day", members, None, "s", "2023-10-01", "2024-06-30").columns


def test_program_timeline_keeps_revenue_once(frame):
    signups = frame([("A", "golf", d("2024-01-01"), "2023-24"), ("a", "swim", d("2024-02-01"), "2023-24")], "email string, program string, transaction_date date, season string")
    revenue = frame([("a", "2023-24", d("2024-03-01"), 10.0), ("a", "2022-23", d("2024-03-01"), 4.0)], "email string, season string, add_date date, gross_revenue double")
    out = ops.program_timeline(signups, revenue, frame([("a", "2023-24")], "email string, season string")).collect()
    assert sum(r["gross_rev"] for r in out) == 28.0 and sum(r["gross_rev_dedup"] for r in out) == 14.0
    assert {(r["rev_stm_season"], r["program_data"]) for r in out} == {("2023-24", "during_program_data"), ("2022-23", "pre_program_data")}
    assert sum(r["is_stm_dedup"] for r in out) == 1


def test_engagement_counts_stop_at_the_purchase(frame):
    ev = frame([("a", "2024-01-01", "open"), ("a", "2024-01-01", "open"), ("a", "2024-02-01", "open"), ("b", "2024-02-01", "click")], "k string, t string, kind string").withColumn("t", F.to_timestamp("t"))
    cut = frame([("a", "2024-01-15")], "k string, cutoff string").withColumn("cutoff", F.to_timestamp("cutoff"))
    got = {r["k"]: r.asDict() for r in ops.engagement_counts(ev, cut, "k", "t", "kind", ["open", "click"], F.to_timestamp(F.lit("2024-12-31"))).collect()}
    assert (got["a"]["num_open"], got["a"]["days_open"], got["b"]["num_click"]) == (2, 1, 1)
