import datetime as dt

from pyspark.sql import functions as F

from turnstone.operators import aggregates as agg
from turnstone.operators import grid, windows


def day(n, year=2024, month=1):
    return dt.date(year, month, 1) + dt.timedelta(days=n)


def test_streak_restarts_after_a_miss_and_per_client(frame):
    came = [1, 1, 0, 1, 1, 1]
    rows = [("a", day(i), bool(x)) for i, x in enumerate(came)] + [("b", day(5), True), ("b", day(5), False)]
    out = windows.streaks(frame(rows, "c string, d date, a boolean"), "c", "d", "a").orderBy("c", "d").collect()
    assert [r["streak"] for r in out if r["c"] == "a"] == [1, 2, 0, 1, 2, 3]
    assert [(r["streak"], r["is_most_recent"]) for r in out if r["c"] == "b"] == [(1, True)]


def test_fill_forward_keeps_leading_gap(frame):
    df = frame([("k", 0, None), ("k", 1, 5.0), ("k", 2, None), ("k", 3, 7.0), ("k", 4, None)], "k string, s int, v double")
    assert [r["v"] for r in grid.fill_forward(df, ["k"], ["s"], "v").orderBy("s").collect()] == [None, 5.0, 5.0, 7.0, 7.0]


def test_booking_curve(frame):
    df = frame([("k", 1, 2.0), ("k", 1, 3.0), ("k", 3, 5.0)], "k string, s int, v double")
    out = grid.booking_curve(df, ["k"], "s", "v", [0, 1, 2, 3, 4]).orderBy("s").collect()
    assert [r["cumulative"] for r in out] == [0, 5, 5, 10, 10]
    assert [r["share_of_final"] for r in out] == [0, 0.5, 0.5, 1, 1]


def test_grid_size_is_the_product(frame):
    base, axis = frame([(1,), (2,), (3,)], "a int"), frame([("x",), ("y",), ("x",)], "b string")
    assert grid.dense_grid(base, {"b": axis, "c": [1, 2, 3, 4]}).count() == 3 * 2 * 4


def test_past_gaps_are_zero_and_future_gaps_null(frame):
    df = frame([(1, None), (2, 4), (3, None)], "h int, v int")
    assert [r[0] for r in df.select(grid.zero_fill_past("h", "v", 2)).collect()] == [0, 4, None]


def test_density_counts_days_once_with_inclusive_edges(frame):
    df = frame([("t", day(0)), ("t", day(0)), ("t", day(3)), ("t", day(4)), ("t", day(30))], "k string, d date")
    got = {r["d"]: (r["density"], r["days_before"], r["days_after"]) for r in windows.day_density(df, ["k"], "d").collect()}
    assert got == {day(0): (2, None, 3), day(3): (3, 3, 1), day(4): (2, 1, 26), day(30): (1, 26, None)}


def test_density_wraps_inside_the_year(frame):
    df = frame([("t", dt.date(2023, 1, 1)), ("t", dt.date(2023, 12, 30)), ("t", dt.date(2022, 12, 31))], "k string, d date")
    got = {r["d"]: r["density"] for r in windows.within_year_density(df, ["k"], "d").collect()}
    assert got == {dt.date(2023, 1, 1): 2, dt.date(2023, 12, 30): 2, dt.date(2022, 12, 31): 1}


def test_back_to_back(frame):
    df = frame([("t", day(0)), ("t", day(1)), ("t", day(5))], "k string, d date")
    assert [r["back_to_back"] for r in windows.back_to_back(df, ["k"], "d").orderBy("d").collect()] == [1, 2, 0]


def test_expanding_and_trailing_means(frame):
    df = frame([("s", 1, 2.0), ("s", 2, None), ("s", 3, 4.0), ("s", 4, 6.0)], "k string, o int, v double")
    assert [r["m"] for r in windows.expanding_mean(df, ["k"], ["o"], "v", "m").orderBy("o").collect()] == [2.0, None, 3.0, 4.0]
    assert [r["m"] for r in windows.trailing_mean(df, ["k"], ["o"], "v", 3, "m").orderBy("o").collect()] == [None, 2.0, 2.0, 3.0]


def test_percent_of_final_runs_from_far_to_near(frame):
    df = frame([("e", 10, 2), ("e", 5, 3), ("e", 0, 5)], "k string, d int, v int")
    out = windows.percent_of_final(df, ["k"], "d", "v").orderBy(F.col("d").desc()).collect()
    assert [(r["cumulative"], r["share_in"], r["left"]) for r in out] == [(2, 0.2, 10), (5, 0.5, 8), (10, 1.0, 5)]


def test_weighted_mean_counts_the_weight_of_a_null(frame):
    df = frame([("a", 1.0, 0.5), ("a", 1.0, None)], "k string, w double, r double")
    assert agg.weighted_mean(df, ["k"], "w", {"m": "r"}).first()["m"] == 0.25


def test_status_precedence(frame):
    df = frame([("s1", "HELD"), ("s1", "COMP"), ("s2", "AVAIL"), ("s2", "SOLD"), ("s3", "AVAIL")], "k string, status string")
    got = {r["k"]: r["status"] for r in agg.strongest_status(df, ["k"], "status", ["COMP", "SOLD", "HELD", "AVAIL"]).collect()}
    assert got == {"s1": "COMP", "s2": "SOLD", "s3": "AVAIL"}


def test_tenure_is_the_run_that_ends_at_the_latest_season(frame):
    rows = [("a", y) for y in (2018, 2020, 2021, 2022)] + [("b", 2020), ("c", 2022), ("c", 2022), ("d", 2022), ("d", 2021), ("d", 2025)]
    got = {r["k"]: r["tenure"] for r in agg.consecutive_tenure(frame(rows, "k string, y int"), "k", "y", 2022).collect()}
    assert got == {"a": 3, "b": 0, "c": 1, "d": 2}


def test_total_rows_and_missing_report(frame):
    df = frame([("s", "a", 1), ("s", "b", None), ("t", "a", 5)], "k string, c string, v int")
    got = {(r["k"], r["c"]): r["n"] for r in agg.with_total_rows(df, ["k"], "c", "total", [F.sum("v").alias("n")]).collect()}
    assert got == {("s", "a"): 1, ("s", "b"): None, ("s", "total"): 1, ("t", "a"): 5, ("t", "total"): 5}
    report = {r["column_name"]: r["missing"] for r in agg.missing_report(df, ["c", "v"]).collect()}
    assert report == {"c": 0, "v": 1}


def test_fill_with_mean(frame):
    df = frame([(1.0,), (None,), (3.0,)], "v double")
    assert [r["v"] for r in agg.fill_with_mean(df, ["v"]).collect()] == [1.0, 2.0, 3.0]


def test_modal_value_tie(frame):
    df = frame([("a", "x"), ("a", "y"), ("a", "y"), ("a", "x"), ("b", "z")], "k string, v string")
    got = {r["k"]: r["v"] for r in agg.modal_value(df, "k", "v", F.when(F.col("v") == "y", 1).otherwise(2)).collect()}
    assert got == {"a": "y", "b": "z"}
