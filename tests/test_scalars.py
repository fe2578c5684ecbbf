import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from turnstone.functions import fixed_values as fixed
from turnstone.functions import scalars as s
from turnstone.functions.rules import apply_rules
from turnstone.operators import encoding


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_last_match_keeps_the_latest_true_rule_and_the_default(frame):
    df = frame([(1,), (5,), (50,)], "x int")
    label = s.last_match([(F.col("x") > 2, "big"), (F.col("x") > 20, "huge")], "none")
    assert values(df, label) == ["none", "big", "huge"]
    assert values(df, s.first_match([(F.col("x") > 2, "big"), (F.col("x") > 20, "huge")], "none")) == ["none", "big", "big"]


def test_null_condition_does_not_match(frame):
    df = frame([(None,), (3,)], "x int")
    assert values(df, s.last_match([(F.col("x") > 2, "big")], "none")) == ["none", "big"]


def test_rule_tables_follow_order_and_negation(frame):
    df = frame([("a", True), ("a", False), ("b", None)], "k string, late boolean")
    out = apply_rules(
        df, {"a": F.col("k") == "a", "late": F.col("late")},
        {"t": [("first", 0.1, ["a"]), ("second", 0.2, ["a", "late"]), ("third", 0.3, ["not a"])]},
        {"t": [("label", "none"), ("rate", 0.0)]})
    assert [tuple(r) for r in out.select("label", "rate").collect()] == [("second", 0.2), ("first", 0.1), ("third", 0.3)]
    assert out.columns == ["k", "late", "label", "rate"]


def test_cut_edges_right_and_left_closed(frame):
    df = frame([(0.0,), (0.5,), (0.75,), (1.0,), (1.1,), (None,)], "p double")
    edges, labels = fixed.SCORE_EDGES
    assert values(df, s.cut("p", edges, labels)) == [None, "Tier 4", "Tier 3", "Tier 1", None, None]
    edges, labels = fixed.ATTENDANCE_EDGES
    n = frame([(0,), (1,), (6,), (11,), (-1,)], "n int")
    assert values(n, s.cut("n", edges, labels, right=False)) == ["Tier 4", "Tier 3", "Tier 2", "Tier 1", None]


def test_season_cutoffs_and_next_season(frame):
    df = frame([(dt.date(2024, 6, 30),), (dt.date(2024, 7, 1),), (dt.date(1999, 9, 1),)], "d date")
    assert values(df, s.season_of("d")) == ["2023-24", "2024-25", "1999-00"]
    assert values(df, s.season_of("d", 9)) == ["2023-24", "2023-24", "1999-00"]
    assert values(df, s.next_season(s.season_of("d"))) == ["2024-25", "2025-26", "2000-01"]


def test_days_between_and_dow0(frame):
    df = frame([(dt.date(2024, 3, 1), dt.date(2024, 3, 3))], "a date, b date")
    assert values(df, s.days_between("a", "b")) == [2]
    assert values(df, s.dow0("b")) == [0]  # a Sunday


def test_days_out_buckets_meet_without_gaps(frame):
    df = frame([(d,) for d in (-5, 0, 1, 3, 4, 7, 8, 14, 15, 30, 31, 60, 61, 90, 91, 400)], "d int")
    assert [b[0] for b in values(df, s.days_out_bucket("d"))] == list("AABBCCDDEEFFGGHH")
    assert values(frame([(None,)], "d int"), s.days_out_bucket("d")) == ["Unknown"]


def test_logs_of_zero_and_bad_numbers(frame):
    df = frame([(0.0,), (math.e,), (None,)], "x double")
    assert values(df, F.round(s.log_or_zero("x"), 6)) == [0.0, 1.0, 0.0]
    bad = frame([(float("inf"),), (float("nan"),), (2.0,)], "x double")
    assert values(bad, s.finite_or_zero("x")) == [0.0, 0.0, 2.0]


def test_whole_number_truncates_and_forgives(frame):
    df = frame([("12.9",), ("-3.7",), ("abc",), (None,)], "t string")
    assert values(df, s.whole_number("t")) == [12, -3, None, None]


def test_row_sum_and_mean_skip_nulls(frame):
    df = frame([(1.0, None, 3.0), (None, None, None)], "a double, b double, c double")
    assert values(df, s.row_sum(["a", "b", "c"])) == [4.0, 0.0]
    assert values(df, s.row_mean(["a", "b", "c"])) == [2.0, None]


def test_lookup_and_label(frame):
    df = frame([("A",), ("Q",), (None,)], "k string")
    assert values(df, s.lookup("k", fixed.TIER_NUMBER, 0)) == [5, 0, 0]
    assert values(df, s.lookup("k", fixed.TIER_NUMBER)) == [5, None, None]
    assert values(df, s.label_of("k", fixed.ARENA_LEVEL_INTERNAL, "Other")) == ["Lowers", "Uppers", "Other"]


def test_clamp_and_ratio(frame):
    df = frame([(-1.0, 5.0), (9.0, 5.0), (3.0, 0.0)], "x double, cap double")
    assert values(df, s.clamp("x", "cap")) == [0.0, 5.0, 0.0]
    assert values(df, s.ratio("x", "cap")) == [-0.2, 1.8, None]


@pytest.mark.parametrize("most", [3, 1000])
def test_codes_of_few_and_many_categories(spark, most):
    names = [f"c{i:03}" for i in range(60)]
    rows = [(i, names[(i * 37) % 60]) for i in range(300)] + [(900, None)]
    df = spark.createDataFrame(rows, "i int, c string").repartition(5)
    got = {r.i: r.code for r in encoding.label_codes(df, "c", "code", most).collect()}
    assert got == {i: None if c is None else names.index(c) for i, c in rows}
    first = {}
    for i, c in rows:
        if c is not None:
            first.setdefault(c, len(first))
    got = {r.i: r.code for r in encoding.first_seen_codes(df, "c", "i", "code", most).collect()}
    assert got == {i: first.get(c) for i, c in rows}
