"""Bucketed scans against pandas, with one key holding most of the rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from turnstone.operators import scan
from turnstone.operators.joins import asof_backward, not_in, value_on_first_row, within_window
from turnstone.operators.sampling import fill_to, ordered_split


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(7)
    n = 3000
    key = np.where(rng.random(n) < 0.5, "hot", rng.integers(0, 20, n).astype(str))
    t = pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 90 * 86400, n), unit="s")
    return pd.DataFrame({"key": key, "id": np.arange(n), "t": t, "v": rng.integers(-50, 50, n).astype(float)})


def test_running_sum_row_number_and_previous(spark, rows):
    df = spark.createDataFrame(rows)
    bucket = F.date_trunc("day", "t")
    got = scan.prefix_scan(df, ["key"], ["t", "id"], bucket, sums={"s": F.col("v"), "n": F.lit(1)})
    got = scan.previous_value(got, ["key"], ["t", "id"], bucket, "v", "before").toPandas().sort_values("id")
    want = rows.sort_values(["key", "t", "id"])
    want["s"] = want.groupby("key")["v"].cumsum()
    want["n"] = want.groupby("key").cumcount() + 1
    want["before"] = want.groupby("key")["v"].shift(1)
    want = want.sort_values("id")
    for c in ("s", "n", "before"):
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float))


def test_exclusive_sum_leaves_the_row_out(spark, rows):
    df = spark.createDataFrame(rows)
    out = scan.prefix_scan(df, ["key"], ["t", "id"], F.date_trunc("week", "t"), sums={"s": F.col("v")}, exclusive=True)
    got = out.toPandas().sort_values("id")
    w = rows.sort_values(["key", "t", "id"])
    w["s"] = w.groupby("key")["v"].cumsum() - w["v"]
    np.testing.assert_allclose(got["s"].fillna(0), w.sort_values("id")["s"])


@pytest.mark.parametrize("method", ["max", "min", "average"])
@pytest.mark.parametrize("descending", [False, True])
def test_ranks_with_ties(spark, rows, method, descending):
    df = spark.createDataFrame(rows)
    got = scan.rank_by_value(df, ["key"], "v", F.floor(F.col("v") / 5), method, descending).toPandas().sort_values("id")
    want = rows.groupby("key")["v"].rank(method, ascending=not descending)
    np.testing.assert_allclose(got["rank"].astype(float), want)


@pytest.mark.parametrize("how", ["linear", "midpoint", "lower", "higher"])
def test_exact_quantiles(spark, rows, how):
    df = spark.createDataFrame(rows)
    qs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.95, "e": 1.0}
    got = scan.exact_quantiles(df, ["key"], "v", qs, F.floor(F.col("v") / 7), how).toPandas().set_index("key")
    for name, q in qs.items():
        want = rows.groupby("key")["v"].quantile(q, interpolation=how)
        np.testing.assert_allclose(got[name].sort_index(), want.sort_index())


def test_midpoint_of_four_values(frame):
    df = frame([(float(x),) for x in (1, 2, 4, 9)], "v double")
    got = scan.exact_quantiles(df, [], "v", {"q": 0.5}, F.lit(0), "midpoint").first()["q"]
    assert got == 3.0


@pytest.mark.parametrize("size", [40, 500, 10**6])
def test_asof_matches_merge_asof(spark, rows, size):
    left = rows[rows.id % 3 == 0].rename(columns={"t": "bought"})[["key", "id", "bought"]]
    right = rows[rows.id % 3 == 1].rename(columns={"t": "called", "v": "score"})[["key", "called", "score"]]
    right = right.sort_values(["called", "score"]).drop_duplicates(["key", "called"], keep="last")
    got = asof_backward(
        spark.createDataFrame(left), spark.createDataFrame(right), "key", "bought", "called", size, ["score"]
    ).toPandas().sort_values("id")
    want = pd.merge_asof(left.sort_values("bought"), right.sort_values("called"), left_on="bought", right_on="called", by="key").sort_values("id")
    assert got["called"].astype("datetime64[ns]").fillna(pd.Timestamp(0)).tolist() == want["called"].astype("datetime64[ns]").fillna(pd.Timestamp(0)).tolist()
    np.testing.assert_allclose(got["score"].astype(float), want["score"])


def test_asof_equal_time_matches_and_null_keys_stay(frame):
    buys = frame([("a", 1, "2024-01-02"), ("a", 2, "2024-01-01"), (None, 3, "2024-01-05"), ("b", 4, "2024-01-05")], "k string, id int, b string")
    calls = frame([("a", "2024-01-02"), ("a", "2024-01-03"), (None, "2024-01-01")], "k string, c string")
    buys, calls = buys.withColumn("b", F.to_timestamp("b")), calls.withColumn("c", F.to_timestamp("c"))
    got = {r["id"]: r["c"] for r in asof_backward(buys, calls, "k", "b", "c").collect()}
    assert str(got[1]) == "2024-01-02 00:00:00"
    assert got[2] is None and got[3] is None and got[4] is None


def test_not_in_null_semantics(frame):
    df = frame([("a",), ("b",), (None,)], "k string")
    listed, with_null, none = frame([("a",)], "k string"), frame([("a",), (None,)], "k string"), frame([], "k string")
    def got(other, aware):
        return sorted([r[0] for r in not_in(df, other, "k", aware).collect()], key=str)
    assert got(listed, True) == ["b"]
    assert got(with_null, True) == []
    assert got(none, True) == [None, "a", "b"]
    assert got(with_null, False) == [None, "b"]


def test_value_only_on_first_row(frame):
    df = frame([("a", "x", 5.0), ("a", "y", 5.0), ("b", "y", 2.0)], "k string, p string, v double")
    got = {(r["k"], r["p"]): r["d"] for r in value_on_first_row(df, ["k"], "p", "v", "d").collect()}
    assert got == {("a", "x"): 5.0, ("a", "y"): 0.0, ("b", "y"): 2.0}


def test_fill_to_k(frame):
    df = frame([(i, float(i % 7)) for i in range(50)], "id int, p double")
    out = fill_to(df, F.col("id") % 10 == 0, ["p", "id"], 12).collect()
    assert len(out) == 12 and {0, 10, 20, 30, 40} <= {r["id"] for r in out}
    rest = sorted((r["p"], r["id"]) for r in out if r["id"] % 10)
    assert rest == sorted((float(i % 7), i) for i in range(50) if i % 10)[:7]
    assert len(fill_to(df, F.col("id") < 40, ["p", "id"], 12).collect()) == 40


def test_ordered_split_is_the_first_share(frame):
    df = frame([(i,) for i in range(100)], "id int")
    got = ordered_split(df, "id", 0.67, F.floor(F.col("id") / 9)).where("is_train").agg(F.count("id"), F.max("id")).first()
    assert tuple(got) == (67, 66)


def test_null_keys_form_a_group(frame):
    rows = frame([(None, 1, 5), (None, 2, 7), (None, 11, 1), ("a", 3, 2), ("a", 12, None)], "k string, at int, v int")
    bucket = F.floor(F.col("at") / 10)
    numbers = {(r.k, r.at): r.n for r in scan.row_numbers(rows, ["k"], ["at"], bucket, "n").collect()}
    assert numbers == {(None, 1): 1, (None, 2): 2, (None, 11): 3, ("a", 3): 1, ("a", 12): 2}
    ranks = {(r.k, r.v): r["rank"] for r in scan.rank_by_value(rows, ["k"], "v", F.col("v") % 2 * 0).collect()}
    assert ranks[None, 7] == 3 and ranks["a", 2] == 1 and ranks["a", None] is None
    quantiles = {r.k: r.q for r in scan.exact_quantiles(rows, ["k"], "v", {"q": 0.5}, F.col("v") * 0).collect()}
    assert quantiles == {None: 5, "a": 2}


def test_buckets_follow_the_data_and_cut_a_hot_key(spark, rows):
    last = pd.DataFrame({"key": ["hot", "3"], "id": [9000, 9001], "t": pd.to_datetime(["2261-12-31", None]), "v": [1.0, 2.0]})
    all_rows = pd.concat([rows, last])  # one time far off, one missing
    df = spark.createDataFrame(all_rows)
    bucket = scan.even_buckets(df, scan.seconds("t"), rows=200)
    placed = bucket.of(df, "b")
    sizes = [r["count"] for r in placed.groupBy("b").count().collect()]
    hot = [r["count"] for r in placed.where("key = 'hot'").groupBy("b").count().collect()]
    assert max(sizes) <= 400 and len(bucket.borders) == 15 and max(hot) <= 400 < sum(hot) / 3
    got = scan.row_numbers(df, ["key"], ["t", "id"], bucket, "n").toPandas().sort_values("id")
    want = all_rows.sort_values(["key", "t", "id"], na_position="first")
    want["n"] = want.groupby("key").cumcount() + 1
    np.testing.assert_array_equal(got["n"], want.sort_values("id")["n"])
    for value in (F.lit(None).cast("double"), F.lit(3)):
        assert scan.even_buckets(df, value, rows=200).of(df, "b").select("b").distinct().count() <= 2
    assert scan.even_buckets(df.limit(0), F.col("v")).borders == []


def test_ranks_and_quantiles_over_sketched_borders(spark, rows):
    df = spark.createDataFrame(rows)
    bucket = scan.even_buckets(df, F.col("v"), rows=100)
    assert len(bucket.borders) > 5
    got = scan.rank_by_value(df, ["key"], "v", bucket, "average", True).toPandas().sort_values("id")
    np.testing.assert_allclose(got["rank"].astype(float), rows.groupby("key")["v"].rank("average", ascending=False))
    q = scan.exact_quantiles(df, ["key"], "v", {"q": 0.3}, bucket).toPandas().set_index("key")["q"].sort_index()
    np.testing.assert_allclose(q, rows.groupby("key")["v"].quantile(0.3).sort_index())


@pytest.mark.parametrize("size", [50, 10**6])
def test_windows_meet_facts_by_key_and_stretch(spark, rows, size):
    facts = spark.createDataFrame(rows)
    draw = np.random.default_rng(3)
    some = rows.sample(60, random_state=1)[["key", "t"]].reset_index(drop=True)
    windows = pd.DataFrame({"key": some["key"], "w": np.arange(60), "low": some["t"], "high": some["t"] + pd.to_timedelta(draw.integers(-2, 40, 60), unit="D")})
    frame = spark.createDataFrame(windows).unionByName(spark.createDataFrame([("hot", 99, None, None)], "key string, w long, low timestamp, high timestamp"))
    got = within_window(facts, frame, "key", "t", "low", "high", size).select("w", "id").toPandas()
    both = rows.merge(windows, on="key")
    want = both[(both["t"] >= both["low"]) & (both["t"] <= both["high"])]
    assert sorted(zip(got.w, got.id)) == sorted(zip(want.w, want.id)) and len(want) > 1000
