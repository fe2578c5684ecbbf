import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from turnstone.operators import forecasting as ops
from turnstone.operators.regression import fit_least_squares, forecast_by_group, predict_least_squares


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    n = 600
    df = pd.DataFrame({"g": np.where(rng.random(n) < 0.7, "hot", "cold"), "a": rng.normal(50, 9, n), "b": rng.normal(0, 1, n)})
    df["y"] = 3 * df.a - 7 * df.b + np.where(df.g == "hot", 5, -5) + rng.normal(0, 0.1, n)
    return df


def lstsq(train, new):
    x = np.c_[np.ones(len(train)), train[["a", "b"]]]
    beta = np.linalg.lstsq(x, train.y, rcond=None)[0]
    return np.c_[np.ones(len(new)), new[["a", "b"]]] @ beta


def test_least_squares_per_group(spark, data):
    df = spark.createDataFrame(data)
    out = forecast_by_group(df, df, ["g"], ["a", "b"], "y").toPandas().sort_values(["g", "a"])
    want = pd.concat([g.assign(p=lstsq(g, g)) for _, g in data.groupby("g")]).sort_values(["g", "a"])
    np.testing.assert_allclose(out["predicted"], want["p"], rtol=1e-8)


def test_constant_feature_does_not_break_the_fit(spark, data):
    df = spark.createDataFrame(data.assign(c=1.0))
    model = fit_least_squares(df, [], ["a", "c"], "y")
    out = predict_least_squares(df, model, [], ["a", "c"], "p")
    assert out.agg(F.avg(F.col("p") - F.col("y"))).first()[0] == pytest.approx(0, abs=1e-6)


def test_independent_scaling_standardises_the_new_rows(spark, data):
    df, new = spark.createDataFrame(data), data.assign(a=data.a + 100)
    model = fit_least_squares(df, [], ["a", "b"], "y")
    same = predict_least_squares(df, model, [], ["a", "b"], "p").toPandas().sort_values("b")["p"]
    moved = predict_least_squares(spark.createDataFrame(new), model, [], ["a", "b"], "p", "independent").toPandas().sort_values("b")["p"]
    np.testing.assert_allclose(same, moved, rtol=1e-8)


def test_bounds_and_whole_numbers(frame):
    history = frame([(1.0, 10.0), (2.0, 20.0), (3.0, 30.0)], "x double, y double")
    rows = frame([(10.0, 50.0), (-5.0, 50.0), (2.25, 50.0)], "x double, cap double")
    got = [r["predicted"] for r in forecast_by_group(history, rows, [], ["x"], "y", capacity="cap", whole=True).collect()]
    assert got == [50, 0, 22]


PARK = "additional double, current_prepaid_passes double, show_rate double, capacity double, predicted_onsite double"


def test_parking_overflow_and_compat(frame):
    df = frame([(10.0, 90.0, 1.0, 95.0, 3.0), (10.0, 50.0, 1.0, 95.0, 50.0), (-4.0, 50.0, 1.0, 95.0, -1.0)], PARK)
    out = ops.onsite_parking(ops.prepaid_parking(df)).collect()
    assert [(r["additional"], r["parked"], r["capacity_remaining"], r["onsite"]) for r in out] == [(5, 95, 0, 0), (10, 60, 35, 35), (0, 50, 45, 0)]
    old = ops.prepaid_parking(df, compat=True).collect()
    assert [(r["additional"], r["capacity_remaining"]) for r in old] == [(5, 0), (10, 60), (-4, 46)]


def test_gate_prices_fall_back_to_the_realised_average(frame):
    df = frame([("e", False, 30.0, 30.0), ("e", True, 0.0, 0.0), ("f", True, 12.0, 12.0)], "k string, is_comp boolean, price double, gross_revenue double")
    got = {r["k"]: (r["prepaid_price"], round(r["gate_price_gross"], 4)) for r in ops.gate_prices(df, ["k"]).collect()}
    assert got == {"e": (30.0, 42.8), "f": (None, 17.12)}


def test_curve_scale_up(frame):
    rows = [("old", "g", 10, 4), ("old", "g", 0, 6), ("new", "g", 10, 8)]
    df = frame(rows, "e string, g string, d int, v int")
    out = ops.scale_up_by_curve(df, "e", "g", "d", "v", F.col("e") == "new").first()
    assert (out["cumulative"], out["projected"], out["d"]) == (8, 20.0, 10)


def test_combined_forecast_and_stitch(frame):
    a, b = frame([("e", 1.0)], "e string, v double"), frame([("e", 2.0), ("f", 3.0)], "e string, v double")
    got = {r["e"]: (r["v"], r["v_a"], r["v_b"]) for r in ops.combine_forecasts({"a": a, "b": b}, "e", "v").collect()}
    assert got == {"e": (3.0, 1.0, 2.0), "f": (3.0, None, 3.0)}
    out = ops.stitch(frame([("s", 1.0)], "season string, v double"), frame([("s", 2.0), ("x", 9.0)], "season string, p double"), "s", {"v": "actual"})
    assert sorted((r["actual"], r["p"]) for r in out.na.fill(0.0).collect()) == [(0.0, 2.0), (1.0, 0.0)]


def test_type_simulation_respects_the_quota(frame):
    rows = [("e", "Plans", "Plans", 0.0)] * 10 + [("e", "Not Sold", "Plans", float(i)) for i in range(5)] + [("e", "Not Sold", "Nightly", 9.0)]
    df = frame(rows, "e string, ticket_type_group string, predicted string, score double")
    got = {r["ticket_type_group"]: r["predicted_additional_tickets"] for r in ops.simulate_types(df, "e", F.lit(0.3), "score", F.floor("score")).collect()}
    assert got == {"Plans": 2, "Nightly": 1, "Not Sold": 3}
