"""Models on the driver tables.  Fitted values have no SQL twin; evaluation does."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnstone.functions import fixed_values as fixed
from turnstone.functions import scalars as s
from turnstone.operators import encoding, neighbours, sampling
from turnstone.operators import models as ops
from turnstone.operators.scan import even_buckets
from turnstone.plans.customers import COHORTS, RENEWAL, cohorts, inference_cohort, renewal_table, window_features
from turnstone.plans.forecasts import GAME_LOG, daily_facts, win_features
from turnstone.registry import query
from turnstone.session import cut_lineage
from turnstone.sources.views import GAMES, TICKETS, games, tickets

LEVELS = ["Lowers", "Clubs", "Uppers", "Suites", "Premium"]
RENEWAL_FEATURES = [
    "is_local", "tenure", "paid_show_rate", "show_rate", "self_show_rate", "num_games", "gross_revenue_agg", "level_num", "renewal_likelihood_survey",
]


def game_rows(t):
    """One row a game, computed once: every fit passes over it many times."""
    per = daily_facts(t).groupBy("event_date", "season", "tier", "is_weekend", "is_premier").agg(
        F.sum("paid_seats").alias("paid"), F.sum("comp_seats").alias("comp"), F.sum("gross_revenue").alias("revenue"),
        F.sum(F.when(F.col("did_attend"), F.col("paid_seats") + F.col("comp_seats")).otherwise(0)).alias("attendance"))
    return per.withColumns({
        "tier_num": s.lookup("tier", fixed.TIER_NUMBER, 0), "weekend": F.col("is_weekend").cast("int"),
        "week_day": s.lookup(s.dow0("event_date"), {6: 1, 5: 2, 0: 2}, 3), "atp": F.coalesce(s.ratio("revenue", "paid"), F.lit(0.0)),
    }).drop("is_weekend").transform(cut_lineage)


def renewal_rows(t, season: str = "1999-00"):
    table = renewal_table(t, season).withColumn("level_num", s.lookup("arena_level", fixed.LEVEL_ORDER, 5))
    return cut_lineage(table.na.fill(0.0, ["paid_show_rate", "show_rate"]))


@query("m4_polynomial")
def polynomial(t):
    g = game_rows(t)
    cut = F.lit("2000-07-01").cast("date")
    out = ops.polynomial_regression(g.where(F.col("event_date") < cut), g.where(F.col("event_date") >= cut), ["attendance", "weekend", "tier_num"], "paid")
    return out.select("event_date", "attendance", "paid", "predicted")


def level_days(t):
    lt = tickets(t).groupBy("arena_level", "season", "days_out").agg(F.sum("paid_seats").alias("seats"))
    return cut_lineage(lt.withColumn("capacity", F.lit(5000.0)).withColumn("start", F.left("season", F.lit(4)).cast("int")))


@query("m5_boosted_by_level")
def boosted_by_level(t):
    rows = level_days(t)
    out = ops.boosted_regression_by_group(
        rows.where("start < 1999"), rows.where("start >= 1999"), "arena_level", LEVELS, ["days_out"], "seats", "capacity")
    return out.select("arena_level", "season", "days_out", "seats", "predicted")


@query("m6_boosted_log_seats")
def boosted_log_seats(t):
    g = game_rows(t)
    out = ops.boosted_log_regression(g.where("season < '2000-01'"), g.where("season >= '2000-01'"), ["weekend", "tier_num", "week_day", "is_premier"], "paid")
    return out.select("event_date", "paid", "predicted")


@query("m7_price_table")
def price_table(t):
    return ops.price_table(price_rows(t), "event_date", "arena_level", "days_out", ["level_num", "days_out", "weekday", "month"], "current_price", LEVELS)


@query("m5_kernel_by_level")
def kernel_by_level(t):
    rows = level_days(t)
    out = ops.kernel_regression_by_group(rows.where("start < 1999"), rows.where("start >= 1999"), "arena_level", LEVELS, ["days_out"], "seats", "capacity")
    return out.select("arena_level", "season", "days_out", "seats", "predicted")


@query("m5_polynomial_kernel")
def polynomial_kernel(t):
    g = game_rows(t).withColumn("all", F.lit("all"))
    out = ops.kernel_regression_by_group(
        g.where("season < '2000-01'"), g.where("season >= '2000-01'"), "all", ["all"], ["tier_num", "week_day", "weekend", "is_premier"], "paid", kind="poly")
    return out.select("event_date", "paid", "predicted")


@query("m6_network_log_seats")
def network_log_seats(t):
    g = game_rows(t)
    out = ops.network_log_regression(g.where("season < '2000-01'"), g.where("season >= '2000-01'"), ["weekend", "tier_num", "week_day", "is_premier"], "paid")
    return out.select("event_date", "paid", "predicted")


def price_rows(t):
    p = tickets(t).where("NOT is_comp").groupBy("event_date", "arena_level", "days_out").agg(
        (F.sum("gross_revenue") / F.sum("paid_seats")).alias("current_price")).withColumns({
            "level_num": s.lookup("arena_level", fixed.LEVEL_NUMBER, 0), "weekday": s.dow0("event_date"), "month": F.month("event_date")})
    return cut_lineage(p.select("event_date", "arena_level", "days_out", "current_price", "level_num", "weekday", "month"))


@query("m7_network_prices")
def network_prices(t):
    return ops.network_price_table(price_rows(t), "event_date", "arena_level", "days_out", ["level_num", "days_out", "weekday", "month"], "current_price", LEVELS)[0]


def renewal_weights() -> dict[str, list[float]]:
    return {plan: [fixed.FEATURE_WEIGHTS[plan].get(f, 1) for f in RENEWAL_FEATURES] for plan in ("Full", "Premier")}


@query("m8_logistic_renewal")
def logistic_renewal(t):
    """Fitted on the holders of one season, scored on those of the next, a model for each plan in the same passes."""
    out = ops.logistic_scores_by(renewal_rows(t, "1998-99"), renewal_rows(t, "1999-00"), "plan", renewal_weights(), RENEWAL_FEATURES, "did_renew")
    return out.select("buyer", "plan", "did_renew", "probability")


LEAD_FEATURES = ["num_games", "spend"]


@query("m9_boosted_lead_scores")
def boosted_lead_scores(t):
    """Fitted on two past cohorts of leads, scored on those of the running season."""
    past = cut_lineage(cohorts(t).select("buyer", "obs_season", "did_purchase_next_season").join(window_features(t), ["buyer", "obs_season"]))
    out = ops.boosted_scores(past, inference_cohort(t), LEAD_FEATURES, "did_purchase_next_season")
    edges, labels = fixed.SCORE_EDGES
    return out.select("buyer", "probability", s.cut("probability", edges, labels).alias("prediction_group"))


@query("m10_forest_win_model")
def forest_win_model(t):
    known = win_features(t).where(F.col("last_3").isNotNull())
    rows = cut_lineage(known.withColumn("decision", F.when(F.col("pts") > F.col("last_3"), "win").otherwise("loss")))
    cut = F.lit("2000-07-01").cast("date")
    features = ["back_to_back", "density", "distance", "last_3"]

    def fit(away: int):
        side = rows.where(F.col("away") == away)
        return ops.forest_classes(side.where(F.col("day") < cut), side.where(F.col("day") >= cut), features, "decision", ["loss", "win"])

    parts = ops.concurrently(fit, (0, 1))
    out = parts[0].unionByName(parts[1]).withColumn("diff", F.abs(F.col("p_win") - F.col("p_loss")))
    near = sampling.relabel_closest(out, F.col("predicted") == "loss", ["diff", "team", "day"], 9, ["team", "day"])
    return near.select("team", "day", "p_win", "p_loss", F.when(F.col("chosen"), "tie").otherwise(F.col("predicted")).alias("predicted"))


@query("m11_knn", """
  WITH f AS (SELECT dayofweek(l_shipdate)::INT AS dow, l_linenumber AS line, l_quantity::INT AS qty, l_returnflag AS cls, l_shipdate < TIMESTAMP '2000-07-01' AS past FROM lineitem),
  tr AS (SELECT dow, line, qty, COUNT(*) AS n FROM f WHERE past GROUP BY 1, 2, 3), tc AS (SELECT dow, line, qty, cls, COUNT(*) AS n FROM f WHERE past GROUP BY 1, 2, 3, 4), q AS (SELECT DISTINCT dow, line, qty FROM f WHERE NOT past),
  d AS (SELECT q.dow AS qd, q.line AS ql, q.qty AS qq, tr.*, (q.dow - tr.dow) ** 2 + (q.line - tr.line) ** 2 + (q.qty - tr.qty) ** 2 AS d2 FROM q, tr),
  c AS (SELECT qd, ql, qq, d2, SUM(SUM(n)) OVER (PARTITION BY qd, ql, qq ORDER BY d2) AS upto FROM d GROUP BY 1, 2, 3, 4), k AS (SELECT qd, ql, qq, MIN(d2) AS kth FROM c WHERE upto >= 5 GROUP BY 1, 2, 3),
  nb AS (SELECT d.qd, d.ql, d.qq, d.d2, tc.cls, tc.n FROM d JOIN k USING (qd, ql, qq) JOIN tc ON tc.dow = d.dow AND tc.line = d.line AND tc.qty = d.qty WHERE d2 <= kth),
  m AS (SELECT qd, ql, qq, MIN(d2) AS near FROM nb GROUP BY 1, 2, 3),
  v AS (SELECT qd, ql, qq, cls, SUM(CASE WHEN near = 0 THEN CASE WHEN d2 = 0 THEN n ELSE 0 END ELSE n / sqrt(d2) END)::DOUBLE AS vote FROM nb JOIN m USING (qd, ql, qq) GROUP BY 1, 2, 3, 4),
  b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY qd, ql, qq ORDER BY ROUND(vote, 9) DESC, cls) AS rn, SUM(vote) OVER (PARTITION BY qd, ql, qq) AS total FROM v)
  SELECT qd AS dow, ql AS line, qq AS qty, cls AS predicted, ROUND(vote / total, 6) AS probability FROM b WHERE rn = 1""")
def knn(t):
    f = t.lineitem.select(
        s.dow0("l_shipdate").alias("dow"), F.col("l_linenumber").alias("line"), F.col("l_quantity").cast("int").alias("qty"), F.col("l_returnflag").alias("cls"),
        (F.col("l_shipdate") < F.lit("2000-07-01").cast("timestamp_ntz")).alias("past"))
    out = neighbours.knn_vote(f.where("past"), f.where("NOT past"), ["dow", "line", "qty"], "cls", 5)
    return out.withColumn("probability", F.round("probability", 6))


@query("m12_multinomial_tiers")
def multinomial_tiers(t):
    g = game_rows(t)
    out = ops.multinomial_classes(g, g, ["week_day", "attendance", "is_premier", "atp"], "tier", list("ABCDE"))
    return out.select("event_date", "tier", "predicted", *[f"p_{c}" for c in "ABCDE"])


@query("m13_game_clusters")
def game_clusters(t):
    g = game_rows(t)
    seasons = [r.season for r in games(t).select("season").distinct().orderBy("season").collect()]  # one a year
    features = ["week_day", "is_premier", "paid", "atp", "attendance"]
    seasonal = ops.ranked_clusters(g.select("event_date", "season", "revenue", *features), seasons, "season", features, "revenue", 4)
    whole = ops.clusters(seasonal.withColumnRenamed("cluster", "cluster_season"), features, 4)
    return whole.select("event_date", "season", "cluster_season", "cluster")


@query("m14_survey_clusters")
def survey_clusters(t):
    d = t.documents.select("doc_id", "lang", "source", F.log1p("n_chars").alias("size"))
    coded = encoding.label_codes(encoding.label_codes(d, "lang", "lang_num"), "source", "source_num")
    coded = encoding.label_codes(coded.withColumn("half", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b")), "half", "half_num")
    out = ops.component_clusters(coded.select("doc_id", "lang_num", "source_num", "size", "half_num"), ["lang_num", "source_num", "size", "half_num"], 4, 5)
    return out.select("doc_id", "pc1", "pc2", "pc3", "pc4", "target")


EVALUATED = """ev AS (SELECT l_orderkey, (l_returnflag = 'A')::INT AS y, l_quantity * (1 - l_discount) AS score, CASE WHEN l_quantity > 30 THEN 1 ELSE 0 END AS p FROM lineitem)"""


def evaluated(t):
    return t.lineitem.select((F.col("l_returnflag") == "A").cast("int").alias("y"), (F.col("l_quantity") * (1 - F.col("l_discount"))).alias("score"),
                             F.when(F.col("l_quantity") > 30, 1).otherwise(0).alias("p"))


@query("m15_confusion", f"WITH {EVALUATED} SELECT y, p, COUNT(*) AS n FROM ev GROUP BY 1, 2")
def confusion(t):
    return ops.confusion(evaluated(t), "y", "p")


@query("m15_accuracy", f"WITH {EVALUATED} SELECT ROUND(AVG((y = p)::INT), 8) AS accuracy FROM ev")
def accuracy(t):
    return ops.accuracy(evaluated(t), "y", "p").withColumn("accuracy", F.round("accuracy", 8))


@query("m15_report", f"""
  WITH {EVALUATED}, c AS (SELECT k AS class, COUNT(CASE WHEN y = k AND p = k THEN 1 END) AS tp, COUNT(CASE WHEN p = k THEN 1 END) AS called, COUNT(CASE WHEN y = k THEN 1 END) AS support FROM ev, (VALUES (0), (1)) v(k) GROUP BY 1)
  SELECT class, ROUND(tp / called, 8) AS precision, ROUND(tp / support, 8) AS recall, ROUND(2.0 * tp / (called + support), 8) AS f1, support FROM c""")
def report(t):
    out = ops.classification_report(evaluated(t), "y", "p")
    return out.select("class", *[F.round(c, 8).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("m15_roc_auc", f"""
  WITH {EVALUATED}, r AS (SELECT y, RANK() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS rk FROM ev)
  SELECT ROUND((SUM(CASE WHEN y = 1 THEN rk END) - SUM(y) * (SUM(y) + 1) / 2.0::DOUBLE) / (SUM(y)::DOUBLE * (COUNT(*) - SUM(y))), 8) AS auc FROM r""")
def roc_auc(t):
    rows = evaluated(t)
    return ops.roc_auc(rows, "y", "score", even_buckets(rows, F.col("score"))).withColumn("auc", F.round("auc", 8))


GRID = [0.1, 1.0, 10.0, 100.0]


def grid(t):
    return ops.grid_search(renewal_rows(t), RENEWAL_FEATURES, "did_renew", GRID, ["l1", "l2", "elasticnet"], [None, "balanced"])


@query("m16_grid_search")
def grid_search(t):
    return grid(t).select("strength", "penalty", "class_weight", "accuracy", "is_best")


@query("m17_feature_elimination")
def feature_elimination(t):
    return ops.eliminate_features(renewal_rows(t), RENEWAL_FEATURES, "did_renew").drop("at_optimum")


@query("m18_odds_ratios")
def odds_ratios(t):
    return ops.coefficient_table(renewal_rows(t), RENEWAL_FEATURES, "did_renew")


@query("m18_importances")
def importances(t):
    return ops.feature_importances(renewal_rows(t), RENEWAL_FEATURES, "did_renew")


def quality_rows(t):
    """Size and words a character of the labelled documents, computed once; texts are measured in the scan, not joined.

    A document without a character has density 0.
    """
    words, chars = F.size(F.split("text", " ")), F.col("n_chars")
    density = F.when(chars != 0, words / chars).when((chars == 0) & F.col("text").isNotNull(), 0.0)
    measured = t.documents.select("doc_id", F.log1p("n_chars").alias("size"), density.alias("density"))
    return cut_lineage(measured.join(t.labels, "doc_id").select("doc_id", "quality", "size", "density"))


@query("m19_oversample")
def oversample(t):
    return neighbours.oversample_minority(quality_rows(t), "doc_id", ["size", "density"], "quality", 0)


# --- what must hold of fitted values: the twins count the rows that have to be there --------------
HOLDERS = f"""WITH {RENEWAL}, holders AS (SELECT b.* FROM base b JOIN customer ON c_custkey = b.buyer JOIN rates r ON r.buyer = b.buyer WHERE spend > 0)"""


def rows_in_range(df, value, low: float, high: float, *keys: str):
    """Rows of each group, and how many of them have a value in the range; neither null nor NaN is."""
    value = F.col(value).cast("double")
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if((value >= low) & (value <= high)).alias("in_range"))


@query("m4_every_game_predicted", f"WITH {GAMES} SELECT COUNT(*) AS n, COUNT(*) AS in_range FROM games WHERE event_date >= DATE '2000-07-01'")
def every_game_predicted(t):
    return rows_in_range(polynomial(t), "predicted", -1e12, 1e12)


@query("m8_every_holder_scored", f"{HOLDERS} SELECT plan, COUNT(*) AS n, COUNT(*) AS in_range FROM holders GROUP BY 1")
def every_holder_scored(t):
    return rows_in_range(logistic_renewal(t), "probability", 0, 1, "plan")


@query("m9_every_lead_scored", f"""
  WITH {COHORTS} SELECT COUNT(*) AS n, COUNT(*) AS in_range FROM (
    SELECT DISTINCT buyer FROM att WHERE event_date BETWEEN DATE '2000-10-01' AND DATE '2001-03-15' AND buyer NOT IN (SELECT buyer FROM held WHERE season = '2000-01'))""")
def every_lead_scored(t):
    return rows_in_range(boosted_lead_scores(t), "probability", 0, 1)


@query("m10_shares_sum_to_one", f"""
  WITH {GAME_LOG} SELECT team, COUNT(*) AS n, COUNT(*) AS in_range FROM ft WHERE last_3 IS NOT NULL AND day >= DATE '2000-07-01' GROUP BY 1""")
def shares_sum_to_one(t):
    return rows_in_range(forest_win_model(t).withColumn("total", F.col("p_win") + F.col("p_loss")), "total", 1 - 1e-9, 1 + 1e-9, "team")


@query("m12_first_order", f"WITH {GAMES} SELECT tier, COUNT(*) AS n, TRUE AS balanced FROM games GROUP BY 1")
def first_order(t):
    """At the optimum the probabilities of a class add up to the rows of the class."""
    one = multinomial_tiers(t).agg(*[F.struct(F.lit(c).alias("tier"), F.count_if(F.col("tier") == c).alias("n"), F.sum(f"p_{c}").alias("p")).alias(c) for c in "ABCDE"])
    each = one.select(F.inline(F.array(*"ABCDE")))
    return each.select("tier", "n", (F.abs(F.col("p") - F.col("n")) <= 0.02 * F.col("n")).alias("balanced"))


@query("m14_every_answer_placed", "SELECT COUNT(*) AS n, COUNT(*) AS in_range FROM documents")
def every_answer_placed(t):
    return rows_in_range(survey_clusters(t), "target", 0, 4)


@query("m19_even_classes", """
  WITH d AS (SELECT quality FROM documents JOIN labels USING (doc_id)), c AS (SELECT COUNT(*) AS n, COUNT(CASE WHEN quality = 0 THEN 1 END) AS m FROM d)
  SELECT quality, synthetic, n FROM (SELECT quality, FALSE AS synthetic, COUNT(*) AS n FROM d GROUP BY 1 UNION ALL SELECT 0, TRUE, n - 2 * m FROM c WHERE n > 2 * m AND m > 1)""")
def even_classes(t):
    return oversample(t).groupBy("quality", "synthetic").agg(F.count("*").alias("n"))


#: The holders of the season before, by whom the renewal models are fitted.
FITTED = (HOLDERS.replace("'2000-01'", "'NEXT'").replace("'1999-00'", "'1998-99'").replace("'NEXT'", "'1999-00'")
          .replace("1999 - k + 1", "1998 - k + 1").replace("TIMESTAMP '1999-07-01'", "TIMESTAMP '1998-07-01'"))


def at_optimum(df, *keys: str):
    """Whether residuals add up to nothing and no feature pulls against the penalty."""
    return df.select(*keys, "n", (F.abs("excess") <= 1e-4).alias("balanced"), (F.col("pull") <= 1e-4).alias("stationary"))


@query("m8_first_order", f"{FITTED} SELECT plan, COUNT(*) AS n, TRUE AS balanced, TRUE AS stationary FROM holders GROUP BY 1")
def renewal_first_order(t):
    return at_optimum(ops.first_order(renewal_rows(t, "1998-99"), "plan", renewal_weights(), RENEWAL_FEATURES, "did_renew"), "plan")


@query("m18_first_order", f"{HOLDERS} SELECT COUNT(*) AS n, TRUE AS balanced, TRUE AS stationary FROM holders")
def odds_first_order(t):
    rows = renewal_rows(t).withColumn("all", F.lit("all"))
    return at_optimum(ops.first_order(rows, "all", {"all": [1.0] * len(RENEWAL_FEATURES)}, RENEWAL_FEATURES, "did_renew"))


@query("m16_settings_at_optimum", """
  SELECT strength, penalty, class_weight, TRUE AS at_optimum, TRUE AS few_passes FROM (VALUES (0.1::DOUBLE), (1.0::DOUBLE), (10.0::DOUBLE), (100.0::DOUBLE)) c(strength),
   (VALUES ('l1'), ('l2'), ('elasticnet')) p(penalty), (VALUES ('none'), ('balanced')) w(class_weight)""")
def settings_at_optimum(t):
    return grid(t).select("strength", "penalty", "class_weight", "at_optimum", (F.col("passes") <= 30).alias("few_passes"))


@query("m17_steps_at_optimum", "SELECT n::INT AS n_features, n::INT AS kept, TRUE AS at_optimum FROM range(1, 10) r(n)")
def steps_at_optimum(t):
    out = ops.eliminate_features(renewal_rows(t), RENEWAL_FEATURES, "did_renew")
    return out.select("n_features", F.size(F.split("kept", ",")).alias("kept"), "at_optimum")


@query("m4_first_order", f"WITH {GAMES} SELECT COUNT(*) AS n, TRUE AS balanced, TRUE AS uncorrelated FROM games WHERE event_date < DATE '2000-07-01'")
def polynomial_first_order(t):
    """Residuals of the fitted games add up to nothing, alone and times a feature."""
    g = game_rows(t).where(F.col("event_date") < F.lit("2000-07-01").cast("date"))
    out = ops.polynomial_regression(g, g, ["attendance", "weekend", "tier_num"], "paid").withColumn("rest", F.col("predicted") - F.col("paid"))
    sums = out.agg(F.count("*").alias("n"), F.sum("rest").alias("a"), F.sum("paid").alias("b"), F.sum(F.col("rest") * F.col("attendance")).alias("c"), F.sum(F.col("paid") * F.col("attendance")).alias("d"))
    return sums.select("n", (F.abs("a") <= F.col("b") * 1e-4).alias("balanced"), (F.abs("c") <= F.col("d") * 1e-4).alias("uncorrelated"))


@query("m5_band_is_balanced", f"""
  WITH {TICKETS}, d AS (SELECT arena_level, season, days_out FROM tickets WHERE left(season, 4)::INT < 1999 GROUP BY 1, 2, 3) SELECT arena_level, COUNT(*) AS n, TRUE AS balanced FROM d GROUP BY 1""")
def band_is_balanced(t):
    """At the optimum as many rows lie above the band as below, those at its edge by their share."""
    rows = level_days(t).where("start < 1999")
    out = ops.kernel_regression_by_group(rows, rows, "arena_level", LEVELS, ["days_out"], "seats")
    miss = F.log1p("predicted") - F.log1p(F.col("seats").cast("double"))
    push = F.signum(miss) * F.least(F.greatest((F.abs(miss) - ops.kernel.BAND) / ops.kernel.ROUNDINGS[-1], F.lit(0.0)), F.lit(1.0))
    return out.groupBy("arena_level").agg(F.count("*").alias("n"), (F.abs(F.sum(push)) <= 1e-3 * F.count("*")).alias("balanced"))


#: The tables draw prices and seats without regard to a game's features, so no model can beat the mean by much; it must not lose to it.
NOT_WORSE = 1.1


@query("m6_network_held_out", f"WITH {GAMES} SELECT COUNT(*) AS n, TRUE AS not_worse FROM games WHERE season >= '2000-01'")
def network_held_out(t):
    """Squared error of the log on games after those of the fit, against the fitted games' mean."""
    mean = game_rows(t).where("season < '2000-01'").agg(F.avg(s.log_or_zero("paid")).alias("mean"))
    out = network_log_seats(t).join(F.broadcast(mean), F.lit(True))
    y = s.log_or_zero("paid")
    return out.agg(F.count("*").alias("n"), (F.sum((F.log("predicted") - y) ** 2) <= NOT_WORSE * F.sum((F.col("mean") - y) ** 2)).alias("not_worse"))


@query("m7_network_held_out", f"""
  WITH {TICKETS}, p AS (SELECT event_date, arena_level, days_out FROM tickets WHERE NOT is_comp GROUP BY 1, 2, 3) SELECT COUNT(*) AS n, TRUE AS judged, TRUE AS not_worse FROM p""")
def network_prices_held_out(t):
    """Squared error on rows that were not trained on, against the trained rows' mean."""
    _, out = ops.network_price_table(price_rows(t), "event_date", "arena_level", "days_out", ["level_num", "days_out", "weekday", "month"], "current_price", LEVELS)
    held = F.col("_u") >= 0.8
    mean = out.where(~held).agg(F.avg("current_price").alias("mean"))
    error = lambda x: F.sum(F.when(held, (x - F.col("current_price")) ** 2))
    return out.join(F.broadcast(mean), F.lit(True)).agg(
        F.count("*").alias("n"), (F.count_if(held) > 0).alias("judged"), (error(F.col("predicted")) <= NOT_WORSE * error(F.col("mean"))).alias("not_worse"))


@query("m13_clusters_are_means", f"WITH {GAMES} SELECT season, COUNT(*) AS n, 0::BIGINT AS strays FROM games GROUP BY 1")
def clusters_are_means(t):
    """No game of a season is nearer to the mean of another cluster than to its own, on standardised features."""
    features = ["week_day", "is_premier", "paid", "atp", "attendance"]
    g = game_rows(t)
    seasons = [r.season for r in games(t).select("season").distinct().orderBy("season").collect()]
    placed = ops.ranked_clusters(g.select("event_date", "season", "revenue", *features), seasons, "season", features, "revenue", 4)
    return ops.inertia(ops.standardise_by(g, placed, "season", seasons, features), features, "cluster", ["season"]).select("season", "n", "strays")


@query("m14_best_of_starts", "SELECT COUNT(*) AS n, 5::BIGINT AS clusters, 0::BIGINT AS strays, TRUE AS not_above_one_start FROM documents")
def best_of_starts(t):
    """Five clusters, every answer nearest to the mean of its own, and no more inertia than from a single start."""
    parts = [f"pc{i}" for i in range(1, 5)]
    placed = cut_lineage(survey_clusters(t))
    one = ops.kmeans.fit(placed, parts, 5, starts=1, seed=7).inertia[""]
    return ops.inertia(placed, parts, "target").select("n", "clusters", "strays", (F.col("inertia") <= one * (1 + 1e-6)).alias("not_above_one_start"))
