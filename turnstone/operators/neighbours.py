"""Exact nearest neighbours on few dimensions, without comparing all pairs.

Points are put on a square grid.  A query only meets points of its own and the
adjoining cells, which hold every point within one cell width; a query whose k
neighbours are not all inside that radius goes to the next round with twice the
width.  Dense regions finish on the small grids, so the wide grids see only the
few sparse queries.  Copies of a vector are one point with a count, so a group of
copies of any size costs one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstone.operators.sampling import keyed_random
from turnstone.operators.scan import even_buckets, row_numbers
from turnstone.session import cut_lineage


def distinct_vectors(df: DataFrame, dims: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Vectors (with labels, if any) and how many rows share each."""
    return df.groupBy(*dims, *extra).agg(F.count("*").alias("n"))


def nearest(points: DataFrame, queries: DataFrame, dims: Sequence[str], k: int, width: float | None = None) -> DataFrame:
    """For each query vector all point vectors up to the distance of its k-th neighbour.

    ``points``: ``dims`` and ``n``.  ``queries``: distinct ``dims``.  Ties at the
    k-th distance are all kept.  Returns query dims as ``q_<dim>``, point dims,
    ``n`` and ``distance``.
    """
    points = cut_lineage(points.groupBy(*dims).agg(F.sum("n").alias("n")))
    extent = points.unionByName(queries, allowMissingColumns=True).agg(
        F.array_max(F.array(*[(F.max(d) - F.min(d)).cast("double") for d in dims])).alias("e")).first()["e"]
    total = points.agg(F.count("*").alias("c"), F.sum("n").alias("n")).first()
    if not total["c"]:
        return points.select(*[F.col(d).alias(f"q_{d}") for d in dims], *dims, "n", F.lit(0.0).alias("distance"))
    reach = float(extent or 0) * len(dims) ** 0.5 + 1e-9
    step = width or max(float(extent or 0), 1e-9) / max(total["c"], 1) ** (1 / len(dims))
    step = _thin_cells(points, dims, step, 32 * k)
    offsets = F.array(*[F.array(*[F.lit(o) for o in shift]) for shift in product((-1, 0, 1), repeat=len(dims))])
    todo = queries.select(*[F.col(d).alias(f"q_{d}") for d in dims])
    done: list[DataFrame] = []
    while True:
        last = step >= reach

        def cell(i: int, prefix: str = ""):
            return F.floor(F.col(prefix + dims[i]).cast("double") / step)

        placed = points.withColumns({f"_c{i}": cell(i) for i in range(len(dims))})
        asked = todo.withColumn("_o", F.explode(offsets)).withColumns(
            {f"_c{i}": cell(i, "q_") + F.col("_o")[i] for i in range(len(dims))}).drop("_o")
        squares = reduce(lambda a, b: a + b, [(F.col(f"q_{d}") - F.col(d)) ** 2 for d in dims])
        near = asked.join(placed, [f"_c{i}" for i in range(len(dims))]).withColumn(
            "distance", F.sqrt(squares.cast("double"))).where(F.lit(last) | (F.col("distance") <= step))
        # one shuffle of the pairs: the distance at which the points of a query, with their copies, come to k
        keys = [f"q_{d}" for d in dims]
        of_query = Window.partitionBy(*keys)
        upto = near.select(*keys, *dims, "n", "distance").withColumn("_upto", F.sum("n").over(of_query.orderBy("distance")))
        filled = upto.withColumn("_kth", F.min(F.when(F.col("_upto") >= k, F.col("distance"))).over(of_query))
        found = filled.where((F.col("distance") <= F.col("_kth")) | (F.lit(last) & F.col("_kth").isNull()))
        done.append(cut_lineage(found.select(*keys, *dims, "n", "distance")))
        if last:
            break
        todo = cut_lineage(todo.join(done[-1].select(*keys).distinct(), keys, "left_anti"))
        if todo.isEmpty():
            break
        step *= 2
    return reduce(DataFrame.unionByName, done)


def _thin_cells(points: DataFrame, dims: Sequence[str], step: float, most: int) -> float:
    """Shrink the first grid until no cell holds more than ``most`` distinct vectors.

    Where the points crowd into one spot, the even grid would put them all into
    one cell and compare them pairwise.
    """
    while True:
        cells = points.groupBy(*[F.floor(F.col(d).cast("double") / step) for d in dims]).count()
        crowd = cells.agg(F.max("count")).first()[0] or 0
        if crowd <= most or step < 1e-9:
            return step
        step /= max(2.0, (crowd / most) ** (1 / len(dims)))


def knn_vote(train: DataFrame, queries: DataFrame, dims: Sequence[str], label: str, k: int = 5) -> DataFrame:
    """Distance-weighted class vote of the k nearest rows; exact matches outvote all others.

    One row per distinct query vector with the winning class and its share of the
    vote; equal votes go to the class that sorts first.
    """
    labelled = distinct_vectors(train, dims, [label])
    asked = queries.select(*dims).distinct()
    pairs = nearest(labelled.select(*dims, "n"), asked, dims, k, width=1.0).drop("n")
    keys = [f"q_{d}" for d in dims]
    per_class = pairs.join(labelled, list(dims)).groupBy(*keys, label).agg(
        F.sum(F.when(F.col("distance") == 0, F.col("n"))).alias("same"),
        F.sum(F.when(F.col("distance") > 0, F.col("n") / F.col("distance"))).alias("weighted"),
    )
    totals = per_class.groupBy(*keys).agg(
        F.max(F.col("same").isNotNull()).alias("_exact"),
        F.collect_list(F.struct(label, "same", "weighted")).alias("_classes"),
    )
    votes = totals.select(*keys, "_exact", F.explode("_classes").alias("x")).select(
        *keys, F.col(f"x.{label}").alias(label),
        F.coalesce(F.when(F.col("_exact"), F.col("x.same").cast("double")).otherwise(F.col("x.weighted")), F.lit(0.0)).alias("vote"))
    best = votes.groupBy(*keys).agg(
        F.min_by(F.struct(label, "vote"), F.struct((-F.col("vote")).alias("v"), F.col(label).alias("c"))).alias("b"),
        F.sum("vote").alias("_total"))
    return best.select(
        *[F.col(f"q_{d}").alias(d) for d in dims], F.col(f"b.{label}").alias("predicted"), (F.col("b.vote") / F.col("_total")).alias("probability"))


def oversample_minority(
    df: DataFrame, key: str, dims: Sequence[str], label: str, minority, k: int = 5, seed: int = 1993
) -> DataFrame:
    """Synthetic minority rows until both classes are equally frequent.

    Each synthetic row lies between a minority row and one of its k nearest
    minority rows.  Draws depend on the row's key, the copy number and the seed,
    so a retried task makes the same rows.
    """
    small = df.where(F.col(label) == minority)
    counts = df.agg(F.count_if(F.col(label) == minority).alias("m"), F.count("*").alias("n")).first()
    need, m = counts["n"] - 2 * counts["m"], counts["m"]
    base = df.select(*dims, label, F.lit(False).alias("synthetic"))
    if need <= 0 or m < 2:
        return base
    vectors = distinct_vectors(small, dims)
    near = nearest(vectors, vectors.select(*dims), dims, k + 1)
    qs = [f"q_{d}" for d in dims]
    others = near.where((F.col("distance") > 0) | (F.col("n") > 1))
    ranked = others.withColumn("_r", F.row_number().over(Window.partitionBy(*qs).orderBy("distance", *dims))).where(F.col("_r") <= k)
    lists = ranked.groupBy(*qs).agg(F.sort_array(F.collect_list(F.struct("_r", *dims))).alias("_near"))
    numbered = row_numbers(small.select(key, *dims), [], [key], even_buckets(small, F.col(key)), "_i")
    copies = F.lit(need // m) + (F.col("_i") <= need % m).cast("int")
    listed = numbered.withColumn("_copies", copies).where("_copies > 0").join(lists.withColumnsRenamed({f"q_{d}": d for d in dims}), list(dims))
    drawn = listed.withColumn("_j", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    spot = (F.floor(keyed_random([key, "_j"], seed) * F.size("_near")) + 1).cast("int")
    other = F.element_at("_near", spot)
    u = keyed_random([key, "_j"], seed + 1)
    made = drawn.select(
        *[(F.col(d) + u * (other[d] - F.col(d))).alias(d) for d in dims], F.lit(minority).alias(label), F.lit(True).alias("synthetic"))
    return base.unionByName(made)
