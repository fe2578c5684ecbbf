"""Hard negatives and near-duplicate vectors against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnstone.llm import hard_negatives, sorted_projections

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def vectors():
    """Random vectors, a crowd of near copies, pairs at the threshold, exact copies, and vectors without direction."""
    rng = np.random.default_rng(3)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    loose = rng.normal(size=(150, 16))
    crowd = unit(rng.normal(size=(1, 16))) + 0.02 * rng.normal(size=(300, 16))
    near = unit(loose[:40]) + 0.12 * unit(rng.normal(size=(40, 16)))
    edge = unit(loose[40:80]) * 0.9 + math.sqrt(0.19) * unit(rng.normal(size=(40, 16)))
    rows = [list(map(float, x)) for x in np.concatenate([loose, crowd, near, edge, loose[:5] * 3])]
    rows += [rows[7], rows[7], rows[200], [0.0] * 16, [-0.0] * 16, [NAN] + [1.0] * 15, [INF] + [1.0] * 15, [None] + [1.0] * 15, None, [], [1.0, 2.0]]
    return rows


def cosines(rows):
    good = [i for i, v in enumerate(rows) if v and len(v) == 16 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    u = np.array([rows[i] for i in good])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    return good, u @ u.T


def test_linked_vectors_equal_brute_force(spark, vectors, monkeypatch):
    good, cosine = cosines(vectors)
    count = len(vectors)
    links, group = [0] * count, list(range(count))
    for a in range(len(good)):
        for b in range(len(good)):
            if a != b and cosine[a, b] >= 0.9:
                links[good[a]] += 1
                old, new = group[good[a]], group[good[b]]
                group = [min(old, new) if g in (old, new) else g for g in group]
    assert sum(links) > 300 * 299
    frame = spark.createDataFrame([(i, v, "clash") for i, v in enumerate(vectors)], "id long, vector array<double>, node string")
    for members, visitors in ((1024, 8192), (16, 8)):
        monkeypatch.setattr(sorted_projections, "MEMBERS", members)
        monkeypatch.setattr(sorted_projections, "VISITORS", visitors)
        got = {r.id: (r.n_links, r.component_id) for r in sorted_projections.near_duplicates(frame, window=32).collect()}
        assert got == {i: (links[i], group[i]) for i in range(count)}


def test_vector_rows_without_ids_and_empty_tables(spark):
    same = [1.0, 2.0]
    frame = spark.createDataFrame([(None, same), (5, same), (5, same), (None, [2.0, -1.0]), (7, None)], "id long, vector array<float>")
    got = sorted((r.id or -1, r.n_links, r.component_id) for r in sorted_projections.near_duplicates(frame).collect())
    assert got[0] == (-1, 0, None) and got[1:] == [(-1, 2, 5), (5, 2, 5), (5, 2, 5), (7, 0, 7)]
    assert sorted_projections.near_duplicates(frame.limit(0)).count() == 0
    assert sorted_projections.near_duplicates(frame.where("id = 7")).first().n_links == 0


def test_passes_grow_with_the_vectors():
    passes = [sorted_projections.plan(n)[0] for n in (1, 10**4, 10**6, 10**9)]
    assert passes == sorted(passes) and passes[0] < passes[-1] < 100


def test_recall_of_single_pairs_over_many_vectors(spark):
    """Pairs of cosine 0.9 to 0.92 among vectors that say nothing: windows alone must find them."""
    rng = np.random.default_rng(9)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    a = unit(rng.normal(size=(6000, 32)))
    other = rng.normal(size=(300, 32))
    other = unit(other - (other * a[:300]).sum(1, keepdims=True) * a[:300])
    c = rng.uniform(0.901, 0.92, (300, 1))
    rows = np.concatenate([a, c * a[:300] + np.sqrt(1 - c**2) * other])
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "id long, vector array<double>")
    found = sorted_projections.near_duplicates(frame).where("n_links > 0").count()
    assert found >= 0.95 * 600


def brute_negatives(rows, share=(80, 100)):
    out = []
    for anchor, label, v in [r for r in rows if r[0] % 10 == 0]:
        score = lambda r: sum(int(x) * int(y) for x, y in zip(v, r[2]))  # noqa: E731, B023
        ranked = sorted(((-score(r), r[0], r[1]) for r in rows))
        for s, positive, _ in [x for x in ranked if x[2] == label and x[1] != anchor][:5]:
            fits = [x for x in ranked if x[2] != label and share[0] * -s <= share[1] * -x[0] <= share[1] * -s][:5]
            out += [(anchor, positive, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize("scale", [30, 1 << 27])
def test_negatives_equal_brute_force(spark, scale):
    rng = np.random.default_rng(int(scale))
    centres = rng.normal(size=(6, 8))
    raw = np.floor(scale / 4 * (centres[rng.integers(0, 6, 260)] + 0.3 * rng.normal(size=(260, 8))))
    raw[10] = raw[20] = raw[31] = raw[32]  # ties
    raw[40] = 0
    rows = [(i, int(rng.integers(0, 3)), [float(x) for x in v]) for i, v in enumerate(raw)]
    odd = [(300, 1, None), (310, None, rows[1][2]), (320, 1, [NAN] * 8), (330, 1, [None] * 8), (340, 1, [1.0]), (None, 1, rows[1][2]), (350, 2, [1e300] * 8)]
    frame = spark.createDataFrame(rows + odd, "id long, label int, vector array<double>").withColumns(
        {"is_anchor": F.col("id") % 10 == 0, "rank": F.lit("clash")})
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    for block in (1024, 7):
        got = sorted(tuple(r[n] for n in names) for r in hard_negatives.mine(frame, block=block).collect())
        assert got == brute_negatives(rows) and len(got) > 100
    assert hard_negatives.mine(frame.limit(0)).columns == names and hard_negatives.mine(frame.limit(0)).count() == 0
    assert hard_negatives.mine(frame.where("id < 0 OR label = 99")).count() == 0


def test_bounds_spare_scores_of_clustered_rows():
    rng = np.random.default_rng(1)
    centres = np.floor(2000 * rng.normal(size=(8, 16)))
    anchors = np.concatenate([c + np.floor(5 * rng.normal(size=(20, 16))) for c in centres])
    tree = hard_negatives.make_tree(np.arange(160), np.zeros(160, dtype=np.int64), anchors)
    assert all(p < i for i, p in enumerate(tree.parents)) and np.allclose(
        [np.linalg.norm(tree.vectors[i] - tree.vectors[p]) for i, p in enumerate(tree.parents) if i], tree.edges[1:])
    rows = np.floor(2000 * rng.normal(size=(500, 16)))
    search = hard_negatives.Search(tree, rows)
    for anchor in range(160):
        low, high = search.bounds(anchor)
        exact = rows @ tree.vectors[anchor]
        assert (low <= exact).all() and (exact <= high).all()
        search.score(anchor, np.flatnonzero(high >= np.sort(exact)[-5]))
    assert search.scored < 0.25 * 160 * 500
