from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from portolan.llm import neighbours as N


def exact(rows, queries, k):
    usable = {i: np.array(v, dtype=float) for i, v in rows}
    out = {}
    for q in queries:
        scores = sorted((-(usable[q] * v).sum(), i) for i, v in usable.items() if i != q)
        out[q] = [i for _, i in scores[:k]]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, list string, score string").repartition(3)


def test_recall_and_scores(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = N.nearest_neighbours(vectors, F.col("id") % 20 == 0).toPandas()
    local = vectors.toPandas().sort_values("vec_id")
    points, ids = np.array(local["embedding"].tolist(), dtype=float), local["vec_id"].to_numpy()
    at = {v: i for i, v in enumerate(ids)}
    hits = 0
    for query, rows in found.groupby("query_id"):
        scores = (points * points[at[query]]).sum(axis=1)
        assert np.array_equal(rows.sort_values("rank")["score"].to_numpy(), scores[[at[v] for v in rows.sort_values("rank")["vec_id"]]])
        scores[at[query]] = -np.inf
        hits += len(set(ids[np.lexsort((ids, -scores))[:20]]) & set(rows["vec_id"]))
    assert found["query_id"].nunique() == (ids % 20 == 0).sum()
    assert hits >= 0.95 * len(found)


def test_copies_ties_and_lengths(spark, monkeypatch):
    for name, value in (("LIST", 20), ("BLOCK", 32)):
        monkeypatch.setattr(N, name, value)
    draw = np.random.default_rng(0)
    rows = [(i, draw.normal(size=4).round(2).tolist()) for i in range(0, 150)]
    rows += [(i, [3.0, 1.0, 0.0, 0.0]) for i in range(200, 400)]  # copies, far more than k
    want = exact([(i, np.float32(v).astype(float)) for i, v in rows], [i for i, _ in rows if i % 20 == 0], 5)
    odd = [(1000, None), (1020, [0.0] * 4), (1040, [1.0, None, 1.0, 1.0]), (1060, [float("nan")] * 4), (1080, [float("inf"), 1.0, 1.0, 1.0]), (1100, [1.0, 2.0]), (1120, []), (None, [1.0] * 4)]
    found = N.nearest_neighbours(table(spark, rows + odd + rows[:1]), F.col("id") % 20 == 0, k=5).toPandas()
    got = {q: g.sort_values("rank")["vec_id"].tolist() for q, g in found.groupby("query_id")}
    assert set(got) == set(want)
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 5 * len(want)
    copied = [q for q in want if q >= 200]
    assert all(got[q] == [i for i in range(200, 207) if i != q][:5] for q in copied if want[q] == [i for i in range(200, 207) if i != q][:5])


def test_few_and_none(spark):
    few = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    found = N.nearest_neighbours(table(spark, few), F.col("id") == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"])] == [(0, 1, 1, 0.5), (0, 2, 2, -1.0)]
    empty = N.nearest_neighbours(table(spark, []), F.col("id") == 0)
    assert empty.count() == 0 and empty.columns == ["query_id", "rank", "vec_id", "score"]


def recall(spark, rows, k=20, every=20):
    """Share of the true neighbours found, and the scores' exactness, against all rows of the query's length."""
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = N.nearest_neighbours(df, F.col("id") % every == 0, k=k).toPandas()
    hits = wanted = 0
    by_length = {}
    for i, v in rows:
        by_length.setdefault(len(v), []).append((i, v))
    got = {q: g.sort_values("rank") for q, g in found.groupby("query_id")}
    for own in by_length.values():
        ids, points = np.array([i for i, _ in own]), np.array([v for _, v in own])
        for at in np.flatnonzero(ids % every == 0):
            scores = (points * points[at]).sum(axis=1)
            place = dict(zip(ids.tolist(), scores))
            scores[at] = -np.inf
            best = set(ids[np.lexsort((ids, -scores))[: min(k, len(ids) - 1)]].tolist())
            wanted += len(best)
            if ids[at] in got:
                g = got[ids[at]]
                hits += len(best & set(g["vec_id"]))
                assert [place[i] for i in g["vec_id"]] == g["score"].tolist()
    assert set(got) <= {i for i, _ in rows if i % every == 0}
    return hits / wanted


def unit(draw, n, dims):
    v = draw.normal(size=(n, dims))
    return (v / np.sqrt((v**2).sum(axis=1))[:, None]).tolist()


def test_recall_over_many_lists(spark, monkeypatch):
    """Over 500 lists without clusters: the ratio follows the measured recall."""
    monkeypatch.setattr(N, "LIST", 24)
    draw = np.random.default_rng(3)
    rows = list(enumerate(unit(draw, 13_000, 24)))
    assert recall(spark, rows, every=100) >= 0.9


def test_clusters_read_few_lists(spark, monkeypatch):
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(40, 16)) * 3
    points = centres[draw.integers(0, 40, 8000)] + draw.normal(size=(8000, 16)) * 0.3
    lists = N.Lists(np.empty(0), np.empty(0), float(np.sqrt((points**2).sum(axis=1)).max()), 0, np.empty(0))
    lists.centroids = N.balanced_centroids(lists.lift(points), 64)
    lists.graph, lists.sizes = N.join_centroids(lists.centroids), np.full(64, 125)
    queries, true = points[:50], []
    for q in queries:
        at = np.argsort(-(points @ q), kind="stable")[:20]
        true.append((at, points[at]))
    lists.fit_ratio(queries, 21, true)
    read = np.mean([len(r) for r in lists.nearest(points[100:400], 21)])
    assert read < 25 and recall(spark, list(enumerate(points.tolist())), every=100) >= 0.9


def test_two_lengths_and_very_long_vectors(spark, monkeypatch):
    monkeypatch.setattr(N, "LIST", 64)
    draw = np.random.default_rng(5)
    rows = list(enumerate(unit(draw, 5000, 12)))
    rows += [(10_000 + i, v) for i, v in enumerate(unit(draw, 3000, 7))]
    rows += [(20_000 + i, v) for i, v in enumerate(unit(draw, 40, 3))]
    rows += [(30_000, (np.array(rows[0][1]) * 1e6).tolist()), (30_001, (np.array(rows[1][1]) * 1e9).tolist())]
    assert recall(spark, rows, every=50) >= 0.9


def test_one_long_vector_does_not_spoil_the_lists():
    """Beside a vector of length 1e6 queries still read a part of the lists."""
    draw = np.random.default_rng(6)
    points = np.array(unit(draw, 6000, 12))
    lists = N.Lists(np.empty(0), np.empty(0), 1.0, 1, np.empty(0))
    lists.centroids = N.balanced_centroids(lists.lift(points), 100)
    lists.graph, lists.sizes = N.join_centroids(lists.centroids), np.full(101, 60)
    _, number = lists.homes(np.r_[points[:3], points[:1] * 1e6], np.arange(4))
    assert number[-1] == 100 and (number[:-1] < 100).all()
    lists.ratio = 1.1
    assert np.mean([len(r) for r in lists.nearest(points[:200], 21)]) < 60


def test_graph_joins_all():
    points = np.random.default_rng(2).normal(size=(300, 3))
    graph = N.join_centroids(points)
    seen, wave = {0}, {0}
    while wave:
        wave = {int(j) for i in wave for j in graph[i]} - seen
        seen |= wave
    assert len(seen) == 300
