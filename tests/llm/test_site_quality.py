from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from portolan.llm import site_quality as S


def test_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2
    judged = S.classify_quality(docs, labels.filter(fold == 0)).join(labels.filter(fold == 1).select("doc_id", F.col("quality").alias("good")), "doc_id")
    assert judged.filter("kept = (good = 1)").count() >= 0.97 * judged.count()


def test_sites_shrink(spark):
    """Posteriors of hosts and paths against the formulas in plain Python."""
    draw = np.random.default_rng(4)
    sites = [(f"h{h}", f"p{p}", 200 if h == 0 else 5) for h in range(12) for p in range(3)]
    share = {h: draw.beta(2, 1) for h in {s[0] for s in sites}}
    clean, spam = " ".join(f"word{i}." for i in range(50)), "### $$$ %%% " * 20
    rows, number = [], 0
    for host, path, n in sites:
        for _ in range(n):
            number += 1
            rows.append((number, clean if draw.random() < share[host] else spam, host, path))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(r[0], int(r[1] == clean)) for r in rows if r[0] % 3], "doc_id long, quality int")
    model = S.fit_sites(docs, labels, F.col("source"), F.col("lang"), "doc_id", "text", "quality")
    found = S.classify_quality(docs, labels, keep=["doc_id", "source", "lang"]).toPandas()
    pull, path_pull, overall = model.host_pull, model.path_pull, found["doc_score"].mean()
    assert abs(model.overall - overall) < 1e-9 and 1 <= pull < path_pull
    for (host, path), own in list(found.groupby(["source", "lang"]))[:9]:
        of = found[found["source"] == host]
        for r in own.head(3).itertuples():
            h = (pull * overall + of["doc_score"].sum() - r.doc_score) / (pull + len(of) - 1)
            p = (path_pull * h + own["doc_score"].sum() - r.doc_score) / (path_pull + len(own) - 1)
            odds = np.log(r.doc_score / (1 - r.doc_score)) + np.log(p / (1 - p)) - np.log(overall / (1 - overall))
            assert abs(p - r.site_score) < 1e-9 and abs(1 / (1 + np.exp(-odds)) - r.quality) < 1e-9


def test_edges(spark, documents):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (77, None)], "doc_id long, quality int")
    rows = [(1, "fine words here. " * 20, None, None), (2, "$$$ " * 50, "en", "s"), (3, None), (4, ""), (5, "x" * 500000, "en", "s"), (1, "fine words here. " * 20), (None, "fine words here. " * 20)]
    found = S.classify_quality(documents(rows), labels).collect()
    assert len(found) == len(rows) and all(0 <= r["quality"] <= 1 and r["kept"] is not None for r in found)
    assert {r["kept"] for r in found if r["doc_id"] == 1} == {True} and not next(r for r in found if r["doc_id"] == 2)["kept"]
    assert S.classify_quality(documents([]), labels).count() == 0
    blind = S.classify_quality(documents(rows), labels.limit(0)).collect()
    assert all(r["doc_score"] == 0.5 and r["kept"] for r in blind)


def test_fit_against_plain_descent():
    """The weights are where the penalised log-likelihood is flat."""
    draw = np.random.default_rng(1)
    x = draw.normal(size=(300, 4)) * [1, 5, 0.1, 0] + [0, 3, 1, 2]
    y = (draw.random(300) < 1 / (1 + np.exp(-(x[:, 0] - 0.4 * x[:, 1] + 1)))).astype(float)
    ridge = np.array([1.0, 1.0, 30.0, 30.0])
    w = S.fit_classifier(x, y, ridge)
    scale = np.where(x.std(axis=0) == 0, 1, x.std(axis=0))
    z, own = (x - x.mean(axis=0)) / scale, w[:-1] * scale
    p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    assert np.abs(z.T @ (y - p) - ridge * own).max() < 1e-4 and abs((y - p).sum()) < 1e-3
    assert np.allclose(S.doc_scores(x, w), np.clip(p, 1e-4, 1 - 1e-4))


def test_pull_against_plain_moments():
    """Documents that the prior counts for, from the sums that Spark gives, against loops."""
    draw = np.random.default_rng(2)
    groups = [draw.beta(6, 3) + draw.normal(0, 0.1, size=n) for n in draw.integers(2, 60, 25)]
    every = np.concatenate(groups)
    total, overall = len(every), every.mean()
    between = sum(len(g) * (g.mean() - overall) ** 2 for g in groups)
    within = sum(((g - g.mean()) ** 2).sum() for g in groups)
    noise = within / (total - len(groups))
    spread = (between - (len(groups) - 1) * noise) / (total - sum(len(g) ** 2 for g in groups) / total)
    sums, squares = [g.sum() for g in groups], [(g**2).sum() for g in groups]
    explained = sum(s * s / len(g) for s, g in zip(sums, groups))
    got = S._pull(overall, len(groups), total, sum(len(g) ** 2 for g in groups), explained - sum(sums) ** 2 / total, sum(squares) - explained, 1)
    assert np.isclose(got, max(1.0, overall * (1 - overall) / spread - 1))
    assert S._pull(0.5, 1, 10, 100, 0, 1, 1) == 1e9 and S._pull(0.5, 5, 50, 500, 0, 20, 1) == 1e9


def test_features_of_a_text():
    text = "One two two. ### Three\nOne two"
    row = S._counted([text, None])[0]
    words = text.lower().split()
    shares = np.zeros(S.WORD_FEATURES)
    for w in words:
        shares[S.zlib.crc32(w.encode()) % S.WORD_FEATURES] += 1 / len(words)
    assert np.allclose(row[11:], np.sqrt(shares)) and np.isclose(row[0], np.log(1 + len(words)))
    assert np.isfinite(S._counted([None, "", "9" * 100_000])).all()


def test_an_id_ten_thousand_times_is_one_example(spark):
    """The rows that reach the driver are one for each labelled id."""
    good, bad = "plain words of a text here. " * 8, "$$$ ### " * 30
    rows = [(i, (good, bad)[i % 2] + str(i)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hot = spark.range(10_000).select(F.lit(0).cast("long").alias("doc_id"), F.lit(rows[0][1]).alias("text"))
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)], "doc_id long, quality int")
    once = S.fit_weights(docs, labels, "doc_id", "text", "quality")
    assert np.allclose(once, S.fit_weights(docs.unionByName(hot), labels, "doc_id", "text", "quality"), atol=1e-5)
