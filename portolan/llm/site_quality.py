"""Document quality from a classifier and, shrunk by empirical Bayes, from the site."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan.llm.kept import kept
from portolan.llm.quality_rules import MEASURES, measure
from portolan.operators.lookup import lookup_join
from portolan.sources.scratch import store

# The classifier is fitted on about this many labelled documents, drawn by hash of their id.
LABELLED_ROWS = 20_000
_EDGE = 1e-4  # probabilities stay this far from 0 and 1
# Words count in so many hashed features, each drawn to zero WORD_RIDGE times as strongly as
# a feature of the measures.
WORD_FEATURES, WORD_RIDGE = 256, 30.0
# Words whose feature a worker remembers.
MOST_WORDS = 100_000


def _counted(texts: Sequence[str | None]) -> np.ndarray:
    """The features of texts: rates of the measures, then square roots of the shares of
    words by feature."""
    m = dict(zip(MEASURES, np.array([measure(t or "") for t in texts], dtype=np.float64).reshape(len(texts), len(MEASURES)).T))
    words, chars = np.maximum(m["n_words"], 1), np.maximum(m["word_chars"], 1)
    rates = [
        np.log1p(m["n_words"]), m["word_chars"] / words, np.minimum(1, m["n_symbols"] / words), np.minimum(1, m["n_symbol_runs"] / words),
        m["n_dup_lines"] / np.maximum(m["n_lines"], 1), m["n_repeat_words"] / words, m["n_upper"] / chars, np.minimum(1, m["n_marks"] / words),
        np.minimum(1, m["n_stops"] / words), m["n_stutters"] / words, m["n_other_chars"] / chars,
    ]
    shares = np.zeros((len(texts), WORD_FEATURES))
    known: dict[str, int] = kept("word-features", dict)
    if len(known) > MOST_WORDS:
        known.clear()
    for row, text in zip(shares, texts):
        for word, n in Counter((text or "").lower().split()).items():
            at = known.get(word)
            if at is None:
                at = zlib.crc32(word.encode("utf-8", "replace")) % WORD_FEATURES
                if len(word) <= 32:
                    known[word] = at
            row[at] += n
    return np.c_[np.array(rates).T.reshape(len(texts), len(rates)), np.sqrt(shares / words[:, None])]


def _chunks(batch: pa.RecordBatch, text: int, most: int = 256) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of a batch with the features of their texts, which stand in column ``text``."""
    for start in range(0, batch.num_rows, most):
        part = batch.slice(start, most)
        yield part, _counted(part.column(text).to_pylist())


def doc_scores(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    z = np.clip((x * weights[:-1]).sum(axis=1) + weights[-1], -30, 30)
    return np.clip(1 / (1 + np.exp(-z)), _EDGE, 1 - _EDGE)


def fit_classifier(x: np.ndarray, y: np.ndarray, ridge: np.ndarray | float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression, the constant last, for features as they are.

    ``ridge`` is what draws each weight, for features of unit deviation, to zero.
    """
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w, penalty = np.zeros(z.shape[1]), np.r_[np.broadcast_to(ridge, x.shape[1]), 1e-6]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return np.r_[w[:-1] / scale, w[-1] - (w[:-1] * mean / scale).sum()]


def _clip(p: Column) -> Column:
    return F.greatest(F.lit(_EDGE), F.least(F.lit(1 - _EDGE), p))


def _logit(p: Column) -> Column:
    return F.ln(_clip(p)) - F.ln(1 - _clip(p))


@dataclass(frozen=True)
class SiteModel:
    """The classifier, what is expected overall, how strongly hosts and paths are drawn to
    what they belong to (in documents), and the sums of each path and its host."""

    weights: np.ndarray
    overall: float
    host_pull: float
    path_pull: float
    sites: DataFrame


def _pull(overall: float, groups: int, total: float, squares: float, between: float, within: float, base: int) -> float:
    """Documents that a group's prior counts for: the fewer, the more groups really differ.

    By the method of moments: the variance between groups beyond what documents that
    differ within groups explain. ``base`` groups are above these.
    """
    if groups <= base or total <= groups:
        return 1e9
    noise = within / (total - groups)
    spread = (between - (groups - base) * noise) / max(1e-12, total - squares / total)
    return min(1e9, max(1.0, overall * (1 - overall) / spread - 1)) if spread > 1e-12 else 1e9


def fit_weights(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> np.ndarray:
    """The classifier's weights, from about LABELLED_ROWS labelled documents.

    An id is one example, however often it occurs: the first of its texts, with the mean
    of its labels.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.avg(label_col).alias("_y"))
    share = min(1.0, LABELLED_ROWS / max(1, known.count()))
    drawn = known.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1))
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    examples = texts.join(F.broadcast(drawn), "_id").groupBy("_id", "_y").agg(F.min("_text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in _chunks(batch, 1):
                offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
                flat = pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.astype(np.float32).ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), flat], names=["y", "x"])

    found = examples.select("_y", "_text").mapInArrow(run, "y double, x array<float>").toArrow()
    if not found.num_rows:
        return np.zeros(12 + WORD_FEATURES)
    x = found.column("x").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(found.num_rows, -1)
    y = (found.column("y").to_numpy() >= 0.5).astype(np.float64)
    return fit_classifier(x, y, np.r_[np.ones(11), np.full(WORD_FEATURES, WORD_RIDGE)])


def scored(docs: DataFrame, weights: np.ndarray, host: Column, path: Column, text_col: str, keep: Sequence[str]) -> DataFrame:
    """``keep`` as _k0, _k1, ..., with _host, _path and _score, the document's evidence,
    of every row; stored, as sums and judgements both read it."""
    names = [f"_k{i}" for i in range(len(keep))]
    schema = T.StructType([
        *(T.StructField(n, docs.schema[c].dataType) for n, c in zip(names, keep)),
        T.StructField("_host", T.StringType()), T.StructField("_path", T.StringType()), T.StructField("_score", T.DoubleType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in _chunks(batch, len(keep) + 2):
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep) + 2], pa.array(doc_scores(x, weights))], names=schema.names)

    body = F.col(text_col).cast("string").alias("_own_text")
    rows = docs.select(*[F.col(c).alias(n) for n, c in zip(names, keep)], *_site(host, path), body)
    return store(rows.mapInArrow(run, schema), "scored")


def fit_sites(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str, text_col: str, label_col: str
) -> SiteModel | None:
    """Fit the classifier on a bounded sample of ``labels`` and the hierarchy on all ``docs``."""
    weights = fit_weights(docs, labels, id_col, text_col, label_col)
    return fit_hierarchy(scored(docs, weights, host, path, text_col, [id_col]), weights)


def fit_hierarchy(rows: DataFrame, weights: np.ndarray) -> SiteModel | None:
    """What hosts and paths have, and how strongly they are drawn together; None without rows."""
    p = F.col("_score")
    paths = store(
        rows.groupBy("_host", "_path").agg(F.count("*").alias("n"), F.sum(p).alias("s"), F.sum(p * p).alias("q")), "site-paths"
    )
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"), F.sum("q").alias("host_q"), F.count("*").alias("host_paths"))
    square = lambda n: F.sum(F.col(n).cast("double") * F.col(n))
    h = hosts.agg(
        F.count("*").alias("groups"), F.sum("host_n").alias("n"), F.sum("host_s").alias("s"), F.sum("host_q").alias("q"),
        square("host_n").alias("squares"), F.sum(F.col("host_s") * F.col("host_s") / F.col("host_n")).alias("explained"),
    ).first()
    if not h["groups"]:
        return None
    k = paths.agg(F.count("*").alias("groups"), square("n").alias("squares"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("explained")).first()
    overall = min(1 - _EDGE, max(_EDGE, h["s"] / h["n"]))
    host_pull = _pull(overall, h["groups"], h["n"], h["squares"], h["explained"] - h["s"] ** 2 / h["n"], h["q"] - h["explained"], 1)
    path_pull = _pull(overall, k["groups"], h["n"], k["squares"], k["explained"] - h["explained"], h["q"] - k["explained"], h["groups"])
    sites = store(paths.join(hosts, "_host").select("_host", "_path", "n", "s", "host_n", "host_s"), "sites")
    return SiteModel(weights, overall, host_pull, path_pull, sites)


def _site(host: Column, path: Column) -> list[Column]:
    return [F.coalesce(c.cast("string"), F.lit("")).alias(n) for c, n in ((host, "_host"), (path, "_path"))]


def judge(rows: DataFrame, model: SiteModel, keep: Sequence[str]) -> DataFrame:
    """``keep`` with doc_score, site_score and quality of every row of :func:`scored`.

    The site's score leaves the row itself out: what is known of the other documents of its
    path, drawn to that of its host, drawn to the whole. It takes the place of the overall
    share of good documents as the prior of the row's own evidence.
    """
    joined = lookup_join(rows, model.sites, ["_host", "_path"], "left")
    own, pull, path_pull = F.col("_score"), F.lit(model.host_pull), F.lit(model.path_pull)
    of_host = (pull * model.overall + F.col("host_s") - own) / (pull + F.col("host_n") - 1)
    of_path = (path_pull * of_host + F.col("s") - own) / (path_pull + F.col("n") - 1)
    odds = _logit(own) + _logit(of_path) - _logit(F.lit(model.overall))
    return joined.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
        own.alias("doc_score"), _clip(of_path).alias("site_score"), (1 / (1 + F.exp(-odds))).alias("quality"),
    )


def classify_quality(
    docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, id_col: str = "doc_id",
    text_col: str = "text", label_col: str = "quality", keep: Sequence[str] | None = None, threshold: float = 0.5,
) -> DataFrame:
    """``keep`` (by default ``id_col``) with doc_score, site_score, quality and kept.

    A logistic regression on measures and hashed words of the whole text, fitted on at most
    about LABELLED_ROWS labelled documents, gives each document's evidence. Sums of it per path
    and host over all documents give posteriors that shrink to the level above, the more
    the fewer documents a site has and the less sites differ. quality combines the two;
    kept is quality at or above ``threshold``. ``host`` is by default the source and
    ``path`` the language in it; null sites are one site. Null texts count as empty.
    Repeated rows count as often as they occur for their site, and once in the fit; labels
    that disagree are averaged. Without
    labels every document scores one half and is kept. An empty table gives no rows.
    """
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    keep = [c for c in (keep or [id_col]) if c not in ("doc_score", "site_score", "quality", "kept")]
    weights = fit_weights(docs, labels, id_col, text_col, label_col)
    rows = scored(docs, weights, host, path, text_col, keep)
    model = fit_hierarchy(rows, weights)
    if model is None:
        no = F.lit(None).cast("double")
        found = docs.select(*keep, no.alias("doc_score"), no.alias("site_score"), no.alias("quality"))
    else:
        found = judge(rows, model, keep)
    return found.withColumn("kept", F.col("quality") >= threshold)
