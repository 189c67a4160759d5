"""Hard negatives by a secondary sort of scored pairs."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portolan.sources.scratch import store

# Rows and anchors that one task holds to score them against each other; there are at
# least LEAST_BLOCKS blocks of rows, so that small tables are scored by many tasks too.
BLOCK, ANCHORS, LEAST_BLOCKS = 65_536, 16_384, 16
_LINES = 64
_EXACT, _MOST = 2.0**53, 2**63 - 1
_KEY = struct.Struct(">QQBQ")
_SIGN, _ALL = 1 << 63, (1 << 64) - 1


def pack_key(anchor: int, score: int, negative: bool, other: int) -> bytes:
    """Bytes that sort by anchor, falling score, positives before negatives, then id."""
    return _KEY.pack(anchor + _SIGN, _ALL - (score + _SIGN), negative, other + _SIGN)


def unpack_key(key: bytes) -> tuple[int, int, bool, int]:
    anchor, score, negative, other = _KEY.unpack(key)
    return anchor - _SIGN, _ALL - score - _SIGN, bool(negative), other - _SIGN


def bounds(positive_score: int, low: int, high: int, base: int) -> tuple[int, int]:
    """Least and largest negative score with low * p <= base * n <= high * p."""
    return -(-low * positive_score // base), high * positive_score // base


def open_windows(
    keys: Iterable[bytes], positives: int, negatives: int, low: int, high: int, base: int
) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Rows (anchor, positive, rank, negative, both scores) from keys in order.

    A positive opens a window of scores; a negative goes to each open window that it fits.
    Only the windows of one anchor, ``positives`` at most, are held at a time.
    """
    current, opened, windows = None, 0, []
    for key in keys:
        anchor, score, negative, other = unpack_key(key)
        if anchor != current:
            current, opened, windows = anchor, 0, []
        if not negative:
            if opened < positives:
                opened += 1
                windows.append([other, score, *bounds(score, low, high, base), 0])
            continue
        windows = [w for w in windows if w[4] < negatives and score >= w[2]]
        for w in windows:
            if score <= w[3]:
                w[4] += 1
                yield anchor, w[0], w[4], other, w[1], score


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def integer_scores(a: np.ndarray, b: np.ndarray, scale: int) -> np.ndarray:
    """Inner products of floor(scale * x), as int64 (scores beyond its range are its ends).

    Products of doubles are exact while every partial sum stays under 2^53; pairs that may
    exceed it are worked out in whole numbers of any size.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        p, q = np.floor(a * scale), np.floor(b * scale)
        most = lambda m: np.abs(m).max(axis=1, initial=0.0)
        large = np.multiply.outer(most(p), most(q)) * a.shape[1] >= _EXACT
        scores = p @ q.T
    scores[large] = 0
    scores = scores.astype(np.int64)
    if large.any():
        whole = lambda m, i: [floor(Fraction(x) * scale) for x in m[i].tolist()]
        left = {i: whole(a, i) for i in np.flatnonzero(large.any(axis=1))}
        right = {j: whole(b, j) for j in np.flatnonzero(large.any(axis=0))}
        for i, j in zip(*np.nonzero(large)):
            scores[i, j] = max(-_MOST, min(_MOST, sum(x * y for x, y in zip(left[i], right[j]))))
    return scores


def _first(scores: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The k places of ``at`` with the largest scores; places are in order of id."""
    if len(at) > k:
        least = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= least]
    return at[np.argsort(-scores[at], kind="stable")[:k]]


def _score_cells(asked: DataFrame, held: DataFrame, scale: int, choose) -> DataFrame:
    """anchor, id and score of the places that ``choose(scores, same label, row of asked)``
    picks in each cell of the grid of anchors and rows."""

    def cell(asking: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if asking.num_rows and rows.num_rows:
            rows = rows.sort_by("id")
            ids, labels, points = rows.column("id").to_numpy(), rows.column("label").to_numpy(), _matrix(rows.column("v"))
            names, own, lines = asking.column("id").to_numpy(), asking.column("label").to_numpy(), _matrix(asking.column("v"))
            windows = asking.column("windows").to_pylist() if "windows" in asking.column_names else [None] * len(names)
            for start in range(0, len(names), _LINES):
                scored = integer_scores(lines[start : start + _LINES], points, scale)
                for i, line in enumerate(scored, start):
                    at = choose(line, labels == own[i], ids != names[i], windows[i])
                    found.append((np.full(len(at), names[i]), ids[at], line[at]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, np.int64)] * 3
        return pa.table(dict(zip(("anchor", "id", "score"), columns)))

    keys = ["size", "block", "cut"]
    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(cell, "anchor long, id long, score long")


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    label: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    base: int = 100,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    The score of two rows is the inner product of floor(``scale`` * x). An anchor's
    positives are its best other rows of the same label; for each of them, its negatives
    are the best rows of another label with ``low`` * p <= ``base`` * n <= ``high`` * p.
    Ties go to the smaller id.

    Anchors meet all rows in a grid of blocks. A first pass finds each anchor's best
    positives, a second the rows that may stand in their windows; of a cell at most
    ``negatives`` rows per window are in a result, so no others are sent on. The pairs'
    scores are packed into (anchor, falling score, id) keys, and a secondary sort brings
    each anchor's pairs to one stream, which opens and closes windows as scores fall and
    holds no anchor's rows.

    Rows with a null id, label or vector, or with a component that is null or not finite,
    take no part. Rows sharing an id are one row, the least by label and vector. Vectors of
    different lengths have no score and don't meet. A negative score has no window. Scores
    beyond a long are its ends. ``anchors`` and ``label`` may use all columns of ``rows``.
    Empty tables, and anchors without positives, give no rows.
    """
    if not 0 <= low < high <= base:
        raise ValueError("windows need 0 <= low < high <= base, as the stream reads falling scores")
    v = F.col(vector_col).cast("array<double>")
    usable = rows.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), v.alias("v"), anchors.alias("anchor")
    ).filter(
        "id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL"
    ).filter(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    one = usable.groupBy("id").agg(F.min(F.struct("label", "v", "anchor")).alias("row"))
    points = store(one.select("id", "row.*", F.size("row.v").alias("size")), "points")
    spark = rows.sparkSession

    asked, counts = points.filter("anchor"), points.agg(F.count("*").alias("rows"), F.count_if("anchor").alias("anchors")).first()
    blocks = max(LEAST_BLOCKS, -(-counts["rows"] // BLOCK))
    cuts = max(1, -(-counts["anchors"] // ANCHORS))
    dealt = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    columns = ["id", "label", "v", "size"]
    held = points.select(*columns, dealt(blocks).alias("block"), every(cuts).alias("cut"))

    def ask(some: DataFrame) -> DataFrame:
        named = some.select(*[F.col(c).alias(c) for c in some.columns])  # new names beside those of ``held``
        return named.withColumn("cut", dealt(cuts)).withColumn("block", every(blocks))

    def best_positives(scores, same, other, _):
        return _first(scores, np.flatnonzero(same & other), positives)

    def in_windows(scores, same, other, windows):
        at = []
        for p in set(windows):
            least, most = (max(-_MOST, min(_MOST, x)) for x in bounds(p, low, high, base))
            if least <= most:
                at.append(_first(scores, np.flatnonzero(~same & other & (scores >= least) & (scores <= most)), negatives))
        return np.unique(np.concatenate(at)) if at else np.empty(0, dtype=np.int64)

    near = _score_cells(ask(asked.select(*columns)), held, scale, best_positives)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    near = store(near.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= positives).drop("n"), "positives")
    windows = near.groupBy(F.col("anchor").alias("id")).agg(F.collect_list("score").alias("windows"))
    far = _score_cells(ask(asked.select(*columns).join(windows, "id")), held, scale, in_windows)

    pairs = near.withColumn("negative", F.lit(False)).unionByName(far.withColumn("negative", F.lit(True)))
    keyed = pairs.rdd.map(lambda r: (pack_key(r["anchor"], r["score"], r["negative"], r["id"]), None))
    in_order = keyed.repartitionAndSortWithinPartitions(
        int(spark.conf.get("spark.sql.shuffle.partitions")), lambda key: zlib.crc32(key[:8])
    )
    mined = in_order.keys().mapPartitions(lambda keys: open_windows(keys, positives, negatives, low, high, base))
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return spark.createDataFrame(mined, out, verifySchema=False)
