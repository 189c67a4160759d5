"""Approximate nearest neighbours from balanced posting lists around centroids."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portolan.sources.scratch import store

# The centroids are fitted on about SAMPLE vectors of a length, drawn by hash (fewer if long:
# CELLS numbers at most); there is one for each LIST vectors of the table, MOST_LISTS at
# most. A length with fewer than FITTED vectors has one list.
SAMPLE, CELLS, LIST, MOST_LISTS, FITTED = 65_536, 4_000_000, 512, 4_096, 1_024
# A vector is copied to up to COPIES lists whose centroids are at most 1 + NEAR times as far
# as its nearest one. About one vector in RARE may be too long for the lists (the longest,
# if they are over twice as long as all others); all queries read these.
COPIES, NEAR, RARE = 2, 0.05, 1_000
# A query reads the lists up to some ratio as far as its nearest. The ratio is the least
# of those tried that finds RECALL of the true neighbours of about DRAWN queries.
RECALL, DRAWN, RATIOS = 0.97, 256, [1.0 + 0.02 * 1.15**i for i in range(60)]
DEGREE, ENTRIES, FIRST = 24, 8, 8
# Rows of vectors, and of queries, that one task scores against each other at a time, and
# the parts that the lists of a small table are dealt to.
BLOCK, QUERY_BLOCK, LEAST_SHARDS = 32_768, 4_096, 12


def balanced_centroids(points: np.ndarray, lists: int) -> np.ndarray:
    """Means of equal parts: points are halved along the line between two means, again and again."""
    parts = [points]
    draw = np.random.default_rng(7)
    while len(parts) < lists:
        parts.sort(key=len)
        own = parts.pop()
        if len(own) < 2:
            parts.append(own)
            break
        a, b = own[draw.choice(len(own), 2, replace=False)]
        for _ in range(6):
            side = own @ (a - b)
            order = np.argsort(side, kind="stable")
            half = len(own) // 2
            b, a = own[order[:half]].mean(axis=0), own[order[half:]].mean(axis=0)
        parts += [own[order[:half]], own[order[half:]]]
    return np.array([p.mean(axis=0) for p in parts if len(p)])


@dataclass
class Lists:
    """Centroids, the graph that joins each one to near ones, and the home rows of each.

    Vectors longer than ``longest`` lie in further lists, ``long`` of them, after those of
    the centroids.
    """

    centroids: np.ndarray
    graph: np.ndarray
    longest: float
    long: int
    sizes: np.ndarray
    ratio: float = 1.0

    def lift(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """Vectors with one more number, so that the largest inner product is the least
        distance: stored ones are all made as long as the longest, queries too but by scale."""
        norms = np.sqrt((vectors**2).sum(axis=1))
        if query:
            return np.c_[vectors * (self.longest / norms)[:, None], np.zeros(len(vectors))]
        return np.c_[vectors, np.sqrt(np.maximum(self.longest**2 - norms**2, 0))]

    def homes(self, vectors: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every copy; the first of a row is its nearest list."""
        points, c = self.lift(vectors), self.centroids
        far = np.sqrt(np.maximum((points**2).sum(1)[:, None] - 2 * points @ c.T + (c**2).sum(1), 0))
        nearest = np.argsort(far, axis=1, kind="stable")[:, : min(COPIES, len(c))]
        d = np.take_along_axis(far, nearest, axis=1)
        use = (d <= (1 + NEAR) * d[:, :1]) | (np.arange(nearest.shape[1]) == 0)
        if self.long:
            over = np.sqrt((vectors**2).sum(axis=1)) > self.longest
            nearest[over, 0] = len(c) + ids[over] % self.long
            use[over, 1:] = False
        row, place = np.nonzero(use)
        return row, nearest[row, place]

    def nearest(self, queries: np.ndarray, least_rows: int, ratio: float | None = None) -> Iterator[np.ndarray]:
        """The centroids' lists that each query reads, nearest first.

        The graph is walked from a few entries: the nearest centroid not yet expanded shows
        its neighbours, until all those up to the ratio are expanded. Lists beyond the ratio
        are pruned, but for those needed to have ``least_rows`` rows.
        """
        ratio = self.ratio if ratio is None else ratio
        points, c, n = self.lift(queries, True), self.centroids, len(self.centroids)
        squares, own = (c**2).sum(1), (points**2).sum(1)
        rows = np.arange(len(points))
        far = np.full((len(points), n), np.inf)
        expanded = np.zeros((len(points), n), dtype=bool)
        entries = np.unique(np.linspace(0, n - 1, ENTRIES).astype(int))
        far[:, entries] = np.maximum(own[:, None] - 2 * points @ c[entries].T + squares[entries], 0)
        for turn in range(n):
            open_ = np.where(expanded, np.inf, far)
            at = open_.argmin(axis=1)
            on = np.isfinite(open_[rows, at]) & ((turn < ENTRIES) | (open_[rows, at] <= ratio**2 * far.min(axis=1)))
            if not on.any():
                break
            some, shown = rows[on], self.graph[at[on]]
            expanded[some, at[on]] = True
            far[some[:, None], shown] = np.maximum(own[some, None] - 2 * np.einsum("qd,qnd->qn", points[some], c[shown]) + squares[shown], 0)
        for line in far:
            order = np.argsort(line, kind="stable")
            order = order[np.isfinite(line[order])]
            use = line[order] <= ratio**2 * line[order[0]]
            filled = np.cumsum(self.sizes[order])
            use |= np.r_[0, filled[:-1]] < least_rows
            if filled[-1] < min(least_rows, self.sizes[:n].sum()):  # the graph has shown too few: all
                yield np.arange(n)
            else:
                yield order[use]

    def fit_ratio(self, queries: np.ndarray, least_rows: int, true: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Take the least ratio with which the queries' lists hold RECALL of their true
        neighbours, given as (ids, vectors); the largest tried reads all lists of most tables."""
        homes = []
        for ids, vectors in true:
            row, number = self.homes(vectors, ids) if len(ids) else (np.empty(0, int), np.empty(0, int))
            homes.append([set(number[row == i].tolist()) for i in range(len(ids))])
        wanted = sum(map(len, homes))
        for self.ratio in RATIOS:
            found = 0
            for own, read in zip(homes, self.nearest(queries, least_rows)):
                held = set(read.tolist()) | set(range(len(self.centroids), len(self.sizes)))
                found += sum(bool(held & lists) for lists in own)
            if found >= RECALL * wanted:
                break


def join_centroids(centroids: np.ndarray) -> np.ndarray:
    """Neighbours of each centroid: the nearest, and those beside it in the list, so that all are joined."""
    n = len(centroids)
    squares = (centroids**2).sum(1)
    far = squares[:, None] - 2 * centroids @ centroids.T + squares
    np.fill_diagonal(far, np.inf)
    near = np.argsort(far, axis=1, kind="stable")[:, : max(1, min(DEGREE, n - 1))]
    i = np.arange(n)
    return np.c_[near, (i + 1) % n, (i - 1) % n]


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def _usable(docs: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, v (doubles) and size of the vectors that take part, each row once, stored."""
    v = F.col(vector_col).cast("array<double>")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & (F.size("v") > 0)
        & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    return store(rows.distinct().withColumn("size", F.size("v")), "vectors")


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _by_size(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """size, places, ids and vectors of the rows of a batch, length by length."""
    sizes, ids = batch.column("size").to_numpy(), batch.column("id").to_numpy()
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield int(size), at, ids[at], _matrix(batch.column("v").take(pa.array(at)))


def _drawn(some: DataFrame, share: float) -> DataFrame:
    return some.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1))


def fit_lists(rows: DataFrame, size: int, count: int) -> Lists:
    """Centroids of a sample of the vectors of one length."""
    if count < FITTED:
        return Lists(np.zeros((1, size + 1)), np.zeros((1, 2), dtype=int), 1.0, 0, np.zeros(1, dtype=int))
    own = rows.filter(F.col("size") == size)
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    usual, longest = own.agg(F.percentile_approx(length, 1 - 1 / RARE, 10 * RARE), F.max(length)).first()
    outliers = longest > 2 * usual
    drawn = _drawn(own, min(1.0, min(SAMPLE, max(1, CELLS // size)) / count)).select("v").toArrow()
    lists = Lists(np.empty(0), np.empty(0), usual if outliers else longest, -(-count // (RARE * LIST)) if outliers else 0, np.zeros(1, dtype=int))
    points = _matrix(drawn.column(0)) if len(drawn) else np.zeros((0, size))
    points = lists.lift(points[np.sqrt((points**2).sum(axis=1)) <= lists.longest])
    n = max(1, min(MOST_LISTS, count // LIST, len(points) // 8))
    lists.centroids = balanced_centroids(points, n) if len(points) else np.zeros((1, size + 1))
    lists.graph = join_centroids(lists.centroids)
    lists.sizes = np.zeros(len(lists.centroids) + lists.long, dtype=int)
    return lists


def _scores(asking: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Inner products, each a sum over its own products, so that equal vectors score the
    same wherever they are."""
    return (points * asking).sum(axis=1)


def _best(line: np.ndarray, q: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the best ``k`` of a line of rough scores, ``least`` at least."""
    floor_ = max(np.partition(line, -k)[-k] if len(line) > k else -np.inf, least)
    at = np.flatnonzero((line >= floor_ - 1e-9 * abs(floor_) if np.isfinite(floor_) else True) & (line > -np.inf))
    exact = _scores(q, points[at])
    at, exact = at[exact >= least], exact[exact >= least]
    use = top(exact, ids[at], k)
    return at[use], exact[use]


def true_neighbours(rows: DataFrame, queries: list, k: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of the ``k`` best of all ``rows`` for a few queries of one length.

    Each task goes through its rows in batches and keeps ``k`` for each query.
    """
    names, asking = np.array([q["id"] for q in queries]), np.array([q["v"] for q in queries])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [(np.empty(0), np.empty(0, np.int64), np.empty((0, asking.shape[1])))] * len(names)
        for batch in batches:
            if not batch.num_rows:
                continue
            points, ids = _matrix(batch.column("v")), batch.column("id").to_numpy()
            for i, line in enumerate(asking @ points.T):
                line[ids == names[i]] = -np.inf
                at, exact = _best(line, asking[i], points, ids, k, kept[i][0].min() if len(kept[i][0]) >= k else -np.inf)
                scores, own = np.r_[kept[i][0], exact], np.r_[kept[i][1], ids[at]]
                use = top(scores, own, k)
                kept[i] = scores[use], own[use], np.r_[kept[i][2], points[at]][use]
        at = np.repeat(np.arange(len(names)), [len(x[0]) for x in kept])
        vectors = np.concatenate([x[2] for x in kept])
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(np.concatenate([x[0] for x in kept])), pa.array(np.concatenate([x[1] for x in kept])), pa.array(list(vectors), pa.list_(pa.float64()))],
            names=["query", "score", "id", "v"],
        )

    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    found = rows.select("id", "v").mapInArrow(run, "query int, score double, id long, v array<double>")
    best: dict[int, list] = {i: [] for i in range(len(names))}
    for r in found.withColumn("rank", place).filter(F.col("rank") <= k).collect():  # k rows for each of a few queries
        best[r["query"]].append(r)
    return {i: (np.array([r["id"] for r in rs], dtype=np.int64), np.array([r["v"] for r in rs])) for i, rs in best.items()}


def score_cell(asked: pa.Table, held: pa.Table, k: int) -> pa.Table:
    """The best ``k`` of the rows of a cell that lie in each query's lists, its bound at least."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if asked.num_rows and held.num_rows:
        held = held.sort_by("list")
        number, ids, points = held.column("list").to_numpy(), held.column("id").to_numpy(), _matrix(held.column("v"))
        names, asking, bounds = asked.column("query_id").to_numpy(), _matrix(asked.column("q")), asked.column("least").to_numpy().copy()
        wanted = asked.column("lists").combine_chunks()
        query = np.repeat(np.arange(len(names)), np.diff(wanted.offsets.to_numpy()))
        lists = wanted.flatten().to_numpy()
        order = np.argsort(lists, kind="stable")
        query, lists = query[order], lists[order]
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for start in np.flatnonzero(np.r_[True, lists[1:] != lists[:-1]]):
            a, b = np.searchsorted(number, [lists[start], lists[start] + 1])
            who = query[start : np.searchsorted(lists, lists[start], side="right")]
            for part in range(0, len(who) if a < b else 0, 256):
                some = who[part : part + 256]
                for i, line in zip(some.tolist(), asking[some] @ points[a:b].T):
                    line[ids[a:b] == names[i]] = -np.inf
                    at, exact = _best(line, asking[i], points[a:b], ids[a:b], k, bounds[i])
                    if i in kept:
                        scores, own = np.r_[kept[i][0], exact], np.r_[kept[i][1], ids[a:b][at]]
                        own, first = np.unique(own, return_index=True)  # a copy in another list
                        use = top(scores[first], own, k)
                        kept[i] = scores[first][use], own[use]
                    else:
                        kept[i] = exact, ids[a:b][at]
                    if len(kept[i][0]) == k:
                        bounds[i] = max(bounds[i], kept[i][0].min())
        found = [(np.full(len(own), names[i]), own, scores) for i, (scores, own) in kept.items()]
    columns = [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, np.int64)] * 2 + [np.empty(0)]
    return pa.table(dict(zip(("query_id", "id", "score"), columns)))


def nearest_neighbours(
    docs: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """For each row of ``docs`` where ``queries`` holds, the ``k`` rows found with the largest
    inner product: query_id, rank from 1, ``id_col`` and score.

    Every usable vector is in the list of its nearest centroid, and near a boundary in
    others too. Queries go to the lists that the centroid graph and a distance ratio select;
    the ratio is chosen so that the lists of some drawn queries hold RECALL of their true
    neighbours, found among all rows. Lists are dealt to shards, and large shards split into
    blocks of vectors by hash. A query's nearest few lists are scored first; their ``k``-th
    score bounds what its other lists give. Scores are in double precision on the original
    vectors. Ties go to the smaller id; a row is no neighbour of its own id; rows with one
    id count once. Of exact copies of a vector only the ``k`` + 1 smallest ids can be among
    the nearest, so further ones are not carried. Vectors that are null, zero, or hold nulls
    or non-finite numbers take no part, nor do null ids; those of different lengths have no
    inner product and don't meet. ``queries`` may use ``id``, the id as a long. Fewer than
    ``k`` candidates give as many rows; an empty table gives none.
    """
    spark = docs.sparkSession
    rows = _usable(docs, id_col, vector_col)
    counts = {r["size"]: r["count"] for r in rows.groupBy("size").count().collect()}
    out = f"query_id long, rank int, {id_col} long, score double"
    if not counts:
        return spark.createDataFrame([], out)
    fitted = {size: fit_lists(rows, size, n) for size, n in counts.items()}
    shared = spark.sparkContext.broadcast(fitted)  # centroids and graph: MOST_LISTS rows a length
    copies = Window.partitionBy(F.xxhash64("v"), "v").orderBy("id")
    carried = rows.withColumn("_copy", F.row_number().over(copies)).filter(F.col("_copy") <= k + 1).select("size", "id", "v")

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, places, ids, vectors in _by_size(batch):
                row, number = shared.value[size].homes(vectors, ids)
                first = np.r_[True, row[1:] != row[:-1]][: len(row)]
                at = pa.array(places[row])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), pa.array(number, pa.int32()), pa.array(first), batch.column(1).take(at), batch.column(2).take(at)],
                    names=["size", "list", "home", "id", "v"],
                )

    postings = store(carried.mapInArrow(post, "size int, list int, home boolean, id long, v array<double>"), "postings")
    counted = postings.groupBy("size", "list").agg(F.count("*").alias("n"), F.sum(F.col("home").cast("long")).alias("homes")).collect()
    shards = {size: min(len(lists.sizes), max(LEAST_SHARDS, -(-counts[size] // BLOCK))) for size, lists in fitted.items()}
    held_rows: dict[tuple[int, int], int] = {}
    for r in counted:
        fitted[r["size"]].sizes[r["list"]] = r["homes"]
        cell = r["size"], r["list"] % shards[r["size"]]
        held_rows[cell] = held_rows.get(cell, 0) + r["n"]
    wanted = rows.filter(queries)
    for size, lists in fitted.items():
        if len(lists.centroids) > 1:
            own = wanted.filter(F.col("size") == size)
            drawn = _drawn(own, min(1.0, DRAWN / max(1, own.count()))).orderBy(F.xxhash64("id")).limit(2 * DRAWN).collect()
            if drawn:
                true = true_neighbours(postings.filter((F.col("size") == size) & F.col("home")), drawn, k)
                lists.fit_ratio(np.array([q["v"] for q in drawn]), k + 1, [true[i] for i in range(len(drawn))])
    chosen = spark.sparkContext.broadcast((fitted, shards))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, places, _, vectors in _by_size(batch):
                lists, n = chosen.value[0][size], chosen.value[1][size]
                for start in range(0, len(places), 512):
                    made = []
                    for i, read in enumerate(lists.nearest(vectors[start : start + 512], k + 1), start):
                        first = max(1, min(FIRST, len(read) // 4))
                        further = np.r_[read[first:], np.arange(len(lists.centroids), len(lists.sizes))]
                        for phase, some in ((1, read[:first]), (2, further)):
                            for shard in np.unique(some % n):
                                made.append((places[i], phase, shard, some[some % n == shard].tolist()))
                    at = pa.array([m[0] for m in made], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([m[1] for m in made], pa.int32()), batch.column(2).take(at), pa.array([m[2] for m in made], pa.int32()),
                         pa.array([m[3] for m in made], pa.list_(pa.int32())), batch.column(0).take(at), batch.column(1).take(at)],
                        names=["phase", "size", "shard", "lists", "query_id", "q"],
                    )

    asked = wanted.select("id", "v", "size").mapInArrow(probe, "phase int, size int, shard int, lists array<int>, query_id long, q array<double>")
    asked = store(asked, "asked")
    asked_rows = {(r["size"], r["shard"]): r["count"] for r in asked.groupBy("size", "shard").count().collect()}
    plan = spark.createDataFrame(
        [(*cell, -(-n // BLOCK), max(1, -(-asked_rows.get(cell, 0) // QUERY_BLOCK))) for cell, n in held_rows.items()],
        "size int, shard int, blocks int, cuts int",
    )
    parts = spark.createDataFrame([(size, n) for size, n in shards.items()], "size int, parts int")
    held = postings.join(F.broadcast(parts), "size").withColumn("shard", F.pmod("list", "parts")).join(F.broadcast(plan), ["size", "shard"])
    held = held.select(
        "size", "shard", "list", "id", "v", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut"),
    )

    def score(some: DataFrame) -> DataFrame:
        placed = some.join(F.broadcast(plan), ["size", "shard"]).select(
            *[F.col(c).alias(c) for c in ("size", "shard", "lists", "query_id", "q", "least")],
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("query_id"), F.col("cuts")).cast("int").alias("cut"),
        )
        keys = ["size", "shard", "block", "cut"]
        return placed.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(
            lambda asking, rows_: score_cell(asking, rows_, k), "query_id long, id long, score double"
        )

    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))

    def best_of(scored: DataFrame) -> DataFrame:
        one = scored.groupBy("query_id", "id").agg(F.max("score").alias("score"))
        return one.withColumn("rank", place).filter(F.col("rank") <= k)

    nothing = F.lit(float("-inf"))
    near = store(best_of(score(asked.filter("phase = 1").withColumn("least", nothing))).drop("rank"), "first-scores")
    bounds = near.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(nothing).alias("least"))
    rest = asked.filter("phase = 2").join(bounds, "query_id", "left").withColumn("least", F.coalesce("least", nothing))
    return best_of(near.unionByName(score(rest))).select("query_id", "rank", F.col("id").alias(id_col), "score")
