"""Near-duplicates by SimHash fingerprints, linked through a vantage-point tree."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan.llm.components import components
from portolan.operators.lookup import lookup_join
from portolan.sources.scratch import store

SEED = 42
# The tree is built on about SAMPLE distinct fingerprints, drawn by hash, so that a shard
# is expected to hold SHARD of all fingerprints; every fingerprint is then placed by it.
SAMPLE, SHARD, SPLIT = 32_768, 4_096, 16
# Points of a shard that are compared with the others at a time, and comparisons.
_BLOCK, _CELLS = 256, 1 << 21


def fingerprint(text: str, shingle: int = 3) -> int:
    """SimHash of the text's shingles of lower-cased (A-Z) words; 0 without words."""
    words = text.encode().lower().split()  # bytes: only ASCII letters change, ASCII spaces split
    if not words:
        return 0
    line = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    n = max(1, len(words) - shingle + 1)
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a : b - 1], SEED) for a, b in zip(starts[:n], starts[width:])], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 1 << 15):
        some = hashes[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` (by default ``id_col``) and fingerprint (the 64 bits as a signed long) of every row."""
    keep = [id_col] if keep is None else list(keep)
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("fingerprint", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py() or "", shingle) for t in batch.column(len(keep))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(found.view(np.int64))], names=schema.names)

    return docs.select(*keep, F.col(text_col).cast("string").alias("_text_of_print")).mapInArrow(run, schema)


def distance(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


@dataclass(frozen=True)
class Node:
    """Fingerprints within ``radius`` of ``point`` are inside; a leaf has a shard instead."""

    point: np.uint64 | None = None
    radius: int = 0
    inside: Node | None = None
    outside: Node | None = None
    shard: int = 0


def build_tree(sample: np.ndarray, leaf: int, bits: int) -> Node:
    """A vantage-point tree over the sample's fingerprints with at most ``leaf`` in a shard,
    unless they can't be told apart.

    Of some points and all radii, the split is taken that leaves the fewest fingerprints
    near its boundary, as those are looked up on both sides, and halves the rest well.
    """
    draw = np.random.default_rng(SEED)
    shards = iter(range(len(sample) + 1))

    def grow(own: np.ndarray) -> Node:
        best = None
        if len(own) > leaf:
            for point in draw.choice(own, size=min(24, len(own)), replace=False):
                share = np.bincount(distance(own, point), minlength=66 + bits) / len(own)
                below = np.cumsum(share)
                for radius in range(64):
                    inside = below[radius]
                    if 0.1 <= inside <= 0.9:
                        near = below[min(64, radius + bits)] - below[max(0, radius - bits + 1) - 1] if radius >= bits else below[radius + bits]
                        cost = near + abs(inside - 0.5)
                        if best is None or cost < best[0]:
                            best = cost, point, radius
        if best is None:
            return Node(shard=next(shards))
        _, point, radius = best
        into = distance(own, point) <= radius
        return Node(point, radius, grow(own[into]), grow(own[~into]))

    return grow(np.sort(sample))


def place(tree: Node, points: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """Shards and the positions of the points that each gets.

    A point has one home. One that lies outside a node's radius, but near enough to link to
    something inside, also visits the inside; a visitor goes to either side that may hold a
    point within ``bits`` of it, by the triangle inequality. So of two linked points, at
    least one comes to the other's home.
    """
    pending = [(tree, np.arange(len(points)), np.empty(0, dtype=np.int64))]
    while pending:
        node, home, visits = pending.pop()
        if not len(home) and not len(visits):
            continue
        if node.point is None:
            yield node.shard, np.concatenate([home, visits])
            continue
        near, far = distance(points[home], node.point), distance(points[visits], node.point).astype(int)
        pending.append((node.outside, home[near > node.radius], visits[far > node.radius - bits]))
        crossing = home[(near > node.radius) & (near <= node.radius + bits)]
        pending.append((node.inside, home[near <= node.radius], np.concatenate([crossing, visits[far <= node.radius + bits]])))


def local_links(points: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Points that have another within ``bits``, each with the least point it is connected to.

    Points are sorted by their distance from one of them: only those whose distances differ
    by no more than ``bits`` can be that near. No pairs are listed: points are reached from
    a root in waves, and leave the search once reached.
    """
    points = np.unique(points)
    from_first = distance(points, points[0]).astype(int)
    order = np.argsort(from_first, kind="stable")
    points, from_first = points[order], from_first[order]

    def reached(some: np.ndarray, at: np.ndarray, among: np.ndarray, among_at: np.ndarray) -> tuple[slice, np.ndarray]:
        span = slice(*np.searchsorted(among_at, (at[0] - bits, at[-1] + bits + 1)))
        return span, distance(some[:, None], among[None, span]) <= bits

    linked = np.zeros(len(points), dtype=bool)
    step = max(16, min(_BLOCK, _CELLS // len(points)))
    for i in range(0, len(points), step):
        _, hit = reached(points[i : i + step], from_first[i : i + step], points, from_first)
        linked[i : i + step] = hit.sum(axis=1) > 1
    points, from_first = points[linked], from_first[linked]
    nodes, roots = [], []
    while len(points):
        found, wave, wave_at = [points[:1]], points[:1], from_first[:1]
        points, from_first = points[1:], from_first[1:]
        while len(wave) and len(points):
            got = np.zeros(len(points), dtype=bool)
            for i in range(0, len(wave), step):
                span, hit = reached(wave[i : i + step], wave_at[i : i + step], points, from_first)
                got[span] |= hit.any(axis=0)
            wave, wave_at, points, from_first = points[got], from_first[got], points[~got], from_first[~got]
            found.append(wave)
        group = np.concatenate(found)
        nodes.append(group)
        roots.append(np.full(len(group), group.min()))
    empty = np.empty(0, dtype=np.uint64)
    return (np.concatenate(nodes), np.concatenate(roots)) if nodes else (empty, empty)


def link_fingerprints(distinct: DataFrame, bits: int, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """node, root: components of the distinct fingerprints at most ``bits`` apart; those
    without a neighbour are left out.

    Fingerprints go to the shards of a vantage-point tree, those near a boundary to several.
    A shard gives one edge per connected fingerprint, to its root there, not all pairs:
    as connected, and as few as the rows it has read. Shards are then joined over common
    fingerprints. A shard that has grown beyond SPLIT times its size, as fingerprints that
    no vantage point tells apart may make it, is cut into blocks, and each two of them are
    searched together, so that a task holds no more than that many.
    """
    spark = distinct.sparkSession
    total = distinct.count()
    draw = F.pmod(F.xxhash64("fingerprint"), F.lit(1 << 30)) < F.lit(min(1 << 30, -(-sample * (1 << 30) // max(1, total))))
    drawn = np.array([r[0] for r in distinct.filter(draw).select("fingerprint").collect()], dtype=np.int64).view(np.uint64)
    leaf = max(16, shard * len(drawn) // max(1, total))
    tree = spark.sparkContext.broadcast(build_tree(drawn, leaf, bits))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for number, at in place(tree.value, points, bits):
                shards = pa.array(np.full(len(at), number, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([shards, pa.array(points[at].view(np.int64))], names=["shard", "fingerprint"])

    def link(group: pa.Table) -> pa.Table:
        nodes, roots = local_links(group.column("fingerprint").to_numpy().view(np.uint64), bits)
        return pa.table({"u": nodes.view(np.int64), "v": roots.view(np.int64)})

    dealt = store(distinct.select("fingerprint").mapInArrow(deal, "shard int, fingerprint long"), "shards")
    return components(in_blocks(dealt, shard).groupBy("shard", "a", "b").applyInArrow(link, "u long, v long"))


def in_blocks(dealt: DataFrame, shard: int) -> DataFrame:
    """shard, a, b, fingerprint: the groups to search. Most shards are one group; the blocks
    of a large one meet in pairs."""
    large = dealt.groupBy("shard").count().filter(F.col("count") > SPLIT * shard)
    large = large.select("shard", F.ceil(F.col("count") / (SPLIT * shard // 2)).cast("int").alias("blocks"))
    cut = lookup_join(dealt, large, ["shard"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fingerprint", F.lit(SEED)), F.col("blocks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: (j != F.col("own")) | (F.col("blocks") == 1))
    pairs = F.transform(others, lambda j: F.struct(F.least("own", j).alias("a"), F.greatest("own", j).alias("b")))
    return cut.withColumn("own", own).select("shard", "fingerprint", F.inline(pairs))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = 2
) -> DataFrame:
    """``id_col``, fingerprint (16 hexadecimal digits) and component_id of every row.

    Documents whose fingerprints differ in at most ``bits`` bits are linked; component_id is
    the smallest id that links lead to, the document's own included. Equal fingerprints are
    one point of the search, however many documents share them, and each has a row in the
    result. Texts without words, null ones too, have the fingerprint zero and are linked
    like any other. Null ids are passed over where there are others. An empty table gives
    no rows. Columns other than the two named are not read.
    """
    rows = store(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    return rows.join(classes(rows, id_col, bits), "fingerprint").select(
        id_col, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def classes(rows: DataFrame, id_col: str, bits: int) -> DataFrame:
    """fingerprint, root and component_id: the group of each distinct fingerprint of ``rows``,
    by its least fingerprint and its smallest id. Stored."""
    distinct = store(rows.groupBy("fingerprint").agg(F.min(id_col).alias("first")), "distinct-fingerprints")
    linked = store(link_fingerprints(distinct, bits), "linked-fingerprints")
    linked = linked.select(F.col("node").alias("fingerprint"), "root")
    firsts = linked.join(distinct, "fingerprint").groupBy("root").agg(F.min("first").alias("least"))
    grouped = distinct.join(linked.join(firsts, "root"), "fingerprint", "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), F.coalesce("least", "first").alias("component_id")
    )
    return store(grouped, "fingerprint-classes")


def one_of_each_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = 2
) -> DataFrame:
    """The rows of ``docs`` that stay if one document of each group of near-duplicates does.

    That is the document with the group's smallest id; if several texts of the group have
    that id, the one of the least fingerprint. Of rows alike in id and fingerprint one
    stays, the first by text and then by the other columns. Rows without an id cannot be
    named and stay. Representatives are chosen on ids and fingerprints; a text is not moved
    where the table of them can be broadcast.
    """
    names, docs = docs.columns, docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    id_col, text_col = (docs.columns[names.index(c)] for c in (id_col, text_col))
    marked = store(fingerprints(docs, id_col, text_col, shingle, keep=docs.columns), "documents")
    named = marked.filter(F.col(id_col).isNotNull())
    known = classes(named.select(id_col, "fingerprint"), id_col, bits)
    counted = named.groupBy(id_col, "fingerprint").agg(F.count("*").alias("_rows"))
    # A group's smallest id may have several of its fingerprints; the least of them stands.
    firsts = counted.join(known.filter("component_id IS NOT NULL"), "fingerprint").filter(F.col(id_col) == F.col("component_id"))
    firsts = firsts.groupBy("root", id_col).agg(F.min(F.struct("fingerprint", "_rows")).alias("x")).select(id_col, "x.*")
    kept = lookup_join(named, store(firsts, "representatives"), [id_col, "fingerprint"])
    order = [text_col, *[c for c in docs.columns if c not in (id_col, text_col)]]
    place = F.row_number().over(Window.partitionBy(id_col, "fingerprint").orderBy(*order))
    once = kept.filter("_rows > 1").withColumn("_place", place).filter("_place = 1")
    rest = marked.filter(F.col(id_col).isNull())
    parts = [df.select(*docs.columns) for df in (kept.filter("_rows = 1"), once, rest)]
    return reduce(DataFrame.unionByName, parts).toDF(*names)
