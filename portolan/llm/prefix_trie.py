"""The trie of conversations' beginnings, built by halving depths as van Emde Boas does."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.operators.keys import dense_surrogate_key
from portolan.operators.lookup import lookup_join
from portolan.sources.scratch import store

# Depths that one row spans, a power of two, and the halves at which it is cut.
SPAN = 64
HALVES = [1 << k for k in range(SPAN.bit_length() - 1)]
ROOT = bytes(16)
EMPTY_SHA256 = hashlib.sha256().hexdigest()


@dataclass(frozen=True)
class Turns:
    """steps (conv, p from 0, token, chars), and sizes (conv, n): all conversations' lengths."""

    steps: DataFrame
    sizes: DataFrame


def _digest(*parts: Column) -> Column:
    """A name for a sequence of parts: 128 bits of SHA-256, taken as equal only for equals."""
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def conversation_turns(
    docs: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> Turns:
    """The turns of every conversation in order.

    Null turns come first; turns that tie are ordered by the digest of role and text, and
    repeated rows are turns each. Null roles and texts are empty; rows without an id belong
    to no conversation. The order is one global sort, so a conversation with a large share
    of all turns lies in many tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        _digest(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("token"),
        F.char_length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("again"),
    )
    numbered = dense_surrogate_key(rows, ["conv", "turn", "token", "again"], "n").select("conv", "token", "chars", "n")
    firsts = store(numbered.groupBy("conv").agg(F.min("n").alias("first"), F.count("*").alias("size")), "first-turns")
    placed = lookup_join(numbered, firsts.select("conv", "first"), ["conv"])
    steps = placed.select("conv", (F.col("n") - F.col("first")).cast("long").alias("p"), "token", "chars")
    return Turns(store(steps, "turns"), firsts.select("conv", F.col("size").alias("n")))


def with_shared_beginnings(turns: Turns, group: int = 100, most: int = 6) -> Turns:
    """Every conversation c with its first h turns taken from conversation c - c % ``group``.

    h is crc32(c in decimal) % ``most``; c keeps its own turns after its first h. Of a
    shorter or missing conversation come as many turns as there are.
    """
    drawn = turns.sizes.select(
        "conv", "n", F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(most)).cast("long").alias("h"),
        (F.col("conv") - F.col("conv") % group).alias("base"),
    )
    bases = turns.sizes.select(F.col("conv").alias("base"), F.col("n").alias("of"))
    drawn = drawn.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("of", F.lit(0))))
    drawn = store(drawn.select("conv", "n", "h", "base", "taken"), "beginnings")
    heads = turns.steps.filter(F.col("p") < most).withColumnRenamed("conv", "base")
    begun = drawn.join(heads, "base").filter("p < h").select("conv", "p", "token", "chars")
    own = lookup_join(turns.steps, drawn.select("conv", "h", "taken"), ["conv"]).filter("p >= h")
    own = own.select("conv", (F.col("p") - F.col("h") + F.col("taken")).alias("p"), "token", "chars")
    sizes = drawn.select("conv", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))
    return Turns(store(begun.unionByName(own), "turns"), sizes)


def _cut(i: Column, half: Column) -> Column:
    """The last place of the upper half of the block of 2 * ``half`` places that holds i."""
    return (i - F.pmod(i, 2 * half) + half - 1).cast("int")


def _halved(tokens: str) -> Column:
    """The name of each beginning of an array of tokens.

    Blocks of 2, 4, ... places are cut in half: the upper half's names stand, its last one
    names the cut, and the lower half's names are put under it; all blocks at once.
    """
    def graft(names: Column, half: Column) -> Column:
        return F.transform(
            names, lambda x, i: F.when(F.pmod(i, 2 * half) >= half, _digest(F.get(names, _cut(i, half)), x)).otherwise(x)
        )

    return F.aggregate(F.lit(HALVES), F.col(tokens), graft)


def _chunks(steps: DataFrame, longest: int) -> list[DataFrame]:
    """conv, q, root and names (and chars) of each SPAN places, from the leaves' level up.

    Sequences longer than SPAN are cut there: what a whole chunk holds is one token of a
    sequence of chunks, which is named in the same way; its names are the roots of the
    chunks below, and of its own places the last.
    """
    listed = F.array_sort(F.collect_list(F.struct("p", "token", "chars")))
    chunks = (
        steps.groupBy("conv", F.floor(F.col("p") / SPAN).cast("long").alias("q")).agg(listed.alias("s"))
        .select("conv", "q", F.col("s.token").alias("tokens"), F.col("s.chars").alias("chars"))
        .select("conv", "q", "chars", _halved("tokens").alias("names"))
    )
    if longest <= SPAN:
        return [store(chunks.withColumn("root", F.lit(ROOT)), "chunks")]
    chunks = store(chunks, "chunk-names")
    whole = chunks.filter(F.size("names") == SPAN)
    above = _chunks(whole.select("conv", F.col("q").alias("p"), F.element_at("names", -1).alias("token"), F.lit(0).cast("long").alias("chars")), longest // SPAN)
    named = above[0].select("conv", "q", F.posexplode("names").alias("i", "name"))
    place = F.col("q") * SPAN + F.col("i")
    roots = named.select("conv", (place + 1).alias("q"), F.col("name").alias("root"))
    lasts = named.select("conv", place.alias("q"), F.col("name").alias("last"))
    joined = chunks.join(roots, ["conv", "q"], "left").join(lasts, ["conv", "q"], "left")
    under = F.when(F.col("root").isNull(), F.col("names")).otherwise(F.transform("names", lambda x: _digest(F.col("root"), x)))
    joined = joined.withColumn("names", under)
    names = F.when(F.col("last").isNull(), F.col("names")).otherwise(F.concat(F.slice("names", 1, SPAN - 1), F.array("last")))
    done = joined.select("conv", "q", "chars", names.alias("names"), F.coalesce("root", F.lit(ROOT)).alias("root"))
    return [store(done, "chunks"), *above]


def _summed(df: DataFrame) -> DataFrame:
    return df.groupBy("name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _totals(levels: list[DataFrame], nodes: DataFrame) -> DataFrame:
    """name, leaves and saved summed over each node's subtree, itself included.

    ``nodes`` has name, rep (a conversation that holds it), p, leaves and saved. Two nodes,
    one above the other, are parted by just one cut: at each cut the lower half's weights
    are summed under the cut's node, and that sum is grafted on the nodes of the upper half
    above it. The cuts of a chunk are all done at once; what lies in chunks further down
    comes first, as the weight of a chunk's last nodes, by the same sums over chunks.
    """
    chunks, *above = levels
    lines = chunks.select(F.col("conv").alias("rep"), "q", "root", "names")
    nodes = nodes.withColumn("q", F.floor(F.col("p") / SPAN).cast("long")).withColumn("i", F.pmod("p", F.lit(SPAN)).cast("int"))
    if above:
        rooted = nodes.filter(F.col("q") > 0).join(lines.select("rep", "q", "root"), ["rep", "q"])
        forests = _summed(rooted.select(F.col("root").alias("name"), "leaves", "saved"))
        lasts = nodes.filter(F.col("i") == SPAN - 1).select("name", "rep", F.col("q").alias("p")).join(forests, "name")
        beneath = _totals(above, store(lasts, "forests"))
        nodes = store(
            nodes.join(beneath.select("name", F.col("leaves").alias("l"), F.col("saved").alias("s")), "name", "left").select(
                "name", "rep", "p", "q", "i", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
            ),
            "weighted",
        )
    lines = lines.drop("root")

    def along(weights: DataFrame, places) -> DataFrame:
        """Weights spread over the places that ``places(i)`` gives on the node's own line."""
        held = weights.groupBy("rep", "q").agg(F.collect_list(F.struct("i", "leaves", "saved")).alias("held"))
        spread = F.flatten(F.transform("held", lambda x: F.transform(
            places(x["i"]), lambda at: F.struct(F.get("names", at).alias("name"), x["leaves"].alias("leaves"), x["saved"].alias("saved"))
        )))
        return _summed(held.join(lines, ["rep", "q"]).select(F.inline(spread)))

    def cuts_above(i: Column) -> Column:
        return F.transform(F.filter(F.lit(HALVES), lambda half: F.pmod(i, 2 * half) >= half), lambda half: _cut(i, half))

    def upper_half(i: Column) -> Column:
        return F.sequence(i - (i + 1).bitwiseAND(-(i + 1)) + 1, i)  # the place after a cut has the half as its lowest bit

    cuts = along(nodes, cuts_above).join(nodes.select("name", "rep", "q", "i"), "name")
    grafts = along(cuts, upper_half)
    return _summed(nodes.select("name", "leaves", "saved").unionByName(grafts))


def _joined_digests(ends: DataFrame) -> DataFrame:
    """name and the SHA-256 of the ascending, comma-joined conversations that end there.

    One global sort by name and conversation; runs become lines of text where they lie, so
    that a name with very many conversations reaches the task that hashes it in few rows.
    """
    in_order = ends.orderBy("name", "conv")

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, convs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            starts = [i for i in range(len(names)) if not i or names[i] != names[i - 1]]
            texts = [",".join(map(str, convs[a:b])) for a, b in zip(starts, [*starts[1:], len(names)])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in starts], pa.binary()), pa.array([convs[i] for i in starts], pa.int64()), pa.array(texts, pa.string())],
                names=["name", "first", "line"],
            )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, hashed = None, None
        for batch in batches:
            done = []
            for n, line in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if n != name:
                    done += [(name, hashed.hexdigest())] if hashed else []
                    name, hashed = n, hashlib.sha256(line.encode())
                else:
                    hashed.update(b"," + line.encode())
            yield pa.RecordBatch.from_pydict({"name": pa.array([d[0] for d in done], pa.binary()), "ends_sha256": pa.array([d[1] for d in done], pa.string())})
        if hashed:
            yield pa.RecordBatch.from_pydict({"name": pa.array([name], pa.binary()), "ends_sha256": [hashed.hexdigest()]})

    pieces = store(in_order.mapInArrow(lines, "name binary, first long, line string"), "end-lines")
    return pieces.repartition("name").sortWithinPartitions("name", "first").mapInArrow(digests, "name binary, ends_sha256 string")


def prefix_trie(turns: Turns) -> DataFrame:
    """One row per distinct beginning of the conversations, the empty one (the root) included.

    conv_id (smallest member), depth, parent_conv_id, n_convs (members), n_children,
    n_leaves and saved_tokens (summed over the subtree, its top included), and ends_sha256
    of the conversations that end there. A leaf has no children; a node saves
    (n_convs - 1) * characters of its last text.

    Sequences are cut at half depth, and beginnings get names out of the names of their
    halves, at all depths in parallel; members, children and weights are grouped by name,
    and subtree totals are grafted upward over the same cuts. A row spans at most SPAN
    turns, and no step gathers a conversation, a node's members or its children in a task.
    Conversations without turns are members of the root; no conversations give no rows.
    """
    longest = turns.sizes.agg(F.max("n")).first()[0]
    levels = _chunks(turns.steps, longest or 0)
    at = F.transform(
        "names",
        lambda x, i: F.struct(
            x.alias("name"), F.when(i > 0, F.get("names", i - 1)).otherwise(F.col("root")).alias("parent"),
            (F.col("q") * SPAN + i).alias("p"), F.get("chars", i).alias("chars"),
        ),
    )
    nodes = store(
        levels[0].select("conv", F.inline(at)).groupBy("name", "parent", "p", "chars")
        .agg(F.count("*").alias("n_convs"), F.min("conv").alias("rep")),
        "nodes",
    )
    children = nodes.groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    n_children = F.coalesce("n_children", F.lit(0))
    weighted = store(
        nodes.join(children, "name", "left").select(
            "name", "parent", "p", "rep", "n_convs", n_children.alias("n_children"),
            (n_children == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        ),
        "nodes-weighted",
    )
    totals = _totals(levels, weighted.select("name", "rep", "p", "leaves", "saved"))

    last = turns.sizes.filter("n > 0").select("conv", F.floor((F.col("n") - 1) / SPAN).cast("long").alias("q"))
    ends = levels[0].join(last, ["conv", "q"]).select(F.element_at("names", -1).alias("name"), "conv")
    turnless = turns.sizes.filter("n = 0").select(F.lit(ROOT).alias("name"), "conv")
    digests = store(_joined_digests(store(ends.unionByName(turnless), "ends")), "end-digests")

    whole = turns.sizes.agg(F.min("conv").alias("rep"), F.count("*").alias("n_convs")).first()
    parents = weighted.select(F.col("name").alias("parent"), F.col("rep").alias("parent_conv_id"))
    known = lookup_join(weighted.drop("leaves", "saved"), parents, ["parent"], "left")
    rows = known.join(totals, "name").join(digests, "name", "left").select(
        F.col("rep").alias("conv_id"), (F.col("p") + 1).alias("depth"),
        F.when(F.col("p") == 0, F.lit(whole["rep"]).cast("long")).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
    if not whole["n_convs"]:
        return rows
    sums = weighted.agg(
        F.count_if(F.col("p") == 0).alias("n_children"), F.coalesce(F.sum("leaves"), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum("saved"), F.lit(0)).alias("saved_tokens"),
    )
    ended = digests.filter(F.col("name") == F.lit(ROOT)).agg(F.max("ends_sha256")).first()[0]
    top = sums.select(
        F.lit(whole["rep"]).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(whole["n_convs"]).cast("long").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
        F.lit(ended or EMPTY_SHA256).alias("ends_sha256"),
    )
    return rows.unionByName(top)
