from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from portolan.llm import simhash as S
from portolan.llm.components import components


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = low.encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(points, bits):
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(points):
        for b in points[:i]:
            if (a ^ b).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {p: find(p) for p in points}


@pytest.mark.parametrize("seed", range(20))
def test_fingerprint(seed):
    draw = random.Random(seed)
    text = "".join(draw.choices(["a", "B", "É", " ", "\n", "cat ", "dog ", "\xa0"], k=draw.randint(0, 80)))
    assert S.fingerprint(text) == plain_fingerprint(text)


def clusters(seed, centres, each):
    """Balls of fingerprints: chains and dense groups around some centres."""
    draw = random.Random(seed)
    points = set()
    for _ in range(centres):
        p = draw.getrandbits(64)
        for _ in range(draw.randint(1, each)):
            points.add(p)
            p ^= sum(1 << b for b in draw.sample(range(64), draw.randint(1, 4)))
    return sorted(points)


@pytest.mark.parametrize("seed", range(6))
def test_tree_brings_linked_points_together(seed):
    points = clusters(seed, 60, 12)
    tree = S.build_tree(np.array(points, dtype=np.uint64), 16, 2)
    shards = {n: {points[i] for i in at} for n, at in S.place(tree, np.array(points, dtype=np.uint64), 2)}
    assert len(shards) > 4
    for i, a in enumerate(points):
        for b in points[:i]:
            if (a ^ b).bit_count() <= 2:
                assert any(a in s and b in s for s in shards.values())


def test_local_links():
    points = clusters(9, 80, 20)
    nodes, roots = S.local_links(np.array(points, dtype=np.uint64), 2)
    got = dict(zip(nodes.tolist(), roots.tolist()))
    want = plain_roots(points, 2)
    alone = {p for p in points if sum(r == want[p] for r in want.values()) == 1}
    assert got == {p: r for p, r in want.items() if p not in alone}


def test_links_of_a_table(spark):
    points = clusters(11, 150, 25)
    signed = np.array(points, dtype=np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(p,) for p in signed], "fingerprint long").repartition(4)
    got = {r["node"]: r["root"] for r in S.link_fingerprints(table, 2, sample=400, shard=60).collect()}
    groups = {}
    for p, r in plain_roots(points, 2).items():
        groups.setdefault(r, set()).add(p)
    back = dict(zip(signed, points))
    found = {}
    for n, r in got.items():
        found.setdefault(r, set()).add(back[n])
    assert sorted(map(sorted, found.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(5, 5), (7, 8)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in range(7, 60)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_documents(spark, documents):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(9, base), (4, base.upper()), (6, base + " tail"), (2, None), (3, ""), (8, " \n"), (1, "one two"), (1, "one two"), (5, "long " * 60000), (None, base)]
    found = S.near_duplicates(documents(rows)).collect()
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in found}
    prints = {i: plain_fingerprint(t or "") for i, t in rows}
    roots = plain_roots(sorted(set(prints.values())), 2)
    least = {}
    for i, p in prints.items():
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    assert got == {(i, f"{p:016x}", least[roots[p]]) for i, p in prints.items()}
    assert len(found) == len(rows)
    assert S.near_duplicates(documents([])).count() == 0


def test_type_of_ids_is_kept(spark):
    docs = spark.createDataFrame([("b", "x y z"), ("a", "x y z")], T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("text", T.StringType())]))
    assert {r["component_id"] for r in S.near_duplicates(docs).collect()} == {"a"}


def ball(seed, n):
    """Fingerprints within four bits of one, which no vantage point tells apart well."""
    r = random.Random(seed)
    points = set()
    while len(points) < n:
        p = 0x0123456789ABCDEF
        for bit in r.sample(range(64), r.randint(0, 4)):
            p ^= 1 << bit
        points.add(p)
    return sorted(points)


def test_a_ball_of_a_third_of_all_fingerprints(spark):
    points = sorted(set(ball(1, 500)) | set(clusters(2, 300, 20)))
    signed = np.array(points, dtype=np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(p,) for p in signed], "fingerprint long").repartition(4)
    got = {r["node"]: r["root"] for r in S.link_fingerprints(table, 2, sample=2000, shard=12).collect()}
    back, want, groups, found = dict(zip(signed, points)), plain_roots(points, 2), {}, {}
    for p, r in want.items():
        groups.setdefault(r, set()).add(p)
    for n, r in got.items():
        found.setdefault(r, set()).add(back[n])
    assert sorted(map(sorted, found.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_large_shards_are_cut(spark):
    dealt = spark.createDataFrame([(0, i) for i in range(2000)] + [(1, i) for i in range(50)], "shard int, fingerprint long")
    cut = S.in_blocks(dealt, 40).collect()
    groups = {}
    for r in cut:
        groups.setdefault((r["shard"], r["a"], r["b"]), set()).add(r["fingerprint"])
    assert max(map(len, groups.values())) < 40 * S.SPLIT * 1.5 and groups[1, 0, 0] == set(range(50))
    members = [g for (s, _, _), g in groups.items() if s == 0]
    assert all(any(a in g and b in g for g in members) for a in range(0, 2000, 211) for b in range(0, 2000, 97))


def test_one_of_each_group(spark, documents):
    text = {k: " ".join(f"{k}{i}" for i in range(80)) for k in "abc"}
    rows = [
        (3, text["a"]), (5, text["a"]), (5, text["b"]), (7, text["b"]), (5, text["b"]),  # 5 is a copy of 3, and first of its own
        (3, text["c"]), (9, text["c"]), (None, text["a"]), (None, text["a"]), (None, None), (2, None), (4, ""), (11, "one two"),
    ]
    docs = documents(rows)
    kept = sorted(((r["doc_id"], r["text"]) for r in S.one_of_each_group(docs).collect()), key=repr)
    want = [(3, text["a"]), (5, text["b"]), (3, text["c"]), (None, text["a"]), (None, text["a"]), (None, None), (2, None), (11, "one two")]
    assert kept == sorted(want, key=repr) and S.one_of_each_group(docs).columns == docs.columns
    assert S.one_of_each_group(documents([])).count() == 0
    many = documents([(1, text["a"])] * 300 + [(None, text["b"])] * 300)
    assert S.one_of_each_group(many).count() == 301
