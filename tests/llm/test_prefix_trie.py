from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from portolan.llm import prefix_trie as P

SCHEMA = "conv_id long, turn int, role string, text string, conv string, p string, name string, chars string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def in_order(rows):
    """Each conversation's (role, text) in order."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append(((turn is not None, turn or 0), digest(role, text), role, text))
    return {c: [(r, t) for _, _, r, t in sorted(s)] for c, s in own.items()}


def rebuilt(own, group=100, most=6):
    out = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - (abs(c) % group) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + s[h:]
    return out


def brute(sequences):
    members, ends, children = {}, {}, {}
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
        ends.setdefault(tuple(s), []).append(c)
    for node in members:
        if node:
            children.setdefault(node[:-1], set()).add(node)
    out = []
    for node, own in members.items():
        leaves = saved = 0
        for w, convs in members.items():
            if w[: len(node)] == node:
                leaves += w not in children
                saved += (len(convs) - 1) * len(w[-1][1]) if w else 0
        line = ",".join(map(str, sorted(ends.get(node, []))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(own), len(node), parent, len(own), len(children.get(node, ())), leaves, saved, hashlib.sha256(line.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=repr)


def talks(seed, n, longest, words="abc"):
    r = random.Random(seed)
    return [(c, i, r.choice(["user", "bot"]), r.choice(words) * r.randint(1, 2)) for c in range(n) for i in range(r.randint(1, longest))]


def test_small_tries(spark):
    rows = talks(1, 120, 7, "ab")
    assert found(P.prefix_trie(P.conversation_turns(table(spark, rows)))) == brute(in_order(rows))


def test_shared_beginnings(spark):
    rows = talks(2, 230, 9) + [(c, t, "u", "x") for c in (-5, -100, *range(1005, 1020)) for t in range(2)]
    turns = P.with_shared_beginnings(P.conversation_turns(table(spark, rows)))
    want = rebuilt(in_order(rows))
    assert any(not s for s in want.values())  # one without turns is a member of the root
    assert found(P.prefix_trie(turns)) == brute(want)


@pytest.mark.parametrize("span", [2, 4])
def test_chunks_of_any_size(spark, monkeypatch, span):
    """Conversations many times as long as a chunk, up to several levels of chunks."""
    monkeypatch.setattr(P, "SPAN", span)
    monkeypatch.setattr(P, "HALVES", [1 << k for k in range(span.bit_length() - 1)])
    r = random.Random(span)
    trunk = [("user", r.choice("abc")) for _ in range(40)]
    rows = []
    for c in range(30):
        keep = r.randint(0, 40)
        own = trunk[:keep] + [("bot", r.choice("ab")) for _ in range(r.randint(0, 6))]
        rows += [(c, i, role, text) for i, (role, text) in enumerate(own or trunk[:1])]
    assert found(P.prefix_trie(P.conversation_turns(table(spark, rows)))) == brute(in_order(rows))


def test_a_conversation_of_a_third_of_all_turns(spark):
    rows = talks(3, 40, 6) + [(7, 100 + i, "user", "ab"[i % 2]) for i in range(130)] + [(8, 100 + i, "user", "ab"[i % 2]) for i in range(70)]
    assert found(P.prefix_trie(P.conversation_turns(table(spark, rows)))) == brute(in_order(rows))


def test_hot_conversation_and_first_turn(spark):
    rows = [(c, t, "user", "same" + "!" * t) for c in range(300) for t in range(2)]
    rows += [(1000 + c, t, "user", "same" if not t else f"own {c} {t}") for c in range(200) for t in range(3)]
    assert found(P.prefix_trie(P.conversation_turns(table(spark, rows)))) == brute(in_order(rows))


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [
        (1, None, None, "x"), (1, 0, "user", None), (1, 0, "user", None), (1, 0, "bot", "y"), (2, None, "", "x"), (2, 0, None, ""),
        (None, 0, "user", "lost"), (None, None, None, None), (3, 5, "a", "b:c"), (4, 5, "a:b", "c"), (5, 9, "é", "中文😀" * 50000), (6, 1, "é", "中文😀" * 50000),
        (7, 1, "", ""), (8, 1, None, None),
    ]
    rows += rows[:3]
    assert found(P.prefix_trie(P.conversation_turns(table(spark, rows)))) == brute(in_order(rows))


def test_empty_table(spark):
    turns = P.conversation_turns(table(spark, []))
    assert found(P.prefix_trie(turns)) == [] == found(P.prefix_trie(P.with_shared_beginnings(turns)))
    only = P.Turns(turns.steps, spark.createDataFrame([(4, 0), (2, 0)], "conv long, n long"))
    assert found(P.prefix_trie(only)) == brute({2: [], 4: []})


def test_end_lines_over_many_batches(spark):
    """A node at which very many conversations end: its line is pieced together in order."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        ends = spark.range(5000).select(F.when(F.col("id") % 3 == 0, b"h").otherwise(F.encode(F.col("id").cast("string"), "utf-8")).alias("name"), F.col("id").alias("conv"))
        got = {bytes(r["name"]): r["ends_sha256"] for r in P._joined_digests(ends.repartition(7)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    line = ",".join(str(i) for i in range(0, 5000, 3))
    assert got[b"h"] == hashlib.sha256(line.encode()).hexdigest() and len(got) == 5000 - 1667 + 1
    assert got[b"7"] == hashlib.sha256(b"7").hexdigest()
