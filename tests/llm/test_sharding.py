from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from portolan.llm import sharding as S


def smallest_largest(sizes, shards):
    def fits(c):
        n, held = 1, 0
        for x in sizes:
            if x > c:
                return False
            if held + x > c:
                n, held = n + 1, 0
            held += x
        return n <= shards

    low, high = 0, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


def check(docs, rows, shards):
    found = S.shard_documents(docs, shards).collect()
    groups, where, slots, held = {}, {}, {}, {}
    for _, t in rows:
        key = hashlib.sha256((t or "").encode()).hexdigest()
        groups[key] = groups.get(key, 0) + len((t or "").encode()) + 1
    for r in found:
        text = next(t or "" for i, t in rows if i == r["doc_id"])
        assert r["size"] == len(text.encode()) + 1 and r["text_crc32"] == zlib.crc32(text.encode())
        where.setdefault(text, set()).add(r["shard"])
        slots.setdefault(r["shard"], []).append(r["slot"])
        held[r["shard"]] = held.get(r["shard"], 0) + r["size"]
    assert len(found) == len(rows) and all(len(s) == 1 for s in where.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(0 <= s < shards for s in held)
    assert max(held.values()) == smallest_largest([groups[k] for k in sorted(groups)], shards)
    return held


@pytest.mark.parametrize("seed, shards", [(1, 8), (2, 3), (3, 8)])
def test_largest_shard_is_minimal(documents, seed, shards):
    draw = random.Random(seed)
    pool = ["w" * draw.randint(0, 400) + str(i) for i in range(60 if seed == 3 else 400)]
    rows = [(i, draw.choice(pool)) for i in range(500)]
    check(documents(rows), rows, shards)


def test_hot_group_and_odd_texts(documents):
    rows = [(i, "hot text " * 10) for i in range(300)] + [(1000 + i, f"text {i} é") for i in range(300)] + [(5000, None), (5001, ""), (5002, "long " * 50000)]
    held = sorted(check(documents(rows), rows, 8).values())
    assert len(held) == 8 and held[-1] == 250001  # the long text alone
    assert held[0] < 1000 and held[-2] == 300 * 91  # the hot group alone; the others are even


def test_few_and_none(documents):
    assert len(check(documents([(1, "a"), (2, "b")]), [(1, "a"), (2, "b")], 8)) == 2
    assert S.shard_documents(documents([])).count() == 0
    same = S.shard_documents(documents([(7, "x"), (7, "x"), (None, "x")])).collect()
    assert len({r["shard"] for r in same}) == 1 and sorted(r["slot"] for r in same) == [0, 1, 2]


def test_opened_buckets_meet_the_optimum(spark, monkeypatch):
    monkeypatch.setattr(S, "DIGITS", 1)
    draw = random.Random(6)
    groups = [(f"{draw.getrandbits(40):010x}", draw.choice([1, 5, 900, 40])) for _ in range(300)]
    table = spark.createDataFrame(groups, "_group string, _size long").cache()
    starts = S.cut_keys(table, 5)
    shard = lambda g: sum(k is not None and g >= k for k in starts)
    held = [sum(n for g, n in groups if shard(g) == s) for s in range(5)]
    assert max(held) == smallest_largest([n for _, n in sorted(groups)], 5)
