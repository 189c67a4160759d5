from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from portolan.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, id string, block string, score string, `rank` string"


def mine(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)
    return H.hard_negatives(df, F.col("vec_id") % 10 == 0, F.col("label"), **options)


def brute(rows, positives=5, negatives=5):
    usable = [r for r in rows if None not in r and all(x is not None and math.isfinite(x) for x in r[1])]
    one = {}
    for r in usable:
        if r[0] not in one or (r[2], r[1]) < (one[r[0]][2], one[r[0]][1]):
            one[r[0]] = r
    whole = {i: [math.floor(Fraction(x) * 256) for x in r[1]] for i, r in one.items()}
    most = 2**63 - 1
    out = []
    for a in one:
        if a % 10:
            continue
        scored = sorted(
            (-max(-most, min(most, sum(x * y for x, y in zip(whole[a], whole[b])))), b)
            for b in one if b != a and len(whole[b]) == len(whole[a])
        )
        for p, b in [x for x in scored if one[x[1]][2] == one[a][2]][:positives]:
            fits = [(n, c) for n, c in scored if one[c][2] != one[a][2] and 80 * -p <= 100 * -n <= 100 * -p]
            out += [(a, b, k, c, -p, -n) for k, (n, c) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def vectors(n, dims, seed, spread=1.0):
    r = random.Random(seed)
    return [(i, [round(r.gauss(0, spread), 2) for _ in range(dims)], r.randrange(3)) for i in range(n)]


def test_against_brute_force(spark):
    rows = vectors(240, 4, 1)
    assert sorted(map(tuple, mine(spark, rows).collect())) == brute(rows) != []


def test_ties_between_positives_and_negatives(spark):
    """Few distinct scores: equal positives and negatives, smaller ids first on both sides."""
    r = random.Random(2)
    rows = [(i, [float(r.randrange(2)), 1.0], r.randrange(2)) for i in range(90)]
    assert sorted(map(tuple, mine(spark, rows).collect())) == brute(rows) != []


def test_hot_label_and_copies_of_one_vector(spark):
    rows = vectors(150, 3, 3) + [(i, [0.5, 0.5, 0.5], 1) for i in range(150, 400)]
    assert sorted(map(tuple, mine(spark, rows).collect())) == brute(rows) != []


def test_unusable_repeated_and_uneven_rows(spark):
    rows = vectors(80, 3, 4)
    rows += rows[:40]  # repeated
    rows += [(7, [9.0, 9.0, 9.0], 2), (10, [0.1, 0.1, 0.1], 0)]  # ids that name other rows too
    rows += [(None, [1.0, 1.0, 1.0], 1), (500, None, 1), (510, [1.0, None, 1.0], 1), (520, [1.0, float("nan"), 0.0], 1),
             (530, [1.0, float("inf"), 0.0], 1), (540, [1.0, 1.0, 1.0], None)]
    rows += [(600, [1.0], 1), (601, [2.0], 1), (602, [1.5], 0), (610, [], 1), (611, [], 1), (612, [], 2)]
    rows += [(-20, [1.0, 0.5, 1.0], 1), (-21, [1.0, 1.0, 1.0], 0)]
    assert sorted(map(tuple, mine(spark, rows).collect())) == brute(rows) != []


def test_scores_beyond_doubles_and_longs(spark):
    rows = vectors(60, 2, 5) + [(100, [1e12, 1.0], 0), (101, [3e12, 2.0], 0), (102, [2.9e12, 1.5], 1), (103, [1e300, 1.0], 1), (104, [1e308, 0.0], 0)]
    assert sorted(map(tuple, mine(spark, rows).collect())) == brute(rows) != []


def test_empty_and_lonely(spark):
    found = mine(spark, [])
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert found.count() == 0
    assert mine(spark, [(10, [1.0], 1), (11, [1.0], 2)]).count() == 0
    with pytest.raises(ValueError):
        mine(spark, [], high=110)


def test_many_cells_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 16)
    monkeypatch.setattr(H, "ANCHORS", 4)
    rows = vectors(300, 4, 6)
    assert sorted(map(tuple, mine(spark, rows).collect())) == brute(rows)


def test_keys_sort_as_their_parts():
    r = random.Random(8)
    parts = [(r.choice([-3, 0, 5]), r.choice([-(2**63) + 1, -1, 0, 7]), r.random() < 0.5, r.choice([-9, 2, 2**62])) for _ in range(300)]
    assert [H.unpack_key(H.pack_key(*p)) for p in parts] == parts
    assert sorted(parts, key=lambda p: H.pack_key(*p)) == sorted(parts, key=lambda p: (p[0], -p[1], p[2], p[3]))
