from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from portolan.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if often[g] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("seed", range(40))
def test_measures_equal_plain_python(seed):
    draw = random.Random(seed)
    alphabet = ["a", "b", "a b a b a b a b a b", "é", "\x1c", " ", " ", "#", "|", "\n", "\t", " ", "A", "!", "\U0001f600", "İ"]
    text = "".join(draw.choices(alphabet, k=draw.randint(0, 120)))
    assert Q.measure(text)[:5] == plain(text)


def test_votes_are_learned_without_labels():
    draw = np.random.default_rng(1)
    good = draw.random(4000) < 0.8
    wrong = draw.random((4000, 5)) < np.where(good[:, None], 0.03, 0.3)
    votes = np.where(good[:, None] ^ wrong, 1, -1) * (draw.random((4000, 5)) < 0.8)
    patterns, back, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, about = Q.fit_votes(patterns, counts.astype(float))
    assert ((posterior[back] >= 0.5) == good).mean() > 0.93
    assert abs(about["good"] - 0.8) < 0.05


def test_edges(documents):
    clean = " ".join(f"word{i}," if i % 9 else f"end{i}." for i in range(60))
    rows = [(1, None), (2, ""), (3, clean), (3, clean), (4, "a b c d e f g h " * 20), (5, clean * 2000), (None, clean)]
    found = Q.weak_supervision(documents(rows)).collect()
    assert sorted((0 if r["doc_id"] is None else r["doc_id"], r["base_failed"]) for r in found) == [
        (0, False), (1, True), (2, True), (3, False), (3, False), (4, True), (5, True)]
    assert all(not r["kept"] for r in found if r["base_failed"])
    assert len({r["quality"] for r in found if r["doc_id"] == 3}) == 1
    assert Q.weak_supervision(documents([])).count() == 0


def test_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").withColumnRenamed("quality", "good")
    judged = Q.weak_supervision(spark.read.parquet(f"{folder}/documents.parquet")).join(labels, "doc_id").filter("NOT base_failed")
    wrong = judged.filter("kept <> (good = 1)").count()
    assert wrong <= 0.02 * judged.count()


def plain_em(votes, rounds=100):
    """Expectation maximisation document by document, in plain Python."""
    from math import exp, log

    rules, extra = len(votes[0]), Q.PRIOR_SHARE * len(votes)
    on_good, on_bad, good = [Q.START_RIGHT_GOOD] * rules, [Q.START_RIGHT_BAD] * rules, Q.START_GOOD
    for _ in range(rounds):
        posterior = []
        for own in votes:
            a, b = log(good), log(1 - good)
            for v, g, w in zip(own, on_good, on_bad):
                if v > 0:
                    a, b = a + log(g), b + log(1 - w)
                elif v < 0:
                    a, b = a + log(1 - g), b + log(w)
            posterior.append(1 / (1 + exp(max(-700, min(700, b - a)))))
        good = (sum(posterior) + extra * Q.START_GOOD) / (len(votes) + extra)
        for j in range(rules):
            cast = [(p, own[j]) for p, own in zip(posterior, votes) if own[j]]
            g = (sum(p for p, v in cast if v > 0) + extra * Q.START_RIGHT_GOOD) / (sum(p for p, _ in cast) + extra)
            w = (sum(1 - p for p, v in cast if v < 0) + extra * Q.START_RIGHT_BAD) / (sum(1 - p for p, _ in cast) + extra)
            on_good[j], on_bad[j] = min(1 - 1e-4, max(0.5, g)), min(1 - 1e-3, max(1e-3, w))
    return posterior


def test_posterior_and_verdict_against_plain_em(spark):
    found = Q.weak_supervision(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).orderBy("doc_id").collect()
    want = plain_em([r["votes"] for r in found])
    assert len({tuple(r["votes"]) for r in found}) > 5
    for r, q in zip(found, want):
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert abs(r["quality"] - q) < 1e-9 and r["base_failed"] == failed and r["kept"] == (not failed and q >= 0.5)
