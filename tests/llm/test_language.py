from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from portolan.llm import language as L


def test_held_out_rows_are_predicted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = L.detect_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.99
    assert all(0 <= r["score"] <= 1 for r in found)


def test_words_before_grams():
    tables = [{"the": 0}, {"<": 1, "q": 2}, {}, {"the": 3}, {}, {}]
    logs = np.log([[0.9, 0.1], [0.5, 0.5], [0.2, 0.8], [0.1, 0.9]])
    model = L.Model(["a", "b"], tables, logs)
    assert model.entries("the") == [0] and model.entries("them") == [3]  # unseen: its known 3-gram
    assert model.entries("q") == [1, 2] and model.entries("z") == [1] and L.Model(["a"], [{}] * 6, logs).entries("x") == []
    found = model.predict(["the the", "them", None, "9", "zq the"])
    assert [x[0] for x in found] == ["a", "b", "und", "und", "a"]
    assert np.allclose(model.vectors[model.seen["q"] if "q" in model.seen else model.seen["zq"]], (logs[1] + logs[2]) / 2)
    assert np.isclose(found[0][1], 0.9**2**0.5 / (0.9**2**0.5 + 0.1**2**0.5))


def test_edges(documents):
    english, french = "the cat and the dog are here ", "le chat et le chien sont ici "
    rows = [(i, (english, french)[i % 2] * 5, ("en", "fr")[i % 2]) for i in range(40)]
    odd = [(100, None, "en"), (101, "", "fr"), (102, "123 -- 45", "en"), (103, "Ωμέγα", None), (104, english * 3000, None), (None, french, "fr"), (105, french, None), (105, french, None)]
    found = {}
    for r in L.detect_languages(documents(rows + odd)).collect():
        found.setdefault(r["doc_id"], []).append(r)
    assert all(found[i][0]["lang_pred"] == ("en", "fr")[i % 2] for i in range(40))
    assert [found[i][0]["lang_pred"] for i in (100, 101, 102)] == ["und"] * 3
    assert found[103][0]["lang_pred"] in ("en", "fr") and found[104][0]["lang_pred"] == "en"
    assert len(found[105]) == 2 and found[105][0]["score"] == found[105][1]["score"] and not found[None][0]["held_out"]
    assert L.detect_languages(documents([])).count() == 0
    unlabelled = L.detect_languages(documents([(1, english)])).first()
    assert (unlabelled["lang_pred"], unlabelled["score"]) == ("und", 0.0)


def plain_model(rows, languages, each):
    """The tables and logs in plain Python, from (text, lang)."""
    counts = Counter()
    for text, lang in rows:
        for w in L.words_of(text):
            counts[0, lang, w] += 1
            for size in range(1, L.LONGEST_GRAM + 1):
                for g in L.grams_of(w, size):
                    counts[size, lang, g] += 1
    tables, logs = [{} for _ in range(L.LONGEST_GRAM + 1)], []
    for size, table in enumerate(tables):
        total = Counter()
        for (s, _, item), n in counts.items():
            if s == size:
                total[item] += n
        chosen = set()
        for lang in languages:
            own = sorted((-n, item) for (s, l, item), n in counts.items() if (s, l) == (size, lang) and (size or total[item] > 1))
            chosen |= {item for _, item in own[:each]}
        per = {lang: sum(n for (s, l, _), n in counts.items() if (s, l) == (size, lang)) for lang in languages}
        for item in sorted(chosen):
            table[item] = len(logs)
            logs.append([np.log((counts[size, lang, item] + L.SMOOTHING) / (per[lang] + L.SMOOTHING * each * len(languages))) for lang in languages])
    return L.Model(languages, tables, np.array(logs))


def test_fit_against_plain_counts(spark, documents, monkeypatch):
    monkeypatch.setattr(L, "MOST_ENTRIES", 90)
    monkeypatch.setattr(L, "LEAST_ENTRIES", 5)
    r = random.Random(3)
    vocabulary = {lang: ["".join(r.choice(letters) for _ in range(r.randint(1, 7))) for _ in range(30)] for lang, letters in (("a", "abcde"), ("b", "cdefg"), ("c", "xyzé"))}
    rows = [(i, " ".join(r.choice(vocabulary[lang]) for _ in range(25)), lang) for i in range(90) for lang in [r.choice("abc")]]
    docs = documents(rows)
    got = L.fit(docs, F.lit(True))
    want = plain_model([(t, lang) for _, t, lang in rows], ["a", "b", "c"], 30)
    assert got.languages == want.languages and [set(t) for t in got.tables] == [set(t) for t in want.tables]
    for mine, plain in zip(got.tables, want.tables):
        for item in mine:
            assert np.allclose(got.logs[mine[item]], want.logs[plain[item]], atol=1e-4)
    texts = [t for _, t, _ in rows[:20]] + ["abc xyz new", "", "éé cc"]
    for a, b in zip(got.predict(texts), want.predict(texts)):
        assert a[0] == b[0] and abs(a[1] - b[1]) < 1e-3


def test_three_hundred_languages(spark, documents):
    """Each is learned and predicted, the rarest too, from a few words of its own."""
    r = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzéàüñøß"
    vocabulary = {f"l{k:03}": ["".join(r.choice(letters) for _ in range(r.randint(3, 7))) for _ in range(12)] for k in range(300)}
    rows, number = [], 0
    for k, (lang, words) in enumerate(vocabulary.items()):
        for _ in range(40 if k < 20 else 4):
            number += 1
            rows.append((number, " ".join(r.choice(words) for _ in range(30)), lang))
    model = L.fit(documents(rows), F.lit(True))
    assert len(model.languages) == 300
    found = model.predict([" ".join(r.choice(words) for _ in range(15)) for words in vocabulary.values()])
    assert np.mean([f[0] == lang for f, lang in zip(found, vocabulary)]) > 0.95


def test_no_table_is_empty_where_all_counts_are_equal(spark):
    counts = spark.createDataFrame([(1, "a", f"g{i}", 2) for i in range(50)] + [(1, "b", "g1", 9)], "size int, lang string, item string, n long")
    assert {r["item"] for r in L.most_frequent(counts, 3).collect()} == {"g0", "g1", "g10"}
