from __future__ import annotations

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

from portolan.llm import suffix_dedup as S

LAST = S._LAST_ID


def brute(rows, least):
    """(id, spans, kept) of each row, by a table of all windows."""
    least_id = {}
    texts = [(LAST if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for s in range(len(t) - least + 1):
            w = t[s : s + least]
            least_id[w] = min(least_id.get(w, LAST), i)
    out = []
    for (name, _), (i, t) in zip(rows, texts):
        gone = np.zeros(len(t) + 2, dtype=bool)
        for s in range(len(t) - least + 1):
            if least_id[t[s : s + least]] < i:
                gone[s + 1 : s + 1 + least] = True
        edges = np.flatnonzero(gone[1:] != gone[:-1]).tolist()
        spans = list(zip(edges[::2], edges[1::2]))
        out.append((name, len(t), spans, bytes(b for b, g in zip(t, gone[1:]) if not g)))
    return sorted(out, key=repr)


def found(df, id_col="doc_id"):
    return sorted(((r[id_col], r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in df.collect()), key=repr)


def prose(seed, n, words=400):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghijé") for _ in range(r.randint(2, 8))) for _ in range(words)]
    return " ".join(r.choice(vocabulary) for _ in range(n))


def corpus(seed=1, docs=40):
    r = random.Random(seed)
    shared = [prose(100 + k, 30) for k in range(3)]
    rows = []
    for i in range(docs):
        text = prose(seed * 1000 + i, r.randint(1, 120))
        if r.random() < 0.6:
            passage = r.choice(shared)
            a, b = sorted(r.sample(range(len(passage)), 2))
            at = r.randrange(len(text))
            text = text[:at] + passage[a:b] + text[at:]
        if r.random() < 0.2 and rows:
            text = r.choice(rows)[1]
        if r.random() < 0.2 and rows:
            other = r.choice(rows)[1]
            text = other[:200] + "!" + other[201:]
        rows.append((i * 7 % docs, text))
    return rows


@pytest.mark.parametrize("least", [16, 50])
def test_against_all_windows(spark, documents, least):
    rows = corpus()
    assert found(S.remove_repeats(documents(rows), least)) == brute(rows, least)


def test_nulls_repeats_ties_and_long_texts(spark, documents):
    passage = prose(5, 40)
    rows = corpus(2, 20) + [(None, passage), (None, passage), (None, "x" + passage), (3, passage), (3, passage + " and"), (50, passage)]
    rows += [(60, None), (61, ""), (62, "short"), (63, "short"), (64, passage[:49]), (65, passage[:50]), (66, passage[:51])]
    rows += [(70, "a" * 3000), (71, "a" * 500 + "b" + "a" * 40), (72, "ab" * 700), (73, "ab" * 300), (50, passage), (50, passage)]
    rows += [(-5, prose(6, 30)), (80, prose(6, 30)), (90, "\0" * 120), (91, "\0" * 90), (92, "é" * 60), (93, "xé" + "é" * 59)]
    rows += [(100, prose(7, 4000) + passage), (101, prose(7, 4000))]
    assert found(S.remove_repeats(documents(rows))) == brute(rows, 50)


def test_hot_passage_and_many_copies(spark, documents):
    passage = prose(9, 25)
    rows = [(i, prose(2000 + i, 12) + " " + passage + " " + prose(3000 + i, 12)) for i in range(150)]
    rows += [(i, rows[i % 3][1]) for i in range(150, 230)]
    assert found(S.remove_repeats(documents(rows))) == brute(rows, 50)


def test_empty_table_and_other_columns(spark, documents):
    empty = S.remove_repeats(documents([]))
    assert empty.columns == ["doc_id", "n_bytes", "spans", "kept"] and empty.count() == 0
    clashing = documents([(1, "t" * 60), (2, "t" * 70)]).withColumn("b", F.lit(1)).withColumn("t", F.lit(2)).withColumn("ord", F.lit(3)).withColumn("id", F.lit(4)).withColumn("kept", F.lit(5))
    assert found(S.remove_repeats(clashing)) == brute([(1, "t" * 60), (2, "t" * 70)], 50)
    with pytest.raises(ValueError):
        S.remove_repeats(clashing, 10)


def in_one_process(rows, least, batches, bits):
    """The stages of remove_repeats over texts that differ, without Spark."""
    parts = [[] for _ in range(batches)]
    for i, t in rows:
        name = hashlib.sha256(t.encode()).digest()
        parts[name[0] % batches].append((name, i, t.encode()))
    made = [S.Batch(pa.table({"t": [p[0] for p in ps], "ord": pa.array([p[1] for p in ps], pa.int64()), "b": pa.array([p[2] for p in ps], pa.binary())}), least, bits) for ps in parts]
    grouped = lambda table, key: [table.filter(pa.compute.equal(table[key], k)) for k in pa.compute.unique(table[key])]
    heads = pa.concat_tables([S.heads_of(n, b) for n, b in enumerate(made)])
    flags = pa.concat_tables([S.repeated_heads(t) for t in grouped(heads, "slot")])
    contexts = pa.concat_tables([S.contexts_of(n, b, flags.filter(pa.compute.equal(flags["batch"], n)), least, bits) for n, b in enumerate(made)])
    spans = pa.concat_tables([S.long_matches(t, least) for t in grouped(contexts, "slot")])
    joined = pa.concat_tables([S.joined_spans(t) for t in grouped(spans, "batch")])
    by_name = {t: [(s["start"], s["stop"]) for s in ss] for t, ss in zip(joined["t"].to_pylist(), joined["spans"].to_pylist())}
    return sorted(((i, by_name.get(hashlib.sha256(t.encode()).digest(), [])) for i, t in rows), key=repr)


@pytest.mark.parametrize(("step", "run", "hot", "batches", "bits"), [(97, 30, 3, 5, 3), (1 << 18, 1 << 16, 2, 1, 1), (64, 7, 4096, 3, 5), (1 << 18, 100, 1, 4, 2)])
def test_steps_runs_and_hot_heads(monkeypatch, step, run, hot, batches, bits):
    for name, value in {"STEP": step, "RUN": run, "HOT": hot}.items():
        monkeypatch.setattr(S, name, value)
    rows = list({t: (i, t) for i, t in corpus(4, 60) if t}.values()) + [(500, "ab" * 200), (501, "b" + "ab" * 150), (502, "c" * 300)]
    want = [(i, spans) for i, _, spans, _ in brute(rows, 32)]
    assert in_one_process(rows, 32, batches, bits) == sorted(want, key=repr)


def test_one_key_for_all_windows(monkeypatch):
    """Equality rests on the bytes: with one digest for all, results stay."""
    monkeypatch.setattr(S.Family, "keys", lambda self, at: np.zeros(len(at), dtype=np.uint64))
    monkeypatch.setattr(S, "RUN", 40)
    rows = list({t: (i, t) for i, t in corpus(5, 12) if t}.values())
    assert in_one_process(rows, 32, 2, 1) == sorted([(i, spans) for i, _, spans, _ in brute(rows, 32)], key=repr)


def test_levels_grow_geometrically():
    text = prose(11, 20000).encode() + bytes(58)
    family = S.Family(S._words(text), 50)
    for k in range(40):
        at = np.arange(k * 1000, (k + 1) * 1000)
        family.add(at, np.full(1000, k))
        sizes = [len(x) for x in family.levels]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))
    assert sum(map(len, family.levels)) == len({text[i : i + 50] for i in range(40000)})


def weak_digest(words, at, n):
    """Few different digests, the same for equal bytes: the bytes must decide."""
    return (words[at] & np.uint64(7)) << np.uint64(61)


@pytest.mark.parametrize(("part", "hot", "same_digests"), [(1, 2, False), (40, 2, False), (7, 10_000, False), (40, 2, True)])
def test_slots_of_a_batch_in_parts(monkeypatch, part, hot, same_digests):
    monkeypatch.setattr(S, "PART", part)
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "_mixed", weak_digest if same_digests else S._mixed)
    rows = list({t: (i, t) for i, t in corpus(5) if t}.values())
    assert in_one_process(rows, 20, 3, 3) == sorted([(i, spans) for i, _, spans, _ in brute(rows, 20)], key=repr)


def test_hot_windows_of_a_batch_take_little_memory():
    draw = random.Random(1)
    line = "a line that each of many documents has, with enough bytes for many windows of fifty, " * 4
    texts = [f"{draw.getrandbits(256):064x}{line}{draw.getrandbits(256):064x}".encode() for _ in range(10_000)]
    batch = S.Batch(pa.table({"t": [i.to_bytes(32, "big") for i in range(10_000)], "ord": range(10_000), "b": texts}), 50, 7)
    flags = S.repeated_heads(S.heads_of(0, batch))
    tracemalloc.start()
    try:
        contexts = S.contexts_of(0, batch, flags, 50, 7)
        assert tracemalloc.get_traced_memory()[1] < 60 * len(batch.buffer)
    finally:
        tracemalloc.stop()
    joined = [r["uses"] for r in contexts.to_pylist() if r["slot"] < 0]
    # One span a document, not one a window; the first document has the line, the others copy it.
    assert [len(np.frombuffer(x, S._SPAN)) for x in joined] == [9_999]
