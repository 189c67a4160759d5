from __future__ import annotations

import os
import random
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import re

import numpy as np
import pytest
from tokenizers import Tokenizer

from portolan.llm import packing as P

FILE = public_tokenizers.path("byte_bpe_50k.json")


def best_fit_one_by_one(counts, capacity):
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [r for r in rooms if r >= length]
            room = min(fits) if fits else capacity
            if fits:
                rooms.remove(room)
            rooms.append(room - length)
    return Counter(rooms)


@pytest.mark.parametrize("seed", range(25))
def test_plan_equals_best_fit_over_single_pieces(seed):
    draw = random.Random(seed)
    capacity = draw.choice([7, 20, 64])
    counts = Counter(draw.choices(range(1, capacity + 1), k=draw.randint(0, 150)))
    plan = P.best_fit_plan(counts, capacity)
    placed, used = {}, Counter()
    for s in plan:
        for i in range(s.count):
            seq, at = s.first_sequence + i // s.each, s.offset + i % s.each * s.length
            placed.setdefault(seq, []).append((at, s.length))
            used[s.length] += 1
    assert used == counts and sorted(placed) == list(range(len(placed)))
    rooms = Counter()
    for parts in placed.values():
        end = 0
        for at, length in sorted(parts):
            assert at == end
            end += length
        rooms[capacity - end] += 1
    assert rooms == best_fit_one_by_one(counts, capacity)


def test_documents(documents):
    draw = random.Random(3)
    words = ["hello", "wörld", "x  y", "a\n\nb", "<|endoftext|>", "'s", "日本", "\t", "12", "!!", " "]
    rows = [(i, " ".join(draw.choices(words, k=draw.randint(0, 40)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "hello world " * 5000), (103, "z" * 30000), (104, "same"), (104, "same"), (None, "no id")]
    tokenizer = Tokenizer.from_file(FILE)
    tokenizer.encode_special_tokens = True
    want = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    pieces = P.token_pieces(documents(rows), FILE)
    packed = P.pack(pieces).collect()
    by_sequence, by_doc = {}, {}
    for r in packed:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert ids == want[r["doc_id"]][r["start"] : r["start"] + r["length"]] and len(ids) == r["length"] <= 2048
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["length"]))
    for parts in by_sequence.values():
        parts.sort()
        assert [a for a, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist() and sum(n for _, n in parts) <= 2048
    for i, parts in by_doc.items():
        parts.sort()
        assert sum(n for _, n in parts) == len(want[i]) * (2 if i == 104 else 1)
        if i != 104:
            assert [k for k, _ in parts] == list(range(len(parts))) and all(n == 2048 for _, n in parts[1:])
    whole = {r["sequence_id"]: r["ids"] for r in P.sequences(P.pack(pieces)).collect()}
    assert sorted(sum(n for _, n in p) for p in by_sequence.values()) == sorted(len(b) // 4 for b in whole.values())


def test_crc_and_empty_table(documents):
    packed = P.pack(P.token_pieces(documents([]), FILE))
    assert packed.count() == 0 and {"sequence_id", "offset"} <= set(packed.columns)
    row = P.token_pieces(documents([(1, "hi")]), FILE).selectExpr("crc32(ids) AS c", "ids").first()
    assert row["c"] == zlib.crc32(row["ids"])


def test_chunks_start_at_safe_spaces_only():
    """Beside every white space, and at the ends of texts that lie side by side."""
    from portolan.llm.chunks import chunk_starts

    spaces = [c for c in map(chr, range(0x3001)) if c.isspace()]
    letters = ["a", "é", "ß", "«", "中", "€", "😀", "́"]
    texts = [f"x{a} {b}y" for a in spaces + letters for b in spaces + letters] + [" a", "a ", " ", "", "a  b", "  "]
    at, safe = 0, set()
    for t in texts:
        for m in re.finditer(r"(?<=\S) (?=\S)", t):
            safe.add(at + len(t[: m.start()].encode()))
        at += len(t.encode())
    data = "".join(texts).encode()
    ends = np.cumsum([len(t.encode()) for t in texts])
    starts = np.r_[0, ends[:-1]]
    found = set(chunk_starts(np.frombuffer(data, np.uint8), starts[starts < ends]).tolist())
    assert found - set(starts.tolist()) <= safe
    words = "the cat été ß l'eau".encode()
    assert chunk_starts(np.frombuffer(words, np.uint8), np.array([0])).tolist() == [0, 3, 7, 13, 16]


def test_a_workers_memory_is_bounded():
    """Two workers stand beside the executor's JVM: one that has met very many different words
    holds some 150 MB more than its encoder, whatever came before."""
    code = f"""
import resource
import pyarrow as pa
from portolan.llm.packing import _encoder

used = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024
with open({FILE!r}, "rb") as f:
    encode = _encoder(f.read())
texts = pa.array([" ".join(f"w{{i * 7919 % 1000003:x}}q{{i}}" for i in range(a, a + 500)) for a in range(0, 900_000, 500)])
before = used()
for ids in encode(texts):
    pass
print(used() - before)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    told = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert int(told.stdout) < 150


def test_the_plan_needs_no_python_worker(documents):
    """The planned slots reach the join as a local table, not as rows that workers pickle."""
    pieces = P.token_pieces(documents([(1, "a b c"), (2, "d")]), FILE)
    shown = P.pack(pieces.drop("ids"))._jdf.queryExecution().toString()
    assert "ExistingRDD" not in shown and "LocalRelation" in shown


def test_chunks_end_where_marks_follow_words():
    from portolan.llm.chunks import chunk_starts

    text = "The cat, été! Más.\nThe l'eau a1 ×. «a» (the)\n\nx -a"
    data = np.frombuffer(text.encode(), np.uint8)
    bounds = [*chunk_starts(data, np.array([0])).tolist(), len(data)]
    chunks = [data[a:b].tobytes().decode() for a, b in zip(bounds, bounds[1:])]
    assert chunks == ["The", " cat", ",", " été", "!", " Más", ".\n", "The", " l'eau", " a", "1", " ×. «a» (the", ")\n\nx", " -a"]


def test_a_word_is_encoded_once_whatever_marks_follow_it():
    encode = P._new_encoder(open(FILE, "rb").read())
    plain, met = encode.encode, []
    encode.encode = lambda chunks: met.extend(chunks) or plain(chunks)
    words, marks = [f"wor{chr(97 + i % 26)}d{chr(97 + i // 26)}é" for i in range(200)], [",", ".", "!!", "&&&", ".\nThe", ")", ":"]
    texts = [" ".join(w + m for w in words) for m in marks]
    tokenizer = Tokenizer.from_file(FILE)
    assert [np.frombuffer(b, "<u4").tolist() for b in encode(texts)] == [e.ids for e in tokenizer.encode_batch(texts)]
    assert len(met) < 230


def test_ids_beside_marks_feeds_and_white_space():
    """Against the library over whole texts, many at a time and one alone."""
    draw = random.Random(5)
    parts = ["a", "Zx", "é", "É", "ß", "×", "÷", "ÿ", "«", "—", "”", "中", "か", "😀", "\u0301", "'", "'s", "''", ".", ",", "!!", "-", "|"]
    parts += ["<|endoftext|>", "1", "²", "\n", "\n\n", "\r\n", "\r", "\t", " ", "  ", "\0", "\x1c", "\x7f", "\x85", "\xa0", "\u2003", "\u2028", "\u3000", "\u1680"]
    texts = [a + b + c for a in parts for b in parts for c in ("", "a", " a", "\n")]
    texts += ["".join(draw.choices(parts, k=draw.randint(4, 60))) for _ in range(3000)]
    tokenizer = Tokenizer.from_file(FILE)
    tokenizer.encode_special_tokens = True
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    encode = P._new_encoder(open(FILE, "rb").read())
    assert [np.frombuffer(b, "<u4").tolist() for b in encode(texts)] == want
    for text in [".", " ", "\n", "é", "\xa0", "x", ""]:
        alone = P._new_encoder(open(FILE, "rb").read()) if text == "." else encode
        assert [np.frombuffer(b, "<u4").tolist() for b in alone([text])] == [tokenizer.encode(text, add_special_tokens=False).ids]
