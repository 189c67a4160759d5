from __future__ import annotations

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from portolan.llm import byte_bpe as B

FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def judge():
    with open(FILE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    with open(FILE, "rb") as f:
        return B.coder(f.read(), public_tokenizers.PATTERN)


def test_random_texts(judge, coder):
    draw = random.Random(5)
    alphabet = [chr(c) for c in (9, 10, 11, 13, 32, 32, 32, 0x1C, 0x85, 0xA0, 0x2003, 0x200B, 39, *range(97, 110), 0xE9, 0x4E2D, 0x1F600, 0x301, 0xB2, 0x661, 48, 33, 35)] + ["'s", "'LL", "<|endoftext|>"]
    texts = ["".join(draw.choices(alphabet, k=draw.randint(0, 60))) for _ in range(2000)]
    bpe, encode = coder
    for text, ids in zip(texts, encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == judge.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 2000, " " * 2000, "\n" * 900 + "x", "é" * 900, "the" * 400])
def test_long_words(judge, coder, text):
    assert np.frombuffer(next(coder[1]([text])), "<u4").tolist() == judge.encode_ordinary(text)


def test_table(documents, judge):
    rows = [(1, None), (2, ""), (3, "hello  world\n"), (3, "hello  world\n"), (4, "große Wörter " * 20000), (None, "x")]
    found = B.encode_texts(documents(rows), FILE, public_tokenizers.PATTERN).collect()
    want = {i: judge.encode_ordinary(t or "") for i, t in rows}
    assert len(found) == len(rows)
    for r in found:
        assert np.frombuffer(r["ids"], "<u4").tolist() == want[r["doc_id"]]
        assert bytes(r["decoded"]).decode() == (dict(rows)[r["doc_id"]] or "")
    assert B.encode_texts(documents([]), FILE, public_tokenizers.PATTERN).count() == 0
