"""Byte-level BPE by rounds of merges over padded matrices of many words."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan.llm.chunks import ChunkEncoder

NONE = np.iinfo(np.int64).max
# Words up to LONGEST bytes are merged in matrices of at most CELLS cells; longer ones,
# where a round for each merge costs too much, by a heap with the same order of merges.
LONGEST, CELLS = 512, 1 << 20
BATCH_ROWS, BATCH_BYTES = 4096, 8 << 20


class PairTable:
    """Hash table from pairs of ids to the id of their merge, looked up by whole arrays."""

    def __init__(self, pairs: np.ndarray, merged: np.ndarray):
        bits = max(4, int(len(pairs) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.full(1 << bits, NONE, dtype=np.int64)
        slot, waiting = self._slot(pairs), np.arange(len(pairs))
        while len(waiting):
            free = waiting[self.keys[slot[waiting]] < 0]
            taken, first = np.unique(slot[free], return_index=True)
            self.keys[taken], self.values[taken] = pairs[free[first]], merged[free[first]]
            waiting = np.setdiff1d(waiting, free[first], assume_unique=True)
            slot[waiting] = (slot[waiting] + 1) & self.mask

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged id of each pair, NONE where there is none; negative ids pad."""
        wanted = ((left.astype(np.int64) << 32) | right).ravel()
        found = np.full(wanted.shape, NONE, dtype=np.int64)
        open_ = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slot = self._slot(wanted[open_])
        while len(open_):
            key = self.keys[slot]
            hit = key == wanted[open_]
            found[open_[hit]] = self.values[slot[hit]]
            on = ~hit & (key >= 0)
            open_, slot = open_[on], (slot[on] + 1) & self.mask
        return found.reshape(left.shape)


class ByteBpe:
    """Encodes and decodes with the ranks of a tiktoken file; a token's rank is its id."""

    def __init__(self, ranks: bytes, pattern: str):
        self.ids = {base64.b64decode(t): int(r) for t, r in (line.split() for line in ranks.splitlines() if line)}
        self.pattern = regex.compile(pattern)
        self.tokens = [b""] * (max(self.ids.values()) + 1)
        for token, i in self.ids.items():
            self.tokens[i] = token
        self.spelt = pa.array(self.tokens, pa.large_binary())
        self.bytes = np.array([self.ids[bytes([b])] for b in range(256)], dtype=np.int64)
        get = self.ids.get
        pairs = [
            (a << 32 | b, i)
            for token, i in self.ids.items()
            for at in range(1, len(token))
            if (a := get(token[:at])) is not None and (b := get(token[at:])) is not None
        ]
        keys, merged = np.array(pairs, dtype=np.int64).T
        self.table = PairTable(keys, merged)
        self.merges = dict(pairs)

    def encode_chunks(self, chunks: list[bytes]) -> Iterator[bytes]:
        """The ids of each chunk; distinct words of all chunks are merged together."""
        split = [[w.encode() for w in self.pattern.findall(c.decode())] for c in chunks]
        words = self.encode_words({w for ws in split for w in ws})
        return (b"".join(map(words.__getitem__, ws)) for ws in split)

    def encode_words(self, words: set[bytes]) -> dict[bytes, bytes]:
        done: dict[bytes, bytes] = {}
        buckets: dict[int, list[bytes]] = {}
        for w in words:
            if w in self.ids:  # a word that is a token is not merged
                done[w] = np.array([self.ids[w]], dtype="<u4").tobytes()
            elif len(w) > LONGEST:
                done[w] = self._merge_long(w)
            else:
                buckets.setdefault(1 << (len(w) - 1).bit_length(), []).append(w)
        for width, bucket in buckets.items():
            step = max(1, CELLS // width)
            for i in range(0, len(bucket), step):
                some = bucket[i : i + step]
                done.update(zip(some, self._merge_rows(some, width)))
        return done

    def _merge_rows(self, words: list[bytes], width: int) -> list[bytes]:
        """Each round merges every row's leftmost pair of least rank; rows without one leave."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ids = np.full((len(words), width), -1, dtype=np.int64)
        ids[np.arange(width) < lengths[:, None]] = self.bytes[np.frombuffer(b"".join(words), dtype=np.uint8)]
        ranks = self.table.find(ids[:, :-1], ids[:, 1:])
        rows, out = np.arange(len(words)), [b""] * len(words)
        while len(rows):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), dtype=np.int64)
            least = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), NONE)
            ended = least == NONE
            held = ids[ended] >= 0
            line, to = ids[ended][held].astype("<u4").tobytes(), (4 * np.cumsum(held.sum(axis=1))).tolist()
            for row, a, b in zip(rows[ended].tolist(), [0, *to], to):
                out[row] = line[a:b]
            if ended.all():
                break
            on = ~ended
            rows, ids, ranks, at, least = rows[on], ids[on], ranks[on], at[on, None], least[on]
            each = np.arange(len(rows))[:, None]
            np.put_along_axis(ids, at, least[:, None], axis=1)
            places = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, places + (places > at), axis=1)
            ranks = np.take_along_axis(ranks, places[:-1] + (places[:-1] >= at), axis=1)
            for shift in (-1, 0):  # the pairs before and after the merged token are new
                left = at + shift
                fits = ((left >= 0) & (left < ids.shape[1] - 1)).ravel()
                r, c = each[fits], left[fits]
                ranks[r, c] = self.table.find(ids[r, c], ids[r, c + 1])
        return out

    def _merge_long(self, word: bytes) -> bytes:
        ids = self.bytes[np.frombuffer(word, dtype=np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        merges, end = self.merges, len(ids)

        def rank(i: int) -> int | None:
            return merges.get(ids[i] << 32 | ids[after[i]]) if i >= 0 and after[i] < end else None

        heap = [(r, i) for i in range(end - 1) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] is None or rank(i) != r:
                continue  # one of the two was merged meanwhile
            gone = after[i]
            ids[i], ids[gone], after[i] = r, None, after[gone]
            if after[i] < end:
                before[after[i]] = i
            for j in (before[i], i):
                if (new := rank(j)) is not None:
                    heapq.heappush(heap, (new, j))
        return np.array([i for i in ids if i is not None], dtype="<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        """The bytes of little-endian uint32 ids."""
        spelt = self.spelt.take(pa.array(np.frombuffer(ids, dtype="<u4")))
        _, ends, data = spelt.buffers()
        return data[: np.frombuffer(ends, "<i8")[len(spelt)]].to_pybytes() if ids else b""


_coders: dict[int, tuple[ByteBpe, ChunkEncoder]] = {}


def coder(ranks: bytes, pattern: str) -> tuple[ByteBpe, ChunkEncoder]:
    """The coder of a rank file; a worker keeps it, and what it has encoded, for later tasks."""
    key = hash((ranks, pattern))
    if key not in _coders:
        bpe = ByteBpe(ranks, pattern)
        _coders.clear()
        _coders[key] = bpe, ChunkEncoder(bpe.encode_chunks)
    return _coders[key]


def encode_texts(
    docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col``, ids (little-endian uint32) and decoded (bytes) of every whole text.

    ``ranks`` is a tiktoken file that the driver reads. Texts are cut at single spaces,
    where every match of ``pattern`` ends; each distinct chunk of a batch is matched and
    merged once. Null counts as the empty text, which has no ids. Rows of the input give
    one row each, repeated or not; columns other than the two named are not read.
    """
    with open(ranks, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # one fixed file
    schema = T.StructType([docs.schema[id_col], T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, encode = coder(shared.value, pattern)
        for batch in batches:
            first, ids, decoded, held = 0, [], [], 0
            for row, encoded in enumerate(encode(batch.column(1)), 1):
                ids.append(encoded)
                decoded.append(bpe.decode(ids[-1]))
                held += len(ids[-1]) + len(decoded[-1])
                if row == batch.num_rows or len(ids) >= BATCH_ROWS or held >= BATCH_BYTES:
                    own = batch.column(0).slice(first, len(ids))
                    yield pa.RecordBatch.from_arrays([own, pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())], names=schema.names)
                    first, ids, decoded, held = row, [], [], 0

    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema)
