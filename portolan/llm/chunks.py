"""Texts in chunks that byte-level BPE encodes independently of each other."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

# Chunks kept of the current and of the last generation each, and the longest that is kept.
MOST_CHUNKS, LONGEST_CHUNK = 150_000, 64
# Bytes of texts that are split at a time; a worker takes some 15 times as many for them.
GROUP = 1_000_000


def maybe_space(lead: np.ndarray) -> np.ndarray:
    """Whether bytes are among those that start a white-space character of several bytes."""
    return (lead == 0xC2) | (lead >= 0xE1) & (lead <= 0xE3)


def chunk_starts(data: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where chunks start in the UTF-8 bytes of texts that lie end to end.

    In the usual byte-level patterns no match reaches across these places, and what stands
    before them changes nothing behind them: before a space between two characters that are
    not white space; between a letter (A to Z, or of Latin-1) and an ASCII digit or mark other
    than the apostrophe; between a single line feed and a letter A to Z. So a word is one
    chunk, whatever marks follow it. Spaces beside control characters, or beside characters
    whose first byte is that of some white space, are left within chunks, which is always
    right.
    """
    starts = np.zeros(len(data) + 1, dtype=bool)
    starts[text_starts] = True
    space = np.flatnonzero(data[1:-1] == 0x20) + 1
    before, after = data[space - 1], data[space + 1]
    safe = (before > 0x20) & (after > 0x20) & ~maybe_space(after) & ~starts[space + 1]
    safe &= ~((before >= 0x80) & ((data[space - 2] == 0xC2) | maybe_space(data[np.maximum(space - 3, 0)])))
    starts[space[safe]] = True
    shown = (data > 0x20) & (data < 0x7F)
    letter = (data | 0x20) - np.uint8(0x61) < 26
    mark = shown & ~letter & (data != 0x27)
    feed = np.flatnonzero(data[1:-1] == 0x0A) + 1
    starts[feed[shown[feed - 1] & letter[feed + 1]] + 1] = True
    # U+00C0 to U+00FF, without the signs of multiplication and division
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    starts[1:-1] |= letter[:-1] & mark[1:]
    return np.flatnonzero(starts[:-1])


def _parts(values: pa.LargeBinaryArray) -> list[bytes]:
    """The values as bytes, as ``to_pylist`` gives them, without an object of Arrow for each."""
    ends = np.frombuffer(values.buffers()[1], "<i8")[values.offset : values.offset + len(values) + 1].tolist()
    line = memoryview(values.buffers()[2] or b"")[: ends[-1]].tobytes()
    return [line[a:b] for a, b in zip(ends, ends[1:])]


class ChunkEncoder:
    """Encodes whole texts, each distinct chunk of a group once.

    ``encode`` takes a list of chunks in UTF-8 and gives the bytes of each one's ids, as
    little-endian uint32. Chunks that were met before are looked up; when a generation of
    known chunks is full, those met again move on to the next one.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]]):
        self.encode = encode
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _ids(self, chunks: list[bytes]) -> list[bytes]:
        if len(self.known) > MOST_CHUNKS:
            self.known, self.older = {}, self.known
        found = list(map(self.known.get, chunks))
        missing = [i for i, ids in enumerate(found) if ids is None]
        sought = [chunks[i] for i in missing]
        ids = list(map(self.older.get, sought))
        new = [i for i, old in enumerate(ids) if old is None]
        for i, made in zip(new, self.encode([sought[i] for i in new])):
            ids[i] = made
        for i, made in zip(missing, ids):
            found[i] = made
        if max(map(len, sought), default=0) <= LONGEST_CHUNK:
            self.known.update(zip(sought, ids))
        else:
            self.known.update((c, made) for c, made in zip(sought, ids) if len(c) <= LONGEST_CHUNK)
        return found

    def _group(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and where each text's begin (and the last ends)."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        if not len(data):
            return np.empty(0, "<u4"), np.zeros(len(offsets), dtype=np.int64)
        at = offsets - offsets[0]
        starts = chunk_starts(data, at[:-1][at[:-1] < at[1:]])
        bounds = np.append(starts, len(data))
        chunks = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        coded = chunks.dictionary_encode()
        ids = pa.array(self._ids(_parts(coded.dictionary)), pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], "<i8")[: len(ids) + 1]
        whole = np.frombuffer(ids.buffers()[2] or b"", "<u4", ends[-1] // 4)
        return whole, ends[np.searchsorted(bounds, at)] // 4

    def groups(self, texts: pa.Array | list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For groups of texts in order: their ids end to end, and the bounds of each text's."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not len(texts):
            return
        lengths = np.cumsum(np.asarray(pa.compute.binary_length(texts).fill_null(0)).astype(np.int64))
        cuts = np.flatnonzero(np.diff(lengths // GROUP)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)]):
            yield self._group(texts.slice(a, b - a))
            pa.default_memory_pool().release_unused()  # another task's worker stands beside

    def __call__(self, texts: pa.Array | list[str]) -> Iterator[bytes]:
        """The ids of each text, in order, as bytes."""
        for whole, bounds in self.groups(texts):
            line, at = whole.tobytes(), (4 * bounds).tolist()
            for a, b in zip(at, at[1:]):
                yield line[a:b]
