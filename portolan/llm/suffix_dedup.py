"""Removal of passages that repeat across documents, over a logarithmic family of suffix arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.operators.lookup import lookup_join
from portolan.sources.scratch import store

# Bytes of text that one task reads at a time, and sampled suffixes that one slot is
# expected to hold; both numbers of groups follow the size of the table.
BATCH_BYTES, SLOT_SEEDS, LEAST_SLOTS = 16 << 20, 1 << 20, 64
# Bytes at the head of a suffix that settle whether it is sampled.
HEAD = 20
# Window starts that are worked on at a time, stretches of a batch that are compared at a
# time, windows in one batch of the family, and occurrences from which a head's windows are
# dealt out one by one.
STEP, PART, RUN, HOT = 1 << 18, 1 << 17, 1 << 16, 4_096
_LAST_ID = 2**63 - 1
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_LOW = np.uint64(0xFFFFFFFF)
_USE = np.dtype([("context", "<u4"), ("doc", "<u4"), ("at", "<i8")])
_SPAN = np.dtype([("doc", "<u4"), ("start", "<i8"), ("stop", "<i8")])
_SPANS = "array<struct<start:bigint,stop:bigint>>"


def _words(buffer: bytes) -> np.ndarray:
    """The eight bytes from every place on, as numbers; ``buffer`` ends in 8 bytes of padding."""
    return np.ndarray(len(buffer) - 8, "<u8", buffer, 0, (1,))


def _offsets(n: int) -> list[int]:
    """Where eight-byte words start that cover n bytes."""
    return sorted({*range(0, n - 7, 8), n - 8})


def _mixed(words: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit digest of the n bytes from each place on."""
    h = np.full(len(at), n, dtype=np.uint64)
    for o in _offsets(n):
        h = (h ^ words[at + o]) * _M2
        h ^= h >> np.uint64(32)
    h *= _M3
    return h ^ (h >> np.uint64(29))


def _same(words: np.ndarray, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Whether the n bytes from a and from b on are equal."""
    same = np.ones(len(a), dtype=bool)
    for o in _offsets(n):
        same &= words[a + o] == words[b + o]
    return same


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows start."""
    new = np.zeros(max(0, len(columns[0]) - 1), dtype=bool)
    for c in columns:
        new |= c[1:] != c[:-1]
    return np.flatnonzero(np.r_[True, new][: len(columns[0])])


def sampled(buffer: bytes, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """place, first and last window, and document of the sampled suffixes of a buffer.

    ``buffer`` holds documents up to ``ends`` and padding. Every window of ``least`` bytes
    within a document has the suffix whose head has the least hash of those that the window
    holds whole, the leftmost if several do: equal windows have equal ones at the same
    distance. Consecutive windows of one suffix come as one row.
    """
    words, head = _words(buffer), min(HEAD, least - 8)
    reach = least - head + 1
    found = []
    for start in range(0, int(ends[-1]) if len(ends) else 0, STEP):
        stop = min(start + STEP, int(ends[-1]) - least + 1)
        if stop <= start:
            break
        places = stop - start + reach - 1
        least_hash = ((words[start : start + places] * _M1) >> np.uint64(32) << np.uint64(32)) | np.arange(places, dtype=np.uint64)
        span = 1
        while 2 * span <= reach:
            least_hash = np.minimum(least_hash[:-span], least_hash[span:])
            span *= 2
        if span < reach:
            least_hash = np.minimum(least_hash[: span - reach], least_hash[reach - span :])
        first_doc, last_doc = np.searchsorted(ends, [start, stop - 1], side="right")
        bounds = ends[first_doc : last_doc + 1]
        doc = np.repeat(np.arange(first_doc, last_doc + 1), np.diff(np.r_[start, np.minimum(bounds, stop)]))
        inside = np.flatnonzero(np.arange(start, stop) + least <= ends[doc])
        place, window, doc = (least_hash[inside] & _LOW).astype(np.int64) + start, inside + start, doc[inside]
        at = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (window[1:] != window[:-1] + 1)][: len(place)])
        found.append((place[at], window[at], np.r_[window[at[1:] - 1], window[-1:]], doc[at]))
    if not found:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(4))
    return tuple(np.concatenate(c) for c in zip(*found))


class Batch:
    """The documents of a batch, one of each text, side by side, and their sampled suffixes."""

    def __init__(self, table: pa.Table, least: int, bits: int):
        t = table.column("t").to_pylist()
        rows = list({name: i for i, name in reversed(list(enumerate(t)))}.values())
        rows.sort(key=t.__getitem__)
        self.names = [t[i] for i in rows]
        self.ords = table.column("ord").to_numpy()[rows] if rows else np.empty(0, dtype=np.int64)
        texts = table.column("b").take(pa.array(rows, pa.int64())).to_pylist()
        self.ends = np.cumsum([len(x) for x in texts], dtype=np.int64)
        self.buffer = b"".join(texts) + bytes(least + 8)
        self.place, self.first, self.last, self.doc = sampled(self.buffer, self.ends, least)
        keys = _mixed(_words(self.buffer), self.place, min(HEAD, least - 8))
        self.slot = (keys >> np.uint64(64 - bits)).astype(np.int64)
        self.key = (keys >> np.uint64(64 - bits) << np.uint64(32)) | (keys & _LOW)  # slot, then 32 bits within it


def _slices(sorted_slots: np.ndarray) -> Iterator[tuple[int, int, int]]:
    at = _starts(sorted_slots)
    yield from zip(sorted_slots[at].tolist(), at.tolist(), [*at[1:].tolist(), len(sorted_slots)])


def _table(columns: dict[str, pa.DataType], rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(columns.values())], names=list(columns))


_HEADS = {"slot": pa.int32(), "batch": pa.int32(), "heads": pa.binary(), "counts": pa.binary()}
_FLAGS = {"batch": pa.int32(), "slot": pa.int32(), "heads": pa.binary(), "hot": pa.binary()}
_CONTEXTS = {"slot": pa.int32(), "batch": pa.int32(), "texts": pa.binary(), "lengths": pa.binary(), "ords": pa.binary(), "uses": pa.binary(), "names": pa.binary()}
_FOUND = {"batch": pa.int32(), "names": pa.binary(), "spans": pa.binary()}


def _ddl(columns: dict[str, pa.DataType]) -> str:
    return ", ".join(f"{c} {'int' if kind == pa.int32() else 'binary'}" for c, kind in columns.items())


def heads_of(number: int, batch: Batch) -> pa.Table:
    """The distinct heads of a batch's sampled suffixes, sorted, by slot; of those that
    occur more than once, the place among them and the count."""
    keys, counts = np.unique(batch.key, return_counts=True)
    rows = []
    for slot, a, b in _slices((keys >> np.uint64(32)).astype(np.int64)):
        more = np.flatnonzero(counts[a:b] > 1)
        many = np.c_[more, counts[a:b][more]].astype("<u4").tobytes()
        rows.append((slot, number, (keys[a:b] & _LOW).astype("<u4").tobytes(), many))
    return _table(_HEADS, rows)


def repeated_heads(runs: pa.Table) -> pa.Table:
    """For each batch the heads of a slot that other batches have too, and which are hot."""
    batches = runs.column("batch").to_pylist()
    slots = runs.column("slot").to_pylist()
    heads = [np.frombuffer(x, "<u4") for x in runs.column("heads").to_pylist()]
    known, where, times = np.unique(np.concatenate(heads), return_inverse=True, return_counts=True)
    total, start = times.astype(np.int64), 0
    for h, more in zip(heads, runs.column("counts").to_pylist()):
        at, n = np.frombuffer(more, "<u4").reshape(-1, 2).T.astype(np.int64)
        total[where[start + at]] += n - 1
        start += len(h)
    rows, start = [], 0
    for batch, slot, h in zip(batches, slots, heads):
        own = where[start : start + len(h)]
        start += len(h)
        shared = times[own] > 1
        if shared.any():
            rows.append((batch, slot, h[shared].tobytes(), np.packbits(total[own][shared] >= HOT).tobytes()))
    return _table(_FLAGS, rows)


def _windows(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All windows from the firsts to the lasts."""
    many = last - first + 1
    return np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())


def _codes(batch: Batch, begin: np.ndarray, stop: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """A number for each stretch of a batch's bytes, the same for equal ones, and the place
    among them of the first that has it. Either all are single windows or none needs to be."""
    if (stop - begin == least).all():
        words = _words(batch.buffer)
        key = _mixed(words, begin, least)
        order = np.argsort(key, kind="stable")
        tied = np.flatnonzero(np.diff(key[order]) == 0)
        if not _same(words, begin[order[tied]], begin[order[tied + 1]], least).all():  # the bytes decide
            order = np.lexsort([words[begin + o] for o in _offsets(least)])
        new = np.r_[True, ~_same(words, begin[order[1:]], begin[order[:-1]], least)][: len(order)]
        codes = np.empty(len(order), dtype=np.int64)
        codes[order] = np.cumsum(new) - 1
        return codes, order[new]
    buffer = batch.buffer
    coded = pa.array([buffer[a:b] for a, b in zip(begin.tolist(), stop.tolist())], pa.binary()).dictionary_encode()
    codes = coded.indices.to_numpy()
    return codes, np.unique(codes, return_index=True)[1]


def _parts(slot: np.ndarray) -> Iterator[np.ndarray]:
    """Places in the order of their slots, about PART at a time; a slot stays together."""
    order = np.argsort(slot, kind="stable")
    at = _starts(slot[order])
    return iter(np.split(order, at[1:][np.diff(at // PART) > 0]))


def contexts_of(number: int, batch: Batch, flags: pa.Table, least: int, bits: int) -> pa.Table:
    """The bytes of all windows of each suffix whose head repeats, by slot.

    Equal bytes go once per batch, under the smallest id that has them; in documents of
    larger ids they are spans already, which stand, joined, in the row of the batch's names
    (slot -1 - batch). The windows of a hot head go one by one, each to the slot of its
    digest. Some slots are worked on at a time, as a batch may have as many windows as bytes.
    """
    flagged, hot_heads = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    for slot, heads, hot in zip(*(flags.column(c).to_pylist() for c in ("slot", "heads", "hot"))):
        keys = np.frombuffer(heads, "<u4").astype(np.uint64) | np.uint64(slot << 32)
        flagged.append(keys)
        hot_heads.append(keys[np.unpackbits(np.frombuffer(hot, np.uint8))[: len(keys)].astype(bool)])
    order = np.lexsort((batch.ords[batch.doc], batch.key))
    key, ord_ = batch.key[order], batch.ords[batch.doc[order]]
    at = _starts(key)
    sizes = np.diff(np.r_[at, len(key)])
    lasts = ord_[np.r_[at[1:], len(key)] - 1] if len(key) else ord_
    use = np.isin(key[at], np.concatenate(flagged)) | (ord_[at] != lasts)
    is_hot = np.isin(key[at], np.concatenate(hot_heads)) | (sizes >= HOT)
    pick, spread = np.sort(order[np.repeat(use & ~is_hot, sizes)]), np.sort(order[np.repeat(use & is_hot, sizes)])
    del order, key, ord_

    before = batch.ends - np.diff(np.r_[0, batch.ends])
    # 1 where windows begin that a smaller id of the batch has, -1 past them: each window is of one suffix.
    edges = np.zeros(len(batch.buffer) + 1, dtype=np.int8)
    rows = []

    def send(slot: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> None:
        doc = np.searchsorted(batch.ends, begin, side="right")
        codes, firsts = _codes(batch, begin, stop, least)
        own, smallest = batch.ords[doc], np.full(len(firsts), _LAST_ID)
        np.minimum.at(smallest, codes, own)
        later = own > smallest[codes]
        edges[begin[later]] += 1
        edges[stop[later] - least + 1] -= 1
        kept = np.flatnonzero(~later)
        kept = kept[np.lexsort((codes[kept], slot[kept]))]
        for s, a, b in _slices(slot[kept]):
            here = kept[a:b]
            starts = _starts(codes[here])
            names = codes[here][starts]
            uses = np.zeros(len(here), dtype=_USE)
            uses["context"] = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(here)]))
            uses["doc"], uses["at"] = doc[here], begin[here] - before[doc[here]]
            texts = [batch.buffer[i:j] for i, j in zip(begin[firsts[names]].tolist(), stop[firsts[names]].tolist())]
            lengths = np.array([len(x) for x in texts], dtype="<u4").tobytes()
            rows.append((s, number, b"".join(texts), lengths, smallest[names].astype("<i8").tobytes(), uses.tobytes(), None))

    for part in _parts(batch.slot[pick]):
        own = pick[part]
        send(batch.slot[own], batch.first[own], batch.last[own] + least)
    windows = _windows(batch.first[spread], batch.last[spread])
    digests = [_mixed(_words(batch.buffer), windows[i : i + STEP], least) >> np.uint64(64 - bits) for i in range(0, len(windows), STEP)]
    dealt = np.concatenate([np.empty(0, np.int32), *[d.astype(np.int32) for d in digests]])
    for part in _parts(dealt):
        send(dealt[part], windows[part], windows[part] + least)

    start = np.flatnonzero(edges > 0)
    spans = np.zeros(len(start), dtype=_SPAN)
    spans["doc"] = doc = np.searchsorted(batch.ends, start, side="right")
    spans["start"], spans["stop"] = start - before[doc], np.flatnonzero(edges < 0) - 1 + least - before[doc]
    rows.append((-1 - number, number, None, None, None, spans.tobytes(), b"".join(batch.names)))
    return _table(_CONTEXTS, rows)


class SuffixArray:
    """Distinct windows in order: by their first four bytes, then by a digest of the whole.

    ``at`` is where each one lies in the bytes, ``ord`` the smallest id that has it.
    """

    def __init__(self, key: np.ndarray, at: np.ndarray, ord_: np.ndarray):
        self.key, self.at, self.ord = key, at, ord_

    def __len__(self) -> int:
        return len(self.key)


class Family:
    """Suffix arrays of falling, geometric sizes over one stretch of bytes.

    Batches come with rising ids. Each gets a suffix array, which is scanned along every
    level for equal windows of smaller ids; what no level has becomes the next level, and
    levels of about equal size are merged, so that there are few and each window moves
    about as often as the logarithm of their number.
    """

    def __init__(self, words: np.ndarray, least: int):
        self.words, self.least, self.levels = words, least, []

    def keys(self, at: np.ndarray) -> np.ndarray:
        first = (self.words[at] & _LOW).astype(np.uint32).byteswap().astype(np.uint64)
        return (first << np.uint64(32)) | (_mixed(self.words, at, self.least) >> np.uint64(32))

    def _ties(self, key: np.ndarray, at: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places whose key the next one shares, and whether the two windows are equal."""
        k, a = key[order], at[order]
        tied = np.flatnonzero(k[1:] == k[:-1])
        return tied, _same(self.words, a[tied], a[tied + 1], self.least)

    def add(self, at: np.ndarray, ord_: np.ndarray) -> np.ndarray:
        """Which windows of the batch, given by rising ids, stand in a document of a smaller id."""
        key = self.keys(at)
        order = np.argsort(key, kind="stable")
        tied, same = self._ties(key, at, order)
        if not same.all():  # different windows of one key: their bytes decide
            order = np.lexsort([ord_, *[self.words[at + o] for o in _offsets(self.least)], key])
            tied, same = self._ties(key, at, order)
        repeats = np.zeros(len(order), dtype=bool)
        repeats[tied[same] + 1] = True
        firsts = np.flatnonzero(~repeats)
        own = SuffixArray(key[order][firsts], at[order][firsts], ord_[order][firsts])
        known = self.scan(own)
        group = np.cumsum(~repeats) - 1
        seen = np.empty(len(order), dtype=bool)
        seen[order] = np.minimum(known, own.ord)[group] < ord_[order]
        new = known == _LAST_ID
        self.insert(SuffixArray(own.key[new], own.at[new], own.ord[new]))
        return seen

    def scan(self, own: SuffixArray) -> np.ndarray:
        """The smallest id that a level has for each window, the last id if none has it."""
        best = np.full(len(own), _LAST_ID)
        for level in self.levels:
            place = np.searchsorted(level.key, own.key)
            open_ = np.arange(len(own))
            while True:
                open_ = open_[place[open_] < len(level)]
                open_ = open_[level.key[place[open_]] == own.key[open_]]
                if not open_.size:
                    break
                same = _same(self.words, level.at[place[open_]], own.at[open_], self.least)
                hit = open_[same]
                best[hit] = np.minimum(best[hit], level.ord[place[hit]])
                open_ = open_[~same]
                place[open_] += 1
        return best

    def insert(self, new: SuffixArray) -> None:
        while self.levels and len(self.levels[-1]) < 2 * len(new):
            old = self.levels.pop()
            key = np.concatenate([old.key, new.key])
            order = np.argsort(key, kind="stable")  # two sorted parts: a merge
            new = SuffixArray(key[order], np.concatenate([old.at, new.at])[order], np.concatenate([old.ord, new.ord])[order])
        if len(new):
            self.levels.append(new)


def long_matches(rows: pa.Table, least: int) -> pa.Table:
    """For each batch the spans of a slot's windows that stand in documents of smaller ids."""
    if rows.column("slot")[0].as_py() < 0:
        return rows.select(["batch", "names", "uses"]).rename_columns(["batch", "names", "spans"])
    numbers = rows.column("batch").to_numpy()
    buffer = b"".join(rows.column("texts").to_pylist()) + bytes(least + 8)
    parts = lambda c, kind: [np.frombuffer(x, kind) for x in rows.column(c).to_pylist()]
    lengths, ords, uses = parts("lengths", "<u4"), parts("ords", "<i8"), parts("uses", _USE)
    sizes = np.array([len(x) for x in lengths])
    before = np.cumsum(sizes) - sizes
    batch = np.repeat(numbers, sizes)
    length, ord_ = np.concatenate(lengths).astype(np.int64), np.concatenate(ords)
    begin = np.cumsum(length) - length
    use = np.concatenate(uses)
    context = use["context"].astype(np.int64) + np.repeat(before, [len(u) for u in uses])  # in order
    use_from = np.searchsorted(context, np.arange(len(length) + 1))

    family = Family(_words(buffer), least)
    order = np.argsort(ord_, kind="stable")
    many = length[order] - least + 1
    cuts = np.flatnonzero(np.diff(np.cumsum(many) // RUN)) + 1  # batches of about RUN windows
    found = []
    for part, n in zip(np.split(order, cuts), np.split(many, cuts)):
        which = np.repeat(part, n)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        seen = np.flatnonzero(family.add(begin[which] + inner, ord_[which]))
        which, inner = which[seen], inner[seen]
        at = np.flatnonzero(np.r_[True, (which[1:] != which[:-1]) | (inner[1:] != inner[:-1] + 1)][: len(which)])
        found.append((which[at], inner[at], np.r_[inner[at[1:] - 1], inner[-1:]] + least))
    which, start, stop = (np.concatenate(c) for c in zip(*found))
    times = (use_from[1:] - use_from[:-1])[which]
    run = np.repeat(np.arange(len(which)), times)
    user = use_from[which][run] + np.arange(len(run)) - np.repeat(np.cumsum(times) - times, times)
    spans = np.zeros(len(run), dtype=_SPAN)
    spans["doc"], spans["start"], spans["stop"] = use["doc"][user], use["at"][user] + start[run], use["at"][user] + stop[run]
    of = batch[which][run]
    by = np.argsort(of, kind="stable")
    return _table(_FOUND, [(n, None, spans[by[a:b]].tobytes()) for n, a, b in _slices(of[by])])


def joined_spans(rows: pa.Table) -> pa.Table:
    """t and maximal spans of a batch's documents that have any."""
    names = b"".join(x for x in rows.column("names").to_pylist() if x)
    spans = np.concatenate([np.frombuffer(x, _SPAN) for x in rows.column("spans").to_pylist()])
    spans = spans[np.lexsort((spans["start"], spans["doc"]))]
    doc, start, stop = (spans[c].astype(np.int64) for c in ("doc", "start", "stop"))
    # Documents laid end to end, so that the furthest stop so far is of the same document.
    room = int(stop.max(initial=0)) + 2
    reach = np.maximum.accumulate(doc * room + stop) if len(doc) else doc
    first = np.flatnonzero(np.r_[True, (doc * room + start)[1:] > reach[:-1]][: len(doc)])
    stop = reach[np.r_[first[1:] - 1, len(doc) - 1]] - doc[first] * room if len(doc) else doc
    doc, start = doc[first], start[first]
    at = _starts(doc)
    lists = pa.ListArray.from_arrays(
        pa.array(np.r_[at, len(doc)].astype(np.int32)), pa.StructArray.from_arrays([pa.array(start), pa.array(stop)], names=["start", "stop"])
    )
    return pa.table([pa.array([names[32 * i : 32 * i + 32] for i in doc[at].tolist()], pa.binary()), lists], names=["t", "spans"])


def _cut(texts: list[bytes], spans: list[list[dict] | None]) -> list[bytes]:
    out = []
    for text, own in zip(texts, spans):
        if own:
            edges = [0, *[x for s in own for x in (s["start"], s["stop"])], len(text)]
            text = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
        out.append(text)
    return out


def remove_repeats(docs: DataFrame, least: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_bytes, spans (of bytes removed) and kept (the other bytes) of every row.

    Texts are UTF-8 bytes. Removed is each byte covered by a string of ``least`` bytes that
    also starts in a row of a smaller id; matches lie within rows, may overlap, and are
    judged on the texts as they come. ``spans`` are maximal; what is kept may start or end
    within a character.

    A text that a row of a smaller id has too goes whole. Of the others every window of
    ``least`` bytes has one sampled suffix, so equal windows meet in the slot of its head.
    Heads that just one document has are dropped first; the bytes around the rest go to
    the slots, where a family of suffix arrays takes them in batches of rising ids and
    scans each along what came before. Batches of documents, slots and runs have bounded
    size whatever the table's; equal bytes of a batch travel once, and the windows of a
    very frequent head are dealt out one by one.

    Null texts are empty. Rows without an id come after all others, and none of them is
    smaller than another; so are rows of one id. Repeated rows each give a row. An empty
    table gives no rows; columns but the two named are not read.
    """
    if least < 16:
        raise ValueError("strings of fewer than 16 bytes are not supported")
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)).alias("ord"), body.alias("b"))
    rows = rows.withColumn("t", F.unhex(F.sha2("b", 256)))
    texts = store(
        rows.select("t", "ord", F.octet_length("b").alias("n")).groupBy("t")
        .agg(F.min("ord").alias("first"), F.count("*").alias("rows"), F.max("n").alias("n")),
        "texts",
    )
    copied = texts.filter("rows > 1").select("t", "first")
    size = texts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    batches = max(1, -(-size // BATCH_BYTES))
    bits = max(LEAST_SLOTS, size // (15 * SLOT_SEEDS)).bit_length()  # a suffix of about 15 is sampled
    mains = lookup_join(rows, copied, ["t"], "left").filter((F.octet_length("b") >= least) & (F.col("first").isNull() | (F.col("ord") == F.col("first"))))

    def dealt() -> DataFrame:
        number = F.pmod(F.xxhash64("t"), F.lit(batches)).cast("int")
        return mains.select(number.alias("batch"), *[F.col(c).alias(c) for c in ("t", "ord", "b")])

    def heads(key: tuple, table: pa.Table) -> pa.Table:
        return heads_of(key[0].as_py(), Batch(table, least, bits))

    def contexts(key: tuple, table: pa.Table, flags: pa.Table) -> pa.Table:
        return contexts_of(key[0].as_py(), Batch(table, least, bits), flags, least, bits)

    def matches(table: pa.Table) -> pa.Table:
        return long_matches(table, least)

    runs = dealt().groupBy("batch").applyInArrow(heads, _ddl(_HEADS))
    flags = store(runs.groupBy("slot").applyInArrow(repeated_heads, _ddl(_FLAGS)), "heads")
    around = dealt().groupBy("batch").cogroup(flags.groupBy("batch")).applyInArrow(contexts, _ddl(_CONTEXTS))
    found = around.groupBy("slot").applyInArrow(matches, _ddl(_FOUND))
    spans = store(found.groupBy("batch").applyInArrow(joined_spans, f"t binary, spans {_SPANS}"), "spans")

    marks = store(copied.join(spans, "t", "full"), "marks")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.octet_length("b").cast("long").alias("stop")))
    again = (F.col("ord") > F.col("first")) & (F.octet_length("b") >= least)
    own = F.when(again, whole).otherwise(F.coalesce("spans", F.array().cast(_SPANS)))
    marked = lookup_join(rows, marks, ["t"], "left").select("id", F.octet_length("b").cast("long").alias("n_bytes"), own.alias("spans"), "b")

    def cut(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            kept = pa.array(_cut(batch.column(3).to_pylist(), batch.column(2).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), kept], names=[id_col, "n_bytes", "spans", "kept"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return marked.mapInArrow(cut, f"`{id_col}` {id_type}, n_bytes long, spans {_SPANS}, kept binary")
