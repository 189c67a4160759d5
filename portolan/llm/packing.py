"""Best-fit packing planned over the histogram of lengths."""

from __future__ import annotations

import os
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan.llm.chunks import LONGEST_CHUNK, ChunkEncoder, maybe_space
from portolan.llm.kept import kept
from portolan.llm.ranks import ROWS_PER_BUCKET, number_within
from portolan.sources.scratch import store

BATCH_ROWS, BATCH_BYTES = 4096, 2 << 20
# How byte-level vocabularies spell a space; chunks encoded in one line; lines, or chunks that
# are not in one, encoded at once (an encoding takes some 100 bytes a token, its ids four).
_SPACE, _LINE, _AT_ONCE = "\u0120", 256, 16


def _encoder(vocabulary: bytes) -> ChunkEncoder:
    """The encoder of a vocabulary file; a worker keeps it for its later tasks."""
    return kept(("encoder", hash(vocabulary)), lambda: _new_encoder(vocabulary))


def _new_encoder(vocabulary: bytes) -> ChunkEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has given out the cores
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(vocabulary)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text

    spaced = np.array([(tokenizer.id_to_token(i) or "").startswith(_SPACE) for i in range(tokenizer.get_vocab_size())])
    feed = tokenizer.encode("\n", add_special_tokens=False).ids

    def ids_of(texts: list[str]) -> Iterator[np.ndarray]:
        for i in range(0, len(texts), _AT_ONCE):
            for e in tokenizer.encode_batch_fast(texts[i : i + _AT_ONCE], add_special_tokens=False):
                yield np.array(e.ids, dtype="<u4")

    def in_lines(chunks: list[bytes], between: bytes) -> Iterator[bytes | None]:
        """Each chunk's ids out of long lines; None for those of a line that cannot be told apart."""
        runs = [chunks[i : i + _LINE] for i in range(0, len(chunks), _LINE)]
        for run, ids in zip(runs, ids_of([between.join(run).decode() for run in runs])):
            starts = np.append(0, np.flatnonzero(ids == feed[0]) + 1) if between else np.flatnonzero(spaced[ids])
            if len(starts) != len(run):
                yield from [None] * len(run)
                continue
            line, begins, gap = ids.tobytes(), (4 * starts).tolist(), 4 * len(between)
            yield from [line[a : b - gap] for a, b in zip(begins, [*begins[1:], len(line) + gap])]

    def encode(chunks: list[bytes]) -> list[bytes]:
        """Chunks that start with their only space are encoded in long lines and told apart by
        the tokens that start with a space, short ones without a line feed in lines with line
        feeds between them. The others, and what may end with white space, go one by one."""
        if not chunks:
            return []
        data = np.frombuffer(b"".join(chunks), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))
        starts = np.append(0, ends[:-1])
        last, second, third = (data[np.maximum(ends - k, 0)] for k in (1, 2, 3))
        solid = (last > 0x20) & ((last < 0x80) | ~(maybe_space(second) | maybe_space(third)))
        led = solid & (data[starts] == 0x20) & (np.add.reduceat(data == 0x20, starts, dtype=np.int64) == 1)
        whole = solid & ~led & (ends - starts <= LONGEST_CHUNK) & (len(feed) == 1)
        whole &= np.add.reduceat(data == 0x0A, starts, dtype=np.int64) == 0
        found: list[bytes | None] = [None] * len(chunks)
        for kind, between in ((led, b""), (whole, b"\n")):
            at = np.flatnonzero(kind).tolist()
            for i, ids in zip(at, in_lines([chunks[i] for i in at], between)):
                found[i] = ids
        others = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(others, ids_of([chunks[i].decode() for i in others])):
            found[i] = ids.tobytes()
        return found

    return ChunkEncoder(encode)


def token_pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0
) -> DataFrame:
    """``id_col``, piece, start, length and ids (little-endian uint32) of every document.

    A document is its text's ids and ``end_id``. One longer than ``capacity`` is cut into
    pieces of ``capacity``, of which the first may be shorter; start counts the ids before a
    piece. Null counts as the empty text, which is ``end_id`` alone. The text is encoded
    whole. ``tokenizer`` is a file of the tokenizers library that the driver reads.
    """
    with open(tokenizer, "rb") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())  # one fixed file
    tail = int(end_id).to_bytes(4, "little")
    schema = T.StructType([
        docs.schema[id_col], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(vocabulary.value)
        for batch in batches:
            at, number, start, length, ids, held = [], [], [], [], [], 0

            def made() -> pa.RecordBatch:
                taken = batch.column(0).take(pa.array(at, pa.int64()))
                return pa.RecordBatch.from_arrays(
                    [taken, pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                    names=schema.names,
                )

            for row, encoded in enumerate(encode(batch.column(1))):
                whole = encoded + tail
                total = len(whole) // 4
                ends = range(total % capacity or capacity, total + 1, capacity) if total > capacity else [total]
                begin = 0
                for k, end in enumerate(ends):
                    at.append(row), number.append(k), start.append(begin), length.append(end - begin)
                    ids.append(whole[4 * begin : 4 * end])
                    begin = end
                held += len(whole)
                if len(at) >= BATCH_ROWS or held >= BATCH_BYTES:
                    yield made()
                    at, number, start, length, ids, held = [], [], [], [], [], 0
            if at:
                yield made()

    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(cut, schema)


class Segment(NamedTuple):
    """Pieces of one length, by rank, that go to consecutive sequences, ``each`` to one."""

    length: int
    first_rank: int
    count: int
    first_sequence: int
    each: int
    offset: int


def best_fit_plan(counts: Mapping[int, int], capacity: int) -> list[Segment]:
    """Best-fit decreasing over counts of lengths.

    Lengths go from long to short; each piece goes where it leaves the least room. All
    pieces of a length are alike, and so are sequences with the same content, so whole
    groups of sequences are filled at a time. At most four groups arise per length and a
    sequence holds at most sqrt(2 * capacity) different lengths, so the plan has fewer than
    4 * capacity * sqrt(2 * capacity) segments, however many pieces there are.
    """
    plan: list[Segment] = []
    groups: dict[int, list[tuple[int, int]]] = {}  # room left: (first sequence, sequences)
    rooms: list[int] = []
    sequences = 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in groups:
                insort(rooms, room)
            groups.setdefault(room, []).append((first, n))

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit {capacity}")
        rank, left = 0, counts[length]
        while left:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                first, n = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[i]
            else:
                room, first, n = capacity, sequences, -(-left // (capacity // length))
                sequences += n
            each = room // length
            full, odd = divmod(min(left, n * each), each)
            for start, number, fill in ((first, full, each), (first + full, int(odd > 0), odd)):
                if number:
                    plan.append(Segment(length, rank, number * fill, start, fill, capacity - room))
                    put(room - fill * length, start, number)
                    rank, left = rank + number * fill, left - number * fill
            used = full + (odd > 0)
            put(room, first + used, n - used)
    return plan


def pack(pieces: DataFrame, identity: Sequence[str] = ("doc_id", "piece"), capacity: int = 2048) -> DataFrame:
    """``pieces`` with the sequence and the offset that each one gets.

    ``pieces`` has a length from 1 to ``capacity``; other columns are kept. The histogram of
    lengths (at most ``capacity`` rows) is planned on the driver by best fit; pieces are
    numbered within their length and take the planned slots by joining on that rank.
    Sequences are gapless from 0, and so are the offsets in each. Pieces alike in
    ``identity`` may trade places. No pieces give no rows. Columns named sequence_id,
    offset or rank are replaced.
    """
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset", "rank")]
    stored = store(pieces.select(*columns), "pieces")
    counts = {r["length"]: r["count"] for r in stored.groupBy("length").count().collect()}
    plan = best_fit_plan(counts, capacity)
    # So many buckets that a frequent length is spread over all tasks of a shuffle.
    tasks = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = number_within(stored, "length", list(identity), counts, "rank", min(ROWS_PER_BUCKET, max(64, sum(counts.values()) // tasks)))
    if not plan:
        return ranked.select(*columns, F.lit(None).cast("long").alias("sequence_id"), F.lit(None).cast("long").alias("offset"))
    # As an Arrow table: rows in a list would go through Python workers of their own.
    names = ["length", "first_rank", "count", "first_sequence", "each", "base"]
    slots = stored.sparkSession.createDataFrame(
        pa.table({n: pa.array(column, pa.int64()) for n, column in zip(names, zip(*plan))})
    ).alias("s")
    at = F.col("r.rank") - F.col("s.first_rank")
    joined = ranked.alias("r").join(
        F.broadcast(slots), (F.col("r.length") == F.col("s.length")) & (at >= 0) & (at < F.col("s.count"))
    )
    return joined.select(
        *[f"r.{c}" for c in columns],
        (F.col("s.first_sequence") + F.floor(at / F.col("s.each"))).cast("long").alias("sequence_id"),
        (F.col("s.base") + F.pmod(at, F.col("s.each")) * F.col("r.length")).cast("long").alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of each packed sequence; ``packed`` carries the pieces' ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate("parts", F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", whole.alias("ids"))
