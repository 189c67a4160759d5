"""Language of a text from its words, backing off to character n-grams for unseen words."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan.llm.kept import kept
from portolan.sources.scratch import store

UNKNOWN = "und"
LONGEST_GRAM = 5
# The model is fitted on about this many documents of each language, the first by hash of
# their id; a parameter of :func:`fit`.
DOCUMENTS_PER_LANGUAGE = 4_000
# Entries of a table (words, or n-grams of one length): the most frequent ones of each
# language up to its part of MOST_ENTRIES, and fewer where there are so many languages that
# their product would exceed MOST_CELLS, but LEAST_ENTRIES of each language at least. With
# that the model takes some 100 MB up to a few hundred languages, and grows slowly after.
MOST_ENTRIES, MOST_CELLS, LEAST_ENTRIES = 50_000, 2_000_000, 24
SMOOTHING = 0.5
# Tasks that cut the words of the sample into n-grams; the sample is bounded, and so are they.
GRAM_TASKS = 32
# Numbers kept as evidence of words met, and characters of texts that are read at a time.
MOST_CACHED, GROUP = 800_000, 1_000_000
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams_of(word: str, size: int) -> list[str]:
    """n-grams of the word between marks of its ends."""
    marked = f"<{word}>"
    return [marked[i : i + size] for i in range(len(marked) - size + 1)]


class Model:
    """``tables[0]`` has words, ``tables[n]`` n-grams; a row of ``logs`` per entry."""

    def __init__(self, languages: list[str], tables: list[dict[str, int]], logs: np.ndarray):
        self.languages, self.tables, self.logs = languages, tables, logs
        self._forget()

    def _forget(self) -> None:
        self.seen: dict[str, int] = {}
        self.vectors = np.zeros((0, len(self.languages)))

    def entries(self, word: str) -> list[int]:
        """What tells of a word: itself if known, else its known n-grams of the greatest
        length that has any."""
        at = self.tables[0].get(word)
        if at is not None:
            return [at]
        for size in range(LONGEST_GRAM, 0, -1):
            get = self.tables[size].get
            known = [i for g in grams_of(word, size) if (i := get(g)) is not None]
            if known:
                return known
        return []

    def look_up(self, words: set[str]) -> None:
        """Note the log frequencies per language of words not met before: the mean over
        their entries, zeros without any."""
        new = list(words.difference(self.seen))
        entries = [self.entries(w) for w in new]
        sizes = np.fromiter(map(len, entries), dtype=np.int64, count=len(new))
        found = np.zeros((len(new), len(self.languages)))
        if sizes.any():
            flat = np.fromiter(chain.from_iterable(entries), dtype=np.int64, count=int(sizes.sum()))
            some = sizes > 0
            starts = (np.cumsum(sizes) - sizes)[some]
            found[some] = np.add.reduceat(self.logs[flat], starts, axis=0) / sizes[some, None]
        self.seen.update(zip(new, range(len(self.seen), len(self.seen) + len(new))))
        self.vectors = np.concatenate([self.vectors, found])

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The language of each text and its share of the evidence.

        The words' evidence is added up and divided by the root of their number, as words
        of one text do not tell independently. Ties go to the first language by name.
        """
        words = [words_of(t) if t else [] for t in texts]
        if len(self.seen) * len(self.languages) > MOST_CACHED:
            self._forget()
        if self.languages:
            self.look_up(set(chain.from_iterable(words)))
        found = []
        for text, own in zip(texts, words):
            if not text or not self.languages or not any(map(str.isalpha, text)):
                found.append((UNKNOWN, 0.0))
                continue
            at = np.fromiter(map(self.seen.__getitem__, own), dtype=np.int64, count=len(own))
            total = self.vectors[at].sum(axis=0) / np.sqrt(max(1, len(own)))
            odds = np.exp(total - total.max())
            best = int(odds.argmax())
            found.append((self.languages[best], float(odds[best] / odds.sum())))
        return found


def _grouped(texts: Iterable[str | None]) -> Iterator[list[str | None]]:
    """Texts in runs of about GROUP characters."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t or "")
        if size >= GROUP or len(group) >= 1000:
            yield group
            group, size = [], 0
    if group:
        yield group


def most_frequent(every: DataFrame, most: int) -> DataFrame:
    """size and item of the ``most`` most frequent entries of each language and size (those
    of fewer, all), ties by the entry itself.

    Each language is ranked on its own, so a rare one keeps its words; a task drops what it
    need not rank before the shuffle.
    """
    place = F.row_number().over(Window.partitionBy("size", "lang").orderBy(F.desc("n"), "item"))
    ranked = every.withColumn("place", place).filter(F.col("place") <= most)
    return ranked.select("size", "item").distinct()


def fit(
    docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    documents_per_language: int = DOCUMENTS_PER_LANGUAGE,
) -> Model:
    """Count words and n-grams of a bounded sample of the labelled rows where ``learn`` holds.

    Every language that a row is labelled with is learned.
    """
    labelled = docs.filter(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_000)).alias("draw"),
    )
    rows = labelled.groupBy("lang").count().collect()
    languages = sorted(r["lang"] for r in rows)
    if not languages:
        return Model([], [{} for _ in range(LONGEST_GRAM + 1)], np.zeros((0, 0)))
    share = {r["lang"]: min(1_000_000, -(-documents_per_language * 1_000_000 // r["count"])) for r in rows}
    shares = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])
    sample = labelled.filter(F.col("draw") < F.element_at(shares, F.col("lang")))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found.update((lang, w) for w in words_of(text.as_py()))
            if found:
                langs, words = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(langs), pa.array(words), pa.array(list(found.values()))], names=["lang", "item", "n"])

    schema = "lang string, item string, n long"
    words = store(
        sample.select("lang", "text").mapInArrow(count_words, schema).groupBy("lang", "item").agg(F.sum("n").alias("n")),
        "language-words",
    )

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                for size in range(1, LONGEST_GRAM + 1):
                    for g in grams_of(word, size):
                        found[lang, g, size] += n
            if found:
                langs, items, sizes = zip(*found)
                columns = [pa.array(langs), pa.array(items), pa.array(list(found.values())), pa.array(sizes, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "item", "n", "size"])

    grams = words.repartition(GRAM_TASKS).mapInArrow(count_grams, schema + ", size int").groupBy("size", "lang", "item").agg(F.sum("n").alias("n"))
    every = store(words.withColumn("size", F.lit(0)).select("size", "lang", "item", "n").unionByName(grams), "language-counts")
    totals = {(r["size"], r["lang"]): r["n"] for r in every.groupBy("size", "lang").agg(F.sum("n").alias("n")).collect()}
    items = every.groupBy("size", "item").agg(
        F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by")
    )
    each = max(LEAST_ENTRIES, min(MOST_ENTRIES, MOST_CELLS // len(languages)) // len(languages))
    # A word seen once in all tells less than its n-grams do.
    chosen = most_frequent(every.join(items.filter((F.col("size") > 0) | (F.col("total") > 1)).select("size", "item"), ["size", "item"]), each)
    known = items.join(chosen, ["size", "item"]).collect()
    most = each * len(languages)
    tables: list[dict[str, int]] = [{} for _ in range(LONGEST_GRAM + 1)]
    seen = np.zeros((len(known), len(languages)), dtype=np.float32)
    number = {lang: i for i, lang in enumerate(languages)}
    per_size = np.array([[totals.get((size, lang), 0) for lang in languages] for size in range(LONGEST_GRAM + 1)])
    for at, r in enumerate(known):
        tables[r["size"]][r["item"]] = at
        for lang, n in r["by"].items():
            seen[at, number[lang]] = n
    sizes = np.array([r["size"] for r in known], dtype=int)
    logs = np.log(seen + np.float32(SMOOTHING)) - np.log(per_size + SMOOTHING * most).astype(np.float32)[sizes]
    return Model(languages, tables, logs)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (by default ``id_col``), lang_pred and score of every row, from its whole text."""
    keep = [c for c in (keep or [id_col]) if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.tables, model.logs))  # see MOST_CELLS
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    names = schema.names

    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = kept(name, lambda: Model(*shared.value))  # and the words it has met, for later tasks
        for batch in batches:
            found = [x for texts in _grouped(t.as_py() for t in batch.column(len(keep))) for x in own.predict(texts)]
            langs, scores = pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], langs, scores], names=names)

    return docs.select(*keep, F.col(text_col).cast("string").alias("_text")).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Whether a row is kept from learning: by the CRC-32 of its id as text; null is not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def detect_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """Learn languages from the rows that are not held out and predict that of every row.

    Returns ``keep`` (by default ``id_col``), held_out, lang_pred and score (0 to 1). Known words count by their log
    frequency per language; others by their longest known n-grams. lang_pred is ``und``
    with score 0 if the text is null, has no letter, or no language was learned. A text
    whose letters are all unknown gets the first language by name, at equal shares.
    The label, source and id of a row are no input of its prediction. Of languages that tie
    the first by name is taken. Repeated rows count as often as they occur and give equal
    results; an empty table gives no rows. Columns named as the results are replaced, and
    others, whatever their names, are read only if they are in ``keep``.
    """
    model = fit(docs, ~held_out(id_col), id_col, text_col, lang_col)
    keep = [c for c in (keep or [id_col]) if c != "held_out"]
    found = identify(docs, model, id_col, text_col, keep)
    return found.select(*keep, held_out(id_col).alias("held_out"), "lang_pred", "score")
