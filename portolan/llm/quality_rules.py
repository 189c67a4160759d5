"""Quality by weak supervision: rules vote or abstain, and their accuracies are estimated."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan.sources.scratch import store

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
            "n_upper", "n_marks", "n_stops", "n_stutters", "n_symbol_runs", "n_other_chars")
_SYMBOL_RUN = re.compile(rb"[#*$%&|<>]+")
_LETTERS_AND_SPACES = bytes(c for c in range(256) if c >= 128 or chr(c).isalpha() or chr(c) in SPACES)


@dataclass(frozen=True)
class VotingRule:
    """Says bad where ``bad`` holds, else good where ``good`` holds, else nothing."""

    name: str
    bad: str
    good: str

    def vote(self) -> Column:
        return F.when(F.expr(self.bad), -1).when(F.expr(self.good), 1).otherwise(0)


VOTING_RULES = (
    VotingRule("length", "n_words < 20", "n_words >= 40"),
    VotingRule("word_length", "word_chars < 2.5 * n_words OR word_chars > 15 * n_words", "word_chars <= 10 * n_words"),
    VotingRule("symbols", "n_symbols > 0.1 * n_words", "n_symbols <= 0.01 * n_words"),
    VotingRule("symbol_words", "n_symbol_runs > 0.08 * n_words", "n_symbol_runs <= 0.01 * n_words"),
    VotingRule("letters", "n_other_chars > 0.12 * word_chars", "n_other_chars <= 0.08 * word_chars"),
    VotingRule("capitals", "n_upper > 0.3 * word_chars", "n_upper <= 0.15 * word_chars"),
    VotingRule("marks", "n_marks > 0.2 * n_words", "n_marks <= 0.05 * n_words"),
    VotingRule("sentences", "n_words >= 40 AND 200 * n_stops < n_words", "60 * n_stops >= n_words"),
    VotingRule("lines", "n_dup_lines > 0.3 * n_lines", "n_lines > 1 AND n_dup_lines = 0"),
    VotingRule("windows", "n_repeat_words > 0.3 * n_words", "n_repeat_words <= 0.1 * n_words"),
    VotingRule("stutters", "n_stutters > 0.1 * n_words", "n_stutters <= 0.02 * n_words"),
)
# A rule starts as seldom wrong on good documents and as a detector of few of the bad ones,
# so that at the start two rules that say bad outweigh the others. This share of all
# documents, added as if judged beforehand, keeps a rule that rarely votes near its start.
PRIOR_SHARE = 0.002
START_GOOD, START_RIGHT_GOOD, START_RIGHT_BAD = 0.8, 0.98, 0.3


def repeated_words(words: Sequence[bytes], window: int = WINDOW) -> int:
    """Words in windows of ``window`` (a power of two) words that the text holds twice or more."""
    if len(words) <= window:
        return 0
    ids = pd.factorize(np.array(words, dtype=object))[0].astype(np.int64)
    span = 1
    while span < window:  # ids of runs of span words become ids of runs of twice as many
        ids = pd.factorize(ids[:-span] * (int(ids.max()) + 1) + ids[span:])[0].astype(np.int64)
        span *= 2
    often = np.flatnonzero(np.bincount(ids)[ids] > 1)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, often, 1)
    np.add.at(edge, often + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def measure(text: str) -> tuple[int, ...]:
    """MEASURES of one whole text."""
    raw = text.encode()
    words = raw.split()  # bytes split at the six ASCII spaces; str would at more
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    low = text.lower()
    if len(low) == len(text):
        upper = sum(a != b for a, b in zip(text, low)) if text != low else 0
    else:
        upper = sum(map(str.isupper, text))
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        upper,
        sum(map(text.count, "!?")),
        sum(map(text.count, ".!?")),
        sum(map(eq, words[1:], words)),
        len(_SYMBOL_RUN.findall(raw)),
        len(raw.translate(None, _LETTERS_AND_SPACES)),
    )


def measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id_col`` and the MEASURES of each row's text; null counts as empty."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = np.array([measure(t.as_py() or "") for t in batch.column(1)], dtype=np.int64)
            columns = found.reshape(batch.num_rows, len(MEASURES)).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names=[id_col, *MEASURES])

    schema = T.StructType([docs.schema[id_col], *(T.StructField(m, T.LongType()) for m in MEASURES)])
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(batches, schema)


def fit_votes(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, dict]:
    """Posterior of good for each pattern of votes, by expectation maximisation.

    ``votes`` (patterns, rules) holds -1, 0 and 1; ``counts`` has the documents of each
    pattern. Given a document's true class, rules that vote are taken as independent; each
    rule has an accuracy on good and one on bad documents, and abstaining says nothing.
    """
    good_votes, bad_votes = (votes > 0).astype(float), (votes < 0).astype(float)
    total = counts.sum()
    extra = PRIOR_SHARE * total
    right_good = np.full(votes.shape[1], START_RIGHT_GOOD)
    right_bad = np.full(votes.shape[1], START_RIGHT_BAD)
    good = START_GOOD
    for _ in range(rounds):
        log_good = np.log(good) + good_votes @ np.log(right_good) + bad_votes @ np.log(1 - right_good)
        log_bad = np.log(1 - good) + bad_votes @ np.log(right_bad) + good_votes @ np.log(1 - right_bad)
        posterior = 1 / (1 + np.exp(np.clip(log_bad - log_good, -700, 700)))
        w_good, w_bad = counts * posterior, counts * (1 - posterior)
        good = (w_good.sum() + extra * START_GOOD) / (total + extra)
        voted = good_votes + bad_votes
        # An accuracy on good documents may not fall below a coin's: this names the classes.
        right_good = np.clip((w_good @ good_votes + extra * START_RIGHT_GOOD) / (w_good @ voted + extra), 0.5, 1 - 1e-4)
        right_bad = np.clip((w_bad @ bad_votes + extra * START_RIGHT_BAD) / (w_bad @ voted + extra), 1e-3, 1 - 1e-3)
    return posterior, {"good": good, "right_on_good": right_good, "right_on_bad": right_bad}


def weak_supervision(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    rules: Sequence[VotingRule] = VOTING_RULES, threshold: float = 0.5,
) -> DataFrame:
    """Each document's measures, votes and posterior probability of being good.

    Returns ``id_col``, the MEASURES, votes (one of -1, 0, 1 per rule), quality (the
    posterior), base_failed (fewer than 20 words, or over 30 % of them in repeated
    windows) and kept (not base_failed and quality at or above ``threshold``).

    The texts are read once; the measures are stored. Documents with equal votes have equal
    posteriors, so expectation maximisation runs over the counts of vote patterns: at most
    3 ** len(rules) rows reach the driver, whatever the number of documents, and no
    document is left out of the estimate. Null and empty texts have no words and fail.
    Repeated rows count and return as often as they occur; an empty table gives no rows.
    Columns other than the two named are not read.
    """
    if len(rules) > 12:
        raise ValueError("vote patterns grow as 3 ** rules; at most 12 rules")
    rows = store(measured(docs, id_col, text_col), "quality-measures")
    voted = rows.withColumn("votes", F.array(*[r.vote() for r in rules]))
    patterns = voted.groupBy("votes").count().collect()
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    if patterns:
        posterior, _ = fit_votes(np.array([p["votes"] for p in patterns]), np.array([p["count"] for p in patterns], dtype=float))
        table = [(list(p["votes"]), float(q)) for p, q in zip(patterns, posterior)]
        judged = rows.sparkSession.createDataFrame(table, "votes array<int>, quality double")
        voted = voted.join(F.broadcast(judged), "votes")
    else:
        voted = voted.withColumn("quality", F.lit(None).cast("double"))
    return voted.select(
        id_col, *MEASURES, "votes", "quality", failed.alias("base_failed"),
        (~failed & (F.col("quality") >= threshold)).alias("kept"),
    )
