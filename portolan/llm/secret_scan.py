"""Secrets in every version of every file, scanned once per distinct content and rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portolan.operators.lookup import lookup_join
from portolan.sources.folders import path_exists
from portolan.sources.scratch import new_scratch_path, store


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match counts if ``group`` of it has ``least`` characters.

    A change of the pattern needs a new ``version``, so that old contents are scanned again.
    """

    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


BASE_RULES = (
    Rule("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    # Runs of 16 or more: the runs that [0-9a-f]+ finds, without the short ones.
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
MORE_RULES = (
    Rule("forge", r"gh[opsu]_[A-Za-z0-9]{20,}", 0, 24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 28),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 16),
)
RULES = BASE_RULES + MORE_RULES

_FINDING = "struct<kind:string,first:int,last:int>"


def content(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def blob_id(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _findings(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """blob, rule, kind, first, last of each match in ``blobs`` (blob, text, due).

    Matches of a rule are leftmost and do not overlap. Their places come from the lengths
    of the matches and of the pieces between them, summed along the text.
    """

    def matches(rule: Rule) -> Column:
        pieces = F.transform(F.split("text", rule.pattern, -1), F.char_length)
        found = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
        rows = F.arrays_zip(F.slice(pieces, 1, F.size(found)).alias("gap"), found.alias("match"))
        listed = F.transform(
            rows,
            lambda x: F.struct(
                F.lit(rule.key).alias("rule"), F.lit(rule.kind).alias("kind"), x["gap"].alias("gap"),
                F.char_length(x["match"]).alias("length"),
                (F.char_length(F.regexp_extract(x["match"], rule.pattern, rule.group)) >= rule.least).alias("counts"),
            ),
        )
        return F.when(F.array_contains("due", rule.key) & F.col("text").rlike(rule.pattern), listed)

    each = blobs.select("blob", F.posexplode(F.flatten(F.array_compact(F.array(*map(matches, rules))))).alias("at", "m"))
    along = Window.partitionBy("blob", "m.rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("last", F.sum(F.col("m.gap") + F.col("m.length")).over(along).cast("int"))
    return placed.filter("m.counts").select(
        "blob", "m.rule", "m.kind", (F.col("last") - F.col("m.length")).alias("first"), "last"
    )


def scan_versions(
    versions: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES, ledger: str | None = None
) -> DataFrame:
    """Findings per distinct text: blob (SHA-256) and spans, an array of (kind, first, last).

    ``ledger`` is a folder that remembers which contents each version of a rule has seen
    and what it found; without one, a new folder under the checkpoint folder is used. Only
    pairs of content and rule version that the ledger lacks are scanned; their findings are
    appended to it, then the pairs are marked as seen. A run that dies between the two
    leaves findings that the next run writes again; equal findings count once. Places are
    code points, the end exclusive. Spans are ordered by start, then as ``rules`` are
    listed. Contents without findings have no row. Null counts as the empty text.
    """
    spark = versions.sparkSession
    ledger = ledger or new_scratch_path(spark, "secret-ledger")
    keys = [r.key for r in rules]
    text = content(text_col)
    every = F.array(*map(F.lit, keys))
    marks = versions.select(blob_id(text).alias("blob")).distinct().withColumn("rules", every)
    if path_exists(spark, f"{ledger}/seen"):
        seen = spark.read.parquet(f"{ledger}/seen").groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("done"))
        none = F.lit([]).cast("array<string>")
        marks = marks.join(seen, "blob", "left").select("blob", F.array_except(every, F.coalesce("done", none)).alias("rules"))
        marks = marks.filter(F.size("rules") > 0)
    marks = store(marks, "secret-marks")
    blobs = (
        versions.select(blob_id(text).alias("blob"), text.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
        .join(marks.withColumnRenamed("rules", "due"), "blob")
    )
    _findings(blobs, rules).write.mode("append").parquet(f"{ledger}/findings")
    marks.write.mode("append").parquet(f"{ledger}/seen")

    order = F.array_position(every, F.col("rule")).cast("int")
    found = (
        spark.read.parquet(f"{ledger}/findings").filter(F.col("rule").isin(keys)).distinct()
        .groupBy("blob")
        .agg(F.array_sort(F.collect_list(F.struct("first", order.alias("order"), "kind", "last"))).alias("all"))
    )
    spans = F.transform("all", lambda x: F.struct(x["kind"].alias("kind"), x["first"].alias("first"), x["last"].alias("last")))
    return found.select("blob", spans.alias("spans"))


def find_secrets(
    docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES, ledger: str | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` (or the columns ``keep`` of it) with the spans found in each row's text.

    Every path that ever held a content gets the content's findings; rows without any have
    an empty array. Columns of ``docs`` named ``spans`` or ``_blob`` are replaced. Null
    texts are empty. Repeated rows are scanned as one content and each return; an empty
    table gives no rows.
    """
    held = store(scan_versions(docs, text_col, rules, ledger), "secret-spans")
    kept = [c for c in (keep or docs.columns) if c not in ("spans", "_blob")]
    rows = docs.select(*kept, blob_id(content(text_col)).alias("_blob"))
    # Few contents hold secrets: their spans are broadcast if measured to be small, and
    # the documents then stay where they are.
    joined = lookup_join(rows, held.withColumnRenamed("blob", "_blob"), ["_blob"], "left")
    return joined.select(*kept, F.coalesce("spans", F.lit([]).cast(f"array<{_FINDING}>")).alias("spans"))


def joined_spans(spans: Column, kinds: Sequence[str] | None = None) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    chosen = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(list(kinds)))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["first"], s["last"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with each stretch of overlapping spans replaced by ``mark``; null stays null."""
    step = F.struct(F.lit(0).alias("at"), F.lit([]).cast("array<string>").alias("parts"))

    def add(done: Column, s: Column) -> Column:
        fresh = s["first"] >= done["at"]
        before = F.substring(text, done["at"] + 1, s["first"] - done["at"])
        return F.struct(
            F.greatest(done["at"], s["last"]).alias("at"),
            F.when(fresh, F.concat(done["parts"], F.array(before, F.lit(mark)))).otherwise(done["parts"]).alias("parts"),
        )

    rest = lambda done: F.concat(F.array_join(done["parts"], ""), F.substring(text, done["at"] + 1, F.char_length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, step, add, rest))


