from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from portolan.llm import secret_scan as S


def plain(text, rules=S.RULES):
    found = []
    for order, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), order, rule.kind, m.end()))
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))


def texts():
    draw = random.Random(8)
    parts = ["password", "TOKEN", "Secret", "api_key", "apikey", "=", ":", " ", "'", '"', "AKIA", "ABCDEFGHIJKLMNOP", "AKIAABCDEFGHIJ1234", "0123456789abcdef",
             "deadbeef", "x", "\n", "é", "\U0001f600", "abcdefghijkl", "ghp_" + "a1" * 12, "-----BEGIN RSA PRIVATE KEY-----", "eyJabcdefgh.abcdefgh.abcdefgh"]
    return ["".join(draw.choices(parts, k=draw.randint(0, 40))) for _ in range(250)]


def test_spans_equal_plain_python(documents):
    rows = [(i, t) for i, t in enumerate(texts())] + [(900, None), (901, ""), (902, "token=" + "z" * 300000), (903, "ab1" * 7), (903, "ab1" * 7), (None, "secret=abcdefghijklmn"), (904, "deadbeefdeadbeef " * 3000)]
    found = S.find_secrets(documents(rows), keep=["doc_id"]).select("doc_id", S.joined_spans(F.col("spans")).alias("s")).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["s"]) for r in found) == sorted((-1 if i is None else i, plain(t or "")) for i, t in rows)
    assert S.find_secrets(documents([])).count() == 0


def test_redacted(documents):
    rows = list(enumerate(texts())) + [(900, None), (901, "")]
    found = S.find_secrets(documents(rows)).select("doc_id", "text", S.redacted(F.col("text"), F.col("spans")).alias("clean"))
    for r in found.collect():
        want, at = "", 0
        spans = sorted((int(s), int(e)) for _, s, e in (x.split(":") for x in plain(r["text"] or "").split(",") if x))
        for s, e in spans:
            if s >= at:
                want += r["text"][at:s] + "[secret]"
            at = max(at, e)
        assert r["clean"] == (None if r["text"] is None else want + r["text"][at:])


def test_ledger_scans_only_what_is_new(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    table = lambda rows: spark.createDataFrame(rows, "path string, text string")
    first = table([("a@1", "AKIA" + "B" * 16), ("b@1", "nothing"), ("c@1", "AKIA" + "B" * 16)])
    assert S.find_secrets(first, ledger=ledger).filter("size(spans) = 1").count() == 2
    seen = spark.read.parquet(f"{ledger}/seen")
    assert seen.count() == 2
    both = first.unionByName(table([("a@2", "password = abcdefghijklmnop")]))
    assert S.find_secrets(both, ledger=ledger).filter("size(spans) = 1").count() == 3
    assert spark.read.parquet(f"{ledger}/seen").count() == 3  # one content more
    newer = [*S.RULES[:2], S.Rule("hex", "[0-9a-f]{16,}", 0, 16, version=2)]
    S.find_secrets(both, rules=newer, ledger=ledger)
    marks = spark.read.parquet(f"{ledger}/seen").select(F.explode("rules").alias("r")).groupBy("r").count().collect()
    assert {r["r"]: r["count"] for r in marks}["hex@2"] == 3 and {r["r"]: r["count"] for r in marks}["assign@1"] == 3
    S.find_secrets(both, ledger=ledger)
    assert spark.read.parquet(f"{ledger}/findings").distinct().count() == spark.read.parquet(f"{ledger}/findings").count()
