"""One query per operator over its whole table, with SQL where SQL states the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.checks.registry import Query, table
from portolan.llm import byte_bpe, hard_negatives, language, neighbours, packing, page_text, prefix_trie, quality_rules, secret_scan, sharding, simhash, site_quality, suffix_dedup

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


@query()
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.weak_supervision(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality",
    )


def _secrets_sql() -> str:
    def places(order: int, rule: secret_scan.Rule) -> str:
        p = rule.pattern.replace("'", "''")
        return (
            f"SELECT row_id, {order} AS ord, '{rule.kind}' AS kind, {rule.least} AS least,"
            f" unnest(regexp_extract_all(t, '{p}')) AS m,"
            f" unnest(regexp_extract_all(t, '{p}', {rule.group})) AS g,"
            f" unnest(string_split_regex(t, '{p}')[:len(regexp_extract_all(t, '{p}'))]) AS gap,"
            f" generate_subscripts(regexp_extract_all(t, '{p}'), 1) AS i FROM docs"
        )

    found = " UNION ALL ".join(places(i, r) for i, r in enumerate(secret_scan.RULES))
    base = ", ".join(f"'{r.kind}'" for r in secret_scan.BASE_RULES)
    spell = "kind || ':' || (last - length(m)) || ':' || last"
    return f"""
        WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t FROM documents),
        found AS ({found}),
        placed AS (
            SELECT *, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY row_id, kind ORDER BY i) AS BIGINT) AS last
            FROM found),
        spans AS (
            SELECT row_id,
                count(*) FILTER (WHERE kind = 'assign') AS n_assign,
                count(*) FILTER (WHERE kind = 'access') AS n_access,
                count(*) FILTER (WHERE kind = 'hex') AS n_hex,
                string_agg({spell}, ',' ORDER BY last - length(m), ord) FILTER (WHERE kind IN ({base})) AS base,
                string_agg({spell}, ',' ORDER BY last - length(m), ord) AS spans
            FROM placed WHERE length(g) >= least GROUP BY row_id)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
            coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM docs LEFT JOIN spans USING (row_id)"""


@query(_secrets_sql())
def op9_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, folder, "documents"), keep=["doc_id"])
    spans = F.col("spans")
    base = secret_scan.joined_spans(spans, [r.kind for r in secret_scan.BASE_RULES])
    return found.select(
        "doc_id",
        *[secret_scan.count_kind(spans, k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(base, 256).alias("base_sha256"),
        secret_scan.joined_spans(spans).alias("spans"),
    )


@query()
def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents"), shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.token_pieces(table(spark, folder, "documents"), tokenizer, capacity=2048)
    return packing.pack(
        pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32")), capacity=2048
    )


@query()
def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = byte_bpe.encode_texts(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.detect_languages(table(spark, folder, "documents"))


@query()
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, bits=2)


@query()
def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    texts = page_text.extract_text(table(spark, folder, "pages"))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query()
def op4_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, folder, "embeddings"), F.col("id") % 20 == 0, k=20)


@query()
def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return site_quality.classify_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


_NEGATIVES_SQL = """
    WITH r AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l,
            list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (
        SELECT a.vec_id AS a, b.vec_id AS b, a.l = b.l AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS s
        FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    positives AS (SELECT * FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5)
    SELECT p.a AS anchor_id, p.b AS positive_id,
        CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b) AS INTEGER) AS rank,
        n.b AS negative_id, p.s AS positive_score, n.s AS negative_score
    FROM positives p JOIN pairs n ON n.a = p.a AND NOT n.same AND 80 * p.s <= 100 * n.s AND 100 * n.s <= 100 * p.s
    QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b) <= 5"""


@query(_NEGATIVES_SQL)
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


# CRC-32 bit by bit over the decimal digits, which SQL has no function for.
_CRC32 = """xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, len({0}) + 1),
            lambda i: [ord({0}[i])::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
        lambda c, b: CASE WHEN xor(c, b) & 1 = 1 THEN xor(xor(c, b) >> 1, 3988292384) ELSE xor(c, b) >> 1 END))"""

_TRIE_SQL = f"""
    WITH turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p
        FROM conversations WHERE conv_id IS NOT NULL),
    own AS (
        SELECT conv_id, conv_id - conv_id % 100 AS base, CAST(conv_id AS VARCHAR) AS digits,
            list(struct_pack(r := role, t := text) ORDER BY p) AS s FROM turns GROUP BY conv_id),
    drawn AS (SELECT *, {_CRC32.format("digits")} % 6 AS h FROM own),
    rebuilt AS (
        SELECT d.conv_id, list_concat(coalesce(b.s[:d.h], []), d.s[d.h + 1:]) AS s
        FROM drawn d LEFT JOIN own b ON b.conv_id = d.base),
    nodes AS (
        SELECT s[:d] AS s, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
            string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(rebuilt.s) = d) AS ends
        FROM rebuilt, unnest(range(0, len(rebuilt.s) + 1)) AS r(d) GROUP BY 1, 2),
    weighted AS (
        SELECT n.*, p.conv_id AS parent_conv_id,
            (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.s[:n.depth] = n.s) AS n_children,
            CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * length(n.s[-1].t) END AS saved
        FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.s = n.s[:n.depth - 1])
    SELECT v.conv_id, v.depth, any_value(v.parent_conv_id) AS parent_conv_id, any_value(v.n_convs) AS n_convs,
        any_value(v.n_children) AS n_children, count(*) FILTER (WHERE w.n_children = 0) AS n_leaves,
        CAST(sum(w.saved) AS BIGINT) AS saved_tokens, any_value(sha256(coalesce(v.ends, ''))) AS ends_sha256
    FROM weighted v JOIN weighted w ON w.depth >= v.depth AND w.s[:v.depth] = v.s
    GROUP BY v.conv_id, v.depth"""


@query(_TRIE_SQL)
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = prefix_trie.conversation_turns(table(spark, folder, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.with_shared_beginnings(turns))


# Bytes are spelt in hexadecimal; pieces of 64 bytes keep the windows' offsets small.
_REPEATS_SQL = """
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    pieces AS (
        SELECT r, doc_id, p, substr(h, 2 * p + 1, 226) AS x FROM d, unnest(range(0, CAST(length(h) / 2 AS BIGINT), 64)) t(p)),
    windows AS (
        SELECT r, doc_id, p + i AS s, substr(x, 2 * i + 1, 100) AS w
        FROM pieces, unnest(range(0, 64)) u(i) WHERE 2 * i + 100 <= length(x)),
    firsts AS (SELECT w, min(doc_id) AS m FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
    dups AS (SELECT DISTINCT r, s FROM windows JOIN firsts USING (w) WHERE doc_id > m),
    marked AS (SELECT *, CASE WHEN s <= lag(s) OVER (PARTITION BY r ORDER BY s) + 50 THEN 0 ELSE 1 END AS new FROM dups),
    numbered AS (SELECT *, sum(new) OVER (PARTITION BY r ORDER BY s) AS k FROM marked),
    spans AS (SELECT r, k, min(s) AS a, max(s) + 50 AS b FROM numbered GROUP BY r, k),
    cut AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS z FROM spans),
    kept AS (
        SELECT r, count(*) AS n, sum(b - a) AS gone, max(b) AS tail,
            string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS body
        FROM cut JOIN d USING (r) GROUP BY r)
    SELECT doc_id, CAST(length(h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
        CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
        sha256(unhex(coalesce(body, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
    FROM d LEFT JOIN kept USING (r)"""


@query(_REPEATS_SQL)
def op13_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, folder, "documents"), least=50)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
