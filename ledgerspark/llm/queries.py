"""The registered queries of this subpackage, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import (
    bpe,
    conversation_trie,
    embedding_whitening,
    license_scan,
    minhash_dedup,
    quality_cnn,
    quality_rules,
    scaled_sketch,
    secret_scan,
    simhash_dedup,
    source_mix,
    token_counts,
    url_filter,
)
from ledgerspark.session import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


@query("op1_secret_scan")
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.fitted(docs))


@query("op2_bpe")
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


#: Words, lines and the measurements of the ledger, per document number ``r`` (row of the table).
LEDGER_SQL = r"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    w AS (
        SELECT r, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
            list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM docs
    ),
    tok AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
    win AS (
        SELECT r, i, word, lead(word) OVER s AS w2, lead(word, 2) OVER s AS w3
        FROM tok WINDOW s AS (PARTITION BY r ORDER BY i)
    ),
    hit AS (
        SELECT r, i, w3 IS NOT NULL AND count(*) OVER (PARTITION BY r, word, w2, w3) > 1 AS twice FROM win
    ),
    cover AS (
        SELECT r, twice OR coalesce(lag(twice) OVER s, false) OR coalesce(lag(twice, 2) OVER s, false) AS covered
        FROM hit WINDOW s AS (PARTITION BY r ORDER BY i)
    ),
    repeats AS (SELECT r, count(*) FILTER (covered) AS n FROM cover GROUP BY r),
    measured AS (
        SELECT d.doc_id,
            len(w.words)::BIGINT AS n_words,
            coalesce(list_sum(list_transform(w.words, lambda x: length(x))), 0)::BIGINT AS word_chars,
            length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
            len(w.lines)::BIGINT AS n_lines,
            (len(w.lines) - len(list_distinct(w.lines)))::BIGINT AS n_dup_lines,
            coalesce(p.n, 0)::BIGINT AS n_repeat_words,
            len(list_filter(w.words, lambda x: suffix(x, '!!')))::BIGINT AS n_shouts
        FROM docs d JOIN w USING (r) LEFT JOIN repeats p USING (r)
    ),
    ledger AS (
        SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
            + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
            + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
            + CASE WHEN 10 * n_shouts > 5 * n_words THEN 8 ELSE 0 END
            + CASE WHEN 10 * n_dup_lines > 5 * n_lines THEN 16 ELSE 0 END
            + CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END
            + CASE WHEN word_chars > 40 * n_words THEN 64 ELSE 0 END)::BIGINT AS failed
        FROM measured
    )
"""


@query(
    "op3_quality_rules",
    LEDGER_SQL
    + """SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
            (failed & 3) <> 0 AS base_failed, (failed & 15) = 0 AS kept, failed
         FROM ledger""",
)
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality_rules.rejected("v1-base").alias("base_failed"), (~quality_rules.rejected()).alias("kept"), "failed",
    )


@query(
    "quality_rule_ablation",
    LEDGER_SQL
    + """, policies AS (
            SELECT * FROM (VALUES ('v1-base', 3), ('v2-junk', 15), ('v3-strict', 127)) AS p (policy, mask)
        ), rules AS (
            SELECT * FROM (VALUES ('few_words', 1), ('repeated_words', 2), ('symbols', 4), ('shouting', 8),
                ('repeated_lines', 16), ('short_words', 32), ('long_words', 64)) AS r (rule, bit)
        )
        SELECT policy, rule,
            count(*) FILTER ((failed & bit) <> 0)::BIGINT AS fail,
            count(*) FILTER ((failed & mask) = bit)::BIGINT AS only_this,
            count(*) FILTER ((failed & mask) <> 0)::BIGINT AS removed_by_policy,
            count(*)::BIGINT AS documents
        FROM ledger, policies, rules WHERE (mask & bit) <> 0 GROUP BY policy, rule""",
)
def quality_rule_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.ablation(quality_rules.ledger(table(spark, sf_dir, "documents")))


@query("op4_license_scan")
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"), license_scan.known_licenses(spark))


@query("op5_quality_cnn")
def op5_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_cnn.score(docs, quality_cnn.fit(docs, table(spark, sf_dir, "labels")))


URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


@query(
    "op6_url_filter",
    r"""WITH rules AS (
            SELECT * FROM (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
                ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
            ) AS r (verdict, rule_host, rule_path)
        ), split AS (
            SELECT row_number() OVER () AS r, page_id,
                CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
            FROM pages
        ), named AS (
            SELECT r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM split
        ), best AS (
            SELECT r, arg_max({'rule': rule_host || rule_path, 'verdict': verdict}, length(rule_host || rule_path)) AS b
            FROM named JOIN rules
                ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY r
        )
        SELECT page_id, host, path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict
        FROM named LEFT JOIN best USING (r)""",
)
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.rule_table(spark, URL_RULES))


@query("op7_simhash_dedup")
def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query("op8_scaled_sketch")
def op8_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled_sketch.edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.document_token_counts(table(spark, sf_dir, "documents")).select("doc_id", "n_tokens")


@query("op10_source_mix")
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = source_mix.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "slot")


@query(
    "op11_conversation_trie",
    """WITH steps AS (
            SELECT list_transform(range(256), lambda b: list_reduce(range(8),
                lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, b)) AS step
        ), turns AS (
            SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS nth FROM turns
        ), sizes AS (SELECT c, count(*) AS own FROM turns GROUP BY c),
        hashed AS (
            SELECT c, own, c - c % 20 AS b, xor(4294967295, list_reduce(list_transform(range(length(c::VARCHAR)), lambda i: ascii(substr(c::VARCHAR, i + 1, 1))::BIGINT),
                lambda crc, byte: xor(crc >> 8, step[(xor(crc, byte) & 255) + 1]), 4294967295)) % 4 AS h
            FROM sizes, steps
        ), named AS (SELECT h.c, h.b, h.h, least(h.h, coalesce(s.own, 0)) AS taken FROM hashed h LEFT JOIN sizes s ON s.c = h.b),
        rebuilt AS (
            SELECT n.c, t.nth AS d, t.role, t.text FROM named n JOIN ranked t ON t.c = n.b AND t.nth <= n.h
            UNION ALL SELECT n.c, t.nth - n.h + n.taken, t.role, t.text FROM named n JOIN ranked t ON t.c = n.c AND t.nth > n.h
        ), begun AS (
            SELECT c, d, text, list({'r': role, 't': text}) OVER (PARTITION BY c ORDER BY d) AS p,
                d = max(d) OVER (PARTITION BY c) AS ended
            FROM rebuilt
        ), nodes AS (
            SELECT p, d, min(c) AS conv_id, count(*) AS n, any_value(len(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> ''))) AS words,
                string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ended) AS ends
            FROM begun GROUP BY p, d
            UNION ALL SELECT [], 0, min(c), count(*), 0, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (c NOT IN (SELECT c FROM rebuilt))
            FROM named HAVING count(*) > 0
        ), family AS (
            SELECT n.p, n.d, u.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes x WHERE x.d = n.d + 1 AND x.p[1:n.d] = n.p) AS n_children
            FROM nodes n LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = n.p[1:n.d - 1]
        ), subtree AS (
            SELECT n.p, n.d, count(*) FILTER (f.n_children = 0) AS n_leaves, sum((x.n - 1) * x.words) AS saved
            FROM nodes n JOIN nodes x ON x.d >= n.d AND x.p[1:n.d] = n.p JOIN family f ON f.p = x.p AND f.d = x.d GROUP BY n.p, n.d
        )
        SELECT n.conv_id, n.d::BIGINT AS depth, f.parent_conv_id, n.n AS n_convs, f.n_children, s.n_leaves, s.saved::BIGINT AS saved_tokens,
            sha256(coalesce(n.ends, '')) AS ends_sha256
        FROM nodes n JOIN family f ON f.p = n.p AND f.d = n.d JOIN subtree s ON s.p = n.p AND s.d = n.d""",
)
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(table(spark, sf_dir, "conversations")).drop("n_ends")


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return embedding_whitening.whiten(rows, embedding_whitening.fit(rows))


@query("op13_minhash_dedup")
def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return near.select("doc_id", "n_shingles", "component_id", kept)
