"""The registered queries of the numbered operators, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import salted_join
from .byte_bpe import encoding_digests
from .common import table, write_table
from .conversation_repair import repair_conversations
from .html_extract import extract_main_text
from .license_scan import scan_licenses
from .path_join import near_duplicates
from .quality import score_quality
from .simhash import as_hex, fingerprint_documents, near_counts
from .spelling import spelling_variants
from .token_packing import pack
from .toxicity import score_toxicity
from .topk_search import top_k
from .url_rules import judge_urls, rules_frame
from .warc_derive import derive_records, response_records

# The rules of the URL query, as (host, path, verdict).
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path and the longest rule that fits."""
    return judge_urls(table(spark, sf_dir, "pages", "page_id", "url"), rules_frame(spark, URL_RULES))


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return extract_main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity."""
    return score_toxicity(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op5_warc_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metadata and a conversion record of every page's response."""
    return derive_records(response_records(table(spark, sf_dir, "pages", "page_id", "url", "html")))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's fingerprint, its edited text's, how like they and the next document's are, and what other fingerprints are near."""
    f, _ = write_table(fingerprint_documents(table(spark, sf_dir, "documents", "doc_id", "text")), "simhash-prints")
    own = as_hex(F.col("f0"), F.col("f1"))
    rows = f.select("doc_id", "n_chars", "edited_sha256", own.alias("fingerprint"),
                    as_hex(F.col("e0"), F.col("e1")).alias("edited_fingerprint"), "near_edited", "near_next")
    # Every fingerprint is within the radius of itself, so no row is lost; copies of one text are a hot key.
    near = near_counts(f).select(own.alias("print"), "near_prints", "nearest")
    return salted_join(rows, near, "fingerprint", "print", salt_source="doc_id").drop("print")


def op6_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate component on two-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), width=2)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality; its source is the host, its language there the path."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return score_quality(docs, table(spark, sf_dir, "labels", "doc_id", "quality"), F.col("source"),
                         F.concat_ws("/", "source", "lang"), ["doc_id"])


def op8_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, packed into sequences."""
    return pack(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), added=True)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's ids under the multilingual ranks, and back, as digests."""
    return encoding_digests(table(spark, sf_dir, "documents", "doc_id", "text"),
                            public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest other vectors of every fiftieth vector."""
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after the damage, and the cheapest repair."""
    return repair_conversations(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word of all texts with its spelling form and root."""
    return spelling_variants(table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's license phrases and notices."""
    return scan_licenses(table(spark, sf_dir, "documents", "doc_id", "text")).drop("spans")


QUERIES = {f.__name__: f for f in (op1_url_rules, op2_html_extract, op3_simhash, op4_toxicity, op5_warc_derive, op6_path_join, op7_quality, op8_token_packing, op9_byte_bpe, op10_topk_search,
                                 op11_conversation_repair, op12_spelling, op13_license_scan)}

_RULES_SQL = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)

ORACLE = {
    "op1_url_rules": f"""
        WITH parsed AS (
            SELECT page_id,
                   coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages),
        rules(rule_host, rule_path, verdict) AS (VALUES {_RULES_SQL})
        SELECT page_id, p.host, p.path, best.rule, coalesce(best.verdict, 'allow') AS verdict
        FROM parsed p LEFT JOIN LATERAL (
            SELECT rule_host || rule_path AS rule, verdict FROM rules
            WHERE (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, rule_path)
            ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC LIMIT 1) best ON true""",
    "op6_path_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                                              ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
            FROM words),
        items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
        links AS (
            SELECT a.doc_id AS x, b.doc_id AS y
            FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id
                 AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
            GROUP BY a.doc_id, b.doc_id
            HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
        reach(x, y) AS (SELECT doc_id, doc_id FROM sets UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
        comp AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
        FROM sets s JOIN comp c USING (doc_id)""",
    "op10_topk_search": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        ranked AS (
            SELECT query_id, vec_id, score,
                   row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
            FROM (SELECT q.vec_id AS query_id, c.vec_id,
                         CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
                  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0))
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
}
