"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, cover_tree, divergence, fingerprints, html_text, jaccard, licenses, packing, prefix_trie, quality, substring, topk, warc
from .common import prepare, table

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to ARC, converted to WARC and read back."""
    prepare(spark)
    return warc.archive_pages(spark, table(spark, sf_dir, "pages"))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    prepare(spark)
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.fit_weights(pages))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    prepare(spark)
    return bpe.encode_digests(spark, table(spark, sf_dir, "documents"), BYTE_VOCABULARY)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    prepare(spark)
    return packing.pack(spark, table(spark, sf_dir, "documents"), WORD_VOCABULARY)


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best rows for every vector whose id is divisible by 50."""
    prepare(spark)
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that documents, or runs of lines of them, are."""
    prepare(spark)
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality posterior of every document and whether it is kept."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.classify(spark, docs, model, carry=["doc_id"])
    return scored.selectExpr("doc_id", "_qc_logit AS logit", "_qc_host_mean AS host_mean", "_qc_path_mean AS path_mean", "_qc_posterior AS posterior", f"_qc_posterior >= {quality.KEEP_FROM} AS keep")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every document and of its edited text."""
    prepare(spark)
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a Jaccard
    similarity of 0.9 or more."""
    prepare(spark)
    return jaccard.jaccard_components(spark, table(spark, sf_dir, "documents"), 3, 90, 100)


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document without repeats of 50 words or more."""
    prepare(spark)
    return substring.removed_words(spark, table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    prepare(spark)
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of a language, and overused terms."""
    prepare(spark)
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors with a cosine of 0.9 or more."""
    prepare(spark)
    return cover_tree.near_duplicates(spark, table(spark, sf_dir, "embeddings"), 0.9)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_html": op2_html,
    "op3_bpe": op3_bpe,
    "op4_packing": op4_packing,
    "op5_topk": op5_topk,
    "op6_licenses": op6_licenses,
    "op7_quality": op7_quality,
    "op8_fingerprints": op8_fingerprints,
    "op9_jaccard": op9_jaccard,
    "op10_substring": op10_substring,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_divergence": op12_divergence,
    "op13_cover_tree": op13_cover_tree,
}

SPACE = "[\\x20\\x09-\\x0D]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words_sql(text: str) -> str:
    return f"[x for x in regexp_split_to_array({text}, '{SPACE}') if x <> '']"


SQL: dict[str, str] = {
    "op9_jaccard": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, {_words_sql(LOWER.format("coalesce(text, '')"))} AS ws FROM documents
        ), s AS (
            SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                                ELSE list_distinct([array_to_string(ws[i:i + 2], ' ') for i in range(1, len(ws) - 1)]) END AS shingles
            FROM w
        ), e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
        links AS MATERIALIZED (
            SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
        ), reach(doc_id, low) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.doc_id WHERE r.low < l.b
        ), least_of AS (SELECT doc_id, min(low) AS component_id FROM reach GROUP BY doc_id)
        SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id FROM s JOIN least_of USING (doc_id)
    """,
    "op10_substring": f"""
        WITH w AS (SELECT row_number() OVER () AS nr, doc_id, {_words_sql("coalesce(text, '')")} AS ws FROM documents),
        v AS (
            SELECT nr, doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS h
            FROM (SELECT nr, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)
        ), first AS (SELECT h, min(doc_id) AS source FROM v GROUP BY h),
        gone AS (
            SELECT nr, list(DISTINCT p) AS ps FROM (
                SELECT v.nr, unnest(range(v.i, v.i + 50)) AS p FROM v JOIN first USING (h) WHERE source < v.doc_id
            ) GROUP BY nr
        ), cut AS (
            SELECT w.doc_id, ws, [ws[i] for i in range(1, len(ws) + 1) if ps IS NULL OR NOT list_contains(ps, i)] AS kept
            FROM w LEFT JOIN gone USING (nr)
        )
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - len(kept) AS BIGINT) AS n_removed,
               sha256(array_to_string(kept, ' ')) AS kept_sha256
        FROM cut
    """,
    "op6_licenses": licenses.scan_sql(),
    "op11_prefix_trie": prefix_trie.prefix_trie_sql(),
    "op12_divergence": divergence.divergence_sql(),
    "op13_cover_tree": cover_tree.near_duplicates_sql(),
    "op5_topk": """
        WITH v AS (
            SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum([p[1] * p[2] for p in list_zip(q.v, c.v)]) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op1_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha1(coalesce(html, '')) AS payload_digest
            FROM pages
        ), w AS (
            SELECT payload_digest, max(page_id) AS winner FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest
        )
        SELECT p.page_id, p.payload_bytes, p.payload_digest,
               CASE WHEN w.winner <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN w.winner <> p.page_id THEN w.winner END AS refers_to
        FROM p LEFT JOIN w ON p.payload_digest = w.payload_digest AND p.payload_bytes >= 1000
    """,
}
