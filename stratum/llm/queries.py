"""The operators over their whole tables with production parameters, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.bpe import encode_documents
from stratum.llm.decontaminate import decontaminate
from stratum.llm.near_dedup import near_duplicates
from stratum.llm.pieces import encode_pieces
from stratum.llm.pii import pseudonymise
from stratum.llm.quality import score_quality
from stratum.llm.ranked_search import search
from stratum.llm.substring_dedup import repeated_passages
from stratum.llm.token_alignment import align_tokenizers
from stratum.llm.token_counts import count_tokens
from stratum.llm.toxicity import score_toxicity
from stratum.llm.url_filter import judge_urls
from stratum.llm.vector_search import exact_top_k

PSEUDONYM_KEY = "corpus-2026"  # a deployment passes its own secret
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(id_: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`: the fold a row belongs to."""
    return F.crc32(id_.cast("string").cast("binary")) % modulus


def toxicity_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return score_toxicity(docs, _table(spark, sf_dir, "labels"), learn=lambda i: id_remainder(i, 5) != 0)


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity_rows(spark, _table(spark, sf_dir, "documents"), sf_dir)
    return scored.select("__row.doc_id", F.coalesce(id_remainder(F.col("__row.doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
                         F.col("__score").alias("score"), F.col("__predicted").alias("predicted"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(_table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY).withColumnRenamed("__n_pseudonyms", "n_pseudonyms")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, out="digests")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(_table(spark, sf_dir, "embeddings"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), learn=lambda i: id_remainder(i, 3) != 1)
    return scored.select("doc_id", F.coalesce(id_remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), out="digests")


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN,
                            public_tokenizers.path("piece_bpe_32k.model"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_benchmark_decontamination, op2_toxicity, op3_pii, op4_byte_bpe, op5_token_counts, op6_substring_dedup,
                            op7_exact_top_k, op8_quality, op9_near_dedup, op10_url_filter, op11_sentencepiece,
                            op12_tokenizer_alignment, op13_ranked_search)}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWERED = f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLES: dict[str, str] = {
    "op1_benchmark_decontamination": rf"""
        WITH d AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
        i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
        win AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS k
                FROM i, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) t(s) WHERE len(w) > 0),
        lengths AS (SELECT DISTINCT n FROM win),
        own AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS k FROM d, lengths, unnest(generate_series(1, len(w) - n + 1)) t(s)),
        hit AS (SELECT doc_id, s, n, item FROM own JOIN win USING (n, k)),
        words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, s, n FROM hit) h, unnest(generate_series(s, s + n - 1)) t(p) GROUP BY doc_id),
        items AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS x FROM hit GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(x, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op7_exact_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
                   WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.vec_id % 50 = 0 AND len(q.e) = len(c.e)),
        r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op9_near_dedup": rf"""
        WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
        sh AS (SELECT DISTINCT doc_id, array_to_string(w[s:s + least(5, len(w)) - 1], ' ') AS k
               FROM d, unnest(generate_series(1, len(w) - least(5, len(w)) + 1)) t(s) WHERE len(w) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM sh a JOIN sh b USING (k) WHERE a.doc_id < b.doc_id GROUP BY ALL),
        links AS (SELECT u, v FROM pairs JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * c >= 75 * (a.n + b.n - c)),
        ends AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
        reach AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT reach.u, ends.v FROM reach JOIN ends ON reach.v = ends.u)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u) USING (doc_id)""",
    "op13_ranked_search": rf"""
        WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '{_TERM}') AS t FROM documents WHERE text IS NOT NULL),
        i AS MATERIALIZED (SELECT row_number() OVER () AS q, item_id, regexp_extract_all({_LOWERED}, '{_TERM}') AS t FROM benchmark WHERE text IS NOT NULL),
        total AS (SELECT count(*) AS n_docs, sum(len(t)) AS n_terms FROM d WHERE len(t) > 0),
        tf AS (SELECT r, term, count(*) AS tf FROM d, unnest(t) u(term) GROUP BY r, term),
        weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, n_docs),
        wanted AS (SELECT DISTINCT q, item_id, term FROM i, unnest(t) u(term)),
        norms AS (SELECT r, doc_id, 10 + CAST((90 * len(t) * n_docs) // n_terms AS BIGINT) AS m FROM d, total WHERE len(t) > 0),
        scores AS (SELECT q, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
                   FROM wanted JOIN weights USING (term) JOIN tf USING (term) JOIN norms USING (r) GROUP BY ALL),
        ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
}
