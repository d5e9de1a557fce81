"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import bloom_lm, bpe_ids, exact_dedup, fim, lexical, license_scan, packing, page_text, quality, sentencepiece_stream, simhash, token_files, topk, trie_counts
from brindle.llm.work import materialize, new_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.duplicate_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score(_table(spark, sf_dir, "documents"))


def op3_perplexity_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept", *quality.MEASURES)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "tokens")
    manifest = token_files.write_token_files(_table(spark, sf_dir, "documents"), folder, bpe_ids.default_path())
    return token_files.read_token_files(spark, folder, manifest)


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_stream.digest(_table(spark, sf_dir, "documents"), sentencepiece_stream.default_path())


def op7_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = page_text.extract(_table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_differenced")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents")).drop("spans")


def op9_trie_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_counts.token_counts(_table(spark, sf_dir, "documents"), sentencepiece_stream.default_path())


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(_table(spark, sf_dir, "documents"))


def packed_documents(docs: DataFrame) -> DataFrame:
    """The packing query over any documents; the pipeline's last stage returns it too."""
    packed, _ = packing.pack(materialize(packing.pieces(docs, bpe_ids.default_path()), "pieces"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_tput_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fim.restore(fim.transform(_table(spark, sf_dir, "documents")))
    return done.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_bloom_lm": op2_bloom_lm,
    "op3_perplexity_bands": op3_perplexity_bands,
    "op4_token_files": op4_token_files,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_page_differencing": op7_page_differencing,
    "op8_license_scan": op8_license_scan,
    "op9_trie_counts": op9_trie_counts,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_exact_top_k": op11_exact_top_k,
    "op12_tput_search": op12_tput_search,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
               count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
    """,
    "op11_exact_top_k": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (
            SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
            FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM pairs QUALIFY rank <= 10
    """,
    "op12_tput_search": r"""
        WITH words AS (
            SELECT row_number() OVER () AS k, doc_id,
                   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents),
        asked AS (
            SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        totals AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM words WHERE len(w) > 0),
        postings AS (
            SELECT k, any_value(doc_id) AS doc_id, term, count(*) AS tf, any_value(n) AS n
            FROM (SELECT k, doc_id, unnest(w) AS term, len(w) AS n FROM words) WHERE term IN (SELECT term FROM asked) GROUP BY k, term),
        weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM postings, totals GROUP BY term),
        scores AS (
            SELECT item_id, k, any_value(doc_id) AS doc_id,
                   CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
            FROM asked JOIN postings USING (term) JOIN weights USING (term), totals GROUP BY item_id, k)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, k) AS INTEGER) AS rank, doc_id, score
        FROM scores WHERE score > 0 QUALIFY rank <= 20
    """,
    "op13_fill_in_middle": """
        WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS x FROM documents),
        drawn AS (
            SELECT *, CAST('0x' || x[1:8] AS BIGINT) % (n + 1) AS one, CAST('0x' || x[9:16] AS BIGINT) % (n + 1) AS two,
                   n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || x[17:24] AS BIGINT) % 100 >= 90 AS stays,
                   CAST('0x' || x[25:32] AS BIGINT) % 100 < 20 AS suffix_first FROM texts),
        parts AS (
            SELECT *, least(one, two) AS a, greatest(one, two) AS b, substr(t, 1, least(one, two)) AS p,
                   substr(t, least(one, two) + 1, greatest(one, two) - least(one, two)) AS m, substr(t, greatest(one, two) + 1) AS s FROM drawn)
        SELECT doc_id, n, CASE WHEN stays THEN 'plain' WHEN suffix_first THEN 'spm' ELSE 'psm' END AS form,
               CASE WHEN NOT stays THEN a END AS prefix_chars, CASE WHEN NOT stays THEN b - a END AS middle_chars,
               sha256(CASE WHEN stays THEN t WHEN suffix_first THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM parts
    """,
}
