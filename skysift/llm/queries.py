"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skysift.llm import cap_dedup, crf_quality, golay_dedup, license_join, mixing, pii_bootstrap, posting_ann, suffix_pieces, url_cascade, wavelet
from skysift.llm.common import table

#: The url rules of query op7.
URL_RULES = [
    url_cascade.Rule("com", "/en/", "block"),
    url_cascade.Rule("example.com", "/en/7", "allow"),
    url_cascade.Rule("net", "/de/", "allow"),
    url_cascade.Rule("example.net", "/de/8", "block"),
    url_cascade.Rule("org", "/es/", "block"),
]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = crf_quality.train(docs, table(spark, sf_dir, "labels"))
    scored = crf_quality.with_score(docs, model, score_col="score")
    return scored.select("doc_id", crf_quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_ann.nearest(table(spark, sf_dir, "embeddings"))


def op3_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), target_entropy=0.9999, max_repetition=4.0)
    return mixed.select("doc_id", "source", F.col("__tokens").alias("n_tokens"), F.col("__weight").alias("weight"), F.col("__copies").alias("copies"))


def op5_wavelet_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.read_files(wavelet.write_files(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")))


def op6_suffix_array_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_pieces.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op7_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_cascade.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op8_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_join.scan_licenses(table(spark, sf_dir, "documents"))


def op9_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golay_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_bootstrap.find_pii(table(spark, sf_dir, "documents"))
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    of_kind = [count(i).alias(f"n_{kind}") for i, kind in enumerate(pii_bootstrap.KINDS)]
    return found.select(F.col("id").alias("doc_id"), *of_kind, F.sha2(pii_bootstrap.span_text(F.col("base")), 256).alias("base_sha256"), pii_bootstrap.span_text(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_crf_quality, op2_posting_lists, op3_cap_filters, op4_temperature_mixing, op5_wavelet_matrix, op6_suffix_array_pieces, op7_bloom_cascade, op8_license_join, op9_golay_simhash, op10_pii_bootstrap)}


def oracle_sql() -> dict[str, str]:
    return {"op7_bloom_cascade": URLS_SQL, "op8_license_join": _licenses_sql()}


URLS_SQL = """
WITH cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), parts AS (
    SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut
), ruled AS (
    SELECT *, CASE WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/7') THEN 'example.com/en/7'
                   WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/de/8') THEN 'example.net/de/8'
                   WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/en/') THEN 'com/en/'
                   WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/de/') THEN 'net/de/'
                   WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/es/') THEN 'org/es/' END AS rule
    FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IS NULL OR rule = 'example.com/en/7' THEN 'allow' ELSE 'block' END AS verdict FROM ruled
"""


def _licenses_sql() -> str:
    """Brute force: every line against every template, as word sets."""
    wanted = [(label, sorted(set(license_join._python_words(text)))) for label, text in license_join.TEMPLATES]
    templates = ", ".join(f"('{label}', {words!r})" for label, words in wanted)
    phrases = ", ".join(f"('{label}', {p.split()!r})" for p, label in license_join.PHRASES.items())
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
WITH templates(label, wanted) AS (VALUES {templates}),
phrases(label, phrase) AS (VALUES {phrases}),
docs AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered FROM documents
), worded AS (
    SELECT doc_id, lowered, regexp_extract_all(lowered, '{word}') AS words FROM docs
), places AS (
    SELECT doc_id, label, i - 1 AS place FROM
        (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM worded WHERE lowered LIKE '%license%' OR lowered LIKE '%cc%by%') w, phrases p
    WHERE list_slice(words, i, i + len(phrase) - 1) = phrase
), base AS (
    SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list_distinct(list(label)) AS labels FROM places GROUP BY doc_id
), lines AS (
    SELECT doc_id, list_distinct(regexp_extract_all(unnest(string_split(lowered, chr(10))), '{word}')) AS words FROM docs
), met AS (
    SELECT doc_id, label, len(list_intersect(words, wanted)) / CAST(len(wanted) AS DOUBLE) AS c, len(list_intersect(words, wanted)) AS shared, len(wanted) AS n FROM lines, templates
), more AS (
    SELECT doc_id, list_distinct(list(label)) AS labels, max(c) AS best FROM met WHERE shared >= ceil(0.8 * n - 1e-9) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ','), '') AS labels,
       greatest(coalesce(best, CAST(0 AS DOUBLE)), CASE WHEN n_base > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS score
FROM worded w LEFT JOIN base b ON w.doc_id = b.doc_id LEFT JOIN more m ON w.doc_id = m.doc_id
"""
