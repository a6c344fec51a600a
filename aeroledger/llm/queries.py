"""Registered queries of the text operators, with SQL where it can give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroledger.llm import (
    balanced_mix, exact_dedup, fill_in_middle, html_text, jaccard_join, language_id, line_dedup, lm_score, nearest_neighbours,
    quality_rules, sentencepiece_spans, suffix_dedup, token_alignment)
from aeroledger.llm.common import documents, id_class

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Fixed value: the words of all contracts.
WORD = r"[^\x20\x09-\x0D]+"


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = exact_dedup.exact_groups(documents(spark, folder))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


SQL["op1_exact_dedup"] = """
    WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
               FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
           sha256(t) AS text_sha256
    FROM n WINDOW w AS (PARTITION BY t)"""


@query
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = id_class(F.col("doc_id"), 5) == 0
    languages, net = language_id.learn(docs, ~held_out)
    return language_id.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), languages, net)


@query
def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.similar_components(documents(spark, folder)).select("doc_id", "n_shingles", "component_id")


@query
def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    verdicts = quality_rules.quality_verdicts(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))
    return verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                           "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


@query
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = line_dedup.without_shared_lines(documents(spark, folder))
    return left.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL["op5_line_dedup"] = """
    WITH s AS (SELECT doc_id, coalesce(source, '') AS site, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
    l AS (SELECT doc_id, site, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM s),
    t AS (SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS word FROM l),
    b AS (SELECT word FROM t WHERE word <> '' GROUP BY word HAVING count(DISTINCT site) >= 5),
    m AS (SELECT t.*, b.word IS NOT NULL AS gone FROM t LEFT JOIN b ON t.word = b.word)
    SELECT doc_id, count(*) FILTER (WHERE word <> '') AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id"""


@query
def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffix_dedup.cut_repeats(documents(spark, folder))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_balanced_mix(spark: SparkSession, folder: str) -> DataFrame:
    mix = balanced_mix.mix(documents(spark, folder))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(spark.read.parquet(f"{folder}/pages.parquet")).select("page_id", "url", "text", "n_chars")


@query
def op9_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score_texts(documents(spark, folder), id_class(F.col("doc_id"), 7) == 2)


@query
def op10_sentencepiece_spans(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_spans.encoding_digests(documents(spark, folder), piece_model())


def byte_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.alignment(documents(spark, folder), byte_model(), piece_model())


@query
def op12_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_neighbours.nearest(spark.read.parquet(f"{folder}/embeddings.parquet"))


@query
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_in_middle.transform(documents(spark, folder))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(back.cast("binary"), 256).alias("restored_sha256"))


SQL["op13_fill_in_middle"] = """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256(concat('1:', doc_id)) AS h FROM documents),
    c AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST(concat('0x', h[1:8]) AS BIGINT) AS h1,
                 CAST(concat('0x', h[9:16]) AS BIGINT) AS h2, CAST(concat('0x', h[17:24]) AS BIGINT) AS h3,
                 CAST(concat('0x', h[25:32]) AS BIGINT) AS h4 FROM d),
    f AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM c),
    p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1, n - b) AS suf FROM f)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('<P>', pre, '<S>', suf, '<M>', mid)
                  ELSE concat('<S>', suf, '<P>', pre, '<M>', mid) END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""
