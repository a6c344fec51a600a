"""From raw documents to token digests: five stages, each written as Parquet and read back as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroledger.llm import balanced_mix, exact_dedup, jaccard_join, language_id, sentencepiece_spans
from aeroledger.llm.common import documents, fresh, stored
from aeroledger.llm.queries import piece_model

# A text goes only if it has no letter or its language is a coin toss among those known.
LEAST_SCORE = 0.3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; learned from the labelled documents of ``docs``.

    Nothing is rejected for its language when no document is labelled.
    """
    languages, net = language_id.learn(docs, F.lit(True))
    if not languages:
        return docs
    label, score = fresh(docs, "lang_pred", "score")
    seen = language_id.predict(docs, languages, net, label=label, score=score, keep_text=True)
    return seen.where((F.col(label) != language_id.UNKNOWN) & (F.col(score) >= LEAST_SCORE)).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    return jaccard_join.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; documents come as often as they are taken."""
    return balanced_mix.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document that is left."""
    digests = sentencepiece_spans.encoding_digests(docs, piece_model())
    return digests.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("jaccard_join", without_near_copies),
    ("balanced_mix", mixed),
    ("sentencepiece", tokens),
]

# SQL can express neither the network nor the sampling; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
