"""Exact deduplication by local, salted and global combining of equal texts.

Every stage groups by digest *and* full text, so two texts that merely share a digest never meet:

1. each task combines its own equal texts (Spark's map-side aggregation),
2. the task results meet per (digest, text, salt): a text that a third of all rows hold is spread over ``salts`` tasks,
3. at most ``salts`` winners per text meet per digest and give the row that stays and the size of the group.

Null counts as an empty text.  Among equal texts the largest id stays; null ids are smaller than any other, and rows
that repeat both text and id all report the same ``keep_id``.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aeroledger.llm.common import ascii_lower, fresh, stored, whole_text

SALTS = 16


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def text_classes(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per distinct text of ``rows`` (id, text, digest): digest, keep_id, group_size, rival.

    ``rival`` holds the text where several texts share the digest, else null.
    """
    salted = (rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
              .groupBy("digest", "text", "salt").agg(F.max("id").alias("keep_id"), F.count("*").alias("n")))
    merged = (salted.repartition("digest").groupBy("digest", "text")
              .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size")))
    variants = F.count("*").over(W.partitionBy("digest"))
    return merged.select("digest", "keep_id", "group_size", "text", variants.alias("variants")).select(
        "digest", "keep_id", "group_size", F.when(F.col("variants") > 1, F.col("text")).alias("rival"))


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", salts: int = SALTS, digest=sha256) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept and the digest of its normalised text."""
    normal = ascii_lower(whole_text(text))
    rows = docs.select(F.col(key).alias("id"), normal.alias("text"), digest(normal).alias("digest"))
    classes = stored(text_classes(rows, salts), "text-classes")
    found = rows.select("id", "digest").join(
        classes.where(F.col("rival").isNull()).drop("rival"), "digest")
    rivals = classes.where(F.col("rival").isNotNull())
    if not rivals.isEmpty():
        found = found.unionByName(rows.join(rivals.withColumnRenamed("rival", "text"), ["digest", "text"]).drop("text"))
    return found.select(F.col("id").alias(key), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                        "digest")


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, all columns; rows that repeat an id and its text come back once."""
    ident, digest = fresh(docs, "kept_id", "kept_digest")
    stay = exact_groups(docs, key, text, salts).where("kept").groupBy(F.col(key).alias(ident), F.col("digest").alias(digest)).count()
    stay = stored(stay, "kept")
    same = F.col(ident).eqNullSafe(F.col(key)) & (F.col(digest) == sha256(ascii_lower(whole_text(text))))
    out = docs.join(stay.where("count = 1"), same, "left_semi")
    repeated = stay.where("count > 1")
    if repeated.isEmpty():
        return out
    return out.unionByName(docs.join(repeated, same, "left_semi").dropDuplicates([key, text]))
