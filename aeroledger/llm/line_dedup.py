"""Removal of lines that many sites share.

Lines are trimmed and hashed (two 64-bit hashes); a line without a word is never removed.  Lines seen on one site only
end at once.  For the others, HyperLogLog sketches of the sites merge by aggregation, so a line of a third of all
documents costs one sketch per task.  Where the estimate lies within ``MARGIN`` of the threshold, the distinct sites are
counted exactly; elsewhere the estimate decides (at 2**12 registers it errs by 1.6 %).  All occurrences of a line of at
least ``sites`` sites are removed.

Null counts as an empty text, a null site as a site of its own.  Copies lose the same lines.  All steps are DataFrame
functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroledger.llm.common import SPACES, stored, whole_text

SITES = 5
REGISTERS = 12  # binary logarithm
MARGIN = 0.25


def line_hash(line: Column) -> Column:
    """Two hashes of the trimmed line; null for a line without a word."""
    trimmed = F.btrim(line, F.lit(SPACES))
    return F.when(trimmed != "", F.concat_ws("/", F.xxhash64(trimmed).cast("string"), F.xxhash64(trimmed, F.lit(1)).cast("string")))


def spread_lines(seen: DataFrame, sites: int = SITES) -> DataFrame:
    """Lines of at least ``sites`` sites.  ``seen``: line, site."""
    several = stored(seen.groupBy("line").agg(F.min("site").alias("lo"), F.max("site").alias("hi")).where("lo != hi").select("line"),
                     "several")
    shared = seen.join(several, "line")
    estimates = stored(shared.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", REGISTERS)).alias("spread")), "spread")
    near = F.col("spread").between(sites * (1 - MARGIN), sites * (1 + MARGIN))
    exact = seen.join(estimates.where(near).select("line"), "line").select("line", "site").distinct().groupBy("line").count()
    return estimates.where(~near & (F.col("spread") >= sites)).select("line").unionByName(
        exact.where(F.col("count") >= sites).select("line"))


def without_shared_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source", sites: int = SITES) -> DataFrame:
    """Per document: key, n_lines (with a word), n_removed and the text that stays (``kept``)."""
    whole = whole_text(text)
    rows = docs.select(F.col(key).alias("doc"), F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"), whole.alias("text"),
                       F.xxhash64(whole).alias("digest"))
    lines = rows.select("doc", "digest", "site", F.explode(F.split("text", "\n")).alias("line")).select(
        "doc", "digest", "site", line_hash(F.col("line")).alias("line")).where(F.col("line").isNotNull())
    shared = stored(spread_lines(lines.select("line", "site"), sites), "shared-lines")
    hits = lines.join(shared, "line").groupBy(F.col("doc").alias("of"), F.col("digest").alias("of_digest")).agg(
        F.collect_set("line").alias("gone"))
    joined = rows.join(hits, F.col("doc").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("of_digest")), "left")
    parts = joined.select("doc", F.split("text", "\n").alias("lines"), F.coalesce("gone", F.array().cast("array<string>")).alias("gone"))
    left = F.filter("lines", lambda x: ~F.coalesce(F.array_contains("gone", line_hash(x)), F.lit(False)))
    counted = parts.select("doc", "lines", F.when(F.size("gone") == 0, F.col("lines")).otherwise(left).alias("stay"))
    return counted.select(
        F.col("doc").alias(key), F.size(F.filter("lines", lambda x: F.btrim(x, F.lit(SPACES)) != "")).cast("long").alias("n_lines"),
        (F.size("lines") - F.size("stay")).cast("long").alias("n_removed"), F.array_join("stay", "\n").alias("kept"))
