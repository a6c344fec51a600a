"""Mixing sources to target weights by cube-method balanced sampling.

Each source gets a target number of words.  A document is taken ``floor(rate)`` times, and once more with probability
``rate - floor(rate)``, where ``rate`` is target over source size (3 at most).  The extra takes are drawn by the cube
method: in a *flight*, three undecided documents at a time move their probabilities along the direction that changes
neither the sum of words nor the number of documents, until one of them is 0 or 1.  A flight leaves two documents
undecided at most.  Flights run in blocks of about ``BLOCK`` documents of one source, dealt by a hash of the id; what the
blocks leave meets in new blocks until a source has one.  That last flight stops at ``LANDS`` documents, and the *landing*
takes, of all their subsets, the one whose words and number come closest to what the probabilities ask for.  Directions are drawn from generators seeded by source, level and block, so reruns agree.

Null texts have size 0, a null source is a source of its own (last in order), documents that repeat an id are units of
their own.  A source without words gets target 0; without any words all targets are 0.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aeroledger.llm.common import fresh, n_words_of, stored, whole_text

MOST_TIMES = 3
WEIGHTS = (1, 2, 3)
BLOCK = 4096
CLOSE = 1e-9
LANDS = 14  # 16,384 subsets
OFF_BY_ONE = 0.05  # a document more or less counts as this share of a mean document's words


def source_targets(sizes: DataFrame, most: int = MOST_TIMES, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Targets of sources: source, source_size, n_docs, target.  ``sizes`` has source and size.

    A source is full when its limit per weight is no more than the level at which all that are not yet full share the
    rest.  Taken by limit per weight, the full sources come first, so running sums find the level.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    order = W.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    place = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    limited = per.withColumn("weight", weight).withColumn("limit", F.col("source_size") * most)
    everything = W.partitionBy()
    below = (W.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), F.encode("source", "UTF-8"))
             .rowsBetween(W.unboundedPreceding, -1))
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(below), F.lit(0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0))))
    shared = limited.withColumn("level", level).withColumn("full", F.col("limit") <= F.col("level") * F.col("weight"))
    common = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    return shared.withColumn("common", common).select(
        "source", "source_size", "n_docs",
        F.when(F.col("full"), F.col("limit").cast("double")).otherwise(F.col("common") * F.col("weight")).alias("target"))


def generator(*parts) -> np.random.Generator:
    seed = hashlib.sha256("\x1f".join(map(repr, parts)).encode()).digest()[:8]
    return np.random.default_rng(int.from_bytes(seed, "little"))


def step(p: list[float], u: list[float], rng) -> list[float]:
    """Move probabilities along ``u`` to one of the two ends, keeping the expectation."""
    ahead = min((1 - a) / b if b > 0 else -a / b for a, b in zip(p, u) if b)
    back = min(a / b if b > 0 else (a - 1) / b for a, b in zip(p, u) if b)
    by = ahead if rng.random() * (ahead + back) < back else -back
    moved = [a + by * b for a, b in zip(p, u)]
    return [0.0 if a < CLOSE else 1.0 if a > 1 - CLOSE else a for a in moved]


def flight(sizes: np.ndarray, p: np.ndarray, rng, landing: bool) -> np.ndarray:
    """Probabilities after the flight: all 0 or 1, but for two at most.  With ``landing`` the flight stops at
    ``LANDS`` undecided documents and those are landed."""
    p = p.astype(float).copy()
    waiting = [int(i) for i in rng.permutation(np.flatnonzero((p > 0) & (p < 1)))]
    active: list[int] = []
    while not landing or len(active) + len(waiting) > LANDS:
        while len(active) < 3 and waiting:
            active.append(waiting.pop())
        if len(active) < 3:
            return p
        a, b, c = (float(sizes[i]) for i in active)
        u = [b - c, c - a, a - b] if not a == b == c else [1.0, -1.0, 0.0]
        scale = max(map(abs, u))
        for i, value in zip(active, step([p[i] for i in active], [x / scale for x in u], rng)):
            p[i] = value
        active = [i for i in active if 0 < p[i] < 1]
    return land(sizes, p, np.array(active + waiting, int))


def land(sizes: np.ndarray, p: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Decide the few documents ``left``: of all their subsets, the one closest in words, then in documents."""
    if len(left):
        subsets = (np.arange(2 ** len(left))[:, None] >> np.arange(len(left))) & 1
        words = np.abs(subsets @ sizes[left].astype(float) - sizes[left] @ p[left])
        number = np.abs(subsets.sum(1) - p[left].sum())
        p[left] = subsets[np.argmin(words + OFF_BY_ONE * sizes[left].mean() * number)]
    return p


def fly(units: DataFrame, per_block: DataFrame, level: int) -> DataFrame:
    """One level of flights.  ``per_block`` has source and n_blocks; a source with one block lands."""
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["doc_key", "size"], kind="stable").reset_index(drop=True)
        source, number, blocks = block.at[0, "source"], int(block.at[0, "block"]), int(block.at[0, "n_blocks"])
        rng = generator(None if pd.isna(source) else source, level, number)
        block["p"] = flight(block["size"].to_numpy(), block["p"].to_numpy(), rng, landing=blocks == 1)
        return block[["row", "doc_key", "source", "size", "p"]]

    same = F.col("source").eqNullSafe(F.col("block_source"))
    blocks = units.join(per_block.withColumnRenamed("source", "block_source"), same).drop("block_source").withColumn(
        "block", F.pmod(F.xxhash64("doc_key", F.lit(level)), F.col("n_blocks")))
    return blocks.groupBy("source", "block").applyInPandas(run, units.schema)


def undecided(units: DataFrame) -> DataFrame:
    return units.where((F.col("p") > 0) & (F.col("p") < 1))


def draw(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """Decide all units (row, doc_key, source, size, p): the same rows with ``p`` 0 or 1."""
    decided, level, rest = [units.where((F.col("p") <= 0) | (F.col("p") >= 1))], 0, undecided(units)
    while True:
        counts = stored(rest.groupBy("source").agg(F.ceil(F.count("*") / block).cast("long").alias("n_blocks")), "blocks")
        flown = stored(fly(rest, counts, level), "flight")
        decided.append(flown.where((F.col("p") <= 0) | (F.col("p") >= 1)))
        if (counts.agg(F.max("n_blocks")).first()[0] or 0) <= 1:
            break
        rest, level = undecided(flown), level + 1
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    return out


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK) -> DataFrame:
    """Per document: key, size, source, source_size, target (of its source), copies and taken (= size * copies)."""
    sized = docs.select(F.col(key).alias("row"), F.col(key).cast("string").alias("doc_key"),
                        F.col(source).cast("string").alias("source"), n_words_of(whole_text(text)).alias("size"))
    sized = stored(sized, "sizes")
    targets = stored(source_targets(sized), "targets")
    rate = F.least(F.lit(float(MOST_TIMES)), F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0)))
    rates = targets.select(F.col("source").alias("of"), rate.alias("rate"))
    units = sized.join(rates, F.col("source").eqNullSafe(F.col("of"))).select(
        "row", "doc_key", "source", "size", (F.col("rate") - F.floor("rate")).alias("p"))
    drawn = draw(units, block)
    full = targets.withColumn("rate", rate).withColumnRenamed("source", "of").drop("n_docs")
    copies = F.floor("rate") + F.round("p").cast("long")
    return drawn.join(full, F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("row").alias(key), "size", "source", "source_size", "target", copies.alias("copies"),
        (F.col("size") * copies).alias("taken"))


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents of the mix, all columns, repeated as often as taken.  Rows that repeat an id share one decision."""
    ident, times, copy = fresh(docs, "key", "copies", "copy")
    copies = mix(docs, key, text, source).groupBy(F.col(key).alias(ident)).agg(F.max("copies").cast("int").alias(times))
    taken = docs.join(copies.where(F.col(times) > 0), F.col(key).eqNullSafe(F.col(ident)))
    return taken.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*[F.col(f"`{c}`") for c in docs.columns])
