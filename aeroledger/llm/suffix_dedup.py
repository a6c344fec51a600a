"""Removal of every byte that a string of ``LENGTH`` bytes covers which also starts elsewhere.

This is not prefix doubling: no pairs of ranks are sorted and no offset doubles.  Minimiser anchors with cell refinement take
its place.  A rank is a 64-bit name of a string (only equality matters), and positions are dropped as early as possible:

1. *Anchors.*  Each window of 200 bytes names its least 50-byte string (by scrambled name, the leftmost of ties).  Equal
   windows have the same anchor at the same place, and neighbouring windows mostly share one, so one position in about 75
   takes part.  Spark counts the anchors' ranks; those whose rank is unique end here, with all their windows.
2. *Contexts.*  An anchor's windows, laid together, form its context.  Where another anchor has an equal one, all its
   windows repeat.
3. *Cells.*  One anchor of each context that is left is taken apart: windows whose anchor lies at offsets of one cell of
   16, then 4, then 1.  What all windows of a cell cover in common is its core, what any covers its whole.  A cell whose
   core is unique ends; a cell whose whole is not unique repeats in full; the others go on to finer cells, until at a
   single window core and whole are the 200 bytes themselves.

Repeated windows come back as intervals per document, which are merged and cut out.  Every exchange carries fixed-size
rows and every grouping is a count with map-side combining, so a passage that a third of all documents share loads no
task.  Null counts as empty text; texts below the length lose nothing; copies of a row lose all that is long enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroledger.llm.common import stored, whole_text
from aeroledger.llm.fingerprints import Names, scramble, sliding_min

LENGTH = 200
SEGMENT = 1 << 20

CELLS = (16, 4, 1)

ANCHORS = "doc {0}, digest bigint, lo int, n int, at int, rank bigint, context bigint"
CELL_ROWS = "rank bigint, context bigint, single boolean, cell int, first int, last int, core bigint, whole bigint, full boolean"


def seeds(length: int) -> int:
    return length // 4


def anchor_runs(names: Names, n_bytes: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window start of each run of windows with one anchor, and the anchors."""
    k = seeds(length)
    width = length - k + 1
    order = scramble(names.all(k))
    least = sliding_min(order, width)
    n = len(least)
    leaves = order[:n - 1] == least[:-1]
    enters = least[1:] < least[:-1]
    lo = np.concatenate([[0], np.flatnonzero(leaves | enters) + 1])
    hi = np.concatenate([lo[1:] - 1, [n - 1]])
    ends_there = order[hi] == least[hi]
    came = np.zeros(len(lo), bool)
    came[1:] = enters[lo[1:] - 1]
    anchors = np.where(ends_there, hi, lo + width - 1)
    rest = np.flatnonzero(~ends_there & ~came)
    for i in range(0, len(rest), 4096):
        some = rest[i:i + 4096]
        anchors[some] = lo[some] + np.argmin(order[lo[some][:, None] + np.arange(width)], axis=1)
    return lo, hi, anchors


def text_anchors(data: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(lo, n, at, rank, context) of the runs of a text, segment by segment."""
    for start in range(0, max(1, len(data) - length + 1), SEGMENT):
        part = data[start:start + SEGMENT + length - 1]
        if len(part) < length:
            return
        names = Names(part)
        lo, hi, at = anchor_runs(names, len(part), length)
        rank = names.of(at, at + seeds(length))
        shape = ((at - lo).astype(np.uint64) << np.uint64(32)) | (hi - at + 2 * length).astype(np.uint64)
        context = scramble(names.of(lo, hi + length)) + scramble(shape)
        yield lo + start, hi - lo + 1, at - lo, rank, context


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and bytes of each text (the last column)."""
    texts = batch.column(batch.num_columns - 1)
    for i in range(batch.num_rows):
        value = texts[i].as_buffer()
        yield i, np.frombuffer(value, np.uint8) if value is not None else np.zeros(0, np.uint8)


def joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """All anchors: doc, digest, first window start, number of windows, anchor's place in the run, rank, context."""
    schema = ANCHORS.format(docs.schema["doc"].dataType.simpleString())
    kinds = (np.int32, np.int32, np.int32, np.uint64, np.uint64)

    def run(batches):
        for batch in batches:
            at, cols = [], tuple([] for _ in kinds)
            for i, data in rows_of(batch):
                for found in text_anchors(data, length):
                    at.append(np.full(len(found[0]), i))
                    for col, values in zip(cols, found):
                        col.append(values)
            rows = pa.array(joined(at, np.int64))
            made = [joined(c, k) for c, k in zip(cols, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), *map(pa.array, made[:3]),
                 *[pa.array(m.view(np.int64)) for m in made[3:]]], ["doc", "digest", "lo", "n", "at", "rank", "context"])

    return docs.select("doc", "digest", "text").mapInArrow(run, schema)


def cells_of(at: int, n: int, bounds: tuple[int, int], width: int, names: Names, length: int):
    """Rows (cell, first, last, core, whole, full) of a context's windows at anchor offsets ``bounds``."""
    first, last = max(bounds[0], at - n + 1), min(bounds[1], at)
    cell = np.arange(first // width, last // width + 1)
    low, high = cell * width, cell * width + width - 1
    core = names.of(at - low, at - high + length)
    full = (low >= at - n + 1) & (high <= at)
    whole = np.zeros(len(cell), np.uint64)
    whole[full] = names.of(at - high[full], at - low[full] + length)
    return cell, np.maximum(low, first), np.minimum(high, last), core, whole, full


def cells(contexts: DataFrame, width: int, length: int) -> DataFrame:
    """Cells of contexts (rank, context, single, at, n, first, last, bytes)."""
    def run(batches):
        for batch in batches:
            source, cols = [], tuple([] for _ in range(6))
            meta = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3, 7)]
            for i, data in rows_of(batch):
                at, n, first, last = (int(m[i]) for m in meta)
                found = cells_of(at, n, (first, last), width, Names(data), length)
                source.append(np.full(len(found[0]), i))
                for col, values in zip(cols, found):
                    col.append(values)
            rows = pa.array(joined(source, np.int64))
            cell, first, last, core, whole, full = (joined(c, k) for c, k in zip(
                cols, (np.int32, np.int32, np.int32, np.uint64, np.uint64, bool)))
            contexts_ = batch.column(1).take(rows).to_numpy().view(np.uint64)
            whole = np.where(full, whole, scramble(contexts_))  # a cell that is cut off is a class of its own
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k).take(rows) for k in range(3)], pa.array(cell), pa.array(first), pa.array(last),
                 pa.array(core.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(full)],
                [f.split()[0] for f in CELL_ROWS.split(", ")])

    return contexts.select("rank", "context", "single", "at", "n", "first", "last", "bytes").mapInArrow(run, CELL_ROWS)


def settle(rows: DataFrame) -> DataFrame:
    """Cells with their verdicts: ``repeats`` (in full) and ``goes_on`` (to finer cells)."""
    classes = rows.groupBy("rank", "cell", "core", "whole").agg(
        F.count("*").alias("members"), F.min("context").alias("speaker"), F.max("single").alias("single_"))
    needy = F.max((F.col("members") == 1) & F.col("single_"))
    cores = classes.groupBy("rank", "cell", "core").agg(F.count("*").alias("classes"), needy.alias("needy"))
    found = rows.join(classes.drop("single_"), ["rank", "cell", "core", "whole"]).join(cores, ["rank", "cell", "core"])
    speaks = (F.col("members") == 1) | (F.col("speaker") == F.col("context"))
    return found.select("rank", "context", "single", "first", "last",
                        (F.col("full") & (F.col("members") > 1)).alias("repeats"),
                        ((F.col("classes") > 1) & F.col("needy") & speaks).alias("goes_on"))


def repeated_windows(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """Runs of repeated windows of ``texts`` (doc, digest, text as binary): doc, digest, lo, n."""
    found = stored(anchors(texts, length), "all-anchors")
    ranks = stored(found.groupBy("rank").count().where("count > 1").drop("count"), "ranks")
    alike = stored(found.join(ranks, "rank"), "anchors")
    place = F.struct("doc", "digest", "lo", "n", "at")
    classes = stored(alike.groupBy("rank", "context").agg(F.count("*").alias("members"), F.min(place).alias("p")), "contexts")
    several = classes.where("members > 1").select("rank", "context")
    out = alike.join(several, ["rank", "context"]).select("doc", "digest", "lo", "n")

    mixed = classes.groupBy("rank").count().where("count > 1").drop("count")
    open_ = classes.join(mixed, "rank").select("rank", "context", (F.col("members") == 1).alias("single"), "p.*")
    contexts = stored(
        open_.join(texts, ["doc", "digest"]).select(
            "rank", "context", "single", "doc", "digest", "lo", "at", "n",
            F.expr(f"substring(text, lo + 1, n + {length - 1})").alias("bytes")).dropDuplicates(["rank", "context"]), "open")
    todo = contexts.withColumn("first", F.lit(0)).withColumn("last", F.lit(length))
    hits = []
    for width in CELLS:
        made = stored(cells(todo, width, length), "cells")  # read three times
        verdicts = stored(settle(made), "verdicts")
        hits.append(verdicts.where("single AND repeats").select("rank", "context", "first", "last"))
        todo = contexts.join(verdicts.where("goes_on").select("rank", "context", "first", "last"), ["rank", "context"])
    cells_hit = hits[0].unionByName(hits[1]).unionByName(hits[2])
    runs = cells_hit.join(contexts.drop("bytes"), ["rank", "context"]).select(
        "doc", "digest", (F.col("lo") + F.col("at") - F.col("last")).alias("lo"), (F.col("last") - F.col("first") + 1).alias("n"))
    return out.unionByName(runs)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals, touching ones joined."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    opens = np.concatenate([[True], starts[1:] > ends[:-1]]) if len(starts) else np.zeros(0, bool)
    last = np.concatenate([opens[1:], [True]]) if len(starts) else opens
    return starts[opens], ends[last]


def cut_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per document: key, n_bytes, n_removed, n_spans and the bytes that stay (``kept``)."""
    # A row is known by 128 bits of its id and text, never null: rows that agree in both have one outcome.
    texts = docs.select(F.col(key).alias("key"), F.encode(whole_text(text), "UTF-8").alias("text")).withColumns({
        "doc": F.xxhash64("key", "text"), "digest": F.xxhash64(F.lit(1), "key", "text")})
    # Copies within one id count as places of their own, so every row takes part.
    runs = stored(repeated_windows(texts.select("doc", "digest", "text"), length), "runs")
    spans = runs.groupBy("doc", "digest").agg(F.collect_list("lo").alias("lo"), F.collect_list(F.col("lo") + F.col("n")).alias("hi"))
    spans = spans.select(F.col("doc").alias("of"), F.col("digest").alias("of_digest"), "lo", "hi")
    cut = texts.join(spans, (F.col("doc") == F.col("of")) & (F.col("digest") == F.col("of_digest")), "left")
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                           T.StructField("kept", T.BinaryType())])

    def run(batches):
        for batch in batches:
            out = ([], [], [], [])
            for i, data in rows_of(batch):
                lo, hi = (np.array(batch.column(k)[i].as_py() or [], np.int64) for k in (1, 2))
                starts, ends = merged(lo, hi + length - 1)
                keep, at = [], 0
                for a, b in zip(starts.tolist(), ends.tolist()):
                    keep.append(data[at:a])
                    at = b
                keep.append(data[at:])
                for col, value in zip(out, (len(data), int((ends - starts).sum()), len(starts), b"".join(k.tobytes() for k in keep))):
                    col.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in out[:3]], pa.array(out[3], pa.binary())],
                [f.name for f in schema])

    return cut.select("key", "lo", "hi", "text").mapInArrow(run, schema)
