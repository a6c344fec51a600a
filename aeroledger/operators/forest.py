"""Random forests for many rows: grown level by level from counts per node, scored a tree at a time over Arrow batches."""

from __future__ import annotations

import json
import time
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroledger.session import checkpointed, scratch_path

BLOCK_ROWS = 1 << 16        # rows of a stored block; arrays of a block stay in the cache
UNIT_ROWS = 1 << 22         # most rows that share one set of counts, nine bytes each in memory
SAMPLE_ROWS = 1 << 17       # values that thresholds are taken from
NODES_AT_ONCE = 1 << 10     # nodes whose splits are compared together
# Draws of a Poisson of mean 1 by a 16-bit number: how often a row is in a tree's bag.
_POISSON = np.searchsorted(np.cumsum([np.exp(-1.0) / float(np.prod(np.arange(1, k + 1))) for k in range(12)]),
                           (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


def binaries(rows: np.ndarray) -> pa.Array:
    """One binary value for each row of a matrix."""
    rows = np.ascontiguousarray(rows)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.itemsize * rows.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def matrix(values: pa.Array, dtype) -> np.ndarray:
    """The matrix whose rows are binary values of one length."""
    ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset:values.offset + len(values) + 1]
    return np.frombuffer(values.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(dtype).reshape(len(values), -1)


# --- rows as blocks -----------------------------------------------------------------------------

def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, x, y, weights): up to BLOCK_ROWS rows as bytes, with the weight of each class met."""
    start, count, kept, held = TaskContext.get().partitionId() << 32, 0, [], 0

    def packed() -> pa.RecordBatch:
        x, y, w = (np.concatenate(parts) for parts in zip(*kept))
        if not np.isfinite(x).all():
            raise ValueError("features must not be NaN or Infinity")
        if not (np.all(y >= 0) and np.all(y == np.floor(y)) and np.all(y < 1 << 7)):
            raise ValueError("labels must be the numbers of classes")
        weights = np.full(int(y.max()) + 1, np.nan)
        weights[y.astype(np.intp)] = w
        if not np.array_equal(weights[y.astype(np.intp)], w):
            raise ValueError("weights must be equal within a class")
        return pa.RecordBatch.from_arrays(
            [pa.array([start + count]), binaries(x.reshape(1, -1)), binaries(y.astype(np.uint8).reshape(1, -1)),
             binaries(weights.reshape(1, -1))], ["block", "x", "y", "weights"])

    for batch in batches:
        x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        y, w = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in (1, 2))
        while len(x):
            room = BLOCK_ROWS - held
            kept.append((x[:room], y[:room], w[:room]))
            held += len(x[:room])
            x, y, w = x[room:], y[room:], w[room:]
            if held == BLOCK_ROWS:
                yield packed()
                count, kept, held = count + 1, [], 0
    if held:
        yield packed()


def thresholds(values: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` values between neighbours that part ``values`` evenly; all of them when there are no more."""
    values, counts = np.unique(values[np.isfinite(values)], return_counts=True)
    between = (values[1:] + values[:-1]) / 2
    if len(between) <= most:
        return between
    stride = counts.sum() / (most + 1)
    ends, goal, chosen = np.cumsum(counts), stride, []
    for i in range(len(between)):
        if abs(ends[i] - goal) < abs(ends[i + 1] - goal):
            chosen.append(between[i])
            goal += stride
    return np.array(chosen)


# --- one level of all trees ---------------------------------------------------------------------

def code_type(width: int) -> type:
    return np.uint8 if width <= 1 << 8 else np.uint16


def level_counts(blocks: Sequence[tuple[int, np.ndarray]], tree: int, splits: Sequence[tuple[np.ndarray, np.ndarray]],
                 picked: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Rows in the bag of ``tree`` by (node, picked feature, bin and class), for the nodes of one level.

    A block has a row of whole 64-bit words per row: a code ``bin * classes + class`` per feature, then zeros.  ``splits`` holds, per level above, the feature of
    each node and the largest such code that goes left.
    """
    nodes, features = picked.shape
    picked = [np.ascontiguousarray(picked[:, j], dtype=np.intp) for j in range(features)]
    counts = np.zeros((features, nodes * width))
    for block, codes in blocks:
        draws = np.random.SFC64([seed, tree, block]).random_raw(-(-len(codes) // 4)).view(np.uint16)[:len(codes)]
        drawn = _POISSON.take(draws)
        rows = np.flatnonzero(drawn > 0)
        weights, codes = drawn.take(rows).astype(np.float64), codes.take(rows, axis=0)
        codes, node = codes.view(code_type(width)).ravel(), np.zeros(len(rows), np.intp)
        first = np.arange(len(rows)) * (len(codes) // max(len(rows), 1))
        for feature, left in splits:
            at = feature.take(node, mode="clip")  # no index is out of bounds; clipping is only faster than checking
            at += first
            right = codes.take(at, mode="clip") > left.take(node, mode="clip")
            node *= 2
            node += right
        cells = node * width
        for j in range(features):
            at = picked[j].take(node, mode="clip")
            at += first
            counts[j] += np.bincount(cells + codes.take(at, mode="clip"), weights, nodes * width)
    return counts.reshape(features, nodes, width).transpose(1, 0, 2)


def best_splits(counts: np.ndarray, picked: np.ndarray, bins: np.ndarray, weights: np.ndarray, least: int) -> dict[str, np.ndarray]:
    """Per node of ``counts`` (node, picked feature, bin, class): the split of the largest gain in Gini impurity, if any.

    ``bins`` holds the thresholds per feature; a side has ``least`` rows at least.
    """
    def gini(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weighted = rows * weights
        total = weighted.sum(-1)
        return 1.0 - ((weighted / np.maximum(total, 1e-300)[..., None]) ** 2).sum(-1), total

    whole = counts[:, 0].sum(1)
    left = np.cumsum(counts, axis=2)[:, :, :-1]
    right = whole[:, None, None] - left
    (impurity, total), (on_left, n_left), (on_right, n_right) = gini(whole), gini(left), gini(right)
    gain = impurity[:, None, None] - (n_left * on_left + n_right * on_right) / np.maximum(total, 1e-300)[:, None, None]
    allowed = ((left.sum(-1) >= least) & (right.sum(-1) >= least)
               & (np.arange(left.shape[2]) < bins[picked][:, :, None]))
    flat = np.where(allowed, gain, -1.0).reshape(len(counts), -1)
    best = flat.argmax(1) if flat.shape[1] else np.zeros(len(counts), np.intp)
    here, (at, bin_) = np.arange(len(counts)), np.divmod(best, max(left.shape[2], 1))
    found = flat[here, best] if flat.shape[1] else np.full(len(counts), -1.0)
    return {"gain": np.where(found > 0, found, -1.0), "feature": picked[here, at], "bin": bin_, "whole": whole,
            "left": left[here, at, bin_] if flat.shape[1] else whole * 0}


class HistogramForestClassifier(RandomForestClassifier):
    """Grows the forest of ``RandomForestClassifier`` from counts, and keeps no state per row and tree.

    The rows lie in blocks of one byte per feature and row.  A level of all trees is one job: a task finds the node of its
    rows in a tree by the splits so far, counts them by node, feature and bin, and goes on to the next tree; counts of a
    node meet in one task, which finds its split.  Only splits come to the driver.  Bags are drawn anew from the numbers of
    tree and block.  As there: quantile bins from a sample, the square root of the features per node, Gini impurity,
    Poisson bags, two equal leaves merged.  Weights must be equal within a class; other parameters than ``numTrees``,
    ``maxDepth``, ``maxBins``, ``minInstancesPerNode`` and ``seed`` are left at their defaults.
    """

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        spark, seed = dataset.sparkSession, self.getSeed() & (1 << 63) - 1
        trees, depth, most = self.getNumTrees(), self.getMaxDepth(), self.getMaxBins() - 1
        raw = checkpointed(dataset.select(
            vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"),
            F.col(self.getWeightCol()).cast("double").alias("w")).mapInArrow(_blocks, "block long, x binary, y binary, weights binary"))
        sizes = [(r.rows, np.frombuffer(r.weights)) for r in raw.groupBy("weights").agg(F.sum(F.length("y")).alias("rows")).collect()]
        total, classes = sum(n for n, _ in sizes), max(len(w) for _, w in sizes)
        weights = np.full(classes, np.nan)
        for _, known in sizes:
            if np.any((weights[:len(known)] != known) & ~np.isnan(weights[:len(known)]) & ~np.isnan(known)):
                raise ValueError("weights must be equal within a class")
            weights[:len(known)] = np.where(np.isnan(known), weights[:len(known)], known)
        weights = np.nan_to_num(weights)
        share = min(1.0, SAMPLE_ROWS / total)

        def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, x, y in zip(*(batch.column(c) for c in ("block", "x", "y"))):
                    x = np.frombuffer(x.as_buffer()).reshape(len(y.as_buffer()), -1)
                    taken = x[np.random.default_rng([seed, block.as_py()]).random(len(x)) < share]
                    yield pa.RecordBatch.from_arrays([binaries(taken.reshape(1, -1)), pa.array([x.shape[1]])], ["x", "features"])

        drawn = raw.mapInArrow(sample, "x binary, features long").collect()
        features = drawn[0].features
        values = np.concatenate([np.frombuffer(r.x).reshape(-1, features) for r in drawn])
        cuts = [thresholds(values[:, f], most) for f in range(features)]
        some, width = int(np.ceil(np.sqrt(features))), (max(map(len, cuts)) + 1) * classes
        code = code_type(width)
        words = -(-features * np.dtype(code).itemsize // 8)

        def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, x, y in zip(*(batch.column(c) for c in ("block", "x", "y"))):
                    y = np.frombuffer(y.as_buffer(), np.uint8)
                    x = np.frombuffer(x.as_buffer()).reshape(len(y), -1)
                    codes = np.zeros((len(y), 8 * words // np.dtype(code).itemsize), code)
                    for f, cut in enumerate(cuts):
                        codes[:, f] = np.searchsorted(cut, x[:, f]) * classes + y
                    yield pa.RecordBatch.from_arrays([pa.array([block.as_py()]), binaries(codes.reshape(1, -1))], ["block", "codes"])

        blocks = checkpointed(raw.mapInArrow(coded, "block long, codes binary"))
        cores = spark.sparkContext.defaultParallelism
        units = blocks.coalesce(max(min(cores, blocks.rdd.getNumPartitions()), -(-total // UNIT_ROWS)))
        bins, least = np.array([len(c) for c in cuts]), self.getMinInstancesPerNode()
        splits: list[dict[str, np.ndarray]] = []  # per level, arrays of (tree, node)
        open_ = np.ones((trees, 1), bool)
        for level in range(depth):
            nodes = 1 << level
            picked = np.random.default_rng([seed, level]).random((trees, nodes, features)).argsort(2)[:, :, :some]
            found = self._level(units, splits, open_, picked, bins, weights, classes, width, words, seed, least, cores)
            splits.append(found)
            parted = found["gain"] > 0
            children = np.stack([found["left"], found["whole"] - found["left"]], 2).reshape(trees, 2 * nodes, classes)
            mixed = (children > 0).sum(2) > 1
            open_ = np.repeat(parted, 2, axis=1) & mixed
            if not open_.any():
                break
        return _stored_model(spark, self, splits, cuts, weights, features)

    @staticmethod
    def _level(units: DataFrame, splits: list[dict[str, np.ndarray]], open_: np.ndarray, picked: np.ndarray, bins: np.ndarray,
               weights: np.ndarray, classes: int, width: int, words: int, seed: int, least: int, tasks: int) -> dict[str, np.ndarray]:
        """The best split of each open node, by (tree, node)."""
        (trees, nodes, some), code = picked.shape, code_type(width)
        # A node that is not split sends all its rows left, to nodes that are not open.
        above = [(np.where(s["gain"] > 0, s["feature"], 0).astype(np.int32),
                  np.where(s["gain"] > 0, (s["bin"] + 1) * classes - 1, np.iinfo(code).max).astype(code)) for s in splits]
        picked = picked.astype(np.int32)

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def counts(held: list[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
                for tree in np.flatnonzero(open_.any(1)):
                    path = [(f[tree].astype(np.intp), c[tree]) for f, c in above]
                    found = level_counts(held, tree, path, picked[tree], width, seed).reshape(nodes, -1)
                    met = np.flatnonzero(open_[tree] & found.any(1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(tree * nodes + met), binaries(found[met].astype(np.int32))], ["node", "counts"])

            held, rows = [], 0
            for batch in batches:
                for block, codes in zip(batch.column("block"), batch.column("codes")):
                    held.append((block.as_py(), np.frombuffer(codes.as_py(), np.uint64).reshape((-1, words) if words > 1 else -1)))
                    rows += len(held[-1][1])
                    if rows + BLOCK_ROWS > UNIT_ROWS:
                        yield from counts(held)
                        held, rows = [], 0
            if held:
                yield from counts(held)

        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, sums = np.zeros(0, np.int64), np.zeros((0, some * width), np.int64)
            for batch in batches:
                if not batch.num_rows:
                    continue
                keys = np.concatenate([keys, batch.column(0).to_numpy()])
                sums = np.concatenate([sums, matrix(batch.column(1), np.int32)])
                order = np.argsort(keys, kind="stable")
                starts = np.flatnonzero(np.diff(keys[order], prepend=-1))
                keys, sums = keys[order][starts], np.add.reduceat(sums[order], starts)
            for start in range(0, len(keys), NODES_AT_ONCE):
                node = keys[start:start + NODES_AT_ONCE]
                best = best_splits(sums[start:start + NODES_AT_ONCE].reshape(len(node), some, -1, classes),
                                   picked.reshape(-1, some)[node], bins, weights, least)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node), pa.array(best["gain"]), pa.array(best["feature"].astype(np.int32)),
                     pa.array(best["bin"].astype(np.int32)), binaries(best["whole"]), binaries(best["left"])],
                    ["node", "gain", "feature", "bin", "whole", "left"])

        out = (units.mapInArrow(counted, "node long, counts binary").repartition(tasks, "node")
               .mapInArrow(split, "node long, gain double, feature int, bin int, whole binary, left binary").toArrow().combine_chunks())
        at = out["node"].to_numpy()
        found = {"gain": np.full(trees * nodes, -1.0), "feature": np.zeros(trees * nodes, np.int32), "bin": np.zeros(trees * nodes, np.int32),
                 "whole": np.zeros((trees * nodes, classes), np.int64), "left": np.zeros((trees * nodes, classes), np.int64)}
        if len(at):
            for name, column in found.items():
                given = out[name].chunk(0) if out[name].num_chunks == 1 else pa.concat_arrays(out[name].chunks)
                column[at] = matrix(given, np.int64) if column.ndim == 2 else given.to_numpy()
        return {name: column.reshape(trees, nodes, *column.shape[1:]) for name, column in found.items()}


# --- as a model of MLlib ------------------------------------------------------------------------

def _stored_model(spark: SparkSession, forest: RandomForestClassifier, splits: list[dict[str, np.ndarray]], cuts: list[np.ndarray],
                  weights: np.ndarray, features: int) -> RandomForestClassificationModel:
    """The model, through the files that MLlib keeps of one."""
    trees, classes, depth = splits[0]["gain"].shape[0], len(weights), len(splits)
    parted = [s["gain"] > 0 for s in splits] + [np.zeros((trees, 1 << depth), bool)]
    rows = [splits[0]["whole"]] + [
        np.stack([s["left"], s["whole"] - s["left"]], 2).reshape(trees, -1, classes) for s in splits]
    guess = [(r * weights).argmax(2) for r in rows]
    for level in range(depth - 1, -1, -1):  # two leaves of one answer become one
        (l_parted, l_guess), (r_parted, r_guess) = ((parted[level + 1][:, side::2], guess[level + 1][:, side::2]) for side in (0, 1))
        parted[level] = parted[level] & (l_parted | r_parted | (l_guess != r_guess))
    there = [np.ones((trees, 1), bool)]
    for level in range(depth):
        there.append(np.repeat(there[level] & parted[level], 2, axis=1))

    # Levels one after the other, as in a heap; numbers follow that order and leave out what is not there.
    there, parted, rows, guess = (np.concatenate(parts, 1) for parts in (there, parted, rows, guess))
    ids, none = np.cumsum(there, 1) - 1, np.full((trees, 1 << depth), -1)
    gain, feature, bin_ = (np.concatenate([*(s[name] for s in splits), none], 1) for name in ("gain", "feature", "bin"))
    tree, place = np.nonzero(there)
    counts, inner = rows[tree, place], parted[tree, place]
    weighted = counts * weights
    children = [np.where(inner, ids[tree, np.where(inner, 2 * place + side, 0)], -1) for side in (1, 2)]
    feature = np.where(inner, feature[tree, place], -1)
    cut = np.zeros(len(tree))
    for f in range(features):
        cut[feature == f] = cuts[f][bin_[tree, place][feature == f]]
    nodes = pa.table({
        "treeID": tree.astype(np.int32), "id": ids[tree, place].astype(np.int32), "prediction": guess[tree, place].astype(np.float64),
        "impurity": 1.0 - ((weighted / np.maximum(weighted.sum(1, keepdims=True), 1e-300)) ** 2).sum(1),
        "impurityStats": pa.ListArray.from_arrays(np.arange(len(tree) + 1, dtype=np.int32) * np.int32(classes), weighted.ravel()),
        "rawCount": counts.sum(1), "gain": np.where(inner, gain[tree, place], -1.0),
        "leftChild": children[0].astype(np.int32), "rightChild": children[1].astype(np.int32),
        "featureIndex": feature.astype(np.int32), "cut": cut})

    path = scratch_path(spark, "forest")
    given = {p.name: v for p, v in forest._paramMap.items()}
    default = {p.name: v for p, v in forest._defaultParamMap.items()}

    def metadata(kind: str, uid: str, drop: Sequence[str] = (), **more: int) -> str:
        return json.dumps({
            "class": f"org.apache.spark.ml.classification.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
            "uid": uid, "paramMap": {k: v for k, v in given.items() if k not in drop},
            "defaultParamMap": {k: v for k, v in default.items() if k not in drop}, **more})

    def text(lines: list[str]) -> DataFrame:
        return spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1)

    text([metadata("RandomForestClassificationModel", forest.uid, numFeatures=features, numClasses=classes, numTrees=trees)]
         ).write.text(f"{path}/metadata")
    of_forest = ("bootstrap", "featureSubsetStrategy", "numTrees", "subsamplingRate")
    spark.createDataFrame([(t, metadata("DecisionTreeClassificationModel", f"dtc_{forest.uid}_{t}", of_forest), 1.0) for t in range(trees)],
                          "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    fields = ("id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild")
    split = F.struct("featureIndex", F.when(F.col("featureIndex") >= 0, F.array("cut")).otherwise(F.array().cast("array<double>")).alias(
        "leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories")).alias("split")
    spark.createDataFrame(nodes).select("treeID", F.struct(*fields, split).alias("nodeData")).write.parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)


# --- scoring ------------------------------------------------------------------------------------

class Votes:
    """The votes of a forest of MLlib, by row: its trees as arrays, its thresholds as ranks among those of a feature."""

    def __init__(self, spark: SparkSession, model: RandomForestClassificationModel):
        path = scratch_path(spark, "forest-nodes")
        model.write().save(path)
        nodes = spark.read.parquet(f"{path}/data").select(
            "treeID", "nodeData.id", "nodeData.leftChild", "nodeData.rightChild", "nodeData.impurityStats",
            "nodeData.split.featureIndex", F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("cut")
        ).toArrow().sort_by([("treeID", "ascending"), ("id", "ascending")])
        tree, node, left, right, feature, cut = (nodes[c].to_numpy() for c in ("treeID", "id", "leftChild", "rightChild", "featureIndex", "cut"))
        stats = nodes["impurityStats"].combine_chunks().flatten().to_numpy().reshape(len(tree), -1)
        total = stats.sum(1, keepdims=True)
        self.votes = np.divide(stats, total, out=np.zeros_like(stats), where=total != 0)
        self.cuts = [np.unique(cut[feature == f]) for f in range(model.numFeatures)]
        leaf = left < 0
        rank = np.full(len(cut), len(tree))
        for f, cuts in enumerate(self.cuts):
            rank[feature == f] = np.searchsorted(cuts, cut[feature == f])
        self.rank = np.where(leaf, 0, rank).astype(np.int32)
        self.feature = np.where(leaf, 0, feature).astype(np.int32)
        # A leaf is its own child, so all rows of a batch may take the same number of steps.
        self.child = np.stack([np.where(leaf, node, left), np.where(leaf, node, right)], 1).astype(np.int32)
        self.start = np.searchsorted(tree, np.arange(model.getNumTrees + 1))
        self.steps, at = np.zeros(model.getNumTrees, int), self.start[:-1]
        while len(at := at[~leaf[at]]):
            self.steps[tree[at]] += 1
            at = (self.start[tree[at], None] + self.child[at]).ravel()
            at = np.unique(at)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """The sum of the trees' class shares, per row of ``x`` and class, tree by tree as MLlib adds them."""
        ranks = np.stack([np.searchsorted(cuts, x[:, f]) for f, cuts in enumerate(self.cuts)], 1).astype(np.int32).ravel()
        first, out = np.arange(len(x)) * len(self.cuts), np.zeros((len(x), self.votes.shape[1]))
        for a, b, steps in zip(self.start[:-1], self.start[1:], self.steps):
            feature, rank, child = self.feature[a:b].astype(np.intp), self.rank[a:b], self.child[a:b].ravel().astype(np.intp)
            node = np.zeros(len(x), np.intp)
            for _ in range(steps):
                right = ranks.take(feature.take(node) + first) > rank.take(node)
                node *= 2
                node += right
                node = child.take(node)
            out += self.votes[a:b].take(node, axis=0)
        return out


def predicted(spark: SparkSession, model: RandomForestClassificationModel, features: Sequence[str | Column]) -> Column:
    """A struct of ``prediction`` and the probability of class 1, as the model's own columns have them."""
    votes = Votes(spark, model)

    @F.pandas_udf("prediction int, probability double")
    def scored(*columns: pd.Series) -> pd.DataFrame:
        x = np.stack([c.to_numpy(np.float64) for c in columns], 1)
        if np.isnan(x).any():
            raise ValueError("a feature is NaN")  # VectorAssembler stops there as well
        raw = votes(x)
        total = raw.sum(1)
        return pd.DataFrame({"prediction": raw.argmax(1).astype(np.int32), "probability": raw[:, 1] / np.where(total != 0, total, 1.0)})

    return scored(*features)
