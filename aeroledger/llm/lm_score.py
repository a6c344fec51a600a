"""Scoring texts with a hashed maximum-entropy language model.

The next word is predicted from hashed features of the words before it: the last word, the last two in order, and the one
before the last (a skip).  The softmax is factored by class: words belong to one of 32 x 32 leaves, the model gives the
first half of the leaf, then the second given the first, and inside a leaf words share the mass by add-one counts, with
one unit kept for words that training never saw.  The ``FREQUENT`` most frequent words have leaves of their own, all other
words share the rest by hash.

The corpus is encoded once, chunk by chunk, against each chunk's own vocabulary; Spark sums the counts of all words and
hands every chunk those of its own.  Training takes ``ROUNDS`` rounds over disjoint parts of all training documents: in a
round chunks are dealt by their names to walks of about ``WALK_CHUNKS``, which take them in order with stochastic gradient
steps from the same weights; a walk's changes of the rows it touched (half precision is ample for steps that are averaged)
are averaged, weighted by how often they were touched, in blocks that Spark groups.  The weights have a fixed size
(2 x 65,536 x 32 numbers), so they may be broadcast.

A chunk is named by its place in the input, and sums of half-precision numbers times counts are exact in double precision,
in whatever order they arrive: runs over the same files give the same scores.  Another division of the input into
partitions makes other chunks, hence other walks and slightly other scores.

Null counts as an empty text, which still has its end token.  Without training text every word is unseen.  Copies get
equal scores as long as they are all training or all held out, which does not enter the score at all.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroledger.llm.common import lean, stored, whole_text
from aeroledger.llm.fingerprints import scramble
from aeroledger.session import scratch_path
from aeroledger.sources.tables import delete_folder

CHUNK_BYTES = 6_000_000
CHUNK_TEXTS = 100_000
SIDE = 32
LEAVES = SIDE * SIDE
FREQUENT = LEAVES // 2
ROWS = 1 << 16
FEATURES = 3
ROUNDS = 2
BATCH = 8192
SCORED = 2048
FAR = 60
STEPS = 128
RATE = 0.25
BLOCKS = 64
WALK_CHUNKS = 4
END = b"\n"  # cannot occur in a word


def encode(docs: DataFrame) -> DataFrame:
    """A row per chunk of ``docs`` (doc, held, text): documents, local vocabulary with training counts, local ids."""
    kind = docs.schema["doc"].dataType.simpleString()
    schema = (f"chunk bigint, docs array<{kind}>, held array<boolean>, size array<int>, ids binary, "
              "words array<binary>, hashes binary, counts array<bigint>")

    def chunk_row(name, doc_type, docs_, held, texts):
        known: defaultdict[bytes, int] = defaultdict()
        known.default_factory = known.__len__
        ids, size = [], []
        for data, out in zip(texts, held):
            own = [known[w] for w in data.lower().split()]
            own.append(known[END])
            size.append(len(own))
            ids.extend(own)
        ids = np.array(ids, np.int64)
        trains = np.repeat(~np.array(held, bool), size)
        counts = np.bincount(ids[trains], minlength=len(known))
        words = list(known)
        hashes = np.array([zlib.crc32(w) for w in words], np.uint32)
        narrow = np.uint16 if len(words) <= 65536 else np.uint32
        return pa.RecordBatch.from_arrays(
            [pa.array([name], pa.int64()), pa.array([docs_], pa.list_(doc_type)), pa.array([held], pa.list_(pa.bool_())),
             pa.array([size], pa.list_(pa.int32())), pa.array([ids.astype(narrow).tobytes()], pa.binary()),
             pa.array([words], pa.list_(pa.binary())), pa.array([hashes.tobytes()], pa.binary()),
             pa.array([counts.tolist()], pa.list_(pa.int64()))], schema_names)

    schema_names = ["chunk", "docs", "held", "size", "ids", "words", "hashes", "counts"]

    def run(batches):
        name, total, kind_ = TaskContext.get().partitionId() << 32, 0, None
        ids, held, texts = [], [], []
        for batch in batches:
            kind_ = batch.column(0).type
            for i in range(batch.num_rows):
                ids.append(batch.column(0)[i].as_py())
                held.append(batch.column(1)[i].as_py())
                buffer = batch.column(2)[i].as_buffer()
                texts.append(buffer.to_pybytes() if buffer is not None else b"")
                total += len(texts[-1])
                if total >= CHUNK_BYTES or len(texts) >= CHUNK_TEXTS:
                    yield chunk_row(name, kind_, ids, held, texts)
                    name, total, ids, held, texts = name + 1, 0, [], [], []
        if texts:
            yield chunk_row(name, kind_, ids, held, texts)

    return docs.select("doc", "held", "text").mapInArrow(lean(run), schema)


def leaf_of(word: Column, top: DataFrame, totals: DataFrame) -> DataFrame:
    """``totals`` (word, c) with the leaf of each word.  ``top`` has FREQUENT rows at most, so it is broadcast."""
    shared = FREQUENT + F.pmod(F.crc32(word), F.lit(LEAVES - FREQUENT))
    return totals.join(F.broadcast(top), "word", "left").withColumn("leaf", F.coalesce("place", shared).cast("int")).drop("place")


class Model:
    """Weights of both halves of the softmax; rows are found by hashed features."""

    def __init__(self, first: np.ndarray, second: np.ndarray, bias_first: np.ndarray, bias_second: np.ndarray):
        self.first, self.second, self.bias_first, self.bias_second = first, second, bias_first, bias_second


def fresh_model(leaf_counts: np.ndarray) -> Model:
    """Zero features; biases say what the leaf counts say."""
    mass = leaf_counts.reshape(SIDE, SIDE) + 1.0
    rows = (ROWS, SIDE)
    of_first = mass.sum(1)
    return Model(np.zeros(rows, np.float32), np.zeros(rows, np.float32), np.log(of_first / of_first.sum()).astype(np.float32),
                 np.log(mass / of_first[:, None]).astype(np.float32))


def places_of(size: np.ndarray) -> np.ndarray:
    """Place of every token in its document."""
    starts = np.cumsum(size) - size
    return (np.arange(size.sum()) - np.repeat(starts, size)).astype(np.int32)


def features(hashes: np.ndarray, ids: np.ndarray, place: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Feature hashes of the tokens ``at``: last word, last two words, the one before the last.

    Callers ask for some thousand tokens at a time: those of a whole chunk would take 100 bytes and more a token.
    """
    def word(back: int) -> np.ndarray:
        there = place[at] >= back
        return np.where(there, hashes[ids[np.where(there, at - back, 0)]].astype(np.uint64) + np.uint64(2), np.uint64(1))

    before, skip = word(1), word(2)
    pair = before * np.uint64(0x9E3779B97F4A7C15) + skip
    return np.stack([scramble(before), scramble(pair ^ np.uint64(0xA5A5)), scramble(skip ^ np.uint64(0x5A5A0000))], axis=1)


def half(rows: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One half's softmax before it is divided: powers, and their total per token."""
    z = np.take(weights, rows[:, 0], axis=0, mode="clip")
    z += bias
    for k in range(1, rows.shape[1]):
        z += np.take(weights, rows[:, k], axis=0, mode="clip")
    if z.max(initial=0) > FAR or z.min(initial=0) < -FAR:  # powers would leave the range of single precision
        z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    return z, z @ np.ones(SIDE, np.float32)


def rows_for(feats: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight rows of both halves."""
    second = scramble(feats + (first.astype(np.uint64) + np.uint64(1))[:, None] * np.uint64(0xD6E8FEB86659FD93))
    mask = np.uint64(ROWS - 1)
    return (feats & mask).astype(np.int64), (second & mask).astype(np.int64)


def log_probabilities(model: Model, hashes: np.ndarray, ids: np.ndarray, size: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """Natural log-probability of each token's leaf; ``leaf`` is that of each word."""
    out, place = np.zeros(len(ids)), places_of(size)
    for i in range(0, len(ids), SCORED):
        some = slice(i, i + SCORED)
        own = leaf[ids[some]]
        a, b = own // SIDE, own % SIDE
        r1, r2 = rows_for(features(hashes, ids, place, np.arange(i, i + len(own))), a)
        at = np.arange(len(a))
        for rows, weights, bias, truth in ((r1, model.first, model.bias_first, a), (r2, model.second, model.bias_second[a], b)):
            powers, total = half(rows, weights, bias)
            own_powers = np.maximum(powers[at, truth], np.finfo(np.float32).tiny)  # a share of zero has no logarithm
            out[some] += np.log(own_powers) - np.log(total)
    return out


def sums_by_run(values: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of ``values[at]`` over each run; ``ends`` are the last places of the runs.

    Running sums are taken in all blocks of ``STEPS`` places at once, a place of each block after the other.  A run within
    a block is a difference of two of them; a run that crosses blocks also gets the totals of the blocks it leaves.
    """
    blocks = -(-len(at) // STEPS)
    places = np.zeros(blocks * STEPS, at.dtype)
    places[:len(at)] = at
    scan = np.take(values, places.reshape(blocks, STEPS).T, axis=0, mode="clip")
    for step in range(1, STEPS):
        scan[step] += scan[step - 1]
    left = np.concatenate([np.zeros((1, values.shape[1])), np.cumsum(scan[-1], axis=0, dtype=np.float64)])
    block, step = ends // STEPS, ends % STEPS
    inside = np.take(scan.reshape(blocks * STEPS, -1), step * blocks + block, axis=0, mode="clip")
    out = inside.copy()
    out[1:] -= inside[:-1]
    before = np.concatenate([[0], block[:-1]])
    crossing = np.flatnonzero(block != before)
    out[crossing] += left[block[crossing]] - left[before[crossing]]
    return out


def descend(weights: np.ndarray, sums: np.ndarray, touched: np.ndarray, rows: np.ndarray, wrong: np.ndarray) -> None:
    """One adaptive gradient step on the rows of a batch."""
    flat = rows.ravel()
    order = np.argsort(flat.astype(np.uint16), kind="stable")  # ROWS is 2**16: a radix sort
    sorted_rows = flat[order]
    ends = np.append(np.flatnonzero(sorted_rows[1:] != sorted_rows[:-1]), len(flat) - 1)
    gradient = sums_by_run(wrong, order // rows.shape[1], ends)
    own = sorted_rows[ends]
    power = sums[own] + np.einsum("ij,ij->i", gradient, gradient) / np.float32(SIDE)
    sums[own] = power
    gradient *= (RATE / np.sqrt(power))[:, None]
    moved = np.take(weights, own, axis=0, mode="clip")
    moved -= gradient
    weights[own] = moved
    touched[own] += np.diff(ends, prepend=-1)


def walk(model: Model, hashes: np.ndarray, ids: np.ndarray, size: np.ndarray, held: np.ndarray, leaf: np.ndarray, state: dict) -> None:
    """Gradient steps over the training tokens of a chunk; ``leaf`` is that of each word."""
    place, trains = places_of(size), np.flatnonzero(np.repeat(~held, size))
    for i in range(0, len(trains), BATCH):
        some = trains[i:i + BATCH]
        own = leaf[ids[some]]
        a, b = own // SIDE, own % SIDE
        r1, r2 = rows_for(features(hashes, ids, place, some), a)
        at = np.arange(len(a))
        for name, rows, bias, truth in (("first", r1, model.bias_first, a), ("second", r2, model.bias_second[a], b)):
            weights = getattr(model, name)
            wrong, total = half(rows, weights, bias)
            wrong /= total[:, None]
            wrong[at, truth] -= 1
            descend(weights, *state[name], rows, wrong)


def chunk_arrays(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, ...]:
    """ids, document sizes, which are held out, word hashes, word counts and word leaves of chunk ``i`` of a batch."""
    def numbers(name: str) -> np.ndarray:
        return batch.column(name)[i].values.to_numpy(zero_copy_only=False)

    size = numbers("size").astype(np.int64)
    ids = batch.column("ids")[i].as_buffer()
    kind = np.uint16 if ids.size == 2 * size.sum() else np.uint32
    return (np.frombuffer(ids, kind), size, numbers("held").astype(bool),
            np.frombuffer(batch.column("hashes")[i].as_buffer(), np.uint32), numbers("c"), numbers("leaf").astype(np.int64))


def train_round(chunks: DataFrame, model: Model) -> Model:
    """Walk all ``chunks`` from ``model``, task by task, and average what the tasks learned."""
    sent = chunks.sparkSession.sparkContext.broadcast(model)
    per = ROWS // BLOCKS

    def run(batches):
        start = sent.value
        own = Model(start.first.copy(), start.second.copy(), start.bias_first, start.bias_second)
        state = {n: (np.ones(ROWS, np.float32), np.zeros(ROWS, np.float32)) for n in ("first", "second")}
        for batch in batches:
            for i in range(batch.num_rows):
                ids, size, held, hashes, _, leaf = chunk_arrays(batch, i)
                walk(own, hashes, ids, size, held, leaf, state)
        for k, name in enumerate(("first", "second")):
            touched = state[name][1]
            moved = (getattr(own, name) - getattr(start, name)).astype(np.float16)
            for block in range(BLOCKS):
                part = slice(block * per, (block + 1) * per)
                if touched[part].any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k * BLOCKS + block], pa.int32()), pa.array([moved[part].tobytes()], pa.binary()),
                         pa.array([touched[part].tobytes()], pa.binary())], ["block", "moved", "touched"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moved, touched = np.zeros((per, SIDE), np.float64), np.zeros(per, np.float64)
        for batch in batches:
            for m, t in zip(batch.column(1), batch.column(2)):
                times = np.frombuffer(t.as_buffer(), np.float32)
                moved += np.frombuffer(m.as_buffer(), np.float16).reshape(per, SIDE) * times[:, None].astype(np.float64)
                touched += times
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([moved.tobytes()], pa.binary()),
                                          pa.array([touched.tobytes()], pa.binary())], ["block", "moved", "touched"])

    schema = "block int, moved binary, touched binary"
    walks = max(1, chunks.count() // WALK_CHUNKS)
    dealt = chunks.repartition(walks, "chunk").sortWithinPartitions("chunk")
    sums = dealt.select("size", "ids", "hashes", "c", "leaf", "held").mapInArrow(lean(run), schema).groupBy("block").applyInArrow(add, schema)
    out = Model(model.first.copy(), model.second.copy(), model.bias_first, model.bias_second)
    for row in sums.collect():  # at most 2 x BLOCKS rows, the size of the model
        weights = (out.first, out.second)[row.block // BLOCKS]
        part = slice((row.block % BLOCKS) * per, (row.block % BLOCKS + 1) * per)
        touched = np.frombuffer(row.touched)
        known = touched > 0
        change = np.frombuffer(row.moved).reshape(per, SIDE)[known] / touched[known, None]
        weights[part][known] += change.astype(np.float32)
    return out


def score_texts(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, held_out, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities)."""
    rows = docs.select(F.col(key).alias("doc"), held_out.alias("held"), F.encode(whole_text(text), "UTF-8").alias("text"))
    spark = docs.sparkSession
    passing = {name: scratch_path(spark, name) for name in ("encoded", "counted")}
    encoded = stored(encode(rows), "encoded", passing["encoded"])
    words = encoded.select("chunk", F.posexplode(F.arrays_zip("words", "counts"))).select(
        "chunk", F.col("pos").alias("local"), F.col("col.words").alias("word"), F.col("col.counts").alias("n"))
    # A word has a row per chunk at most; one shuffle tells each of them the count of all.
    of_word = Window.partitionBy("word").orderBy("chunk")
    counted = stored(words.withColumns({
        "c": F.sum("n").over(of_word.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        "first": F.row_number().over(of_word) == 1}).drop("n"), "counted", passing["counted"])
    totals = counted.where("first").select("word", "c")
    top = totals.where("c > 0").orderBy(F.desc("c"), "word").limit(FREQUENT).collect()
    ranks = spark.createDataFrame([(r.word, i) for i, r in enumerate(top)], "word binary, place int")
    by_leaf = {r.leaf: (r.c, r.v) for r in leaf_of(F.col("word"), ranks, totals).groupBy("leaf").agg(
        F.sum("c").alias("c"), F.count_if(F.col("c") > 0).alias("v")).collect()}  # LEAVES rows at most
    leaf_counts, leaf_words = (np.array([by_leaf.get(i, (0, 0))[k] for i in range(LEAVES)], np.float64) for k in (0, 1))
    told = leaf_of(F.col("word"), ranks, counted).groupBy("chunk").agg(
        F.sort_array(F.collect_list(F.struct("local", "c", "leaf"))).alias("v"))
    chunks = stored(encoded.drop("words", "counts").join(told, "chunk").select(
        "chunk", "docs", "held", "size", "ids", "hashes", F.col("v.c").alias("c"), F.col("v.leaf").alias("leaf")), "numbered")
    for path in passing.values():  # all that follows reads the numbered chunks
        delete_folder(spark, path)

    model = fresh_model(leaf_counts)
    for k in range(ROUNDS):
        model = train_round(chunks.where(F.pmod(F.xxhash64("chunk"), F.lit(ROUNDS)) == k), model)
    n, v = int(leaf_counts.sum()), int(leaf_words.sum())
    sent = spark.sparkContext.broadcast((model, leaf_counts, leaf_words))
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()),
        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        trained, in_leaf, of_leaf = sent.value
        doc_type = None
        for batch in batches:
            doc_type = batch.column(0).type.value_type
            for i in range(batch.num_rows):
                ids, size, held, hashes, c, leaf = chunk_arrays(batch, i)
                starts = np.cumsum(size) - size
                base = np.log10((c + 1.0) / (n + v + 1.0))[ids]
                inside = np.log10((c + 1.0) / (in_leaf[leaf] + of_leaf[leaf] + 1.0))[ids]
                total = log_probabilities(trained, hashes, ids, size, leaf) / np.log(10) + inside
                yield pa.RecordBatch.from_arrays(
                    [batch.column("docs")[i].values.cast(doc_type), pa.array(held, pa.bool_()), pa.array(size),
                     pa.array(np.add.reduceat((c[ids] > 0).astype(np.int64), starts)), pa.array(np.full(len(size), n)),
                     pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(total, starts))], schema.names)

    return chunks.select("docs", "held", "size", "ids", "hashes", "c", "leaf").mapInArrow(lean(run), schema)
