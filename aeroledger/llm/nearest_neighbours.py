"""Nearest neighbours by inner product with multiprobe p-stable hashing and exact reranking.

The largest inner product becomes the least distance: rows fall into bands by the power of two of their norm, a row is divided
by the top norm of its band and completed to length one by one more coordinate, a query is divided by its norm.  A table hashes
a vector by ``m`` Gaussian projections cut into steps of ``WIDTH``.  Each band of each table is probed by perturbing the query's
hash by one step in some projections; the sets of projections, ranked by how near the query lies to their borders, are
visited in the order of the squared distance that is expected of them, estimated once for all queries.

How many tables, projections and probes are used is fitted: ``FIT_QUERIES`` queries are searched in all rows by brute force,
and the setting of least estimated work that finds ``FIT_RECALL`` of their neighbours is taken.  The bounded samples (these
queries, ``FIT_ROWS`` rows) are the only ones; every row is indexed, and no bucket is cut.  A bucket of more than
``CELL_ROWS`` rows or queries is searched in blocks.

Equal vectors are one class with its smallest ids, so a class of copies costs as much as one row.  A table's buckets meet
their queries in cells; a cell keeps each query's best classes by the exact inner product in double precision, and the best of
all cells and tables, repeated finds counted once, give the result.  Ties go to the smaller id.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without an id and vectors whose
length is not the most frequent one (of equally frequent ones the longest).  Rows equal in id and vector count once; a query
never finds a row of its own id.  An empty table, or one without a query, gives an empty result.  The result has columns of its
own only, so no column of the input can clash.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroledger.llm.common import lean, stored

WIDTH = 2.0
FIT_QUERIES, FIT_ROWS, FIT_RECALL = 96, 4096, 0.96
TABLES, PROJECTIONS, PROBES = (4, 8), (4, 6, 8, 10, 12, 16, 20), (1, 4, 16, 64, 256)
CELL_ROWS, LEAST_CELLS = 20_000, 64
# Cost of sending a query to a bucket, and of one inner product, in the same unit.
PROBE_COST, PRODUCT_COST = 100.0, 1.0
SEED = 20
MOST_SCORES, ANSWER_ROWS = 2_000_000, 10_000


# --- hashing ------------------------------------------------------------------------------------

def probe_sets(m: int, most: int) -> np.ndarray:
    """The first ``most`` perturbations as rows over the 2m (projection, side) pairs, nearest border first.

    The expected squared distance of the j-th nearest border has a closed form; a set never holds both sides of a
    projection, which are the j-th nearest and the j-th farthest.
    """
    j = np.arange(1, m + 1)
    near = j * (j + 1) / (4 * (m + 1) * (m + 2))
    k = 2 * m + 1 - np.arange(m + 1, 2 * m + 1)
    cost = [*near.tolist(), *(1 - k / (m + 1) + k * (k + 1) / (4 * (m + 1) * (m + 2))).tolist()]
    found: list[tuple[int, ...]] = [()]
    heap = [(cost[0], (0,))]
    while heap and len(found) < most:
        score, chosen = heapq.heappop(heap)
        if all(2 * m - 1 - c not in chosen for c in chosen):
            found.append(chosen)
        last = chosen[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (score - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (score + cost[last + 1], (*chosen, last + 1)))
    out = np.zeros((len(found), 2 * m), np.int8)
    for row, chosen in enumerate(found):
        out[row, list(chosen)] = 1
    return out


@dataclass
class Hashing:
    """``tables`` hash tables of ``m`` projections each, for vectors of ``dim`` components and the completing one."""
    dim: int
    m: int
    tables: int
    probes: int

    def __post_init__(self):
        rng = np.random.default_rng([SEED, self.dim, self.m])
        self.directions = rng.normal(size=(max(TABLES), self.dim + 1, self.m))[:self.tables]
        self.shifts = rng.uniform(0, WIDTH, (max(TABLES), self.m))[:self.tables]
        self.factors = rng.integers(1, 1 << 62, self.m + 2, dtype=np.int64) * 2 + 1
        self.sets = probe_sets(self.m, self.probes)

    def places(self, unit: np.ndarray, table: int) -> np.ndarray:
        return (unit @ self.directions[table] + self.shifts[table]) / WIDTH

    def keys(self, steps: np.ndarray, table: int, band: np.ndarray) -> np.ndarray:
        """One 64-bit key per row of hash values; buckets that share a key only add candidates."""
        with np.errstate(over="ignore"):
            head = band.astype(np.int64) * self.factors[-1] + np.int64(table) * self.factors[-2]
            mixed = steps.astype(np.int64) @ self.factors[:self.m]
            key = (mixed + head[..., None] if mixed.ndim > head.ndim else mixed + head) * self.factors[-1]
        return key ^ (key >> np.int64(31))

    def bucket(self, rows: np.ndarray, band: np.ndarray, table: int) -> np.ndarray:
        return self.keys(np.floor(self.places(rows, table)), table, band)

    def probed(self, queries: np.ndarray, band: int, table: int) -> np.ndarray:
        """Keys of the buckets that each query visits, in order."""
        places = self.places(queries, table)
        steps = np.floor(places)
        below = places - steps
        order = np.argsort(np.concatenate([below, 1 - below], axis=1), axis=1, kind="stable")
        moves = np.concatenate([-np.eye(self.m), np.eye(self.m)])[order]  # query, rank of the border, projection
        return self.keys(steps[:, None, :] + self.sets @ moves, table, np.full(len(queries), band))


def norm_of(vector: Column) -> Column:
    return F.sqrt(F.aggregate(F.transform(vector, lambda x: x.cast("double")), F.lit(0.0), lambda a, x: a + x * x))


def band_of(norm: Column, top: float) -> Column:
    """0 for norms above half of the largest, 1 above a quarter, and so on: a few thousand bands at most in doubles."""
    return F.greatest(F.floor(F.log2(F.lit(top)) - F.log2(norm)), F.lit(0)).cast("int")


def unit_rows(vectors: np.ndarray, band: np.ndarray, top: float) -> np.ndarray:
    """Rows divided by the top norm of their band and completed to length one."""
    scaled = vectors / np.ldexp(top, -band)[:, None]
    rest = np.sqrt(np.maximum(1 - np.einsum("ij,ij->i", scaled, scaled), 0))
    return np.concatenate([scaled, rest[:, None]], axis=1)


def unit_queries(vectors: np.ndarray) -> np.ndarray:
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    return np.concatenate([unit, np.zeros((len(unit), 1))], axis=1)


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Vectors of an Arrow list column as rows in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def exactly(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed in one order wherever they are computed."""
    return np.add.reduce(np.ascontiguousarray(a * b), axis=1)


# --- vectors and classes ------------------------------------------------------------------------

def usable(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, int, float]:
    """(id, vector of the rows that take part, their length, their largest norm)."""
    v = F.col("vector")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = (vectors.select(F.col(key).alias("id"), F.col(vector).alias("vector")).where(F.col("id").isNotNull() & v.isNotNull())
            .where(~odd & F.exists(v, lambda x: x != 0)))
    lengths = rows.groupBy(F.size(v).alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(norm_of(v)).alias("top"))
    best = lengths.orderBy(F.desc("n"), F.desc("dim")).first()
    if best is None:
        return rows.limit(0), 0, 0.0
    return rows.where(F.size(v) == best["dim"]), best["dim"], best["top"]


def classes_of(rows: DataFrame, k: int, top: float) -> DataFrame:
    """class (smallest id of the equal vectors), ids (the k + 1 smallest), vector, band.

    A query drops at most its own id, so k + 1 ids are all it can need.  The row number is limited before the shuffle,
    hence a class of any size sends a few rows per task.
    """
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    least = rows.dropDuplicates(["id", "vector"]).withColumn("place", place).where(F.col("place") <= k + 1)
    return least.groupBy("vector").agg(F.min("id").alias("class"), F.sort_array(F.collect_list("id")).alias("ids")).withColumn(
        "band", band_of(norm_of(F.col("vector")), top))


# --- fitting ------------------------------------------------------------------------------------

def brute_force(queries: np.ndarray, classes: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and bands of the ``k + 1`` best classes of a bounded set of queries; NaN where there are fewer."""
    dim, columns = queries.shape[1], ["class", "vector", "band"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = queries @ matrix(batch.column(1), dim).T
                best = np.argsort(-scores, axis=1, kind="stable")[:, :k + 1]
                query, flat = np.repeat(np.arange(len(queries)), best.shape[1]), pa.array(best.ravel())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query), *[c.take(flat) for c in batch.columns], pa.array(np.take_along_axis(scores, best, 1).ravel())],
                    ["q", *columns, "score"])

    kinds = ", ".join(f"{c} {classes.schema[c].dataType.simpleString()}" for c in columns)
    found = classes.select(*columns).mapInArrow(lean(run), f"q bigint, {kinds}, score double")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "class"))
    vectors, bands = np.full((len(queries), k + 1, dim), np.nan), np.zeros((len(queries), k + 1), np.int64)
    for r in found.withColumn("rank", rank).where(F.col("rank") <= k + 1).collect():
        vectors[r["q"], r["rank"] - 1], bands[r["q"], r["rank"] - 1] = r["vector"], r["band"]
    return vectors, bands


def sampled(rows: DataFrame, most: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and bands of at most ``most`` classes, the least by a hash of their vector."""
    found = rows.orderBy(F.xxhash64("vector", F.lit(seed)), "class").limit(most).select("vector", "band").collect()
    return np.array([r["vector"] for r in found], float), np.array([r["band"] for r in found], np.int64)


def fitted(classes: DataFrame, queries: DataFrame, top: float, k: int, n: int) -> Hashing:
    """The setting of least estimated work that finds ``FIT_RECALL`` of the sampled queries' neighbours."""
    (asked, _), (some, some_band) = sampled(queries, FIT_QUERIES, SEED), sampled(classes, FIT_ROWS, SEED + 1)
    truth, truth_band = brute_force(asked, classes, k)
    dim, shape = asked.shape[1], truth.shape[:2]
    present = ~np.isnan(truth[:, :, 0]) & ~(truth == asked[:, None, :]).all(axis=2)
    truth = np.where(present[:, :, None], truth, 0.0).reshape(-1, dim)
    near, rows = unit_rows(truth, truth_band.ravel(), top), unit_rows(some, some_band, top)
    bands = np.unique(np.concatenate([truth_band[present], some_band]))
    unit, best = unit_queries(asked), None
    for m in PROJECTIONS:
        hashing = Hashing(dim, m, max(TABLES), max(PROBES))
        probes = len(hashing.sets)
        found = np.full((max(TABLES), *shape), probes)     # first probe that reaches a neighbour, by table
        work = np.zeros((max(TABLES), probes))             # sampled rows read by each probe, by table
        for t in range(max(TABLES)):
            near_key = hashing.bucket(near, truth_band.ravel(), t).reshape(shape)
            keys, counts = np.unique(hashing.bucket(rows, some_band, t), return_counts=True)
            for band in bands.tolist():
                probed = hashing.probed(unit, band, t)
                at = np.minimum(np.searchsorted(keys, probed), len(keys) - 1)
                work[t] += np.where(keys[at] == probed, counts[at], 0).sum(axis=0)
                hit = near_key[:, :, None] == probed[:, None, :]
                found[t] = np.where(hit.any(axis=2), np.minimum(found[t], hit.argmax(axis=2)), found[t])
        for tables in TABLES:
            first = found[:tables].min(axis=0)
            for p in PROBES:
                recall = (first[present] < p).mean() if present.any() else 1.0
                read = work[:tables, :p].sum() / len(asked) / len(some) * n
                cost = tables * len(bands) * min(p, probes) * PROBE_COST + read * PRODUCT_COST
                # Enough recall first, then least work; without enough, most recall.
                rank = (recall < FIT_RECALL, cost if recall >= FIT_RECALL else -recall, cost)
                if best is None or rank < best[0]:
                    best = rank, (dim, m, tables, p)
    return Hashing(*best[1])


# --- index and search ---------------------------------------------------------------------------

def indexed(classes: DataFrame, hashing: Hashing, top: float, *carried: str) -> DataFrame:
    """bucket, class and the columns ``carried``: every class in every table."""
    names = ["bucket", "class", *carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                band = batch.column(1).to_numpy().astype(np.int64)
                rows = unit_rows(matrix(batch.column(0), hashing.dim), band, top)
                for t in range(hashing.tables):
                    yield pa.RecordBatch.from_arrays([pa.array(hashing.bucket(rows, band, t)), *batch.columns[2:]], names)

    kinds = ", ".join(f"{c} {classes.schema[c].dataType.simpleString()}" for c in names[1:])
    return classes.select(F.col("vector").alias("vector__"), "band", *names[1:]).mapInArrow(lean(run), f"bucket bigint, {kinds}")


def probing(queries: DataFrame, hashing: Hashing, bands: list[int]) -> DataFrame:
    """bucket, query (a class), vector: every bucket a query visits in any table and band, once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                some = batch.slice(low, 500)
                unit = unit_queries(matrix(some.column(1), hashing.dim))
                keys = np.concatenate([hashing.probed(unit, b, t) for t in range(hashing.tables) for b in bands], axis=1)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(list(keys), pa.list_(pa.int64())), some.column(1)],
                                                 ["query", "buckets", "vector"])

    kind, key = queries.schema["vector"].dataType.simpleString(), queries.schema["class"].dataType.simpleString()
    visits = queries.select("class", "vector").mapInArrow(lean(run), f"query {key}, buckets array<bigint>, vector {kind}")
    return visits.select(F.explode(F.array_distinct("buckets")).alias("bucket"), "query", "vector")


def crowded(side: DataFrame, name: str) -> DataFrame:
    """Buckets that hold more than ``CELL_ROWS`` of one side, with the number of blocks they are searched in."""
    sizes = side.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CELL_ROWS)
    return sizes.select("bucket", F.ceil(F.col("n") / CELL_ROWS).cast("long").alias(name))


def dealt(side: DataFrame, blocks: DataFrame, own: str, mine: str, other: str, cells: int) -> DataFrame:
    """``side`` with its cell; a row of a crowded bucket goes to one block of its side and to all of the other side."""
    n_mine, n_other = (F.coalesce(f"{c}s", F.lit(1).cast("long")) for c in (mine, other))
    placed = (side.join(blocks, "bucket", "left").withColumn(mine, F.pmod(F.xxhash64(own), n_mine))
              .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), n_other - 1))))
    key = F.xxhash64("bucket", "row_block", "query_block")
    return placed.select(F.pmod(key, F.lit(cells)).alias("cell"), key.alias("bucket"), *[c for c in side.columns if c != "bucket"])


def search_cell(rows: pa.Table, asks: pa.Table, dim: int, k: int) -> pa.Table:
    """The k + 1 best classes of each query among the rows that share one of its buckets in this cell."""
    schema = pa.schema([("query", asks.schema.field("query").type), ("class", rows.schema.field("class").type),
                        ("ids", rows.schema.field("ids").type), ("score", pa.float64())])
    if not rows.num_rows or not asks.num_rows:
        return schema.empty_table()
    x, q = matrix(rows["vector"], dim), matrix(asks["vector"], dim)
    buckets = asks["buckets"].combine_chunks()
    asked, by = buckets.flatten().to_numpy(), np.repeat(np.arange(len(q)), np.diff(buckets.offsets.to_numpy()))
    order, of_row = np.argsort(asked, kind="stable"), np.argsort(rows["bucket"].to_numpy(), kind="stable")
    asked, by, held = asked[order], by[order], rows["bucket"].to_numpy()[of_row]
    names = rows["class"].to_numpy()
    cuts = np.flatnonzero(np.concatenate([[True], asked[1:] != asked[:-1], [True]]))
    low, high = (np.searchsorted(held, asked[cuts[:-1]], side) for side in ("left", "right"))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for first, last, a, b in zip(cuts, cuts[1:], low, high):
        members = of_row[a:b]
        step = max(1, MOST_SCORES // max(len(members), 1))
        for start in range(first, last if len(members) else first, step):
            of = by[start:min(start + step, last)]
            scores = q[of] @ x[members].T
            if len(members) > k + 1:
                # The (k + 1)-th score bounds what is kept; what ties with it stays in.
                bound = np.partition(scores, len(members) - k - 1, axis=1)[:, [len(members) - k - 1]]
                at, place = np.nonzero(scores >= bound - 1e-9 * np.abs(bound))
            else:
                at, place = (v.ravel() for v in np.indices(scores.shape))
            found.append((of[at], members[place], scores[at, place]))
    if not found:
        return schema.empty_table()
    query, row, rough = (np.concatenate(f) for f in zip(*found))
    order = np.lexsort((names[row], query))
    query, row, rough = query[order], row[order], rough[order]
    once = np.concatenate([[True], (query[1:] != query[:-1]) | (names[row[1:]] != names[row[:-1]])])
    query, row, rough = query[once], row[once], rough[once]
    # Matrix products may round differently from block to block, so what comes near the bound is scored anew.
    order = np.lexsort((-rough, query))
    query, row, rough = query[order], row[order], rough[order]
    place = place_in_run(query)
    bound = np.full(len(q), -np.inf)
    bound[query[place == k]] = rough[place == k]
    kept = rough >= bound[query] - 1e-9 * np.abs(np.where(np.isfinite(bound), bound, 0))[query]
    query, row = query[kept], row[kept]
    score = np.concatenate([exactly(q[query[i:i + 8192]], x[row[i:i + 8192]]) for i in range(0, len(row), 8192)])
    order = np.lexsort((names[row], -score, query))
    query, row, score = query[order], row[order], score[order]
    kept = place_in_run(query) <= k
    query, row = pa.array(query[kept]), pa.array(row[kept])
    return pa.table([asks["query"].take(query), rows["class"].take(row), rows["ids"].take(row), pa.array(score[kept])], schema=schema)


def place_in_run(values: np.ndarray) -> np.ndarray:
    """0, 1, … within each run of equal values."""
    new = np.concatenate([[True], values[1:] != values[:-1]])
    at = np.arange(len(values))
    return at - np.maximum.accumulate(np.where(new, at, 0))


def best_classes(classes: DataFrame, queries: DataFrame, hashing: Hashing, top: float, k: int, n: int) -> DataFrame:
    """query (a class), found: the k + 1 best classes of each queried vector as (score, ids)."""
    bands = sorted(r["band"] for r in classes.select("band").distinct().collect())
    cells = max(LEAST_CELLS, n * hashing.tables // CELL_ROWS)
    visits = probing(queries, hashing, bands)
    blocks = crowded(indexed(classes, hashing, top), "row_blocks").join(crowded(visits.select("bucket"), "query_blocks"), "bucket", "full")
    rows = dealt(indexed(classes, hashing, top, "ids", "vector"), blocks, "class", "row_block", "query_block", cells)
    asks = dealt(visits, blocks, "query", "query_block", "row_block", cells).withColumnRenamed("cell", "of_cell")
    asks = asks.groupBy("of_cell", "query").agg(F.collect_list("bucket").alias("buckets"), F.first("vector").alias("vector"))
    dim, kind = hashing.dim, classes.schema["class"].dataType.simpleString()

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return search_cell(left, right, dim, k)

    found = rows.groupBy("cell").cogroup(asks.groupBy("of_cell")).applyInArrow(
        search, f"query {kind}, class {kind}, ids array<{kind}>, score double")
    # A query meets a class once per table at most; all of its finds are a few thousand rows.
    once = found.repartition("query").groupBy("query", "class").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "class"))
    return (once.withColumn("place", place).where(F.col("place") <= k + 1)
            .groupBy("query").agg(F.collect_list(F.struct("score", "ids")).alias("found")))


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, key: str = "vec_id", vector: str = "embedding",
            hashing: Hashing | None = None) -> DataFrame:
    """query_id, rank, ``key``, score: the k nearest rows found of every row whose id is divisible by ``every``.

    ``hashing`` fixes the setting that is otherwise fitted.
    """
    spark = vectors.sparkSession
    rows, dim, top = usable(vectors, key, vector)
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"query_id {kind}, rank int, `{key}` {kind}, score double"
    if not dim:
        return spark.createDataFrame([], schema)
    classes = stored(classes_of(rows, k, top), "vector-classes")
    # A vector asked for by many ids is searched once.
    asking = rows.where(F.col("id") % every == 0).select("id", "vector")
    heads = asking.groupBy("vector").agg(F.count(F.lit(1)).alias("n_queries"))
    queries = stored(classes.join(heads, "vector").select("class", "vector", "band", "n_queries"), "vector-queries")
    if queries.isEmpty():
        return spark.createDataFrame([], schema)
    n = classes.count()
    best = best_classes(classes, queries, hashing or fitted(classes, queries, top, k, n), top, k, n)
    # Queries with one vector are answered in blocks, so none of its copies wait for one task.
    blocks = F.ceil(F.col("n_queries") / ANSWER_ROWS).cast("long")
    answers = queries.join(best, queries["class"] == best["query"]).select(
        "vector", "class", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"), "found")
    often = queries.where(F.col("n_queries") > ANSWER_ROWS).select("vector", blocks.alias("blocks"))
    asks = asking.distinct().join(often, "vector", "left").select(
        "id", "vector", F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1).cast("long"))).alias("block"))
    pairs = (asks.join(answers, ["vector", "block"]).select("id", "class", F.explode("found").alias("f"))
             .select("id", "class", F.col("f.score").alias("score"), F.explode("f.ids").alias("other")).where(F.col("other") != F.col("id")))
    rank = F.row_number().over(Window.partitionBy("id", "class").orderBy(F.desc("score"), "other"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select(
        F.col("id").alias("query_id"), "rank", F.col("other").alias(key), "score")
