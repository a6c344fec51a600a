"""Near-duplicate components by exact Jaccard similarity of 5-word shingles, with a token-group matrix.

The matrix says which groups of documents have which token (shingle).  A document that is to share at least ``m`` tokens
with some member of a group must share ``m`` with the group's union, so groups below the bound are never opened.

1. Every document becomes a set of 64-bit shingle hashes.  A pair at 0.75 shares enough tokens that, of each set's
   smallest ``n - ceil(0.75 n) + l`` hashes, at least ``min(l, l')`` are common; only this prefix is exchanged.
2. First bound, one group of all other documents: chunks of documents send their distinct prefix tokens, learn which of
   them occur elsewhere, and drop documents with fewer than ``m`` of those.  A token costs one entry per chunk.
3. Equal sets become one class, and the bound is applied again to the whole sets of what is left: a class needs
   ``ceil(0.75 n)`` shingles that other classes have.
   In a few rounds, classes that agree on a min-hash are compared with the most central of them; links found so far join classes
   to groups of similar documents, and later rounds compare only across groups.
4. Second bound: the matrix of tokens and groups, for tokens of several groups.  Each class looks up its rarest tokens
   in other groups; for groups that have one and members of a fitting size, its overlap with the union of the group's tokens
   is counted, and those at 0.75 of its own set are opened: their fitting members are compared exactly.  Groups are
   connected already, so no pairs within a group are made.
5. Links of steps 3 and 4 give the components.

Null and empty texts have no shingles and are linked with nothing; fewer than five words are one shingle.  Every row is a
document of its own, known by 128 bits of id and text: rows that repeat an id with another text are linked by their own texts,
rows that agree in both have one outcome.  Null ids are linked like others; a component's id is the least that is not null, or
null if all are.  The similarity is that of hashed shingles (64 bits).
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroledger.llm.common import UPPER, fresh, lean, stored, whole_text
from aeroledger.llm.components import components
from aeroledger.llm.fingerprints import Names, scramble

SHINGLE = 5
CHUNK_BYTES = 4_000_000
BLOCK_BYTES = 1_000_000
MIN_HASHES = 3  # rounds
KEYS_A_ROUND = 4
RNG = np.random.default_rng(11)
PLACE = RNG.integers(0, 2**64, SHINGLE, np.uint64) | np.uint64(1)
SALTS = RNG.integers(0, 2**64, MIN_HASHES * KEYS_A_ROUND, np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[[ord(c) for c in UPPER]] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
CHUNK = ("docs array<bigint>, digests array<bigint>, n array<int>, s1 array<bigint>, s2 array<bigint>, "
         "size array<int>, tokens binary")


def needed(n):
    """ceil(0.75 n)"""
    return (3 * n + 3) // 4


def extra(n):
    return np.maximum(1, 3 * n // 20)


def prefix_length(n):
    return n - needed(n) + extra(n)


def least_shared(n):
    """Prefix tokens that a set of ``n`` shares with any partner at 0.75."""
    return extra(needed(n))


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending within each, and the number of each text.

    Texts are taken in blocks, as working arrays and the tables behind names are many times the size of a block.
    """
    blocks, size = [[]], 0
    for text in texts:
        size += len(text) + 1
        if size > BLOCK_BYTES and blocks[-1]:
            blocks.append([])
            size = len(text) + 1
        blocks[-1].append(text)
    hashes, counts = zip(*map(block_sets, blocks))
    return np.concatenate(hashes), np.concatenate(counts)


def block_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_sets`` of one block."""
    data = LOWER[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    space = IS_SPACE[data]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    words = scramble(Names(data).of(starts, ends) + scramble((ends - starts).astype(np.uint64)))
    first_byte = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    first_word = np.searchsorted(starts, first_byte)
    n_words = np.diff(first_word)
    n_shingles = np.where(n_words >= SHINGLE, n_words - SHINGLE + 1, np.minimum(n_words, 1))
    owner = np.repeat(np.arange(len(texts)), n_shingles)
    begin = np.arange(len(owner)) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles) + first_word[owner]
    size = np.minimum(n_words[owner], SHINGLE)
    padded = np.concatenate([words, np.zeros(SHINGLE, np.uint64)])
    total = size.astype(np.uint64)
    for j in range(SHINGLE):
        total += np.where(j < size, padded[begin + j] * PLACE[j], np.uint64(0))
    hashes = scramble(total)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])])[:len(hashes)]
    return hashes[fresh], np.bincount(owner[fresh], minlength=len(texts))


def sums_of(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests of each set."""
    at = np.concatenate([[0], np.cumsum(counts)])
    out = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(scramble(hashes ^ np.uint64(salt)))])
        out.append((total[at[1:]] - total[at[:-1]]).view(np.int64))
    return out[0], out[1]


def in_chunks(batch: pa.RecordBatch, text: int):
    """(rows, texts) of about ``CHUNK_BYTES`` together."""
    rows, texts, size = [], [], 0
    for i, value in enumerate(batch.column(text)):
        data = value.as_buffer()
        rows.append(i)
        texts.append(data.to_pybytes() if data is not None else b"")
        size += len(texts[-1])
        if size >= CHUNK_BYTES:
            yield rows, texts
            rows, texts, size = [], [], 0
    if rows:
        yield rows, texts


def known_by(key: str | Column, text: str | Column) -> list[Column]:
    """The two halves (doc, digest) of what a row is known by; never null."""
    return [F.xxhash64(key, text).alias("doc"), F.xxhash64(F.lit(1), key, text).alias("digest")]


def chunk_sets(docs: DataFrame) -> DataFrame:
    """A row per chunk: ids and what rows are known by, set sizes and digests, prefix tokens in one piece and their numbers."""
    kind = docs.schema["key"].dataType.simpleString()
    schema = f"chunk string, keys array<{kind}>, {CHUNK}"

    def run(batches):
        for batch in batches:
            for rows, texts in in_chunks(batch, 3):
                hashes, counts = shingle_sets(texts)
                s1, s2 = sums_of(hashes, counts)
                place = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
                taken = np.where(counts > 0, prefix_length(counts), 0)
                prefix = hashes[place < np.repeat(taken, counts)]
                known = [batch.column(c).take(pa.array(rows)) for c in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uuid.uuid4().hex]), *[pa.array([c.to_pylist()], pa.list_(c.type)) for c in known],
                     *[pa.array([list(x)], pa.list_(t)) for x, t in ((counts, pa.int32()), (s1, pa.int64()), (s2, pa.int64()),
                                                                     (taken, pa.int32()))],
                     pa.array([prefix.tobytes()], pa.binary())], ["chunk", "keys", "docs", "digests", "n", "s1", "s2", "size", "tokens"])

    return docs.select("key", "doc", "digest", "text").mapInArrow(lean(run), schema)


def shared_tokens(chunks: DataFrame) -> DataFrame:
    """Per chunk the prefix tokens that occur in more than one document, in pieces: chunk, tokens."""
    buckets = max(64, 16 * int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def deal(batches):
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens, times = np.unique(np.frombuffer(blob, np.uint64), return_counts=True)
                tokens = np.repeat(tokens, np.minimum(times, 2))  # twice: shared within the chunk
                bucket = (tokens % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                tokens, bucket = tokens[order], bucket[order]
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                parts = np.split(tokens, cuts) if len(tokens) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(bucket[c]) for c in ([0, *cuts] if len(tokens) else [])], pa.int32()), pa.array([chunk] * len(parts), pa.string()),
                     pa.array([p.tobytes() for p in parts], pa.binary())], ["bucket", "chunk", "tokens"])

    def meet(batches):
        names, blobs = [], []
        for batch in batches:
            names.extend(batch.column(1).to_pylist())
            blobs.extend(batch.column(2).to_pylist())
        if not blobs:
            return
        tokens, times = np.unique(np.frombuffer(b"".join(blobs), np.uint64), return_counts=True)
        several = tokens[times > 1]
        for i in range(0, len(blobs), 2000):
            out = []
            for blob in blobs[i:i + 2000]:
                own = np.unique(np.frombuffer(blob, np.uint64))
                at = np.minimum(np.searchsorted(several, own), max(0, len(several) - 1))
                out.append(own[several[at] == own].tobytes() if len(several) else b"")
            yield pa.RecordBatch.from_arrays([pa.array(names[i:i + 2000], pa.string()), pa.array(out, pa.binary())], ["chunk", "tokens"])

    dealt = chunks.select("chunk", "tokens").mapInArrow(lean(deal), "bucket int, chunk string, tokens binary")
    return dealt.repartition("bucket").mapInArrow(lean(meet), "chunk string, tokens binary").where(F.octet_length("tokens") > 0)


def survivors(chunks: DataFrame, shared: DataFrame, least) -> DataFrame:
    """Documents with at least ``least(n)`` shared tokens: doc, digest, n, s1, s2 and those tokens."""
    told = shared.groupBy("chunk").agg(F.collect_list("tokens").alias("shared"))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n, size = np.array(row["n"], np.int64), np.array(row["size"], np.int64)
                tokens, known = np.frombuffer(row["tokens"], np.uint64), np.frombuffer(b"".join(row["shared"]), np.uint64)
                owner = np.repeat(np.arange(len(n)), size)
                hit = np.isin(tokens, known)
                counts = np.bincount(owner[hit], minlength=len(n))
                kept = np.flatnonzero((n > 0) & (counts >= least(n)))
                ends = np.cumsum(counts)
                found = tokens[hit]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array([row[c][i] for i in kept], pa.int32() if c == "n" else pa.int64()) for c in ("docs", "digests", "n", "s1", "s2")],
                     pa.array([found[ends[i] - counts[i]:ends[i]].tobytes() for i in kept], pa.binary())],
                    ["doc", "digest", "n", "s1", "s2", "tokens"])

    joined = chunks.join(told, "chunk").select("docs", "digests", "n", "s1", "s2", "size", "tokens", "shared")
    return joined.mapInArrow(lean(run), "doc bigint, digest bigint, n int, s1 bigint, s2 bigint, tokens binary")


def full_sets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Whole sets and min-hashes of classes (n, s1, s2, node; doc and digest of a member): doc (the node), n, items (binary), keys."""
    wanted = docs.join(classes, ["doc", "digest"]).select("node", "text", "n", "s1", "s2")

    def run(batches):
        for batch in batches:
            meta = [batch.column(i).to_numpy() for i in range(2, 5)]
            for rows, texts in in_chunks(batch, 1):
                hashes, counts = shingle_sets(texts)
                s1, s2 = sums_of(hashes, counts)
                ends = np.cumsum(counts)
                right = [k for k, i in enumerate(rows) if counts[k] == meta[0][i] and s1[k] == meta[1][i] and s2[k] == meta[2][i]]
                sets = [hashes[ends[k] - counts[k]:ends[k]] for k in right]
                keys = [[int(scramble(s ^ salt).min().view(np.int64)) for salt in SALTS] for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([rows[k] for k in right], pa.int64())), pa.array([len(s) for s in sets], pa.int32()),
                     pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    ["doc", "n", "items", "keys"])

    return wanted.mapInArrow(lean(run), "doc bigint, n int, items binary, keys array<bigint>").dropDuplicates(["doc"])


def set_chunks(sets: DataFrame) -> DataFrame:
    """Whole sets in the form of ``chunk_sets``, without ids."""

    def run(batches):
        for batch in batches:
            for rows, blobs in in_chunks(batch, 2):
                at = pa.array(rows)
                n, none = batch.column(1).take(at).to_pylist(), [0] * len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uuid.uuid4().hex]), pa.array([batch.column(0).take(at).to_pylist()], pa.list_(pa.int64())),
                     pa.array([none], pa.list_(pa.int64())), pa.array([n], pa.list_(pa.int32())), *[pa.array([none], pa.list_(pa.int64()))] * 2,
                     pa.array([n], pa.list_(pa.int32())), pa.array([b"".join(blobs)], pa.binary())],
                    ["chunk", "docs", "digests", "n", "s1", "s2", "size", "tokens"])

    return sets.select("doc", "n", "items").mapInArrow(lean(run), f"chunk string, {CHUNK}")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sets have a similarity of at least 0.75."""

    def side(name: str) -> DataFrame:
        return sets.select(F.col("doc").alias(name), F.col("items").alias(f"items_{name}"))

    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (a, b))
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                keep.append(100 * common >= 75 * (len(x) + len(y) - common))
            some = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"])
            yield some.filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "items_a", "items_b")
    return joined.mapInArrow(lean(run), "a bigint, b bigint")


def token_rows(classes: DataFrame) -> DataFrame:
    """(doc, token) of the shared prefix tokens."""

    def run(batches):
        for batch in batches:
            blobs = [np.frombuffer(b, np.int64) for b in batch.column(1).to_pylist()]
            rows = np.repeat(np.arange(len(blobs)), [len(b) for b in blobs])
            tokens = np.concatenate(blobs) if blobs else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), batch.column(2).take(pa.array(rows)),
                                              pa.array(tokens)], ["doc", "n", "token"])

    return classes.select("doc", "tokens", "n").mapInArrow(lean(run), "doc bigint, n int, token bigint")


def sql_share(n: Column, over: int, under: int) -> Column:
    """ceil(n * over / under)"""
    return F.floor((over * n + under - 1) / under).cast("int")


def across_groups(classes: DataFrame, groups: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) between members of different groups.  ``groups``: node, component.

    Only tokens of several groups count, those of the fewest documents first, as asking and held rows meet token by token.
    A pair of ``n`` and ``n_other`` tokens at 0.75 shares at least 3/7 of their sum, so its first shared token has that
    many left in both sets, itself included (``rest``).  The smaller set is held by the matrix where 6/7 of it are left, the larger asks
    where 3/4 are left; a group is looked at where the sizes fit and enough tokens are left for its least fitting member, and
    opens if 3/4 of the asking set are in the union of the group's tokens.
    """
    rows = token_rows(classes).join(groups.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
        "grp", F.coalesce("component", "doc")).select("doc", "n", "token", "grp")
    spread = rows.groupBy("token").agg(F.count("*").alias("df"), F.min("grp").alias("lo"), F.max("grp").alias("hi")).where("lo != hi")
    crossing = rows.join(spread, "token").groupBy("doc", "n", "grp").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("ranked"))
    crossing = stored(crossing, "crossing")
    n, rest = F.col("n"), F.col("rest")
    rare = crossing.select("doc", "n", "grp", F.size("ranked").alias("c"), F.posexplode("ranked").alias("place", "t")).select(
        "doc", "n", "grp", F.col("t.token").alias("token"), (F.col("c") - F.col("place")).alias("rest"))
    rare = stored(rare.where(4 * rest >= 3 * n), "rare")
    held = rare.where(7 * rest >= 6 * n).select("token", F.col("grp").alias("other"), F.col("n").alias("n_other"),
                                                F.col("rest").alias("rest_other"), F.col("doc").alias("b"))
    matrix = held.groupBy("token", "other").agg(F.min("n_other").alias("least"), F.max("n_other").alias("most"),
                                                F.max("rest_other").alias("rest_other"))

    def enough(n_other: Column) -> Column:
        return (7 * rest >= 3 * (n + n_other)) & (7 * F.col("rest_other") >= 3 * (n + n_other))

    fits = (F.col("other") != F.col("grp")) & (F.col("least") <= n) & (4 * F.col("most") >= 3 * n)
    opened = rare.join(matrix, "token").where(fits & enough(F.greatest(F.col("least"), sql_share(n, 3, 4))))
    opened = stored(opened.select("doc", "n", "rest", "token", "other").distinct(), "opened")
    opened = opened.join(overlapping(opened.select("doc", "n", "other").distinct(), crossing), ["doc", "other"])
    pairs = opened.join(held, ["token", "other"]).where(
        (F.col("n_other") <= n) & (4 * F.col("n_other") >= 3 * n) & enough(F.col("n_other")))
    return pairs.select(F.greatest("doc", "b").alias("a"), F.least("doc", "b").alias("b")).distinct()


def overlapping(asked: DataFrame, crossing: DataFrame) -> DataFrame:
    """(doc, other) of ``asked`` (doc, n, other) where group ``other`` has three quarters of the tokens of ``doc``.

    Every token that two groups share is in ``crossing``, so the overlap with a group's union of tokens is counted exactly.
    """
    wanted = asked.select("other").distinct()
    union = crossing.join(wanted, F.col("grp") == F.col("other"), "left_semi").select(
        F.col("grp").alias("other"), F.explode("ranked.token").alias("token")).distinct()
    sought = asked.join(crossing.select("doc", F.col("ranked.token").alias("tokens")), "doc").select(
        "doc", "n", "other", F.explode("tokens").alias("token"))
    return sought.join(union, ["other", "token"]).groupBy("doc", "n", "other").count().where(
        4 * F.col("count") >= 3 * F.col("n")).select("doc", "other")


def central(near: DataFrame) -> DataFrame:
    """(doc, weight): how many documents have an average shingle of each; the original of many near copies stands out."""
    rows = token_rows(near)
    spread = rows.groupBy("token").agg(F.count("*").alias("df"))
    return rows.join(spread, "token").groupBy("doc").agg((F.sum("df") / F.max("n")).alias("weight"))


def alike(sets: DataFrame, groups: DataFrame | None, k: int) -> DataFrame:
    """Pairs of a document and the most central one with the same min-hash, for the ``k``-th hashes, across groups."""
    rows = sets.select("doc", "weight", "s1", "s2", F.explode(F.slice("keys", KEYS_A_ROUND * k + 1, KEYS_A_ROUND)).alias("k"))
    if groups is not None:
        rows = rows.join(groups.withColumnRenamed("node", "doc"), "doc", "left")
    else:
        rows = rows.withColumn("component", F.lit(None).cast(rows.schema["doc"].dataType))
    rows = rows.withColumn("grp", F.coalesce("component", "doc"))
    lead = rows.groupBy("k").agg(F.max(F.struct("weight", "s1", "s2", "doc", "grp")).alias("l"), F.min("grp").alias("lo"),
                                 F.max("grp").alias("hi")).where("lo != hi").drop("lo", "hi")
    return rows.join(lead, "k").where("grp != l.grp").select(F.col("doc").alias("a"), F.col("l.doc").alias("b")).distinct()


def members(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: key, doc, digest, n, links, and ``first``: (no_key, key, doc, digest) of the component's first row, null without shingles."""
    texts = docs.select(F.col(key).alias("key"), F.encode(whole_text(text), "UTF-8").alias("text"))
    texts = texts.select("key", *known_by("key", "text"), "text")
    chunks = stored(chunk_sets(texts), "chunks")
    shared = stored(shared_tokens(chunks), "shared")
    near = survivors(chunks, shared, least_shared)
    classes = near.groupBy("n", "s1", "s2").agg(F.min(F.struct("doc", "digest")).alias("m"))
    classes = stored(classes.select("n", "s1", "s2", "m.*", F.monotonically_increasing_id().alias("node")), "classes")
    sets = stored(full_sets(texts, classes), "sets")
    whole = stored(set_chunks(sets), "whole")
    near = stored(survivors(whole, shared_tokens(whole), needed), "near")
    sums = classes.select(F.col("node").alias("doc"), "s1", "s2")
    sets = stored(sets.join(central(near), "doc").join(sums, "doc"), "sets")

    links, groups = None, None
    for k in range(MIN_HASHES):
        new = stored(verified(alike(sets, groups, k), sets), "links")
        links = new if links is None else links.unionByName(new)
        groups = components(links)
    links = links.unionByName(stored(verified(across_groups(near, groups), sets), "links"))
    found = components(links)
    degree = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).groupBy("node").agg(
        F.count("*").alias("links"))
    linked = classes.join(found, "node").join(degree, "node", "left").select("n", "s1", "s2", "component", "links")

    everyone = chunks.select(F.explode(F.arrays_zip("keys", "docs", "digests", "n", "s1", "s2")).alias("d")).select(
        F.col("d.keys").alias("key"), F.col("d.docs").alias("doc"), F.col("d.digests").alias("digest"), "d.n", "d.s1", "d.s2")
    place = F.struct(F.col("key").isNull().alias("no_key"), "key", "doc", "digest")
    of_class = everyone.where("n > 0").groupBy("n", "s1", "s2").agg(F.min(place).alias("own"))
    of_class = stored(of_class.join(linked, ["n", "s1", "s2"], "left"), "components")
    firsts = of_class.where("component IS NOT NULL").groupBy("component").agg(F.min("own").alias("first"))
    of_class = of_class.join(firsts, "component", "left").select("n", "s1", "s2", F.coalesce("first", "own").alias("first"), "links")
    return everyone.join(of_class, ["n", "s1", "s2"], "left").select("key", "doc", "digest", "n", "first", "links")


def similar_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_shingles, component_id (least id reachable by links) and n_links of its class."""
    return members(docs, key, text).select(
        F.col("key").alias(key), F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("first.key", "key").alias("component_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, that with the least id, all columns; all documents without shingles.

    Of several rows with the least id (or of rows that all lack one) one text stays; rows that agree in id and text are one document.
    """
    one, two = fresh(docs, "known", "known_digest")
    stay = members(docs, key, text).where(
        (F.col("n") == 0) | ((F.col("first.doc") == F.col("doc")) & (F.col("first.digest") == F.col("digest"))))
    stay = stay.select(F.col("doc").alias(one), F.col("digest").alias(two))
    first, second = known_by(F.col(key), F.encode(whole_text(text), "UTF-8"))
    marked = docs.withColumns({f"{one}_of": first, f"{two}_of": second})
    kept = marked.join(stay, (F.col(f"{one}_of") == F.col(one)) & (F.col(f"{two}_of") == F.col(two)), "left_semi")
    return kept.drop(f"{one}_of", f"{two}_of")
