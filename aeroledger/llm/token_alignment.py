"""Alignment of a byte-level tokenizer (A) with a SentencePiece tokenizer (B) over the bytes of each text.

Both cut the same bytes, a space and the text.  Token-byte incidence matrices are kept in compressed rows built by hand, and
products are taken row by row after Gustavson: row i of A·Bᵀ adds up the rows of Bᵀ that row i of A names.  The product over
bytes gives the overlap links, each with its shared bytes.  Two tokens in a row share a group if an overlap link leads from
both to one token of the other side, so groups end where tokens of both sides end.  The products over groups (A's ids by
group, group by B's ids) give the shared-group links, and the product of documents by groups with those the links of each
document.  Equal groups are worked out once per chunk of texts, which also bounds what a frequent pair sends to one task of
the corpus-wide count: one row per chunk.

A text that is null or empty, or whose tokens do not spell its bytes again on either side, has no tokens: zeros and an empty
``groups_sha256``.  Repeated rows are documents of their own and count each, as do rows with a null id; order and ties do not
matter; an empty table gives an empty result.  Results have the key and columns of their own only, so no column of the input
can clash.  A long text is a chunk of its own; memory grows with the longest text and with the id pairs of a single group.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroledger.llm.common import lean, stored, whole_text

# The split of byte-level tokenizers, the mark of a space in pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MARK = "▁"

CHUNK_BYTES = 4 << 20
ALIGN_CHARACTERS = 1 << 19
MOST_WORK = 1 << 22


# --- compressed rows ----------------------------------------------------------------------------

@dataclass
class Rows:
    """A sparse matrix: row i has ``values[k]`` in ``columns[k]`` for k from ``starts[i]`` to ``starts[i + 1]``."""
    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    def __len__(self) -> int:
        return len(self.starts) - 1

    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)


def begins(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``first[k]``, ``first[k] + 1``, … (``sizes[k]`` of them) for each k, in one array."""
    ends = np.cumsum(sizes, dtype=np.int64)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - sizes), sizes)


def product(left: Rows, right: Rows) -> Rows:
    """left · right by rows, in blocks of rows whose work is bounded; columns of a row ascend."""
    picked = right.sizes()[left.columns]
    single = bool((picked == 1).all())
    work = left.starts if single else begins(picked)[left.starts]
    counts, columns, values = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    row = 0
    while row < len(left):
        stop = max(row + 1, int(np.searchsorted(work, work[row] + MOST_WORK, side="right")) - 1)
        here = slice(left.starts[row], left.starts[stop])
        taken, of_row, value = right.starts[left.columns[here]], np.arange(stop - row), left.values[here]
        of_row = np.repeat(of_row, np.diff(left.starts[row:stop + 1]))
        if not single:
            taken, of_row, value = spread(taken, picked[here]), np.repeat(of_row, picked[here]), np.repeat(value, picked[here])
        cell = of_row * right.width + right.columns[taken]
        value = value * right.values[taken]
        if len(cell) and (cell[1:] < cell[:-1]).any():
            order = np.argsort(cell, kind="stable")
            cell, value = cell[order], value[order]
        new = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.empty(0, np.int64)
        cell = cell[new]
        values.append(np.add.reduceat(value, new) if len(new) else value)
        columns.append(cell % right.width)
        counts.append(np.bincount(cell // right.width, minlength=stop - row))
        row = stop
    return Rows(begins(np.concatenate(counts)), np.concatenate(columns), np.concatenate(values), right.width)


def byte_rows(sizes: np.ndarray) -> Rows:
    """Tokens by bytes: each token holds the bytes that follow those of the token before it."""
    total = int(sizes.sum())
    return Rows(begins(sizes), np.arange(total), np.ones(total, np.int64), max(total, 1))


def byte_columns(sizes: np.ndarray) -> Rows:
    """Bytes by tokens: the transpose of ``byte_rows``, with the one token of each byte."""
    total = int(sizes.sum())
    return Rows(np.arange(total + 1), np.repeat(np.arange(len(sizes)), sizes), np.ones(total, np.int64), max(len(sizes), 1))


def overlaps(sizes_a: np.ndarray, sizes_b: np.ndarray) -> Rows:
    """Links of tokens that share bytes, valued by the bytes they share."""
    return product(byte_rows(sizes_a), byte_columns(sizes_b))


def groups_of(links: Rows, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Group of each A token and of each B token, from the overlap links."""
    if not len(links):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first, last = links.columns[links.starts[:-1]], links.columns[links.starts[1:] - 1]
    of_a = np.concatenate([[0], np.cumsum(first[1:] > last[:-1])])
    of_b = np.empty(n_b, np.int64)
    of_b[links.columns] = np.repeat(of_a, links.sizes())
    return of_a, of_b


# --- tokenizers ---------------------------------------------------------------------------------

class Vocabulary:
    """Bytes of every id, as one array with offsets."""

    def __init__(self, entries: list[bytes]):
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.starts = begins(self.sizes)[:-1]
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        return self.data[spread(self.starts[ids], self.sizes[ids])]


def byte_alphabet() -> dict[str, int]:
    """Characters of a byte-level vocabulary: printable bytes stand for themselves, the others for U+0100 onwards, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(others)}


class ByteTokens:
    """Byte-level tokens of a space and the text, by the vocabulary of a tokenizers file whose ids follow its merges."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in model["model"]["vocab"].items()}
        for k, merge in enumerate(model["model"]["merges"]):
            pair = merge.split(" ") if isinstance(merge, str) else merge
            if model["model"]["vocab"]["".join(pair)] != 256 + k:
                raise ValueError("ids do not follow the merges")
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        entries = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            entries[i] = token
        self.vocabulary = Vocabulary(entries)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(self.encoding.encode_ordinary(" " + t), np.int64) for t in texts]


class PieceTokens:
    """Pieces of a SentencePiece model, which puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.vocabulary = Vocabulary([
            bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i)
            else self.model.id_to_piece(i).replace(MARK, " ").encode() for i in range(self.model.get_piece_size())])

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


def spells(vocabulary: Vocabulary, found: list[np.ndarray], texts: list[bytes]) -> np.ndarray:
    """Whether each text's tokens spell its bytes."""
    ids = np.concatenate([np.empty(0, np.int64), *found])
    bounds = begins(np.array([len(f) for f in found]))
    sizes = np.diff(begins(vocabulary.sizes[ids])[bounds])
    same = sizes == [len(t) for t in texts]
    keep = np.repeat(same, np.diff(bounds))
    data = np.frombuffer(b"".join([t for t, s in zip(texts, same) if s]), np.uint8)
    wrong = begins(vocabulary.spelled(ids[keep]) != data)[begins(sizes[same])]
    same[same] = np.diff(wrong) == 0
    return same


@dataclass
class Aligned:
    """Tokens of a run of texts, one text after the other, and the group of each token."""
    ids_a: np.ndarray
    ids_b: np.ndarray
    bounds_a: np.ndarray
    bounds_b: np.ndarray
    links: Rows
    group_a: np.ndarray
    group_b: np.ndarray


def joined(parts: list[Aligned]) -> Aligned:
    """Runs of texts one after the other."""
    if len(parts) == 1:
        return parts[0]

    def end_to_end(arrays: list[np.ndarray], steps: list[int]) -> np.ndarray:
        return np.concatenate([a + s for a, s in zip(arrays, begins(np.array(steps)).tolist())])

    n_a, n_b = [len(p.ids_a) for p in parts], [len(p.ids_b) for p in parts]
    groups = [int(p.group_a[-1]) + 1 if len(p.group_a) else 0 for p in parts]
    links = [p.links for p in parts]
    starts = end_to_end([x.starts[:-1] for x in links], [len(x.columns) for x in links])
    return Aligned(
        np.concatenate([p.ids_a for p in parts]), np.concatenate([p.ids_b for p in parts]),
        np.append(end_to_end([p.bounds_a[:-1] for p in parts], n_a), sum(n_a)),
        np.append(end_to_end([p.bounds_b[:-1] for p in parts], n_b), sum(n_b)),
        Rows(np.append(starts, sum(len(x.columns) for x in links)), end_to_end([x.columns for x in links], n_b),
             np.concatenate([x.values for x in links]), max(sum(n_b), 1)),
        end_to_end([p.group_a for p in parts], groups), end_to_end([p.group_b for p in parts], groups))


class Aligner:
    """Aligns runs of texts; one per task."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = ByteTokens(byte_path), PieceTokens(piece_path)

    def __call__(self, texts: list[str]) -> Aligned:
        """Aligns about ``ALIGN_CHARACTERS`` at a time, so that the byte arrays stay in the processor's cache."""
        ends = begins(np.array([len(t) for t in texts]))
        edges = np.flatnonzero(np.diff(ends[:-1] // ALIGN_CHARACTERS, prepend=-1, append=-1)).tolist()
        return joined([self.align(texts[i:j]) for i, j in zip(edges, edges[1:])])

    def align(self, texts: list[str]) -> Aligned:
        none = np.empty(0, np.int64)
        whole = [b" " + t.encode() for t in texts]
        found_a, found_b = ([f if t else none for t, f in zip(texts, tokens(texts))] for tokens in (self.a, self.b))
        empty = np.array([not t for t in texts], bool)
        good = spells(self.a.vocabulary, found_a, whole) & spells(self.b.vocabulary, found_b, whole) & ~empty
        found_a, found_b = ([f if ok else none for f, ok in zip(found, good)] for found in (found_a, found_b))
        ids_a, ids_b = np.concatenate([none, *found_a]), np.concatenate([none, *found_b])
        links = overlaps(self.a.vocabulary.sizes[ids_a], self.b.vocabulary.sizes[ids_b])
        return Aligned(ids_a, ids_b, begins(np.array([len(f) for f in found_a])), begins(np.array([len(f) for f in found_b])),
                       links, *groups_of(links, len(ids_b)))


# --- groups of a chunk --------------------------------------------------------------------------

# Two odd numbers from the golden ratio and the square root of three.
STEPS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBB67AE8584CAA73B))


def row_hash(starts: np.ndarray, ids: np.ndarray, step: np.uint64) -> np.ndarray:
    """A 64-bit hash of the ids of each row and of their order."""
    sizes = np.diff(starts)
    powers = np.cumprod(np.full(max(int(sizes.max(initial=0)), 1), step))
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * step
    mixed ^= mixed >> np.uint64(29)
    return np.add.reduceat(mixed * powers[np.arange(len(ids)) - np.repeat(starts[:-1], sizes)], starts[:-1])


def distinct_groups(starts_a: np.ndarray, ids_a: np.ndarray, starts_b: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one group of each kind, kind of each group): groups are of a kind if both sides hold the same ids in order."""
    if len(starts_a) == 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    key = row_hash(starts_a, ids_a, STEPS[0]) * STEPS[1] ^ row_hash(starts_b, ids_b, STEPS[1])
    _, example, kind = np.unique(key, return_index=True, return_inverse=True)
    for starts, ids in ((starts_a, ids_a), (starts_b, ids_b)):
        sizes, like = np.diff(starts), example[kind]
        if (sizes != sizes[like]).any() or (ids != ids[spread(starts[like], sizes)]).any():
            # Two kinds share a hash: tell the groups apart by their ids.
            seen: dict[tuple, int] = {}
            rows = [(tuple(ids_a[starts_a[g]:starts_a[g + 1]]), tuple(ids_b[starts_b[g]:starts_b[g + 1]])) for g in range(len(kind))]
            kind = np.array([seen.setdefault(r, len(seen)) for r in rows], np.int64)
            return np.unique(kind, return_index=True)[1], kind
    return example, kind


def rows_of(starts: np.ndarray, ids: np.ndarray, chosen: np.ndarray, width: int) -> Rows:
    """The chosen rows, with repeated ids of a row added up."""
    sizes = np.diff(starts)[chosen]
    picked = Rows(begins(sizes), ids[spread(starts[chosen], sizes)], np.ones(int(sizes.sum()), np.int64), width)
    return product(picked, Rows(np.arange(width + 1), np.arange(width), np.ones(width, np.int64), width))


def group_links(a: Rows, b: Rows) -> tuple[Rows, np.ndarray]:
    """Shared-group links by group: (groups by id pairs, the pairs as A id times B's width plus B id).

    A's side is taken apart into one row per group and id, so a row of the product is never wider than B's vocabulary.
    """
    group = np.repeat(np.arange(len(a)), a.sizes())
    by_id = product(Rows(np.arange(len(group) + 1), group, a.values, max(len(a), 1)), b)
    cells = np.repeat(a.columns, by_id.sizes()) * b.width + by_id.columns
    pairs, place = np.unique(cells, return_inverse=True)
    starts = by_id.starts[a.starts]
    return Rows(starts, place, by_id.values, max(len(pairs), 1)), pairs


def group_names(starts_a: np.ndarray, ids_a: np.ndarray, starts_b: np.ndarray, ids_b: np.ndarray, chosen: np.ndarray) -> list[str]:
    """``a1,a2|b1`` for each chosen group."""
    sides = []
    for starts, ids in ((starts_a, ids_a), (starts_b, ids_b)):
        sizes = np.diff(starts)[chosen]
        digits = ids[spread(starts[chosen], sizes)].astype(str).tolist()
        bounds = begins(sizes).tolist()
        sides.append([",".join(digits[i:j]) for i, j in zip(bounds, bounds[1:])])
    return [f"{a}|{b}" for a, b in zip(*sides)]


def summary(texts: list[str], aligner: Aligner) -> tuple[list[dict], dict]:
    """(a row per text, the row of the chunk): groups by kind, and the id pairs of the kinds with their document counts."""
    al = aligner(texts)
    n_groups = int(al.group_a[-1]) + 1 if len(al.group_a) else 0
    marks = np.arange(n_groups + 1)
    starts_a, starts_b = np.searchsorted(al.group_a, marks), np.searchsorted(al.group_b, marks)
    example, kind = distinct_groups(starts_a, al.ids_a, starts_b, al.ids_b)
    names = np.array(group_names(starts_a, al.ids_a, starts_b, al.ids_b, example), object)
    links, pairs = group_links(rows_of(starts_a, al.ids_a, example, len(aligner.a.vocabulary.sizes)),
                               rows_of(starts_b, al.ids_b, example, len(aligner.b.vocabulary.sizes)))
    bounds = np.searchsorted(starts_a, al.bounds_a)  # groups never cross texts
    per_text = rows_of(bounds, kind, np.arange(len(texts)), max(len(example), 1))
    held = product(Rows(per_text.starts, per_text.columns, np.ones(len(per_text.columns), np.int64), per_text.width), links)
    n_links = np.add.reduceat(np.append(links.values, 0), links.starts[:-1]) if len(links) else np.empty(0, np.int64)
    out = []
    for k in range(len(texts)):
        of_text = slice(bounds[k], bounds[k + 1])
        mine = slice(per_text.starts[k], per_text.starts[k + 1])
        out.append({
            "n_a": int(al.bounds_a[k + 1] - al.bounds_a[k]), "n_b": int(al.bounds_b[k + 1] - al.bounds_b[k]),
            "n_groups": int(bounds[k + 1] - bounds[k]),
            "n_links": int((n_links[per_text.columns[mine]] * per_text.values[mine]).sum()),
            "groups_sha256": hashlib.sha256(";".join(names[kind[of_text]].tolist()).encode()).hexdigest()
            if bounds[k + 1] > bounds[k] else "",
            "kinds": per_text.columns[mine], "times": per_text.values[mine]})
    width = len(aligner.b.vocabulary.sizes)
    return out, {"pair_a": pairs // width, "pair_b": pairs % width, "pair_docs": np.bincount(held.columns, minlength=len(pairs)),
                 "link_starts": links.starts, "link_pairs": links.columns, "link_times": links.values}


# --- tables -------------------------------------------------------------------------------------

COUNTS = ("n_a", "n_b", "n_groups", "n_links")
INT_ARRAY = T.ArrayType(T.IntegerType(), False)
CHUNK_ARRAYS = ("pair_a", "pair_b", "pair_docs", "link_starts", "link_pairs", "link_times")


def text_runs(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes of text; a longer text is a range of its own."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
    ends = begins(sizes)
    first = 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + most, side="right")) - 1)
        yield first, last
        first = last


def chunk_summaries(docs: DataFrame, byte_path: str, piece_path: str, key: str, text: str) -> DataFrame:
    """Rows of documents and of their chunks (``pair_a`` not null); a chunk's name is unique within one stored result."""
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("key", docs.schema[key].dataType),
        *[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("groups_sha256", T.StringType()),
        *[T.StructField(c, INT_ARRAY) for c in ("kinds", "times", *CHUNK_ARRAYS)]])

    def lists(values: list) -> pa.Array:
        return pa.array([None if v is None else np.asarray(v, np.int32) for v in values], pa.list_(pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, chunk = Aligner(byte_path, piece_path), TaskContext.get().partitionId() << 32
        for batch in batches:
            for a, b in text_runs(batch.column(1), CHUNK_BYTES):
                texts, of_chunk = summary(batch.column(1).slice(a, b - a).to_pylist(), aligner)
                n = len(texts)
                keys = pa.concat_arrays([batch.column(0).slice(a, n), pa.nulls(1, batch.column(0).type)])
                yield pa.RecordBatch.from_arrays([
                    pa.array([chunk] * (n + 1), pa.int64()), keys,
                    *[pa.array([*[t[c] for t in texts], None], pa.int64()) for c in COUNTS],
                    pa.array([*[t["groups_sha256"] for t in texts], None], pa.string()),
                    *[lists([*[t[c] for t in texts], None]) for c in ("kinds", "times")],
                    *[lists([*[None] * n, of_chunk[c]]) for c in CHUNK_ARRAYS]], schema.names)
                chunk += 1

    return docs.select(F.col(key).alias("key"), whole_text(text).alias("text")).mapInArrow(lean(run), schema)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """a, b, n (documents that hold the pair linked), best (whether no other pair of the A id has more)."""
    counts = chunks.groupBy("a", "b").agg(F.sum("docs").alias("n"))
    # An A id has at most as many pairs as B has ids.
    return counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("a")))


def alignment(docs: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best`` counts the links whose pair has the highest document count among the pairs of its A id, ties included;
    ``count_sum`` adds up the pair counts of all links.
    """
    told = stored(chunk_summaries(docs, byte_path, piece_path, key, text), "token-alignment")
    pairs = told.where(F.col("pair_a").isNotNull()).select("chunk", F.posexplode(F.arrays_zip("pair_a", "pair_b", "pair_docs")).alias("place", "p"))
    pairs = pairs.select("chunk", "place", F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b"), F.col("p.pair_docs").cast("long").alias("docs"))
    answers = pairs.select("chunk", "place", "a", "b").join(pair_counts(pairs), ["a", "b"]).select(
        F.col("chunk").alias("of_chunk"), "place", "n", "best")
    needed = told.select("chunk", "key", *COUNTS, "groups_sha256", "kinds", "times", "link_starts", "link_pairs", "link_times")
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), *[T.StructField(c, T.LongType()) for c in (*COUNTS, "n_best", "count_sum")],
        T.StructField("groups_sha256", T.StringType())])

    def finish(rows: pa.Table, found: pa.Table) -> pa.Table:
        head = rows.filter(pc.is_valid(rows["link_starts"]))
        starts, places, times = (head[c].combine_chunks().flatten().to_numpy() for c in ("link_starts", "link_pairs", "link_times"))
        order = np.argsort(found["place"].to_numpy())
        n, best = found["n"].to_numpy()[order], found["best"].to_numpy()[order]
        per_kind = [np.diff(begins(times * of_pair[places])[starts]) for of_pair in (n, best.astype(np.int64))]
        own = rows.filter(pc.is_null(rows["link_starts"]))
        bounds = begins(pc.list_value_length(own["kinds"]).to_numpy())
        kinds, often = (own[c].combine_chunks().flatten().to_numpy() for c in ("kinds", "times"))
        sums, bests = (np.diff(begins(often * v[kinds])[bounds]) if len(kinds) else np.zeros(len(bounds) - 1, np.int64) for v in per_kind)
        return pa.table([own["key"], *[own[c] for c in COUNTS], pa.array(bests), pa.array(sums), own["groups_sha256"]], schema.names)

    return needed.groupBy("chunk").cogroup(answers.groupBy("of_chunk")).applyInArrow(finish, schema)


def token_groups(docs: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, ids and groups of both sides, and its overlap links as (place in A, place in B, shared bytes)."""
    arrays = ("ids_a", "ids_b", "group_a", "group_b", "link_a", "link_b", "shared_bytes")
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), *[T.StructField(c, INT_ARRAY) for c in arrays]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_path, piece_path)
        for batch in batches:
            for a, b in text_runs(batch.column(1), CHUNK_BYTES):
                al = aligner(batch.column(1).slice(a, b - a).to_pylist())
                of_link = np.repeat(np.arange(len(al.links)), al.links.sizes())
                rows = []
                for k in range(b - a):
                    of_a, of_b = (slice(s[k], s[k + 1]) for s in (al.bounds_a, al.bounds_b))
                    of_l = slice(al.links.starts[of_a.start], al.links.starts[of_a.stop])
                    base = al.group_a[of_a.start] if of_a.stop > of_a.start else 0
                    rows.append((al.ids_a[of_a], al.ids_b[of_b], al.group_a[of_a] - base, al.group_b[of_b] - base,
                                 of_link[of_l] - of_a.start, al.links.columns[of_l] - of_b.start, al.links.values[of_l]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     *[pa.array([np.asarray(r[i], np.int32) for r in rows], pa.list_(pa.int32())) for i in range(len(arrays))]],
                    schema.names)

    return docs.select(F.col(key), whole_text(text).alias("text__")).mapInArrow(lean(run), schema)
