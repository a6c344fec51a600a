"""Fill-in-middle: texts cut at two code points and put in another order, with markers between the pieces.

The cuts are found on the UTF-8 bytes themselves, eight at a time.  The Arrow buffer of a run of texts is viewed as unsigned
64-bit words; bit arithmetic sets the top bit of every byte that ends a code point; ``bitwise_count`` gives the code points of
each word and their running sum those before it.  The word of the k-th code point comes from a search in that sum, its byte
from a select inside the word.  No text is decoded and no byte is visited on its own.

Null counts as an empty text, a null id as an empty id; both are plain.  Rows are independent: copies, ties and order do not
matter, an empty table gives an empty result.  The result has the key and columns of its own only, so extra columns of the
input cannot clash.  A long text is a run of its own; memory grows with the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroledger.llm.common import lean, whole_text

# Markers, and the shares of texts that are cut and that begin with the suffix, in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUT_SHARE, SUFFIX_FIRST_SHARE = 90, 20

RUN_BYTES = 4 << 20
ONES = np.uint64(0x0101010101010101)
TOPS = np.uint64(0x8080808080808080)
PLAIN, PSM, SPM = 0, 1, 2
FORMS = ("plain", "psm", "spm")


def ending_marks(words: np.ndarray) -> np.ndarray:
    """Top bit of every byte that ends a code point; the byte after the last word counts as the start of another.

    A byte continues a code point if it is ``10xxxxxx``; a byte ends one if the byte after it does not continue it.
    """
    starts = ~(words & ~(words << np.uint64(1))) & TOPS
    marks = starts >> np.uint64(8)
    marks[:-1] |= starts[1:] << np.uint64(56)
    marks[-1] |= np.uint64(1 << 63)
    return marks


class CodePoints:
    """Counts and finds code points in UTF-8 bytes."""

    def __init__(self, data: np.ndarray):
        padded = np.zeros(len(data) // 8 * 8 + 8, np.uint8)  # a zero byte follows the data, so its last byte ends a code point
        padded[:len(data)] = data
        self.marks = ending_marks(padded.view("<u8"))
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)])

    def up_to(self, places: np.ndarray) -> np.ndarray:
        """Code points that end before each byte offset."""
        word, byte = places >> 3, (places & 7).astype(np.uint64)
        below = (np.uint64(1) << (byte * np.uint64(8))) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.marks[word] & below).astype(np.int64)

    def end_of(self, ranks: np.ndarray) -> np.ndarray:
        """Byte offset just after the code point with each 1-based rank; 0 for rank 0."""
        word = np.searchsorted(self.before, ranks, side="left") - 1
        word = np.maximum(word, 0)
        within = np.maximum(ranks - self.before[word], 1).astype(np.uint64)
        # Byte i of the product holds the marks in bytes 0 to i; the bytes that hold fewer than ``within`` lie before it.
        running = (self.marks[word] >> np.uint64(7)) * ONES
        fewer = (((within - np.uint64(1)) * ONES | TOPS) - running) & TOPS
        return np.where(ranks == 0, 0, word * 8 + np.bitwise_count(fewer).astype(np.int64) + 1)


def runs(offsets: np.ndarray, most: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes together; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        yield first, last
        first = last


def arranged(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray,
             forms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Code points, prefix code points and middle code points of each text, and the text in its form."""
    base = offsets[0]
    bounds = offsets - base
    points = CodePoints(data[base:offsets[-1]])
    seen = points.up_to(bounds)
    n = np.diff(seen)
    cuts = np.sort(draws % (n + 1)[:, None], axis=1)
    ends = points.end_of(seen[:-1, None] + cuts)
    ends = np.where(cuts == 0, bounds[:-1, None], ends)
    whole = data[base:offsets[-1]].tobytes()
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    out = []
    for a, b, c, d, form in zip(bounds[:-1].tolist(), ends[:, 0].tolist(), ends[:, 1].tolist(), bounds[1:].tolist(),
                                forms.tolist()):
        if form == PLAIN:
            out.append(whole[a:d])
        elif form == PSM:
            out.append(b"".join((p, whole[a:b], s, whole[c:d], m, whole[b:c])))
        else:
            out.append(b"".join((s, whole[c:d], p, whole[a:b], m, whole[b:c])))
    return n, cuts[:, 0], cuts[:, 1] - cuts[:, 0], out


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column without nulls, as views."""
    wide = pa.types.is_large_string(column.type)
    _, ends, body = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(body, np.uint8) if body else np.empty(0, np.uint8), offsets.astype(np.int64)


def draw(digest: Column, k: int) -> Column:
    """The k-th (from 1) group of eight digits of a hex digest as a number."""
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def holds_marker(text: str) -> Column:
    """Whether a text holds a marker, so that it cannot be cut."""
    return F.col(text).contains(PREFIX) | F.col(text).contains(SUFFIX) | F.col(text).contains(MIDDLE)


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n, form, prefix_chars, middle_chars and ``output``, the text in its form.

    Form and cuts come from a digest of the id, so every run and every partitioning gives the same result.
    """
    whole = whole_text(text)
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256)
    told = docs.select(F.col(key), whole.alias("text__"), digest.alias("digest__")).select(
        F.col(key), "text__", draw(F.col("digest__"), 1).alias("first__"), draw(F.col("digest__"), 2).alias("second__"),
        F.when((F.col("text__") == "") | holds_marker("text__") | (draw(F.col("digest__"), 3) % 100 >= CUT_SHARE), PLAIN)
        .when(draw(F.col("digest__"), 4) % 100 < SUFFIX_FIRST_SHARE, SPM).otherwise(PSM).alias("form__"))
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_buffers(batch.column(1))
            draws = np.stack([batch.column(i).to_numpy() for i in (2, 3)], axis=1)
            forms = batch.column(4).to_numpy()
            for a, b in runs(offsets):
                n, prefix, middle, out = arranged(data, offsets[a:b + 1], draws[a:b], forms[a:b])
                plain = forms[a:b] == PLAIN
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n), pa.array([FORMS[f] for f in forms[a:b]], pa.string()),
                     pa.array(prefix, mask=plain), pa.array(middle, mask=plain),
                     pa.array(out, pa.binary()).view(pa.string())], schema.names)

    return told.mapInArrow(lean(run), schema)


def restored(output: Column, form: Column) -> Column:
    """The text that was put in a form: a cut text holds each marker once, so the pieces lie between them."""
    pieces = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == FORMS[PSM], F.concat(pieces[1], pieces[3], pieces[2]))
            .when(form == FORMS[SPM], F.concat(pieces[2], pieces[3], pieces[1])).otherwise(output))
