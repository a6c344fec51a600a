"""SentencePiece encoding that keeps, for every piece, the bytes of the original text it stands for.

A text is normalised by the model's compiled character map: at each place the longest prefix found in the map's double
array is replaced, and every produced byte remembers where its source starts.  The library cuts the text into pieces; their
lengths run over the recorded alignment and give original byte spans.  A model with user-defined symbols is refused.

Null counts as an empty text and gives no pieces.  Rows are independent: copies, ties and order do not matter.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroledger.llm.common import lean, whole_text

MARK = "▁"
MARK_BYTES = MARK.encode()
UNKNOWN_BYTES = "�".encode()
CHUNK_CHARACTERS = 500_000


class CharacterMap:
    """Longest-prefix replacement by a compiled character map (a double array followed by its replacement strings)."""

    def __init__(self, compiled: bytes):
        self.units: tuple[int, ...] = ()
        if compiled:
            size = struct.unpack_from("<I", compiled)[0]
            self.units = struct.unpack_from(f"<{size // 4}I", compiled, 4)
            self.strings = compiled[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest mapped prefix of ``data[at:]`` and its replacement."""
        units, best = self.units, None
        if not units:
            return None
        node = (units[0] >> 10) << ((units[0] & 512) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit & 256:
                best = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if best is None:
            return None
        return best[0], self.strings[best[1]:self.strings.index(b"\0", best[1])]


def character_length(data: bytes, at: int) -> int:
    first = data[at]
    return 1 if first < 0xC0 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


class Normaliser:
    """Normalised bytes of a text with the source offset of each byte (one more at the end)."""

    def __init__(self, compiled: bytes, dummy_prefix: bool, remove_extra: bool, escape: bool):
        self.map, self.dummy_prefix, self.remove_extra = CharacterMap(compiled), dummy_prefix, remove_extra
        self.space = MARK_BYTES if escape else b" "

    def replaced(self, data: bytes) -> Iterator[tuple[int, int, bytes]]:
        at = 0
        while at < len(data):
            hit = self.map.longest(data, at)
            n, out = hit if hit else (character_length(data, at), None)
            yield at, n, data[at:at + n] if out is None else out
            at += n

    def __call__(self, data: bytes) -> tuple[bytes, list[int]]:
        chunks = list(self.replaced(data))
        if self.remove_extra:
            while chunks and chunks[0][2] == b" ":
                chunks.pop(0)
        if not chunks:
            return b"", [0]
        out, source = bytearray(), []

        def put(what: bytes, start: int) -> None:
            out.extend(what)
            source.extend([start] * len(what))

        if self.dummy_prefix:
            put(self.space, chunks[0][0])
        after_space = self.remove_extra
        end = chunks[0][0]
        for start, n, chunk in chunks:
            while after_space and chunk.startswith(b" "):
                chunk = chunk[1:]
            if chunk:
                if chunk == data[start:start + n] and b" " not in chunk:  # unchanged: byte by byte
                    out.extend(chunk)
                    source.extend(range(start, start + n))
                else:
                    for i in range(len(chunk)):
                        put(self.space if chunk[i] == 32 else chunk[i:i + 1], start)
                after_space = self.remove_extra and chunk.endswith(b" ")
            end = start + n
            if not self.remove_extra:
                after_space = False
        if self.remove_extra:
            while out.endswith(self.space):
                end = source[-len(self.space)]
                del out[-len(self.space):], source[-len(self.space):]
        return bytes(out), [*source, end]


@dataclass
class Encoded:
    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    joined: str


class SpanEncoder:
    """Encodes texts with a model file; one per task."""

    def __init__(self, model_path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(self.model.serialized_model_proto())
        spec = proto.normalizer_spec
        self.plain = not spec.precompiled_charsmap and not spec.remove_extra_whitespaces and spec.escape_whitespaces
        self.normalise = Normaliser(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces,
                                    spec.escape_whitespaces)
        if any(p.type == p.USER_DEFINED for p in proto.pieces):
            raise ValueError("models with user-defined symbols are not supported")
        self.plain = self.plain and spec.add_dummy_prefix
        self.sizes = [1 if p.type == p.BYTE else len(p.piece.encode()) for p in proto.pieces]
        self.source_sizes = np.array([n - 2 * (p.piece.count(MARK)) for n, p in zip(self.sizes, proto.pieces)], np.int64)
        self.unknown = proto.trainer_spec.unk_id
        self.digits = [str(i) for i in range(len(self.sizes))]

    def encode_all(self, texts: list[str]) -> list[Encoded]:
        return [self.spans(t, ids) for t, ids in zip(texts, self.model.encode(texts, num_threads=1))]

    def __call__(self, text: str) -> Encoded:
        return self.encode_all([text])[0]

    def spans(self, text: str, ids: list[int]) -> Encoded:
        """Project pieces to source bytes.

        Where the model maps characters to themselves, a mark is one space, and the first mark (the dummy prefix) is
        nothing: the recorded alignment is then a running sum.  Any other model or text takes the general way.
        """
        joined = ",".join([self.digits[i] for i in ids])
        ids = np.array(ids, np.int32)
        if not len(ids):
            return Encoded(ids, ids.astype(np.int64), ids.astype(np.int64), "")
        if not self.plain or MARK in text or (ids == self.unknown).any():
            return self.aligned(text, ids, joined)
        ends = self.source_sizes[ids].cumsum() - 1
        return Encoded(ids, np.concatenate([[0], ends[:-1]]), ends, joined)

    def aligned(self, text: str, ids: np.ndarray, joined: str) -> Encoded:
        """The general way: pieces laid over the normalised bytes, whose sources the character map recorded."""
        normal, source = self.normalise(text.encode())
        ends = np.cumsum([0, *self.piece_sizes_in(normal, ids.tolist())])
        offsets = np.array(source, np.int64)
        starts, stops = offsets[ends[:-1]], offsets[ends[1:]]
        return Encoded(ids, starts, np.maximum(starts, stops), joined)

    def piece_sizes_in(self, normal: bytes, ids: list[int]) -> list[int]:
        """Bytes of the normalised text under each piece; an unknown piece takes what lies before the next known one."""
        sizes, at = [], 0
        for k, i in enumerate(ids):
            if i == self.unknown:
                following = next((self.model.id_to_piece(j).encode() for j in ids[k + 1:] if j != self.unknown), None)
                stop = len(normal) if following is None else normal.index(following, at)
                sizes.append(stop - at)
            else:
                sizes.append(self.sizes[i])
            at += sizes[-1]
        return sizes


def chunks(texts: Iterable[str]) -> Iterator[list[str]]:
    """Runs of texts of about ``CHUNK_CHARACTERS`` together; a longer text is a run of its own."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > CHUNK_CHARACTERS:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def _map(docs: DataFrame, key: str, text: str, fields: list, build) -> DataFrame:
    """Apply ``build()(texts) -> rows`` to runs of texts, batch by batch."""
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), *fields])
    arrow = [pa.field(f.name, _arrow(f.dataType)) for f in fields]

    def run(batches):
        step = build()
        for batch in batches:
            rows = [r for some in chunks(v.as_py() for v in batch.column(1)) for r in step(some)]
            columns = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(arrow)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [batch.schema.names[0], *[f.name for f in arrow]])

    return docs.select(F.col(key), whole_text(text).alias("text__")).mapInArrow(lean(run), schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}[kind.simpleString()]


def encode(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of each text and the original byte span of every piece: key, ids, starts, ends (arrays)."""
    def build():
        encoder = SpanEncoder(model_path)

        def step(texts: list[str]):
            return [(e.ids, e.starts.astype(np.int32), e.ends.astype(np.int32)) for e in encoder.encode_all(texts)]
        return step

    arrays = [T.StructField(n, T.ArrayType(T.IntegerType(), False)) for n in ("ids", "starts", "ends")]
    return _map(docs, key, text, arrays, build)


def decode(encoded: DataFrame, model_path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Texts of arrays of ids: key, text; null ids give an empty text."""
    schema = T.StructType([T.StructField(key, encoded.schema[key].dataType), T.StructField("text", T.StringType())])

    def run(batches):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        for batch in batches:
            texts = [model.decode(v) if v else "" for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], schema.names)

    return encoded.select(key, ids).mapInArrow(lean(run), schema)


def encoding_digests(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: n_tokens, digests of ids, of the decoded text and of the spans, and whether these tile the text's bytes.

    ``spans_sha256`` is over all first bytes, then all ends, as little-endian 64-bit integers.
    """
    def build():
        encoder = SpanEncoder(model_path)

        def digests(value: str, e: Encoded, back: str):
            tiled = not len(e.ids) or bool(e.starts[0] == 0 and (e.starts[1:] == e.ends[:-1]).all()
                                           and e.ends[-1] == len(value.encode()))
            spans = hashlib.sha256(e.starts.astype("<i8").tobytes() + e.ends.astype("<i8").tobytes()).hexdigest()
            return (len(e.ids), hashlib.sha256(e.joined.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(),
                    spans, tiled)

        def step(texts: list[str]):
            found = encoder.encode_all(texts)
            back = encoder.model.decode([e.ids.tolist() for e in found], num_threads=1)
            return [digests(*x) for x in zip(texts, found, back)]
        return step

    return _map(docs, key, text, [
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()), T.StructField("spans_sha256", T.StringType()),
        T.StructField("spans_tile", T.BooleanType())], build)
