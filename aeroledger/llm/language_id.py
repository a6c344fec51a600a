"""Language identification by a small convolutional network over bytes.

Bytes are embedded, filters of several widths slide over fixed-length windows, each filter keeps its largest response, and
a softmax layer turns those into language probabilities.  Training (numpy, Adam) runs on a bounded sample: at most
``DOCS_PER_LANGUAGE`` labelled documents of each language, the ones with the least id hash, ``WINDOWS_PER_DOC`` windows
of each.  To predict, a text is cut into windows from end to end and their probabilities are averaged, weighted by bytes.

A text that is null or has no letter gets ``und`` and score 0; so does every text when nothing is labelled.  Ties between
languages go to the first by code point.  Copies get equal predictions, and no column but the text enters one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroledger.llm.common import lean, whole_text

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
DOCS_PER_LANGUAGE = 512
WINDOWS_PER_DOC = 6
EPOCHS = 6
BATCH = 64
STEP = 64  # windows whose responses are held at once
UNKNOWN = "und"


@dataclass
class Network:
    embedding: np.ndarray  # 256 x d
    filters: list[np.ndarray]  # width*d x filters, per width
    biases: list[np.ndarray]
    dense: np.ndarray  # pooled x languages
    offset: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.dense, self.offset]


def fresh_network(languages: int, rng) -> Network:
    d = EMBEDDING
    return Network(rng.normal(0, 0.5, (256, d)), [rng.normal(0, (w * d) ** -0.5, (w * d, FILTERS)) for w in WIDTHS],
                   [np.zeros(FILTERS) for _ in WIDTHS], rng.normal(0, 0.1, (FILTERS * len(WIDTHS), languages)), np.zeros(languages))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def gradients(net: Network, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross-entropy over a batch of windows, in the order of ``parameters``."""
    n, d = len(x), EMBEDDING
    embedded = net.embedding[x]
    rows = np.arange(n)[:, None]
    pooled, where, patches = [], [], []
    for w, filters, bias in zip(WIDTHS, net.filters, net.biases):
        view = np.lib.stride_tricks.sliding_window_view(embedded, (w, d), axis=(1, 2))[:, :, 0].reshape(n, -1, w * d)
        response = view @ filters + bias
        at = response.argmax(axis=1)
        top = np.take_along_axis(response, at[:, None, :], axis=1)[:, 0]
        pooled.append(np.maximum(top, 0))
        where.append(at)
        patches.append(view[rows, at])  # n x filters x w*d
    hidden = np.concatenate(pooled, axis=1)
    wrong = softmax(hidden @ net.dense + net.offset)
    wrong[np.arange(n), y] -= 1
    wrong /= n
    back = (wrong @ net.dense.T) * (hidden > 0)
    g_embedding, g_filters, g_biases = np.zeros_like(net.embedding), [], []
    for k, (w, filters) in enumerate(zip(WIDTHS, net.filters)):
        part = back[:, k * FILTERS:(k + 1) * FILTERS]
        g_filters.append(np.einsum("nf,nfc->cf", part, patches[k]))
        g_biases.append(part.sum(axis=0))
        to_bytes = (part[:, :, None] * filters.T[None]).reshape(n, FILTERS, w, d)
        for j in range(w):
            np.add.at(g_embedding, x[rows, where[k] + j], to_bytes[:, :, j])
    return [g_embedding, *g_filters, *g_biases, hidden.T @ wrong, wrong.sum(axis=0)]


def train(x: np.ndarray, y: np.ndarray, languages: int, seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)
    net = fresh_network(languages, rng)
    params = net.parameters()
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    steps, rate = 0, 0.01
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for i in range(0, len(order), BATCH):
            some = order[i:i + BATCH]
            steps += 1
            for p, g, m, v in zip(params, gradients(net, x[some], y[some]), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** steps)) / (np.sqrt(v / (1 - 0.999 ** steps)) + 1e-8)
    return net


class Predictor:
    """Window probabilities; responses to byte pairs are tabulated, so a filter costs one lookup per two bytes."""

    def __init__(self, net: Network):
        self.net, d = net, EMBEDDING
        single = [[(net.embedding @ f[j * d:(j + 1) * d]).astype(np.float32) for j in range(w)] for w, f in zip(WIDTHS, net.filters)]
        self.tables = []
        for parts in single:
            pairs = [(parts[j][:, None, :] + parts[j + 1][None, :, :]).reshape(65536, -1) for j in range(0, len(parts) - 1, 2)]
            self.tables.append((pairs, parts[-1] if len(parts) % 2 else None))

    def __call__(self, windows: np.ndarray) -> np.ndarray:
        out = []
        for i in range(0, len(windows), STEP):
            x = windows[i:i + STEP]
            pair = x[:, :-1].astype(np.int32) << 8 | x[:, 1:]
            hidden = []
            for w, (pairs, odd), bias in zip(WIDTHS, self.tables, self.net.biases):
                n = WINDOW - w + 1
                response = pairs[0][pair[:, :n]]
                for j, table in enumerate(pairs[1:], 1):
                    response += table[pair[:, 2 * j:2 * j + n]]
                if odd is not None:
                    response += odd[x[:, w - 1:w - 1 + n]]
                hidden.append(np.maximum(response.max(axis=1) + bias, 0))
            out.append(softmax(np.concatenate(hidden, axis=1) @ self.net.dense + self.net.offset))
        return np.concatenate(out) if out else np.zeros((0, len(self.net.offset)))


def windows_of(data: bytes) -> np.ndarray:
    """All windows of a text, the last one filled with zero bytes."""
    n = max(1, -(-len(data) // WINDOW))
    return np.frombuffer(data.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


def training_windows(docs: DataFrame, allowed: Column, key: str, text: str, lang: str) -> DataFrame:
    """(lang, id, window) of the bounded sample."""
    within = W.partitionBy("lang", "salt").orderBy(F.xxhash64("id"), "id")
    order = W.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = (docs.where(allowed & F.col(lang).isNotNull() & F.col(text).isNotNull())
              .select(F.col(key).cast("string").alias("id"), F.col(lang).alias("lang"))
              .withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
              .withColumn("place", F.row_number().over(within)).where(F.col("place") <= DOCS_PER_LANGUAGE)
              .withColumn("place", F.row_number().over(order)).where(F.col("place") <= DOCS_PER_LANGUAGE)
              .select("id", "lang").distinct())
    rows = docs.where(allowed).select(F.col(key).cast("string").alias("id"), F.col(lang).alias("lang"), whole_text(text).alias("text"))

    def run(batches):
        for batch in batches:
            out = []
            for ident, name, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
                windows = windows_of(value.encode())
                for k in sorted({int(k) for k in np.linspace(0, len(windows) - 1, WINDOWS_PER_DOC)}):
                    out.append((name, ident, windows[k].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(
                (pa.string(), pa.string(), pa.binary()))], ["lang", "id", "window"])

    # Broadcast: at most DOCS_PER_LANGUAGE ids for each language.
    return rows.join(F.broadcast(chosen), ["id", "lang"]).select("id", "lang", "text").mapInArrow(lean(run), "lang string, id string, window binary")


def learn(docs: DataFrame, allowed: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> tuple[list[str], Network | None]:
    """Languages and the network trained on the rows of ``docs`` that are ``allowed``."""
    sample = training_windows(docs, allowed, key, text, lang).orderBy("lang", "id", "window").collect()
    languages = sorted({r.lang for r in sample})
    if not languages:
        return [], None
    x = np.array([np.frombuffer(r.window, np.uint8) for r in sample])
    y = np.array([languages.index(r.lang) for r in sample])
    return languages, train(x, y, len(languages))


def predict(docs: DataFrame, languages: list[str], net: Network | None, text: str = "text", label: str = "lang_pred",
            score: str = "score", keep_text: bool = False) -> DataFrame:
    """``docs`` with the predicted language and the probability given to it; the text goes unless it is to be kept."""
    keep = [c for c in docs.columns if c not in (label, score) and (keep_text or c != text)]
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField(label, T.StringType()), T.StructField(score, T.DoubleType())])
    model = docs.sparkSession.sparkContext.broadcast((languages, net))  # a few thousand numbers per language

    def run(batches):
        names, trained = model.value
        predictor = Predictor(trained) if trained else None
        for batch in batches:
            last = batch.num_columns
            texts, worded = batch.column(last - 2), batch.column(last - 1).to_pylist()
            out = []
            for i, has_letter in enumerate(worded):
                if not has_letter or predictor is None:
                    out.append((UNKNOWN, 0.0))
                    continue
                data = texts[i].as_buffer().to_pybytes()
                windows = windows_of(data)
                weights = np.full(len(windows), float(WINDOW))
                weights[-1] = len(data) - (len(windows) - 1) * WINDOW
                p = weights @ predictor(windows) / weights.sum()
                out.append((names[int(p.argmax())], float(min(1.0, p.max()))))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(last - 2)], pa.array([o[0] for o in out], pa.string()),
                 pa.array([o[1] for o in out], pa.float64())], schema.names)

    whole = whole_text(text)
    return docs.select(*[F.col(f"`{c}`") for c in keep], whole.alias("text__"), whole.rlike(r"\p{L}").alias("worded__")).mapInArrow(lean(run), schema)
