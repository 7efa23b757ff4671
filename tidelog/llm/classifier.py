"""A quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. Bytes are embedded, FILTERS learned filters
slide over each chunk, and each filter's largest response is the chunk's feature; the features' mean over all chunks goes
through a small hidden layer to one probability. Scoring is one pass over the documents without a shuffle.

The network is fitted on the driver to a bounded sample: MAX_DOCUMENTS labelled rows, chosen by hash of their id, with all
chunks of their whole texts. Only rows whose crc32(doc_id) mod FOLDS isn't 0 are in it. The text is the only input of a
score.

Defined cases: null and empty texts are one chunk of padding and get a score; very long texts are scored in pieces; rows
that repeat get equal scores; without labels of both kinds the score is their share (0.5 without any); an empty table gives
no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import in_python

# Production parameters.
FOLDS = 5
THRESHOLD = 0.3
MAX_DOCUMENTS = 4000
CHUNK = 512
STEP = 384
BLOCK = 4  # bytes per step of a filter; a filter is two blocks wide
WIDTH = 8  # of a byte's embedding
FILTERS = 32
HIDDEN = 16
STEPS = 640  # of BATCH documents
BATCH = 64
RATE = 0.004
SEED = 5
_AT_ONCE = 512  # chunks


@dataclass
class Network:
    embedding: np.ndarray  # 256 x WIDTH
    filters: np.ndarray  # 2 x (BLOCK * WIDTH) x FILTERS
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return list(vars(self).values())

    def responses(self, chunks: np.ndarray) -> np.ndarray:
        """Chunks x places x filters."""
        blocks = self.embedding[chunks].reshape(len(chunks), CHUNK // BLOCK, BLOCK * WIDTH)
        return blocks[:, :-1] @ self.filters[0] + blocks[:, 1:] @ self.filters[1]

    def features(self, chunks: np.ndarray) -> np.ndarray:
        parts = [self.responses(chunks[i : i + _AT_ONCE]).max(axis=1) for i in range(0, len(chunks), _AT_ONCE)]
        return np.maximum(np.concatenate(parts) + self.bias, 0)

    def probability(self, features: np.ndarray) -> np.ndarray:
        inner = np.tanh(features @ self.hidden + self.hidden_bias)
        return 1 / (1 + np.exp(-np.clip(inner @ self.out + self.out_bias[0], -30, 30)))


def chunked(text: bytes) -> np.ndarray:
    """Overlapping chunks over the whole text; the last is filled with zeros."""
    n = max(1, -(-(len(text) - (CHUNK - STEP)) // STEP))
    data = np.zeros((n - 1) * STEP + CHUNK, np.uint8)
    data[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.as_strided(data, (n, CHUNK), (STEP, 1))


def _new_network(rng) -> Network:
    normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    return Network(
        normal(256, WIDTH, scale=0.5), normal(2, BLOCK * WIDTH, FILTERS, scale=(2 * BLOCK * WIDTH) ** -0.5),
        np.zeros(FILTERS, np.float32), normal(FILTERS, HIDDEN, scale=FILTERS**-0.5), np.zeros(HIDDEN, np.float32),
        normal(HIDDEN, scale=HIDDEN**-0.5), np.zeros(1, np.float32),
    )


def _gradients(net: Network, chunks: np.ndarray, owner: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross entropy over documents; owner is each chunk's document."""
    n = len(y)
    parts = [slice(i, i + _AT_ONCE) for i in range(0, len(chunks), _AT_ONCE)]  # a long text has many chunks
    at, top = np.empty((len(chunks), FILTERS), np.int64), np.empty((len(chunks), FILTERS), np.float32)
    for part in parts:
        responses = net.responses(chunks[part])
        at[part], top[part] = responses.argmax(axis=1), responses.max(axis=1) + net.bias
    per = 1 / np.bincount(owner, minlength=n).astype(np.float32)
    pooled = np.zeros((n, FILTERS), np.float32)
    np.add.at(pooled, owner, np.maximum(top, 0) * per[owner, None])
    inner = np.tanh(pooled @ net.hidden + net.hidden_bias)
    error = ((1 / (1 + np.exp(-np.clip(inner @ net.out + net.out_bias[0], -30, 30))) - y) / n).astype(np.float32)
    back = error[:, None] * net.out * (1 - inner**2)
    to_top = ((back @ net.hidden.T) * per[:, None])[owner] * (top > 0)
    # Only the place of the largest response passes a gradient on.
    flat = net.filters.reshape(-1, FILTERS)
    d_embedding, d_filters = np.zeros_like(net.embedding), np.zeros_like(net.filters)
    for part in parts:
        some, passed = chunks[part], to_top[part]
        places = (at[part, :, None] * BLOCK + np.arange(2 * BLOCK)).reshape(len(some), -1)
        seen = np.take_along_axis(some, places, 1).reshape(len(some), FILTERS, 2 * BLOCK)
        inputs = net.embedding[seen].reshape(len(some), FILTERS, -1)
        d_filters += np.einsum("cfi,cf->if", inputs, passed).reshape(net.filters.shape)
        np.add.at(d_embedding, seen.ravel(), (passed[:, :, None] * flat.T).reshape(-1, WIDTH))
    return [
        d_embedding, d_filters, to_top.sum(axis=0), pooled.T @ back, back.sum(axis=0), inner.T @ error, error.sum(keepdims=True)
    ]


def train(chunks: list[np.ndarray], y: np.ndarray) -> Network | float:
    """The network for documents given as their chunks; their share of ones where there is nothing to learn."""
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    rng = np.random.default_rng(SEED)
    net = _new_network(rng)
    moments = [(np.zeros_like(a), np.zeros_like(a)) for a in net.arrays()]
    order: list[int] = []
    for step in range(1, STEPS + 1):
        if not order:
            order = rng.permutation(len(y)).tolist()
        some, order = order[:BATCH], order[BATCH:]
        owner = np.repeat(np.arange(len(some)), [len(chunks[k]) for k in some])
        rate = RATE * (1 - 0.9 * step / STEPS)
        gradients = _gradients(net, np.concatenate([chunks[k] for k in some]), owner, y[some].astype(np.float32))
        for a, g, (m, v) in zip(net.arrays(), gradients, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return net


def held_out(doc_id, folds: int = FOLDS):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def fit(docs: DataFrame, labels: DataFrame, max_documents: int = MAX_DOCUMENTS) -> Network | float:
    marked = labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
    marked = marked.filter("doc_id is not null and quality in (0, 1)").filter(~held_out(F.col("doc_id")))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_documents)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # max_documents short rows
    text = F.coalesce("text", F.lit("")).cast("binary")
    sample = sample.select("doc_id", "quality", text.alias("text"))
    # An id may have any number of rows: they are bounded too.
    rows = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", F.xxhash64("text")).limit(max_documents).collect()
    rows.sort(key=lambda r: (r[0], bytes(r[2])))
    return train([chunked(bytes(r[2])) for r in rows], np.array([r[1] for r in rows], np.int64))


def score(text: bytes, network: Network | float) -> float:
    if not isinstance(network, Network):
        return network
    chunks = chunked(text)
    total = np.zeros(FILTERS, np.float64)
    for i in range(0, len(chunks), 8 * _AT_ONCE):
        total += network.features(chunks[i : i + 8 * _AT_ONCE]).sum(axis=0, dtype=np.float64)
    return float(network.probability(total[None] / len(chunks))[0])


def _scored(network):
    def scored(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            scores = [score(t.as_py() or b"", network.value) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return scored


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, held_out, score (of label 1), predicted."""
    network = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))  # some ten thousand numbers
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = in_python(docs.select("doc_id", "text"), _scored(network), f"doc_id {kind}, score double")
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)
