"""Quality classifier (4): random-indexing word vectors and a small network.

Words are runs of letters, digits and bytes above 0x7F, or of signs. A word
is known by one of ``BUCKETS`` hash buckets. Every bucket has a fixed sparse
ternary index vector drawn from its number; its word vector is the sum of the
index vectors of all words within two places of it, over *all* documents. The
sums are whole numbers, so they do not depend on the order of the tasks, and
the table they fill has a fixed size however large the corpus is.

A document is the mean and the spread of its unit word vectors. A two-layer
numpy network, fitted on at most ``MAX_TRAIN`` labelled documents (the ones
with the smallest hashes of their ids), scores it; one temperature, fitted on
a part kept out of the fit, calibrates the probabilities.

Defined results: null and empty texts pool to the zero vector and get the
network's score for it; with no usable label every score is 0.5; an id
labelled twice counts once, with the lower label; rows with a null label are
not learnt from; repeated rows are scored one by one; an empty table gives an
empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regstat.llm import common as c

BUCKETS = 1 << 13
DIMS = 32
WINDOW = 2
#: Labelled documents that the network is fitted on, at most.
MAX_TRAIN = 8_000
HIDDEN = 24
EPOCHS = 400
#: Bytes of text that are pooled at a time; their word vectors take about 60 times as much.
POOLED_BYTES = 1 << 17
#: Bytes of text whose words are summed at a time; they take about 100 times as much.
SUMMED_BYTES = 1 << 18
RATE = 0.01
DECAY = 1e-4

_CODES = c.byte_codes(4)
_CLASS = np.full(256, 2, np.int8)
_CLASS[[0x20, *range(0x00, 0x20), 0x7F]] = 0
_CLASS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1


def index_vectors() -> np.ndarray:
    """Ternary index vector of each bucket: -1, 0, 0 or 1 by two hash bits."""
    cell = np.arange(BUCKETS * DIMS, dtype=c.U64).reshape(BUCKETS, DIMS)
    return np.array([-1, 0, 0, 1], np.int8)[(c.mix(cell) >> c.U64(62)).astype(np.int64)]


def word_buckets(block: c.Block) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every word, in order."""
    kind = _CLASS[block.buf]
    cut = np.ones(len(kind) + 1, bool)
    cut[1:-1] = kind[1:] != kind[:-1]
    cut[block.at] = True
    edges = np.flatnonzero(cut)
    start, end = edges[:-1], edges[1:]
    words = kind[start] > 0 if len(start) else np.zeros(0, bool)
    start, end = start[words], end[words]
    h = c.SpanHash(block.buf, _CODES)(start, end)
    return (h & c.U64(BUCKETS - 1)).astype(np.int64), block.rows_of(start)


def context_sums(bucket: np.ndarray, row: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Sum of the index vectors around each word, inside its document."""
    own = index[bucket]
    out = np.zeros_like(own)
    for d in range(1, WINDOW + 1):
        same = (row[d:] == row[:-d]).astype(np.int8)[:, None]
        out[d:] += own[:-d] * same
        out[:-d] += own[d:] * same
    return out


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit word vectors, ``BUCKETS`` x ``DIMS``, from all rows of
    ``doc_id, text``. Each task sums into one table of fixed size."""
    names = [f"v{i}" for i in range(DIMS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_vectors()
        total = np.zeros((BUCKETS, DIMS), np.int64)
        for block in c.blocks(batches, SUMMED_BYTES):
            bucket, row = word_buckets(block)
            if len(bucket) <= WINDOW:
                continue
            around = context_sums(bucket, row, index)
            order = np.argsort(bucket, kind="stable")
            first = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            total[bucket[order][first]] += np.add.reduceat(around[order], first, axis=0, dtype=np.int64)
        used = np.flatnonzero(total.any(axis=1))
        columns = [pa.array(used, pa.int64()), *[pa.array(np.ascontiguousarray(total[used, i])) for i in range(DIMS)]]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", *names])

    parts = docs.mapInArrow(run, "bucket long, " + ", ".join(f"{n} long" for n in names))
    rows = parts.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).collect()  # at most BUCKETS rows
    table = np.zeros((BUCKETS, DIMS), np.float64)
    for r in rows:
        table[r["bucket"]] = r[1:]
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.maximum(norm, 1e-9)).astype(np.float32)


def pooled(block: c.Block, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the word vectors of each row; zeros without words."""
    bucket, row = word_buckets(block)
    out = np.zeros((len(block.ids), 2 * DIMS), np.float64)
    if len(bucket):
        first = np.flatnonzero(np.diff(row, prepend=-1))
        n = np.diff(np.append(first, len(row)))[:, None]
        own = vectors[bucket].astype(np.float64)
        mean = np.add.reduceat(own, first, axis=0) / n
        square = np.add.reduceat(own * own, first, axis=0) / n
        out[row[first], :DIMS] = mean
        out[row[first], DIMS:] = np.sqrt(np.maximum(square - mean * mean, 0))
    return out


@dataclass
class Network:
    """Standardised input, one hidden layer of tanh units, one logit."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, held: np.ndarray) -> Network:
    """Fit on the rows that are not ``held`` by full-batch Adam; choose the
    temperature with the least log loss on the held ones."""
    rng = np.random.default_rng(4)
    xf, yf = (x[~held], y[~held]) if (~held).any() else (x, y)
    scale = xf.std(axis=0)
    net = Network(
        xf.mean(axis=0),
        np.where(scale > 1e-6, scale, 1.0),
        rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, HIDDEN**-0.5, HIDDEN),
        0.0,
    )
    z = (xf - net.centre) / net.scale
    state = {k: [0.0, 0.0] for k in ("w1", "b1", "w2", "b2")}
    for step in range(1, EPOCHS + 1):
        h = np.tanh(z @ net.w1 + net.b1)
        error = (1 / (1 + np.exp(-np.clip(h @ net.w2 + net.b2, -30, 30))) - yf) / len(yf)
        back = np.outer(error, net.w2) * (1 - h * h)
        grads = {
            "w1": z.T @ back + DECAY * net.w1,
            "b1": back.sum(axis=0),
            "w2": h.T @ error + DECAY * net.w2,
            "b2": error.sum(),
        }
        for k, g in grads.items():
            m, v = state[k]
            state[k] = m, v = [0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g]
            move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            setattr(net, k, getattr(net, k) - move)
    if held.any():
        logit, yh = net.logit(x[held]), y[held]
        loss = [np.mean(np.logaddexp(0, np.where(yh == 1, -logit, logit) / t)) for t in _TEMPERATURES]
        net.temperature = float(_TEMPERATURES[int(np.argmin(loss))])
    return net


_TEMPERATURES = np.geomspace(1, 8, 43)


def fold(id_col: str) -> Column:
    """crc32 of the id's text modulo 5."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, label_col: str) -> Network | None:
    """The network, or None without a usable label. Rows of fold 0 are never
    learnt from; fold 1 is kept for the temperature."""
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).alias("label"))
        .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id") != 0))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .join(docs.select("doc_id"), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(MAX_TRAIN)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in c.blocks(batches, POOLED_BYTES):
            x = pooled(block, vectors)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.ids, pa.int64()), c.lists(x.ravel(), np.full(len(x), x.shape[1]), pa.float64())], ["doc_id", "x"]
            )

    chosen = docs.join(F.broadcast(usable), "doc_id")  # at most MAX_TRAIN labels
    # one text of each id: the one with the least hash
    one = chosen.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("least"))
    rows = one.select("doc_id", "least.text").mapInArrow(run, "doc_id long, x array<double>")
    rows = rows.join(F.broadcast(usable), "doc_id").select("doc_id", "label", fold("doc_id").alias("fold"), "x").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    x = np.array([r["x"] for r in rows])
    return fit(x, np.array([float(r["label"]) for r in rows]), np.array([r["fold"] == 1 for r in rows]))


def model(
    corpus: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> tuple[np.ndarray, Network | None]:
    """Word vectors from all of ``corpus`` and the network fitted on its
    labelled rows."""
    known = c.keyed(corpus, id_col, text_col)
    vectors = word_vectors(known)
    return vectors, train(known, labels, vectors, label_col)


def scores(texts: pa.Array, vectors: np.ndarray, net: Network | None) -> np.ndarray:
    """Score of each text of an Arrow column."""
    texts = texts.fill_null("")
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(texts))), texts], ["doc_id", "text"])
    parts = [np.full(len(b.ids), 0.5) if net is None else net.score(pooled(b, vectors)) for b in c.blocks([batch], POOLED_BYTES)]
    return np.concatenate(parts) if parts else np.zeros(0)


def score(docs: DataFrame, fitted: tuple, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = pa.array(scores(batch.column("text"), *fitted))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), s], ["doc_id", "score"])

    return c.keyed(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def accepted(docs: DataFrame, fitted: tuple, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` scored ``least`` or more, all columns as they are,
    handed back in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, lo = pa.array(scores(batch.column(text_col), *fitted) >= least), 0
            for part in c.slices(batch, text_col):
                yield part.filter(keep.slice(lo, part.num_rows))
                lo += part.num_rows

    return docs.mapInArrow(run, docs.schema)
