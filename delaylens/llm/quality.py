"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

1. *Random indexing.* Every word belongs to one of ``buckets`` hash buckets; a bucket has a fixed
   sparse index vector of a few +1/-1 entries. The vector of a word is the sum of the index vectors
   of its neighbours within ``window`` words, over all documents. A task adds into one dense matrix
   of bounded size; Spark sums the matrices by bucket.
2. *Pooling.* A document is the mean and the spread of its words' vectors, the mean cosine of
   neighbouring words, the share of neighbours with one and the same vector, and its length.
3. *Network.* One hidden layer in numpy, trained on a bounded sample of labelled documents; the
   logits are divided by a temperature fitted on labelled rows that the weights have not seen.

Label columns, language, source and ids are never inputs of a score.

Defined results: null text is an empty text; an empty text, or one without tokens, is scored from
zero vectors; repeated rows are scored one by one; null ids keep their rows; labels that are null,
not 0/1, or contradict each other for one document are left out; with no labels, or labels of one
class alone, every score is 0.5. Other columns of the inputs are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import arrow_map, seeds, splitmix, strings, written

_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+|\n")


@dataclass(frozen=True)
class QualityParams:
    buckets: int = 8192           # hash buckets of words; bounds the vector table
    dim: int = 32                 # length of a word vector
    nonzeros: int = 4             # entries of an index vector
    window: int = 2               # neighbours on each side
    max_labelled: int = 20_000    # documented bound of the training sample, in documents
    hidden: int = 32
    epochs: int = 60
    batch: int = 256
    rate: float = 3e-3
    decay: float = 1e-4
    threshold: float = 0.3        # predicted 1 from this score on
    seed: int = 7


class _Buckets(dict):
    """Memo token -> bucket, emptied at 100,000 entries."""

    def __init__(self, buckets: int):
        super().__init__()
        self.mask = buckets

    def __missing__(self, token: str) -> int:
        if len(self) >= 100_000:
            self.clear()
        value = zlib.crc32(token.encode("utf-8", "surrogatepass")) % self.mask
        if len(token) <= 64:
            self[token] = value
        return value


def _ids(text: str | None, memo: _Buckets) -> np.ndarray:
    found = _TOKEN.findall(text) if text else []
    return np.fromiter((memo[t] for t in found), dtype=np.int64, count=len(found))


def index_vectors(p: QualityParams) -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the entries of every bucket's index vector."""
    base = seeds(p.buckets, p.seed)[:, None] + seeds(p.nonzeros, p.seed + 1)[None, :]
    h = splitmix(base)
    return (h % np.uint64(p.dim)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)


def word_vectors(docs: DataFrame, text_col: str, p: QualityParams) -> np.ndarray:
    """The bucket x dim table of word vectors over all documents, rows of length one (or zero)."""
    names = [f"d{j}" for j in range(p.dim)]
    schema = pa.schema([("bucket", pa.int32()), *((n, pa.int32()) for n in names)])

    def gather(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, sign = index_vectors(p)
        memo = _Buckets(p.buckets)
        total = np.zeros(p.buckets * p.dim)
        held: list[np.ndarray] = []
        size = 0

        def add(ids: np.ndarray) -> None:
            """Count every token's neighbours; -1 separates documents."""
            for off in range(1, p.window + 1):
                left, right = ids[:-off], ids[off:]
                ok = (left >= 0) & (right >= 0)
                left, right = left[ok], right[ok]
                for a, b in ((left, right), (right, left)):
                    for k in range(p.nonzeros):
                        total[:] += np.bincount(a * p.dim + where[b, k], weights=sign[b, k],
                                                minlength=total.size)

        gap = np.full(p.window, -1, dtype=np.int64)
        for part in parts:
            for text in strings(part.column(0)):
                ids = _ids(text, memo)
                held += [ids, gap]
                size += len(ids)
                if size >= 500_000:
                    add(np.concatenate(held))
                    held, size = [], 0
        if size:
            add(np.concatenate(held))
        table = total.reshape(p.buckets, p.dim).astype(np.int32)
        rows = np.flatnonzero(np.abs(table).sum(1))
        for at in range(0, len(rows), 2048):
            some = rows[at : at + 2048]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), *(pa.array(table[some, j]) for j in range(p.dim))], schema=schema)

    parts = docs.select(F.col(text_col).alias("text")).transform(arrow_map,
        gather, "bucket int, " + ", ".join(f"{n} int" for n in names))
    # At most ``buckets`` rows reach the driver, whatever the input.
    rows = parts.groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names)).collect()
    out = np.zeros((p.buckets, p.dim))
    for r in rows:
        out[r[0]] = r[1:]
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(norm > 0, norm, 1)).astype(np.float32)


def pool(texts: list[str | None], vectors: np.ndarray, memo: _Buckets) -> np.ndarray:
    """Per text: mean and spread of its word vectors, agreement of neighbours, logarithm of length."""
    dim = vectors.shape[1]
    out = np.zeros((len(texts), 2 * dim + 3), dtype=np.float32)
    for i, text in enumerate(texts):
        ids = _ids(text, memo)
        n = len(ids)
        if not n:
            continue
        sums, squares, near = np.zeros(dim), np.zeros(dim), 0.0
        for at in range(0, n, 200_000):
            v = vectors[ids[at : at + 200_001]]  # one more, for the pair across the edge
            near += np.einsum("ij,ij->", v[:-1], v[1:], dtype=np.float64)
            v = v[:200_000]
            sums += v.sum(0, dtype=np.float64)
            squares += np.einsum("ij,ij->j", v, v, dtype=np.float64)
        mean = sums / n
        out[i, :dim] = mean
        out[i, dim : 2 * dim] = np.sqrt(np.maximum(squares / n - mean * mean, 0))
        out[i, -3:] = near / max(n - 1, 1), (ids[1:] == ids[:-1]).sum() / max(n - 1, 1), np.log1p(n)
    return out


@dataclass(frozen=True)
class Network:
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        return np.maximum(z @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, p: QualityParams) -> Network | None:
    """Fit the network by Adam on four fifths of the rows, the temperature on the rest.

    None if the rows hold fewer than two classes.
    """
    if len(np.unique(y)) < 2:
        return None
    rng = np.random.default_rng(p.seed)
    order = rng.permutation(len(y))
    held = order[: len(y) // 5] if len(y) >= 50 else order[:0]
    fit = order[len(held):]
    if len(np.unique(y[fit])) < 2:
        fit, held = order, order[:0]
    centre = x[fit].mean(0)
    spread = x[fit].std(0)
    scale = np.where(spread > 1e-6, spread, 1)
    z = ((x - centre) / scale).astype(np.float64)
    w = [rng.normal(0, np.sqrt(2 / z.shape[1]), (z.shape[1], p.hidden)), np.zeros(p.hidden),
         rng.normal(0, np.sqrt(1 / p.hidden), p.hidden), np.zeros(1)]
    m, v, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for _ in range(p.epochs):
        shuffled = rng.permutation(fit)
        for at in range(0, len(shuffled), p.batch):
            rows = shuffled[at : at + p.batch]
            xb, yb = z[rows], y[rows]
            h = np.maximum(xb @ w[0] + w[1], 0)
            d = (_sigmoid(h @ w[2] + w[3]) - yb) / len(rows)
            dh = np.outer(d, w[2]) * (h > 0)
            grads = [xb.T @ dh + p.decay * w[0], dh.sum(0), h.T @ d + p.decay * w[2], np.array([d.sum()])]
            t += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] = w[k] - p.rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    net = Network(centre, scale, w[0], w[1], w[2], float(w[3][0]), 1.0)
    if not len(held):
        return net
    logits, target = net.logits(x[held]), y[held]

    def loss(temperature: float) -> float:
        q = np.clip(_sigmoid(logits / temperature), 1e-9, 1 - 1e-9)
        return float(-(target * np.log(q) + (1 - target) * np.log(1 - q)).mean())

    best = min(np.exp(np.linspace(-2, 2, 161)), key=loss)
    return Network(centre, scale, w[0], w[1], w[2], float(w[3][0]), float(best))


def labelled_sample(labels: DataFrame, p: QualityParams, id_col: str = "doc_id",
                    label_col: str = "quality") -> DataFrame:
    """(id, y) of at most ``max_labelled`` labelled documents, the first by a hash of the id.

    Only documents whose crc32(id as text) mod 5 is not 0; one agreed 0/1 label per document.
    """
    one = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
           .where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id")))
           .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("other")).where("y = other"))
    return one.select("id", "y").orderBy(F.xxhash64("id", F.lit(p.seed)), "id").limit(p.max_labelled)


def held_out(id_col):
    """Whether a document is kept away from training: crc32(id as text) mod 5 is 0."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, p: QualityParams = QualityParams(), id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> tuple[np.ndarray, Network | None]:
    """Word vectors over all documents and the network of the labelled sample."""
    vectors = word_vectors(docs, text_col, p)
    sample = written(labelled_sample(labels, p, id_col, label_col), "quality-sample")
    # ``max_labelled`` rows at most, so the broadcast has a fixed bound.
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
             .join(F.broadcast(sample), "id").select("id", "y", "text"))
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    schema = pa.schema([("id", pa.int64()), ("y", pa.int32()), ("x", pa.binary())])

    def features(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Buckets(p.buckets)
        for part in parts:
            x = pool(strings(part.column(2)), shared.value, memo)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).cast(pa.int64()), part.column(1).cast(pa.int32()),
                 pa.array([r.tobytes() for r in x], type=pa.binary())], schema=schema)

    rows = (texts.transform(arrow_map, features, "id long, y int, x binary").dropDuplicates(["id"])
            .orderBy("id").collect())
    if not rows:
        return vectors, None
    x = np.stack([np.frombuffer(r.x, dtype=np.float32) for r in rows])
    return vectors, train(x, np.array([float(r.y) for r in rows]), p)


def score(docs: DataFrame, vectors: np.ndarray, net: Network | None, p: QualityParams = QualityParams(),
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast((vectors, net))
    slim = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("__text"))
    id_type = slim.schema[id_col].dataType.simpleString()

    def scored(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, net = shared.value
        memo = _Buckets(p.buckets)
        for part in parts:
            texts = strings(part.column(1))
            if net is None:
                s = np.full(len(texts), 0.5)
            else:
                s = net.scores(pool(texts, vectors, memo).astype(np.float64))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s)], names=[id_col, "score"])

    return (slim.transform(arrow_map, scored, f"`{id_col}` {id_type}, score double")
            .withColumn("predicted", F.when(F.col("score") >= p.threshold, 1).otherwise(0)))


def classify(docs: DataFrame, labels: DataFrame, p: QualityParams = QualityParams(), id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Fit on the labelled training rows and score all documents: (id, held_out, score, predicted)."""
    vectors, net = fit(docs, labels, p, id_col, text_col, label_col)
    return score(docs, vectors, net, p, id_col, text_col).select(
        id_col, held_out(F.col(id_col)).alias("held_out"), "score", "predicted")


def keep(docs: DataFrame, vectors: np.ndarray, net: Network | None, p: QualityParams = QualityParams(),
         text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least the threshold, with all their columns.

    Every row is judged by its own text, so rows with null or repeated ids need no join.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vectors, net))
    at = docs.columns.index(text_col)

    def kept(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, net = shared.value
        memo = _Buckets(p.buckets)
        for part in parts:
            if net is not None:
                s = net.scores(pool(strings(part.column(at)), vectors, memo).astype(np.float64))
                part = part.filter(pa.array(s >= p.threshold))
            yield part

    return docs.transform(arrow_map, kept, docs.schema)
