"""Quality classifier: random-indexing word vectors and a two-layer network.

Every token falls into one of ``BUCKETS`` buckets, and every bucket has a fixed
sparse random index vector. A bucket's word vector is the sum of the index
vectors of its tokens' neighbours over the whole corpus (random indexing),
scaled to length 1, with a share of its own index vector for words seldom seen.
A document is its token vectors pooled (mean, spread, steps) and its length. A
two-layer numpy network scores it, and a temperature fitted on labelled rows
that the network did not see calibrates the score.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardgrain.llm.common import arrow_map

BUCKETS = 1 << 14
DIM = 48
NONZERO = 4
WINDOW = 2
OWN = 0.3
BLOCK = 1 << 17
WIDTH = 3 * DIM + 1  # features of a document
MAX_LABELLED = 20_000  # bound of the labelled sample the network is fitted on
HIDDEN = 32
# Runs of letters, of digits, and of anything else that is not white space.
_TOKENS = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\sA-Za-z0-9\x80-\xff]+").findall


def index_vectors(seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(places, signs) of the non-zero entries of every bucket's index vector."""
    rng = np.random.default_rng(seed)
    return (rng.integers(0, DIM, (BUCKETS, NONZERO)),
            rng.choice(np.array([-1, 1]), (BUCKETS, NONZERO)))


def buckets(text: str | None) -> np.ndarray:
    """Bucket of every token of a whole text, in order."""
    if not text:
        return np.zeros(0, np.int64)
    found = _TOKENS(text.encode("utf-8", "surrogatepass"))
    return np.fromiter(map(zlib.crc32, found), np.int64, len(found)) & (BUCKETS - 1)


def _columns() -> list[str]:
    return [f"d{i}" for i in range(DIM)]


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Vectors of all buckets (BUCKETS x DIM), from every whole text of ``docs``.

    Tasks add up their own texts and send at most BUCKETS rows each; the table
    that comes back has BUCKETS rows whatever the corpus.
    """
    names = _columns()
    schema = pa.schema([("bucket", pa.int32()), *((n, pa.int64()) for n in names)])

    def run(batches):
        places, signs = index_vectors()
        # one bucket more, between documents, with an empty index vector
        places = np.vstack([places, np.zeros((1, NONZERO), places.dtype)])
        signs = np.vstack([signs, np.zeros((1, NONZERO), signs.dtype)])
        total = np.zeros((BUCKETS + 1) * DIM)
        gap = np.full(WINDOW, BUCKETS)
        for b in batches:
            t = np.concatenate([x for text in b.column("text").to_pylist()
                                for x in (buckets(text), gap)] or [gap])
            for off in range(1, WINDOW + 1):
                for at in range(0, len(t) - off, BLOCK):
                    left, right = t[at:at + BLOCK], t[at + off:at + off + BLOCK]
                    left = left[:len(right)]
                    for word, near in ((left, right), (right, left)):
                        total += np.bincount((word[:, None] * DIM + places[near]).ravel(),
                                             signs[near].ravel(), len(total))
        sums = total.reshape(-1, DIM)[:BUCKETS].round().astype(np.int64)
        rows = np.flatnonzero(sums.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows.astype(np.int32)), *(pa.array(sums[rows, i]) for i in range(DIM))],
            schema=schema)

    ddl = "bucket int, " + ", ".join(f"{n} long" for n in names)
    got = docs.select("text").mapInArrow(run, ddl).groupBy("bucket").agg(
        *(F.sum(n).alias(n) for n in names)).toArrow()
    out = np.zeros((BUCKETS, DIM))
    if got.num_rows:
        out[got["bucket"].to_numpy()] = np.stack([got[n].to_numpy() for n in names], 1)
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1.0)
    places, signs = index_vectors()
    for j in range(NONZERO):
        np.add.at(out, (np.arange(BUCKETS), places[:, j]), OWN * signs[:, j])
    return out.astype(np.float32)


def pooled(text: str | None, vectors: np.ndarray) -> np.ndarray:
    """A whole text's token vectors pooled: their mean, their standard deviation,
    the root mean square of the step from each to the next, and the logarithm
    of the token count; zeros without a token."""
    t = buckets(text)
    out = np.zeros(WIDTH)
    if not len(t):
        return out.astype(np.float32)
    s, q, d = np.zeros(DIM), np.zeros(DIM), np.zeros(DIM)
    for at in range(0, len(t), BLOCK // 4):
        v = vectors[t[at:at + BLOCK // 4 + 1]]
        step = np.diff(v, axis=0)
        d += np.einsum("ij,ij->j", step, step, dtype=np.float64)
        v = v[:BLOCK // 4]
        s += v.sum(0, dtype=np.float64)
        q += np.einsum("ij,ij->j", v, v, dtype=np.float64)
    mean = s / len(t)
    out[:DIM] = mean
    out[DIM:2 * DIM] = np.sqrt(np.maximum(q / len(t) - mean * mean, 0))
    out[2 * DIM:3 * DIM] = np.sqrt(d / max(1, len(t) - 1))
    out[-1] = np.log1p(len(t))
    return out.astype(np.float32)


@dataclass
class Network:
    """Two layers over standardised features, and the temperature of the logit."""

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
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -60, 60)))


def _loss(logit: np.ndarray, y: np.ndarray, temperature: float) -> float:
    z = logit / temperature
    return float(np.mean(np.logaddexp(0, z) - y * z))


def fit(x: np.ndarray, y: np.ndarray, epochs: int = 60, seed: int = 0) -> Network:
    """Adam on the cross entropy of four fifths of the rows; the last fifth sets
    the temperature. With one class only, a constant score near that class;
    with no rows 0.5."""
    width = x.shape[1]
    rate = (y.sum() + 0.5) / (len(y) + 1)
    net = Network(np.zeros(width), np.ones(width), np.zeros((width, HIDDEN)), np.zeros(HIDDEN),
                  np.zeros(HIDDEN), float(np.log(rate / (1 - rate))))
    if len(np.unique(y)) < 2:
        return net
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, used = order[:len(y) // 5], order[len(y) // 5:]
    net.centre, net.scale = x[used].mean(0), x[used].std(0) + 1e-3
    net.w1 = rng.normal(0, width ** -0.5, (width, HIDDEN))
    net.w2 = rng.normal(0, HIDDEN ** -0.5, HIDDEN)
    keep = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first, second = [np.zeros_like(p) for p in keep], [np.zeros_like(p) for p in keep]
    step = 0
    z = (x - net.centre) / net.scale
    for _ in range(epochs):
        rng.shuffle(used)
        for at in range(0, len(used), 128):
            rows = used[at:at + 128]
            h = np.tanh(z[rows] @ keep[0] + keep[1])
            p = 1 / (1 + np.exp(-np.clip(h @ keep[2] + keep[3], -60, 60)))
            d = (p - y[rows]) / len(rows)
            back = np.outer(d, keep[2]) * (1 - h * h)
            grads = [z[rows].T @ back + 1e-4 * keep[0], back.sum(0), h.T @ d + 1e-4 * keep[2],
                     np.array([d.sum()])]
            step += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                keep[k] -= 0.003 * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = keep[0], keep[1], keep[2], float(keep[3][0])
    if len(held):
        logit = net.logit(x[held])
        grid = np.geomspace(0.25, 8, 61)
        net.temperature = float(grid[int(np.argmin([_loss(logit, y[held], t) for t in grid]))])
    return net


def features(docs: DataFrame, vectors: np.ndarray, *carry: str) -> DataFrame:
    """(carried long columns, x array<float>) of every row."""
    def run(batches):
        for b in batches:
            yield {**{c: b[c] for c in carry}, "x": [pooled(t, vectors) for t in b["text"]]}

    ddl = "".join(f"{c} long, " for c in carry) + "x array<float>"
    return arrow_map(docs.select(*(F.col(c).cast("long") for c in carry), "text"), run, ddl)


def learn(docs: DataFrame, labels: DataFrame, vectors: np.ndarray,
          max_labelled: int = MAX_LABELLED) -> Network:
    """Network for ``labels`` (doc_id, label 0/1): at most about ``max_labelled``
    of the labelled rows, chosen by a hash of doc_id, are pooled and fitted.
    Rows without doc_id or label are left out; a doc_id with several labels
    counts by their mean, rounded.
    """
    rows = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(
        F.round(F.avg("label")).cast("long").alias("label"))
    n = rows.count()
    if n > max_labelled:
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(
            max_labelled / n * (1 << 30)))
    rows = rows.select(F.col("doc_id").cast("long").alias("l_id"), "label")
    used = docs.select("doc_id", "text").join(
        F.broadcast(rows), F.col("doc_id") == F.col("l_id"))  # about max_labelled rows
    got = features(used, vectors, "doc_id", "label").toArrow().sort_by("doc_id")
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(-1, WIDTH).astype(np.float64) \
        if got.num_rows else np.zeros((0, WIDTH))
    return fit(x, got["label"].to_numpy().astype(np.float64))


def classify(docs: DataFrame, vectors: np.ndarray, net: Network) -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs`` (doc_id, text).

    Whole texts; a null text counts as empty and has the score of a document
    without tokens. Repeated rows repeat; an empty table gives no rows; other
    columns are not read. predicted is 1 from a score of 0.5 on.
    """
    def run(batches):
        for b in batches:
            x = np.array([pooled(t, vectors) for t in b["text"]], np.float64).reshape(-1, WIDTH)
            s = net.score(x)
            yield {"doc_id": b["doc_id"], "score": s.tolist(),
                   "predicted": (s >= 0.5).astype(np.int32).tolist()}

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run,
                     "doc_id long, score double, predicted int")


def keep(docs: DataFrame, vectors: np.ndarray, net: Network, least: float) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``least``, columns as they are."""
    def run(batches):
        for b in batches:
            texts = b.column(b.schema.get_field_index("text")).to_pylist()
            x = np.array([pooled(t, vectors) for t in texts], np.float64).reshape(-1, WIDTH)
            yield b.filter(pa.array(net.score(x) >= least))

    return docs.mapInArrow(run, docs.schema)
