"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network with a calibrated temperature."""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.plans.workspace import Workspace

_TOKEN = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[^\sA-Za-z0-9\x80-\xff]+")


def tokens(text: bytes | None) -> list[bytes]:
    """Words (lower-cased, unless written in capitals throughout) and runs of symbols."""
    found = _TOKEN.findall(text or b"")
    return [t if len(t) > 1 and t.isupper() else t.lower() for t in found]


class QualityModel:
    """Fitted on a bounded sample; pickles to a few MB whatever the corpus.

    A word's vector is its own sparse random index vector plus the normalised sum of its neighbours' index vectors in
    the sample, permuted by their side; words outside the vocabulary keep the index vector of their hash. Two words
    ``k`` apart are bound by the product of their index vectors, component by component. A document is the mean of its words'
    vectors and, for each of the lags, the mean of its bound pairs.
    """

    def __init__(self, dim: int = 64, hidden: int = 24, vocabulary: int = 20000, buckets: int = 4096, lags: tuple = (1, 2, 3, 4), seed: int = 7):
        self.dim, self.hidden, self.size, self.buckets, self.lags = dim, hidden, vocabulary, buckets, lags
        rng = np.random.default_rng(seed)
        self.index = np.zeros((buckets, dim), np.float32)
        for row in self.index:
            row[rng.choice(dim, 8, replace=False)] = rng.choice([-1.0, 1.0], 8)
        self.ids: dict[bytes, int] = {}
        self.vectors = self.own = self.index
        self.rng = rng
        self.net: tuple | None = None
        self.base, self.temperature = 0.5, 1.0

    def _bucket(self, t: bytes) -> int:
        return xxhash.xxh3_64_intdigest(t) % self.buckets

    def _rows(self, ts: list[bytes]) -> np.ndarray:
        get, n = self.ids.get, len(ts)
        out = np.fromiter(map(get, ts, repeat(-1)), np.int64, n)
        for i in np.nonzero(out < 0)[0]:
            out[i] = self._bucket(ts[i])
        return out

    def features(self, text: bytes | None, part: int = 1 << 14) -> np.ndarray:
        ids = self._rows(tokens(text))
        x = np.zeros((1 + len(self.lags), self.dim))
        if not len(ids):
            return x.ravel()
        rows, count = np.unique(ids, return_counts=True)
        x[0] = count.astype(np.float32) @ self.vectors[rows] / len(ids)
        most = max(self.lags, default=0)
        for lo in range(0, len(ids), part):  # a long text in parts
            v = self.own[ids[max(lo - most, 0) : lo + part]]
            skip = min(lo, most)
            for i, k in enumerate(self.lags):
                at = max(skip, k)
                if len(v) > at:
                    x[1 + i] += np.einsum("td,td->d", v[at:], v[at - k : len(v) - k])
        for i, k in enumerate(self.lags):
            x[1 + i] /= max(len(ids) - k, 1)
        return x.ravel()

    def fit(self, texts: list[bytes], y: np.ndarray) -> QualityModel:
        """Learn vectors and network; one class or no rows leave a constant score."""
        if len(y):
            self.base = float(np.mean(y))
        if len(set(y.tolist())) < 2:
            return self
        count: Counter = Counter()
        for t in texts:  # tokens are made twice rather than held
            count.update(tokens(t))
        kept = sorted((t for t, c in count.items() if c > 1), key=lambda t: (-count[t], t))[: self.size]
        own = np.array([self._bucket(t) for t in kept], np.int64)
        place = {t: i for i, t in enumerate(kept)}
        ctx = np.zeros((len(kept) + 1, self.dim), np.float32)
        for text in texts:
            at = np.array([place.get(t, -1) for t in tokens(text)], np.int64)
            iv = self.index[np.where(at >= 0, own[at] if len(own) else 0, 0)] if len(at) else None
            for k in (1, 2):
                if len(at) > k:
                    np.add.at(ctx, at[k:], np.roll(iv[:-k], k, 1))
                    np.add.at(ctx, at[:-k], np.roll(iv[k:], -k, 1))
        ctx = ctx[:-1] / np.maximum(np.linalg.norm(ctx[:-1], axis=1, keepdims=True), 1e-6)
        self.ids = {t: i + self.buckets for i, t in enumerate(kept)}
        self.own = np.concatenate([self.index, self.index[own]])
        self.vectors = np.concatenate([self.index, self.index[own] + 2 * ctx])
        self._train(np.array([self.features(t) for t in texts], np.float64), y.astype(np.float64))
        return self

    def _train(self, x: np.ndarray, y: np.ndarray, steps: int = 1500, batch: int = 128) -> None:
        order = self.rng.permutation(len(y))
        cal, fit = order[: len(y) // 5], order[len(y) // 5 :]
        mean, sd = x[fit].mean(0), x[fit].std(0) + 1e-3
        z = (x - mean) / sd
        p = [self.rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], self.hidden)), np.zeros(self.hidden), self.rng.normal(0, 0.3, self.hidden), np.zeros(1)]
        m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
        for step in range(1, steps + 1):
            rows = self.rng.choice(fit, batch)
            h = np.tanh(z[rows] @ p[0] + p[1])
            d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - y[rows]) / batch
            dh = np.outer(d, p[2]) * (1 - h * h)
            g = [z[rows].T @ dh + 1e-3 * p[0], dh.sum(0), h.T @ d + 1e-3 * p[2], np.array([d.sum()])]
            for i in range(4):
                m[i] = 0.9 * m[i] + 0.1 * g[i]
                v[i] = 0.999 * v[i] + 0.001 * g[i] ** 2
                p[i] = p[i] - 0.01 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        self.net = (mean, sd, *p)
        rows = cal if len(cal) >= 20 else order
        logit, t = self._logits(x[rows]), np.geomspace(0.25, 8, 41)
        loss = [np.mean(np.logaddexp(0, -np.where(y[rows] > 0, 1, -1) * logit / k)) for k in t]
        self.temperature = float(t[int(np.argmin(loss))])

    def _logits(self, x: np.ndarray) -> np.ndarray:
        mean, sd, w1, b1, w2, b2 = self.net
        return np.tanh((x - mean) / sd @ w1 + b1) @ w2 + b2

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        if not texts or self.net is None:
            return np.full(len(texts), self.base)
        x = np.array([self.features(t) for t in texts], np.float64)
        return 1 / (1 + np.exp(-np.clip(self._logits(x) / self.temperature, -60, 60)))


def fit_quality(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, sample: int = 3000, sample_bytes: int = 64 << 20) -> QualityModel:
    """Fit on at most ``sample`` labelled documents outside the held fold, of at most ``sample_bytes`` together.

    They are the first by a hash of doc_id over all labels; whole texts, of which those that no longer fit are passed over.
    The sample, bounded so, meets in one task, and the driver gets the fitted model alone. No rows leave a constant score.
    A doc_id with both labels teaches nothing; of documents that repeat a doc_id, the least text does.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(F.crc32(F.col("doc_id").cast("string")) % folds != held).groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most")
    ids = known.select("doc_id", "quality", F.xxhash64("doc_id").alias("turn")).orderBy("turn", "doc_id").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("t")).join(F.broadcast(ids), "doc_id")
    rows = Workspace(docs.sparkSession, "quality").save(rows.groupBy("turn", "doc_id", "quality").agg(F.min(F.coalesce("t", F.lit(b""))).alias("t")), "sample")
    total, kept = 0, []
    for r in rows.select("turn", "doc_id", F.octet_length("t").alias("n")).orderBy("turn", "doc_id").collect():
        if total + r["n"] <= sample_bytes:
            total += r["n"]
            kept.append(r["doc_id"])
    some = docs.sparkSession.createDataFrame([(i,) for i in kept], "doc_id long")
    found = rows.join(F.broadcast(some), "doc_id", "left_semi").select("turn", "doc_id", "quality", "t")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if got := [b for b in batches if len(b)]:
            table = pa.Table.from_batches(got).sort_by([("turn", "ascending"), ("doc_id", "ascending")])
            model = QualityModel().fit(table.column("t").to_pylist(), table.column("quality").to_numpy().astype(np.int64))
            yield pa.record_batch([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    made = found.coalesce(1).mapInArrow(fit, "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else QualityModel()


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.3, folds: int = 5, held: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs(doc_id, text)``, from its whole text alone.

    Null and empty texts are scored as texts without tokens. held_out tells whether crc32 of the doc_id falls in the
    held fold (false for a null doc_id). Repeated rows are scored one by one, other columns ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = shared.value.score(b.column(1).to_pylist())
            yield pa.record_batch([b.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("t")).mapInArrow(run, "doc_id long, score double")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, with all their columns; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if t is None else t.encode() for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(shared.value.score(texts) >= threshold, pa.bool_()))

    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))  # names of any kind pass by their places
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
