"""Toxic spans by a linear-chain conditional random field over words, and document scores from its marginals."""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.plans.workspace import Workspace

_WORD = re.compile(r"\S+")
_STOP = (".", "!", "?", ";")
_MARKS = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~¡¿«»“”„‘’…–—。，！？"
#: Words of a chain: a sentence, or so many of a longer one.
_LONGEST = 64


def units(word: str) -> list[str]:
    """What the field sees of a word: the word without marks at its edges, its beginnings and its endings."""
    w = word.strip(_MARKS).lower()
    n = len(w)
    return ["=" + w] + ["^" + w[:k] for k in range(3, min(9, n))] + ["$" + w[-k:] for k in range(3, min(7, n))]


class Chains:
    """Words of many texts cut into chains at sentence ends, dealt so that all chains step on together."""

    def __init__(self, starts: np.ndarray, n: int):
        self.n = n
        size = np.diff(np.append(starts, n))
        order = np.argsort(-size, kind="stable")
        self.start, self.size = starts[order], size[order]
        most = int(self.size[0]) if len(size) else 0
        self.live = np.searchsorted(-self.size, -np.arange(most), side="left")  # chains longer than each step

    def marginals(self, e: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(p, f, r) of the toxic state. ``e``: log odds of each word by itself, ``a``: 2 x 2 factors of neighbouring states.

        With two states, the forward and backward passes carry one number each: the ratio of the toxic to the clean state.
        """
        odds = np.exp(np.clip(e, -30, 30))
        f, g = np.ones(self.n), np.ones(self.n)
        for t, k in enumerate(self.live):
            at = self.start[:k] + t
            f[at] = odds[at] if t == 0 else odds[at] * (a[0, 1] + f[at - 1] * a[1, 1]) / (a[0, 0] + f[at - 1] * a[1, 0])
        for t in range(len(self.live) - 2, -1, -1):
            at = self.start[: self.live[t + 1]] + t
            r = odds[at + 1] * g[at + 1]
            g[at] = (a[1, 0] + r * a[1, 1]) / (a[0, 0] + r * a[0, 1])
        x = f * g
        return x / (1 + x), f, odds * g

    def follows(self) -> np.ndarray:
        """Places of the words that have a word before them in their chain."""
        inner = np.ones(self.n, bool)
        inner[self.start] = False
        return np.nonzero(inner)[0]


class ToxicityModel:
    """Fitted on a bounded sample; pickles to a few MB whatever the corpus."""

    def __init__(self, most: int = 200_000):
        self.most = most
        self.weight: dict[str, float] = {}
        self.bias = 0.0
        self.factor = np.ones((2, 2))
        self.head: np.ndarray | None = None
        self.base = 0.0
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.size, self.odds, self.ends = 0, np.zeros(1024), np.zeros(1024, bool)

    # words and chains

    def _look(self, words: list[str]) -> np.ndarray:
        """Places of the words in the table of words met lately (a bound on memory, not on words)."""
        if len(self.known) > 400_000:
            self.known, self.size = {}, 0
        get = self.known.get
        ids = np.array([get(w, -1) for w in words], np.int64)
        for i in np.nonzero(ids < 0)[0].tolist():
            w = words[i]
            if (k := get(w)) is None:
                if self.size == len(self.odds):
                    self.odds, self.ends = np.resize(self.odds, 2 * self.size + 1024), np.resize(self.ends, 2 * self.size + 1024)
                k = self.known[w] = self.size
                weight = self.weight.get
                self.odds[k] = self.bias + sum([weight(u, 0.0) for u in units(w)])
                self.ends[k] = w.endswith(_STOP)
                self.size += 1
            ids[i] = k
        return ids

    @staticmethod
    def _chains(ends: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Starts of chains: the first word of a text, each word after a sentence's end, and parts of very long sentences."""
        begins = np.zeros(len(ends), bool)
        begins[1:] = ends[:-1]
        begins[first[first < len(ends)]] = True
        at, here = np.nonzero(begins)[0], np.arange(len(ends))
        return np.nonzero((here - np.repeat(at, np.diff(np.append(at, len(ends))))) % _LONGEST == 0)[0]

    def tag(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Marginal probability of the toxic state for each word of the texts, one after the other, and where each text begins."""
        words: list[str] = []
        cut = [0]
        for t in texts:
            words += (t or "").split()
            cut.append(len(words))
        if not words:
            return np.zeros(0), np.array(cut)
        ids = self._look(words)
        starts = self._chains(self.ends[ids], np.array(cut[:-1]))
        return Chains(starts, len(words)).marginals(self.odds[ids], self.factor)[0], np.array(cut)

    # documents

    @staticmethod
    def summary(p: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """Of each text: expected toxic words, on two scales and by the text's length, and their greatest probability."""
        n = np.diff(cut)
        s, top, some = np.zeros(len(n)), np.zeros(len(n)), n > 0
        if some.any():
            s[some], top[some] = np.add.reduceat(p, cut[:-1][some]), np.maximum.reduceat(p, cut[:-1][some])
        return np.column_stack([np.log(s + 1e-3), np.log1p(s), top, np.log((s + 1e-2) / (n + 20))])

    def judge(self, p: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """Scores of texts from the marginals of their words."""
        if self.head is None:
            return np.full(len(cut) - 1, self.base)
        return 1 / (1 + np.exp(-np.clip(self.summary(p, cut) @ self.head[:-1] + self.head[-1], -30, 30)))

    def score(self, texts: list[str | None]) -> np.ndarray:
        return self.judge(*self.tag(texts))

    # learning

    def fit(self, texts: list[str], y: np.ndarray, weights: np.ndarray, rounds: int = 2) -> ToxicityModel:
        """Learn from labelled documents; ``weights`` restore the labels' own shares. One class leaves a constant score.

        Documents' labels become labels of words: no word of a clean document is toxic; a word of a toxic one is if some unit
        of it is far more frequent in toxic documents, and in later rounds if the field says so.
        """
        self.base = float(np.average(y, weights=weights)) if len(y) else 0.0
        if len(set(y.tolist())) < 2:
            return self
        ids: dict[str, int] = {}
        flat: list[int] = []
        cut = [0]
        for t in texts:
            flat += [ids.setdefault(w, len(ids)) for w in t.split()]
            cut.append(len(flat))
        word, cuts = np.array(flat, np.int64), np.array(cut)
        doc = np.repeat(np.arange(len(texts)), np.diff(cuts))
        bad_doc = y[doc] > 0
        row, unit, names, lift = self._units(ids, word, doc, y)
        ends = np.array([w.endswith(_STOP) for w in ids], bool)[word] if len(word) else np.zeros(0, bool)
        chains = Chains(self._chains(ends, cuts[:-1]), len(word))
        best = np.full(len(ids), -np.inf)
        np.maximum.at(best, row, lift[unit])
        label = bad_doc & (best[word] > 2.0)
        w_doc = weights[doc]
        for _ in range(rounds):
            theta, bias, trans, e = self._train(chains, word, row, unit, len(ids), len(names), label, w_doc)
            p, _, _ = chains.marginals(e, np.exp(trans))
            label = bad_doc & (p > 0.3)
        self.weight = {names[i]: float(theta[i]) for i in np.nonzero(np.abs(theta) > 1e-3)[0]}
        self.bias, self.factor = float(bias), np.exp(trans)
        self.head = _logistic(self.summary(p, cuts), y.astype(float), weights)
        return self

    def _units(self, ids: dict[str, int], word: np.ndarray, doc: np.ndarray, y: np.ndarray):
        """Units of the sample's words as a sparse matrix (row: word, unit), their names, and their log odds by documents."""
        pairs = np.unique(np.stack([doc, word], 1), axis=0)
        of: list[list[str]] = [units(w) for w in ids]
        n_bad = max(int((y > 0).sum()), 1)
        n_good = max(len(y) - n_bad, 1)
        bad, good = Counter(), Counter()
        starts = np.append(np.nonzero(np.diff(pairs[:, 0], prepend=-1))[0], len(pairs))
        for a, b in zip(starts[:-1], starts[1:]):
            seen: set[str] = set()
            for w in pairs[a:b, 1].tolist():
                seen.update(of[w])
            (bad if y[pairs[a, 0]] > 0 else good).update(seen)
        names = sorted((u for u in set(bad) | set(good) if bad[u] + good[u] > 1), key=lambda u: (-bad[u] - good[u], u))[: self.most]
        at = {u: i for i, u in enumerate(names)}
        row, unit = [], []
        for i, us in enumerate(of):
            for u in us:
                if u in at:
                    row.append(i)
                    unit.append(at[u])
        # a rare unit proves little: its share in toxic documents is shrunk towards the share of all
        lift = np.array([np.log((bad[u] + 0.5) / (n_bad + 1)) - np.log((good[u] + 0.5) / (n_good + 1)) if bad[u] >= max(2, 0.02 * n_bad) else -np.inf for u in names])
        return np.array(row, np.int64), np.array(unit, np.int64), names, lift

    @staticmethod
    def _train(chains: Chains, word: np.ndarray, row: np.ndarray, unit: np.ndarray, n_words: int, n_units: int, label: np.ndarray, weight: np.ndarray, steps: int = 45, ridge: float = 2.0):
        """Penalised conditional likelihood by Adam on whole gradients: units' weights, bias and transitions."""
        theta, trans = np.zeros(n_units + 1), np.zeros((2, 2))
        theta[-1] = -2.0
        inner = chains.follows()
        y = label.astype(float)
        pair = np.bincount(2 * label[inner - 1] + label[inner], weights=weight[inner], minlength=4).reshape(2, 2)
        m, v = np.zeros(n_units + 5), np.zeros(n_units + 5)
        total = max(float(weight.sum()), 1.0)
        e = np.zeros(len(word))
        for step in range(1, steps + 1):
            e = (np.bincount(row, theta[unit], n_words) + theta[-1])[word] if len(row) else np.full(len(word), theta[-1])
            a = np.exp(trans)
            p, f, r = chains.marginals(e, a)
            gap = np.bincount(word, (p - y) * weight, n_words)
            left, right = f[inner - 1], r[inner]
            both = np.stack([np.full(len(inner), a[0, 0]), a[0, 1] * right, a[1, 0] * left, a[1, 1] * left * right])
            both = (both / both.sum(0) * weight[inner]).sum(1).reshape(2, 2)
            grad = np.concatenate([np.bincount(unit, gap[row], n_units) + ridge * theta[:-1], [gap.sum()], (both - pair).ravel() + 0.1 * trans.ravel()]) / total
            m = 0.8 * m + 0.2 * grad
            v = 0.98 * v + 0.02 * grad**2
            move = 0.25 * (m / (1 - 0.8**step)) / (np.sqrt(v / (1 - 0.98**step)) + 1e-9)
            theta = theta - move[: n_units + 1]
            trans = trans - move[n_units + 1 :].reshape(2, 2)
        e = (np.bincount(row, theta[unit], n_words) + theta[-1])[word] if len(row) else e
        return theta[:-1], theta[-1], trans, e


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Coefficients, none of them negative, and intercept, by Newton's method; columns that would count against go one by one."""
    z = np.column_stack([x, np.ones(len(x))])
    kept = list(range(z.shape[1]))
    while True:
        u, b = z[:, kept], np.zeros(len(kept))
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(u @ b, -30, 30)))
            h = (u * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ u + ridge * np.eye(len(b))
            move = np.linalg.solve(h, u.T @ (weight * (p - y)) + ridge * b)
            b = b - np.clip(move, -4, 4)
            if np.abs(move).max() < 1e-8:
                break
        if len(kept) == 1 or b[:-1].min() >= 0:
            out = np.zeros(z.shape[1])
            out[kept] = b
            return out
        kept.pop(int(np.argmin(b[:-1])))


def fit_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, toxic: int = 800, clean: int = 2400, sample_bytes: int = 10 << 20) -> ToxicityModel:
    """Fit on at most ``toxic`` and ``clean`` labelled documents outside the held fold, of ``sample_bytes`` together.

    They are the first of their label by a hash of doc_id over all labels, whole texts, of which those that no longer fit are
    passed over; each counts for as many as its label has. The sample, bounded so, meets in one task and the driver gets the
    model alone. A doc_id with both labels teaches nothing; of documents that repeat a doc_id, the least text does.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "toxicity")
    known = labels.where("doc_id is not null and toxic in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y"))
    known = known.where(F.crc32(F.col("doc_id").cast("string")) % folds != held).groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("most")).where("y = most")
    known = ws.save(known.select("doc_id", "y", F.xxhash64("doc_id").alias("turn")), "labels")
    share = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    ids = known.where("y = 1").orderBy("turn", "doc_id").limit(toxic).union(known.where("y = 0").orderBy("turn", "doc_id").limit(clean))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id")
    rows = ws.save(rows.groupBy("turn", "doc_id", "y").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")), "sample")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if len(b)]
        if not got:
            return
        table = pa.Table.from_batches(got).sort_by([("turn", "ascending"), ("doc_id", "ascending")])
        texts, y, room = [], [], {1: sample_bytes // 3, 0: sample_bytes - sample_bytes // 3}
        for t, k in zip(table.column("text").to_pylist(), table.column("y").to_pylist()):
            if (n := len(t.encode())) <= room[k]:
                room[k] -= n
                texts.append(t)
                y.append(k)
        y = np.array(y, np.int64)
        weight = np.where(y > 0, share.get(1, 0) / max(int((y > 0).sum()), 1), share.get(0, 0) / max(int((y == 0).sum()), 1))
        model = ToxicityModel().fit(texts, y, weight * len(y) / max(weight.sum(), 1e-9))
        yield pa.record_batch([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    made = rows.coalesce(1).mapInArrow(fit, "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else ToxicityModel()


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7, folds: int = 3, held: int = 1, least: float = 0.5, part: int = 1 << 20) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_toxic, spans) for each row of ``docs(doc_id, text)``, from its whole text alone.

    ``spans`` are the offending stretches (start and end in code points, and the greatest marginal of a word): neighbouring
    words of a marginal of ``least`` or more; ``n_toxic`` is the expected number of toxic words. Null and empty texts are
    scored as texts without words. held_out is false for a null doc_id; repeated rows are scored one by one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])

    def spans(text: str | None, p: np.ndarray) -> list[dict]:
        hot = set(np.nonzero(p >= least)[0].tolist())
        out: list[dict] = []
        if not hot:
            return out
        last, most = -2, max(hot)
        for i, m in enumerate(_WORD.finditer(text)):
            if i in hot:
                if last == i - 1:
                    out[-1] |= {"end": m.end(), "p": max(out[-1]["p"], float(p[i]))}
                else:
                    out.append({"start": m.start(), "end": m.end(), "p": float(p[i])})
                last = i
            if i >= most:
                break
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            model, lo = shared.value, 0
            while lo < len(b):  # some texts at a time
                hi, size = lo, 0
                while hi < len(b) and size < part:
                    size += len(b.column(1)[hi].as_py() or "")
                    hi += 1
                texts = b.column(1)[lo:hi].to_pylist()
                p, cut = model.tag(texts)
                at = [spans(t, p[i:j]) for t, i, j in zip(texts, cut[:-1], cut[1:])]
                n = np.bincount(np.repeat(np.arange(len(texts)), np.diff(cut)), p, len(texts))
                yield pa.record_batch([b.column(0)[lo:hi], pa.array(model.judge(p, cut), pa.float64()), pa.array(n, pa.float64()), pa.array(at, pa.list_(span))], ["doc_id", "score", "n_toxic", "spans"])
                lo = hi

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("t"))
    out = out.mapInArrow(run, "doc_id long, score double, n_toxic double, spans array<struct<start: long, end: long, p: double>>")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_toxic", "spans")
