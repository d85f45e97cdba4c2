"""Periodic runs of words: suffix trees of a text and its reversal, constant-time common extensions, Lyndon roots."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run has at least this many words and this many periods.
LEAST, PERIODS = 6, 4
#: Words in a row that occur at least twice in every run of that size.
_GRAM = 5


def suffix_tree(s: list[int], sigma: int) -> tuple[dict[int, int], list[int], list[int]]:
    """Ukkonen's tree of ``s``, whose last symbol occurs once: children by ``node * sigma + symbol``, edges' starts and ends."""
    n = len(s)
    child: dict[int, int] = {}
    start, end, link = [0], [0], [0]
    node = edge = length = left = 0
    for pos, c in enumerate(s):
        left += 1
        waits = 0  # an inner node without its suffix link
        while left:
            if not length:
                edge = pos
            key = node * sigma + s[edge]
            to = child.get(key)
            if to is None:
                child[key] = len(start)
                start.append(pos)
                end.append(n)
                link.append(0)
                if waits:
                    link[waits] = node
                    waits = 0
            else:
                at = start[to]
                size = end[to] - at
                if length >= size:
                    edge += size
                    length -= size
                    node = to
                    continue
                if s[at + length] == c:
                    length += 1
                    if waits:
                        link[waits] = node
                    break
                inner = len(start)
                child[key] = inner
                start += (at, pos)
                end += (at + length, n)
                link += (0, 0)
                child[inner * sigma + c] = inner + 1
                start[to] = at + length
                child[inner * sigma + s[at + length]] = to
                if waits:
                    link[waits] = inner
                waits = inner
            left -= 1
            if not node and length:
                length -= 1
                edge = pos - left + 1
            else:
                node = link[node]
    return child, start, end


class Extensions:
    """Common extensions of suffixes of a sequence of small integers (from 1): least depth of an Euler tour between two leaves.

    The tour's depths are cut into blocks: minima from a block's edges, a sparse table over blocks, and a scan for two leaves
    of one block, so a question takes constant time and the memory is linear.
    """

    BLOCK = 16

    def __init__(self, seq: np.ndarray):
        s = [*seq.tolist(), 0]  # the end sorts first
        sigma, n = int(seq.max()) + 1, len(s)
        child, start, end = suffix_tree(s, sigma)
        keys = np.fromiter(child.keys(), np.int64, len(child))
        to = np.fromiter(child.values(), np.int64, len(child))
        order = np.argsort(keys)
        self.parent, self.symbol, self.to = keys[order] // sigma, keys[order] % sigma, to[order]
        cut = np.searchsorted(self.parent, np.arange(len(start) + 1))
        self.lo, self.hi = cut[:-1].tolist(), cut[1:].tolist()
        self.size = [b - a for a, b in zip(start, end)]
        self.n = n
        tour, first, self.leaves = self._tour(self.to.tolist())
        self.first = np.array(first)
        pad = -len(tour) % self.BLOCK
        d = np.array(tour + [n] * pad, np.int64).reshape(-1, self.BLOCK)
        self.flat = d.ravel()
        self.head = np.minimum.accumulate(d, 1).ravel()
        self.tail = np.minimum.accumulate(d[:, ::-1], 1)[:, ::-1].ravel()
        self.table = [d.min(1)]
        while (step := 1 << (len(self.table) - 1)) * 2 <= len(d):
            self.table.append(np.minimum(self.table[-1][:-step], self.table[-1][step:]))

    def _tour(self, children: list[int]) -> tuple[list[int], list[int], list[int]]:
        """Depths along the Euler tour, the place of each suffix's leaf in it, and the suffixes in the order of their leaves."""
        lo, hi, size, n = self.lo, self.hi, self.size, self.n
        tour, first, leaves = [], [0] * n, []
        depth = [0] * len(size)
        stack = [0]
        while stack:
            v = stack.pop()
            if v < 0:
                tour.append(depth[~v])
                continue
            d = depth[v]
            a, b = lo[v], hi[v]
            if a == b:
                first[n - d] = len(tour)
                leaves.append(n - d)
            for c in reversed(children[a:b]):
                depth[c] = d + size[c]
                stack += (~v, c)
            tour.append(d)
        return tour, first, leaves

    def rank(self, falling: bool = False) -> np.ndarray:
        """Each suffix's place in lexicographic order, of the symbols' order or of its reverse; the end is least in both."""
        leaves = self.leaves
        if falling:
            by = np.lexsort((np.where(self.symbol == 0, -1 << 40, -self.symbol), self.parent))
            leaves = self._tour(self.to[by].tolist())[2]
        out = np.empty(self.n, np.int64)
        out[leaves] = np.arange(self.n)
        return out

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of suffixes ``i`` and ``j``, pair by pair."""
        a, b = self.first[i], self.first[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        p, q = a // self.BLOCK, b // self.BLOCK
        out = np.minimum(self.tail[a], self.head[b])
        level = np.frexp(np.maximum(q - p - 1, 1))[1] - 1
        for k in np.unique(level[q - p > 1]):
            at = np.nonzero((level == k) & (q - p > 1))[0]
            t = self.table[k]
            out[at] = np.minimum(out[at], np.minimum(t[p[at] + 1], t[q[at] - (1 << k)]))
        at = np.nonzero(p == q)[0]
        if len(at):
            own = self.flat[a[at]].copy()
            for k in range(1, self.BLOCK):
                here = a[at] + k <= b[at]
                own[here] = np.minimum(own[here], self.flat[a[at][here] + k])
            out[at] = own
        return out


def _lyndon(rank: np.ndarray) -> np.ndarray:
    """End of the longest Lyndon word at each position: the next suffix of smaller rank."""
    r = rank.tolist()
    n = len(r) - 1
    out = [n] * n
    for i in range(n - 1, -1, -1):
        j, mine = i + 1, r[i]
        while r[j] > mine:
            j = out[j]
        out[i] = j
    return np.array(out, np.int64)


def segment_runs(seq: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, least period) of a sequence of integers, of ``LEAST`` words and ``PERIODS`` periods or more.

    Every run has a root that is the longest Lyndon word at its place in the symbols' order or in the reverse order; each such
    word is extended to both sides by common extensions of the sequence and of its reversal.
    """
    n = len(seq)
    if n < LEAST:
        return []
    seq = np.unique(seq, return_inverse=True)[1].ravel() + 1
    ahead, back = Extensions(seq), Extensions(seq[::-1])
    found: set[tuple[int, int, int]] = set()
    for falling in (False, True):
        end = _lyndon(ahead.rank(falling))
        i = np.nonzero(end < n)[0]
        j = end[i]
        right = ahead.common(i, j)
        left = np.zeros(len(i), np.int64)
        inner = i > 0
        left[inner] = back.common(n - i[inner], n - j[inner])
        start, stop, period = i - left, j + right, j - i
        keep = stop - start >= np.maximum(LEAST, PERIODS * period)
        found.update(zip(start[keep].tolist(), (stop - start)[keep].tolist(), period[keep].tolist()))
    return sorted(found)


def _stretches(seq: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of ``seq`` that hold all its runs.

    In a run every word occurs ``PERIODS`` times and every ``_GRAM`` words in a row occur twice (of length at least 4 q and 6,
    it has 4 q - 4 >= q + 1 places for them if q > 1, and two if q = 1). What does not, ends a stretch, and the stretches are
    judged again by themselves until nothing changes.
    """
    out, todo = [], [(0, len(seq))]
    while todo:
        a, b = todo.pop()
        if b - a < LEAST:
            continue
        ids = np.unique(seq[a:b], return_inverse=True)[1].ravel()
        many = np.bincount(ids)[ids] >= PERIODS
        n = b - a - _GRAM + 1
        h, whole = np.zeros(n, np.uint64), np.ones(n, bool)
        for k in range(_GRAM):
            h = h * np.uint64(0x9E3779B97F4A7C15) + (ids[k : k + n] + 1).astype(np.uint64)
            whole &= many[k : k + n]
        order = np.argsort(h, kind="stable")
        same = h[order][1:] == h[order][:-1]
        twice = np.zeros(n, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        step = np.flatnonzero(np.diff(np.concatenate([[0], (twice & whole).astype(np.int8), [0]])))
        parts = [(a + int(u), a + int(v) + _GRAM - 1) for u, v in zip(step[::2], step[1::2])]
        if parts == [(a, b)]:
            out.append((a, b))
        else:
            todo += parts
    return out


def word_runs(words: list) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a list of words, by start and period."""
    if len(words) < LEAST:
        return []
    seen: dict = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    if len(seen) > len(words) - PERIODS + 1:  # no word occurs often enough
        return []
    return sorted((a + s, n, p) for a, b in _stretches(ids) for s, n, p in segment_runs(ids[a:b]))


def planted(words: list, doc_id: int | None) -> list:
    """The words as the contract changes them: in a tenth of the documents, by crc32 of the id, the end becomes periodic."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


_RUN = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
_KINDS = dict.fromkeys(("doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli"), pa.int64()) | {"runs": pa.list_(_RUN), "runs_sha256": pa.string(), "collapsed_sha256": pa.string()}
_OUT = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs array<struct<start: long, length: long, period: long>>, runs_sha256 string, collapsed_sha256 string"


def detect_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """One row for each row of ``docs(doc_id, text)``: its runs of words, the longest of them, and digests.

    Words are runs of bytes other than space and \\x09-\\x0D; a null text has none. A text is treated whole in one task and nothing
    is shuffled; trees are made only of stretches that can hold a run, and a long text costs memory linear in its words.
    Repeated rows are answered each, a null doc_id stays null (and is never planted), other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                words = (text.as_py() or b"").split()
                if plant:
                    words = planted(words, i)
                runs = word_runs(words)
                top = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
                kept = words
                if runs:
                    drop = np.zeros(len(words) + 1, np.int64)
                    for s, n, p in runs:
                        drop[s + p] += 1
                        drop[s + n] -= 1
                    kept = [w for w, d in zip(words, np.cumsum(drop).tolist()) if not d]
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
                milli = 1000 * top[1] // top[2] if runs else None
                spans = [{"start": s, "length": n, "period": p} for s, n, p in runs]
                digests = hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()
                rows.append((i, len(words), len(runs), *top, milli, spans, *digests))
            yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate(_KINDS.values())], list(_KINDS))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, _OUT)

