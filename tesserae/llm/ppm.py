"""Language-model scores by prediction by partial matching, and a unigram base, trained on the whole corpus."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.packing import dealt, loosen, planes, squeeze, whole
from tesserae.plans.workspace import Workspace

_SPACE = re.compile(rb"[ \t-\r]")
_END = 10  # the end symbol; no word holds it
_TAIL = 3  # nodes are dealt by so many nearest bytes of their context; shorter contexts are broadcast


def keys(s: np.ndarray, order: int) -> np.ndarray:
    """For each symbol after the leading context: its ``order`` predecessors, nearest first, and itself, in one integer."""
    n = len(s) - order
    out = s[order:].astype(np.int64)
    for i in range(1, order + 1):
        out |= s[order - i : order - i + n].astype(np.int64) << (8 * (order + 1 - i))
    return out


def _node(key: np.ndarray, order: int, j: int) -> np.ndarray:
    """The node of order ``j`` that a key of ``order`` meets: its ``j`` nearest context bytes and its symbol."""
    return (key >> (8 * (order + 1 - j)) << 8) | (key & 255)


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    if not len(key):
        return key, n
    by = np.argsort(key)
    key, n = key[by], n[by]
    first = np.nonzero(np.append(True, key[1:] != key[:-1]))[0]
    return key[first], np.add.reduceat(n, first)


def levels(code: np.ndarray, n: np.ndarray, top: int, low: int = 0) -> list[tuple[np.ndarray, np.ndarray]]:
    """Nodes with counts of the orders ``low`` to ``top``, summed up from those of order ``top``."""
    out = [_summed(code, n)]
    for _ in range(top - low):
        code, n = out[0]
        out.insert(0, _summed((code >> 16 << 8) | (code & 255), n))
    return out


class Trie:
    """A byte-context trie as sorted arrays: for each order from 0 the (context, symbol) nodes and their counts.

    Probability of a symbol: from the longest context met, the symbol's count over the context's total, or escape to
    the context without its farthest byte, leaving out the symbols already refused (they can no longer occur); last,
    all 256 symbols evenly. Escape estimate (method C): the number of distinct symbols of the context.
    """

    def __init__(self, nodes: list[tuple[np.ndarray, np.ndarray]]):
        self.order = len(nodes) - 1
        self.levels = []
        for j, (code, n) in enumerate(nodes):
            ctx = code >> 8
            first = np.nonzero(np.append(True, ctx[1:] != ctx[:-1]))[0] if len(ctx) else np.zeros(0, np.int64)
            total = np.add.reduceat(n, first).astype(float) if len(ctx) else np.zeros(0)
            rest = np.zeros(len(first))  # what the symbols met here weigh one order below
            if j and len(ctx):
                below, times = nodes[j - 1]
                rest = np.add.reduceat(times[np.searchsorted(below, (code >> 16 << 8) | (code & 255))], first).astype(float)
            self.levels.append((code, n, ctx[first], total, np.diff(np.append(first, len(ctx))), rest))

    @staticmethod
    def _find(known: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(known, x), len(known) - 1)
        return at, known[at] == x

    def log10(self, key: np.ndarray) -> np.ndarray:
        """log10 probability of each key's symbol after its context."""
        out = np.zeros(len(key))
        todo = np.arange(len(key))
        gone_n, gone_d = np.zeros(len(key)), np.zeros(len(key))  # weight and number of the symbols left out
        for j in range(self.order, -1, -1):
            code, n, ctx, total, distinct, rest = self.levels[j]
            if not len(code) or not len(todo):
                continue
            c = _node(key[todo], self.order, j)
            at, known = self._find(ctx, c >> 8)
            spot, hit = self._find(code, c)
            left, esc = total[at] - gone_n, np.maximum(distinct[at] - gone_d, 0)
            out[todo[hit]] += np.log10(n[spot[hit]] / (left + esc)[hit])
            miss = known & ~hit & (left > 0)
            out[todo[miss]] += np.log10(esc[miss] / (left + esc)[miss])
            gone_n, gone_d = np.where(known, rest[at], 0)[~hit], np.where(known, distinct[at], 0)[~hit]
            todo = todo[~hit]
        out[todo] -= np.log10(np.maximum(256 - gone_d, 1))
        return out


def pieces(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """The text cut behind white space about every ``size`` bytes, so that its words never lie in memory all at once."""
    lo = 0
    while lo < len(text):
        cut = _SPACE.search(text, lo + size - 1)
        hi = cut.end() if cut else len(text)
        yield text[lo:hi]
        lo = hi


def normal(text: bytes | None, order: int) -> tuple[bytes, int]:
    """The token sequence as bytes, and its words: ``order`` ends of context, lower-cased words parted by a space, an end."""
    found, n = [], 0
    for p in pieces(text or b""):
        ws = p.lower().split()
        n += len(ws)
        if ws:
            found.append(b" ".join(ws))
    return bytes([_END]) * order + b" ".join(found) + bytes([_END]), n


def _symbols(text: bytes, lens: np.ndarray, order: int, depth: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document numbers, keys of ``depth`` context bytes) of a chunk's symbols, ``size`` at a time."""
    buf = np.frombuffer(text, np.uint8)
    end = np.cumsum(lens)
    start = end - lens
    for lo in range(0, len(buf), size):
        hi = min(lo + size, len(buf))
        a, b = np.searchsorted(end, lo, "right"), np.searchsorted(start, hi, "left")
        doc = np.repeat(np.arange(a, b, dtype=np.int32), np.minimum(end[a:b], hi) - np.maximum(start[a:b], lo))
        at = max(lo, depth)
        doc = doc[at - lo :]
        real = np.arange(at, hi) - start[doc] >= order
        yield doc[real], keys(buf[at - depth : hi], depth)[real]


def _vocabulary(text: bytes) -> tuple[list[bytes], np.ndarray]:
    """Distinct words of a chunk in order of first use, and the place of each word of the text among them."""
    place: defaultdict[bytes, int] = defaultdict()
    place.default_factory = place.__len__
    at = [np.fromiter(map(place.__getitem__, p.split()), np.int64) for p in pieces(text)]
    return list(place), np.concatenate(at)


def _code_bucket(key: np.ndarray, order: int, parts: int) -> np.ndarray:
    tail = key >> (8 * (order + 1 - min(_TAIL, order)))
    return (tail.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % parts


def _word_bucket(vocab: list[bytes], parts: int) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh32_intdigest, vocab), np.int64, len(vocab)) % parts


_CHUNK = "chunk long, docs array<long>, train array<boolean>, lens array<long>, words array<long>, size long, text binary, low array<long>, low_n array<long>"
_ASKED = "kind int, bucket int, chunk long, m int, item binary, n binary"
_TOLD = "kind int, bucket int, of long, m int, value binary"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}
    names, types = zip(*(f.split(" ") for f in schema.split(", ")), strict=True)
    cols = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.record_batch([pa.array(c, kinds[t]) for c, t in zip(cols, types, strict=True)], list(names))


def _packer(order: int, chunk_bytes: int):
    """Chunks of documents: their token sequences, compressed, and the counts of the short contexts in training texts."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq = TaskContext.get().partitionId(), 0

        def row(docs: list, train: list, texts: list, words: list) -> pa.RecordBatch:
            text, lens = b"".join(texts), np.array(list(map(len, texts)))
            found = []
            for doc, k in _symbols(text, lens, order, min(_TAIL, order) - 1, chunk_bytes // 4):
                found.append(np.unique(k[np.array(train, bool)[doc]], return_counts=True))
            low = _summed(*map(np.concatenate, zip(*found, strict=True)))
            return _batch([((task << 32) + seq, docs, train, lens, words, len(text), squeeze(text), *low)], _CHUNK)

        held, size = ([], [], [], []), 0
        for b in batches:
            for doc, t, k in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                text, n = normal(t.as_py(), order)
                for to, x in zip(held, (doc, k, text, n), strict=True):
                    to.append(x)
                size += len(text)
                if size >= chunk_bytes:
                    yield row(*held)
                    held, size, seq = ([], [], [], []), 0, seq + 1
        if held[0]:
            yield row(*held)

    return pack


def _asker(order: int, parts: int, size: int):
    """A chunk's distinct byte codes (kind 0) and words (kind 1) with their counts in training texts, by bucket."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in b.to_pylist():
                text, lens, train = loosen(c["text"]), np.array(c["lens"]), np.array(c["train"], bool)
                seen = []
                for doc, k in _symbols(text, lens, order, order, size):
                    own = train[doc]
                    learned, other = np.sort(k[own]), _distinct(k[~own])
                    first = np.nonzero(np.append(True, learned[1:] != learned[:-1]))[0] if len(learned) else np.zeros(0, np.int64)
                    seen += [(learned[first], np.diff(np.append(first, len(learned)))), (other, np.zeros(len(other), np.int64))]
                code, n = _summed(*map(np.concatenate, zip(*seen, strict=True)))
                out = [(0, i, c["chunk"], len(r), planes(code[r], order + 1), planes(n[r], 4)) for i, r in dealt(_code_bucket(code, order, parts))]
                vocab, at = _vocabulary(text)
                n = np.bincount(at[np.repeat(train, c["words"])], minlength=len(vocab))
                for i, r in dealt(_word_bucket(vocab, parts)):
                    out.append((1, i, c["chunk"], len(r), squeeze(b" ".join([vocab[x] for x in r])), planes(n[r], 4)))
                yield _batch(out, _ASKED)

    return ask


def _teller(low, order: int):
    """Answers a bucket's chunks: the log10 probability of each code, the training count of each word.

    All nodes of a bucket's contexts of ``_TAIL`` bytes or more lie in it, and ``low`` holds the shorter contexts', so
    its trie is that of the whole corpus as far as its codes can see.
    """

    def codes(rows: list[dict]) -> Iterator[tuple[int, bytes]]:
        have = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for i in range(0, len(rows), 64):
            more = [(whole(r["item"], r["m"], order + 1), whole(r["n"], r["m"], 4)) for r in rows[i : i + 64]]
            have = _summed(*map(np.concatenate, zip(have, *more, strict=True)))
        code, n = have
        trie = Trie([*low.value, *levels(code[n > 0], n[n > 0], order, min(_TAIL, order))])
        lp = trie.log10(code).astype(np.float32)
        for r in rows:
            x = lp[np.searchsorted(code, whole(r["item"], r["m"], order + 1))]
            yield r["m"], planes(x.view(np.uint32), 4)

    def words(rows: list[dict]) -> Iterator[tuple[int, bytes]]:
        def named(r: dict) -> list[bytes]:
            return loosen(r["item"]).split(b" ")

        total: defaultdict[bytes, int] = defaultdict(int)
        for r in rows:
            for w, n in zip(named(r), whole(r["n"], r["m"], 4).tolist(), strict=True):
                total[w] += n
        for r in rows:
            yield r["m"], planes(np.fromiter(map(total.__getitem__, named(r)), np.int64, r["m"]), 6)
        yield sum(n > 0 for n in total.values()), b""

    def tell(group: pa.Table) -> pa.Table:
        rows = group.sort_by("chunk").to_pylist()
        kind, bucket = rows[0]["kind"], rows[0]["bucket"]
        told = (words if kind else codes)(rows)
        of = [r["chunk"] for r in rows] + [-1 - bucket]  # last, a bucket of words tells how many of them training knows
        return pa.Table.from_batches([_batch([(kind, bucket, at, m, x) for at, (m, x) in zip(of, told, strict=False)], _TOLD)])

    return tell


def _scorer(order: int, parts: int, size: int, ends: int):
    """Scores of a chunk's documents from the answers of all buckets, which name values in the order they were asked."""

    def values(told: Iterable[dict], bucket: np.ndarray, width: int) -> np.ndarray:
        by = {r["bucket"]: whole(r["value"], r["m"], width) for r in told}
        out = np.zeros(len(bucket), np.int64)
        for i, r in dealt(bucket):
            out[r] = by[i]
        return out

    def score(chunk: pa.Table, told: pa.Table) -> pa.Table:
        if not chunk.num_rows:  # what a bucket of words knows
            return pa.Table.from_batches([_batch([(None, None, None, told.column("m")[0].as_py(), None, None)], _SCORED)])
        c, told = chunk.to_pylist()[0], told.to_pylist()
        text, lens, m = loosen(c["text"]), np.array(c["lens"]), len(c["docs"])
        code = _distinct(np.concatenate([_distinct(k) for _, k in _symbols(text, lens, order, order, size)]))
        lp = values((r for r in told if not r["kind"]), _code_bucket(code, order, parts), 4).astype(np.uint32).view(np.float32).astype(float)
        total = np.zeros(m)
        for doc, k in _symbols(text, lens, order, order, size):
            by = np.argsort(k)
            k = k[by]
            new = np.append(True, k[1:] != k[:-1])
            total += np.bincount(doc[by], lp[np.searchsorted(code, k[new])][np.cumsum(new) - 1], minlength=m)
        vocab, at = _vocabulary(text)
        n = values((r for r in told if r["kind"]), _word_bucket(vocab, parts), 6)
        doc = np.repeat(np.arange(m), c["words"])
        base = np.bincount(doc, np.log10(n + 1)[at], minlength=m) + np.log10(ends + 1)
        known = np.bincount(doc, (n > 0)[at], minlength=m) + (ends > 0)
        cols = (c["docs"], c["train"], np.array(c["words"]) + 1, known.astype(np.int64), base, total)
        return pa.Table.from_batches([_batch(list(zip(*(x if isinstance(x, list) else x.tolist() for x in cols), strict=True)), _SCORED)])

    return score


_SCORED = "doc_id long, train boolean, n_tokens long, n_known long, base double, score double"


def score_language(docs: DataFrame, order: int = 6, folds: int = 7, held: int = 2, chunk_bytes: int = 4 << 20, bucket_bytes: int = 8 << 20) -> DataFrame:
    """Unigram and PPM log10 scores of ``docs(doc_id, text)``, learned from rows outside the held fold.

    Tokens are the words of the lower-cased whole text (runs of other than space and \\x09-\\x0D) and one end. Returns
    a row for each row: doc_id, held_out (crc32 of doc_id mod ``folds`` is ``held``; false for null), n_tokens,
    n_known (tokens seen in training), train_tokens, base_score (add-one unigram), score (PPM over the bytes of the
    token sequence; pretrained, the same counts for all documents; log probabilities of codes are held as 32-bit floats).

    Documents are packed into chunks. A chunk asks for its distinct byte codes and words, with their counts in
    training; codes are dealt by the last three bytes of their context, words by a hash, into buckets whose number
    follows the corpus. A bucket sums the counts of its part of the trie and answers every chunk, and chunks score
    their documents. All nodes of all contexts and all words are used at every size. Nodes of contexts of at most two
    bytes (2**24 at most, whatever the corpus) are broadcast. ``order`` is 1 to 6.

    Null texts count as empty (one token, the end). Repeated rows are scored one by one; an empty table or an empty
    training fold is fine (all words unknown, all bytes even). Very long texts are taken in parts inside a task. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "ppm")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held, F.lit(False))
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("t"), (~held_out).alias("train"))
    chunks = ws.save(src.mapInArrow(_packer(order, chunk_bytes), _CHUNK), "chunks")
    train = F.zip_with("words", "train", lambda n, k: F.when(k, n + 1).otherwise(0))
    total = [F.sum(F.aggregate(x, F.lit(0).cast("long"), lambda a, n: a + n)) for x in (train, F.transform("train", lambda k: k.cast("long")))]
    n, ends, size = (x or 0 for x in chunks.agg(*total, F.sum("size")).first())
    parts = max(8, size // bucket_bytes)
    short = chunks.select(F.explode(F.arrays_zip("low", "low_n")).alias("z")).groupBy("z.low").agg(F.sum("z.low_n").alias("n")).toArrow()
    low = spark.sparkContext.broadcast(levels(short.column(0).to_numpy(), short.column(1).to_numpy(), min(_TAIL, order) - 1))
    asked = chunks.select("chunk", "train", "lens", "words", "text").mapInArrow(_asker(order, parts, chunk_bytes // 4), _ASKED)
    told = asked.groupBy("kind", "bucket").applyInArrow(_teller(low, order), _TOLD)
    scored = chunks.drop("low", "low_n").groupBy("chunk").cogroup(told.groupBy("of")).applyInArrow(_scorer(order, parts, chunk_bytes // 4, ends), _SCORED)
    scored = ws.save(scored, "scored")
    ws.drop("chunks")
    v = scored.where("train is null").agg(F.coalesce(F.sum("n_known"), F.lit(0))).first()[0] + (ends > 0)
    base = F.col("base") - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))
    return scored.where("train is not null").select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")

