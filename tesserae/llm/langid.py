"""Language identification: known words first, shorter and shorter character n-grams for the rest."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.packing import dealt, loosen, planes, squeeze, whole
from tesserae.plans.workspace import Workspace

_WORD = re.compile(r"[^\W\d_]+")
_ORDERS = (4, 3, 2, 1)


def words(text: str | None) -> list[str]:
    """Lower-cased runs of letters; empty if there is no letter."""
    found = _WORD.findall((text or "").lower())
    return found if any(map(str.isalpha, found)) or any(c.isalpha() for w in found for c in w) else []


def _pieces(word: str, n: int) -> list[str]:
    w = f" {word} "
    return [w[i : i + n] for i in range(len(w) - n + 1)] or [w]


def _batch(held: Counter, kinds: list) -> pa.RecordBatch:
    """A counter of tuples as rows, the count last; the counter is emptied."""
    cols = [*zip(*held, strict=True)] or [()] * (len(kinds) - 1)
    out = pa.record_batch([pa.array(c, k) for c, k in zip((*cols, list(held.values())), kinds, strict=True)], [str(i) for i in range(len(kinds))])
    held.clear()
    return out


def count_languages(docs: DataFrame, most: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """Counts of labelled ``docs(text, lang)``: words (gram, lang, n), and n-grams of their letters (kind, gram, lang, n).

    Tasks count up to ``most`` different entries before these are shuffled; n-grams are counted over the summed words,
    not over the texts again.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, by = [pa.string(), pa.string(), pa.int64()], {}
        pairs = lambda: Counter({(w, x): n for x, c in by.items() for w, n in c.items()})
        for b in batches:
            for t, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                by.setdefault(lang, Counter()).update(words(t))
                if sum(map(len, by.values())) >= most:
                    yield _batch(pairs(), kinds)
                    by.clear()
        yield _batch(pairs(), kinds)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, held = [pa.int32(), pa.string(), pa.string(), pa.int64()], Counter()
        for b in batches:
            for w, lang, n in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                for k in _ORDERS:
                    for g in _pieces(w, k):
                        held[k, g, lang] += n
                if len(held) >= most:
                    yield _batch(held, kinds)
        yield _batch(held, kinds)

    ws = Workspace(docs.sparkSession, "langid-words")
    counted = docs.where("lang is not null").select("text", "lang").mapInArrow(count, "gram string, lang string, n long")
    counted = ws.save(counted.groupBy("gram", "lang").agg(F.sum("n").alias("n")), "words")
    return counted, counted.mapInArrow(split, "kind int, gram string, lang string, n long").groupBy("kind", "gram", "lang").agg(F.sum("n").alias("n"))


def _floors(langs: list[str], totals: dict, sizes: dict) -> np.ndarray:
    """Log frequency (add-half over the learned entries) of an entry never met, by kind and language."""
    return np.array([[np.log(0.5 / (totals.get((k, x), 0) + 0.5 * sizes.get(k, 0) or 1)) for x in langs] for k in range(5)]).reshape(5, len(langs))


class Languages:
    """A fitted model: tables of all words (gram, lang, n) and n-grams (kind, gram, z of lang and n), and the most frequent
    words, and the n-grams if they are few enough, beside them.

    Frequencies are add-half over all entries of a kind, so an entry that a language never had counts by what its
    text was worth: log((n + 1/2) / (total + entries / 2)), as ``floor`` plus log(2 n + 1).
    """

    def __init__(self, words_: DataFrame, grams: DataFrame, n_words: int, langs: list[str], floor: np.ndarray, common: tuple, near: list[tuple] | None):
        self.words, self.grams, self.n_words, self.langs, self.floor, self.common, self.near = words_, grams, n_words, langs, floor, common, near


def _listed(rows: pa.Table, langs: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """Entries (gram, z) as a dictionary and the gains log(2 n + 1) of each in each language."""
    gain = np.zeros((rows.num_rows, len(langs)))
    z = rows.column("z").combine_chunks()
    if rows.num_rows:
        of = np.repeat(np.arange(rows.num_rows), np.diff(z.offsets.to_numpy()))
        lang = pa.compute.index_in(z.flatten().field("lang"), pa.array(langs, pa.string())).to_numpy()
        gain[of, lang] = np.log(2 * z.flatten().field("n").to_numpy() + 1)
    return {g: i for i, g in enumerate(rows.column("gram").to_pylist())}, gain


def fit_languages(docs: DataFrame, cells: int = 1 << 18, near_cells: int = 1 << 21) -> Languages:
    """Count all of ``docs(text, lang)``; every word and n-gram met is kept, in a table.

    As shortcuts that change no result, the most frequent words (``cells`` / languages of them, so a fixed size) are also
    gathered, and all n-grams if n-grams x languages are at most ``near_cells``; else words look theirs up by joins.
    Labels are taken to be few enough to list. Rows with a null lang or text teach nothing.
    """
    ws = Workspace(docs.sparkSession, "langid")
    both, counted = count_languages(docs)
    grams = ws.save(counted.groupBy("kind", "gram").agg(F.collect_list(F.struct("lang", "n")).alias("z")), "grams")
    each = both.groupBy(F.lit(0).alias("kind"), "lang").agg(F.sum("n").alias("n")).unionByName(grams.select("kind", F.explode("z").alias("z")).groupBy("kind", "z.lang").agg(F.sum("z.n").alias("n")))
    totals = {(r["kind"], r["lang"]): r["n"] for r in each.collect()}
    langs = sorted({lang for _, lang in totals})
    width = max(len(langs), 1)
    ranked = both.groupBy("gram").agg(F.sum("n").alias("times"), F.collect_list(F.struct("lang", "n")).alias("z"))
    sizes = {r["kind"]: r["count"] for r in grams.groupBy("kind").count().collect()} | {0: both.agg(F.count_distinct("gram")).first()[0]}
    common = _listed(ranked.orderBy(F.desc("times"), "gram").limit(max(1, cells // width)).select("gram", "z").toArrow(), langs)
    near = None
    if sum(sizes.values()) - sizes[0] <= near_cells // width:
        near = [_listed(grams.where(F.col("kind") == k).select("gram", "z").toArrow(), langs) for k in _ORDERS]
    ws.release()
    return Languages(both, grams, sizes[0], langs, _floors(langs, totals, sizes), common, near)


_CHUNK = {
    "chunk": pa.int64(),
    "docs": pa.list_(pa.int64()),
    "n": pa.list_(pa.int64()),
    "part": pa.list_(pa.float64()),
    "cells": pa.list_(pa.int32()),
    "word": pa.binary(),
    "times": pa.binary(),
    "asked": pa.list_(pa.struct({"bucket": pa.int32(), "m": pa.int32(), "words": pa.binary()})),
}
_CHUNKS = "chunk long, docs array<long>, n array<long>, part array<double>, cells array<int>, word binary, times binary, asked array<struct<bucket:int,m:int,words:binary>>"
_ANSWERS = "bucket int, of long, m int, value binary"


def _packer(shared, parts: int, chunk_chars: int):
    """Chunks: documents with the sums of their frequent words, a sparse matrix of the other words, and these by bucket."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq = TaskContext.get().partitionId(), 0
        (common, gain), floor = shared.value
        gain = gain + floor[0]

        def row(docs, n, part, place, cells, word, times) -> pa.RecordBatch:
            vocab, asked, spot = list(place), [], np.zeros(len(place), np.int64)
            for i, r in dealt(np.fromiter((zlib.crc32(w.encode()) % parts for w in vocab), np.int64, len(vocab))):
                spot[r] = sum(a["m"] for a in asked) + np.arange(len(r))  # words are told by bucket, so they are numbered by bucket
                asked.append({"bucket": i, "m": len(r), "words": squeeze(" ".join([vocab[x] for x in r]).encode())})
            got = ((task << 32) + seq, docs, n, np.concatenate(part), cells, planes(spot[np.concatenate(word)], 4), planes(np.concatenate(times), 4), asked)
            return pa.record_batch([pa.array([x], k) for x, k in zip(got, _CHUNK.values(), strict=True)], list(_CHUNK))

        held, size = ([], [], [], {}, [], [], []), 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                docs, n, part, place, cells, word, times = held
                text = t.as_py()
                ws = words(text)
                at = np.fromiter(map(common.get, ws, repeat(-1)), np.int64, len(ws))
                rest = Counter([ws[x] for x in np.nonzero(at < 0)[0]])
                docs.append(i)
                n.append(len(ws))
                part.append(gain[at[at >= 0]].sum(0))
                cells.append(len(rest))
                word.append(np.array([place.setdefault(w, len(place)) for w in rest], np.int64))
                times.append(np.array(list(rest.values()), np.int64))
                size += len(text or "")
                if size >= chunk_chars:
                    yield row(*held)
                    held, size, seq = ([], [], [], {}, [], [], []), 0, seq + 1
        if held[0]:
            yield row(*held)

    return pack


def _unseen(ws: Workspace, left: DataFrame, grams: DataFrame) -> list[DataFrame]:
    """(word, kind, hits, lang, n) of unseen words: the longest n-grams of which any is known, order by order."""
    out = []
    for k in _ORDERS:

        def split(batches: Iterator[pa.RecordBatch], k: int = k) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = [(w, g) for w in b.column(0).to_pylist() for g in _pieces(w, k)]
                yield pa.record_batch([pa.array([r[i] for r in rows], pa.string()) for i in range(2)], ["word", "gram"])

        pieces = left.mapInArrow(split, "word string, gram string")
        met = pieces.join(grams.where(F.col("kind") == k).select("gram", "z"), "gram").groupBy("word").agg(F.count("*").alias("hits"), F.flatten(F.collect_list("z")).alias("z"))
        met = ws.save(met.select("word", F.lit(k).alias("kind"), "hits", "z"), f"met{k}")
        out.append(met.select("word", "kind", "hits", F.explode("z").alias("e")).select("word", "kind", "hits", "e.lang", "e.n"))
        if k > _ORDERS[-1]:
            left = ws.save(left.join(met.select("word"), "word", "left_anti"), f"left{k}")
    return out


def _answer(shared, langs: list[str]):
    """A bucket's learned words (and, looked up before, n-grams of unseen ones) as vectors for the words of all chunks."""

    def run(asked: pa.Table, learned: pa.Table) -> pa.Table:
        (near, floor), width = shared.value, len(langs)
        col = {x: i for i, x in enumerate(langs)}
        place: dict[str, int] = {}
        vec: list[np.ndarray] = []

        def unseen(word: str) -> np.ndarray:
            for k, (known, gain) in zip(_ORDERS, near or (), strict=False):
                if hits := [i for g in _pieces(word, k) if (i := known.get(g)) is not None]:
                    return gain[hits].mean(0) + floor[k]
            return np.zeros(width)

        if asked.num_rows:
            for w, kind, hits, lang, n in zip(*(learned.column(c).to_pylist() for c in ("word", "kind", "hits", "lang", "n")), strict=True):
                i = place.setdefault(w, len(place))
                if i == len(vec):
                    vec.append(floor[kind].copy())
                vec[i][col[lang]] += math.log(2 * n + 1) / hits
        out, rows = [], asked.select(["bucket", "chunk", "m", "words"]).to_pylist()
        at = []
        for r in rows:
            ws = loosen(r["words"]).decode().split(" ")
            at.append(np.fromiter((place.setdefault(w, len(place)) for w in ws), np.int64, len(ws)))
        vec += [unseen(w) for w in islice(place, len(vec), None)]
        table = np.array(vec, np.float32).reshape(-1, width)
        for r, x in zip(rows, at, strict=True):
            out.append((r["bucket"], r["chunk"], r["m"], planes(np.ascontiguousarray(table[x].T).view(np.uint32).ravel(), 4)))
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary())
        cols = list(zip(*out, strict=True)) or [()] * 4
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["bucket", "of", "m", "value"])

    return run


def _predict(langs: list[str]):
    """Predictions of a chunk: its frequent words' sums and those of the other words that were looked up."""

    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        c, width = chunk.to_pylist()[0], len(langs)
        m, cells = len(c["docs"]), np.array(c["cells"])
        word, times = (whole(c[x], int(cells.sum()), 4) for x in ("word", "times"))
        doc, total = np.repeat(np.arange(m), cells), np.array(c["part"]).reshape(m, width)
        told = [(r["m"], whole(r["value"], r["m"] * width, 4).astype(np.uint32).view(np.float32)) for r in answers.sort_by("bucket").to_pylist()]
        for j in range(width):  # one language at a time
            vec = np.concatenate([np.zeros(0), *(x[j * k : (j + 1) * k] for k, x in told)])
            total[:, j] += np.bincount(doc, vec[word] * times, minlength=m)
        best = total.argmax(1)
        sure = 1 / np.exp(total - total[np.arange(m), best][:, None]).sum(1)
        some = np.array(c["n"]) > 0
        return pa.table({"doc_id": pa.array(c["docs"], pa.int64()), "lang_pred": pa.array(np.where(some, np.array(langs)[best], "und").tolist(), pa.string()), "score": pa.array(np.where(some, sure, 0.0))})

    return run


def identify(docs: DataFrame, model: Languages, chunk_chars: int = 2 << 20, bucket_words: int = 20_000, slice_words: int = 1 << 20) -> DataFrame:
    """(doc_id, lang_pred, score) for each row of ``docs(doc_id, text)``; score is the posterior of the prediction.

    A chunk of documents asks for its distinct words, dealt by a hash over buckets of about ``bucket_words`` learned
    words, and gets their vectors (32-bit floats). Chunks are dealt over slices, as many as leave a bucket about ``slice_words``
    words asked in a slice, and each slice has a copy of the buckets: a task's group follows neither the chunks nor the
    words of the whole corpus. An unseen word counts as the mean of its longest n-grams of which any
    is known, and nothing where none is.

    Null text or no letter: ``und``, score 0; so is all without learned languages. Ties go to the language that sorts
    first. Repeated rows are predicted one by one, other columns ignored.
    """
    spark = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not model.langs:
        return src.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    ws = Workspace(spark, "langid")
    parts = max(8, model.n_words // bucket_words)
    chunks = ws.save(src.mapInArrow(_packer(spark.sparkContext.broadcast((model.common, model.floor)), parts, chunk_chars), _CHUNKS), "chunks")
    total = chunks.agg(F.sum(F.aggregate("asked.m", F.lit(0).cast("long"), lambda n, m: n + m))).first()[0] or 0
    slices = max(1, -(-total // (parts * slice_words)))
    asked = chunks.select("chunk", F.pmod(F.xxhash64("chunk"), F.lit(slices)).cast("int").alias("slice"), F.explode("asked").alias("a")).select("chunk", "slice", "a.*")
    learned = model.words.select(F.col("gram").alias("word"), F.lit(0).alias("kind"), F.lit(1).cast("long").alias("hits"), "lang", "n")
    if model.near is None:
        every = asked.select("words").mapInArrow(_spelled, "word string").distinct()
        for more in _unseen(ws, ws.save(every.join(learned.select("word"), "word", "left_anti"), "unseen"), model.grams):
            learned = learned.unionByName(more)
    learned = learned.withColumns({"part": (F.crc32("word") % parts).cast("int"), "copy": F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))})
    answers = asked.groupBy("bucket", "slice").cogroup(learned.groupBy("part", "copy")).applyInArrow(_answer(spark.sparkContext.broadcast((model.near, model.floor)), model.langs), _ANSWERS)
    return chunks.drop("asked").groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(_predict(model.langs), "doc_id long, lang_pred string, score double")


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for x in b.column(0).to_pylist():
            yield pa.record_batch([pa.array(loosen(x).decode().split(" "), pa.string())], ["word"])
