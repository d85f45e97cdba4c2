"""Benchmark decontamination by winnowed word fingerprints, their join, and extension of the hits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.shingles import grams, word_hashes
from tesserae.plans.workspace import Workspace, fits_broadcast

#: Bytes of words stay (0-9, a-z, all of non-ASCII), A-Z become a-z, all others part words.
_FOLD = bytes(b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    return [] if text is None else text.translate(_FOLD).split()


def winnow(h: np.ndarray, k: int, t: int) -> np.ndarray:
    """Distinct fingerprints of a word-hash sequence: the least k-gram hash of each run of ``t - k + 1`` k-grams.

    Two sequences that share a run of ``t`` words share its k-grams, so the least of them, so a fingerprint.
    """
    if len(h) < t:
        return h[:0]
    return np.unique(np.lib.stride_tricks.sliding_window_view(grams(h, k), t - k + 1).min(1))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _item_prints(items: DataFrame, k: int, t: int) -> DataFrame:
    """(item_id, n_words, keys, windows): fingerprints (of items shorter than ``t``, the whole run) and window hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = [word_hashes(words(x)) for x in b.column(1).to_pylist()]
            keys = [_signed(winnow(x, k, t) if len(x) >= t else grams(x, len(x))) for x in h]
            windows = [np.unique(_signed(grams(x, min(t, len(x))))) for x in h]
            listed = pa.list_(pa.int64())
            yield pa.record_batch([b.column(0), pa.array(list(map(len, h)), pa.int64()), pa.array(keys, listed), pa.array(windows, listed)], ["item_id", "n_words", "keys", "windows"])

    return items.mapInArrow(run, "item_id long, n_words long, keys array<long>, windows array<long>")


def _known(x: np.ndarray, among) -> np.ndarray:
    """Which of x are in a sorted broadcast array; all where there is none to look in."""
    if among is None:
        return np.ones(len(x), bool)
    a = among.value
    return a[np.minimum(np.searchsorted(a, x), len(a) - 1)] == x if len(a) else np.zeros(len(x), bool)


def _doc_prints(docs: DataFrame, k: int, t: int, short: list[int], among) -> DataFrame:
    """(id, doc_id, n_words, keys, text): fingerprints that are among the items', and the text if there are any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        for b in batches:
            n, keys = [], []
            for text in b.column(1):
                h = word_hashes(words(text.as_py()))
                n.append(len(h))
                got = _signed(np.concatenate([winnow(h, k, t), *(np.unique(grams(h, m)) for m in short if m <= len(h))]))
                keys.append(got[_known(got, among)])
            text = pa.array([x if len(y) else None for x, y in zip(b.column(1), keys, strict=True)], pa.binary())
            yield pa.record_batch([pa.array(np.arange(at, at + len(n))), b.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.list_(pa.int64())), text], ["id", "doc_id", "n_words", "keys", "text"])
            at += len(n)

    return docs.mapInArrow(run, "id long, doc_id long, n_words long, keys array<long>, text binary")


def _hits(texts: DataFrame, t: int, short: list[int], among) -> DataFrame:
    """(id, at, m, win) of every window of ``t`` words, and of the lengths of short items, that is among the items'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                h = word_hashes(words(text.as_py()))
                for m in (*short, t):
                    if m <= len(h):
                        win = _signed(grams(h, m))
                        at = np.nonzero(_known(win, among))[0]
                        yield pa.record_batch([pa.array(np.full(len(at), i)), pa.array(at), pa.array(np.full(len(at), m)), pa.array(win[at])], ["id", "at", "m", "win"])

    return texts.mapInArrow(run, "id long, at long, m long, win long")


def contamination(docs: DataFrame, items: DataFrame, t: int = 10, k: int = 5, held: int = 4 << 20) -> DataFrame:
    """Words of ``docs(doc_id, text)`` inside windows of ``t`` consecutive words of ``items(item_id, text)``.

    An item of fewer than ``t`` words, but not none, is one window. Returns a row for each document row: doc_id,
    n_words, n_hit (words inside any occurring window), n_items (items with an occurring window), items_sha256 (of
    their ids, sorted as strings and comma-joined), contaminated (n_hit > 0).

    Both tables are fingerprinted by winnowing (k-grams, windows of ``t - k + 1``), which meets every shared run of
    ``t`` words; items shorter than ``t`` give the hash of their whole run. Documents that share a fingerprint with an
    item are extended: their windows are joined to the items' distinct windows, and the ids of items follow by window, so
    a passage of many items is matched once. Up to ``held`` fingerprints, and windows, of items are counted and looked up
    inside the tasks, so that no other leaves them; beyond that both joins are shuffled. Words, fingerprints and windows are
    compared by 64-bit hashes.

    Null or wordless texts have no words and no hits. Items without id or words are ignored; repeated items count
    once. Repeated documents are returned one by one. Other columns are ignored. Empty tables are fine.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "winnow")
    items = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text")).distinct()
    prints = ws.save(_item_prints(items, k, t).where("n_words > 0"), "items")
    short = sorted(r[0] for r in prints.where(f"n_words < {t}").select("n_words").distinct().collect())
    owners = ws.save(prints.select("item_id", F.explode("windows").alias("win")).distinct(), "owners")

    def lookup(keys: DataFrame):
        """The distinct keys as a sorted broadcast array, if they are few."""
        n = keys.count()
        return spark.sparkContext.broadcast(np.sort(keys.toArrow().column(0).to_numpy())) if n <= held and fits_broadcast(n, 8) else None

    keys = prints.select(F.explode("keys").alias("key")).distinct()
    wins = owners.select("win").distinct()
    among, among_wins = lookup(keys), lookup(wins)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    rows = ws.save(_doc_prints(src, k, t, short, among), "prints")
    near = rows.where("size(keys) > 0")
    if among is None:
        ids = rows.select("id", F.explode("keys").alias("key")).join(keys, "key", "left_semi").select("id").distinct()
        near = near.join(ids, "id", "left_semi")
    hits = _hits(near.select("id", "text"), t, short, among_wins)
    hits = ws.save(hits if among_wins else hits.join(wins, "win", "left_semi"), "hits")
    # words covered by windows that may overlap: ends are met in order
    ends = F.array_sort(F.collect_list(F.struct("at", (F.col("at") + F.col("m")).alias("end"))))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    cover = F.aggregate(ends, zero, lambda a, w: F.struct((a["n"] + F.greatest(w["end"] - F.greatest(w["at"], a["upto"]), F.lit(0))).alias("n"), F.greatest(a["upto"], w["end"]).alias("upto")))["n"]
    covered = hits.groupBy("id").agg(cover.alias("n_hit"))
    owned = hits.select("id", "win").distinct().join(owners, "win").select("id", F.col("item_id").cast("string").alias("item")).distinct()
    owned = owned.groupBy("id").agg(F.count("*").alias("n_items"), F.sha2(F.array_join(F.sort_array(F.collect_list("item")), ","), 256).alias("items_sha256"))
    found = ws.save(covered.join(owned, "id"), "found")
    out = rows.select("id", "doc_id", "n_words").join(found, "id", "left")
    none = F.sha2(F.lit("").cast("binary"), 256)
    return out.select("doc_id", "n_words", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_hit", "n_items")), F.coalesce("items_sha256", none).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))
