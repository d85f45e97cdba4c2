"""Filter interaction audit: what five filters remove in every order, from one pass of flags and additive mask counts."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.llm.packing import dealt, loosen, squeeze
from tesserae.llm.shingles import mix
from tesserae.plans.workspace import Workspace, small_side

FILTERS = "ABCDE"
_BIT = {f: 1 << i for i, f in enumerate(FILTERS)}
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SIGNS = re.compile(rb"[#$%&*|]")


def text_mask(text: bytes, chars: int) -> int:
    """Bits of the filters A to D that a text of ``chars`` code points fails."""
    words = text.split()
    n = len(words)
    fails = n < 200, 100 * len(set(words)) < 50 * n, 100 * (len(text) - len(text.translate(None, _UPPER))) > 2 * chars, _SIGNS.search(text) is not None
    return sum(_BIT[f] for f, x in zip("ABCD", fails, strict=True) if x)


def _flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        text = b.column("text")
        mask = [text_mask(t.as_py(), n) for t, n in zip(text.cast(pa.binary()), pc.utf8_length(text).to_pylist(), strict=True)]
        yield pa.record_batch([b.column("doc_id"), b.column("part"), pa.array(mask, pa.int32()), b.column("h")], ["doc_id", "part", "mask", "h"])


class CountingBloom:
    """A counting Bloom filter cut into shards: all cells of a hash lie in one shard, one in each stripe of it.

    Counters stop at 2, which is all that is asked of them. A hash with a counter below 2 was added once at most.
    """

    def __init__(self, rows: int, cells: int = 16, stripes: int = 3):
        self.shards = max(1, math.isqrt(rows))
        self.width = max(8, -(-rows * cells // (self.shards * stripes)))
        self.stripes = stripes

    def shard(self, h: np.ndarray) -> np.ndarray:
        return (mix(h) >> np.uint64(20)).astype(np.int64) % self.shards

    def cells(self, h: np.ndarray) -> np.ndarray:
        """(stripes, hashes): a cell of each stripe."""
        at = [(mix(h + np.uint64(0x9E37 * (i + 1))) >> np.uint64(20)).astype(np.int64) % self.width + i * self.width for i in range(self.stripes)]
        return np.stack(at)

    def part(self, h: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Partial sketch of one shard: rows (cell, count up to 2)."""
        cell, where = np.unique(self.cells(h), return_inverse=True)
        count = np.bincount(where.ravel(), np.tile(times, self.stripes)).astype(np.int64)
        return np.stack([cell, np.minimum(count, 2)]).astype(np.uint32)

    def merged(self, parts: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(self.stripes * self.width, np.uint8)
        for cell, count in parts:
            out[cell] = np.minimum(out[cell] + count, 2)
        return out

    def repeats(self, sketch: np.ndarray, h: np.ndarray) -> np.ndarray:
        return sketch[self.cells(h)].min(0) > 1


def possible_repeats(rows: DataFrame, n: int, held: int = 1 << 20) -> DataFrame:
    """``h`` of ``rows(h long)``, each once, less those that the sketch of all ``n`` rows knows to occur once.

    Tasks sketch their rows, at most ``held`` at a time, shard by shard, so a hash of many rows leaves a task once. A shard
    gets partial sketches, merges them, and tests the hashes that lie in it; shards and their size both grow with the root
    of ``n``. Nothing passes the driver.
    """
    bloom = CountingBloom(n)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        some: list[np.ndarray] = []

        def flush():
            h, times = np.unique(np.concatenate(some), return_counts=True)
            for s, at in dealt(bloom.shard(h)):
                yield s, h[at], np.minimum(times[at], 2)

        for b in batches:
            some.append(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            if sum(map(len, some)) >= held:
                yield from flush()
                some = []
        if some:
            yield from flush()

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, h, times in pieces(batches):
            yield pa.record_batch([pa.array([s], pa.int64()), pa.array([squeeze(bloom.part(h, times).tobytes())], pa.binary())], ["shard", "part"])

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, h, _ in pieces(batches):
            yield pa.record_batch([pa.array([s], pa.int64()), pa.array([h.tobytes()], pa.binary())], ["shard", "hashes"])

    def tell(parts: pa.Table, hashes: pa.Table) -> pa.Table:
        sketch = bloom.merged([np.frombuffer(loosen(x.as_py()), np.uint32).reshape(2, -1) for x in parts.column("part")])
        h = np.unique(np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in hashes.column("hashes")]))
        return pa.table([pa.array(h[bloom.repeats(sketch, h)].view(np.int64), pa.int64())], ["h"])

    parts, asked = rows.mapInArrow(sketches, "shard long, part binary"), rows.mapInArrow(lists, "shard long, hashes binary")
    return parts.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(tell, "h long")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order of the five filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``docs(doc_id, text, source)`` are read whole: once for flags and hashes, once for the texts that may repeat. A null text is
    empty, a null source the part ''. A document of null doc_id neither fails E nor makes another fail; equal rows of one
    doc_id are counted each and do not fail E by one another. A doc_id is good or toxic if any of its label rows says so. Other
    columns are ignored; no documents give no rows.
    """
    ws = Workspace(docs.sparkSession, "audit")
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    lab = labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    lab = lab.agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"))
    rows = d.withColumn("h", F.xxhash64("text")).mapInArrow(_flagged, "doc_id long, part string, mask int, h long")
    rows = rows.join(small_side(ws.save(lab, "labels"), 32), "doc_id", "left")
    rows = ws.save(rows.select("doc_id", "part", "mask", "h", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")), "rows")

    again = small_side(ws.save(possible_repeats(rows.select("h"), rows.count()), "again"), 32)
    some = d.withColumn("h", F.xxhash64("text")).where("doc_id is not null").join(again, "h", "left_semi")
    first = some.groupBy("text").agg(F.min("doc_id").alias("doc_id")).select("doc_id", F.xxhash64("text").alias("h"))
    first = small_side(ws.save(first, "first"), 32)
    late = rows.where("doc_id is not null").join(again, "h", "left_semi").join(first, ["doc_id", "h"], "left_anti")

    def counted(df: DataFrame) -> DataFrame:
        return df.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))

    late = ws.save(counted(late), "late")
    less = late.select("part", "mask", *((-F.col(c)).alias(c) for c in ("n", "good", "toxic")))
    more = late.withColumn("mask", F.col("mask").bitwiseOR(_BIT["E"]))
    masks = counted(rows).unionByName(less).unionByName(more).groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))
    return _orders(masks)


def _orders(masks: DataFrame) -> DataFrame:
    """All orders and steps from ``masks(part, mask, n, good, toxic)``: at most 32 masks a part, so a part is one row."""
    parts = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("m"))
    steps = parts.withColumn("filter_order", F.explode(F.array(*(F.lit("".join(o)) for o in permutations(FILTERS)))))
    steps = steps.withColumn("step", F.explode(F.array(*(F.lit(i) for i in range(1, 6)))))
    place = {f: F.instr("filter_order", f) for f in FILTERS}
    own = sum((F.when(place[f] == F.col("step"), b).otherwise(0) for f, b in _BIT.items()), F.lit(0))
    prior = sum((F.when(place[f] < F.col("step"), b).otherwise(0) for f, b in _BIT.items()), F.lit(0))
    steps = steps.withColumns({"own": own, "prior": prior})

    def total(value, when) -> Column:
        return F.aggregate("m", F.lit(0).cast("long"), lambda s, x: s + F.when(when(x["mask"]), value(x)).otherwise(0).cast("long"))

    def fails(m: Column) -> Column:
        return m.bitwiseAND(F.col("own")) != 0

    def gone(m: Column) -> Column:
        return m.bitwiseAND(F.col("prior")) != 0

    return steps.select(
        "part", "filter_order", "step",
        total(lambda x: x["n"], lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        total(lambda x: x["n"], lambda m: fails(m) & ~gone(m)).alias("removed"),
        total(lambda x: x["n"], lambda m: fails(m) & gone(m)).alias("redundant"),
        total(lambda x: x["n"], lambda m: m == F.col("own")).alias("unique_fails"),
        total(lambda x: x["good"], lambda m: fails(m) & ~gone(m)).alias("good_lost"),
        total(lambda x: x["toxic"], lambda m: fails(m) & ~gone(m)).alias("toxic_lost"),
        # of the 120 orders, each filter that a document fails is the first of those in an equal share
        total(lambda x: x["n"] * 120 / F.bit_count(x["mask"]), fails).alias("shapley"),
    )
