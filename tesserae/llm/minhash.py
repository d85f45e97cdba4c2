"""MinHash near-duplicate detection: minima, banding, signature verification, exact confirmation, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tesserae.operators.components import connected_components
from tesserae.llm.shingles import MinHash, shingle_set
from tesserae.plans.workspace import Workspace, small_side


def _linked(inter, na, nb, num: int, den: int):
    return den * inter >= num * (na + nb - inter)


def _signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mh = MinHash(bands, rows)
        for b in batches:
            out = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                s = shingle_set(t, n)
                if not len(s):
                    out.append((i, 0, None, None))
                    continue
                out.append((i, len(s), xxhash.xxh3_128_digest(s.tobytes()), mh.signature(s).tobytes()))
            cols = list(zip(*out, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "n_shingles", "set_key", "sig"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("t")).mapInArrow(run, "doc_id long, n_shingles long, set_key binary, sig binary")


def _sets(docs: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [shingle_set(t, n).tobytes() for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(s, pa.binary())], ["doc", "sh"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("t")).mapInArrow(run, "doc long, sh binary")


@F.pandas_udf(DoubleType())
def _agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of equal minima."""
    return pd.Series([float(np.mean(np.frombuffer(x, np.uint32) == np.frombuffer(y, np.uint32))) for x, y in zip(a, b, strict=True)], dtype=float)


def _incidence(sets: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Dense 0/1 columns, some at a time, of the shingles that two or more of the sets hold."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, inv, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = df[inv] > 1
    rows, col = rows[keep], (np.cumsum(df > 1) - 1)[inv[keep]]
    order = np.argsort(col, kind="stable")
    rows, col = rows[order], col[order]
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, 1024):
        a, b = np.searchsorted(col, [lo, lo + 1024])
        m = np.zeros((len(sets), 1024), np.float32)
        m[rows[a:b], col[a:b] - lo] = 1
        yield m


def _forest(num: int, den: int):
    """For a block: exact links between rows of side 0 and rows of either side, as a spanning forest over components."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("doc").sort_values(["side", "doc"], ignore_index=True)
        sets = [np.frombuffer(x, np.uint64) for x in pdf["sh"]]
        left = int((pdf["side"] == 0).sum())
        size = np.array([len(s) for s in sets])
        inter = np.zeros((left, len(sets)), np.int32)
        for m in _incidence(sets):
            inter += (m[:left] @ m.T).astype(np.int32)
        comp, out = pdf["comp"].to_numpy(), []
        root = comp.copy()
        for i in range(left):
            others, at = np.unique(root[near := np.nonzero(_linked(inter[i].astype(np.int64), size[i], size, num, den))[0]], return_index=True)
            new = others != root[i]
            out += [(comp[i], comp[j]) for j in near[at[new]]]
            if new.any():
                root[np.isin(root, others[new])] = root[i]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def _blocks(weight: str, cap: int):
    return F.greatest(F.lit(1), F.ceil(F.col(weight) / cap)).cast("int")


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, bands: int = 32, rows: int = 4, cap: int = 32768) -> DataFrame:
    """Near-duplicate classes of ``docs(doc_id, text)`` on distinct word ``n``-shingles.

    Two documents are linked if ``den * |A & B| >= num * |A | B|``; the class is the connected component.
    Returns a row for each input row: doc_id, n_shingles, component_id (least doc_id reachable), kept (doc_id is it).

    1. Equal sets collapse to their least doc_id before anything is paired, so exact copies cost one row.
    2. ``bands * rows`` minima; with the defaults two sets at 0.85 share no band once in 2e10, at 0.8 once in 2e7.
    3. A bucket proposes only its star: (least document, other). Stars whose signatures agree less than six standard
       deviations below the threshold are put off; the rest is confirmed on full sets, and components follow.
    4. Families (documents that share a star centre) which still span several components are compared exactly in
       blocks of about ``cap`` shingles, documents outside the centre's component against all; a block returns a
       spanning forest, never its pairs. So a bucket of any size loses no link and meets in no single task.

    Null or wordless text: n_shingles 0, linked with nothing. A null doc_id is never linked; its component_id is null
    and kept is true. Rows that repeat a doc_id are returned one by one, each in the class of its own text.
    Other columns of ``docs`` are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "minhash")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sigs = ws.save(_signatures(docs, n, bands, rows), "sigs")
    whole = sigs.where("n_shingles > 0 and doc_id is not null")
    reps = ws.save(whole.groupBy("set_key").agg(F.min(F.struct("doc_id", "n_shingles", "sig")).alias("r")).select("set_key", F.col("r.doc_id").alias("doc"), "r.n_shingles", "r.sig"), "reps")
    rows_in = ws.save(sigs.select("doc_id", "n_shingles", "set_key"), "rows")
    ws.drop("sigs")

    band = [F.xxhash64(F.expr(f"substring(sig, {4 * rows * i + 1}, {4 * rows})"), F.lit(i)) for i in range(bands)]
    keyed = reps.select(F.explode(F.array(*band)).alias("key"), "doc")
    stars = ws.save(keyed.groupBy("key").agg(F.min("doc").alias("centre"), F.count("*").alias("m")).where("m > 1").drop("m"), "stars")
    family = ws.save(keyed.join(stars, "key").where("doc <> centre").select("centre", "doc").distinct(), "family")
    used = ws.save(family.select("doc").union(family.select(F.col("centre").alias("doc"))).distinct(), "used")
    sizes = ws.save(used.join(reps.select("doc", "n_shingles", "sig"), "doc"), "sizes")
    sets = ws.save(_sets(docs.join(small_side(used.withColumnRenamed("doc", "doc_id"), 16), "doc_id", "left_semi"), n).dropDuplicates(["doc"]), "sets")

    # stars: signature verification, then full sets, members of a centre dealt over blocks
    t = num / den
    floor = t - 6 * (t * (1 - t) / (bands * rows)) ** 0.5
    near = family.join(sizes, "doc").join(sizes.select(F.col("doc").alias("centre"), F.col("sig").alias("sig_c"), F.col("n_shingles").alias("n_c")), "centre")
    near = ws.save(near.where(f"{den} * least(n_shingles, n_c) >= {num} * greatest(n_shingles, n_c)").where(_agreement("sig", "sig_c") >= floor).select("centre", "doc", "n_shingles"), "near")
    weight = ws.save(near.groupBy("centre").agg(F.sum("n_shingles").alias("w")), "near-w")
    member = near.join(weight, "centre").select("centre", F.pmod(F.xxhash64("doc"), _blocks("w", cap)).cast("int").alias("i"), "doc", F.lit(1).alias("side"))
    centre = weight.select("centre", F.explode(F.sequence(F.lit(0), _blocks("w", cap) - 1)).alias("i"), F.col("centre").alias("doc"), F.lit(0).alias("side"))
    work = ws.save(member.unionByName(centre).withColumn("j", F.lit(0)).withColumn("comp", F.col("doc")), "star-work")
    edges = ws.save(work.join(sets, "doc").groupBy("centre", "i", "j").applyInPandas(_forest(num, den), "a long, b long"), "star-edges")
    comp = ws.save(_labels(used, connected_components(ws, edges, "stars")), "comp")

    ws.release()
    # families that still span components: blocks outside the centre's component against all blocks
    fam = family.union(family.select("centre", F.col("centre").alias("doc")).distinct())
    fam = fam.join(comp, "doc").join(comp.select(F.col("doc").alias("centre"), F.col("comp").alias("comp_c")), "centre")
    fam = ws.save(fam.join(sizes.select("doc", "n_shingles"), "doc").withColumn("minor", (F.col("comp") != F.col("comp_c")).cast("int")), "fam")
    open_ = fam.groupBy("centre").agg(F.sum(F.col("n_shingles") * F.col("minor")).alias("w1"), F.sum(F.col("n_shingles") * (1 - F.col("minor"))).alias("w0")).where("w1 > 0")
    open_ = ws.save(open_.select("centre", _blocks("w1", cap).alias("n1"), _blocks("w0", cap).alias("n0")), "open")
    dealt = fam.join(open_, "centre").withColumn("k", F.pmod(F.xxhash64("doc"), F.when(F.col("minor") == 1, F.col("n1")).otherwise(F.col("n0"))).cast("int"))
    # block pair (i, j): minor block i against minor block j >= i (j < n1) or major block j - n1
    pairs = F.when(
        F.col("minor") == 1,
        F.transform(F.sequence(F.lit(0), F.col("n1") + F.col("n0") - 1), lambda j: F.struct(F.when(j < F.col("n1"), F.least("k", j)).otherwise(F.col("k")).alias("i"), F.when(j < F.col("n1"), F.greatest("k", j)).otherwise(j).alias("j"))),
    ).otherwise(F.transform(F.sequence(F.lit(0), F.col("n1") - 1), lambda i: F.struct(i.alias("i"), (F.col("k") + F.col("n1")).alias("j"))))
    work = dealt.select("centre", "doc", "comp", "minor", "k", F.explode(pairs).alias("p")).select("centre", "p.i", "p.j", "doc", "comp", F.when((F.col("minor") == 1) & (F.col("k") == F.col("p.i")), 0).otherwise(1).alias("side"))
    work = ws.save(work, "family-work")
    edges = ws.save(work.join(sets, "doc").groupBy("centre", "i", "j").applyInPandas(_forest(num, den), "a long, b long"), "family-edges")
    over = connected_components(ws, edges, "families").select(F.col("node").alias("comp"), F.col("component").alias("upper"))
    comp = comp.join(over, "comp", "left").select("doc", F.coalesce("upper", "comp").alias("component_id"))
    classes = ws.save(reps.join(comp, "doc").select("set_key", "component_id", "doc"), "classes")
    single = ws.save(reps.select("set_key", F.col("doc").alias("d")).join(classes.drop("doc"), "set_key", "left").select("set_key", F.coalesce("component_id", "d").alias("component_id")), "labels")
    out = rows_in.join(single, "set_key", "left")
    cid = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), cid).alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _labels(nodes: DataFrame, cc: DataFrame) -> DataFrame:
    return nodes.join(cc.withColumnRenamed("node", "doc"), "doc", "left").select("doc", F.coalesce("component", "doc").alias("comp"))
