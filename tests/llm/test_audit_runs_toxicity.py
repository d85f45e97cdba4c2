"""Filter audit, periodic runs and toxicity: brute force, held-out accuracy, and awkward tables."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.test_llm import docs_of, table

from tesserae.llm import audit, catalog, runs, toxicity

# filter audit


def audit_plain(rows, labels):
    """Part, order, step -> counts, document by document; ``rows`` are (doc_id, text, source)."""
    fails = []
    for i, t, _ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        late = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows)
        fails.append({f for f, x in zip("ABCDE", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search(r"[#$%&*|]", t)), late)) if x})
    good, toxic = ({i for i, q, x in labels if i is not None and (q, x)[k] == 1} for k in (0, 1))
    out, shapley = {}, {}
    for part in {s or "" for _, _, s in rows}:
        mine = [(rows[k][0], f) for k, f in enumerate(fails) if (rows[k][2] or "") == part]
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [i for i, x in left if f in x]
                left = [(i, x) for i, x in left if f not in x]
                lost = sum(f in x for _, x in mine) - len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), lost, sum(x == {f} for _, x in mine), sum(i in good for i in gone), sum(i in toxic for i in gone)]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit_rows():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    long = " ".join(words)
    rows = [(i, rng.choice([long, long + " A" * 50, "A B", "a | b", "same same same", f"{long} {i}", None, ""]), rng.choice(["s", "s", "s", "t", None, ""])) for i in range(80)]
    rows += [(200, "twice", "t"), (200, "twice", "t"), (None, "twice", "t"), (None, "alone", None), (201, "twice", "s"), (-3, "A B", "s"), (300, "é" * 9999 + " $", "u"), (301, "x " * 50_000, "u")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 90, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    return rows, labels


def test_audit_against_every_document(spark):
    rows, labels = audit_rows()
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, source string, mask int, h int, part int").repartition(7)
    lab = spark.createDataFrame([(*r, 9) for r in labels], "doc_id long, quality int, toxic int, good int")
    got = {tuple(r[:3]): tuple(r[3:]) for r in audit.filter_audit(docs, lab).collect()}
    assert got == audit_plain(rows, labels)


def test_audit_of_nothing(spark):
    rows, labels = audit_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert audit.filter_audit(docs.limit(0), lab).count() == 0
    got = audit.filter_audit(docs, lab.limit(0))
    assert got.count() == 4 * 600 and got.agg(F.sum(F.col("good_lost") + F.col("toxic_lost"))).first()[0] == 0


@pytest.mark.parametrize("cells", [1, 16])
def test_sketch_clears_unique_hashes_only(spark, cells, monkeypatch):
    monkeypatch.setattr(audit.CountingBloom.__init__, "__defaults__", (cells, 3))
    h = list(range(5000)) + list(range(0, 5000, 10)) + [7] * 3000
    rows = spark.createDataFrame([(x * 0x9E3779B97F4A7C15 % (1 << 63),) for x in h], "h long").repartition(9)
    got = [r[0] for r in audit.possible_repeats(rows, len(h), held=500).collect()]
    twice = {x * 0x9E3779B97F4A7C15 % (1 << 63) for x in [*range(0, 5000, 10), 7]}
    assert len(got) == len(set(got)) and twice <= set(got)
    assert len(got) < (5000 if cells == 1 else 700)


# periodic runs


def runs_plain(x):
    """By definition: every period, every maximal stretch, least period."""
    out, seen = [], set()
    for p in range(1, len(x) // 2 + 1):
        i = 0
        while i + p < len(x):
            j = i
            while j + p < len(x) and x[j] == x[j + p]:
                j += 1
            if j - i >= p:
                if (i, j + p) not in seen and j + p - i >= max(6, 4 * p):
                    out.append((i, j + p - i, p))
                seen.add((i, j + p))
            i = j + 1
    return sorted(out)


def test_runs_against_definition():
    rng = random.Random(1)
    for t in range(1500):
        n, k = rng.randrange(0, 70), rng.randrange(1, 5)
        x = [rng.randrange(k) for _ in range(n)]
        if t % 3 == 0 and n > 8:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randrange(3, 10)
            x = x[:a] + [x[a + (i - a) % p] for i in range(a, n)]
        assert runs.word_runs(x) == runs_plain(x), x
        assert runs.segment_runs(np.array(x, np.int64)) == runs_plain(x), x


def test_common_extensions_against_comparison():
    rng = np.random.default_rng(2)
    for n in (1, 2, 15, 16, 17, 200, 700):
        x = rng.integers(1, 3, n)
        ext = runs.Extensions(x)
        i, j = (a.ravel() for a in np.meshgrid(np.arange(n), np.arange(n)))
        i, j = i[i != j], j[i != j]
        plain = [next((k for k in range(n) if max(a, b) + k >= n or x[a + k] != x[b + k]), 0) for a, b in zip(i[:4000], j[:4000])]
        assert ext.common(i, j)[:4000].tolist() == plain
        tails = [x[k:].tolist() for k in range(n)] + [[]]
        assert ext.rank().argsort().tolist() == sorted(range(n + 1), key=lambda k: tails[k])
        assert ext.rank(falling=True).argsort().tolist() == sorted(range(n + 1), key=lambda k: [-v for v in tails[k]])


def runs_row(i, text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n = len(w)
    if i is not None and n and (h := zlib.crc32(str(i).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    found = runs_plain(w)
    top = sorted(found, key=lambda r: (-r[1], r[0], r[2]))[0] if found else (None,) * 3
    kept = [x for k, x in enumerate(w) if not any(s + p <= k < s + m for s, m, p in found)]
    listed = "".join(f"{s},{m},{p}\n" for s, m, p in found)
    return (i, len(found), *top, 1000 * top[1] // top[2] if found else None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def same_runs(spark, rows):
    got = runs.detect_runs(docs_of(spark, rows), plant=True).drop("n_words", "runs")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(runs_row(*r)) for r in rows)


def test_runs_query_against_definition(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "documents").where("length(text) < 6000").collect()]
    assert len(rows) > 100
    q = catalog.queries()["op12_periodic_runs"](spark, "/root/testdata/sf0.001")
    got = {r["doc_id"]: tuple(r) for r in q.collect()}
    assert len(got) == table(spark, "documents").count() and all(got[i] == runs_row(i, t) for i, t in rows)
    assert sum(r[1] > 0 for r in got.values()) > 10


def test_runs_of_awkward_texts(spark):
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "a a a a a"), (5, "a a a a a a"), (None, "b " * 40), (7, "x y " * 4), (7, "x y " * 4), (8, "Ä Ä Ä Ä Ä Ä\x0b z"), (-1, "q " * 30)]
    same_runs(spark, rows + [(i, "a b c d e f g h i j k l m n " * 9) for i in range(100, 140)])
    assert runs.detect_runs(docs_of(spark, rows).limit(0)).count() == 0


def test_runs_of_a_very_long_text():
    rng = random.Random(4)
    part = [f"w{rng.randrange(900)}" for _ in range(3000)]
    words = [f"u{k}" for k in range(200_000)] + part * 5 + ["z"] * 7
    assert runs.word_runs(words) == [(200_000, 15_000, 3000), (215_000, 7, 1)]


# toxicity


def test_marginals_against_all_taggings():
    rng = np.random.default_rng(3)
    starts, n = np.array([0, 1, 5]), 11
    e, a = rng.normal(size=n), np.exp(rng.normal(size=(2, 2)))
    p, f, r = toxicity.Chains(starts, n).marginals(e, a)
    for lo, hi in ((0, 1), (1, 5), (5, 11)):
        total, one, pair = 0.0, np.zeros(hi - lo), np.zeros((hi - lo, 2, 2))
        for tags in itertools.product((0, 1), repeat=hi - lo):
            w = np.exp(sum(e[lo + k] for k, x in enumerate(tags) if x)) * np.prod([a[x, y] for x, y in zip(tags, tags[1:])])
            total += w
            one += w * np.array(tags)
            for k in range(1, hi - lo):
                pair[k, tags[k - 1], tags[k]] += w
        assert np.allclose(p[lo:hi], one / total)
        for k in range(1, hi - lo):
            x = np.array([[a[0, 0], a[0, 1] * r[lo + k]], [a[1, 0] * f[lo + k - 1], a[1, 1] * f[lo + k - 1] * r[lo + k]]])
            assert np.allclose(x / x.sum(), pair[k] / total)


def test_gradient_is_that_of_the_likelihood():
    """One step of learning lowers the penalised loss, and the field's learned state fits planted labels."""
    rng = random.Random(0)
    vocabulary = [f"{a}{b}" for a in ("kor", "mel", "tas") for b in "abcdefgh"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(40)) + "." for _ in range(120)]
    y = np.array([k % 4 == 0 for k in range(120)]).astype(int)
    texts = [t.replace(" ", " gromp ", 2) if k else t for t, k in zip(texts, y)]
    m = toxicity.ToxicityModel().fit(texts, y, np.ones(120))
    p, cut = m.tag(["mela gromp tasb. kora", "mela tasb"])
    assert p[1] > 0.5 and max(p[[0, 2, 3, 4, 5]]) < 0.2 and cut.tolist() == [0, 4, 6]
    assert ((m.score(texts) > 0.7) == (y > 0)).all()


def test_toxicity_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels)).cache()
    assert out.count() == docs.count()
    seen = out.join(labels, "doc_id").where("held_out").toPandas()
    bad = seen["toxic"] == 1
    assert (seen["predicted"][bad] == 1).mean() > 0.75 and (seen["predicted"][~bad] == 0).mean() > 0.97
    for r in out.join(docs, "doc_id").where("size(spans) > 0").limit(20).collect():
        for s in r["spans"]:
            assert r["text"][s["start"] : s["end"]].strip() == r["text"][s["start"] : s["end"]] != "" and s["p"] >= 0.5
    out.unpersist()


def test_toxicity_of_awkward_texts(spark):
    rows = [(i, f"fine words of day {i}") for i in range(60)] + [(100 + i, f"fine zork day {i} zork") for i in range(60)]
    rows += [(500, None), (501, ""), (502, " \n"), (None, "zork zork"), (503, "zork " * 50_000), (100, "again")]
    labels = spark.createDataFrame([(i, int(i is not None and i >= 100), 1) for i, _ in rows[:120]] + [(None, 1, 1), (3, 1, 1)], "doc_id long, toxic int, score int")
    docs = docs_of(spark, rows)
    model = toxicity.fit_toxicity(docs, labels)
    got = toxicity.score_toxicity(docs, model, part=50).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    one = {r["doc_id"]: r for r in got}
    assert one[None]["predicted"] == 1 and not one[None]["held_out"] and one[503]["spans"][-1]["end"] > 249_900
    assert {one[i]["score"] for i in (500, 501, 502)} == {one[500]["score"]} and one[500]["predicted"] == 0 and one[1]["predicted"] == 0
    for few in (labels.limit(0), labels.where("toxic = 0")):
        flat = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, few)).select("score").distinct().collect()
        assert len(flat) == 1
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


# quality features


def test_quality_features_against_plain_loops():
    from tesserae.llm import quality

    rng = random.Random(8)
    texts = [" ".join(rng.choice(["good", "word", "Plain", "ODD", "x1", "!!", "rare%d" % k]) for _ in range(rng.randrange(1, 60))).encode() for k in range(80)]
    m = quality.QualityModel().fit(texts, np.array([k % 2 for k in range(80)]))
    for text in [*texts[:20], b"", None, b"unseen words only", b"one", b"a a a a a a", b"long " * 40_000]:
        ts = [t if len(t) > 1 and t.isupper() else t.lower() for t in re.findall(rb"[A-Za-z0-9\x80-\xff]+|[^\sA-Za-z0-9\x80-\xff]+", text or b"")]
        row = [m.ids[t] if t in m.ids else m._bucket(t) for t in ts]
        want = np.zeros((5, m.dim))
        for r in row:
            want[0] += m.vectors[r] / len(row)
        for lag in (1, 2, 3, 4):
            for i in range(lag, len(row)):
                want[lag] += m.own[row[i]].astype(float) * m.own[row[i - lag]] / (len(row) - lag)
        assert np.allclose(m.features(text), want.ravel(), atol=1e-4)
        z = (m.features(text) - m.net[0]) / m.net[1]
        logit = sum(m.net[4][h] * np.tanh(z @ m.net[2][:, h] + m.net[3][h]) for h in range(m.hidden)) + m.net[5][0]
        assert np.isclose(m.score([text])[0], 1 / (1 + np.exp(-logit / m.temperature)))
