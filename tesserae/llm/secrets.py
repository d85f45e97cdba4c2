"""Secret scans: patterns propose, a random forest trained on labelled findings disposes. DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.plans.workspace import Workspace, fits_broadcast

# fixed values: public formats of credentials (Java regular expressions), most specific first; every one is linear in the text
KEYWORD = r"(?:password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|auth[_-]?key|credential|(?<![a-z])pw)s?"
ASSIGN = rf"(?i:{KEYWORD}[\"']?\s{{0,3}}[:=]\s{{0,3}}[\"'`]?)"
LOGIN = r"\b[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:"
FORMATS = {
    "private_key": r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]+(?:-----END [A-Z ]{0,40}PRIVATE KEY-----)?",
    "aws_key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b",
    "github_token": r"\bgh[pousr]_[A-Za-z0-9]{30,}",
    "slack_token": r"\bxox[abprs]-[A-Za-z0-9-]{10,}",
    "jwt": r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}(?:\.[A-Za-z0-9_-]+)?",
    "login": rf"{LOGIN}[^\s/@]{{3,128}}(?=@)",
    "assignment": rf"{ASSIGN}[^\s\"'`,;<>]{{6,}}",
    "opaque": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}",
}
CANDIDATE = "|".join(f"(?:{p})" for p in FORMATS.values())
# fixed values: words of placeholders and of code, known whatever the corpus
WORDS = (
    "password passwd secret token example sample dummy placeholder change changeme test your here none null true false required optional default value string enter reset forgot login user admin key api "
    "host localhost server database port index content config build home path file image data share python local release version section title page report final draft section module class method"
).split()
#: Words beside a finding, and parts of its path, by a hash: so many columns of each.
NEAR, PATH = 16, 8
FEATURES = ["f_length", "f_breaks", "f_pairs", "f_vowels", "f_digits", "f_distinct", "f_hex", "f_marks", "f_words", "f_keyword", "f_doubt", "f_assigned", "f_format", "f_test_path"]
FEATURES += [f"f_near{i}" for i in range(NEAR)] + [f"f_path{i}" for i in range(PATH)]


@dataclass
class Language:
    """What the corpus says of its language: a table of words with counts, and log probabilities of letter after letter."""

    words: DataFrame
    least: int
    pairs: list[float]


def learn_language(docs: DataFrame) -> Language:
    """Words (lower-case runs of letters) of all ``docs(text)``, and letter transitions of a to z over all their words.

    A word counts as one of the dictionary if it makes 1e-8 of the corpus and was met five times. No texts: no words, and all
    transitions alike.
    """
    ws = Workspace(docs.sparkSession, "secret-words")
    word = docs.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")).where("word <> ''")
    words = ws.save(word.groupBy("word").agg(F.count("*").alias("n")), "words")
    letters = F.split("word", "")
    pair = words.select("n", F.explode(F.zip_with(letters, F.slice(letters, 2, F.greatest(F.size(letters) - 1, F.lit(0))), lambda a, b: F.concat(a, b))).alias("pair"))
    met = {r["pair"]: r["n"] for r in pair.where(F.col("pair").rlike("^[a-z]{2}$")).groupBy("pair").agg(F.sum("n").alias("n")).collect()}
    abc = "abcdefghijklmnopqrstuvwxyz"
    after = {a: sum(met.get(a + b, 0) for b in abc) for a in abc}
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ws.release()
    return Language(words, max(5, math.ceil(total * 1e-8)), [math.log((met.get(a + b, 0) + 1) / (after[a] + 26)) for a in abc for b in abc])


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """Every pattern match of the whole texts: doc_id, finding (from 0 in a text), start (1-based), hit, value (the end of the
    hit), kind, the word before and after, and the path. Texts without a match are dropped before anything is taken apart."""
    hits = docs.where(F.col("text").rlike(CANDIDATE))
    hits = hits.select("doc_id", F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), F.regexp_extract_all("text", F.lit(CANDIDATE), 0).alias("hits"), F.split("text", CANDIDATE, -1).alias("gaps"))
    # starts as running sums, in one pass over the hits
    step = F.transform("gaps", lambda g, i: F.length(g) + F.coalesce(F.length(F.get("hits", i)), F.lit(0)))
    hits = hits.withColumn("ends", _running(step))
    at = F.transform("hits", lambda h, i: F.struct(h.alias("hit"), (F.get("ends", i) - F.length(h) + 1).alias("start"), F.substring(F.get("gaps", i), -120, 120).alias("left"), F.substring(F.get("gaps", i + 1), 1, 120).alias("right")))
    x = hits.select("doc_id", "path", F.posexplode(at).alias("finding", "z"))
    hit = F.col("z.hit")
    kind = F.lit("opaque")
    for name, p in reversed([*FORMATS.items()][:-1]):
        kind = F.when(hit.rlike(f"^(?:{p.removesuffix('(?=@)')})$"), name).otherwise(kind)
    value = F.when(kind == "login", F.regexp_replace(hit, f"^{LOGIN}", "")).otherwise(F.regexp_replace(hit, f"^{ASSIGN}", ""))
    return x.select(
        "doc_id", "finding", F.col("z.start").alias("start"), hit.alias("hit"), value.alias("value"), kind.alias("kind"),
        F.regexp_extract("z.left", r"(\S+)\s*$", 1).alias("before"), F.regexp_extract("z.right", r"^\S*\s+(\S+)", 1).alias("after"), "path",
    )


def _running(steps: Column) -> Column:
    """Running sums of an array of integers, by blocks, so that long arrays cost no square of their length."""
    size = F.ceil(F.sqrt(F.size(steps))).cast("int")
    zero = F.array().cast("array<long>")
    add = lambda a, x: F.concat(a, F.array(F.coalesce(F.element_at(a, -1), F.lit(0)) + x))
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0))), lambda i: F.slice(steps, i * size + 1, F.greatest(size, F.lit(1))))
    inner = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda a, x: F.when(F.size(a) > 0, add(a, x)).otherwise(F.array(x.cast("long")))))
    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda a, x: a + x))
    before = F.aggregate(sums, F.array(F.lit(0).cast("long")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    return F.flatten(F.transform(inner, lambda b, i: F.transform(b, lambda x: x + F.get(before, i))))


def features(found: DataFrame, language: Language) -> DataFrame:
    """Length, character transitions, dictionary coverage, path and neighbouring words of (hit, value, kind, before, after, path).

    Transitions are the mean log probability of the value's letters after one another; coverage is the share of its
    characters in dictionary words (of three letters or more, parted at capitals).
    """
    spark = found.sparkSession
    ws = Workspace(spark, "secret-candidates")
    found = ws.save(found.withColumn("cid", F.monotonically_increasing_id()), "candidates")  # ids must not change from here on
    part = found.select("cid", F.explode(F.regexp_extract_all("value", F.lit(r"[A-Z]?[a-z]{2,}|[A-Z]{3,}"), 0)).alias("part")).select("cid", F.lower("part").alias("word")).where("length(word) > 2")
    fixed = spark.createDataFrame([(w,) for w in WORDS], "word string")
    known = language.words.where(F.col("n") >= language.least).select("word").unionByName(fixed).distinct()
    cover = part.join(known, "word").groupBy("cid").agg(F.sum(F.length("word")).alias("covered"))
    found = found.join(cover, "cid", "left").drop("cid")
    v, n = F.col("value"), F.greatest(F.length("value"), F.lit(1)).cast("double")
    near = F.concat_ws(" ", "before", "after")
    chars = F.split(F.lower(v), "")
    codes = F.transform(chars, lambda c: F.when(c.between("a", "z"), F.ascii(c) - 97))
    lp = F.zip_with(codes, F.slice(codes, 2, F.greatest(F.size(codes) - 1, F.lit(0))), lambda a, b: F.get(F.lit(language.pairs), a * 26 + b))
    seen = F.aggregate(lp, F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n")), lambda a, x: F.struct((a["s"] + F.coalesce(x, F.lit(0.0))).alias("s"), (a["n"] + x.isNotNull().cast("int")).alias("n")))

    def count(p: str) -> Column:
        return F.regexp_count(v, F.lit(p)) / n

    def hashed(words: Column, i: int, m: int) -> Column:
        return F.size(F.filter(words, lambda w: (w != "") & (F.pmod(F.xxhash64(w), F.lit(m)) == i))).cast("double")

    near_words, path_words = F.split(F.lower(near), r"[^\p{L}]+"), F.split(F.lower("path"), r"[^\p{L}]+")
    cols = {
        "f_length": n,
        "f_breaks": count("(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[a-z0-9])|(?<=[0-9])(?=[A-Za-z])"),
        "f_pairs": F.when(seen["n"] > 0, seen["s"] / seen["n"]).otherwise(-math.log(26)),
        "f_vowels": count("(?i)(?<=[aeiou])(?=[b-df-hj-np-tv-z])"),
        "f_digits": count("[0-9]"),
        "f_distinct": F.size(F.array_distinct(F.split(v, ""))) / n,
        "f_hex": v.rlike("^[0-9a-f]+$").cast("double"),
        "f_marks": count("[/_=+.:$*{}-]"),
        "f_words": F.coalesce("covered", F.lit(0)) / n,
        "f_keyword": (F.col("hit").rlike(f"(?i){KEYWORD}") | near.rlike(f"(?i){KEYWORD}")).cast("double"),
        "f_doubt": near.rlike(r"(?i)\b(?:commit|revision|checksum|digest|md5|sha\d*|uuid|guid|isbn|hash|etag|build|id)\b").cast("double"),
        "f_assigned": F.col("hit").rlike(f"^{ASSIGN}").cast("double"),
        "f_format": F.col("kind").isin([k for k in FORMATS if k not in ("assignment", "opaque", "login")]).cast("double"),
        "f_test_path": F.col("path").rlike("(?i)test|example|sample|fixture|mock|doc").cast("double"),
    }
    cols |= {f"f_near{i}": hashed(near_words, i, NEAR) for i in range(NEAR)} | {f"f_path{i}": hashed(path_words, i, PATH) for i in range(PATH)}
    return found.withColumns({k: F.coalesce(c, F.lit(0.0)) for k, c in cols.items()}).drop("covered")


def labelled_findings(spark: SparkSession, n: int = 6000) -> DataFrame:
    """A fixed set of labelled findings (doc_id, text, source, label): credentials of all formats, and what is mistaken for them.

    Made by hashing row numbers, so it is the same everywhere; replace or extend it by reviewed findings of one's own.
    """
    i = F.col("id").cast("string")
    sha, other = F.sha2(i, 256), F.sha2(F.concat(i, F.lit("+")), 256)
    digits = F.regexp_replace(F.concat(sha, other), "[a-f]", "")
    upper = F.translate(F.substring(sha, 1, 16), "0123456789abcdef", "K2QZ7XWPLJ4TB6RV")
    alnum = F.regexp_replace(F.concat(F.base64(F.unhex(sha)), F.base64(F.unhex(other))), "[+/=]", "x")
    b64 = F.regexp_replace(F.concat(F.base64(F.unhex(sha)), F.base64(F.unhex(other))), "=", "A")
    listed = "the change password example user login page value section release config sample title content default local river mountain garden window letter summer coffee planet market bridge silver dragon monkey orange hunter winter".split()

    def word(k: int) -> Column:
        return F.get(F.lit(listed), F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(listed))).cast("int"))

    def some(k: int, low: int, span: int) -> Column:
        return (F.lit(low) + F.pmod(F.xxhash64("id", F.lit(k)), F.lit(span))).cast("int")

    def cat(*xs) -> Column:
        return F.concat(*(F.lit(x) if isinstance(x, str) else x for x in xs))

    a, b, c = word(1), word(2), word(3)
    good = [
        cat("AKIA", upper),
        cat("password=", F.substring(sha, 1, 16)),
        cat('token = "', F.substring(sha, 1, 40), '"'),
        cat("ghp_", F.substring(alnum, 1, 36)),
        cat("api_key: ", F.substring(alnum, F.lit(1), some(4, 16, 24))),
        cat("eyJ", F.substring(alnum, 1, 20), ".", F.substring(alnum, 21, 30), ".", F.substring(alnum, 30, 25)),
        cat("secret: ", F.substring(alnum, F.lit(3), some(5, 12, 24))),
        cat("passwd='", F.substring(alnum, F.lit(5), some(6, 8, 16)), "!'"),
        cat("postgres://", a, ":", F.substring(alnum, F.lit(2), some(7, 8, 14)), "@", b, ".com:5432/", c),
        cat("pw: ", a, F.substring(digits, F.lit(1), some(8, 1, 4)), b, c),
        cat("xoxb-", F.substring(digits, 1, 12), "-", F.substring(alnum, 1, 24)),
        cat("-----BEGIN RSA PRIVATE KEY-----\n", b64, "\n", F.reverse(b64), "\n-----END RSA PRIVATE KEY-----"),
        cat("export AWS_SECRET_ACCESS_KEY=", F.substring(b64, 1, 40)),
        cat("Password: ", F.initcap(a), F.substring(digits, F.lit(1), some(9, 2, 3)), "!", F.substring(alnum, 1, 3)),
    ]
    bad = [
        cat("password=", a, "_", b),
        cat('token = "your_', a, "_", b, '"'),
        cat("AKIAEXAMPLE", F.rpad(F.substring(F.upper(a), 1, 9), 9, "X")),
        cat("commit ", F.substring(sha, 1, 40)),
        cat("md5 ", F.substring(sha, 1, 32)),
        cat(a, "_", b, "_section_title_", F.substring(digits, 1, 2)),
        cat("/usr/share/lib/python3/", a, "/", b),
        F.rpad(cat("12345678901234567890", i), 26, "0"),
        cat("https://www.", a, ".com/", b, "/", F.substring(sha, 1, 24), "/index"),
        cat("ENSG", F.lpad(F.substring(digits, 1, 6), 11, "0"), F.upper(F.substring(alnum, 1, 4)), b),
        cat("IMG_20", F.substring(digits, 1, 6), "_", F.substring(digits, 3, 9), "_HDR"),
        cat(F.substring(sha, 1, 8), "-", F.substring(sha, 9, 4), "-4", F.substring(sha, 13, 3), "-a", F.substring(sha, 16, 3), "-", F.substring(other, 1, 12)),
        cat("data:image/png;base64,", b64, b64),
        cat("sha256:", sha),
        cat(a, "-20", F.substring(digits, 1, 2), "-10-12-", b, "-final-version-2.pdf"),
        cat("password: ", F.repeat(F.lit("*"), 8)),
        cat("api_key=${", F.upper(a), "_", F.upper(b), "_KEY}"),
        cat("postgres://user:password@localhost/", a),
        cat("978-", F.substring(digits, 1, 1), "-16-", F.substring(digits, 2, 6), "-0-", F.substring(digits, 8, 5)),
        cat(a, F.initcap(b), F.initcap(c), F.substring(digits, 1, 2), "Handler"),
        cat("https://cdn.", a, ".net/assets/", b, "/v", F.substring(digits, 1, 1), "/", c, "-", F.substring(sha, 1, 8), ".js"),
        cat("secret: please_", a, "_the_", b),
    ]
    kind = F.col("id") % (len(good) + len(bad))
    text = F.element_at(F.array(*good, *bad), (kind + 1).cast("int"))
    around = cat(word(11), " ", word(12), " ", text, " ", word(13))
    part = F.get(F.lit("src lib app docs/example tests/fixtures config deploy www notes".split()), F.pmod(F.xxhash64("id", F.lit(14)), F.lit(9)).cast("int"))
    source = F.when((kind < len(good)) & part.rlike("example|fixtures"), F.lit("src")).otherwise(part)
    return spark.range(0, n, 1, 4).select(F.col("id").alias("doc_id"), around.alias("text"), cat(source, "/", word(15)).alias("source"), (kind < len(good)).cast("int").alias("label"))


@dataclass
class SecretModel:
    forest: RandomForestClassificationModel
    language: Language


def fit_forest(labelled: DataFrame, docs: DataFrame, trees: int = 32, depth: int = 10, seed: int = 11) -> SecretModel:
    """A forest on the candidates of ``labelled(doc_id, text, source, label)`` (a text's candidates share its label), with
    words and letter transitions of ``docs(text)``."""
    language = learn_language(docs)
    x = features(candidates(labelled), language).join(labelled.select("doc_id", F.col("label").cast("double").alias("label")), "doc_id")
    # the forest reads its rows several times: take them apart once
    x = Workspace(docs.sparkSession, "secret-training").save(x.select("doc_id", "finding", "label", *FEATURES).orderBy("doc_id", "finding"), "features")
    x = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(x)
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.8, featureSubsetStrategy="0.4")
    return SecretModel(forest.fit(x.select("x", "label")), language)


def scan(docs: DataFrame, model: SecretModel, threshold: float = 0.5) -> DataFrame:
    """Candidates of ``docs(doc_id, text, source)`` with ``probability`` and ``is_secret`` (it reaches ``threshold``).

    A row for each match: doc_id, finding, start, kind, hit, value, probability, is_secret. Null and empty texts and
    texts without a match give no row; a null source is an empty path; repeated rows are scanned one by one. Other
    columns are ignored. A document is one row and is scanned where it lies, in time linear in its length; only the
    words of candidates meet the table of words.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source")
    x = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(features(candidates(src), model.language))
    p = vector_to_array("probability")[1]
    out = model.forest.transform(x).select("doc_id", "finding", "start", "kind", "hit", "value", p.alias("probability"))
    return out.withColumn("is_secret", F.col("probability") >= threshold)


def redact(docs: DataFrame, model: SecretModel, threshold: float = 0.5, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every confirmed span replaced in its text, and n_chars, if there is one, of the new text.

    All rows and columns stay, whatever their names. Findings meet their documents by a hash of text and source, so null
    and repeated doc_ids are served alike. They are written first and broadcast if they are few; else the join is shuffled.
    """
    ws = Workspace(docs.sparkSession, "redact")
    text, source = F.col("row.text"), F.col("row.source")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = rows.withColumn("key", F.xxhash64(text, F.coalesce(source.cast("string"), F.lit(""))))
    found = scan(rows.select(F.col("key").alias("doc_id"), text.alias("text"), source.alias("source")), model, threshold)
    cut = F.when(F.col("is_secret"), F.length("value")).otherwise(0)
    found = found.groupBy(F.col("doc_id").alias("key"), "finding").agg(F.max(cut).alias("cut"))  # copies of a text agree
    found = ws.save(found.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("finding", "cut"))).alias("cuts")).where("exists(cuts, c -> c.cut > 0)"), "found")
    size = found.agg(F.coalesce(F.sum(F.size("cuts") * 16 + 32), F.lit(0))).first()[0]
    found = F.broadcast(found) if fits_broadcast(size, 1) else found
    hits = F.regexp_extract_all(text, F.lit(CANDIDATE), 0)
    marked = F.zip_with(hits, "cuts", lambda h, c: F.when(c["cut"] > 0, F.concat(F.substring(h, F.lit(1), F.length(h) - c["cut"]), F.lit(mark))).otherwise(h))
    clean = F.concat_ws("", F.flatten(F.zip_with(F.split(text, CANDIDATE, -1), marked, lambda g, h: F.array(g, F.coalesce(h, F.lit(""))))))
    out = rows.join(found, "key", "left").withColumn("clean", F.when(F.col("cuts").isNull(), text).otherwise(clean))
    new = {"text": F.col("clean"), "n_chars": F.when(F.col("cuts").isNull(), F.col("row.n_chars")).otherwise(F.length("clean").cast("long"))} if "n_chars" in docs.columns else {"text": F.col("clean")}
    return out.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
