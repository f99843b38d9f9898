"""Counts against a brute-force reading; the bound against exact sums; the guarantee on labelled rows."""

import math
import random
import re
from collections import Counter

from pyspark.sql import Row
from pyspark.sql import functions as F

from changefold.llm import quality_rules as qr

TEXTS = [None, "", " \n\t ", "one", "a b c a b c", "a b a b a b a b", "x\x0by\x0cz\r\nx\ny\ny\n\ny", "é ñ é ñ é ñ \xa0 w", "#*$ %& |<>", "the end\nthe end\n the end", " lead and trail ", "w " * 300, "a b c d a b c e b c d", "Ab!? " * 60]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts(spark):
    r = random.Random(1)
    texts = TEXTS + ["".join(r.choice(["a ", "b ", "c\n", "d", " ", "# "]) for _ in range(r.randint(1, 90))) for _ in range(150)]
    df = spark.createDataFrame([Row(doc_id=i, text=t, lang=None if i % 2 else "xx", n_words="clash", level=1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, n_words string, level int")
    rows = {x.doc_id: x for x in qr.features(df).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        x = rows[i]
        want = brute(t)
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == want, repr(t)
        assert x.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_binomial(spark):
    cases = [(0, 300, 0.02), (3, 300, 0.02), (0, 1, 0.5), (7, 1000, 0.01), (100, 9000, 0.02), (50, 60, 0.5)]
    for x, n, p in cases:
        got = spark.range(1).select(qr.binomial_cdf(F.lit(x), F.lit(n), p).alias("v")).first().v
        want = 1.0 if x > n * p else sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(x + 1))
        assert math.isclose(got, want, rel_tol=1e-9)


def make(spark, n=3000, bad=0.15):
    r = random.Random(5)
    docs, labels = [], []
    for i in range(n):
        junk = r.random() < bad
        words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) + ("###" if junk and r.random() < 0.7 else "") for _ in range(60)]
        docs.append((i, " ".join(words), r.choice(["x", "y", None])))
        labels.append((i, 0 if junk else 1, 0))
    return spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_certified_levels_reject_junk_and_keep_good(spark):
    docs, labels = make(spark)
    out = qr.judged(qr.features(docs), labels).join(labels, "doc_id")
    by = {r["quality"]: r["k"] for r in out.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert by[1] > 1 - qr.ALPHA and by[0] < 0.02


def test_no_labels_and_empty(spark):
    docs, labels = make(spark, 60)
    none = labels.withColumn("quality", F.lit(None).cast("int"))
    assert qr.judged(qr.features(docs), none).filter("kept").count() == 60
    assert qr.judged(qr.features(docs.limit(0)), labels).count() == 0
