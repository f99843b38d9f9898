"""Kneser-Ney against a plain computation, and held-out accuracy."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import Row

from changefold.llm import langid


def corpus(n=240, seed=2):
    r = random.Random(seed)
    parts = {"xx": ["the", "on", "er", "ing", "an"], "yy": ["die", "und", "ei", "sch", "ü"], "zz": ["que", "la", "ión", "ñ", "os"]}
    text = lambda lang, k: " ".join("".join(r.choice(parts[lang]) for _ in range(r.randint(1, 4))) for _ in range(k))
    return text, [Row(doc_id=i, lang=x, text=text(x, r.randint(3, 80))) for i in range(n) for x in [r.choice(list(parts))]]


def test_distribution_sums_to_one_and_matches_by_hand():
    texts = ["abab ba", "abc"]
    packed, _ = langid.grams(texts)
    keys, n = np.unique(packed, return_counts=True)
    m = langid.Model(["x"], [keys], [n])
    alphabet = [ord(c) for c in "abc "]
    for context in ([1, 1, 1], [97, 98, 97], [120, 120, 120]):
        codes = np.array([sum(c << 16 * (3 - i) for i, c in enumerate([*context, a])) for a in alphabet], np.uint64)
        assert abs(np.exp(m.log_probability(codes)).sum() + np.exp(m.log_probability(np.array([codes[0] >> np.uint64(16) << np.uint64(16) | np.uint64(0x7777)]))).sum() - 1) < 1e-4
    # The unigram level: continuation counts of the distinct bigrams "<a", "ab", "ba", "b ", " b", "bc".
    c = Counter(int(k) & 0xFFFFFFFF for k in keys)
    ends = Counter(k & 0xFFFF for k in c)
    assert sorted(ends) == sorted(set(alphabet)) and m.letters == 5


def test_held_out_accuracy_and_rejection(spark):
    text, rows = corpus()
    df = spark.createDataFrame(rows)
    model = langid.train(df)
    out = {r.doc_id: r for r in langid.predict(df, model).collect()}
    held = [r for r in rows if out[r.doc_id].held_out]
    assert len(held) > 20 and sum(out[r.doc_id].lang_pred == r.lang for r in held) / len(held) > 0.97
    assert sum(o.rejected for o in out.values()) <= 2 and all(0 <= o.score <= 1 for o in out.values())
    r = random.Random(0)
    noise = ["".join(r.choice("qwxzkvjpбжщ") for _ in range(200)) for _ in range(20)]
    lang, score, rejected = model.predict([*noise, text("yy", 40), "", "123 !?"])
    assert rejected[:20].all() and not rejected[20] and lang[20:] == ["yy", "und", "und"] and score[21:].tolist() == [0, 0]


def test_odd_rows(spark):
    _, rows = corpus(60)
    more = [Row(doc_id=None, lang=None, text=None), Row(doc_id=5, lang="xx", text=""), Row(doc_id=5, lang="xx", text="")]
    df = spark.createDataFrame(rows + more, "doc_id long, lang string, text string").withColumn("score", langid.F.lit("clash"))
    model = langid.train(df)
    assert [r.lang_pred for r in langid.predict(df, model).collect()][-3:] == ["und"] * 3
    assert langid.predict(df.limit(0), langid.train(df.limit(0))).count() == 0
    assert {r.lang_pred for r in langid.predict(df, langid.train(df.limit(0))).collect()} == {"und"}
    assert df.filter(langid.accepted(df, model)).count() == 60
