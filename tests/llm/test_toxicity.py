"""Folding, entries, exceptions and held-out labels, with a plain search beside the automaton."""

import random

import numpy as np
import pytest

from changefold.llm import toxicity as tx

SYLLABLES = ["ba", "do", "ki", "lu", "me", "no", "pa", "ro", "su", "ti", "va", "ze"]


def word(rnd):
    return "".join(rnd.choices(SYLLABLES, k=rnd.randint(2, 4)))


def corpus(n, seed=1, share=0.15, bad=("grubble", "snarkwit", "vexhole")):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        words = [word(rnd) for _ in range(rnd.randint(5, 120))]
        toxic = rnd.random() < share
        if toxic:
            for _ in range(rnd.randint(1, 3)):
                words.insert(rnd.randrange(len(words)), rnd.choice(bad))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", 5, 0.5) for i, t, _ in rows], "doc_id long, text string, fold string, toxic int, score double")
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in rows], "doc_id long, toxic int, text string")
    return docs, labels


@pytest.mark.parametrize("text", ["grubble", "GRUBBLE!", "grübble", "gru​bble", "ɡrubble", "grubb1e", "gru88le", "grubbl3", "ｇｒｕｂｂｌｅ", "grubbӏе", "(grubble)$$$", "grubble###"])
def test_disguises_fold_to_one_word(text):
    assert tx.fold(text) == tx.fold("grubble")


def test_numbers_and_signs_are_not_words():
    assert tx.fold("in 2024, 15 of 30! $5 and a$ap 7up") == ["in", "of", "and", "asap", "tup"]
    assert tx.fold("") == [] and tx.fold("!!! 123 $$$") == []


def test_hits_against_plain_search():
    rnd = random.Random(3)
    weights = {f" {word(rnd)[:5]}": rnd.random() + 0.1 for _ in range(30)} | {f" {word(rnd)} ": rnd.random() + 0.1 for _ in range(30)}
    words = [word(rnd) for _ in range(400)]
    exceptions = {f" {words[5]} ", f" {words[9]} {words[10]} "}
    lexicon = tx.Lexicon(weights, exceptions)
    text, plain = f" {' '.join(words)} ", {}
    for entry, w in weights.items():
        at = text.find(entry)
        while at >= 0:
            plain[at] = max(plain.get(at, 0), w)
            at = text.find(entry, at + 1)
    for phrase in exceptions:
        at = text.find(phrase)
        while at >= 0:
            plain = {k: w for k, w in plain.items() if not at <= k < at + len(phrase) - 1}
            at = text.find(phrase, at + 1)
    assert lexicon.hits(text, lexicon.automaton()) == plain


def test_held_out_documents(spark):
    rows = corpus(900)
    docs, labels = frames(spark, rows)
    model = tx.train(docs, labels, learn=tx.F.col("_id") % 3 != 0)
    assert all(any(tx.fold(b)[0].startswith(e.strip()) for e in model.lexicon.weights) for b in ("grubble", "snarkwit", "vexhole"))
    got = {r.doc_id: r for r in tx.scores(docs, model).collect()}
    held = [(y, got[i]) for i, _, y in rows if i % 3 == 0]
    assert np.mean([r.predicted == y for y, r in held]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for _, r in held)
    disguised = spark.createDataFrame([(1, "so gru88le dox"), (2, "so SNАRKWIT dox"), (3, "so dox"), (4, None), (5, ""), (None, "vexhole " * 3), (1, "so gru88le dox")], "doc_id long, text string")
    out = tx.scores(disguised, model).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == 7 and [by[k].predicted for k in (1, 2, 3, 4, 5, None)] == [1, 1, 0, 0, 0, 1]
    assert by[4].score == by[5].score and len({r.score for r in out if r.doc_id == 1}) == 1


def test_word_beginnings_and_exceptions(spark):
    """Toxic words share a beginning; one harmless word and one harmless phrase hold it too."""
    rnd = random.Random(9)
    rows = []
    for i in range(600):
        words = [word(rnd) for _ in range(30)]
        toxic = int(i % 6 == 0)
        if toxic:
            words.insert(rnd.randrange(30), "skrag" + word(rnd))
        elif i % 6 == 1 and i % 5 == 0:
            words.insert(4, "skragton")
        elif i % 6 == 2 and i % 5 == 0:
            words[7:7] = ["skragmeko", "flower"]
        rows.append((i, " ".join(words), toxic))
    docs, labels = frames(spark, rows)
    model = tx.train(docs, labels)
    some = [(1, "see the skragtipa there"), (2, "off to skragton by train"), (3, "a skragmeko flower grows"), (4, "see the flower there")]
    got = {r.doc_id: r.predicted for r in tx.scores(spark.createDataFrame(some, "doc_id long, text string"), model).collect()}
    assert got == {1: 1, 2: 0, 3: 0, 4: 0}


def test_length_weighs(spark):
    docs, labels = frames(spark, corpus(400))
    model = tx.train(docs, labels)
    filler = " ".join(["lumeno"] * 400_000)
    out = {r.doc_id: r.score for r in tx.scores(spark.createDataFrame([(1, "lumeno grubble"), (2, f"grubble {filler}"), (3, filler)], "doc_id long, text string"), model).collect()}
    assert out[1] > out[2] > out[3]


def test_nothing_to_learn_and_empty(spark):
    docs, labels = frames(spark, [(1, "a b", 0), (2, "c d", 0)])
    assert {round(r.score, 6) for r in tx.scores(docs, tx.train(docs, labels)).collect()} == {tx.PRIOR}
    nulls = labels.selectExpr("doc_id", "cast(null as int) toxic")
    assert tx.train(docs, nulls).lexicon.weights == {}
    empty = docs.limit(0)
    assert tx.scores(empty, tx.train(empty, labels.limit(0))).collect() == []


def test_a_label_twice_is_toxic_if_one_says_so(spark):
    rows = corpus(400)
    docs, labels = frames(spark, rows)
    twice = labels.unionAll(labels.selectExpr("doc_id", "0 toxic", "text"))
    assert tx.train(docs, twice) == tx.train(docs, labels)


def test_query_holds_out_by_crc(spark):
    import zlib

    out = tx.op11_toxicity(spark, "/root/testdata/sf0.001").collect()
    assert len(out) == 200 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)


def test_chosen_drops_what_others_make_needless():
    counts = {" grub": (40, 0), " grubb": (40, 0), " grubbl": (25, 0), " grubble ": (25, 0), " good": (10, 90), " rare": (2, 0)}
    found = tx.chosen(counts, 100, 900)
    assert set(found) == {" grubb"}
