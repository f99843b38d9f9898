"""Ranks against a literal reading of the contract, and classes, members and blocks one by one."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from changefold.llm import lexical_search as ls

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def literal(docs, items):
    """(item_id, rank, doc_id, score) of every item, repeats included."""
    own = [(i, [t.translate(LOWER) for t in TERM.findall(t or "")]) for i, t in docs]
    full = [(i, t) for i, t in own if t]
    n, total = len(full), sum(len(t) for _, t in full)
    df = Counter(w for _, t in full for w in set(t))
    out = []
    for item, text in items:
        asked = [t.translate(LOWER) for t in TERM.findall(text or "")]
        ranks = []
        for i, words in full:
            tf, m = Counter(words), 25 + 75 * len(words) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in asked if t in tf)
            if score > 0:
                ranks.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, r[3], -r[0]) for k, r in enumerate(sorted(ranks, key=lambda r: r[:3])[:10])]
    return sorted(out, key=str)


def ranked(spark, docs, items, **columns):
    d = spark.createDataFrame([(*r, 1, "k") for r in docs], "doc_id long, text string, n int, hash string")
    q = spark.createDataFrame([(*r, 0.5) for r in items], "item_id long, text string, score double")
    return sorted((tuple(r) for r in ls.search(d, q).collect()), key=str)


def corpus(seed, n):
    rnd = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "delta", "ébène", "naïve", "x1", "42", "日本", "ε", "zeta", "the", "The"]
    return [(i, rnd.choice([" ", ", ", "_", "\n"]).join(rnd.choices(words, k=rnd.randint(1, 30)))) for i in range(n)]


def test_against_literal_reading(spark):
    docs = corpus(1, 120)
    docs += [(500 + i, docs[3][1]) for i in range(40)] + [(900, None), (901, ""), (902, "\x00 !?"), (None, docs[3][1]), (3, docs[3][1])]
    docs += [(903, "beta " * 700 + "Zeta")]  # counts beyond one byte
    items = [(0, "alpha Beta the THE"), (1, "zeta ébène 日本"), (1, "alpha"), (2, None), (3, "--"), (4, "unknown words"), (None, "beta ébène x1 42"), (5, docs[3][1])]
    assert ranked(spark, docs, items) == literal(docs, items)


def test_equal_scores_go_by_id_across_classes(spark):
    """Three classes of equal score: their members interleave by id."""
    docs = [(k, ("red one", "red two", "red six")[k % 3]) for k in range(40, 0, -1)] + [(100 + i, "blue sky") for i in range(5)]
    items = [(7, "red"), (8, "sky blue red")]
    assert ranked(spark, docs, items) == literal(docs, items)


def test_large_class_and_blocks(spark, monkeypatch):
    docs = corpus(2, 60) + [(1000 - i, "alpha beta gamma") for i in range(300)]
    items = [(i, t) for i, t in corpus(3, 25)]
    one = ranked(spark, docs, items)
    assert one == literal(docs, items)
    monkeypatch.setattr(ls, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(ls, "BROADCAST_BYTES", 0)
    assert ranked(spark, docs, items) == one


def test_empty_tables(spark):
    assert ranked(spark, [], [(1, "alpha")]) == []
    assert ranked(spark, [(1, "alpha")], []) == []
    assert ranked(spark, [(1, None), (2, "...")], [(1, "alpha")]) == []


@given(st.lists(st.integers(0, 70_000), min_size=1, max_size=40, unique=True), st.data())
def test_bags_round_trip(places, data):
    places = np.sort(np.array(places))
    tf = np.array(data.draw(st.lists(st.integers(1, 100_000), min_size=len(places), max_size=len(places))))
    a, b = ls.unpack(ls.pack(places, tf, np.uint32), np.uint32)
    assert (a == places).all() and (b == tf).all()


def test_vocabulary_verifies_bytes(monkeypatch):
    """With hashes of two values nearly all terms collide: the bytes decide."""
    words = [b"a", b"b", b"ab", b"ba", b"abc", b"cab"]
    real = ls.common.Prefix.hashes
    monkeypatch.setattr(ls.common.Prefix, "hashes", lambda self, a, b: real(self, a, b) & np.uint64(1))
    v = ls.Vocabulary.of(words)
    data = np.frombuffer(b"ab c ba zz cab a", np.uint8)
    start, end, _ = ls.common.words(data, np.array([0, len(data)]), ls._TERM_BYTE)
    place = v.places(data, start, end)
    assert [v.word(k) if k >= 0 else None for k in place] == [b"ab", None, b"ba", None, b"cab", b"a"]


@pytest.mark.parametrize("number", [np.float64, np.int64])
def test_best_keeps_ties_in_order(number):
    rnd = np.random.default_rng(5)
    scores, first, cid = rnd.integers(0, 4, (200, 3)), rnd.permutation(200), np.arange(200)
    best = ls.Best(3)
    for a in range(0, 200, 17):
        best.add(scores[a : a + 17].astype(number).astype(np.int64), first[a : a + 17], cid[a : a + 17])
    for i in range(3):
        true = sorted((-s, f, c) for s, f, c in zip(scores[:, i], first, cid, strict=True) if s > 0)[:10]
        assert [(-s, f, c) for s, f, c in zip(best.score[i], best.first[i], best.cid[i], strict=True)] == true
