"""Sketches and classes against brute force."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa

from changefold.llm import near_dup as nd
from changefold.session import fresh_dir


def texts(seed=4):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(1, 6)))
    out = [None, "", "", " \n ", "a b", "a  b", "a b c", "one"]
    common = " ".join(word() for _ in range(40))
    for _ in range(60):
        base = [word() for _ in range(r.randint(30, 200))]
        out.append(" ".join(base))
        for _ in range(r.randint(0, 4)):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 12])):
                copy[r.randrange(len(copy))] = word()
            out.append(r.choice([" ", "\n"]).join(copy))
        if r.random() < 0.5:
            out.append(" ".join([common, *[word() for _ in range(30)]]))
    group = [word() for _ in range(150)]
    for _ in range(80):
        copy = list(group)
        copy[r.randrange(len(copy))] = word()
        out.append(" ".join(copy))
    return out


def brute(values):
    """Class of each text by all pairs."""
    shingles = []
    for t in values:
        w = (t or "").split()
        shingles.append(Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))))
    df = Counter(s for c in shingles for s in c)
    code = {s: min(255, round(nd.STEPS * np.log2(n))) for s, n in df.items()}
    weight = [{s: n * float(nd.idf(np.array([code[s]]), len(values))[0]) for s, n in c.items()} for c in shingles]
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            a, b = weight[i], weight[j]
            both = sum(min(a[s], b[s]) for s in a.keys() & b.keys())
            same = (values[i] or "") == (values[j] or "")
            if same or (a and b and both / (sum(a.values()) + sum(b.values()) - both) >= nd.SIMILARITY):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(values))]


def test_classes(spark):
    values = texts()
    path = fresh_dir(spark, "near")
    names = ["rid", "block", "key", "bands", "samples", "codes", "size", "bucket", "_row", "root", "node", "pivot", "first"]
    schema = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)
    spark.createDataFrame([(i, t, *[f"{n} {i}" for n in names]) for i, t in enumerate(values)], schema).write.parquet(path)
    df = spark.read.parquet(path)
    got = {r.doc_id: r for r in nd.classes(df).collect()}
    assert [got[i].class_id for i in range(len(values))] == brute(values)
    assert sum(r.first for r in got.values()) == len(set(brute(values)))
    # Columns named like those made inside come back as they were.
    kept = nd.distinct(df)
    assert kept.schema == df.schema and kept.count() == len(set(brute(values)))
    assert all(r[n] == f"{n} {r.doc_id}" for r in kept.collect() for n in names)


def test_classes_when_scans_split_anew(spark, monkeypatch):
    """Files are dealt to other tasks between passes, as if executors came and went."""
    values = texts(6)
    path = fresh_dir(spark, "near")
    spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").repartition(12).write.parquet(path)
    key = "spark.sql.files.openCostInBytes"
    was = spark.conf.get(key)
    monkeypatch.setattr(nd.exchange, "release", lambda s: s.conf.set(key, "1" if s.conf.get(key) != "1" else "64m"))
    try:
        got = {r.doc_id: r for r in nd.classes(spark.read.parquet(path)).collect()}
        kept = [r.text for r in nd.distinct(spark.read.parquet(path)).collect()]
    finally:
        spark.conf.set(key, was)
    want = brute(values)
    assert [got[i].class_id for i in range(len(values))] == want
    of = {}
    for t, c in zip(values, want, strict=True):
        of[t] = c
    assert sorted(of[t] for t in kept) == sorted(set(want))


def test_classes_over_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(nd, "TILE_BYTES", 1500)
    r = random.Random(8)
    group = [str(r.random()) for _ in range(150)]
    values = []
    for i in range(120):  # links in chains and stars around the original, and copies too far from it
        copy = list(values[-1].split() if i % 3 == 1 else group)
        for _ in range(r.randint(0, 9)):
            copy[r.randrange(len(copy))] = str(r.random())
        values.append(" ".join(copy))
    path = fresh_dir(spark, "near")
    spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").write.parquet(path)
    got = {r.doc_id: r.class_id for r in nd.classes(spark.read.parquet(path)).collect()}
    want = brute(values)
    assert 2 < len(set(want)) < 100
    assert [got[i] for i in range(len(values))] == want


def test_prefixes_lose_no_pair():
    r = np.random.default_rng(5)
    pool = r.integers(0, 2**63, 60).astype(np.uint64)
    sets = []
    for i in range(150):
        if i % 2:
            keep = sets[-1][r.random(len(sets[-1])) < 0.93]
            sets.append(np.unique(np.append(keep, r.integers(0, 2**63, r.integers(0, 3)).astype(np.uint64))))
        else:
            sets.append(np.unique(r.choice(pool, r.integers(1, 40))))
    count = np.array([len(x) for x in sets])
    h = np.concatenate(sets)
    weight = 1 + (h % np.uint64(7)) / 7 + (r.random(len(h)) < 0.02)
    ends = np.concatenate([[0], np.cumsum(count)])
    part = [(h[a:b], weight[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
    for block in (np.zeros(150, np.int64), np.arange(150) % 2):
        near = {(x, y) for x in range(150) for y in range(x) if nd.similarity(part[x], part[y]) >= 0.8 and (block[x] != block[y] or not block.any())}
        found = nd.close(h, weight, count, np.arange(150), block, 0.8)
        assert set(found) <= near
        root = np.arange(150)
        for x, y in found:
            root[root == root[y]] = root[x]
        assert near and all(root[x] == root[y] for x, y in near)


def test_nulls_and_empty(spark):
    path = fresh_dir(spark, "near")
    spark.createDataFrame([(None, "x y z"), (None, "x y z"), (7, "x y z"), (8, None), (8, None)], "doc_id long, text string").write.parquet(path)
    df = spark.read.parquet(path)
    assert sorted((str(r.doc_id), r.class_id) for r in nd.classes(df).collect()) == [("7", 7), ("8", 8), ("8", 8), ("None", 7), ("None", 7)]
    empty = fresh_dir(spark, "near")
    df.limit(0).write.parquet(empty)
    assert nd.classes(spark.read.schema(df.schema).parquet(empty)).count() == 0


def test_bands_follow_weighted_jaccard():
    r = np.random.default_rng(1)
    h = np.sort(r.integers(0, 2**63, 400).astype(np.uint64))
    a, b = r.random(400) + 1, r.random(400) + 1
    agree = np.mean([(nd.bands(h + np.uint64(k), a, np.array([400]), 16, 1)[0] == nd.bands(h + np.uint64(k), b, np.array([400]), 16, 1)[0]).mean() for k in range(60)])
    assert abs(agree - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04


def test_shingles_of_whole_texts():
    column = pa.array(["a b c d e f", "", "x", "a b c d e a b c d e", "é\tü\nö ä ß"])
    h, n, count = nd.shingles(column)
    assert count.tolist() == [2, 0, 1, 5, 1] and n.sum() == 2 + 1 + 6 + 1


def test_runs_of_texts_do_not_change_samples(monkeypatch):
    r = np.random.default_rng(2)
    count = r.integers(0, 60, 80)
    h, weight = r.integers(0, 2**63, count.sum()).astype(np.uint64), r.random(count.sum()) + 1
    whole = nd.bands(h, weight, count)
    monkeypatch.setattr(nd, "CACHED", 50)
    assert all((a == b).all() for a, b in zip(whole, nd.bands(h, weight, count), strict=True))
    # Bands are made of the samples: texts that agree in all samples of a band share it.
    twice = nd.bands(np.concatenate([h, h]), np.concatenate([weight, weight]), np.concatenate([count, count]))
    n = (count > 0).sum()
    assert all((x[:n] == x[n:]).all() for x in twice)


def test_agreement_estimates_similarity():
    """Texts at the similarity agree in enough samples, with room to spare."""
    r = np.random.default_rng(7)
    least = []
    for k in range(40):
        h = np.sort(r.integers(0, 2**63, 300).astype(np.uint64))
        edited = h.copy()
        at = r.choice(300, 33, replace=False)  # 267 of 333 shingles in common: 0.80
        edited[at] = r.integers(0, 2**63, 33).astype(np.uint64)
        edited = np.sort(edited)
        w = np.ones(300)
        (_, a), (_, b) = nd.bands(h, w, np.array([300])), nd.bands(edited, w, np.array([300]))
        least.append((a == b).sum())
    assert min(least) > nd.AGREEING and abs(np.mean(least) - 108) < 3


def test_agreeing_members_of_other_components():
    r = np.random.default_rng(3)
    base = r.integers(0, 256, (6, 135)).astype(np.uint8)
    samples = np.concatenate([base, base, base])
    for x in samples[6:]:
        at = r.choice(135, r.integers(20, 90), replace=False)
        x[at] = r.integers(0, 256, len(at))
    root = np.array([0, 1, 2, 3, 4, 5, 0, 1, 2, 9, 9, 9, 0, 0, 0, 9, 9, 10])
    for block in (np.zeros(18, np.int64), np.arange(18) // 6 % 2):
        want = [any((samples[x] == samples[y]).sum() >= nd.AGREEING and root[x] != root[y] and (not block.any() or block[x] != block[y]) for y in range(18)) for x in range(18)]
        assert nd.agreeing(samples, root, block).tolist() == want and any(want) and not all(want)
