"""Removed bytes against brute force, for short and long strings."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import Row

from changefold.llm import substring_dedup as sd


def brute(values, length):
    data = [(t or "").encode() for t in values]
    n = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if n[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


def make(seed, length):
    r = random.Random(seed)
    text = lambda n: "".join(r.choice("abcdé\n ") for _ in range(n))
    parts = [text(r.randint(length - 40, length + 300)) for _ in range(8)] + ["a" * (length + 30), text(length)]
    out = [None, "", "short", text(5000)]
    for _ in range(60):
        out.append("".join(x for _ in range(r.randint(1, 4)) for x in (text(r.randint(0, 400)), r.choice(parts))))
    return [*out, out[6], out[6], out[9], "z" * 3000]


@pytest.mark.parametrize(("seed", "length"), [(1, 200), (2, 140)])
def test_removed(spark, seed, length):
    values = make(seed, length)
    df = spark.createDataFrame([Row(doc_id=i, text=t, key="clash", n_bytes=0) for i, t in enumerate(values)], "doc_id long, text string, key string, n_bytes int")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.dedup(df, length=length, rounds=2).collect()}
    assert [got[i] for i in range(len(values))] == brute(values, length)


def test_removed_when_scans_split_anew(spark, monkeypatch):
    def release(s):  # as if executors came and went between passes
        s.conf.set("spark.sql.files.maxPartitionBytes", "64m" if s.conf.get("spark.sql.files.maxPartitionBytes") == "2k" else "2k")

    monkeypatch.setattr(sd.exchange, "release", release)
    monkeypatch.setattr(sd.exchange, "buckets", lambda s: 4)
    values = make(3, 200)
    df = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    monkeypatch.setattr(sd.common, "saved", _small_groups(sd.common.saved))
    try:
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.dedup(df.coalesce(1), rounds=2).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert [got[i] for i in range(len(values))] == brute(values, 200)


def _small_groups(saved):
    """Tables of small row groups, so that a file can be split."""

    def save(df, name):
        conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for k in ("parquet.block.size", "parquet.page.size"):
            conf.set(k, "1024")
        conf.set("parquet.page.size.row.check.min", "1")
        conf.set("parquet.block.size.row.check.min", "1")
        try:
            return saved(df, name)
        finally:
            for k in ("parquet.block.size", "parquet.page.size", "parquet.page.size.row.check.min", "parquet.block.size.row.check.min"):
                conf.unset(k)

    return save


def test_cover():
    d = sd.singer(sd.PRIME)
    assert len(d) == 12 and {(a - b) % sd.PERIOD for a in d for b in d} == set(range(sd.PERIOD))


def test_rest_and_empty(spark):
    df = spark.createDataFrame([(None, "x" * 500), (2, None)], "doc_id long, text string")
    result, _ = sd.repeats(df, keep_rest=True)
    assert {(r.n_removed, bytes(r.rest)) for r in result.collect()} == {(500, b""), (0, b"")}
    assert sd.dedup(df.limit(0)).count() == 0
