"""Removal of repeated substrings by a difference cover and one suffix bucket at a time.

A byte goes if it is covered by a string of LENGTH bytes that starts anywhere else in the corpus as well.  Sorting
every suffix would move many times the corpus, so:

1. Equal texts are one row with a count.  If it is over one, all its strings repeat and the whole text goes.
2. Cover samples: positions whose remainder modulo PERIOD lies in a difference cover.  For any two positions there is
   a shift below PERIOD that brings both onto samples, so equal strings of LENGTH bytes share an equal sample string
   of LENGTH - PERIOD + 1 bytes.  The samples (12 of 133 positions) are ranked: a bucket of them is sorted at a time
   and a sample whose string is the only one of its kind has no tie.
3. Only suffixes with a tied sample within the next PERIOD bytes can repeat.  They are taken one range of suffix
   buckets at a time (ROUNDS jobs, or more by `rounds`): of each the fingerprint of its first LENGTH bytes is sorted
   with its bucket, and equal neighbours repeat.  Memory and shuffle are bounded by a bucket and a round.
4. The union of the repeated strings goes from each text.

Order within a bucket is by 64-bit fingerprints, not by letters: only ties of LENGTH bytes matter here.  Everything
travels through the exchange as four bytes for a sample and eight for a suffix.

Null text counts as empty.  Texts shorter than LENGTH lose nothing.  Null ids are kept, repeated rows are copies and
lose everything, an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, exchange

LENGTH = 200
PRIME = 11
PERIOD = PRIME * PRIME + PRIME + 1
ROUNDS = 4


def singer(p: int) -> list[int]:
    """A perfect difference cover of p + 1 residues modulo p * p + p + 1 (Singer): the powers of a root of a cubic over
    the field of p elements that lie in a plane."""
    v = p * p + p + 1
    for a, b, c in product(range(p), range(p), range(1, p)):
        x, plane = (1, 0, 0), []
        for i in range(v):
            if x[2] == 0:
                plane.append(i)
            x = ((c * x[2]) % p, (x[0] + b * x[2]) % p, (x[1] + a * x[2]) % p)  # times the root: t^3 = a t^2 + b t + c
        if len(plane) == p + 1 and len({(s - t) % v for s in plane for t in plane}) == v:
            return plane
    raise ValueError(p)


_COVER: dict[int, np.ndarray] = {}


def cover() -> np.ndarray:
    """By residue, whether it is a sample."""
    if PERIOD not in _COVER:
        _COVER[PERIOD] = np.isin(np.arange(PERIOD), singer(PRIME))
    return _COVER[PERIOD]


class Part:
    """The texts of a part as bytes, with prefix sums for the fingerprint of any substring."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = common.byte_texts(column)
        self.size = np.diff(self.offsets)
        self.prefix = common.Prefix(self.data)

    def samples(self, length: int) -> np.ndarray:
        """Places of the cover samples with a whole sample string."""
        reach = length - PERIOD + 1
        inside = np.arange(len(self.data)) - np.repeat(self.offsets[:-1], self.size)
        return np.flatnonzero(cover()[inside % PERIOD] & (inside + reach <= np.repeat(self.size, self.size)))

    def fingerprints(self, at: np.ndarray, length: int) -> np.ndarray:
        return self.prefix.hashes(at, at + length)

    def suspects(self, samples: np.ndarray, tied: np.ndarray, length: int) -> np.ndarray:
        """Places of suffixes of at least `length` bytes with a tied sample less than PERIOD bytes on."""
        ends = np.repeat(self.offsets[1:], self.size)
        mark = np.zeros(len(self.data) + 1, np.int32)
        hit = samples[tied > 0]
        text = np.repeat(self.offsets[:-1], self.size)
        np.add.at(mark, np.maximum(hit - (PERIOD - 1), text[hit]), 1)
        np.add.at(mark, hit + 1, -1)
        return np.flatnonzero((np.cumsum(mark[:-1]) > 0) & (np.arange(len(self.data)) + length <= ends))


def _tied(items: np.ndarray) -> np.ndarray:
    """Sorts a bucket; 1 for each item that has an equal."""
    order = np.argsort(items)
    s = items[order]
    same = s[1:] == s[:-1]
    out = np.zeros(len(items), np.uint8)
    out[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(s) else out
    return out


def _digest(data: np.ndarray, repeated: np.ndarray) -> tuple[int, int, str]:
    """Bytes and runs removed, and the digest of the rest."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], repeated.view(np.int8), [0]])))
    return int(repeated.sum()), len(edge) // 2, hashlib.sha256(data[~repeated].tobytes()).hexdigest()


def repeats(df: DataFrame, text: str = "text", length: int = LENGTH, rounds: int = ROUNDS, keep_rest: bool = False) -> tuple[DataFrame, DataFrame]:
    """Of each different text its key (md5), n_bytes, n_removed, n_spans, kept_sha256 and with `keep_rest` the
    remaining bytes; and the expression-free frame of keys of `df`."""
    if length <= PERIOD:
        raise ValueError(f"length must be over {PERIOD}")
    spark = df.sparkSession
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keyed = df.withColumn("_text", t).withColumn("_key", F.unhex(F.md5("_text")))
    rows = exchange.numbered(keyed.groupBy(F.col("_key").alias("key")).agg(F.first("_text").alias("text"), F.count("*").alias("copies")), "substring-texts")
    exchange.release(spark)
    n = exchange.buckets(spark)

    def ask_samples(part: pa.RecordBatch) -> np.ndarray:
        own = Part(part.column("text"))
        return own.fingerprints(own.samples(length), length - PERIOD + 1)

    ranks = common.saved(exchange.answer(exchange.ask(rows, ask_samples, n, 4), _tied, 4).withColumn("round", F.lit(-1)), "substring-ranks")
    exchange.release(spark)

    def suspects(part: pa.RecordBatch, replies: pa.Table) -> tuple[Part, np.ndarray, np.ndarray]:
        own = Part(part.column("text"))
        samples = own.samples(length)
        ranked = replies.filter(pa.array(replies.column("round").to_numpy() == -1)) if replies.num_rows else replies
        at = own.suspects(samples, exchange.returned(own.fingerprints(samples, length - PERIOD + 1), ranked, n), length)
        return own, at, own.fingerprints(at, length)

    def in_round(fingerprints: np.ndarray, r: int) -> np.ndarray:
        return exchange.bucket_of(fingerprints, n) % rounds == r

    def ask_suffixes(r: int):
        def run(part: pa.RecordBatch, replies: pa.Table) -> dict:
            _, _, h = suspects(part, replies)
            seq = replies.column("seq")[0].as_py() if replies.num_rows else 0
            return exchange.packed(h[in_round(h, r)], part.column("block")[0].as_py(), seq, n, 8)

        return run

    answers = [ranks]
    for r in range(rounds):
        asked = exchange.together(rows, ranks, ask_suffixes(r), exchange.ASKED)
        answers.append(common.saved(exchange.answer(asked, _tied, 8).withColumn("round", F.lit(r)), "substring-ties"))
        del asked
        exchange.release(spark)

    def remove(part: pa.RecordBatch, replies: pa.Table) -> dict:
        own, at, h = suspects(part, replies)
        hit = np.zeros(len(at), bool)
        for r in range(rounds):
            mine = in_round(h, r)
            if mine.any():
                hit[mine] = exchange.returned(h[mine], replies.filter(pa.array(replies.column("round").to_numpy() == r)), n) > 0
        mark = np.zeros(len(own.data) + 1, np.int32)
        np.add.at(mark, at[hit], 1)
        np.add.at(mark, at[hit] + length, -1)
        repeated = np.cumsum(mark[:-1]) > 0
        copies = part.column("copies").to_numpy()
        out, rest = [], []
        for i, (a, b) in enumerate(zip(own.offsets[:-1].tolist(), own.offsets[1:].tolist(), strict=True)):
            gone = repeated[a:b] | (copies[i] > 1 and b - a >= length)
            out.append(_digest(own.data[a:b], gone))
            rest.append(own.data[a:b][~gone].tobytes() if keep_rest else None)
        return {"key": part.column("key"), "n_bytes": own.size, **{c: [x[k] for x in out] for k, c in enumerate(("n_removed", "n_spans", "kept_sha256"))}, "rest": rest}

    everything = reduce(DataFrame.unionAll, answers)
    result = exchange.together(rows, everything, remove, "key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, rest binary")
    return (result if keep_rest else result.drop("rest")), keyed.drop("_text")


def dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, rounds: int = ROUNDS) -> DataFrame:
    """One row for each row of `df`."""
    result, keyed = repeats(df.select(doc_id, text), text, length, rounds)
    return keyed.select(doc_id, "_key").join(result, F.col("_key") == F.col("key")).drop("_key", "key")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(common.table(spark, sf_dir, "documents"))
