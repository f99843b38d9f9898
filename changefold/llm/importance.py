"""Quality classifier by importance resampling over hashed n-grams.

Two generative models over hashed unigrams and bigrams of words and signs: the target model is counted on labelled
documents of good quality that are not toxic (half of a bounded sample, TARGET_DOCS), the raw model on every document of the
corpus.  A document's log importance weight is the sum of log(target / raw) over its n-grams, tempered to the mean
times the square root of their number, so that length alone does not decide.  With Gumbel noise (a hash of the id and
a seed, so a retry repeats it) added to the weight, the k largest keys are a sample of k documents without
replacement, drawn in proportion to the weights.

A few abusive words do not move a mean, so toxic documents have a score of their own: the largest log(toxic / target)
of any n-gram, by the number of labelled documents that hold it.  Its cutoff comes from the held-out halves of both
kinds: at most TARGET_LOSS of the good documents are above it, and it is used only if more than SIGNAL times that share
of the toxic ones is.  What is above it has REJECTED taken from its weight, so it is drawn last.

k is the number of documents whose weight is at least the TARGET_LOSS quantile of the weights of the sample's other
half, which the model has not seen: a feature of the operator, not a cap; `keep` sets another k.  The k-th key is found by counting keys in ever
narrower bins, never by collecting them.

Null text has no n-grams and weight 0, null ids draw the same noise as an empty id.  Repeated rows are rows of their
own (equal keys; ties at the k-th key are all kept).  Without target labels every document is kept.  An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

BUCKET_BITS = 17
TARGET_DOCS = 20_000
TARGET_LOSS = 0.01
SEED = 17
#: Added to the document counts of both kinds, which keeps rare n-grams from looking toxic.
TOXIC_SMOOTHING = 2.0
SIGNAL = 3
REJECTED = 1000.0
#: Added to each bucket of both models.
SMOOTHING = 0.5
BINS = 4096

# Bytes by class: 0 white space, 1 letters, digits and all of other scripts, 2 signs.
_CLASS = np.full(256, 2, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[128:] = 1
for _a, _b in (("0", "9"), ("A", "Z"), ("a", "z")):
    _CLASS[ord(_a) : ord(_b) + 1] = 1


def buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every n-gram of the texts, and the text it is in."""
    data, offsets = common.byte_texts(column)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _CLASS[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    start, end = cuts[:-1], cuts[1:]
    real = kind[start] != 0
    start, end = start[real], end[real]
    token = common.Prefix(data).hashes(start, end)
    text = np.searchsorted(offsets, start, side="right") - 1
    pair = common.mixed(token[:-1] * np.uint64(3) + token[1:])[text[:-1] == text[1:]]
    shift = np.uint64(64 - BUCKET_BITS)
    return (np.concatenate([token, pair]) >> shift).astype(np.int64), np.concatenate([text, text[:-1][text[:-1] == text[1:]]])


def counts(df: DataFrame, text: str = "text", target: str = "target") -> np.ndarray:
    """n-grams by bucket, of the documents with `target` and of all.  Each task sums its own before anything is sent."""
    size = 1 << BUCKET_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, size), np.int64)
        for batch in batches:
            for part in common.slices(batch, text):
                bucket, at = buckets(part.column(text))
                n[1] += np.bincount(bucket, minlength=size)
                chosen = part.column(target).to_numpy(zero_copy_only=False).astype(bool)
                if chosen.any():
                    n[0] += np.bincount(bucket[chosen[at]], minlength=size)
        at = np.flatnonzero(n[1])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[0][at]), pa.array(n[1][at])], names=["bucket", "target", "raw"])

    sums = df.select(text, target).mapInArrow(run, "bucket int, target long, raw long").groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).toArrow()
    out = np.zeros((2, size))
    out[:, sums.column("bucket").to_numpy()] = np.stack([sums.column("target").to_numpy(), sums.column("raw").to_numpy()])
    return out


def holders(df: DataFrame, text: str = "text", toxic: str = "_toxic") -> np.ndarray:
    """Labelled documents that hold an n-gram, by bucket, of toxic ones and of the others."""
    size = 1 << BUCKET_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, size), np.int64)
        for batch in batches:
            for part in common.slices(batch, text):
                bucket, at = buckets(part.column(text))
                once = np.unique(at * size + bucket)
                is_toxic = part.column(toxic).to_numpy(zero_copy_only=False).astype(bool)[once // size]
                n += np.stack([np.bincount(once[is_toxic] % size, minlength=size), np.bincount(once[~is_toxic] % size, minlength=size)])
        at = np.flatnonzero(n.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[0][at]), pa.array(n[1][at])], names=["bucket", "toxic", "other"])

    sums = df.select(text, toxic).mapInArrow(run, "bucket int, toxic long, other long").groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).toArrow()
    out = np.zeros((2, size))
    out[:, sums.column("bucket").to_numpy()] = np.stack([sums.column("toxic").to_numpy(), sums.column("other").to_numpy()])
    return out


def log_ratio(n: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    smooth = n + smoothing
    p = smooth / smooth.sum(1, keepdims=True)
    return np.log(p[0] / p[1])


def weights(df: DataFrame, ratio: np.ndarray, toxic: np.ndarray, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """doc_id, weight, key and the largest `toxic` ratio of every document."""
    shared = df.sparkSession.sparkContext.broadcast((ratio, toxic))

    def rows(part):
        bucket, at = buckets(part.column("text"))
        n = np.bincount(at, minlength=part.num_rows)
        ratio, toxic = shared.value
        worst = np.full(part.num_rows, -np.inf)
        np.maximum.at(worst, at, toxic[bucket])
        return {doc_id: part.column(doc_id), "noise": part.column("noise"), "weight": np.bincount(at, ratio[bucket], part.num_rows) / np.sqrt(np.maximum(n, 1)), "worst": worst}

    kind = df.schema[doc_id].dataType.simpleString()
    uniform = (F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(seed)), 12) + 0.5) / float(1 << 52)
    ready = df.select(doc_id, (-F.log(-F.log(uniform))).alias("noise"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    scored = common.map_slices(ready, rows, f"{doc_id} {kind}, noise double, weight double, worst double")
    return scored.select(doc_id, "weight", (F.col("weight") + F.col("noise")).alias("key"), "worst")


def kth_largest(df: DataFrame, column: str, k: int) -> float:
    """The k-th largest value: bins are counted, then the bin that holds it is split again, until its values are one."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    above = 0
    while low < high:
        width = (high - low) / BINS
        inside = df.filter(F.col(column).between(low, high))
        place = F.least(F.floor((F.col(column) - low) / width), F.lit(BINS - 1))
        bins = sorted(inside.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect(), reverse=True)
        for _, n, least, most in bins:
            if above + n >= k:
                low, high = least, most
                break
            above += n
    return low


def resample(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: int | None = None, target_docs: int = TARGET_DOCS, loss: float = TARGET_LOSS, seed: int = SEED) -> DataFrame:
    """doc_id, weight, key and kept for every document."""
    good = labels.filter((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("_id")).distinct()
    chosen = good.filter(common.share("_id", good.count(), target_docs))  # bounded by the parameter, so it may be broadcast
    halves = chosen.withColumn("_fit", F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(2)) == 0)
    marked = df.select(doc_id, F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(halves), F.col(doc_id) == F.col("_id"), "left").withColumn("target", F.coalesce("_fit", F.lit(False)))
    n = counts(marked)
    bad = labels.filter((F.col("toxic") == 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("_id")).distinct()
    bad = bad.filter(common.share("_id", bad.count(), target_docs)).withColumn("_fit", F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(2)) == 0)
    both = halves.withColumn("_toxic", F.lit(False)).unionAll(bad.withColumn("_toxic", F.lit(True))).groupBy("_id", "_fit").agg(F.max("_toxic").alias("_toxic"))
    held = holders(df.select(doc_id, F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(both.filter("_fit")), F.col(doc_id) == F.col("_id")))
    toxic = log_ratio(held, TOXIC_SMOOTHING) if held.any(1).all() else np.zeros(1 << BUCKET_BITS)
    scored = common.saved(weights(df, log_ratio(n) if n[0].any() else np.zeros(1 << BUCKET_BITS), toxic, doc_id, text, seed), "importance")
    total = scored.count()
    tested = scored.join(F.broadcast(both.filter("NOT _fit")), F.col(doc_id) == F.col("_id"))
    cutoff = tested.filter("NOT _toxic").agg(F.percentile("worst", F.lit(1 - loss))).first()[0]
    caught = None if cutoff is None else tested.filter("_toxic").agg(F.avg((F.col("worst") > cutoff).cast("double"))).first()[0]
    rejected = F.col("worst") > F.lit(cutoff) if caught is not None and caught > SIGNAL * loss else F.lit(False)
    low = F.when(rejected, F.lit(REJECTED)).otherwise(F.lit(0.0))
    scored = scored.select(doc_id, (F.col("weight") - low).alias("weight"), (F.col("key") - low).alias("key"))
    if keep is None:
        seen = scored.join(F.broadcast(halves.filter("NOT _fit")), F.col(doc_id) == F.col("_id")).filter(F.col("weight") > F.lit(-REJECTED / 2)).agg(F.percentile("weight", F.lit(loss))).first()[0]
        keep = total if seen is None else scored.filter(F.col("weight") >= seen).count()
    if keep <= 0 or not total:
        return scored.withColumn("kept", F.lit(False))
    return scored.withColumn("kept", F.col("key") >= F.lit(kth_largest(scored, "key", min(keep, total))))


def op1_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
