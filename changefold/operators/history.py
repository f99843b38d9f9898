"""Full state history (type-2 SCD): every change event becomes a version of
its row, valid from its own time until the next event of the same key.

``lead() over (partition by key order by seq)`` would sort all events of one
key in one task, which breaks when a single key holds a large share of the
log.  ``next_in_group`` splits each key by time buckets instead: the log is
shuffled once, on ``(key, bucket)``, and the lead is taken inside each
bucket.  The last event of a bucket takes the first event of the key's next
bucket, handed over by a table of bucket heads: (key, bucket, time), combined
inside each map task before it is shuffled, so it is narrow, and a hot key
has one row per bucket in it.

A bucket is a function of the event alone, so any retry or second pass finds
the same one; nothing is sampled and nothing is written in between.  A task
holds a key's events of one bucket; narrow buckets (``bucket_ms``) bound it,
at the price of more heads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changefold import specs
from changefold.operators.fold import changes
from changefold.specs import TableSpec

BUCKET_MS = 60_000


def next_in_group(df: DataFrame, key: str, order: str, take: str, out: str, bucket: Column) -> DataFrame:
    """Add ``out`` = ``take`` of the next row (by ``order``) of the same
    ``key``; null for the last row of a key.  ``order`` must be unique
    within a key and non-null, ``take`` non-null; ``bucket`` must not fall
    as ``order`` rises."""
    bucketed = df.withColumn("_bucket", bucket)
    w = Window.partitionBy(key, "_bucket").orderBy(order)
    local = bucketed.withColumn("_local_next", F.lead(take).over(w))
    heads = bucketed.groupBy(key, "_bucket").agg(F.min(F.struct(F.col(order), F.col(take))).alias("_head"))
    succ = heads.select(key, "_bucket", F.lead(F.col("_head")[take]).over(
        Window.partitionBy(key).orderBy("_bucket")).alias("_succ"))
    return (local.join(succ, [key, "_bucket"], "left")
            .withColumn(out, F.coalesce("_local_next", "_succ")).drop("_bucket", "_local_next", "_succ"))


def history(bronze_df: DataFrame, spec: TableSpec, bucket_ms: int = BUCKET_MS) -> DataFrame:
    """One row per change event: key, op, ``valid_from_ms``, ``valid_to_ms``
    (null while current), the row image (``before`` for deletes) converted
    to silver types, and ``_deleted``."""
    ch = changes(bronze_df, spec).withColumn("_from", F.col("_seq.ts_ms"))
    bucket = F.floor(F.col("_from") / F.lit(bucket_ms))
    versions = next_in_group(ch, spec.key, "_seq", "_from", "_to", bucket)
    img = F.coalesce(F.col("after"), F.col("before"))
    cols = [versions[spec.key], F.col("op"),
            F.col("_from").alias("valid_from_ms"), F.col("_to").alias("valid_to_ms")]
    cols += [oc.convert(img[oc.source]).alias(oc.name) for oc in spec.columns if oc.name != spec.key]
    cols.append((F.col("op") == specs.DELETE_OP).alias("_deleted"))
    return versions.select(*cols)
