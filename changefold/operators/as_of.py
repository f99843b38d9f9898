"""Time travel from a base: the silver table as it was at a time, from folded states kept for an earlier time and the
newer part of the log alone.

A base for event time ``b`` holds the folded state of every key from all events up to ``b`` that had arrived up to
batch ``n``, and an index of those batches: the event times each spans.  The state at ``t >= b`` merges

* the base,
* of the indexed batches, events in ``(b, t]``: only batches that reach beyond ``b`` can have any,
* of batches that arrived after ``n``, events up to ``t``, late ones before ``b`` included.

The batches are found by a join of the log with the index on its partition column, so Spark prunes the other
partitions at run time; their files are never opened.  Merging is the fold's, so an event in the base and in the
tail would change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefold.operators import fold
from changefold.sources import store
from changefold.specs import TableSpec

BATCH = store.BATCH_COLUMN


def time_index(bronze_df: DataFrame) -> DataFrame:
    """One row per batch: the event times that it spans and its number of events."""
    return bronze_df.groupBy(BATCH).agg(F.min("ts_ms").alias("from_ms"), F.max("ts_ms").alias("to_ms"),
                                        F.count(F.lit(1)).alias("events"))


def write_base(bronze_df: DataFrame, spec: TableSpec, path: str, base_ms: int) -> int:
    """Keep the states at ``base_ms`` of everything that has arrived, and the index of its batches, below ``path``;
    returns the last batch (-1: none).  The index is written last: without it a base is not used."""
    last = bronze_df.agg(F.max(BATCH)).first()[0]
    last = -1 if last is None else last
    arrived = bronze_df.filter(F.col(BATCH) <= last)
    events = fold.changes(arrived.filter(F.col("ts_ms") <= F.lit(base_ms)).drop(BATCH), spec)
    for name, df in (("states", fold.fold_changes(events, spec)), ("index", time_index(arrived))):
        df.write.mode("overwrite").parquet(f"{path}/{name}/base_ms={base_ms}/base_batch={last}")
    return last


def newest_base(spark: SparkSession, path: str, as_of_ms: int) -> tuple[int, int] | None:
    """(time, last batch) of the latest base not after ``as_of_ms``, of equal times the one with most batches."""
    found = []
    for ms in store.folders(spark, f"{path}/index", "base_ms"):
        if ms <= as_of_ms:
            at = f"{path}/index/base_ms={ms}"
            found += [(ms, n) for n in store.folders(spark, at, "base_batch")
                      if store.finished(spark, f"{at}/base_batch={n}")]
    return max(found, default=None)


def tail(bronze_df: DataFrame, index: DataFrame, base_ms: int, base_batch: int, as_of_ms: int) -> DataFrame:
    """The events that the base does not hold, up to ``as_of_ms``."""
    reaching = index.filter((F.col("to_ms") > F.lit(base_ms)) & (F.col("from_ms") <= F.lit(as_of_ms))).select(BATCH)
    upto = F.col("ts_ms") <= F.lit(as_of_ms)
    indexed = (bronze_df.filter((F.col(BATCH) <= F.lit(base_batch)) & upto & (F.col("ts_ms") > F.lit(base_ms)))
               .join(reaching, BATCH, "left_semi"))
    later = bronze_df.filter((F.col(BATCH) > F.lit(base_batch)) & upto)
    return indexed.unionByName(later.select(*indexed.columns))


def state_as_of(bronze_df: DataFrame, spec: TableSpec, path: str, as_of_ms: int) -> DataFrame:
    """The silver table at ``as_of_ms`` from the newest base below ``path``; without one the whole log is folded."""
    spark = bronze_df.sparkSession
    base = newest_base(spark, path, as_of_ms)
    if base is None:
        return fold.state_as_of(bronze_df.drop(BATCH), spec, as_of_ms)
    at = "base_ms={}/base_batch={}".format(*base)
    states = spark.read.parquet(f"{path}/states/{at}")
    events = tail(bronze_df, spark.read.parquet(f"{path}/index/{at}"), *base, as_of_ms).drop(BATCH)
    newer = fold.event_states(fold.changes(events, spec), spec)
    return fold.materialize(fold.merge_states(states.unionByName(newer), spec), spec)
