"""Time travel from a base equals a fold of the whole log, and reads only the newer part of it."""

import json
import random

import pytest
from pyspark.sql import functions as F

from changefold import specs
from changefold.operators import as_of, fold, ingest

from helpers import messages
from test_plans import plan

EV = specs.USER_EVENTS


def _log(spark, path, n=600, seed=3, late=0.1):
    """Batches of events in order of time, some of them late by any amount."""
    rnd = random.Random(seed)
    items = []
    for off in range(n):
        ts = rnd.randrange(off * 10 + 1) if rnd.random() < late else off * 10
        key, op = rnd.randrange(40), rnd.choice("cuurd")
        img = {"user_id": key, "value": float(off), "props": None}
        env = {"op": op, "ts_ms": ts, "source": {"lsn": off}, "before": img if op == "d" else None,
               "after": None if op == "d" else img}
        items.append((json.dumps(env), off, off // 50, key % 4))
    b = ingest.bronze(ingest.classify(messages(spark, items), EV))
    b.repartition("_batch_id").write.partitionBy("_batch_id").parquet(path)
    return spark.read.schema(b.schema).parquet(path)


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("late", [0.0, 0.3])
def test_equals_a_fold_of_the_whole_log(spark, tmp_base, late):
    log = _log(spark, f"{tmp_base}/bronze", late=late)
    kept = f"{tmp_base}/kept"
    assert as_of.newest_base(spark, kept, 10**9) is None
    assert _rows(as_of.state_as_of(log, EV, kept, 2500)) == _rows(fold.state_as_of(log, EV, 2500))
    # One base made early, of the first half of the batches, and one of all.
    assert as_of.write_base(log.filter("_batch_id <= 5"), EV, kept, 1000) == 5
    assert as_of.write_base(log, EV, kept, 4000) == 11
    assert as_of.newest_base(spark, kept, 3999) == (1000, 5) and as_of.newest_base(spark, kept, 4000) == (4000, 11)
    for t in (0, 999, 1000, 1001, 2500, 3999, 4000, 5990, 10**6):
        assert _rows(as_of.state_as_of(log, EV, kept, t)) == _rows(fold.state_as_of(log, EV, t)), t


def test_only_newer_partitions_are_read(spark, tmp_base):
    log = _log(spark, f"{tmp_base}/bronze", late=0.0)
    last = as_of.write_base(log, EV, f"{tmp_base}/kept", 4000)
    state = as_of.state_as_of(log, EV, f"{tmp_base}/kept", 5000)
    assert "dynamicpruning" in plan(state).lower()
    index = spark.read.parquet(f"{tmp_base}/kept/index/base_ms=4000/base_batch={last}")
    events = as_of.tail(log, index, 4000, last, 5000)
    assert {r._batch_id for r in events.select("_batch_id").distinct().collect()} == {8, 9, 10}
    # What the pruning join lets through of the indexed part: batches that reach beyond the base.
    reached = index.filter("to_ms > 4000 AND from_ms <= 5000")
    assert {r._batch_id for r in reached.collect()} == {8, 9, 10}


def test_an_unfinished_base_is_not_used(spark, tmp_base):
    log = _log(spark, f"{tmp_base}/bronze")
    as_of.write_base(log, EV, f"{tmp_base}/kept", 1000)
    log.limit(1).write.parquet(f"{tmp_base}/kept/states/base_ms=2000/base_batch=11")
    assert as_of.newest_base(spark, f"{tmp_base}/kept", 5000) == (1000, 11)


def test_empty_log(spark, tmp_base):
    log = _log(spark, f"{tmp_base}/bronze").filter("false")
    assert as_of.write_base(log, EV, f"{tmp_base}/kept", 1000) == -1
    assert as_of.state_as_of(log, EV, f"{tmp_base}/kept", 2000).collect() == []
