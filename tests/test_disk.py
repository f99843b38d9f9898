"""What the streams leave on disk: no second copies, dense logs, shuffle files of one pass at a time."""

import datetime as dt
import glob
import os
import time

import pyarrow.parquet as pq
import pytest

from changefold import specs
from changefold.plans.catalogue import QUERIES
from changefold.session import SHUFFLE_CLEANUP, shuffles_freed
from changefold.sources import fixtures, store
from changefold.streaming import jobs
from changefold.streaming.config import StreamConfig

ORD, ITM = specs.ORDERS, specs.ORDER_ITEMS


def _tables(spark, path, n=60):
    """``n`` orders of one to three lines each."""
    day = dt.date(2024, 1, 1)
    orders = [(k, k % 7, "FOP"[k % 3], 10.0 * k, day + dt.timedelta(days=k % 20)) for k in range(n)]
    lines = [(k, (k * 3 + i) % 11, k % 5, i, float(1 + (k + i) % 9), 1.5 * k + i, 0.0, 0.0, "N", "O",
              dt.datetime(2024, 2, 1 + k % 20)) for k in range(n) for i in range(1 + k % 3)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                  "o_orderdate date").write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                                 "l_linestatus string, l_shipdate timestamp").write.parquet(f"{path}/lineitem.parquet")
    return path


def _rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def _streamed(spark, base, **kw):
    """Snapshot and changes of both tables, in silver."""
    cfg = StreamConfig(base_path=base, message_path=f"{base}/messages", available_now=True, **kw)
    tables = _tables(spark, f"{base}/tables")
    for spec in (ORD, ITM):
        store.write_messages(fixtures.to_messages(fixtures.table_changes(spark, tables, spec)).drop("_batch_id"),
                             cfg.message_path)
        jobs.run_once(spark, cfg, spec)
    return cfg


@pytest.mark.parametrize("name", ["kpi_maintained", "open_orders_stream"])
def test_no_message_is_kept_beside_the_logs(spark, tmp_base, monkeypatch, name):
    tables = _tables(spark, f"{tmp_base}/tables")
    monkeypatch.setattr("changefold.plans.catalogue.fresh_dir", lambda *_: f"{tmp_base}/run")
    assert QUERIES[name](spark, tables).count() > 0
    found = glob.glob(f"{tmp_base}/run/**/*.parquet", recursive=True)
    assert any("/bronze/order_items/" in f for f in found) and any("/silver/orders/" in f for f in found)
    assert [f for f in found if "/arrivals/" in f or "/messages/" in f] == []


def test_messages_go_after_raw_took_them_and_later_ones_are_read(spark, tmp_base):
    cfg = StreamConfig(base_path=tmp_base, message_path=f"{tmp_base}/messages", available_now=True)
    tables = _tables(spark, f"{tmp_base}/tables")
    msgs = fixtures.to_messages(fixtures.snapshot_changes(fixtures.order_rows(spark, tables), ORD)).drop("_batch_id")
    for i, part in enumerate(("offset < 25", "offset >= 25")):
        store.write_messages(msgs.filter(part), cfg.message_path)
        jobs.run_once(spark, cfg, ORD, drop_messages=True)
        assert not store.exists(spark, store.topic_path(cfg.message_path, ORD.topic))
        assert jobs.read_silver(spark, cfg, ORD).count() == (25, 60)[i]


def test_logs_are_written_dense(spark, tmp_base):
    cfg = _streamed(spark, tmp_base)
    jobs.refresh_gold(spark, cfg, 0)
    for path in (store.topic_path(cfg.message_path, ITM.topic), cfg.bronze_path(ITM.name), cfg.silver_path(ITM.name),
                 cfg.gold_path):
        files = [f for f in glob.glob(f"{path}/**/*.parquet", recursive=True) if pq.read_metadata(f).num_rows]
        assert files
        for f in files:
            group = pq.read_metadata(f).row_group(0)
            assert {group.column(i).compression for i in range(group.num_columns)} == {"ZSTD"}, f


@pytest.mark.parametrize("compacted", [False, True])
def test_full_refresh_in_passes_equals_one_pass(spark, tmp_base, compacted):
    cfg = _streamed(spark, tmp_base, gold_slices=3, gold_slices_from_mb=0)
    if compacted:
        for spec in (ORD, ITM):
            jobs.compact_silver(spark, cfg, spec, 0, grace_batches=0)
    metrics = jobs.refresh_gold(spark, cfg, 0)
    want = _rows(jobs._full_gold(spark, cfg))
    assert want and _rows(jobs.read_gold(spark, cfg)) == want
    assert metrics["rows"] == len(want)
    assert not os.path.exists(cfg.gold_orders_path)
    # Again over the same version: replaced, not added to.
    jobs.refresh_gold(spark, cfg, 0)
    assert _rows(jobs.read_gold(spark, cfg)) == want


def test_version_counts_only_after_its_last_pass(spark, tmp_base, monkeypatch):
    cfg = _streamed(spark, tmp_base, gold_slices=3, gold_slices_from_mb=0)
    real, done = jobs._write_gold, []

    def fails_last(*a, **kw):
        if len(done) == 2:
            raise OSError("lost")
        done.append(1)
        return real(*a, **kw)

    monkeypatch.setattr(jobs, "_write_gold", fails_last)
    with pytest.raises(OSError):
        jobs.refresh_gold(spark, cfg, 0)
    assert jobs.read_gold(spark, cfg) is None
    assert not os.path.exists(cfg.gold_orders_path)
    monkeypatch.setattr(jobs, "_write_gold", real)
    jobs.refresh_gold(spark, cfg, 0)
    assert _rows(jobs.read_gold(spark, cfg)) == _rows(jobs._full_gold(spark, cfg))


def test_shuffle_files_go_with_their_execution(spark, tmp_base):
    dirs = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def files():
        return {f for d in dirs for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}

    spark.range(10).repartition(3).write.parquet(f"{tmp_base}/kept")
    before, setting = files(), spark.conf.get(SHUFFLE_CLEANUP, None)
    with shuffles_freed(spark):
        held = spark.range(1000).repartition(4, "id").groupBy("id").count()
        held.write.parquet(f"{tmp_base}/out")
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    for _ in range(100):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before
    assert spark.read.parquet(f"{tmp_base}/out").count() == held.count() == 1000
