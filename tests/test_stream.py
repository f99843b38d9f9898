"""Structured Streaming gives the batch result; restarts and replays are safe."""

import time

import pytest

from pyspark.sql import functions as F

from changefold import specs
from changefold.operators import fold, gold, ingest
from changefold.sources import fixtures, store
from changefold.streaming import jobs, metrics
from changefold.streaming.config import StreamConfig

from conftest import SF0001

EV = specs.USER_EVENTS


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _batch_state(spark):
    bronze = ingest.bronze(ingest.classify(fixtures.user_event_messages(spark, SF0001), EV))
    return _rows(fold.current_state(bronze, EV))


def _write_messages(spark, path, batch_filter=None, files=4):
    m = fixtures.user_event_messages(spark, SF0001)
    if batch_filter is not None:
        m = m.filter(batch_filter)
    store.write_messages(m.repartitionByRange(files, "offset").drop("_batch_id"), path)


def _cfg(base, **kw):
    kw.setdefault("message_files_per_trigger", 1)
    kw.setdefault("max_files_per_trigger", 1)
    return StreamConfig(base_path=base, message_path=f"{base}/messages", available_now=True, **kw)


def test_stream_equals_batch(spark, tmp_base):
    cfg = _cfg(tmp_base)
    _write_messages(spark, cfg.message_path)
    jobs.run_once(spark, cfg, EV)
    assert _rows(jobs.read_silver(spark, cfg, EV)) == _batch_state(spark)
    # several micro-batches really ran
    assert spark.read.parquet(cfg.silver_path(EV.name)).select("_batch_id").distinct().count() > 1


def test_restart_from_checkpoint(spark, tmp_base):
    cfg = _cfg(tmp_base)
    _write_messages(spark, cfg.message_path, F.col("offset") < 500)
    jobs.run_once(spark, cfg, EV)
    first = spark.read.parquet(cfg.bronze_path(EV.name)).count()
    _write_messages(spark, cfg.message_path, F.col("offset") >= 500)
    jobs.run_once(spark, cfg, EV)  # resumes from the checkpoints
    assert spark.read.parquet(cfg.bronze_path(EV.name)).count() > first
    assert _rows(jobs.read_silver(spark, cfg, EV)) == _batch_state(spark)


def test_replayed_batch_is_idempotent(spark, tmp_base):
    cfg = _cfg(tmp_base)
    msgs = fixtures.user_event_messages(spark, SF0001, damage=True).drop("_batch_id")
    jobs.process_raw_batch(msgs, 5, EV, cfg)
    n_bronze = spark.read.parquet(cfg.bronze_path(EV.name)).count()
    n_dead = spark.read.parquet(cfg.dead_letter_path(EV.name)).count()
    jobs.process_raw_batch(msgs, 5, EV, cfg)  # the same batch again
    assert spark.read.parquet(cfg.bronze_path(EV.name)).count() == n_bronze
    assert spark.read.parquet(cfg.dead_letter_path(EV.name)).count() == n_dead > 0
    bronze = spark.read.parquet(cfg.bronze_path(EV.name))
    jobs.process_silver_batch(bronze, 5, EV, cfg)
    jobs.process_silver_batch(bronze, 5, EV, cfg)
    n_keys = fold.changes(bronze, EV).select("user_id").distinct().count()
    assert spark.read.parquet(cfg.silver_path(EV.name)).count() == n_keys
    expected = _rows(fold.current_state(bronze.drop("_batch_id"), EV))
    assert _rows(jobs.read_silver(spark, cfg, EV)) == expected


def test_stateful_silver_stream(spark, tmp_base):
    cfg = _cfg(tmp_base)
    _write_messages(spark, cfg.message_path)
    q = jobs.start_raw(spark, cfg, EV)
    q.awaitTermination()
    q = jobs.start_silver_stateful(spark, cfg, EV)
    q.awaitTermination()
    assert q.exception() is None
    with open(f"{cfg.checkpoint('silver_stateful', EV.name)}/offsets/0") as fh:
        assert "RocksDBStateStoreProvider" in fh.read()
    assert _rows(jobs.read_silver(spark, cfg, EV)) == _batch_state(spark)


def test_silver_writers_do_not_share_a_log(spark, tmp_base):
    cfg = _cfg(f"{tmp_base}/a")
    _write_messages(spark, cfg.message_path)
    jobs.run_once(spark, cfg, EV)
    last = spark.read.parquet(cfg.silver_path(EV.name)).agg(F.max("_batch_id")).first()[0]
    jobs.compact_silver(spark, cfg, EV, last, grace_batches=0)
    with pytest.raises(RuntimeError, match="belongs to the silver query"):
        jobs.start_silver_stateful(spark, cfg, EV)
    lost = _cfg(f"{tmp_base}/a")  # the log and base remain, the checkpoint is another's or gone
    object.__setattr__(lost, "checkpoint", lambda layer, table: f"{tmp_base}/other/{layer}/{table}")
    with pytest.raises(RuntimeError, match="was not written by silver_stateful"):
        jobs.start_silver_stateful(spark, lost, EV)
    assert _rows(jobs.read_silver(spark, cfg, EV)) == _batch_state(spark)


def test_stateful_silver_goes_on_after_its_own_compaction(spark, tmp_base):
    cfg = _cfg(tmp_base)
    _write_messages(spark, cfg.message_path)
    for start in (jobs.start_raw, jobs.start_silver_stateful):
        start(spark, cfg, EV).awaitTermination()
    last = spark.read.parquet(cfg.silver_path(EV.name)).agg(F.max("_batch_id")).first()[0]
    jobs.compact_silver(spark, cfg, EV, last, grace_batches=0)
    q = jobs.start_silver_stateful(spark, cfg, EV)
    q.awaitTermination()
    assert q.exception() is None
    assert _rows(jobs.read_silver(spark, cfg, EV)) == _batch_state(spark)
    with pytest.raises(RuntimeError, match="belongs to the silver_stateful query"):
        jobs.start_silver(spark, cfg, EV)


def test_compaction_keeps_state(spark, tmp_base):
    cfg = _cfg(tmp_base)
    _write_messages(spark, cfg.message_path)
    jobs.run_once(spark, cfg, EV)
    before = _rows(jobs.read_silver(spark, cfg, EV))
    last = spark.read.parquet(cfg.silver_path(EV.name)).agg(F.max("_batch_id")).first()[0]
    jobs.compact_silver(spark, cfg, EV, last, grace_batches=1)
    assert spark.read.parquet(cfg.silver_path(EV.name)).select("_batch_id").distinct().count() == 2
    assert _rows(jobs.read_silver(spark, cfg, EV)) == before
    jobs.compact_silver(spark, cfg, EV, last, grace_batches=0)
    assert spark.read.parquet(cfg.silver_path(EV.name)).select("_batch_id").distinct().count() == 1
    assert _rows(jobs.read_silver(spark, cfg, EV)) == before


def test_gold_from_streamed_silver(spark, tmp_base):
    cfg = _cfg(tmp_base, max_files_per_trigger=100, message_files_per_trigger=100)
    store.write_messages(fixtures.all_topic_messages(spark, SF0001).drop("_batch_id"), cfg.message_path)
    for t in ("orders", "order_items"):
        jobs.run_once(spark, cfg, specs.REGISTRY[t])
    q = jobs.start_gold(spark, cfg)
    q.awaitTermination()
    assert q.exception() is None
    got = _rows(jobs.read_gold(spark, cfg))
    want = _rows(gold.open_orders(fixtures.silver_orders(spark, SF0001), fixtures.silver_order_items(spark, SF0001)))
    assert got == want and len(got) == 4005


def test_progress_listener_records_batches(spark, tmp_base):
    rec = metrics.install(spark)
    try:
        cfg = _cfg(tmp_base)
        _write_messages(spark, cfg.message_path)
        jobs.run_once(spark, cfg, EV)
        for _ in range(50):
            if rec.rows():
                break
            time.sleep(0.2)
        rows = rec.rows()
        assert rows and {"input_rows_per_second", "batch_duration_ms", "offsets_behind"} <= set(rows[0])
        assert rec.frame(spark).count() >= len(rows)
    finally:
        spark.streams.removeListener(rec)


def test_bootstrap_creates_empty_table(spark, tmp_base):
    path = f"{tmp_base}/empty"
    assert not store.exists(spark, path)
    store.bootstrap(spark, path, jobs.bronze_schema(EV), ("_batch_id",))
    assert store.exists(spark, path)
    assert spark.read.schema(jobs.bronze_schema(EV)).parquet(path).count() == 0


def test_export_orders_by_order_date(spark, tmp_base):
    cfg = _cfg(tmp_base, max_files_per_trigger=100, message_files_per_trigger=100)
    store.write_messages(fixtures.to_messages(fixtures.snapshot_changes(
        fixtures.order_rows(spark, SF0001), specs.ORDERS)).drop("_batch_id"), cfg.message_path)
    jobs.run_once(spark, cfg, specs.ORDERS)
    out = jobs.export_silver(spark, cfg, specs.ORDERS, f"{tmp_base}/export/orders")
    import os
    assert any(d.startswith("order_date=") for d in os.listdir(f"{tmp_base}/export/orders"))
    want = fixtures.silver_orders(spark, SF0001).select("order_id", "order_date", "status")
    assert _rows(out.select("order_id", "order_date", "status")) == _rows(want)


def test_bootstrap_all_and_metrics_table(spark, tmp_base):
    cfg = _cfg(tmp_base)
    jobs.bootstrap_all(spark, cfg)
    for name in specs.REGISTRY:
        assert store.exists(spark, cfg.bronze_path(name)) and store.exists(spark, cfg.silver_path(name))
    # an empty silver log reads as an empty table
    assert jobs.read_silver(spark, cfg, specs.ORDERS).count() == 0
    rec = metrics.ProgressRecorder()
    rec._rows.append({"query": "q", "batch_id": 0, "timestamp": "t", "num_input_rows": 1,
                      "input_rows_per_second": 1.0, "processed_rows_per_second": 1.0,
                      "batch_duration_ms": 5, "offsets_behind": 0.0})
    assert rec.flush(spark, f"{tmp_base}/metrics") == 1
    assert spark.read.parquet(f"{tmp_base}/metrics").count() == 1


def test_crash_after_write_then_restart_has_no_duplicates(spark, tmp_base):
    """Batch 1 writes its bronze partition, then the query dies before the
    checkpoint commits it.  On restart Spark re-runs batch 1 with the same
    input; the partition is overwritten, not appended."""
    cfg = _cfg(tmp_base)
    _write_messages(spark, cfg.message_path)
    crashed = {"done": False}

    def flaky(df, bid):
        jobs.process_raw_batch(df, bid, EV, cfg)
        if bid == 1 and not crashed["done"]:
            crashed["done"] = True
            raise RuntimeError("simulated crash after the write")

    q = (jobs.message_stream(spark, cfg, EV).writeStream.foreachBatch(flaky)
         .option("checkpointLocation", cfg.checkpoint("raw", EV.name))
         .trigger(availableNow=True).start())
    try:
        q.awaitTermination()
    except Exception:
        pass
    assert crashed["done"] and q.exception() is not None
    jobs.run_once(spark, cfg, EV)  # restart raw from its checkpoint, then silver
    bronze = spark.read.parquet(cfg.bronze_path(EV.name))
    assert bronze.count() == bronze.select("offset").distinct().count() == 1000
    assert _rows(jobs.read_silver(spark, cfg, EV)) == _batch_state(spark)


@pytest.mark.parametrize("limit,mode", [(1_000_000, "incremental"), (1, "full")])
def test_gold_refreshes_on_item_only_changes(spark, tmp_base, limit, mode):
    cfg = _cfg(tmp_base, max_files_per_trigger=100, message_files_per_trigger=100, gold_delta_limit=limit)
    orders = fixtures.to_messages(fixtures.snapshot_changes(fixtures.order_rows(spark, SF0001), specs.ORDERS))
    store.write_messages(orders.drop("_batch_id"), cfg.message_path)
    jobs.run_once(spark, cfg, specs.ORDERS)
    q = jobs.start_gold(spark, cfg)
    q.awaitTermination()
    assert jobs.read_gold(spark, cfg).count() == 0  # no items yet
    items = fixtures.to_messages(fixtures.snapshot_changes(fixtures.order_item_rows(spark, SF0001),
                                                           specs.ORDER_ITEMS))
    store.write_messages(items.drop("_batch_id"), cfg.message_path)
    jobs.run_once(spark, cfg, specs.ORDER_ITEMS)  # only the items log changes
    q = jobs.start_gold(spark, cfg)
    q.awaitTermination()
    assert jobs.read_gold(spark, cfg).count() == 4005
    assert jobs.GOLD_METRICS[-1]["mode"] == mode  # above the delta limit: full recompute


def test_compaction_inside_the_stream(spark, tmp_base):
    cfg = _cfg(tmp_base, compact_every=2)
    _write_messages(spark, cfg.message_path, files=8)
    jobs.run_once(spark, cfg, EV)
    batches = sorted(r[0] for r in spark.read.parquet(cfg.silver_path(EV.name)).select("_batch_id").distinct().collect())
    assert batches == [4, 5, 6, 7]  # 8 micro-batches; compactions at 2, 4, 6 with a grace of 2
    assert store.complete_versions(spark, cfg.silver_base_path(EV.name)) == [4, 6]
    assert _rows(jobs.read_silver(spark, cfg, EV)) == _batch_state(spark)
    # base v=6 + log batch 7: the newer keys are broadcast, the base is not shuffled
    from test_plans import plan
    p = plan(jobs.read_silver(spark, cfg, EV))
    assert "BroadcastHashJoin LeftAnti" in p and "BroadcastHashJoin LeftSemi" in p
    # above the limit the same read is one full merge, with the same result
    from dataclasses import replace
    full = jobs.read_silver(spark, replace(cfg, merge_delta_limit=0), EV)
    assert "BroadcastHashJoin LeftAnti" not in plan(full)
    assert _rows(full) == _batch_state(spark)


def test_run_all_records_metrics_table(spark, tmp_base):
    cfg = _cfg(tmp_base, max_files_per_trigger=100, message_files_per_trigger=100)
    store.write_messages(fixtures.all_topic_messages(spark, SF0001).drop("_batch_id"), cfg.message_path)
    rec = jobs.run_all(spark, cfg, tables=("orders", "order_items"), metrics_path=f"{tmp_base}/metrics",
                       flush_seconds=1)
    assert jobs.read_gold(spark, cfg).count() == 4005
    for _ in range(50):  # listener events arrive asynchronously
        if store.exists(spark, f"{tmp_base}/metrics"):
            break
        time.sleep(0.2)
        rec.flush(spark, f"{tmp_base}/metrics")
    names = {r.query for r in spark.read.parquet(f"{tmp_base}/metrics").select("query").distinct().collect()}
    assert names & {"raw_orders", "raw_order_items", "silver_orders", "silver_order_items", "gold_open_orders"}


def test_all_four_tables_through_the_streams(spark, tmp_base):
    cfg = _cfg(tmp_base, max_files_per_trigger=100, message_files_per_trigger=100)
    store.write_messages(fixtures.all_topic_messages(spark, SF0001).drop("_batch_id"), cfg.message_path)
    jobs.run_all(spark, cfg)  # orders, customers, products, order_items + gold
    cust = jobs.read_silver(spark, cfg, specs.CUSTOMERS)
    negative = fixtures.read_table(spark, SF0001, "customer").filter("c_acctbal < 0").count()
    assert cust.count() == fixtures.read_table(spark, SF0001, "customer").count()
    assert cust.filter("_deleted AND NOT is_active").count() == negative > 0
    prod = {r.product_id: float(r.unity_price) for r in jobs.read_silver(spark, cfg, specs.PRODUCTS).collect()}
    want = {r.p_partkey: round(r.p_retailprice, 2)
            for r in fixtures.read_table(spark, SF0001, "part").collect()}
    assert prod == want  # both wire forms of the price decode to the same value
    assert jobs.read_gold(spark, cfg).count() == 4005


def test_compaction_purges_old_soft_deletes(spark, tmp_base):
    cfg = _cfg(tmp_base)
    _write_messages(spark, cfg.message_path)
    jobs.run_once(spark, cfg, EV)
    before = jobs.read_silver(spark, cfg, EV).collect()  # read before the old log is deleted
    deleted = [r for r in before if r._deleted]
    assert deleted
    ms = {r.user_id: int(r.updated_at.timestamp() * 1000) for r in deleted}
    cutoff = sorted(ms.values())[len(ms) // 2]  # purge the older half
    last = spark.read.parquet(cfg.silver_path(EV.name)).agg(F.max("_batch_id")).first()[0]
    jobs.compact_silver(spark, cfg, EV, last, grace_batches=0, purge_deleted_before_ms=cutoff)
    after = {r.user_id for r in jobs.read_silver(spark, cfg, EV).collect()}
    purged = {k for k, v in ms.items() if v < cutoff}
    assert purged and not (purged & after)
    assert after == {r.user_id for r in before} - purged


def test_compactions_of_the_stream_purge(spark, tmp_base):
    """With ``purge_deleted_after_days`` the stream's own compactions drop keys that were deleted long ago."""
    cfg = _cfg(tmp_base, compact_every=2, purge_deleted_after_days=1)
    _write_messages(spark, cfg.message_path)
    jobs.run_once(spark, cfg, EV)
    base, newer, version = jobs.silver_parts(spark, cfg, EV)
    assert version is not None and base.filter("_last_op = 'd'").isEmpty() and not base.isEmpty()
    kept = {r.user_id for r in jobs.read_silver(spark, cfg, EV).collect()}
    batch = fold.current_state(ingest.bronze(ingest.classify(fixtures.user_event_messages(spark, SF0001), EV)), EV)
    assert {r.user_id for r in batch.filter("NOT _deleted").collect()} <= kept
