"""Spark side of every registered query: ``(spark, sf_dir) -> DataFrame``.

Each query reads the driver's tables (through ``sources.fixtures``) and
runs the engine's operators on them.  Output columns are plain
bigint/int/double/string/date/boolean so that results compare by value with
the DuckDB oracle; timestamps are given as epoch milliseconds.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefold import specs
from changefold.functions import convert
from changefold.operators import as_of, fold, gold, history, ingest, kpis, layout, maintain, rollup
from changefold.session import fresh_dir, prepare, shuffles_freed
from changefold.sources import fixtures, store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return register


# --- gold and KPIs ---------------------------------------------------------

def open_orders_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.open_orders(fixtures.silver_orders(spark, sf_dir),
                            fixtures.silver_order_items(spark, sf_dir))


@query("open_orders")
def q_open_orders(spark, sf_dir):
    """Flat open-orders table from the silver orders and order_items."""
    return open_orders_of(spark, sf_dir)


def _kpi(name: str, fn):
    def q(spark, sf_dir):
        return fn(open_orders_of(spark, sf_dir))
    q.__doc__ = f"KPI ``{fn.__name__}`` over the gold table built from the silver snapshots."
    return query(name)(q)


for _name, _fn in kpis.ALL.items():
    _kpi(_name, _fn)


@query("open_orders_bucketed")
def q_open_orders_bucketed(spark, sf_dir):
    """The gold join over silver tables kept in buckets of order_id: neither side is shuffled."""
    base = fresh_dir(spark, "bucketed")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = "changefold_" + base.rsplit("-", 1)[1]
    orders, items = (store.write_bucketed(df, f"{name}_{part}", f"{base}/{part}", "order_id", n) for part, df in (
        ("orders", fixtures.silver_orders(spark, sf_dir)), ("items", fixtures.silver_order_items(spark, sf_dir))))
    return gold.open_orders(orders, items)


# --- change capture over the events log ------------------------------------

EVENTS = specs.USER_EVENTS
AS_OF_MS = 1705276800000  # 2024-01-15 00:00:00 UTC
PURGE_AS_OF = "2024-07-30 12:00:00"


def classified_events(spark, sf_dir, damage=False):
    return ingest.classify(fixtures.user_event_messages(spark, sf_dir, damage=damage), EVENTS)


def events_bronze(spark, sf_dir, damage=False):
    return ingest.bronze(classified_events(spark, sf_dir, damage))


def present_state(silver):
    """Silver user_events rows with timestamps as epoch milliseconds."""
    return silver.select("user_id", "value", "props",
                         convert.timestamp_to_epoch_ms(F.col("updated_at")).alias("updated_at_ms"),
                         convert.timestamp_to_epoch_ms(F.col("created_at")).alias("created_at_ms"),
                         "_deleted")


@query("cdc_parse")
def q_cdc_parse(spark, sf_dir):
    """Encode events as JSON change messages, parse them back, flatten."""
    b = events_bronze(spark, sf_dir)
    return b.select("topic", "partition", "offset", "op", "ts_ms",
                    F.coalesce(F.col("after.user_id"), F.col("before.user_id")).alias("user_id"),
                    F.coalesce(F.col("after.value"), F.col("before.value")).alias("value"),
                    F.coalesce(F.col("after.props"), F.col("before.props")).alias("props"),
                    F.col("source.lsn").alias("lsn"))


@query("cdc_dead_letter")
def q_cdc_dead_letter(spark, sf_dir):
    """Damaged messages routed to the dead-letter layout with a reason."""
    dl = ingest.dead_letters(classified_events(spark, sf_dir, damage=True))
    return dl.select("topic", "partition", "offset", "dead_letter_reason", "dead_letter_batch_id")


@query("cdc_null_messages")
def q_cdc_null_messages(spark, sf_dir):
    """Null-valued messages are dropped but counted, per topic and batch."""
    return ingest.null_messages(fixtures.user_event_messages(spark, sf_dir, damage=True),
                                by=("topic", "_batch_id"))


@query("cdc_batch_metrics")
def q_cdc_batch_metrics(spark, sf_dir):
    """Per-batch valid / dead-letter / upsert / delete counts in one pass."""
    return ingest.batch_metrics(classified_events(spark, sf_dir, damage=True))


@query("cdc_latest_per_batch")
def q_cdc_latest_per_batch(spark, sf_dir):
    """Last event per (batch, key); deletes keyed by their before image."""
    return fold.latest_per_batch(events_bronze(spark, sf_dir), EVENTS)


@query("cdc_upserts")
def q_cdc_upserts(spark, sf_dir):
    return fold.upserts(events_bronze(spark, sf_dir), EVENTS)


@query("cdc_deletes")
def q_cdc_deletes(spark, sf_dir):
    return fold.deletes(events_bronze(spark, sf_dir), EVENTS)


@query("cdc_state")
def q_cdc_state(spark, sf_dir):
    """Replay: fold the whole change log into one current row per key."""
    return present_state(fold.current_state(events_bronze(spark, sf_dir), EVENTS))


@query("cdc_state_incremental")
def q_cdc_state_incremental(spark, sf_dir):
    """Fold each 1000-event batch, then merge the batch states."""
    return present_state(fold.incremental_state(events_bronze(spark, sf_dir), EVENTS))


@query("cdc_state_as_of")
def q_cdc_state_as_of(spark, sf_dir):
    """The state as of 2024-01-15 00:00 UTC (time travel by filter + fold)."""
    return present_state(fold.state_as_of(events_bronze(spark, sf_dir), EVENTS, AS_OF_MS))


BASE_MS = 1704672000000  # 2024-01-08 00:00:00 UTC


@query("state_as_of_from_base")
def q_state_as_of_from_base(spark, sf_dir):
    """The state as of 2024-01-15 from a base kept for 2024-01-08 and the newer part of the log: batches that
    ended before the base are not read."""
    base = fresh_dir(spark, "as-of")
    b = events_bronze(spark, sf_dir)
    b.repartition("_batch_id").write.partitionBy("_batch_id").parquet(f"{base}/bronze")
    log = spark.read.schema(b.schema).parquet(f"{base}/bronze")
    half = log.agg((F.max("_batch_id") / 2).cast("long")).first()[0]
    # The base is made when half of the log has arrived; the rest comes after it.
    as_of.write_base(log.filter(F.col("_batch_id") <= F.lit(half)), EVENTS, f"{base}/kept", BASE_MS)
    return present_state(as_of.state_as_of(log, EVENTS, f"{base}/kept", AS_OF_MS))


@query("cdc_history")
def q_cdc_history(spark, sf_dir):
    """Type-2 history: each event's version and its validity interval."""
    return history.history(events_bronze(spark, sf_dir), EVENTS)


@query("purge_deleted")
def q_purge_deleted(spark, sf_dir):
    """Drop rows soft-deleted more than 6 months before 2024-07-30 12:00 UTC."""
    silver = fold.current_state(events_bronze(spark, sf_dir), EVENTS)
    return present_state(maintain.purge_deleted(silver, PURGE_AS_OF))


# --- type conversions and snapshots of the order tables --------------------

@query("convert_dates")
def q_convert_dates(spark, sf_dir):
    """Epoch-day wire dates -> DATE, independent of the session time zone."""
    rows = fixtures.order_rows(spark, sf_dir)
    return rows.select("order_id",
                       convert.epoch_days_to_date(F.col("order_date")).alias("order_date"),
                       convert.epoch_days_to_date(F.col("delivery_date")).alias("delivery_date"))


@query("convert_timestamps")
def q_convert_timestamps(spark, sf_dir):
    """Epoch-millisecond wire times -> TIMESTAMP, rendered in UTC."""
    ev = fixtures.read_table(spark, sf_dir, "events")
    ms = convert.ntz_to_epoch_ms(F.col("ts"))
    ts = convert.epoch_ms_to_timestamp(ms)
    return ev.select("event_id", ms.alias("ts_ms"),
                     F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS").alias("ts_text"))


@query("convert_decimals")
def q_convert_decimals(spark, sf_dir):
    """Prices in both wire forms (text, scale + base64 bytes) -> DECIMAL(10,2)."""
    rows = fixtures.product_rows(spark, sf_dir)
    form = F.when(F.trim(F.col("unity_price")).startswith("{"), "object").otherwise("text")
    return rows.select("product_id", form.alias("wire_form"),
                       convert.wire_decimal(F.col("unity_price")).cast("double").alias("unity_price"))


def snapshot_state(spark, rows, spec):
    msgs = fixtures.to_messages(fixtures.snapshot_changes(rows, spec))
    return fold.current_state(ingest.bronze(ingest.classify(msgs, spec)), spec)


@query("item_rename")
def q_item_rename(spark, sf_dir):
    """order_items snapshot through JSON + fold; ``quanity`` -> ``quantity``."""
    s = snapshot_state(spark, fixtures.order_item_rows(spark, sf_dir), specs.ORDER_ITEMS)
    return s.select("order_item_id", "order_id", "product_id", "quantity", "_deleted")


@query("orders_snapshot_state")
def q_orders_snapshot_state(spark, sf_dir):
    """orders snapshot through JSON + fold into the silver orders table."""
    s = snapshot_state(spark, fixtures.order_rows(spark, sf_dir), specs.ORDERS)
    return s.select("order_id", "order_date", "delivery_date", "customer_id", "status", "_deleted")


@query("orders_lifecycle_state")
def q_orders_lifecycle_state(spark, sf_dir):
    """Every order's create/update events, newest delivered first, folded
    into the silver orders table (incrementally, one batch per stage)."""
    msgs = fixtures.to_messages(fixtures.order_lifecycle_changes(spark, sf_dir))
    bronze = ingest.bronze(ingest.classify(msgs, specs.ORDERS))
    s = fold.incremental_state(bronze, specs.ORDERS)
    return s.select("order_id", "order_date", "delivery_date", "customer_id", "status",
                    convert.timestamp_to_epoch_ms(F.col("updated_at")).alias("updated_at_ms"),
                    convert.timestamp_to_epoch_ms(F.col("created_at")).alias("created_at_ms"), "_deleted")


@query("orders_history")
def q_orders_history(spark, sf_dir):
    """Type-2 history of every order's status from its lifecycle events."""
    msgs = fixtures.to_messages(fixtures.order_lifecycle_changes(spark, sf_dir))
    h = history.history(ingest.bronze(ingest.classify(msgs, specs.ORDERS)), specs.ORDERS)
    return h.select("order_id", "op", "status", "valid_from_ms", "valid_to_ms", "_deleted")


@query("kpi_by_date_status_end_to_end")
def q_kpi_end_to_end(spark, sf_dir):
    """KPI 1 from change messages: order lifecycles and item snapshots ->
    bronze -> silver folds -> open_orders -> open orders by date and status."""
    orders = fold.current_state(ingest.bronze(ingest.classify(
        fixtures.to_messages(fixtures.order_lifecycle_changes(spark, sf_dir)), specs.ORDERS)), specs.ORDERS)
    items = snapshot_state(spark, fixtures.order_item_rows(spark, sf_dir), specs.ORDER_ITEMS)
    return kpis.open_orders_by_date_status(gold.open_orders(orders, items))


@query("products_snapshot_state")
def q_products_snapshot_state(spark, sf_dir):
    """products snapshot (both price forms) through JSON + fold."""
    s = snapshot_state(spark, fixtures.product_rows(spark, sf_dir), specs.PRODUCTS)
    return s.select("product_id", "product_name", "barcode", F.col("unity_price").cast("double"),
                    "is_active", "_deleted")


@query("customers_snapshot_state")
def q_customers_snapshot_state(spark, sf_dir):
    """customers snapshot + deletes through JSON + fold (a delete deactivates)."""
    msgs = fixtures.to_messages(fixtures.customer_changes(spark, sf_dir))
    s = fold.current_state(ingest.bronze(ingest.classify(msgs, specs.CUSTOMERS)), specs.CUSTOMERS)
    return s.select("customer_id", "customer_name", "is_active", "customer_address",
                    convert.timestamp_to_epoch_ms(F.col("updated_at")).alias("updated_at_ms"), "_deleted")


@query("cdc_route_topics")
def q_cdc_route_topics(spark, sf_dir):
    """One message log with five topics: messages per (table, partition)."""
    return ingest.topic_counts(fixtures.all_topic_messages(spark, sf_dir))


@query("compact_clustered")
def q_compact_clustered(spark, sf_dir):
    """Rewrite silver orders clustered on (status, delivery_date); read back."""
    out = fresh_dir(spark, "compact-orders")
    t = maintain.compact(fixtures.silver_orders(spark, sf_dir), out, ["status", "delivery_date"])
    return t.select("order_id", "order_date", "delivery_date", "customer_id", "status", "_deleted")


@query("compact_zordered")
def q_compact_zordered(spark, sf_dir):
    """Rewrite silver orders along the curve over (status, delivery_date); read back."""
    out = fresh_dir(spark, "zorder-orders")
    t = maintain.compact(fixtures.silver_orders(spark, sf_dir), out, ["status", "delivery_date"], curve=True)
    return t.select("order_id", "order_date", "delivery_date", "customer_id", "status", "_deleted")


# --- the same fold under Structured Streaming --------------------------------

def arrivals(spark, msgs, path, rounds):
    """Messages written to ``path`` as they come and read back in rounds of about equal size, by rising offset (null
    first).  Only the offsets are looked at to find the bounds, so the work of a task does not depend on the number of
    rounds."""
    with shuffles_freed(spark):
        msgs.write.options(**store.LOG_OPTIONS).parquet(path)
    staged = spark.read.parquet(path)
    cuts = staged.agg(F.percentile_approx("offset", [i / rounds for i in range(1, rounds)])).first()[0] or []
    place = F.lit(0)
    for cut in cuts:
        place += F.coalesce((F.col("offset") > cut).cast("int"), F.lit(0))
    return [staged.filter(place == i) for i in range(rounds)]


@query("cdc_state_stream")
def q_cdc_state_stream(spark, sf_dir):
    """events as broker messages in files -> raw stream -> bronze -> silver
    stream (one micro-batch per file, availableNow) -> merged silver state."""
    from changefold.streaming import jobs
    from changefold.streaming.config import StreamConfig

    base = fresh_dir(spark, "stream")
    cfg = StreamConfig(base_path=base, message_path=f"{base}/messages", available_now=True,
                       message_files_per_trigger=1)
    msgs = fixtures.user_event_messages(spark, sf_dir)
    store.write_messages(msgs.repartition("_batch_id").drop("_batch_id"), cfg.message_path)
    jobs.run_once(spark, cfg, EVENTS)
    return present_state(jobs.read_silver(spark, cfg, EVENTS))


@query("orders_state_stateful_stream")
def q_orders_state_stateful_stream(spark, sf_dir):
    """Order lifecycles as messages (newest first, 4 rounds) -> raw stream ->
    silver as a stateful streaming aggregation (state store, update mode)
    -> silver orders."""
    from changefold.streaming import jobs
    from changefold.streaming.config import StreamConfig

    base = fresh_dir(spark, "stream-stateful")
    # The default state store: a registered query leaves the session's
    # state-store setting alone.
    cfg = StreamConfig(base_path=base, message_path=f"{base}/messages", available_now=True, state_store="default")
    msgs = fixtures.to_messages(fixtures.order_lifecycle_changes(spark, sf_dir)).drop("_batch_id")
    # Offsets rise from the newest stage to the oldest.
    for arrived in arrivals(spark, msgs, f"{base}/arrivals", 4):
        store.write_messages(arrived, cfg.message_path)
        drained(jobs.start_raw(spark, cfg, specs.ORDERS))
    drained(jobs.start_silver_stateful(spark, cfg, specs.ORDERS))
    s = jobs.read_silver(spark, cfg, specs.ORDERS)
    return s.select("order_id", "order_date", "delivery_date", "customer_id", "status",
                    convert.timestamp_to_epoch_ms(F.col("updated_at")).alias("updated_at_ms"),
                    convert.timestamp_to_epoch_ms(F.col("created_at")).alias("created_at_ms"), "_deleted")


@query("open_orders_stream")
def q_open_orders_stream(spark, sf_dir):
    """orders and lineitem snapshots as broker messages arriving in two
    rounds (split by offset range); after each round the raw, silver and
    gold streams catch up, so the second gold refresh is incremental.
    Message files go once they are in bronze."""
    from changefold.streaming import jobs
    from changefold.streaming.config import StreamConfig

    base = fresh_dir(spark, "stream-gold")
    cfg = StreamConfig(base_path=base, message_path=f"{base}/messages", available_now=True)
    snaps = fixtures.to_messages(fixtures.snapshot_changes(fixtures.order_rows(spark, sf_dir), specs.ORDERS)) \
        .unionByName(fixtures.to_messages(
            fixtures.snapshot_changes(fixtures.order_item_rows(spark, sf_dir), specs.ORDER_ITEMS)))
    rounds = arrivals(spark, snaps.drop("_batch_id"), f"{base}/arrivals", 2)
    for arrived in rounds:
        store.write_messages(arrived, cfg.message_path)
        if arrived is rounds[-1]:
            store.drop(spark, f"{base}/arrivals")
        for spec in (specs.ORDERS, specs.ORDER_ITEMS):
            jobs.run_once(spark, cfg, spec, drop_messages=True)
        q = jobs.start_gold(spark, cfg)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"gold refresh failed: {q.exception()}")
    out = jobs.read_gold(spark, cfg)
    if out is None:
        raise RuntimeError("the gold stream wrote no version")
    return out


# --- updates and soft deletes on all four tables -----------------------------

def changed_bronze(spark, sf_dir, spec):
    msgs = fixtures.to_messages(fixtures.table_changes(spark, sf_dir, spec))
    return ingest.bronze(ingest.classify(msgs, spec))


def changed_state(spark, sf_dir, spec):
    """Snapshot, updates, deletes and re-inserts through JSON, folded batch by batch."""
    return fold.incremental_state(changed_bronze(spark, sf_dir, spec), spec)


def with_audit(silver, *columns):
    return silver.select(*columns, convert.timestamp_to_epoch_ms(F.col("updated_at")).alias("updated_at_ms"),
                         convert.timestamp_to_epoch_ms(F.col("created_at")).alias("created_at_ms"), "_deleted")


@query("orders_changed_state")
def q_orders_changed_state(spark, sf_dir):
    """orders after updates (a null status too), soft deletes and re-inserts."""
    return with_audit(changed_state(spark, sf_dir, specs.ORDERS),
                      "order_id", "order_date", "delivery_date", "customer_id", "status")


@query("order_items_changed_state")
def q_order_items_changed_state(spark, sf_dir):
    """order_items after updates, soft deletes and re-inserts."""
    return with_audit(changed_state(spark, sf_dir, specs.ORDER_ITEMS),
                      "order_item_id", "order_id", "product_id", "quantity")


@query("customers_changed_state")
def q_customers_changed_state(spark, sf_dir):
    """customers after updates and soft deletes, which deactivate."""
    return with_audit(changed_state(spark, sf_dir, specs.CUSTOMERS),
                      "customer_id", "customer_name", "is_active", "customer_address")


@query("products_changed_state")
def q_products_changed_state(spark, sf_dir):
    """products after price updates, soft deletes (deactivated) and re-inserts (active again)."""
    return with_audit(changed_state(spark, sf_dir, specs.PRODUCTS), "product_id", "product_name", "barcode",
                      F.col("unity_price").cast("double").alias("unity_price"), "is_active")


@query("orders_delete_keys")
def q_orders_delete_keys(spark, sf_dir):
    """Keys and layout dates of deleted orders, from their before images."""
    return fold.deletes(changed_bronze(spark, sf_dir, specs.ORDERS), specs.ORDERS)


@query("open_orders_changed")
def q_open_orders_changed(spark, sf_dir):
    """Gold over silver tables with soft-deleted orders and items, null statuses and moved dates."""
    return gold.open_orders(changed_state(spark, sf_dir, specs.ORDERS), changed_state(spark, sf_dir, specs.ORDER_ITEMS))


# --- KPIs kept with the gold versions ----------------------------------------

def drained(query):
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"{query.name} failed: {query.exception()}")


@query("kpi_maintained")
def q_kpi_maintained(spark, sf_dir):
    """Snapshots and two rounds of changes of orders and items through raw, silver and gold streams; the KPI counts
    follow each gold refresh by the changed orders alone.  All four KPIs as served, in one table.  Message files go once
    they are in bronze."""
    from changefold.streaming import jobs
    from changefold.streaming.config import StreamConfig

    base = fresh_dir(spark, "stream-kpis")
    cfg = StreamConfig(base_path=base, message_path=f"{base}/messages", available_now=True, maintain_kpis=True)
    both = (specs.ORDERS, specs.ORDER_ITEMS)
    msgs = fixtures.to_messages(fixtures.table_changes(spark, sf_dir, both[0])).unionByName(
        fixtures.to_messages(fixtures.table_changes(spark, sf_dir, both[1])))
    with shuffles_freed(spark):
        msgs.write.options(**store.LOG_OPTIONS).partitionBy("_batch_id").parquet(f"{base}/arrivals")
    for step in range(3):
        store.write_messages(spark.read.parquet(f"{base}/arrivals").filter(F.col("_batch_id") == step)
                             .drop("_batch_id"), cfg.message_path)
        store.drop(spark, f"{base}/arrivals/_batch_id={step}")
        for spec in both:
            jobs.run_once(spark, cfg, spec, drop_messages=True)
        drained(jobs.start_gold(spark, cfg))
    out = None
    columns = {"delivery_date": "date", "status": "string", "product_id": "long", "customer_id": "long"}
    for name, r in rollup.ROLLUPS.items():
        kpi = jobs.read_kpi(spark, cfg, name)
        if kpi is None:
            raise RuntimeError(f"the gold stream kept no {name}")
        part = kpi.select(F.lit(name).alias("kpi"), *[(F.col(c) if c in r.by else F.lit(None)).cast(t).alias(c)
                                                     for c, t in columns.items()], F.col(r.value).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


# --- one raw stream, redelivered messages, expiring state ---------------------

@query("raw_fanout_stream")
def q_raw_fanout_stream(spark, sf_dir):
    """All topics, and one that no table claims, through one raw stream: rows of each bronze table by operation and of
    each dead-letter table by reason."""
    from changefold.streaming import jobs
    from changefold.streaming.config import StreamConfig

    base = fresh_dir(spark, "stream-fanout")
    cfg = StreamConfig(base_path=base, message_path=f"{base}/messages", available_now=True, raw_fanout=True)
    msgs = fixtures.all_topic_messages(spark, sf_dir).unionByName(fixtures.unclaimed_messages(spark, sf_dir))
    store.write_messages(msgs.drop("_batch_id"), cfg.message_path)
    tables = tuple(specs.REGISTRY)
    drained(jobs.start_raw_fanout(spark, cfg, tables))
    out = None
    for name in (*tables, jobs.UNKNOWN):
        for sink, path, column in (("bronze", cfg.bronze_path(name), "op"),
                                   ("dead_letter", cfg.dead_letter_path(name), "dead_letter_reason")):
            if not store.batch_ids(spark, path):
                continue
            part = spark.read.parquet(path).groupBy(F.col(column).alias("kind")).agg(F.count(F.lit(1)).alias("messages"))
            part = part.select(F.lit(name).alias("table_name"), F.lit(sink).alias("sink"), "kind", "messages")
            out = part if out is None else out.unionByName(part)
    return out


@query("raw_dedup_stream")
def q_raw_dedup_stream(spark, sf_dir):
    """events delivered in two rounds, the second with every fifth message of the first again (and some twice in one
    round) through the raw stream: each message is one bronze row."""
    from changefold.streaming import jobs
    from changefold.streaming.config import StreamConfig

    base = fresh_dir(spark, "stream-dedup")
    cfg = StreamConfig(base_path=base, message_path=f"{base}/messages", available_now=True, dedup_horizon="400 days")
    msgs = fixtures.user_event_messages(spark, sf_dir)
    half = msgs.agg((F.max("_batch_id") / 2).cast("long")).first()[0]
    first, off = F.col("_batch_id") <= F.lit(half), F.col("offset")
    for own, again in ((first, first & (off % 7 == 0)), (~first, first & (off % 5 == 0) | ~first & (off % 7 == 0))):
        store.write_messages(msgs.filter(own).unionByName(msgs.filter(again)).drop("_batch_id"), cfg.message_path)
        drained(jobs.start_raw(spark, cfg, EVENTS))
    b = spark.read.schema(jobs.bronze_schema(EVENTS)).parquet(cfg.bronze_path(EVENTS.name))
    return b.select("partition", "offset", "op", "ts_ms", F.coalesce("after.user_id", "before.user_id").alias("user_id"))


@query("orders_state_expiring_stream")
def q_orders_state_expiring_stream(spark, sf_dir):
    """Order lifecycles in four rounds by their arrival, some days late, through the raw stream and the silver stream
    whose state expires by event time -> silver orders."""
    from changefold.streaming import jobs
    from changefold.streaming.config import StreamConfig

    base = fresh_dir(spark, "stream-expiring")
    cfg = StreamConfig(base_path=base, message_path=f"{base}/messages", available_now=True)
    msgs = fixtures.to_messages(fixtures.late_lifecycle_changes(spark, sf_dir))
    at = F.unix_millis("timestamp")
    low, high = msgs.agg(F.min(at), F.max(at)).first()
    step = max(-(-(high + 1 - low) // 4), 1)
    msgs.withColumn("_round", F.floor((at - low) / step)).write.partitionBy("_round").parquet(f"{base}/arrivals")
    for arrival in range(4):
        store.write_messages(spark.read.parquet(f"{base}/arrivals").filter(F.col("_round") == arrival)
                             .drop("_round", "_batch_id"), cfg.message_path)
        drained(jobs.start_raw(spark, cfg, specs.ORDERS))
        silver = jobs.start_silver_expiring(spark, cfg, specs.ORDERS)
        drained(silver)
        jobs.refuse_late(silver)
    return with_audit(jobs.read_silver(spark, cfg, specs.ORDERS),
                      "order_id", "order_date", "delivery_date", "customer_id", "status")


# --- layout by date, metrics --------------------------------------------------

@query("orders_touched_by_date")
def q_orders_touched_by_date(spark, sf_dir):
    """The rows of a date-partitioned orders table that the deletes of a change batch touch: only their dates are
    read."""
    out = fresh_dir(spark, "orders-by-date")
    table = layout.write(fixtures.silver_orders(spark, sf_dir), specs.ORDERS, out)
    changes = changed_bronze(spark, sf_dir, specs.ORDERS).filter(F.col("op") == specs.DELETE_OP)
    keys = layout.touched_keys(changes, specs.ORDERS)
    return layout.touched(table, keys, specs.ORDERS).select("order_id", "order_date", "delivery_date", "customer_id", "status")


@query("metric_alerts")
def q_metric_alerts(spark, sf_dir):
    """Slow batches, growing lag and dropped late rows in sliding windows of micro-batch metrics."""
    from changefold.streaming import metrics

    found = metrics.alerts(fixtures.batch_metrics_rows(spark, sf_dir), trigger_ms=17_000, window="1 day",
                           slide="6 hours", least_batches=2)
    return found.select("query", F.unix_millis("window_start").alias("window_start_ms"),
                        F.unix_millis("window_end").alias("window_end_ms"), "alert", "batches", "value")


@query("serving_kpis")
def q_serving_kpis(spark, sf_dir):
    """The gold table written as a serving table; KPI 3 by a scan of it."""
    out = fresh_dir(spark, "serving")
    open_orders_of(spark, sf_dir).write.parquet(out)
    return kpis.serve(spark.read.parquet(out), "kpi_pending_items_by_product")
