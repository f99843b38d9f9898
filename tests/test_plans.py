"""Physical plans: what a 100x larger input would rely on."""

from pyspark.sql import functions as F

from changefold import specs
from changefold.operators import fold, gold, ingest, kpis
from changefold.sources import fixtures

from conftest import SF0001

EV = specs.USER_EVENTS


def plan(df, mode="formatted"):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_fold_is_one_aggregate_no_window_no_python(spark, tmp_base):
    bronze_path = f"{tmp_base}/bronze"
    ingest.bronze(ingest.classify(fixtures.user_event_messages(spark, SF0001), EV)).write.parquet(bronze_path)
    state = fold.current_state(spark.read.parquet(bronze_path), EV)
    p = plan(state)
    assert "Window" not in p and "Cartesian" not in p and "BroadcastNestedLoop" not in p
    assert "EvalPython" not in p and "ArrowEvalPython" not in p
    # partial aggregate before the single shuffle on the key
    assert p.count("Arguments: hashpartitioning") == 1 and "hashpartitioning(user_id" in p
    assert "ReadSchema: struct<before:struct<user_id:bigint>" in p  # nested pruning
    assert "partial_max(" in p and "partial_min(" in p


def test_as_of_filter_reaches_the_scan(spark, tmp_base):
    bronze_path = f"{tmp_base}/bronze"
    ingest.bronze(ingest.classify(fixtures.user_event_messages(spark, SF0001), EV)).write.parquet(bronze_path)
    p = plan(fold.state_as_of(spark.read.parquet(bronze_path), EV, 1705276800000))
    assert "PushedFilters: [IsNotNull(ts_ms), LessThanOrEqual(ts_ms,1705276800000)]" in p


def test_gold_prunes_columns_and_has_no_forced_broadcast(spark):
    oo = gold.open_orders(fixtures.silver_orders(spark, SF0001), fixtures.silver_order_items(spark, SF0001))
    p = plan(oo)
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in p
    assert "broadcast" not in plan(oo, "extended").split("== Optimized Logical Plan ==")[0].lower()
    assert "PushedFilters" in p


def test_kpi_distinct_count_aggregates_map_side(spark):
    oo = gold.open_orders(fixtures.silver_orders(spark, SF0001), fixtures.silver_order_items(spark, SF0001))
    p = plan(kpis.open_orders_by_date_status(oo))
    assert "partial_count(distinct order_id" in p or "partial_count(order_id" in p
    assert "HashAggregate" in p


def test_items_window_shares_the_join_shuffle(spark):
    """The item-id window and the join both partition on the order key, so
    the items side is shuffled once when the join is not broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        oo = gold.open_orders(fixtures.silver_orders(spark, SF0001), fixtures.silver_order_items(spark, SF0001))
        p = plan(oo)
        assert p.count("Arguments: hashpartitioning(l_orderkey") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_history_has_no_window_over_the_bare_key(spark):
    from changefold.operators import history
    bronze = ingest.bronze(ingest.classify(fixtures.user_event_messages(spark, SF0001), EV))
    p = plan(history.history(bronze, EV))
    assert "hashpartitioning(user_id#" in p and "_bucket#" in p  # the log's window runs per (key, time bucket)
    assert p.count("Window") and "checkpoint" not in p.lower()


def test_each_message_is_parsed_once(spark):
    """from_json appears once in the optimized bronze plan, although the
    bronze filter reads many payload fields (Q11: one pass per batch)."""
    msgs = spark.createDataFrame([], "value binary, topic string, partition int, offset long, timestamp timestamp")
    b = ingest.bronze(ingest.classify(msgs, EV))
    opt = plan(b, "extended").split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert opt.count("from_json(") == 1


def test_states_carry_only_what_silver_needs(spark, tmp_base):
    """Audit fields that reach no silver row, and the key a second time, are neither read nor shuffled."""
    ingest.bronze(ingest.classify(fixtures.to_messages(fixtures.table_changes(spark, SF0001, specs.ORDERS)), specs.ORDERS)) \
        .write.parquet(f"{tmp_base}/bronze")
    bronze = spark.read.parquet(f"{tmp_base}/bronze")
    states = fold.event_states(fold.changes(bronze, specs.ORDERS), specs.ORDERS)
    assert states.schema["_up_img"].dataType.fieldNames() == ["order_date", "delivery_date", "customer_id", "status", "updated_at"]
    p = plan(fold.current_state(bronze, specs.ORDERS))
    read = next(line for line in p.splitlines() if "ReadSchema" in line)
    assert "updated_by" not in read and "created_by" not in read and "before:struct<order_id:bigint>" in read


def test_rounds_of_arrivals_are_no_tasks(spark, tmp_base):
    """Rounds split the messages by offset without bringing a round's messages into one task."""
    from changefold.plans.catalogue import arrivals

    msgs = spark.range(1, 4001, numPartitions=8).select(
        F.when(F.col("id") % 400 != 0, F.col("id")).alias("offset"), F.lit("x").alias("value"))
    found = [[r.offset for r in part.collect()] for part in arrivals(spark, msgs, f"{tmp_base}/arrivals", 4)]
    assert len(spark.read.parquet(f"{tmp_base}/arrivals").inputFiles()) == 8
    assert all(900 <= len(r) <= 1100 for r in found) and sum(map(len, found)) == 4000
    assert sum(o is None for o in found[0]) == 10 and all(o is not None for r in found[1:] for o in r)
    assert all(max(o or 0 for o in a) < min(b) for a, b in zip(found, found[1:]))
    none = arrivals(spark, msgs.filter("offset < 0"), f"{tmp_base}/empty", 2)
    assert [part.count() for part in none] == [0, 0]


def test_table_changes_rank_lines_once(spark):
    p = plan(fixtures.table_changes(spark, SF0001, specs.ORDER_ITEMS), "simple")
    assert p.count("Window [") == 1 and p.count("Exchange ") == 1


def test_batch_states_merge_without_another_sort(spark, tmp_base):
    """Batch states come sorted by key, so their merge sorts only after its shuffle."""
    spec = specs.ORDER_ITEMS
    ingest.bronze(ingest.classify(fixtures.to_messages(fixtures.table_changes(spark, SF0001, spec)), spec)) \
        .write.parquet(f"{tmp_base}/bronze")
    p = plan(fold.incremental_state(spark.read.parquet(f"{tmp_base}/bronze"), spec), "simple")
    assert p.count("SortAggregate(") == 4 and p.count("Sort [") == 3
