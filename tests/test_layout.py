"""Tables by date and by bucket: what a lookup or a join reads and moves."""

from pyspark.sql import functions as F

from changefold import specs
from changefold.operators import gold, ingest, layout
from changefold.sources import fixtures, store

from conftest import SF0001
from test_plans import plan

ORD = specs.ORDERS


def _rows(df):
    return sorted(map(str, df.collect()))


def test_only_touched_dates_are_read(spark, tmp_base):
    orders = fixtures.silver_orders(spark, SF0001)
    table = layout.write(orders, ORD, f"{tmp_base}/orders")
    assert _rows(table.select(*orders.columns)) == _rows(orders)
    changes = ingest.bronze(ingest.classify(fixtures.to_messages(fixtures.table_changes(spark, SF0001, ORD)), ORD))
    some = changes.filter((F.col("op") == "d") & (F.col("before.order_id") < 100))
    keys = layout.touched_keys(some, ORD)
    found = layout.touched(table, keys, ORD)
    assert "dynamicpruningexpression" in plan(found)
    assert _rows(found.select("order_id")) == _rows(orders.filter("order_id < 100 AND order_id % 10 IN (3, 6)").select("order_id"))
    found._jdf.queryExecution().executedPlan().executeCollect()
    read = int(str(found._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numPartitions").value())) \
        if "numPartitions" in str(found._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().keys()) else None
    dates = keys.select("order_date").distinct().count()
    assert read is None or read <= dates < table.select("order_date").distinct().count()


def test_both_dates_of_a_moved_row_are_touched(spark):
    day = 19_000
    img = lambda d: (1, d, d + 10, 7, "PENDING", 0, None, 0, None)
    schema = "before struct<{0}>, after struct<{0}>".format(
        "order_id:bigint,order_date:int,delivery_date:int,customer_id:bigint,status:string,updated_at:bigint,updated_by:bigint,created_at:bigint,created_by:bigint")
    moved = spark.createDataFrame([(img(day), img(day + 3)), (None, img(day)), (img(day), None)], schema)
    assert len(layout.touched_keys(moved, ORD).collect()) == 2


def test_bucketed_join_has_no_exchange(spark, tmp_base):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    orders, items = fixtures.silver_orders(spark, SF0001), fixtures.silver_order_items(spark, SF0001)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        tables = [store.write_bucketed(df, f"bucketed_{name}", f"{tmp_base}/{name}", "order_id", 4)
                  for name, df in (("orders", orders), ("items", items))]
        joined = gold.open_orders(*tables)
        p = plan(joined)
        assert "Exchange" not in p and "SortMergeJoin" in p
        assert _rows(joined) == _rows(gold.open_orders(orders, items))
        # grouping by the bucket column moves nothing either
        assert "Exchange" not in plan(tables[1].groupBy("order_id").count())
        import glob
        assert len(glob.glob(f"{tmp_base}/items/*.parquet")) == 4
    finally:
        for name in ("orders", "items"):
            spark.sql(f"DROP TABLE IF EXISTS bucketed_{name}")
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
