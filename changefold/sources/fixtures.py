"""Adapters from the driver's TPC-H-like tables to the CDC data model.

Each adapter is a plain DataFrame transformation of a given table, so its
work grows with the table.  The same rules are written in DuckDB SQL in
``changefold.plans.oracle``; the two must agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changefold import specs
from changefold.functions import convert

# ---------------------------------------------------------------------------
# Fixed values of the adapters.
# Order status codes: F -> COMPLETED, P -> PENDING,
#   O -> PROCESSING when the order key is even, REPROCESSING when odd.
# New orders are due 10 days after the order date.
# Event types -> operation codes: signup -> c, purchase -> r, error -> d,
#   click and view (anything else) -> u.
# One fixture micro-batch holds 1000 consecutive event ids.
# Topic partitions per fixture topic: 8 (partition = key mod 8).
# Damaged messages, by event id, first match wins:
#   multiple of 97 -> truncated JSON, of 101 -> no op field,
#   of 103 -> ts_ms sent as text, of 89 -> null message value.
# Order lifecycles: every order is created PENDING at midnight of its order
#   date; O orders then move to their adapter status one hour later; F
#   orders move to PROCESSING after one hour and to COMPLETED after two.
#   Stages arrive in reverse: the last stage in batch 0 with the lowest offset.
# Order item ids: order key * 1000 + rank of the line within its order.
# Barcodes: the part key left-padded with zeros to 12 digits.
# Customers: active when the account balance is >= 0; customer address is
#   "NATION <nation key>"; customers with a negative balance are deleted
#   (at ts_ms 1, after their snapshot at ts_ms 0).
# Table changes after a snapshot, at ts_ms 1000000 + 1000 * step, by key:
#   orders mod 10: 1 becomes COMPLETED, 2 becomes PENDING, 3 is deleted, 4 loses
#     its status, 5 is delivered 5 days later, 6 is deleted and in step 2
#     created again as PENDING.
#   order items mod 7: 1 has one more, 2 is deleted, 3 gets the next product,
#     5 is deleted and in step 2 created again with quantity 1.
#   customers mod 10: 1 gets " RENAMED" after its name, 2 is deleted, 3 is inactive.
#   products mod 10: 1 costs 1.00 more, 2 is deleted, 3 is inactive, 4 is deleted
#     and in step 2 created again with " NEW" after its name.
# Late order lifecycles: every last stage of an order whose key is a multiple of
#   11 reaches the broker 3 days late.
# Messages of a topic that no table claims: one per supplier, on
#   finance_db.operations.suppliers.
# Batch metrics: 100 consecutive event ids are one batch, one query per event
#   type; a batch takes 1000 ms per event, lags by its last event id mod 997,
#   and drops its events whose id is a multiple of 501.
# ---------------------------------------------------------------------------
DELIVERY_DAYS = 10
EVENT_OPS = {"signup": "c", "purchase": "r", "error": "d"}
BATCH_SIZE = 1000
TOPIC_PARTITIONS = 8
DAMAGE_TRUNCATED, DAMAGE_NO_OP, DAMAGE_TEXT_TS, DAMAGE_NULL = 97, 101, 103, 89
ITEM_ID_FACTOR = 1000
BARCODE_WIDTH = 12

LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                    "l_shipdate"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day_ms(date_col):
    return convert.date_to_epoch_days(date_col).cast("long") * F.lit(86_400_000)


# ---------------------------------------------------------------------------
# Silver snapshots (what the silver store holds after folding the log)
# ---------------------------------------------------------------------------

def order_status(code, key):
    return (F.when(code == "F", "COMPLETED")
            .when(code == "P", "PENDING")
            .when(code == "O", F.when(key % 2 == 0, "PROCESSING").otherwise("REPROCESSING")))


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    order_date = o.o_orderdate.cast("date")
    ts = F.timestamp_millis(_day_ms(order_date))
    return o.select(
        o.o_orderkey.alias("order_id"),
        order_date.alias("order_date"),
        F.date_add(order_date, DELIVERY_DAYS).alias("delivery_date"),
        o.o_custkey.alias("customer_id"),
        order_status(o.o_orderstatus, o.o_orderkey).alias("status"),
        ts.alias("updated_at"),
        ts.alias("created_at"),
        F.lit(False).alias("_deleted"),
    )


def _items_with_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    # (l_orderkey, l_linenumber) is not unique in the test data; whole rows
    # are.  Rank lines inside their order by every column.
    li = read_table(spark, sf_dir, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy(*LINEITEM_COLUMNS)
    return li.withColumn(
        "order_item_id", F.col("l_orderkey") * ITEM_ID_FACTOR + F.row_number().over(w))


def silver_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _items_with_id(spark, sf_dir)
    ts = F.timestamp_millis(_day_ms(F.col("l_shipdate").cast("date")))
    return li.select(
        "order_item_id",
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        ts.alias("updated_at"),
        ts.alias("created_at"),
        F.lit(False).alias("_deleted"),
    )


def silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        c.c_custkey.alias("customer_id"),
        c.c_name.alias("customer_name"),
        (c.c_acctbal >= 0).alias("is_active"),
        F.concat(F.lit("NATION "), c.c_nationkey.cast("string")).alias("customer_address"),
        F.timestamp_millis(F.lit(0)).alias("updated_at"),
        F.timestamp_millis(F.lit(0)).alias("created_at"),
        F.lit(False).alias("_deleted"),
    )


def silver_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(
        p.p_partkey.alias("product_id"),
        p.p_name.alias("product_name"),
        F.lpad(p.p_partkey.cast("string"), BARCODE_WIDTH, "0").alias("barcode"),
        p.p_retailprice.cast("decimal(10,2)").alias("unity_price"),
        F.lit(True).alias("is_active"),
        F.timestamp_millis(F.lit(0)).alias("updated_at"),
        F.timestamp_millis(F.lit(0)).alias("created_at"),
        F.lit(False).alias("_deleted"),
    )


# ---------------------------------------------------------------------------
# Source row images (wire types: epoch days, epoch ms, price as text)
# ---------------------------------------------------------------------------

def order_item_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _items_with_id(spark, sf_dir)
    ms = _day_ms(F.col("l_shipdate").cast("date"))
    return li.select(
        "order_item_id",
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quanity"),
        ms.alias("updated_at"), F.lit(None).cast("long").alias("updated_by"),
        ms.alias("created_at"), F.lit(None).cast("long").alias("created_by"),
    )


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    days = convert.date_to_epoch_days(o.o_orderdate.cast("date"))
    ms = days.cast("long") * F.lit(86_400_000)
    return o.select(
        o.o_orderkey.alias("order_id"),
        days.alias("order_date"),
        (days + DELIVERY_DAYS).alias("delivery_date"),
        o.o_custkey.alias("customer_id"),
        order_status(o.o_orderstatus, o.o_orderkey).alias("status"),
        ms.alias("updated_at"), F.lit(None).cast("long").alias("updated_by"),
        ms.alias("created_at"), F.lit(None).cast("long").alias("created_by"),
    )


def customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        c.c_custkey.alias("customer_id"),
        c.c_name.alias("customer_name"),
        (c.c_acctbal >= 0).alias("is_active"),
        F.concat(F.lit("NATION "), c.c_nationkey.cast("string")).alias("customer_address"),
        F.lit(0).cast("long").alias("updated_at"), F.lit(None).cast("long").alias("updated_by"),
        F.lit(0).cast("long").alias("created_at"), F.lit(None).cast("long").alias("created_by"),
        c.c_acctbal.alias("_balance"),
    )


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot of every customer, then a delete of each customer with a
    negative balance."""
    rows = customer_rows(spark, sf_dir)
    snap = snapshot_changes(rows.drop("_balance"), specs.CUSTOMERS)
    spec = specs.CUSTOMERS
    image = F.struct(*[F.col(f) for f in spec.row_schema.fieldNames()]).cast(spec.row_schema)
    t = F.lit(1).cast("long")
    dels = rows.filter(F.col("_balance") < 0).select(
        image.alias("before"),
        F.lit(None).cast(spec.row_schema).alias("after"),
        F.lit("d").alias("op"),
        t.alias("ts_ms"),
        _source_block(spec, t, F.col(spec.key), F.lit("false")).alias("source"),
        F.lit(spec.topic).alias("topic"),
        F.pmod(F.col(spec.key), F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        F.col(spec.key).alias("offset"),
        F.timestamp_millis(t).alias("timestamp"),
        F.lit(1).cast("long").alias("_batch_id"),
    )
    return snap.unionByName(dels)


def order_lifecycle_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create + update events of every order (see the fixed values above),
    delivered newest first."""
    spec = specs.ORDERS
    rows = order_rows(spark, sf_dir)
    final = F.col("status")
    stages = (F.when(final == "COMPLETED", F.array(F.lit("PENDING"), F.lit("PROCESSING"), F.lit("COMPLETED")))
              .when(final == "PENDING", F.array(F.lit("PENDING")))
              .otherwise(F.array(F.lit("PENDING"), final)))
    hour = 3_600_000
    ev = rows.select("*", F.posexplode(stages).alias("stage", "stage_status"),
                     F.size(stages).alias("n_stages"))
    ts = F.col("created_at") + F.col("stage") * F.lit(hour)
    image = F.struct(*[(F.col("stage_status") if f == "status" else ts if f == "updated_at" else F.col(f)).alias(f)
                       for f in spec.row_schema.fieldNames()]).cast(spec.row_schema)
    newest_first = F.col("n_stages") - 1 - F.col("stage")
    return ev.select(
        F.lit(None).cast(spec.row_schema).alias("before"),
        image.alias("after"),
        F.when(F.col("stage") == 0, F.lit("c")).otherwise(F.lit("u")).alias("op"),
        ts.alias("ts_ms"),
        _source_block(spec, ts, F.col("order_id") * 4 + F.col("stage"), F.lit("false")).alias("source"),
        F.lit(spec.topic).alias("topic"),
        F.pmod(F.col("order_id"), F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        (newest_first * F.lit(10**12).cast("long") + F.col("order_id")).alias("offset"),
        F.timestamp_millis(ts).alias("timestamp"),
        newest_first.cast("long").alias("_batch_id"),
    )


CHANGE_MS, CHANGE_STEP_MS = 1_000_000, 1_000


def _rules(spec: specs.TableSpec) -> list[tuple]:
    """(which keys, step, operation, new values) of the changes of a table (see the fixed values above)."""
    k = F.col(spec.key)
    if spec is specs.ORDERS:
        m = k % 10
        return [(m == 1, 1, "u", {"status": F.lit("COMPLETED")}), (m == 2, 1, "u", {"status": F.lit("PENDING")}),
                (m == 3, 1, "d", {}), (m == 4, 1, "u", {"status": F.lit(None).cast("string")}),
                (m == 5, 1, "u", {"delivery_date": F.col("delivery_date") + 5}),
                (m == 6, 1, "d", {}), (m == 6, 2, "c", {"status": F.lit("PENDING")})]
    if spec is specs.ORDER_ITEMS:
        m = k % 7
        return [(m == 1, 1, "u", {"quanity": F.col("quanity") + 1}), (m == 2, 1, "d", {}),
                (m == 3, 1, "u", {"product_id": F.col("product_id") + 1}),
                (m == 5, 1, "d", {}), (m == 5, 2, "c", {"quanity": F.lit(1)})]
    if spec is specs.CUSTOMERS:
        m = k % 10
        return [(m == 1, 1, "u", {"customer_name": F.concat("customer_name", F.lit(" RENAMED"))}), (m == 2, 1, "d", {}),
                (m == 3, 1, "u", {"is_active": F.lit(False)})]
    m = k % 10
    dearer = (convert.wire_decimal(F.col("unity_price")) + 1).cast("decimal(10,2)").cast("string")
    return [(m == 1, 1, "u", {"unity_price": dearer}), (m == 2, 1, "d", {}), (m == 3, 1, "u", {"is_active": F.lit(False)}),
            (m == 4, 1, "d", {}), (m == 4, 2, "c", {"product_name": F.concat("product_name", F.lit(" NEW"))})]


def table_rows(spark: SparkSession, sf_dir: str, spec: specs.TableSpec) -> DataFrame:
    """A source table's rows before any change."""
    read = {"orders": order_rows, "order_items": order_item_rows, "customers": customer_rows, "products": product_rows}
    return read[spec.name](spark, sf_dir).select(*spec.row_schema.fieldNames())


def table_changes(spark: SparkSession, sf_dir: str, spec: specs.TableSpec) -> DataFrame:
    """The snapshot of a table (batch 0) and its later updates, deletes and re-inserts (batch = step), in one pass: each
    row once for the snapshot (event 0) and once for each rule it meets (event = place of the rule, from 1)."""
    rules = list(enumerate(_rules(spec), 1))
    met = F.array(F.lit(0), *[F.when(when, F.lit(i)) for i, (when, *_) in rules])
    rows = table_rows(spark, sf_dir, spec).withColumn("_event", F.explode(met)).filter(F.col("_event").isNotNull())
    event = F.col("_event")

    def by_event(snapshot, of_rule):
        value = F.when(event == 0, snapshot)
        for i, rule in rules:
            value = value.when(event == i, of_rule(*rule[1:]))
        return value

    def field(f: str):
        changed = [(i, new[f]) for i, (_, _, _, new) in rules if f in new]
        value = F.when(event > 0, ts) if f == "updated_at" else None
        for i, new in changed:
            value = (F if value is None else value).when(event == i, new)
        return (F.col(f) if value is None else value.otherwise(F.col(f))).alias(f)

    names = spec.row_schema.fieldNames()
    key = F.col(spec.key)
    step = by_event(F.lit(0), lambda step, op, new: F.lit(step))
    op = by_event(F.lit("r"), lambda step, op, new: F.lit(op))
    ts = F.when(event == 0, F.lit(0).cast("long")).otherwise(
        (F.lit(CHANGE_MS) + step * F.lit(CHANGE_STEP_MS)).cast("long"))
    offset = step * F.lit(10**12).cast("long") + key
    before = F.struct(*[F.col(f) for f in names]).cast(spec.row_schema)
    after = F.struct(*[field(f) for f in names]).cast(spec.row_schema)
    return rows.select(
        F.when(op.isin("u", "d"), before).alias("before"),
        F.when(op != "d", after).alias("after"),
        op.alias("op"), ts.alias("ts_ms"),
        _source_block(spec, ts, offset, F.when(event == 0, F.lit("true")).otherwise(F.lit("false"))).alias("source"),
        F.lit(spec.topic).alias("topic"),
        F.pmod(key, F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        offset.alias("offset"),
        F.timestamp_millis(ts).alias("timestamp"),
        step.cast("long").alias("_batch_id"),
    )


def product_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices alternate between the two wire forms: text for even keys,
    the scale + base64 object for odd keys."""
    p = read_table(spark, sf_dir, "part")
    price = p.p_retailprice.cast("decimal(10,2)")
    wire = F.when(p.p_partkey % 2 == 0, price.cast("string")) \
        .otherwise(convert.decimal_to_wire_object(price))
    return p.select(
        p.p_partkey.alias("product_id"),
        p.p_name.alias("product_name"),
        F.lpad(p.p_partkey.cast("string"), BARCODE_WIDTH, "0").alias("barcode"),
        wire.alias("unity_price"),
        F.lit(True).alias("is_active"),
        F.lit(0).cast("long").alias("updated_at"), F.lit(None).cast("long").alias("updated_by"),
        F.lit(0).cast("long").alias("created_at"), F.lit(None).cast("long").alias("created_by"),
    )


# ---------------------------------------------------------------------------
# Change events and broker messages
# ---------------------------------------------------------------------------

def _source_block(spec: specs.TableSpec, ts_ms, lsn, snapshot) -> "F.Column":
    return F.struct(
        F.lit("2.5").alias("version"),
        F.lit("postgresql").alias("connector"),
        F.lit(spec.topic_prefix.split(".")[0]).alias("name"),
        ts_ms.alias("ts_ms"),
        snapshot.alias("snapshot"),
        F.lit("finance").alias("db"),
        F.lit(spec.topic_prefix.split(".")[-1]).alias("schema"),
        F.lit(spec.name).alias("table"),
        lsn.alias("txId"),
        lsn.alias("lsn"),
        F.lit(None).cast("long").alias("xmin"),
    )


def user_event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as the change log of a ``user_events`` table keyed by
    ``user_id``.  Columns: the envelope fields, the broker position
    (topic, partition, offset, timestamp) and ``_batch_id``."""
    spec = specs.USER_EVENTS
    ev = read_table(spark, sf_dir, "events")
    op = F.coalesce(*[F.when(ev.event_type == k, F.lit(v)) for k, v in EVENT_OPS.items()],
                    F.lit("u"))
    ts_ms = convert.ntz_to_epoch_ms(ev.ts)
    image = F.struct(ev.user_id.alias("user_id"), ev.value.alias("value"), ev.props.alias("props"))
    null_image = F.lit(None).cast(spec.row_schema)
    return ev.select(
        F.when(op == "d", image).otherwise(null_image).alias("before"),
        F.when(op == "d", null_image).otherwise(image).alias("after"),
        op.alias("op"),
        ts_ms.alias("ts_ms"),
        _source_block(spec, ts_ms, ev.event_id, F.lit("false")).alias("source"),
        F.lit(spec.topic).alias("topic"),
        F.pmod(ev.user_id, F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        ev.event_id.alias("offset"),
        ev.ts.cast("timestamp").alias("timestamp"),
        F.floor(ev.event_id / BATCH_SIZE).cast("long").alias("_batch_id"),
    )


def snapshot_changes(rows: DataFrame, spec: specs.TableSpec, ts_ms: int = 0) -> DataFrame:
    """Initial snapshot of a table: one ``r`` event per row."""
    key = F.col(spec.key)
    image = F.struct(*[F.col(f) for f in spec.row_schema.fieldNames()]).cast(spec.row_schema)
    t = F.lit(ts_ms).cast("long")
    return rows.select(
        F.lit(None).cast(spec.row_schema).alias("before"),
        image.alias("after"),
        F.lit("r").alias("op"),
        t.alias("ts_ms"),
        _source_block(spec, t, key, F.lit("true")).alias("source"),
        F.lit(spec.topic).alias("topic"),
        F.pmod(key, F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        key.alias("offset"),
        F.timestamp_millis(t).alias("timestamp"),
        F.lit(0).cast("long").alias("_batch_id"),
    )


def to_messages(changes: DataFrame, damage: bool = False) -> DataFrame:
    """Serialise change events to broker messages (JSON text in ``value``).

    With ``damage`` the fixture's damage rule is applied by offset, giving
    truncated JSON, a missing ``op``, ``ts_ms`` as text, and null values."""
    env = F.to_json(F.struct("before", "after", "op", "ts_ms", "source"))
    if damage:
        off = F.col("offset")
        no_op = F.to_json(F.struct("before", "after", "ts_ms", "source"))
        text_ts = F.to_json(F.struct(
            "before", "after", "op",
            F.date_format(F.timestamp_millis("ts_ms"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("ts_ms"),
            "source"))
        truncated = env.substr(F.lit(1), (F.length(env) / 2).cast("int"))
        env = (F.when(off % DAMAGE_TRUNCATED == 0, truncated)
               .when(off % DAMAGE_NO_OP == 0, no_op)
               .when(off % DAMAGE_TEXT_TS == 0, text_ts)
               .when(off % DAMAGE_NULL == 0, F.lit(None).cast("string"))
               .otherwise(env))
    return changes.select(
        F.encode(env, "UTF-8").alias("value"),
        "topic", "partition", "offset", "timestamp", "_batch_id",
    )


def user_event_messages(spark: SparkSession, sf_dir: str, damage: bool = False) -> DataFrame:
    return to_messages(user_event_changes(spark, sf_dir), damage=damage)


def all_topic_messages(spark: SparkSession, sf_dir: str, damage: bool = True) -> DataFrame:
    """Messages of every fixture topic: the user_events change log (damaged
    as above), snapshots of orders, order_items and products, and the
    customer snapshot with its deletes."""
    snaps = [
        snapshot_changes(order_rows(spark, sf_dir), specs.ORDERS),
        snapshot_changes(order_item_rows(spark, sf_dir), specs.ORDER_ITEMS),
        snapshot_changes(product_rows(spark, sf_dir), specs.PRODUCTS),
    ]
    snaps.append(customer_changes(spark, sf_dir))
    msgs = user_event_messages(spark, sf_dir, damage=damage)
    for s in snaps:
        msgs = msgs.unionByName(to_messages(s))
    return msgs


def late_lifecycle_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lifecycles with the broker's times: some last stages arrive days after they happened."""
    last = F.col("offset") < F.lit(10**12)
    late = last & (F.col("after.order_id") % 11 == 0)
    arrival = F.when(late, F.col("timestamp") + F.expr("INTERVAL 3 DAYS")).otherwise(F.col("timestamp"))
    return order_lifecycle_changes(spark, sf_dir).withColumn("timestamp", arrival)


def unclaimed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of a topic that no table claims."""
    s = read_table(spark, sf_dir, "supplier")
    return s.select(
        F.encode(F.to_json(F.struct("s_suppkey", "s_name")), "UTF-8").alias("value"),
        F.lit(f"{specs.DEFAULT_TOPIC_PREFIX}.suppliers").alias("topic"),
        F.pmod(F.col("s_suppkey"), F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        F.col("s_suppkey").alias("offset"), F.timestamp_millis(F.lit(0)).alias("timestamp"),
        F.lit(0).cast("long").alias("_batch_id"))


def batch_metrics_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress rows of micro-batches, as the recorder keeps them."""
    ev = read_table(spark, sf_dir, "events")
    at = F.timestamp_millis(convert.ntz_to_epoch_ms(F.max("ts")))
    return ev.groupBy(F.col("event_type").alias("query"), F.floor(F.col("event_id") / 100).alias("batch_id")).agg(
        F.lit("run").alias("run_id"), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
        F.count(F.lit(1)).alias("num_input_rows"),
        (F.count(F.lit(1)) * 1000).alias("batch_duration_ms"),
        (F.max("event_id") % 997).cast("double").alias("offsets_behind"),
        F.count_if(F.col("event_id") % 501 == 0).alias("dropped_late_rows"))
