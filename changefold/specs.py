"""Table specs: one registry entry drives parsing, folding and layout.

A ``TableSpec`` says what a change envelope of one table looks like (its row
image schema), which column is the key, and how the row image becomes a
silver row.  Adding a table means adding one spec; no code is per table.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changefold.functions import convert

# ---------------------------------------------------------------------------
# The change-envelope layout of the capture connector.
# Envelope fields: before, after, op, ts_ms, source.
# Source block fields: version, connector, name, ts_ms, snapshot, db, schema,
# table, txId, lsn, xmin.
# Operation codes: c = create, u = update, r = snapshot read, d = delete.
# Default topic names: "finance_db.operations.<table>" (configurable).
# ---------------------------------------------------------------------------
DEFAULT_TOPIC_PREFIX = "finance_db.operations"
SOURCE_SCHEMA = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("connector", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("snapshot", T.StringType()),
    T.StructField("db", T.StringType()),
    T.StructField("schema", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("txId", T.LongType()),
    T.StructField("lsn", T.LongType()),
    T.StructField("xmin", T.LongType()),
])
UPSERT_OPS = ("c", "u", "r")
DELETE_OP = "d"
ALL_OPS = UPSERT_OPS + (DELETE_OP,)

# Message (log record) columns as delivered by the broker.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

AUDIT_FIELDS = [
    T.StructField("updated_at", T.LongType()),
    T.StructField("updated_by", T.LongType()),
    T.StructField("created_at", T.LongType()),
    T.StructField("created_by", T.LongType()),
]


def envelope_schema(row_schema: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("before", row_schema),
        T.StructField("after", row_schema),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("source", SOURCE_SCHEMA),
    ])


Converter = Callable[[Column], Column]


@dataclass(frozen=True)
class OutputColumn:
    """One silver column: ``name`` = ``convert(image[source])``."""

    name: str
    source: str
    convert: Converter = lambda c: c


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: str
    row_schema: T.StructType
    columns: tuple[OutputColumn, ...]
    # Delete effects besides ``_deleted = true``: column -> value.
    on_delete: dict = field(default_factory=dict)
    # Column used only to lay out files (never part of the key).
    layout_column: str | None = None
    # Silver columns that keep the value of the key's first upsert instead
    # of following later updates (default: none, every column follows).
    sticky_columns: tuple[str, ...] = ()
    # Row-image field that orders rows inside silver log files, so Parquet
    # min/max statistics can skip row groups on range filters (default: key).
    cluster_field: str | None = None

    @property
    def cluster(self) -> str:
        return self.cluster_field or self.key
    topic_prefix: str = DEFAULT_TOPIC_PREFIX

    @property
    def topic(self) -> str:
        return f"{self.topic_prefix}.{self.name}"

    @property
    def envelope(self) -> T.StructType:
        return envelope_schema(self.row_schema)

    @property
    def image_schema(self) -> T.StructType:
        """The part of a row image that folded states carry: what silver columns are made of.  The key is a column of
        its own, and the other audit fields reach no silver row."""
        used = {c.source for c in self.columns} | {"updated_at", *([self.cluster_field] if self.cluster_field else [])}
        kept = [f for f in self.row_schema.fields if f.name in used and f.name != self.key]
        return T.StructType(kept or [self.row_schema[self.key]])

    def has_field(self, name: str) -> bool:
        return name in self.row_schema.fieldNames()

    @property
    def silver_columns(self) -> list[str]:
        return [c.name for c in self.columns] + ["updated_at", "created_at", "_deleted"]


ORDERS = TableSpec(
    name="orders",
    key="order_id",
    row_schema=T.StructType([
        T.StructField("order_id", T.LongType()),
        T.StructField("order_date", T.IntegerType()),
        T.StructField("delivery_date", T.IntegerType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("status", T.StringType()),
        *AUDIT_FIELDS,
    ]),
    columns=(
        OutputColumn("order_id", "order_id"),
        OutputColumn("order_date", "order_date", convert.epoch_days_to_date),
        OutputColumn("delivery_date", "delivery_date", convert.epoch_days_to_date),
        OutputColumn("customer_id", "customer_id"),
        OutputColumn("status", "status"),
    ),
    layout_column="order_date",
)

CUSTOMERS = TableSpec(
    name="customers",
    key="customer_id",
    row_schema=T.StructType([
        T.StructField("customer_id", T.LongType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("customer_address", T.StringType()),
        *AUDIT_FIELDS,
    ]),
    columns=(
        OutputColumn("customer_id", "customer_id"),
        OutputColumn("customer_name", "customer_name"),
        OutputColumn("is_active", "is_active"),
        OutputColumn("customer_address", "customer_address"),
    ),
    on_delete={"is_active": False},
)

PRODUCTS = TableSpec(
    name="products",
    key="product_id",
    row_schema=T.StructType([
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("barcode", T.StringType()),
        T.StructField("unity_price", T.StringType()),
        T.StructField("is_active", T.BooleanType()),
        *AUDIT_FIELDS,
    ]),
    columns=(
        OutputColumn("product_id", "product_id"),
        OutputColumn("product_name", "product_name"),
        OutputColumn("barcode", "barcode"),
        OutputColumn("unity_price", "unity_price", convert.wire_decimal),
        OutputColumn("is_active", "is_active"),
    ),
    on_delete={"is_active": False},
)

ORDER_ITEMS = TableSpec(
    name="order_items",
    key="order_item_id",
    row_schema=T.StructType([
        T.StructField("order_item_id", T.LongType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        # The source column is spelled "quanity"; silver renames it.
        T.StructField("quanity", T.IntegerType()),
        *AUDIT_FIELDS,
    ]),
    columns=(
        OutputColumn("order_item_id", "order_item_id"),
        OutputColumn("order_id", "order_id"),
        OutputColumn("product_id", "product_id"),
        OutputColumn("quantity", "quanity"),
    ),
    # Gold looks items up by order: keep an order's item states together.
    cluster_field="order_id",
)

# A keyed table without audit columns: the driver's ``events`` replayed as
# row changes of a ``user_events`` table (see sources.fixtures).  Its
# ``updated_at``/``created_at`` come from the change events' own times.
USER_EVENTS = TableSpec(
    name="user_events",
    key="user_id",
    row_schema=T.StructType([
        T.StructField("user_id", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]),
    columns=(
        OutputColumn("user_id", "user_id"),
        OutputColumn("value", "value"),
        OutputColumn("props", "props"),
    ),
)

# order_items as the source system updates it: only quantity follows later
# updates; order_id and product_id keep their first values (for comparison).
ORDER_ITEMS_FIRST_IDS = replace(ORDER_ITEMS, sticky_columns=("order_id", "product_id"))

REGISTRY: dict[str, TableSpec] = {s.name: s for s in (ORDERS, CUSTOMERS, PRODUCTS, ORDER_ITEMS, USER_EVENTS)}


def spec_for(name_or_topic: str) -> TableSpec:
    name = name_or_topic.rsplit(".", 1)[-1]
    return REGISTRY[name]
