"""Gold layer: ``open_orders``, one flat row per item of an open order.

Open = live (not soft-deleted) and status is not ``COMPLETED``; a null status
is not open (three-valued logic of ``!=``).  An open order with no live item
has no row (inner join), so it is absent from every KPI.

No broadcast hint: which side is small depends on the data.  Spark's size
check (``autoBroadcastJoinThreshold``, re-applied by AQE on the filtered
runtime size) broadcasts the open orders only when they are provably under
the threshold; otherwise both sides shuffle once on ``order_id`` and AQE
splits a hot order's partition (skew join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN_ORDERS_COLUMNS = ["order_id", "delivery_date", "status", "customer_id", "order_date",
                       "order_item_id", "product_id", "quantity"]
COMPLETED = "COMPLETED"


def live(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("_deleted"))


def still_open(orders: DataFrame) -> DataFrame:
    return live(orders).filter(F.col("status") != F.lit(COMPLETED))


def open_orders(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    o = still_open(orders).select("order_id", "delivery_date", "status", "customer_id", "order_date")
    i = live(order_items).select("order_item_id", "order_id", "product_id", "quantity")
    return i.join(o, "order_id", "inner").select(*OPEN_ORDERS_COLUMNS)
