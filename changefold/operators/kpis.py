"""The four order KPIs, each a function ``open_orders -> DataFrame``.

Distinct counts plan as a two-level aggregate (group on the grouping keys
plus ``order_id``, then count), both levels with map-side partial
aggregation, so a hot date or customer is combined before it is shuffled.
Top-k ties are broken by the grouping key, ascending, so results are
deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PENDING = "PENDING"
TOP_K = 3


def open_orders_by_date_status(open_orders: DataFrame) -> DataFrame:
    return (open_orders.groupBy("delivery_date", "status")
            .agg(F.countDistinct("order_id").alias("order_count"))
            .orderBy("delivery_date", "status"))


def top_delivery_dates(open_orders: DataFrame, k: int = TOP_K) -> DataFrame:
    return (open_orders.groupBy("delivery_date")
            .agg(F.countDistinct("order_id").alias("open_order_count"))
            .orderBy(F.desc("open_order_count"), F.asc("delivery_date"))
            .limit(k))


def pending_items_by_product(open_orders: DataFrame) -> DataFrame:
    return (open_orders.filter(F.col("status") == PENDING)
            .groupBy("product_id")
            .agg(F.count(F.lit(1)).alias("pending_item_count"))
            .orderBy(F.desc("pending_item_count"), F.asc("product_id")))


def top_customers_pending(open_orders: DataFrame, k: int = TOP_K) -> DataFrame:
    return (open_orders.filter(F.col("status") == PENDING)
            .groupBy("customer_id")
            .agg(F.countDistinct("order_id").alias("pending_order_count"))
            .orderBy(F.desc("pending_order_count"), F.asc("customer_id"))
            .limit(k))


ALL = {
    "kpi_open_orders_by_date_status": open_orders_by_date_status,
    "kpi_top_delivery_dates": top_delivery_dates,
    "kpi_pending_items_by_product": pending_items_by_product,
    "kpi_top_customers_pending": top_customers_pending,
}


def serve(open_orders: DataFrame, name: str) -> DataFrame:
    """A KPI by its name over the serving table, however it was read (files, a catalog table, a database)."""
    if name not in ALL:
        raise KeyError(f"no KPI {name!r}; there are {', '.join(ALL)}")
    return ALL[name](open_orders)
