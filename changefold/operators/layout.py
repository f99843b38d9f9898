"""Tables laid out by a date: written with one folder per date, and looked up so that only the dates asked for are read.

A change of an order carries its date (deletes in the before image), so the rows it touches are found by
``(order_date, order_id)``.  The join is on the folder column too; Spark collects the dates of the changes first and
prunes the other folders at run time (dynamic partition pruning), whatever the table's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefold.specs import TableSpec


def write(df: DataFrame, spec: TableSpec, path: str) -> DataFrame:
    """Write a silver table in folders of its layout column; the written table.  Rows are ranged on (date, key): few
    files per date, and a date with a large share of the rows is split across tasks by key."""
    out = df.repartitionByRange(spec.layout_column, spec.key).sortWithinPartitions(spec.key)
    out.write.mode("overwrite").partitionBy(spec.layout_column).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def touched_keys(bronze_df: DataFrame, spec: TableSpec) -> DataFrame:
    """(layout date, key) of every row that a batch of changes touches: where it was before, and where it is after.
    Changes without a date touch no folder."""
    date = next(c for c in spec.columns if c.name == spec.layout_column)
    sides = [bronze_df.select(date.convert(F.col(side)[date.source]).alias(date.name),
                              F.col(side)[spec.key].alias(spec.key)) for side in ("before", "after")]
    return sides[0].unionByName(sides[1]).filter(F.col(date.name).isNotNull()).distinct()


def touched(table: DataFrame, keys: DataFrame, spec: TableSpec) -> DataFrame:
    """The table's rows at ``keys``: only the keys' folders are read."""
    return table.join(keys.select(spec.layout_column, spec.key), [spec.layout_column, spec.key], "left_semi")
