"""The curve's key against a plain interleaving, and files skipped by either column."""

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from changefold.operators import maintain

BY = ["status", "delivery_date"]


def _orders(spark, n=4000):
    return spark.range(n).select(
        F.col("id").alias("order_id"),
        F.element_at(F.array(*map(F.lit, ["COMPLETED", "PENDING", "PROCESSING", "REPROCESSING"])),
                     (F.pmod(F.xxhash64("id"), F.lit(4)) + 1).cast("int")).alias("status"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(400)).cast("int"))
        .alias("delivery_date"))


def _read(path, column, value):
    """Files whose statistics allow ``column = value``, of all."""
    hit = total = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        total += 1
        for g in range(meta.num_row_groups):
            own = next(meta.row_group(g).column(c) for c in range(meta.num_columns)
                       if meta.row_group(g).column(c).path_in_schema == column)
            if own.statistics.min <= value <= own.statistics.max:
                hit += 1
                break
    return hit, total


def test_filters_on_either_column_skip_files(spark, tmp_base):
    import datetime as dt

    df = _orders(spark)
    curve = maintain.compact(df, f"{tmp_base}/z", BY, partitions=32, curve=True)
    maintain.compact(df, f"{tmp_base}/l", BY, partitions=32)
    assert sorted(map(tuple, curve.collect())) == sorted(map(tuple, df.collect()))
    day = dt.date(2024, 7, 1)
    by_date, files = _read(f"{tmp_base}/z", "delivery_date", day)
    by_status, _ = _read(f"{tmp_base}/z", "status", "PENDING")
    assert files >= 28 and by_date <= files / 2 and by_status <= files / 2
    # and Spark itself reads fewer rows for the date alone
    narrow = curve.filter(F.col("delivery_date") == day)
    assert narrow.count() == df.filter(F.col("delivery_date") == day).count()


def test_second_column_alone_skips_more_than_a_sort_on_it_last(spark, tmp_base):
    """Four numeric columns' worth of spread: after a lexicographic sort the last column skips nothing."""
    df = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"),
                                    F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1000)).alias("b"))
    maintain.compact(df, f"{tmp_base}/z", ["a", "b"], partitions=64, curve=True)
    maintain.compact(df, f"{tmp_base}/l", ["a", "b"], partitions=64)
    z, files = _read(f"{tmp_base}/z", "b", 500)
    plain, _ = _read(f"{tmp_base}/l", "b", 500)
    assert plain >= 0.9 * 64 and z <= files / 4


def test_key_interleaves_ranks(spark):
    rows = [(a, b) for a in range(16) for b in range(16)] * 2
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "a int, b int")
    got = df.select("a", "b", maintain.zorder_key(df, ["a", "b"], bits=5).alias("z")).collect()
    rank = {c: sorted({r[i] for r in rows}) for i, c in enumerate("ab")}

    def plain(a, b):
        x, y = (bisect(rank[c], v) * 32 // (len(rank[c]) + 1) for c, v in (("a", a), ("b", b)))
        return sum((x >> k & 1) << (2 * k + 1) | (y >> k & 1) << (2 * k) for k in range(5))

    from bisect import bisect_right as bisect
    order = {(r.a, r.b): r.z for r in got}
    want = {k: plain(*k) for k in order}
    assert order == want


@pytest.mark.parametrize("bounds", [[], [5], [1, 3], [0, 2, 4, 6, 8, 10, 12], list(range(255))])
def test_rank_is_a_binary_search(spark, bounds):
    from bisect import bisect_right

    values = [None, -1, *range(0, 20), 254, 300]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = {r.v: r.k for r in df.select("v", maintain._rank(F.col("v"), bounds).alias("k")).collect()}
    assert got == {v: 0 if v is None else bisect_right(bounds, v) for v in values}


def test_nulls_text_and_empty_tables(spark, tmp_base):
    schema = "s string, d date, x double, t timestamp, f boolean"
    df = spark.createDataFrame([(None, None, None, None, None), ("é", None, 1.5, None, True), ("", None, -2.0, None, False)], schema)
    by = ["s", "d", "x", "t", "f"]
    assert maintain.compact(df, f"{tmp_base}/n", by, curve=True).count() == 3
    assert maintain.compact(df.limit(0), f"{tmp_base}/e", by, curve=True).count() == 0
    with pytest.raises(ValueError):
        maintain.zorder_key(df, by, bits=13)
