"""Table maintenance: retention purge, clustered compaction (lexicographic or along a space-filling curve)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RETENTION_MONTHS = 6  # soft-deleted rows older than this are purged


def purge_deleted(silver: DataFrame, as_of: Column | str, months: int = RETENTION_MONTHS) -> DataFrame:
    """Drop soft-deleted rows whose last change is older than ``months``
    before ``as_of``; live rows are always kept."""
    as_of_col = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    # Interval arithmetic keeps the time of day (add_months returns a DATE).
    cutoff = as_of_col - F.expr(f"INTERVAL '{int(months)}' MONTH")
    return silver.filter(~(F.col("_deleted") & (F.col("updated_at") < cutoff)))


def cluster(df: DataFrame, by: list[str], partitions: int | None = None) -> DataFrame:
    """Range-partition and sort on ``by`` so Parquet min/max statistics skip
    files and row groups for filters on those columns (data skipping)."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *by).sortWithinPartitions(*by)


# --- space-filling curve ------------------------------------------------------
#
# Sorting on (a, b) lets files be skipped by a, but every file then spans nearly
# all of b.  Along the curve that interleaves the bits of both ranks (Z-order) a
# file covers a rectangle, so a filter on either column alone skips files.

ZORDER_BITS = 8


def _number(df: DataFrame, name: str) -> Column:
    """An order-preserving whole number of a column: dates and times by their epoch, numbers scaled, text by its
    first six bytes (quantiles are exact below 2^53).  Nulls come first."""
    col, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        number = F.datediff(col, F.lit("1970-01-01")) if isinstance(kind, T.DateType) else F.unix_micros(col.cast("timestamp"))
    elif isinstance(kind, (T.StringType, T.BinaryType)):
        head = F.substring(F.hex(col.cast("binary")), 1, 12)
        number = F.conv(F.rpad(head, 12, "0"), 16, 10).cast("long")
    elif isinstance(kind, T.BooleanType):
        number = col.cast("int")
    elif isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        number = col.cast("double")
    else:
        number = col.cast("long")
    return number


def _rank(number: Column, bounds: list) -> Column:
    """How many of the rising ``bounds`` are at most ``number``, by binary search over a literal array."""
    size = 1 << max(len(bounds), 1).bit_length()
    steps = [size >> k for k in range(1, size.bit_length())]
    array = F.array(*[F.lit(b) for b in bounds], F.lit(None)) if bounds else F.array(F.lit(None))
    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                        lambda at, s: F.when(F.coalesce(F.get(array, at + s - 1) <= number, F.lit(False)), at + s)
                        .otherwise(at))
    return F.when(number.isNull(), F.lit(0)).otherwise(found)


def zorder_key(df: DataFrame, by: list[str], bits: int = ZORDER_BITS) -> Column:
    """The place on the curve of each row: the ranks of its columns among at most ``2 ** bits`` quantiles of the whole
    table (one aggregate), their bits interleaved, the first column's most significant.  ``bits * len(by)`` must stay
    below 63."""
    if not 0 < bits * len(by) < 63:
        raise ValueError(f"{len(by)} columns of {bits} bits do not fit a long")
    share = [k / (1 << bits) for k in range(1, 1 << bits)]
    numbers = {c: _number(df, c) for c in by}
    quantiles = df.agg(*[F.percentile_approx(numbers[c], share, 100 << bits).alias(f"q{i}")
                         for i, c in enumerate(by)]).first()
    key = F.lit(0).cast("long")
    for i, c in enumerate(by):
        bounds = sorted(set(quantiles[f"q{i}"] or []))
        # Few distinct values spread over all bits, so every column cuts the curve from its top bit on.
        rank = F.floor(_rank(numbers[c], bounds) * F.lit(1 << bits) / F.lit(len(bounds) + 1)).cast("long")
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(bit, b * len(by) + len(by) - 1 - i))
    return key


def zorder(df: DataFrame, by: list[str], partitions: int | None = None, bits: int = ZORDER_BITS) -> DataFrame:
    """Range-partition and sort along the curve over ``by``, so min/max statistics skip files for filters on any of
    the columns."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumn("_curve", zorder_key(df, by, bits))
    return placed.repartitionByRange(n, "_curve").sortWithinPartitions("_curve").drop("_curve")


def compact(df: DataFrame, path: str, by: list[str], partitions: int | None = None,
            partition_by: list[str] | None = None, curve: bool = False) -> DataFrame:
    """Rewrite ``df`` clustered on ``by`` into ``path`` (``curve``: along
    the space-filling curve over ``by``) and return the rewritten table."""
    writer = (zorder if curve else cluster)(df, by, partitions).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)
