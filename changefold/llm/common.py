"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir

#: Text of about so many bytes is worked on at once inside a task, which bounds numpy's memory.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, *ids: str, text: str = "text") -> DataFrame:
    """The id columns and the text with null as empty; nothing else reaches the scan, so extra columns cannot clash."""
    return df.select(*ids, F.coalesce(F.col(text).cast("string"), F.lit("")).alias(text))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy runs of rows that hold about `limit` bytes of `column`; a longer row is a slice of its own."""
    if batch.num_rows == 0:
        return
    length = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(length, dtype=np.int64) - 1).clip(0) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | None], schema: str, column: str = "text", limit: int = SLICE_BYTES) -> DataFrame:
    """`fn` maps each slice to columns by name (None: no rows).  One narrow stage, no shuffle."""
    arrow = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, limit):
                out = fn(part)
                if out is not None:
                    yield pa.RecordBatch.from_arrays([_array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    if isinstance(values, pa.ChunkedArray):
        return values.combine_chunks().cast(kind)
    return pa.array(values, type=kind)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def arrow_batch(out: dict, arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_array(out[f.name], f.type) for f in arrow], schema=arrow)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def saved(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: cuts lineage in a way that survives lost executors."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Deletes the files of `saved` tables that nothing reads any more."""
    for table in tables:
        jvm, conf = table.sparkSession.sparkContext._jvm, table.sparkSession._jsparkSession.sessionState().newHadoopConf()
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


#: What is broadcast has at most so many bytes, counted first.
BROADCAST_BYTES = 32 << 20


def broadcast_if_small(df: DataFrame, row_bytes: int) -> DataFrame:
    """`df` marked for broadcast if its rows of so many bytes are few enough; else Spark picks the join."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def share(column: Column | str, rows: int, bound: int) -> Column:
    """True for about `bound` of `rows` rows, chosen by a hash of the column: a bounded sample that any retry repeats."""
    if rows <= bound:
        return F.lit(True)
    return F.pmod(F.xxhash64(column), F.lit(1 << 30)) < F.lit(int((1 << 30) * bound / rows))


def code_points(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of code points, and where each begins (one more entry for the end)."""
    lengths = np.fromiter(map(len, values), np.int64, len(values))
    return np.frombuffer("".join(values).encode("utf-32-le", "surrogatepass"), np.uint32), np.concatenate([[0], np.cumsum(lengths)])


def with_text(docs: DataFrame, changed: DataFrame, text: str = "text") -> DataFrame:
    """`changed` has the rows of `docs` with another text: n_chars follows it, the columns stay in order."""
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.length(text).cast(kind))
    return changed.select(*docs.columns)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for at least n places."""
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[size] = tuple(np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, p, np.uint64)])) for p in (_BASE, inverse))
    return _POWERS[size]


class Prefix:
    """Polynomial prefix sums of bytes: the hash of any substring in constant time, vectorised over substrings."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])


def byte_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a string column as one array of bytes, and the place where each begins, with one more for the end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


_WORD_BYTE = np.ones(256, bool)
_WORD_BYTE[[9, 10, 11, 12, 13, 32]] = False


def words(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray = _WORD_BYTE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of word bytes: other than ASCII white space) of all texts, and how many each text has."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = word_byte[data]
    starts = inside[1:-1] & ~inside[:-2]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[first] = inside[1:-1][first]  # a text begins a word even if the one before ends without white space
    start = np.flatnonzero(starts)
    ends = inside[1:-1] & ~inside[2:]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[last] = inside[1:-1][last]
    end = np.flatnonzero(ends) + 1
    return start, end, np.diff(np.searchsorted(start, offsets))
