"""Asks a question about every hash that a text yields, such as how often it occurs in the corpus, and brings the
answers back to the text.

A row for each hash would be many times the size of the texts.  Here the hashes of a block of texts travel as one
binary value for each bucket of the hash space, four or eight bytes a hash; a bucket's task sees all of them, and
answers with one byte for each in the order they came.  Blocks are runs of rows of a saved table, which holds the
number of each row and of its block, so every pass finds the same blocks however its scan is split; the hashes
themselves are computed again, not kept.  Blocks grow with the
number of buckets, so the binary values stay long and their number follows the input.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Rows of a block for each bucket, and at least.
BLOCK_ROWS = 64
ANSWERS = "block long, seq long, bucket int, codes binary"
ASKED = "bucket int, block long, seq long, items binary"


def numbered(df: DataFrame, name: str) -> DataFrame:
    """`df` with rid and block, saved once: a scan numbers rows by its splits, which follow the cluster's cores when a
    pass is planned, so numbers made in each pass would differ."""
    bits = max(BLOCK_ROWS, buckets(df.sparkSession) - 1).bit_length() - (0 if buckets(df.sparkSession) > BLOCK_ROWS else 1)
    return common.saved(df.withColumn("rid", F.monotonically_increasing_id()).withColumn("block", F.shiftright("rid", bits)), name)


def buckets(spark: SparkSession) -> int:
    return common.partitions(spark)


def parts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Runs of rows of one block and about SLICE_BYTES of text: block, number of the first row, rows."""
    for piece in common.slices(batch, "text"):
        block = piece.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield int(block[a]), piece.column("rid")[a].as_py(), piece.slice(a, b - a)


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(33)) % np.uint64(n)).astype(np.int32)


def packed(hashes: np.ndarray, block: int, seq: int, n: int, width: int) -> dict:
    """Rows of ASKED: the hashes by bucket, within a bucket in their order."""
    bucket = bucket_of(hashes, n)
    order = np.argsort(bucket, kind="stable")
    values = hashes[order] if width == 8 else hashes[order].astype(np.uint32)
    bucket = bucket[order]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(first, len(bucket)) * width
    items = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)])
    return {"bucket": bucket[first], "block": np.full(len(first), block), "seq": np.full(len(first), seq), "items": items}


def ask(df: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], n: int, width: int) -> DataFrame:
    arrow = common._arrow_schema(df.sparkSession, ASKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, seq, rows in parts(batch):
                h = hashes(rows)
                if len(h):
                    yield common.arrow_batch(packed(h, block, seq, n, width), arrow)

    return df.select("rid", "block", "text").mapInArrow(run, ASKED)


def answer(asked: DataFrame, reply: Callable[[np.ndarray], np.ndarray], width: int) -> DataFrame:
    """`reply` gives one byte for each hash of a bucket.  A bucket holds its share of the hash space; the number of
    buckets grows with spark.sql.shuffle.partitions."""

    def run(table: pa.Table) -> pa.Table:
        items = table.column("items").combine_chunks()
        if isinstance(items, pa.ChunkedArray):
            items = pa.concat_arrays(items.chunks)
        items = items.cast(pa.large_binary())
        ends = np.frombuffer(items.buffers()[1], np.int64, len(items) + 1, items.offset * 8)
        data = np.frombuffer(items.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.uint64 if width == 8 else np.uint32)
        codes = reply(data).astype(np.uint8)
        small = pa.Array.from_buffers(pa.large_binary(), len(items), [None, pa.py_buffer((ends - ends[0]) // width), pa.py_buffer(codes)])
        return pa.table({"block": table.column("block"), "seq": table.column("seq"), "bucket": table.column("bucket"), "codes": small.cast(pa.binary())})

    return asked.groupBy("bucket").applyInArrow(run, ANSWERS)


def returned(hashes: np.ndarray, rows: pa.Table, n: int) -> np.ndarray:
    """The answers of a part in the order of its hashes."""
    order = np.argsort(bucket_of(hashes, n), kind="stable")
    rows = rows.sort_by("bucket")
    codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.uint8)
    out = np.empty(len(hashes), np.uint8)
    out[order] = codes
    return out


def together(df: DataFrame, answers: DataFrame, run: Callable[[pa.RecordBatch, pa.Table], dict], schema: str) -> DataFrame:
    """`run(rows, rows of answers)` for each part of a block, both in order."""
    arrow = common._arrow_schema(df.sparkSession, schema)
    asked_columns = [c for c in answers.columns if c != "block"]

    def block(rows: pa.Table, replies: pa.Table) -> pa.Table:
        rows = rows.sort_by("rid").combine_chunks()
        seq = replies.column("seq").to_numpy()
        seqs = np.unique(seq)
        # Rows of a part that asked nothing go with their neighbours: they have no answers to place.
        cuts = [0, *np.searchsorted(rows.column("rid").to_numpy(), seqs[1:]).tolist(), rows.num_rows]
        out = []
        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            own = replies.filter(pa.array(seq == seqs[i])) if len(seqs) else replies
            for part in rows.slice(a, b - a).combine_chunks().to_batches():
                out.append(common.arrow_batch(run(part, own.select(asked_columns)), arrow))
        return pa.Table.from_batches(out, schema=arrow)

    return df.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(block, schema)


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of finished jobs now: they go when the driver collects its garbage."""
    for _ in range(2):  # what the first finds may hold on to more
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)
