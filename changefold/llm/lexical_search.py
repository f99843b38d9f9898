"""Ranked lexical search of all documents for a set of query items, with bag deduplication.

A score depends on a document only through its bag, the counts of the terms that occur in the items, and its length
number m.  So documents are restricted to the items' vocabulary, equal (bag, m) pairs become one class (grouped by hash
and by the bag's bytes, so equality is verified), classes are scored once, and of the winning classes members are
listed by ascending doc_id.  A class holds any share of the rows: it is counted inside each task before it is
shuffled, and its first members are taken in two steps over salted parts.

Items are a stated query set.  They are dealt by a hash of their row into blocks of about BLOCK_ITEMS items and
BLOCK_CHARS characters, whatever their number; the vocabulary and the items of one block at a time reach the tasks.
All numbers but a term's weight are whole; a class's scores are products of matrices of doubles only while every sum is below
2^53, else of 64-bit integers.

Defined results.  Null texts have no terms; null and term-less items have no rows; items with equal ids are items of
their own.  Repeated documents each take a rank; documents without an id come after all others of equal score.  Long
texts are read whole.  An empty table gives no rows.  Only the id and text columns are read, so others cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

TOP = 10
BLOCK_ITEMS, BLOCK_CHARS = 512, 200_000
#: Counts of a tile of classes that is scored at once.
TILE = 20_000
#: Bags of winning classes are broadcast up to so many bytes.
BROADCAST_BYTES = 32 << 20
SALTS = 16
LAST = (1 << 63) - 1  # stands for a missing doc_id while ranking

TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")  # in UTF-8 the bytes of other scripts are all above 127
_TERM_BYTE = np.zeros(256, bool)
_TERM_BYTE[128:] = True
for _a, _b in ("09", "AZ", "az"):
    _TERM_BYTE[ord(_a) : ord(_b) + 1] = True


def terms(text: str | None) -> list[bytes]:
    return [t.lower() for t in TERM.findall((text or "").encode("utf-8", "replace"))]


@dataclass
class Vocabulary:
    """The items' terms in the order of their hashes: term k is data[start[k]:end[k]]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    equal: int  # terms that share one hash, at most

    @classmethod
    def of(cls, words: list[bytes]) -> Vocabulary:
        data = np.frombuffer(b"".join(words), np.uint8)
        end = np.cumsum([len(w) for w in words])
        start = end - [len(w) for w in words]
        hashes = common.Prefix(data).hashes(start, end)
        order = np.argsort(hashes, kind="stable")
        return cls(data, start[order], end[order], hashes[order], int(np.unique(hashes, return_counts=True)[1].max()))

    def __len__(self) -> int:
        return len(self.hashes)

    def word(self, k: int) -> bytes:
        return self.data[self.start[k] : self.end[k]].tobytes()

    def places(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each term of a text, -1 for others; a hash finds it, the bytes decide."""
        out = np.full(len(start), -1, np.int64)
        hashes = common.Prefix(data).hashes(start, end)
        first = np.searchsorted(self.hashes, hashes)
        for step in range(self.equal):
            k = np.minimum(first + step, len(self) - 1)
            length = end - start
            at = np.flatnonzero((self.hashes[k] == hashes) & (self.end[k] - self.start[k] == length))
            for size in np.unique(length[at]):
                some = at[length[at] == size]
                span = np.arange(size)
                same = (data[start[some][:, None] + span] == self.data[self.start[k[some]][:, None] + span]).all(1)
                out[some[same]] = k[some[same]]
        return out

    @property
    def kind(self) -> type:
        return np.uint16 if len(self) <= 1 << 16 else np.uint32


def pack(place: np.ndarray, tf: np.ndarray, kind: type) -> bytes:
    """A bag: the width of counts, terms rising, counts."""
    small = np.uint8 if tf.max() < 256 else np.uint32
    return bytes([small().itemsize]) + place.astype(kind).tobytes() + tf.astype(small).tobytes()


def unpack(bag: bytes, kind: type) -> tuple[np.ndarray, np.ndarray]:
    n = (len(bag) - 1) // (kind().itemsize + bag[0])
    return np.frombuffer(bag, kind, n, 1), np.frombuffer(bag, np.uint8 if bag[0] == 1 else np.uint32, n, 1 + n * kind().itemsize)


def bags(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n, bag and the bag's hash of every document with a term; the bag is empty if none is in the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(part: pa.RecordBatch) -> dict:
        known = shared.value
        data, offsets = common.byte_texts(part.column("text"))
        upper = (data >= 65) & (data <= 90)
        data = data + upper.astype(np.uint8) * 32
        start, end, n = common.words(data, offsets, _TERM_BYTE)
        place = known.places(data, start, end)
        hit = place >= 0
        doc = np.repeat(np.arange(len(n)), n)[hit]
        key, tf = np.unique(doc * len(known) + place[hit], return_counts=True)
        doc, place = key // len(known), key % len(known)
        cut = np.searchsorted(doc, np.arange(len(n) + 1))
        return {"doc_id": part.column("doc_id"), "n": n, "bag": [pack(place[a:b], tf[a:b], known.kind) if a < b else b"" for a, b in zip(cut, cut[1:], strict=False)]}

    out = common.map_slices(docs, run, "doc_id long, n long, bag binary")
    return out.filter("n > 0").withColumn("hash", F.xxhash64("bag"))


def frequencies(classes: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Documents that hold each term, counted over classes by their copies."""
    size, kind = len(vocabulary), vocabulary.kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            for bag, copies in zip(batch.column("bag").to_pylist(), batch.column("copies").to_pylist(), strict=True):
                df[unpack(bag, kind)[0]] += copies
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at])], names=["term", "df"])

    out = np.zeros(size, np.int64)
    for term, df in classes.select("bag", "copies").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df")).collect():
        out[term] = df
    return out


class Best:
    """The TOP classes of every item so far, by falling score, then rising first doc_id, then class."""

    def __init__(self, items: int):
        self.score = np.zeros((items, TOP), np.int64)
        self.first = np.full((items, TOP), LAST)
        self.cid = np.full((items, TOP), LAST)

    def add(self, scores: np.ndarray, first: np.ndarray, cid: np.ndarray) -> None:
        """`scores` by class and item.  Items that no class betters are left alone."""
        items = np.flatnonzero(((scores >= self.score[:, -1]) & (scores > 0)).any(0))
        if not len(items):
            return
        score = np.concatenate([self.score[items], scores[:, items].T], 1)
        wide = (len(items), len(cid))
        first = np.concatenate([self.first[items], np.broadcast_to(first, wide)], 1)
        cid = np.concatenate([self.cid[items], np.broadcast_to(cid, wide)], 1)
        order = np.lexsort((cid, first, -score), axis=1)[:, :TOP]
        self.score[items], self.first[items], self.cid[items] = (np.take_along_axis(x, order, 1) for x in (score, first, cid))


def scored(classes: DataFrame, queries: list[list[int]], weight: np.ndarray, kind: type) -> DataFrame:
    """item, score, first, cid: the best classes of each item, task by task.  `queries` are the items' terms with repeats."""
    pairs = np.array([(t, i) for i, q in enumerate(queries) for t in q], np.int64).reshape(-1, 2)
    key, times = np.unique(pairs[:, 0] * len(queries) + pairs[:, 1], return_counts=True)
    term, item = key // len(queries), key % len(queries)
    begin = np.searchsorted(term, np.arange(len(weight) + 1))
    whole = int(weight.max(initial=0)) * 10**6 * max(map(len, queries)) < 1 << 53  # then doubles add without rounding
    number = np.float64 if whole else np.int64
    shared = classes.sparkSession.sparkContext.broadcast((begin, item, times, weight))

    def tile(rows: list[tuple], best: Best) -> None:
        begin, item, times, weight = shared.value
        found = [unpack(bag, kind) for _, _, _, bag in rows]
        size = np.array([len(t) for t, _ in found])
        terms_, tf = np.concatenate([t for t, _ in found]).astype(np.int64), np.concatenate([c for _, c in found]).astype(np.int64)
        m = np.array([r[2] for r in rows], np.int64)
        row = np.repeat(np.arange(len(rows)), size)
        used, at = np.unique(terms_, return_inverse=True)
        part = np.zeros((len(rows), len(used)), number)
        part[row, at] = weight[terms_] * ((10**9 * tf) // (1000 * tf + 8 * m[row]))
        asked = np.zeros((len(used), len(best.score)), number)
        count = begin[used + 1] - begin[used]
        flat = np.repeat(begin[used] - np.cumsum(count) + count, count) + np.arange(count.sum())
        asked[np.repeat(np.arange(len(used)), count), item[flat]] = times[flat]
        best.add((part @ asked).astype(np.int64), np.array([r[1] for r in rows]), np.array([r[0] for r in rows]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, rows, n = Best(len(queries)), [], 0
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("cid", "first", "m", "bag")), strict=True):
                rows.append(r)
                n += len(r[3])
                if n >= 3 * TILE:
                    tile(rows, best)
                    rows, n = [], 0
        if rows:
            tile(rows, best)
        item, place = np.nonzero(best.score)
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), *(pa.array(x[item, place]) for x in (best.score, best.first, best.cid))], names=["item", "score", "first", "cid"])

    return classes.select("cid", "first", "m", "bag").mapInArrow(run, "item int, score long, first long, cid long")


def members(docs: DataFrame, winners: DataFrame) -> DataFrame:
    """cid and doc_id of the TOP first documents of each winning class."""
    held = winners.agg(F.sum(F.length("bag") + 32)).first()[0] or 0
    winners = winners.withColumnsRenamed({"bag": "_bag", "hash": "_hash", "m": "_m"})
    joined = docs.join(F.broadcast(winners) if held <= BROADCAST_BYTES else winners, (F.col("hash") == F.col("_hash")) & (F.col("m") == F.col("_m")) & (F.col("bag") == F.col("_bag")))
    found = joined.select("cid", F.coalesce("doc_id", F.lit(LAST)).alias("doc_id")).withColumn("salt", F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.lit(SALTS)))
    for keys in (["cid", "salt"], ["cid"]):
        found = found.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("doc_id"))).filter(F.col("place") <= TOP)
    return found.select("cid", "doc_id")


def block(docs: DataFrame, items: list[tuple[int, str]], ids: DataFrame) -> DataFrame | None:
    """The ranks of one block of items, given as (row, text); `ids` holds the items' ids by row."""
    asked = [(row, found) for row, text in items if (found := terms(text))]
    if not asked:
        return None
    vocabulary = Vocabulary.of(sorted({t for _, found in asked for t in found}))
    number = {vocabulary.word(k): k for k in range(len(vocabulary))}
    rows = common.saved(bags(docs, vocabulary), "search-bags")
    documents, total = rows.agg(F.count("*"), F.sum("n")).first()
    if not documents:
        return None
    rows = rows.withColumn("m", F.expr(f"25 + ((75L * n * {documents}L) div {total}L)")).filter(F.length("bag") > 0)
    grouped = rows.groupBy("hash", "m", "bag").agg(F.count("*").alias("copies"), F.coalesce(F.min("doc_id"), F.lit(LAST)).alias("first"))
    classes = common.saved(grouped.withColumn("cid", F.monotonically_increasing_id()), "search-classes")
    df = frequencies(classes, vocabulary)
    weight = np.array([floor(1000 * log((2 * documents + 2) / (2 * int(k) + 1))) for k in df], np.int64)
    by_task = scored(classes, [[number[t] for t in found] for _, found in asked], weight, vocabulary.kind)
    best = Window.partitionBy("item").orderBy(F.desc("score"), "first", "cid")
    chosen = common.saved(by_task.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= TOP).select("item", "score", "cid"), "search-chosen")
    winners = classes.join(F.broadcast(chosen.select("cid").distinct()), "cid")  # TOP rows an item of the block
    listed = members(rows, common.saved(winners.select("cid", "hash", "m", "bag"), "search-winners"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    ranked = chosen.join(listed, "cid").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)
    place = docs.sparkSession.createDataFrame([(i, row) for i, (row, _) in enumerate(asked)], "item int, _row long")
    out = ranked.join(place, "item").join(ids, "_row").select("_item", "rank", F.nullif("doc_id", F.lit(LAST)).alias("doc_id"), "score")
    return common.saved(out, "search-ranks")


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, rank, doc_id and score of the TOP documents of every item."""
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    numbered = common.saved(items.select(F.col(item_id).alias("_item"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text")).withColumn("_row", F.monotonically_increasing_id()), "search-items")
    count, chars = numbered.agg(F.count("*"), F.coalesce(F.sum(F.length("_text")), F.lit(0))).first()
    blocks = max(-(-count // BLOCK_ITEMS), -(-chars // BLOCK_CHARS))
    found = []
    for b in range(blocks):
        own = numbered.filter(F.pmod(F.xxhash64("_row"), F.lit(blocks)) == b)
        ranks = block(docs, [(r["_row"], r["_text"]) for r in own.select("_row", "_text").orderBy("_row").collect()], own.select("_row", "_item"))
        if ranks is not None:
            found.append(ranks)
    schema = f"{item_id} {items.schema[item_id].dataType.simpleString()}, rank int, doc_id long, score long"
    if not found:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, found).withColumnRenamed("_item", item_id)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS terms FROM documents),
q AS (SELECT irow, item_id, term, count(*) AS times
      FROM (SELECT irow, item_id, unnest(terms) AS term
            FROM (SELECT row_number() OVER () AS irow, item_id, {_TERMS} AS terms FROM benchmark)) GROUP BY ALL),
c AS (SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM d WHERE len(terms) > 0),
t AS (SELECT rid, doc_id, n, term, count(*) AS tf
      FROM (SELECT rid, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
      WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS weight
      FROM (SELECT term, count(*) AS df FROM t GROUP BY term), c),
s AS (SELECT irow, item_id, rid, doc_id,
             CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total)))) AS BIGINT) AS score
      FROM t JOIN w USING (term) JOIN q USING (term), c GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY irow ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 10"""
