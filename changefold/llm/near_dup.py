"""Near-duplicates by improved consistent weighted sampling (ICWS) over TF-IDF shingles.

1. Shingles are runs of five words (a shorter text is one shingle), weighted by tf * idf with
   idf = 1 + ln(N / df) / ln(N), between 1 and 2.  Document frequencies come from the exchange: every shingle of
   every text is counted, over whole texts.
2. ICWS draws BANDS * ROWS samples: two texts agree in a sample with a probability that is their weighted Jaccard
   similarity.  Texts that agree in all rows of a band meet in a bucket (27 bands of 5: a pair at 0.8 misses all of
   them twice in 100,000; texts that share a third of their weight meet in a band four times in 1000).
3. Equal texts are one representative from here on.  In each bucket the member that meets most others, over all its
   bands, is the pivot.  Pairs that agree in fewer than AGREEING of all samples are far from the similarity and go; the
   others are verified by exact weighted Jaccard similarity on whole texts.
4. Buckets that still hold more than one component are searched whole, in tiles of about TILE_BYTES.  First the samples
   tell which members agree with one of another component; of those alone the texts are read: a pair at the similarity shares a shingle among each one's rarest ones (the prefix that holds more weight than such a pair may
   differ in), so only texts with such a shingle in common are verified.  Nothing is lost by that, and a text whose
   edits make up more than that weight meets nobody, however many copies of the original there are.
5. Verified links are joined to classes by their smallest member, over saved tables.

Null text counts as empty; empty texts are copies of each other and near nothing else.  Null ids are kept, and are the
class id only if no member has an id.  Repeated rows are copies.  An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, exchange

SHINGLE = 5
BANDS, ROWS = 27, 5
SIMILARITY = 0.8
#: Bytes of text in a block of a bucket; a tile holds one block or two.
TILE_BYTES = 2 << 20
#: Steps of the stored document frequency for each doubling.
STEPS = 4
#: Pairs that agree in fewer of their samples are not compared: at the similarity 108 of 135 are expected, and fewer
#: than these happen three times in a million pairs, seldom beside the bands' 20.
AGREEING = 87
#: Shingles whose samples are drawn at once.
CACHED = 1 << 16


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, how often each occurs, and how many each text has."""
    data, offsets = common.byte_texts(column)
    start, end, count = common.words(data, offsets)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    word = common.Prefix(data).hashes(start, end)
    text = np.repeat(np.arange(len(count)), count)
    first = np.cumsum(count) - count
    full = np.maximum(count - SHINGLE + 1, np.minimum(count, 1))
    at = np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full) + np.repeat(first, full)
    size = np.repeat(np.minimum(count, SHINGLE), full)
    h = np.zeros(len(at), np.uint64)
    for k in range(SHINGLE):
        inside = k < size
        h = h * np.uint64(0x9E3779B97F4A7C15) + np.where(inside, word[np.minimum(at + k, len(word) - 1)], np.uint64(k))
    h, text = common.mixed(h), text[at]
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])]))
    return h[new], np.diff(np.append(new, len(h))), np.bincount(text[new], minlength=len(count))


def _frequency_codes(items: np.ndarray) -> np.ndarray:
    """Of each hash its frequency in the bucket, on a logarithmic scale."""
    order = np.argsort(items)
    s = items[order]
    new = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    n = np.diff(np.append(new, len(s)))
    out = np.empty(len(items), np.uint8)
    out[order] = np.repeat(np.minimum(255, np.round(STEPS * np.log2(n))).astype(np.uint8), n)
    return out


def idf(codes: np.ndarray, docs: int) -> np.ndarray:
    scale = np.log(max(docs, 2))
    return 1 + np.maximum(0, scale - codes * (np.log(2) / STEPS)) / scale


_GAMMA = None


def _gamma() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of the Gamma(2, 1) distribution at 65,536 places, and their logarithms."""
    global _GAMMA
    if _GAMMA is None:
        x = np.concatenate([np.linspace(0, 2, 200_000), np.linspace(2, 40, 400_000)[1:]])
        g = np.interp((np.arange(1 << 16) + 0.5) / (1 << 16), 1 - np.exp(-x) * (1 + x), x).astype(np.float32)
        _GAMMA = g, np.log(g)
    return _GAMMA


def bands(h: np.ndarray, weight: np.ndarray, count: np.ndarray, n_bands: int = BANDS, rows: int = ROWS) -> tuple[np.ndarray, np.ndarray]:
    """ICWS: of each text (with shingles) one hash for each band, and the low byte of each sample."""
    count = count[count > 0]
    out = np.zeros((len(count), n_bands), np.uint64)
    low = np.zeros((len(count), n_bands * rows), np.uint8)
    ends = np.cumsum(count)
    first = 0
    while first < len(count):  # runs of texts whose arrays stay in the processor's cache; a longer text is a run of its own
        begin = ends[first] - count[first]
        last = max(first + 1, int(np.searchsorted(ends, begin + CACHED, side="right")))
        at = slice(begin, ends[last - 1])
        _icws(h[at], np.log(weight[at]).astype(np.float32), count[first:last], out[first:last], low[first:last], rows)
        first = last
    return out, low


def _icws(h: np.ndarray, log_w: np.ndarray, count: np.ndarray, out: np.ndarray, low: np.ndarray, rows: int) -> None:
    gamma, log_gamma = _gamma()
    n = len(h)
    starts = np.cumsum(count) - count
    x, y = np.empty(n, np.uint64), np.empty(n, np.uint64)
    own = np.repeat(np.arange(len(count)), count)
    r, log_c, beta, t = (np.empty(n, np.float32) for _ in range(4))
    best = np.empty(n, bool)
    least = np.empty(len(count), np.float32)
    sixteen = np.uint64(0xFFFF)
    # The hashes are mixed already, so an odd factor for each sample spreads them anew; the upper bits are used.
    factor = common.mixed(np.arange(1, low.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    for k in range(low.shape[1]):
        np.multiply(h, factor[k], out=x)
        np.right_shift(x, np.uint64(48), out=y)
        np.take(gamma, y.view(np.int64), out=r, mode="clip")
        np.right_shift(x, np.uint64(32), out=y)
        np.bitwise_and(y, sixteen, out=y)
        np.take(log_gamma, y.view(np.int64), out=log_c, mode="clip")
        np.right_shift(x, np.uint64(16), out=y)
        np.bitwise_and(y, sixteen, out=y)
        np.multiply(y, np.float32(1 / (1 << 16)), out=beta, casting="unsafe")
        np.divide(log_w, r, out=t)
        np.add(t, beta, out=t)
        np.floor(t, out=t)
        np.subtract(t, beta, out=beta)
        np.multiply(r, beta, out=beta)
        np.subtract(log_c, beta, out=log_c)
        np.subtract(log_c, r, out=log_c)
        np.minimum.reduceat(log_c, starts, out=least)
        np.take(least, own, out=beta, mode="clip")
        np.equal(log_c, beta, out=best)
        at = np.flatnonzero(best)  # one shingle of each text, more only in a tie
        chosen = common.mixed(h[at] ^ (t[at].astype(np.int64).view(np.uint64) << np.uint64(40)) ^ np.uint64(k))
        sample = chosen if len(at) == len(count) else np.minimum.reduceat(chosen, np.searchsorted(at, starts))
        low[:, k] = sample & np.uint64(0xFF)
        out[:, k // rows] = common.mixed(out[:, k // rows] * np.uint64(31) + sample + np.uint64(k))


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two texts, each its sorted hashes and weights."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both / (a[1].sum() + b[1].sum() - both))


def sketches(rows: DataFrame, docs: int) -> DataFrame:
    """Of each row of a numbered table its bands, its samples and the codes of its shingles' frequencies."""
    spark = rows.sparkSession
    n = exchange.buckets(spark)
    asked = exchange.ask(rows, lambda part: shingles(part.column("text"))[0], n, 4)
    answers = exchange.answer(asked, _frequency_codes, 4)

    def binary(ends: np.ndarray, data: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])

    def sketch(part, replies):
        h, tf, count = shingles(part.column("text"))
        codes = exchange.returned(h, replies, n)
        found, low = bands(h, tf * idf(codes, docs), count) if len(h) else (np.zeros((0, BANDS), np.uint64), np.zeros((0, BANDS * ROWS), np.uint8))
        each = np.concatenate([[0], np.cumsum(count > 0)])
        band = pa.ListArray.from_arrays(pa.array((each * BANDS).astype(np.int32)), pa.array(found.ravel().view(np.int64)))
        size = pc.binary_length(part.column("text").cast(pa.large_binary()))
        return {**{c: part.column(c) for c in ("rid", "doc_id", "key")}, "size": size, "bands": band, "samples": binary(each * BANDS * ROWS, low), "codes": binary(np.concatenate([[0], np.cumsum(count)]), codes)}

    kind = rows.schema["doc_id"].dataType.simpleString()
    return exchange.together(rows, answers, sketch, f"rid long, doc_id {kind}, key binary, size long, bands array<long>, samples binary, codes binary")


def _samples(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)


def promising(pairs: DataFrame, made: DataFrame) -> DataFrame:
    """The pairs (rid, pivot) that agree in enough samples to be worth comparing."""

    def agree(part):
        enough = pa.array((_samples(part.column("a")) == _samples(part.column("b"))).sum(1) >= AGREEING)
        return {"rid": part.column("rid").filter(enough), "pivot": part.column("pivot").filter(enough)}

    a = made.select("rid", F.col("samples").alias("a"))
    b = made.select(F.col("rid").alias("pivot"), F.col("samples").alias("b"))
    return common.map_slices(pairs.join(a, "rid").join(b, "pivot").select("rid", "pivot", "a", "b"), agree, "rid long, pivot long", "a")


def whole(rids: DataFrame, rows: DataFrame, made: DataFrame) -> DataFrame:
    """rid, text and codes of the named rows (a column of a saved table): only their texts are dealt out."""
    rids = common.broadcast_if_small(rids, 16)
    return rows.select("rid", "text").join(rids, "rid", "left_semi").join(made.select("rid", "codes").join(rids, "rid", "left_semi"), "rid")


def verified(pairs: DataFrame, texts: DataFrame, docs: int, least: float = SIMILARITY) -> DataFrame:
    """Pairs (rid, pivot) with whether they are similar, from the whole texts of both (texts: rid, text, codes)."""

    def compare(part):
        out = []
        sides = []
        for side in ("a", "b"):
            h, tf, count = shingles(part.column(f"{side}_text"))
            weight = tf * idf(np.frombuffer(b"".join(part.column(f"{side}_codes").to_pylist()), np.uint8), docs)
            sides.append((h, weight, np.concatenate([[0], np.cumsum(count)])))
        for i in range(part.num_rows):
            a, b = ((h[e[i] : e[i + 1]], w[e[i] : e[i + 1]]) for h, w, e in sides)
            out.append(similarity(a, b) >= least)
        return {"rid": part.column("rid"), "pivot": part.column("pivot"), "near": out}

    a = texts.select("rid", F.col("text").alias("a_text"), F.col("codes").alias("a_codes"))
    b = texts.select(F.col("rid").alias("pivot"), F.col("text").alias("b_text"), F.col("codes").alias("b_codes"))
    both = pairs.join(a, "rid").join(b, "pivot").select("rid", "pivot", "a_text", "a_codes", "b_text", "b_codes")
    return common.map_slices(both, compare, "rid long, pivot long, near boolean", "a_text")


def links(members: DataFrame, rows: DataFrame, made: DataFrame, docs: int, least: float = SIMILARITY) -> DataFrame:
    """node and root of the texts joined by verified links within buckets (members: bucket, rid, mates, size)."""
    pivots = members.groupBy("bucket").agg(F.min(F.struct(-F.col("mates"), F.col("rid").alias("pivot"))).alias("best")).select("bucket", "best.pivot")
    tested = members.join(pivots, "bucket").filter("rid != pivot").select(F.greatest("rid", "pivot").alias("rid"), F.least("rid", "pivot").alias("pivot")).distinct()
    tested = common.saved(promising(tested, made), "near-dup-tested")
    named = tested.select("rid").unionAll(tested.select("pivot")).distinct()
    texts = common.saved(whole(named, rows, made), "near-dup-texts")
    near = common.saved(verified(tested, texts, docs, least).filter("near").select("rid", "pivot"), "near-dup-links")
    common.forget(tested, texts)
    roots = components(near)
    common.forget(near)
    exchange.release(members.sparkSession)
    hopeful = common.saved(_hopeful(_apart(members, roots), made), "near-dup-apart")
    found = common.saved(searched(hopeful, rows, made, docs, least), "near-dup-links")
    common.forget(hopeful)
    if found.isEmpty():
        common.forget(found)
        return roots
    # The components so far are stars: with the new links they stand for all links.
    out = components(found.unionAll(roots))
    common.forget(found, roots)
    return out


def _apart(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members with their component's root and their block, of the buckets whose pivot left more than one component.  A member
    goes to each tile of its block with another one."""
    named = members.join(roots, F.col("rid") == F.col("node"), "left").select("bucket", "rid", "size", F.coalesce("root", "rid").alias("root"))
    sums = named.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("n"), F.sum("size").alias("bytes"))
    several = sums.filter("a != b AND n > 2").select("bucket", F.ceil(F.col("bytes") / TILE_BYTES).alias("blocks"))
    placed = named.join(several, "bucket").withColumn("block", F.pmod(F.xxhash64("rid"), F.greatest("blocks", F.lit(1))))
    tiled = placed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest("blocks", F.lit(1)) - 1)).alias("other"))
    return tiled.select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "rid", "root")


def agreeing(samples: np.ndarray, root: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Which texts agree in enough samples with one of another root (of two blocks: with one of the other block)."""
    out = np.zeros(len(root), bool)
    two = block.min() != block.max()
    names, own, often = np.unique(root, return_inverse=True, return_counts=True)
    for x in np.flatnonzero(own != often.argmax()):  # the largest component meets the others from their side
        other = own != own[x]
        if two:
            other &= block != block[x]
        at = np.flatnonzero(other)
        hits = at[(samples[at] == samples[x]).sum(1) >= AGREEING]
        if len(hits):
            out[x] = True
            out[hits] = True
    return out


def _hopeful(tiles: DataFrame, made: DataFrame) -> DataFrame:
    """The rows of each tile that agree with one of another component: only their texts are read."""
    columns = ("bucket", "low", "high", "block", "rid", "root")

    def tile(table: pa.Table) -> pa.Table:
        keep = agreeing(_samples(table.column("samples").combine_chunks()), table.column("root").to_numpy(), table.column("block").to_numpy())
        return table.select(columns).filter(pa.array(keep))

    with_samples = tiles.join(made.select("rid", "samples"), "rid")
    return with_samples.groupBy("bucket", "low", "high").applyInArrow(tile, ", ".join(f"{c} long" for c in columns))


def close(h: np.ndarray, weight: np.ndarray, count: np.ndarray, root: np.ndarray, block: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Places of texts (none without shingles) that are similar: enough pairs to join the roots of all that are.  Of two blocks only pairs
    between them are looked at."""
    starts = np.cumsum(count) - count
    own = np.repeat(np.arange(len(count)), count)
    total = np.add.reduceat(weight, starts)
    _, kind, often = np.unique(h, return_inverse=True, return_counts=True)
    order = np.lexsort((kind, often[kind], own))
    before = np.cumsum(weight[order])
    before = before - before[starts][own] + weight[order][starts][own] - weight[order]
    rare = before <= (1 - least) * total[own] * (1 + 1e-6) + 1e-6
    kind, own = kind[order][rare], own[rare]
    by = np.argsort(kind, kind="stable")
    holders = own[by]
    first = np.flatnonzero(np.concatenate([[True], kind[by][1:] != kind[by][:-1]]))
    begin = np.empty(len(kind), np.int64)
    begin[by] = np.repeat(first, np.diff(np.append(first, len(by))))
    place = np.empty(len(kind), np.int64)
    place[by] = np.arange(len(by))
    # Holders of a shingle are in order: those between its first place and a text's own come before the text.
    met = np.flatnonzero(place > begin)
    ends = np.searchsorted(own[met], np.arange(len(count) + 1))
    root, found, two = root.copy(), [], block.min() != block.max()
    for x in range(len(count)):
        mine = met[ends[x] : ends[x + 1]]
        if not len(mine):
            continue
        others = np.unique(np.concatenate([holders[a:b] for a, b in zip(begin[mine], place[mine], strict=True)]))
        others = others[root[others] != root[x]]
        if two:
            others = others[block[others] != block[x]]
        a = slice(starts[x], starts[x] + count[x])
        for y in others[np.minimum(total[others], total[x]) >= least * np.maximum(total[others], total[x]) * (1 - 1e-6)]:
            b = slice(starts[y], starts[y] + count[y])
            if root[x] != root[y] and similarity((h[a], weight[a]), (h[b], weight[b])) >= least:
                found.append((x, int(y)))
                root[root == root[y]] = root[x]
    return found


def searched(tiles: DataFrame, rows: DataFrame, made: DataFrame, docs: int, least: float = SIMILARITY) -> DataFrame:
    """Links (rid, pivot) between the components of each tile, from whole texts."""

    def tile(table: pa.Table) -> pa.Table:
        table = table.sort_by("rid").combine_chunks()
        h, tf, count = shingles(table.column("text"))
        weight = tf * idf(np.frombuffer(b"".join(table.column("codes").to_pylist()), np.uint8), docs)
        rid, root, block = (table.column(c).to_numpy() for c in ("rid", "root", "block"))
        found = np.array(close(h, weight, count, root, block, least), np.int64).reshape(-1, 2)
        return pa.table({"rid": rid[found[:, 0]], "pivot": rid[found[:, 1]]})

    texts = whole(tiles.select("rid").distinct(), rows, made)
    return tiles.join(texts, "rid").groupBy("bucket", "low", "high").applyInArrow(tile, "rid long, pivot long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: every node of the links that is not its component's smallest, and the smallest.  Large-star and small-star steps in
    turn, each a shuffle by node with a partial minimum, until all links are stars; links are saved after both."""
    u, v = edges.columns
    now = common.saved(edges.filter(F.col(u) != F.col(v)).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "components")
    while not _stars(now):
        around = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = around.join(least, "u").filter("v > u AND v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, now = now, common.saved(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), "components")
        common.forget(before)
    return now.toDF("node", "root")


def _stars(edges: DataFrame) -> bool:
    """Whether each u, always greater than its v, has one link and is no other node's v."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """rid, doc_id, class_id and whether the row is its class's first, for every row of `df`."""
    rows = exchange.numbered(df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")), "near-dup-rows")
    out = _classes(rows, least)
    common.forget(rows)
    return out


def _classes(rows: DataFrame, least: float) -> DataFrame:
    """The saved classes of a numbered table (rid, block, doc_id, text).  Texts are kept there alone; all else that is
    saved on the way goes when it has been read."""
    spark, docs = rows.sparkSession, rows.count()
    made = common.saved(sketches(rows.withColumn("key", F.unhex(F.md5("text"))), docs), "near-dup-sketches")
    exchange.release(spark)
    copies = common.saved(made.groupBy("key").agg(F.min("rid").alias("rep"), F.min("doc_id").alias("least"), F.min_by("bands", "rid").alias("bands"), F.max("size").alias("size")), "near-dup-copies")
    # A band's number is in its hash, so the hash alone names the bucket.
    spread = copies.select(F.col("rep").alias("rid"), "size", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    mates = F.sum("n").over(Window.partitionBy("rid"))
    members = common.saved(spread.join(shared, "bucket").withColumn("mates", mates).drop("n"), "near-dup-buckets")
    exchange.release(spark)
    roots = links(members, rows, made, docs, least)
    common.forget(members)
    joined = copies.select("key", "rep", "least").join(roots, F.col("rep") == F.col("node"), "left").select("key", "rep", "least", F.coalesce("root", "rep").alias("root"))
    named = joined.groupBy("root").agg(F.min("least").alias("class_id"))
    by_key = joined.join(named, "root").select("key", "root", "class_id")
    out = common.saved(made.select("rid", "doc_id", "key").join(by_key, "key").select("rid", "doc_id", "class_id", (F.col("rid") == F.col("root")).alias("first")), "near-dup-classes")
    common.forget(made, copies, roots)
    exchange.release(spark)
    return out


def distinct(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`df` with one row of each class.  Its columns travel inside one, so their names cannot clash with those made here."""
    kept = exchange.numbered(df.select(F.struct("*").alias("_row")), "near-dup-rows")
    own = kept.select("rid", "block", F.col("_row").getField(doc_id).alias("doc_id"), F.coalesce(F.col("_row").getField(text).cast("string"), F.lit("")).alias("text"))
    first = _classes(own, SIMILARITY).filter("first").select("rid")
    return kept.join(first, "rid", "left_semi").select("_row.*")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(common.table(spark, sf_dir, "documents")).select("doc_id", "class_id", F.col("first").alias("kept"))
