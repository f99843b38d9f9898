"""Benchmark decontamination by pigeonhole edit matching.

Documents and test items are compared as lower-case words joined by one blank.  An item of m characters may be met with
k = floor(ERROR_RATE * m) edits.  It is split into k + 1 pieces: k edits leave at least one piece whole, so every match
holds an exact piece.  All pieces of all items are found in one pass over each whole text (Aho-Corasick); around the
places where a piece puts its item, Myers' bit-parallel algorithm gives the least edit distance.

Items are a stated query set.  They reach the tasks in blocks of at most BLOCK_CHARS characters, one job part for each
block, whatever their number.  Items with fewer than LEAST_CHARS characters after normalising lie within many longer
words: they are met without edits and as whole words only.  Items without a word, null items and null texts match nothing.  Repeated documents give repeated rows, repeated item_ids
are items of their own, empty tables give no rows.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

ERROR_RATE = 0.08
LEAST_CHARS = 20
BLOCK_CHARS = 4_000_000
WORD = re.compile(r"\w+")


def normal(text: str) -> str:
    return " ".join(WORD.findall(text.lower()))


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """errors + 1 pieces of nearly equal length, each with its place."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def distances(item: str, masks: dict[str, int], text: str) -> tuple[int, int]:
    """Myers: the least edit distance of the item to any substring of the text, and where the first such one ends."""
    m = len(item)
    top, full = 1 << (m - 1), (1 << m) - 1
    up, down, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        x = eq | down
        d0 = (((x & up) + up) ^ up) | x
        h_up, h_down = down | (full & ~(d0 | up)), up & d0
        if h_up & top:
            score += 1
        elif h_down & top:
            score -= 1
        h_up = h_up << 1 & full
        h_down = h_down << 1 & full
        up, down = h_down | (full & ~(d0 | h_up)), h_up & d0
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    def __init__(self, items: list[tuple[object, str]], rate: float = ERROR_RATE, least: int = LEAST_CHARS):
        import ahocorasick

        known = [(i, normal(t or "")) for i, t in items]
        self.items = [(i, t, int(rate * len(t)) if len(t) >= least else 0) for i, t in known if t]
        self.masks: list[dict[str, int]] = []
        places: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text, errors) in enumerate(self.items):
            mask: dict[str, int] = {}
            for j, c in enumerate(text):
                mask[c] = mask.get(c, 0) | 1 << j
            self.masks.append(mask)
            if len(text) < least:  # with a blank on either side, as a whole
                places.setdefault(f" {text} ", []).append((number, None))
                continue
            for at, piece in pieces(text, errors):
                places.setdefault(piece, []).append((number, at))
        self.finder = ahocorasick.Automaton()
        for piece, where in places.items():
            self.finder.add_word(piece, (len(piece), where))
        if places:
            self.finder.make_automaton()

    def matches(self, text: str) -> list[tuple[object, int, int, int]]:
        """(item, distance, errors allowed, end in the normal text) of each item within its budget."""
        if not self.items:
            return []
        text = normal(text)
        begins: dict[int, set[int]] = {}
        whole: dict[int, int] = {}
        for last, (size, where) in self.finder.iter(f" {text} "):
            for number, at in where:
                if at is None:
                    whole.setdefault(number, last - 1)
                else:
                    begins.setdefault(number, set()).add(last - size - at)
        out = [(self.items[number][0], 0, 0, end) for number, end in sorted(whole.items())]
        for number, starts in sorted(begins.items()):
            item, body, errors = self.items[number]
            best = (errors + 1, 0)
            for a, b in _windows(sorted(starts), len(body), errors, len(text)):
                d, end = distances(body, self.masks[number], text[a:b])
                best = min(best, (d, a + end))
                if d == 0:
                    break
            if best[0] <= errors:
                out.append((item, best[0], errors, best[1]))
        return out


def _windows(starts: list[int], size: int, errors: int, end: int) -> list[tuple[int, int]]:
    """The parts of the text in which a match with one of these starts lies, overlapping ones as one."""
    out: list[list[int]] = []
    for s in starts:
        a, b = max(0, s - errors), min(end, s + size + errors)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", chars: int = BLOCK_CHARS) -> list[list[tuple]]:
    """The items in blocks of about `chars` characters; one block is in the driver's hands at a time as it is made."""
    items = benchmark.filter(F.col(text).isNotNull()).select(F.col(item_id).alias("item"), F.col(text).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // chars)
    part = F.pmod(F.xxhash64("item", "text"), F.lit(max(1, n)))
    for i in range(n):
        yield sorted(map(tuple, items.filter(part == i).collect()), key=str)


def match(df: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", rate: float = ERROR_RATE, least: int = LEAST_CHARS, chars: int = BLOCK_CHARS) -> DataFrame:
    """One row for each document and item that it holds within the budget."""
    schema = f"{doc_id} {df.schema[doc_id].dataType.simpleString()}, {item_id} {benchmark.schema[item_id].dataType.simpleString()}, distance int, errors_allowed int, end_at long"

    def part_of(items: list[tuple]) -> DataFrame:
        make = _once(items, rate, least)

        def rows(part):
            found = [make().matches(t) for t in part.column("text").to_pylist()]
            flat = [m for ms in found for m in ms]
            if not flat:
                return None
            at = np.repeat(np.arange(len(found)), [len(ms) for ms in found])
            return {doc_id: part.column(doc_id).take(at), **{name: [m[k] for m in flat] for k, name in enumerate((item_id, "distance", "errors_allowed", "end_at"))}}

        return common.map_slices(common.texts(df, doc_id, text=text).withColumnRenamed(text, "text"), rows, schema)

    parts = [part_of(items) for items in blocks(benchmark, item_id, text, chars)]
    return reduce(DataFrame.unionAll, parts) if parts else df.sparkSession.createDataFrame([], schema)


def _once(items: list[tuple], rate: float, least: int):
    """A matcher for each task, made when it first is asked for: an automaton does not travel."""
    made: list[Matcher] = []

    def get() -> Matcher:
        if not made:
            made.append(Matcher(items, rate, least))
        return made[0]

    return get


def clean(df: DataFrame, benchmark: DataFrame, text: str = "text", rate: float = ERROR_RATE) -> DataFrame:
    """The rows of `df` that hold no item."""
    for items in blocks(benchmark):
        df = df.filter(_free(items, rate)(F.coalesce(F.col(text), F.lit(""))))
    return df


def _free(items: list[tuple], rate: float) -> Column:
    make = _once(items, rate, LEAST_CHARS)

    @F.pandas_udf("boolean")
    def free(values):
        return values.map(lambda t: not make().matches(t)).astype(bool)

    return free


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
