"""Language identification with interpolated Kneser-Ney character models.

For each language a model of character 4-grams over lower-case letters (all else is one blank) is counted by Spark on a
bounded, documented sample of labelled training documents (FIT_DOCS of a language, chosen by a hash of the id).
Interpolated Kneser-Ney: absolute discounts from the counts of counts, lower orders from continuation counts, a uniform
distribution at the end.  For each order the n-grams of all languages stand in one array sorted by hash, with a column
of log-probabilities for each language, so one search serves all languages; only n-grams no language has seen fall
back to the context weights and the next order.

A text's language is the one with the least cross-entropy for each character.  Rejection is calibrated on other
training documents (CALIBRATE_DOCS of a language): the excess over the language's mean entropy, damped for short
texts, must not pass the largest seen by more than MARGIN nats.

lang_pred is `und`, score 0 and rejected true for null text, text without letters, or if there is nothing to learn
from.  A null doc_id counts as an empty one in the split.  Repeated rows give repeated rows; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

ORDER = 4
FIT_DOCS = 2_000
CALIBRATE_DOCS = 1_000
MARGIN = 0.3
#: Letters from which on a text's mean entropy counts as settled.
SETTLED = 200
#: Characters that the score treats as independent evidence.
EVIDENCE = 20
BLANK, EDGE, RARE = 32, 1, 0xFFFF

_LETTER = None


def _letter() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)
    return _LETTER


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The 4-gram that ends at each character of the texts, packed in 64 bits, and how many each text has."""
    codes, offsets = common.code_points([("\1\1\1" + t.lower().replace("\1", " ")) for t in texts])
    edge = codes == EDGE
    codes = np.where(_letter()[codes], np.minimum(codes, RARE), np.where(edge, EDGE, BLANK)).astype(np.uint64)
    before = np.concatenate([[np.uint64(EDGE)], codes[:-1]])
    keep = (codes != BLANK) | ((before != BLANK) & (before != EDGE))
    text = np.repeat(np.arange(len(texts)), np.diff(offsets))[keep]
    codes = codes[keep]
    packed = codes.copy()
    for back in range(1, ORDER):
        packed[back:] |= codes[:-back] << np.uint64(16 * back)
    real = codes != EDGE
    return packed[real], np.bincount(text[real], minlength=len(texts))


class HashArray:
    """Keys in the order of their hash, with an index on the leading bits."""

    def __init__(self, keys: np.ndarray):
        h = common.mixed(keys)
        self.order = np.argsort(h)
        self.hashes = h[self.order]
        bits = max(1, len(keys).bit_length())
        self.shift = np.uint64(64 - bits)
        self.starts = np.searchsorted(self.hashes >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)
        self.deepest = int(np.diff(self.starts).max(initial=0))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places in the sorted array, -1 for keys it lacks."""
        h = common.mixed(keys)
        bucket = (h >> self.shift).astype(np.int64)
        at, end = self.starts[bucket], self.starts[bucket + 1]
        out = np.full(len(keys), -1, np.int64)
        todo = np.flatnonzero(at < end)
        for _ in range(self.deepest):
            hit = self.hashes[at[todo]] == h[todo]
            out[todo[hit]] = at[todo[hit]]
            todo = todo[~hit]
            at[todo] += 1
            todo = todo[at[todo] < end[todo]]
            if not len(todo):
                break
        return out


class Model:
    def __init__(self, langs: list[str], keys: list[np.ndarray], counts: list[np.ndarray]):
        """Distinct 4-grams of each language with their counts."""
        self.langs = langs
        self.mean, self.limit = np.zeros(len(langs)), np.full(len(langs), np.inf)
        if not langs:
            return
        union, table = [None] * (ORDER + 1), [None] * (ORDER + 1)
        union[ORDER] = np.unique(np.concatenate([np.zeros(0, np.uint64), *keys]))
        table[ORDER] = np.zeros((len(union[ORDER]), len(langs)))
        for i, (k, c) in enumerate(zip(keys, counts, strict=True)):
            table[ORDER][np.searchsorted(union[ORDER], k), i] = c
        suffix = [None] * (ORDER + 1)
        for n in range(ORDER, 1, -1):  # continuation counts: how many longer n-grams end so
            cut = np.uint64((1 << 16 * (n - 1)) - 1)
            union[n - 1], suffix[n] = np.unique(union[n] & cut, return_inverse=True)
            table[n - 1] = np.stack([np.bincount(suffix[n], table[n][:, i] > 0, len(union[n - 1])) for i in range(len(langs))], 1)
        self.letters = len(union[1]) + 1
        lower = np.full(len(langs), 1.0 / self.letters)  # under the unigrams lies a uniform distribution
        self.arrays, self.log_p, self.contexts, self.log_weight = [None] * (ORDER + 1), [None] * (ORDER + 1), [None] * (ORDER + 1), [None] * (ORDER + 1)
        for n in range(1, ORDER + 1):
            c = table[n]
            ones, twos = (c == 1).sum(0), (c == 2).sum(0)
            discount = np.where(ones > 0, ones / np.maximum(1, ones + 2 * twos), 0.5).clip(0.1, 0.95)
            contexts, inverse = np.unique(union[n] >> np.uint64(16), return_inverse=True)
            total = np.stack([np.bincount(inverse, c[:, i], len(contexts)) for i in range(len(langs))], 1)
            kinds = np.stack([np.bincount(inverse, c[:, i] > 0, len(contexts)) for i in range(len(langs))], 1)
            weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            p = np.maximum(c - discount, 0) / np.maximum(total, 1)[inverse] + weight[inverse] * (lower[suffix[n]] if n > 1 else lower)
            self.arrays[n], self.contexts[n] = HashArray(union[n]), HashArray(contexts)
            self.log_p[n] = np.log(p[self.arrays[n].order]).astype(np.float32)
            self.log_weight[n] = np.log(weight[self.contexts[n].order]).astype(np.float32)
            lower = p
        self.log_uniform = -np.log(self.letters)

    def log_probability(self, packed: np.ndarray, n: int = ORDER) -> np.ndarray:
        """One row for each n-gram, one column for each language."""
        if n == 0:
            return np.full((len(packed), len(self.langs)), self.log_uniform, np.float32)
        at = self.arrays[n].find(packed)
        out = self.log_p[n][at] if len(self.log_p[n]) else np.zeros((len(packed), len(self.langs)), np.float32)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            context = self.contexts[n].find(packed[missing] >> np.uint64(16))
            weight = np.where((context < 0)[:, None], np.float32(0), self.log_weight[n][context])
            out[missing] = weight + self.log_probability(packed[missing] & np.uint64((1 << 16 * (n - 1)) - 1), n - 1)
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy in nats a character for each text and language, and the characters of each text."""
        packed, n = grams(texts)
        out = np.zeros((len(texts), len(self.langs)))
        some = np.flatnonzero(n)
        if len(some):
            begins = (np.cumsum(n) - n)[some]
            out[some] = -np.add.reduceat(self.log_probability(packed), begins, axis=0, dtype=np.float64) / n[some, None]
        return out, n

    def excess(self, entropy: np.ndarray, lang: np.ndarray, n: np.ndarray) -> np.ndarray:
        return (entropy - self.mean[lang]) * np.sqrt(np.minimum(n, SETTLED) / SETTLED)

    def calibrate(self, lang: np.ndarray, entropy: np.ndarray, n: np.ndarray) -> None:
        for i in range(len(self.langs)):
            own = lang == i
            if own.any():
                self.mean[i] = entropy[own].mean()
                self.limit[i] = self.excess(entropy[own], lang[own], n[own]).max() + MARGIN

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score between 0 and 1, and whether it is rejected."""
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        entropy, n = self.entropies(texts)
        best = entropy.argmin(1)
        least = entropy[np.arange(len(texts)), best]
        score = 1 / np.exp(-(entropy - least[:, None]) * np.minimum(n, EVIDENCE)[:, None]).sum(1)
        rejected = (n == 0) | (self.excess(least, best, n) > self.limit[best])
        return [self.langs[b] if k else "und" for b, k in zip(best.tolist(), (n > 0).tolist(), strict=True)], np.where(n > 0, score, 0.0), rejected


def remainder(doc_id: str) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


def train(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", fit: int = FIT_DOCS, calibrate: int = CALIBRATE_DOCS) -> Model:
    """Fits on documents whose remainder is 1 to 3, calibrates on remainder 4; remainder 0 is held out."""
    labelled = df.select(F.col(doc_id).cast("string").alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"), remainder(doc_id).alias("part")).filter("lang IS NOT NULL AND text IS NOT NULL AND part > 0")
    sizes = {r["lang"]: (r["fit"], r["held"]) for r in labelled.groupBy("lang").agg(F.count_if(F.col("part") < 4).alias("fit"), F.count_if(F.col("part") == 4).alias("held")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], [], [])

    def sample(held: bool) -> DataFrame:
        bound = calibrate if held else fit
        pick = F.lit(False)
        for x in langs:
            pick = pick | ((F.col("lang") == x) & common.share(F.col("id"), sizes[x][held], bound))
        return labelled.filter((F.col("part") == 4) == held).filter(pick).select("lang", "text")

    def count(part):
        out = []
        names = np.array(part.column("lang").to_pylist())
        texts = part.column("text").to_pylist()
        for x in sorted(set(names.tolist())):
            keys, n = np.unique(grams([texts[i] for i in np.flatnonzero(names == x)])[0], return_counts=True)
            out.append((np.repeat(x, len(keys)), keys.view(np.int64), n))
        return dict(zip(("lang", "gram", "n"), map(np.concatenate, zip(*out, strict=True)), strict=True))

    counts = common.map_slices(sample(False), count, "lang string, gram long, n long", limit=16 * common.SLICE_BYTES).groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    name, gram, n = (counts.column(c).to_numpy() for c in ("lang", "gram", "n"))
    own = [name == x for x in langs]
    model = Model(langs, [np.sort(gram[o].view(np.uint64)) for o in own], [n[o][np.argsort(gram[o].view(np.uint64))] for o in own])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def measure(part):
        entropy, size = shared.value.entropies(part.column("text").to_pylist())
        index = {x: i for i, x in enumerate(langs)}
        own = np.array([index[x] for x in part.column("lang").to_pylist()])
        return {"lang": own, "entropy": entropy[np.arange(len(own)), own], "n": size, "right": entropy.argmin(1) == own}

    seen = common.map_slices(sample(True), measure, "lang int, entropy double, n long, right boolean").filter("n > 0 AND right").toArrow()
    model.calibrate(*(seen.column(c).to_numpy() for c in ("lang", "entropy", "n")))
    return model


def predict(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(model)

    def rows(part):
        lang, score, rejected = shared.value.predict(part.column("text").to_pylist())
        return {doc_id: part.column(doc_id), "held_out": part.column("held_out"), "lang_pred": lang, "score": score, "rejected": rejected}

    kind = df.schema[doc_id].dataType.simpleString()
    ready = df.select(doc_id, (remainder(doc_id) == 0).alias("held_out"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return common.map_slices(ready, rows, f"{doc_id} {kind}, held_out boolean, lang_pred string, score double, rejected boolean")


def accepted(df: DataFrame, model: Model, text: str = "text") -> Column:
    """True for texts that the model does not reject."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def keep(values):
        import pandas as pd

        out = []
        for i in range(0, len(values), 256):
            out.append(~shared.value.predict(values.iloc[i : i + 256].tolist())[2])
        return pd.Series(np.concatenate(out) if out else np.zeros(0, bool))

    return keep(F.coalesce(F.col(text), F.lit("")))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return predict(docs, train(docs))
