"""Secret scan: fixed patterns, and character Markov models of random strings and of ordinary identifiers.

Training is one Spark job over a bounded sample of documents (TRAIN_DOCS, chosen by a hash of the id).  Its labels come
from the text itself: values that a fixed pattern marks as secret are samples of random strings, shorter runs of the
same signs than a candidate has are ordinary.  Of each class first-order transition counts are summed over the sample.
A candidate is a run of at least MIN_CHARS signs outside the pattern spans; it is reported if its log-likelihood ratio
for each sign is above the threshold.  The threshold is calibrated on all documents that the models have not seen: of
their short runs that read like words, joined in their order until they are as long as a candidate, at most one in
FALSE_ALARMS is above it.  No candidate is among them, so the threshold does not rise with the share of unmarked keys.
Without samples of secrets the random model is uniform.

Null text is empty and has no spans; repeated rows give repeated rows; an empty table gives none.  Positions are code
points of the whole text, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# The patterns of the base rule, in their order.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"

KEYWORDS = ("passw", "secret", "token", "api")
RUN = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")
#: Letters of one case or capitalised, and short numbers, with signs between.
WORDLIKE = re.compile(r"(?:(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4})(?:[+/_.=-]+|\Z)|[+/_.=-]+)+")
MIN_CHARS = 20
TRAIN_DOCS = 20_000
FALSE_ALARMS = 100_000
#: Bins of the calibration histogram for each unit of log-likelihood ratio.
BINS = 50
START = len(SIGNS)
WIDTH = START + 1
_CODE = np.full(256, START, np.uint8)
_CODE[np.frombuffer(SIGNS.encode(), np.uint8)] = np.arange(START)


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(start, end, kind) of the fixed patterns, by start, then kind; and the spans of the secret strings proper."""
    found, values = [], []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                found.append((m.start(), m.end(), 0))
                values.append(m.span(2))
    for kind, pattern, least in ((1, ACCESS, 20), (2, HEX, 24)):
        for m in pattern.finditer(text):
            if m.end() - m.start() >= least:
                found.append((m.start(), m.end(), kind))
                values.append(m.span())
    found.sort(key=lambda s: (s[0], s[2]))
    return found, values


def free_runs(text: str, taken: list[tuple[int, int, int]], least: int) -> Iterable[tuple[int, int]]:
    """Runs of signs that touch no taken span."""
    for m in RUN.finditer(text):
        a, b = m.span()
        if b - a >= least and not any(s < b and a < e for s, e, _ in taken):
            yield a, b


def transitions(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each sign of all words the pair (sign before, sign) as one number, and the number of the word."""
    codes = _CODE[np.frombuffer(("\n" + "\n".join(words)).encode("latin-1"), np.uint8)]
    real = codes[1:] != START
    pairs = codes[:-1].astype(np.int64) * WIDTH + codes[1:]
    return pairs[real], np.repeat(np.arange(len(words)), [len(w) for w in words])


class Model:
    def __init__(self, random: np.ndarray, ordinary: np.ndarray, threshold: float = 0.0):
        def log_p(counts: np.ndarray) -> np.ndarray:
            counts = counts.reshape(WIDTH, WIDTH)[:, :START]
            signs = counts.sum(0) + 0.5  # what a sign before has rarely or never had behind it falls back to all signs
            smooth = counts + 0.5 * START * signs / signs.sum()
            return np.log(smooth / smooth.sum(1, keepdims=True))

        ratio = np.zeros((WIDTH, WIDTH))
        ratio[:, :START] = log_p(random if random.sum() else np.zeros(WIDTH * WIDTH)) - log_p(ordinary)
        self.ratio, self.threshold = ratio.ravel(), threshold

    def scores(self, words: list[str]) -> np.ndarray:
        """Mean log-likelihood ratio of each word, random against ordinary."""
        if not words:
            return np.zeros(0)
        pairs, word = transitions(words)
        return np.bincount(word, self.ratio[pairs], len(words)) / np.bincount(word, minlength=len(words))

    def spans(self, text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        runs = list(free_runs(text, taken, MIN_CHARS))
        keep = self.scores([text[a:b] for a, b in runs]) > self.threshold
        return [(a, b, 3) for (a, b), k in zip(runs, keep, strict=True) if k]


def _samples(texts: list[str]) -> tuple[list[str], list[str]]:
    secret, ordinary = [], []
    for t in texts:
        base, values = base_spans(t)
        secret += [t[a:b] for a, b in values]
        ordinary += [t[a:b] for a, b in free_runs(t, base, 8) if b - a < MIN_CHARS]
    return secret, ordinary


def negatives(ordinary: list[str]) -> list[str]:
    """Runs as long as a candidate that cannot be unmarked secrets: word-like short runs, joined."""
    out, at = [], ""
    for w in filter(WORDLIKE.fullmatch, ordinary):
        at += w
        if len(at) >= MIN_CHARS:
            out.append(at)
            at = ""
    return out


def train(df: DataFrame, doc_id: str = "doc_id", text: str = "text", docs: int = TRAIN_DOCS) -> Model:
    """Counts come to the driver summed: WIDTH squared for each class, and a histogram of scores."""
    total = df.count()
    fit = common.share(doc_id, total, docs) & (F.pmod(F.xxhash64(F.col(doc_id), F.lit(1)), F.lit(2)) == 0)
    every = common.texts(df.withColumn("_fit", fit), doc_id, "_fit", text=text).select(F.col(text).alias("text"), F.col("_fit").alias("fit"))

    def count(part):
        out = [np.bincount(transitions(words)[0], minlength=WIDTH * WIDTH) if words else np.zeros(WIDTH * WIDTH, np.int64) for words in _samples(part.column("text").to_pylist())]
        where = [np.flatnonzero(c) for c in out]
        return {"label": np.repeat([0, 1], [len(w) for w in where]), "pair": np.concatenate(where), "n": np.concatenate([c[w] for c, w in zip(out, where, strict=True)])}

    sums = np.zeros((2, WIDTH * WIDTH))
    for r in common.map_slices(every.filter("fit"), count, "label int, pair int, n long").groupBy("label", "pair").sum("n").collect():
        sums[r[0], r[1]] = r[2]
    model = Model(sums[0], sums[1])

    def score(part):
        _, ordinary = _samples(part.column("text").to_pylist())
        bins, n = np.unique(np.floor(model.scores(negatives(ordinary)) * BINS).astype(np.int64), return_counts=True)
        return {"bin": bins, "n": n}

    held = sorted(common.map_slices(every.filter("NOT fit"), score, "bin int, n long").groupBy("bin").sum("n").collect(), reverse=True)
    allowed, above, threshold = sum(r[1] for r in held) // FALSE_ALARMS, 0, 0.0
    for r in held:
        above += r[1]
        if above > allowed:
            threshold = max(0.0, (r[0] + 1) / BINS)
            break
    model.threshold = threshold
    return model


def found(text: str, model: Model | None) -> tuple[list, list]:
    base, _ = base_spans(text)
    extra = model.spans(text, base) if model else []
    return base, sorted(base + extra, key=lambda s: (s[0], s[2]))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def scan(df: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans of every document.  Row-local; the model is a few kB."""

    def rows(part):
        both = [found(t, model) for t in part.column(text).to_pylist()]
        kinds = [[k for _, _, k in every] for _, every in both]
        return {
            doc_id: part.column(doc_id), **{f"n_{name}": [ks.count(k) for ks in kinds] for k, name in enumerate(KINDS)},
            "base_sha256": [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in both], "spans": [joined(every) for _, every in both],
        }

    kind = df.schema[doc_id].dataType.simpleString()
    return common.map_slices(common.texts(df, doc_id, text=text), rows, f"{doc_id} {kind}, n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string", text)


def redacted(text: str, model: Model | None, mark: str = "[secret]") -> str:
    """The text with each run of overlapping spans replaced by the mark."""
    out, at = [], 0
    for a, b, _ in found(text, model)[1]:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """`df` with secrets replaced in `text`; null stays null."""

    @F.pandas_udf("string")
    def clean(values):
        return values.map(lambda t: None if t is None else redacted(t, model))

    return df.withColumn(text, clean(F.col(text)))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return scan(docs, train(docs))
