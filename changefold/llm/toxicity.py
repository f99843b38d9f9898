"""Toxicity by a weighted lexicon.

Texts are folded first: compatibility forms and marks go, letters of other scripts that look like Latin ones become
them, digits and signs that stand for letters inside words become those (LOOKS; `l`, `i`, `1`, `|` and `!` are one class),
everything else parts words.  The lexicon holds word beginnings and whole words with weights; an Aho-Corasick automaton finds
them all in one pass over the whole text.  A word counts with its heaviest entry.  Exception phrases, a word
alone or with a neighbour, take the entries inside them out.  A word met again adds less (1 + log of its count).  The
sum of weights is divided by 1 + log(1 + words / LENGTH), and a logistic curve maps it to the score.

Learning uses a bounded sample of labelled documents (SAMPLE).  Tasks count, for each fold, how many toxic and other documents
hold an entry; an entry stays if its share of toxic documents exceeds the base rate beyond chance among all entries
tested (likelihood ratio, FALSE_ENTRIES expected by chance), with a smoothed log odds ratio as its weight.  Of nested
entries with equal counts the longest word beginning stays, and an entry goes that a shorter one outweighs.
Exceptions are phrases around entries that EXCEPTION_DOCS documents or more hold, mostly not toxic ones.  The curve is fitted
on scores that each fold gets from the other folds' lexicon, so its probabilities are not those of seen documents.

Defined results.  Null and empty texts score the curve at zero.  Rows with null labels or ids teach nothing; a
document labelled twice is toxic if one label says so; repeated documents have rows of their own and equal scores.
Without labels of both kinds every score is PRIOR.  An empty table gives no rows.  Only id, text and label are read,
so other columns cannot clash.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SAMPLE = 20_000
FOLDS = 2
#: Word beginnings of so many characters, and whole words, can be entries.
SHORTEST, LONGEST = 4, 8
LEAST_DOCS = 3
FALSE_ENTRIES = 1.0
EXCEPTION_DOCS = 3
LENGTH = 1000
PRIOR = 0.1
#: A score from here on is a prediction of label 1.
THRESHOLD = 0.3
RIDGE = 1e-3

# Look-alikes by the letter they stand for.  Greek and Cyrillic letters first, then digits and signs.
LOOKS = {
    "a": "αаɑ4@", "b": "βвьƅ8", "c": "сϲ", "d": "ԁ", "e": "еєεҽ3", "g": "ɡ9", "h": "һнԋ", "i": "іιїɩӏlı1|!", "j": "јϳ",
    "k": "кκ", "m": "м", "n": "ոη", "o": "оοσօ0", "p": "рρ", "q": "ԛ", "r": "гᴦ", "s": "ѕꜱ5$", "t": "тτ7", "u": "υս", "v": "νѵ",
    "w": "ԝωѡ", "x": "хχ", "y": "уγү", "z": "ᴢ2",
}
_MAP = {ord(c): letter for letter, looks in LOOKS.items() for c in looks}
_HIDDEN = frozenset([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
_SIGNS = frozenset(map(ord, "@$|!"))
#: A sign stands for a letter only if a letter follows in its word; digits only in a word with a letter.
_SIGN = re.compile(r"[@$|!](?=[@$|!\d]*[^\W\d_])")
_DIGIT = re.compile(r"[0-9]")
_LATER = {ord(c): _MAP[ord(c)] for c in "0123456789" if ord(c) in _MAP}
_NOT_LETTERS = dict.fromkeys(_SIGNS, " ")


class _Folding(dict):
    """What each code point becomes, worked out when it is first met: letters fold, digits and signs wait, hidden
    characters and marks go, all else parts words."""

    def __missing__(self, code: int) -> str:
        out = ""
        for c in unicodedata.normalize("NFKD", chr(code)).lower() if code not in _HIDDEN else "":
            if unicodedata.combining(c):
                continue
            if c in "0123456789" or ord(c) in _SIGNS:
                out += c
            elif ord(c) in _MAP:
                out += _MAP[ord(c)]
            else:
                out += c if c.isalnum() else " "
        self[code] = out
        return out


_FOLD = _Folding()


def fold(text: str) -> list[str]:
    """The folded words of a text."""
    text = text.translate(_FOLD)
    if "@" in text or "$" in text or "|" in text or "!" in text:
        text = _SIGN.sub(lambda m: _MAP[ord(m[0])], text).translate(_NOT_LETTERS)
    words = text.split()
    if _DIGIT.search(text):
        words = " ".join([w for w in words if not w.isdigit()]).translate(_LATER).split()
    return words


def entries(words: set[str]) -> Iterator[str]:
    """What can be an entry: ` word ` whole and ` begin` of a word."""
    for w in words:
        if len(w) >= SHORTEST:
            yield f" {w} "
            for k in range(SHORTEST, min(len(w), LONGEST) + 1):
                yield f" {w[:k]}"


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: set[str] = field(default_factory=set)  # ` word `, ` word other `

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for entry in self.weights.keys() | self.exceptions:
            found.add_word(entry, (len(entry), self.weights.get(entry), entry in self.exceptions))
        found.make_automaton()
        return found

    def hits(self, text: str, automaton: ahocorasick.Automaton) -> dict[int, float]:
        """Where in ` word word ... ` a word with an entry begins, and its heaviest entry's weight."""
        best: dict[int, float] = {}
        covered: list[tuple[int, int]] = []
        if not len(automaton):
            return best
        for end, (size, weight, exception) in automaton.iter(text):
            begin = end - size + 1
            if weight is not None and weight > best.get(begin, 0.0):
                best[begin] = weight
            if exception:
                covered.append((begin, end))
        for a, b in covered:
            for at in [at for at in best if a <= at < b]:
                del best[at]
        return best


def joined(words: list[str]) -> str:
    return f" {' '.join(words)} "


def amount(words: list[str], lexicon: Lexicon, automaton: ahocorasick.Automaton) -> float:
    text = joined(words)
    hits = lexicon.hits(text, automaton)
    times = Counter(text[at : text.index(" ", at + 1)] for at in hits)
    weight = {text[at : text.index(" ", at + 1)]: w for at, w in hits.items()}
    return sum(w * (1 + np.log(times[word])) for word, w in weight.items()) / (1 + np.log1p(len(words) / LENGTH))


def _counted(df: DataFrame, of) -> DataFrame:
    """entry, fold, toxic, other: documents that hold what `of(words)` gives, summed over each slice first."""

    def run(part: pa.RecordBatch) -> dict:
        n: tuple[Counter, Counter] = (Counter(), Counter())
        for text, fold_, toxic in zip(part.column("text").to_pylist(), part.column("fold").to_pylist(), part.column("toxic").to_pylist(), strict=True):
            n[toxic].update((e, fold_) for e in set(of(fold(text))))
        keys = list(n[0].keys() | n[1].keys())
        return {"entry": [k[0] for k in keys], "fold": [k[1] for k in keys], "toxic": [n[1][k] for k in keys], "other": [n[0][k] for k in keys]}

    return common.map_slices(df, run, "entry string, fold int, toxic long, other long", limit=8 * common.SLICE_BYTES)


def _excess(toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int) -> np.ndarray:
    """Likelihood ratio of the entry's documents against the base rate, 0 below it."""
    base, n = n_toxic / (n_toxic + n_other), toxic + other
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(toxic > 0, toxic * np.log(toxic / (n * base)), 0) + np.where(other > 0, other * np.log(other / (n * (1 - base))), 0)
    return np.where(toxic > n * base, 2 * gain, 0)


def chosen(counts: dict[str, tuple[int, int]], n_toxic: int, n_other: int) -> dict[str, float]:
    """Entries beyond chance with their weights, without those that others make needless."""
    if not counts or not n_toxic or not n_other:
        return {}
    names = list(counts)
    toxic, other = np.array([counts[e] for e in names], float).T
    enough = toxic >= LEAST_DOCS
    bound = 2 * np.log(max(enough.sum(), 1) / FALSE_ENTRIES)
    keep = enough & (_excess(toxic, other, n_toxic, n_other) > max(bound, 10.0))
    weight = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((other + 0.5) / (n_other + 1))
    found = {names[k]: (float(weight[k]), toxic[k], other[k]) for k in np.flatnonzero(keep) if weight[k] > 0}
    longer = {}  # of word beginnings with equal counts the longest says most
    for e in sorted(found, key=len):
        shorter = e[:-1]
        if not e.endswith(" ") and shorter in found and found[shorter][1:] == found[e][1:]:
            longer[shorter] = e
    left = {e: w for e, (w, *_) in found.items() if e not in longer}
    return {e: w for e, w in left.items() if not any(left.get(e[:k], -1.0) >= w for k in range(1 + SHORTEST, len(e)))}


def phrases(words: list[str], lexicon: Lexicon, automaton: ahocorasick.Automaton) -> Iterator[str]:
    """The words with an entry, alone and with the word before and after."""
    at = 1
    begins = lexicon.hits(joined(words), automaton)
    for k, w in enumerate(words):
        if at - 1 in begins:
            yield f" {w} "
            if k:
                yield f" {words[k - 1]} {w} "
            if k + 1 < len(words):
                yield f" {w} {words[k + 1]} "
        at += len(w) + 1


def harmless(counts: dict[str, tuple[int, int]]) -> set[str]:
    """Phrases that are mostly in documents that are not toxic; none that a shorter one covers."""
    found = {p for p, (toxic, other) in counts.items() if toxic + other >= EXCEPTION_DOCS and other > 3 * toxic}
    return {p for p in found if p.count(" ") == 2 or not any(f" {w} " in found for w in p.split())}


def curve(amounts: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the logistic curve (Newton steps; a small ridge keeps separable labels finite)."""
    x = np.stack([amounts, np.ones(len(amounts))], 1)
    # Labels one document away from certainty, after Platt.
    target = np.where(toxic, (toxic.sum() + 1) / (toxic.sum() + 2), 1 / ((~toxic).sum() + 2))
    b = np.array([0.0, np.log((toxic.sum() + 1) / ((~toxic).sum() + 1))])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2) * RIDGE, x.T @ (target - p) - RIDGE * b)
        b = b + step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-9:
            break
    return max(float(b[0]), 0.0), float(b[1])


@dataclass
class Model:
    lexicon: Lexicon
    slope: float
    intercept: float

    def score(self, amounts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * amounts + self.intercept, -40, 40)))


def _amounts(df: DataFrame, keep: str, lexicons: dict[int | None, Lexicon], schema: str, extra) -> DataFrame:
    """`extra(part, amounts)` of every slice; the lexicon is that of the row's fold, or the only one."""
    shared = df.sparkSession.sparkContext.broadcast(lexicons)
    ready: dict = {}

    def run(part: pa.RecordBatch) -> dict:
        if not ready:
            ready.update({k: (x, x.automaton()) for k, x in shared.value.items()})
        which = part.column(keep).to_pylist() if keep else [None] * part.num_rows
        out = np.zeros(part.num_rows)
        for i, (text, k) in enumerate(zip(part.column("text").to_pylist(), which, strict=True)):
            words = fold(text)
            lexicon, automaton = ready[k]
            out[i] = amount(words, lexicon, automaton)
        return extra(part, out)

    return common.map_slices(df, run, schema)


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", sample: int = SAMPLE) -> Model:
    """`learn` says of an id (column _id) whether its label may be used."""
    known = labels.select(F.col(doc_id).alias("_id"), F.col(toxic).alias("_toxic")).filter(F.col("_id").isNotNull() & F.col("_toxic").isin(0, 1))
    known = known.filter(learn if learn is not None else F.lit(True)).groupBy("_id").agg((F.max("_toxic") == 1).cast("int").alias("toxic"))
    few = known.filter(common.share("_id", known.count(), sample))  # bounded by the parameter, so it may be broadcast
    own = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    marked = common.saved(own.join(F.broadcast(few), "_id").withColumn("fold", F.pmod(F.xxhash64("_id", F.lit(11)), F.lit(FOLDS)).cast("int")), "toxicity-sample")
    size = {(f, t): n for f, t, n in marked.groupBy("fold", "toxic").count().collect()}
    n = {f: [sum(size.get((g, t), 0) for g in range(FOLDS) if g != f) for t in (1, 0)] for f in [None, *range(FOLDS)]}
    if not all(n[None]):
        return Model(Lexicon(), 0.0, float(np.log(PRIOR / (1 - PRIOR))))

    def tables(of, least: str) -> dict:
        """Counts of an entry in all folds (None) and in all but each."""
        sums = _counted(marked.select("text", "fold", "toxic"), of).groupBy("entry", "fold").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        total = sums.groupBy("entry").agg(F.sum("toxic").alias("t"), F.sum("other").alias("o"), F.map_from_entries(F.collect_list(F.struct("fold", F.struct("toxic", "other")))).alias("by")).filter(least)
        out: dict = {f: {} for f in n}
        for r in total.toLocalIterator():
            out[None][r.entry] = (r.t, r.o)
            for f in range(FOLDS):
                own = r.by.get(f)
                out[f][r.entry] = (r.t - own.toxic, r.o - own.other) if own else (r.t, r.o)
        return out

    base = n[None][0] / sum(n[None])
    found = tables(lambda words: entries(set(words)), f"t >= {LEAST_DOCS} AND t > {2 * base} * (t + o)")
    lexicons = {f: Lexicon(chosen(found[f], *n[f])) for f in n}
    whole = lexicons[None]
    if whole.weights:
        ready = whole.automaton()
        around = tables(lambda words: phrases(words, whole, ready), f"t + o >= {EXCEPTION_DOCS} AND o > 3 * t")
        for f in n:
            lexicons[f].exceptions = harmless(around[f])
    seen = _amounts(marked.select("text", "fold", "toxic"), "fold", lexicons, "amount double, toxic int", lambda part, x: {"amount": x, "toxic": part.column("toxic")}).toArrow()
    slope, intercept = curve(seen.column("amount").to_numpy(), seen.column("toxic").to_numpy() == 1)
    return Model(whole, slope, intercept)


def scores(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score and predicted of every document."""
    own = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    out = _amounts(own, "", {None: model.lexicon}, f"_id {docs.schema[doc_id].dataType.simpleString()}, score double", lambda part, x: {"_id": part.column("_id"), "score": model.score(x)})
    return out.select(F.col("_id").alias(doc_id), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    model = train(docs, labels, learn=~held_out(F.col("_id")))
    return scores(docs, model).withColumn("held_out", held_out(F.col("doc_id")))
