"""Byte-level BPE by monoid tree reduction.

A text is cut in halves down to leaves, each leaf is encoded on its own, and neighbours are joined on the way up.
A join re-encodes only a window around the seam.  The window grows on each side until its edge is a place where
tokens outside cannot change any more:

* a change of character class that ends a match of the split pattern whatever follows (`_stable`), or
* inside a long run of one class, a pair of adjacent tokens that the merges leave as they are.  A sequence of
  tokens is the encoding of its bytes if every adjacent pair is, so one checked pair at each edge proves the rest.

Decoding concatenates the bytes of the tokens up the same tree.

Null text encodes as the empty text (no ids).  Null or repeated doc_ids give one row each; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Code points of a leaf.
LEAF = 4096
#: Code points to each side of a seam that are searched for a stable edge before token pairs are tried.
REACH = 256


class Codec:
    def __init__(self, path: str, pattern: str, leaf: int = LEAF, reach: int = REACH):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.leaf_codec = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.token = [b""] * (max(ranks.values()) + 1)
        for piece, i in ranks.items():
            self.token[i] = piece
        self.text_of_id = [str(i) for i in range(len(self.token))]
        self.leaf, self.reach = max(1, leaf), max(1, reach)
        self.pair = lru_cache(1 << 16)(self._pair)

    def encode(self, text: str) -> list[int]:
        text = text.encode("utf-8", "replace").decode("utf-8")
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, a: int, b: int) -> list[int]:
        if b - a <= self.leaf:
            return self.leaf_codec.encode_ordinary(text[a:b])
        m = (a + b) // 2
        return self._join(text, a, m, b, self._encode(text, a, m), self._encode(text, m, b))

    def _join(self, text: str, a: int, m: int, b: int, left: list[int], right: list[int]) -> list[int]:
        """Ids of text[a:b] from those of text[a:m] and text[m:b]."""
        if _stable(text, m):
            left.extend(right)
            return left
        reach = self.reach
        while True:
            s, e = _edge(text, a, m, reach, -1), _edge(text, b, m, reach, 1)
            if s is not None and e is not None:
                del left[len(left) - _tokens(self.token, reversed(left), len(text[s:m].encode())) :]
                left.extend(self.leaf_codec.encode_ordinary(text[s:e]))
                left.extend(right[_tokens(self.token, right, len(text[m:e].encode())) :])
                return left
            if s is None and e is None and (joined := self._join_inside(text, m, reach, left, right)) is not None:
                return joined
            reach *= 2

    def _join_inside(self, text: str, m: int, reach: int, left: list[int], right: list[int]) -> list[int] | None:
        """The seam lies in one run of letters, digits or signs: a window of tokens, proven by a pair at each edge."""
        if _kind(text[m]) == " ":
            return None  # of white space, how the run ends decides
        before, after = len(text[m - reach : m].encode()), len(text[m : m + reach].encode())
        k = 8
        while True:
            p, q = left[-k:], right[:k]
            if sum(len(self.token[t]) for t in left[-k - 1 :]) > before or sum(len(self.token[t]) for t in right[: k + 1]) > after:
                return None
            middle = self.leaf_codec._encode_single_piece(b"".join(map(self.token.__getitem__, p + q)))
            if self.pair(left[-k - 1], middle[0]) and self.pair(middle[-1], right[k]):
                del left[-k:]
                return left + middle + right[k:]
            k *= 2

    def _pair(self, x: int, y: int) -> bool:
        return self.leaf_codec._encode_single_piece(self.token[x] + self.token[y]) == [x, y]

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self.leaf:
            return b"".join(map(self.token.__getitem__, ids))
        m = len(ids) // 2
        return self.decode(ids[:m]) + self.decode(ids[m:])


@lru_cache(1 << 16)
def _kind(c: str) -> str:
    """The class of the split pattern that the character is in: white space, letter, number or sign."""
    if c.isspace() and c not in "\x1c\x1d\x1e\x1f":
        return " "
    return {"L": "a", "N": "0"}.get(unicodedata.category(c)[0], "!")


def _stable(text: str, p: int) -> bool:
    """A match of the pattern ends at p in every text that has these two characters: no alternative goes on from a
    visible character into white space, nor from one class into another, but for contractions after an apostrophe."""
    if p in (0, len(text)):
        return True
    x, y = _kind(text[p - 1]), _kind(text[p])
    return x != " " and x != y and not (x == "!" and text[p - 1] == "'" and y == "a")


def _edge(text: str, end: int, m: int, reach: int, step: int) -> int | None:
    """The nearest stable place on one side of m; the node's own end counts."""
    p = m
    for _ in range(reach):
        p += step
        if p == end or _stable(text, p):
            return p
    return None


def _tokens(token: list[bytes], ids, size: int) -> int:
    """How many of the ids make up `size` bytes."""
    n = 0
    for i in ids:
        if size <= 0:
            break
        size -= len(token[i])
        n += 1
    return n


_CODECS: dict[tuple, Codec] = {}


def codec(path: str, pattern: str, leaf: int = LEAF, reach: int = REACH) -> Codec:
    """One per worker process."""
    key = (path, pattern, leaf, reach)
    if key not in _CODECS:
        _CODECS[key] = Codec(*key)
    return _CODECS[key]


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """`df` with the ids of `text` in an array column; other columns stay."""

    @F.pandas_udf("array<int>")
    def ids(values):
        c = codec(path, pattern)
        return values.map(lambda t: c.encode(t or ""))

    return df.withColumn(out, ids(F.coalesce(F.col(text), F.lit(""))))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "bytes") -> DataFrame:
    @F.pandas_udf("binary")
    def back(values):
        c = codec(path, pattern)
        return values.map(lambda x: c.decode([] if x is None else list(x)))

    return df.withColumn(out, back(F.col(ids)))


def round_trip(df: DataFrame, path: str, pattern: str, doc_id: str = "doc_id") -> DataFrame:
    """Digests of the ids and of the bytes decoded from them, made in the task that encodes: the ids of all texts
    are larger than the texts and need not leave it."""

    def digest(part):
        c = codec(path, pattern)
        n, ids_sha, text_sha = [], [], []
        for t in part.column("text").to_pylist():
            ids = c.encode(t)
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(",".join(map(c.text_of_id.__getitem__, ids)).encode()).hexdigest())
            text_sha.append(hashlib.sha256(c.decode(ids)).hexdigest())
        return {doc_id: part.column(doc_id), "n_tokens": n, "ids_sha256": ids_sha, "decoded_sha256": text_sha}

    kind = df.schema[doc_id].dataType.simpleString()
    return common.map_slices(common.texts(df, doc_id), digest, f"{doc_id} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(common.table(spark, sf_dir, "documents"), *vocabulary())
