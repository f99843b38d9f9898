"""Token ids in binary shards: frequency-ranked ids, byte-aligned variable-length coding, control bytes apart.

Every id is replaced by its rank in the order of falling corpus frequency, so common ids take one byte.  Two bits for
each id, four ids to a control byte, say how many bytes (1 to 4, little-endian) it has in the data stream.  A shard:

    "VTOK1"  documents, each its control bytes then its data bytes  |  index  |  length of the index, 8 bytes

The index is an Arrow stream with doc_id, n (ids), at (offset of the document) and size of each document.  Shards hold
the documents in ascending doc_id order (nulls first), shard by shard.  Shards are written by tasks under a temporary
name and renamed, so a task that runs twice leaves one file.

Null text encodes as empty, so it holds the end id alone.  Repeated doc_ids keep one entry a row.  An empty table gives
no rows.  The table of ranks has as many entries as the vocabulary.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir
from . import common

MAGIC = b"VTOK1"
END_ID = 1
#: About so many bytes of pieces and words, with their ids, stay in a worker process in each of two generations.
REMEMBERED_BYTES = 32 << 20
#: What an entry of a dictionary takes besides its bytes; pieces and words over so many bytes are not remembered.
ENTRY_BYTES, LONG = 200, 200
# White space of the tokenizer's own pattern; pieces between never merge across it.
SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
# Classes of bytes. Words of letters (ASCII, and those of two bytes from C3 80 on), digits and signs alone are the same
# in every normal form and change case letter by letter; words with other bytes go to the library whole.
_BLANK, _LETTER, _DIGIT, _SIGN, _ODD = range(5)
_CLASS = np.full(256, _ODD, np.uint8)
_CLASS[33:127] = _SIGN
_CLASS[[*range(65, 91), *range(97, 123)]] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[[9, 10, 11, 12, 13, 32]] = _BLANK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Remembered:
    """Ids of pieces or words in two generations: the younger one becomes the older when it is full, and frequent
    entries soon come back from there."""

    def __init__(self):
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.room = REMEMBERED_BYTES

    def all(self, keys: list[bytes], find) -> list[bytes]:
        """The ids of each key; `find` gives those that are not remembered."""
        found = list(map(self.young.get, keys))
        if None in found:
            missing = list(dict.fromkeys(k for k, ids in zip(keys, found, strict=True) if ids is None))
            met = {k: find(k) if ids is None else ids for k, ids in zip(missing, map(self.old.get, missing), strict=True)}
            found = [met[k] if ids is None else ids for k, ids in zip(keys, found, strict=True)]
            if max(map(len, missing)) > LONG:
                met = {k: ids for k, ids in met.items() if len(k) <= LONG}
            self.young.update(met)
            self.room -= sum(map(len, met)) + sum(map(len, met.values())) + ENTRY_BYTES * len(met)
            if self.room < 0:
                self.young, self.old, self.room = {}, self.young, REMEMBERED_BYTES
        return found


class WordCodec:
    """Encodes with the tokenizers library, a piece of a word at a time, remembering what it has seen: the tokenizer
    splits at white space, then into pieces, so the ids of a text are those of its pieces in a row."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model, byte_level = self.tokenizer.model, ByteLevel(add_prefix_space=False, use_regex=False)
        self.size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces, self.words = Remembered(), Remembered()
        self.letters = {c: byte_level.pre_tokenize_str(c)[0][0] for c in map(chr, [*range(33, 127), *range(0xC0, 0x100)])}

    def encode(self, text: str) -> bytes:
        """Ids of one text as little-endian unsigned 32-bit integers."""
        data = np.frombuffer(text.encode(), np.uint8)
        return self.texts(data, np.array([0, len(data)]))[0].astype("<u4").tobytes()

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin, with one more place for the end.  Works on
        blocks of about SLICE_BYTES; a longer text is cut at white space."""
        cuts = offsets
        if (np.diff(offsets) > common.SLICE_BYTES).any():
            blank = np.flatnonzero(_CLASS[data] == _BLANK)
            at = np.searchsorted(blank, np.arange(common.SLICE_BYTES, len(data), common.SLICE_BYTES))
            cuts = np.sort(np.concatenate([offsets, blank[np.unique(at[at < len(blank)])]]))
        first = np.flatnonzero(np.diff(cuts[:-1] // common.SLICE_BYTES, prepend=-1)).tolist()
        parts, n = [], [np.zeros(1, np.int64)]
        for a, b in zip(first, [*first[1:], len(cuts) - 1], strict=False):
            ids, ends = self._block(data[cuts[a] : cuts[b]], cuts[a : b + 1] - cuts[a])
            parts.append(ids)
            n.append(ends[1:] + n[-1][-1])
        starts = np.concatenate(n)
        if cuts is not offsets:
            starts = starts[np.searchsorted(cuts, offsets, "right") - 1]
        return np.concatenate(parts) if parts else np.zeros(0, self.kind), starts

    def _block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = len(data)
        low = np.zeros(size + 4, np.uint8)  # the margin is blank, so what looks ahead stays inside
        low[:size] = _LOWER[data]
        kind = np.zeros(size + 4, np.uint8)
        kind[:size] = _CLASS[data]
        wide = np.flatnonzero(data == 0xC3)
        after = low[wide + 1]
        letter = (after >= 0x80) & (after != 0x97) & (after != 0xB7)  # the signs of multiplication and division
        wide, after = wide[letter], after[letter]
        kind[wide] = kind[wide + 1] = _LETTER
        low[wide[after < 0x9F] + 1] += 0x20

        fresh = np.zeros(size + 4, bool)  # a text begins
        fresh[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        inside = kind != _BLANK
        start = np.empty(size + 4, bool)
        start[0] = True
        np.not_equal(kind[1:], kind[:-1], out=start[1:])
        start |= fresh
        start |= kind == _DIGIT
        start &= inside
        # 's 't 'm 'd 're 've 'll are pieces, where the apostrophe begins one and a letter follows.
        quote = np.flatnonzero((low == 0x27) & start)
        quote = quote[(kind[quote + 1] == _LETTER) & ~fresh[quote + 1]]
        one, two = low[quote + 1], low[quote + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        pair = (((one == 0x72) | (one == 0x76)) & (two == 0x65) | (one == 0x6C) & (two == 0x6C)) & ~fresh[quote + 2]
        for at, n in ((quote[short], 1), (quote[pair], 2)):
            start[at + 1] = False
            start[at + n + 1] |= inside[at + n + 1]

        # Words that go to the library whole: with odd bytes or added tokens.
        odd = [np.flatnonzero(kind == _ODD)]
        raw = data.tobytes()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                odd.append(np.arange(at, at + len(token)))
                at = raw.find(token, at + 1)
        odd = np.concatenate(odd)
        odd = odd[inside[odd]]
        odd_words = np.zeros(0, np.int64)
        if len(odd):
            begins = inside & fresh
            begins[1:] |= inside[1:] & ~inside[:-1]
            begins[0] |= inside[0]
            begin = np.flatnonzero(begins)
            odd_words = np.unique(np.searchsorted(begin, odd, "right") - 1)
            end = np.append(begin[1:], size)
            step = np.zeros(size + 5, np.int8)
            np.add.at(step, begin[odd_words], 1)
            np.add.at(step, end[odd_words], -1)
            whole = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
            inside &= ~whole
            start &= ~whole
            odd_words, odd_ends = begin[odd_words], end[odd_words]

        at = np.flatnonzero(start)
        ends = np.append(np.flatnonzero(start[inside]), np.count_nonzero(inside)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(low[inside])]).dictionary_encode()
        found = self.pieces.all(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self._piece)
        codes = coded.indices.to_numpy()
        if len(odd_words):
            places = np.searchsorted(at, odd_words)
            codes = np.insert(codes, places, np.arange(len(found), len(found) + len(odd_words), dtype=np.int32))
            at = np.insert(at, places, odd_words)
            found += self.words.all([data[a:b].tobytes().strip() for a, b in zip(odd_words.tolist(), odd_ends.tolist(), strict=True)], self._word)

        ids = np.frombuffer(b"".join(found), self.kind)
        size_of = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        n = size_of[codes]
        before = np.cumsum(n) - n
        total = int(n.sum())
        where = np.repeat((np.cumsum(size_of) - size_of)[codes] - before, n) + np.arange(total)
        return ids[where], np.append(before, total)[np.searchsorted(at, offsets)]

    def _word(self, word: bytes) -> bytes:
        return np.array([i for w in SPACE.split(word.decode()) if w for i in self.tokenizer.encode(w, add_special_tokens=False).ids], self.kind).tobytes()

    def _piece(self, piece: bytes) -> bytes:
        """A piece goes straight to the library's merge model; the steps before it do not change plain words."""
        text = piece.decode()
        if not text.isascii():
            text = "".join(map(self.letters.__getitem__, text))
        return array(self.kind.char, [t.id for t in self.model.tokenize(text)]).tobytes()


_CODECS: dict[str, WordCodec] = {}


def codec(path: str) -> WordCodec:
    if path not in _CODECS:
        _CODECS[path] = WordCodec(path)
    return _CODECS[path]


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    v = values.astype("<u4")
    extra = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    padded = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    padded[: len(v)] = extra
    control = padded[0::4] | padded[1::4] << 2 | padded[2::4] << 4 | padded[3::4] << 6
    widest = 1 + int(extra.max(initial=0))
    keep = np.arange(widest, dtype=np.uint8) <= extra[:, None]
    return control.tobytes(), v.view(np.uint8).reshape(-1, 4)[:, :widest][keep].tobytes()


# Of each control byte the four lengths, by table.
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1
_MASK = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The values again: lengths by table lookup, then a gather at each value's place for each byte of the longest."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(lengths, dtype=np.int64) - lengths
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    words = np.zeros(n, np.uint32)
    for k in range(lengths.max(initial=0)):
        words |= raw[at + k].astype(np.uint32) << np.uint32(8 * k)
    return words & _MASK[lengths]


def encoded(df: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (unsigned 16-bit if the vocabulary allows, else 32-bit, little-endian) with the end id."""

    def rows(part):
        c = codec(vocabulary)
        ids, starts = c.texts(*common.byte_texts(part.column(text)))
        ids = np.insert(ids, starts[1:], END_ID)
        places = (starts + np.arange(len(starts))) * c.kind.itemsize
        return {doc_id: part.column(doc_id), "ids": pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(ids)])}

    kind = df.schema[doc_id].dataType.simpleString()
    return common.map_slices(common.texts(df, doc_id, text=text), rows, f"{doc_id} {kind}, ids binary", text)


def _ids(value: bytes, narrow: bool) -> np.ndarray:
    return np.frombuffer(value, "<u2" if narrow else "<u4")


def ranking(ids: DataFrame, size: int, column: str = "ids") -> np.ndarray:
    """Ids in the order of falling frequency over all documents, ties by id.  Each slice sends a sum for each id."""
    narrow = size <= 1 << 16

    def count(part):
        n = np.bincount(np.concatenate([_ids(x, narrow) for x in part.column(column).to_pylist()]), minlength=size)
        at = np.flatnonzero(n)
        return {"id": at, "n": n[at]}

    n = np.zeros(size, np.int64)
    for r in common.map_slices(ids.select(column), count, "id int, n long", column, 16 * common.SLICE_BYTES).groupBy("id").sum("n").collect():
        n[r[0]] = r[1]
    return np.lexsort((np.arange(size), -n)).astype(np.uint32)


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write(ids: DataFrame, order: np.ndarray, path: str, doc_id: str = "doc_id") -> list[dict]:
    """Writes shards of ranked ids in doc_id order; returns for each its name, documents and ids, in order.  The list
    has an entry for each partition, not for each document."""
    spark = ids.sparkSession
    narrow = len(order) <= 1 << 16
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    ranks = spark.sparkContext.broadcast(rank)

    def coded(part):
        packed = [pack(ranks.value[_ids(x, narrow)]) for x in part.column("ids").to_pylist()]
        return {doc_id: part.column(doc_id), "n": [len(x) // (2 if narrow else 4) for x in part.column("ids").to_pylist()], "body": [c + d for c, d in packed]}

    kind = ids.schema[doc_id].dataType.simpleString()
    rows = common.map_slices(ids, coded, f"{doc_id} {kind}, n long, body binary", "ids", 4 * common.SLICE_BYTES)
    ordered = rows.repartitionByRange(common.partitions(spark), F.col(doc_id).asc_nulls_first()).sortWithinPartitions(F.col(doc_id).asc_nulls_first())

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        name = f"shard-{context.partitionId():06d}"
        system, folder = _filesystem(path)
        system.create_dir(folder)
        draft = f"{folder}/.{name}-{context.taskAttemptId()}"
        index, at = [], len(MAGIC)
        with system.open_output_stream(draft) as f:
            f.write(MAGIC)
            for batch in batches:
                bodies = batch.column("body").to_pylist()
                f.write(b"".join(bodies))
                size = np.array([len(b) for b in bodies], np.int64)
                index.append(pa.RecordBatch.from_arrays([batch.column(doc_id), batch.column("n"), pa.array(at + np.cumsum(size) - size), pa.array(size)], names=["doc_id", "n", "at", "size"]))
                at += int(size.sum())
            if index:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, index[0].schema) as out:
                    for x in index:
                        out.write_batch(x)
                tail = sink.getvalue().to_pybytes()
                f.write(tail + len(tail).to_bytes(8, "little"))
        if not index:
            system.delete_file(draft)
            return
        system.move(draft, f"{folder}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([sum(x.num_rows for x in index)], pa.int64()), pa.array([sum(x.column("n").to_numpy().sum() for x in index)], pa.int64())], names=["name", "docs", "ids"])

    return sorted((r.asDict() for r in ordered.mapInArrow(shard, "name string, docs long, ids long").collect()), key=lambda r: r["name"])


def read(spark: SparkSession, path: str, shards: list[dict], order: np.ndarray, doc_kind: str, rows, schema: str) -> DataFrame:
    """Reads the shards in parallel, one task each.  `rows(doc_ids, starts, list of id arrays)` gives the columns of
    `schema`; starts count the ids of all documents before."""
    if not shards:
        return spark.createDataFrame([], schema)
    base = np.cumsum([0, *[s["ids"] for s in shards]]).tolist()
    todo = spark.createDataFrame([(s["name"], b) for s, b in zip(shards, base, strict=False)], "name string, base long").repartitionByRange(len(shards), "name")
    orders = spark.sparkContext.broadcast(order)
    arrow = common._arrow_schema(spark, schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, folder = _filesystem(path)
                with system.open_input_file(f"{folder}/{name}") as f:
                    end = f.size()
                    f.seek(0)
                    if f.read(len(MAGIC)) != MAGIC:
                        raise ValueError(f"{name} is no shard")
                    f.seek(end - 8)
                    size = int.from_bytes(f.read(8), "little")
                    f.seek(end - 8 - size)
                    index = pa.ipc.open_stream(pa.BufferReader(f.read(size))).read_all()
                    n, at, sizes = (index.column(c).to_numpy() for c in ("n", "at", "size"))
                    starts = start + np.cumsum(n) - n
                    cut = np.concatenate([[0], np.flatnonzero(np.diff((at - len(MAGIC)) // (2 * common.SLICE_BYTES))) + 1, [len(n)]])
                    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                        f.seek(int(at[a]))
                        block = f.read(int(at[b - 1] + sizes[b - 1] - at[a]))
                        ids = []
                        for i in range(a, b):
                            body, control = block[at[i] - at[a] : at[i] - at[a] + sizes[i]], -(-int(n[i]) // 4)
                            ids.append(orders.value[unpack(body[:control], body[control:], int(n[i]))])
                        yield common.arrow_batch(rows(index.column("doc_id").slice(a, b - a), starts[a:b], ids), arrow)

    return todo.mapInArrow(task, schema)


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    vocabulary = word_vocabulary()
    ids = common.saved(encoded(docs, vocabulary), "token-ids")
    order = ranking(ids, codec(vocabulary).size)
    path = fresh_dir(spark, "token-shards")
    shards = write(ids, order, path)

    def digest(doc_id, starts, values):
        return {"doc_id": doc_id, "start": starts, "n_tokens": [len(v) for v in values], "ids_crc32": [zlib.crc32(v.astype("<u4").tobytes()) for v in values]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return read(spark, path, shards, order, kind, digest, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
