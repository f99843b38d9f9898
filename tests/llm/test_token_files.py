"""Shards of token ids: coding, order, and the ids of the tokenizers library."""

import gc
import itertools
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row

from changefold.llm import token_files as tf
from changefold.session import fresh_dir

VOCABULARY = tf.word_vocabulary()


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 70_000), st.integers(0, 2**32 - 1)), max_size=40))
def test_packing_round_trip(values):
    v = np.array(values, np.uint32)
    control, data = tf.pack(v)
    assert len(control) == -(-len(v) // 4)
    assert tf.unpack(control, data, len(v)).tolist() == values


@pytest.fixture(scope="module")
def words():
    return tf.codec(VOCABULARY)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=10), st.sampled_from(["The", "thing's", "don't,", "über", "ΟΔΟΣ", "İstanbul", "<|endoftext|>", "a\x1cb", "½", "é", "日本", " ", "x99y", "'''s", "ÿŸ", "ß"])), max_size=8).map(" ".join))
def test_equals_the_library(words, text):
    text = text.encode("utf-8", "replace").decode()
    assert np.frombuffer(words.encode(text), "<u4").tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "x<|endoftext|>y", "<|startoftext|>", "é<|endoftext|>'s", "<|ENDOFTEXT|> <|endoftext", "<|endoftext|><|startoftext|>\n<|endoftext|>"])
def test_added_tokens_as_a_fresh_library(words, text):
    from tokenizers import Tokenizer

    assert np.frombuffer(words.encode(text), "<u4").tolist() == Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids


ENDS = ["'", "'s", "'S", "''s", "l", "'l", "'LL", "'re", "r", "'vex", "s't", "É's", "'é", "×", "÷a", "ÀÖØÞß", "x1y22", "\u2019s", "<|endoftext|>", "<|", "endoftext|>", "İ", "e\u0301", "\u0301", "\x1c", "\x85", "\u00a0", "\t", " ", "  ", "\n", ""]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.one_of(st.sampled_from(ENDS), st.text(max_size=4)), max_size=8).map("".join), max_size=5), st.integers(1, 40))
def test_texts_beside_each_other_as_the_library(words, values, block):
    """Pieces never cross texts, and neither small blocks nor small memories change an id."""
    values = [v.encode("utf-8", "replace").decode() for v in values]
    data, offsets = tf.common.byte_texts(pa.array(values, pa.string()))
    with pytest.MonkeyPatch.context() as m:
        m.setattr(tf.common, "SLICE_BYTES", block)
        m.setattr(tf, "REMEMBERED_BYTES", 500)
        ids, starts = words.texts(data, offsets)
    assert [ids[a:b].tolist() for a, b in itertools.pairwise(starts.tolist())] == [words.tokenizer.encode(v, add_special_tokens=False).ids for v in values]


def kept_bytes(texts) -> int:
    """What a codec holds on to after these texts."""
    codec = tf.WordCodec(VOCABULARY)
    codec.encode("a first text")
    tracemalloc.start()
    for t in texts:
        codec.encode(t)
    gc.collect()
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    return kept


def test_long_words_are_not_remembered():
    """Text without white space is one word; a worker's memory does not grow with its length."""
    assert kept_bytes(f"{i}" + "日本語" * 2000 for i in range(150)) < 1 << 20
    assert kept_bytes(f"{i}" + "ab" * 3000 for i in range(150)) < 1 << 20


def test_memory_of_words_is_bounded(monkeypatch):
    """New words push out old ones by their bytes, whatever their number."""
    monkeypatch.setattr(tf, "REMEMBERED_BYTES", 1 << 18, raising=False)
    assert kept_bytes(" ".join(np.base_repr(7919 * (1000 * i + k), 36).translate(str.maketrans("0123456789", "abcdefghij")) for k in range(1000)) for i in range(20)) < 1 << 20


def test_shards(spark):
    texts = {5: "the one thing", 2: None, 9: "", 7: "Großer Straßen\nñandú " * 5000, 3: "the the the"}
    rows = [Row(doc_id=i, text=t, ids="clash") for i, t in texts.items()] + [Row(doc_id=None, text="x y", ids=""), Row(doc_id=3, text="the the the", ids="")]
    ids = tf.encoded(spark.createDataFrame(rows), VOCABULARY)
    order = tf.ranking(ids, tf.codec(VOCABULARY).size)
    path = fresh_dir(spark, "shards")
    shards = tf.write(ids, order, path)
    back = tf.read(spark, path, shards, order, "long", lambda d, s, v: {"doc_id": d, "start": s, "ids": [x.tolist() for x in v], "crc": [zlib.crc32(x.tobytes()) for x in v]}, "doc_id long, start long, ids array<long>, crc long").collect()
    plain = tf.codec(VOCABULARY).tokenizer
    assert sorted(str(r.doc_id) for r in back) == sorted(str(r.doc_id) for r in rows)
    at = 0
    for r in sorted(back, key=lambda r: r.start):
        assert r.start == at
        at += len(r.ids)
        text = "x y" if r.doc_id is None else texts[r.doc_id]
        assert r.ids == [*plain.encode(text or "", add_special_tokens=False).ids, tf.END_ID]
    assert [r.doc_id for r in sorted(back, key=lambda r: r.start)] == [None, 2, 3, 3, 5, 7, 9]


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    ids = tf.encoded(empty, VOCABULARY)
    order = tf.ranking(ids, tf.codec(VOCABULARY).size)
    path = fresh_dir(spark, "shards")
    assert tf.read(spark, path, tf.write(ids, order, path), order, "long", None, "doc_id long").count() == 0
