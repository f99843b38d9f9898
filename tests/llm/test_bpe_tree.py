"""The tree encoder against the library it must agree with, and the exact round trip."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row

from changefold.llm import bpe_tree

PATH, PATTERN = bpe_tree.vocabulary()


@pytest.fixture(scope="module")
def small():
    return bpe_tree.Codec(PATH, PATTERN, leaf=3, reach=4)


RUNS = st.lists(st.one_of(st.text(max_size=12), st.sampled_from(["a", "thth", " ", "  ", "\n", "\t ", "'s", "'", "'re", "7", "99", "!!", "ß", "日本", "é", "\x1c", "́", "😀", " "]).flatmap(lambda x: st.integers(1, 40).map(lambda n: x * n))), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(RUNS)
def test_equals_the_library(small, text):
    clean = text.encode("utf-8", "replace").decode()
    ids = small.encode(text)
    assert ids == small.leaf_codec.encode_ordinary(clean)
    assert small.decode(ids) == clean.encode()


@pytest.mark.parametrize("text", ["a" * 70_000, "ab" * 30_000, "thtion" * 9_000 + " x", " " * 50_000 + "x", "!?" * 20_000, "7" * 30_000, "日本語" * 9_000, "\n" * 20_000, "'s" * 9000, "the thing's 'round " * 4000])
def test_long_runs(text):
    c = bpe_tree.Codec(PATH, PATTERN, leaf=512, reach=64)
    ids = c.encode(text)
    assert ids == c.leaf_codec.encode_ordinary(text)
    assert c.decode(ids) == text.encode()


def test_rows(spark):
    df = spark.createDataFrame([Row(doc_id=1, text="héllo there", n_tokens=9), Row(doc_id=1, text="héllo there", n_tokens=9), Row(doc_id=None, text=None, n_tokens=0), Row(doc_id=4, text="", n_tokens=0)])
    out = sorted(bpe_tree.round_trip(df, PATH, PATTERN).collect(), key=str)
    empty = hashlib.sha256(b"").hexdigest()
    assert len(out) == 4 and {r.decoded_sha256 for r in out if r.doc_id == 1} == {hashlib.sha256("héllo there".encode()).hexdigest()}
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == (0, empty, empty) for r in out if r.doc_id != 1)
    assert bpe_tree.round_trip(df.limit(0), PATH, PATTERN).count() == 0
    both = bpe_tree.decode(bpe_tree.encode(df, PATH, PATTERN), PATH, PATTERN)
    assert all(bytes(r["bytes"]).decode() == (r["text"] or "") for r in both.collect())
