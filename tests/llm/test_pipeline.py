"""The stages in turn: columns, one document of each class, decisions that take effect."""

import hashlib

from changefold.llm import common, decontam, near_dup
from changefold.session import fresh_dir
import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = common.table(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        path = fresh_dir(spark, f"test-{name}")
        out.write.parquet(path)
        docs = seen[name] = spark.read.parquet(path)
        if name != "tokens":
            assert docs.columns == columns
    counts = [before, *(d.count() for d in seen.values())]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    assert near_dup.classes(seen["near_duplicates"]).filter("NOT first").isEmpty()
    assert decontam.clean(seen["decontamination"], common.table(spark, SF, "benchmark")).count() == counts[3]
    # Nothing goes after decontamination: secrets are replaced, tokens are made of what is left.
    assert counts[3] == counts[4] == counts[5]
    texts = {r.doc_id: r.text or "" for r in seen["secrets"].collect()}
    found = {r.doc_id: r.decoded_sha256 for r in seen["tokens"].collect()}
    assert found == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in texts.items()}


def test_clashing_columns_nulls_and_repeated_rows(spark):
    """Columns named like those that stages make inside pass through; null texts are one class; repeats go."""
    from pyspark.sql import functions as F

    names = ["rid", "block", "key", "item", "_row", "bands", "lang_pred", "score", "spans", "ids"]
    base = common.table(spark, SF, "documents")
    odd = spark.createDataFrame([(9001, None, None, None, None), (9002, "", "en", "web", 0), (None, base.filter("lang = 'en'").orderBy("doc_id").first()["text"] + " and so it was", "en", "web", 13), (9003, None, "de", "web", None)], base.schema)
    docs = base.unionAll(base.limit(40)).unionAll(odd)
    tag = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit("-"))
    docs = docs.select("*", *[F.concat(tag, F.lit(n)).alias(n) for n in names])
    path = fresh_dir(spark, "clash")
    docs.write.parquet(path)
    docs = spark.read.parquet(path)
    schema = docs.schema
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name == "tokens":
            assert out.count() == docs.count()
            break
        docs = common.saved(out, f"clash-{name}")
        assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in schema]
        rows = docs.collect()
        assert all(r[n] == f"{'none' if r.doc_id is None else r.doc_id}-{n}" for r in rows for n in names)
        if name == "near_duplicates":
            assert len({r.doc_id for r in rows}) == len(rows)
            assert sum(not r.text for r in rows) <= 1


def test_empty_table(spark):
    docs = common.table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name
