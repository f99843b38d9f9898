"""Documents through the stages of a training-data pipeline.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.  A stage's rows are
written as Parquet and read again as the next one's docs; all but the last return the columns of documents.

Null and empty texts have no language that could be rejected and are one class of copies, of which one stays.  Null ids
and repeated rows are rows like others until the near-duplicate stage, which keeps one of each class; of equal
candidates the first row stays.  Long texts are read whole.  Other columns pass through every stage but the last, whatever
their names.  An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changefold.llm import bpe_tree, common, decontam, langid, near_dup, secret_scan


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose language the model rejects."""
    return docs.filter(langid.accepted(docs, langid.train(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return near_dup.distinct(docs).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold a benchmark item within its error budget."""
    return decontam.clean(docs, common.table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text."""
    return common.with_text(docs, secret_scan.redact(docs, secret_scan.train(docs)))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, with the digests of the ids and of the text decoded from them."""
    return bpe_tree.round_trip(docs, *bpe_tree.vocabulary())


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

#: No SQL: the stages are statistical models, sketches and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = common.table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = common.saved(docs, f"pipeline-{name}")
            if before is not None:
                common.forget(before)
            before = docs
    return docs
