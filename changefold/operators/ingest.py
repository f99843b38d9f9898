"""Bronze layer: parse broker messages, classify, project.

One parse per message.  Every non-null message gets its parsed ``payload``
and a ``dead_letter_reason`` (null when valid) in a single projection, so
the bronze and dead-letter outputs are two filters of one DataFrame.

``from_json`` alone does not catch bad input: it returns a struct of nulls
for text that is not JSON.  The parse schema therefore carries a corrupt
record column, and the envelope's required fields (``op``, ``ts_ms``, the
key on the side the op uses) are checked explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changefold import specs
from changefold.specs import TableSpec

CORRUPT = "_corrupt_record"

# Dead-letter reasons, checked in this order.
REASON_NULL = "null_value"  # not a dead letter: dropped and counted
REASON_EMPTY = "empty_payload"
REASON_NOT_JSON = "json_parse_failure"
REASON_SCHEMA = "schema_mismatch"
REASON_NO_OP = "missing_op"
REASON_BAD_OP = "invalid_op"
REASON_NO_TS = "missing_ts_ms"
REASON_NO_KEY = "missing_key"
REASON_UNKNOWN_TOPIC = "unknown_topic"

BRONZE_POSITION = ["topic", "partition", "offset", "kafka_ingest_ts"]


def parse_schema(spec: TableSpec) -> T.StructType:
    return T.StructType(spec.envelope.fields + [T.StructField(CORRUPT, T.StringType())])


def event_key(spec: TableSpec, payload: str = "payload") -> Column:
    """The key of a change: from ``before`` for deletes, ``after`` otherwise.

    Keying by ``after`` alone would put every delete of a batch under the
    null key."""
    p = F.col(payload)
    return F.when(p["op"] == specs.DELETE_OP, p["before"][spec.key]).otherwise(p["after"][spec.key])


def classify(messages: DataFrame, spec: TableSpec) -> DataFrame:
    """Messages with the parsed ``payload`` and a ``dead_letter_reason``
    (null when valid).  Null messages (heartbeats, tombstones) get the
    reason ``null_value``: they reach neither bronze nor the dead-letter
    table and are only counted (``null_messages``, ``batch_metrics``).

    The JSON is parsed exactly once per message.  The parse sits in a
    one-element ``inline`` generator: filters on the reason cannot be
    pushed below a generator's output, so the optimizer does not copy
    ``from_json`` into every predicate that reads a payload field."""
    text = F.col("value").cast("string")
    parsed = messages.select(
        "*", F.inline(F.array(F.struct(
            F.from_json(text, parse_schema(spec),
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("payload")))))
    p = F.col("payload")
    reason = (F.when(F.col("value").isNull(), F.lit(REASON_NULL))
              .when(F.trim(text) == "", F.lit(REASON_EMPTY))
              .when(p.isNull(), F.lit(REASON_NOT_JSON))
              .when(p[CORRUPT].isNotNull() & F.json_object_keys(text).isNull(), F.lit(REASON_NOT_JSON))
              .when(p[CORRUPT].isNotNull(), F.lit(REASON_SCHEMA))
              .when(F.col("topic") != F.lit(spec.topic), F.lit(REASON_UNKNOWN_TOPIC))
              .when(p["op"].isNull(), F.lit(REASON_NO_OP))
              .when(~p["op"].isin(*specs.ALL_OPS), F.lit(REASON_BAD_OP))
              .when(p["ts_ms"].isNull(), F.lit(REASON_NO_TS))
              .when(event_key(spec).isNull(), F.lit(REASON_NO_KEY)))
    return parsed.withColumn("dead_letter_reason", reason)


def bronze(classified: DataFrame) -> DataFrame:
    """Valid rows: envelope fields + log position (+ ``_batch_id`` if present)."""
    extra = ["_batch_id"] if "_batch_id" in classified.columns else []
    return classified.filter(F.col("dead_letter_reason").isNull()).select(
        "payload.before", "payload.after", "payload.op", "payload.ts_ms", "payload.source",
        "topic", "partition", "offset", F.col("timestamp").alias("kafka_ingest_ts"), *extra)


def dead_letters(classified: DataFrame, batch_id: Column | int | None = None,
                 stamp: Column | None = None) -> DataFrame:
    """Rejected rows: raw value + position + reason, batch id and time."""
    if batch_id is None:
        batch_id = F.col("_batch_id")
    elif not isinstance(batch_id, Column):
        batch_id = F.lit(batch_id)
    reason = F.col("dead_letter_reason")
    return classified.filter(reason.isNotNull() & (reason != REASON_NULL)).select(
        "value", "topic", "partition", "offset", "dead_letter_reason",
        batch_id.cast("long").alias("dead_letter_batch_id"),
        (stamp if stamp is not None else F.current_timestamp()).alias("dead_letter_ts"))


def unknown_topics(messages: DataFrame, registry: dict[str, TableSpec] | None = None) -> DataFrame:
    """Messages whose topic no spec claims, in the dead-letter layout."""
    topics = [s.topic for s in (registry or specs.REGISTRY).values()]
    return (messages.filter(F.col("value").isNotNull() & ~F.col("topic").isin(*topics))
            .withColumn("dead_letter_reason", F.lit(REASON_UNKNOWN_TOPIC)))


def null_messages(messages: DataFrame, by: tuple[str, ...] = ("topic",)) -> DataFrame:
    """Per group: total messages and null-valued messages (dropped, counted)."""
    return messages.groupBy(*by).agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("value").isNull()).alias("null_messages"))


def topic_counts(messages: DataFrame) -> DataFrame:
    """Messages per (table, partition) from the topic name; null values counted."""
    from changefold.functions.convert import topic_table
    return messages.groupBy(topic_table(F.col("topic")).alias("table_name"), "partition").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("value").isNull()).alias("null_messages"))


def route(messages: DataFrame, registry: dict[str, TableSpec] | None = None) -> dict[str, DataFrame]:
    """Split a multi-topic message log: table name -> classified rows."""
    reg = registry or specs.REGISTRY
    return {name: classify(messages.filter(F.col("topic") == spec.topic), spec)
            for name, spec in reg.items()}


def batch_metrics(classified: DataFrame, by: str = "_batch_id") -> DataFrame:
    """Counts per batch in one pass: non-null messages, valid, dead letters,
    upserts, deletes."""
    reason = F.col("dead_letter_reason")
    op = F.col("payload.op")
    return classified.filter(reason.isNull() | (reason != REASON_NULL)).groupBy(by).agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(reason.isNull()).alias("valid"),
        F.count_if(reason.isNotNull()).alias("dead_letter"),
        F.count_if(reason.isNull() & op.isin(*specs.UPSERT_OPS)).alias("upserts"),
        F.count_if(reason.isNull() & (op == specs.DELETE_OP)).alias("deletes"))
