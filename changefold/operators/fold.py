"""Silver layer: the current row per key as a fold of its change events.

For each key the state is an associative, commutative and idempotent
aggregate of the key's events under the total order
``seq = (ts_ms, lsn, partition, offset)``:

=====================  ==================================================
state column           aggregate over the key's events
=====================  ==================================================
``_up_img``            row image of the last upsert (``max`` of struct(seq, image)),
                       narrowed to what silver columns are made of
``_up_seq``            seq of the last upsert
``_first_created``     ``created_at`` of the first upsert (``min`` of struct(seq, created_at))
``_first_seq``         seq of the first upsert
``_last_op``           op of the last event (``max`` of struct(seq, op))
``_last_seq``          seq of the last event
=====================  ==================================================

A single event is a state of one event, and two states merge with the same
aggregates, so a full replay, a micro-batch update, late or duplicated
events and deletes are all one ``groupBy(key).agg(...)``: one shuffle with
map-side partial aggregation (a hot key is combined inside each map task
before it is shuffled), no MERGE, no Python.  The result does not depend on
arrival order, duplicates or batch boundaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefold import specs
from changefold.functions import convert
from changefold.operators.ingest import event_key
from changefold.specs import TableSpec

STATE_COLUMNS = ["_up_img", "_up_seq", "_first_created", "_first_seq", "_last_op", "_last_seq"]


def sequence(bronze_df: DataFrame) -> Column:
    """Total order of events: commit time, then log position.  Broker offsets
    only compare within one partition; a key always maps to one partition."""
    return F.struct(
        F.col("ts_ms").alias("ts_ms"),
        F.coalesce(F.col("source.lsn"), F.lit(-1).cast("long")).alias("lsn"),
        F.coalesce(F.col("partition"), F.lit(-1)).cast("int").alias("partition"),
        F.coalesce(F.col("offset"), F.lit(-1).cast("long")).alias("offset"),
    )


def changes(bronze_df: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bronze -> (key, op, seq, before, after, _image, _created[, _batch_id][, kept columns]).

    ``_image`` and ``_created`` are what a state takes of ``after``; named here, next to the scan, so that the other
    fields are not read."""
    key = F.when(F.col("op") == specs.DELETE_OP, F.col("before")[spec.key]) \
        .otherwise(F.col("after")[spec.key])
    extra = ["_batch_id"] if "_batch_id" in bronze_df.columns else []
    image = F.struct(*[F.col("after")[f].alias(f) for f in spec.image_schema.fieldNames()])
    created = F.col("after.created_at") if spec.has_field("created_at") else F.col("ts_ms")
    return bronze_df.select(key.alias(spec.key), "op", sequence(bronze_df).alias("_seq"),
                            "before", "after", image.alias("_image"), created.alias("_created"), *extra, *keep)


def event_states(changes_df: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Each change event as a one-event state (``keep``: extra grouping columns)."""
    up = F.col("op").isin(*specs.UPSERT_OPS)
    return changes_df.select(
        *keep, spec.key,
        F.when(up, F.col("_image")).alias("_up_img"),
        F.when(up, F.col("_seq")).alias("_up_seq"),
        F.when(up, F.col("_created")).alias("_first_created"),
        F.when(up, F.col("_seq")).alias("_first_seq"),
        F.col("op").alias("_last_op"),
        F.col("_seq").alias("_last_seq"),
        *([F.when(up, F.col("_image")).alias("_first_img")] if spec.sticky_columns else []),
    )


def merge_states(states: DataFrame, spec: TableSpec, by: tuple[str, ...] = (), key_first: bool = False) -> DataFrame:
    """Merge any number of partial states per key (``by`` adds grouping
    columns, e.g. a batch id; with ``key_first`` the rows come sorted by key,
    so that merging them further by key alone sorts nothing again).

    Each state pair (value, seq) is merged as one ``max``/``min`` over
    ``struct(seq, value)``: structs compare field by field, so the seq
    decides and the shuffle carries each seq once per pair (``max_by`` plus
    ``max`` would carry it twice).  Ties (the same event delivered twice)
    resolve by value, deterministically."""
    first_fields = [F.col("_first_seq"), F.col("_first_created")]
    if spec.sticky_columns:
        first_fields.append(F.col("_first_img"))
    up = F.when(F.col("_up_seq").isNotNull(), F.struct(F.col("_up_seq"), F.col("_up_img")))
    first = F.when(F.col("_first_seq").isNotNull(), F.struct(*first_fields))
    last = F.struct(F.col("_last_seq"), F.col("_last_op"))
    group = (spec.key, *by) if key_first else (*by, spec.key)
    merged = states.groupBy(*group).agg(F.max(up).alias("_u"), F.min(first).alias("_f"),
                                                F.max(last).alias("_l"))
    cols = [F.col("_u._up_img").alias("_up_img"), F.col("_u._up_seq").alias("_up_seq"),
            F.col("_f._first_created").alias("_first_created"), F.col("_f._first_seq").alias("_first_seq"),
            F.col("_l._last_op").alias("_last_op"), F.col("_l._last_seq").alias("_last_seq")]
    if spec.sticky_columns:
        cols.append(F.col("_f._first_img").alias("_first_img"))
    return merged.select(*by, spec.key, *cols)


def fold_changes(changes_df: DataFrame, spec: TableSpec, by: tuple[str, ...] = (), key_first: bool = False) -> DataFrame:
    return merge_states(event_states(changes_df, spec, keep=by), spec, by, key_first)


def materialize(states: DataFrame, spec: TableSpec, keep_state: bool = False) -> DataFrame:
    """States -> silver rows.  A key with no upsert has no row (a delete of an
    unknown key changes nothing visible), but its state is kept in the log
    so that a late insert is still seen as deleted."""
    deleted = F.col("_last_op") == specs.DELETE_OP
    img = F.col("_up_img")
    cols = []
    for oc in spec.columns:
        source_img = F.col("_first_img") if oc.name in spec.sticky_columns else img
        value = F.col(spec.key) if oc.source == spec.key else oc.convert(source_img[oc.source])
        if oc.name in spec.on_delete:
            value = F.when(deleted, F.lit(spec.on_delete[oc.name])).otherwise(value)
        cols.append(value.alias(oc.name))
    delete_ts = convert.epoch_ms_to_timestamp(F.col("_last_seq.ts_ms"))
    if spec.has_field("updated_at"):
        updated = F.when(deleted, delete_ts).otherwise(convert.epoch_ms_to_timestamp(img["updated_at"]))
    else:
        updated = delete_ts
    cols += [updated.alias("updated_at"),
             convert.epoch_ms_to_timestamp(F.col("_first_created")).alias("created_at"),
             deleted.alias("_deleted")]
    if keep_state:
        cols += [F.col(c) for c in ("_last_op", "_last_seq")]
    return states.filter(F.col("_up_seq").isNotNull()).select(*cols)


def current_state(bronze_df: DataFrame, spec: TableSpec) -> DataFrame:
    """Replay: fold the whole bronze log into the silver table."""
    return materialize(fold_changes(changes(bronze_df, spec), spec), spec)


def incremental_state(bronze_df: DataFrame, spec: TableSpec, batch_col: str = "_batch_id") -> DataFrame:
    """Fold each micro-batch on its own, then merge the per-batch states;
    equal to ``current_state`` by construction."""
    per_batch = fold_changes(changes(bronze_df, spec), spec, by=(batch_col,), key_first=True).drop(batch_col)
    return materialize(merge_states(per_batch, spec), spec)


def state_as_of(bronze_df: DataFrame, spec: TableSpec, as_of_ms: int) -> DataFrame:
    """The silver table as it was at ``as_of_ms`` (events with ts_ms <= T);
    the filter is pushed into the bronze scan."""
    return current_state(bronze_df.filter(F.col("ts_ms") <= F.lit(as_of_ms)), spec)


def latest_per_batch(bronze_df: DataFrame, spec: TableSpec, batch_col: str = "_batch_id",
                     key_from: str = "op") -> DataFrame:
    """The last event of each key within each batch.  ``max_by`` combines
    map-side instead of a window sort.

    ``key_from="op"`` keys deletes by ``before`` (correct).  ``"after"``
    reproduces keying every event by its ``after`` image, under which all
    deletes of a batch share the null key and only one survives; it exists
    to compare against that behaviour, not for use."""
    ch = changes(bronze_df, spec)
    if key_from == "after":
        ch = ch.withColumn(spec.key, F.col("after")[spec.key])
    last = F.max_by(F.struct("op", F.col("_seq.ts_ms").alias("ts_ms"), F.col("_seq.offset").alias("offset"),
                             F.coalesce("after", "before").alias("image")), "_seq").alias("_last")
    out = ch.groupBy(batch_col, spec.key).agg(last)
    img_cols = [F.col("_last.image")[f].alias(f) for f in spec.row_schema.fieldNames() if f != spec.key]
    return out.select(batch_col, spec.key, "_last.op", "_last.ts_ms", "_last.offset", *img_cols)


def upserts(bronze_df: DataFrame, spec: TableSpec) -> DataFrame:
    """Create/update/snapshot events as silver-shaped rows (``_deleted`` false)."""
    img = F.col("after")
    cols = [oc.convert(img[oc.source]).alias(oc.name) for oc in spec.columns]
    return bronze_df.filter(F.col("op").isin(*specs.UPSERT_OPS)).select(
        *cols, F.col("ts_ms"), F.col("offset"), F.lit(False).alias("_deleted"))


def deletes(bronze_df: DataFrame, spec: TableSpec) -> DataFrame:
    """Delete events: the key (and the layout column) from ``before``."""
    cols = [F.col("before")[spec.key].alias(spec.key)]
    if spec.layout_column:
        oc = next(c for c in spec.columns if c.name == spec.layout_column)
        cols.append(oc.convert(F.col("before")[oc.source]).alias(oc.name))
    return bronze_df.filter(F.col("op") == specs.DELETE_OP).select(*cols, "ts_ms", "offset")


__all__ = ["changes", "event_states", "merge_states", "fold_changes", "materialize", "current_state",
           "incremental_state", "state_as_of", "latest_per_batch", "upserts", "deletes", "event_key"]
