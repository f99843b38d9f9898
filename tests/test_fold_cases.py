"""Hand-written change cases (FIXTURES.md §6) for the fold."""

import json

from changefold import specs
from changefold.operators import fold, ingest

from helpers import envelope as env, messages, rows_by_key, state_of


def test_plain_create_update(spark):
    s = rows_by_key(state_of(spark, [(env("c", ts=1, value=1.0), 1), (env("u", ts=2, value=2.0), 2)]))
    assert s[1]["value"] == 2.0 and s[1]["_deleted"] is False


def test_snapshot_then_update(spark):
    s = rows_by_key(state_of(spark, [(env("r", ts=1, value=1.0), 1), (env("u", ts=2, value=5.0), 2)]))
    assert s[1]["value"] == 5.0 and not s[1]["_deleted"]


def test_delete_keeps_last_image(spark):
    s = rows_by_key(state_of(spark, [(env("c", ts=1, value=1.0), 1), (env("d", ts=2, value=1.0), 2)]))
    assert s[1]["_deleted"] is True and s[1]["value"] == 1.0
    assert s[1]["updated_at"].timestamp() * 1000 == 2  # the delete's own time, not "now"


def test_insert_and_delete_in_one_batch(spark):
    s = rows_by_key(state_of(spark, [(env("c", ts=1), 1, 7), (env("d", ts=2), 2, 7)]))
    assert s[1]["_deleted"] is True


def test_many_deletes_in_one_batch_all_survive(spark):
    items = [(env("c", key=k, ts=k), k, 0) for k in (1, 2, 3)]
    items += [(env("d", key=k, ts=10 + k), 10 + k, 1) for k in (1, 2, 3)]
    s = rows_by_key(state_of(spark, items))
    assert sorted(k for k, r in s.items() if r["_deleted"]) == [1, 2, 3]


def test_latest_per_batch_keys_deletes_by_before(spark):
    items = [(env("d", key=k, ts=k), k, 0) for k in (1, 2, 3)]
    bronze = ingest.bronze(ingest.classify(messages(spark, items), specs.USER_EVENTS))
    out = fold.latest_per_batch(bronze, specs.USER_EVENTS).collect()
    assert sorted(r.user_id for r in out) == [1, 2, 3]


def test_after_keyed_dedup_loses_deletes(spark):
    """The keying this engine fixes: by ``after`` only one delete survives."""
    items = [(env("d", key=k, ts=k), k, 0) for k in (1, 2, 3)]
    bronze = ingest.bronze(ingest.classify(messages(spark, items), specs.USER_EVENTS))
    assert fold.latest_per_batch(bronze, specs.USER_EVENTS, key_from="after").count() == 1
    assert fold.latest_per_batch(bronze, specs.USER_EVENTS).count() == 3


def test_reinsert_keeps_first_created(spark):
    s = rows_by_key(state_of(spark, [(env("c", ts=1), 1), (env("d", ts=2), 2), (env("c", ts=3), 3)]))
    assert s[1]["_deleted"] is False
    assert s[1]["created_at"].timestamp() * 1000 == 1


def test_delete_of_unknown_key_gives_no_row(spark):
    assert state_of(spark, [(env("d", key=9, ts=1), 1)]).count() == 0


def test_delete_before_insert_is_honoured(spark):
    # The delete arrives first (in an earlier batch) but is the later event.
    s = rows_by_key(state_of(spark, [(env("d", ts=5), 1, 0), (env("c", ts=1), 2, 1)]))
    assert s[1]["_deleted"] is True


def test_late_update_loses(spark):
    s = rows_by_key(state_of(spark, [(env("u", ts=5, value=5.0), 1, 0), (env("u", ts=3, value=3.0), 2, 1)]))
    assert s[1]["value"] == 5.0


def test_same_ts_breaks_tie_by_offset(spark):
    s = rows_by_key(state_of(spark, [(env("u", ts=5, value=8.0), 8), (env("u", ts=5, value=7.0), 7)]))
    assert s[1]["value"] == 8.0


def test_same_ts_breaks_tie_by_lsn_first(spark):
    s = rows_by_key(state_of(spark, [(env("u", ts=5, lsn=2, value=2.0), 7),
                                     (env("u", ts=5, lsn=1, value=1.0), 8)]))
    assert s[1]["value"] == 2.0


def test_duplicate_delivery_is_idempotent(spark):
    items = [(env("c", ts=1, value=1.0), 1), (env("u", ts=2, value=2.0), 2), (env("d", ts=3), 3)]
    once = rows_by_key(state_of(spark, items))
    twice = rows_by_key(state_of(spark, items + items))
    assert once == twice


def _order(op, ts, order_date, status="PENDING", key=1):
    image = {"order_id": key, "order_date": order_date, "delivery_date": None, "customer_id": 3,
             "status": status, "updated_at": ts, "created_at": ts}
    e = {"op": op, "ts_ms": ts, "before": image if op == "d" else None, "after": None if op == "d" else image}
    return json.dumps(e)


def test_order_date_change_keeps_one_row(spark):
    s = state_of(spark, [(_order("c", 1, 19723), 1), (_order("u", 2, 19724), 2)], specs.ORDERS).collect()
    assert len(s) == 1 and str(s[0].order_date) == "2024-01-02"


def test_null_order_date_keeps_one_row(spark):
    s = state_of(spark, [(_order("c", 1, None), 1), (_order("u", 2, None), 2), (_order("u", 3, None), 3)],
                 specs.ORDERS).collect()
    assert len(s) == 1


def _item(op, ts, order_id, product_id, qty, key=1):
    image = {"order_item_id": key, "order_id": order_id, "product_id": product_id, "quanity": qty,
             "updated_at": ts, "created_at": ts}
    return json.dumps({"op": op, "ts_ms": ts, "after": image})


def test_item_moves_to_new_order_and_renames_quantity(spark):
    s = state_of(spark, [(_item("c", 1, 10, 20, 1), 1), (_item("u", 2, 11, 21, 4), 2)],
                 specs.ORDER_ITEMS).collect()
    assert (s[0].order_id, s[0].product_id, s[0].quantity) == (11, 21, 4)


def test_item_ids_can_keep_first_values_like_the_source_system(spark):
    items = [(_item("c", 1, 10, 20, 1), 1), (_item("u", 2, 11, 21, 4), 2)]
    s = state_of(spark, items, specs.ORDER_ITEMS_FIRST_IDS).collect()
    assert (s[0].order_id, s[0].product_id, s[0].quantity) == (10, 20, 4)


def _product(key, price):
    image = {"product_id": key, "product_name": "p", "barcode": "1", "unity_price": price,
             "is_active": True, "updated_at": 1, "created_at": 1}
    return json.dumps({"op": "c", "ts_ms": 1, "after": image})


def test_price_forms(spark):
    prices = {1: "12.34", 2: {"scale": 2, "value": "BNI="}, 3: {"scale": 2, "value": "+y4="},
              4: None, 5: "abc", 6: "-7.50"}
    items = [(_product(k, v), k) for k, v in prices.items()]
    s = {r.product_id: r.unity_price for r in state_of(spark, items, specs.PRODUCTS).collect()}
    assert float(s[1]) == 12.34 and float(s[2]) == 12.34
    assert float(s[3]) == -12.34  # 0xFB2E = -1234 in two's complement
    assert s[4] is None and s[5] is None and float(s[6]) == -7.5


def test_customer_delete_deactivates(spark):
    image = {"customer_id": 1, "customer_name": "a", "is_active": True, "customer_address": "x",
             "updated_at": 1, "created_at": 1}
    items = [(json.dumps({"op": "c", "ts_ms": 1, "after": image}), 1),
             (json.dumps({"op": "d", "ts_ms": 2, "before": image}), 2)]
    r = state_of(spark, items, specs.CUSTOMERS).collect()[0]
    assert r.is_active is False and r._deleted is True


def test_extra_json_field_is_ignored(spark):
    text = json.dumps({"op": "c", "ts_ms": 1, "after": {"user_id": 1, "value": 1.0, "surprise": 1},
                       "transaction": {"id": "x"}})
    assert state_of(spark, [(text, 1)]).count() == 1
