"""Property test: the Spark fold equals a plain-Python model of CDC state.

The model replays each key's events in sequence order: an upsert replaces
the row (keeping the first ``created_at``), a delete marks it deleted with
the delete's time.  Hypothesis draws events with colliding timestamps,
deletes before inserts, re-inserts and duplicates, split into batches.
"""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from changefold import specs
from changefold.operators import fold, ingest

from helpers import messages

EV = specs.USER_EVENTS

event = st.tuples(
    st.integers(1, 4),                       # key
    st.sampled_from(["c", "u", "r", "d"]),   # op
    st.integers(0, 5),                       # ts_ms (collisions on purpose)
    st.floats(-5, 5, allow_nan=False).map(lambda x: round(x, 2)),  # value
)


def model(events):
    """events: list of (key, op, ts, value, offset) -> {key: (value, deleted, updated, created)}."""
    state = {}
    for key, op, ts, value, offset in sorted(events, key=lambda e: (e[0], e[2], e[4])):
        cur = state.get(key)
        if op == "d":
            if cur is None:
                state[key] = {"row": None, "deleted": True, "updated": ts, "created": None}
            else:
                cur.update(deleted=True, updated=ts)
        else:
            created = cur["created"] if cur and cur["created"] is not None else ts
            state[key] = {"row": value, "deleted": False, "updated": ts, "created": created}
    return {k: (v["row"], v["deleted"], v["updated"], v["created"])
            for k, v in state.items() if v["created"] is not None}


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(evs=st.lists(event, min_size=1, max_size=30), batches=st.integers(1, 4), dup=st.booleans(),
       seed=st.integers(0, 10**6))
def test_fold_matches_model(spark, evs, batches, dup, seed):
    import random
    rng = random.Random(seed)
    events = [(k, op, ts, v, off) for off, (k, op, ts, v) in enumerate(evs)]
    items = []
    for k, op, ts, v, off in events:
        img = {"user_id": k, "value": v}
        env = {"op": op, "ts_ms": ts, "before": img if op == "d" else None, "after": None if op == "d" else img}
        items.append((json.dumps(env), off, rng.randrange(batches), k % 3))
    if dup:
        items += [(t, o, rng.randrange(batches), p) for t, o, _, p in items]
    rng.shuffle(items)
    bronze = ingest.bronze(ingest.classify(messages(spark, items), EV))
    got = {r.user_id: (r.value, r._deleted, int(r.updated_at.timestamp() * 1000),
                       int(r.created_at.timestamp() * 1000))
           for r in fold.incremental_state(bronze, EV).collect()}
    assert got == model(events)
