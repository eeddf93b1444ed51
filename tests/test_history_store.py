from datetime import datetime, timedelta
from random import Random

import pytest

from tillroll.operators.history import dim_customer_scd2
from tillroll.streaming.history_store import customer_history

SNAPSHOT = "customer_id string, loyalty_tier string, home_store_id string, email_domain string, snapshot_ts timestamp"


def day(n, hour=0):
    return datetime(2026, 1, 1) + timedelta(days=n, hours=hour)


def frame(spark, rows):
    return spark.createDataFrame(list(rows), SNAPSHOT)


def versions(df):
    return sorted(map(repr, df.drop("customer_sk", "dbt_loaded_at").collect()))


def keys(df):
    return {(r.customer_id, r.effective_start_date): r.customer_sk for r in df.collect()}


@pytest.fixture
def store(tmp_path):
    return customer_history(str(tmp_path / "history"), buckets=4)


def test_batches_in_any_order_equal_the_full_run_and_keys_stay(spark, store):
    rng = Random(11)
    rows = [
        (None if c == 0 else f"c{c}", rng.choice(["gold", "silver"]), rng.choice(["s1", None]), f"d{d}", day(d))
        for c in range(12)
        for d in rng.sample(range(40), 12)
    ]
    # Every day of one customer, dealt over the batches like the rest.
    rows += [("hot", rng.choice(["gold", "silver"]), "s", "x", day(d)) for d in range(150)]
    rng.shuffle(rows)
    parts = [rows[0::3], rows[1::3], rows[2::3]]
    given = {}
    for number, part in enumerate(parts):
        store.merge(frame(spark, part), number)
        so_far = [row for p in parts[: number + 1] for row in p]
        assert versions(store.read(spark)) == versions(dim_customer_scd2(frame(spark, so_far)))
        now = keys(store.read(spark))
        assert all(now[place] == sk for place, sk in given.items() if place in now)
        assert min(sk for place, sk in now.items() if place not in given) > max(given.values(), default=0)
        given |= now
    register = store.read_keys(spark)
    assert sorted(r.customer_sk for r in register.collect()) == list(range(1, len(given) + 1))


def test_ranges_are_closed_split_and_joined(spark, store):
    store.merge(frame(spark, [("a", "gold", "s", "x", day(0)), ("a", "gold", "s", "x", day(9))]), 0)
    store.merge(frame(spark, [("a", "silver", "s", "x", day(4))]), 1)
    rows = store.read(spark).orderBy("effective_start_date").collect()
    assert [(r.customer_sk, r.loyalty_tier, r.is_current) for r in rows] == [
        (1, "gold", False), (2, "silver", False), (3, "gold", True),
    ]
    # The day between is corrected: one range again, under its old key; the other two keys stay unused.
    store.merge(frame(spark, [("a", "gold", "s", "x", day(4, 5))]), 2)
    assert [(r.customer_sk, r.is_current) for r in store.read(spark).collect()] == [(1, True)]
    store.merge(frame(spark, [("b", "gold", "s", "x", day(0)), ("a", "silver", "s", "x", day(9))]), 3)
    assert sorted(r.customer_sk for r in store.read(spark).collect()) == [1, 3, 4]


def test_withdrawn_days_and_emptied_buckets(spark, store):
    store.merge(frame(spark, [("a", "gold", "s", "x", day(0)), ("b", "gold", "s", "x", day(0))]), 0)
    gone = frame(spark, [("a", None, None, None, day(0, 7))])
    store.merge(frame(spark, []), 1, withdrawn=gone)
    assert [r.customer_id for r in store.read(spark).collect()] == ["b"]
    store.merge(frame(spark, [("a", "silver", "s", "x", day(0))]), 2, withdrawn=gone)
    assert keys(store.read(spark).where("customer_id = 'a'")) == {("a", day(0).date()): 1}


def test_a_batch_may_be_repeated_but_not_overtaken(spark, store):
    first = frame(spark, [("a", "gold", "s", "x", day(0))])
    second = frame(spark, [("a", "silver", "s", "x", day(1)), ("c", "gold", None, "x", day(1))])
    store.merge(first, 0)
    store.merge(second, 5)
    before = sorted(map(repr, store.read(spark).collect()))
    store.merge(second, 5)
    assert sorted(map(repr, store.read(spark).collect())) == before
    with pytest.raises(ValueError, match="later"):
        store.merge(first, 0)


def test_nothing_at_all(spark, store):
    assert store.read(spark).count() == 0
    store.merge(frame(spark, []), 0)
    assert store.read(spark).count() == 0 and store.read_keys(spark).count() == 0
    store.merge(frame(spark, [("a", "gold", "s", "x", day(0))]), 1)
    assert keys(store.read(spark)) == {("a", day(0).date()): 1}


def test_a_batch_replaces_only_its_buckets(spark, store):
    def files():
        return {"/".join(f.split("/")[-2:]) for f in store.read(spark).inputFiles()}

    store.merge(frame(spark, [(f"c{c}", "gold", "s", "x", day(0)) for c in range(40)]), 0)
    before = files()
    store.merge(frame(spark, [("c1", "silver", "s", "x", day(1))]), 1)
    assert len(before) == 4 and len(before & files()) == 3
