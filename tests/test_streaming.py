import re
from datetime import date

import pytest

from tests.rows import event, events, profile, profiles
from tillroll import schemas
from tillroll.operators.events import clean_sales_events
from tillroll.sources import sinks
from tillroll.sources.files import partition_dirs
from tillroll.sources.lake import Lake, read_clean_events, read_clean_profiles, read_raw_events
from tillroll.plans.silver import clean_events_job
from tillroll.streaming import live, upsert
from tillroll.streaming.landing import start_landing, with_ingest_date
from tillroll.streaming.live import LiveTables, start_live
from tillroll.streaming.upsert import EventDays, start_incremental_clean, start_incremental_profiles


@pytest.fixture
def place(tmp_path):
    class Place:
        lake = Lake(str(tmp_path / "lake"))
        inbox = str(tmp_path / "inbox")

        def path(self, name):
            return str(tmp_path / name)

    return Place()


def deliver(spark, place, *rows):
    events(spark, *rows).coalesce(1).write.mode("append").parquet(place.inbox)


def inbox(spark, place):
    return spark.readStream.schema(schemas.SALES_EVENTS_RAW).parquet(place.inbox)


def follow(spark, place, **options):
    start_incremental_clean(spark, place.lake, place.path("clean-cp"), **options).awaitTermination()


def clean(spark, place):
    rows = read_clean_events(spark, place.lake.clean_events).collect()
    return sorted((r.event_id, r.quantity, r.event_date.day) for r in rows)


def rejected(spark, place):
    return sorted(r.event_id for r in spark.read.parquet(place.lake.quarantine).collect())


def land(spark, place, *rows):
    sinks.land_batch(with_ingest_date(events(spark, *rows)), place.lake.raw_events)


def test_landing_is_exactly_once_over_restarts(spark, place):
    deliver(spark, place, event(event_id="a"), event(event_id="b", ingest_ts="2024-05-21T00:00:00"))
    for more in ([], [], [event(event_id="c")]):
        if more:
            deliver(spark, place, *more)
        start_landing(inbox(spark, place), place.lake.raw_events, place.path("cp")).awaitTermination()
    landed = read_raw_events(spark, place.lake.raw_events).collect()
    assert sorted((r.event_id, r.ingest_date) for r in landed) == [
        ("a", date(2024, 5, 20)), ("b", date(2024, 5, 21)), ("c", date(2024, 5, 20)),
    ]


def test_late_row_does_not_wipe_its_day(spark, place):
    land(spark, place, event(event_id="a"), event(event_id="b", event_ts="2024-05-19T23:30:00"))
    follow(spark, place)
    # Only one row arrives the next day, and it belongs to the day before.
    land(spark, place, event(event_id="late", ingest_ts="2024-05-21T02:00:00", event_ts="2024-05-20T22:00:00"))
    follow(spark, place)
    assert clean(spark, place) == [("a", 4, 20), ("b", 4, 19), ("late", 4, 20)]


def test_later_copies_win_and_clear_rejects(spark, place):
    land(spark, place, event(event_id="a", quantity=1), event(event_id="bad", quantity=0))
    follow(spark, place)
    assert rejected(spark, place) == ["bad"]
    land(
        spark, place,
        event(event_id="a", quantity=7, ingest_ts="2024-05-20T10:30:00"),
        event(event_id="bad", quantity=3, ingest_ts="2024-05-20T10:30:00"),
    )
    follow(spark, place)
    assert clean(spark, place) == [("a", 7, 20), ("bad", 3, 20)]
    assert partition_dirs(spark, place.lake.quarantine, "event_date") == set()


def test_unreadable_times_reach_the_quarantine(spark, place):
    land(spark, place, event(event_id="a"), event(event_id="no time", event_ts="?"))
    land(spark, place, event(event_id="no arrival", ingest_ts="?"))
    follow(spark, place)
    land(spark, place, event(event_id="b", ingest_ts="2024-05-20T12:00:00"))
    follow(spark, place)
    assert clean(spark, place) == [("a", 4, 20), ("b", 4, 20)]
    assert rejected(spark, place) == ["no arrival", "no time"]


def test_event_that_moves_to_another_day(spark, place):
    options = dict(copies_share_day=False)
    land(spark, place, event(event_id="a"), event(event_id="stays"))
    follow(spark, place, **options)
    land(spark, place, event(event_id="a", event_ts="2024-05-19T10:00:00", ingest_ts="2024-05-20T12:00:00"))
    follow(spark, place, **options)
    assert clean(spark, place) == [("a", 4, 19), ("stays", 4, 20)]


def test_incremental_equals_full_run_in_any_batching(spark, place):
    base = [
        event(
            event_id=f"e{n % 40}",
            quantity=n % 5,
            event_ts=f"2024-05-{10 + n % 40 % 4:02d}T{n % 40 % 24:02d}:00:00",
            ingest_ts=f"2024-05-{10 + n % 40 % 4 + n % 2:02d}T23:{n % 60:02d}:00",
        )
        for n in range(120)
    ]
    for part in (base[:30], base[30:35], base[35:]):
        land(spark, place, *part)
        follow(spark, place, max_files_per_batch=2)
    expected = clean_sales_events(events(spark, *base))
    assert clean(spark, place) == sorted(
        (r.event_id, r.quantity, r.event_ts.day) for r in expected.clean.collect()
    )
    assert rejected(spark, place) == sorted(r.event_id for r in expected.quarantine.collect())


def test_backfill_that_lands_before_its_day(spark, place):
    early = event(event_id="early", event_ts="2024-05-25T08:00:00", ingest_ts="2024-05-20T09:00:00")
    land(spark, place, event(event_id="a"), early)
    follow(spark, place)
    land(spark, place, event(event_id="late", event_ts="2024-05-25T09:00:00", ingest_ts="2024-05-26T09:00:00"))
    follow(spark, place)
    assert clean(spark, place) == [("a", 4, 20), ("early", 4, 25), ("late", 4, 25)]


def test_copies_on_both_sides_of_midnight(spark, place):
    land(spark, place, event(event_id="a", event_ts="2024-05-20T23:59:59", ingest_ts="2024-05-21T00:00:05"))
    follow(spark, place)
    land(spark, place, event(event_id="a", event_ts="2024-05-21T00:00:01", ingest_ts="2024-05-21T00:00:09"))
    follow(spark, place)
    assert clean(spark, place) == [("a", 4, 21)]


def test_incremental_profiles(spark, place):
    def land_profiles(*rows):
        sinks.land_batch(with_ingest_date(profiles(spark, *rows)), place.lake.raw_profiles)

    def run():
        start_incremental_profiles(spark, place.lake, place.path("profiles-cp")).awaitTermination()
        rows = read_clean_profiles(spark, place.lake.clean_profiles).collect()
        return sorted((r.customer_id, r.loyalty_tier, str(r.snapshot_date)) for r in rows)

    land_profiles(profile(), profile(customer_id="buyer-2"), profile(customer_id="buyer-3", snapshot_ts="?"))
    assert run() == [
        ("buyer-1", "gold", "2024-05-20"), ("buyer-2", "gold", "2024-05-20"), ("buyer-3", "gold", "None"),
    ]
    land_profiles(
        profile(snapshot_ts="2024-05-20T08:00:00", loyalty_tier="silver", ingest_ts="2024-05-22T00:00:00"),
        profile(customer_id="buyer-2", snapshot_ts="2024-05-21T00:00:00", ingest_ts="2024-05-22T00:00:00"),
        profile(customer_id="buyer-2", snapshot_ts="2024-05-20T09:00:00", loyalty_tier="?"),
    )
    assert run() == [
        ("buyer-1", "silver", "2024-05-20"), ("buyer-2", "gold", "2024-05-21"), ("buyer-3", "gold", "None"),
    ]


def test_a_batch_reads_its_buckets_and_landing_days_only(spark, place):
    land(spark, place, event(event_id="a"), event(event_id="b", ingest_ts="2024-05-21T00:00:00"))
    follow(spark, place)
    days = EventDays(place.lake)
    assert {r.event_id for r in days.index.read(spark).collect()} == {"a", "b"}
    ids = days.index.ids(events(spark, event(event_id="b")))
    known = days.index.copies_of(ids)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)
    (row,) = known.collect()
    assert (row.event_id, str(row.event_day), str(row.ingest_date)) == ("b", "2024-05-20", "2024-05-21")
    plan = days.copies(spark, ids, [row.ingest_date])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*ingest_date", plan)


def test_index_of_a_lake_without_one_and_its_compaction(spark, place):
    land(spark, place, event(event_id="a"), event(event_id=None))
    clean_events_job(spark, place.lake)
    land(spark, place, event(event_id="a", quantity=7, ingest_ts="2024-05-22T00:00:00", event_ts="2024-05-18T00:00:00"))
    follow(spark, place)
    named = read_clean_events(spark, place.lake.clean_events).where("event_id is not null").collect()
    assert [(r.event_id, r.quantity, r.event_date.day) for r in named] == [("a", 7, 18)]
    index = EventDays(place.lake).index
    before = {tuple(r) for r in index.read(spark).collect()}
    index.add(index.read(spark))
    index.compact(spark)
    after = [tuple(r) for r in index.read(spark).collect()]
    assert set(after) == before and len(after) == len(before)


def test_a_batch_that_breaks_off_is_made_good(spark, place, monkeypatch):
    land(spark, place, event(event_id="a"), event(event_id="b"))
    follow(spark, place)
    land(spark, place, event(event_id="a", event_ts="2024-05-19T10:00:00", ingest_ts="2024-05-20T12:00:00"))
    real, calls = upsert.overwrite_partitions, []

    def breaks_at_the_second(*args, **options):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*args, **options)

    monkeypatch.setattr(upsert, "overwrite_partitions", breaks_at_the_second)
    with pytest.raises(Exception, match="lost"):
        follow(spark, place)
    monkeypatch.undo()
    follow(spark, place)
    assert clean(spark, place) == [("a", 4, 19), ("b", 4, 20)]


def test_only_events_that_came_before_are_searched_for(spark, place, monkeypatch):
    real, asked = EventDays.copies, []

    def noting(self, spark, ids, landings):
        asked.append(sorted(r.event_id for r in ids.collect()))
        return real(self, spark, ids, landings)

    monkeypatch.setattr(EventDays, "copies", noting)
    land(spark, place, event(event_id="a"), event(event_id="b"), event(event_id="b", quantity=9))
    follow(spark, place)
    later = {"event_ts": "2024-05-19T10:00:00", "ingest_ts": "2024-05-20T12:00:00"}
    land(spark, place, event(event_id="a", **later), event(event_id="c"), event(event_id="c", quantity=9))
    follow(spark, place)
    assert asked == [[], ["a"]]
    assert clean(spark, place) == [("a", 4, 19), ("b", 9, 20), ("c", 9, 20)]
    entries = EventDays(place.lake).index.read(spark).collect()
    assert sorted((r.event_id, r.event_day.day) for r in entries) == [("a", 19), ("a", 20), ("b", 20), ("c", 20)]


def test_events_that_a_batch_run_stored_first(spark, place):
    """The index does not know them yet when their batch is followed."""
    land(spark, place, event(event_id="a"))
    follow(spark, place)
    land(spark, place, event(event_id="b"), event(event_id="bad", quantity=0))
    clean_events_job(spark, place.lake)
    follow(spark, place)
    assert clean(spark, place) == [("a", 4, 20), ("b", 4, 20)]
    assert rejected(spark, place) == ["bad"]


def live_revenue(spark, tables):
    return sorted(map(tuple, tables.read_revenue(spark).select("sales_date", "n_transactions", "total_revenue").collect()))


def test_revenue_takes_old_lines_out(spark, place):
    tables = LiveTables(place.path("live-tables"))
    nan, day = float("nan"), date(2024, 5, 20)
    later = {"ingest_ts": "2024-05-20T12:00:00"}
    steps = [
        ([event(event_id="a"), event(event_id="b", unit_price=nan)], 2, None),
        ([event(event_id="b", unit_price=0.1, quantity=3, **later)], 2, 160.3),
        ([event(event_id="c", unit_price=float("inf"))], 3, float("inf")),
        ([event(event_id="c", unit_price=-1.0, **later)], 2, 160.3),
        ([event(event_id="d", unit_price=1e30, quantity=1)], 3, 1e30),
        ([event(event_id="d", event_type="void", **later)], 2, 160.3),
    ]
    for number, (rows, n, total) in enumerate(steps):
        for _ in range(2):  # a repeated batch counts once
            tables.merge(events(spark, *rows), number)
        ((at, count, revenue),) = live_revenue(spark, tables)
        assert (at, count) == (day, n)
        assert revenue != revenue if total is None else revenue == total
        if number == 2:
            tables.fold(spark)
            assert live_revenue(spark, tables) == [(day, n, total)]
    tables.fold(spark)
    assert live_revenue(spark, tables) == [(day, 2, 160.3)]


def test_a_live_batch_that_breaks_off_counts_once(spark, place, monkeypatch):
    tables = LiveTables(place.path("live-tables"))
    tables.merge(events(spark, event(event_id="a"), event(event_id="b")), 0)
    rows = events(spark, event(event_id="a", quantity=1, ingest_ts="2024-05-20T12:00:00"), event(event_id="c"))

    def fails(*args, **options):
        raise RuntimeError("lost")

    monkeypatch.setattr(live, "overwrite_partitions", fails)
    with pytest.raises(RuntimeError):
        tables.merge(rows, 1)
    monkeypatch.undo()
    tables.merge(rows, 1)
    assert live_revenue(spark, tables) == [(date(2024, 5, 20), 3, 360.0)]
    assert sorted(r.quantity for r in tables.read_latest(spark).collect()) == [1, 4, 4]


def test_late_rows_and_the_store_are_all_events(spark, place):
    tables = LiveTables(place.path("live-tables"), lateness="6 hours")
    first = [event(event_id="a"), event(event_id="z", event_ts="2024-05-21T10:00:00"), event(event_id="odd", event_ts="?")]
    second = [
        event(event_id="too late", event_ts="2024-05-20T11:00:00"),
        event(event_id="in time", event_ts="2024-05-21T05:00:00"),
        event(event_id="z", quantity=9, event_ts="2024-05-21T10:00:00", ingest_ts="2024-05-22T00:00:00"),
    ]
    for number, rows in enumerate((first, second)):
        for _ in range(2):
            tables.merge(events(spark, *rows), number)
    late = sorted(r.event_id for r in tables.read_late(spark).collect())
    kept = sorted((r.event_id, r.quantity) for r in tables.read_latest(spark).collect())
    assert late == ["odd", "too late"]
    assert kept == [("a", 4), ("in time", 4), ("z", 9)]


def test_live_tables_hold_all_after_each_batch(spark, place):
    """Late by days, moved to another day, mended, without a readable time: as a batch over all would say."""
    tables = LiveTables(place.path("live-tables"))
    batches = [
        [event(event_id="a"), event(event_id="bad", quantity=0), event(event_id="moved"), event(event_id="odd", event_ts="?")],
        [event(event_id="new", event_ts="2024-05-28T08:00:00", ingest_ts="2024-05-28T08:00:01")],
        [
            event(event_id="a", quantity=9, ingest_ts="2024-05-29T00:00:00"),
            event(event_id="moved", event_ts="2024-05-19T23:00:00", ingest_ts="2024-05-29T00:00:00"),
            event(event_id="bad", quantity=1, ingest_ts="2024-05-29T00:00:00"),
            event(event_id="new", event_ts="2024-05-30T08:00:00", ingest_ts="2024-05-30T08:00:01"),
        ],
    ]
    seen = []
    for rows in batches:
        seen += rows
        deliver(spark, place, *rows)
        start_live(inbox(spark, place), tables, place.path("live-tables-cp")).awaitTermination()
        clean, rejected = tables.split(tables.read_latest(spark))
        expected = clean_sales_events(events(spark, *seen))
        key = lambda r: (r.event_id, r.quantity, str(r.event_ts))
        assert sorted(map(key, clean.collect())) == sorted(map(key, expected.clean.collect()))
        assert sorted(map(key, rejected.collect())) == sorted(map(key, expected.quarantine.collect()))
        revenue = sorted(map(tuple, tables.read_revenue(spark).select("sales_date", "total_revenue").collect()))
        by_day = {}
        for r in expected.clean.collect():
            by_day[r.event_ts.date()] = by_day.get(r.event_ts.date(), 0) + r.line_amount
        assert revenue == sorted(by_day.items())
    assert partition_dirs(spark, tables.latest, "event_date") == {
        "event_date=2024-05-19", "event_date=2024-05-20", "event_date=2024-05-30",
        "event_date=__HIVE_DEFAULT_PARTITION__",
    }
