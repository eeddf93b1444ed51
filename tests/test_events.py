from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.rows import event, events
from tillroll.operators.events import (
    CLEAN_COLUMNS,
    clean_sales_events,
    dedupe_sales_events,
    enrich_sales_events,
    quarantine_malformed_sales_events,
)
from tillroll.operators.staging import stage_sales_events
from tillroll.plans.silver import without_unknown_references


def ids(df):
    return sorted(r.event_id for r in df.select("event_id").collect())


def test_latest_copy_wins(spark):
    """Twelve events of one to four copies each: every event keeps the copy that arrived last."""
    rows, last = [], {}
    for n in range(12):
        for copy in range(n % 4 + 1):
            minute = (n * 7 + copy * 11) % 60
            rows.append(event(event_id=f"e{n}", quantity=minute + 1, ingest_ts=f"2024-05-21T06:{minute:02d}:00"))
            last[f"e{n}"] = max(last.get(f"e{n}", 0), minute + 1)
    assert {r.event_id: r.quantity for r in dedupe_sales_events(events(spark, *rows)).collect()} == last


def test_arrival_is_compared_as_time_not_as_text(spark):
    df = events(
        spark,
        event(ingest_ts="2024-05-20T12:00:00+02:00", quantity=1),
        event(ingest_ts="2024-05-20T11:00:00+00:00", quantity=2),
    )
    assert [r.quantity for r in dedupe_sales_events(df).collect()] == [2]


@pytest.mark.parametrize("order", [1, -1])
def test_ties_do_not_depend_on_input_order(spark, order):
    rows = [event(quantity=q) for q in (1, 3, 2)][::order]
    assert dedupe_sales_events(events(spark, *rows)).first().quantity == 3
    assert dedupe_sales_events(events(spark, *rows), ["quantity"]).first().quantity == 3


def test_one_hot_event_id(spark):
    copies = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("event_id"),
        F.timestamp_seconds(F.col("id")).alias("ingest_ts"),
        F.col("id").alias("n"),
    )
    kept = dedupe_sales_events(copies)
    assert kept.count() == 20_000 - 6667 + 1
    assert kept.where("event_id = 'hot'").first().n == 19_998


def test_split(spark):
    """One field at a time is made wrong, or stretched as far as it may go."""
    wrong = dict(product_id=[""], store_id=[""], quantity=[0], unit_price=[-0.01], event_type=["", "SALE", "gift"])
    right = dict(quantity=[-9, 1], unit_price=[0.0], event_type=["refund", "void"], customer_id=["", None])

    def each(changes):
        return [event(event_id=f"{c}={v}", **{c: v}) for c, values in changes.items() for v in values]

    clean, rejected = quarantine_malformed_sales_events(events(spark, *each(wrong), *each(right)))
    assert ids(clean) == sorted(r["event_id"] for r in each(right))
    assert ids(rejected) == sorted(r["event_id"] for r in each(wrong))


@pytest.mark.parametrize("column", ["product_id", "store_id", "quantity", "unit_price", "event_type"])
def test_null_field(spark, column):
    df = events(spark, event(**{column: None}))
    clean, rejected = quarantine_malformed_sales_events(df)
    assert (clean.count(), rejected.count()) == (0, 1)
    clean, rejected = quarantine_malformed_sales_events(df, "reference")
    assert (clean.count(), rejected.count()) == (0, 0)


def test_null_field_beside_a_wrong_one_is_rejected_by_both_policies(spark):
    df = events(spark, event(product_id="", quantity=None))
    for policy in ("quarantine", "reference"):
        assert quarantine_malformed_sales_events(df, policy).quarantine.count() == 1


def test_unreadable_timestamp(spark):
    df = events(spark, event(event_ts="garbage"))
    assert clean_sales_events(df).quarantine.count() == 1
    kept = clean_sales_events(df, null_policy="reference").clean.first()
    assert kept.event_ts is None and kept.is_late_arrival is None


def test_price_that_is_no_number_passes(spark):
    clean = clean_sales_events(events(spark, event(unit_price=float("nan")))).clean
    assert clean.where("isnan(line_amount)").count() == 1


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        quarantine_malformed_sales_events(events(spark, event()), "other")


@pytest.mark.parametrize(
    ("quantity", "price", "discount", "amount"),
    [(7, 1.25, 0.5, 8.25), (2, 3.0, None, 6.0), (-4, 2.5, 1.0, -11.0), (3, 0.333, None, 1.0), (1, 0.0, 0.0, 0.0)],
)
def test_amount_of_a_line(spark, quantity, price, discount, amount):
    df = events(spark, event(quantity=quantity, unit_price=price, discount_amount=discount))
    row = enrich_sales_events(df).first()
    assert (row.discount_amount, row.line_amount) == (discount or 0.0, amount)
    assert row.event_ts == datetime(2024, 5, 20, 9, 15)


@pytest.mark.parametrize(
    ("arrival", "late"),
    [("10:15:00", False), ("10:15:00.9", False), ("10:15:01", True), ("08:59:00", False)],
)
def test_late_is_more_than_an_hour_in_whole_seconds(spark, arrival, late):
    df = events(spark, event(ingest_ts=f"2024-05-20T{arrival}"))
    assert enrich_sales_events(df).first().is_late_arrival is late


def test_whole_step(spark):
    """Copies, a late good copy of a broken event and a broken event, in one pass."""
    df = events(
        spark,
        event(event_id="mended", store_id=""),
        event(event_id="mended", ingest_ts="2024-05-20T18:00:00"),
        event(event_id="repeated"),
        event(event_id="repeated"),
        event(event_id="broken", unit_price=-1.0),
    )
    clean, rejected = clean_sales_events(df)
    assert (clean.columns, rejected.columns) == (CLEAN_COLUMNS, df.columns)
    assert (ids(clean), ids(rejected)) == (["mended", "repeated"], ["broken"])
    assert clean.where("is_late_arrival").first().event_id == "mended"


def test_malformed_later_copy_displaces_a_good_one(spark):
    df = events(spark, event(), event(ingest_ts="2024-05-20T11:00:00", quantity=0))
    clean, rejected = clean_sales_events(df)
    assert (clean.count(), rejected.count()) == (0, 1)


def test_sides_add_up_to_distinct_events(spark):
    raw = spark.range(3000).select(
        (F.col("id") % 700).cast("string").alias("event_id"),
        F.when(F.col("id") % 5 == 0, None).otherwise("sale").alias("event_type"),
        F.lit("c").alias("customer_id"),
        F.when(F.col("id") % 7 == 0, "").otherwise("p").alias("product_id"),
        F.when(F.col("id") % 11 == 0, None).otherwise("s").alias("store_id"),
        (F.col("id") % 3).alias("quantity"),
        F.lit(1.5).alias("unit_price"),
        F.lit(None).cast("double").alias("discount_amount"),
        F.timestamp_seconds("id").alias("event_ts"),
        F.timestamp_seconds("id").alias("ingest_ts"),
    )
    clean, rejected = clean_sales_events(raw)
    assert clean.count() + rejected.count() == 700
    assert not set(ids(clean)) & set(ids(rejected))


def test_staging_keeps_sales_only(spark):
    df = events(spark, event(event_id="a"), event(event_id="b", event_type="refund", quantity=-1))
    staged = stage_sales_events(clean_sales_events(df).clean)
    row = staged.first()
    assert staged.count() == 1 and row.event_id == "a"
    assert dict(staged.dtypes)["quantity"] == "int"
    assert row.event_date.isoformat() == "2024-05-20"


@pytest.mark.parametrize("small", [True, False])
def test_reference_check(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr("tillroll.plans.silver.BROADCAST_MAX_ROWS", 0)
    df = events(
        spark,
        event(event_id="known"),
        event(event_id="anonymous", customer_id=None),
        event(event_id="stranger", customer_id="buyer-9"),
        event(event_id="lost shop", store_id="shop-9"),
    )
    parents = {
        "customer_id": spark.createDataFrame([("buyer-1",), ("buyer-1",)], "customer_id string"),
        "store_id": spark.createDataFrame([("shop-1",)], "store_id string"),
    }
    clean, rejected = without_unknown_references(df, parents)
    assert ids(clean) == ["anonymous", "known"]
    assert ids(rejected) == ["lost shop", "stranger"]
    assert clean.columns == df.columns
