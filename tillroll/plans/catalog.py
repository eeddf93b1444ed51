"""Named queries over the retail tables: one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions.keys import surrogate_key
from tillroll.functions.scalars import email_domain
from tillroll.operators import quality
from tillroll.operators.dimensions import date_dimension_covering, dim_product, dim_store
from tillroll.operators.events import (
    clean_sales_events,
    dedupe_sales_events,
    enrich_sales_events,
    quarantine_malformed_sales_events,
)
from tillroll.operators.facts import FACT_COLUMNS, AsofStrategy, choose_strategy, fct_sales, sales_columns
from tillroll.operators.history import (
    CUSTOMER_CARRIED,
    CUSTOMER_TRACKED,
    change_points,
    dim_customer_scd2,
)
from tillroll.operators.marts import (
    customers_with_changes,
    mart_customer_ltv,
    mart_daily_store_sales,
    top_customers,
)
from tillroll.operators.profiles import clean_customer_profiles, dedupe_customer_profiles
from tillroll.operators.staging import stage_customer_profiles, stage_sales_events
from tillroll.operators.tallies import number_events, sales_by, store_day_tallies
from tillroll.plans.daily import run_daily
from tillroll.plans.gold import GOLD_TABLES, Seeds, build_gold
from tillroll.plans.report import health_metrics as stored_metrics
from tillroll.plans.silver import clean_events_job, clean_profiles_job, without_unknown_references
from tillroll.scratch import fresh_path, pin
from tillroll.sources import retail_tables as retail
from tillroll.sources.lake import (
    Lake,
    read_clean_events,
    read_clean_profiles,
    read_quarantine,
    read_raw_events,
    read_seed,
    read_seed_column,
    read_test_statuses,
)
from tillroll.sources.published import Layer
from tillroll.sources.sinks import export_csv, land_batch
from tillroll.streaming.history_store import HistoryStore, customer_history
from tillroll.streaming.landing import start_landing, with_ingest_date
from tillroll.streaming.live import LiveTables, start_live
from tillroll.streaming.upsert import start_incremental_clean, start_incremental_profiles

Query = Callable[[SparkSession, str], DataFrame]

# Load stamps differ from run to run.
_STAMPS = ("silver_loaded_at", "dbt_loaded_at")

_REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    _REGISTRY[build.__name__] = build
    return build


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _unstamped(df: DataFrame) -> DataFrame:
    return df.drop(*_STAMPS)


def _run(stream) -> None:
    stream.awaitTermination()


# --- building blocks over the given tables ---


def _clean(spark: SparkSession, sf_dir: str):
    events = retail.sales_events_by_order(spark, sf_dir)
    split = clean_sales_events(events, retail.EVENT_TIE_BREAKERS, shared=retail.EVENT_SHARED)
    return split._replace(quarantine=split.quarantine.drop(*retail.EVENT_SHARED))


def _deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = retail.sales_events_by_order(spark, sf_dir)
    latest = dedupe_sales_events(events, retail.EVENT_TIE_BREAKERS, retail.EVENT_SHARED)
    return latest.drop(*retail.EVENT_SHARED)


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_customer_profiles(
        retail.customer_snapshots(spark, sf_dir), retail.PROFILE_TIE_BREAKERS
    )


def _staged_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_sales_events(_clean(spark, sf_dir).clean)


def _staged_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_customer_profiles(_profiles(spark, sf_dir))


def _dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_dimension_covering(retail.table(spark, sf_dir, "lineitem"), "l_shipdate")


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_customer_scd2(_staged_profiles(spark, sf_dir), already_distinct=True)


# What the marts read of the fact.
_DAILY_FACT = ["event_id", "store_sk", "date_sk", "quantity", "line_amount"]
_LTV_FACT = ["event_id", "customer_sk", "event_ts", "line_amount"]


def _fact(
    spark: SparkSession,
    sf_dir: str,
    strategy: AsofStrategy = "auto",
    history: DataFrame | None = None,
    shops: DataFrame | None = None,
    numbered: bool = False,
    columns: Iterable[str] = FACT_COLUMNS,
) -> DataFrame:
    # The number takes the order from the store, day and event.
    needed = sales_columns([*columns, *(["event_id", "event_ts"] if numbered else [])])
    sales = _staged_sales(spark, sf_dir).select(*needed)
    sales = number_events(sales) if numbered else sales
    if "customer_sk" in columns:
        history = _history(spark, sf_dir) if history is None else history
        strategy = choose_strategy(history) if strategy == "auto" else strategy
        # By day, the sales are read twice; they are stored first, as they are between layers.
        sales = pin(sales, "staged_sales", codec="zstd") if strategy == "days" and not numbered else sales
    products = retail.products(spark, sf_dir)
    return fct_sales(
        sales,
        history,
        dim_product(products) if "product_sk" in columns else products,
        dim_store(retail.stores(spark, sf_dir)) if shops is None else shops,
        strategy,
        columns,
    )


def _ltv(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    history = _history(spark, sf_dir)
    fact = _fact(spark, sf_dir, history=history, columns=_LTV_FACT)
    return mart_customer_ltv(fact, history, events_unique=True, **options)


def _daily(spark: SparkSession, sf_dir: str, events_unique: bool) -> DataFrame:
    shops = dim_store(retail.stores(spark, sf_dir))
    fact = _fact(spark, sf_dir, shops=shops, columns=_DAILY_FACT)
    return mart_daily_store_sales(fact, shops, _dates(spark, sf_dir), events_unique)


def _seeds(spark: SparkSession, sf_dir: str) -> Seeds:
    return Seeds(
        retail.products(spark, sf_dir),
        retail.stores(spark, sf_dir),
        retail.customer_ids(spark, sf_dir),
    )


def _gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All tables; those that several checks read are written once."""
    seeds = _seeds(spark, sf_dir)
    clean = pin(_clean(spark, sf_dir).clean, "clean_events", codec="zstd")
    profiles = pin(_profiles(spark, sf_dir), "clean_profiles", codec="zstd")
    dates = _dates(spark, sf_dir)
    return build_gold(clean, profiles, seeds, dates, store=lambda name, df: pin(df, name, codec="zstd"))


# --- clean layer ---


@query
def raw_sales_events(spark, sf_dir):
    return retail.sales_events(spark, sf_dir)


@query
def raw_customer_snapshots(spark, sf_dir):
    return retail.customer_snapshots(spark, sf_dir).drop("ingest_ts")


@query
def dedupe_events(spark, sf_dir):
    return _deduped(spark, sf_dir).drop(*retail.EVENT_TIE_BREAKERS)


@query
def enriched_events(spark, sf_dir):
    columns = ["event_id", "discount_amount", "line_amount", "event_ts", "ingest_ts", "is_late_arrival"]
    return enrich_sales_events(retail.sales_events(spark, sf_dir)).select(*columns)


@query
def clean_events(spark, sf_dir):
    return _unstamped(_clean(spark, sf_dir).clean)


@query
def quarantined_events(spark, sf_dir):
    return _clean(spark, sf_dir).quarantine.drop(*retail.EVENT_TIE_BREAKERS)


@query
def null_policy_split(spark, sf_dir):
    """Sizes of both sides when a missing product is null instead of empty, under each policy."""
    events = _deduped(spark, sf_dir)
    holed = events.withColumn("product_id", F.nullif("product_id", F.lit("")))
    sizes = [
        side.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(policy).alias("policy"), F.lit(name).alias("side"), "n"
        )
        for policy in ("quarantine", "reference")
        for name, side in quarantine_malformed_sales_events(holed, policy)._asdict().items()
    ]
    return reduce(DataFrame.unionByName, sizes)


@query
def late_arrivals_by_day(spark, sf_dir):
    return (
        _clean(spark, sf_dir)
        .clean.groupBy(F.to_date("event_ts").alias("event_date"))
        .agg(F.count(F.lit(1)).alias("n_events"), F.count_if("is_late_arrival").alias("n_late"))
    )


@query
def reference_check(spark, sf_dir):
    """The optional reference check, against customers that ever had the gold tier."""
    events = _deduped(spark, sf_dir)
    gold = retail.customer_snapshots(spark, sf_dir).where("loyalty_tier = 'gold'")
    split = without_unknown_references(events, {"customer_id": gold})
    sides = split.clean.select("store_id", F.lit(True).alias("known")).unionByName(
        split.quarantine.select("store_id", F.lit(False).alias("known"))
    )
    return sides.groupBy("store_id").agg(
        F.count_if("known").alias("n_clean"), F.count_if(~F.col("known")).alias("n_quarantined")
    )


@query
def latest_profiles(spark, sf_dir):
    snapshots = retail.customer_snapshots(spark, sf_dir)
    return dedupe_customer_profiles(snapshots, retail.PROFILE_TIE_BREAKERS).drop("ingest_ts", "src_order")


@query
def clean_profiles(spark, sf_dir):
    return _unstamped(_profiles(spark, sf_dir))


@query
def staged_sales(spark, sf_dir):
    return _unstamped(_staged_sales(spark, sf_dir))


@query
def staged_profiles(spark, sf_dir):
    return _unstamped(_staged_profiles(spark, sf_dir))


@query
def email_domains(spark, sf_dir):
    return _profiles(spark, sf_dir).select(email_domain(F.col("email")).alias("email_domain")).distinct()


# --- dimensions, fact, marts ---


def _named(name: str, build: Query) -> None:
    _REGISTRY[name] = build


_named("dim_product", lambda spark, sf_dir: dim_product(retail.products(spark, sf_dir)))
_named("dim_store", lambda spark, sf_dir: dim_store(retail.stores(spark, sf_dir)))
_named("dim_date", _dates)
_named("dim_customer_scd2", lambda spark, sf_dir: _unstamped(_history(spark, sf_dir)))
_named("fct_sales", lambda spark, sf_dir: _unstamped(_fact(spark, sf_dir)))
_named("fct_sales_asof_window", lambda spark, sf_dir: _unstamped(_fact(spark, sf_dir, "days")))
_named("mart_daily_store_sales", lambda spark, sf_dir: _daily(spark, sf_dir, events_unique=True))
_named("mart_customer_ltv", _ltv)
_named("ltv_by_customer", lambda spark, sf_dir: _ltv(spark, sf_dir, scope="customer"))


_DAILY = ["store_id", "store_name", "region", "calendar_date", "is_weekend"]


@query
def mart_daily_store_sales_distinct(spark, sf_dir):
    """Distinct events without the claim that none repeats, from sets of event numbers."""
    shops = dim_store(retail.stores(spark, sf_dir))
    tallies = store_day_tallies(_fact(spark, sf_dir, shops=shops, numbered=True, columns=_DAILY_FACT))
    return sales_by(tallies, shops, _dates(spark, sf_dir), _DAILY)


@query
def mart_daily_of_repeated_lines(spark, sf_dir):
    """Lines of odd quantity occur twice: they count once as events, twice in units and revenue."""
    shops = dim_store(retail.stores(spark, sf_dir))
    fact = _fact(spark, sf_dir, shops=shops, numbered=True, columns=_DAILY_FACT)
    repeated = fact.unionByName(fact.where("quantity % 2 = 1"))
    return sales_by(store_day_tallies(repeated), shops, _dates(spark, sf_dir), _DAILY)


@query
def region_sales_by_quarter(spark, sf_dir):
    """Daily tallies of two runs, numbered apart (every other month each), merged without the fact."""
    shops = dim_store(retail.stores(spark, sf_dir))
    needed = sales_columns([*_DAILY_FACT, "event_ts"])
    sales = pin(_staged_sales(spark, sf_dir).select(*needed), "staged_sales", codec="zstd")
    runs = []
    for run in range(2):
        part = number_events(sales.where(F.month("event_ts") % 2 == run))
        fact = fct_sales(part, None, retail.products(spark, sf_dir), shops, columns=_DAILY_FACT)
        runs.append(store_day_tallies(fact, run))
    stored = pin(reduce(DataFrame.unionByName, runs), "tallies", codec="zstd")
    return sales_by(stored, shops, _dates(spark, sf_dir), ["region", "year", "quarter"])


@query
def scd2_change_points(spark, sf_dir):
    profiles = _staged_profiles(spark, sf_dir)
    return change_points(profiles, "customer_id", CUSTOMER_TRACKED, CUSTOMER_CARRIED, "snapshot_ts")


def _history_by_batches(spark: SparkSession, sf_dir: str) -> HistoryStore:
    """The stored history after three batches, each with every third month: later ones fall between earlier ones."""
    store = customer_history(fresh_path(spark, "history"))
    profiles = pin(_staged_profiles(spark, sf_dir), "staged_profiles")
    for number in range(3):
        store.merge(profiles.where(F.month("snapshot_ts") % 3 == number), number)
    return store


@query
def dim_customer_scd2_incremental(spark, sf_dir):
    """Equal to the full run but for the keys, which stay as they were given batch by batch."""
    return _history_by_batches(spark, sf_dir).read(spark)


@query
def customer_key_register(spark, sf_dir):
    """Every key ever given, with the batch that gave it."""
    return _history_by_batches(spark, sf_dir).read_keys(spark).drop("bucket")


@query
def customers_multi_version(spark, sf_dir):
    return customers_with_changes(_history(spark, sf_dir))


@query
def ltv_top200(spark, sf_dir):
    return top_customers(_ltv(spark, sf_dir))


@query
def ltv_preview(spark, sf_dir):
    """The first ten rows of the daily mart."""
    return _daily(spark, sf_dir, events_unique=True).orderBy("calendar_date", "store_id").limit(10)


# --- checks ---


@query
def dq_unique(spark, sf_dir):
    """On raw events, where copies violate it."""
    return quality.violations(
        quality.unique("raw", "event_id"), {"raw": retail.sales_events(spark, sf_dir)}
    )


@query
def dq_not_null(spark, sf_dir):
    check = quality.not_null("fct_sales", "customer_sk")
    fact = _fact(spark, sf_dir, columns=["event_id", "customer_sk", "event_ts"])
    return quality.violations(check, {"fct_sales": fact}).select("event_id", "event_ts")


@query
def dq_accepted_values(spark, sf_dir):
    check = quality.accepted_values("raw", "loyalty_tier", ["bronze", "silver", "gold", "platinum"])
    found = quality.violations(check, {"raw": retail.customer_snapshots(spark, sf_dir)})
    return found.select("customer_id", "loyalty_tier", "snapshot_ts")


@query
def dq_accepted_range(spark, sf_dir):
    check = quality.accepted_range("raw", "unit_price", 0, 90000)
    found = quality.violations(check, {"raw": retail.sales_events(spark, sf_dir)})
    return found.select("event_id", *retail.EVENT_TIE_BREAKERS, "unit_price")


@query
def dq_relationships(spark, sf_dir):
    """Customers with sales but without any profile."""
    check = quality.relationships("sales", "customer_id", "dim_customer_scd2", "customer_id")
    tables = {"sales": _staged_sales(spark, sf_dir), "dim_customer_scd2": _history(spark, sf_dir)}
    return quality.violations(check, tables).select("customer_id").distinct()


@query
def dq_one_current_row(spark, sf_dir):
    """The one-flagged-row rule on data that breaks it: late events per customer."""
    flagged = _clean(spark, sf_dir).clean.select("customer_id", F.col("is_late_arrival").alias("is_current"))
    check = quality.one_current_row("flagged", "customer_id")
    return quality.violations(check, {"flagged": flagged})


@query
def dq_line_amount(spark, sf_dir):
    """On amounts shifted by one, which all violate it."""
    shifted = _staged_sales(spark, sf_dir).withColumn("line_amount", F.col("line_amount") + 1)
    found = quality.violations(quality.line_amount_matches("fct"), {"fct": shifted})
    return found.select("event_id", "line_amount")


@query
def dq_suite(spark, sf_dir):
    return quality.run_checks(quality.retail_checks(), _gold(spark, sf_dir))


@query
def dq_summary(spark, sf_dir):
    return quality.status_histogram(dq_suite(spark, sf_dir))


@query
def table_counts(spark, sf_dir):
    tables = _gold(spark, sf_dir)
    return quality.table_counts(spark, {name: (lambda df=tables[name]: df) for name in GOLD_TABLES})


@query
def quarantine_count(spark, sf_dir):
    return _clean(spark, sf_dir).quarantine.agg(F.count(F.lit(1)).alias("n_quarantined"))


# --- storage ---


def _landed(spark: SparkSession, sf_dir: str) -> Lake:
    lake = Lake(fresh_path(spark, "lake"))
    for raw, path in (
        (retail.delivered_events(spark, sf_dir), lake.raw_events),
        (retail.delivered_profiles(spark, sf_dir), lake.raw_profiles),
    ):
        land_batch(with_ingest_date(raw).hint("rebalance", "ingest_date"), path)
    return lake


def _landing_summary(spark: SparkSession, lake: Lake) -> DataFrame:
    landed = read_raw_events(spark, lake.raw_events)
    return landed.groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_distinct("event_id").alias("n_ids")
    )


@query
def bronze_landing(spark, sf_dir):
    return _landing_summary(spark, _landed(spark, sf_dir))


@query
def silver_events_job(spark, sf_dir):
    lake = _landed(spark, sf_dir)
    clean_events_job(spark, lake)
    return _unstamped(read_clean_events(spark, lake.clean_events))


@query
def silver_profiles_job(spark, sf_dir):
    lake = _landed(spark, sf_dir)
    clean_profiles_job(spark, lake)
    return _unstamped(read_clean_profiles(spark, lake.clean_profiles))


def _daily_run(spark: SparkSession, sf_dir: str, strategy: AsofStrategy = "auto") -> Layer:
    lake = _landed(spark, sf_dir)
    dates = date_dimension_covering(retail.table(spark, sf_dir, "events"), "ts")
    run = run_daily(spark, lake, _seeds(spark, sf_dir), dates, strategy)
    if run.error:
        raise run.error
    return Layer(lake.gold)


@query
def fct_sales_published_by_months(spark, sf_dir):
    """The fact after a version without quantities, a run that broke off, and two runs of every other month each."""
    layer = Layer(fresh_path(spark, "gold"))
    month = F.floor(F.col("date_sk") / 100).cast("int")
    # Stored by month once, so that no run shuffles it again; the hashed key is made anew from the event.
    key, *rest = [c for c in FACT_COLUMNS if c not in _STAMPS]
    narrow = _fact(spark, sf_dir, columns=rest).withColumn("month", month)
    stored = pin(narrow, "fct_sales", by="month", codec="zstd")
    fact = stored.select(surrogate_key(F.col("event_id")).alias(key), "*")
    with layer.next(spark) as draft:
        draft.write("fct_sales", fact.withColumn("quantity", F.lit(0)), by="month", laid_out=True)
    lost = layer.next(spark)
    lost.write("fct_sales", fact.withColumn("quantity", F.lit(-1)), by="month", laid_out=True)
    for half in range(2):
        part = fact.where(F.col("month") % 2 == half)
        months = [r.month for r in part.select("month").distinct().collect()]
        with layer.next(spark) as draft:
            draft.write("fct_sales", part, by="month", days=months, laid_out=True)
    return layer.read(spark, "fct_sales").drop("month")


@query
def daily_run_store_sales(spark, sf_dir):
    return _daily_run(spark, sf_dir).read(spark, "mart_daily_store_sales")


@query
def daily_run_ltv(spark, sf_dir):
    return _daily_run(spark, sf_dir, "days").read(spark, "mart_customer_ltv")


@query
def daily_run_checks(spark, sf_dir):
    return _daily_run(spark, sf_dir).read(spark, "check_results")


@query
def seed_csv_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "ref_products")
    export_csv(retail.products(spark, sf_dir), path)
    return read_seed(spark, path, schemas.PRODUCTS)


@query
def seed_csv_column(spark, sf_dir):
    path = fresh_path(spark, "ref_stores")
    export_csv(retail.stores(spark, sf_dir), path)
    return read_seed_column(spark, path, schemas.STORES, "store_id")


@query
def ltv_csv_export(spark, sf_dir):
    path = fresh_path(spark, "ltv_top200")
    top = ltv_top200(spark, sf_dir)
    export_csv(top, path, single_file=True)
    return read_seed(spark, path, top.schema)


@query
def json_status_histogram(spark, sf_dir):
    """Run-result documents, one per order line, with the line's two flags as statuses."""
    path = fresh_path(spark, "run_results")
    flags = F.array(*(F.struct(F.col(c).alias("status")) for c in ("l_returnflag", "l_linestatus")))
    retail.table(spark, sf_dir, "lineitem").select(flags.alias("results")).write.json(path)
    return quality.status_histogram(read_test_statuses(spark, path, multi_line=False))


# --- streams ---


def _streamed(spark: SparkSession, sf_dir: str) -> Lake:
    lake = Lake(fresh_path(spark, "lake"))
    source = retail.delivered_events(spark, sf_dir, stream=True)
    _run(start_landing(source, lake.raw_events, fresh_path(spark, "landing-checkpoint")))
    return lake


def _upserted(spark: SparkSession, sf_dir: str) -> Lake:
    lake = _streamed(spark, sf_dir)
    _run(start_incremental_clean(spark, lake, fresh_path(spark, "clean-checkpoint")))
    return lake


def _live(spark: SparkSession, sf_dir: str) -> LiveTables:
    tables = LiveTables(fresh_path(spark, "live"))
    source = retail.delivered_events(spark, sf_dir, stream=True)
    _run(start_live(source, tables, fresh_path(spark, "live-checkpoint")))
    return tables


@query
def stream_landing(spark, sf_dir):
    return _landing_summary(spark, _streamed(spark, sf_dir))


@query
def stream_clean_events(spark, sf_dir):
    return _unstamped(read_clean_events(spark, _upserted(spark, sf_dir).clean_events))


@query
def stream_quarantine(spark, sf_dir):
    rejected = read_quarantine(spark, _upserted(spark, sf_dir).quarantine)
    return rejected.drop("ingest_date", "source_partition", "schema_version")


@query
def stream_clean_profiles(spark, sf_dir):
    lake = Lake(fresh_path(spark, "lake"))
    source = retail.delivered_profiles(spark, sf_dir, stream=True)
    _run(start_landing(source, lake.raw_profiles, fresh_path(spark, "landing-checkpoint")))
    _run(start_incremental_profiles(spark, lake, fresh_path(spark, "clean-checkpoint")))
    return _unstamped(read_clean_profiles(spark, lake.clean_profiles))


@query
def stream_latest_events(spark, sf_dir):
    tables = _live(spark, sf_dir)
    return _unstamped(tables.split(tables.read_latest(spark)).clean).drop("event_date")


@query
def stream_live_quarantine(spark, sf_dir):
    tables = _live(spark, sf_dir)
    return tables.split(tables.read_latest(spark)).quarantine.drop("source_partition", "schema_version")


@query
def stream_daily_revenue(spark, sf_dir):
    return _live(spark, sf_dir).read_revenue(spark)


def _upserted_in_parts(spark: SparkSession, sf_dir: str, parts: list, moved: bool = False) -> Lake:
    """The clean layer after the deliveries that meet each of ``parts`` landed and were followed, one by one."""
    lake, checkpoint = Lake(fresh_path(spark, "lake")), fresh_path(spark, "clean-checkpoint")
    delivered = retail.delivered_events(spark, sf_dir, second_copies_moved=moved)
    for part in parts:
        land_batch(with_ingest_date(delivered.where(part)).hint("rebalance", "ingest_date"), lake.raw_events)
        _run(start_incremental_clean(spark, lake, checkpoint))
    return lake


@query
def stream_clean_events_backfill(spark, sf_dir):
    """One of four shards comes after all others: its days are filled up afterwards."""
    last = F.col("source_partition") == "shard-3"
    lake = _upserted_in_parts(spark, sf_dir, [~last, last])
    return _unstamped(read_clean_events(spark, lake.clean_events))


@query
def stream_clean_events_moved(spark, sf_dir):
    """Second copies come later and move their events to the next day; rows with an even quantity come first."""
    even = F.col("quantity") % 2 == 0
    lake = _upserted_in_parts(spark, sf_dir, [even, ~even], moved=True)
    return _unstamped(read_clean_events(spark, lake.clean_events))


@query
def quarantine_after_mixed_runs(spark, sf_dir):
    """The batch job over what landed first, then the incremental job over the rest: one layout, one result."""
    lake = Lake(fresh_path(spark, "lake"))
    delivered = retail.delivered_events(spark, sf_dir)
    last = F.col("source_partition") == "shard-3"
    land_batch(with_ingest_date(delivered.where(~last)).hint("rebalance", "ingest_date"), lake.raw_events)
    clean_events_job(spark, lake)
    land_batch(with_ingest_date(delivered.where(last)).hint("rebalance", "ingest_date"), lake.raw_events)
    _run(start_incremental_clean(spark, lake, fresh_path(spark, "clean-checkpoint")))
    return read_quarantine(spark, lake.quarantine).drop("source_partition", "schema_version")


def _with_a_bound(spark: SparkSession, sf_dir: str) -> LiveTables:
    """Live tables with an hour's bound, after the deliveries of three shards and then those of the fourth."""
    tables = LiveTables(fresh_path(spark, "live"), lateness="1 hour")
    delivered = retail.delivered_events(spark, sf_dir)
    last = F.col("source_partition") == "shard-3"
    for number, part in enumerate([~last, last]):
        tables.merge(delivered.where(part), number)
    return tables


@query
def stream_late_rows(spark, sf_dir):
    """Deliveries for days that were closed before they came."""
    return _with_a_bound(spark, sf_dir).read_late(spark).drop("source_partition", "schema_version")


@query
def health_metrics(spark, sf_dir):
    """What a run left behind: rows per stored table, rejected events, statuses of its checks."""
    lake = _landed(spark, sf_dir)
    clean_events_job(spark, lake)
    stored = {
        "dim_product": dim_product(retail.products(spark, sf_dir)),
        "dim_store": dim_store(retail.stores(spark, sf_dir)),
    }
    with Layer(lake.gold).next(spark) as draft:
        for name, table in stored.items():
            draft.write(name, table)
    checks = [quality.unique("dim_store", "store_id"), quality.not_null("dim_product", "product_id")]
    return stored_metrics(spark, lake, [*stored], quality.run_checks(checks, stored).select("status"))
