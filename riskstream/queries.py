"""Registered queries over the event table.

Timestamps are returned as timestamp_ntz and the session zone is UTC, so that results compare
with any engine.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import LongType, StringType, TimestampType

from riskstream.functions.clock import add_dt_hr, add_event_time
from riskstream.functions.frames import frame_columns, to_frame
from riskstream.operators.interval_join import hot_keys
from riskstream.operators.keyed import serving_alerts
from riskstream.operators.lateness import split_late
from riskstream.operators import routes
from riskstream.operators.routes import ROUTES
from riskstream.operators.sinks import COMPACTED, write_layer
from riskstream.plans.compaction import compact, compact_in_place, inventory
from riskstream.plans.gold import daily_kpi, daily_kpi_by_flag, location_risk
from riskstream.plans.hourly import run_hour
from riskstream.plans.layers import Layers, unify
from riskstream.plans import reports
from riskstream.plans.repair import REPAIR, missing_alerts, repair_alerts
from riskstream.plans.reports import rows
from riskstream.plans.serving import load_serving, serving_high_risk
from riskstream.plans.tables import create_tables, sync_partitions
from riskstream.plans.versions import drop_folded, fold_day, hours_table
from riskstream.schemas import struct
from riskstream.settings import Settings
from riskstream.sources.events import EVENTS, Feeds, feeds_from_events
from riskstream.sources.feeds import CONTRACTS, Contract, Version, bad_frames, decode_feed
from riskstream.sources.commits import records
from riskstream.sources.files import leaves, read_hours
from riskstream.streaming.jobs import dual_write_stream, start_dual_write, stream_session
from riskstream.streaming.history import replay, stage_slice, time_slices, topic_streams
from riskstream.workspace import shared_folder

DAY = "2024-01-01"
HOUR = 7


def plain_times(df: DataFrame) -> DataFrame:
    return df.selectExpr(*[
        f"CAST(`{f.name}` AS TIMESTAMP_NTZ) AS `{f.name}`" if isinstance(f.dataType, TimestampType)
        else f"`{f.name}`" for f in df.schema.fields
    ])


class Lake:
    """The feeds and layers of one data folder, and a scratch lake for the queries that write."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")

    @cached_property
    def settings(self) -> Settings:
        root = shared_folder(self.spark, "riskstream")
        return Settings(root, database=root.rsplit("/", 1)[1].replace("-", "_"))

    @cached_property
    def decoded(self) -> Feeds:
        return feeds_from_events(self.events)

    @cached_property
    def feeds(self) -> Feeds:
        return Feeds(*(add_event_time(feed) for feed in self.decoded))

    def layers(self, hot: tuple[str, ...] = ()) -> Layers:
        return Layers(self.feeds, Settings(""), "proc_time", hot)

    @cached_property
    def alerts(self) -> DataFrame:
        return add_dt_hr(self.layers().alerts)

    @cached_property
    def silver(self) -> DataFrame:
        return add_dt_hr(self.layers().silver)

    def write(self, tag: str, df: DataFrame, batch_id: str | Column = "history") -> None:
        route = ROUTES[tag]
        write_layer(df, self.settings.layer(route.layer), route, batch_id)

    def write_in_batches(self, tag: str, df: DataFrame, batches: int = 4, prefix: str = "batch") -> None:
        """History laid out the way a stream leaves it: several leaves in every hour."""
        number = F.pmod(F.xxhash64("transaction_id"), F.lit(batches))
        self.write(tag, df, F.concat(F.lit(f"{prefix}-"), number.cast("string")))

    def read(self, tag: str, dt: str | None = None, hr: int | None = None) -> DataFrame:
        route = ROUTES[tag]
        return read_hours(self.spark, self.settings.layer(route.layer), route.stored, dt, hr)


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    REGISTRY[build.__name__] = lambda spark, sf_dir: plain_times(build(Lake(spark, sf_dir)))
    return build


# --- feeds, clocks, scoring ----------------------------------------------------------------------
@query
def bronze_tx(lake: Lake) -> DataFrame:
    return add_dt_hr(lake.feeds.transactions).drop("proc_time")


@query
def bronze_login(lake: Lake) -> DataFrame:
    return add_dt_hr(lake.feeds.logins).drop("proc_time")


@query
def bronze_activity(lake: Lake) -> DataFrame:
    return add_dt_hr(lake.feeds.activity).drop("proc_time")


@query
def frame_decode(lake: Lake) -> DataFrame:
    """Every transaction framed as a raw message and decoded again."""
    contract = CONTRACTS["transactions"]
    body = F.to_json(F.struct(*contract.schema.names))
    raw = lake.decoded.transactions.select(
        to_frame(body, contract.schema_id).alias("value"), "kafka_timestamp")
    return decode_feed(raw, contract, "json")


@query
def frame_headers(lake: Lake) -> DataFrame:
    """Schema ids found in the frames of all three feeds, with their row counts."""
    def raw(feed: DataFrame, contract) -> DataFrame:
        body = F.to_json(F.struct(*contract.schema.names))
        return feed.select(to_frame(body, contract.schema_id).alias("value"))

    messages = [raw(feed, contract) for feed, contract in zip(lake.decoded, CONTRACTS.values())]
    framed = frame_columns(messages[0].union(messages[1]).union(messages[2]))
    return framed.groupBy("magic", "schema_id").agg(rows().alias("message_count"))


@query
def bad_frame_audit(lake: Lake) -> DataFrame:
    """Logins damaged by rule: a message in 10 loses its body, another its magic byte, another
    its closing brace."""
    contract = CONTRACTS["logins"]
    body = F.to_json(F.struct(*contract.schema.names))
    raw = lake.decoded.logins.select(
        to_frame(body, contract.schema_id).alias("value"), "kafka_timestamp",
        (F.col("timestamp") % 10).alias("damage"),
    ).withColumn(
        "value",
        F.when(F.col("damage") == 0, F.expr("substring(value, 1, 5)"))
        .when(F.col("damage") == 1, F.concat(F.lit(b"\x07"), F.expr("substring(value, 2)")))
        .when(F.col("damage") == 2, F.expr("substring(value, 1, length(value) - 1)"))
        .otherwise(F.col("value")),
    ).drop("damage")
    return bad_frames(raw, contract, "json").groupBy("topic", "dlq_reason").agg(
        rows().alias("message_count"))


def versioned_messages(lake: Lake) -> tuple[DataFrame, Contract]:
    """Transactions as a long-lived topic holds them: three in ten by an earlier schema with other names, an amount as text
    and fewer columns, one by a schema that nobody knows, one by the earlier schema with an amount that is no number."""
    newest = CONTRACTS["transactions"]
    earlier = Version(
        11, struct(tx_id=StringType, account=StringType, amount=StringType, location=StringType, timestamp=LongType),
        renamed=(("transaction_id", "tx_id"), ("account_id", "account")), defaults=(("currency", "EUR"),))
    amount = F.when(F.col("timestamp") % 10 == 7, "n/a").otherwise(F.col("amount").cast("string"))
    old_body = F.to_json(F.struct(
        F.col("transaction_id").alias("tx_id"), F.col("account_id").alias("account"), amount.alias("amount"),
        "location", "timestamp"))
    new_body = F.to_json(F.struct(*newest.schema.names))
    kind = F.col("timestamp") % 10
    value = (F.when(kind.isin(3, 4, 5, 7), to_frame(old_body, earlier.schema_id))
             .when(kind == 6, to_frame(new_body, 99)).otherwise(to_frame(new_body, newest.schema_id)))
    return lake.decoded.transactions.select(value.alias("value"), "kafka_timestamp"), replace(newest, versions=(earlier,))


@query
def schema_versions(lake: Lake) -> DataFrame:
    """Messages of two schemas of one topic, each decoded by the schema it names."""
    return decode_feed(*versioned_messages(lake), "json")


@query
def schema_version_audit(lake: Lake) -> DataFrame:
    """What of them goes to the dead letters."""
    return bad_frames(*versioned_messages(lake), "json").groupBy("topic", "schema_id", "dlq_reason").agg(
        rows().alias("message_count"))


@query
def risk_scores(lake: Lake) -> DataFrame:
    return lake.layers().transactions.select(
        "transaction_id", "account_id", "amount", "location", "is_international",
        "risk_score", "is_high_risk")


@query
def risk_score_dist(lake: Lake) -> DataFrame:
    return lake.layers().transactions.groupBy("risk_score", "is_high_risk").agg(
        rows().alias("tx_count"), F.sum("amount").alias("total_amount"))


@query
def lag_metrics(lake: Lake) -> DataFrame:
    return lake.layers().transactions.select(
        "transaction_id", "event_time", "kafka_timestamp", "spark_proc_time",
        "source_to_kafka_lag_sec", "kafka_to_spark_lag_sec", "total_latency_sec", "on_time")


@query
def on_time_tx(lake: Lake) -> DataFrame:
    on_time, _ = split_late(lake.feeds.transactions, "10 minutes", "proc_time")
    return on_time.select("transaction_id", "account_id", "event_time", "total_latency_sec")


@query
def late_tx(lake: Lake) -> DataFrame:
    _, late = split_late(lake.feeds.transactions, "10 minutes", "proc_time")
    return late.select("transaction_id", "account_id", "amount", "total_latency_sec", "event_time",
                       "dlq_reason")


@query
def late_login(lake: Lake) -> DataFrame:
    return Layers.late(lake.layers().logins).select(
        "login_id", "account_id", "total_latency_sec", "event_time", "dlq_reason")


@query
def late_activity(lake: Lake) -> DataFrame:
    return Layers.late(lake.layers().activity).select(
        "account_id", "activity_type", "total_latency_sec", "event_time", "dlq_reason")


# --- correlation ---------------------------------------------------------------------------------
@query
def login_then_tx(lake: Lake) -> DataFrame:
    return lake.layers().login_alerts


@query
def activity_then_tx(lake: Lake) -> DataFrame:
    return lake.layers().activity_alerts


@query
def login_then_tx_hot_accounts(lake: Lake) -> DataFrame:
    """The same join with the heavy accounts measured first and joined in parts."""
    hot = hot_keys(lake.feeds.transactions, "account_id", Settings("").hot_share)
    return lake.layers(tuple(hot)).login_alerts


@query
def alerts_all(lake: Lake) -> DataFrame:
    return lake.alerts


@query
def unified_rows(lake: Lake) -> DataFrame:
    """The whole tagged union of nine branches."""
    return unify(lake.layers())


@query
def route_counts(lake: Lake) -> DataFrame:
    return routes.route_counts(unify(lake.layers()))


# --- reports and gold ----------------------------------------------------------------------------
@query
def ingest_lag_by_hour(lake: Lake) -> DataFrame:
    return reports.ingest_lag_by_hour(lake.silver)


@query
def fraud_heatmap(lake: Lake) -> DataFrame:
    return reports.fraud_heatmap(lake.alerts, DAY)


@query
def dlq_audit(lake: Lake) -> DataFrame:
    return reports.dlq_audit(add_dt_hr(Layers.late(lake.layers().transactions)))


@query
def top_risk_accounts(lake: Lake) -> DataFrame:
    return reports.top_risk_accounts(lake.alerts, DAY)


@query
def top5_risk_accounts(lake: Lake) -> DataFrame:
    return reports.top_risk_accounts(lake.alerts, DAY, limit=5)


@query
def gold_location_risk(lake: Lake) -> DataFrame:
    return location_risk(lake.alerts, DAY)


@query
def gold_daily_kpi(lake: Lake) -> DataFrame:
    return daily_kpi(lake.silver, DAY)


@query
def gold_daily_kpi_flag(lake: Lake) -> DataFrame:
    return daily_kpi_by_flag(lake.silver, DAY)


# --- lake: writes, tables, compaction --------------------------------------------------------------
@query
def layer_roundtrip(lake: Lake) -> DataFrame:
    """Late transactions written as a partitioned layer and scanned back."""
    lake.write("LATE_TX", add_dt_hr(Layers.late(lake.layers().transactions)))
    return lake.read("LATE_TX").select(
        "transaction_id", "account_id", "amount", "total_latency_sec", "event_time", "dt", "hr")


@query
def compacted_hour(lake: Lake) -> DataFrame:
    bronze = lake.silver.drop("risk_score", "is_high_risk")
    lake.write_in_batches("BRONZE_TX", bronze)
    compact(lake.spark, lake.settings, DAY, HOUR)
    return lake.read("SILVER_TX", DAY, HOUR).select(
        "transaction_id", "account_id", "amount", "event_time", "risk_score", "is_high_risk",
        "dt", "hr", "batch_id")


@query
def compacted_day(lake: Lake) -> DataFrame:
    """A day of alerts compacted into itself."""
    lake.write_in_batches("ALERT", lake.alerts)
    compact_in_place(lake.spark, lake.settings, "ALERT", DAY)
    leaves_left = F.size(F.collect_set("batch_id").over(Window.partitionBy("dt", "hr"))).alias("leaves")
    return lake.read("ALERT", DAY).select(
        "account_id", "event_time", "transaction_id", "alert_type", "login_id", "risk_score",
        "dt", "hr", F.col("batch_id").startswith(COMPACTED).alias("compacted"), leaves_left)


@query
def folded_hours(lake: Lake) -> DataFrame:
    """A day of alerts in versioned hours: folded in two rounds, with new leaves between them, and what was folded deleted."""
    table, halves = "silver_fraud_alerts", F.pmod(F.xxhash64("transaction_id", "alert_type"), F.lit(2))
    for half in (0, 1):
        lake.write_in_batches("ALERT", lake.alerts.where(halves == half), batches=3, prefix=f"round-{half}")
        fold_day(lake.spark, lake.settings, table, DAY)
        drop_folded(lake.spark, lake.settings, table, DAY, keep_seconds=0)
    left = len(leaves(lake.spark, lake.settings.layer(ROUTES["ALERT"].layer), DAY))
    return lake.spark.table(hours_table(lake.settings, table)).where(F.col("dt") == F.to_date(F.lit(DAY))).select(
        "account_id", "event_time", "transaction_id", "alert_type", "login_id", "risk_score", "dt", "hr", F.lit(left).alias("leaves_left"))


@query
def repaired_alerts(lake: Lake) -> DataFrame:
    """A day's alerts of which a third was never raised and a part lies in versioned hours, repaired twice."""
    lake.write("SILVER_TX", lake.silver)
    lake.write("BRONZE_LOGIN", add_dt_hr(Layers.on_time(lake.layers().logins)))
    lake.write("BRONZE_ACTIVITY", add_dt_hr(Layers.on_time(lake.layers().activity)))
    raised = lake.alerts.where(F.unix_millis("event_time") % 3 != 0)
    early = F.col("hr") < HOUR
    lake.write("ALERT", raised.where(early), "early")
    fold_day(lake.spark, lake.settings, "silver_fraud_alerts", DAY)
    drop_folded(lake.spark, lake.settings, "silver_fraud_alerts", DAY, keep_seconds=0)
    lake.write("ALERT", raised.where(~early), "live")
    repair_alerts(lake.spark, lake.settings, DAY)
    left = missing_alerts(lake.spark, lake.settings, DAY).count()
    names = ("account_id", "event_time", "transaction_id", "alert_type", "login_id", "old_value", "risk_score", "dt", "hr")
    folded = lake.spark.table(hours_table(lake.settings, "silver_fraud_alerts")).where(F.col("dt") == F.to_date(F.lit(DAY)))
    return lake.read("ALERT", DAY).select(*names, F.col("batch_id").startswith(REPAIR).alias("repaired")).union(
        folded.select(*names, F.lit(False))).withColumn("still_missing", F.lit(left).cast("int"))


@query
def partition_inventory(lake: Lake) -> DataFrame:
    lake.write("BRONZE_TX", lake.silver.drop("risk_score", "is_high_risk"))
    return inventory(lake.read("BRONZE_TX")).select("dt", "hr", "row_count")


@query
def synced_table_counts(lake: Lake) -> DataFrame:
    """External table over written folders: no partitions before the sync, all of them after."""
    lake.write("LATE_TX", add_dt_hr(Layers.late(lake.layers().transactions)))
    create_tables(lake.spark, lake.settings)
    table = lake.settings.table("dlq_transactions")
    before = lake.spark.table(table).count()
    sync_partitions(lake.spark, lake.settings, "dlq_transactions")
    return lake.spark.table(table).groupBy("dt", "hr").agg(
        rows().alias("late_count"), F.lit(before).cast("bigint").alias("count_before_sync"))


def _hourly(lake: Lake) -> Lake:
    # The hour's bronze in the leaves a stream would leave, alerts of the whole history beside it.
    bronze = lake.silver.drop("risk_score", "is_high_risk")
    lake.write_in_batches("BRONZE_TX", bronze)
    lake.write("SILVER_TX", lake.silver)
    lake.write("ALERT", lake.alerts)
    if not run_hour(lake.spark, lake.settings, DAY, HOUR):
        raise RuntimeError(f"no transactions in hour {HOUR} of {DAY}")
    return lake


@query
def hourly_gold_location(lake: Lake) -> DataFrame:
    return lake.spark.table(_hourly(lake).settings.table("gold_location_risk"))


@query
def hourly_gold_kpi(lake: Lake) -> DataFrame:
    return lake.spark.table(_hourly(lake).settings.table("gold_daily_kpi_report"))


# --- keyed serving -------------------------------------------------------------------------------
@query
def alerts_serving(lake: Lake) -> DataFrame:
    # Doubles print differently from engine to engine: compare the number.
    return serving_alerts(lake.layers().alerts, "amount").drop("tx_amount")


@query
def high_risk_serving(lake: Lake) -> DataFrame:
    scored = lake.layers().silver
    return serving_high_risk(scored, "transaction_id", "amount").drop("tx_amount", "tx_proc_ts")


@query
def serving_table(lake: Lake) -> DataFrame:
    """A day of alerts loaded into the serving table."""
    lake.write("ALERT", lake.alerts)
    lake.write("SILVER_TX", lake.silver)
    create_tables(lake.spark, lake.settings)
    sync_partitions(lake.spark, lake.settings, "silver_fraud_alerts", "silver_transactions")
    load_serving(lake.spark, lake.settings, DAY)
    return lake.spark.table(lake.settings.table("serving_alerts")).drop("tx_amount")


@query
def serving_cells(lake: Lake) -> DataFrame:
    """The text cells of a day in both serving tables, read back as the number and the time that they write."""
    lake.write("ALERT", lake.alerts)
    lake.write("SILVER_TX", lake.silver)
    create_tables(lake.spark, lake.settings)
    sync_partitions(lake.spark, lake.settings, "silver_fraud_alerts", "silver_transactions")
    load_serving(lake.spark, lake.settings, DAY)
    amount = "CAST(tx_amount AS DOUBLE) AS amount"
    alerts, high_risk = (lake.spark.table(lake.settings.table(name)) for name in ("serving_alerts", "serving_high_risk"))
    return alerts.selectExpr("row_key", amount, "CAST(tx_risk AS INT) AS risk", "CAST(NULL AS TIMESTAMP) AS proc_ts").unionAll(
        high_risk.selectExpr("row_key", amount, "CAST(tx_risk_score AS INT) AS risk", "CAST(tx_proc_ts AS TIMESTAMP) AS proc_ts"))


def from_the_future(feeds: Feeds) -> Feeds:
    """A copy of each feed's first event that the alert rules look at, ten years later."""
    watched = ("amount >= 10000", "true", "activity_type = 'LIMIT_CHANGE'")
    ahead = F.col("timestamp") + 3650 * 86_400_000
    return Feeds(*(feed.where(rule).orderBy("timestamp").limit(1).withColumn("timestamp", ahead) for feed, rule in zip(feeds, watched)))


# --- streaming -----------------------------------------------------------------------------------
def _streamed(lake: Lake, *tags: str, hot: tuple[str, ...] = ()) -> Lake:
    replay(lake.spark, lake.settings, lake.decoded, slices=2, only=tags or tuple(ROUTES), hot=hot)
    return lake


@query
def stream_login_then_tx(lake: Lake) -> DataFrame:
    alerts = _streamed(lake, "ALERT").read("ALERT")
    return alerts.where("alert_type = 'LOGIN_THEN_TX'").select(*lake.layers().login_alerts.columns)


@query
def stream_activity_then_tx(lake: Lake) -> DataFrame:
    hot = hot_keys(lake.feeds.transactions, "account_id", Settings("").hot_share)
    alerts = _streamed(lake, "ALERT", hot=tuple(hot)).read("ALERT")
    return alerts.where("alert_type = 'ACTIVITY_THEN_TX'").select(
        *lake.layers().activity_alerts.columns)


@query
def stream_growing_hot_list(lake: Lake) -> DataFrame:
    """All alerts of a replay whose list of busy accounts is empty at first and measured again at each restart."""
    feeds = ("BRONZE_TX", "BRONZE_LOGIN", "BRONZE_ACTIVITY")
    replay(lake.spark, lake.settings, lake.decoded, slices=3, only=(*feeds, "ALERT"), grow_hot=True)
    return lake.read("ALERT").select(*lake.alerts.columns)


@query
def stream_route_counts(lake: Lake) -> DataFrame:
    """All routes through one query; counts of what landed in the lake."""
    _streamed(lake)
    landed = [
        lake.read(tag).select(F.lit(tag).alias("_type")) for tag in ROUTES if tag != "BAD_FRAME"
    ]
    union = landed[0]
    for frame in landed[1:]:
        union = union.union(frame)
    return routes.route_counts(union)


@query
def stream_future_event(lake: Lake) -> DataFrame:
    """All alerts of a replay whose first micro-batch holds an event of each feed dated ten years ahead."""
    stage_slice(from_the_future(lake.decoded), lake.settings.layer("_staging/topics"), 0, 2**62)
    return _streamed(lake, "ALERT").read("ALERT").select(*lake.alerts.columns)


@query
def stream_commit_records(lake: Lake) -> DataFrame:
    """Rows by route as the records of the finished micro-batches have them."""
    noted = records(_streamed(lake).spark, lake.settings).select(F.explode("hours").alias("h"))
    return noted.groupBy(F.col("h.tag").alias("_type")).agg(F.sum("h.row_count").alias("row_count"))


@query
def replay_null_times(lake: Lake) -> DataFrame:
    """A replay in which some transactions have no time: they land in the dead letters."""
    feeds = lake.decoded
    untimed = F.when(~F.col("transaction_id").endswith("7"), F.col("timestamp"))
    replay(lake.spark, lake.settings, feeds._replace(transactions=feeds.transactions.withColumn("timestamp", untimed)),
           slices=2, only=("BRONZE_TX", "LATE_TX"))
    return routes.route_counts(lake.read("BRONZE_TX").select(F.lit("BRONZE_TX").alias("_type")).union(
        lake.read("LATE_TX").select(F.lit("LATE_TX").alias("_type"))))


@query
def stream_dual_write(lake: Lake) -> DataFrame:
    """The single-feed job: every transaction, scored, in one layer."""
    settings = lake.settings
    topics = settings.layer("_staging/topics")
    for number, (first, after) in enumerate(time_slices(lake.decoded)):
        stage_slice(lake.decoded, topics, first, after, untimed=number == 0)
    raw = topic_streams(stream_session(lake.spark, settings), topics).transactions.drop("proc_time")
    start_dual_write(dual_write_stream(raw, settings, "json"), settings,
                     available_now=True).awaitTermination()
    route = ROUTES["SILVER_TX"]
    return read_hours(lake.spark, settings.layer("transactions"), route.stored).select(
        "transaction_id", "account_id", "amount", "risk_score", "is_high_risk", "event_time", "dt", "hr")
