import json
import os
from dataclasses import replace
from glob import glob

import pytest
from helpers import at, rows_of
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from riskstream.__main__ import arguments, main
from riskstream.operators.keyed import high_risk_cells, latest_by_key, put_rows, serving_alerts
from riskstream.functions.clock import add_dt_hr
from riskstream.functions.frames import to_frame
from riskstream.operators.interval_join import HotSpan
from riskstream.operators.routes import ROUTES, route_counts, tagged, union_aligned
from riskstream.plans.layers import unify
from riskstream.queries import Lake, from_the_future
from riskstream.schemas import struct
from riskstream.sources.events import Feeds
from riskstream.sources.feeds import CONTRACTS, Version
from riskstream.sources.files import stream_files
from riskstream.streaming.history import (
    REPLAYED, as_messages, replay, stage_slice, time_slices, topic_streams,
)
from riskstream.streaming import jobs
from riskstream.streaming.hot_accounts import grown_hot_accounts
from riskstream.streaming.jobs import (
    dual_write_stream, rows_dropped_by_watermark, start_dual_write, start_router, stream_session, unified_stream,
)

SF = "/root/testdata/sf0.001"


@pytest.fixture
def lake(spark):
    return Lake(spark, SF)


def landed(lake, tags=tuple(ROUTES)):
    counts = {}
    for tag in tags:
        if os.path.isdir(lake.settings.layer(ROUTES[tag].layer)):
            counts[tag] = lake.read(tag).count()
    return counts


def file_store(folder):
    """An upserting store as a folder of one file per put."""
    os.makedirs(folder, exist_ok=True)

    def open_store():
        import json
        import os
        import uuid

        class Store:
            def put(self, rows):
                with open(os.path.join(folder, uuid.uuid4().hex), "w") as out:
                    out.write("\n".join(json.dumps(row) for row in rows))

            def close(self):
                pass

        return Store()

    return open_store


def stored(folder):
    puts = [open(name).read().splitlines() for name in sorted(glob(f"{folder}/*"))]
    return [len(put) for put in puts], [json.loads(line) for put in puts for line in put]


def test_stream_equals_batch_over_restarts(lake, tmp_path):
    sizes = replay(lake.spark, lake.settings, lake.decoded, slices=3,
                   open_store=file_store(str(tmp_path / "store")))
    tx, log, act = (feed.count() for feed in lake.decoded)
    # Once for the layers and once per rule that reads the feed.
    assert sum(sizes) == 3 * tx + 2 * log + 2 * act and len([n for n in sizes if n]) == 3

    batch = dict(route_counts(unify(lake.layers())).collect())
    assert landed(lake) == batch
    columns = lake.alerts.columns
    assert rows_of(lake.read("ALERT"), *columns) == rows_of(lake.alerts, *columns)
    silver = [c for c in ROUTES["SILVER_TX"].stored.names if c != "batch_id"]
    assert rows_of(lake.read("SILVER_TX"), *silver) == rows_of(lake.silver, *silver)

    _, puts = stored(tmp_path / "store")
    served = serving_alerts(lake.layers().alerts)
    assert {r["row_key"]: r["al_type"] for r in puts} == {r.row_key: r.al_type for r in served.collect()}


def test_split_queries_and_hot_accounts_write_the_same(lake):
    topics = lake.settings.layer("_staging/topics")
    [(first, after)] = time_slices(lake.decoded)
    stage_slice(lake.decoded, topics, first, after)
    session = stream_session(lake.spark, lake.settings)
    plain = [tag for tag in ROUTES if tag != "ALERT"]
    for name, only in (("layers", plain), ("alerts", ["ALERT"])):
        unified = unified_stream(topic_streams(session, topics), lake.settings, "json", "proc_time",
                                 ["ACC-1000"], only)
        start_router(unified, lake.settings, name, available_now=True).awaitTermination()
    assert landed(lake) == dict(route_counts(unify(lake.layers())).collect())


def test_failed_batch_is_repeated_without_duplicates(lake, tmp_path):
    topics = lake.settings.layer("_staging/topics")
    [(first, after)] = time_slices(lake.decoded)
    stage_slice(lake.decoded, topics, first, after)
    session = stream_session(lake.spark, lake.settings)

    def start(open_store):
        unified = unified_stream(topic_streams(session, topics), lake.settings, "json", "proc_time")
        return start_router(unified, lake.settings, open_store=open_store, available_now=True)

    def broken():
        raise RuntimeError("store is down")

    with pytest.raises(Exception, match="store is down"):
        start(broken).awaitTermination()
    batch = dict(route_counts(unify(lake.layers())).collect())
    assert landed(lake) == batch  # the layers were written before the store failed
    start(file_store(str(tmp_path / "store"))).awaitTermination()
    assert landed(lake) == batch
    assert stored(tmp_path / "store")[1]


def test_new_checkpoint_never_overwrites_older_rows(spark, lake, tmp_path):
    """Batch numbers start at 0 again, but the leaves carry the id of the query."""
    session = stream_session(spark, lake.settings)
    feed = tagged(lake.silver, "SILVER_TX")
    source = str(tmp_path / "source")
    feed.write.parquet(source)
    for name in ("one", "two"):
        stream = stream_files(session, source, feed.schema)
        start_router(stream, lake.settings, name, available_now=True).awaitTermination()
    assert landed(lake) == {"SILVER_TX": 2 * lake.silver.count()}


def test_bad_frames_reach_the_dead_letters(lake):
    topics = lake.settings.layer("_staging/topics")
    [(first, after)] = time_slices(lake.decoded)
    stage_slice(lake.decoded, topics, first, after)
    junk = lake.spark.createDataFrame([(b"", at(), at()), (b"\x09" * 9, at(), at())], REPLAYED)
    junk.write.mode("append").parquet(f"{topics}/topic=logins")
    session = stream_session(lake.spark, lake.settings)
    unified = unified_stream(topic_streams(session, topics), lake.settings, "json", "proc_time",
                             only=["BAD_FRAME", "LATE_LOGIN"])
    start_router(unified, lake.settings, available_now=True).awaitTermination()
    assert rows_of(lake.read("BAD_FRAME"), "topic", "dlq_reason") == [
        ("logins", "frame without body"), ("logins", "unknown magic byte")]


def test_throttle_takes_one_file_at_a_time(lake, spark, tmp_path):
    session = stream_session(spark, lake.settings)
    source = str(tmp_path / "source")
    messages = as_messages(lake.decoded.logins, CONTRACTS["logins"]).select(*REPLAYED.names)
    for _ in range(3):
        messages.coalesce(1).write.mode("append").parquet(source)
    stream = stream_files(session, source, REPLAYED, 1)
    sizes = []
    query = stream.writeStream.foreachBatch(lambda df, n: sizes.append(df.count())).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sizes == [lake.decoded.logins.count()] * 3


def test_row_behind_the_watermark_is_counted_not_silently_lost(lake, spark, tmp_path):
    """An on-time row that comes after a future-dated one is dropped by the join; progress tells."""
    session = stream_session(spark, lake.settings)
    schema = "transaction_id string, account_id string, event_time timestamp, location string, amount double, risk_score int"
    log_schema = "login_id string, account_id string, event_time timestamp, location string, ip_address string, device_type string"
    tx_dir, log_dir = str(tmp_path / "tx"), str(tmp_path / "log")
    from riskstream.operators.alerts import login_then_tx

    def arrive(seconds):
        spark.createDataFrame([("t", "a", at(seconds), "Paris", 1.0, 0)], schema).coalesce(1).write.mode("append").parquet(tx_dir)
        spark.createDataFrame([("l", "a", at(seconds), "Rome", "i", "d")], log_schema).coalesce(1).write.mode("append").parquet(log_dir)

    dropped, found = 0, []
    for moment in (0, 36_000, 60):
        arrive(moment)
        from pyspark.sql.types import _parse_datatype_string
        alerts = login_then_tx(stream_files(session, tx_dir, _parse_datatype_string(schema)),
                               stream_files(session, log_dir, _parse_datatype_string(log_schema)),
                               watermark="10 minutes")
        query = alerts.writeStream.foreachBatch(lambda df, n: found.append(df.count())).option(
            "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
        dropped += rows_dropped_by_watermark(query)
    assert sum(found) == 2
    assert dropped == 3  # the transaction and both cell copies of the login


def test_state_is_bounded_by_the_watermark(lake):
    replay(lake.spark, lake.settings, lake.decoded, slices=2, only=["ALERT"])
    session = stream_session(lake.spark, lake.settings)
    topics = lake.settings.layer("_staging/topics")
    unified = unified_stream(topic_streams(session, topics), lake.settings, "json", "proc_time", only=["ALERT"])
    query = start_router(unified, lake.settings, available_now=True)
    query.awaitTermination()
    held = {}
    for side in ("left", "right"):
        state = lake.spark.read.format("statestore").option("joinSide", side).load(
            lake.settings.checkpoint("risk_layers"))
        held[side] = state.count()
    # 36 hours of rows went in; only those of about the last ten minutes are held.
    assert held["left"] < lake.decoded.transactions.count() / 20
    assert held["right"] < lake.decoded.logins.count() / 20


def test_dual_write(lake, spark, tmp_path):
    settings = lake.settings
    topics = settings.layer("_staging/topics")
    [(first, after)] = time_slices(lake.decoded)
    stage_slice(lake.decoded, topics, first, after)
    raw = topic_streams(stream_session(spark, settings), topics).transactions.drop("proc_time")
    start_dual_write(dual_write_stream(raw, settings, "json"), settings,
                     file_store(str(tmp_path / "store")), available_now=True).awaitTermination()
    rows = spark.read.parquet(settings.layer("transactions"))
    scored = lake.layers().transactions
    assert rows_of(rows, "transaction_id", "risk_score") == rows_of(scored, "transaction_id", "risk_score")
    sizes, puts = stored(tmp_path / "store")
    expected = latest_by_key(high_risk_cells(scored, "transaction_id"), F.desc("transaction_id"))
    assert {r["row_key"] for r in puts} == {r.row_key for r in expected.collect()}
    assert all(r["tx_is_high_risk"] == "true" and r["tx_proc_ts"] for r in puts)


def test_puts_come_in_batches_and_errors_are_raised(spark, tmp_path):
    rows = spark.range(450).select(F.col("id").cast("string").alias("row_key")).coalesce(1)
    put_rows(rows, file_store(str(tmp_path / "s")), 200)
    assert sorted(stored(tmp_path / "s")[0]) == [50, 200, 200]

    def refuse():
        raise OSError("refused")

    with pytest.raises(Exception, match="refused"):
        put_rows(rows, refuse)


def test_last_write_wins_per_key(spark):
    rows = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new"), ("j", 1, "only")], "row_key string, batch int, v string")
    assert rows_of(latest_by_key(rows, F.desc("batch")), "row_key", "v") == [("j", "only"), ("k", "new")]


def test_hot_accounts_come_and_go(lake, spark):
    assert grown_hot_accounts(spark, lake.settings) == []
    lake.write("BRONZE_TX", lake.silver)
    latest = lake.silver.agg(F.max(F.unix_micros("event_time"))).first()[0]
    one = HotSpan("ACC-1000", latest)           # one account holds it all
    assert grown_hot_accounts(spark, lake.settings) == [one] == grown_hot_accounts(spark, lake.settings)
    later = lake.silver.withColumn("event_time", F.col("event_time") + F.expr("INTERVAL '3' DAY")).drop("dt", "hr")
    other = union_aligned([add_dt_hr(later).withColumn("account_id", F.lit(x)) for x in ("p", "q")])
    lake.write("BRONZE_LOGIN", other.withColumn("login_id", F.lit("l")))
    settings = replace(lake.settings, hot_hours=1, watermark_delay="9 weeks")
    last = latest + 3 * 86_400_000_000
    assert grown_hot_accounts(spark, settings) == [one._replace(until=last), HotSpan("p", last), HotSpan("q", last)]
    # Rows of the first span can't come any more.
    assert grown_hot_accounts(spark, lake.settings, now=last + 3_600_000_000) == [HotSpan("p", last), HotSpan("q", last)]


def test_list_of_an_older_lake_is_in_force_from_the_beginning(lake, spark):
    spark.createDataFrame([("ACC-1000",)], "account_id string").coalesce(1).write.json(lake.settings.checkpoint("hot_accounts"))
    assert [span.key for span in grown_hot_accounts(spark, lake.settings)] == ["ACC-1000"]


def test_state_of_an_account_spreads_once_it_is_listed(lake, spark):
    """The list grows between two restarts: older state is found, newer rows lie in several tasks."""
    settings = replace(lake.settings, watermark_delay="9 weeks")        # all state is kept
    replay(spark, settings, lake.decoded, slices=3, only=("BRONZE_TX", "BRONZE_LOGIN", "BRONZE_ACTIVITY", "ALERT"), grow_hot=True)
    columns = lake.alerts.columns
    assert rows_of(lake.read("ALERT"), *columns) == rows_of(lake.alerts, *columns)
    [span] = grown_hot_accounts(spark, settings)
    state = stream_session(spark, settings).read.format("statestore").option("joinSide", "left").option("operatorId", 0).load(
        settings.checkpoint("risk_layers")).select("partition_id", "value.*")
    cells = state.where(F.col("account_id") == span.key).groupBy("_cell").agg(
        F.count("*").alias("n"), F.countDistinct("_part").alias("parts"), F.max("_part").alias("last"))
    first = min(span.cells(width)[0] for width in (60_000_000, 300_000_000))
    assert cells.where((F.col("_cell") < first) & (F.col("last") > 0)).isEmpty()
    assert cells.where((F.col("_cell") >= first) & (F.col("parts") > 1)).count() > 0


def test_an_event_from_the_future_costs_no_alert(lake, spark):
    feeds = lake.decoded
    future = from_the_future(feeds)
    columns = ("transaction_id", "login_id", "alert_type")
    lost = Lake(spark, SF)
    for where, settings in ((lake, lake.settings), (lost, replace(lost.settings, future_allowance=None))):
        stage_slice(future, settings.layer("_staging/topics"), 0, 2**62)
        replay(spark, settings, feeds, slices=2, only=("ALERT", "LATE_LOGIN"))
    assert rows_of(lake.read("ALERT"), *columns) == rows_of(lake.alerts, *columns)
    assert rows_of(lake.read("LATE_LOGIN").where("dlq_reason = 'from the future'"), "login_id") == rows_of(future.logins, "login_id")
    # Without the bound the watermark runs away and the second slice misses the joins.
    assert lost.read("ALERT").count() < lake.alerts.count()


def test_callers_session_is_left_alone(spark, lake):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    session = stream_session(spark, lake.settings)
    assert "RocksDB" in session.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_latest_batch_wins_over_rule_order(spark):
    alerts = spark.createDataFrame(
        [("ACC-1", at(0), "TX-1", "ACTIVITY_THEN_TX", at(10)), ("ACC-1", at(0), "TX-1", "LOGIN_THEN_TX", at(20)),
         ("ACC-2", at(0), "TX-2", "LOGIN_THEN_TX", at(20)), ("ACC-2", at(0), "TX-2", "ACTIVITY_THEN_TX", at(20)),
         ("ACC-3", at(0), "TX-3", "LOGIN_THEN_TX", None), ("ACC-3", at(0), "TX-3", "ACTIVITY_THEN_TX", None)],
        "account_id string, event_time timestamp, transaction_id string, alert_type string, emitted_at timestamp",
    ).withColumns({"reason": F.lit("r"), "amount": F.lit(1.5), "risk_score": F.lit(30)})
    assert rows_of(serving_alerts(alerts), "tx_id", "al_type", "tx_amount", "tx_risk") == [
        ("TX-1", "LOGIN_THEN_TX", "1.5", "30"), ("TX-2", "ACTIVITY_THEN_TX", "1.5", "30"),
        ("TX-3", "ACTIVITY_THEN_TX", "1.5", "30")]


@pytest.mark.parametrize("split", [True, False])
def test_jobs_run_until_stopped(lake, spark, monkeypatch, split):
    """The job entry points, with staged files in place of the topics."""
    settings = replace(lake.settings, trigger_interval="1 second")
    topics = settings.layer("_staging/topics")
    # The wall clock makes all history late, so everything must land in the dead letters.
    feeds = Feeds(*(feed.limit(50) for feed in lake.decoded))
    stage_slice(feeds, topics, 0, 2**60)
    monkeypatch.setattr(jobs, "kafka_topics", lambda session, _: Feeds(
        *(raw.drop("proc_time") for raw in topic_streams(session, topics))))
    queries = jobs.run_stream(spark, settings, "json", split=split)
    try:
        assert len(queries) == (2 if split else 1)
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    assert landed(lake) == {"LATE_TX": 50, "LATE_LOGIN": 50, "LATE_ACTIVITY": 50}


def test_single_topic_job_runs_until_stopped(lake, spark, monkeypatch):
    settings = replace(lake.settings, trigger_interval="1 second")
    topics = settings.layer("_staging/topics")
    stage_slice(lake.decoded, topics, 0, 2**60)
    monkeypatch.setattr(jobs, "read_kafka", lambda session, *a, **k: topic_streams(session, topics).transactions.drop("proc_time"))
    [query] = jobs.run_dual_write_stream(spark, settings, "json")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(settings.layer("transactions")).count() == lake.decoded.transactions.count()


def test_command_line(lake, spark):
    root = lake.settings.root
    lake.write("BRONZE_TX", lake.silver.drop("risk_score", "is_high_risk"))
    lake.write("ALERT", lake.alerts)
    run = lambda *argv: main(spark, arguments(["--root", root, "--database", lake.settings.database, *argv]))
    assert run("hour", "2024-01-01", "7") == 0
    assert run("hour", "2023-01-01", "7") == 1
    assert run("compact", "2024-01-01", "8") == 0
    assert run("compact", "2024-01-01", "8", "--in-place", "ALERT") == 0
    assert run("compact", "2024-01-01", "--in-place", "ALERT") == 0
    assert run("serving", "2024-01-01") == 0
    assert spark.table(lake.settings.table("serving_alerts")).count() > 0
    assert run("tables") == 0
    tables = spark.table(lake.settings.table("silver_transactions"))
    assert {r.hr for r in tables.select("hr").distinct().collect()} == {7, 8}
    assert arguments(["--root", "r", "dual-write", "--bootstrap", "b:1"]).trigger == "10 seconds"


def test_streams_take_contracts_with_versions(lake, tmp_path):
    earlier = Version(77, struct(id=StringType, account_id=StringType, timestamp=LongType), renamed=(("login_id", "id"),))
    contracts = {**CONTRACTS, "logins": replace(CONTRACTS["logins"], versions=(earlier,))}
    def messages(number):
        body = F.to_json(F.struct(F.col("login_id").alias("id"), "account_id", "timestamp"))
        return lake.decoded.logins.select(to_frame(body, number).alias("value"), "kafka_timestamp", "proc_time")
    no_messages = messages(77).limit(0)
    raw = Feeds(no_messages, messages(77).union(messages(78)), no_messages)
    unified = unified_stream(raw, lake.settings, "json", "proc_time", contracts=contracts)
    n = lake.decoded.logins.count()
    found = {(r._type, r.dlq_reason if r._type == "BAD_FRAME" else None): r["count"]
             for r in unified.groupBy("_type", "dlq_reason").count().collect()}
    assert found.pop(("BAD_FRAME", "unknown schema id")) == n
    assert set(found) <= {("BRONZE_LOGIN", None), ("LATE_LOGIN", None)} and sum(found.values()) == n
