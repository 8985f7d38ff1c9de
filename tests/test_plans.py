"""The plans Catalyst makes of the queries."""

from datetime import datetime, timezone

import pytest
from helpers import at, logins, scored_tx

from riskstream.operators.alerts import login_then_tx
from riskstream.operators.keyed import alert_cells, latest_by_key
from riskstream.queries import REGISTRY, Lake
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
START_OF_DAY = datetime(2024, 1, 1, tzinfo=timezone.utc)


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


STREAMED = [n for n in REGISTRY if n.startswith("stream_")]
WRITING = ["layer_roundtrip", "compacted_hour", "compacted_day", "partition_inventory",
           "synced_table_counts", "hourly_gold_location", "hourly_gold_kpi", "serving_table"]


@pytest.mark.parametrize("name", [n for n in REGISTRY if n not in STREAMED + WRITING])
def test_no_query_multiplies_rows_or_leaves_the_jvm(spark, name):
    text = plan(REGISTRY[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition"):
        if bad == "SinglePartition" and name in ("gold_daily_kpi", "gold_daily_kpi_flag"):
            continue  # a global aggregate: one row of partial sums per task
        assert bad not in text, text


def test_event_type_filter_and_columns_reach_the_scan(spark):
    text = plan(REGISTRY["login_then_tx"](spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in text
    assert "In(event_type, [error,purchase,view])" in text
    kpi = plan(REGISTRY["ingest_lag_by_hour"](spark, SF))
    assert "user_id" not in kpi and "value" not in kpi


def test_join_shuffles_on_account_and_cell(spark, no_broadcast):
    text = plan(REGISTRY["login_then_tx"](spark, SF))
    assert "SortMergeJoin" in text
    exchanges = [line for line in text.splitlines() if "hashpartitioning(" in line]
    assert len(exchanges) == 2 and all("_cell" in line and "account_id" in line for line in exchanges)


def test_activity_conditions_are_filtered_before_the_shuffle(spark, no_broadcast):
    text = plan(REGISTRY["activity_then_tx"](spark, SF))
    join = next(line for line in text.splitlines() if line.startswith("Join condition"))
    assert "activity_type" not in join and "10000" not in join


def test_kpi_reads_one_day_of_silver(spark):
    lake = Lake(spark, SF)
    lake.write("SILVER_TX", lake.silver)
    from riskstream.plans.gold import daily_kpi
    text = plan(daily_kpi(lake.read("SILVER_TX"), "2024-01-02"))
    assert "(dt#" in text.split("PartitionFilters:")[1].splitlines()[0]
    assert "ReadSchema: struct<amount:double,risk_score:int>" in text


def test_serving_drops_losers_before_the_shuffle(spark):
    tx = scored_tx(spark, [("t", "a", at(5), "Paris", 1.0)])
    alerts = login_then_tx(tx, logins(spark, [("l", "a", at(0), "Rome")]))
    text = plan(latest_by_key(alert_cells(alerts, "alert_type"), F.asc("alert_type")))
    assert text.count("WindowGroupLimit") >= 2


def test_top_k_is_a_bounded_sort(spark):
    assert "TakeOrderedAndProject" in plan(REGISTRY["top5_risk_accounts"](spark, SF))


def test_hot_list_becomes_a_literal_set(spark, no_broadcast):
    text = plan(REGISTRY["login_then_tx_hot_accounts"](spark, SF))
    exchanges = [line for line in text.splitlines() if "hashpartitioning(" in line]
    assert all("_part" in line for line in exchanges) and len(exchanges) == 2


def test_burst_in_one_cell_is_split_at_run_time(spark, no_broadcast, tmp_path):
    """A third of all rows in one account and minute: adaptive skew handling cuts the partition."""
    n = 60_000
    rows = spark.range(n).select(
        F.sha2(F.col("id").cast("string"), 512).alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), F.col("id") % 5000)).alias("account_id"),
        F.when(F.col("id") % 3 == 0, F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 60))
        .otherwise(F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 90_000)).alias("event_time"),
        F.lit("Paris").alias("location"), F.lit(1.0).alias("amount"), F.lit(50).alias("risk_score"),
    )
    rows.repartition(8).write.parquet(str(tmp_path / "tx"))
    tx = spark.read.parquet(str(tmp_path / "tx"))
    log = logins(spark, [("l", "hot", at(0, START_OF_DAY), "Rome"), ("m", "hot", at(30, START_OF_DAY), "Oslo")])
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        alerts = login_then_tx(tx, log)
        found = alerts.groupBy("login_id").agg(F.count("*"), F.max("transaction_id"))
        counts = {row[0]: row[1] for row in found.collect()}
        text = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert "skew=true" in text
    hot = tx.where("account_id = 'hot'")
    assert counts == {"l": hot.count(), "m": hot.where("second(event_time) >= 30").count()}


def test_a_message_body_is_parsed_once(spark):
    text = REGISTRY["frame_decode"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json(") == 1


def test_batch_writes_are_rebalanced_by_hour(spark):
    lake = Lake(spark, SF)
    text = plan(lake.silver.hint("rebalance", F.col("dt"), F.col("hr")))
    assert "REBALANCE_PARTITIONS_BY_COL" in text
