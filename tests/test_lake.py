import os
import subprocess
import sys
from datetime import datetime, timezone
from glob import glob

import pytest
from helpers import at, millis, rows_of
from pyspark.sql import functions as F

from riskstream import schemas
from riskstream.functions.clock import add_dt_hr
from riskstream.operators.keyed import serving_alerts
from riskstream.operators.routes import ROUTES, route_counts, union_aligned
from riskstream.operators.sinks import write_layer, write_micro_batch
from riskstream.plans import compaction
from riskstream.plans.compaction import compact, compact_in_place, inventory
from riskstream.plans.gold import daily_kpi, daily_kpi_by_flag, load_gold, location_risk, overwrite_day
from riskstream.plans.hourly import hour_ready, run_hour
from riskstream.plans.layers import Layers, unify
from riskstream.plans.reports import (
    dlq_audit, fraud_heatmap, ingest_lag_by_hour, top_risk_accounts,
)
from riskstream.plans.serving import load_serving, serving_high_risk
from riskstream.plans.tables import LAYER_TABLES, create_tables, sync_day, sync_partitions
from riskstream.queries import DAY, HOUR, Lake
from riskstream.settings import Settings
from riskstream.sources.files import read_hours

SF = "/root/testdata/sf0.001"
SILVER = ROUTES["SILVER_TX"]
AFTERWARDS = datetime(2025, 1, 1, tzinfo=timezone.utc)


@pytest.fixture
def lake(spark):
    return Lake(spark, SF)


def bronze_of(lake):
    return lake.silver.drop("risk_score", "is_high_risk")


def files(folder):
    return sorted(glob(f"{folder}/**/*.parquet", recursive=True))


# --- union and routes ----------------------------------------------------------------------------
def test_union_pads_sorts_and_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "n int, b string")
    b = spark.createDataFrame([(2, 0.5)], "n int, a double")
    union = union_aligned([a, b])
    assert union.columns == ["a", "b", "n"]
    assert rows_of(union) == sorted([(None, "x", 1), (None, "x", 1), (0.5, None, 2)], key=repr)


def test_routes_partition_every_feed(lake):
    layers = lake.layers()
    counts = dict(route_counts(unify(layers)).collect())
    assert counts["BRONZE_TX"] == counts["SILVER_TX"]
    for feed, on_time, late in (("transactions", "BRONZE_TX", "LATE_TX"), ("logins", "BRONZE_LOGIN", "LATE_LOGIN"),
                                ("activity", "BRONZE_ACTIVITY", "LATE_ACTIVITY")):
        assert counts[on_time] + counts[late] == getattr(layers, feed).count()
    assert counts["ALERT"] == layers.alerts.count()


def test_unified_row_has_every_column_once(lake):
    unified = unify(lake.layers())
    expected = {f.name for tag, route in ROUTES.items() if tag != "BAD_FRAME" for f in route.schema.fields}
    assert set(unified.columns) == expected - {"emitted_at"} | {"dt", "hr", "_type"}


def test_leaving_routes_out_leaves_out_their_rows(lake):
    counts = dict(route_counts(unify(lake.layers(), only=["ALERT", "LATE_TX"])).collect())
    assert set(counts) == {"ALERT", "LATE_TX"}


# --- reports -------------------------------------------------------------------------------------
def alerts_frame(spark, rows):
    return spark.createDataFrame(rows, "account_id string, tx_location string, amount double, "
                                       "risk_score int, hr int").withColumn("dt", F.to_date(F.lit(DAY)))


def test_heatmap_has_a_group_for_alerts_without_place(spark):
    alerts = alerts_frame(spark, [("a", None, 1.0, 0, 1), ("a", "Paris", 2.0, 0, 1), ("b", "Paris", 4.0, 0, 1)])
    assert [tuple(r) for r in fraud_heatmap(alerts, DAY).collect()] == [("Paris", 2, 6.0), (None, 1, 1.0)]
    assert fraud_heatmap(alerts, "2030-01-01").isEmpty()
    assert fraud_heatmap(alerts.withColumn("dt", F.current_date())).count() == 2


def test_top_accounts(spark):
    alerts = alerts_frame(spark, [("a", "x", 1.0, i, i) for i in range(3)] + [("b", "x", 1.0, 7, 1)] * 2
                          + [("c", "x", 1.0, 9, 2)] * 5 + [("0", "x", 1.0, 1, 3)] * 3)
    ranked = [tuple(r) for r in top_risk_accounts(alerts, DAY).collect()]
    assert ranked == [("c", 5, 9), ("0", 3, 1), ("a", 3, 2)]
    assert [r.account_id for r in top_risk_accounts(alerts, DAY, limit=1).collect()] == ["c"]
    assert [r.account_id for r in top_risk_accounts(alerts, DAY, more_than=0, hours=(0, 1)).collect()] == ["a", "b"]


def test_lag_and_dead_letter_reports(spark):
    df = spark.createDataFrame(
        [("2024-01-02", 7, 10, 1, 5.0), ("2024-01-02", 7, 20, 2, 5.0), ("2024-01-01", 9, 1, 1, 5.0)],
        "dt string, hr int, source_to_kafka_lag_sec long, kafka_to_spark_lag_sec long, amount double")
    assert [tuple(r) for r in ingest_lag_by_hour(df).collect()] == [
        ("2024-01-02", 7, 15.0, 1.5), ("2024-01-01", 9, 1.0, 1.0)]
    assert rows_of(dlq_audit(df), "dt", "late_count", "lost_realtime_visibility_amount") == [
        ("2024-01-01", 1, 5.0), ("2024-01-02", 2, 10.0)]


def test_kpi_of_a_day_without_rows(lake):
    for kpi in (daily_kpi(lake.silver, "2030-01-01"), daily_kpi_by_flag(lake.silver, "2030-01-01")):
        assert [tuple(r) for r in kpi.collect()] == [(0, None, None, None)]
    assert location_risk(lake.alerts, "2030-01-01").isEmpty()


def test_both_kpi_forms_agree(lake):
    assert daily_kpi(lake.silver, DAY).collect() == daily_kpi_by_flag(lake.silver, DAY).collect()
    row = daily_kpi(lake.silver, DAY).first()  # the published day of FIXTURES.md
    assert (row.total_transactions, row.total_alerts, row.high_risk_volume) == (409, 77, 832524.0)


# --- writes --------------------------------------------------------------------------------------
def test_hours_are_written_without_leading_zero(lake, tmp_path):
    write_layer(lake.silver, str(tmp_path), SILVER, "b")
    assert any("/hr=7/" in f for f in files(tmp_path)) and not any("/hr=07/" in f for f in files(tmp_path))


def test_repeated_write_replaces_its_own_leaf_only(lake, spark, tmp_path):
    path = str(tmp_path)
    for leaf in ("first", "second", "first", "first"):
        write_layer(lake.silver, path, SILVER, leaf)
    back = read_hours(spark, path, SILVER.stored)
    n = lake.silver.count()
    assert dict(back.groupBy("batch_id").count().collect()) == {"first": n, "second": n}


def test_stored_columns_follow_the_contract(lake, spark, tmp_path):
    write_layer(lake.alerts, str(tmp_path), ROUTES["ALERT"], "b")
    stored = spark.read.parquet(files(tmp_path)[0])
    assert stored.columns == schemas.ALERT.names


def hour_of(spark, n):
    df = spark.range(n).select(
        F.concat(F.lit("TX-"), "id").alias("transaction_id"), (F.lit(millis(at())) + F.col("id") % 60000).alias("timestamp"))
    return add_dt_hr(df.withColumn("event_time", F.timestamp_millis("timestamp")))


def test_micro_batch_of_one_hour_becomes_several_even_files(spark, tmp_path):
    batch = hour_of(spark, 10_000).persist()
    write_micro_batch(batch, str(tmp_path), SILVER, "q-0", 10_000, 2_500)
    sizes = [spark.read.parquet(f).count() for f in files(tmp_path)]
    assert len(sizes) == 4 and sum(sizes) == 10_000 and max(sizes) < 4_000
    write_micro_batch(batch, str(tmp_path), SILVER, "q-0", 10_000, 100_000)
    assert len(files(tmp_path)) == 1
    assert read_hours(spark, str(tmp_path), SILVER.stored).count() == 10_000


def test_rows_without_event_time_keep_a_partition(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "account_id string").withColumns(
        {"event_time": F.lit(None).cast("timestamp"), "dlq_reason": F.lit("no event time")})
    write_layer(add_dt_hr(df), str(tmp_path), ROUTES["LATE_LOGIN"], "b")
    row = read_hours(spark, str(tmp_path), ROUTES["LATE_LOGIN"].stored).first()
    assert (row.account_id, row.dt, row.hr) == ("a", None, None)


# --- scans, compaction, tables --------------------------------------------------------------------
def test_hour_scan_keeps_partition_columns(lake):
    lake.write("SILVER_TX", lake.silver)
    hour = lake.read("SILVER_TX", DAY, HOUR)
    assert {"dt", "hr", "batch_id"} <= set(hour.columns)
    assert hour.count() == lake.silver.where(f"dt = DATE'{DAY}' AND hr = {HOUR}").count() > 0


def test_inventory_counts_rows_files_and_bytes(lake):
    lake.write_in_batches("BRONZE_TX", bronze_of(lake))
    rows = inventory(lake.read("BRONZE_TX")).collect()
    assert sum(r.row_count for r in rows) == lake.silver.count()
    folder = lake.settings.layer("bronze/transactions")
    assert sum(r.file_count for r in rows) == len(files(folder))
    assert all(r.byte_count > 0 for r in rows)


def test_compaction_scores_and_leaves_other_hours_alone(lake, spark):
    lake.write_in_batches("BRONZE_TX", bronze_of(lake))
    lake.write("SILVER_TX", lake.silver, "streamed")
    columns = [c for c in SILVER.stored.names if c != "batch_id"]
    before = rows_of(lake.read("SILVER_TX"), *columns)
    for _ in range(2):
        compact(spark, lake.settings, DAY, HOUR)
        silver = lake.read("SILVER_TX")
        assert rows_of(silver, *columns) == before
        leaves = {(r.hr, r.batch_id) for r in silver.where(f"dt = DATE'{DAY}'").select("hr", "batch_id").collect()}
        assert (HOUR, "compacted") in leaves and (HOUR, "streamed") not in leaves
        assert (HOUR + 1, "streamed") in leaves
    assert len(files(lake.settings.layer(f"silver/transactions/dt={DAY}/hr={HOUR}"))) == 1


def test_compaction_sizes_files_by_bytes(lake, spark):
    lake.write_in_batches("BRONZE_TX", bronze_of(lake))
    many = Settings(lake.settings.root, file_bytes=4000)
    compact(spark, many, DAY, HOUR)
    assert len(files(lake.settings.layer(f"silver/transactions/dt={DAY}/hr={HOUR}"))) > 1


def test_day_compaction_in_one_run(lake, spark):
    lake.write_in_batches("BRONZE_TX", bronze_of(lake))
    compact(spark, lake.settings, DAY)
    expected = rows_of(lake.silver.where(f"dt = DATE'{DAY}'"), "transaction_id", "risk_score", "hr")
    assert rows_of(lake.read("SILVER_TX", DAY), "transaction_id", "risk_score", "hr") == expected


@pytest.mark.parametrize("hr", [HOUR, None])
def test_in_place_compaction_keeps_the_rows(lake, spark, hr):
    lake.write_in_batches("BRONZE_TX", bronze_of(lake))
    columns = [c for c in ROUTES["BRONZE_TX"].stored.names if c != "batch_id"]
    before = rows_of(lake.read("BRONZE_TX"), *columns)
    folder = lake.settings.layer("bronze/transactions")
    many = len(files(folder))
    compact_in_place(spark, lake.settings, "BRONZE_TX", DAY, hr)
    assert rows_of(lake.read("BRONZE_TX"), *columns) == before
    assert len(files(folder)) < many


@pytest.mark.parametrize("step", ["_write", "_delete"])
def test_in_place_compaction_recovers_from_a_lost_driver(lake, spark, monkeypatch, step):
    lake.write_in_batches("BRONZE_TX", bronze_of(lake))
    before = rows_of(lake.read("BRONZE_TX"), "transaction_id", "dt", "hr")
    done = getattr(compaction, step)

    def break_off(*args):
        done(*args)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(compaction, step, break_off)
    with pytest.raises(RuntimeError):
        compact_in_place(spark, lake.settings, "BRONZE_TX", DAY, HOUR)
    monkeypatch.undo()
    for _ in range(2):
        compact_in_place(spark, lake.settings, "BRONZE_TX", DAY, HOUR)
        assert rows_of(lake.read("BRONZE_TX"), "transaction_id", "dt", "hr") == before


@pytest.mark.parametrize("in_place", [True, False])
def test_rows_written_during_compaction_stay(lake, spark, monkeypatch, in_place):
    lake.write_in_batches("BRONZE_TX", bronze_of(lake))
    tag = "BRONZE_TX" if in_place else "SILVER_TX"
    more = lake.silver.where(f"dt = DATE'{DAY}' AND hr = {HOUR}").limit(1).withColumn("transaction_id", F.lit("meanwhile"))
    write = compaction._write

    def meanwhile(*args):
        lake.write(tag, more, "0f0f0f0f-0000-0000-0000-00000000000f-3")
        write(*args)

    monkeypatch.setattr(compaction, "_write", meanwhile)
    if in_place:
        compact_in_place(spark, lake.settings, tag, DAY, HOUR)
    else:
        compact(spark, lake.settings, DAY, HOUR)
    assert lake.read(tag, DAY, HOUR).where("transaction_id = 'meanwhile'").count() == 1


def test_folded_batches_leave_silver_too_and_the_newest_is_not_folded(lake, spark):
    hour = lake.silver.where(f"dt = DATE'{DAY}' AND hr = {HOUR}")
    for n in range(3):
        part = hour.where(F.pmod(F.hash("transaction_id"), F.lit(3)) == n)
        for tag in ("BRONZE_TX", "SILVER_TX"):
            lake.write(tag, part, f"0f0f0f0f-0000-0000-0000-00000000000f-{n}")
    compact_in_place(spark, lake.settings, "BRONZE_TX", DAY, HOUR)
    names = {r.batch_id for r in lake.read("BRONZE_TX").select("batch_id").distinct().collect()}
    assert len(names) == 2 and "0f0f0f0f-0000-0000-0000-00000000000f-2" in names
    compact(spark, lake.settings, DAY, HOUR)
    assert rows_of(lake.read("SILVER_TX"), "transaction_id") == rows_of(hour, "transaction_id")


def test_compacting_a_layer_onto_itself_is_refused(lake, spark):
    with pytest.raises(ValueError):
        compact(spark, lake.settings, DAY, HOUR, "ALERT", "ALERT")


def test_tables_exist_and_follow_the_folders(lake, spark):
    lake.write("ALERT", lake.alerts)
    for _ in range(2):
        create_tables(spark, lake.settings)
    for table, tag in LAYER_TABLES.items():
        assert spark.table(lake.settings.table(table)).columns == ROUTES[tag].stored.names
    table = lake.settings.table("silver_fraud_alerts")
    assert spark.table(table).count() == 0
    sync_partitions(spark, lake.settings, "silver_fraud_alerts")
    assert spark.table(table).count() == lake.alerts.count()
    compact_in_place(spark, lake.settings, "ALERT", DAY, HOUR)
    sync_partitions(spark, lake.settings, "silver_fraud_alerts")
    assert spark.table(table).count() == lake.alerts.count()


def test_layers_without_rows_can_be_synced(spark, lake):
    create_tables(spark, lake.settings)
    sync_partitions(spark, lake.settings)
    lake.write("LATE_TX", add_dt_hr(Layers.late(lake.layers().transactions)))
    assert lake.read("LATE_TX").count() == 13
    assert all(spark.table(lake.settings.table(t)).isEmpty() for t in LAYER_TABLES if t != "dlq_transactions")


def test_reports_are_the_same_on_tables_and_layers(spark, lake):
    late = add_dt_hr(Layers.late(lake.layers().transactions))
    for tag, rows in (("SILVER_TX", lake.silver), ("ALERT", lake.alerts), ("LATE_TX", late)):
        lake.write(tag, rows)
    create_tables(spark, lake.settings)
    sync_day(spark, lake.settings, DAY)
    table = lambda name: spark.table(lake.settings.table(name)).where(f"dt = DATE'{DAY}'")
    of_day = lambda df: df.where(f"dt = DATE'{DAY}'")
    for report, name, rows in (
            (ingest_lag_by_hour, "silver_transactions", lake.silver), (dlq_audit, "dlq_transactions", late),
            (lambda df: fraud_heatmap(df, DAY), "silver_fraud_alerts", lake.alerts),
            (lambda df: top_risk_accounts(df, DAY), "silver_fraud_alerts", lake.alerts)):
        assert rows_of(report(table(name))) == rows_of(report(of_day(rows)))
    load_gold(spark, lake.settings, DAY)
    assert rows_of(table("gold_location_risk").drop("dt")) == rows_of(location_risk(lake.alerts, DAY))
    assert rows_of(table("gold_daily_kpi_report").drop("dt")) == rows_of(daily_kpi_by_flag(lake.silver, DAY))


def test_day_sync_adds_and_drops_leaves_of_that_day_only(spark, lake):
    lake.write("ALERT", lake.alerts)
    create_tables(spark, lake.settings)
    count = lambda: spark.table(lake.settings.table("silver_fraud_alerts")).count()
    for _ in range(2):
        sync_day(spark, lake.settings, DAY, "silver_fraud_alerts")
        assert count() == lake.alerts.where(f"dt = DATE'{DAY}'").count()
    compact_in_place(spark, lake.settings, "ALERT", DAY)
    sync_day(spark, lake.settings, DAY, "silver_fraud_alerts")
    assert count() == lake.alerts.where(f"dt = DATE'{DAY}'").count()


def test_hours_in_fresh_processes(spark, lake):
    """Three processes, each with an empty catalog: two hours and one of them again."""
    lake.write_in_batches("BRONZE_TX", bronze_of(lake))
    lake.write("SILVER_TX", lake.silver)
    lake.write("ALERT", lake.alerts)
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for hour in (HOUR, HOUR + 1, HOUR):
        done = subprocess.run(
            [sys.executable, "-m", "riskstream", "--root", lake.settings.root, "hour", DAY, str(hour)], cwd=repo, timeout=300,
            env=os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false pyspark-shell"},
            capture_output=True, text=True)
        assert done.returncode == 0, done.stderr[-2000:]
    gold = lambda name: spark.read.parquet(lake.settings.layer(f"daily/{name}")).drop("dt")
    assert rows_of(gold("gold_location_risk")) == rows_of(location_risk(lake.alerts, DAY))
    assert rows_of(gold("gold_daily_kpi_report")) == rows_of(daily_kpi_by_flag(lake.silver, DAY))
    assert gold("serving_alerts").count() == serving_alerts(lake.alerts.where(f"dt = DATE'{DAY}'")).count()


def test_serving_tables_hold_one_row_per_key(lake, spark):
    lake.write("ALERT", lake.alerts)
    lake.write("SILVER_TX", lake.silver)
    create_tables(spark, lake.settings)
    sync_partitions(spark, lake.settings)
    for day in (DAY, "2024-01-02", DAY):
        load_serving(spark, lake.settings, day)
    alerts = spark.table(lake.settings.table("serving_alerts")).drop("dt")
    assert rows_of(alerts) == rows_of(serving_alerts(lake.alerts))
    assert alerts.count() == alerts.select("row_key").distinct().count() < lake.alerts.count()
    high = spark.table(lake.settings.table("serving_high_risk")).drop("dt")
    assert rows_of(high) == rows_of(serving_high_risk(lake.silver))


def test_gold_load_replaces_one_day(lake, spark):
    create_tables(spark, lake.settings)
    table = lake.settings.table("gold_daily_kpi_report")
    for day in (DAY, "2024-01-02", DAY):
        overwrite_day(spark, table, day, daily_kpi(lake.silver, day))
    got = {str(r.dt): r.total_transactions for r in spark.table(table).collect()}
    assert set(got) == {DAY, "2024-01-02"} and got[DAY] == 409


def test_hour_readiness(lake, spark):
    assert not hour_ready(spark, lake.settings, DAY, HOUR, AFTERWARDS)  # no folder
    lake.write("BRONZE_TX", bronze_of(lake))
    assert hour_ready(spark, lake.settings, DAY, HOUR, AFTERWARDS)
    assert not hour_ready(spark, lake.settings, "2024-02-01", HOUR, AFTERWARDS)
    closing = datetime(2024, 1, 1, HOUR + 1, 10, tzinfo=timezone.utc)  # end of hour + 10 minutes
    assert hour_ready(spark, lake.settings, DAY, HOUR, closing)
    assert not hour_ready(spark, lake.settings, DAY, HOUR, closing.replace(minute=9))


def test_hourly_run_twice_gives_the_same_lake(lake, spark):
    lake.write_in_batches("BRONZE_TX", bronze_of(lake))
    lake.write("SILVER_TX", lake.silver)
    lake.write("ALERT", lake.alerts)
    assert not run_hour(spark, lake.settings, "2023-01-01", 1, AFTERWARDS)
    results = []
    for _ in range(2):
        assert run_hour(spark, lake.settings, DAY, HOUR, AFTERWARDS)
        results.append([rows_of(spark.table(lake.settings.table(t)))
                        for t in ("gold_location_risk", "gold_daily_kpi_report", "silver_transactions")])
    assert results[0] == results[1]
    assert len(results[0][1]) == 1


def test_last_batch_wins_in_the_high_risk_table(spark, lake):
    row = lake.silver.where("is_high_risk").limit(1)
    early = row.withColumns({"transaction_id": F.lit("TX-9"), "spark_proc_time": F.lit("2024-01-01 00:00:01").cast("timestamp")})
    late = row.withColumns({"transaction_id": F.lit("TX-1"), "spark_proc_time": F.lit("2024-01-01 00:00:06").cast("timestamp")})
    [kept] = serving_high_risk(early.union(late), "transaction_id").collect()
    assert kept.transaction_id == "TX-1" and str(kept.tx_proc_ts).startswith("2024-01-01 00:00:06")
