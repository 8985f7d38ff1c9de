"""Catalog tables over the lake. All have a place below its root, so a new catalog takes them over as they are."""

from __future__ import annotations

from pyspark.sql import SparkSession

from riskstream import schemas
from riskstream.operators.routes import ROUTES
from riskstream.settings import Settings
from riskstream.sources.files import leaves, make_folder

LAYER_TABLES = {
    "bronze_transactions": "BRONZE_TX",
    "bronze_logins": "BRONZE_LOGIN",
    "bronze_activity": "BRONZE_ACTIVITY",
    "silver_transactions": "SILVER_TX",
    "silver_fraud_alerts": "ALERT",
    "dlq_transactions": "LATE_TX",
    "dlq_logins": "LATE_LOGIN",
    "dlq_activity": "LATE_ACTIVITY",
    "dlq_frames": "BAD_FRAME",
}
DAILY_TABLES = {
    "gold_location_risk": schemas.GOLD_LOCATION_RISK,
    "gold_daily_kpi_report": schemas.GOLD_DAILY_KPI,
    "serving_alerts": schemas.SERVING_ALERTS,
    "serving_high_risk": schemas.SERVING_HIGH_RISK,
}


def create_database(spark: SparkSession, settings: Settings) -> None:
    if settings.database != "default":
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {settings.database} "
                  f"LOCATION '{settings.layer('gold')}'")


def create_tables(spark: SparkSession, settings: Settings) -> None:
    """External tables over the streamed layers, and daily ones for gold and serving. Safe to repeat, also in a
    process whose catalog starts empty: what earlier ones have written is found again."""
    create_database(spark, settings)
    for table, tag in LAYER_TABLES.items():
        route = ROUTES[tag]
        # A sync needs the folder, and a layer without rows so far has none.
        make_folder(spark, settings.layer(route.layer))
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {settings.table(table)} ({schemas.ddl(route.stored)}) "
            f"USING parquet PARTITIONED BY (dt, hr, batch_id) "
            f"LOCATION '{settings.layer(route.layer)}'")
    for table, schema in DAILY_TABLES.items():
        folder = settings.layer(f"daily/{table}")
        make_folder(spark, folder)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {settings.table(table)} ({schemas.ddl(schema)}, dt DATE) "
            f"USING parquet PARTITIONED BY (dt) LOCATION '{folder}'")
        spark.sql(f"MSCK REPAIR TABLE {settings.table(table)} SYNC PARTITIONS")     # one partition a day


def sync_day(spark: SparkSession, settings: Settings, day: str, *tables: str) -> None:
    """Make the catalog match the folders of one day. Its leaves, at most one per hour and micro-batch, are compared by
    name; other days are neither listed nor changed."""
    for table in tables or LAYER_TABLES:
        spark.catalog.refreshTable(settings.table(table))       # a rewritten leaf keeps its name
        there = set(leaves(spark, settings.layer(ROUTES[LAYER_TABLES[table]].layer), day))
        shown = spark.sql(f"SHOW PARTITIONS {settings.table(table)} PARTITION (dt = DATE'{day}')").collect()
        levels = [dict(level.split("=", 1) for level in r[0].split("/")) for r in shown]
        known = {(int(x["hr"]), x["batch_id"]) for x in levels}
        for change, changed in (("ADD IF NOT EXISTS", sorted(there - known)), ("DROP IF EXISTS", sorted(known - there))):
            for at in range(0, len(changed), 500):
                names = [f"PARTITION (dt = DATE'{day}', hr = {hr}, batch_id = '{leaf}')" for hr, leaf in changed[at:at + 500]]
                spark.sql(f"ALTER TABLE {settings.table(table)} {change} " + (", " if change[0] == "D" else " ").join(names))


def sync_partitions(spark: SparkSession, settings: Settings, *tables: str) -> None:
    """Make the catalog match the folders: adds new leaves and drops those compaction removed."""
    for table in tables or LAYER_TABLES:
        spark.sql(f"MSCK REPAIR TABLE {settings.table(table)} SYNC PARTITIONS")
