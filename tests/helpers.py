"""Small frames for tests."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

START = datetime(2024, 1, 1, 12, 0, 0, tzinfo=timezone.utc)


def at(seconds=0.0, start=START):
    return start + timedelta(seconds=seconds)


def millis(moment):
    return int(moment.timestamp() * 1000)


def scored_tx(spark, rows):
    """(transaction_id, account_id, event_time, location, amount)"""
    df = spark.createDataFrame(
        rows, "transaction_id string, account_id string, event_time timestamp, location string, amount double")
    return df.withColumn("risk_score", F.lit(50))


def logins(spark, rows):
    """(login_id, account_id, event_time, location)"""
    df = spark.createDataFrame(
        rows, "login_id string, account_id string, event_time timestamp, location string")
    return df.withColumns({"ip_address": F.lit("192.168.1.1"), "device_type": F.lit("Web")})


def activity(spark, rows):
    """(account_id, event_time, activity_type)"""
    df = spark.createDataFrame(rows, "account_id string, event_time timestamp, activity_type string")
    return df.withColumns({"old_value": F.lit("5000"), "new_value": F.lit("20000")})


def rows_of(df, *columns):
    df = df.select(*columns) if columns else df.select(*sorted(df.columns))
    return sorted((tuple(row) for row in df.collect()), key=repr)
