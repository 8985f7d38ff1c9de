from dataclasses import replace
from datetime import date, datetime, timezone

import pytest
from helpers import at, millis, rows_of
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from riskstream.__main__ import arguments, settings_of
from riskstream.functions.clock import add_dt_hr, add_event_time
from riskstream.functions.frames import frame_columns, to_frame
from riskstream.functions.keys import alert_row_key, high_risk_row_key
from riskstream.operators.lateness import mark_on_time, split_late
from riskstream.operators.scoring import score_transactions
from riskstream.schemas import struct
from riskstream.settings import Settings, seconds
from riskstream.sources.feeds import CONTRACTS, Version, bad_frames, decode_feed
from riskstream.sources.kafka import kafka_options


@pytest.mark.parametrize("amount, international, place, score", [
    (9999.99, False, "Paris", 0),
    (10000.0, False, "Paris", 0),
    (10000.01, False, "Paris", 50),
    (float("nan"), False, "Paris", 50),
    (None, None, None, 0),
    (None, True, "Unknown", 50),
    (1.0, None, "unknown", 0),
    (1.0, True, "Paris", 30),
    (1.0, False, "Unknown", 20),
    (20000.0, True, "Unknown", 100),
    (20000.0, True, None, 80),
    (20000.0, False, "Unknown", 70),
])
def test_score(spark, amount, international, place, score):
    tx = spark.createDataFrame(
        [(amount, international, place)], "amount double, is_international boolean, location string")
    row = score_transactions(tx, 50).first()
    assert (row.risk_score, row.is_high_risk) == (score, score >= 50)
    assert score_transactions(tx, 20).first().is_high_risk == (score >= 20)


def test_score_type_is_int(spark):
    tx = spark.createDataFrame([(1.0, True, "x")], "amount double, is_international boolean, location string")
    assert dict(score_transactions(tx).dtypes)["risk_score"] == "int"


def test_calendar_columns(spark):
    moments = [
        datetime(2024, 1, 1, 0, 0, 0, tzinfo=timezone.utc),
        datetime(2024, 1, 1, 23, 59, 59, 999000, tzinfo=timezone.utc),
        datetime(2024, 1, 2, 7, 0, 0, 1000, tzinfo=timezone.utc),
    ]
    df = spark.createDataFrame([(millis(m),) for m in moments] + [(None,)], "timestamp long")
    got = add_dt_hr(add_event_time(df)).select("dt", "hr").collect()
    assert [tuple(r) for r in got] == [
        (date(2024, 1, 1), 0), (date(2024, 1, 1), 23), (date(2024, 1, 2), 7), (None, None)]


def test_event_time_keeps_milliseconds(spark):
    df = add_event_time(spark.createDataFrame([(1704067200123,)], "timestamp long"))
    assert df.select(F.unix_micros("event_time")).first()[0] == 1704067200123000


def lateness_rows(spark):
    rows = [
        ("exact", at(0), at(3), at(600)),
        ("late by a hair", at(0), at(3), at(600.05)),
        ("fresh", at(0), at(3), at(5)),
        ("future", at(60), at(61), at(0)),
        ("no time", None, at(3), at(5)),
    ]
    return spark.createDataFrame(
        rows, "id string, event_time timestamp, kafka_timestamp timestamp, clock timestamp")


def test_lateness_bound_is_inclusive_and_finer_than_seconds(spark):
    marked = mark_on_time(lateness_rows(spark), "10 minutes", "clock")
    got = {r.id: (r.on_time, r.dlq_reason, r.total_latency_sec) for r in marked.collect()}
    assert got == {
        "exact": (True, None, 600),
        "late by a hair": (False, "late", 600),
        "fresh": (True, None, 5),
        "future": (True, None, -60),
        "no time": (False, "no event time", None),
    }


def test_split_loses_nothing_and_lags_add_up(spark):
    on_time, late = split_late(lateness_rows(spark), "10 minutes", F.col("clock"))
    assert on_time.count() + late.count() == 5
    telescoped = on_time.where(
        "source_to_kafka_lag_sec + kafka_to_spark_lag_sec != total_latency_sec")
    assert telescoped.isEmpty()


def test_wall_clock_makes_history_late(spark):
    on_time, late = split_late(lateness_rows(spark).drop("clock"), "10 minutes")
    assert (on_time.count(), late.count()) == (0, 5)


def test_frame_round_trip_and_bad_frames(spark):
    contract = CONTRACTS["activity"]
    body = ('{"account_id":"ACC-1","activity_type":"LIMIT_CHANGE","old_value":"1","new_value":"2",'
            '"timestamp":5}').encode()
    header = bytes([0, 0, 0, 1, 2])
    values = [header + body, b"", b"\x00\x00\x00\x01", header, header + b"{",
              b"\x07" + header[1:] + body, None, header + b"[]"]
    raw = spark.createDataFrame([(v, at(i)) for i, v in enumerate(values)],
                                "value binary, kafka_timestamp timestamp")
    good = decode_feed(raw, contract, "json")
    assert good.columns == ["account_id", "activity_type", "old_value", "new_value", "timestamp",
                            "kafka_timestamp"]
    assert [tuple(r)[:5] for r in good.collect()] == [("ACC-1", "LIMIT_CHANGE", "1", "2", 5)]

    bad = bad_frames(raw, contract, "json")
    assert sorted((r.dlq_reason, r.schema_id) for r in bad.collect() if r.schema_id) == [
        ("frame without body", 258), ("undecodable body", 258), ("undecodable body", 258),
        ("unknown magic byte", 258)]
    assert good.count() + bad.count() == len(values)


def test_frame_fields_are_big_endian(spark):
    df = spark.createDataFrame([("{}",)], "body string").select(to_frame(F.col("body"), 66051).alias("value"))
    row = frame_columns(df).first()
    assert (row.magic, row.schema_id, bytes(row.body), row.frame_error) == (0, 66051, b"{}", None)


def versioned_contract():
    earlier = Version(9, struct(acct=StringType, login_id=StringType, ip_address=StringType, timestamp=StringType, zone=StringType),
                      renamed=(("account_id", "acct"),), defaults=(("device_type", "unknown"),))
    return replace(CONTRACTS["logins"], versions=(earlier, Version(8, struct(account_id=StringType, timestamp=LongType))))


def test_messages_are_read_by_the_schema_they_name(spark):
    contract = versioned_contract()
    messages = [
        (2, '{"account_id": "a", "login_id": "l1", "ip_address": "i", "location": "p", "device_type": "d", "timestamp": 1}'),
        (9, '{"acct": "b", "login_id": "l2", "ip_address": "i", "timestamp": "2", "zone": "z", "location": "not in this schema"}'),
        (9, '{"acct": "b", "login_id": "l3", "timestamp": "soon"}'),
        (9, "{}"), (9, "[]"), (9, '{"acct": "b"'), (8, '{"account_id": "c", "timestamp": 3}'), (8, '{"account_id": "c", "timestamp": "x"}'),
        (7, '{"account_id": "d", "timestamp": 4}'), (2 ** 31 + 2, '{"account_id": "e", "timestamp": 5}')]
    values = [b"\x00" + number.to_bytes(4, "big") + body.encode() for number, body in messages]
    raw = spark.createDataFrame([(v, at()) for v in [*values, b"\x07", None]], "value binary, kafka_timestamp timestamp")
    good = decode_feed(raw, contract, "json")
    assert good.columns == [*contract.schema.names, "kafka_timestamp"]
    assert [f.dataType for f in good.schema][:6] == [f.dataType for f in contract.schema]
    assert sorted(tuple(r)[:6] for r in good.select(*contract.schema.names).na.fill("-").collect()) == [
        ("a", "l1", "i", "p", "d", 1), ("b", "l2", "i", "-", "unknown", 2), ("c", "-", "-", "-", "-", 3)]
    bad = bad_frames(raw, contract, "json")
    assert sorted((r.dlq_reason, r.schema_id or 0) for r in bad.collect()) == [
        ("frame without body", 0), ("frame without body", 0),
        ("undecodable body", 8), *[("undecodable body", 9)] * 4,
        ("unknown schema id", 7), ("unknown schema id", 2 ** 31 + 2)]
    assert decode_feed(raw.limit(0), contract, "json").count() == 0


def test_each_message_is_parsed_by_one_schema(spark):
    raw = spark.createDataFrame([(b"", at())], "value binary, kafka_timestamp timestamp")
    plan = decode_feed(raw, versioned_contract(), "json")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 3


def test_versions_must_fit_their_contract():
    contract = CONTRACTS["logins"]
    with pytest.raises(ValueError, match="two versions"):
        replace(contract, versions=(Version(2, contract.schema),))
    for wrong in ({"renamed": (("account_id", "nobody"),)}, {"renamed": (("nobody", "login_id"),)}, {"defaults": (("nobody", 1),)}):
        with pytest.raises(ValueError, match="nobody"):
            replace(contract, versions=(Version(3, contract.schema, **wrong),))


def test_avro_body(spark):
    """Untested where the package is absent, as on the build box."""
    if not spark._jvm.java.lang.Thread.currentThread().getContextClassLoader().getResource(
            "org/apache/spark/sql/avro/AvroDataToCatalyst.class"):
        pytest.skip("spark-avro is not on the class path")
    raw = spark.createDataFrame([(b"\x00" * 8, at())], "value binary, kafka_timestamp timestamp")
    assert decode_feed(raw, CONTRACTS["logins"], "avro").columns == [*CONTRACTS["logins"].schema.names, "kafka_timestamp"]


def test_every_setting_from_the_command_line():
    job = ["stream", "--bootstrap", "b:1", "--trigger", "9 seconds"]
    options = ["watermark_delay=3 minutes", "late_allowance=2 minutes", "login_tx_window=30 seconds", "high_risk_threshold=70",
               "hot_share=0.5", "future_allowance=none", "fail_on_data_loss=true", "topic_tx=t=1", "trigger_interval=1 second"]
    found = settings_of(arguments(["--root", "r", *[x for option in options for x in ("--set", option)], *job]))
    assert found == Settings(
        "r", bootstrap="b:1", watermark_delay="3 minutes", late_allowance="2 minutes", login_tx_window="30 seconds",
        high_risk_threshold=70, hot_share=0.5, future_allowance=None, fail_on_data_loss=True, topic_tx="t=1", trigger_interval="1 second")
    assert settings_of(arguments(["--root", "r", *job])) == Settings("r", bootstrap="b:1", trigger_interval="9 seconds")
    for wrong in ("nothing=1", "watermark_delay", "watermark_delay=soon", "high_risk_threshold=x", "fail_on_data_loss=2", "bootstrap"):
        with pytest.raises(SystemExit):
            arguments(["--root", "r", "--set", wrong, "tables"])


def test_avro_contract_text():
    assert '"name": "is_international", "type": "boolean"' in CONTRACTS["transactions"].avro()


def test_unknown_body_format(spark):
    raw = spark.createDataFrame([(b"", at())], "value binary, kafka_timestamp timestamp")
    with pytest.raises(ValueError):
        decode_feed(raw, CONTRACTS["logins"], "xml")


def test_row_keys(spark):
    df = spark.createDataFrame(
        [("ACC-1", at(0.25), "TX-9", 77)],
        "account_id string, event_time timestamp, transaction_id string, timestamp long")
    row = df.select(alert_row_key().alias("a"), high_risk_row_key().alias("h")).first()
    assert row.a == f"ACC-1_{millis(at(0.25))}_TX-9"
    assert row.h == "ACC-1_77"


def test_kafka_options():
    plain = kafka_options("b:1", "t")
    assert plain == {"kafka.bootstrap.servers": "b:1", "subscribe": "t", "startingOffsets": "latest",
                     "failOnDataLoss": "false"}
    assert kafka_options("b:1", "t", "earliest", 3000)["maxOffsetsPerTrigger"] == "3000"


def test_parts_of_seconds_are_refused():
    for duration in ("1500 milliseconds", "1.5 seconds", "soon", ""):
        with pytest.raises(ValueError):
            seconds(duration)
    assert seconds("3000 milliseconds") == 3


def test_settings():
    settings = Settings("/lake")
    assert settings.layer("dlq/logins") == "/lake/dlq/logins"
    assert Settings.small_box("/lake").max_offsets_per_trigger == 3000
    assert [seconds(d) for d in ("1 minute", "5 minutes", "10 minutes", "2 hours")] == [60, 300, 600, 7200]
    with pytest.raises(AttributeError):
        settings.root = "/other"


def test_half_parsed_bodies_are_bad_and_a_missing_account_is_not(spark):
    contract = CONTRACTS["logins"]
    names = contract.schema.names
    bodies = ['{"account_id": "a", "timestamp": "soon"}', '{"account_id": "a"', "null", "[]", "{}",
              '{"login_id": "l", "timestamp": 5}', '{"account_id": "a", "login_id": "m", "timestamp": 6}']
    raw = spark.createDataFrame([(b, at()) for b in bodies], "body string, kafka_timestamp timestamp").select(
        to_frame(F.col("body"), contract.schema_id).alias("value"), "kafka_timestamp")
    good = decode_feed(raw, contract, "json")
    assert good.columns == [*names, "kafka_timestamp"]
    assert sorted(r.login_id for r in good.collect()) == ["l", "m"]
    assert bad_frames(raw, contract, "json").where("dlq_reason = 'undecodable body'").count() == 5
