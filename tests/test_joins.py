import random

import pytest
from helpers import activity, at, logins, rows_of, scored_tx

from riskstream.functions.clock import add_event_time
from riskstream.operators.alerts import activity_then_tx, login_then_tx
from riskstream.operators.interval_join import HotSpan, hot_keys
from riskstream.plans.layers import Layers
from riskstream.settings import Settings
from riskstream.sources.events import EVENTS, Feeds, feeds_from_events


def micro(n):
    return n / 1_000_000


@pytest.mark.parametrize("cells", [True, False])
@pytest.mark.parametrize("offset, found", [
    (0, True), (60, True), (30, True), (60 + micro(1), False), (-micro(1), False), (-30, False),
])
@pytest.mark.parametrize("trigger", [0, 17.5, 59.999999])
def test_login_interval_bounds(spark, cells, trigger, offset, found):
    tx = scored_tx(spark, [("t", "a", at(trigger + offset), "Paris", 1.0)])
    log = logins(spark, [("l", "a", at(trigger), "London")])
    assert login_then_tx(tx, log, cells=cells).count() == int(found)


@pytest.mark.parametrize("offset, amount, kind, found", [
    (0, 10000.0, "LIMIT_CHANGE", True), (300, 10000.0, "LIMIT_CHANGE", True),
    (300 + micro(1), 10000.0, "LIMIT_CHANGE", False), (-micro(1), 10000.0, "LIMIT_CHANGE", False),
    (10, 9999.99, "LIMIT_CHANGE", False), (10, 99999.0, "ADDRESS_CHANGE", False),
    (10, None, "LIMIT_CHANGE", False),
])
def test_activity_rule(spark, offset, amount, kind, found):
    tx = scored_tx(spark, [("t", "a", at(offset), "Paris", amount)])
    act = activity(spark, [("a", at(0), kind)])
    assert activity_then_tx(tx, act).count() == int(found)


@pytest.mark.parametrize("tx_place, login_place, found", [
    ("Paris", "London", 1), ("Paris", "Paris", 0), (None, "Paris", 0), ("Paris", None, 0)])
def test_places_must_differ_and_be_known(spark, tx_place, login_place, found):
    tx = scored_tx(spark, [("t", "a", at(5), tx_place, 1.0)])
    log = logins(spark, [("l", "a", at(0), login_place)])
    assert login_then_tx(tx, log).count() == found


def test_one_alert_per_matching_login(spark):
    tx = scored_tx(spark, [("t", "a", at(30), "Paris", 1.0), ("u", "b", at(30), "Paris", 1.0)])
    log = logins(spark, [("l1", "a", at(0), "London"), ("l2", "a", at(29), "Tokyo"),
                         ("l3", "c", at(29), "Tokyo"), ("l4", None, at(29), "Tokyo")])
    assert rows_of(login_then_tx(tx, log), "transaction_id", "login_id") == [("t", "l1"), ("t", "l2")]


def test_rows_without_time_or_account_never_match(spark):
    tx = scored_tx(spark, [("t", "a", None, "Paris", 1.0), ("u", None, at(1), "Paris", 1.0)])
    log = logins(spark, [("l", "a", at(0), "London"), ("m", None, at(0), "London"), ("n", "a", None, "Rome")])
    assert login_then_tx(tx, log).count() == 0


def test_times_before_the_epoch(spark):
    from datetime import datetime, timezone
    early = datetime(1969, 12, 31, 23, 59, 30, tzinfo=timezone.utc)
    tx = scored_tx(spark, [(str(i), "a", at(i * 10, early), "Paris", 1.0) for i in range(12)])
    log = logins(spark, [(str(i), "a", at(i * 10, early), "London") for i in range(12)])
    columns = ("transaction_id", "login_id")
    assert rows_of(login_then_tx(tx, log), *columns) == rows_of(login_then_tx(tx, log, cells=False), *columns)


def random_frames(spark, seed, accounts, n=400, span=900):
    rng = random.Random(seed)
    # A third of everything belongs to one account.
    account = lambda: "hot" if rng.random() < 1 / 3 else f"a{rng.randrange(accounts)}"
    places = ["Paris", "London", "Unknown", None]
    moment = lambda: at(rng.choice([rng.randrange(span), round(rng.uniform(0, span), 6)]))
    tx = [(f"t{i}", account(), moment(), rng.choice(places), 1.0) for i in range(n)]
    log = [(f"l{i}", account(), moment(), rng.choice(places)) for i in range(n // 3)]
    brute = sorted(
        (t[0], g[0]) for t in tx for g in log
        if t[1] == g[1] and 0 <= (t[2] - g[2]).total_seconds() <= 60
        and None not in (t[3], g[3]) and t[3] != g[3])
    return scored_tx(spark, tx), logins(spark, log), brute


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_every_form_equals_brute_force(spark, seed):
    tx, log, brute = random_frames(spark, seed, accounts=5)
    assert brute
    for form in ({}, {"cells": False}, {"hot": ["hot"], "hot_parts": 7},
                 {"hot": ["hot", "a1", "absent"], "cells": False}):
        assert rows_of(login_then_tx(tx, log, **form), "transaction_id", "login_id") == brute


@pytest.mark.parametrize("seed", [4, 5])
def test_spans_of_hot_keys_change_nothing(spark, seed):
    tx, log, brute = random_frames(spark, seed, accounts=3)
    begin = int(at(0).timestamp() * 1_000_000)
    spans = [HotSpan("hot", begin + 100_000_000, begin + 400_000_000), HotSpan("hot", begin + 600_000_000), HotSpan("a1", begin, begin)]
    for hot in (spans, [*spans, "a2"]):
        pairs = login_then_tx(tx, log, hot=hot, hot_parts=5)
        assert rows_of(pairs, "transaction_id", "login_id") == brute
    with pytest.raises(ValueError, match="needs cells"):
        login_then_tx(tx, log, hot=spans, cells=False)


def test_a_span_begins_behind_all_state():
    width = 60
    first, after = HotSpan("k", 125, 200).cells(width)
    # A trigger at 125 reaches until 185, in cell 3.
    assert (first, after) == (4, 5) and HotSpan("k", 120).cells(width) == (4, None)


def test_hot_keys_are_exactly_those_above_the_share(spark):
    df = spark.createDataFrame([("a",)] * 50 + [("b",)] * 30 + [("c",)] * 20 + [(None,)] * 100, "k string")
    assert hot_keys(df, "k", 0.15) == ["a", "b"]
    assert hot_keys(df, "k", 0.1) == ["a", "b", "c"]
    assert hot_keys(df.limit(0), "k", 0.1) == []


def busy_layers(spark, sf, **options):
    """Ten accounts hold everything: the counts are the published ones of FIXTURES.md."""
    events = spark.read.schema(EVENTS).parquet(f"/root/testdata/sf{sf}/events.parquet")
    feeds = Feeds(*(add_event_time(f) for f in feeds_from_events(events, accounts=10)))
    return Layers(feeds, Settings(""), "proc_time", **options)


@pytest.mark.parametrize("sf, expected", [
    ("0.001", (591, 210, 199, 13, 3, 3)), ("0.01", (5977, 2006, 2017, 121, 422, 258))])
def test_published_counts(spark, sf, expected):
    layers = busy_layers(spark, sf)
    counts = (
        layers.transactions.count(), layers.logins.count(), layers.activity.count(),
        layers.late(layers.transactions).count(), layers.login_alerts.count(),
        layers.activity_alerts.count())
    assert counts == expected


def test_few_hot_accounts_in_parts(spark):
    layers = busy_layers(spark, "0.1", hot=[f"ACC-{1000 + i}" for i in range(10)])
    assert layers.login_alerts.count() == 43938
    assert layers.activity_alerts.count() == 27314
