"""Compacted hours with versions: readers of the catalog see an hour change in one step.

Beside each streamed layer's table of leaves stands one of hours, `<table>_hours`, with one partition per (dt, hr). A fold writes the
hour's finished leaves, and what its version so far holds, as a new folder beside the old one, and then
moves the partition there with one SET LOCATION: a query that was planned before reads the old version, one planned afterwards the new
one, and both have each row once. What has been folded is deleted later, when no such query runs any more.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from functools import reduce
from math import ceil
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskstream import schemas
from riskstream.operators.routes import ROUTES, Route
from riskstream.plans.tables import LAYER_TABLES, create_database
from riskstream.schemas import conform
from riskstream.settings import Settings
from riskstream.sources.commits import finished
from riskstream.sources.files import bytes_of, delete_folder, folder_exists, leaves, level_values, make_folder, read_leaves

NOTES = "hr int, version string, leaves array<string>, state string, at long"
KEEP_SECONDS = 3600


class Version(NamedTuple):
    """A written version of an hour: the leaves it holds, and when it was switched to (milliseconds; None: not yet)."""
    hr: int
    name: str
    leaves: frozenset[str]
    written: int
    switched: int | None


def hours_table(settings: Settings, table: str) -> str:
    return settings.table(f"{table}_hours")


def _place(settings: Settings, route: Route, dt: str) -> str:
    return settings.layer(f"_hours/{route.layer}/dt={dt}")


def _folder(settings: Settings, route: Route, dt: str, hr: int, name: str) -> str:
    return f"{_place(settings, route, dt)}/hr={hr}/{name}"


def create_hours_table(spark: SparkSession, settings: Settings, table: str) -> None:
    """Safe to repeat. The table's own folder stays empty: every partition has a place of its own."""
    route = ROUTES[LAYER_TABLES[table]]
    empty = settings.layer(f"_hours/{route.layer}/_none")
    make_folder(spark, empty)
    create_database(spark, settings)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {hours_table(settings, table)} ({schemas.ddl(_columns(route))}) "
              f"USING parquet PARTITIONED BY (dt, hr) LOCATION '{empty}'")


def _columns(route: Route):
    kept = [f for f in route.stored.fields if f.name != "batch_id"]
    return type(route.stored)(kept)


def versions(spark: SparkSession, settings: Settings, table: str, dt: str) -> dict[int, list[Version]]:
    """The versions of each hour of a day, oldest first, from the day's notes."""
    notes = f"{_place(settings, ROUTES[LAYER_TABLES[table]], dt)}/_notes"
    found: dict[tuple[int, str], dict[str, object]] = {}
    if folder_exists(spark, notes):
        for r in spark.read.schema(NOTES).json(notes).collect():
            found.setdefault((r.hr, r.version), {})[r.state] = r
    hours: dict[int, list[Version]] = {}
    for (hr, name), states in found.items():
        written, switched = states["written"], states.get("switched")
        hours.setdefault(hr, []).append(Version(hr, name, frozenset(written.leaves), written.at, switched and switched.at))
    return {hr: sorted(own, key=lambda v: (v.switched is None, v.switched, v.written)) for hr, own in hours.items()}


def _current(own: list[Version]) -> Version | None:
    return next((v for v in reversed(own) if v.switched is not None), None)


def _note(spark: SparkSession, settings: Settings, route: Route, dt: str, hr: int, version: str, of: list[str], state: str) -> None:
    row = [(hr, version, of, state, time.time_ns() // 1_000_000)]
    spark.createDataFrame(row, NOTES).coalesce(1).write.mode("append").json(f"{_place(settings, route, dt)}/_notes")


def _write_version(rows: DataFrame, folder: str, files: int, route: Route) -> None:
    rows.repartitionByRange(files, F.xxhash64(*route.spread_by)).write.mode("overwrite").parquet(folder)


def _switch(spark: SparkSession, settings: Settings, table: str, dt: str, hr: int, folder: str) -> None:
    name, partition = hours_table(settings, table), f"PARTITION (dt = DATE'{dt}', hr = {hr})"
    if spark.sql(f"SHOW PARTITIONS {name} {partition}").isEmpty():
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {partition} LOCATION '{folder}'")
    else:
        spark.sql(f"ALTER TABLE {name} {partition} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)


def fold_hour(spark: SparkSession, settings: Settings, table: str, dt: str, hr: int,
              transform: Callable[[DataFrame], DataFrame] | None = None) -> bool:
    """Take the hour's finished leaves that no version holds yet into a new version; False if there are none.

    Nothing is deleted. A run that breaks off before the switch leaves a folder that nobody reads, one that breaks off
    after it at worst folds the same leaves again, from the older version: each time readers see every folded row once. A leaf that a
    repeated micro-batch writes anew under its old name is known, and not folded twice.
    """
    route = ROUTES[LAYER_TABLES[table]]
    layer = settings.layer(route.layer)
    create_hours_table(spark, settings, table)
    base = _current(versions(spark, settings, table, dt).get(hr, []))
    known = base.leaves if base else frozenset()
    fresh = [x for x in finished(spark, settings, leaves(spark, layer, dt, hr)) if x[1] not in known]
    if not fresh:
        return False
    rows = read_leaves(spark, layer, route.stored, dt, fresh)
    rows = conform(rows.transform(transform) if transform else rows, _columns(route)).drop("dt", "hr")
    size = sum(bytes_of(spark, f"{layer}/dt={dt}/hr={hr}/batch_id={leaf}") for _, leaf in fresh)
    if base:
        old = _folder(settings, route, dt, hr, base.name)
        rows = rows.unionByName(spark.read.schema(rows.schema).parquet(old))
        size += bytes_of(spark, old)
    version = uuid.uuid4().hex
    folder = _folder(settings, route, dt, hr, version)
    _write_version(rows, folder, max(1, ceil(size / settings.file_bytes)), route)
    _note(spark, settings, route, dt, hr, version, sorted(known | {leaf for _, leaf in fresh}), "written")
    _switch(spark, settings, table, dt, hr, folder)
    _note(spark, settings, route, dt, hr, version, [], "switched")
    return True


def fold_day(spark: SparkSession, settings: Settings, table: str, dt: str) -> list[int]:
    """Fold every hour of a day that has something new; returns these hours."""
    found = sorted({hr for hr, _ in leaves(spark, settings.layer(ROUTES[LAYER_TABLES[table]].layer), dt)})
    return [hr for hr in found if fold_hour(spark, settings, table, dt, hr)]


def whole_days(spark: SparkSession, settings: Settings, tag: str, days: list[str]) -> DataFrame | None:
    """All finished rows of a route on these days, without `batch_id`: what the current versions hold, and the leaves that none of them
    holds. Leaves are listed before the notes are read, and none is deleted that a version does not hold; None: no rows."""
    route = ROUTES[tag]
    layer = settings.layer(route.layer)
    table = next(name for name, own in LAYER_TABLES.items() if own == tag)
    parts, folders = [], []
    for dt in days:
        listed = finished(spark, settings, leaves(spark, layer, dt))
        current = {hr: version for hr, own in versions(spark, settings, table, dt).items() if (version := _current(own))}
        folders += [_folder(settings, route, dt, hr, version.name) for hr, version in current.items()]
        loose = [(hr, leaf) for hr, leaf in listed if hr not in current or leaf not in current[hr].leaves]
        if loose:
            parts.append(read_leaves(spark, layer, route.stored, dt, loose).drop("batch_id"))
    if folders:
        held = spark.read.schema(_columns(route)).option("basePath", settings.layer(f"_hours/{route.layer}"))
        parts.append(held.parquet(*folders))
    return reduce(DataFrame.unionByName, parts) if parts else None


def restore_hours(spark: SparkSession, settings: Settings, table: str, dt: str) -> None:
    """Point the partitions of a day to their current versions, for a catalog that starts empty or has lost a switch."""
    create_hours_table(spark, settings, table)
    for hr, own in versions(spark, settings, table, dt).items():
        if current := _current(own):
            _switch(spark, settings, table, dt, hr, _folder(settings, ROUTES[LAYER_TABLES[table]], dt, hr, current.name))


def drop_folded(spark: SparkSession, settings: Settings, table: str, dt: str, keep_seconds: int = KEEP_SECONDS) -> int:
    """Delete what the current versions of a day have replaced for at least `keep_seconds`: older versions, broken-off ones, and
    folded leaves. Returns the number of folders."""
    route, before = ROUTES[LAYER_TABLES[table]], time.time_ns() // 1_000_000 - 1000 * keep_seconds
    gone = 0
    for hr, own in versions(spark, settings, table, dt).items():
        current = _current(own)
        if current is None or current.switched > before:
            continue
        place = f"{_place(settings, route, dt)}/hr={hr}"
        noted = {v.name: v for v in own}
        for name in level_values(spark, f"{place}/*"):
            if name != current.name and (name in noted and noted[name].written <= before):
                delete_folder(spark, f"{place}/{name}")
                gone += 1
        layer = settings.layer(route.layer)
        for _, leaf in leaves(spark, layer, dt, hr):
            if leaf in current.leaves:
                delete_folder(spark, f"{layer}/dt={dt}/hr={hr}/batch_id={leaf}")
                gone += 1
    return gone
