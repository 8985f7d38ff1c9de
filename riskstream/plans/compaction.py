"""Small-file compaction of an hour or a day."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from math import ceil

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskstream.operators.routes import ROUTES, Route
from riskstream.operators.scoring import score_transactions
from riskstream.operators.sinks import COMPACTED, write_leaves
from riskstream.schemas import conform
from riskstream.settings import Settings
from riskstream.sources.commits import LIVE, finished
from riskstream.sources.files import bytes_of, delete_folder, folder_exists, leaves, read_leaves


def inventory(layer: DataFrame) -> DataFrame:
    """Rows, files and bytes of every (dt, hr) of a scanned layer.

    Only file metadata columns are asked for, so no data page is decoded; counting is
    pre-aggregated per file.
    """
    files = layer.groupBy("dt", "hr", F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("row_count"), F.first("_metadata.file_size").alias("bytes"))
    return files.groupBy("dt", "hr").agg(
        F.sum("row_count").alias("row_count"), F.count(F.lit(1)).alias("file_count"),
        F.sum("bytes").alias("byte_count"))


Leaves = list[tuple[int, str]]
STEPS = "hr int, leaf string, fresh string, state string"


def _write(rows: DataFrame, route: Route, layer: str, dt: str, size: int, file_bytes: int) -> None:
    """The rows of a day or an hour in as many files as their bytes need, whatever their number: cut by ranges of
    (hour, hash of the row)."""
    files = max(1, ceil(size / file_bytes))
    write_leaves(rows.repartitionByRange(files, "hr", F.xxhash64(*route.spread_by)), layer)


def _bytes(spark: SparkSession, layer: str, dt: str, of: Leaves) -> int:
    return sum(bytes_of(spark, f"{layer}/dt={dt}/hr={hr}") for hr in {hr for hr, _ in of})


def _delete(spark: SparkSession, layer: str, dt: str, of: Leaves) -> None:
    for hr, leaf in of:
        delete_folder(spark, f"{layer}/dt={dt}/hr={hr}/batch_id={leaf}")


def compact(spark: SparkSession, settings: Settings, dt: str, hr: int | None = None,
            source: str = "BRONZE_TX", target: str = "SILVER_TX",
            transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Rewrite an hour (or a day) of `source` as few files of `target`, in place of what was there.

    `transform` turns source rows into target rows; for silver it is the scoring, so that the
    scored rows the stream wrote are replaced by the same rows and not by unscored ones. Leaves are listed first,
    and only listed ones are read and replaced: what a stream writes meanwhile stays, and so does a leaf
    of a micro-batch whose source leaf isn't there yet. Between the write and the deletes a reader can see
    rows twice; a run that fails there is simply repeated, as the source is kept.
    """
    if source == target:
        raise ValueError("use compact_in_place to compact a layer into itself")
    if transform is None and target == "SILVER_TX":
        def transform(df: DataFrame) -> DataFrame:
            return score_transactions(df, settings.high_risk_threshold)

    origin, route = ROUTES[source], ROUTES[target]
    from_layer, to_layer = settings.layer(origin.layer), settings.layer(route.layer)
    old = leaves(spark, to_layer, dt, hr)
    read = finished(spark, settings, leaves(spark, from_layer, dt, hr))
    if not read:
        return
    taken = {*read, *_folded(spark, settings, origin, dt)}
    rows = read_leaves(spark, from_layer, origin.stored, dt, read)
    rows = rows.transform(transform) if transform else rows
    out = conform(rows.withColumn("batch_id", F.lit(COMPACTED)), route.stored)
    _write(out, route, to_layer, dt, _bytes(spark, from_layer, dt, read), settings.file_bytes)
    _delete(spark, to_layer, dt, [x for x in old if x[1] != COMPACTED and (x in taken or not LIVE.fullmatch(x[1]))])


def compact_in_place(spark: SparkSession, settings: Settings, tag: str, dt: str,
                     hr: int | None = None) -> None:
    """Fold the leaves of an hour (or a day) of a layer into one per hour, while a stream may go on writing.

    The listed leaves are copied into a fresh one and then deleted; nothing else is touched. Each step is noted first, so a
    run that finds an unfinished one either drops its copy or ends its deletes. In every hour the newest leaf of each query
    stays, because its micro-batch may be repeated and would then bring back rows that are folded. Between the
    copy and the deletes a reader can see rows twice.
    """
    route = ROUTES[tag]
    layer, notes = settings.layer(route.layer), _notes(settings, route, dt)
    for fresh, states in _unfinished(spark, notes).items():
        old = [(r.hr, r.leaf) for r in states["planned"]]
        hours = {h for h, _ in old}
        _delete(spark, layer, dt, old if "written" in states else [(h, fresh) for h in hours])
        _note(spark, notes, [(0, None, fresh, "done" if "written" in states else "dropped")])
    old = _without_newest(leaves(spark, layer, dt, hr))
    if not old:
        return
    fresh = f"{COMPACTED}-{uuid.uuid4().hex}"
    _note(spark, notes, [(h, leaf, fresh, "planned") for h, leaf in old])
    rows = read_leaves(spark, layer, route.stored, dt, old).withColumn("batch_id", F.lit(fresh))
    _write(conform(rows, route.stored), route, layer, dt, _bytes(spark, layer, dt, old), settings.file_bytes)
    _note(spark, notes, [(0, None, fresh, "written")])
    _delete(spark, layer, dt, old)
    _note(spark, notes, [(0, None, fresh, "done")])


def _without_newest(found: Leaves) -> Leaves:
    newest: dict[tuple[int, str], int] = {}
    for hr, leaf in found:
        if live := LIVE.fullmatch(leaf):
            query = (hr, leaf.rpartition("-")[0])
            newest[query] = max(newest.get(query, -1), int(live[2]))
    return [(hr, leaf) for hr, leaf in found if not LIVE.fullmatch(leaf)
            or int(leaf.rpartition("-")[2]) < newest[hr, leaf.rpartition("-")[0]]]


# One small file per step; a day's notes are read whole.
def _notes(settings: Settings, route: Route, dt: str) -> str:
    return settings.layer(f"_compaction/{route.layer}/dt={dt}")


def _note(spark: SparkSession, notes: str, steps: list[tuple]) -> None:
    spark.createDataFrame(steps, STEPS).coalesce(1).write.mode("append").json(notes)


def _unfinished(spark: SparkSession, notes: str) -> dict[str, dict[str, list]]:
    found: dict[str, dict[str, list]] = {}
    if folder_exists(spark, notes):
        for r in spark.read.schema(STEPS).json(notes).collect():
            found.setdefault(r.fresh, {}).setdefault(r.state, []).append(r)
    return {fresh: states for fresh, states in found.items() if not {"done", "dropped"} & set(states)}


def _folded(spark: SparkSession, settings: Settings, route: Route, dt: str) -> Leaves:
    """Leaves of a day that are in a fresh one by now."""
    notes = _notes(settings, route, dt)
    if not folder_exists(spark, notes):
        return []
    steps = spark.read.schema(STEPS).json(notes).collect()
    there = {r.fresh for r in steps if r.state == "written"}
    return [(r.hr, r.leaf) for r in steps if r.state == "planned" and r.fresh in there]
