"""Parquet sources: a directory as a stream, and pruned scans of a lake layer; folder checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def stream_files(spark: SparkSession, path: str, schema: StructType,
                 max_files_per_trigger: int = 0) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger > 0:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def folder_exists(spark: SparkSession, path: str) -> bool:
    """One metadata call to the file system; reading the folder would list everything in it."""
    fs, folder = _file_system(spark, path)
    return fs.exists(folder)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _file_system(spark, path)
    fs.mkdirs(folder)


def leaves(spark: SparkSession, layer: str, dt: str, hr: int | None = None) -> list[tuple[int, str]]:
    """(hr, batch_id) of every leaf of a day or an hour, from the folders' names."""
    hour = "hr=*" if hr is None else f"hr={int(hr)}"
    fs, pattern = _file_system(spark, f"{layer}/dt={dt}/{hour}/batch_id=*")
    found = []
    for status in fs.globStatus(pattern) or ():
        path = status.getPath()
        found.append((int(path.getParent().getName().split("=", 1)[1]), path.getName().split("=", 1)[1]))
    return sorted(found)


def level_values(spark: SparkSession, pattern: str) -> list[str]:
    """What stands behind `=` in the names of the folders that match, or whole names."""
    fs, path = _file_system(spark, pattern)
    return [status.getPath().getName().rpartition("=")[2] for status in fs.globStatus(path) or ()]


def latest_hours(spark: SparkSession, layer: str, count: int) -> list[tuple[str, int]]:
    """(dt, hr) of the last hours of a layer that have a folder, latest first; days are listed by name, and only as many are
    opened as it takes."""
    found: list[tuple[str, int]] = []
    for dt in sorted(level_values(spark, f"{layer}/dt=[0-9]*"), reverse=True):
        found += [(dt, hr) for hr in sorted(map(int, level_values(spark, f"{layer}/dt={dt}/hr=[0-9]*")), reverse=True)]
        if len(found) >= count:
            break
    return found[:count]


def bytes_of(spark: SparkSession, path: str) -> int:
    fs, folder = _file_system(spark, path)
    return fs.getContentSummary(folder).getLength()


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _file_system(spark, path)
    fs.delete(folder, True)


def read_leaves(spark: SparkSession, layer: str, schema: StructType, dt: str,
                of: list[tuple[int, str]]) -> DataFrame:
    """Exactly these leaves of a day; one that is written meanwhile is not read."""
    paths = [f"{layer}/dt={dt}/hr={hr}/batch_id={leaf}" for hr, leaf in of]
    return spark.read.schema(schema).option("basePath", layer).parquet(*paths)


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def read_hours(spark: SparkSession, layer: str, schema: StructType, dt: str | None = None,
               hr: int | None = None) -> DataFrame:
    """Scan a layer, one day or one hour of it; `dt` and `hr` stay columns and prune directories.

    The schema comes from the contract, so no footer is opened to infer it.
    """
    path = layer
    if dt is not None:
        # Listing starts at the day or the hour; basePath keeps the levels above as columns.
        path = f"{path}/dt={dt}"
        if hr is not None:
            path = f"{path}/hr={int(hr)}"
    df = spark.read.schema(schema).option("basePath", layer).parquet(path)
    if dt is not None:
        df = df.where(F.col("dt") == F.to_date(F.lit(dt)))
    return df if hr is None else df.where(F.col("hr") == int(hr))
