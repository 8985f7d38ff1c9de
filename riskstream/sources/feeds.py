"""Feed contracts and decoding of framed messages."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskstream import schemas
from riskstream.functions.clock import add_event_time
from riskstream.functions.frames import HEADER_BYTES, frame_columns, usable_frame
from riskstream.settings import Settings
from riskstream.sources.kafka import read_kafka


def avro_record(name: str, schema: StructType) -> str:
    """An Avro record of plain primitives."""
    kinds = {"string": "string", "double": "double", "bigint": "long", "boolean": "boolean"}
    return json.dumps({
        "type": "record",
        "name": "".join(part.capitalize() for part in name.split("_")),
        "fields": [{"name": f.name, "type": kinds[f.dataType.simpleString()]} for f in schema.fields],
    })


@dataclass(frozen=True)
class Version:
    """An earlier schema of a feed that messages of a topic may still carry.

    renamed   (column of the contract, column here) for those that had another name.
    defaults  (column of the contract, value) for those that this schema lacks; others are null.
    """
    schema_id: int
    schema: StructType
    renamed: tuple[tuple[str, str], ...] = ()
    defaults: tuple[tuple[str, str | int | float | bool], ...] = ()


@dataclass(frozen=True)
class Contract:
    """The newest registered schema of one feed. Add an entry per schema change.

    versions  Earlier schemas. With any, a message is read by the schema whose id it carries, and other ids are bad
              frames. Without, every message is read as the newest schema, whatever its id.
    """
    name: str
    schema_id: int
    schema: StructType
    versions: tuple[Version, ...] = ()

    def __post_init__(self):
        ids = [self.schema_id, *(v.schema_id for v in self.versions)]
        if len(set(ids)) < len(ids):
            raise ValueError(f"{self.name}: a schema id has two versions")
        for version in self.versions:
            new = {name for name, _ in (*version.renamed, *version.defaults)} - set(self.schema.names)
            old = {name for _, name in version.renamed} - set(version.schema.names)
            if new or old:
                raise ValueError(f"{self.name}, schema {version.schema_id}: no column {', '.join(sorted(new | old))}")

    def avro(self) -> str:
        return avro_record(self.name, self.schema)


CORRUPT = "_corrupt"

CONTRACTS = {
    "transactions": Contract("transactions", 1, schemas.TRANSACTION),
    "logins": Contract("logins", 2, schemas.LOGIN),
    "activity": Contract("activity", 3, schemas.ACTIVITY),
}


def _body(schema: StructType, body: str, avro_schema: str) -> Column:
    """The message body as a struct. A body that does not parse gives nulls, not an error; CORRUPT is set if any part does not."""
    message = F.expr(f"substring(value, {HEADER_BYTES + 1})")
    if body == "json":
        return F.from_json(message.cast("string"), StructType([*schema.fields, StructField(CORRUPT, StringType())]), {"columnNameOfCorruptRecord": CORRUPT})
    if body == "avro":
        from pyspark.sql.avro.functions import from_avro
        parsed = from_avro(message, avro_schema, {"mode": "PERMISSIVE"})
        return parsed.withField(CORRUPT, F.lit(None).cast("string"))
    raise ValueError(f"unknown body format {body!r}")


def _upgraded(message: Column, contract: Contract, version: Version) -> Column:
    """A struct of an earlier schema as one of the contract's. A value that the newer type can't hold makes the body corrupt;
    a body of nulls alone stays one, so that no default hides that nothing was in it."""
    renamed, defaults = dict(version.renamed), dict(version.defaults)

    def columns(old: Column) -> Column:
        nothing = reduce(and_, (old[name].isNull() for name in version.schema.names))
        fields, lost = [], F.lit(False)
        for field in contract.schema.fields:
            source = renamed.get(field.name, field.name)
            if source in version.schema.names:
                value = old[source].try_cast(field.dataType)
                lost = lost | (old[source].isNotNull() & value.isNull())
            else:
                value = F.when(~nothing, F.lit(defaults.get(field.name))).cast(field.dataType)
            fields.append(value.alias(field.name))
        corrupt = F.when(lost, F.lit("a value of another type")).otherwise(old[CORRUPT])
        return F.struct(*fields, corrupt.alias(CORRUPT))

    # Over a list of one, so that the body is parsed once and not for each column.
    return F.transform(F.array(message), columns)[0]


def _parsed(contract: Contract, body: str, avro_schema: str | None) -> Column:
    """The body in the contract's columns and CORRUPT, by the schema that `schema_id` names. One pass whatever the number of versions:
    a message is parsed by its own schema only."""
    newest = _body(contract.schema, body, avro_schema or contract.avro())
    if not contract.versions:
        return newest
    parsed = F.when(F.col("schema_id") == contract.schema_id, newest)
    for version in contract.versions:
        message = _body(version.schema, body, avro_record(contract.name, version.schema))
        parsed = parsed.when(F.col("schema_id") == version.schema_id, _upgraded(message, contract, version))
    return parsed


def decode_marked(raw: DataFrame, contract: Contract, body: str = "avro",
                  avro_schema: str | None = None) -> DataFrame:
    """All messages of a topic in one pass: feed columns, what the raw row carried besides its
    value, and `frame_error`, which is null for good messages. Bad ones keep `topic`, `value` and
    `schema_id` for the dead letters.
    """
    extra = [c for c in raw.columns if c != "value"]
    # As a one-row `inline` the parse happens once. A filter on a parsed column would otherwise be
    # moved below the projection and parse every body a second time.
    parsed = F.inline(F.array(F.when(usable_frame(), _parsed(contract, body, avro_schema))))
    nothing = " AND ".join(f"`{name}` IS NULL" for name in contract.schema.names)
    error = f"coalesce(frame_error, CASE WHEN {CORRUPT} IS NOT NULL OR ({nothing}) THEN 'undecodable body' END)"
    framed = frame_columns(raw)
    if contract.versions:
        known = F.col("schema_id").isin(contract.schema_id, *(v.schema_id for v in contract.versions))
        framed = framed.withColumn("frame_error", F.coalesce("frame_error", F.when(~known, "unknown schema id")))
    decoded = framed.select(parsed, *extra, "value", "schema_id", "frame_error")
    names = [f"`{name}`" for name in (*contract.schema.names, *extra)]
    return decoded.selectExpr(*names, "value", "schema_id", f"{error} AS frame_error").selectExpr(
        *names, "frame_error",
        f"CASE WHEN frame_error IS NOT NULL THEN '{contract.name}' END AS topic",
        "CASE WHEN frame_error IS NOT NULL THEN value END AS value",
        "CASE WHEN frame_error IS NOT NULL THEN schema_id END AS schema_id")


def decode_feed(raw: DataFrame, contract: Contract, body: str = "avro",
                avro_schema: str | None = None) -> DataFrame:
    """The good messages as feed columns, then whatever else the raw row carried."""
    marked = decode_marked(raw, contract, body, avro_schema)
    return marked.where("frame_error IS NULL").drop("frame_error", "topic", "value", "schema_id")


def bad_frames(raw: DataFrame, contract: Contract, body: str = "avro",
               avro_schema: str | None = None) -> DataFrame:
    """The complement of decode_feed: messages for the dead letters, with the reason."""
    marked = decode_marked(raw, contract, body, avro_schema)
    return marked.where("frame_error IS NOT NULL").selectExpr(
        "topic", "value", "kafka_timestamp", "schema_id", "frame_error AS dlq_reason")


def ingest(raw: DataFrame, contract: Contract, body: str = "avro",
           avro_schema: str | None = None) -> DataFrame:
    """Decoded messages, good and bad, with their event time."""
    return raw.transform(decode_marked, contract, body, avro_schema).transform(add_event_time)


def ingest_topic(spark: SparkSession, settings: Settings, topic: str, contract: Contract,
                 body: str = "avro", avro_schema: str | None = None) -> DataFrame:
    raw = read_kafka(spark, settings.bootstrap, topic, settings.starting_offsets,
                     settings.max_offsets_per_trigger, settings.fail_on_data_loss)
    return ingest(raw, contract, body, avro_schema)
