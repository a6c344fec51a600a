"""Event envelopes: building them from tables and reading them back."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroledger.functions.columns import short_id
from aeroledger.schemas import EVENT_TYPES

# All payload fields of all types in one struct: a name means the same, with one type, wherever it occurs.
PAYLOAD = T.StructType(list({f.name: f for spec in EVENT_TYPES.values() for f in spec["payload"].fields}.values()))
ENVELOPE = T.StructType([
    *[T.StructField(c, T.StringType()) for c in ("event_id", "event_type", "topic", "key")],
    T.StructField("event_time", T.TimestampType()), T.StructField("payload", PAYLOAD),
    T.StructField("_unread", T.StringType())])
STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
ENVELOPE_KEYS = ("event_id", "event_type", "topic", "event_time", "payload")


def build_envelopes(event_type: str, rows: DataFrame, produced_at: Column | None = None,
                    event_id: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """(topic, key, event_time, value, *keep) for rows that carry the payload columns of ``event_type``.

    The id derives from type, key, time and payload, so a retried task does not
    create new events.
    """
    spec = EVENT_TYPES[event_type]
    payload = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec["payload"].fields])
    as_json = {"ignoreNullFields": "false", "timestampFormat": STAMP}
    body = rows.select(F.col(spec["key"]).cast("string").alias("key"), F.col(spec["time"]).cast("timestamp").alias("event_time"),
                       payload.alias("payload"), (event_id if event_id is not None else F.lit(None)).alias("_id"), *keep)
    ident = F.coalesce(F.col("_id").cast("string"),
                       short_id(F.lit(event_type), "key", "event_time", F.to_json("payload", as_json)))
    value = F.struct(ident.alias("event_id"), F.lit(event_type).alias("event_type"), F.lit(spec["topic"]).alias("topic"),
                     "key", "event_time", "payload",
                     (produced_at if produced_at is not None else F.lit(None)).cast("timestamp").alias("_produced_at"))
    return body.select(F.lit(spec["topic"]).alias("topic"), "key", "event_time",
                       F.to_json(value, as_json).alias("value"), *keep)


def event_feed(flights: DataFrame | None = None, baggage: DataFrame | None = None,
               bookings: DataFrame | None = None, ordered: bool = False) -> DataFrame:
    """Envelopes of all three sources, optionally in event-time order."""
    parts = [build_envelopes(t, df) for t, df in
             (("flight_status", flights), ("baggage_scan", baggage), ("booking", bookings)) if df is not None]
    feed = reduce(DataFrame.unionByName, parts)
    return feed.orderBy("event_time", "topic", "key") if ordered else feed


def read_events(spark: SparkSession, source: str, location: str, per_trigger: int | None = None,
                topics: list[str] | None = None) -> DataFrame:
    """Raw stream with ``value`` and ``arrival`` (position of the record at its source).

    ``kafka``: ``location`` names the brokers.  ``files``: JSON-line files with one
    envelope per line below ``location``; the line's place in its file is filled in
    per micro-batch.
    """
    if source == "kafka":
        subscribed = ",".join(topics or [s["topic"] for s in EVENT_TYPES.values()])
        reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", location)
                  .option("subscribe", subscribed).option("startingOffsets", "earliest"))
        if per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", per_trigger)
        return reader.load().select(
            F.col("value").cast("string").alias("value"),
            F.struct(F.col("partition").cast("string").alias("part"), F.lit(0).cast("long").alias("block"),
                     F.col("offset").alias("pos")).alias("arrival"))
    if source == "files":
        reader = spark.readStream.format("text")
        if per_trigger:
            reader = reader.option("maxFilesPerTrigger", per_trigger)
        return reader.load(location).select(
            "value", F.struct(
                F.concat_ws("|", F.date_format("_metadata.file_modification_time", "yyyyMMddHHmmssSSS"),
                            "_metadata.file_path").alias("part"),
                F.col("_metadata.file_block_start").alias("block"),
                F.lit(None).cast("long").alias("pos")).alias("arrival"))
    raise ValueError(f"unknown source {source}")


def _payload_problem(event_type: str) -> Column:
    """Why a payload does not fit its type; NULL when it does.

    Only a payload with a null field can lack one, so other rows skip the look at
    the field names.
    """
    spec = EVENT_TYPES[event_type]
    names = spec["payload"].fieldNames()
    some_null = reduce(Column.__or__, [F.col(f"payload.{c}").isNull() for c in names])
    present = F.json_object_keys(F.get_json_object("value", "$.payload"))
    absent = F.array_except(F.array(*[F.lit(c) for c in names]), F.coalesce(present, F.array().cast("array<string>")))
    lacks = F.when(F.size(absent) > 0, F.concat(F.lit("payload lacks "), F.array_join(absent, ", ")))
    return F.coalesce(F.when(some_null, lacks),
                      F.when(F.col(f"payload.{spec['key']}").isNull(), F.lit("payload key is null")))


def parse_events(raw: DataFrame) -> DataFrame:
    """(arrival, envelope columns, payload, problem, value); ``problem`` is NULL for good events.

    A good event is JSON, has every envelope field, and a payload with every
    field its type calls for (a value may be null, a field may not be absent).
    Events of unknown types are good but carry no known payload.  The raw text
    is kept for unusable events only.  Each record is parsed once.
    """
    doc = F.from_json("value", ENVELOPE, {"columnNameOfCorruptRecord": "_unread"})
    out = raw.select("value", "arrival", doc.alias("_e")).select("value", "arrival", "_e.*")
    absent = reduce(Column.__or__, [F.col(c).isNull() for c in ENVELOPE_KEYS])
    by_type = [F.when(F.col("event_type") == t, _payload_problem(t)) for t in EVENT_TYPES]
    problem = F.coalesce(F.when(absent, F.lit("incomplete envelope")), *by_type,
                         F.when(F.col("_unread").isNotNull(), F.lit("unreadable values")))
    return (out.withColumn("problem", problem).drop("_unread")
            .withColumn("value", F.when(F.col("problem").isNotNull(), F.col("value"))))


def typed_events(events: DataFrame, event_type: str) -> DataFrame:
    """Events of one type with their payload columns next to event id, time and arrival."""
    names = EVENT_TYPES[event_type]["payload"].fieldNames()
    return (events.filter(F.col("event_type") == event_type)
            .select("event_id", "event_time", "arrival", *[f"payload.{c}" for c in names]))
