"""Live tables from the event stream: exact dedup, out-of-order-safe state, dead letters, monitoring.

The set of seen event ids is the state of ``dropDuplicates`` (kept by the state
store, no watermark: ids never expire), so a batch costs as much as its own
events.  The logs of a micro-batch (ledger, dead letters, monitoring) go to its own
``batch_id=`` folder and are overwritten on replay.  A live table holds one row per
key in buckets of the key's hash; a batch merges its part into the buckets it has
keys of and leaves the others alone.  Merging is associative and takes a batch twice
without harm, so a replay changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from aeroledger.schemas import EVENT_TYPES
from aeroledger.session import ENGINE_CONF
from aeroledger.sources import partitions, tables
from aeroledger.streaming.envelope import parse_events, typed_events

LEDGER, DEAD_LETTERS, MONITORING = "stream_seen_events", "events_deadletter", "stream_monitoring"
PROGRESS = "stream_progress"
PROGRESS_ROW = "topic string, progress_start timestamp, progress_end timestamp, lag bigint"


def dedup(events: DataFrame, fresh_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(first arrival of each fresh event, repeated deliveries per topic)."""
    columns = [c for c in events.columns if c not in ("event_id", "arrival")]
    first = (events.groupBy("event_id").agg(F.min(F.struct("arrival", *columns)).alias("_f"))
             .select("event_id", "_f.*").join(fresh_ids, "event_id", "left_semi"))
    seen = events.groupBy("topic").agg(F.count(F.lit(1)).alias("delivered"))
    kept = first.groupBy("topic").agg(F.count(F.lit(1)).alias("processed"))
    return first, seen.join(kept, "topic", "left").select(
        "topic", (F.col("delivered") - F.coalesce("processed", F.lit(0))).alias("duplicates"))


def _columns(event_type: str) -> tuple[str, list[str], list[str]]:
    spec = EVENT_TYPES[event_type]
    fixed = [f for f in spec["payload"].fieldNames() if f != spec["key"] and f not in spec["mutable"]]
    return spec["key"], fixed, list(spec["mutable"])


def partial_state(events: DataFrame, event_type: str, batch_id: int, now: datetime) -> DataFrame:
    """State a batch contributes per key: columns fixed by its first arrival, the rest by its newest event time.

    Among equal event times the later arrival wins.
    """
    key, fixed, mutable = _columns(event_type)
    newest = F.max(F.struct("event_time", "arrival", *mutable))
    oldest = F.min(F.struct("arrival", *fixed))
    stamp = F.lit(now).cast("timestamp").alias("_updated_at")
    batch = F.lit(batch_id).cast("long")
    return (events.groupBy(key).agg(newest.alias("_new"), oldest.alias("_old"))
            .select(key, *[F.col(f"_old.{c}") for c in fixed], *[F.col(f"_new.{c}") for c in mutable],
                    F.col("_new.event_time").alias("event_time"), stamp,
                    batch.alias("_first_batch"), batch.alias("_last_batch")))


def merge_states(partials: DataFrame, event_type: str) -> DataFrame:
    """One partial per key from any number of them."""
    key, fixed, mutable = _columns(event_type)
    newest = F.max(F.struct("event_time", "_last_batch", *mutable, "_updated_at"))
    oldest = F.min(F.struct("_first_batch", *fixed))
    return (partials.groupBy(key).agg(newest.alias("_new"), oldest.alias("_old"))
            .select(key, *[F.col(f"_old.{c}") for c in fixed], *[F.col(f"_new.{c}") for c in mutable],
                    "_new.event_time", "_new._updated_at", "_old._first_batch", "_new._last_batch"))


def state_schema(event_type: str) -> T.StructType:
    """Columns of a stored live table."""
    key, fixed, mutable = _columns(event_type)
    payload = EVENT_TYPES[event_type]["payload"]
    stamps = [T.StructField(c, T.TimestampType()) for c in ("event_time", "_updated_at")]
    return T.StructType([*[payload[c] for c in (key, *fixed, *mutable)], *stamps,
                         *[T.StructField(c, T.LongType()) for c in ("_first_batch", "_last_batch")]])


def bucket_of(key: str, buckets: int) -> Column:
    """Name of a key's bucket; it carries the number of buckets, which a table keeps for life."""
    return F.concat(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string"), F.lit(f"of{buckets}"))


def bucket_count(spark: SparkSession, path: str, default: int) -> int:
    names = [n for n in tables.list_names(spark, path) if n.startswith(f"{partitions.PART}=")]
    return int(names[0].rsplit("of", 1)[1]) if names else default


def merge_partial(partial: DataFrame, event_type: str, root: str, buckets: int) -> list[str]:
    """Merge a batch's part into the live table; returns the buckets it rewrote."""
    spark, spec, schema = partial.sparkSession, EVENT_TYPES[event_type], state_schema(event_type)
    path = f"{root}/{spec['live']}"
    partitions.settle(spark, path, schema)
    if not tables.path_exists(spark, path):
        partitions.create(spark, path, schema)
    bucket = bucket_of(spec["key"], bucket_count(spark, path, buckets))
    touched = partitions.parts_of(partial.select(bucket.alias(partitions.PART)))
    if touched:
        stored = partitions.read(spark, path, schema, touched).drop(partitions.PART)
        merged = merge_states(stored.unionByName(partial), event_type)
        partitions.replace(merged.withColumn(partitions.PART, bucket), path, touched)
    return touched


def monitoring_rows(events: DataFrame, fresh: DataFrame, duplicates: DataFrame, run_id: str, start: datetime,
                    end: datetime) -> DataFrame:
    """One row per topic: applied, repeated and unusable events of the batch."""
    zero = F.lit(0).cast("long")

    def counted(df: DataFrame, processed: Column = zero, repeated: Column = zero, errors: Column = zero) -> DataFrame:
        return df.select(F.coalesce("topic", F.lit("unknown")).alias("topic"), processed.alias("processed"),
                         repeated.alias("duplicates"), errors.alias("errors"))

    spark = events.sparkSession
    known = spark.createDataFrame([(s["topic"],) for s in EVENT_TYPES.values()], "topic string")
    bad = events.filter(F.col("problem").isNotNull()).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    applied = fresh.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    parts = (counted(known).unionByName(counted(applied, processed=F.col("n")))
             .unionByName(counted(duplicates, repeated=F.col("duplicates")))
             .unionByName(counted(bad, errors=F.col("n"))))
    sums = parts.groupBy("topic").agg(*[F.sum(c).alias(c) for c in ("processed", "duplicates", "errors")])
    return sums.select(F.lit(run_id).alias("run_id"), "topic", F.lit(start).cast("timestamp").alias("window_start"),
                       F.lit(end).cast("timestamp").alias("window_end"), "processed", "duplicates", "errors",
                       F.lit(None).cast("long").alias("consumer_lag"))


def apply_batch(root: str, run_id: str, buckets: int = 8) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body that writes live tables, ledger, dead letters and monitoring below ``root``.

    ``buckets`` sizes a live table at its first batch: as many as make a bucket one task's work when the table is full.
    """

    def write(df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")

    def body(batch: DataFrame, batch_id: int) -> None:
        start = datetime.now(timezone.utc)
        # Text files carry no record position; rows of one file block stay together and in order.
        place = F.coalesce("arrival.pos", F.monotonically_increasing_id())
        batch = batch.withColumn("arrival", F.struct("arrival.part", "arrival.block", place.alias("pos"))).persist()
        kept = [batch]
        try:
            events = batch.filter(F.col("kind") == "event").drop("kind")
            fresh_ids = batch.filter(F.col("kind") == "fresh").select("event_id")
            fresh, repeated = dedup(events.filter(F.col("problem").isNull()), fresh_ids)
            fresh = fresh.persist()
            kept.append(fresh)
            now = F.lit(start).cast("timestamp")
            for event_type in EVENT_TYPES:
                merge_partial(partial_state(typed_events(fresh, event_type), event_type, batch_id, start), event_type, root, buckets)
            write(fresh.select("event_id", "event_type", "topic", now.alias("consumed_at")), LEDGER, batch_id)
            write(events.filter(F.col("problem").isNotNull()).select("topic", "value", "problem"), DEAD_LETTERS, batch_id)
            write(monitoring_rows(events, fresh, repeated, run_id, start, datetime.now(timezone.utc)),
                  MONITORING, batch_id)
        finally:
            for df in kept:
                df.unpersist()

    return body


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session whose shuffle partitions suit the stream's state.

    A checkpoint keeps its number of state partitions for life; by default it is
    one per core rather than the batch setting.
    """
    session = spark.newSession()
    for key, value in ENGINE_CONF.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", str(state_partitions or spark.sparkContext.defaultParallelism))
    return session


def _batch_distinct(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct non-null ids of each Arrow batch."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pc.drop_null(pc.unique(batch.column(0)))], names=["event_id"])


def tagged_stream(raw: DataFrame) -> DataFrame:
    """Every delivered event (kind ``event``) plus the ids never seen before (kind ``fresh``).

    An id delivered over and over would send all its copies to one state task.
    Streams have no map-side combine, so copies are dropped per Arrow batch
    before the shuffle, together with the unusable events' missing ids.
    """
    events = parse_events(raw).withColumn("kind", F.lit("event"))
    usable = parse_events(raw).select(F.when(F.col("problem").isNull(), F.col("event_id")).alias("event_id"))
    ids = (usable.mapInArrow(_batch_distinct, "event_id string").dropDuplicates(["event_id"])
           .withColumn("kind", F.lit("fresh")))
    return events.unionByName(ids, allowMissingColumns=True)


def start_live_tables(raw: DataFrame, root: str, checkpoint: str, run_id: str, available_now: bool = False,
                      interval: str = "10 seconds", buckets: int | None = None) -> StreamingQuery:
    """Start the stream; with ``available_now`` it stops once the present input is used up."""
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    buckets = buckets or int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (tagged_stream(raw).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .foreachBatch(apply_batch(root, run_id, buckets)).trigger(**trigger).start())


def lag_by_topic(progress: dict) -> dict[str, int]:
    """Records of each topic that lay at the source beyond the end of a batch, from its progress report.

    Kafka reports offsets by topic and partition; a partition without an end offset has not been read at all.  Other
    sources know no topics and report no lag.
    """
    lags: dict[str, int] = {}
    for source in progress["sources"]:
        end, latest = ({} if v is None else json.loads(v) if isinstance(v, str) else v for v in (
            source.get("endOffset"), source.get("latestOffset")))
        for topic, offsets in latest.items() if isinstance(latest, dict) else ():
            if isinstance(offsets, dict):
                read = end.get(topic, {}) if isinstance(end, dict) else {}
                lags[topic] = lags.get(topic, 0) + sum(max(0, last - read.get(part, 0)) for part, last in offsets.items())
    return lags


def record_progress(spark: SparkSession, root: str, progress: dict) -> None:
    """Keep a batch's times and lags beside its logs; a row without a topic carries the times."""
    start = datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00"))
    end = start + timedelta(milliseconds=progress["durationMs"].get("triggerExecution", 0))
    rows = [(topic, start, end, lag) for topic, lag in [(None, None), *lag_by_topic(progress).items()]]
    spark.createDataFrame(rows, PROGRESS_ROW).coalesce(1).write.mode("overwrite").parquet(
        f"{root}/{PROGRESS}/batch_id={progress['batchId']}")


class ProgressLog(StreamingQueryListener):
    """Records the progress of one running query; add it to the session's ``streams`` before or after the start."""

    def __init__(self, spark: SparkSession, root: str, query: StreamingQuery):
        self.spark, self.root, self.id = spark, root, str(query.id)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.id) == self.id:
            record_progress(self.spark, self.root, json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def run_available(raw: DataFrame, root: str, checkpoint: str, run_id: str) -> None:
    """Process everything at the source, then stop."""
    query = start_live_tables(raw, root, checkpoint, run_id, available_now=True)
    query.awaitTermination()
    # Spark keeps as many reports as spark.sql.streaming.numRecentProgressUpdates says; earlier batches stay without.
    for progress in query.recentProgress:
        told = json.loads(progress.json)
        if tables.path_exists(raw.sparkSession, f"{root}/{MONITORING}/batch_id={told['batchId']}"):
            record_progress(raw.sparkSession, root, told)


def publish_dead_letters(dead: DataFrame, bootstrap: str, topic: str = "events.deadletter") -> None:
    """Send unusable events to the dead-letter topic."""
    (dead.select("value").write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
     .option("topic", topic).save())


# --- reading ------------------------------------------------------------------------------------

def live_table(spark: SparkSession, root: str, event_type: str) -> DataFrame:
    """Latest state per key."""
    spec = EVENT_TYPES[event_type]
    stored = partitions.read(spark, f"{root}/{spec['live']}", state_schema(event_type))
    return stored.select(*spec["payload"].fieldNames(), "event_time", "_updated_at")


def ledger(spark: SparkSession, root: str) -> DataFrame:
    return tables.read_table(spark, f"{root}/{LEDGER}").drop("batch_id")


def dead_letters(spark: SparkSession, root: str) -> DataFrame:
    return tables.read_table(spark, f"{root}/{DEAD_LETTERS}").drop("batch_id")


def monitoring(spark: SparkSession, root: str) -> DataFrame:
    """One row per batch and topic; window times and lag are those of the stream's own reports where a batch has one."""
    rows = tables.read_table(spark, f"{root}/{MONITORING}")
    if not tables.path_exists(spark, f"{root}/{PROGRESS}"):
        return rows.drop("batch_id")
    told = tables.read_table(spark, f"{root}/{PROGRESS}")
    times = told.filter(F.col("topic").isNull()).select("batch_id", "progress_start", "progress_end")
    lags = told.filter(F.col("topic").isNotNull()).select("batch_id", "topic", "lag")
    merged = rows.join(times, "batch_id", "left").join(lags, ["batch_id", "topic"], "left")
    renewed = {"window_start": "progress_start", "window_end": "progress_end", "consumer_lag": "lag"}
    return merged.withColumns({c: F.coalesce(new, c) for c, new in renewed.items()}).select(
        *[c for c in rows.columns if c != "batch_id"])
