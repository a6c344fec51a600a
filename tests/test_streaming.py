import json
import os
import pathlib
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from aeroledger.operators import views
from aeroledger.plans.bindings import Tables
from aeroledger.schemas import LOGS
from aeroledger.sources import sinks, tables
from aeroledger.streaming import envelope, live


def event(event_id, key, when, status, kind="flight_status", **extra):
    payloads = {
        "flight_status": {"flight_id": key, "route_id": extra.get("route", "r"), "aircraft_id": "a", "status": status,
                          "scheduled_departure": "2024-01-01 06:00:00", "actual_departure": extra.get("actual"), "delay_minutes": extra.get("delay")},
        "baggage_scan": {"bag_id": key, "booking_id": "b", "airport": extra.get("airport", "X"), "status": status, "scan_time": f"2024-01-01 {when}"},
        "booking": {"booking_id": key, "customer_id": "c", "flight_id": "f", "fare": extra.get("fare", 10.0), "status": status, "booking_time": "2024-01-01 01:00:00"},
        "heartbeat": {"beat": 1}}
    topics = {"flight_status": "flights.status", "baggage_scan": "baggage.scans", "booking": "bookings.events", "heartbeat": "flights.status"}
    return {"event_id": event_id, "event_type": kind, "topic": topics[kind], "key": key, "event_time": f"2024-01-01 {when}", "payload": payloads[kind]}


class Stream:
    def __init__(self, spark, folder):
        self.spark, self.inbox, self.root, self.checkpoint = spark, f"{folder}/in", f"{folder}/out", f"{folder}/cp"
        os.makedirs(self.inbox)
        self.files = 0

    def send(self, *events):
        self.files += 1
        path = f"{self.inbox}/part-{self.files:04d}.json"
        with open(path, "w") as f:
            f.writelines((e if isinstance(e, str) else json.dumps(e)) + "\n" for e in events)
        os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))

    def run(self, per_trigger=None, run_id="r"):
        live.run_available(envelope.read_events(self.spark, "files", self.inbox, per_trigger), self.root, self.checkpoint, run_id)

    def state(self, kind="flight_status", *columns):
        df = live.live_table(self.spark, self.root, kind)
        return {r[0]: tuple(r)[1:] for r in df.select(df.columns[0], *columns).collect()}

    def counts(self):
        rows = live.monitoring(self.spark, self.root).groupBy("topic").agg(F.sum("processed"), F.sum("duplicates"), F.sum("errors")).collect()
        return {r[0]: tuple(r)[1:] for r in rows}


@pytest.fixture
def stream(spark, tmp_path):
    return Stream(spark, str(tmp_path))


def test_late_duplicate_and_broken_events_over_restarts(stream):
    stream.send(event("e1", "f1", "10:00:00", "BOARDING", delay=5.0, route="first"), event("e2", "f1", "09:00:00", "SCHEDULED", route="late"),
                event("e1", "f1", "10:00:00", "BOARDING"), event("e3", "g1", "10:00:00", "LOADED", "baggage_scan", airport="X"),
                event("e4", "g1", "10:00:00", "DELIVERED", "baggage_scan", airport="Y"), event("e3", "g1", "10:00:00", "LOADED", "baggage_scan"),
                '{"event_id": "e5", "event_ty', event("h1", "x", "10:00:00", "", "heartbeat"))
    stream.run()
    assert stream.state("flight_status", "status", "delay_minutes", "route_id") == {"f1": ("BOARDING", 5.0, "first")}
    assert stream.state("baggage_scan", "status", "airport") == {"g1": ("DELIVERED", "X")}   # tie: the later arrival wins
    lacking = event("e6", "k1", "10:00:00", "CONFIRMED", "booking")
    del lacking["payload"]["status"]
    wrong = event("e7", "k1", "10:00:00", "CONFIRMED", "booking", fare="cheap")
    nokey = event("e8", None, "10:00:00", "CONFIRMED", "booking")
    stream.send(event("e2", "f1", "09:00:00", "SCHEDULED"), event("e9", "f1", "10:00:00", "DEPARTED", route="third"),
                event("e10", "f1", "08:00:00", "OLD"), lacking, wrong, nokey, event("h1", "x", "10:00:00", "", "heartbeat"))
    stream.run()
    assert stream.state("flight_status", "status", "delay_minutes", "route_id") == {"f1": ("DEPARTED", None, "first")}
    assert stream.state("booking", "status") == {}
    problems = sorted(r.problem for r in live.dead_letters(stream.spark, stream.root).collect())
    assert problems == ["incomplete envelope", "payload key is null", "payload lacks status", "unreadable values"]
    assert stream.counts() == {"flights.status": (5, 3, 0), "baggage.scans": (2, 1, 0), "bookings.events": (0, 0, 3), "unknown": (0, 0, 1)}
    stream.send(event("e6", "k1", "11:00:00", "CONFIRMED", "booking"))     # a dead-lettered id may come back in good shape
    stream.run()
    assert stream.state("booking", "status") == {"k1": ("CONFIRMED",)}
    health = views.stream_health(live.monitoring(stream.spark, stream.root), live.ledger(stream.spark, stream.root)).first()
    assert (health.processed, health.duplicates, health.errors, health.delivered, health.unique_events) == (8, 4, 4, 16, 8)


def test_result_does_not_depend_on_batching_or_repetition(spark, tmp_path):
    rng = random.Random(5)
    events = [event(f"e{i}", f"f{rng.randrange(4)}", f"{rng.randrange(24):02d}:{i % 60:02d}:{i // 60:02d}", f"S{i}", delay=float(i)) for i in range(60)]
    results = []
    for n, files in enumerate((1, 4)):
        s = Stream(spark, str(tmp_path / f"s{n}"))
        delivered = events + ([] if n == 0 else rng.sample(events, 20))
        for i in range(files):
            s.send(*delivered[i * len(delivered) // files:(i + 1) * len(delivered) // files])
        s.run(per_trigger=1)
        results.append(s.state("flight_status", "status", "delay_minutes", "event_time", "route_id"))
    assert results[0] == results[1] and len(results[0]) == 4


def test_copies_of_one_event_shrink_before_the_state(stream):
    stream.send(*[event("hot", "f1", "10:00:00", "A")] * 500, *["not json"] * 300, event("e2", "f1", "11:00:00", "B"))
    raw = envelope.read_events(stream.spark, "files", stream.inbox)
    query = live.start_live_tables(raw, stream.root, stream.checkpoint, "r", available_now=True)
    query.awaitTermination()
    assert query.recentProgress[0]["stateOperators"][0]["customMetrics"]["numDroppedDuplicateRows"] < 50
    assert stream.counts() == {"flights.status": (2, 499, 0), "unknown": (0, 0, 300), "baggage.scans": (0, 0, 0), "bookings.events": (0, 0, 0)}
    assert stream.state("flight_status", "status") == {"f1": ("B",)}


def bucket_files(stream, name):
    root = pathlib.Path(stream.root, name)
    return {p.name: {(f.name, f.stat().st_mtime_ns) for f in p.glob("*.parquet")} for p in root.iterdir() if p.name.startswith("_part=")}


def test_live_table_has_a_row_per_key_and_changes_by_bucket(stream):
    stream.send(*[event(f"e{i}", f"f{i}", "10:00:00", "A", route="one") for i in range(12)])
    stream.run()
    before = bucket_files(stream, "fact_flight_status_live")
    assert len(before) > 1 and {p.rsplit("of", 1)[1] for p in before} == {"3"}
    stream.send(event("x1", "f1", "11:00:00", "B", route="two"), event("x2", "f1", "09:00:00", "OLD"))
    stream.run()
    after = bucket_files(stream, "fact_flight_status_live")
    assert sum(after[p] != before[p] for p in before) == 1 and set(after) == set(before)
    assert stream.state("flight_status", "status", "route_id")["f1"] == ("B", "one")
    stored = stream.spark.read.parquet(f"{stream.root}/fact_flight_status_live")
    assert stored.count() == stored.select("flight_id").distinct().count() == 12
    files = live.live_table(stream.spark, stream.root, "flight_status").inputFiles()
    assert files and not any("batch_id" in f for f in files) and len(files) <= 3


def test_bucket_count_of_a_table_never_changes(stream):
    for n, buckets in enumerate((4, 9)):
        part = stream.spark.sql(f"SELECT 'f{n}' AS flight_id, 'r' AS route_id, 'a' AS aircraft_id, timestamp '2024-01-01' AS scheduled_departure, "
                                "'S' AS status, CAST(NULL AS timestamp) AS actual_departure, 1D AS delay_minutes, timestamp '2024-01-01' AS event_time, "
                                f"timestamp '2024-01-01' AS _updated_at, {n}L AS _first_batch, {n}L AS _last_batch")
        assert all(p.endswith("of4") for p in live.merge_partial(part, "flight_status", stream.root, buckets))
    assert set(stream.state("flight_status", "status")) == {"f0", "f1"}


def test_replayed_batch_overwrites_its_own_output(stream):
    stream.send(event("e1", "f1", "10:00:00", "A"))
    raw = envelope.parse_events(stream.spark.read.text(stream.inbox).withColumn(
        "arrival", F.struct(F.lit("p").alias("part"), F.lit(0).cast("long").alias("block"), F.lit(1).cast("long").alias("pos"))))
    batch = raw.withColumn("kind", F.lit("event")).unionByName(
        raw.select("event_id").withColumn("kind", F.lit("fresh")), allowMissingColumns=True)
    body = live.apply_batch(stream.root, "r")
    body(batch, 7)
    once = stream.state("flight_status", "status", "event_time", "route_id")
    body(batch, 7)
    assert stream.state("flight_status", "status", "event_time", "route_id") == once and len(once) == 1
    assert live.ledger(stream.spark, stream.root).count() == 1 and stream.counts()["flights.status"] == (1, 0, 0)


def test_lag_and_windows_come_from_the_stream(stream):
    kafka = {"batchId": 0, "timestamp": "2024-01-01T10:00:00.000Z", "durationMs": {"triggerExecution": 1500}, "sources": [
        {"endOffset": {"flights.status": {"0": 7, "1": 5}, "baggage.scans": {"0": 3}},
         "latestOffset": {"flights.status": {"0": 10, "1": 5, "2": 4}, "baggage.scans": {"0": 3}}}]}
    assert live.lag_by_topic(kafka) == {"flights.status": 7, "baggage.scans": 0}
    as_text = {"sources": [{k: json.dumps(v) for k, v in kafka["sources"][0].items()}]}
    assert live.lag_by_topic(as_text) == live.lag_by_topic(kafka)
    assert live.lag_by_topic({"sources": [{"endOffset": {"logOffset": 3}, "latestOffset": None}, {"endOffset": None, "latestOffset": "4"}]}) == {}
    stream.send(event("e1", "f1", "10:00:00", "A"))
    query = live.start_live_tables(envelope.read_events(stream.spark, "files", stream.inbox), stream.root, stream.checkpoint, "r", available_now=True)
    query.awaitTermination()
    own = json.loads(query.recentProgress[0].json)
    live.record_progress(stream.spark, stream.root, own)
    rows = live.monitoring(stream.spark, stream.root)
    assert rows.columns == LOGS["stream_monitoring"].fieldNames() and {r.consumer_lag for r in rows.collect()} == {None}
    start = rows.agg(F.max(F.unix_millis("window_start"))).first()[0]
    assert start == int(datetime.fromisoformat(own["timestamp"].replace("Z", "+00:00")).timestamp() * 1000)
    live.record_progress(stream.spark, stream.root, kafka)   # the same batch reported by a source with topics
    again = {r.topic: (r.consumer_lag, r.seconds) for r in live.monitoring(stream.spark, stream.root).selectExpr(
        "topic", "consumer_lag", "unix_millis(window_end) - unix_millis(window_start) AS seconds").collect()}
    assert again == {"flights.status": (7, 1500), "baggage.scans": (0, 1500), "bookings.events": (None, 1500)}


def test_envelopes_round_trip_and_ids_are_stable(spark, tmp_path):
    flights = spark.sql("SELECT 'f1' AS flight_id, 'r' AS route_id, 'a' AS aircraft_id, 'BOARDING' AS status, "
                        "timestamp '2024-01-01 06:00:00.123456' AS scheduled_departure, CAST(NULL AS timestamp) AS actual_departure, 1.5D AS delay_minutes")
    bags = spark.sql("SELECT 'g' AS bag_id, 'b' AS booking_id, 'X' AS airport, 'LOADED' AS status, timestamp '2024-01-01 05:00:00' AS scan_time")
    feed = envelope.event_feed(flights, bags, ordered=True)
    assert [r.topic for r in feed.collect()] == ["baggage.scans", "flights.status"]
    assert feed.select("value").collect() == feed.select("value").collect()
    arrival = F.struct(F.lit("p").alias("part"), F.lit(0).cast("long").alias("block"), F.lit(1).cast("long").alias("pos"))
    parsed = envelope.parse_events(feed.select("value", arrival.alias("arrival")))
    assert parsed.filter("problem IS NOT NULL").count() == 0
    back = envelope.typed_events(parsed, "flight_status").first()
    assert back.scheduled_departure.microsecond == 123456 and back.actual_departure is None and back.delay_minutes == 1.5
    sinks.publish_events(feed, str(tmp_path / "topic"))
    assert tables.path_exists(spark, str(tmp_path / "topic"))


def test_unknown_source(spark):
    with pytest.raises(ValueError):
        envelope.read_events(spark, "pigeon", "x")


def test_rows_of_one_file_are_dealt_over_the_tasks(spark, tmp_path, rows):
    """A file of one row group is one split; making and parsing its envelopes must not be one task per branch."""
    events = spark.range(600).select(
        F.col("id").alias("event_id"), F.lit("2024-01-01 06:00:00").cast("timestamp_ntz").alias("ts"), (F.col("id") % 50).alias("user_id"),
        F.element_at(F.array(*map(F.lit, ("view", "error", "purchase"))), (F.col("id") % 3 + 1).cast("int")).alias("event_type"),
        (F.col("id") % 130).cast("double").alias("value"), F.lit("p").alias("props"))
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    session = live.stream_session(spark, 4)
    seen = []

    def look(batch, batch_id):
        spread = batch.withColumn("task", F.spark_partition_id())
        seen.extend((spread.groupBy("task").count().collect(), rows(batch)))

    query = Tables(session, str(tmp_path)).stream().writeStream.foreachBatch(look).option(
        "checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    tasks, streamed = seen
    assert len(tasks) == 12 and max(r["count"] for r in tasks) <= 100  # three branches over four tasks each; 3 tasks before
    assert streamed == rows(Tables.feed(events))
