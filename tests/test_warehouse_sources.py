import csv
from datetime import datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aeroledger.operators import quality, warehouse
from aeroledger.plans import medallion
from aeroledger.schemas import BRONZE, LOGS, ROTATION
from aeroledger.session import checkpointed, scratch_path, shared_dir
from aeroledger.sources import partitions, sinks, tables

NOW = datetime(2024, 3, 1, 12, 0, tzinfo=timezone.utc)
SLOW = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def kv(spark, d):
    return spark.createDataFrame(list(d.items()), "k int, v int")


@SLOW
@given(st.dictionaries(st.integers(0, 6), st.one_of(st.none(), st.integers())), st.dictionaries(st.integers(3, 9), st.one_of(st.none(), st.integers())))
def test_upsert_is_a_dictionary_update_and_idempotent(spark, target, source):
    target = {k: v if v is None else v % 100 for k, v in target.items()}
    source = {k: v if v is None else v % 100 for k, v in source.items()}
    once = warehouse.upsert(kv(spark, target), kv(spark, source), ["k"])
    assert {r.k: r.v for r in once.collect()} == {**target, **source}
    twice = warehouse.upsert(once, kv(spark, source), ["k"])
    assert sorted(twice.collect()) == sorted(once.collect(), key=tuple) or {r.k: r.v for r in twice.collect()} == {**target, **source}


def test_load_table_logs_rebuilds_and_refuses_repeated_keys(spark, tmp_path):
    root = str(tmp_path)
    warehouse.create_schema(spark, root)
    stamp = "'f' AS _source_file, 'b' AS _batch_id, timestamp '2024-01-01' AS _ingested_at"
    first = spark.sql(f"SELECT 'a1' AS aircraft_id, 'jet' AS type, 100 AS seat_capacity, {stamp}")
    second = spark.sql(f"SELECT * FROM VALUES ('a1', CAST(NULL AS string), 120), ('a2', 'prop', 50) AS t(aircraft_id, type, seat_capacity)").selectExpr("*", *stamp.split(", "))
    assert warehouse.load_table(spark, root, "dim_aircraft", first, "r1") == 1
    assert warehouse.load_table(spark, root, "dim_aircraft", second, "r2") == 2
    assert warehouse.load_table(spark, root, "dim_aircraft", second.limit(0), "r3") == 0
    now = {r.aircraft_id: (r.type, r.seat_capacity) for r in warehouse.warehouse_tables(spark, root)["dim_aircraft"].collect()}
    assert now == {"a1": (None, 120), "a2": ("prop", 50)}
    with pytest.raises(ValueError, match="repeats key"):
        warehouse.load_table(spark, root, "dim_aircraft", first.union(first), "r4")
    log = {r.run_id: (r.status, r.rows_affected, r.error_message) for r in tables.read_table(spark, f"{root}/pipeline_run_log").collect()}
    assert log["r2"] == ("SUCCESS", 2, None) and log["r3"] == ("SUCCESS", 0, "no rows") and log["r4"][0] == "FAILED"
    assert [r.run_id for r in warehouse.failed_runs(tables.read_table(spark, f"{root}/pipeline_run_log")).collect()] == ["r4"]
    warehouse.create_schema(spark, root, rebuild=True)
    assert warehouse.warehouse_tables(spark, root)["dim_aircraft"].count() == 0
    assert "dim_aircraft" in warehouse.register_views(spark, root)


BOOKED = "booking_id string, customer_id string, flight_id string, fare double, booking_time timestamp, status string"


def booked(spark, rows_):
    """Bookings from (id, fare, day of January or None)."""
    made = [(i, "c", "f", fare, datetime(2024, 1, day, 10) if day else None, "CONFIRMED") for i, fare, day in rows_]
    return quality.add_audit_columns(spark.createDataFrame(made, BOOKED), "f", "b", NOW)


def file_times(folder):
    return {p.name: {(f.name, f.stat().st_mtime_ns) for f in p.glob("*.parquet")} for p in folder.iterdir() if p.name.startswith("_part=")}


def fares(spark, root):
    return {r.booking_id: (r.fare, r.booking_time.day if r.booking_time else None)
            for r in warehouse.warehouse_tables(spark, root)["fact_booking"].collect()}


def test_second_load_rewrites_only_touched_days(spark, tmp_path):
    root, folder = str(tmp_path), tmp_path / "fact_booking"
    warehouse.create_schema(spark, root)
    warehouse.load_table(spark, root, "fact_booking", booked(spark, [(f"b{i}", 1.0, 1 + i % 5) for i in range(20)] + [("n", 1.0, None), ("lone", 1.0, 20)]), "r1")
    first = file_times(folder)
    assert sorted(first) == [*[f"_part=2024-01-0{d}" for d in range(1, 6)], "_part=2024-01-20", "_part=none"]
    # b0 changes in its day, b1 moves from day 2 to day 9, "lone" leaves a day that is empty then, "new" comes to day 3.
    assert warehouse.load_table(spark, root, "fact_booking", booked(spark, [("b0", 2.0, 1), ("b1", 3.0, 9), ("lone", 4.0, None), ("new", 5.0, 3)]), "r2") == 4
    second = file_times(folder)
    assert {p for p in first if second.get(p) != first[p]} == {"_part=2024-01-01", "_part=2024-01-02", "_part=2024-01-03", "_part=2024-01-20", "_part=none"}
    assert "_part=2024-01-20" not in second and "_part=2024-01-09" in second
    want = {f"b{i}": (1.0, 1 + i % 5) for i in range(20)} | {"n": (1.0, None), "b0": (2.0, 1), "b1": (3.0, 9), "lone": (4.0, None), "new": (5.0, 3)}
    assert fares(spark, root) == want
    plan = partitions.read(spark, str(folder), warehouse.WAREHOUSE["fact_booking"], ["2024-01-01"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_part" in plan.replace("isnotnull(_part#", "_part#") or "_part" in plan.split("PartitionFilters")[1].split("]")[0]


def test_load_computes_its_source_once(spark, tmp_path):
    root, rows_ = str(tmp_path), booked(spark, [("a", 1.0, 1), ("b", 1.0, 2), ("c", 1.0, None)])
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    source = rows_.mapInArrow(count, rows_.schema)
    for n, run in enumerate(("r1", "r2"), 1):  # into an empty table, and over rows that are there
        assert warehouse.load_table(spark, root, "fact_booking", source, run) == 3 and made.value == 3 * n
        assert fares(spark, root) == {"a": (1.0, 1), "b": (1.0, 2), "c": (1.0, None)}
    assert not tables.path_exists(spark, f"{root}/fact_booking_incoming")
    with pytest.raises(ValueError):
        warehouse.load_table(spark, root, "fact_booking", source.unionByName(source), "r3")
    assert not tables.path_exists(spark, f"{root}/fact_booking_incoming") and len(fares(spark, root)) == 3


def test_many_keys_do_not_sort_the_target(spark, rows):
    target, source = (spark.createDataFrame(r, "k long, v string") for r in ([(1, "a"), (2, "b"), (None, "c")], [(2, "x"), (3, "y")]))
    out = warehouse.upsert(target, source, ["k"], many=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert rows(out) == rows(warehouse.upsert(target, source, ["k"])) and out.count() == 4


def test_interrupted_load_is_made_good(spark, tmp_path, monkeypatch):
    root, path = str(tmp_path), str(tmp_path / "fact_booking")
    warehouse.load_table(spark, root, "fact_booking", booked(spark, [("a", 1.0, 1), ("b", 1.0, 2)]), "r1")
    real = partitions._overwrite

    def dies(rows_, where):  # the driver ends after a partition is gone and before its new state is there
        tables.delete_folder(spark, f"{where}/_part=2024-01-01")
        raise KeyboardInterrupt

    monkeypatch.setattr(partitions, "_overwrite", dies)
    with pytest.raises(KeyboardInterrupt):
        warehouse.load_table(spark, root, "fact_booking", booked(spark, [("a", 2.0, 1)]), "r2")
    monkeypatch.setattr(partitions, "_overwrite", real)
    assert partitions.settle(spark, path, warehouse.WAREHOUSE["fact_booking"]) is True
    assert fares(spark, root) == {"a": (2.0, 1), "b": (1.0, 2)}
    # One that ends before its new state is complete leaves the table as it was.
    sinks.write_table(spark.range(3), f"{path}_pending/rows")
    assert partitions.settle(spark, path, warehouse.WAREHOUSE["fact_booking"]) is False
    warehouse.load_table(spark, root, "fact_booking", booked(spark, [("c", 3.0, 2)]), "r3")
    assert fares(spark, root) == {"a": (2.0, 1), "b": (1.0, 2), "c": (3.0, 2)}


def test_lookup_helpers(spark, tmp_path):
    base, schema = str(tmp_path), kv(spark, {}).schema
    sinks.write_table(kv(spark, {1: 1}), f"{base}/old_Flights_v1.parquet")
    assert tables.find_table(spark, base, "flights").count() == 1
    assert tables.find_table(spark, base, "bags", schema).columns == ["k", "v"]
    with pytest.raises(FileNotFoundError):
        tables.find_table(spark, base, "bags", required=True)
    assert tables.read_optional(spark, f"{base}/x", schema).count() == 0
    assert tables.read_first(spark, [f"{base}/x", f"{base}/old_Flights_v1.parquet"]).count() == 1
    with pytest.raises(FileNotFoundError):
        tables.read_first(spark, [f"{base}/x"])
    with pytest.raises(FileNotFoundError, match="x"):
        tables.require_datasets(spark, {"x": f"{base}/x"})
    got = tables.dataset_presence(spark, {"a": base, "b": f"{base}/x"}).collect()
    assert [r.dataset_exists for r in got] == [True, False]
    sinks.write_table(kv(spark, {2: 2}), f"{base}/sub/more.parquet")
    assert tables.read_folder(spark, base).count() == 2


def test_sinks(spark, tmp_path):
    base = str(tmp_path)
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "k int, day string")
    sinks.write_partitioned(df, f"{base}/p", "day")
    back = tables.read_table(spark, f"{base}/p").filter("day = '2024-01-02'")
    assert back.count() == 1 and "PartitionFilters: [isnotnull(day" in back._jdf.queryExecution().executedPlan().toString()
    assert sinks.write_rejects(df.limit(0), f"{base}/r") is False and not tables.path_exists(spark, f"{base}/r")
    assert sinks.write_rejects(df, f"{base}/r") is True
    sinks.write_json(df, f"{base}/j")
    assert spark.read.json(f"{base}/j").count() == 2
    df.createOrReplaceTempView("exported")
    assert sinks.export_tables(spark, ["exported"], f"{base}/e") == {"exported": f"{base}/e/exported"}
    assert warehouse.snapshot_tables(spark, {"exported": f"{base}/e/exported"}, f"{base}/s") == {"exported": 2}
    sinks.publish_events(df.selectExpr("'t' AS topic", "'k' AS key", "day AS value"), f"{base}/ev")
    assert spark.read.json(f"{base}/ev").count() == 2
    sinks.append_log(spark, "stream_monitoring", [("r", "t", NOW, NOW, 1, 2, 3, None)], f"{base}/log")
    sinks.append_log(spark, "stream_monitoring", [("r", "t", NOW, NOW, 1, 2, 3, None)], f"{base}/log")
    assert tables.read_table(spark, f"{base}/log").schema == LOGS["stream_monitoring"] and tables.read_table(spark, f"{base}/log").count() == 2


def test_catalog_table_replace(spark):
    sinks.replace_table(kv(spark, {1: 1}), "replaced_numbers")
    sinks.replace_table(kv(spark, {1: 1, 2: 2}), "replaced_numbers")
    assert spark.table("replaced_numbers").count() == 2
    spark.sql("DROP TABLE replaced_numbers")


class FakeSession:
    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "fake"})


def test_shared_dir_follows_the_session_setting(spark):
    assert shared_dir(FakeSession("spark://x", "hdfs://shared/")) == "hdfs://shared"
    assert scratch_path(FakeSession("spark://x", "hdfs://shared"), "x").startswith("hdfs://shared/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession("spark://x"))
    assert shared_dir(FakeSession("local[2]")) == shared_dir(FakeSession("local[2]"))
    assert checkpointed(kv(spark, {1: 1})).count() == 1


def bronze(folder):
    def write(name, rows_):
        with open(folder / f"{name}.csv", "w", newline="") as f:
            out = csv.writer(f)
            out.writerow(BRONZE[name].fieldNames())
            out.writerows(rows_)
    write("airports", [("X", "c", "r", 10), ("Y", "c", "r", 10), ("X", "c2", "r", 11), ("Z", "", "r", 1)])
    write("aircraft", [("a1", "jet", 100), ("a2", "jet", 120)])
    write("routes", [("r1", "X", "Y", 0.5), ("r2", "X", "Z", 0.5), ("r3", "Y", "X", 0.5)])
    write("customers", [("c1", "n", "GOLD", "r")])
    write("dim_date", [("2024-01-01", "2024-01-01", 2024, 1, 1, "Monday", "false")])
    flights = []
    for i in range(60):
        late = i % 3 == 1
        status = "CANCELLED" if i % 20 == 19 else "COMPLETED"
        flights.append((f"f{i}", "r1" if i % 2 else "r3", f"a{i % 2 + 1}", f"2024-01-{i // 6 + 1:02d} {i % 6 * 3:02d}:00:00",
                        "" if status == "CANCELLED" else f"2024-01-{i // 6 + 1:02d} {i % 6 * 3:02d}:{30 if late else 0:02d}:00", status,
                        "" if status == "CANCELLED" else 30.0 if late else 0.0))
    write("flights", flights + [("f0", "r1", "a1", "2024-01-01 05:00:00", "", "COMPLETED", 0.0), ("f98", "r2", "a1", "2024-01-01 05:00:00", "", "COMPLETED", 0.0),
                                ("f99", "r1", "a1", "", "", "COMPLETED", 0.0)])
    write("bookings", [(f"b{i}", "c1", f"f{i % 60}", 100.5, "2024-01-01 01:00:00", "REFUNDED" if i % 9 == 0 else "CONFIRMED") for i in range(120)]
          + [("b900", "c1", "f98", 10.0, "2024-01-01 01:00:00", "CONFIRMED"), ("b901", "c1", "f1", -1.0, "2024-01-01 01:00:00", "CONFIRMED")])
    write("baggage", [(f"g{i}", f"b{i}", "2024-01-01 02:00:00", "X", "DELAYED" if i % 5 == 0 else "LOADED") for i in range(20)]
          + [("g90", "b900", "2024-01-01 02:00:00", "X", "LOADED"), ("g91", "b1", "2024-01-01 02:00:00", "Z", "LOADED")])
    write("support_tickets", [("t1", "b1", "LOST", "2024-01-01 09:00:00"), ("t2", "b1", "", "2024-01-01 09:00:00")])
    write("fares", [("r1", "ECO", "2024-01-01 00:00:00", 50.0), ("r1", "ECO", "2024-01-02 00:00:00", 0.0)])


def test_whole_batch(spark, tmp_path):
    raw = tmp_path / "bronze"
    raw.mkdir()
    bronze(raw)
    root = str(tmp_path / "run")
    run_id = medallion.run_batch(spark, str(raw), root, now=NOW, trees=5)
    report = {r.entity: (r.raw_rows, r.valid_rows, r.rejected_rows) for r in medallion.ingest_report(spark, f"{root}/silver").collect()}
    assert report == {"airports": (4, 2, 2), "aircraft": (2, 2, 0), "routes": (3, 2, 1), "customers": (1, 1, 0), "dim_date": (1, 1, 0),
                      "flights": (63, 60, 3), "bookings": (122, 120, 2), "baggage": (22, 20, 2), "support_tickets": (2, 1, 1), "fares": (2, 1, 1)}
    reasons = {r.flight_id: r[quality.REASON] for r in medallion.reject_table(spark, f"{root}/silver", "flights").collect()}
    assert reasons == {"f0": "duplicate_pk;", "f98": "ref_missing;", "f99": "scheduled_departure_null;"}
    house = warehouse.warehouse_tables(spark, f"{root}/warehouse")
    counts = {r.table_name: r.n_rows for r in tables.row_counts(house).collect()}
    assert counts["fact_flight"] == 60 and counts["fact_booking"] == 120 and counts["fact_cancellation"] == 3
    audit = tables.read_table(spark, f"{root}/run_audit")
    assert {r.status for r in audit.collect()} == {"SUCCESS"} and audit.count() == 9 and audit.first().run_id == run_id
    log = tables.read_table(spark, f"{root}/warehouse/dq_check_log")
    assert log.count() == 14 and log.filter("status = 'FAIL'").count() == 0
    out = f"{root}/outputs"
    assert tables.read_table(spark, f"{out}/mart_revenue_per_flight").count() == 60
    written = tables.read_table(spark, f"{out}/mart_rotation_delay_propagation")
    assert set(written.columns) == set(ROTATION.fieldNames()) and "flight_date" in written.columns
    assert warehouse.load_rotation_mart(spark, f"{out}/mart_rotation_delay_propagation", f"{root}/warehouse") == 60
    marts_ = {n: tables.read_table(spark, f"{out}/{n}") for n in ("mart_load_factor", "mart_revenue_per_flight", "mart_rotation_delay")}
    assert quality.model_tests(marts_).filter("status = 'FAIL'").count() == 0
    assert tables.read_table(spark, f"{out}/alerts").filter("alert_type = 'DELAY_RISK'").count() > 0
    # A second load of the same input changes nothing.
    silver = {e: medallion.silver_table(spark, f"{root}/silver", e) for e in quality.ENTITY_RULES}
    warehouse.load_warehouse(spark, f"{root}/warehouse", silver, "again")
    assert warehouse.warehouse_tables(spark, f"{root}/warehouse")["fact_booking"].count() == 120


def test_stages_stop_at_the_first_failure(spark, tmp_path):
    done = []

    def fail():
        raise ValueError("no input")

    with pytest.raises(ValueError):
        medallion.run_stages(spark, {"a": lambda: done.append(1), "b": fail, "c": lambda: done.append(2)}, f"{tmp_path}/audit", "r")
    got = {r.stage: (r.status, r.error) for r in tables.read_table(spark, f"{tmp_path}/audit").collect()}
    assert done == [1] and got == {"a": ("SUCCESS", None), "b": ("FAILED", "no input")}


def test_batch_forecasts_demand(spark, tmp_path):
    raw = tmp_path / "bronze"
    raw.mkdir()
    bronze(raw)
    with open(raw / "flights.csv", "a", newline="") as f:
        csv.writer(f).writerows((f"x{i}", "r1", "a1", f"2024-{2 + i // 28:02d}-{1 + i % 28:02d} 01:00:00", "", "COMPLETED", 0.0)
                                for i in range(50))
    with open(raw / "bookings.csv", "a", newline="") as f:
        csv.writer(f).writerows((f"y{i}-{k}", "c1", f"x{i}", 10.0, "2024-01-01 01:00:00", "CONFIRMED")
                                for i in range(50) for k in range(1 + i % 7))
    root = str(tmp_path / "run")
    medallion.run_batch(spark, str(raw), root, now=NOW, trees=3, demand_trees=3)
    out = f"{root}/outputs"
    assert tables.read_table(spark, f"{out}/demand_forecast").count() == 7
    assert tables.read_table(spark, f"{out}/alerts").filter("alert_type = 'DEMAND_SURGE'").count() > 0
    assert spark.read.json(f"{out}/analytics_metrics").filter("route_id = 'r1'").count() == 1
    medallion.validate_outputs(spark, out)
    with pytest.raises(Exception, match="demand_forecast"):
        medallion.validate_outputs(spark, f"{root}/silver")
    with pytest.raises(Exception, match="fares"):
        medallion.run_batch(spark, str(tmp_path / "none"), f"{root}2", now=NOW)
