from datetime import datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aeroledger.operators import quality as q

SLOW = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
NOW = datetime(2024, 3, 1, 12, 0, tzinfo=timezone.utc)


def test_reasons_and_their_order(spark):
    df = spark.createDataFrame([
        (None, "a", 1), (None, None, 2), ("k1", None, 3), ("k1", "b", 4), ("k2", "c", 5), ("k2", "c", 6), ("k3", "d", 7)],
        "id string, name string, pos int")
    flagged = {r.pos: r[q.REASON] for r in q.flag_rejects(df, ["id"], ["name", "absent"], ["pos"]).collect()}
    assert flagged == {1: "pk_null;", 2: "pk_null;name_null;duplicate_pk;", 3: "name_null;", 4: "duplicate_pk;",
                       5: "", 6: "duplicate_pk;", 7: ""}


@SLOW
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.integers(0, 2))), max_size=40),
       st.sampled_from([3, 10_000_000]))
def test_valid_and_rejected_partition_the_input(spark, pairs, slice_rows):
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(pairs)], "k int, v int, pos int")
    valid, rejected = q.validate_and_split(df, ["k"], ["v"], ["pos"], slice_rows)
    kept, bad = [r.pos for r in valid.collect()], [r.pos for r in rejected.collect()]
    assert sorted(kept + bad) == list(range(len(pairs)))
    seen = set()
    expected = []
    for i, (k, v) in enumerate(pairs):
        if k is not None and v is not None and k not in seen:
            expected.append(i)
        seen.add(k)
    assert sorted(kept) == expected


def test_composite_key(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 1, 3), (None, 1, 4)], "x string, y int, pos int")
    got = {r.pos: r[q.REASON] for r in q.flag_rejects(df, ["x", "y"], [], ["pos"]).collect()}
    assert got == {1: "", 2: "", 3: "duplicate_pk;", 4: "pk_null;"}


def test_bronze_to_silver_cascades_and_keeps_failed_rows(spark):
    flights = spark.createDataFrame([
        ("f1", "r1", "a1", "COMPLETED", None, NOW, 1), ("f2", "r9", "a1", "COMPLETED", 3.0, NOW, 2),
        ("f3", "r1", None, "COMPLETED", 3.0, NOW, 3), ("f4", "r1", "a1", "LOST", 3.0, NOW, 4),
        ("f5", "r1", "a1", "CANCELLED", -1.0, NOW, 5), ("f1", "r1", "a1", "COMPLETED", 0.0, NOW, 6),
        ("f6", "r1", "a1", None, 0.0, NOW, 7), ("f7", "r1", "a1", "CANCELLED", 0.0, None, 8), ("f2", "r1", "a1", "DEPARTED", 1.0, NOW, 9)],
        "flight_id string, route_id string, aircraft_id string, status string, delay_minutes double, "
        "scheduled_departure timestamp, pos int")
    parents = {"routes": spark.createDataFrame([("r1",), ("r1",)], "route_id string"),
               "aircraft": spark.createDataFrame([("a1",)], "aircraft_id string")}
    out = q.bronze_to_silver(flights, q.ENTITY_RULES["flights"], parents, ["pos"])
    assert {r.pos: r[q.REASON] for r in out.collect()} == {
        1: "", 2: "ref_missing;", 3: "ref_missing;", 4: "rule_failed;", 5: "rule_failed;", 6: "duplicate_pk;",
        7: "rule_failed;", 8: "scheduled_departure_null;", 9: ""}
    report = q.reject_report({"flights": out}).first()
    assert tuple(report) == ("flights", 9, 2, 7)


def test_fares_skip_the_key_test_and_null_price_fails(spark):
    fares = spark.createDataFrame([("r1", 10.0, 1), ("r1", 10.0, 2), ("r1", None, 3), ("r1", 0.0, 4), (None, 5.0, 5)],
                                  "route_id string, price double, pos int")
    out = q.bronze_to_silver(fares, q.ENTITY_RULES["fares"], {"routes": fares.limit(0).unionByName(fares.filter("pos=1"))}, ["pos"])
    assert {r.pos: r[q.REASON] for r in out.collect()} == {1: "", 2: "", 3: "rule_failed;", 4: "rule_failed;", 5: "ref_missing;"}


def test_referential_filter_drops_null_and_unknown(spark, rows):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id int, fk int")
    assert rows(q.referential_filter(child, [("fk", spark.createDataFrame([(1,), (1,)], "k int"), "k")]), "id") == [(1,)]


def test_derive_cancellations(spark, rows):
    f = spark.createDataFrame([("a", "CANCELLED", NOW), ("b", "COMPLETED", NOW)], "flight_id string, status string, scheduled_departure timestamp")
    assert rows(q.derive_cancellations(f), "flight_id", "reason_code") == [("a", "UNSPECIFIED")]


def tables(spark):
    return {
        "fact_flight": spark.createDataFrame([("f1", "r1", "COMPLETED", 5.0), ("f1", "r1", "COMPLETED", None), (None, "rX", "ODD", -2.0),
                                              ("f3", None, None, 1.0)],
                                             "flight_id string, route_id string, status string, delay_minutes double"),
        "dim_route": spark.createDataFrame([("r1",)], "route_id string"),
        "fact_booking": spark.createDataFrame([("b1", "f1", "c1", 10.0), ("b2", "f9", "c1", 0.0), ("b3", None, "c2", 5.0)],
                                              "booking_id string, flight_id string, customer_id string, fare double"),
        "dim_customer": spark.createDataFrame([("c1",)], "customer_id string"),
        "fact_baggage": spark.createDataFrame([("b1",), ("b7",)], "booking_id string"),
    }


def test_suite_counts_violations_and_skips_missing_tables(spark):
    got = {r.check_name: (r.violations, r.status) for r in q.dq_suite(tables(spark)).collect()}
    assert got == {
        "null_pk_fact_flight": (1, "FAIL"), "range_delay_minutes_negative": (1, "FAIL"), "valid_flight_status": (1, "FAIL"),
        "dup_pk_fact_flight": (1, "FAIL"), "ref_integrity_flight_to_route": (2, "FAIL"), "null_pk_fact_booking": (0, "PASS"),
        "range_fare_non_positive": (1, "FAIL"), "dup_pk_fact_booking": (0, "PASS"), "ref_integrity_booking_to_flight": (2, "FAIL"),
        "ref_integrity_booking_to_customer": (1, "FAIL"), "ref_integrity_baggage_to_booking": (1, "FAIL")}
    with pytest.raises(RuntimeError, match="3/11|2/11"):
        q.enforce_gate(q.dq_suite(tables(spark)))


def test_gate_passes(spark):
    results = spark.createDataFrame([("a", "PASS"), ("b", "PASS")], "check_name string, status string")
    assert q.enforce_gate(results) == (2, 2)


def test_generic_tests_ignore_nulls_where_the_key_checks_do_not(spark, rows):
    t = tables(spark)
    assert rows(q.broken_relationships(t["fact_booking"], "flight_id", t["fact_flight"], "flight_id")) == [("f9", 1)]
    assert q.orphan_count(t["fact_booking"], "flight_id", t["fact_flight"], "flight_id").first()[0] == 2
    assert rows(q.unaccepted_values(t["fact_flight"], "status", ["COMPLETED"])) == [("ODD", 1)]
    assert rows(q.uniqueness_violations(t["fact_flight"], "flight_id")) == [("f1", 2)]
    assert q.null_violations(t["fact_flight"], "flight_id").count() == 1
    assert q.negative_values(t["fact_flight"], "delay_minutes").count() == 1


def test_stream_checks(spark):
    empty = spark.createDataFrame([], "window_end timestamp, processed long, duplicates long, errors long")
    ledger = spark.createDataFrame([("a",), ("a",)], "event_id string")
    got = {r.check_name: r.status for r in q.stream_checks(F.lit(NOW), empty, ledger).collect()}
    assert got == {"stream_freshness_minutes_ok": "PASS", "stream_error_rate_ok": "PASS", "stream_dedup_ledger_unique": "FAIL"}
    late = spark.createDataFrame([(datetime(2024, 3, 1, 11, 29), 90, 4, 6)], empty.schema)
    got = {r.check_name: r.status for r in q.stream_checks(F.lit(NOW), late).collect()}
    assert got == {"stream_freshness_minutes_ok": "FAIL", "stream_error_rate_ok": "FAIL"}
    assert q.stream_checks(F.lit(NOW)) is None


def test_freshness(spark):
    def status(loaded):
        df = spark.createDataFrame([(loaded,)] if loaded else [], "_ingested_at timestamp")
        return tuple(q.load_freshness(df, F.lit(NOW)).select("hours_since_load", "status").first())
    assert status(datetime(2024, 2, 29, 13, 59)) == (23, "PASS")
    assert status(datetime(2024, 2, 29, 12, 0)) == (24, "FAIL")
    assert status(None) == (None, "FAIL")


def test_volume(spark, rows):
    df = spark.createDataFrame([("d1",)] * 10 + [("d2",)] * 10 + [("d3",)], "scheduled_date_id string")
    assert rows(q.volume_by_day(df), "scheduled_date_id", "flag") == [("d1", "OK"), ("d2", "OK"), ("d3", "LOW_VOLUME_ALERT")]
    assert rows(q.low_volume_days(df)) == [("d3", 1)]


def test_profile_and_dataset_quality(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (None, None)], "a int, b string")
    assert tuple(q.profile(df, "d").first()) == ("d", 4, 2, 3, 1)
    got = q.dataset_quality(spark, {"d": df, "e": df.limit(0), "m": None})
    assert {r.dataset: (r.rows, r.null_values, r.duplicate_rows, r.status) for r in got.collect()} == {
        "d": (4, 4, 1, "CHECK"), "e": (0, 0, 0, "PASS"), "m": (0, None, None, "MISSING")}
    assert q.overall_quality(got).first()[0] == "CHECK"


@pytest.mark.parametrize("digest", [q.row_digest, lambda columns: F.struct((F.length(columns[1]) % 2).alias("weak"))])
def test_profile_with_digests_that_collide(spark, digest):
    rows_ = [(i % 40 if i % 40 != 7 else None, "x" * (i % 4) if i % 9 else None, float("nan") if i % 5 == 0 else -0.0 if i % 5 == 1 else 0.0)
             for i in range(300)]
    df = spark.createDataFrame(rows_, "a int, b string, `c d` double").repartition(5)
    seen = {tuple("nan" if v != v else v for v in r) for r in rows_}
    got = q._profiled(df, digest).first()
    nulls = [sum(v is None for v in r) for r in rows_]
    assert tuple(got) == (300, sum(nulls), sum(n > 0 for n in nulls), 300 - len(seen))
    assert tuple(q._profiled(df.limit(0), digest).first()) == (0, 0, 0, 0)


def test_profile_of_distinct_rows_shuffles_digests_only(spark):
    df = spark.range(20_000).select("id", F.repeat(F.sha2(F.col("id").cast("string"), 256), 20).alias("wide"))
    assert tuple(q._profiled(df).first()) == (20_000, 0, 0, 0)
    plan = q._profiled(df)._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning(_digest" in line]
    assert exchanged and "wide" not in plan.split("Subquery")[0].split("Exchange hashpartitioning(_digest")[0]


def test_unreadable_dataset_is_an_error_of_its_own(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("good", "broken", "twice", "gone")}
    spark.range(3).write.parquet(paths["good"])
    spark.range(2).union(spark.range(2)).write.parquet(paths["twice"])
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"PAR1 this is no table PAR1")
    got = q.dataset_states(spark, paths)
    rows_ = {r.dataset: r for r in got.collect()}
    assert {n: (r.dataset_exists, r.rows, r.null_values, r.duplicate_rows, r.status) for n, r in rows_.items()} == {
        "good": (True, 3, 0, 0, "PASS"), "broken": (True, 0, None, None, "ERROR"), "twice": (True, 4, 0, 2, "CHECK"),
        "gone": (False, 0, None, None, "MISSING")}
    assert rows_["broken"].error and all(r.error is None for n, r in rows_.items() if n != "broken")
    assert q.overall_quality(got).first()[0] == "CHECK"


def test_model_tests_cover_marts(spark):
    mart = spark.createDataFrame([("r", None)], "route_id string, load_factor double")
    got = {r.check_name: r.status for r in q.model_tests({"mart_load_factor": mart}).collect()}
    assert got == {"not_null_mart_load_factor_route_id": "PASS", "not_null_mart_load_factor_load_factor": "FAIL"}
