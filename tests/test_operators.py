from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from aeroledger.operators import analytics, marts, ml, rotation

T0 = datetime(2024, 1, 1)


def at(hour, minute=0, day=1):
    return datetime(2024, 1, day, hour, minute)


FLIGHTS = "flight_id string, route_id string, aircraft_id string, scheduled_departure timestamp, actual_departure timestamp, status string, delay_minutes double"


@pytest.fixture(scope="module")
def legs(spark):
    return spark.createDataFrame([
        ("f1", "r", "a", at(6), at(6, 20), "COMPLETED", 20.0), ("f2", "r", "a", at(8), at(8, 30), "COMPLETED", 30.0),
        ("f3", "r", "a", at(9), None, "CANCELLED", None), ("f4", "r", "a", at(10), at(10, 5), "COMPLETED", 5.0),
        ("f6", "r", "a", at(11), at(11), "COMPLETED", 0.0), ("f5", "r", "a", at(11), at(12), "COMPLETED", 60.0),
        ("f7", "r", "a", at(0, 0, 2), at(0, 0, 2), "COMPLETED", 0.0), ("g1", "r", "b", at(7), at(7, 9), "COMPLETED", 9.0)], FLIGHTS)


@pytest.mark.parametrize("slice_rows", [2, 1_000_000])
def test_rotation(legs, slice_rows):
    out = {r.flight_id: r for r in rotation.rotation_delay_propagation(legs, history=True, slice_rows=slice_rows).collect()}
    brief = {f: (r.rotation_sequence, r.prev_flight_id, r.turnaround_minutes, r.propagated_delay_min, r.is_cascade_delay,
                 r.delay_propagation_flag, r.prev_is_cascade_delay) for f, r in out.items()}
    assert brief == {
        "f1": (1, None, None, 0.0, 0, "PRIMARY_DELAY", 0), "f2": (2, "f1", 100.0, 20.0, 1, "PROPAGATED", 0),
        "f3": (3, "f2", 30.0, 30.0, 0, "NO_DELAY", 1), "f4": (4, "f3", None, 0.0, 0, "PRIMARY_DELAY", 0),
        "f5": (5, "f4", 55.0, 5.0, 1, "PROPAGATED", 0), "f6": (6, "f5", -60.0, 60.0, 0, "NO_DELAY", 1),
        "f7": (1, None, None, 0.0, 0, "NO_DELAY", 0), "g1": (1, None, None, 0.0, 0, "PRIMARY_DELAY", 0)}
    assert out["f3"].delay_minutes == 0.0 and out["f1"].flight_date == date(2024, 1, 1)


def test_rotation_mart_and_counts(legs):
    r = rotation.rotation_delay_propagation(legs)
    assert tuple(rotation.rotation_counts(r).first()) == (8, 2)
    row = rotation.rotation_delay_mart(r).filter("aircraft_id = 'a' AND flight_date = '2024-01-01'").first()
    assert (row.total_flights, row.delayed_flights, row.cascade_delay_flights, row.average_delay_minutes,
            row.average_turnaround_minutes, row.total_propagated_delay_minutes) == (6, 4, 2, 19.17, 31.25, 115.0)


def test_delay_features(legs):
    base = rotation.rotation_delay_propagation(legs, history=True)
    fast = {r.flight_id: r.previous_cascade_indicator for r in ml.delay_features(base).collect()}
    slow = {r.flight_id: r.previous_cascade_indicator for r in ml.delay_features(base.drop("prev_is_cascade_delay")).collect()}
    leaky = {r.flight_id: r.previous_cascade_indicator for r in ml.delay_features(base, leak_free=False).collect()}
    assert fast == slow == {"f2": 0, "f3": 1, "f4": 0, "f5": 0, "f6": 1}
    assert leaky == {"f2": 1, "f3": 0, "f4": 0, "f5": 1, "f6": 0}
    row = ml.delay_features(base).filter("flight_id = 'f2'").first()
    assert (row.future_delay, row.previous_flight_delay, row.previous_flight_delayed, row.previous_departure_hour,
            row.scheduled_departure_hour, row.scheduled_departure_day, row.previous_propagated_delay) == (1, 20.0, 1, 6, 8, 0, 20.0)
    with pytest.raises(ValueError, match="turnaround_minutes"):
        ml.delay_features(base.drop("turnaround_minutes"))


@pytest.fixture(scope="module")
def facts(spark):
    flights = spark.createDataFrame([
        ("f1", "r1", "a1", "2024-01-01", "COMPLETED", 15.0), ("f2", "r1", "a9", "2024-01-01", "DEPARTED", 16.0),
        ("f3", "r1", "a1", "2024-01-01", "CANCELLED", None), ("f4", "r2", "a1", "2024-01-01", "BOARDING", None),
        ("f5", "r1", "a1", "2024-01-01", "CANCELLED", None)],
        "flight_id string, route_id string, aircraft_id string, scheduled_date_id string, status string, delay_minutes double")
    bookings = spark.createDataFrame([
        ("b1", "f1", 100.0, T0, "CONFIRMED"), ("b2", "f1", 50.25, T0, "COMPLETED"), ("b3", "f1", 70.0, T0, "REFUNDED"),
        ("b4", "f2", 10.0, at(5, 0, 2), "REFUNDED"), ("b5", "f4", 20.0, at(5, 0, 2), "CHECKED_IN"), ("b6", "f9", 5.0, T0, "CONFIRMED"),
        ("b7", "f1", 5.0, T0, None)], "booking_id string, flight_id string, fare double, booking_time timestamp, status string")
    aircraft = spark.createDataFrame([("a1", 100)], "aircraft_id string, seat_capacity int")
    return flights, bookings, aircraft


def test_load_factor(facts, rows):
    flights, bookings, aircraft = facts
    assert rows(marts.load_factor(flights, aircraft, bookings)) == [
        ("r1", "2024-01-01", 2, 2, 100, 0.02), ("r2", "2024-01-01", 1, 1, 100, 0.01)]


def test_delay_minutes_fifteen_is_on_time(facts, rows):
    assert rows(marts.delay_minutes(facts[0])) == [("r1", "2024-01-01", 2, 1, 15.5, 31.0, 50.0)]


def test_cancellation_rate_takes_smallest_of_tied_reasons(spark, facts, rows):
    c = spark.createDataFrame([("f3", "WX"), ("f5", "CREW")], "flight_id string, reason_code string")
    got = rows(marts.cancellation_rate(facts[0], c), "route_id", "scheduled_flights", "cancelled_flights", "top_reason_code",
               "cancellation_rate_pct")
    assert got == [("r1", 4, 2, "CREW", 50.0), ("r2", 1, 0, None, 0.0)]


def test_revenue_marts(facts, rows):
    flights, bookings, _ = facts
    assert rows(marts.route_revenue(bookings, flights), "route_id", "bookings", "route_revenue") == [("r1", 2, 150.25), ("r2", 1, 20.0)]
    assert rows(marts.revenue_per_flight(flights, bookings), "flight_id", "bookings", "flight_revenue", "avg_fare") == [
        ("f1", 2, 150.25, 75.13), ("f2", 0, None, None), ("f3", 0, None, None), ("f4", 1, 20.0, 20.0), ("f5", 0, None, None)]


def test_baggage_and_complaints(spark, rows):
    bags = spark.createDataFrame([("X", at(3), "DELAYED"), ("X", at(4), "LOADED"), ("X", at(4), None)], "airport string, scan_time timestamp, status string")
    assert rows(marts.baggage_sla(bags), "airport", "bags_scanned", "sla_breaches", "baggage_sla_pct") == [("X", 3, 1, 66.67)]
    tickets = spark.createDataFrame([(at(3), "LOST"), (at(4), "LOST"), (at(4, 0, 9), "LOST")], "created_at timestamp, issue_type string")
    bookings = spark.createDataFrame([(at(1),)] * 3, "booking_time timestamp")
    assert rows(marts.complaint_rate(tickets, bookings), "tickets", "bookings", "complaints_per_1000_bookings") == [(2, 3, 666.67)]


def test_hot_flight_is_one_row_before_the_join(facts):
    flights, bookings, _ = facts
    plan = marts.revenue_per_flight(flights, bookings)._jdf.queryExecution().optimizedPlan().toString()
    right = plan.split("Join LeftOuter")[1]
    assert "Aggregate [flight_id" in right


def test_profitability(spark, rows):
    flights = spark.createDataFrame([("f1", "rich", 0.0), ("f2", "even", 10.0), ("f3", "poor", None), (None, None, 1.0)],
                                    "flight_id string, route_id string, delay_minutes double")
    bookings = spark.createDataFrame([("f1", 50000.0), ("f2", 12000.0), ("f2", None)], "flight_id string, fare double")
    out = analytics.route_profitability(flights, bookings)
    got = [(r.route_id, r.estimated_profit, r.profit_margin_pct, r.profitability_status) for r in out.collect()]
    assert got == [("rich", 22500.0, 45.0, "HEALTHY"), ("even", 600.0, 5.0, "BREAK_EVEN"), ("poor", -5000.0, None, "LOSS")]


def test_bag_cycles(spark):
    scans = spark.createDataFrame([
        ("b1", at(1), None), ("b1", at(1, 45), "X"), ("b2", at(1), "Y"), ("b2", datetime(2024, 1, 1, 1, 45, 6), "Z"),
        ("b3", at(2), "Q"), ("b4", None, "Q"), (None, at(2), "Q"), ("b5", at(3), None)], "bag_id string, scan_time timestamp, airport string")
    got = {r.bag_id: (r.cycle_minutes, r.sla_status, r.airport) for r in analytics.baggage_cycle_sla(scans).collect()}
    assert got == {"b1": (45.0, "WITHIN_SLA", "X"), "b2": (45.1, "BREACH", "Y"), "b3": (0.0, "WITHIN_SLA", "Q"),
                   "b5": (0.0, "WITHIN_SLA", None)}


def test_passenger_experience_keeps_every_ticket_once(spark, rows):
    tickets = spark.createDataFrame([("t1", "b1", "LOST", "2024-01-01 10:00:00"), ("t2", "b9", "LOST", "bad"), ("t3", None, "LATE", None)],
                                    "ticket_id string, booking_id string, issue_type string, created_at string")
    bookings = spark.createDataFrame([("b1",), ("b1",)], "booking_id string")
    assert rows(analytics.passenger_experience(tickets, bookings), "ticket_id", "ticket_date") == [
        ("t1", date(2024, 1, 1)), ("t2", None), ("t3", None)]
    fares = spark.createDataFrame([("b1", 5.0), ("b1", 3.0)], "booking_id string, fare double")
    assert rows(analytics.passenger_experience(tickets, fares, ["fare"]), "ticket_id", "fare") == [("t1", 3.0), ("t2", None), ("t3", None)]
    assert [tuple(r) for r in analytics.issue_summary(tickets).collect()] == [
        ("LOST", 2, pytest.approx(200 / 3)), ("LATE", 1, pytest.approx(100 / 3))]


def test_demand_and_anomalies(spark, rows):
    flights = spark.createDataFrame([("f1", "r", date(2024, 1, 1)), ("f2", "r", date(2024, 1, 1)), ("f3", "r", None), ("f4", "s", date(2024, 1, 2))],
                                    "flight_id string, route_id string, flight_date date")
    bookings = spark.createDataFrame([("f1",), ("f1",), ("f2",)], "flight_id string")
    assert rows(analytics.route_demand_daily(flights, bookings)) == [(date(2024, 1, 1), "r", 3), (date(2024, 1, 2), "s", 0)]
    days = [("q", 1, 1)] + [("c", d, 2) for d in range(1, 4)] + [("s", d, 1) for d in range(1, 13)] + [("s", 13, 9)]
    events = [(r, datetime(2024, 1, d, 5)) for r, d, n in days for _ in range(n)] + [(None, at(5))]
    out = analytics.cancellation_anomalies(spark.createDataFrame(events, "route_id string, cancelled_at timestamp"))
    top = out.first()
    assert (top.route_id, top.cancellation_count, top.anomaly, top.severity) == ("s", 9, True, "HIGH")
    assert top.z_score == pytest.approx((9 - 21 / 13) / (64 / 13) ** 0.5, rel=1e-12)
    assert {(r.route_id, r.std, r.z_score, r.severity) for r in out.filter("route_id <> 's'").collect()} == {
        ("q", 0.0, 0.0, "NORMAL"), ("c", 0.0, 0.0, "NORMAL")}


def test_forecast_features_need_history(spark):
    def demand(route, days):
        return [(route, date.fromordinal(date(2024, 1, 1).toordinal() + d), d) for d in days]
    df = spark.createDataFrame(demand("short", range(20)) + demand("none", range(21)) + demand("long", range(0, 80, 2)),
                               "route_id string, flight_date date, booking_count long")
    out = ml.forecast_features(df).orderBy("flight_date").collect()
    assert {r.route_id for r in out} == {"long"} and len(out) == 26
    first = out[0]
    assert (first.day_index, first.lag_1, first.lag_7, first.lag_14, first.rolling_7) == (14, 26, 14, 0, 20.0)
    assert sum(r.is_train for r in out) == 20


def test_delay_model_learns_and_round_trips(spark, tmp_path):
    rows = spark.range(400).select(
        F.col("id").cast("string").alias("flight_id"), *[F.lit(0.0).alias(c) for c in ml.DELAY_FEATURES if c != "turnaround_minutes"],
        F.when(F.col("id") % 10 == 0, None).otherwise(F.when(F.col("id") % 4 == 0, 20.0).otherwise(90.0)).alias("turnaround_minutes"),
        ((F.col("id") % 4 == 0) | (F.col("id") % 10 == 0)).cast("int").alias("future_delay"))
    train, test = ml.stratified_split(rows)
    assert train.count() == 320 and train.join(test, "flight_id").count() == 0
    model = ml.train_delay_model(train, trees=20, depth=3)
    ml.save_model(model, str(tmp_path / "m"))
    scored = ml.score_delay(ml.load_model(str(tmp_path / "m")), test)
    report = {r["class"]: r for r in ml.classification_report(scored).collect()}
    assert report[1].f1 == 1.0 and report[0].accuracy == 1.0 and report[1].support + report[0].support == 80
    assert scored.filter("turnaround_minutes IS NULL").count() > 0
    assert ml.feature_importance(spark, model).first().feature == "turnaround_minutes"
    with pytest.raises(ValueError, match="single class"):
        ml.train_delay_model(train.withColumn("future_delay", F.lit(1)))


def test_delay_training_is_dealt_over_the_cores(spark, monkeypatch, rows):
    """Rows that AQE merged into one partition must not train in one task."""
    train = spark.range(20_000).select(
        *[(F.col("id") * (i + 3) % 17).alias(c) for i, c in enumerate(ml.DELAY_FEATURES)], (F.col("id") % 3 == 0).cast("int").alias("future_delay"))
    fed = []
    monkeypatch.setattr(ml.Pipeline, "fit", lambda self, df: fed.append(df))
    for given in (train.coalesce(1), train.limit(20_000)):
        ml.train_delay_model(given)
        assert fed[-1].rdd.getNumPartitions() == 20_000 // ml.LEAST_TASK_ROWS == 4
        assert max(fed[-1].groupBy(F.spark_partition_id()).count().toDF("p", "n").collect(), key=lambda r: r.n).n < 6_000
        assert rows(fed[-1], *train.columns) == rows(train)
    assert [r.x for r in fed[0].select(F.col("turnaround_minutes").alias("x")).collect()] == [
        r.x for r in fed[1].select(F.col("turnaround_minutes").alias("x")).collect()]


def test_classification_report_counts_unpredicted_classes(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (0, 0)], "future_delay int, predicted_delay int")
    got = {r["class"]: (r.precision, r.recall, r.f1, r.support) for r in ml.classification_report(df).collect()}
    assert got == {0: (pytest.approx(2 / 3), 1.0, 0.8, 2), 1: (0.0, 0.0, 0.0, 1)}


def test_demand_forecast_shape_and_recursion(spark):
    rows = [(r, date.fromordinal(date(2024, 1, 1).toordinal() + d), 10 * i + d % 7) for i, r in enumerate(["r1", "r2"]) for d in range(60)]
    forecast, metrics = ml.demand_forecast(spark.createDataFrame(rows, "route_id string, flight_date date, booking_count long"), trees=5, depth=4)
    got = forecast.collect()
    assert len(got) == 14 and min(r.forecast_date for r in got) == date(2024, 3, 1) and max(r.forecast_date for r in got) == date(2024, 3, 7)
    assert all(r.predicted_bookings >= 0 for r in got)
    assert {(r.route_id, r.train_rows, r.test_rows) for r in metrics.collect()} == {("r1", 39, 7), ("r2", 39, 7)}
    doc = analytics.analytics_metrics(spark, metrics, {"sla": 45})
    assert doc.filter("route_id IS NOT NULL").count() == 2 and doc.count() == 8
