from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from aeroledger.operators import notifications as n
from aeroledger.operators import rules as r
from aeroledger.operators import views as v

NOW = datetime(2024, 1, 1, 9, 0, tzinfo=timezone.utc)


def test_delay_actions_branches(spark):
    df = spark.createDataFrame([
        ("a", 0.70, 1, 10.0, 99.0), ("b", 0.71, 0, 59.0, 0.0), ("c", 0.9, 0, 60.0, 0.0), ("d", 0.9, 0, None, 0.0),
        ("e", 0.40, 1, 1.0, 31.0), ("f", 0.69, 1, 1.0, 30.0), ("g", 0.39, 1, 1.0, 99.0), ("h", None, 1, 1.0, 99.0)],
        "flight_id string, delay_probability double, previous_cascade_indicator int, turnaround_minutes double, previous_flight_delay double")
    out = r.delay_actions(df)
    assert {x.flight_id: (x.risk_level, x.priority, x.automation_action) for x in out.collect()} == {
        "a": ("HIGH", 1, "URGENT_OPERATIONS_REVIEW"), "b": ("HIGH", 1, "AIRCRAFT_TURNAROUND_ALERT"),
        "c": ("HIGH", 1, "OPERATIONS_REVIEW"), "d": ("HIGH", 1, "OPERATIONS_REVIEW"), "e": ("MEDIUM", 2, "MONITOR_AIRCRAFT"),
        "f": ("MEDIUM", 2, "MONITOR_FLIGHT"), "g": ("LOW", 3, "NO_ACTION"), "h": ("LOW", 3, "NO_ACTION")}
    assert all(x.action_message == r.ACTION_MESSAGES[x.automation_action] for x in out.collect())
    assert [x.flight_id for x in r.top_actions(out, 3).collect()] == ["c", "d", "b"]
    alerts = {x.alert_id: x for x in r.delay_alerts(out).collect()}
    assert len(alerts) == 6 and alerts["DELAY-e"].priority == 2 and alerts["DELAY-e"].trigger_reason.startswith("Previous flight")


def test_baggage_alerts_all_and_flag(spark):
    sla = spark.range(150).select(F.concat(F.lit("b"), F.col("id")).alias("bag_id"), F.col("id").cast("double").alias("cycle_minutes"))
    out = r.baggage_alerts(sla).collect()
    assert {x.alert_id for x in out} == {f"BAG-b{i}" for i in range(46, 150)} and len(out) == 104
    assert out[0].entity_id == "UNKNOWN" and "45 minutes (" in out[0].trigger_reason
    flags = spark.createDataFrame([("x", "Yes"), ("y", "no"), ("z", None)], "bag_tag string, sla_breached string")
    assert [x.alert_id for x in r.baggage_alerts(flags).collect()] == ["BAG-x"]


def test_demand_alerts_both_rules(spark):
    f = spark.createDataFrame([(f"r{i}", float(i)) for i in range(1, 6)], "route_id string, predicted_bookings double")
    assert sorted(x.entity_id for x in r.demand_alerts(f).collect()) == ["r4", "r5"]   # quantile tie is included
    a = spark.createDataFrame([("x", 12.0, 10), ("y", 11.9, 10), ("z", 1.0, None)], "route_id string, forecast double, bookings int")
    assert sorted(x.entity_id for x in r.demand_alerts(a).collect()) == ["x", "z"]
    assert r.demand_alerts(a.drop("forecast")).count() == 0


def test_cancellation_alerts_flag_then_score(spark):
    df = spark.createDataFrame([("a", 5.0, "TRUE"), ("b", 5.0, "false"), ("c", 2.0, None)], "route_id string, z_score double, anomaly string")
    assert [x.alert_id for x in r.cancellation_alerts(df).collect()] == ["CANCEL-a"]
    assert [x.alert_id for x in r.cancellation_alerts(df.drop("anomaly")).collect()] == ["CANCEL-a", "CANCEL-b", "CANCEL-c"]
    assert r.cancellation_alerts(df.select("route_id")).count() == 0


@pytest.fixture(scope="module")
def alerts(spark):
    rows = [(f"DELAY-{i}", "DELAY_RISK", f"f{i}", "HIGH", 1, "AIRCRAFT_TURNAROUND_ALERT" if i == 3 else "OPERATIONS_REVIEW", "why", i / 10,
             "Operations Control", "OPEN", True) for i in range(9)]
    rows += [("DEMAND-r", "DEMAND_SURGE", "r", "MEDIUM", 2, "DEMAND_SURGE_ALERT", "why", None, "Network Planning", "open", True),
             ("CANCEL-r", "CANCELLATION_CLUSTER", "r", "HIGH", 1, "CANCELLATION_CLUSTER_ALERT", "why", None, "Operations Control", "CLOSED", True),
             ("CANCEL-s", "CANCELLATION_CLUSTER", "s", "HIGH", 1, "CANCELLATION_CLUSTER_ALERT", "why", None, "Operations Control", "OPEN", False),
             ("BAG-1", "BAGGAGE_SLA_BREACH", "UNKNOWN", "LOW", 1, "BAGGAGE_SLA_ESCALATION", "why", None, "Baggage Operations", "OPEN", True)]
    schema = ("alert_id string, alert_type string, entity_id string, risk_level string, priority int, automation_action string, "
              "trigger_reason string, model_probability double, owner string, status string, notification_required boolean")
    return r.unified_alerts(spark.createDataFrame(rows, schema), now=NOW)


def test_selection_takes_types_first_then_fills(alerts):
    got = [x.alert_id for x in n.select_notifications(alerts).orderBy("selection_rank").collect()]
    assert got == ["DELAY-8", "DEMAND-r", "DELAY-7", "DELAY-6", "DELAY-5"]
    assert n.select_notifications(alerts.filter("alert_type = 'DEMAND_SURGE'")).count() == 1
    assert n.select_notifications(alerts.limit(0)).count() == 0


def test_selection_limits_rows_before_the_shuffle(alerts):
    plan = n.select_notifications(alerts)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_outbox_audit_counts_and_acknowledgement(spark, alerts):
    outbox = n.notification_outbox(alerts.filter("alert_id IN ('DELAY-3', 'DEMAND-r')"), NOW)
    box = {(x.alert_id, x.notification_channel): x for x in outbox.collect()}
    assert len(box) == 4 and len({x.message_id for x in box.values()}) == 4
    mail = box["DELAY-3", "EMAIL"]
    assert mail.owner == "Fleet Operations" and mail.recipient == "fleet_mailbox" and mail.subject == "[Operations] HIGH Alert - f3"
    assert "Delay Probability: 30.0%" in mail.message and box["DEMAND-r", "SLACK"].subject is None
    results = outbox.filter("notification_channel = 'EMAIL'").select("message_id", (F.col("alert_id") == "DELAY-3").alias("delivered"),
                                                                     F.lit("bounced").alias("error"))
    audit = n.notification_audit(outbox, results.unionByName(results))
    got = {(x.alert_id, x.notification_channel): (x.status, x.error) for x in audit.collect()}
    assert got == {("DELAY-3", "EMAIL"): ("SENT", None), ("DELAY-3", "SLACK"): ("FAILED", "no delivery result"),
                   ("DEMAND-r", "EMAIL"): ("FAILED", "bounced"), ("DEMAND-r", "SLACK"): ("FAILED", "no delivery result")}
    assert tuple(n.delivery_counts(audit).first()) == (1, 3, 1, 0)
    later = audit.unionByName(audit.filter("alert_id = 'DELAY-3' AND notification_channel = 'EMAIL'")
                              .withColumn("timestamp", F.expr("timestamp + interval 1 hour")))
    done = n.acknowledge(later, "f3", "Duty", NOW).filter("status = 'ACKNOWLEDGED'").collect()
    assert len(done) == 1 and done[0].owner == "Duty" and done[0].timestamp.hour == 10 and done[0].acknowledged_at is not None
    with pytest.raises(LookupError):
        n.acknowledge(later, "nobody", "Duty", NOW)
    assert tuple(v.notification_summary(audit).first()) == (4, 1, 3, 0)


def test_alert_summary(alerts):
    got = {(x.dimension, x.value): x.n for x in r.alert_summary(alerts).collect()}
    assert got["alert_type", "DELAY_RISK"] == 9 and got["risk_level", "MEDIUM"] == 1 and sum(got.values()) == 39


def test_summary_falls_back_to_scored_rows(spark, alerts):
    audit = spark.createDataFrame([("SENT",), ("failed",)], "status string")
    row = v.summary(spark.createDataFrame([], "flight_id string"), alerts, audit).first()
    assert (row.total_flights, row.risk_scored_flights, row.high_risk, row.medium_risk, row.low_risk, row.notifications_sent,
            row.notifications_failed) == (13, 13, 11, 1, 1, 1, 1)
    charts = {x.name: x.value for x in v.action_chart(spark.createDataFrame([(2, 1, 4)], "urgent_actions long, medium_risk long, aircraft_turnaround_alerts long")).collect()}
    assert charts == {"Urgent Review": 2, "Turnaround": 4, "Monitoring": 0}


def test_views(spark, alerts):
    scored = spark.createDataFrame([("f1", "a12", "r1", 0.9, "HIGH", 1, "X"), ("f12", "a2", "r2", 0.5, "Medium", 2, "Y"), ("f3", "a3", "r3", 0.1, "LOW", 3, "Y")],
                                   "flight_id string, aircraft_id string, route_id string, delay_probability double, risk_level string, priority int, automation_action string")
    assert [x.flight_id for x in v.flights_view(scored, "medium").collect()] == ["f12"]
    assert [x.flight_id for x in v.delay_risk(scored).collect()] == ["f1", "f12"]
    assert v.require_flight(scored, "f3").risk_level == "LOW"
    with pytest.raises(LookupError):
        v.require_flight(scored, "zz")
    with pytest.raises(ValueError):
        v.flights_view(scored, limit=0)
    assert [x.flight_id for x in v.flight_matches(scored, "12").collect()] == ["f1", "f12"]
    page = v.flight_search(scored, "", page_no=2, per_page=2).collect()
    assert [(x.flight_id, x.matches, x.total_pages) for x in page] == [("f3", 3, 2)]
    flights = spark.createDataFrame([("f1", NOW), ("f9", NOW)], "flight_id string, scheduled_departure timestamp")
    live = v.flights_live(flights, scored.unionByName(scored.withColumn("priority", F.col("priority") + 1)))
    assert [(x.flight_id, x.priority) for x in live.orderBy("flight_id").collect()] == [("f1", 1), ("f9", None)]
    assert {(x.risk_level, x.n, x.total) for x in v.risk_distribution(scored).collect()} == {("HIGH", 1, 3), ("MEDIUM", 1, 3), ("LOW", 1, 3)}
    top = v.alerts_view(alerts, limit=2).collect()
    assert [(x.alert_id, x.high_count, x.medium_count) for x in top] == [("DELAY-8", 11, 1), ("DELAY-7", 11, 1)]


def test_panels(spark):
    routes = spark.createDataFrame([("a", "₹ 1,000", "400"), ("b", "2,000", None)], "route_id string, revenue string, cost string")
    assert [(x.route, x.profit) for x in v.top_routes_by_profit(routes).collect()] == [("b", 2000.0), ("a", 600.0)]
    series = spark.createDataFrame([("r", date(2024, 1, d), None if d == 3 else float(d), 9 if d != 4 else None) for d in range(1, 21)] + [("r", date(2024, 2, 1), None, None)],
                                   "route_id string, forecast_date date, forecast double, actual_demand int")
    got = v.forecast_series(series).collect()
    assert len(got) == 14 and got[0].label == "2024-01-07" and got[-1].forecast == 20.0
    sla = spark.createDataFrame([("1",), ("breach!",), ("late",), ("ok",), (None,)], "sla_status string")
    assert v.baggage_breach_count(sla).first()[0] == 3
    tickets = spark.createDataFrame([("LOST_BAG",)] * 3 + [("",)], "issue_type string")
    issues = spark.createDataFrame([("LOST_BAG", 2), ("LATE", 5)], "issue_type string, ticket_count long")
    assert [tuple(x) for x in v.issue_chart(tickets, issues).collect()] == [("LATE", 5), ("LOST BAG", 3), ("OTHER", 1)]
    presence = spark.createDataFrame([("x", True), ("y", False)], "dataset string, dataset_exists boolean")
    assert {x.status for x in v.system_health(presence).collect()} == {"degraded"}
    assert v.json_records(spark.createDataFrame([(float("nan"), None)], "v double, s string")).first()[0] == '{"v":null,"s":null}'


def test_flag_words_belong_to_their_column(spark):
    flags = spark.createDataFrame([("a", "Breach"), ("b", "anomaly"), ("c", "high")], "id string, word string")
    assert {x.alert_id for x in r.baggage_alerts(flags.toDF("bag_id", "sla_breach")).collect()} == {"BAG-a", "BAG-c"}
    assert {x.alert_id for x in r.cancellation_alerts(flags.toDF("route_id", "anomaly")).collect()} == {"CANCEL-b", "CANCEL-c"}


def test_alerts_of_one_route_get_messages_of_their_own(spark):
    days = spark.createDataFrame([("r", date(2024, 1, d), 9.0) for d in (1, 2, 3)], "route_id string, forecast_date date, forecast double")
    outbox = n.notification_outbox(r.unified_alerts(r.demand_alerts(days), now=NOW), NOW)
    assert outbox.count() == 6 and outbox.select("message_id").distinct().count() == 6
    done = n.acknowledge(n.notification_audit(outbox, outbox.select("message_id", F.lit(True).alias("delivered"),
                                                                    F.lit(None).cast("string").alias("error"))), "r", "Duty", NOW)
    assert done.filter("status = 'ACKNOWLEDGED'").count() == 1


def test_route_page_sorts_by_the_first_profit_spelling(spark):
    routes = spark.createDataFrame([("a", 1.0, 9.0, 5.0), ("b", 2.0, 8.0, 6.0), ("c", None, 7.0, 7.0)],
                                   "route_id string, estimated_profit double, route_profit double, net_profit double")
    assert [r.route_id for r in v.route_profitability_view(routes).collect()] == ["b", "a", "c"]
    assert [r.route_id for r in v.route_profitability_view(routes.drop("estimated_profit"), 2).collect()] == ["a", "b"]
    assert [r.route_id for r in v.route_profitability_view(routes.select("route_id", "net_profit")).collect()] == ["a", "b", "c"]


def test_audit_streams_messages_past_hashed_results(spark, alerts, rows):
    outbox = n.notification_outbox(n.select_notifications(alerts), NOW)
    results = outbox.select("message_id", (F.col("notification_channel") == "EMAIL").alias("delivered"), F.lit("closed").alias("error"))
    nobody = outbox.withColumn("message_id", F.lit(None).cast("string"))
    audit = n.notification_audit(outbox.unionByName(nobody), results.unionByName(results))
    plan = audit._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan  # wide messages are not sorted
    messages = outbox.count()
    assert rows(audit.groupBy("status", F.col("message_id").isNull().alias("lost")).count()) == sorted(
        [("FAILED", False, messages // 2), ("FAILED", True, messages), ("SENT", False, messages // 2)])
    assert {r.error for r in audit.filter("message_id IS NULL").collect()} == {"no delivery result"}


def test_pages_with_totals_keep_first_rows_per_task(spark, alerts):
    frame = spark.range(50).select(F.col("id").alias("flight_id"), F.lit("HIGH").alias("risk_level"), (F.col("id") / 100).alias("delay_probability"),
                                   F.lit(NOW).alias("timestamp"), F.col("id").cast("string").alias("alert_id"), F.lit("SENT").alias("status"))
    shown = {"notifications": v.notifications_view(frame, 3), "search": v.flight_search(frame, "4", page_no=2, per_page=2),
             "alerts": v.alerts_view(frame, limit=3)}
    for df in shown.values():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
    assert [(r.alert_id, r.total, r.sent, r.failed) for r in shown["notifications"].collect()] == [(i, 50, 50, 0) for i in ("0", "1", "10")]
    assert [(r.flight_id, r.matches, r.total_pages) for r in shown["search"].collect()] == [(47, 14, 7), (46, 14, 7)]
    assert [(r.alert_id, r.high_count, r.medium_count) for r in shown["alerts"].collect()] == [("49", 50, 0), ("48", 50, 0), ("47", 50, 0)]
