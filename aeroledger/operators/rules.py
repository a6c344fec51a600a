"""Operational rules: actions for risky flights and one alert table over all sources."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroledger.functions.columns import TRUTHY, numeric, resolve_column, truthy
from aeroledger.operators.quality import union_all
from aeroledger.operators.skew import exact_quantile

ALERT_COLUMNS = ("alert_id", "alert_type", "entity_id", "risk_level", "priority", "automation_action",
                 "trigger_reason", "model_probability", "owner", "status", "notification_required", "event_day")

# The message that goes with each action.
ACTION_MESSAGES = {
    "URGENT_OPERATIONS_REVIEW": "Previous flight had cascade delay. Review aircraft rotation immediately.",
    "AIRCRAFT_TURNAROUND_ALERT": "High delay probability with short aircraft turnaround. Prioritize ground operations.",
    "OPERATIONS_REVIEW": "High predicted delay probability. Operations team review recommended.",
    "MONITOR_AIRCRAFT": "Previous flight experienced significant delay. Monitor aircraft turnaround.",
    "MONITOR_FLIGHT": "Moderate predicted delay probability. Continue operational monitoring.",
    "NO_ACTION": "Low predicted delay probability. No immediate action required.",
}

# Column spellings accepted in exported inputs, in order of preference.
FLIGHT_NAMES = ("flight_id", "flight", "id")
ROUTE_NAMES = ("route_id", "route", "route_code")
RISK_NAMES = ("risk_level", "risk", "severity")
ACTION_NAMES = ("automation_action", "action")
PROBABILITY_NAMES = ("future_delay_probability", "delay_probability", "probability", "prediction_probability")
REASON_NAMES = ("trigger_reason", "reason", "action_message")
BAG_NAMES = ("baggage_id", "bag_id", "bag_tag")
DURATION_NAMES = ("cycle_minutes", "sla_minutes", "scan_duration_minutes", "duration_minutes", "processing_minutes")
BREACH_NAMES = ("sla_breached", "sla_breach", "breach", "is_breach")
FORECAST_NAMES = ("predicted_bookings", "predicted_demand", "forecast_demand", "forecast", "prediction")
ACTUAL_NAMES = ("actual_demand", "demand", "bookings", "booking_count")
ANOMALY_NAMES = ("anomaly", "is_anomaly", "anomaly_flag")
DAY_NAMES = ("forecast_date", "cancel_date", "flight_date", "event_date")
SCORE_NAMES = ("z_score", "zscore", "cancellation_zscore")

# Spellings of "yes" in each flag column.
BREACH_WORDS = (*TRUTHY, "breach")
ANOMALY_WORDS = (*TRUTHY, "anomaly")


def delay_actions(predictions: DataFrame, high: float = 0.70, medium: float = 0.40,
                  short_turnaround: float = 60, long_delay: float = 30) -> DataFrame:
    """Adds ``risk_level``, ``automation_action``, ``action_message`` and ``priority``.

    A missing turnaround or earlier delay never triggers its branch.
    """
    p = F.col("delay_probability")
    urgent = (F.when(F.col("previous_cascade_indicator") == 1, F.lit("URGENT_OPERATIONS_REVIEW"))
              .when(F.col("turnaround_minutes") < short_turnaround, F.lit("AIRCRAFT_TURNAROUND_ALERT"))
              .otherwise(F.lit("OPERATIONS_REVIEW")))
    watch = (F.when(F.col("previous_flight_delay") > long_delay, F.lit("MONITOR_AIRCRAFT"))
             .otherwise(F.lit("MONITOR_FLIGHT")))
    messages = F.create_map(*[F.lit(x) for pair in ACTION_MESSAGES.items() for x in pair])
    level = F.when(p >= high, F.lit(1)).when(p >= medium, F.lit(2)).otherwise(F.lit(3))
    return (predictions.withColumn("priority", level)
            .withColumn("risk_level", F.element_at(F.array(F.lit("HIGH"), F.lit("MEDIUM"), F.lit("LOW")),
                                                   F.col("priority")))
            .withColumn("automation_action", F.when(F.col("priority") == 1, urgent)
                        .when(F.col("priority") == 2, watch).otherwise(F.lit("NO_ACTION")))
            .withColumn("action_message", messages[F.col("automation_action")]))


def top_actions(actions: DataFrame, n: int = 10) -> DataFrame:
    """The most pressing flights: priority, then probability, then id."""
    return actions.orderBy("priority", F.desc_nulls_last("delay_probability"), "flight_id").limit(n)


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), F.asc_nulls_last(column))


def _alert(alert_type: str, alert_id: Column, entity: Column, risk: Column, priority: Column, action: Column,
           reason: Column, probability: Column, owner: str, day: Column) -> list[Column]:
    values = (alert_id, F.lit(alert_type), entity, risk, priority.cast("int"), action, reason,
              probability.cast("double"), F.lit(owner), F.lit("OPEN"), F.lit(True), day.cast("date"))
    return [v.alias(c) for v, c in zip(values, ALERT_COLUMNS)]


def _named(df: DataFrame, names: Sequence[str], default: str = "UNKNOWN") -> Column:
    found = resolve_column(df.columns, names)
    return F.col(found).cast("string") if found else F.lit(default)


def _day(df: DataFrame) -> Column:
    """The day the alert is about, which tells apart alerts of one route."""
    found = resolve_column(df.columns, DAY_NAMES)
    return F.col(found) if found else F.lit(None)


def delay_alerts(actions: DataFrame) -> DataFrame:
    """One alert per HIGH or MEDIUM flight."""
    risk = F.upper(_named(actions, RISK_NAMES, ""))
    flight = _named(actions, FLIGHT_NAMES)
    probability = resolve_column(actions.columns, PROBABILITY_NAMES)
    return actions.filter(risk.isin("HIGH", "MEDIUM")).select(*_alert(
        "DELAY_RISK", F.concat(F.lit("DELAY-"), flight), flight, risk, F.when(risk == "HIGH", 1).otherwise(2),
        _named(actions, ACTION_NAMES, "OPERATIONS_REVIEW"),
        _named(actions, REASON_NAMES, "Predicted future flight delay risk."),
        numeric(probability) if probability else F.lit(0.0), "Operations Control", _day(actions)))


def baggage_alerts(sla: DataFrame, minutes: float = 45) -> DataFrame:
    """Bags over the limit; without a duration column the breach flag decides."""
    duration = resolve_column(sla.columns, DURATION_NAMES)
    breach = resolve_column(sla.columns, BREACH_NAMES)
    if duration:
        late = numeric(duration, None) > minutes
    else:
        late = truthy(breach, BREACH_WORDS) if breach else F.lit(False)
    took = numeric(duration) if duration else F.lit(0.0)
    bag = _named(sla, BAG_NAMES)
    reason = F.format_string(f"Baggage operational scan SLA exceeded {minutes:g} minutes (%.1f minutes).", took)
    return sla.filter(late).select(*_alert(
        "BAGGAGE_SLA_BREACH", F.concat(F.lit("BAG-"), bag), _named(sla, FLIGHT_NAMES), F.lit("HIGH"), F.lit(1),
        F.lit("BAGGAGE_SLA_ESCALATION"), reason, F.lit(None), "Baggage Operations", _day(sla)))


def demand_alerts(forecast: DataFrame, surge: float = 1.2, q: float = 0.75,
                  actual_names: Sequence[str] = ACTUAL_NAMES) -> DataFrame:
    """Forecasts well above actual demand; without actuals, the forecasts from the upper quantile on."""
    column = resolve_column(forecast.columns, FORECAST_NAMES)
    if column is None:
        return forecast.limit(0).select(*_alert("DEMAND_SURGE", *[F.lit(None).cast("string")] * 3,
                                                F.lit(None), *[F.lit(None).cast("string")] * 2, F.lit(None), "", F.lit(None)))
    predicted = numeric(column)
    actual = resolve_column(forecast.columns, actual_names)
    if actual:
        bar = numeric(actual) * surge
    else:
        bar = exact_quantile(forecast.select(predicted.alias("v")), "v", q).scalar()
    route = _named(forecast, ROUTE_NAMES)
    reason = F.format_string("Forecast demand surge detected for route %s. Forecast demand=%.0f.", route, predicted)
    return forecast.filter(predicted >= bar).select(*_alert(
        "DEMAND_SURGE", F.concat(F.lit("DEMAND-"), route), route, F.lit("MEDIUM"), F.lit(2),
        F.lit("DEMAND_SURGE_ALERT"), reason, F.lit(None), "Network Planning", _day(forecast)))


def anomalous(anomalies: DataFrame, z: float = 2) -> Column | None:
    """Condition for an anomalous day: the flag if present, else the score; None when neither exists."""
    marked = resolve_column(anomalies.columns, ANOMALY_NAMES)
    score = resolve_column(anomalies.columns, SCORE_NAMES)
    if marked:
        return truthy(marked, ANOMALY_WORDS)
    return numeric(score) >= z if score else None


def cancellation_alerts(anomalies: DataFrame, z: float = 2) -> DataFrame:
    """Anomalous cancellation days."""
    condition = anomalous(anomalies, z)
    column = resolve_column(anomalies.columns, SCORE_NAMES)
    score = numeric(column) if column else F.lit(0.0)
    route = _named(anomalies, ROUTE_NAMES)
    reason = F.format_string("Cancellation anomaly detected for route %s. Anomaly score=%.2f.", route, score)
    hits = anomalies.filter(F.lit(False) if condition is None else condition)
    return hits.select(*_alert(
        "CANCELLATION_CLUSTER", F.concat(F.lit("CANCEL-"), route), route, F.lit("HIGH"), F.lit(1),
        F.lit("CANCELLATION_CLUSTER_ALERT"), reason, F.lit(None), "Operations Control", _day(anomalies)))


def unified_alerts(*alerts: DataFrame, now: datetime) -> DataFrame:
    """All alerts in one schema, stamped with the run time; alerts that carry no day get a null one."""
    dated = [a if "event_day" in a.columns else a.withColumn("event_day", F.lit(None).cast("date")) for a in alerts]
    return union_all(dated).select(F.lit(now).cast("timestamp").alias("timestamp"), *ALERT_COLUMNS,
                                    F.lit("AUTOMATION_RULE_TRIGGERED").alias("audit_event"))


def alert_summary(alerts: DataFrame) -> DataFrame:
    """(dimension, value, n) for alert type, action and risk, from one aggregation."""
    columns = ["alert_type", "automation_action", "risk_level"]
    combined = alerts.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return (combined.unpivot(["_n"], columns, "dimension", "value")
            .groupBy("dimension", "value").agg(F.sum("_n").alias("n"))
            .orderBy("dimension", F.desc("n"), "value"))
