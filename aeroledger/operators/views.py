"""Read views over the published outputs.  Limits always apply to a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroledger.functions.columns import (
    clean_number, contains_any, count_when, first_filled, json_safe, numeric, prefer_columns, resolve_column,
    same_text, spaced, truthy)
from aeroledger.operators.rules import (
    ACTUAL_NAMES, BREACH_NAMES, BREACH_WORDS, DURATION_NAMES, FORECAST_NAMES, anomalous)

# Columns a flight page shows, and column spellings of profit, cost and revenue.
FLIGHT_PAGE = ("flight_id", "entity_id", "aircraft_id", "route_id", "delay_probability", "future_delay_probability",
               "model_probability", "risk_level", "priority", "automation_action", "action_message",
               "trigger_reason", "owner", "status", "timestamp")
PROBABILITIES = ("delay_probability", "future_delay_probability", "model_probability")
LIVE_COLUMNS = ("risk_level", "priority", "automation_action", "model_probability", "delay_probability")
PROFIT_NAMES = ("profit", "route_profit", "profit_amount", "net_profit", "estimated_profit", "total_profit")
ROUTE_PROFIT_NAMES = ("profit", "estimated_profit", "route_profit", "profitability")  # in the order the route page looks for them
REVENUE_NAMES = ("revenue", "route_revenue", "total_revenue")
COST_NAMES = ("operating_cost", "estimated_cost", "estimated_operating_cost", "cost", "total_cost")
MAX_PAGE = 5000


def _bounded(limit: int) -> int:
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must lie between 1 and {MAX_PAGE}")
    return limit


def page(df: DataFrame, order: Sequence[str | Column], limit: int = 100) -> DataFrame:
    """First ``limit`` rows in the given total order."""
    return df.orderBy(*[F.asc_nulls_last(c) if isinstance(c, str) else c for c in order]).limit(_bounded(limit))


def _by_probability(df: DataFrame) -> list[Column]:
    probability = resolve_column(df.columns, PROBABILITIES)
    ident = resolve_column(df.columns, ("flight_id", "alert_id", "entity_id"))
    reason = [F.asc_nulls_last(c) for c in ("trigger_reason", "event_day") if c in df.columns]  # alert ids repeat
    return ([F.desc_nulls_last(probability)] if probability else []) + [F.asc_nulls_last(ident), *reason]


def attach(df: DataFrame, one_row: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Adds the columns of a one-row frame to every row, as a scalar subquery.

    In one projection: above a second one Spark would sort a page's whole input instead of keeping its first rows per task.
    """
    columns = list(columns or one_row.columns)
    one = one_row.select(F.struct(*columns)).scalar()
    return df.select(*df.columns, *[one.getField(c).alias(c) for c in columns])


def risk_counts() -> list[Column]:
    return [count_when(same_text("risk_level", level)).alias(f"{level.lower()}_risk")
            for level in ("HIGH", "MEDIUM", "LOW")]


def audit_counts(prefix: str = "") -> list[Column]:
    return [count_when(same_text("status", s)).alias(f"{prefix}{s.lower()}") for s in ("SENT", "FAILED", "ACKNOWLEDGED")]


def summary(flights: DataFrame, scored: DataFrame, audit: DataFrame) -> DataFrame:
    """Headline numbers as one row; without flights the scored rows stand in for their count."""
    head = scored.agg(
        F.count(F.lit(1)).alias("risk_scored_flights"), *risk_counts(),
        count_when(F.col("automation_action") == "URGENT_OPERATIONS_REVIEW").alias("urgent_actions"),
        count_when(F.col("automation_action") == "AIRCRAFT_TURNAROUND_ALERT").alias("aircraft_turnaround_alerts"))
    head = attach(head, audit.agg(*audit_counts("notifications_")))
    operated = flights.agg(F.count(F.lit(1))).scalar()
    return head.withColumn("total_flights", F.when(operated > 0, operated).otherwise(F.col("risk_scored_flights")))


def dashboard(summary_row: DataFrame, outputs: dict[str, DataFrame]) -> DataFrame:
    """The summary plus the row count of each output."""
    for name, df in outputs.items():
        summary_row = summary_row.withColumn(f"{name}_rows", df.agg(F.count(F.lit(1))).scalar())
    return summary_row


def flights_view(scored: DataFrame, risk: str | None = None, limit: int = 100) -> DataFrame:
    """Riskiest flights, optionally of one risk level."""
    rows = scored.filter(same_text("risk_level", risk)) if risk else scored
    return page(prefer_columns(rows, FLIGHT_PAGE), _by_probability(rows), limit)


def flight_detail(scored: DataFrame, flight: str) -> DataFrame:
    """The row of one flight (by flight id, else by entity id)."""
    key = resolve_column(scored.columns, ("flight_id", "entity_id"))
    return page(scored.filter(F.col(key).cast("string") == flight), _by_probability(scored), 1)


def require_flight(scored: DataFrame, flight: str):
    """The flight's row; an error when it is unknown."""
    row = flight_detail(scored, flight).first()
    if row is None:
        raise LookupError(f"no flight {flight}")
    return row


def flights_live(flights: DataFrame, scored: DataFrame, limit: int = 100) -> DataFrame:
    """First flights by departure with their alert, one alert per flight (the most pressing).

    The page is cut before the join, so at most ``MAX_PAGE`` rows look for alerts.
    """
    shown = page(flights, ["scheduled_departure", "flight_id"], limit)
    columns = sorted([c for c in LIVE_COLUMNS if c in scored.columns], key=lambda c: c != "priority")
    wanted = scored.join(F.broadcast(shown.select("flight_id")), "flight_id", "left_semi")
    first = F.min(F.struct(*columns))
    one = wanted.groupBy("flight_id").agg(first.alias("_a"))
    return shown.join(one, "flight_id", "left").select(*flights.columns, *[F.col(f"_a.{c}").alias(c) for c in columns])


def alerts_view(alerts: DataFrame, risk: str | None = None, action: str | None = None,
                limit: int = 1000) -> DataFrame:
    """HIGH and MEDIUM alerts, most probable first; the counts cover all matches, not just the page."""
    rows = alerts.filter(F.upper("risk_level").isin("HIGH", "MEDIUM"))
    if risk:
        rows = rows.filter(same_text("risk_level", risk))
    if action:
        rows = rows.filter(same_text("automation_action", action))
    counts = rows.agg(count_when(same_text("risk_level", "HIGH")).alias("high_count"),
                      count_when(same_text("risk_level", "MEDIUM")).alias("medium_count"))
    return attach(page(rows, _by_probability(rows), limit), counts)


def delay_risk(scored: DataFrame, limit: int = 100) -> DataFrame:
    rows = scored.filter(F.upper("risk_level").isin("HIGH", "MEDIUM"))
    return page(rows, _by_probability(rows), limit)


def risk_distribution(scored: DataFrame) -> DataFrame:
    """Rows per risk level, each with the overall total."""
    counts = scored.groupBy(F.upper("risk_level").alias("risk_level")).agg(F.count(F.lit(1)).alias("n"))
    return attach(counts, counts.agg(F.sum("n").alias("total")))


def notification_summary(audit: DataFrame) -> DataFrame:
    return audit.agg(F.count(F.lit(1)).alias("total"), *audit_counts())


def notifications_view(audit: DataFrame, limit: int = 1000) -> DataFrame:
    """Audit rows, newest first, with the delivery counts of the whole audit."""
    newest = [F.desc_nulls_last("timestamp"), *[F.asc_nulls_last(c) for c in (
        "alert_id", "notification_channel", "trigger_reason", "message_id") if c in audit.columns]]
    return attach(page(audit, newest, limit), notification_summary(audit))


def route_profitability_view(routes: DataFrame, limit: int = 100) -> DataFrame:
    profit = resolve_column(routes.columns, ROUTE_PROFIT_NAMES)
    return page(routes, ([F.desc_nulls_last(profit)] if profit else []) + [F.asc("route_id")], limit)


def route_performance(routes: DataFrame, limit: int = 100, order: Sequence[str] = ("route_id",)) -> DataFrame:
    return page(routes, list(order), limit)


def breaches(sla: DataFrame) -> Column:
    found = resolve_column(sla.columns, BREACH_NAMES)
    return truthy(found, BREACH_WORDS) if found else F.lit(False)


def baggage_sla_view(sla: DataFrame, limit: int = 100) -> DataFrame:
    """A page of bags with the number of breaches over all bags."""
    return attach(page(sla, ["bag_id"], limit), sla.agg(count_when(breaches(sla)).alias("breach_count")))


def baggage_issues(sla: DataFrame, minutes: float = 45, limit: int = 100) -> DataFrame:
    duration = resolve_column(sla.columns, DURATION_NAMES)
    rows = sla.filter(numeric(duration, None) > minutes) if duration else sla.filter(breaches(sla))
    return page(rows, [F.desc_nulls_last(duration), F.asc("bag_id")] if duration else ["bag_id"], limit)


def anomalies_view(anomalies: DataFrame, z: float = 2, limit: int = 100) -> DataFrame:
    """Anomalous days by flag, else by score, else every day."""
    condition = anomalous(anomalies, z)
    rows = anomalies if condition is None else anomalies.filter(condition)
    return page(rows, [F.desc_nulls_last("z_score"), F.asc("cancel_date"), F.asc("route_id")], limit)


def system_health(presence: DataFrame) -> DataFrame:
    """Presence of each dataset with the overall verdict."""
    verdict = presence.agg(F.when(F.min("dataset_exists"), F.lit("healthy")).otherwise(F.lit("degraded")).alias("status"))
    return attach(presence.select("dataset", "dataset_exists"), verdict)


# --- dashboard panels ---------------------------------------------------------------------------

def flight_matches(scored: DataFrame, query: str = "", risk: str = "ALL", action: str = "ALL") -> DataFrame:
    """Flights whose flight, aircraft or route id contains the query, with optional risk and action."""
    ident = first_filled(*[c for c in ("entity_id", "flight_id", "id") if c in scored.columns])
    rows = scored.filter(contains_any(query, ident, *[c for c in ("aircraft_id", "route_id") if c in scored.columns]))
    if risk != "ALL":
        rows = rows.filter(same_text("risk_level", risk))
    if action != "ALL":
        rows = rows.filter(same_text("automation_action", action))
    return rows


def flight_search(scored: DataFrame, query: str = "", risk: str = "ALL", action: str = "ALL", page_no: int = 1,
                  per_page: int = 10) -> DataFrame:
    """One page of matches with the number of matches and pages."""
    rows = flight_matches(scored, query, risk, action)
    pages = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(per_page))).cast("long")
    totals = rows.agg(F.count(F.lit(1)).alias("matches"), pages.alias("total_pages"))
    shown = rows.orderBy(*_by_probability(rows)).offset((page_no - 1) * per_page).limit(per_page)
    return attach(shown, totals)


def _chart(one_row: DataFrame, bars: dict[str, Column]) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(n).alias("name"), v.cast("long").alias("value")) for n, v in bars.items()])
    return one_row.select(F.inline(entries))


def risk_chart(summary_row: DataFrame) -> DataFrame:
    return _chart(summary_row, {"High": F.col("high_risk"), "Medium": F.col("medium_risk"), "Low": F.col("low_risk")})


def action_chart(summary_row: DataFrame) -> DataFrame:
    watched = F.greatest(F.lit(0), F.col("medium_risk") - F.col("aircraft_turnaround_alerts"))
    return _chart(summary_row, {"Urgent Review": F.col("urgent_actions"),
                                "Turnaround": F.col("aircraft_turnaround_alerts"), "Monitoring": watched})


def alerts_of_risk(alerts: DataFrame, risk: str = "HIGH") -> DataFrame:
    return alerts.filter(same_text("risk_level", risk))


def alert_queue(alerts: DataFrame, n: int = 30) -> DataFrame:
    return page(alerts, ["priority", *_by_probability(alerts)], n)


def top_routes_by_profit(routes: DataFrame, n: int = 10) -> DataFrame:
    """Best routes by stated profit, else by revenue minus cost."""
    def value(names: Sequence[str]) -> Column:
        found = resolve_column(routes.columns, names)
        return F.coalesce(clean_number(found), F.lit(0.0)) if found else F.lit(0.0)

    stated = resolve_column(routes.columns, PROFIT_NAMES)
    difference = value(REVENUE_NAMES) - value(COST_NAMES)
    profit = F.coalesce(clean_number(stated), difference) if stated else difference
    rows = routes.select(F.col("route_id").alias("route"), value(REVENUE_NAMES).alias("revenue"),
                         value(COST_NAMES).alias("cost"), profit.alias("profit"))
    return page(rows, [F.desc("profit"), F.asc("route")], n)


def forecast_series(forecast: DataFrame, n: int = 14, date: str = "forecast_date",
                    order: Sequence[str] = ("forecast_date", "route_id")) -> DataFrame:
    """Last ``n`` points; the forecast falls back to the actual value, points with neither are left out."""
    actual = resolve_column(forecast.columns, ACTUAL_NAMES)
    predicted = resolve_column(forecast.columns, FORECAST_NAMES)
    a = numeric(actual, None) if actual else F.lit(None).cast("double")
    f = numeric(predicted, None) if predicted else F.lit(None).cast("double")
    rows = forecast.select(*order, F.substring(F.col(date).cast("string"), 1, 16).alias("label"),
                           a.alias("actual"), F.coalesce(f, a).alias("forecast"))
    last = (rows.filter(F.col("forecast").isNotNull()).orderBy(*[F.desc_nulls_first(c) for c in order]).limit(n))
    return last.orderBy(*[F.asc_nulls_last(c) for c in order]).select("label", "actual", "forecast")


def top_route_demand(demand: DataFrame, n: int = 10, column: str = "booking_count") -> DataFrame:
    """Busiest route days (days are not added up)."""
    rows = demand.select(F.col("route_id").alias("route"), "flight_date", numeric(column, None).alias("demand"))
    return page(rows.filter(F.col("demand").isNotNull()), [F.desc("demand"), F.asc("flight_date"), F.asc("route")], n)


def baggage_breach_count(sla: DataFrame, column: str = "sla_status") -> DataFrame:
    """Bags whose status text tells of a breach."""
    status = F.upper(F.col(column).cast("string"))
    hit = status.contains("BREACH") | status.isin("LATE", "FAILED", "1", "TRUE", "YES")
    return sla.agg(count_when(hit).alias("breach_count"))


def issue_chart(tickets: DataFrame, issues: DataFrame, n: int = 8) -> DataFrame:
    """Most frequent issues; raw and summarised counts are compared and the larger one shown."""
    raw = (tickets.groupBy(F.coalesce(first_filled("issue_type"), F.lit("OTHER")).alias("issue"))
           .agg(F.count(F.lit(1)).alias("count")))
    told = issues.select(F.coalesce(first_filled("issue_type"), F.lit("OTHER")).alias("issue"),
                         F.col("ticket_count").alias("count"))
    merged = raw.unionByName(told).groupBy("issue").agg(F.max("count").alias("count"))
    return page(merged.select(spaced("issue").alias("issue"), "count"), [F.desc("count"), F.asc("issue")], n)


def json_records(df: DataFrame) -> DataFrame:
    """One JSON-safe text per row."""
    return json_safe(df).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))


def stream_health(monitoring: DataFrame, ledger: DataFrame) -> DataFrame:
    """Events applied, repeated and failed, and the distinct ids in the ledger, as one row."""
    zero = F.lit(0)
    totals = monitoring.agg(*[F.coalesce(F.sum(c), zero).cast("long").alias(c)
                              for c in ("processed", "duplicates", "errors")])
    totals = totals.withColumn("delivered", F.col("processed") + F.col("duplicates") + F.col("errors"))
    return attach(totals, ledger.agg(F.countDistinct("event_id").alias("unique_events")))
