"""Independent SQL for the registered queries: named common table expressions and small expression helpers."""

from __future__ import annotations

NOW = "TIMESTAMP '2024-02-01 06:00:00'"


def r(expr: str, digits: int) -> str:
    """Round half away from zero; a negative zero becomes zero."""
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0e0)"


def s(expr: str, digits: int = 6, over: str = "") -> str:
    """Decimal sum."""
    return f"CAST(SUM(CAST(({expr}) AS DECIMAL(28,{digits}))){over} AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


CTES = {
    "flights_ev": """
        SELECT event_id AS flight_id, event_type AS route_id, user_id AS aircraft_id, ts AS scheduled_departure,
               ts + to_minutes(CAST(delay AS BIGINT)) AS actual_departure,
               CASE WHEN event_type = 'error' THEN 'CANCELLED' ELSE 'COMPLETED' END AS status, delay AS delay_minutes
        FROM (SELECT *, CASE WHEN event_type = 'error' THEN NULL WHEN value > 15 THEN CAST(floor(value) AS DOUBLE)
                        ELSE 0e0 END AS delay FROM events)""",
    "flights_ord": """
        SELECT o_orderkey AS flight_id, o_orderpriority AS route_id, o_custkey AS aircraft_id,
               strftime(o_orderdate, '%Y-%m-%d') AS scheduled_date_id, CAST(o_orderdate AS DATE) AS flight_date,
               o_orderdate AS scheduled_departure,
               CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'DEPARTED' ELSE 'CANCELLED' END AS status,
               nullif(CAST(floor(o_totalprice / 10000e0) AS DOUBLE), 0e0) AS delay_minutes
        FROM orders""",
    "bookings_li": """
        SELECT l_orderkey * 10 + l_linenumber AS booking_id, l_orderkey AS flight_id, l_extendedprice AS fare,
               l_shipdate AS booking_time, l_returnflag = 'R' AS refunded FROM lineitem""",
    "cancels": """
        SELECT o_orderkey AS flight_id, o_orderdate AS cancelled_at, c_mktsegment AS reason_code,
               o_orderpriority AS route_id
        FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'P'""",
    "scans": """
        SELECT l_orderkey AS bag_id, l_shipdate AS scan_time, nullif(l_returnflag, 'N') AS airport,
               l_discount >= 0.08 AS late FROM lineitem""",
    "raw_bookings": """
        SELECT CASE WHEN value >= 2 THEN user_id * 1000 + CAST(floor(value) AS BIGINT) END AS booking_id,
               user_id AS customer_id, nullif(event_type, 'signup') AS status, value - 1 AS fare,
               ts AS booking_time, event_id AS position FROM events""",
    "checked": """
        SELECT *, concat(CASE WHEN booking_id IS NULL THEN 'pk_null;' ELSE '' END,
                         CASE WHEN status IS NULL THEN 'status_null;' ELSE '' END,
                         CASE WHEN row_number() OVER (PARTITION BY booking_id ORDER BY position) > 1
                              THEN 'duplicate_pk;' ELSE '' END) AS _reject_reason
        FROM raw_bookings""",
    "legs": """
        SELECT *, CAST(scheduled_departure AS DATE) AS flight_date, coalesce(delay_minutes, 0e0) AS delay
        FROM flights_ev""",
    "chained": """
        SELECT *, row_number() OVER w AS rotation_sequence, lag(flight_id) OVER w AS prev_flight_id,
               lag(scheduled_departure) OVER w AS prev_scheduled_departure,
               lag(actual_departure) OVER w AS prev_actual_departure, lag(delay) OVER w AS prev_delay_minutes,
               lag(delay, 2) OVER w AS delay_two_back
        FROM legs WINDOW w AS (PARTITION BY aircraft_id, flight_date ORDER BY scheduled_departure, flight_id)""",
    "rotation": """
        SELECT flight_id, route_id, aircraft_id, flight_date, CAST(rotation_sequence AS INTEGER) AS rotation_sequence,
               scheduled_departure, actual_departure, status, delay AS delay_minutes, prev_flight_id,
               prev_scheduled_departure, prev_actual_departure, prev_delay_minutes,
               (epoch(date_trunc('second', scheduled_departure)) - epoch(date_trunc('second', prev_actual_departure)))
                   / 60e0 AS turnaround_minutes,
               CASE WHEN prev_delay_minutes > 0 THEN prev_delay_minutes ELSE 0e0 END AS propagated_delay_min,
               CASE WHEN prev_delay_minutes > 0 AND delay > 0 THEN 1 ELSE 0 END AS is_cascade_delay,
               CASE WHEN prev_delay_minutes > 0 AND delay > 0 THEN 'PROPAGATED' WHEN delay > 0 THEN 'PRIMARY_DELAY'
                    ELSE 'NO_DELAY' END AS delay_propagation_flag,
               CASE WHEN delay_two_back > 0 AND prev_delay_minutes > 0 THEN 1 ELSE 0 END AS prev_cascade
        FROM chained""",
    "features": """
        SELECT * EXCLUDE (prev_cascade), CASE WHEN delay_minutes > 0 THEN 1 ELSE 0 END AS future_delay,
               coalesce(prev_delay_minutes, 0e0) AS previous_flight_delay,
               CASE WHEN prev_delay_minutes > 0 THEN 1 ELSE 0 END AS previous_flight_delayed,
               CAST(coalesce(hour(prev_actual_departure), 0) AS INTEGER) AS previous_departure_hour,
               CAST(hour(scheduled_departure) AS INTEGER) AS scheduled_departure_hour,
               CAST(isodow(scheduled_departure) - 1 AS INTEGER) AS scheduled_departure_day,
               propagated_delay_min AS previous_propagated_delay, prev_cascade AS previous_cascade_indicator
        FROM rotation WHERE prev_flight_id IS NOT NULL""",
    "scored": """
        SELECT *, least(1e0, (previous_flight_delay + scheduled_departure_hour) / 100e0) AS delay_probability
        FROM features""",
    "ranked_risk": """
        SELECT *, CASE WHEN delay_probability >= 0.7e0 THEN 'HIGH' WHEN delay_probability >= 0.4e0 THEN 'MEDIUM'
                       ELSE 'LOW' END AS risk_level FROM scored""",
    "acted": """
        SELECT *, CAST(CASE risk_level WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END AS INTEGER) AS priority,
               CASE WHEN risk_level = 'LOW' THEN 'NO_ACTION'
                    WHEN risk_level = 'MEDIUM' AND previous_flight_delay > 30 THEN 'MONITOR_AIRCRAFT'
                    WHEN risk_level = 'MEDIUM' THEN 'MONITOR_FLIGHT'
                    WHEN previous_cascade_indicator = 1 THEN 'URGENT_OPERATIONS_REVIEW'
                    WHEN turnaround_minutes < 60 THEN 'AIRCRAFT_TURNAROUND_ALERT'
                    ELSE 'OPERATIONS_REVIEW' END AS automation_action
        FROM ranked_risk""",
    "messages": """
        SELECT * FROM (VALUES
            ('URGENT_OPERATIONS_REVIEW', 'Previous flight had cascade delay. Review aircraft rotation immediately.'),
            ('AIRCRAFT_TURNAROUND_ALERT', 'High delay probability with short aircraft turnaround. Prioritize ground operations.'),
            ('OPERATIONS_REVIEW', 'High predicted delay probability. Operations team review recommended.'),
            ('MONITOR_AIRCRAFT', 'Previous flight experienced significant delay. Monitor aircraft turnaround.'),
            ('MONITOR_FLIGHT', 'Moderate predicted delay probability. Continue operational monitoring.'),
            ('NO_ACTION', 'Low predicted delay probability. No immediate action required.'))
            AS m(automation_action, action_message)""",
    "actions": "SELECT * FROM acted JOIN messages USING (automation_action)",
    "bags": """
        SELECT bag_id, min(scan_time) AS first_scan, max(scan_time) AS last_scan,
               min(airport) FILTER (WHERE airport IS NOT NULL AND scan_time = earliest) AS airport
        FROM (SELECT *, min(CASE WHEN airport IS NOT NULL THEN scan_time END) OVER (PARTITION BY bag_id) AS earliest
              FROM scans) GROUP BY bag_id""",
    "sla": """
        SELECT *, (epoch(last_scan) - epoch(first_scan)) / 60e0 AS cycle_minutes, 43200 AS sla_minutes,
               (epoch(last_scan) - epoch(first_scan)) / 60e0 > 43200 AS sla_breached,
               CASE WHEN (epoch(last_scan) - epoch(first_scan)) / 60e0 > 43200 THEN 'BREACH' ELSE 'WITHIN_SLA' END
                   AS sla_status FROM bags""",
    "booked": "SELECT flight_id, count(*) AS n FROM bookings_li GROUP BY flight_id",
    "demand": """
        SELECT flight_date, route_id, CAST(sum(coalesce(n, 0)) AS BIGINT) AS booking_count
        FROM flights_ord LEFT JOIN booked USING (flight_id) GROUP BY ALL""",
    "lagged": """
        SELECT *, row_number() OVER w - 1 AS day_index, lag(booking_count) OVER w AS lag_1,
               lag(booking_count, 7) OVER w AS lag_7, lag(booking_count, 14) OVER w AS lag_14,
               sum(booking_count) OVER (PARTITION BY route_id ORDER BY flight_date
                                        ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) / 7e0 AS rolling_7,
               isodow(flight_date) - 1 AS dow, count(*) OVER (PARTITION BY route_id) AS days
        FROM demand WINDOW w AS (PARTITION BY route_id ORDER BY flight_date)""",
    "full_rows": """
        SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY flight_date) - 1 AS i,
               count(*) OVER (PARTITION BY route_id) AS n
        FROM lagged WHERE lag_14 IS NOT NULL AND days >= 21""",
    "forecast": """
        SELECT route_id, flight_date AS forecast_date, rolling_7 AS predicted_bookings, booking_count
        FROM full_rows WHERE n >= 14""",
    "cancel_days": """
        SELECT CAST(cancelled_at AS DATE) AS cancel_date, route_id, count(*) AS cancellation_count
        FROM cancels GROUP BY ALL""",
    "spread": """
        SELECT route_id, count(*) AS d, CAST(sum(cancellation_count) AS BIGINT) AS t,
               CAST(sum(cancellation_count * cancellation_count) AS BIGINT) AS q FROM cancel_days GROUP BY route_id""",
    "zs": """
        SELECT cancel_date, route_id, cancellation_count, CAST(t AS DOUBLE) / CAST(d AS DOUBLE) AS mean,
               CASE WHEN d > 1 THEN sqrt(CAST(d * q - t * t AS DOUBLE) / CAST(d * (d - 1) AS DOUBLE)) ELSE 0e0 END AS std
        FROM cancel_days JOIN spread USING (route_id)""",
    "anomalies": """
        SELECT *, z_score >= 2 AS anomaly, CASE WHEN z_score >= 3 THEN 'HIGH' WHEN z_score >= 2 THEN 'MEDIUM'
               ELSE 'NORMAL' END AS severity
        FROM (SELECT *, CASE WHEN std > 0 THEN (cancellation_count - mean) / std ELSE 0e0 END AS z_score FROM zs)""",
    "delay_alerts": """
        SELECT concat('DELAY-', flight_id) AS alert_id, 'DELAY_RISK' AS alert_type, CAST(flight_id AS VARCHAR) AS entity_id,
               risk_level, priority, automation_action, action_message AS trigger_reason,
               delay_probability AS model_probability, 'Operations Control' AS owner, flight_date AS event_day
        FROM actions WHERE risk_level <> 'LOW'""",
    "baggage_alerts": """
        SELECT concat('BAG-', bag_id) AS alert_id, 'BAGGAGE_SLA_BREACH' AS alert_type, 'UNKNOWN' AS entity_id,
               'HIGH' AS risk_level, 1 AS priority, 'BAGGAGE_SLA_ESCALATION' AS automation_action,
               printf('Baggage operational scan SLA exceeded 43200 minutes (%.1f minutes).', cycle_minutes) AS trigger_reason,
               CAST(NULL AS DOUBLE) AS model_probability, 'Baggage Operations' AS owner, CAST(NULL AS DATE) AS event_day
        FROM sla WHERE cycle_minutes > 43200""",
    "demand_alerts": """
        SELECT concat('DEMAND-', route_id) AS alert_id, 'DEMAND_SURGE' AS alert_type, route_id AS entity_id,
               'MEDIUM' AS risk_level, 2 AS priority, 'DEMAND_SURGE_ALERT' AS automation_action,
               printf('Forecast demand surge detected for route %s. Forecast demand=%.0f.', route_id, predicted_bookings)
                   AS trigger_reason,
               CAST(NULL AS DOUBLE) AS model_probability, 'Network Planning' AS owner,
               CAST(forecast_date AS DATE) AS event_day
        FROM (SELECT * FROM forecast
              WHERE predicted_bookings >= (SELECT quantile_cont(predicted_bookings, 0.75) FROM forecast))""",
    "cancel_alerts": """
        SELECT concat('CANCEL-', route_id) AS alert_id, 'CANCELLATION_CLUSTER' AS alert_type, route_id AS entity_id,
               'HIGH' AS risk_level, 1 AS priority, 'CANCELLATION_CLUSTER_ALERT' AS automation_action,
               printf('Cancellation anomaly detected for route %s. Anomaly score=%.2f.', route_id, z_score) AS trigger_reason,
               CAST(NULL AS DOUBLE) AS model_probability, 'Operations Control' AS owner, cancel_date AS event_day
        FROM anomalies WHERE anomaly""",
    "alerts": f"""
        SELECT {NOW} AS timestamp, *, 'OPEN' AS status, true AS notification_required,
               'AUTOMATION_RULE_TRIGGERED' AS audit_event
        FROM (SELECT * FROM delay_alerts UNION ALL SELECT * FROM baggage_alerts
              UNION ALL SELECT * FROM demand_alerts UNION ALL SELECT * FROM cancel_alerts)""",
    "routed": """
        SELECT * EXCLUDE (owner, status),
               CASE WHEN automation_action = 'AIRCRAFT_TURNAROUND_ALERT' THEN 'Fleet Operations'
                    WHEN alert_type = 'BAGGAGE_SLA_BREACH' THEN 'Baggage Operations'
                    WHEN alert_type = 'DEMAND_SURGE' THEN 'Network Planning' ELSE 'Operations Control' END AS owner,
               CASE WHEN automation_action = 'AIRCRAFT_TURNAROUND_ALERT' THEN 'fleet_mailbox'
                    ELSE 'operations_mailbox' END AS recipient
        FROM alerts""",
    "sent": """
        SELECT *, substr(sha256(concat_ws('|', alert_id, notification_channel, entity_id, trigger_reason,
                   coalesce(CAST(event_day AS VARCHAR), ''), CAST(epoch_us(timestamp) AS VARCHAR))), 1, 16) AS message_id
        FROM routed, (VALUES ('EMAIL'), ('SLACK')) AS c(notification_channel)""",
    "audit": """
        SELECT message_id, event_day, timestamp, alert_id, entity_id, alert_type, risk_level, priority, automation_action,
               trigger_reason, owner, notification_channel, recipient,
               CASE WHEN notification_channel = 'EMAIL' OR risk_level = 'HIGH' THEN 'SENT' ELSE 'FAILED' END AS status,
               CASE WHEN notification_channel = 'EMAIL' OR risk_level = 'HIGH' THEN NULL ELSE 'channel closed' END AS error,
               CAST(NULL AS TIMESTAMP) AS acknowledged_at
        FROM sent""",
    "profit_base": f"""
        SELECT route_id, {s('coalesce(rev, 0e0)')} AS total_revenue, count(DISTINCT flight_id) AS total_flights,
               {s('coalesce(delay_minutes, 0e0)', 6)} / count(*) AS avg_delay_minutes
        FROM flights_ord LEFT JOIN (SELECT flight_id, {s('fare')} AS rev FROM bookings_li GROUP BY flight_id)
             USING (flight_id) GROUP BY route_id""",
    "profit_cost": """
        SELECT *, total_revenue / total_flights AS revenue_per_flight,
               total_flights * 5000 + avg_delay_minutes * total_flights * 100 + total_revenue * 0.45e0
                   AS estimated_operating_cost FROM profit_base""",
    "profit_net": "SELECT *, total_revenue - estimated_operating_cost AS estimated_profit FROM profit_cost",
    "profit": """
        SELECT *, CASE WHEN profit_margin_pct >= 20 THEN 'HEALTHY' WHEN profit_margin_pct >= 0 THEN 'BREAK_EVEN'
                  ELSE 'LOSS' END AS profitability_status
        FROM (SELECT *, estimated_profit / nullif(total_revenue, 0e0) * 100e0 AS profit_margin_pct FROM profit_net)""",
    "issues": """
        SELECT issue_type, n AS ticket_count, CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE) * 100e0
               AS complaint_share_pct
        FROM (SELECT event_type AS issue_type, count(*) AS n FROM events GROUP BY 1)""",
    "deliveries": """
        SELECT event_id, user_id, event_type, value, ts, props, copy,
               CASE WHEN event_type IN ('view', 'click') THEN 'flight_status' WHEN event_type = 'error' THEN 'baggage_scan'
                    ELSE 'booking' END AS kind,
               CASE WHEN event_type IN ('view', 'click') THEN 'flights.status' WHEN event_type = 'error'
                    THEN 'baggage.scans' ELSE 'bookings.events' END AS topic,
               CAST(floor(value * 100e0 + 0.5e0) AS BIGINT) AS block, event_id * 2 + copy AS pos
        FROM events, (VALUES (1), (2)) AS c(copy) WHERE copy = 1 OR value > 100""",
    "good": "SELECT * FROM deliveries WHERE value >= 3",
    "applied": "SELECT * FROM good WHERE copy = 1",
    "warehouse_flights": """
        SELECT nullif(o_custkey, 7) AS flight_id, o_orderpriority AS route_id,
               CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'DEPARTED' ELSE 'HELD' END AS status,
               o_totalprice / 1000e0 - 10e0 AS delay_minutes, strftime(o_orderdate, '%Y-%m-%d') AS scheduled_date_id
        FROM orders""",
    "warehouse_bookings": """
        SELECT l_orderkey * 10 + l_linenumber AS booking_id, l_orderkey AS flight_id, l_suppkey AS customer_id,
               l_extendedprice - 2000e0 AS fare FROM lineitem""",
}

# What each expression reads, so a query only carries the ones it needs.
_ORDER = list(CTES)


def _uses(text: str) -> set[str]:
    words = set()
    word = ""
    for ch in text + " ":
        if ch.isalnum() or ch == "_":
            word += ch
        else:
            words.add(word)
            word = ""
    return words & set(CTES)


def with_ctes(sql: str) -> str:
    """Prefix a statement with the expressions it depends on, in order of definition."""
    needed: set[str] = set()
    todo = _uses(sql)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo |= _uses(CTES[name]) - {name}
    sql = sql.strip()
    if not needed:
        return sql
    shared = "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({CTES[n].strip()})" for n in _ORDER if n in needed)
    own = sql.startswith("WITH ")
    return f"{shared},\n{sql[len('WITH '):].lstrip()}" if own else f"{shared}\n{sql}"
