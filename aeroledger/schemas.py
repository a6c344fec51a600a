"""Declared schemas of the bronze files, warehouse tables and stream tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"str": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(),
          "ts": T.TimestampType(), "date": T.DateType(), "bool": T.BooleanType()}


def struct(spec: str) -> T.StructType:
    """``"flight_id:str delay:double"`` to a StructType (all nullable)."""
    fields = (item.split(":") for item in spec.split())
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields])


AUDIT = "_source_file:str _batch_id:str _ingested_at:ts"

# Raw entity files, in the order in which references resolve.
BRONZE = {name: struct(spec) for name, spec in {
    "airports": "airport_id:str city:str region:str capacity:int",
    "aircraft": "aircraft_id:str type:str seat_capacity:int",
    "routes": "route_id:str origin_airport_id:str dest_airport_id:str popularity:double",
    "customers": "customer_id:str name:str tier:str home_region:str",
    "dim_date": "date_id:str date:date year:int month:int day:int day_of_week:str is_weekend:bool",
    "flights": ("flight_id:str route_id:str aircraft_id:str scheduled_departure:ts actual_departure:ts "
                "status:str delay_minutes:double"),
    "bookings": "booking_id:str customer_id:str flight_id:str fare:double booking_time:ts status:str",
    "baggage": "bag_id:str booking_id:str scan_time:ts airport:str status:str",
    "support_tickets": "ticket_id:str booking_id:str issue_type:str created_at:ts",
    "fares": "route_id:str cabin:str timestamp:ts price:double",
}.items()}

WAREHOUSE = {name: struct(f"{spec} {AUDIT}") for name, spec in {
    "dim_airport": "airport_id:str city:str region:str capacity:int",
    "dim_aircraft": "aircraft_id:str type:str seat_capacity:int",
    "dim_customer": "customer_id:str name:str tier:str home_region:str",
    "dim_date": "date_id:str date:date year:int month:int day:int day_of_week:str is_weekend:bool",
    "dim_route": "route_id:str origin_airport_id:str dest_airport_id:str popularity:double",
    "fact_flight": ("flight_id:str route_id:str aircraft_id:str scheduled_date_id:str scheduled_departure:ts "
                    "actual_departure:ts status:str delay_minutes:double"),
    "fact_cancellation": "flight_id:str cancelled_at:ts reason_code:str",
    "fact_booking": "booking_id:str customer_id:str flight_id:str fare:double booking_time:ts status:str",
    "fact_baggage": "bag_id:str booking_id:str scan_time:ts airport:str status:str",
    "fact_support_ticket": "ticket_id:str booking_id:str issue_type:str created_at:ts",
    "fact_fare_snapshot": "route_id:str cabin:str timestamp:ts price:double",
}.items()}

WAREHOUSE_KEYS = {
    "dim_airport": ["airport_id"], "dim_aircraft": ["aircraft_id"], "dim_customer": ["customer_id"],
    "dim_date": ["date_id"], "dim_route": ["route_id"], "fact_flight": ["flight_id"],
    "fact_cancellation": ["flight_id"], "fact_booking": ["booking_id"], "fact_baggage": ["bag_id"],
    "fact_support_ticket": ["ticket_id"], "fact_fare_snapshot": ["route_id", "cabin", "timestamp"],
}

LOGS = {
    "dq_check_log": struct("check_id:str check_name:str table_name:str status:str details:str run_at:ts batch_id:str"),
    "pipeline_run_log": struct("run_id:str task_name:str status:str rows_affected:long started_at:ts ended_at:ts "
                               "error_message:str"),
    "stream_monitoring": struct("run_id:str topic:str window_start:ts window_end:ts processed:long duplicates:long "
                                "errors:long consumer_lag:long"),
}

ROTATION = struct("flight_id:str route_id:str aircraft_id:str flight_date:date rotation_sequence:int "
                  "scheduled_departure:ts actual_departure:ts status:str delay_minutes:double prev_flight_id:str "
                  "prev_scheduled_departure:ts prev_actual_departure:ts prev_delay_minutes:double "
                  "turnaround_minutes:double propagated_delay_min:double is_cascade_delay:int "
                  "delay_propagation_flag:str")

# Event types: topic, business key, event-time column, payload fields, columns a later event may change.
EVENT_TYPES = {
    "flight_status": {
        "topic": "flights.status", "key": "flight_id", "time": "scheduled_departure",
        "payload": struct("flight_id:str route_id:str aircraft_id:str status:str scheduled_departure:ts "
                          "actual_departure:ts delay_minutes:double"),
        "mutable": ["status", "actual_departure", "delay_minutes"], "live": "fact_flight_status_live"},
    "baggage_scan": {
        "topic": "baggage.scans", "key": "bag_id", "time": "scan_time",
        "payload": struct("bag_id:str booking_id:str airport:str status:str scan_time:ts"),
        "mutable": ["status", "scan_time"], "live": "fact_baggage_scan_live"},
    "booking": {
        "topic": "bookings.events", "key": "booking_id", "time": "booking_time",
        "payload": struct("booking_id:str customer_id:str flight_id:str fare:double status:str booking_time:ts"),
        "mutable": ["status"], "live": "fact_booking_live"},
}

NOTIFICATION_AUDIT = struct("message_id:str event_day:date timestamp:ts alert_id:str entity_id:str alert_type:str risk_level:str priority:int "
                            "automation_action:str trigger_reason:str owner:str notification_channel:str "
                            "recipient:str status:str error:str acknowledged_at:ts")

FLIGHT_STATUSES = ("SCHEDULED", "BOARDING", "DEPARTED", "COMPLETED", "CANCELLED")
