"""Registered queries: one per operator or view, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroledger.functions.columns import (
    as_percent, calendar_parts, clamp, clean_number, compact_amount, contains_any, first_filled, flag, json_safe, lenient_timestamp,
    right_closed_bins, round_to, same_text, spaced, truthy)
from aeroledger.operators import (
    analytics, marts, ml, notifications, quality, rotation, rules, skew, views, warehouse)
from aeroledger.plans.bindings import BAG_MINUTES, NOW, Tables
from aeroledger.plans.oracles import big, dbl, r, s, with_ctes
from aeroledger.session import scratch_path
from aeroledger.schemas import ROTATION
from aeroledger.sources import sinks
from aeroledger.sources import tables as sources
from aeroledger.streaming import envelope, live


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def add(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = Query(build, with_ctes(sql) if sql else None)
        return build
    return add


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES[name].build(Tables(spark, folder))


# --- rotation -----------------------------------------------------------------------------------

query("rotation_delay", "SELECT * EXCLUDE (prev_cascade) FROM rotation")(lambda t: t.rotation())
# The same in slices of three rows, so that numbers and earlier legs are stitched at any size of the tables.
query("rotation_delay_sliced", "SELECT * FROM rotation")(lambda t: t.rotation(history=True, slice_rows=3).withColumnRenamed(
    "prev_is_cascade_delay", "prev_cascade"))

query("rotation_counts", f"""SELECT count(*) AS total_rows, {big('sum(is_cascade_delay)')} AS cascade_rows
                             FROM rotation""")(lambda t: rotation.rotation_counts(t.rotation()))

query("mart_rotation_delay", f"""
    SELECT flight_date, aircraft_id, count(*) AS total_flights, count(*) FILTER (WHERE delay_minutes > 0) AS delayed_flights,
           {big('sum(is_cascade_delay)')} AS cascade_delay_flights,
           {r(s('delay_minutes', 6) + ' / count(*)', 2)} AS average_delay_minutes,
           {r(s('turnaround_minutes', 6) + ' / nullif(count(turnaround_minutes), 0)', 2)} AS average_turnaround_minutes,
           {r(s('propagated_delay_min', 6), 2)} AS total_propagated_delay_minutes
    FROM rotation GROUP BY ALL""")(lambda t: rotation.rotation_delay_mart(t.rotation()))


# --- KPI marts ----------------------------------------------------------------------------------

query("load_factor", f"""
    SELECT route_id, scheduled_date_id AS flight_date, count(DISTINCT flight_id) AS flights,
           {big('sum(coalesce(n, 0))')} AS booked_seats, {big('sum(c_nationkey + 1)')} AS available_seats,
           {r("CAST(sum(coalesce(n, 0)) AS DOUBLE) / nullif(CAST(sum(c_nationkey + 1) AS DOUBLE), 0e0)", 4)} AS load_factor
    FROM flights_ord LEFT JOIN customer ON c_custkey = aircraft_id
         LEFT JOIN (SELECT flight_id, count(*) AS n FROM bookings_li WHERE NOT refunded GROUP BY 1) USING (flight_id)
    WHERE status IN ('COMPLETED', 'DEPARTED') GROUP BY ALL""")(
    lambda t: marts.load_factor(t.order_flights(), t.aircraft(), t.bookings()))

query("delay_minutes", f"""
    SELECT route_id, scheduled_date_id AS flight_date, count(*) AS flights,
           count(*) FILTER (WHERE delay_minutes > 15) AS delayed_flights,
           {r(s('delay_minutes', 6) + ' / nullif(count(delay_minutes), 0)', 2)} AS avg_delay_minutes,
           {r(s('delay_minutes', 6), 2)} AS total_delay_minutes,
           {r("100e0 * (CAST(count(*) FILTER (WHERE delay_minutes > 15) AS DOUBLE) / CAST(count(*) AS DOUBLE))", 2)}
               AS pct_flights_delayed
    FROM flights_ord WHERE status <> 'CANCELLED' GROUP BY ALL""")(lambda t: marts.delay_minutes(t.order_flights()))

query("cancellation_rate", f"""
    WITH planned AS (SELECT route_id, scheduled_date_id AS flight_date, count(*) AS scheduled_flights
                     FROM flights_ord GROUP BY ALL),
    reasons AS (SELECT f.route_id, scheduled_date_id AS flight_date, reason_code, count(*) AS n
                FROM cancels c JOIN flights_ord f USING (flight_id) GROUP BY ALL),
    tops AS (SELECT route_id, flight_date, {big('sum(n) OVER g')} AS cancelled, reason_code,
                    row_number() OVER (PARTITION BY route_id, flight_date ORDER BY n DESC, reason_code) AS place
             FROM reasons WINDOW g AS (PARTITION BY route_id, flight_date))
    SELECT p.*, coalesce(cancelled, 0) AS cancelled_flights, reason_code AS top_reason_code,
           {r("100e0 * (CAST(coalesce(cancelled, 0) AS DOUBLE) / scheduled_flights)", 2)} AS cancellation_rate_pct
    FROM planned p LEFT JOIN (SELECT * FROM tops WHERE place = 1) USING (route_id, flight_date)""")(
    lambda t: marts.cancellation_rate(t.order_flights(), t.cancellations()))

query("baggage_sla_daily", f"""
    SELECT airport, scan_time AS scan_date, count(*) AS bags_scanned, count(*) FILTER (WHERE late) AS sla_breaches,
           {r("100e0 * (1e0 - CAST(count(*) FILTER (WHERE late) AS DOUBLE) / CAST(count(*) AS DOUBLE))", 2)} AS baggage_sla_pct
    FROM scans GROUP BY ALL""")(lambda t: marts.baggage_sla(t.scans()))

query("route_revenue", f"""
    SELECT route_id, booking_time AS booking_date, count(*) AS bookings, {r(s('fare'), 2)} AS route_revenue
    FROM bookings_li JOIN flights_ord USING (flight_id) WHERE NOT refunded GROUP BY ALL""")(
    lambda t: marts.route_revenue(t.bookings(), t.order_flights()))

query("revenue_per_flight", f"""
    SELECT f.flight_id, route_id, scheduled_date_id AS flight_date, count(booking_id) AS bookings,
           {r(s('fare'), 2)} AS flight_revenue, {r(s('fare') + ' / nullif(count(fare), 0)', 2)} AS avg_fare
    FROM flights_ord f LEFT JOIN bookings_li b ON b.flight_id = f.flight_id AND NOT refunded GROUP BY ALL""")(
    lambda t: marts.revenue_per_flight(t.order_flights(), t.bookings()))

query("complaint_rate", f"""
    SELECT t.*, bookings, {r('1000e0 * (CAST(tickets AS DOUBLE) / bookings)', 2)} AS complaints_per_1000_bookings
    FROM (SELECT date_trunc('day', ts) AS day, event_type AS issue_type, count(*) AS tickets FROM events GROUP BY ALL) t
    JOIN (SELECT date_trunc('day', ts) AS day, count(*) AS bookings FROM events WHERE event_type = 'purchase' GROUP BY ALL)
         USING (day)""")(lambda t: marts.complaint_rate(t.tickets(), t.event_bookings()))

query("staging_flights", """SELECT flight_id, route_id, aircraft_id, scheduled_date_id, scheduled_departure, status,
    delay_minutes FROM flights_ord""")(lambda t: marts.staging("stg_flights", t.order_flights()))

# The other views: their table and SQL.
STAGED = {
    "stg_bookings": (Tables.bookings, """
        SELECT l_orderkey * 10 + l_linenumber AS booking_id, l_suppkey AS customer_id, l_orderkey AS flight_id,
               l_extendedprice AS fare, l_shipdate AS booking_time,
               CASE WHEN l_returnflag = 'R' THEN 'REFUNDED' ELSE 'CONFIRMED' END AS status FROM lineitem"""),
    "stg_baggage": (Tables.baggage, """
        SELECT l_orderkey * 10 + l_linenumber AS bag_id, l_orderkey * 10 + 1 AS booking_id, l_shipdate AS scan_time,
               nullif(l_returnflag, 'N') AS airport,
               CASE WHEN l_discount >= 0.08 THEN 'DELAYED' ELSE 'DELIVERED' END AS status FROM lineitem"""),
    "stg_cancellations": (Tables.cancellations, "SELECT flight_id, cancelled_at, reason_code FROM cancels"),
    "stg_support_tickets": (Tables.tickets, """
        SELECT event_id AS ticket_id, user_id AS booking_id, event_type AS issue_type, ts AS created_at FROM events"""),
    "stg_routes": (Tables.routes, """
        SELECT o_orderpriority AS route_id, min(o_custkey % 25) AS origin_airport_id, max(o_custkey % 25) AS dest_airport_id,
               CAST(count(*) AS DOUBLE) AS popularity FROM orders GROUP BY 1"""),
    "stg_airports": (Tables.airports, """
        SELECT n_nationkey AS airport_id, n_name AS city, r_name AS region, (n_nationkey + 1) * 100 AS capacity
        FROM nation JOIN region ON r_regionkey = n_regionkey"""),
    "stg_aircraft": (Tables.fleet, "SELECT c_custkey AS aircraft_id, c_mktsegment AS type, c_nationkey + 1 AS seat_capacity FROM customer"),
}
for _name, (_table, _sql) in STAGED.items():
    query(_name.replace("stg_", "staging_"), _sql)(lambda t, n=_name, f=_table: marts.staging(n, f(t)))


# --- validation and quality ---------------------------------------------------------------------

AUDIT = ("bookings.csv", "batch-1", NOW)


@query("validate_valid", """
    SELECT booking_id, customer_id, status, fare, booking_time, position, true AS _is_valid,
           'bookings.csv' AS _source_file, 'batch-1' AS _batch_id, TIMESTAMP '2024-02-01 06:00:00' AS _ingested_at
    FROM checked WHERE _reject_reason = ''""")
def _(t: Tables) -> DataFrame:
    valid, _ = quality.validate_and_split(t.raw_bookings(), ["booking_id"], ["status", "fare"], ["position"])
    return quality.add_audit_columns(valid, *AUDIT)


@query("validate_rejects", "SELECT * FROM checked WHERE _reject_reason <> ''")
def _(t: Tables) -> DataFrame:
    return quality.validate_and_split(t.raw_bookings(), ["booking_id"], ["status", "fare"], ["position"])[1]


def _silver(t: Tables) -> DataFrame:
    """Raw bookings against validated customers: every reference to a customer must hold."""
    known = t.raw("customer").filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("customer_id"))
    rules_ = quality.EntityRules(("booking_id",), ("status", "fare"),
                                 (quality.Reference("customers", "customer_id", ("customer_id",)),),
                                 lambda: quality.positive("fare"))
    return quality.bronze_to_silver(t.raw_bookings(), rules_, {"customers": known}, ["position"])


SILVER_SQL = """
    marked AS (SELECT b.*, concat(CASE WHEN c_custkey IS NULL THEN 'ref_missing;' ELSE '' END,
                                  CASE WHEN fare > 0 THEN '' ELSE 'rule_failed;' END) AS early
               FROM raw_bookings b LEFT JOIN customer ON c_custkey = customer_id AND c_acctbal > 0),
    silver AS (SELECT * EXCLUDE (early), early AS _reject_reason FROM marked WHERE early <> ''
               UNION ALL
               SELECT * EXCLUDE (early), concat(CASE WHEN booking_id IS NULL THEN 'pk_null;' ELSE '' END,
                   CASE WHEN status IS NULL THEN 'status_null;' ELSE '' END,
                   CASE WHEN row_number() OVER (PARTITION BY booking_id ORDER BY position) > 1
                        THEN 'duplicate_pk;' ELSE '' END)
               FROM marked WHERE early = '')"""

query("bronze_to_silver", f"WITH {SILVER_SQL} SELECT * FROM silver")(_silver)

query("reject_report", f"""WITH {SILVER_SQL}
    SELECT 'bookings' AS entity, count(*) AS raw_rows, count(*) FILTER (WHERE _reject_reason = '') AS valid_rows,
           count(*) FILTER (WHERE _reject_reason <> '') AS rejected_rows FROM silver""")(
    lambda t: quality.reject_report({"bookings": _silver(t)}))

query("referential_filter", """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity FROM lineitem
    WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
      AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 40)""")(
    lambda t: quality.referential_filter(
        t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity"),
        [("l_suppkey", t.raw("supplier").filter("s_acctbal > 0"), "s_suppkey"),
         ("l_partkey", t.raw("part").filter("p_size <= 40"), "p_partkey")]))

query("business_rules", """
    SELECT * FROM warehouse_flights WHERE status IN ('COMPLETED', 'DEPARTED') AND (delay_minutes IS NULL OR delay_minutes >= 0)""")(
    lambda t: quality.business_rule_filter(t.warehouse()["fact_flight"].drop("_ingested_at"), quality.flight_rule()))

query("derive_cancellations", """
    SELECT flight_id, scheduled_departure AS cancelled_at, 'UNSPECIFIED' AS reason_code
    FROM flights_ev WHERE status = 'CANCELLED'""")(lambda t: quality.derive_cancellations(t.flights()))

query("upsert_orders", """
    WITH source AS (SELECT CASE WHEN l_returnflag = 'R' THEN l_orderkey ELSE -l_orderkey END AS k,
                           min(l_shipdate) AS d, CAST(max(l_quantity) AS DOUBLE) AS p FROM lineitem GROUP BY 1)
    SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT k FROM source)
    UNION ALL SELECT k, d, p FROM source""")(
    lambda t: warehouse.upsert(
        t.raw("orders").select("o_orderkey", "o_orderdate", "o_totalprice"),
        t.raw("lineitem").groupBy(F.when(F.col("l_returnflag") == "R", F.col("l_orderkey"))
                                  .otherwise(-F.col("l_orderkey")).alias("o_orderkey"))
        .agg(F.min("l_shipdate").alias("o_orderdate"), F.max("l_quantity").alias("o_totalprice")), ["o_orderkey"]))


def _orphans(child: str, column: str, parent: str) -> str:
    return f"(SELECT count(*) FROM {child} c WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.k = c.{column}))"


SUITE_SQL = [
    ("null_pk_fact_flight", "fact_flight", "(SELECT count(*) FROM warehouse_flights WHERE flight_id IS NULL)"),
    ("range_delay_minutes_negative", "fact_flight", "(SELECT count(*) FROM warehouse_flights WHERE delay_minutes < 0)"),
    ("valid_flight_status", "fact_flight", "(SELECT count(*) FROM warehouse_flights WHERE status = 'HELD')"),
    ("dup_pk_fact_flight", "fact_flight",
     "(SELECT count(*) FROM (SELECT 1 FROM warehouse_flights GROUP BY flight_id HAVING count(*) > 1))"),
    ("ref_integrity_flight_to_route", "fact_flight", "(SELECT count(*) FROM warehouse_flights WHERE route_id = '5-LOW')"),
    ("null_pk_fact_booking", "fact_booking", "(SELECT count(*) FROM warehouse_bookings WHERE booking_id IS NULL)"),
    ("range_fare_non_positive", "fact_booking", "(SELECT count(*) FROM warehouse_bookings WHERE fare <= 0)"),
    ("dup_pk_fact_booking", "fact_booking",
     "(SELECT count(*) FROM (SELECT 1 FROM warehouse_bookings GROUP BY booking_id HAVING count(*) > 1))"),
    ("ref_integrity_booking_to_flight", "fact_booking",
     _orphans("warehouse_bookings", "flight_id", "(SELECT flight_id AS k FROM warehouse_flights)")),
    ("ref_integrity_booking_to_customer", "fact_booking",
     _orphans("warehouse_bookings", "customer_id", "(SELECT s_suppkey AS k FROM supplier WHERE s_acctbal > 0)")),
    ("ref_integrity_baggage_to_booking", "fact_baggage",
     _orphans("(SELECT event_id * 10 + 1 AS b FROM events)", "b", "(SELECT booking_id AS k FROM warehouse_bookings)")),
    ("ref_integrity_support_to_booking", "fact_support_ticket",
     _orphans("(SELECT nullif(user_id, 8) AS b FROM events)", "b", "(SELECT booking_id AS k FROM warehouse_bookings)")),
    ("range_fare_snapshot_price_non_positive", "fact_fare_snapshot", "(SELECT count(*) FROM part WHERE p_retailprice - 1000e0 <= 0)"),
]

query("dq_suite", "SELECT *, CAST(0 AS BIGINT) AS threshold, CASE WHEN violations <= 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ("
      + " UNION ALL ".join(f"SELECT '{n}' AS check_name, '{t}' AS table_name, {q} AS violations" for n, t, q in SUITE_SQL) + ")")(
    lambda t: quality.dq_suite(t.warehouse()))

query("dq_gate", "SELECT count(*) FILTER (WHERE violations <= 0) AS passed, count(*) AS total FROM ("
      + " UNION ALL ".join(f"SELECT {q} AS violations" for _, _, q in SUITE_SQL) + ")")(
    lambda t: quality.dq_gate(quality.dq_suite(t.warehouse())).select("passed", "total"))

query("null_keys", """
    SELECT 'fact_flight.flight_id' AS check_name, 'fact_flight' AS table_name,
           count(*) FILTER (WHERE flight_id IS NULL) AS violations FROM warehouse_flights
    UNION ALL SELECT 'fact_booking.booking_id', 'fact_booking', count(*) FILTER (WHERE booking_id IS NULL) FROM warehouse_bookings
    UNION ALL SELECT 'fact_baggage.bag_id', 'fact_baggage', count(*) FILTER (WHERE event_id IS NULL) FROM events
    UNION ALL SELECT 'fact_support_ticket.ticket_id', 'fact_support_ticket', count(*) FILTER (WHERE event_id IS NULL) FROM events""")(
    lambda t: quality.null_key_counts(t.warehouse()))

query("dup_keys", """
    SELECT 'fact_flight' AS table_name, CAST(flight_id AS VARCHAR) AS key, count(*) AS n FROM warehouse_flights
    GROUP BY flight_id HAVING count(*) > 1
    UNION ALL SELECT 'fact_booking', CAST(booking_id AS VARCHAR), count(*) FROM warehouse_bookings
    GROUP BY booking_id HAVING count(*) > 1""")(
    lambda t: quality.dup_keys(t.warehouse(), {"fact_flight": "flight_id", "fact_booking": "booking_id"}))

query("volume_anomaly", """
    SELECT scheduled_date_id, n AS n_rows, avg(n) OVER () AS avg_daily,
           CASE WHEN n < 0.3e0 * avg(n) OVER () THEN 'LOW_VOLUME_ALERT' ELSE 'OK' END AS flag
    FROM (SELECT scheduled_date_id, count(*) AS n FROM warehouse_flights GROUP BY 1)""")(
    lambda t: quality.volume_by_day(t.warehouse()["fact_flight"]))

query("low_volume_days", """
    WITH daily AS (SELECT scheduled_date_id, count(*) AS n_rows FROM warehouse_flights GROUP BY 1)
    SELECT * FROM daily WHERE n_rows < 0.3e0 * (SELECT avg(n_rows) FROM daily)""")(
    lambda t: quality.low_volume_days(t.warehouse()["fact_flight"]))

CLOCK = datetime(2001, 8, 2, 10, 30, tzinfo=timezone.utc)
query("load_freshness", """
    SELECT 'freshness_fact_flight' AS check_name, 'fact_flight' AS table_name, h AS hours_since_load,
           CASE WHEN h < 24 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (SELECT date_diff('hour', max(o_orderdate), TIMESTAMP '2001-08-02 10:30:00') AS h FROM orders)""")(
    lambda t: quality.load_freshness(t.warehouse()["fact_flight"], F.lit(CLOCK).cast("timestamp")))

# The whole gate: the suite and the freshness check.
query("dq_gate_fresh", "SELECT count(*) FILTER (WHERE violations <= 0) AS passed, count(*) AS total FROM ("
      + " UNION ALL ".join(f"SELECT {q} AS violations" for _, _, q in SUITE_SQL)
      + """ UNION ALL SELECT CASE WHEN date_diff('hour', max(o_orderdate), TIMESTAMP '2001-08-02 10:30:00') < 24
            THEN 0 ELSE 1 END FROM orders)""")(
    lambda t: (lambda house: quality.dq_gate(quality.dq_suite(house).select("check_name", "status").unionByName(
        quality.load_freshness(house["fact_flight"], F.lit(CLOCK).cast("timestamp")).select("check_name", "status")))
        .select("passed", "total"))(t.warehouse()))

query("test_not_null", "SELECT * FROM raw_bookings WHERE status IS NULL")(
    lambda t: quality.null_violations(t.raw_bookings(), "status"))
query("test_unique", """SELECT booking_id, count(*) AS n FROM raw_bookings WHERE booking_id IS NOT NULL
                        GROUP BY 1 HAVING count(*) > 1""")(
    lambda t: quality.uniqueness_violations(t.raw_bookings(), "booking_id"))
query("test_accepted_values", """SELECT status AS value_field, count(*) AS n_records FROM warehouse_flights
                                 WHERE status NOT IN ('COMPLETED', 'DEPARTED') GROUP BY 1""")(
    lambda t: quality.unaccepted_values(t.warehouse()["fact_flight"], "status", ["COMPLETED", "DEPARTED"]))
query("test_relationships", """
    SELECT l_partkey AS from_field, count(*) AS n_records FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40) GROUP BY 1""")(
    lambda t: quality.broken_relationships(t.raw("lineitem"), "l_partkey", t.raw("part").filter("p_size <= 40"), "p_partkey"))
query("test_non_negative", "SELECT * FROM raw_bookings WHERE fare < 0")(
    lambda t: quality.negative_values(t.raw_bookings(), "fare"))

query("model_tests", """
    SELECT *, CAST(0 AS BIGINT) AS threshold, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
    SELECT 'not_null_stg_flights_flight_id' AS check_name, 'stg_flights' AS table_name,
           (SELECT count(*) FROM warehouse_flights WHERE flight_id IS NULL) AS violations
    UNION ALL SELECT 'not_null_stg_flights_route_id', 'stg_flights', (SELECT count(*) FROM warehouse_flights WHERE route_id IS NULL)
    UNION ALL SELECT 'unique_stg_flights_flight_id', 'stg_flights', (SELECT count(*) FROM (SELECT 1 FROM warehouse_flights
        WHERE flight_id IS NOT NULL GROUP BY flight_id HAVING count(*) > 1))
    UNION ALL SELECT 'accepted_values_stg_flights_status', 'stg_flights', (SELECT count(DISTINCT status) FROM warehouse_flights
        WHERE status = 'HELD')
    UNION ALL SELECT 'not_null_stg_bookings_booking_id', 'stg_bookings', (SELECT count(*) FROM warehouse_bookings WHERE booking_id IS NULL)
    UNION ALL SELECT 'not_null_stg_bookings_fare', 'stg_bookings', (SELECT count(*) FROM warehouse_bookings WHERE fare IS NULL)
    UNION ALL SELECT 'unique_stg_bookings_booking_id', 'stg_bookings', (SELECT count(*) FROM (SELECT 1 FROM warehouse_bookings
        GROUP BY booking_id HAVING count(*) > 1))
    UNION ALL SELECT 'relationships_stg_bookings_flight_id', 'stg_bookings', (SELECT count(DISTINCT flight_id) FROM warehouse_bookings
        WHERE flight_id NOT IN (SELECT flight_id FROM warehouse_flights WHERE flight_id IS NOT NULL)))""")(
    lambda t: quality.model_tests({"stg_flights": t.warehouse()["fact_flight"], "stg_bookings": t.warehouse()["fact_booking"]}))


# All models: marts and rotation by the SQL of their own queries.
MODEL_QUERIES = {"mart_load_factor": "load_factor", "mart_delay_minutes": "delay_minutes", "mart_cancellation_rate": "cancellation_rate",
                 "mart_baggage_sla": "baggage_sla_daily", "mart_route_revenue": "route_revenue",
                 "mart_revenue_per_flight": "revenue_per_flight", "mart_customer_complaint_rate": "complaint_rate",
                 "stg_rotation_delay": "rotation_delay", "mart_rotation_delay": "mart_rotation_delay",
                 **{n: n.replace("stg_", "staging_") for n in ("stg_flights", *STAGED)}}


def _model_tests_sql() -> str:
    found = []
    for model, tests in quality.MODEL_TESTS.items():
        rows = f"({QUERIES[MODEL_QUERIES[model]].sql})"
        checks = {f"not_null_{model}_{c}": f"count(*) FROM {rows} WHERE {c} IS NULL" for c in tests.get("not_null", [])}
        checks |= {f"unique_{model}_{c}": f"count(*) FROM (SELECT {c} FROM {rows} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
                   for c in tests.get("unique", [])}
        checks |= {f"accepted_values_{model}_{c}": f"count(DISTINCT {c}) FROM {rows} WHERE {c} NOT IN {tuple(values)}"
                   for c, values in tests.get("accepted", {}).items()}
        checks |= {f"relationships_{model}_{c}": f"""count(DISTINCT {c}) FROM {rows} WHERE {c} NOT IN (
                       SELECT {key} FROM ({QUERIES[MODEL_QUERIES[other]].sql}) WHERE {key} IS NOT NULL)"""
                   for c, other, key in tests.get("relations", [])}
        found += [f"SELECT '{n}' AS check_name, '{model}' AS table_name, (SELECT {q}) AS violations" for n, q in checks.items()]
    return ("SELECT *, CAST(0 AS BIGINT) AS threshold, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ("
            + " UNION ALL ".join(found) + ")")


@query("model_tests_all")
def _(t: Tables) -> DataFrame:
    return quality.model_tests({model: QUERIES[name].build(t) for model, name in MODEL_QUERIES.items()})


QUERIES["model_tests_all"] = Query(QUERIES["model_tests_all"].build, _model_tests_sql())


def _loose(t: Tables) -> DataFrame:
    return t.raw("lineitem").select("l_returnflag", F.nullif("l_discount", F.lit(0.0)).alias("discount"), "l_tax")


LOOSE = "(SELECT l_returnflag, nullif(l_discount, 0) AS discount, l_tax FROM lineitem)"

query("profile", f"""
    SELECT 'lineitem' AS dataset, {big('sum(n)')} AS rows, CAST(3 AS BIGINT) AS columns,
           {big('coalesce(sum(n) FILTER (WHERE discount IS NULL), 0)')} AS null_rows, {big('sum(n - 1)')} AS duplicate_rows
    FROM (SELECT *, count(*) AS n FROM {LOOSE} GROUP BY ALL)""")(lambda t: quality.profile(_loose(t), "lineitem"))

query("dataset_quality", f"""
    SELECT 'lineitem' AS dataset, true AS dataset_exists, {big('sum(n)')} AS rows,
           {big('coalesce(sum(n) FILTER (WHERE discount IS NULL), 0)')} AS null_values, {big('sum(n - 1)')} AS duplicate_rows,
           CASE WHEN sum(n - 1) > 0 THEN 'CHECK' ELSE 'PASS' END AS status
    FROM (SELECT *, count(*) AS n FROM {LOOSE} GROUP BY ALL)
    UNION ALL SELECT 'orders', true, count(*), 0, 0, 'PASS' FROM orders
    UNION ALL SELECT 'audit', false, 0, NULL, NULL, 'MISSING'""")(
    lambda t: quality.dataset_quality(t.spark, {"lineitem": _loose(t), "orders": t.raw("orders"), "audit": None}))

LINEITEM = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
NULLS = " + ".join(f"({c} IS NULL)::BIGINT" for c in LINEITEM)

query("profile_all_columns", f"""
    SELECT 'lineitem' AS dataset, {big('sum(n)')} AS rows, CAST({len(LINEITEM)} AS BIGINT) AS columns,
           {big('coalesce(sum(n) FILTER (WHERE nulls > 0), 0)')} AS null_rows, {big('sum(n - 1)')} AS duplicate_rows
    FROM (SELECT *, {NULLS} AS nulls, count(*) AS n FROM lineitem GROUP BY ALL)""")(
    lambda t: quality.profile(t.raw("lineitem"), "lineitem"))

query("dataset_quality_all_columns", f"""
    SELECT 'lineitem' AS dataset, true AS dataset_exists, {big('sum(n)')} AS rows, {big('sum(n * nulls)')} AS null_values,
           {big('sum(n - 1)')} AS duplicate_rows, CASE WHEN sum(n - 1) > 0 THEN 'CHECK' ELSE 'PASS' END AS status
    FROM (SELECT *, {NULLS} AS nulls, count(*) AS n FROM lineitem GROUP BY ALL)
    UNION ALL SELECT 'orders', true, count(*), 0, 0, 'PASS' FROM orders
    UNION ALL SELECT 'audit', false, 0, NULL, NULL, 'MISSING'""")(
    lambda t: quality.dataset_quality(t.spark, {"lineitem": t.raw("lineitem"), "orders": t.raw("orders"), "audit": None}))

query("dataset_states", f"""
    SELECT 'lineitem' AS dataset, true AS dataset_exists, {big('sum(n)')} AS rows, {big('sum(n * nulls)')} AS null_values,
           {big('sum(n - 1)')} AS duplicate_rows, CASE WHEN sum(n - 1) > 0 THEN 'CHECK' ELSE 'PASS' END AS status, CAST(NULL AS VARCHAR) AS error
    FROM (SELECT *, {NULLS} AS nulls, count(*) AS n FROM lineitem GROUP BY ALL)
    UNION ALL SELECT 'orders', true, count(*), 0, 0, 'PASS', NULL FROM orders
    UNION ALL SELECT 'audit', false, 0, NULL, NULL, 'MISSING', NULL""")(
    lambda t: quality.dataset_states(t.spark, {n: f"{t.folder}/{n}.parquet" for n in ("lineitem", "orders", "audit")}))

query("row_counts", "SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem "
      "UNION ALL SELECT 'customer', count(*) FROM customer")(
    lambda t: sources.row_counts({n: t.raw(n) for n in ("orders", "lineitem", "customer")}))

query("failed_checks", "SELECT check_name, table_name, violations FROM ("
      + " UNION ALL ".join(f"SELECT '{n}' AS check_name, '{t}' AS table_name, {q} AS violations" for n, t, q in SUITE_SQL)
      + ") WHERE violations > 0")(
    lambda t: warehouse.failed_checks(quality.dq_suite(t.warehouse()).withColumns(
        {"run_at": F.lit(NOW).cast("timestamp"), "check_id": F.col("check_name")}))
    .select("check_name", "table_name", "violations"))


# --- analytics ----------------------------------------------------------------------------------

query("route_profitability", "SELECT * FROM profit")(lambda t: t.profitability())
query("bag_cycle_sla", "SELECT * FROM sla")(lambda t: t.bag_cycles())
query("passenger_experience", """
    SELECT event_id AS ticket_id, user_id AS booking_id, event_type AS issue_type, ts AS created_at,
           CAST(ts AS DATE) AS ticket_date FROM events""")(
    lambda t: analytics.passenger_experience(t.tickets(), t.event_bookings()))
query("passenger_bookings", """
    SELECT event_id AS ticket_id, user_id AS booking_id, event_type AS issue_type, ts AS created_at, CAST(ts AS DATE) AS ticket_date,
           booking_time FROM events LEFT JOIN (SELECT user_id, min(ts) AS booking_time FROM events WHERE event_type = 'purchase'
           GROUP BY 1) USING (user_id)""")(
    lambda t: analytics.passenger_experience(t.tickets(), t.event_bookings(), ["booking_time"]))
query("issue_summary", "SELECT * FROM issues")(lambda t: analytics.issue_summary(t.tickets()))
query("route_demand_daily", "SELECT * FROM demand")(lambda t: t.demand())
query("cancellation_anomalies", "SELECT * FROM anomalies")(lambda t: t.anomalies())

query("quantile", " UNION ALL ".join(
    f"SELECT {q}e0 AS q, quantile_cont(value, {q}) AS quantile FROM events" for q in (0.25, 0.5, 0.75, 0.99)))(
    lambda t: skew.exact_quantiles(t.raw("events"), "value", (0.25, 0.5, 0.75, 0.99)))

query("number_columns", f"""
    SELECT o_orderkey, o_totalprice AS cleaned, {r('o_totalprice', 0)} AS whole,
           CASE WHEN o_totalprice / 1e6 <= 1 THEN o_totalprice / 1e6 * 100e0 ELSE o_totalprice / 1e6 END AS share
    FROM orders""")(
    lambda t: t.raw("orders").select(
        "o_orderkey", clean_number(F.concat(F.lit("₹ "), F.format_number("o_totalprice", 2), F.lit(" %"))).alias("cleaned"),
        round_to("o_totalprice", 0).alias("whole"), as_percent(F.col("o_totalprice") / 1e6).alias("share")))

query("compact_amounts", """
    SELECT event_id, CASE WHEN v >= 1e6 THEN printf('%.2fM', v / 1e6) WHEN v >= 1e3 THEN printf('%.1fK', v / 1e3)
                     ELSE printf('%.0f', v) END AS amount
    FROM (SELECT event_id, floor(value) * 100000e0 AS v FROM events)""")(
    lambda t: t.raw("events").select("event_id", compact_amount(F.floor("value") * 100000.0).alias("amount")))


query("calendar", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           CAST(day(o_orderdate) AS INTEGER) AS day, dayname(o_orderdate) AS day_of_week, isodow(o_orderdate) >= 6 AS is_weekend
    FROM orders""")(
    lambda t: t.raw("orders").select("o_orderkey", *[c.alias(n) for n, c in calendar_parts("o_orderdate").items()]))

query("text_columns", """
    SELECT c_custkey, c_mktsegment = 'BUILDING' AS builds, contains(c_name, '12') OR contains(c_mktsegment, '12') AS found,
           CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN c_name ELSE c_mktsegment END AS label,
           replace(concat(c_mktsegment, '_', c_nationkey), '_', ' ') AS spaced, c_nationkey = 1 AS yes,
           CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS in_credit, CAST(NULL AS TIMESTAMP) AS no_time FROM customer""")(
    lambda t: t.raw("customer").select(
        "c_custkey", same_text("c_mktsegment", "building").alias("builds"), contains_any("12", "c_name", "c_mktsegment").alias("found"),
        first_filled(F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).otherwise(F.lit("")), "c_name").alias("label"),
        spaced(F.concat_ws("_", "c_mktsegment", "c_nationkey")).alias("spaced"), truthy("c_nationkey").alias("yes"),
        flag(F.col("c_acctbal") > 0).alias("in_credit"), lenient_timestamp("c_name").alias("no_time")))

query("risk_bins", """
    SELECT event_id, CASE WHEN value / 100e0 <= 0.3e0 THEN 'LOW' WHEN value / 100e0 <= 0.6e0 THEN 'MEDIUM'
                          WHEN value / 100e0 <= 1.01e0 THEN 'HIGH' END AS level,
           least(greatest(value, 10e0), 100e0) AS bounded FROM events""")(
    lambda t: t.raw("events").select(
        "event_id", right_closed_bins(F.col("value") / 100.0, (0.30, 0.60, 1.01), ("LOW", "MEDIUM", "HIGH")).alias("level"),
        clamp("value", 10.0, 100.0).alias("bounded")))

query("json_safe", """
    SELECT event_id, CAST(ts AS VARCHAR) AS ts, CASE WHEN value >= 1 THEN value END AS value FROM
        (SELECT event_id, date_trunc('second', ts) AS ts, value FROM events)""")(
    lambda t: json_safe(t.raw("events").select(
        "event_id", F.date_trunc("second", "ts").alias("ts"),
        F.when(F.col("value") >= 1, F.col("value")).otherwise(F.lit(float("nan"))).alias("value"))))


# --- files and tables ---------------------------------------------------------------------------

@query("stg_rotation_delay", "SELECT * EXCLUDE (prev_cascade) FROM rotation")
def _(t: Tables) -> DataFrame:
    """The rotation table after a round trip through day partitions."""
    path = scratch_path(t.spark, "rotation-by-day")
    sinks.write_partitioned(t.rotation(), path, "flight_date")
    return sources.read_table(t.spark, path).select(*ROTATION.fieldNames())


@query("bronze_csv", """
    SELECT CAST(booking_id AS VARCHAR) AS booking_id, CAST(customer_id AS VARCHAR) AS customer_id, status, fare,
           date_trunc('second', booking_time) AS booking_time, _reject_reason FROM checked""")
def _(t: Tables) -> DataFrame:
    """Raw bookings through CSV files; the order of the rows in the files decides which copy of a key is kept."""
    path = scratch_path(t.spark, "bookings.csv")
    (t.raw_bookings().repartitionByRange("position").sortWithinPartitions("position")
     .select("booking_id", "customer_id", F.lit(None).cast("string").alias("flight_id"), "fare",
             F.date_trunc("second", "booking_time").alias("booking_time"), "status")
     .write.option("header", True).csv(path))
    raw = sources.read_bronze(t.spark, path, "bookings")
    return (quality.flag_rejects(raw, ["booking_id"], ["status", "fare"], sources.INPUT_ORDER)
            .drop("flight_id", *sources.INPUT_ORDER))


@query("warehouse_load", """
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name,
           CASE WHEN c_acctbal > 0 THEN 'GOLD' ELSE c_mktsegment END AS tier,
           CASE WHEN c_acctbal > 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS home_region FROM customer
    UNION ALL SELECT concat('S', s_suppkey), s_name, 'GOLD', NULL FROM supplier""")
def _(t: Tables) -> DataFrame:
    """A first load of all customers, then one that updates some of them and adds others."""
    root = scratch_path(t.spark, "warehouse")
    people = t.raw("customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("tier"), F.col("c_nationkey").cast("string").alias("home_region"), "c_acctbal")
    gold = people.filter("c_acctbal > 0").select("customer_id", "name").unionByName(
        t.raw("supplier").select(F.concat(F.lit("S"), "s_suppkey").alias("customer_id"), F.col("s_name").alias("name")))
    for run, rows in (("first", people), ("second", gold.withColumns({"tier": F.lit("GOLD"), "home_region": F.lit(None)}))):
        warehouse.load_table(t.spark, root, "dim_customer", quality.add_audit_columns(rows, "customers.csv", run, NOW), run)
    return warehouse.warehouse_tables(t.spark, root)["dim_customer"].select("customer_id", "name", "tier", "home_region")


@query("warehouse_load_all", """
    SELECT 'dim_airport' AS table_name, count(*) AS n_rows FROM nation UNION ALL SELECT 'dim_aircraft', count(*) FROM customer
    UNION ALL SELECT 'dim_customer', count(*) FROM customer UNION ALL SELECT 'dim_date', count(DISTINCT o_orderdate) FROM orders
    UNION ALL SELECT 'dim_route', count(DISTINCT o_orderpriority) FROM orders UNION ALL SELECT 'fact_flight', count(*) FROM orders
    UNION ALL SELECT 'fact_cancellation', count(*) FROM cancels UNION ALL SELECT 'fact_booking', count(DISTINCT l_orderkey * 10 + l_linenumber) FROM lineitem
    UNION ALL SELECT 'fact_baggage', count(DISTINCT l_orderkey * 10 + l_linenumber) FROM lineitem UNION ALL SELECT 'fact_support_ticket', count(*) FROM events
    UNION ALL SELECT 'fact_fare_snapshot', count(*) FROM part""")
def _(t: Tables) -> DataFrame:
    """All tables of the warehouse, loaded and then loaded again, which must change nothing."""
    root, entities = scratch_path(t.spark, "warehouse"), t.entities()
    for entity in ("bookings", "baggage"):  # grouped from line items, once for both loads
        sinks.write_table(entities[entity], f"{root}/silver_{entity}")
        entities[entity] = sources.read_table(t.spark, f"{root}/silver_{entity}")
    for run in ("first", "second"):
        warehouse.load_warehouse(t.spark, root, {
            entity: quality.add_audit_columns(rows, f"{entity}.csv", run, NOW) for entity, rows in entities.items()}, run, grain="month")
    return sources.row_counts(warehouse.warehouse_tables(t.spark, root))

# Each warehouse table over its values: (entity, table, key that tells the loads apart, columns of the SQL, source of the SQL).
# The first load leaves out keys that end in 3 or T; the second brings these, and keys that end in 7 or H with a change.
LOADED = [
    ("airports", "dim_airport", "airport_id", {
        "airport_id": "n_nationkey", "city": "n_name", "region": "r_name", "capacity": "CAST((n_nationkey + 1) * 100 AS INTEGER)"},
     "nation JOIN region ON r_regionkey = n_regionkey", "capacity"),
    ("aircraft", "dim_aircraft", "aircraft_id", {
        "aircraft_id": "c_custkey", "type": "c_mktsegment", "seat_capacity": "CAST(c_nationkey + 1 AS INTEGER)"}, "customer", "type"),
    ("customers", "dim_customer", "customer_id", {
        "customer_id": "c_custkey", "name": "c_name", "tier": "c_mktsegment", "home_region": "CAST(c_nationkey AS VARCHAR)"},
     "customer", "tier"),
    ("dim_date", "dim_date", "date_id", {
        "date_id": "strftime(day, '%Y-%m-%d')", "date": "day", "year": "CAST(year(day) AS INTEGER)",
        "month": "CAST(month(day) AS INTEGER)", "day": "CAST(day(day) AS INTEGER)", "day_of_week": "dayname(day)",
        "is_weekend": "isodow(day) >= 6"}, "(SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)", "year"),
    ("routes", "dim_route", "route_id", {
        "route_id": "o_orderpriority", "origin_airport_id": "CAST(min(o_custkey % 25) AS VARCHAR)",
        "dest_airport_id": "CAST(max(o_custkey % 25) AS VARCHAR)", "popularity": "CAST(count(*) AS DOUBLE)"},
     "orders GROUP BY o_orderpriority", "popularity"),
    ("flights", "fact_flight", "flight_id", {
        "flight_id": "flight_id", "route_id": "route_id", "aircraft_id": "CAST(aircraft_id AS VARCHAR)",
        "scheduled_date_id": "scheduled_date_id", "scheduled_departure": "scheduled_departure", "status": "status",
        "delay_minutes": "delay_minutes"}, "flights_ord", "scheduled_departure"),
    ("cancellations", "fact_cancellation", "flight_id", {
        "flight_id": "flight_id", "cancelled_at": "cancelled_at", "reason_code": "reason_code"}, "cancels", "cancelled_at"),
    ("bookings", "fact_booking", "booking_id", {
        "booking_id": "booking_id", "customer_id": "CAST(b.customer_id AS VARCHAR)", "flight_id": "CAST(b.flight_id AS VARCHAR)",
        "fare": "b.fare", "booking_time": "b.booking_time", "status": "b.status"},
     """(SELECT l_orderkey * 10 + l_linenumber AS booking_id, min({'customer_id': l_suppkey, 'flight_id': l_orderkey,
             'fare': l_extendedprice, 'booking_time': l_shipdate,
             'status': CASE WHEN l_returnflag = 'R' THEN 'REFUNDED' ELSE 'CONFIRMED' END}) AS b FROM lineitem GROUP BY 1)""", "booking_time"),
    ("baggage", "fact_baggage", "bag_id", {
        "bag_id": "bag_id", "booking_id": "CAST(b.booking_id AS VARCHAR)", "scan_time": "b.scan_time", "airport": "b.airport",
        "status": "b.status"},
     """(SELECT l_orderkey * 10 + l_linenumber AS bag_id, arg_min({'booking_id': l_orderkey * 10 + 1, 'scan_time': l_shipdate,
             'airport': nullif(l_returnflag, 'N'), 'status': CASE WHEN l_discount >= 0.08 THEN 'DELAYED' ELSE 'DELIVERED' END},
             (l_shipdate, coalesce(nullif(l_returnflag, 'N'), ''), CASE WHEN l_discount >= 0.08 THEN 'DELAYED' ELSE 'DELIVERED' END)) AS b
         FROM lineitem GROUP BY 1)""", "scan_time"),
    ("support_tickets", "fact_support_ticket", "ticket_id", {
        "ticket_id": "event_id", "booking_id": "CAST(user_id AS VARCHAR)", "issue_type": "event_type", "created_at": "ts"},
     "events", "created_at"),
    ("fares", "fact_fare_snapshot", "cabin", {
        "route_id": "p_brand", "cabin": "p_partkey", "timestamp": "TIMESTAMP '2024-02-01 06:00:00'", "price": "p_retailprice"},
     "part", "price"),
]


def _loaded_twice(t: Tables, entity: str, table: str, key: str, changed: str) -> DataFrame:
    """The table after a first load and one that changes some of its rows and brings others."""
    root, end = scratch_path(t.spark, "warehouse"), F.right(F.col(key).cast("string"), F.lit(1))
    rows = t.entities()[entity]
    kind = rows.schema[changed].dataType.typeName()
    change = {"timestamp_ntz": F.col(changed) + F.make_dt_interval(F.lit(1)), "string": F.lit(None).cast("string")}.get(
        kind, F.col(changed) + 1)
    loads = {"first": rows.filter(~end.isin("3", "T")),
             "second": rows.filter(end.isin("3", "T", "7", "H")).withColumn(
                 changed, F.when(end.isin("7", "H"), change).otherwise(F.col(changed)))}
    for run_id, part in loads.items():
        part = part if entity != "flights" else warehouse.prepare_flights(part)
        warehouse.load_table(t.spark, root, table, quality.add_audit_columns(part, f"{entity}.csv", run_id, NOW), run_id,
                             grain="month")
    return warehouse.warehouse_tables(t.spark, root)[table]


def _register_loads() -> None:
    for entity, table, key, columns, source, changed in LOADED:
        def build(t: Tables, entity=entity, table=table, key=key, columns=columns, changed=changed) -> DataFrame:
            return _loaded_twice(t, entity, table, key, changed).select(*columns, "_batch_id")

        time = columns[changed] if changed in warehouse.PARTITION_TIME.values() else None
        text = {"type", "tier"}
        shown = {c: f"CAST({e} AS VARCHAR)" if c == key else e for c, e in columns.items()}
        is_new, is_changed = (f"right(CAST({columns[key]} AS VARCHAR), 1) IN ('{a}', '{b}')" for a, b in ("3T", "7H"))
        other = "NULL" if changed in text else f"{time} + INTERVAL 1 DAY" if time else f"{columns[changed]} + 1"
        shown[changed] = f"CASE WHEN {is_changed} THEN {other} ELSE {columns[changed]} END"
        if table == "fact_flight":
            shown["scheduled_date_id"] = f"strftime({shown[changed]}, '%Y-%m-%d')"
        picked = ", ".join(f"{e} AS {c}" for c, e in shown.items())
        query(f"warehouse_{table}", f"""
            SELECT {picked}, CASE WHEN {is_new} OR {is_changed} THEN 'second' ELSE 'first' END AS _batch_id FROM {source}""")(build)


_register_loads()


# --- models -------------------------------------------------------------------------------------

query("delay_features", "SELECT * FROM features")(lambda t: t.features())

query("delay_features_as_published", """
    SELECT * REPLACE (is_cascade_delay AS previous_cascade_indicator) FROM features""")(
    lambda t: ml.delay_features(t.rotation(), leak_free=False))

query("forecast_features", """
    SELECT flight_date, route_id, booking_count, CAST(day_index AS INTEGER) AS day_index, lag_1, lag_7, lag_14, rolling_7,
           CAST(dow AS INTEGER) AS dow, i < greatest(floor(n * 0.8e0), n - 7) AS is_train
    FROM full_rows WHERE n >= 14""")(lambda t: ml.forecast_features(t.demand()))

query("stratified_split", f"""
    SELECT future_delay, {big('count(*)')} AS size, CAST(floor(count(*) * 0.8e0 + 0.5e0) AS BIGINT) AS train_rows
    FROM features GROUP BY 1""")(
    lambda t: (lambda parts: parts[0].withColumn("part", F.lit(1)).unionByName(parts[1].withColumn("part", F.lit(0)))
               .groupBy("future_delay").agg(F.count(F.lit(1)).alias("size"), F.sum("part").cast("long").alias("train_rows")))(
        ml.stratified_split(t.features().select("flight_id", "future_delay"))))

def _delay_scored(t: Tables) -> tuple[DataFrame, DataFrame, object]:
    rows = t.published("features")
    train, test = ml.stratified_split(rows)
    model = ml.train_delay_model(train)
    return rows, test, model


@query("delay_model_scores")
def _(t: Tables) -> DataFrame:
    rows, _, model = _delay_scored(t)
    return ml.score_delay(model, rows).select("flight_id", "future_delay", "predicted_delay", "delay_probability",
                                              "delay_risk_level")


@query("delay_model_metrics")
def _(t: Tables) -> DataFrame:
    _, test, model = _delay_scored(t)
    return ml.classification_report(ml.score_delay(model, test))


@query("delay_model_importance")
def _(t: Tables) -> DataFrame:
    return ml.feature_importance(t.spark, _delay_scored(t)[2])


query("demand_forecast")(lambda t: ml.demand_forecast(t.published("demand"))[0])
query("forecast_metrics")(lambda t: ml.demand_forecast(t.published("demand"))[1])
query("analytics_metrics")(lambda t: analytics.analytics_metrics(
    t.spark, ml.demand_forecast(t.published("demand"))[1],
    {"sla_minutes": 45, "anomaly_z": 2, "severe_z": 3, "healthy_margin_pct": 20}))


# --- rules, alerts, notifications ---------------------------------------------------------------

query("delay_actions", "SELECT * FROM actions")(lambda t: t.actions())
query("top_actions", "SELECT * FROM actions ORDER BY priority, delay_probability DESC, flight_id LIMIT 10")(
    lambda t: rules.top_actions(t.actions()))
query("action_counts", "SELECT automation_action, count(*) AS n FROM actions GROUP BY 1")(
    lambda t: rules.value_counts(t.actions(), "automation_action"))

OPEN = ", 'OPEN' AS status, true AS notification_required"
query("delay_alerts", f"SELECT *{OPEN} FROM delay_alerts")(lambda t: rules.delay_alerts(t.actions()))
query("baggage_alerts", f"SELECT *{OPEN} FROM baggage_alerts")(lambda t: rules.baggage_alerts(t.bag_cycles(), BAG_MINUTES))
query("demand_alerts", f"SELECT *{OPEN} FROM demand_alerts")(
    lambda t: rules.demand_alerts(t.forecast().drop("booking_count")))
query("demand_alerts_vs_actual", """
    SELECT concat('DEMAND-', route_id) AS alert_id, route_id AS entity_id,
           printf('Forecast demand surge detected for route %s. Forecast demand=%.0f.', route_id, predicted_bookings) AS trigger_reason
    FROM forecast WHERE predicted_bookings >= booking_count * 1.2e0""")(
    lambda t: rules.demand_alerts(t.forecast()).select("alert_id", "entity_id", "trigger_reason"))
query("cancellation_alerts", f"SELECT *{OPEN} FROM cancel_alerts")(lambda t: rules.cancellation_alerts(t.anomalies()))
query("unified_alerts", "SELECT * FROM alerts")(lambda t: t.alerts())
query("alert_summary", """
    SELECT 'alert_type' AS dimension, alert_type AS value, count(*) AS n FROM alerts GROUP BY ALL
    UNION ALL SELECT 'automation_action', automation_action, count(*) FROM alerts GROUP BY ALL
    UNION ALL SELECT 'risk_level', risk_level, count(*) FROM alerts GROUP BY ALL""")(
    lambda t: rules.alert_summary(t.published("alerts")))

query("select_notifications", """
    WITH placed AS (SELECT *, CASE alert_type WHEN 'DELAY_RISK' THEN 0 WHEN 'BAGGAGE_SLA_BREACH' THEN 1
                                   WHEN 'DEMAND_SURGE' THEN 2 ELSE 3 END AS slot,
                           row_number() OVER (PARTITION BY alert_type ORDER BY priority, model_probability DESC NULLS LAST,
                                              alert_id, trigger_reason, event_day) AS nth FROM alerts),
    picked AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN nth = 1 THEN slot ELSE 4 END, priority,
                                            model_probability DESC NULLS LAST, alert_id, trigger_reason, event_day) AS place FROM placed)
    SELECT * EXCLUDE (slot, nth, place), CAST(place AS INTEGER) AS selection_rank FROM picked WHERE place <= 5""")(
    lambda t: notifications.select_notifications(t.published("alerts")))

query("route_notification", "SELECT alert_id, alert_type, automation_action, owner, recipient FROM routed")(
    lambda t: notifications.route_notification(t.published("alerts"))
    .select("alert_id", "alert_type", "automation_action", "owner", "recipient"))

query("notification_outbox", """
    SELECT message_id, event_day, timestamp, alert_id, entity_id, alert_type, risk_level, priority, automation_action,
           trigger_reason, owner, notification_channel, recipient,
           CASE WHEN notification_channel = 'EMAIL' THEN concat('[Operations] ', risk_level, ' Alert - ', entity_id) END AS subject,
           CASE WHEN notification_channel = 'EMAIL'
                THEN concat_ws(chr(10), 'OPERATIONS ALERT', concat('Alert ID: ', alert_id), concat('Alert Type: ', alert_type),
                    concat('Flight: ', entity_id), concat('Risk Level: ', risk_level), concat('Priority: ', priority),
                    concat('Delay Probability: ', pct), concat('Automated Action: ', automation_action),
                    concat('Trigger Reason: ', trigger_reason), concat('Owner: ', owner), 'Status: OPEN',
                    'Generated: 2024-02-01T06:00:00+00:00')
                ELSE concat_ws(chr(10), '*Operational Alert*', concat('*Alert ID:* ', alert_id), concat('*Alert Type:* ', alert_type),
                    concat('*Flight:* ', entity_id), concat('*Risk Level:* ', risk_level), concat('*Priority:* ', priority),
                    concat('*Delay Probability:* ', pct), concat('*Automated Action:* ', automation_action),
                    concat('*Trigger Reason:* ', trigger_reason), concat('*Owner:* ', owner), '*Status:* OPEN',
                    '*Generated:* 2024-02-01T06:00:00+00:00') END AS message
    FROM (SELECT *, printf('%.1f%%', coalesce(model_probability, 0e0) * 100e0) AS pct FROM sent)""")(lambda t: t.outbox())
query("message_ids", "SELECT count(*) AS messages, count(*) AS ids FROM sent")(
    lambda t: t.published("outbox").agg(F.count(F.lit(1)).alias("messages"), F.count_distinct("message_id").alias("ids")))

query("notification_audit", "SELECT * FROM audit")(lambda t: t.audit())
query("delivery_counts", """
    SELECT count(*) FILTER (WHERE status = 'SENT') AS sent, count(*) FILTER (WHERE status = 'FAILED') AS failed,
           count(*) FILTER (WHERE status = 'SENT' AND notification_channel = 'EMAIL') AS email_sent,
           count(*) FILTER (WHERE status = 'SENT' AND notification_channel = 'SLACK') AS slack_sent FROM audit""")(
    lambda t: notifications.delivery_counts(t.published("audit")))

query("acknowledge", """
    WITH newest AS (SELECT message_id FROM audit WHERE entity_id = '1-URGENT' ORDER BY timestamp DESC, message_id DESC LIMIT 1)
    SELECT a.* REPLACE (CASE WHEN n.message_id IS NULL THEN a.owner ELSE 'Duty Manager' END AS owner,
                        CASE WHEN n.message_id IS NULL THEN a.status ELSE 'ACKNOWLEDGED' END AS status,
                        CASE WHEN n.message_id IS NULL THEN NULL ELSE TIMESTAMP '2024-02-01 06:00:00' END AS acknowledged_at)
    FROM audit a LEFT JOIN newest n USING (message_id)""")(
    lambda t: notifications.acknowledge(t.published("audit"), "1-URGENT", "Duty Manager", NOW))


# --- views --------------------------------------------------------------------------------------

HEAD = f"""
    SELECT count(*) AS risk_scored_flights, count(*) FILTER (WHERE risk_level = 'HIGH') AS high_risk,
           count(*) FILTER (WHERE risk_level = 'MEDIUM') AS medium_risk, count(*) FILTER (WHERE risk_level = 'LOW') AS low_risk,
           count(*) FILTER (WHERE automation_action = 'URGENT_OPERATIONS_REVIEW') AS urgent_actions,
           count(*) FILTER (WHERE automation_action = 'AIRCRAFT_TURNAROUND_ALERT') AS aircraft_turnaround_alerts,
           (SELECT count(*) FROM audit WHERE status = 'SENT') AS notifications_sent,
           (SELECT count(*) FROM audit WHERE status = 'FAILED') AS notifications_failed,
           (SELECT count(*) FROM audit WHERE status = 'ACKNOWLEDGED') AS notifications_acknowledged,
           (SELECT count(*) FROM flights_ev) AS total_flights FROM actions"""


def _summary(t: Tables) -> DataFrame:
    return views.summary(t.flights(), t.published("actions"), t.published("audit"))


query("summary", HEAD)(_summary)
query("dashboard", f"""
    SELECT h.*, (SELECT count(*) FROM profit) AS route_profitability_rows, (SELECT count(*) FROM sla) AS baggage_sla_rows,
           (SELECT count(*) FROM events) AS passenger_experience_rows, (SELECT count(*) FROM demand) AS demand_rows,
           (SELECT count(*) FROM anomalies) AS cancellation_anomalies_rows FROM ({HEAD}) h""")(
    lambda t: views.dashboard(_summary(t), {
        "route_profitability": t.profitability(), "baggage_sla": t.bag_cycles(), "passenger_experience": t.tickets(),
        "demand": t.demand(), "cancellation_anomalies": t.anomalies()}))

PAGE = """flight_id, aircraft_id, route_id, delay_probability, risk_level, priority, automation_action, action_message, status"""
query("flights_view", f"""SELECT {PAGE} FROM actions WHERE risk_level = 'MEDIUM'
    ORDER BY delay_probability DESC, flight_id LIMIT 100""")(lambda t: views.flights_view(t.published("actions"), "medium"))
query("flight_detail", "SELECT * FROM actions WHERE flight_id = 4242")(
    lambda t: views.flight_detail(t.published("actions"), "4242"))
query("flights_live", """
    SELECT f.flight_id, f.route_id, f.aircraft_id, f.scheduled_departure, f.actual_departure, f.status, f.delay_minutes,
           risk_level, priority, automation_action, delay_probability
    FROM (SELECT * FROM flights_ev ORDER BY scheduled_departure, flight_id LIMIT 500) f
         LEFT JOIN actions USING (flight_id)""")(
    lambda t: views.flights_live(t.flights(), t.published("actions"), 500))
query("alerts_view", """
    SELECT a.*, (SELECT count(*) FROM alerts WHERE risk_level = 'HIGH') AS high_count,
           (SELECT count(*) FROM alerts WHERE risk_level = 'MEDIUM') AS medium_count
    FROM (SELECT * FROM alerts ORDER BY model_probability DESC NULLS LAST, alert_id, trigger_reason, event_day LIMIT 1000) a""")(
    lambda t: views.alerts_view(t.published("alerts")))
query("delay_risk", """SELECT * FROM actions WHERE risk_level <> 'LOW' ORDER BY delay_probability DESC, flight_id LIMIT 100""")(
    lambda t: views.delay_risk(t.published("actions")))
query("risk_distribution", f"""SELECT risk_level, count(*) AS n, {big('sum(count(*)) OVER ()')} AS total FROM actions GROUP BY 1""")(
    lambda t: views.risk_distribution(t.published("actions")))
query("notification_summary", """
    SELECT count(*) AS total, count(*) FILTER (WHERE status = 'SENT') AS sent, count(*) FILTER (WHERE status = 'FAILED') AS failed,
           count(*) FILTER (WHERE status = 'ACKNOWLEDGED') AS acknowledged FROM audit""")(
    lambda t: views.notification_summary(t.published("audit")))
query("notifications_view", """
    SELECT a.*, (SELECT count(*) FROM audit) AS total, (SELECT count(*) FROM audit WHERE status = 'SENT') AS sent,
           (SELECT count(*) FROM audit WHERE status = 'FAILED') AS failed, CAST(0 AS BIGINT) AS acknowledged
    FROM (SELECT * FROM audit ORDER BY timestamp DESC, alert_id, notification_channel, trigger_reason, message_id LIMIT 1000) a""")(
    lambda t: views.notifications_view(t.published("audit")))
query("route_profitability_view", "SELECT * FROM profit ORDER BY estimated_profit DESC, route_id LIMIT 3")(
    lambda t: views.route_profitability_view(t.profitability(), 3))
query("route_performance", "SELECT * FROM profit ORDER BY route_id LIMIT 100")(lambda t: views.route_performance(t.profitability()))
query("baggage_sla_view", """SELECT s.*, (SELECT count(*) FROM sla WHERE sla_breached) AS breach_count
    FROM (SELECT * FROM sla ORDER BY bag_id LIMIT 100) s""")(lambda t: views.baggage_sla_view(t.published("bag_cycles")))
query("baggage_issues", "SELECT * FROM sla WHERE cycle_minutes > 45 ORDER BY cycle_minutes DESC, bag_id LIMIT 100")(
    lambda t: views.baggage_issues(t.published("bag_cycles")))
query("baggage_issues_chart", "SELECT count(*) AS breach_count FROM sla WHERE sla_status = 'BREACH'")(
    lambda t: views.baggage_breach_count(t.published("bag_cycles")))
query("passenger_page", """SELECT event_id AS ticket_id, user_id AS booking_id, event_type AS issue_type, ts AS created_at,
    CAST(ts AS DATE) AS ticket_date FROM events ORDER BY event_id LIMIT 100""")(
    lambda t: views.page(analytics.passenger_experience(t.tickets(), t.event_bookings()), ["ticket_id"]))
query("demand_page", "SELECT * FROM demand ORDER BY flight_date, route_id LIMIT 1000")(
    lambda t: views.page(t.published("demand"), ["flight_date", "route_id"], 1000))
query("anomalies_view", "SELECT * FROM anomalies WHERE anomaly ORDER BY z_score DESC, cancel_date, route_id LIMIT 100")(
    lambda t: views.anomalies_view(t.published("anomalies")))
query("flight_search", f"""
    WITH hits AS (SELECT * FROM actions WHERE risk_level = 'HIGH' AND (contains(CAST(flight_id AS VARCHAR), '12')
                  OR contains(CAST(aircraft_id AS VARCHAR), '12') OR contains(lower(route_id), '12')))
    SELECT h.*, (SELECT count(*) FROM hits) AS matches,
           (SELECT CAST(greatest(1, ceil(count(*) / 10e0)) AS BIGINT) FROM hits) AS total_pages
    FROM (SELECT * FROM hits ORDER BY delay_probability DESC, flight_id LIMIT 10 OFFSET 10) h""")(
    lambda t: views.flight_search(t.published("actions"), "12", risk="HIGH", page_no=2))
query("risk_chart", f"""
    WITH head AS ({HEAD}) SELECT 'High' AS name, high_risk AS value FROM head UNION ALL SELECT 'Medium', medium_risk FROM head
    UNION ALL SELECT 'Low', low_risk FROM head""")(lambda t: views.risk_chart(_summary(t)))
query("action_chart", f"""
    WITH head AS ({HEAD}) SELECT 'Urgent Review' AS name, urgent_actions AS value FROM head
    UNION ALL SELECT 'Turnaround', aircraft_turnaround_alerts FROM head
    UNION ALL SELECT 'Monitoring', greatest(0, medium_risk - aircraft_turnaround_alerts) FROM head""")(
    lambda t: views.action_chart(_summary(t)))
query("high_risk_alerts", "SELECT * FROM alerts WHERE risk_level = 'HIGH'")(
    lambda t: views.alerts_of_risk(t.published("alerts"), "high"))
query("medium_count", "SELECT count(*) AS n FROM alerts WHERE risk_level = 'MEDIUM'")(
    lambda t: views.alerts_of_risk(t.published("alerts"), "medium").agg(F.count(F.lit(1)).alias("n")))
query("alert_queue", """
    SELECT * FROM alerts ORDER BY priority, model_probability DESC NULLS LAST, alert_id, trigger_reason, event_day LIMIT 30""")(
    lambda t: views.alert_queue(t.published("alerts")))
query("top_routes", """
    SELECT route_id AS route, total_revenue AS revenue, estimated_operating_cost AS cost, estimated_profit AS profit
    FROM profit ORDER BY 4 DESC, 1 LIMIT 10""")(lambda t: views.top_routes_by_profit(t.profitability()))
query("forecast_series", f"""
    SELECT CAST(forecast_date AS VARCHAR) AS label, {dbl('booking_count')} AS actual, predicted_bookings AS forecast
    FROM forecast ORDER BY forecast_date DESC, route_id DESC LIMIT 14""")(
    lambda t: views.forecast_series(t.published("forecast")))
query("top_demand", f"""SELECT route_id AS route, flight_date, {dbl('booking_count')} AS demand FROM demand
    ORDER BY booking_count DESC, flight_date, route_id LIMIT 10""")(lambda t: views.top_route_demand(t.published("demand")))
query("issue_chart", """SELECT replace(issue_type, '_', ' ') AS issue, ticket_count AS count FROM issues
    ORDER BY 2 DESC, 1 LIMIT 8""")(
    lambda t: views.issue_chart(t.tickets(), analytics.issue_summary(t.tickets())))
query("json_records", """
    SELECT concat('{"flight_date":"', flight_date, '","route_id":"', route_id, '","booking_count":', booking_count, '}') AS record
    FROM demand""")(lambda t: views.json_records(t.demand()))


@query("system_health", """
    SELECT *, 'degraded' AS status FROM (
        SELECT 'orders' AS dataset, count(*) > 0 AS dataset_exists FROM orders
        UNION ALL SELECT 'lineitem', count(*) > 0 FROM lineitem UNION ALL SELECT 'events', count(*) > 0 FROM events
        UNION ALL SELECT 'notification_audit', false)""")
def _(t: Tables) -> DataFrame:
    """A dataset is healthy when its folder exists and holds rows."""
    names = ("orders", "lineitem", "events")
    filled = sources.row_counts({n: t.raw(n) for n in names}).select(
        F.col("table_name").alias("dataset"), (F.col("n_rows") > 0).alias("filled"))
    found = sources.dataset_presence(t.spark, {n: f"{t.folder}/{n}.parquet" for n in (*names, "notification_audit")})
    return views.system_health(found.join(filled, "dataset", "left").withColumn(
        "dataset_exists", F.col("dataset_exists") & F.coalesce("filled", F.lit(False))))


# --- stream -------------------------------------------------------------------------------------

_STREAMED: dict[tuple[str, str], str] = {}


def _streamed(t: Tables) -> str:
    """Run the live-table stream over the whole input, once per session, and return its output folder."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _STREAMED:
        root = scratch_path(t.spark, "live")
        stream = Tables(live.stream_session(t.spark), t.folder).stream()
        live.run_available(stream, root, scratch_path(t.spark, "live-checkpoint"), "run-1")
        _STREAMED[key] = root
    return _STREAMED[key]


query("stream_envelope", """
    SELECT concat('E', event_id) AS event_id, kind AS event_type, topic, CAST(user_id AS VARCHAR) AS key, ts AS event_time
    FROM deliveries WHERE value >= 1 AND copy = 1""")(
    lambda t: envelope.parse_events(t.feed(t.raw("events"))).filter(F.col("event_id").isNotNull())
    .select("event_id", "event_type", "topic", "key", "event_time").distinct())

query("stream_dedup", "SELECT concat('E', event_id) AS event_id, kind AS event_type, topic FROM applied")(
    lambda t: live.ledger(t.spark, _streamed(t)).drop("consumed_at"))

query("stream_latest_state", """
    SELECT CAST(user_id AS VARCHAR) AS flight_id, arg_max(upper(event_type), ts) AS status, arg_max(value, ts) AS delay_minutes,
           max(ts) AS actual_departure, max(ts) AS event_time, arg_min(props, block * 1e9 + pos) AS route_id,
           concat('A', user_id) AS aircraft_id, arg_min(ts, block * 1e9 + pos) AS scheduled_departure
    FROM applied WHERE kind = 'flight_status' GROUP BY user_id""")(
    lambda t: live.live_table(t.spark, _streamed(t), "flight_status").drop("_updated_at"))
query("stream_latest_bags", """
    SELECT CAST(user_id AS VARCHAR) AS bag_id, concat('B', user_id) AS booking_id, arg_min(props, block * 1e9 + pos) AS airport,
           'LOADED' AS status, max(ts) AS scan_time, max(ts) AS event_time
    FROM applied WHERE kind = 'baggage_scan' GROUP BY user_id""")(
    lambda t: live.live_table(t.spark, _streamed(t), "baggage_scan").drop("_updated_at"))
query("stream_latest_bookings", """
    SELECT CAST(user_id AS VARCHAR) AS booking_id, concat('C', user_id) AS customer_id, arg_min(props, block * 1e9 + pos) AS flight_id,
           arg_min(value, block * 1e9 + pos) AS fare, arg_max(upper(event_type), ts) AS status,
           arg_min(ts, block * 1e9 + pos) AS booking_time, max(ts) AS event_time
    FROM applied WHERE kind = 'booking' GROUP BY user_id""")(
    lambda t: live.live_table(t.spark, _streamed(t), "booking").drop("_updated_at"))

query("stream_dead_letter", """
    SELECT CASE WHEN value < 1 THEN 'incomplete envelope' ELSE 'payload lacks status' END AS problem, count(*) AS n
    FROM deliveries WHERE value < 3 GROUP BY 1""")(
    lambda t: live.dead_letters(t.spark, _streamed(t)).groupBy("problem").agg(F.count(F.lit(1)).alias("n")))

query("stream_monitoring", """
    SELECT CASE WHEN value < 1 THEN 'unknown' ELSE topic END AS topic, count(*) FILTER (WHERE value >= 3 AND copy = 1) AS processed,
           count(*) FILTER (WHERE copy = 2) AS duplicates, count(*) FILTER (WHERE value < 3) AS errors
    FROM deliveries GROUP BY 1""")(
    lambda t: live.monitoring(t.spark, _streamed(t)).groupBy("topic").agg(
        *[F.sum(c).alias(c) for c in ("processed", "duplicates", "errors")]))


@query("stream_health", """
    SELECT count(*) FILTER (WHERE value >= 3 AND copy = 1) AS processed, count(*) FILTER (WHERE copy = 2) AS duplicates,
           count(*) FILTER (WHERE value < 3) AS errors, count(*) AS delivered,
           count(DISTINCT event_id) FILTER (WHERE value >= 3) AS unique_events FROM deliveries""")
def _(t: Tables) -> DataFrame:
    root = _streamed(t)
    return views.stream_health(live.monitoring(t.spark, root), live.ledger(t.spark, root))


@query("stream_checks", """
    SELECT check_name, 'stream_monitoring' AS table_name, CAST(v AS BIGINT) AS violations, CAST(0 AS BIGINT) AS threshold,
           CASE WHEN v = 0 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (SELECT 'stream_freshness_minutes_ok' AS check_name, 0 AS v
          UNION ALL SELECT 'stream_error_rate_ok', CASE WHEN count(*) FILTER (WHERE value < 3) > 0.05e0 * count(*)
                    THEN 1 ELSE 0 END FROM deliveries)
    UNION ALL SELECT 'stream_dedup_ledger_unique', 'stream_seen_events', 0, 0, 'PASS'""")
def _(t: Tables) -> DataFrame:
    root = _streamed(t)
    monitoring = live.monitoring(t.spark, root)
    # Ten minutes after the stream's last window, whenever the query runs.
    clock = monitoring.agg(F.max("window_end") + F.make_dt_interval(mins=F.lit(10))).scalar()
    return quality.stream_checks(clock, monitoring, live.ledger(t.spark, root))
