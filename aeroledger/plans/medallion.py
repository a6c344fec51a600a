"""The batch run from raw files to alerts, as stages over one Spark session.

Tables are written at stage borders only.  Within a stage everything is one
lazy plan.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroledger.operators import analytics, marts, ml, quality, rotation, rules, warehouse
from aeroledger.schemas import BRONZE, ROTATION
from aeroledger.sources import sinks, tables

# What a batch must leave behind, and the limits its metrics file states.
OUTPUTS = ("mart_load_factor", "mart_delay_minutes", "mart_cancellation_rate", "mart_baggage_sla", "mart_route_revenue",
           "mart_revenue_per_flight", "mart_customer_complaint_rate", "mart_rotation_delay_propagation", "mart_rotation_delay",
           "route_profitability", "baggage_sla", "passenger_experience", "passenger_issue_summary", "route_demand_daily",
           "cancellation_anomalies", "delay_features", "delay_model", "delay_model_report", "delay_predictions", "demand_forecast",
           "demand_forecast_metrics", "analytics_metrics", "delay_actions", "alerts")
THRESHOLDS = {"sla_minutes": 45, "anomaly_z": 2, "severe_z": 3, "healthy_margin_pct": 20}
AUDIT_SCHEMA = "run_id string, stage string, status string, started_at timestamp, ended_at timestamp, error string"


# --- bronze to silver ---------------------------------------------------------------------------

def silver_table(spark: SparkSession, silver: str, entity: str) -> DataFrame:
    """Validated rows of an entity (the folder name holds the flag as text)."""
    return (tables.read_table(spark, f"{silver}/{entity}").filter(F.col("_is_valid") == "true")
            .withColumn("_is_valid", F.lit(True)).drop(quality.REASON, *tables.INPUT_ORDER))


def reject_table(spark: SparkSession, silver: str, entity: str) -> DataFrame:
    """Rejected rows of an entity with their reason."""
    return (tables.read_table(spark, f"{silver}/{entity}").filter(F.col("_is_valid") == "false")
            .drop("_is_valid", *tables.INPUT_ORDER))


def ingest(spark: SparkSession, bronze: str, silver: str, batch_id: str, now: datetime) -> dict[str, DataFrame]:
    """Validate every entity whose raw file exists, parents first, and return the valid tables.

    An entity is evaluated once: valid and rejected rows go to two partition
    folders (``_is_valid=true`` / ``false``) of the same write.
    """
    valid: dict[str, DataFrame] = {}
    for entity, entity_rules in quality.ENTITY_RULES.items():
        path = f"{bronze}/{entity}.csv"
        if not tables.path_exists(spark, path):
            continue
        raw = tables.read_bronze(spark, path, entity)
        checked = quality.bronze_to_silver(raw, entity_rules, valid, tables.INPUT_ORDER)
        checked = quality.add_audit_columns(checked, f"{entity}.csv", batch_id, now)
        (checked.withColumn("_is_valid", F.col(quality.REASON) == "").write.mode("overwrite")
         .partitionBy("_is_valid").parquet(f"{silver}/{entity}"))
        valid[entity] = silver_table(spark, silver, entity)
    if "flights" in valid:
        cancelled = quality.derive_cancellations(valid["flights"])
        sinks.write_table(quality.add_audit_columns(cancelled, "derived:flights.csv", batch_id, now),
                          f"{silver}/cancellations")
        valid["cancellations"] = tables.read_table(spark, f"{silver}/cancellations")
    return valid


def ingest_report(spark: SparkSession, silver: str) -> DataFrame:
    """Raw, valid and rejected rows per entity written by ``ingest``."""
    found = [e for e in quality.ENTITY_RULES if tables.path_exists(spark, f"{silver}/{e}")]
    return quality.reject_report({e: tables.read_table(spark, f"{silver}/{e}") for e in found})


# --- warehouse to marts and analytics -----------------------------------------------------------

def check_warehouse(spark: SparkSession, root: str, batch_id: str, now: datetime) -> tuple[int, int]:
    """Run the suite and the freshness check, log the results, and fail when any check failed."""
    current = warehouse.warehouse_tables(spark, root)
    suite = quality.dq_suite(current).select("check_name", "table_name", "violations", "status")
    fresh = quality.load_freshness(current["fact_flight"], F.lit(now).cast("timestamp"))
    results = suite.unionByName(fresh.select("check_name", "table_name",
                                             F.col("hours_since_load").alias("violations"), "status"))
    log = f"{root}/dq_check_log"
    sinks.append_dq_log(results, log, batch_id, now)
    # The gate reads what was logged, so the checks run once.
    return quality.enforce_gate(tables.read_table(spark, log).filter(F.col("batch_id") == batch_id))


def build_marts(tables_: dict[str, DataFrame], out: str) -> list[str]:
    """Write the seven KPI marts."""
    stg = {name: marts.staging(name, tables_[source]) for name, source in {
        "stg_flights": "fact_flight", "stg_bookings": "fact_booking", "stg_baggage": "fact_baggage",
        "stg_cancellations": "fact_cancellation", "stg_support_tickets": "fact_support_ticket",
        "stg_aircraft": "dim_aircraft"}.items()}
    built = {
        "mart_load_factor": marts.load_factor(stg["stg_flights"], stg["stg_aircraft"], stg["stg_bookings"]),
        "mart_delay_minutes": marts.delay_minutes(stg["stg_flights"]),
        "mart_cancellation_rate": marts.cancellation_rate(stg["stg_flights"], stg["stg_cancellations"]),
        "mart_baggage_sla": marts.baggage_sla(stg["stg_baggage"]),
        "mart_route_revenue": marts.route_revenue(stg["stg_bookings"], stg["stg_flights"]),
        "mart_revenue_per_flight": marts.revenue_per_flight(stg["stg_flights"], stg["stg_bookings"]),
        "mart_customer_complaint_rate": marts.complaint_rate(stg["stg_support_tickets"], stg["stg_bookings"]),
    }
    for name, df in built.items():
        sinks.write_table(df, f"{out}/{name}")
    return list(built)


def build_rotation(spark: SparkSession, flights: DataFrame, out: str) -> DataFrame:
    """Write the rotation table by flight date and its daily mart; returns the table as read back."""
    path = f"{out}/mart_rotation_delay_propagation"
    sinks.write_partitioned(rotation.rotation_delay_propagation(flights), path, "flight_date")
    written = tables.read_table(spark, path).select(*ROTATION.fieldNames())
    sinks.write_table(rotation.rotation_delay_mart(written), f"{out}/mart_rotation_delay")
    return written


def build_analytics(spark: SparkSession, tables_: dict[str, DataFrame], out: str) -> list[str]:
    """Write the business analytics outputs."""
    flights = tables_["fact_flight"].withColumn("flight_date", F.to_date("scheduled_departure"))
    bookings, tickets = tables_["fact_booking"], tables_["fact_support_ticket"]
    built = {
        "route_profitability": analytics.route_profitability(flights, bookings),
        "baggage_sla": analytics.baggage_cycle_sla(tables_["fact_baggage"]),
        "passenger_experience": analytics.passenger_experience(tickets, bookings),
        "passenger_issue_summary": analytics.issue_summary(tickets),
        "route_demand_daily": analytics.route_demand_daily(flights, bookings),
        "cancellation_anomalies": analytics.cancellation_anomalies(tables_["fact_cancellation"], flights),
    }
    for name, df in built.items():
        sinks.write_table(df, f"{out}/{name}")
    return list(built)


def score_flights(rotation_table: DataFrame, out: str, trees: int = 300, depth: int = 10) -> DataFrame:
    """Train the delay model, write it, and write the scored flights."""
    spark = rotation_table.sparkSession
    sinks.write_table(ml.delay_features(rotation_table), f"{out}/delay_features")
    rows = tables.read_table(spark, f"{out}/delay_features")
    train, test = ml.stratified_split(rows)
    model = ml.train_delay_model(train, trees, depth)
    ml.save_model(model, f"{out}/delay_model")
    sinks.write_table(ml.classification_report(ml.score_delay(model, test)), f"{out}/delay_model_report")
    sinks.write_table(ml.score_delay(model, rows), f"{out}/delay_predictions")
    return tables.read_table(spark, f"{out}/delay_predictions")


def forecast_demand(spark: SparkSession, out: str, trees: int = 200, depth: int = 8) -> DataFrame:
    """Write the demand forecast, its metrics and the metrics file of all analyses; returns the forecast."""
    forecast, metrics = ml.demand_forecast(tables.read_table(spark, f"{out}/route_demand_daily"), trees=trees, depth=depth)
    sinks.write_table(forecast, f"{out}/demand_forecast")
    sinks.write_table(metrics, f"{out}/demand_forecast_metrics")
    sinks.write_json(analytics.analytics_metrics(spark, tables.read_table(spark, f"{out}/demand_forecast_metrics"), THRESHOLDS),
                     f"{out}/analytics_metrics")
    return tables.read_table(spark, f"{out}/demand_forecast")


def validate_outputs(spark: SparkSession, out: str) -> None:
    """Fail when an output of the batch is missing."""
    tables.require_datasets(spark, {name: f"{out}/{name}" for name in OUTPUTS})


def raise_alerts(spark: SparkSession, predictions: DataFrame, out: str, now: datetime,
                 forecast: DataFrame | None = None) -> DataFrame:
    """Write actions and the unified alert table from the outputs at hand."""
    sinks.write_table(rules.delay_actions(predictions), f"{out}/delay_actions")
    parts = [rules.delay_alerts(tables.read_table(spark, f"{out}/delay_actions"))]
    if tables.path_exists(spark, f"{out}/baggage_sla"):
        parts.append(rules.baggage_alerts(tables.read_table(spark, f"{out}/baggage_sla")))
    if forecast is not None:
        parts.append(rules.demand_alerts(forecast))
    if tables.path_exists(spark, f"{out}/cancellation_anomalies"):
        parts.append(rules.cancellation_alerts(tables.read_table(spark, f"{out}/cancellation_anomalies")))
    sinks.write_table(rules.unified_alerts(*parts, now=now), f"{out}/alerts")
    return tables.read_table(spark, f"{out}/alerts")


# --- running stages -----------------------------------------------------------------------------

def run_stages(spark: SparkSession, stages: dict[str, Callable[[], object]], audit_path: str,
               run_id: str | None = None) -> str:
    """Run the stages in order, append one audit row each, and stop at the first failure."""
    run_id = run_id or uuid.uuid4().hex[:8]
    for stage, work in stages.items():
        started, error = datetime.now(timezone.utc), None
        try:
            work()
        except Exception as caught:
            error = caught
        row = (run_id, stage, "FAILED" if error else "SUCCESS", started, datetime.now(timezone.utc),
               str(error)[:500] if error else None)
        spark.createDataFrame([row], AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(audit_path)
        if error:
            raise error
    return run_id


def run_batch(spark: SparkSession, bronze: str, root: str, now: datetime | None = None, trees: int = 300,
              demand_trees: int = 200) -> str:
    """The whole batch: raw files, warehouse, checks, marts, rotation, analytics, models with the metrics file, alerts.

    The last stage also fails when an output is missing.
    """
    now = now or datetime.now(timezone.utc)
    run_id = uuid.uuid4().hex[:8]
    silver, house, out = f"{root}/silver", f"{root}/warehouse", f"{root}/outputs"
    state: dict = {}

    def current() -> dict[str, DataFrame]:
        return warehouse.warehouse_tables(spark, house)

    def models() -> None:
        state.update(scored=score_flights(state["rotation"], out, trees), forecast=forecast_demand(spark, out, demand_trees))

    def alerts() -> None:
        raise_alerts(spark, state["scored"], out, now, state["forecast"])
        validate_outputs(spark, out)

    return run_stages(spark, {
        "source_check": lambda: tables.require_datasets(spark, {e: f"{bronze}/{e}.csv" for e in BRONZE}),
        "silver": lambda: state.update(silver=ingest(spark, bronze, silver, run_id, now)),
        "warehouse": lambda: warehouse.load_warehouse(spark, house, state["silver"], run_id),
        "quality": lambda: check_warehouse(spark, house, run_id, now),
        "marts": lambda: build_marts(current(), out),
        "rotation": lambda: state.update(rotation=build_rotation(spark, current()["fact_flight"], out)),
        "analytics": lambda: build_analytics(spark, current(), out),
        "model": models,
        "alerts": alerts,
    }, f"{root}/run_audit", run_id)
