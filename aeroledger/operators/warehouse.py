"""Loading validated entities into the star schema."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroledger.functions.columns import day_of
from aeroledger.operators.quality import repeated_keys
from aeroledger.schemas import LOGS, WAREHOUSE, WAREHOUSE_KEYS
from aeroledger.sources import partitions, sinks, tables

# Warehouse table per validated entity, dimensions first.
LOAD_ORDER = {
    "airports": "dim_airport", "aircraft": "dim_aircraft", "customers": "dim_customer", "dim_date": "dim_date",
    "routes": "dim_route", "flights": "fact_flight", "cancellations": "fact_cancellation",
    "bookings": "fact_booking", "baggage": "fact_baggage", "support_tickets": "fact_support_ticket",
    "fares": "fact_fare_snapshot",
}

# Facts lie in a partition per day (or month, where days hold few rows) of this column; dimensions in one partition.
PARTITION_TIME = {
    "fact_flight": "scheduled_departure", "fact_cancellation": "cancelled_at", "fact_booking": "booking_time",
    "fact_baggage": "scan_time", "fact_support_ticket": "created_at", "fact_fare_snapshot": "timestamp",
}
WHOLE, NO_TIME = "all", "none"
MANY_KEYS = 1 << 19  # about what Spark's limit for broadcasts holds
GRAINS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}


def partition_of(table: str, grain: str = "day") -> Column:
    """Name of the partition a row of the table belongs to."""
    if table not in PARTITION_TIME:
        return F.lit(WHOLE)
    return F.coalesce(F.date_format(PARTITION_TIME[table], GRAINS[grain]), F.lit(NO_TIME))


def upsert(target: DataFrame, source: DataFrame, pk: Sequence[str], many: bool = False) -> DataFrame:
    """Target after replacing rows by key and adding new keys; source NULLs overwrite, nothing is deleted.

    ``many`` source keys, too many to broadcast, are hashed by part, so the wide rows of the target are not sorted.
    """
    keys = source.select(*pk)
    kept = target.join(keys.hint("shuffle_hash") if many else keys, list(pk), "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def check_unique_key(source: DataFrame, pk: Sequence[str]) -> None:
    """An upsert from a source that repeats a key has no defined result, so it is refused."""
    key = source.select(F.struct(*pk).alias("key"))
    repeated = repeated_keys(key, "key").limit(1).collect()
    if repeated:
        raise ValueError(f"source repeats key {repeated[0]['key']}")


def merge_into(source: DataFrame, table: str, pk: Sequence[str]) -> None:
    """The same upsert as a row-level MERGE, for catalogs whose table format supports it.

    Such formats rewrite only the files that hold matching keys, the better
    choice for very large facts.
    """
    condition = F.lit(True)
    for c in pk:
        condition = condition & (F.col(f"target.{c}") == F.col(f"source.{c}"))
    (source.alias("source").mergeInto(f"{table} AS target", condition)
     .whenMatched().updateAll().whenNotMatched().insertAll().merge())


def run_log_row(run_id: str, task: str, started: datetime, rows: int = 0, error: Exception | None = None,
                note: str | None = None) -> tuple:
    message = str(error)[:500] if error else note
    return (run_id, task, "FAILED" if error else "SUCCESS", rows, started, datetime.now(timezone.utc), message)


def load_table(spark: SparkSession, root: str, table: str, source: DataFrame, run_id: str,
               pk: Sequence[str] | None = None, grain: str = "day") -> int:
    """Upsert ``source`` into the warehouse table below ``root`` and log the run; returns the input rows.

    Only partitions that hold a key of the source, or receive one, are read whole and rewritten; a row whose time moves
    leaves its old partition, whatever grain that was written in.
    """
    pk = list(pk or WAREHOUSE_KEYS[table])
    path, schema = f"{root}/{table}", WAREHOUSE[table]
    task, started, log = f"load_{table}", datetime.now(timezone.utc), f"{root}/pipeline_run_log"
    try:
        source = source.select(*[F.col(f.name).cast(f.dataType) for f in WAREHOUSE[table].fields])
        with partitions.arriving(source.withColumn(partitions.PART, partition_of(table, grain)), path) as source:
            rows = source.count()
            if rows:
                check_unique_key(source, pk)
                partitions.settle(spark, path, schema)
                present = partitions.stored_parts(spark, path)
                touched = (partitions.holding(partitions.read(spark, path, schema), source, pk) if present
                           else partitions.parts_of(source))
                if present & set(touched):
                    source = upsert(partitions.read(spark, path, schema, touched), source, pk, many=rows > MANY_KEYS)
                partitions.replace(source, path, touched)
        row = run_log_row(run_id, task, started, rows, note=None if rows else "no rows")
        sinks.append_log(spark, "pipeline_run_log", [row], log)
        return rows
    except Exception as error:
        sinks.append_log(spark, "pipeline_run_log", [run_log_row(run_id, task, started, error=error)], log)
        raise


def create_schema(spark: SparkSession, root: str, rebuild: bool = False) -> None:
    """Create every declared table that is not there, empty; ``rebuild`` empties all."""
    for table, schema in WAREHOUSE.items():
        if rebuild or not tables.path_exists(spark, f"{root}/{table}"):
            partitions.create(spark, f"{root}/{table}", schema)
    for log in ("dq_check_log", "pipeline_run_log"):
        if not tables.path_exists(spark, f"{root}/{log}"):
            sinks.write_table(tables.empty_table(spark, LOGS[log]), f"{root}/{log}", "append")


def prepare_flights(flights: DataFrame) -> DataFrame:
    """Flights with the date id the warehouse joins on."""
    return flights.withColumn("scheduled_date_id", day_of("scheduled_departure"))


def load_warehouse(spark: SparkSession, root: str, silver: dict[str, DataFrame], run_id: str,
                   rebuild: bool = False, grain: str = "day") -> dict[str, int]:
    """Load every entity at hand, dimensions first; returns the input rows per table."""
    create_schema(spark, root, rebuild)
    loaded = {}
    for entity, table in LOAD_ORDER.items():
        if entity in silver:
            source = prepare_flights(silver[entity]) if entity == "flights" else silver[entity]
            loaded[table] = load_table(spark, root, table, source, run_id, grain=grain)
    return loaded


def warehouse_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every warehouse table that has been created."""
    return {t: partitions.read(spark, f"{root}/{t}", schema).drop(partitions.PART)
            for t, schema in WAREHOUSE.items() if tables.path_exists(spark, f"{root}/{t}")}


def register_views(spark: SparkSession, root: str) -> list[str]:
    """Expose the warehouse tables to SQL as temporary views."""
    current = warehouse_tables(spark, root)
    for name, df in current.items():
        df.createOrReplaceTempView(name)
    return sorted(current)


def failed_runs(run_log: DataFrame) -> DataFrame:
    """Failed load tasks, newest first."""
    return run_log.filter(F.col("status") == "FAILED").orderBy(F.desc_nulls_last("started_at"), "run_id", "task_name")


def failed_checks(check_log: DataFrame) -> DataFrame:
    """Failed quality checks, newest first."""
    return check_log.filter(F.col("status") == "FAIL").orderBy(F.desc_nulls_last("run_at"), "check_id")


def load_rotation_mart(spark: SparkSession, rotation_path: str, root: str) -> int:
    """Copy the day-partitioned rotation output into the warehouse; returns its rows."""
    path = f"{root}/mart_rotation_delay_propagation"
    sinks.write_partitioned(tables.read_table(spark, rotation_path), path, "flight_date")
    return tables.read_table(spark, path).count()


def snapshot_tables(spark: SparkSession, sources: dict[str, str], destination: str) -> dict[str, int]:
    """Copy tables (name -> path) to a standalone store and return their row counts."""
    counts = {}
    for name, path in sources.items():
        sinks.write_table(tables.read_table(spark, path), f"{destination}/{name}")
        counts[name] = tables.read_table(spark, f"{destination}/{name}").count()
    return counts
