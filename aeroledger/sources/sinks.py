"""Writing tables, logs and events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroledger.schemas import LOGS


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_partitioned(df: DataFrame, path: str, by: str, mode: str = "overwrite") -> None:
    """Partition folders by ``by``.

    The rebalance hint collects small days into few files and splits a day that
    holds too much for one task.
    """
    df.hint("rebalance", by).write.mode(mode).partitionBy(by).parquet(path)


def write_rejects(rejected: DataFrame, path: str) -> bool:
    """CSV of rejected rows; nothing is written when there are none."""
    if rejected.isEmpty():
        return False
    rejected.write.mode("overwrite").option("header", True).csv(path)
    return True


def replace_table(df: DataFrame, table: str) -> None:
    """Create or replace a catalog table from a query."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def export_tables(spark: SparkSession, tables: Sequence[str], folder: str) -> dict[str, str]:
    """Copy catalog tables or views to Parquet below ``folder``; returns their paths."""
    paths = {}
    for table in tables:
        paths[table] = f"{folder}/{table.split('.')[-1]}"
        write_table(spark.table(table), paths[table])
    return paths


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def publish_events(envelopes: DataFrame, target: str, bootstrap: str | None = None) -> None:
    """Envelopes (topic, key, value) to Kafka when a broker is named, else as JSON lines in a folder."""
    out = envelopes.select("topic", "key", "value")
    if bootstrap:
        (out.write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("kafka.acks", "all").save())
    else:
        out.write.mode("append").json(target)


def append_log(spark: SparkSession, log: str, rows: Sequence[tuple], path: str) -> None:
    """Append rows to one of the declared logs."""
    spark.createDataFrame(list(rows), LOGS[log]).coalesce(1).write.mode("append").parquet(path)


def append_dq_log(results: DataFrame, path: str, batch_id: str, run_at) -> None:
    """Append check results (check_name, table_name, violations, status) to the check log."""
    (results.select(F.substring(F.sha2(F.concat_ws("|", F.lit(batch_id), "check_name"), 256), 1, 8).alias("check_id"),
                    "check_name", "table_name", "status",
                    F.concat(F.lit("violations="), F.col("violations").cast("string")).alias("details"),
                    F.lit(run_at).cast("timestamp").alias("run_at"), F.lit(batch_id).alias("batch_id"))
     .coalesce(1).write.mode("append").parquet(path))
