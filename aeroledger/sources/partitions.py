"""Parquet tables that are changed partition by partition.

A change rewrites only the partitions that hold something of it, by Spark's dynamic partition overwrite.  The new state of
these partitions is first written beside the table.  It counts once Spark's ``_SUCCESS`` marker stands in ``touched``, its
last part; a run that dies earlier leaves the table as it was, one that dies later is made good by the next (``settle``).
One writer at a time; readers that must not see a change half applied need a catalog with row-level MERGE
(``warehouse.merge_into``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroledger.sources.tables import delete_folder, empty_table, list_names, path_exists, read_table

PART = "_part"


def _pending(path: str) -> str:
    return f"{path.rstrip('/')}_pending"


def _incoming(path: str) -> str:
    return f"{path.rstrip('/')}_incoming"


def _with_part(schema: T.StructType) -> T.StructType:
    return T.StructType([*[f for f in schema.fields if f.name != PART], T.StructField(PART, T.StringType())])


def _gathered(rows: DataFrame) -> DataFrame:
    """A small partition in few files; one that is too much for a task split, where Spark plans adaptively.

    Streams do not, and would drop the hint.
    """
    adaptive = rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    return rows.hint("rebalance", PART) if adaptive else rows.repartition(PART)


def _overwrite(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)


def create(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty table, whatever was there before."""
    delete_folder(spark, _pending(path))
    empty_table(spark, _with_part(schema)).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        PART).parquet(path)


def read(spark: SparkSession, path: str, schema: T.StructType, only: Sequence[str] | None = None) -> DataFrame:
    """The table with its ``_part`` column; with ``only``, no other partition is read."""
    if not path_exists(spark, path):
        return empty_table(spark, _with_part(schema))
    rows = read_table(spark, path, _with_part(schema))
    return rows if only is None else rows.filter(F.col(PART).isin(*only)) if only else rows.limit(0)


def parts_of(rows: DataFrame) -> list[str]:
    """The partitions that rows lie in; as many as the table has folders at most."""
    return sorted(r[0] for r in rows.select(PART).distinct().collect())


def holding(target: DataFrame, source: DataFrame, pk: Sequence[str]) -> list[str]:
    """Partitions that hold a key of ``source`` or are to receive one: reads keys only, and none where one is to be received."""
    own = parts_of(source)
    elsewhere = target.filter(~F.col(PART).isin(*own)) if own else target
    held = elsewhere.select(*pk, PART).join(source.select(*pk), list(pk), "left_semi")
    return sorted({*own, *parts_of(held)})


@contextmanager
def arriving(rows: DataFrame, path: str) -> Iterator[DataFrame]:
    """``rows`` stored beside the table while a change reads them several times, so that what they come from runs once."""
    spark, incoming = rows.sparkSession, _incoming(path)
    try:
        rows.write.mode("overwrite").option("compression", "zstd").parquet(incoming)
        yield read_table(spark, incoming, rows.schema)
    finally:
        delete_folder(spark, incoming)


def stored_parts(spark: SparkSession, path: str) -> set[str]:
    """Partitions that have a folder."""
    return {n.removeprefix(f"{PART}=") for n in list_names(spark, path) if n.startswith(f"{PART}=")}


def replace(rows: DataFrame, path: str, touched: Sequence[str]) -> None:
    """Give the ``touched`` partitions the state ``rows``; those that get no row disappear.

    Where none of them is there yet a run that dies has nothing to lose, and the rows go to the table at once.
    """
    spark, pending = rows.sparkSession, _pending(path)
    delete_folder(spark, pending)
    if not stored_parts(spark, path) & set(touched):
        _overwrite(_gathered(rows), path)
        return
    _gathered(rows).write.partitionBy(PART).parquet(f"{pending}/rows")
    spark.createDataFrame([(p,) for p in touched], f"{PART} string").coalesce(1).write.parquet(f"{pending}/touched")
    settle(spark, path, rows.schema)


def settle(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """Apply a change that is complete beside the table, drop one that is not; returns whether one was applied."""
    pending = _pending(path)
    done = path_exists(spark, f"{pending}/touched/_SUCCESS")
    if done:
        touched = parts_of(read_table(spark, f"{pending}/touched"))
        for part in sorted(set(touched) - stored_parts(spark, f"{pending}/rows")):
            delete_folder(spark, f"{path}/{PART}={part}")
        _overwrite(read_table(spark, f"{pending}/rows", _with_part(schema)), path)
    delete_folder(spark, pending)
    return done
