"""Reading files and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroledger.functions.columns import nan_to_null
from aeroledger.schemas import BRONZE

# Position of a raw row: file, block of the file, running number within the block.
INPUT_ORDER = ("_in_file", "_in_block", "_in_row")


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Sorted child names of a folder; empty when it does not exist."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(p))


def delete_folder(spark: SparkSession, folder: str) -> None:
    fs, p = _fs(spark, folder)
    fs.delete(p, True)


def read_bronze(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """Raw CSV with its declared schema, plus ``INPUT_ORDER`` columns that keep the file order."""
    return (spark.read.schema(BRONZE[entity]).option("header", True).csv(path)
            .withColumns({"_in_file": F.col("_metadata.file_path"),
                          "_in_block": F.col("_metadata.file_block_start"),
                          "_in_row": F.monotonically_increasing_id()}))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet file or folder; partition columns of a hive layout are discovered."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_exported(spark: SparkSession, path: str) -> DataFrame:
    """Parquet written by tools that store missing doubles as NaN."""
    return nan_to_null(read_table(spark, path))


def read_folder(spark: SparkSession, folder: str, pattern: str = "*.parquet", recursive: bool = True) -> DataFrame:
    """All matching Parquet files of a folder as one table."""
    return (spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive)
            .option("mergeSchema", True).parquet(folder))


def find_table(spark: SparkSession, folder: str, keyword: str, schema: T.StructType | None = None,
               required: bool = False) -> DataFrame:
    """First Parquet entry of the folder whose name contains the keyword.

    When there is none: an error if required, else an empty table.
    """
    hits = [n for n in list_names(spark, folder) if keyword.lower() in n.lower() and n.endswith(".parquet")]
    if hits:
        return read_table(spark, f"{folder}/{hits[0]}")
    if required:
        raise FileNotFoundError(f"no table named like '{keyword}' in {folder}")
    return empty_table(spark, schema or T.StructType([]))


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty one with the declared schema."""
    return read_table(spark, path) if path_exists(spark, path) else empty_table(spark, schema)


def read_first(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The first table that exists."""
    for path in paths:
        if path_exists(spark, path):
            return read_table(spark, path)
    raise FileNotFoundError(f"none of these exist: {', '.join(paths)}")


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def dataset_presence(spark: SparkSession, datasets: dict[str, str]) -> DataFrame:
    """(dataset, path, dataset_exists) for each named path."""
    rows = [(name, path, path_exists(spark, path)) for name, path in datasets.items()]
    return spark.createDataFrame(rows, "dataset string, path string, dataset_exists boolean")


def require_datasets(spark: SparkSession, datasets: dict[str, str]) -> None:
    missing = [name for name, path in datasets.items() if not path_exists(spark, path)]
    if missing:
        raise FileNotFoundError(f"missing datasets: {', '.join(missing)}")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) per table."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
             for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
