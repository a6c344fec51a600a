"""Words, hashes and stored tables shared by the text operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroledger.session import scratch_path

# The white space that ends a word, as bytes 0x20 and 0x09 to 0x0D.
SPACES = " \t\n\x0b\f\r"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole_text(text: str | Column = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def words_of(text: Column) -> Column:
    """Runs of characters that are not white space; an empty array for none."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def n_words_of(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def id_class(key: Column, modulus: int) -> Column:
    """``crc32`` of the id written as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % modulus


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write to the shared folder (to ``path``, if given) and read back: cuts lineage and survives the loss of executors.

    Once the table is written nothing needs the shuffle files that led to it, so Spark may drop them at once.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for workers that Spark uses again: what a task has freed goes back to the machine as the task ends."""
    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
            if trim:
                trim(0)

    return task


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with those of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
