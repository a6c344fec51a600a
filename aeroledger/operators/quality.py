"""Validation of raw entities and data-quality checks on loaded tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroledger.functions.columns import boundaries_crossed, count_when, ratio
from aeroledger.operators.skew import SLICE_ROWS, with_sequence
from aeroledger.schemas import FLIGHT_STATUSES
from aeroledger.sources.tables import path_exists

REASON = "_reject_reason"
REF_MISSING = "ref_missing;"
RULE_FAILED = "rule_failed;"


# --- bronze to silver ---------------------------------------------------------------------------

def add_audit_columns(df: DataFrame, source_file: str, batch_id: str, ingested_at: datetime) -> DataFrame:
    """Stamp the file, the run and the load time."""
    return df.withColumns({"_source_file": F.lit(source_file), "_batch_id": F.lit(batch_id),
                           "_ingested_at": F.lit(ingested_at).cast("timestamp")})


def flag_rejects(df: DataFrame, pk: Sequence[str], not_null: Sequence[str], order: Sequence[str],
                 slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Adds ``_reject_reason``: key NULL, then each NULL business column, then repeated key ('' when clean).

    Of rows sharing a key the first by ``order`` is kept (NULL keys equal each
    other).  All input rows take part in that test, also those already bad.
    """
    any_null = reduce(Column.__or__, [F.col(c).isNull() for c in pk])
    pieces = [F.when(any_null, F.lit("pk_null;"))]
    pieces += [F.when(F.col(c).isNull(), F.lit(f"{c}_null;")) for c in not_null if c in df.columns]
    pieces.append(F.when(F.col("_copy") > 1, F.lit("duplicate_pk;")))
    numbered = with_sequence(df, pk, order, seq="_copy", slice_rows=slice_rows)
    return numbered.withColumn(REASON, F.concat_ws("", *pieces)).drop("_copy")


def split_rejects(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows with ``_is_valid``, rejected rows with their reason)."""
    clean = F.col(REASON) == ""
    return (flagged.filter(clean).drop(REASON).withColumn("_is_valid", F.lit(True)),
            flagged.filter(~clean))


def validate_and_split(df: DataFrame, pk: Sequence[str], not_null: Sequence[str], order: Sequence[str],
                       slice_rows: int = SLICE_ROWS) -> tuple[DataFrame, DataFrame]:
    return split_rejects(flag_rejects(df, pk, not_null, order, slice_rows))


@dataclass(frozen=True)
class Reference:
    """Child column(s) that must exist as ``key`` in the validated ``parent``."""

    parent: str
    key: str
    columns: tuple[str, ...]


def mark_references(child: DataFrame, references: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Adds ``_ref_ok``: every foreign key (column, parent, key) has a parent row; NULL never has one.

    Each parent is reduced to its distinct keys, so the left join keeps the
    child's rows as they are.  Small parents broadcast by their measured size;
    otherwise AQE splits a hot key's partition on the child side.
    """
    marks = []
    for i, (column, parent, key) in enumerate(references):
        known = parent.select(F.col(key).alias(f"_k{i}")).filter(F.col(f"_k{i}").isNotNull()).distinct()
        child = child.join(known, child[column] == known[f"_k{i}"], "left")
        marks.append(f"_k{i}")
    ok = reduce(Column.__and__, [F.col(m).isNotNull() for m in marks]) if marks else F.lit(True)
    return child.withColumn("_ref_ok", ok).drop(*marks)


def referential_filter(child: DataFrame, references: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Rows whose foreign keys all exist."""
    for column, parent, key in references:
        child = child.join(parent.select(F.col(key).alias(column)), column, "left_semi")
    return child


def positive(column: str) -> Column:
    return F.coalesce(F.col(column) > 0, F.lit(False))


def flight_rule(statuses: Sequence[str] = FLIGHT_STATUSES) -> Column:
    """Known status, and a delay that is missing or not negative."""
    known = F.coalesce(F.col("status").isin(*statuses), F.lit(False))
    return known & (F.col("delay_minutes").isNull() | (F.col("delay_minutes") >= 0))


def business_rule_filter(df: DataFrame, rule: Column) -> DataFrame:
    return df.filter(F.coalesce(rule, F.lit(False)))


@dataclass(frozen=True)
class EntityRules:
    """How one raw entity is validated."""

    pk: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    rule: Callable[[], Column] | None = None


# Parents come before children.  ``fares`` has no key test.
ENTITY_RULES = {
    "airports": EntityRules(("airport_id",), ("city", "region")),
    "aircraft": EntityRules(("aircraft_id",), ("type", "seat_capacity")),
    "routes": EntityRules(("route_id",), ("origin_airport_id", "dest_airport_id"),
                          (Reference("airports", "airport_id", ("origin_airport_id", "dest_airport_id")),)),
    "customers": EntityRules(("customer_id",), ("name",)),
    "dim_date": EntityRules(("date_id",), ("date",)),
    "flights": EntityRules(("flight_id",), ("route_id", "scheduled_departure"),
                           (Reference("routes", "route_id", ("route_id",)),
                            Reference("aircraft", "aircraft_id", ("aircraft_id",))), flight_rule),
    "bookings": EntityRules(("booking_id",), ("customer_id", "flight_id", "fare"),
                            (Reference("customers", "customer_id", ("customer_id",)),
                             Reference("flights", "flight_id", ("flight_id",))), lambda: positive("fare")),
    "baggage": EntityRules(("bag_id",), ("booking_id", "status"),
                           (Reference("bookings", "booking_id", ("booking_id",)),
                            Reference("airports", "airport_id", ("airport",)))),
    "support_tickets": EntityRules(("ticket_id",), ("booking_id", "issue_type"),
                                   (Reference("bookings", "booking_id", ("booking_id",)),)),
    "fares": EntityRules((), (), (Reference("routes", "route_id", ("route_id",)),), lambda: positive("price")),
}


def bronze_to_silver(raw: DataFrame, rules: EntityRules, parents: dict[str, DataFrame], order: Sequence[str],
                     slice_rows: int = SLICE_ROWS) -> DataFrame:
    """All rows of an entity with ``_reject_reason`` ('' when valid).

    Missing references and failed business rules come first; only rows that
    pass both are tested for NULL and repeated keys.
    """
    references = [(column, parents[ref.parent], ref.key) for ref in rules.references for column in ref.columns]
    rule = F.coalesce(rules.rule(), F.lit(False)) if rules.rule else F.lit(True)
    marked = mark_references(raw, references).withColumn(
        REASON, F.concat_ws("", F.when(~F.col("_ref_ok"), F.lit(REF_MISSING)),
                            F.when(~rule, F.lit(RULE_FAILED)))).drop("_ref_ok")
    if not rules.pk:
        return marked
    passed = marked.filter(F.col(REASON) == "").drop(REASON)
    failed = marked.filter(F.col(REASON) != "")
    return flag_rejects(passed, rules.pk, rules.not_null, order, slice_rows).unionByName(failed)


def derive_cancellations(flights: DataFrame) -> DataFrame:
    """One cancellation per cancelled flight; the source states no reason."""
    return (flights.filter(F.col("status") == "CANCELLED")
            .select("flight_id", F.col("scheduled_departure").alias("cancelled_at"),
                    F.lit("UNSPECIFIED").alias("reason_code")))


def reject_report(flagged: dict[str, DataFrame]) -> DataFrame:
    """Raw, valid and rejected rows per entity, one pass each."""
    clean = F.col(REASON) == ""
    return union_all([df.agg(F.lit(name).alias("entity"), F.count(F.lit(1)).alias("raw_rows"),
                             count_when(clean).alias("valid_rows"), count_when(~clean).alias("rejected_rows"))
                      for name, df in flagged.items()])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- checks on loaded tables --------------------------------------------------------------------

@dataclass(frozen=True)
class TableChecks:
    """Row checks of one table (name -> violating condition), its key checks and its orphan checks."""

    rows: dict[str, Callable[[], Column]] = field(default_factory=dict)
    unique: dict[str, str] = field(default_factory=dict)
    orphans: dict[str, tuple[str, str, str]] = field(default_factory=dict)


# The standard suite: 2 null keys, 2 repeated keys, 5 references, 4 value rules.
SUITE = {
    "fact_flight": TableChecks(
        {"null_pk_fact_flight": lambda: F.col("flight_id").isNull(),
         "range_delay_minutes_negative": lambda: F.col("delay_minutes") < 0,
         "valid_flight_status": lambda: ~F.col("status").isin(*FLIGHT_STATUSES)},
        {"dup_pk_fact_flight": "flight_id"},
        {"ref_integrity_flight_to_route": ("route_id", "dim_route", "route_id")}),
    "fact_booking": TableChecks(
        {"null_pk_fact_booking": lambda: F.col("booking_id").isNull(),
         "range_fare_non_positive": lambda: F.col("fare") <= 0},
        {"dup_pk_fact_booking": "booking_id"},
        {"ref_integrity_booking_to_flight": ("flight_id", "fact_flight", "flight_id"),
         "ref_integrity_booking_to_customer": ("customer_id", "dim_customer", "customer_id")}),
    "fact_baggage": TableChecks(
        orphans={"ref_integrity_baggage_to_booking": ("booking_id", "fact_booking", "booking_id")}),
    "fact_support_ticket": TableChecks(
        orphans={"ref_integrity_support_to_booking": ("booking_id", "fact_booking", "booking_id")}),
    "fact_fare_snapshot": TableChecks(
        {"range_fare_snapshot_price_non_positive": lambda: F.col("price") <= 0}),
}

# Key columns whose NULLs the wider listing also counts.
KEY_COLUMNS = {"fact_flight": "flight_id", "fact_booking": "booking_id", "fact_baggage": "bag_id",
               "fact_support_ticket": "ticket_id"}


def _finding(name: str, table: str, violations: Column) -> list[Column]:
    return [F.lit(name).alias("check_name"), F.lit(table).alias("table_name"),
            F.coalesce(violations, F.lit(0)).cast("long").alias("violations")]


def row_checks(df: DataFrame, table: str, conditions: dict[str, Column]) -> DataFrame:
    """All row conditions of a table in a single pass: (check_name, table_name, violations)."""
    counted = df.agg(*[count_when(cond).alias(name) for name, cond in conditions.items()])
    names = list(conditions)
    return (counted.unpivot([], names, "check_name", "violations")
            .select("check_name", F.lit(table).alias("table_name"), "violations"))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows (NULL counts as a key)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphan_count(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows without a parent, NULL keys included.

    The child shrinks to one counted row per key before the anti-join, so a hot
    key is a single row by then.
    """
    per_key = child.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    lost = per_key.join(parent.select(F.col(key).alias(column)), column, "left_anti")
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations"))


def judge(findings: DataFrame, threshold: int = 0) -> DataFrame:
    """PASS while the violations do not exceed the threshold."""
    return (findings.withColumn("threshold", F.lit(threshold).cast("long"))
            .withColumn("status", F.when(F.col("violations") <= F.col("threshold"), F.lit("PASS"))
                        .otherwise(F.lit("FAIL"))))


def dq_suite(tables: dict[str, DataFrame], suite: dict[str, TableChecks] = SUITE) -> DataFrame:
    """(check_name, table_name, violations, threshold, status) for every check whose tables exist."""
    found = []
    for table, checks in suite.items():
        if table not in tables:
            continue
        df = tables[table]
        if checks.rows:
            found.append(row_checks(df, table, {n: c() for n, c in checks.rows.items()}))
        for name, key in checks.unique.items():
            found.append(repeated_keys(df, key).agg(*_finding(name, table, F.count(F.lit(1)))))
        for name, (column, parent, key) in checks.orphans.items():
            if parent in tables:
                found.append(orphan_count(df, column, tables[parent], key)
                             .select(*_finding(name, table, F.col("violations"))))
    return judge(union_all(found))


def null_key_counts(tables: dict[str, DataFrame], keys: dict[str, str] = KEY_COLUMNS) -> DataFrame:
    """Rows with a NULL business key per table."""
    return union_all([tables[t].agg(*_finding(f"{t}.{k}", t, count_when(F.col(k).isNull())))
                      for t, k in keys.items() if t in tables])


def dup_keys(tables: dict[str, DataFrame], keys: dict[str, str]) -> DataFrame:
    """Repeated keys of several tables as (table_name, key, n)."""
    return union_all([repeated_keys(tables[t], k).select(F.lit(t).alias("table_name"),
                                                         F.col(k).cast("string").alias("key"), "n")
                      for t, k in keys.items()])


def stream_checks(now: Column, monitoring: DataFrame | None = None, ledger: DataFrame | None = None,
                  max_age_minutes: int = 30, max_error_share: float = 0.05) -> DataFrame | None:
    """Freshness, error share and ledger uniqueness; tables that do not exist are skipped.

    An empty monitoring table passes: it has no age and no errors.
    """
    found = []
    if monitoring is not None:
        table = "stream_monitoring"
        totals = monitoring.agg(
            F.max("window_end").alias("last"), F.sum("errors").alias("errors"),
            F.sum(F.col("processed") + F.col("duplicates") + F.col("errors")).alias("seen"))
        stale = F.when(boundaries_crossed("minute", "last", now) > max_age_minutes, 1).otherwise(0)
        failing = F.when(F.col("errors") > F.col("seen") * max_error_share, 1).otherwise(0)
        found += [totals.select(*_finding("stream_freshness_minutes_ok", table, stale)),
                  totals.select(*_finding("stream_error_rate_ok", table, failing))]
    if ledger is not None:
        found.append(repeated_keys(ledger, "event_id").agg(
            *_finding("stream_dedup_ledger_unique", "stream_seen_events", F.count(F.lit(1)))))
    return judge(union_all(found)) if found else None


def load_freshness(df: DataFrame, now: Column, table: str = "fact_flight", column: str = "_ingested_at",
                   max_hours: int = 24) -> DataFrame:
    """Hours since the last load; PASS below ``max_hours``, FAIL for an empty table."""
    hours = boundaries_crossed("hour", "last", now)
    return (df.agg(F.max(column).alias("last"))
            .select(F.lit(f"freshness_{table}").alias("check_name"), F.lit(table).alias("table_name"),
                    hours.alias("hours_since_load"),
                    F.when(hours < max_hours, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status")))


def volume_by_day(df: DataFrame, day: str = "scheduled_date_id", share: float = 0.3) -> DataFrame:
    """Rows per day next to the daily average; days below ``share`` of it are flagged."""
    daily = df.groupBy(day).agg(F.count(F.lit(1)).alias("n_rows"))
    average = daily.agg(ratio(F.sum("n_rows"), F.count(F.lit(1)))).scalar()
    return (daily.withColumn("avg_daily", average)
            .withColumn("flag", F.when(F.col("n_rows") < share * F.col("avg_daily"), F.lit("LOW_VOLUME_ALERT"))
                        .otherwise(F.lit("OK")))
            .orderBy(F.col(day).asc_nulls_last()))


def low_volume_days(df: DataFrame, day: str = "scheduled_date_id", share: float = 0.3) -> DataFrame:
    return volume_by_day(df, day, share).filter(F.col("flag") != "OK").select(day, "n_rows")


def dq_gate(results: DataFrame) -> DataFrame:
    """Passed and total checks with the verdict, as one row."""
    return results.agg(count_when(F.col("status") == "PASS").alias("passed"), F.count(F.lit(1)).alias("total"),
                       F.sort_array(F.collect_list(F.when(F.col("status") == "FAIL", F.col("check_name"))))
                       .alias("failed_checks"))


def enforce_gate(results: DataFrame) -> tuple[int, int]:
    """Run the gate; raise when any check failed (the result has one row per check)."""
    row = dq_gate(results).first()
    if row.failed_checks:
        raise RuntimeError(f"{row.passed}/{row.total} checks passed; failed: {', '.join(row.failed_checks)}")
    return row.passed, row.total


# --- generic column tests: each returns the violating rows or values ----------------------------

def null_violations(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def uniqueness_violations(df: DataFrame, column: str) -> DataFrame:
    """Repeated non-NULL values with their counts."""
    return repeated_keys(df.filter(F.col(column).isNotNull()), column)


def unaccepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Unexpected non-NULL values with their counts."""
    return (df.filter(~F.col(column).isin(*values)).groupBy(F.col(column).alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records")))


def broken_relationships(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Non-NULL child values without a parent, one row per value with its count."""
    per_key = (child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("from_field"))
               .agg(F.count(F.lit(1)).alias("n_records")))
    return per_key.join(parent.select(F.col(key).alias("from_field")), "from_field", "left_anti")


def negative_values(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) < 0)


# Column tests per model: not_null, unique, accepted values, references (column, model, key).
MODEL_TESTS = {
    "stg_flights": {"unique": ["flight_id"], "not_null": ["flight_id", "route_id"],
                    "accepted": {"status": FLIGHT_STATUSES}},
    "stg_bookings": {"unique": ["booking_id"], "not_null": ["booking_id", "fare"],
                     "relations": [("flight_id", "stg_flights", "flight_id")]},
    "stg_baggage": {"unique": ["bag_id"], "not_null": ["bag_id"],
                    "relations": [("booking_id", "stg_bookings", "booking_id")]},
    "stg_cancellations": {"unique": ["flight_id"], "not_null": ["flight_id"]},
    "stg_support_tickets": {"unique": ["ticket_id"], "not_null": ["ticket_id"]},
    "stg_routes": {"unique": ["route_id"], "not_null": ["route_id"]},
    "stg_airports": {"unique": ["airport_id"], "not_null": ["airport_id"]},
    "stg_aircraft": {"unique": ["aircraft_id"], "not_null": ["aircraft_id"]},
    "mart_load_factor": {"not_null": ["route_id", "load_factor"]},
    "mart_delay_minutes": {"not_null": ["route_id"]},
    "mart_cancellation_rate": {"not_null": ["route_id"]},
    "mart_baggage_sla": {"not_null": ["airport"]},
    "mart_route_revenue": {"not_null": ["route_id"]},
    "mart_revenue_per_flight": {"unique": ["flight_id"], "not_null": ["flight_id"]},
    "mart_customer_complaint_rate": {"not_null": ["day"]},
    "stg_rotation_delay": {"unique": ["flight_id"],
                           "not_null": ["flight_id", "aircraft_id", "flight_date", "delay_minutes", "is_cascade_delay"]},
    "mart_rotation_delay": {"not_null": ["flight_date", "aircraft_id", "total_flights", "delayed_flights",
                                         "cascade_delay_flights"]},
}


def model_tests(models: dict[str, DataFrame], spec: dict = MODEL_TESTS) -> DataFrame:
    """Run the column tests of every model at hand: (check_name, table_name, violations, threshold, status)."""
    found = []
    for model, tests in spec.items():
        if model not in models:
            continue
        df = models[model]
        found.append(row_checks(df, model, {f"not_null_{model}_{c}": F.col(c).isNull()
                                            for c in tests.get("not_null", [])}))
        failing = {f"unique_{model}_{c}": uniqueness_violations(df, c) for c in tests.get("unique", [])}
        failing |= {f"accepted_values_{model}_{c}": unaccepted_values(df, c, values)
                    for c, values in tests.get("accepted", {}).items()}
        failing |= {f"relationships_{model}_{c}": broken_relationships(df, c, models[other], key)
                    for c, other, key in tests.get("relations", []) if other in models}
        found += [bad.agg(*_finding(name, model, F.count(F.lit(1)))) for name, bad in failing.items()]
    return judge(union_all(found))


# --- profiling ----------------------------------------------------------------------------------

def row_digest(columns: Sequence[Column]) -> Column:
    """128 bits of a row: two 64-bit hashes with different seeds; equal rows have equal digests."""
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(1), *columns).alias("b"))


def _profiled(df: DataFrame, digest: Callable[[Sequence[Column]], Column] = row_digest) -> DataFrame:
    """One row: rows, null cells, rows with a NULL, rows beyond the first of identical ones.

    Digests are counted first, combined on the map side.  A digest met once is a row of its own; whole rows are compared
    only where a digest was met twice, so a table without repetitions shuffles nothing but digests, and equal digests of
    different rows do no harm.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    nulls = reduce(Column.__add__, [c.isNull().cast("long") for c in columns])
    met = df.select(digest(columns).alias("_digest"), nulls.alias("_nulls")).groupBy("_digest").agg(
        F.count(F.lit(1)).alias("_copies"), F.sum("_nulls").alias("_nulls"), count_when(F.col("_nulls") > 0).alias("_null_rows"))
    zero = F.lit(0)
    again = F.col("_copies") > 1
    totals = met.agg(F.coalesce(F.sum("_copies"), zero).cast("long").alias("rows"),
                     F.coalesce(F.sum("_nulls"), zero).cast("long").alias("null_values"),
                     F.coalesce(F.sum("_null_rows"), zero).cast("long").alias("null_rows"),
                     F.coalesce(F.sum(F.when(again, F.col("_copies"))), zero).cast("long").alias("_repeated"))
    suspects = met.filter(again).select("_digest")
    compared = (df.select(digest(columns).alias("_digest"), F.struct(*columns).alias("_row")).join(suspects, "_digest", "left_semi")
                .groupBy("_row").agg(F.count(F.lit(1)).alias("_n")).agg(F.count(F.lit(1)).alias("_distinct")))
    return totals.select("rows", "null_values", "null_rows", (F.col("_repeated") - compared.scalar()).alias("duplicate_rows"))


def profile(df: DataFrame, name: str) -> DataFrame:
    """(dataset, rows, columns, null_rows, duplicate_rows)."""
    return _profiled(df).select(F.lit(name).alias("dataset"), "rows",
                                F.lit(len(df.columns)).cast("long").alias("columns"), "null_rows", "duplicate_rows")


def dataset_quality(spark: SparkSession, datasets: dict[str, DataFrame | None]) -> DataFrame:
    """Per dataset: existence, rows, null cells, repeated rows and PASS / CHECK / MISSING."""
    parts = []
    for name, df in datasets.items():
        if df is None:
            parts.append(spark.range(1).select(
                F.lit(name).alias("dataset"), F.lit(False).alias("dataset_exists"), F.lit(0).cast("long").alias("rows"),
                F.lit(None).cast("long").alias("null_values"), F.lit(None).cast("long").alias("duplicate_rows"),
                F.lit("MISSING").alias("status")))
        else:
            parts.append(_profiled(df).select(
                F.lit(name).alias("dataset"), F.lit(True).alias("dataset_exists"), "rows", "null_values",
                "duplicate_rows",
                F.when(F.col("duplicate_rows") > 0, F.lit("CHECK")).otherwise(F.lit("PASS")).alias("status")))
    return union_all(parts)


QUALITY_STATE = T.StructType([
    T.StructField("dataset", T.StringType()), T.StructField("dataset_exists", T.BooleanType()),
    *[T.StructField(c, T.LongType()) for c in ("rows", "null_values", "duplicate_rows")],
    T.StructField("status", T.StringType()), T.StructField("error", T.StringType())])


def dataset_states(spark: SparkSession, paths: dict[str, str], error_length: int = 500) -> DataFrame:
    """``dataset_quality`` of stored datasets with the state ERROR and the error's text for those that cannot be read.

    Each dataset is measured by a job of its own, so a broken file leaves the others' rows alone.
    """
    rows = []
    for name, path in paths.items():
        if not path_exists(spark, path):
            rows.append((name, False, 0, None, None, "MISSING", None))
            continue
        try:
            got = _profiled(spark.read.parquet(path)).first()
            rows.append((name, True, got["rows"], got["null_values"], got["duplicate_rows"],
                         "CHECK" if got["duplicate_rows"] else "PASS", None))
        except (PySparkException, Py4JError) as error:
            rows.append((name, True, 0, None, None, "ERROR", str(error)[:error_length]))
    return spark.createDataFrame(rows, QUALITY_STATE)


def overall_quality(quality: DataFrame) -> DataFrame:
    """PASS only when every dataset passes."""
    return quality.agg(F.when(F.coalesce(F.sum((F.col("status") != "PASS").cast("int")), F.lit(0)) == 0,
                              F.lit("PASS")).otherwise(F.lit("CHECK")).alias("quality_status"))
