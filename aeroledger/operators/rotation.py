"""Aircraft rotations: how a late departure spreads to the aircraft's next legs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroledger.functions.columns import count_when, exact_avg, exact_sum, flag, minutes_between, round_to
from aeroledger.operators.skew import SLICE_ROWS, with_sequence

CARRIED = ("flight_id", "scheduled_departure", "actual_departure", "delay_minutes")


def rotation_delay_propagation(flights: DataFrame, history: bool = False,
                               slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per flight with its place in the aircraft's day and the delay inherited from the leg before.

    A missing delay counts as zero; cancelled legs stay in the rotation.  The
    whole previous leg travels as one struct, so a single window pass serves
    every ``prev_`` column.  ``history`` adds ``prev_is_cascade_delay``, the flag
    of the leg before, which looks two legs back.
    """
    legs = flights.select(
        "flight_id", "route_id", "aircraft_id", F.to_date("scheduled_departure").alias("flight_date"),
        "scheduled_departure", "actual_departure", "status",
        F.coalesce(F.col("delay_minutes").cast("double"), F.lit(0.0)).alias("delay_minutes"))
    legs = with_sequence(legs, ["aircraft_id", "flight_date"], ["scheduled_departure", "flight_id"], CARRIED,
                         seq="rotation_sequence", prevs=["_leg", "_leg2"] if history else ["_leg"],
                         slice_rows=slice_rows)
    late = F.col("delay_minutes") > 0
    inherited = F.col("_leg.delay_minutes") > 0
    cascade = late & inherited
    earlier = [flag(inherited & (F.col("_leg2.delay_minutes") > 0)).alias("prev_is_cascade_delay")] if history else []
    return legs.select(
        "flight_id", "route_id", "aircraft_id", "flight_date",
        F.col("rotation_sequence").cast("int").alias("rotation_sequence"),
        "scheduled_departure", "actual_departure", "status", "delay_minutes",
        *[F.col(f"_leg.{c}").alias(f"prev_{c}") for c in CARRIED],
        minutes_between("scheduled_departure", "_leg.actual_departure").alias("turnaround_minutes"),
        F.when(inherited, F.col("_leg.delay_minutes")).otherwise(F.lit(0.0)).alias("propagated_delay_min"),
        flag(cascade).alias("is_cascade_delay"),
        F.when(cascade, F.lit("PROPAGATED")).when(late, F.lit("PRIMARY_DELAY"))
        .otherwise(F.lit("NO_DELAY")).alias("delay_propagation_flag"), *earlier)


def rotation_counts(rotation: DataFrame) -> DataFrame:
    """Total and cascading legs, in one pass."""
    return rotation.agg(F.count(F.lit(1)).alias("total_rows"),
                        count_when(F.col("is_cascade_delay") == 1).alias("cascade_rows"))


def rotation_delay_mart(rotation: DataFrame) -> DataFrame:
    """Per aircraft and day: legs, late and cascading legs, mean delay and turnaround, minutes inherited."""
    return rotation.groupBy("flight_date", "aircraft_id").agg(
        F.count(F.lit(1)).alias("total_flights"),
        count_when(F.col("delay_minutes") > 0).alias("delayed_flights"),
        count_when(F.col("is_cascade_delay") == 1).alias("cascade_delay_flights"),
        round_to(exact_avg("delay_minutes", 6), 2).alias("average_delay_minutes"),
        round_to(exact_avg("turnaround_minutes", 6), 2).alias("average_turnaround_minutes"),
        round_to(exact_sum("propagated_delay_min", 6), 2).alias("total_propagated_delay_minutes"))
