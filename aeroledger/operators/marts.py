"""KPI marts over the warehouse tables.

Facts are aggregated on their join key before they meet another table, so a
flight with a third of all bookings costs one row per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroledger.functions.columns import count_when, exact_avg, exact_sum, ratio, round_to

# Column-pruned pass-through per source table, the base the marts read.
STAGING = {
    "stg_flights": ("flight_id", "route_id", "aircraft_id", "scheduled_date_id", "scheduled_departure",
                    "actual_departure", "status", "delay_minutes"),
    "stg_bookings": ("booking_id", "customer_id", "flight_id", "fare", "booking_time", "status"),
    "stg_baggage": ("bag_id", "booking_id", "scan_time", "airport", "status"),
    "stg_cancellations": ("flight_id", "cancelled_at", "reason_code"),
    "stg_support_tickets": ("ticket_id", "booking_id", "issue_type", "created_at"),
    "stg_routes": ("route_id", "origin_airport_id", "dest_airport_id", "popularity"),
    "stg_airports": ("airport_id", "city", "region", "capacity"),
    "stg_aircraft": ("aircraft_id", "type", "seat_capacity"),
}


def staging(name: str, table: DataFrame) -> DataFrame:
    """Staging projection of a warehouse table (columns the table lacks are left out)."""
    return table.select(*[c for c in STAGING[name] if c in table.columns])


def day(c: str) -> Column:
    return F.date_trunc("day", F.col(c))


def _kept(bookings: DataFrame, dropped: Sequence[str]) -> DataFrame:
    """Bookings whose status is known and not in ``dropped``."""
    return bookings.filter(~F.col("status").isin(*dropped))


def load_factor(flights: DataFrame, aircraft: DataFrame, bookings: DataFrame,
                flown: Sequence[str] = ("COMPLETED", "DEPARTED", "BOARDING"),
                dropped: Sequence[str] = ("REFUNDED",)) -> DataFrame:
    """Booked over available seats per route and day."""
    seats = (flights.filter(F.col("status").isin(*flown))
             .select("flight_id", "route_id", "aircraft_id", F.col("scheduled_date_id").alias("flight_date"))
             .join(aircraft.select("aircraft_id", "seat_capacity"), "aircraft_id", "left"))
    booked = _kept(bookings, dropped).groupBy("flight_id").agg(F.count(F.lit(1)).alias("_booked"))
    totals = (seats.join(booked, "flight_id", "left").groupBy("route_id", "flight_date")
              .agg(F.countDistinct("flight_id").alias("flights"),
                   F.sum(F.coalesce("_booked", F.lit(0))).alias("booked_seats"),
                   F.sum("seat_capacity").alias("available_seats")))
    return totals.withColumn("load_factor", round_to(ratio("booked_seats", "available_seats"), 4))


def delay_minutes(flights: DataFrame, flown: Sequence[str] = ("COMPLETED", "DEPARTED"),
                  late_after: float = 15) -> DataFrame:
    """Delay trend per route and day."""
    late = count_when(F.col("delay_minutes") > late_after)
    return (flights.filter(F.col("status").isin(*flown))
            .groupBy("route_id", F.col("scheduled_date_id").alias("flight_date"))
            .agg(F.count(F.lit(1)).alias("flights"), late.alias("delayed_flights"),
                 round_to(exact_avg("delay_minutes", 6), 2).alias("avg_delay_minutes"),
                 round_to(exact_sum("delay_minutes", 6), 2).alias("total_delay_minutes"),
                 round_to(100.0 * ratio(late, F.count(F.lit(1))), 2).alias("pct_flights_delayed")))


def cancellation_rate(flights: DataFrame, cancellations: DataFrame) -> DataFrame:
    """Cancelled share per route and day with the most frequent reason (ties: the smallest)."""
    route_day = flights.select("flight_id", "route_id", F.col("scheduled_date_id").alias("flight_date"))
    planned = route_day.groupBy("route_id", "flight_date").agg(F.count(F.lit(1)).alias("scheduled_flights"))
    by_reason = (cancellations.select("flight_id", "reason_code").join(route_day, "flight_id")
                 .groupBy("route_id", "flight_date", "reason_code").agg(F.count(F.lit(1)).alias("_n")))
    # Largest count first, then smallest reason: the minimum of (-count, reason).
    top = F.min(F.when(F.col("reason_code").isNotNull(), F.struct((-F.col("_n")).alias("n"), "reason_code")))
    cancelled = by_reason.groupBy("route_id", "flight_date").agg(
        F.sum("_n").alias("_cancelled"), top["reason_code"].alias("top_reason_code"))
    share = 100.0 * ratio("cancelled_flights", "scheduled_flights")
    return (planned.join(cancelled, ["route_id", "flight_date"], "left")
            .select("route_id", "flight_date", "scheduled_flights",
                    F.coalesce("_cancelled", F.lit(0)).alias("cancelled_flights"), "top_reason_code")
            .withColumn("cancellation_rate_pct", round_to(share, 2)))


def baggage_sla(baggage: DataFrame, late_status: str = "DELAYED") -> DataFrame:
    """Share of scans on time per airport and day."""
    late = count_when(F.col("status") == late_status)
    return (baggage.groupBy("airport", day("scan_time").alias("scan_date"))
            .agg(F.count(F.lit(1)).alias("bags_scanned"), late.alias("sla_breaches"),
                 round_to(100.0 * (1.0 - ratio(late, F.count(F.lit(1)))), 2).alias("baggage_sla_pct")))


def route_revenue(bookings: DataFrame, flights: DataFrame, dropped: Sequence[str] = ("REFUNDED",)) -> DataFrame:
    """Kept bookings and their fares per route and booking day."""
    per_flight = (_kept(bookings, dropped)
                  .groupBy("flight_id", day("booking_time").alias("booking_date"))
                  .agg(F.count(F.lit(1)).alias("_n"), exact_sum("fare").alias("_fare")))
    return (per_flight.join(flights.select("flight_id", "route_id"), "flight_id")
            .groupBy("route_id", "booking_date")
            .agg(F.sum("_n").alias("bookings"), round_to(exact_sum("_fare"), 2).alias("route_revenue")))


def revenue_per_flight(flights: DataFrame, bookings: DataFrame, dropped: Sequence[str] = ("REFUNDED",)) -> DataFrame:
    """Every flight with its kept bookings; revenue is NULL where there are none."""
    kept = (_kept(bookings, dropped).groupBy("flight_id")
            .agg(F.count("booking_id").alias("_n"), round_to(exact_sum("fare"), 2).alias("flight_revenue"),
                 round_to(exact_avg("fare"), 2).alias("avg_fare")))
    return (flights.select("flight_id", "route_id", F.col("scheduled_date_id").alias("flight_date"))
            .join(kept, "flight_id", "left")
            .select("flight_id", "route_id", "flight_date", F.coalesce("_n", F.lit(0)).alias("bookings"),
                    "flight_revenue", "avg_fare"))


def complaint_rate(tickets: DataFrame, bookings: DataFrame) -> DataFrame:
    """Tickets per 1,000 bookings by day and issue; days without bookings do not appear."""
    booked = bookings.groupBy(day("booking_time").alias("day")).agg(F.count(F.lit(1)).alias("bookings"))
    raised = tickets.groupBy(day("created_at").alias("day"), "issue_type").agg(F.count(F.lit(1)).alias("tickets"))
    return (raised.join(booked, "day")
            .select("day", "issue_type", "tickets", "bookings",
                    round_to(1000.0 * ratio("tickets", "bookings"), 2).alias("complaints_per_1000_bookings")))
