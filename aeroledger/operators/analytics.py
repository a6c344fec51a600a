"""Business analytics: profitability, bag cycles, complaints, demand, cancellation spikes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeroledger.functions.columns import (
    exact_minutes_between, exact_sum, lenient_timestamp, numeric, ratio, round_to)


def route_profitability(flights: DataFrame, bookings: DataFrame, fixed_cost: float = 5000,
                        delay_cost: float = 100, variable_rate: float = 0.45,
                        healthy: float = 20) -> DataFrame:
    """Estimated profit per route, best first.

    Revenue counts every booking; cost is a stated proxy (a fixed amount per
    flight, an amount per delay minute, a share of revenue).
    """
    per_flight = (bookings.select("flight_id", numeric("fare").alias("_fare")).groupBy("flight_id")
                  .agg(exact_sum("_fare").alias("_revenue")))
    totals = (flights.select("flight_id", "route_id", numeric("delay_minutes").alias("_delay"))
              .filter(F.col("route_id").isNotNull())
              .join(per_flight, "flight_id", "left").groupBy("route_id")
              .agg(exact_sum(F.coalesce("_revenue", F.lit(0.0))).alias("total_revenue"),
                   F.countDistinct("flight_id").alias("total_flights"),
                   exact_sum("_delay", 6).alias("_delay_sum"), F.count(F.lit(1)).alias("_rows")))
    totals = totals.withColumn("avg_delay_minutes", F.col("_delay_sum") / F.col("_rows"))
    cost = (F.col("total_flights") * fixed_cost + F.col("avg_delay_minutes") * F.col("total_flights") * delay_cost
            + F.col("total_revenue") * variable_rate)
    margin = F.col("profit_margin_pct")
    return (totals.withColumn("revenue_per_flight", ratio("total_revenue", "total_flights"))
            .withColumn("estimated_operating_cost", cost)
            .withColumn("estimated_profit", F.col("total_revenue") - F.col("estimated_operating_cost"))
            .withColumn("profit_margin_pct", ratio("estimated_profit", "total_revenue") * 100.0)
            .withColumn("profitability_status", F.when(margin >= healthy, F.lit("HEALTHY"))
                        .when(margin >= 0, F.lit("BREAK_EVEN")).otherwise(F.lit("LOSS")))
            .drop("_delay_sum", "_rows")
            .orderBy(F.desc_nulls_last("estimated_profit"), "route_id"))


def baggage_cycle_sla(scans: DataFrame, minutes: float = 45) -> DataFrame:
    """Time between a bag's first and last scan, and whether it broke the limit.

    The airport is the one of the earliest scan that names an airport.
    """
    timed = (scans.withColumn("_at", lenient_timestamp("scan_time"))
             .filter(F.col("bag_id").isNotNull() & F.col("_at").isNotNull()))
    place = F.min(F.when(F.col("airport").isNotNull(), F.struct("_at", "airport")))
    bags = timed.groupBy("bag_id").agg(F.min("_at").alias("first_scan"), F.max("_at").alias("last_scan"),
                                       place["airport"].alias("airport"))
    cycle = exact_minutes_between("last_scan", "first_scan")
    return (bags.withColumn("cycle_minutes", cycle).withColumn("sla_minutes", F.lit(minutes))
            .withColumn("sla_breached", F.col("cycle_minutes") > minutes)
            .withColumn("sla_status", F.when(F.col("sla_breached"), F.lit("BREACH")).otherwise(F.lit("WITHIN_SLA"))))


def passenger_experience(tickets: DataFrame, bookings: DataFrame | None = None,
                         carry: Sequence[str] = ()) -> DataFrame:
    """Tickets with a parsed time and date, one row per ticket.

    Booking columns named in ``carry`` are looked up from one booking per id (the
    smallest values).  Without any, a left join to distinct booking ids could
    change nothing, so the bookings are not read at all.
    """
    out = (tickets.withColumn("created_at", lenient_timestamp("created_at"))
           .withColumn("ticket_date", F.to_date("created_at")))
    if bookings is None or not carry:
        return out
    known = bookings.groupBy("booking_id").agg(F.min(F.struct(*carry)).alias("_b"))
    return out.join(known, "booking_id", "left").select(*out.columns, *[F.col(f"_b.{c}").alias(c) for c in carry])


def issue_summary(tickets: DataFrame, issue: str = "issue_type") -> DataFrame:
    """Tickets per issue with their share of all tickets, most frequent first."""
    counts = (tickets.filter(F.col(issue).isNotNull()).groupBy(issue)
              .agg(F.count(F.lit(1)).alias("ticket_count")))
    total = counts.agg(F.sum("ticket_count")).scalar()
    return (counts.withColumn("complaint_share_pct", ratio("ticket_count", total) * 100.0)
            .orderBy(F.desc("ticket_count"), issue))


def route_demand_daily(flights: DataFrame, bookings: DataFrame) -> DataFrame:
    """Bookings per route and flight day, zero for flights nobody booked."""
    booked = bookings.groupBy("flight_id").agg(F.count(F.lit(1)).alias("_n"))
    return (flights.select("flight_id", "route_id", "flight_date")
            .filter(F.col("flight_date").isNotNull() & F.col("route_id").isNotNull())
            .join(booked, "flight_id", "left")
            .groupBy("flight_date", "route_id")
            .agg(F.sum(F.coalesce("_n", F.lit(0))).alias("booking_count")))


def cancellation_anomalies(cancellations: DataFrame, flights: DataFrame | None = None,
                           medium: float = 2, high: float = 3) -> DataFrame:
    """Days on which a route cancelled unusually often (z-score of daily counts), strongest first.

    The route comes from ``flights`` when given, else the cancellations carry
    it.  The spread uses integer sums, so the score does not depend on row order.
    """
    dated = cancellations.withColumn("cancel_date", F.to_date(lenient_timestamp("cancelled_at")))
    if flights is not None:
        dated = dated.join(flights.select("flight_id", "route_id"), "flight_id", "left")
    daily = (dated.filter(F.col("route_id").isNotNull() & F.col("cancel_date").isNotNull())
             .groupBy("cancel_date", "route_id").agg(F.count(F.lit(1)).alias("cancellation_count")))
    # One row per route and calendar day by now, so a route's group is bounded by the calendar.
    n = F.col("cancellation_count")
    days, total, squares = (F.count(F.lit(1)), F.sum(n), F.sum(n * n))
    spread = F.sqrt((F.col("_days") * F.col("_sq") - F.col("_sum") * F.col("_sum")).cast("double")
                    / (F.col("_days") * (F.col("_days") - 1)).cast("double"))
    w = Window.partitionBy("route_id")
    scored = (daily.withColumn("_days", days.over(w)).withColumn("_sum", total.over(w))
              .withColumn("_sq", squares.over(w))
              .withColumn("mean", ratio("_sum", "_days"))
              .withColumn("std", F.when(F.col("_days") > 1, spread).otherwise(F.lit(0.0)))
              .withColumn("z_score", F.when(F.col("std") > 0, (n - F.col("mean")) / F.col("std"))
                          .otherwise(F.lit(0.0))))
    z = F.col("z_score")
    return (scored.withColumn("anomaly", z >= medium)
            .withColumn("severity", F.when(z >= high, F.lit("HIGH")).when(z >= medium, F.lit("MEDIUM"))
                        .otherwise(F.lit("NORMAL")))
            .drop("_days", "_sum", "_sq")
            .orderBy(F.desc("z_score"), "cancel_date", "route_id"))


def analytics_metrics(spark, forecast_metrics: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Documentation rows for a JSON sink: one per analysis, one per threshold, one per forecast route."""
    methods = [
        ("route_profitability", "revenue aggregation with a stated operating-cost proxy",
         "cost is estimated, no cost field exists"),
        ("baggage_sla", "time between first and last scan", "scans may not cover the whole journey"),
        ("passenger_experience", "ticket volume and issue mix", "tickets are a proxy for complaints"),
        ("demand_forecasting", "chronological 80/20 split, lag and rolling features, random forest",
         "short history, no seasonality drivers"),
        ("cancellation_anomaly_detection", "z-score of daily cancellations per route",
         "short history makes the spread unstable"),
    ]
    doc = spark.createDataFrame(methods, "analysis string, method string, limitation string")
    limits = spark.createDataFrame([(k, float(v)) for k, v in thresholds.items()], "threshold string, value double")
    routes = forecast_metrics.withColumn("analysis", F.lit("demand_forecasting"))
    return (doc.unionByName(limits, allowMissingColumns=True)
            .unionByName(routes, allowMissingColumns=True))


def chronological_rows(demand: DataFrame, lags: Sequence[int] = (1, 7, 14), window: int = 7,
                       min_days: int = 21) -> DataFrame:
    """Lag and rolling features per route; rows without a full history are left out.

    Lags count rows, not calendar days.  Input has one row per route and day, so
    a route's window is bounded by the calendar.
    """
    w = Window.partitionBy("route_id").orderBy("flight_date")
    recent = w.rowsBetween(-window, -1)
    out = (demand.withColumn("day_index", F.row_number().over(w) - 1)
           .withColumn("_days", F.count(F.lit(1)).over(Window.partitionBy("route_id"))))
    for lag in lags:
        out = out.withColumn(f"lag_{lag}", F.lag("booking_count", lag).over(w))
    full = F.count("booking_count").over(recent) == window
    out = (out.withColumn(f"rolling_{window}", F.when(full, F.sum("booking_count").over(recent) / F.lit(float(window))))
           .withColumn("dow", F.weekday("flight_date")))
    needed = [f"lag_{lag}" for lag in lags] + [f"rolling_{window}"]
    return (out.filter(F.col("_days") >= min_days).dropna(subset=[*needed, "booking_count"]).drop("_days"))
