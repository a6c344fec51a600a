"""Adapters from the given benchmark tables to the entities the operators work on.

Each adapter maps whole tables; columns that the benchmark lacks are derived
from the values of its rows.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroledger.functions.columns import day_of
from aeroledger.operators import analytics, ml, notifications, rotation, rules
from aeroledger.session import scratch_path
from aeroledger.sources.sinks import write_table
from aeroledger.sources.tables import read_table
from aeroledger.streaming.envelope import build_envelopes

NOW = datetime(2024, 2, 1, 6, 0, tzinfo=timezone.utc)
BAG_MINUTES = 30 * 24 * 60

_PUBLISHED: dict[tuple[str, str, str], str] = {}
_SCHEMAS: dict[str, T.StructType] = {}

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


class Tables:
    """The benchmark tables of one folder, and the entities derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        """The table as stored; its schema is looked up once, since every lookup is a job of its own."""
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    # Flights seen as events: one aircraft per user, one route per event type.
    def flights(self) -> DataFrame:
        cancelled = F.col("event_type") == "error"
        delay = F.when(cancelled, None).when(F.col("value") > 15, F.floor("value").cast("double")).otherwise(F.lit(0.0))
        return (self.raw("events").withColumn("delay_minutes", delay)
                .select(F.col("event_id").alias("flight_id"), F.col("event_type").alias("route_id"),
                        F.col("user_id").alias("aircraft_id"), F.col("ts").alias("scheduled_departure"),
                        (F.col("ts") + F.make_dt_interval(mins=F.col("delay_minutes").cast("int"))).alias("actual_departure"),
                        F.when(cancelled, F.lit("CANCELLED")).otherwise(F.lit("COMPLETED")).alias("status"),
                        "delay_minutes"))

    # Flights seen as orders, with bookings as line items.
    def order_flights(self) -> DataFrame:
        status = F.col("o_orderstatus")
        return self.raw("orders").select(
            F.col("o_orderkey").alias("flight_id"), F.col("o_orderpriority").alias("route_id"),
            F.col("o_custkey").alias("aircraft_id"), day_of("o_orderdate").alias("scheduled_date_id"),
            F.to_date("o_orderdate").alias("flight_date"), F.col("o_orderdate").alias("scheduled_departure"),
            F.when(status == "F", F.lit("COMPLETED")).when(status == "O", F.lit("DEPARTED"))
            .otherwise(F.lit("CANCELLED")).alias("status"),
            F.nullif(F.floor(F.col("o_totalprice") / 10000.0).cast("double"), F.lit(0.0)).alias("delay_minutes"))

    def bookings(self) -> DataFrame:
        return self.raw("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("booking_id"),
            F.col("l_suppkey").alias("customer_id"), F.col("l_orderkey").alias("flight_id"),
            F.col("l_extendedprice").alias("fare"), F.col("l_shipdate").alias("booking_time"),
            F.when(F.col("l_returnflag") == "R", F.lit("REFUNDED")).otherwise(F.lit("CONFIRMED")).alias("status"))

    def aircraft(self) -> DataFrame:
        return self.raw("customer").select(F.col("c_custkey").alias("aircraft_id"),
                                           (F.col("c_nationkey") + 1).alias("seat_capacity"))

    def cancellations(self) -> DataFrame:
        orders = self.raw("orders").filter(F.col("o_orderstatus") == "P")
        return (orders.join(self.raw("customer"), orders["o_custkey"] == F.col("c_custkey"))
                .select(F.col("o_orderkey").alias("flight_id"), F.col("o_orderdate").alias("cancelled_at"),
                        F.col("c_mktsegment").alias("reason_code")))

    def scans(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("bag_id"), F.col("l_shipdate").alias("scan_time"),
            F.nullif("l_returnflag", F.lit("N")).alias("airport"),
            F.when(F.col("l_discount") >= 0.08, F.lit("DELAYED")).otherwise(F.lit("DELIVERED")).alias("status"))

    def tickets(self) -> DataFrame:
        return self.raw("events").select(F.col("event_id").alias("ticket_id"), F.col("user_id").alias("booking_id"),
                                         F.col("event_type").alias("issue_type"), F.col("ts").alias("created_at"))

    def event_bookings(self) -> DataFrame:
        return (self.raw("events").filter(F.col("event_type") == "purchase")
                .select(F.col("user_id").alias("booking_id"), F.col("ts").alias("booking_time")))

    def baggage(self) -> DataFrame:
        return self.raw("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("bag_id"), (F.col("l_orderkey") * 10 + 1).alias("booking_id"),
            F.col("l_shipdate").alias("scan_time"), F.nullif("l_returnflag", F.lit("N")).alias("airport"),
            F.when(F.col("l_discount") >= 0.08, F.lit("DELAYED")).otherwise(F.lit("DELIVERED")).alias("status"))

    def routes(self) -> DataFrame:
        place = F.col("o_custkey") % 25
        return self.raw("orders").groupBy(F.col("o_orderpriority").alias("route_id")).agg(
            F.min(place).alias("origin_airport_id"), F.max(place).alias("dest_airport_id"),
            F.count(F.lit(1)).cast("double").alias("popularity"))

    def airports(self) -> DataFrame:
        return self.raw("nation").join(self.raw("region"), F.col("r_regionkey") == F.col("n_regionkey")).select(
            F.col("n_nationkey").alias("airport_id"), F.col("n_name").alias("city"), F.col("r_name").alias("region"),
            ((F.col("n_nationkey") + 1) * 100).alias("capacity"))

    def fleet(self) -> DataFrame:
        return self.raw("customer").select(F.col("c_custkey").alias("aircraft_id"), F.col("c_mktsegment").alias("type"),
                                           (F.col("c_nationkey") + 1).alias("seat_capacity"))

    def entities(self) -> dict[str, DataFrame]:
        """Every entity of the warehouse with the columns of its table; line items repeat keys, the least row of a key counts."""
        def least(rows: DataFrame, key: str) -> DataFrame:
            own = F.min(F.struct(*[c for c in rows.columns if c != key]))
            return rows.groupBy(key).agg(own.alias("_row")).select(key, "_row.*")

        date = F.to_date("o_orderdate")
        return {
            "airports": self.airports(), "aircraft": self.fleet(), "routes": self.routes(),
            "customers": self.raw("customer").select(
                F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("tier"),
                F.col("c_nationkey").alias("home_region")),
            "dim_date": self.raw("orders").select(date.alias("date")).distinct().select(
                day_of("date").alias("date_id"), "date", F.year("date").alias("year"), F.month("date").alias("month"),
                F.day("date").alias("day"), F.date_format("date", "EEEE").alias("day_of_week"),
                (F.weekday("date") >= 5).alias("is_weekend")),
            "flights": self.order_flights().withColumn("actual_departure", F.lit(None).cast("timestamp")),
            "cancellations": self.cancellations(), "bookings": least(self.bookings(), "booking_id"),
            "baggage": least(self.baggage(), "bag_id"),
            "support_tickets": self.tickets(),
            "fares": self.raw("part").select(
                F.col("p_brand").alias("route_id"), F.col("p_partkey").alias("cabin"), F.lit(NOW).cast("timestamp").alias("timestamp"),
                F.col("p_retailprice").alias("price")),
        }

    # Raw bookings with natural defects: repeated and missing keys, missing status, negative fares.
    def raw_bookings(self) -> DataFrame:
        key = F.when(F.col("value") >= 2, F.col("user_id") * 1000 + F.floor("value"))
        return self.raw("events").select(
            key.alias("booking_id"), F.col("user_id").alias("customer_id"),
            F.nullif("event_type", F.lit("signup")).alias("status"), (F.col("value") - 1).alias("fare"),
            F.col("ts").alias("booking_time"), F.col("event_id").alias("position"))

    # Warehouse tables with natural defects for the check suite.
    def warehouse(self) -> dict[str, DataFrame]:
        li, od, ev = self.raw("lineitem"), self.raw("orders"), self.raw("events")
        status = F.col("o_orderstatus")
        return {
            "fact_flight": od.select(
                F.nullif("o_custkey", F.lit(7)).alias("flight_id"), F.col("o_orderpriority").alias("route_id"),
                F.when(status == "F", F.lit("COMPLETED")).when(status == "O", F.lit("DEPARTED"))
                .otherwise(F.lit("HELD")).alias("status"),
                (F.col("o_totalprice") / 1000.0 - 10.0).alias("delay_minutes"),
                F.col("o_orderdate").alias("_ingested_at"), day_of("o_orderdate").alias("scheduled_date_id")),
            "dim_route": od.filter(F.col("o_orderpriority") != "5-LOW").select(F.col("o_orderpriority").alias("route_id")).distinct(),
            "fact_booking": li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("booking_id"),
                                      F.col("l_orderkey").alias("flight_id"), F.col("l_suppkey").alias("customer_id"),
                                      (F.col("l_extendedprice") - 2000.0).alias("fare")),
            "dim_customer": self.raw("supplier").filter(F.col("s_acctbal") > 0).select(F.col("s_suppkey").alias("customer_id")),
            "fact_baggage": ev.select(F.col("event_id").alias("bag_id"), (F.col("event_id") * 10 + 1).alias("booking_id")),
            "fact_support_ticket": ev.select(F.col("event_id").alias("ticket_id"),
                                             F.nullif("user_id", F.lit(8)).alias("booking_id")),
            "fact_fare_snapshot": self.raw("part").select((F.col("p_retailprice") - 1000.0).alias("price")),
        }

    # Derived outputs the views read.
    def published(self, name: str) -> DataFrame:
        """An output written once per session below the shared folder, as the views would find it."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _PUBLISHED:
            path = scratch_path(self.spark, f"published-{name}")
            write_table(getattr(self, name)(), path)
            _PUBLISHED[key] = path
        return read_table(self.spark, _PUBLISHED[key])

    def rotation(self, **options) -> DataFrame:
        return rotation.rotation_delay_propagation(self.flights(), **options)

    def features(self) -> DataFrame:
        return ml.delay_features(rotation.rotation_delay_propagation(self.flights(), history=True))

    def actions(self) -> DataFrame:
        """Rule-based actions on a stated risk score: earlier delay plus departure hour, in percent."""
        score = F.least(F.lit(1.0), (F.col("previous_flight_delay") + F.col("scheduled_departure_hour")) / 100.0)
        return rules.delay_actions(self.features().withColumn("delay_probability", score))

    def bag_cycles(self) -> DataFrame:
        return analytics.baggage_cycle_sla(self.scans(), BAG_MINUTES)

    def demand(self) -> DataFrame:
        return analytics.route_demand_daily(self.order_flights(), self.bookings())

    def forecast(self) -> DataFrame:
        """A plain forecast next to the actual demand: the mean of the seven days before."""
        return ml.forecast_features(self.demand()).select(
            "route_id", F.col("flight_date").alias("forecast_date"), F.col("rolling_7").alias("predicted_bookings"),
            "booking_count")

    def anomalies(self) -> DataFrame:
        return analytics.cancellation_anomalies(self.cancellations(), self.order_flights())

    def alerts(self) -> DataFrame:
        return rules.unified_alerts(
            rules.delay_alerts(self.published("actions")), rules.baggage_alerts(self.bag_cycles(), BAG_MINUTES),
            rules.demand_alerts(self.forecast().drop("booking_count")), rules.cancellation_alerts(self.anomalies()),
            now=NOW)

    def profitability(self) -> DataFrame:
        return analytics.route_profitability(self.order_flights(), self.bookings())

    def outbox(self) -> DataFrame:
        return notifications.notification_outbox(self.published("alerts"), NOW)

    def audit(self) -> DataFrame:
        """Every alert sent on both channels; chat messages of lesser alerts bounce."""
        outbox = self.published("outbox")
        arrived = (F.col("notification_channel") == "EMAIL") | (F.col("risk_level") == "HIGH")
        results = outbox.select("message_id", arrived.alias("delivered"),
                                F.when(~arrived, F.lit("channel closed")).alias("error"))
        return notifications.notification_audit(outbox, results)

    # The event stream: three known types and one unknown, repeated, late and broken deliveries.
    def stream(self) -> DataFrame:
        events = (self.spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{self.folder}/events*.parquet"))
        # A file's row groups are a few tasks at most, and making and parsing envelopes takes long: rows are dealt out as they are read.
        return self.feed(events.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions"))))

    @staticmethod
    def feed(events: DataFrame) -> DataFrame:
        """(value, arrival) for each delivery; arrival follows the value column, so event times come out of order."""
        copies = F.when(F.col("value") > 100, F.lit(2)).otherwise(F.lit(1))
        rows = events.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
        who, kind = F.col("user_id").cast("string"), F.col("event_type")
        ident = F.concat(F.lit("E"), F.col("event_id").cast("string"))
        arrival = F.struct(F.lit("a").alias("part"), F.floor(F.col("value") * 100.0 + 0.5).alias("block"),
                           (F.col("event_id") * 2 + F.col("copy")).alias("pos"))
        base = rows.withColumns({"_id": ident, "arrival": arrival, "who": who})
        place = F.col("props")
        flights = base.filter(kind.isin("view", "click")).select(
            "_id", "arrival", "value", F.col("who").alias("flight_id"), place.alias("route_id"),
            F.concat(F.lit("A"), "who").alias("aircraft_id"), F.upper(kind).alias("status"),
            F.col("ts").alias("scheduled_departure"), F.col("ts").alias("actual_departure"),
            F.col("value").alias("delay_minutes"))
        bags = base.filter(kind == "error").select(
            "_id", "arrival", "value", F.col("who").alias("bag_id"), F.concat(F.lit("B"), "who").alias("booking_id"),
            place.alias("airport"), F.lit("LOADED").alias("status"), F.col("ts").alias("scan_time"))
        bookings = base.filter(kind.isin("purchase", "signup")).select(
            "_id", "arrival", "value", F.col("who").alias("booking_id"), F.concat(F.lit("C"), "who").alias("customer_id"),
            place.alias("flight_id"), F.col("value").alias("fare"), F.upper(kind).alias("status"),
            F.col("ts").alias("booking_time"))

        def sealed(event_type: str, df: DataFrame) -> DataFrame:
            out = build_envelopes(event_type, df.withColumnRenamed("value", "_raw"), event_id=F.col("_id"),
                                  keep=["arrival", "_raw"])
            cut = F.when(F.col("_raw") < 1, F.substring("value", 1, 40))          # broken JSON
            lacking = F.when(F.col("_raw") < 3, F.replace("value", F.lit('"status"'), F.lit('"state"')))
            return out.select(F.coalesce(cut, lacking, F.col("value")).alias("value"), "arrival")

        return (sealed("flight_status", flights).unionByName(sealed("baggage_scan", bags))
                .unionByName(sealed("booking", bookings)))

