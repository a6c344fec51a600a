"""Notification selection, outbox, delivery audit and acknowledgement (sending itself is outside)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroledger.functions.columns import as_percent, count_when, same_text, short_id

# Types that get a slot of their own, in order, and the team of each.
TYPE_ORDER = ("DELAY_RISK", "BAGGAGE_SLA_BREACH", "DEMAND_SURGE", "CANCELLATION_CLUSTER")
TYPE_OWNERS = {"BAGGAGE_SLA_BREACH": "Baggage Operations", "DEMAND_SURGE": "Network Planning",
               "CANCELLATION_CLUSTER": "Operations Control"}
CHANNELS = ("EMAIL", "SLACK")

AUDIT_COLUMNS = ("message_id", "event_day", "timestamp", "alert_id", "entity_id", "alert_type", "risk_level", "priority", "automation_action",
                 "trigger_reason", "owner", "notification_channel", "recipient")


def arrival_order() -> list[Column]:
    """Default order among alerts: priority, probability, id, reason, day."""
    return [F.asc_nulls_last("priority"), F.desc_nulls_last("model_probability"), F.asc("alert_id"),
            F.asc_nulls_last("trigger_reason"), F.asc_nulls_last("event_day")]


def notifiable(alerts: DataFrame) -> DataFrame:
    """Open HIGH and MEDIUM alerts that ask for a notification."""
    return alerts.filter(F.col("risk_level").isin("HIGH", "MEDIUM")
                         & F.coalesce(F.col("notification_required").cast("boolean"), F.lit(False))
                         & same_text("status", "OPEN"))


def select_notifications(alerts: DataFrame, n: int = 5, order: Sequence[Column] | None = None) -> DataFrame:
    """Up to ``n`` alerts: the first of each known type, then the next ones in order.

    Each type keeps its first n rows before the shuffle (a row-number limit is
    applied per input partition), so at most n rows per type reach the final,
    single-group ranking.
    """
    order = list(order or arrival_order())
    kind = F.upper(F.col("alert_type"))
    slot = F.coalesce(*[F.when(kind == t, F.lit(i)) for i, t in enumerate(TYPE_ORDER)], F.lit(len(TYPE_ORDER)))
    per_type = Window.partitionBy("_slot").orderBy(*order)
    first = (notifiable(alerts).withColumn("_slot", slot)
             .withColumn("_nth", F.row_number().over(per_type)).filter(F.col("_nth") <= n))
    leads = (F.col("_nth") == 1) & (F.col("_slot") < len(TYPE_ORDER))
    overall = Window.orderBy(F.when(leads, F.col("_slot")).otherwise(F.lit(len(TYPE_ORDER))), *order)
    return (first.withColumn("selection_rank", F.row_number().over(overall))
            .filter(F.col("selection_rank") <= n).drop("_slot", "_nth"))


def route_notification(alerts: DataFrame) -> DataFrame:
    """Sets ``owner`` to the responsible team and ``recipient`` to its mailbox key."""
    fleet = F.col("automation_action") == "AIRCRAFT_TURNAROUND_ALERT"
    team = F.coalesce(F.when(fleet, F.lit("Fleet Operations")),
                      *[F.when(F.col("alert_type") == t, F.lit(o)) for t, o in TYPE_OWNERS.items()],
                      F.lit("Operations Control"))
    return alerts.withColumn("owner", team).withColumn(
        "recipient", F.when(fleet, F.lit("fleet_mailbox")).otherwise(F.lit("operations_mailbox")))


def render_message(alerts: DataFrame, now: datetime) -> DataFrame:
    """Adds ``subject``, ``body`` (mail) and ``chat_text`` with defaults for missing fields."""
    def text(column: str, default: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(default)) if column in alerts.columns else F.lit(default)

    entity = text("entity_id", "Unknown")
    probability = as_percent("model_probability") if "model_probability" in alerts.columns else F.lit(0.0)
    facts = [
        ("Alert ID", F.coalesce(text("alert_id", ""), F.concat(F.lit("ALERT-"), entity))),
        ("Alert Type", text("alert_type", "UNKNOWN")),
        ("Flight", entity),
        ("Risk Level", text("risk_level", "UNKNOWN")),
        ("Priority", text("priority", "N/A")),
        ("Delay Probability", F.format_string("%.1f%%", probability)),
        ("Automated Action", text("automation_action", "UNKNOWN")),
        ("Trigger Reason", text("trigger_reason", "Operational risk detected.")),
        ("Owner", text("owner", "Operations Control")),
        ("Status", F.lit("OPEN")),
        ("Generated", F.lit(now.isoformat())),
    ]
    lines = [F.concat(F.lit(f"{label}: "), value) for label, value in facts]
    bold = [F.concat(F.lit(f"*{label}:* "), value) for label, value in facts]
    return alerts.withColumns({
        "subject": F.concat(F.lit("[Operations] "), text("risk_level", "UNKNOWN"), F.lit(" Alert - "), entity),
        "body": F.concat_ws("\n", F.lit("OPERATIONS ALERT"), *lines),
        "chat_text": F.concat_ws("\n", F.lit("*Operational Alert*"), *bold)})


def notification_outbox(selected: DataFrame, now: datetime, channels: Sequence[str] = CHANNELS) -> DataFrame:
    """One message per alert and channel, ready for a sender; ``message_id`` is its own as alerts differ in id, reason or day."""
    routed = render_message(route_notification(selected), now)
    rows = (routed.withColumn("timestamp", F.lit(now).cast("timestamp"))
            .withColumn("notification_channel", F.explode(F.array(*[F.lit(c) for c in channels]))))
    mail = F.col("notification_channel") == "EMAIL"
    ident = short_id("alert_id", "notification_channel", "entity_id", "trigger_reason", "event_day", F.unix_micros("timestamp"))
    return rows.withColumn("message_id", ident).select(
        *AUDIT_COLUMNS, F.when(mail, F.col("subject")).alias("subject"),
        F.when(mail, F.col("body")).otherwise(F.col("chat_text")).alias("message"))


def notification_audit(outbox: DataFrame, results: DataFrame) -> DataFrame:
    """Outbox rows with their delivery: SENT, or FAILED with the error.

    ``results`` holds (message_id, delivered, error); a message without a
    result counts as failed.  Each side is shuffled by id once; results, a narrow row per message, are hashed there, so
    the wide messages stream past them and are never sorted.
    """
    known = results.groupBy("message_id").agg(F.max("delivered").alias("_ok"), F.max("error").alias("_error"))
    sent = F.coalesce(F.col("_ok"), F.lit(False))
    return outbox.join(known.hint("shuffle_hash"), "message_id", "left").select(
        *AUDIT_COLUMNS, F.when(sent, F.lit("SENT")).otherwise(F.lit("FAILED")).alias("status"),
        F.when(~sent, F.coalesce(F.col("_error"), F.lit("no delivery result"))).alias("error"),
        F.lit(None).cast("timestamp").alias("acknowledged_at"))


def delivery_counts(audit: DataFrame, channels: Sequence[str] = CHANNELS) -> DataFrame:
    """Sent and failed messages, and sent ones per channel."""
    sent = F.col("status") == "SENT"
    return audit.agg(count_when(sent).alias("sent"), count_when(F.col("status") == "FAILED").alias("failed"),
                     *[count_when(sent & (F.col("notification_channel") == c)).alias(f"{c.lower()}_sent")
                       for c in channels])


def acknowledge(audit: DataFrame, entity: str, owner: str, now: datetime, id_column: str = "entity_id") -> DataFrame:
    """The audit after acknowledging the entity's newest message; an unknown entity is an error."""
    sent = F.unix_micros("timestamp")
    newest = audit.filter(F.col(id_column).cast("string") == entity).agg(F.max(F.struct(sent, "message_id"))).first()[0]
    if newest is None:
        raise LookupError(f"no notification for {entity}")
    hit = sent.eqNullSafe(F.lit(newest[0])) & (F.col("message_id") == newest[1])
    return (audit.withColumn("_hit", hit)
            .withColumn("status", F.when(F.col("_hit"), F.lit("ACKNOWLEDGED")).otherwise(F.col("status")))
            .withColumn("owner", F.when(F.col("_hit"), F.lit(owner)).otherwise(F.col("owner")))
            .withColumn("acknowledged_at", F.when(F.col("_hit"), F.lit(now).cast("timestamp"))
                        .otherwise(F.col("acknowledged_at"))).drop("_hit"))
