"""Notifications: payloads as columns, and delivery of each partition by a sink that is off by default."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(c: Column) -> Column:
    return F.when(c.isNull(), "None").otherwise(F.concat(F.lit("'"), c, F.lit("'")))


def payloads(queue: DataFrame) -> DataFrame:
    """field_id, summary, message: one line, and JSON of a row of the review queue."""
    summary = F.concat(F.lit("HITL review: "), F.col("field_name"), F.lit("="), quoted(F.col("value")), F.lit(" on "), F.coalesce("entity_key", F.lit("None")))
    return queue.select("field_id", summary.alias("summary"), F.to_json(F.struct("field_name", "value", "entity_key")).alias("message"))


def messages(pending: DataFrame) -> DataFrame:
    """review_id, summary, description of open reviews: one line, and five with the file's name, entity, field, value and reason. Nulls stand as None."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("None"))

    summary = F.concat(F.lit("HITL review: "), shown("field_name"), F.lit("="), quoted(F.col("value")), F.lit(" on "), shown("entity_key"), F.lit(" ("), shown("reason"), F.lit(")"))
    name = F.coalesce(F.regexp_extract("source_uri", r"([^/]*)$", 1), F.lit("None"))
    description = F.concat(F.lit("File: "), name, F.lit("\nEntity: "), shown("entity_key"), F.lit("\nField: "), shown("field_name"), F.lit("\nValue: "), shown("value"), F.lit("\nReason: "), shown("reason"))
    return pending.select("review_id", summary.alias("summary"), description.alias("description"))


def deliver(df: DataFrame, sink: Callable[[list[dict]], None], enabled: bool = False) -> None:
    """Hands each partition's payloads to `sink` once, if enabled; a failing sink is reported and stops nothing."""
    if not enabled:
        return

    def run(rows) -> None:
        try:
            sink([r.asDict() for r in rows])
        except Exception as e:  # noqa: BLE001: a notification must not stop the run
            print(f"notification failed: {e}")

    df.foreachPartition(run)
