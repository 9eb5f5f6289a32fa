"""Events as Kafka messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.schema import EVENT_FIELDS, EVENT_SCHEMA, MESSAGE_SCHEMA_VERSION


def event_json(fields: Sequence[str] = EVENT_FIELDS) -> Column:
    """JSON text of an event; fields without a value are left out."""
    return F.to_json(F.struct(*fields))


def kafka_rows(events: DataFrame, run_id: str) -> DataFrame:
    """Message key, value and headers of each event.

    The user id is the key, so Kafka keeps the events of a user in one partition
    and in order.
    """
    fields = [f for f in EVENT_FIELDS if f in events.columns]
    headers = {
        "event_type": F.col("event_type"),
        "producer_run_id": F.lit(run_id),
        "schema_version": F.lit(MESSAGE_SCHEMA_VERSION),
    }
    return events.select(
        F.col("user_id").cast("binary").alias("key"),
        event_json(fields).cast("binary").alias("value"),
        F.array(
            *(
                F.struct(F.lit(name).alias("key"), value.cast("binary").alias("value"))
                for name, value in headers.items()
            )
        ).alias("headers"),
    )


def by_user(events: DataFrame, partitions: int) -> DataFrame:
    """Lay out events for a file sink: users together, each in order of time.

    Partitions are ranges of user and time, so a user too large for one task
    continues in the next partition instead of overloading one.
    """
    order = ["user_id", "event_ts"]
    return events.repartitionByRange(partitions, *order).sortWithinPartitions(*order)


def round_trip(events: DataFrame) -> DataFrame:
    """Each event next to itself after serialising and parsing."""
    fields = [f for f in EVENT_FIELDS if f in events.columns]
    text = event_json(fields)
    return events.select(
        "*", text.alias("event_json"), F.from_json(text, EVENT_SCHEMA).alias("parsed_back")
    )
