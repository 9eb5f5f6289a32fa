"""Data-quality rules on a table of click events."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import event_time, is_type
from clickloom.operators.catalog import lookup
from clickloom.operators.serialize import event_json
from clickloom.schema import (
    CATEGORIES,
    DEVICE_TYPES,
    EVENT_FIELDS,
    EVENT_SCHEMA,
    EVENT_TYPES,
    ORDER_PREFIX,
    PAYMENT_METHODS,
    REQUIRED_FIELDS,
    SESSION_PREFIX,
    USER_PREFIX,
)

UUID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def quality_report(
    events: DataFrame,
    catalog: DataFrame,
    max_users: int,
    categories: Sequence[str] = CATEGORIES,
) -> DataFrame:
    """``rule, checked, failed`` of every rule.

    All rules that look at one event share one scan and one aggregate. The two
    that compare events (number of users, repeated ids) read one column each.
    ``events`` has the 20 fields of the wire format, and may have the text that
    was sent in ``event_json``; without it the events are serialised here.
    """
    ids = events.select("user_id", "event_id")
    return (
        _event_rules(lookup(events, catalog), categories)
        .unionByName(user_bound(ids, max_users))
        .unionByName(_repeated_ids(ids))
    )


def event_rules(categories: Sequence[str] = CATEGORIES) -> dict[str, tuple[Column, Column]]:
    """Per rule: which events it applies to, and what must hold for them.

    ``event_json`` is the serialised event, the ``catalog_`` columns are those of
    the product lookup.
    """
    every = F.lit(True)
    text = F.col("event_json")
    has = {c: F.col(c).isNotNull() for c in EVENT_FIELDS}
    present = reduce(lambda a, b: a + b, (has[c].cast("int") for c in EVENT_FIELDS))
    return {
        "required_fields": (
            every,
            reduce(lambda a, b: a & b, (has[c] & (F.col(c) != "") for c in REQUIRED_FIELDS)),
        ),
        "event_id_uuid": (every, F.col("event_id").rlike(UUID_PATTERN)),
        "timestamp_iso8601": (every, event_time(F.col("event_timestamp")).isNotNull()),
        "event_type_domain": (every, is_type(*EVENT_TYPES)),
        "device_type_domain": (every, F.col("device_type").isin(*DEVICE_TYPES)),
        "user_id_prefix": (every, F.col("user_id").startswith(USER_PREFIX)),
        "session_id_prefix": (every, F.col("session_id").startswith(SESSION_PREFIX)),
        "product_view_product": (
            is_type("product_view"),
            F.col("catalog_price").isNotNull()
            & (F.col("price") > 0)
            & F.col("category").isin(*categories),
        ),
        "add_to_cart_quantity": (
            is_type("add_to_cart"),
            has["product_id"] & F.col("quantity").between(1, 5) & (F.col("cart_value") > 0),
        ),
        "checkout_complete_order": (
            is_type("checkout_complete"),
            F.col("order_id").startswith(ORDER_PREFIX)
            & F.col("payment_method").isin(*PAYMENT_METHODS),
        ),
        "search_query_set": (is_type("search"), F.col("search_query") != ""),
        "page_url_set": (every, F.col("page_url") != ""),
        "price_positive": (has["price"], F.col("price") > 0),
        "cart_value_not_negative": (has["cart_value"], F.col("cart_value") >= 0),
        "json_round_trip": (
            every,
            F.from_json(text, EVENT_SCHEMA)["event_id"].eqNullSafe(F.col("event_id")),
        ),
        "json_without_nulls": (every, F.size(F.json_object_keys(text)) == present),
    }


def with_json(events: DataFrame) -> DataFrame:
    """``events`` with the text that was sent, or what would be."""
    sent = F.col("event_json") if "event_json" in events.columns else event_json()
    return events.withColumn("event_json", sent)


def rule_counts(rules: dict[str, tuple[Column, Column]]) -> list[Column]:
    """Aggregates: checked and failed events of every rule."""
    counts = []
    for name, (applies, holds) in rules.items():
        broken = applies & ~F.coalesce(holds, F.lit(False))
        counts += [
            F.count_if(applies).alias(f"{name}_checked"),
            F.count_if(broken).alias(f"{name}_failed"),
        ]
    return counts


def rule_rows(totals: DataFrame, names: Sequence[str]) -> DataFrame:
    """The one row of ``totals`` as a row per rule."""
    rows = (
        F.struct(
            F.lit(name).alias("rule"),
            F.col(f"{name}_checked").alias("checked"),
            F.col(f"{name}_failed").alias("failed"),
        )
        for name in names
    )
    return totals.select(F.inline(F.array(*rows)))


def _event_rules(events: DataFrame, categories: Sequence[str]) -> DataFrame:
    rules = event_rules(categories)
    # At most one entry per known type.
    seen = F.collect_set(F.when(is_type(*EVENT_TYPES), F.col("event_type")))
    known = F.array(*(F.lit(t) for t in EVENT_TYPES))
    totals = with_json(events).agg(*rule_counts(rules), seen.alias("seen")).withColumns(
        {
            "event_types_present_checked": F.size(known).cast("bigint"),
            "event_types_present_failed": F.size(F.array_except(known, "seen")).cast("bigint"),
        }
    )
    return rule_rows(totals, [*rules, "event_types_present"])


def user_bound(events: DataFrame, max_users: int) -> DataFrame:
    users = events.agg(F.countDistinct("user_id").alias("checked"))
    return users.select(
        F.lit("users_within_bound").alias("rule"),
        "checked",
        F.greatest(F.col("checked") - F.lit(max_users), F.lit(0)).cast("bigint").alias("failed"),
    )


def _repeated_ids(events: DataFrame) -> DataFrame:
    per_id = events.groupBy("event_id").agg(F.count("*").alias("copies"))
    return per_id.agg(
        F.lit("event_ids_unique").alias("rule"),
        F.count("*").alias("checked"),
        F.count_if(F.col("copies") > 1).alias("failed"),
    )
