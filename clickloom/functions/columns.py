"""Derived columns of a click event. Each function returns a column expression."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.schema import ALERT_FORMAT, EVENT_SCHEMA, FUNNEL_STAGES, OTHER_STAGE

# Amounts are summed as decimals: such sums do not depend on the order of rows, so
# a retried task or another partitioning gives the same total. Amounts that are no
# such decimals (NaN, infinite, too large, finer than the scale) are summed as
# doubles beside them, so nothing leaves a total and nothing overflows.
MONEY = "decimal(20,4)"
MONEY_SCALE = 4
MONEY_LIMIT = 1e15


def parsed_event(json: Column) -> Column:
    return F.from_json(json, EVENT_SCHEMA)


def event_time(text: Column) -> Column:
    """Null on unreadable text, in ANSI mode too."""
    return F.try_to_timestamp(text)


def is_type(*event_types: str) -> Column:
    return F.col("event_type").isin(*event_types)


def funnel_stage(event_type: Column) -> Column:
    """Stage of an event type; ``other`` for login, logout and the unknown."""
    (first, first_types), *rest = FUNNEL_STAGES.items()
    stages = reduce(
        lambda chain, item: chain.when(event_type.isin(*item[1]), item[0]),
        rest,
        F.when(event_type.isin(*first_types), first),
    )
    return stages.otherwise(OTHER_STAGE)


def revenue(is_purchase: Column, cart_value: Column) -> Column:
    """Cart value of a purchase (null if it has none), 0 for everything else."""
    return F.when(is_purchase, cart_value).otherwise(F.lit(0.0))


def lag_ms(later: Column, earlier: Column) -> Column:
    """Difference in whole seconds, as milliseconds; may be negative."""
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) * F.lit(1000)


def _is_exact(amount: Column) -> Column:
    return (F.abs(amount) < MONEY_LIMIT) & (F.round(amount, MONEY_SCALE) == amount)


def exact_amount(amount: Column) -> Column:
    """The amount as a decimal; null for one that is none."""
    return F.when(_is_exact(amount), amount.try_cast(MONEY))


def odd_amount(amount: Column) -> Column:
    """The amount as it is if :func:`exact_amount` has none for it."""
    return F.when(~_is_exact(amount), amount)


def money(exact: Column, odd: Column) -> Column:
    """A total from the sums of both kinds; null without any amount."""
    parts = F.coalesce(exact.cast("double"), F.lit(0.0)) + F.coalesce(odd, F.lit(0.0))
    return F.when(exact.isNotNull() | odd.isNotNull(), parts)


def money_sum(amount: Column) -> Column:
    """Aggregate: the total of a column of amounts."""
    return money(F.sum(exact_amount(amount)), F.sum(odd_amount(amount)))


def category_slug(category: Column) -> Column:
    return F.replace(F.lower(category), F.lit(" "), F.lit("-"))


def page_url() -> Column:
    """Page an event happens on, from its type, product and search text."""
    product_page = F.concat(F.lit("/product/"), F.col("product_id"))
    search_page = F.concat(
        F.lit("/search?q="), F.replace(F.col("search_query"), F.lit(" "), F.lit("+"))
    )
    return (
        F.when(is_type("product_view", "add_to_cart"), product_page)
        .when(is_type("search"), search_page)
        .when(is_type("remove_from_cart"), "/cart")
        .when(is_type("checkout_start"), "/checkout")
        .when(is_type("checkout_complete"), "/order-confirmation")
        .when(is_type("user_login", "user_logout"), "/account")
        .otherwise("/")
    )


def category_url(category: Column) -> Column:
    return F.concat(F.lit("/category/"), category_slug(category))


def alert_text() -> Column:
    return F.format_string(
        ALERT_FORMAT,
        F.col("order_id"),
        F.col("user_id"),
        F.coalesce(F.col("cart_value"), F.lit(0.0)),
        F.col("payment_method"),
    )
