"""State rebuilt from past events: running cart per session, login per user.

The value at an event depends on all earlier events of its key. It is a running
sum that some events reset, so it is scanned in ranges of rows (``running.py``)
rather than in a window per key. On a stream see ``keyed_streams.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import MONEY_SCALE, exact_amount, is_type
from clickloom.operators.running import KEEP, RESET_AFTER, RESET_BEFORE, running_sums

ORDER = ("event_ts", "event_id")

# Amounts are added up as two whole numbers of this base, as one would be too long.
_BASE = 10**9


def units(amount: Column) -> Column:
    """An amount in the smallest unit of money, a decimal; 0 for one that is none."""
    whole = (exact_amount(amount) * F.lit(10**MONEY_SCALE)).cast("decimal(30,0)")
    return F.coalesce(whole, F.lit(0).cast("decimal(30,0)"))


def added_units() -> Column:
    """What an event adds to its cart."""
    return F.when(
        is_type("add_to_cart"), units(F.round(F.col("price") * F.col("quantity"), 2))
    ).otherwise(F.lit(0).cast("decimal(30,0)"))


def shown_cart(cart: Column, price: Column) -> Column:
    """What an event shows of a cart, both in units, as an amount."""
    shown = F.when(is_type("remove_from_cart"), F.greatest(cart - price, F.lit(0))).when(
        is_type("add_to_cart", "checkout_start", "checkout_complete"), cart
    )
    amount = shown.cast("decimal(38,4)") / F.lit(10**MONEY_SCALE)
    return F.round(amount.cast("double"), 2)


def cart_state(events: DataFrame) -> DataFrame:
    """Add ``running_cart``: the cart value a cart or checkout event shows.

    ``add_to_cart`` adds price times quantity, rounded to cents.
    ``checkout_complete`` shows the cart and then empties it.
    ``remove_from_cart`` shows the cart less the price, at least 0, but the cart
    itself stays as it was; that is how the event stream defines it.
    ``checkout_start`` shows the cart. Other events show null. A checkout
    without a cart shows 0. A price that is no plain amount (NaN, infinite, over
    1e15, finer than the money scale) adds nothing and takes nothing off.
    """
    added = added_units()
    upper = F.floor(added / F.lit(_BASE))
    parts = {"_cart_upper": upper, "_cart_lower": added - upper * F.lit(_BASE)}
    emptied = F.when(is_type("checkout_complete"), RESET_AFTER).otherwise(KEEP)
    scanned = running_sums(events, "session_id", ORDER, parts, emptied)
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    cart = wide("_cart_upper") * F.lit(_BASE) + wide("_cart_lower")
    return scanned.select(
        *events.columns, shown_cart(cart, units(F.col("price"))).alias("running_cart")
    )


def login_state(events: DataFrame) -> DataFrame:
    """Add ``logged_in``: whether the user is logged in at (and after) the event."""
    changes = F.when(is_type("user_login", "user_logout"), RESET_BEFORE).otherwise(KEEP)
    logins = {"_logins": F.when(is_type("user_login"), 1).otherwise(0)}
    scanned = running_sums(events, "user_id", ORDER, logins, changes)
    return scanned.select(*events.columns, (F.col("_logins") > 0).alias("logged_in"))
