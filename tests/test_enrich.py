from datetime import date

import pytest
from conftest import add_to_cart, event, purchase
from pyspark.sql import functions as F

from clickloom.functions.columns import category_url, page_url
from clickloom.operators.alerts import high_value_purchases
from clickloom.operators.enrich import enrich
from clickloom.operators.routing import parse_and_validate
from clickloom.schema import EVENT_TYPES


def enriched(messages, *payloads, clock=None):
    return enrich(parse_and_validate(messages(*payloads), clock)[0])


def test_date_parts(messages):
    row = enriched(messages, event()).first()
    assert (row.event_date, row.event_hour, row.event_minute) == (date(2024, 2, 29), 23, 5)


@pytest.mark.parametrize(
    "payload, is_purchase, is_add, revenue",
    [
        (event(), False, False, 0.0),
        (purchase(), True, False, 169.0),
        (add_to_cart(), False, True, 0.0),
        (purchase(cart_value=None), True, False, None),
    ],
)
def test_flags_and_revenue(messages, payload, is_purchase, is_add, revenue):
    row = enriched(messages, payload).first()
    assert (row.is_purchase, row.is_add_to_cart, row.revenue) == (is_purchase, is_add, revenue)


def test_funnel_stages(messages):
    rows = enriched(messages, *(event(event_type=t) for t in EVENT_TYPES)).collect()
    assert {r.event_type: r.funnel_stage for r in rows} == {
        "page_view": "awareness",
        "search": "awareness",
        "product_view": "consideration",
        "wishlist_add": "consideration",
        "add_to_cart": "intent",
        "remove_from_cart": "intent",
        "checkout_start": "purchase",
        "checkout_complete": "purchase",
        "user_login": "other",
        "user_logout": "other",
    }


@pytest.mark.parametrize(
    "stamp, lag",
    [
        ("2024-07-04 06:00:57.900", 3000),
        ("2024-07-04 06:01:10", -10000),
        ("yesterday", None),
    ],
)
def test_lag_counts_whole_seconds(messages, stamp, lag):
    clock = F.lit("2024-07-04 06:01:00.500").cast("timestamp")
    assert enriched(messages, event(event_timestamp=stamp), clock=clock).first().processing_lag_ms == lag


def test_alert_threshold_is_inclusive(messages):
    rows = enriched(
        messages,
        purchase(event_id="low", cart_value=499.99),
        purchase(event_id="equal", cart_value=500.0),
        purchase(event_id="high", cart_value=777.5),
        purchase(event_id="none", cart_value=None),
        add_to_cart(event_id="cart", cart_value=900.0),
    )
    alerts = {r.event_id: r for r in high_value_purchases(rows).collect()}
    assert set(alerts) == {"equal", "high"}
    assert alerts["high"].alert_text == (
        "HIGH-VALUE PURCHASE ALERT | order_id=ORD-9001 user_id=U-marta"
        " amount=777.50 payment=paypal"
    )


def test_page_urls(messages):
    rows = enriched(
        messages,
        event(),
        event(event_type="search", search_query="gaming chair"),
        event(event_type="user_login"),
        event(event_type="page_view"),
        purchase(),
    ).withColumns({"url": page_url(), "cat": category_url(F.lit("Home & Kitchen"))})
    got = {r.event_type: r.url for r in rows.collect()}
    assert got == {
        "product_view": "/product/PROD-00077",
        "search": "/search?q=gaming+chair",
        "user_login": "/account",
        "page_view": "/",
        "checkout_complete": "/order-confirmation",
    }
    assert rows.first().cat == "/category/home-&-kitchen"
