"""Event and envelope types, and the value domains of the event stream."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values of the wire format -----------------------------------------

EVENT_FIELD_TYPES = {
    "event_id": "string",
    "event_type": "string",
    "event_timestamp": "string",
    "user_id": "string",
    "session_id": "string",
    "device_type": "string",
    "browser": "string",
    "ip_address": "string",
    "referrer": "string",
    "page_url": "string",
    "product_id": "string",
    "product_name": "string",
    "category": "string",
    "price": "double",
    "quantity": "integer",
    "search_query": "string",
    "cart_value": "double",
    "order_id": "string",
    "payment_method": "string",
    "is_authenticated": "boolean",
}

# Declared not null. ``from_json`` ignores that, so the routing rules enforce it.
REQUIRED_FIELDS = ("event_id", "event_type", "event_timestamp", "user_id", "session_id")

ENVELOPE_FIELD_TYPES = {
    "key": "binary",
    "value": "binary",
    "topic": "string",
    "partition": "integer",
    "offset": "long",
    "timestamp": "timestamp",
    "timestampType": "integer",
}

EVENT_TYPES = (
    "page_view",
    "product_view",
    "search",
    "add_to_cart",
    "remove_from_cart",
    "wishlist_add",
    "checkout_start",
    "checkout_complete",
    "user_login",
    "user_logout",
)

# Expected percentage of each event type, in the order above.
EVENT_WEIGHTS = (30, 25, 15, 12, 3, 4, 5, 3, 2, 1)

FUNNEL_STAGES = {
    "awareness": ("page_view", "search"),
    "consideration": ("product_view", "wishlist_add"),
    "intent": ("add_to_cart", "remove_from_cart"),
    "purchase": ("checkout_start", "checkout_complete"),
}
OTHER_STAGE = "other"

CATEGORIES = (
    "Electronics",
    "Clothing",
    "Home & Kitchen",
    "Books",
    "Sports & Outdoors",
    "Beauty",
    "Toys",
    "Automotive",
    "Health",
    "Garden",
)

DEVICE_TYPES = ("desktop", "mobile", "tablet")

PAYMENT_METHODS = ("credit_card", "paypal", "apple_pay", "google_pay", "debit_card")

USER_PREFIX = "U-"
SESSION_PREFIX = "S-"
ORDER_PREFIX = "ORD-"
MESSAGE_SCHEMA_VERSION = "1.0"

# printf format of an alert: order id, user id, amount, payment method.
ALERT_FORMAT = "HIGH-VALUE PURCHASE ALERT | order_id=%s user_id=%s amount=%.2f payment=%s"

# --- Derived -----------------------------------------------------------------


def _struct(types: dict[str, str], required: tuple[str, ...] = ()) -> T.StructType:
    # Built without a session: Python workers import this module too.
    schema = T.StructType()
    for name, kind in types.items():
        schema.add(name, kind, nullable=name not in required)
    return schema


EVENT_FIELDS = tuple(EVENT_FIELD_TYPES)
EVENT_SCHEMA = _struct(EVENT_FIELD_TYPES, REQUIRED_FIELDS)
ENVELOPE_SCHEMA = _struct(ENVELOPE_FIELD_TYPES)
