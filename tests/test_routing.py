import json
from datetime import datetime

import pytest
from conftest import event, purchase
from pyspark.sql import functions as F

from clickloom.operators import routing
from clickloom.schema import EVENT_FIELDS, EVENT_TYPES


def routes(frame):
    rows = routing.with_route(routing.parse_messages(frame)).orderBy("kafka_offset").collect()
    return [(r.route, r.reject_reason) for r in rows]


def only_valid(frame):
    return routing.valid_events(routing.parse_messages(frame)).first()


def text(**changes):
    return json.dumps(event(**changes))


@pytest.mark.parametrize(
    "payload",
    [
        None,
        "",
        "not valid json {{{{",
        text()[:-20],
        json.dumps([event(), event()]),
        event(event_id=None),
        '{"event_id": null}',
        "{}",
    ],
)
def test_corrupt(messages, payload):
    assert routes(messages(payload)) == [("corrupt", None)]


@pytest.mark.parametrize(
    "payload, reason",
    [
        (event(event_type="unknown_action"), "event_type"),
        (event(event_type=None), "event_type"),
        (event(user_id=None), "user_id"),
        (event(session_id=None), "session_id"),
        (event(user_id=None, session_id=None), "user_id"),
    ],
)
def test_rejected(messages, payload, reason):
    assert routes(messages(payload)) == [("rejected", reason)]


@pytest.mark.parametrize(
    "payload, field, value",
    [
        (event(price="x"), "price", None),
        (event(quantity=2.5), "quantity", None),
        (event(is_authenticated="true"), "is_authenticated", None),
        (event(event_id=17), "event_id", "17"),
        (event(event_id=""), "event_id", ""),
        (text() + " trailing", "event_id", "e-77"),
        (event(extra="ignored"), "event_id", "e-77"),
        (text().replace("84.5", "NaN"), "price", float("nan")),
    ],
)
def test_valid_with_odd_fields(messages, payload, field, value):
    got = only_valid(messages(payload))[field]
    assert got == value or (got != got and value != value)


def test_every_known_type_is_valid(messages):
    frame = messages(*(event(event_id=f"id-{t}", event_type=t) for t in EVENT_TYPES))
    assert routes(frame) == [("valid", None)] * 10


def test_mixed_batch(messages):
    frame = messages(event(), purchase(), "garbage", event(event_type="bad_type"))
    valid, corrupt = routing.parse_and_validate(frame)
    assert (valid.count(), corrupt.count()) == (2, 1)
    parsed = routing.parse_messages(frame)
    assert routing.routing_counts(parsed).first().asDict() == {
        "total": 4,
        "valid": 2,
        "corrupt": 1,
        "rejected": 1,
    }


def test_valid_columns(messages):
    valid, corrupt = routing.parse_and_validate(messages("bad", event()))
    assert valid.columns == [
        *EVENT_FIELDS,
        "event_ts",
        "kafka_timestamp",
        "kafka_partition",
        "kafka_offset",
        "_ingested_at",
    ]
    assert dict(valid.dtypes)["event_ts"] == "timestamp"
    assert (valid.first().kafka_partition, valid.first().kafka_offset) == (0, 1)
    assert corrupt.columns == ["raw_json", "kafka_timestamp", "partition", "offset", "_corrupt_ts"]
    assert (corrupt.first().raw_json, corrupt.first().offset) == ("bad", 0)


@pytest.mark.parametrize(
    "stamp, expected",
    [
        ("2024-02-29 23:05:09", datetime(2024, 2, 29, 23, 5, 9)),
        ("2024-01-15T14:30:00.123456+00:00", datetime(2024, 1, 15, 14, 30, 0, 123456)),
        ("2024-01-15T14:30:00+02:00", datetime(2024, 1, 15, 12, 30)),
        ("2024-01-15T14:30:00Z", datetime(2024, 1, 15, 14, 30)),
        ("yesterday", None),
    ],
)
def test_event_time(messages, stamp, expected):
    frame = messages(event(event_timestamp=stamp))
    valid = routing.valid_events(routing.parse_messages(frame))
    assert valid.select(F.col("event_ts").cast("timestamp_ntz")).first()[0] == expected


def test_clock_column(messages):
    clock = F.lit("2030-01-01").cast("timestamp")
    valid, corrupt = routing.parse_and_validate(messages(event(), "bad"), clock)
    assert valid.first()["_ingested_at"] == corrupt.first()["_corrupt_ts"]


def test_dead_letters_keep_the_bytes(spark, messages):
    raw = messages(event(), b"\xff\xfe\x00broken", event(user_id=None))
    letters = routing.dead_letters(routing.parse_messages(raw))
    sent = {bytes(r.value) for r in raw.filter("offset > 0").collect()}
    assert {bytes(r.value) for r in letters.collect()} == sent
    assert {bytes(r.key) for r in letters.collect()} == {b"key"}


def test_message_is_parsed_once(messages):
    valid, _ = routing.parse_and_validate(messages(event()))
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
