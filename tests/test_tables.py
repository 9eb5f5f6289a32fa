from datetime import date

import pytest
from pyspark.sql import functions as F

from clickloom.operators import catalog, dedup, serialize
from clickloom.operators.bounds import fits_broadcast
from clickloom.operators.quality import quality_report
from clickloom.schema import EVENT_SCHEMA
from clickloom.sources.tables import read_table, write_table
from clickloom.workspace import fresh_dir


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


# --- Duplicates and upsert ---------------------------------------------------------


def test_dedup_keeps_the_first_of_a_hot_key(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.col("id").alias("kafka_offset"),
    )
    got = dedup.dedup_batch(rows, order=["kafka_offset"])
    assert got.count() == 2001
    assert got.filter("event_id = 'hot'").first().kafka_offset == 0
    # Each task drops copies before the shuffle.
    assert "Partial" in plan(got) and "WindowGroupLimit" in plan(got)
    assert dedup.dedup_batch(rows).count() == 2001


def test_upsert_takes_the_newest(spark):
    schema = "event_id string, version int, label string"
    target = spark.createDataFrame([("a", 1, "old"), ("b", 5, "old"), ("c", 2, "old")], schema)
    updates = spark.createDataFrame(
        [("a", 2, "new"), ("a", 3, "newest"), ("b", 4, "stale"), ("c", 2, "same"), ("d", 1, "added")],
        schema,
    )
    got = {r.event_id: r.label for r in dedup.upsert(target, updates, ["event_id"], "version").collect()}
    assert got == {"a": "newest", "b": "old", "c": "same", "d": "added"}


def test_upsert_adds_columns(spark):
    target = spark.createDataFrame([("a", 1)], "event_id string, version int")
    updates = spark.createDataFrame([("b", 1, "x")], "event_id string, version int, extra string")
    got = {r.event_id: r.extra for r in dedup.upsert(target, updates, ["event_id"], "version").collect()}
    assert got == {"a": None, "b": "x"}


def test_upsert_table_touches_only_its_partitions(spark):
    path = f"{fresh_dir(spark, 'upsert')}/t"
    schema = "event_id string, kafka_offset long, label string, event_date date"
    days = [date(2024, 1, d) for d in (1, 2, 3, 4)]
    stored = [(f"e{d.day}-{i}", 1, "old", d) for d in days for i in range(5)]
    write_table(spark.createDataFrame(stored, schema), path)
    before = files_by_date(spark, path)
    updates = spark.createDataFrame(
        [("e1-0", 2, "new", days[0]), ("e3-9", 1, "added", days[2])], schema
    )
    for _ in range(2):
        dedup.upsert_table(spark, path, updates)
    after = files_by_date(spark, path)
    assert before[days[1]] == after[days[1]] and before[days[3]] == after[days[3]]
    got = {r.event_id: r.label for r in read_table(spark, path).collect()}
    assert len(got) == 21 and got["e1-0"] == "new" and got["e3-9"] == "added"
    dedup.upsert_table(spark, path, updates.limit(0))
    assert read_table(spark, path).count() == 21


def files_by_date(spark, path):
    rows = spark.read.parquet(path).select("event_date", F.input_file_name().alias("f")).distinct()
    out = {}
    for r in rows.collect():
        out.setdefault(r.event_date, set()).add(r.f)
    return out


def test_read_prunes_partitions_and_columns(spark):
    path = f"{fresh_dir(spark, 'prune')}/t"
    frame = spark.range(100).select(
        F.col("id").alias("a"),
        F.col("id").alias("b"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % 5).cast("int")).alias("event_date"),
    )
    write_table(frame, path)
    one = read_table(spark, path, first_date="2024-01-02", last_date=date(2024, 1, 2)).select("a")
    assert one.count() == 20
    text = plan(one)
    assert "2024-01-02" in text.split("PartitionFilters")[1]
    assert "ReadSchema: struct<a:bigint>" in text


# --- Lookup ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def clicks(spark):
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40)
    return spark.range(3000).select(
        F.concat(F.lit("e"), F.col("id")).alias("event_id"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("P"), hot)).alias("product_id"),
    )


@pytest.fixture(scope="module")
def products(spark):
    n = F.col("id")
    return spark.range(30).select(
        F.concat(F.lit("P"), n).alias("product_id"),
        F.concat(F.lit("Product "), n).alias("product_name"),
        F.lit("Books").alias("category"),
        (n + 0.5).alias("price"),
    )


def test_lookup_plans_agree(clicks, products):
    small = catalog.lookup(clicks, products)
    large = catalog.lookup(clicks, products, max_rows=10)
    assert small.columns == large.columns
    assert sorted(small.collect()) == sorted(large.collect())
    assert small.count() == 3000
    assert small.filter("catalog_name is null").count() == sum(
        1 for i in range(3000) if i % 5 == 0 or (i % 3 and i % 40 >= 30)
    )
    assert "SortMergeJoin" in plan(large)


def test_lookup_keeps_each_event_once(clicks, products):
    doubled = products.unionByName(products.withColumn("product_name", F.lit("Zzz")))
    for bound in (10, 1000):
        found = catalog.lookup(clicks, doubled, max_rows=bound)
        assert found.count() == 3000
        assert found.filter("catalog_name = 'Zzz'").count() == 0


def test_broadcast_bound(products):
    assert fits_broadcast(products)
    assert not fits_broadcast(products, max_rows=29)
    assert not fits_broadcast(products, max_bytes=100)
    assert fits_broadcast(products.limit(0))


# --- Messages ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def wire(spark):
    def row(**v):
        return tuple(v.get(f.name) for f in EVENT_SCHEMA)

    required = dict(event_timestamp="2024-01-15T14:30:00.123456+00:00", session_id="S-1", page_url="/")
    good = dict(required, user_id="U-1", device_type="mobile")
    rows = [
        row(**good, event_id="3f4a2b1c-0000-4000-8000-000000000001", event_type="page_view"),
        row(
            **good,
            event_id="3f4a2b1c-0000-4000-8000-000000000002",
            event_type="product_view",
            product_id="P1",
            price=2.5,
            category="Books",
        ),
        row(
            **good,
            event_id="3f4a2b1c-0000-4000-8000-000000000003",
            event_type="product_view",
            product_id="P999",
            price=-1.0,
            category="Books",
        ),
        row(**good, event_id="x", event_type="search", search_query="a \"quoted\" :null, text"),
        row(**good, event_id="x", event_type="add_to_cart", product_id="P1", quantity=9, cart_value=-1.0),
        row(
            **dict(required, user_id="", device_type="fridge", event_timestamp="soon"),
            event_id="3f4a2b1c-0000-4000-8000-000000000004",
            event_type="checkout_complete",
            order_id="ORD-1",
            payment_method="cash",
        ),
        row(**dict(good, page_url=None), event_id="", event_type="teleport"),
    ]
    return spark.createDataFrame(rows, EVENT_SCHEMA.__class__([f.__class__(f.name, f.dataType) for f in EVENT_SCHEMA]))


def test_json_leaves_out_nulls(wire):
    back = serialize.round_trip(wire)
    assert back.filter("NOT parsed_back.event_id <=> event_id").count() == 0
    first = back.filter("event_type = 'page_view'").first()
    assert "null" not in first.event_json and "product_id" not in first.event_json


def test_kafka_rows(wire):
    row = serialize.kafka_rows(wire, "run-1").filter("cast(value as string) like '%page_view%'").first()
    assert bytes(row.key) == b"U-1"
    assert {h.key: bytes(h.value).decode() for h in row.headers} == {
        "event_type": "page_view",
        "producer_run_id": "run-1",
        "schema_version": "1.0",
    }


def test_by_user_splits_a_hot_user(spark):
    n = F.col("id")
    events = spark.range(6000).select(
        F.when(n % 3 == 0, "U-hot").otherwise(F.concat(F.lit("U-"), n)).alias("user_id"),
        F.timestamp_seconds(n).alias("event_ts"),
    )
    laid = serialize.by_user(events, 6).withColumn("p", F.spark_partition_id())
    sizes = [r["count"] for r in laid.groupBy("p").count().collect()]
    assert sum(sizes) == 6000 and max(sizes) < 2000


def test_quality_report(spark, wire, products):
    got = {r.rule: (r.checked, r.failed) for r in quality_report(wire, products, max_users=1).collect()}
    assert got == {
        "required_fields": (7, 2),
        "event_id_uuid": (7, 3),
        "timestamp_iso8601": (7, 1),
        "event_type_domain": (7, 1),
        "device_type_domain": (7, 1),
        "user_id_prefix": (7, 1),
        "session_id_prefix": (7, 0),
        "product_view_product": (2, 1),
        "add_to_cart_quantity": (1, 1),
        "checkout_complete_order": (1, 1),
        "search_query_set": (1, 0),
        "page_url_set": (7, 1),
        "price_positive": (2, 1),
        "cart_value_not_negative": (1, 1),
        "json_round_trip": (7, 0),
        "json_without_nulls": (7, 0),
        "event_types_present": (10, 5),
        "users_within_bound": (2, 1),
        "event_ids_unique": (6, 1),
    }
