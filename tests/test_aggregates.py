import json
import math

from datetime import datetime, timedelta

import pytest
from conftest import event, purchase
from pyspark.sql import functions as F

from clickloom.operators import silver, totals
from clickloom.operators.enrich import enrich
from clickloom.operators.routing import parse_and_validate


def enriched(messages, *payloads):
    return enrich(parse_and_validate(messages(*payloads))[0])


@pytest.fixture(scope="module")
def skewed(spark):
    """Enriched events; a third of them in one cell, by one user of one session."""
    n = F.col("id")
    hot = n % 3 == 0
    start = F.lit("2024-03-01 23:50:00").cast("timestamp")
    return spark.range(6000).select(
        F.concat(F.lit("e"), n).alias("event_id"),
        F.when(hot, "checkout_complete").otherwise("page_view").alias("event_type"),
        F.timestamp_micros(
            F.unix_micros(start) + F.when(hot, F.lit(1)).otherwise(n * 250_000)
        ).alias("event_ts"),
        F.when(hot, "U-hot").otherwise(F.concat(F.lit("U-"), n % 50)).alias("user_id"),
        F.when(hot, "S-hot").otherwise(F.concat(F.lit("S-"), n % 70)).alias("session_id"),
        F.when(n % 5 > 0, F.concat(F.lit("P-"), n % 11)).alias("product_id"),
        F.when(n % 4 > 0, "mobile").alias("device_type"),
        F.when(n % 7 > 0, n % 1000 / 100).alias("cart_value"),
        (n % 2 == 0).alias("is_authenticated"),
        F.timestamp_micros(F.unix_micros(start) + n * 300_000).alias("_ingested_at"),
    ).transform(enrich)


def brute_force(rows, width, step):
    cells = {}
    epoch = datetime(1970, 1, 1)
    for r in rows:
        first = r.ts - (r.ts - epoch) % step
        start = first
        while start > r.ts - width:
            key = (start, r.event_type, r.event_date, r.device_type, r.funnel_stage)
            cells.setdefault(key, []).append(r)
            start -= step
    out = {}
    for key, members in cells.items():
        revenue = [round(m.revenue * 100) for m in members if m.revenue is not None]
        lags = [m.processing_lag_ms for m in members]
        out[key] = (
            len(members),
            len({m.user_id for m in members}),
            len({m.session_id for m in members}),
            sum(revenue) / 100 if revenue else None,
            pytest.approx(sum(revenue) / 100 / len(revenue)) if revenue else None,
            sum(m.is_purchase for m in members),
            sum(m.is_add_to_cart for m in members),
            pytest.approx(sum(lags) / len(lags)),
            max(lags),
            len({m.product_id for m in members if m.product_id}),
            sum(m.is_authenticated for m in members),
        )
    return out


def published(cells):
    plain = cells.withColumn("start", F.col("window_start").cast("timestamp_ntz"))
    return {
        (r.start, r.event_type, r.event_date, r.device_type, r.funnel_stage): (
            r.event_count,
            r.unique_users,
            r.unique_sessions,
            r.total_revenue,
            r.avg_revenue,
            r.purchase_count,
            r.add_to_cart_count,
            r.avg_processing_lag_ms,
            r.max_processing_lag_ms,
            r.unique_products_viewed,
            r.authenticated_events,
        )
        for r in plain.collect()
    }


def test_tumbling_cells(skewed):
    rows = skewed.withColumn("ts", F.col("event_ts").cast("timestamp_ntz")).collect()
    minute = timedelta(minutes=1)
    assert published(silver.batch_cells(skewed)) == brute_force(rows, minute, minute)


def test_approximate_cells(skewed):
    keys = ["window_start", "event_type", "event_date", "device_type", "funnel_stage"]
    exact = silver.batch_cells(skewed)
    close = silver.batch_cells(skewed, error=0.01)
    same = [c for c in exact.columns if c not in silver.DISTINCT_COUNTS]
    assert sorted(exact.select(same).collect(), key=str) == sorted(close.select(same).collect(), key=str)
    match = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    both = exact.alias("a").join(close.alias("b"), match)
    far = F.abs(F.col("a.unique_users") - F.col("b.unique_users")) > 1
    assert both.count() == exact.count() and both.filter(far).count() == 0


@pytest.mark.parametrize("width, step", [(5, 1), (4, 2), (3, 3)])
def test_sliding_cells(skewed, width, step):
    rows = skewed.withColumn("ts", F.col("event_ts").cast("timestamp_ntz")).collect()
    expected = brute_force(rows, timedelta(minutes=width), timedelta(minutes=step))
    got = silver.sliding_cells(skewed, f"{width} minutes", f"{step} minutes")
    assert published(got) == expected


def test_null_event_time_leaves_the_cells(messages):
    rows = enriched(messages, event(event_timestamp="never"), event())
    assert silver.batch_cells(rows).agg(F.sum("event_count")).first()[0] == 1


def test_odd_amounts_do_not_break_a_total(messages):
    def total(*amounts):
        rows = [json.dumps(purchase(cart_value=a)) for a in amounts]
        return totals.grand_total(enriched(messages, *rows)).first().total_revenue

    assert total(169.0, 1e300) == 1e300
    assert total(9.3e14, 5.0) == 9.3e14 + 5
    assert total(9e14, 9e14, 9e14) == 2.7e15
    assert total(0.00001, 0.00001) == 0.00002
    assert math.isnan(total(1.0, float("nan")))
    cells = silver.batch_cells(enriched(messages, *[purchase(cart_value=9e14)] * 3)).first()
    assert (cells.total_revenue, cells.avg_revenue) == (2.7e15, 9e14)


def test_any_sliding_width_equals_spark_windows(messages):
    stamps = [f"2024-02-29 10:{m:02d}:{s:02d}" for m in range(0, 30, 3) for s in (0, 30)]
    rows = enriched(
        messages,
        *[event(event_id=f"e{i}", event_timestamp=t, user_id=f"U-{i % 4}") for i, t in enumerate(stamps)],
    )
    for width, step in (("5 minutes", "2 minutes"), ("7 minutes", "3 minutes"), ("6 minutes", "6 minutes")):
        want = rows.groupBy(F.window("event_ts", width, step).alias("w")).agg(
            F.count("*").alias("n"), F.countDistinct("user_id").alias("u")
        )
        got = silver.sliding_cells(rows, width, step)
        columns = ["window_start", "event_count", "unique_users"]
        assert sorted(map(tuple, got.select(columns).collect())) == sorted(
            map(tuple, want.select("w.start", "n", "u").collect())
        )


def test_totals(messages):
    payloads = [purchase(event_id=f"p-{i}") for i in range(3)]
    payloads += [event(event_id=f"v-{i}", user_id=f"U-{i}") for i in range(7)]
    rows = enriched(messages, *payloads)
    total = totals.grand_total(rows).first()
    assert (total.grain, total.total_events, total.purchase_count) == ("all", 10, 3)
    assert total.total_revenue == pytest.approx(3 * 169.0)
    by_type = {r.event_type: r for r in totals.totals_by_type_and_date(rows).collect()}
    assert (by_type["product_view"].event_count, by_type["product_view"].unique_users) == (7, 7)
    assert by_type["checkout_complete"].purchase_count == 3
    share = {r.event_type: r for r in totals.event_type_share(rows).collect()}
    assert (share["product_view"].share, share["product_view"].expected_share) == (0.7, 0.25)
    assert totals.top_event_type(rows).first().event_type == "product_view"


def test_sessions_per_user(skewed):
    got = {r.user_id: r.session_count for r in totals.sessions_per_user(skewed).collect()}
    want = {}
    for r in skewed.select("user_id", "session_id").collect():
        want.setdefault(r.user_id, set()).add(r.session_id)
    assert got == {u: len(s) for u, s in want.items()}
