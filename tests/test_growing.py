"""Roll-ups, frequent values, growing reports, buckets and state read back."""

import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from clickloom.operators import frequent, quality_growing, rollups, silver, totals
from clickloom.operators.quality import quality_report
from clickloom.plans import clickstream, fixture
from clickloom.plans.clickstream import MAX_USERS, PART_TYPES
from clickloom.session import prepare
from clickloom.sources.tables import read_table, write_bucketed, write_table
from clickloom.workspace import fresh_dir, shared_dir

SMALL = "/root/testdata/sf0.001"
START = datetime(2024, 3, 1, tzinfo=timezone.utc)

CELL_EVENTS = """event_ts timestamp, event_type string, event_date date, device_type string,
    funnel_stage string, user_id string, session_id string, product_id string, revenue double,
    is_purchase boolean, is_add_to_cart boolean, is_authenticated boolean, processing_lag_ms long"""


def cell_events(spark, count, users):
    rng = random.Random(users)
    rows = []
    for _ in range(count):
        ts = START + timedelta(seconds=rng.randrange(3 * 86_400))
        user = rng.choice([None, *(f"u{i}" for i in range(users))])
        rows.append(
            (rng.choice([ts, ts, ts, None]), rng.choice("ab"), ts.date(), "d", "f", user, f"s{rng.randrange(users)}",
             None, rng.choice([None, 0.1, 1e16, 3.33]), True, False, rng.choice([None, True]),
             rng.choice([None, 5, -7]))
        )
    return spark.createDataFrame(rows, CELL_EVENTS).repartition(5)


@pytest.mark.parametrize("widths", [("1 hour",), ("1 hour", "1 day"), ("15 minutes", "6 hours", "1 day")])
def test_rollups_equal_cells_of_events(spark, widths):
    events = cell_events(spark, 3000, 300)
    cells = rollups.sketched_cells(events, "1 minute")
    for width in widths:
        cells = rollups.merged_cells(cells, width)
    got = rollups.estimated_cells(cells)
    want = silver.batch_cells(events, widths[-1])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert rollups.merged_cells(rollups.sketched_cells(events.limit(0))).count() == 0


def test_rollup_error_beyond_the_nominal_entries(spark):
    events = cell_events(spark, 20_000, 3000)
    cells = rollups.merged_cells(rollups.sketched_cells(events, "1 hour", 7), "1 day", 7)
    exact = silver.batch_cells(events, "1 day").select("event_type", "event_date", F.col("unique_users").alias("n"))
    both = rollups.estimated_cells(cells).join(exact, ["event_type", "event_date"])
    errors = [abs(r.unique_users - r.n) / r.n for r in both.collect()]
    assert 0 < max(errors) < 4 / 2**3.5  # four standard errors of 128 entries


def test_cube_is_one_scan(spark):
    events = cell_events(spark, 500, 20)
    cube = rollups.event_cube(events)
    plan = cube._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and "Expand" in plan
    by_type = {r.event_type: r.event_count for r in cube.filter("grouping = 3").collect()}
    assert by_type == {r.event_type: r["count"] for r in events.groupBy("event_type").count().collect()}
    assert cube.filter("grouping = 7").first().event_count == 500


@pytest.mark.parametrize("counters", [3, 30, 5000])
@pytest.mark.parametrize("kind", ["skewed", "even", "few"])
def test_most_frequent_equals_counting(spark, counters, kind):
    rng = random.Random(counters)
    names = {
        "skewed": [f"v{int(rng.paretovariate(0.7))}" for _ in range(6000)],
        "even": [f"v{i % 2000}" for i in range(6000)],
        "few": ["a", "b", None, "a"] * 10,
    }[kind]
    frame = spark.createDataFrame([(n,) for n in names], "name string").repartition(6)
    counts = Counter(n for n in names if n is not None)
    want = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:10]
    got = frequent.most_frequent(frame, "name", 10, counters).orderBy("rank").collect()
    assert [(r.value, r.n) for r in got] == want
    assert [r["rank"] for r in got] == list(range(1, len(want) + 1))


def test_summaries_are_bounded_and_bound_the_counts(spark):
    rng = random.Random(1)
    names = [f"v{int(rng.paretovariate(0.8))}" for _ in range(8000)]
    frame = spark.createDataFrame([(n,) for n in names], "name string").repartition(4)
    held = frequent.summaries(frame, "name", 50).collect()
    assert len(held) <= 4 * 51
    low, off = Counter(), sum(r.off for r in held)
    for r in held:
        low[r.value] += r.n
    assert all(low[v] <= n <= low[v] + off for v, n in Counter(names).items())
    assert frequent.most_frequent(frame.limit(0), "name").count() == 0


def test_growing_report_reads_new_dates_only(spark):
    prepare(spark)
    events, products = clickstream._quality_input(spark, SMALL)
    dates = sorted(r[0] for r in events.select("event_date").distinct().collect())
    folder = fresh_dir(spark, "growing")
    table, summary = f"{folder}/events", f"{folder}/summary"

    def summarise(**more):
        return quality_growing.summarise_new_dates(spark, table, summary, products, PART_TYPES, **more)

    write_table(events.filter(F.col("event_date").isin(dates[:3])), table)
    summarise()
    undated = events.filter(F.col("event_date") == dates[5]).withColumn("event_date", F.lit(None).cast("date"))
    write_table(events.filter(F.col("event_date").isin(dates[3:5])).unionByName(undated), table)
    read = summarise()
    assert {r[0] for r in read.select("event_date").distinct().collect()} == {*dates[3:5], None}
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and str(dates[3]) in plan and str(dates[0]) not in plan
    assert summarise() is None

    def same():
        whole = quality_report(read_table(spark, table), products, MAX_USERS, PART_TYPES)
        merged = quality_growing.report_of_summaries(spark, summary, MAX_USERS, PART_TYPES)
        assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))

    same()
    # A date that grows after it was summarised, and one whose summary broke off.
    write_table(events.filter(F.col("event_date") == dates[0]).limit(20), table)
    summarise(again=[dates[0]])
    same()


def test_buckets_spare_the_shuffle(spark):
    events = fixture.clicks(fixture.events_table(spark, SMALL))
    path = f"{fresh_dir(spark, 'buckets')}/bronze"
    table = write_bucketed(events, "bucketed_events", path, 4)
    counted = totals.sessions_per_user(table)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    want = totals.sessions_per_user(events).collect()
    assert sorted(counted.collect()) == sorted(want)


def test_shared_folder_is_asked_for_on_a_cluster(spark):
    class Cluster:
        conf = type("Conf", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(RuntimeError):
        shared_dir(Cluster)
    assert shared_dir(spark)


def test_grand_total_of_nothing(spark):
    empty = cell_events(spark, 3, 2).limit(0)
    row = totals.grand_total(empty).collect()
    assert [tuple(r) for r in row] == [("all", 0, 0, None)]
