import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from clickloom.operators.running import RANGES, running_sums
from clickloom.operators.sessions import batch_sessions
from clickloom.operators.state import cart_state, login_state
from clickloom.schema import EVENT_TYPES

SCHEMA = """event_id string, event_type string, event_ts timestamp, user_id string,
    session_id string, price double, quantity int, cart_value double, is_purchase boolean,
    revenue double"""

START = datetime(2024, 5, 1, tzinfo=timezone.utc)


def make_events(spark, count, seed, span_minutes, users=6):
    """Random events; a third of them belong to one user and one session."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        hot = rng.random() < 1 / 3
        user = "U-hot" if hot else f"U-{rng.randrange(users)}"
        session = "S-hot" if hot else f"S-{user}-{rng.randrange(3)}"
        kind = rng.choice(EVENT_TYPES)
        ts = START + timedelta(minutes=rng.randrange(span_minutes), seconds=rng.choice((0, 0, 30)))
        price = None if rng.random() < 0.1 else round(rng.uniform(1, 99), 2)
        quantity = None if rng.random() < 0.1 else rng.randint(1, 5)
        cart = round(rng.uniform(1, 900), 2)
        bought = kind == "checkout_complete"
        rows.append(
            (f"e{i:06d}", kind, ts, user, session, price, quantity, cart, bought, cart if bought else 0.0)
        )
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(7)


def in_order(rows, key):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        groups.setdefault(r[key], []).append(r)
    return groups


def cents(x):
    return round(x * 100)


@pytest.fixture
def ranges(spark):
    """Sets the number of ranges for a test."""
    before = spark.conf.get(RANGES)
    yield lambda n: spark.conf.set(RANGES, n)
    spark.conf.set(RANGES, before)


@pytest.mark.parametrize("n_ranges", [1, 3, 8, 40])
def test_cart_state(spark, ranges, n_ranges):
    ranges(n_ranges)
    rows, events = make_events(spark, 1500, 3, 4000)
    want = {}
    for members in in_order(rows, 4).values():
        cart = 0
        for r in members:
            kind, price, quantity = r[1], r[5], r[6]
            if kind == "add_to_cart" and price is not None and quantity is not None:
                cart += cents(price * quantity)
            shown = None
            if kind in ("add_to_cart", "checkout_start", "checkout_complete"):
                shown = cart
            elif kind == "remove_from_cart":
                shown = max(0, cart - cents(price or 0))
            want[r[0]] = None if shown is None else shown / 100
            if kind == "checkout_complete":
                cart = 0
    got = cart_state(events)
    assert got.columns == [*events.columns, "running_cart"]
    assert {r.event_id: r.running_cart for r in got.collect()} == want


@pytest.mark.parametrize("n_ranges", [1, 3, 8, 40])
def test_login_state(spark, ranges, n_ranges):
    ranges(n_ranges)
    rows, events = make_events(spark, 1500, 4, 4000)
    want = {}
    for members in in_order(rows, 3).values():
        state = False
        for r in members:
            state = {"user_login": True, "user_logout": False}.get(r[1], state)
            want[r[0]] = state
    assert {r.event_id: r.logged_in for r in login_state(events).collect()} == want


@pytest.mark.parametrize("mode", ["burst", "no times"])
def test_no_range_holds_twice_its_share(spark, ranges, mode):
    """One session, all within one second or without any time."""
    ranges(10)
    at = {"burst": "timestamp'2024-05-01 10:00:00Z' + make_dt_interval(0, 0, 0, (id % 7) / 10)",
          "no times": "cast(null AS timestamp)"}[mode]
    rows = spark.range(20_000, numPartitions=6).selectExpr(
        "'S' AS session_id", f"{at} AS event_ts", "concat('e', lpad(id, 6, '0')) AS event_id"
    )
    scanned = running_sums(
        rows, "session_id", ("event_ts", "event_id"), {"nth": F.lit(1)}, F.lit(0)
    ).withColumn("task", F.spark_partition_id())
    sizes = [r["count"] for r in scanned.groupBy("task").count().collect()]
    assert len(sizes) == 10 and max(sizes) <= 2 * 20_000 / 10
    window = "row_number() over (order by event_ts, event_id)"
    assert scanned.selectExpr("nth", f"{window} AS want").filter("nth <> want").isEmpty()


def test_running_sums_against_python(spark, ranges):
    ranges(16)
    rng = random.Random(12)
    keys = [None, "", "a", "b", *"cdefgh"] + ["hot"] * 8
    rows = [
        (rng.choice(keys), rng.choice([None, *range(5)]), i, rng.choice([None, 1, -3, 10**15]),
         rng.choices([0, 1, 2], [12, 1, 1])[0])
        for i in range(1500)
    ]
    frame = spark.createDataFrame(rows, "key string, at int, id int, x long, reset int").repartition(5)
    got = running_sums(frame, "key", ("at", "id"), {"s": F.col("x"), "n": F.lit(1)}, F.col("reset"))
    state, want = {}, {}
    for key, at, i, x, reset in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        s, n = (0, 0) if reset == 1 else state.get(key, (0, 0))
        want[i] = s, n = s + (x or 0), n + 1
        state[key] = (0, 0) if reset == 2 else (s, n)
    assert {r["id"]: (r["s"], r["n"]) for r in got.collect()} == want
    assert got.filter("false").count() == 0 and got.columns == [*frame.columns, "s", "n"]
    empty = running_sums(frame.limit(0), "key", ("at", "id"), {"n": F.lit(1)}, F.lit(0))
    assert empty.count() == 0


def test_state_runs_nothing_while_built_and_reads_once(spark):
    _, events = make_events(spark, 400, 3, 600)
    spark.sparkContext.setJobGroup("build", "building")
    carts = cart_state(events)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    carts.collect()
    plan = carts._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    dealt = [line for line in final.splitlines() if "rangepartitioning" in line]
    assert sorted("ReusedExchange" in line for line in dealt) == [False, True]
    assert final.count("Scan ExistingRDD") == 1


def test_state_refuses_columns_it_uses(spark):
    _, events = make_events(spark, 5, 3, 600)
    with pytest.raises(ValueError):
        cart_state(events.withColumn("_range", F.lit(1)))


def test_state_keeps_events_without_time(spark):
    _, events = make_events(spark, 200, 5, 60)
    holes = events.withColumn("event_ts", F.when(F.col("event_id") > "e000050", F.col("event_ts")))
    assert cart_state(holes).count() == login_state(holes).count() == 200


@pytest.mark.parametrize("gap", [1, 5, 30])
@pytest.mark.parametrize("seed", [1, 2])
def test_batch_sessions(spark, gap, seed):
    rows, events = make_events(spark, 900, seed, 3000)
    silence = timedelta(minutes=gap)
    want = set()
    for user, members in in_order(rows, 3).items():
        runs = []
        for r in members:
            # An event exactly one gap later still belongs to the session.
            if runs and r[2] - runs[-1][-1][2] <= silence:
                runs[-1].append(r)
            else:
                runs.append([r])
        for run in runs:
            want.add(
                (
                    user,
                    run[0][2].replace(tzinfo=None),
                    (run[-1][2] + silence).replace(tzinfo=None),
                    len(run),
                    sum(r[8] for r in run),
                    sum(cents(r[9]) for r in run) / 100,
                )
            )
    got = batch_sessions(events, f"{gap} minutes")
    plain = got.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")}
    )
    assert {tuple(r) for r in plain.collect()} == want


def test_batch_sessions_equal_session_window(spark):
    _, events = make_events(spark, 900, 9, 3000)
    built_in = events.groupBy(F.session_window("event_ts", "7 minutes").alias("w"), "user_id").agg(
        F.count("*").alias("n")
    )
    want = {(r.user_id, r.w.start, r.w.end, r.n) for r in built_in.collect()}
    got = batch_sessions(events, "7 minutes").collect()
    assert {(r.user_id, r.session_start, r.session_end, r.event_count) for r in got} == want
