"""Click events, messages and a catalog derived from the test tables.

The column expressions below are plain SQL that Spark and DuckDB both run, so
the checks start from equal rows. Every row of ``events`` becomes one message.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS_SCHEMA = """
    event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
    value DOUBLE, props STRING
"""

TOPIC = "clickstream-events"
WIRE_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

K = "cast(regexp_extract(props, '([0-9]+)', 1) AS int)"

# name -> SQL over ``events`` with ``k`` = the number inside ``props``.
CLICK_COLUMNS = {
    "event_id": "concat('evt-', cast(event_id AS varchar(20)))",
    "event_type": """CASE event_type
        WHEN 'view' THEN CASE WHEN k % 2 = 0 THEN 'page_view' ELSE 'product_view' END
        WHEN 'click' THEN CASE k % 4 WHEN 0 THEN 'search' WHEN 1 THEN 'add_to_cart'
                          WHEN 2 THEN 'remove_from_cart' ELSE 'wishlist_add' END
        WHEN 'purchase' THEN CASE WHEN k % 2 = 0 THEN 'checkout_complete' ELSE 'checkout_start' END
        WHEN 'signup' THEN CASE WHEN k % 2 = 0 THEN 'user_login' ELSE 'user_logout' END
        ELSE 'unknown_action' END""",
    "event_ts": "ts",
    "user_id": "concat('U-', cast(user_id AS varchar(20)))",
    "session_id": """concat('S-', cast(user_id AS varchar(20)), '-',
        cast(cast(ts AS date) AS varchar(10)))""",
    "device_type": "CASE user_id % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END",
    "browser": """CASE k % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Firefox' WHEN 2 THEN 'Safari'
        ELSE 'Edge' END""",
    "ip_address": "'203.0.113.42'",
    "referrer": "CASE WHEN k % 3 = 0 THEN 'google.com' ELSE 'direct' END",
    "page_url": "CASE WHEN event_type = 'click' AND k % 4 = 0 THEN '/search?q=running+shoes' ELSE '/' END",
    "product_id": """CASE WHEN event_type IN ('view', 'click') AND k % 4 <> 0
        THEN concat('PROD-', lpad(cast(k + 1 AS varchar(5)), 5, '0')) END""",
    "price": "CASE WHEN event_type IN ('view', 'click') AND k % 4 <> 0 THEN value END",
    "quantity": "CASE WHEN event_type = 'click' AND k % 4 = 1 THEN 1 + k % 5 END",
    "search_query": "CASE WHEN event_type = 'click' AND k % 4 = 0 THEN 'running shoes' END",
    # A few purchases have amounts beyond, or finer than, any money.
    "cart_value": """CASE WHEN event_type = 'purchase' AND event_id % 61 = 5
            THEN cast('9.3e14' AS double)
        WHEN event_type = 'purchase' AND event_id % 61 = 6 THEN cast('1.0e18' AS double)
        WHEN event_type = 'purchase' AND event_id % 61 = 7 THEN cast('0.00001' AS double)
        WHEN event_type = 'purchase' AND event_id % 997 = 8 THEN cast('NaN' AS double)
        WHEN event_type IN ('click', 'purchase')
        AND (event_type = 'purchase' OR k % 4 IN (1, 2)) THEN value * 2 END""",
    "order_id": """CASE WHEN event_type = 'purchase' AND k % 2 = 0
        THEN concat('ORD-', cast(event_id AS varchar(20))) END""",
    "payment_method": """CASE WHEN event_type = 'purchase' AND k % 2 = 0
        THEN CASE WHEN k % 4 = 0 THEN 'credit_card' ELSE 'paypal' END END""",
    "is_authenticated": "k % 2 = 0",
    "n": "event_id",
    # What is wrong with the message that carries the event; most are sound.
    "fault": """CASE event_id % 50 WHEN 0 THEN 'broken_json' WHEN 1 THEN 'no_event_id'
        WHEN 2 THEN 'no_user_id' WHEN 3 THEN 'no_session_id' END""",
    # Messages delivered twice.
    "resent": "k < 5",
    "k": "k",
}

# The product catalog, over ``part``. Keys longer than five digits stay whole.
CATALOG_COLUMNS = {
    "product_id": """concat('PROD-', lpad(cast(p_partkey AS varchar(20)),
        cast(greatest(5, length(cast(p_partkey AS varchar(20)))) AS int), '0'))""",
    "product_name": "p_name",
    "category": "p_type",
    "price": "p_retailprice",
}

WIRE_FIELDS = tuple(
    name
    for name in CLICK_COLUMNS
    if name not in ("event_ts", "n", "fault", "resent", "k")
)


def select_sql(columns: dict[str, str], source: str) -> str:
    body = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"SELECT {body} FROM {source}"


FLAT_SQL = select_sql(CLICK_COLUMNS, f"(SELECT *, {K} AS k FROM events) e")
CATALOG_SQL = select_sql(CATALOG_COLUMNS, "part")


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a stream: all its files in one micro-batch.

    The file source takes a folder or a pattern; the pattern fits a table stored
    as one file as well as one stored as a folder.
    """
    return spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet*")


def clicks(events: DataFrame) -> DataFrame:
    """Click events in columns."""
    with_k = events.withColumn("k", F.expr(K))
    return with_k.selectExpr(*(f"{sql} AS {name}" for name, sql in CLICK_COLUMNS.items()))


def with_resent(flat: DataFrame) -> DataFrame:
    """Click events with the resent ones a second time."""
    copies = F.when(F.col("resent"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return flat.withColumn("delivery", F.explode(copies))


PARTS = 12
LATE = "n % 10 = 7 AND part < 9"


def in_parts(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Add ``part``: which twelfth of the time the events span an event falls into."""
    low, high = events.agg(F.min(F.unix_micros(_utc())), F.max(F.unix_micros(_utc()))).first()
    part = F.floor((F.unix_micros(_utc()) - low) * PARTS / F.lit(high - low + 1))
    return events.withColumn("part", part.cast("int"))


def _utc() -> Column:
    return F.col("event_ts").cast("timestamp")


ROWS_PER_FILE = 40_000  # a file is read by one task


def ordered_files(
    frame: DataFrame,
    part: Column,
    path: str,
    made: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Write ``frame`` as files in the order of its parts; returns the files of a part.

    One job writes all parts, each into a folder of its own and, if it is large,
    into several files, which a trigger reads in as many tasks. Rows are dealt
    before ``made`` turns them into what is written, so that this runs in the tasks
    that write, however few the table was read in. A file stream takes files by their time, so theirs are set
    in the order of the parts; a trigger of as many files as returned takes one part.
    """
    spark = frame.sparkSession
    parts = frame.withColumn("_part", part).filter("_part is not null")
    most = parts.groupBy("_part").count().agg(F.max("count")).first()[0] or 0
    files = -(-most // ROWS_PER_FILE) or 1
    dealt = parts.withColumn("_file", F.pmod(F.xxhash64(*frame.columns), F.lit(files)))
    dealt = dealt.repartition(files * (PARTS + 3), "_part", "_file")
    (
        (made(dealt) if made else dealt)
        .write.partitionBy("_part", "_file")
        .parquet(path)
    )
    written = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = written.getFileSystem(spark._jsc.hadoopConfiguration())
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    placed = names.select(
        "path", F.regexp_extract("path", "_part=([0-9]+)/", 1).cast("int").alias("part")
    )
    for row in placed.orderBy("part", "path").collect():
        # Some time ago, so that the last ones are no newer than the stream's start.
        stamp = 1_700_000_000_000 + 60_000 * row["part"]
        store.setTimes(spark._jvm.org.apache.hadoop.fs.Path(row["path"]), stamp, -1)
    return files


def doubled_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog with some products a second time, under a later name."""
    products = catalog(spark, sf_dir)
    second = products.filter(F.col("product_id").endswith("7")).withColumn(
        "product_name", F.concat("product_name", F.lit(" (copy)"))
    )
    return products.unionByName(second)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return part.selectExpr(*(f"{sql} AS {name}" for name, sql in CATALOG_COLUMNS.items()))


def event_timestamp() -> Column:
    """Event time as ISO-8601 text."""
    return F.concat(F.date_format("event_ts", WIRE_TIME), F.lit("+00:00"))


def messages(flat: DataFrame, *more: str) -> DataFrame:
    """Each click event as the message that carries it, faults applied.

    ``more`` names columns to keep beside the message.
    """

    def unless(fault: str, value: Column) -> Column:
        return F.when(~F.col("fault").eqNullSafe(fault), value)

    fields = {name: F.col(name) for name in WIRE_FIELDS}
    fields["event_id"] = unless("no_event_id", fields["event_id"])
    fields["user_id"] = unless("no_user_id", fields["user_id"])
    fields["session_id"] = unless("no_session_id", fields["session_id"])
    fields["event_timestamp"] = event_timestamp()
    body = F.to_json(F.struct(*(value.alias(name) for name, value in fields.items())))
    text = F.when(F.col("fault").eqNullSafe("broken_json"), "not json {{").otherwise(body)
    return flat.select(
        F.col("user_id").cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("n") % 6).cast("int").alias("partition"),
        F.col("n").alias("offset"),
        F.col("event_ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        *more,
    )


def clock() -> Column:
    """Ingest time: 0 to 6 seconds after the message, by its offset."""
    delay = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("kafka_offset") % 7)
    return F.col("kafka_timestamp") + delay
