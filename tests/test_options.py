import pytest

from clickloom.options import JobOptions
from clickloom.session import build_session, prepare, session_settings
from clickloom.sources.messages import kafka_settings
from clickloom.workspace import fresh_dir, with_locations


def test_defaults():
    o = JobOptions.from_env({})
    assert (o.topic, o.dlq_topic) == ("clickstream-events", "clickstream-events-dlq")
    assert o.max_offsets_per_trigger == 50_000
    assert (o.trigger_interval_secs, o.watermark, o.session_gap) == (30, "5 minutes", "30 minutes")
    assert o.alert_purchase_threshold == 500.0
    assert o.starting_offsets == "latest"


def test_environment_overrides_defaults_and_arguments_override_both():
    env = {
        "KAFKA_TOPIC": "clicks",
        "WATERMARK_MINUTES": "9",
        "ALERT_PURCHASE_THRESHOLD": "750.5",
        "DELTA_BASE_PATH": "/tables/",
        "CHECKPOINT_BASE": "/checkpoints",
        "REPLAY_INTERVAL_MS": "250",
    }
    o = JobOptions.from_env(env, topic="mine")
    assert (o.topic, o.watermark, o.alert_purchase_threshold) == ("mine", "9 minutes", 750.5)
    assert o.bronze_path == "/tables/bronze"
    assert o.silver_agg_path == "/tables/silver_agg"
    assert o.silver_sessions_path == "/tables/silver_sessions"
    assert o.corrupt_path == "/tables/corrupt_records"
    assert o.checkpoint("bronze") == "/checkpoints/bronze"
    assert o.replay_interval_ms == 250


@pytest.mark.parametrize(
    "bad",
    [
        {"bootstrap_servers": ""},
        {"max_offsets_per_trigger": -1},
        {"env": "laptop"},
        {"session_timeout_minutes": 0},
        {"source_format": "parquet"},
    ],
)
def test_validate_refuses(bad):
    with pytest.raises(ValueError):
        JobOptions(**bad).validate()


def test_tables_need_a_base():
    with pytest.raises(ValueError):
        JobOptions().bronze_path


def test_kafka_settings():
    s = kafka_settings(JobOptions(bootstrap_servers="b:9092", topic="t", starting_offsets="earliest"))
    assert s["subscribe"] == "t" and s["startingOffsets"] == "earliest"
    assert s["maxOffsetsPerTrigger"] == "50000" and s["failOnDataLoss"] == "false"
    # Queries of one job must not share a consumer group.
    assert "kafka.group.id" not in s and "minPartitions" not in s
    assert kafka_settings(JobOptions(min_partitions=64))["minPartitions"] == "64"


def test_a_backfill_has_no_caps():
    s = kafka_settings(JobOptions(fail_on_data_loss=True).uncapped())
    assert "maxOffsetsPerTrigger" not in s and s["failOnDataLoss"] == "true"
    assert JobOptions().uncapped().max_files_per_trigger == 0


def test_session_settings():
    s = session_settings(JobOptions(shuffle_partitions=16))
    assert s["spark.sql.shuffle.partitions"] == "16"
    assert s["spark.sql.session.timeZone"] == "UTC"
    assert s["spark.sql.streaming.schemaInference"] == "false"
    assert "spark.sql.shuffle.partitions" not in session_settings(JobOptions())


def test_build_session_joins_the_running_one(spark):
    assert build_session().conf.get("spark.sql.session.timeZone") == "UTC"


def test_prepare_keeps_what_the_session_has(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "false")
    prepare(session)
    conf = session.conf
    assert conf.get("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled") == "false"
    assert conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    assert conf.get("spark.sql.session.timeZone") == "UTC"


def test_locations_come_from_the_shared_folder(spark):
    o = with_locations(spark, JobOptions())
    base = spark.conf.get("spark.checkpoint.dir")
    assert o.bronze_path.startswith(base) and o.checkpoint("x").startswith(base)
    kept = with_locations(spark, JobOptions(table_base="/a", checkpoint_base="/b"))
    assert (kept.table_base, kept.checkpoint_base) == ("/a", "/b")
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")
