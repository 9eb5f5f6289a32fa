"""Job options, read once from the environment and passed to the job."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace


def _env(name: str, default):
    """A dataclass field whose value may be overridden by an environment variable."""
    return field(default=default, metadata={"env": name})


def _read(text: str, kind: type):
    if kind is bool:
        return text.strip().lower() in ("1", "true", "yes")
    return kind(text)


@dataclass(frozen=True)
class JobOptions:
    """Everything a run can be tuned with.

    ``table_base`` and ``checkpoint_base`` have no default folder: when they are
    unset the job takes the shared folder of ``spark.checkpoint.dir`` (see
    :mod:`clickloom.workspace`), never a machine-local one on a cluster.
    """

    # Source
    source_format: str = _env("SOURCE_FORMAT", "kafka")
    bootstrap_servers: str = _env("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092")
    topic: str = _env("KAFKA_TOPIC", "clickstream-events")
    dlq_topic: str = _env("KAFKA_DLQ_TOPIC", "clickstream-events-dlq")
    consumer_group: str = _env("KAFKA_CONSUMER_GROUP", "spark-clickstream-consumer")
    starting_offsets: str = _env("KAFKA_STARTING_OFFSETS", "latest")
    max_offsets_per_trigger: int = _env("KAFKA_MAX_OFFSETS_PER_TRIGGER", 50_000)
    min_partitions: int = _env("KAFKA_MIN_PARTITIONS", 0)
    source_path: str = _env("SOURCE_PATH", "")
    max_files_per_trigger: int = _env("MAX_FILES_PER_TRIGGER", 1_000)
    fail_on_data_loss: bool = _env("KAFKA_FAIL_ON_DATA_LOSS", False)

    # Sinks
    table_format: str = _env("TABLE_FORMAT", "parquet")
    table_base: str = _env("DELTA_BASE_PATH", "")
    checkpoint_base: str = _env("CHECKPOINT_BASE", "")
    trigger_interval_secs: int = _env("TRIGGER_INTERVAL_SECS", 30)
    analytics_from_bronze: bool = _env("ANALYTICS_FROM_BRONZE", False)

    # Event time
    watermark_minutes: int = _env("WATERMARK_MINUTES", 5)
    session_timeout_minutes: int = _env("SESSION_TIMEOUT_MINUTES", 30)

    # Rules
    alert_purchase_threshold: float = _env("ALERT_PURCHASE_THRESHOLD", 500.0)

    # Time between triggers that write events back to Kafka.
    replay_interval_ms: int = _env("REPLAY_INTERVAL_MS", 500)

    # Execution. Unset (0) keeps the value of the session.
    shuffle_partitions: int = _env("SHUFFLE_PARTITIONS", 0)
    env: str = _env("ENV", "local")

    @classmethod
    def from_env(cls, environ: Mapping[str, str] | None = None, **overrides) -> JobOptions:
        """Defaults, then the environment, then explicit overrides."""
        environ = os.environ if environ is None else environ
        found = {}
        for f in fields(cls):
            text = environ.get(f.metadata["env"])
            if text is not None and text != "":
                found[f.name] = _read(text, type(f.default))
        return replace(cls(**found), **overrides).validate()

    def validate(self) -> JobOptions:
        def require(ok: bool, message: str) -> None:
            if not ok:
                raise ValueError(message)

        if self.source_format == "kafka":
            require(bool(self.bootstrap_servers), "KAFKA_BOOTSTRAP_SERVERS must be set")
            require(bool(self.topic), "KAFKA_TOPIC must be set")
        else:
            require(bool(self.source_path), "SOURCE_PATH must be set for a file source")
        require(self.max_offsets_per_trigger >= 0, "max_offsets_per_trigger must not be negative")
        require(self.max_files_per_trigger >= 0, "max_files_per_trigger must not be negative")
        require(self.trigger_interval_secs > 0, "trigger_interval_secs must be positive")
        require(self.watermark_minutes >= 0, "watermark_minutes must not be negative")
        require(self.session_timeout_minutes > 0, "session_timeout_minutes must be positive")
        require(self.alert_purchase_threshold >= 0, "alert threshold must not be negative")
        require(self.replay_interval_ms > 0, "replay_interval_ms must be positive")
        require(self.shuffle_partitions >= 0, "shuffle_partitions must not be negative")
        require(self.env in ("local", "dev", "prod"), f"unknown ENV: {self.env}")
        return self

    def uncapped(self) -> JobOptions:
        """The options of a backfill, whose triggers take all there is.

        The caps (0 is none) pace a live job. A backfill would need millions of
        triggers under them, and files that are not in the order of their events
        would lose what a later file's watermark calls late.
        """
        return replace(self, max_offsets_per_trigger=0, max_files_per_trigger=0)

    @property
    def watermark(self) -> str:
        return f"{self.watermark_minutes} minutes"

    @property
    def session_gap(self) -> str:
        return f"{self.session_timeout_minutes} minutes"

    # Table locations below ``table_base``.
    def table(self, name: str) -> str:
        if not self.table_base:
            raise ValueError("table_base is unset; see workspace.with_locations")
        return f"{self.table_base.rstrip('/')}/{name}"

    @property
    def bronze_path(self) -> str:
        return self.table("bronze")

    @property
    def silver_agg_path(self) -> str:
        return self.table("silver_agg")

    @property
    def silver_sessions_path(self) -> str:
        return self.table("silver_sessions")

    @property
    def corrupt_path(self) -> str:
        return self.table("corrupt_records")

    @property
    def rejected_path(self) -> str:
        return self.table("rejected_records")

    @property
    def alerts_path(self) -> str:
        return self.table("alerts")

    def checkpoint(self, name: str) -> str:
        if not self.checkpoint_base:
            raise ValueError("checkpoint_base is unset; see workspace.with_locations")
        return f"{self.checkpoint_base.rstrip('/')}/{name}"
