"""Progress of streaming queries."""

from __future__ import annotations

import json
import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

logger = logging.getLogger("clickloom.metrics")

PROGRESS_TYPES = {
    "query": "STRING",
    "query_id": "STRING",
    "run_id": "STRING",
    "batch_id": "BIGINT",
    "started_at": "STRING",
    "input_rows": "BIGINT",
    "input_rows_per_second": "DOUBLE",
    "processed_rows_per_second": "DOUBLE",
    "watermark": "STRING",
    "late_rows_dropped": "BIGINT",
    "state_rows": "BIGINT",
    "duration_ms": "MAP<STRING, BIGINT>",
    "observed": "STRING",
}
PROGRESS_FIELDS = tuple(PROGRESS_TYPES)
PROGRESS_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in PROGRESS_TYPES.items())


def progress_row(progress: dict) -> tuple:
    """One progress report as a row with :data:`PROGRESS_FIELDS`."""
    operators = progress.get("stateOperators") or []
    return (
        progress.get("name"),
        str(progress["id"]),
        str(progress["runId"]),
        progress["batchId"],
        progress["timestamp"],
        progress.get("numInputRows", 0),
        _number(progress.get("inputRowsPerSecond")),
        _number(progress.get("processedRowsPerSecond")),
        (progress.get("eventTime") or {}).get("watermark"),
        sum(o.get("numRowsDroppedByWatermark", 0) for o in operators),
        sum(o.get("numRowsTotal", 0) for o in operators),
        {k: int(v) for k, v in (progress.get("durationMs") or {}).items()},
        json.dumps(progress.get("observedMetrics") or {}),
    )


def keep_progress(spark: SparkSession, batches: int) -> None:
    """Let queries started from now on keep the reports of this many micro-batches."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(batches))


def progress_frame(spark: SparkSession, queries: Iterable[StreamingQuery]) -> DataFrame:
    """The micro-batches of the queries, as many as Spark keeps (see ``keep_progress``)."""
    rows = [progress_row(json.loads(p.json)) for q in queries for p in q.recentProgress]
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)


def route_totals(progress: DataFrame, name: str = "routes") -> DataFrame:
    """Per query: batches with input, input rows, and the observed routes in all."""
    kinds = ("total", "valid", "corrupt", "rejected")
    counts = F.from_json("observed", f"map<string,struct<{','.join(f'{k}:bigint' for k in kinds)}>>")
    return (
        progress.withColumn("counts", F.try_element_at(counts, F.lit(name)))
        .groupBy("query")
        .agg(
            F.count_if(F.col("input_rows") > 0).alias("batches"),
            F.sum("input_rows").alias("input_rows"),
            *(F.sum(f"counts.{kind}").alias(kind) for kind in kinds),
        )
    )


def query_status(queries: Iterable[StreamingQuery]) -> list[dict]:
    """Name, id, activity and failure of each query."""
    return [
        {
            "query": q.name,
            "query_id": str(q.id),
            "active": q.isActive,
            "exception": str(q.exception()) if q.exception() else None,
        }
        for q in queries
    ]


class ProgressLog(StreamingQueryListener):
    """Logs start, progress and end of every query of a session as JSON."""

    def onQueryStarted(self, event) -> None:
        _log("started", id=str(event.id), query=event.name)

    def onQueryProgress(self, event) -> None:
        _log("progress", **dict(zip(PROGRESS_FIELDS, progress_row(json.loads(event.progress.json)))))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        level = logging.ERROR if event.exception else logging.INFO
        _log("ended", level, id=str(event.id), exception=event.exception)


def _log(what: str, level: int = logging.INFO, **details) -> None:
    logger.log(level, "query %s %s", what, json.dumps(details))


def _number(value) -> float | None:
    # Reports carry NaN and infinity as text.
    return None if value is None else float(value)
