"""The quality report of a table that grows by dates: only new dates are read.

For each date three small tables hold what the report needs of it: counts per
rule with the event types seen, its users, and a digest of each event id with
the number of its copies. Counts add up; users and ids are counted over all
dates from these tables, so users who come back, and ids that are repeated on
another date, are found without reading the events again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.columns import is_type
from clickloom.operators.catalog import lookup
from clickloom.operators.quality import event_rules, rule_counts, rule_rows, user_bound, with_json
from clickloom.schema import CATEGORIES, EVENT_TYPES
from clickloom.sources.tables import read_table, write_table

DATE = "event_date"
RULES, USERS, IDS = "rules", "users", "ids"


def dates_of(spark: SparkSession, path: str) -> list:
    """The dates a table has, null among them if it has rows without; none without a table.

    Spark answers from the names of the partitions.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return []
    return [row[0] for row in read_table(spark, path).select(DATE).distinct().collect()]


def of_dates(events: DataFrame, dates: list) -> DataFrame:
    """The rows of some dates; the table's other partitions are not listed."""
    named = [d for d in dates if d is not None]
    wanted = F.col(DATE).isin(named) if named else F.lit(False)
    return events.filter(wanted | F.col(DATE).isNull() if None in dates else wanted)


def summarise_new_dates(
    spark: SparkSession,
    events_path: str,
    summary_path: str,
    catalog: DataFrame,
    categories: Sequence[str] = CATEGORIES,
    again: Sequence = (),
) -> DataFrame | None:
    """Add the dates of the events table that have no summary yet, and those in ``again``.

    A date is summarised once it is complete; ``again`` names dates that got more
    events since. The ids come last, and a date counts as done when its ids are
    there, so a run that breaks off is made good by the next. Returns the events
    read, None if there were none to read.
    """
    done = set(dates_of(spark, f"{summary_path}/{IDS}")) - set(again)
    new = [d for d in dates_of(spark, events_path) if d not in done]
    if not new:
        return None
    events = of_dates(read_table(spark, events_path), new)
    rules = event_rules(categories)
    types = [F.when(is_type(t), F.lit(1 << at)) for at, t in enumerate(EVENT_TYPES)]
    seen = F.coalesce(F.bit_or(F.coalesce(*types)), F.lit(0)).alias("seen")
    per_date = with_json(lookup(events, catalog)).groupBy(DATE).agg(*rule_counts(rules), seen)
    digest = F.unhex(F.md5(F.col("event_id").cast("binary"))).alias("digest")
    tables = {
        RULES: per_date,
        USERS: events.select(DATE, "user_id").filter("user_id is not null").distinct(),
        IDS: events.groupBy(DATE, digest).agg(F.count("*").alias("copies")),
    }
    for name, rows in tables.items():
        write_table(rows, f"{summary_path}/{name}", (DATE,), mode="overwrite")
    return events


def report_of_summaries(
    spark: SparkSession,
    summary_path: str,
    max_users: int,
    categories: Sequence[str] = CATEGORIES,
) -> DataFrame:
    """``quality_report`` of all dates summarised, from the summaries alone."""
    rules, users, ids = (read_table(spark, f"{summary_path}/{t}") for t in (RULES, USERS, IDS))
    names = [f"{rule}_{kind}" for rule in event_rules(categories) for kind in ("checked", "failed")]
    totals = rules.agg(*(F.sum(n).alias(n) for n in names), F.bit_or("seen").alias("seen"))
    n_types = F.lit(len(EVENT_TYPES)).cast("bigint")
    totals = totals.withColumns(
        {
            "event_types_present_checked": n_types,
            "event_types_present_failed": n_types - F.bit_count("seen").cast("bigint"),
        }
    )
    copies = ids.groupBy("digest").agg(F.sum("copies").alias("copies"))
    repeated = copies.agg(
        F.lit("event_ids_unique").alias("rule"),
        F.count("*").alias("checked"),
        F.count_if(F.col("copies") > 1).alias("failed"),
    )
    return (
        rule_rows(totals, [*event_rules(categories), "event_types_present"])
        .unionByName(user_bound(users, max_users))
        .unionByName(repeated)
    )
