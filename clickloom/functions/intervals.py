"""Time arithmetic on whole microseconds."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def interval_micros(text: str) -> Column:
    """Length of an interval such as ``30 minutes``; the optimizer folds it."""
    return F.unix_micros(F.expr(f"timestamp'1970-01-01 00:00:00Z' + interval {text}"))


def interval_length(text: str) -> int:
    """The same as a number, where the plan depends on it."""
    return pd.Timedelta(text).value // 1000


def floor_micros(ts: Column, width: Column) -> Column:
    """Start of the slice of ``width`` microseconds that holds ``ts``."""
    micros = F.unix_micros(ts)
    return micros - F.pmod(micros, width)
