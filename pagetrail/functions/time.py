"""Time helpers that give the same answer whatever the session time zone is.

Driver tables carry ``timestamp_ntz`` (wall clock, read as UTC); a log read
with the declared page-view schema carries zoned ``timestamp``. Each helper
takes the column's data type so it can pick a zone-free expression for
``timestamp_ntz`` and the instant-based one for ``timestamp``.

Every helper has a ``*_sql`` form returning SQL text for a column name, so
wide projections can be issued as one ``selectExpr``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_ntz(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.TimestampNTZType)


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def q(name: str) -> str:
    """Quote a column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


# For timestamp_ntz only calendar arithmetic is used: a cast to date and the
# hour / minute / second fields never consult a time zone (unlike a cast to
# timestamp, which timestampdiff performs on its inputs).


def epoch_millis_sql(name: str, dtype: T.DataType) -> str:
    """Milliseconds since 1970-01-01 UTC, floored like ``Timestamp.getTime``."""
    c = q(name)
    if is_ntz(dtype):
        return (
            f"(CAST(unix_date(CAST({c} AS DATE)) AS BIGINT) * 86400000"
            f" + CAST(hour({c}) AS BIGINT) * 3600000 + CAST(minute({c}) AS BIGINT) * 60000"
            f" + CAST(floor(date_part('SECOND', {c}) * 1000) AS BIGINT))"
        )
    return f"unix_millis({c})"


def epoch_seconds_sql(name: str, dtype: T.DataType) -> str:
    """Whole seconds since the epoch (what ``cast(ts as long)`` gives)."""
    c = q(name)
    if is_ntz(dtype):
        return (
            f"(CAST(unix_date(CAST({c} AS DATE)) AS BIGINT) * 86400"
            f" + CAST(hour({c}) AS BIGINT) * 3600 + CAST(minute({c}) AS BIGINT) * 60"
            f" + CAST(second({c}) AS BIGINT))"
        )
    return f"unix_seconds({c})"


def hour_floor_sql(name: str, dtype: T.DataType) -> str:
    """Truncate to the hour, keeping the input type."""
    c = q(name)
    if is_ntz(dtype):
        return f"make_timestamp_ntz(year({c}), month({c}), day({c}), hour({c}), 0, 0)"
    return f"date_trunc('hour', {c})"


def epoch_millis(name: str, dtype: T.DataType) -> Column:
    return F.expr(epoch_millis_sql(name, dtype))


def epoch_seconds(name: str, dtype: T.DataType) -> Column:
    return F.expr(epoch_seconds_sql(name, dtype))


def hour_floor(name: str, dtype: T.DataType) -> Column:
    return F.expr(hour_floor_sql(name, dtype))


def seconds_interval(seconds: int | float) -> Column:
    """A day-time interval of ``seconds`` seconds (works for both time types)."""
    return F.expr(f"INTERVAL '{float(seconds)!r}' SECOND")


def millis_literal(millis: int, dtype: T.DataType) -> Column:
    """A timestamp literal of the column's type for an epoch-millis instant."""
    t = dt.datetime.fromtimestamp(millis / 1000, tz=dt.timezone.utc)
    if is_ntz(dtype):
        return F.expr(f"TIMESTAMP_NTZ '{t.replace(tzinfo=None).isoformat(sep=' ')}'")
    return F.lit(t)


def open_millis_range_hint(name: str, dtype: T.DataType, t1_millis: int, t2_millis: int) -> Column:
    """``t1 < ts < t2`` on the raw timestamp column.

    Implied by ``t1 < epoch_millis(ts) < t2`` (millis are floored), so adding
    it never drops a row; unlike the millis form it is a plain column
    comparison that Parquet can push down and prune row groups with.
    """
    c = F.col(name)
    return (c > millis_literal(t1_millis, dtype)) & (c < millis_literal(t2_millis, dtype))
