from pagetrail.functions.keys import join_key, prefix_successor, tab_line
from pagetrail.functions.time import (
    dtype_of,
    epoch_millis,
    epoch_millis_sql,
    epoch_seconds,
    epoch_seconds_sql,
    hour_floor,
    hour_floor_sql,
    is_ntz,
    q,
    seconds_interval,
)

__all__ = [
    "dtype_of",
    "epoch_millis",
    "epoch_millis_sql",
    "epoch_seconds",
    "epoch_seconds_sql",
    "hour_floor",
    "hour_floor_sql",
    "is_ntz",
    "join_key",
    "prefix_successor",
    "q",
    "seconds_interval",
    "tab_line",
]
