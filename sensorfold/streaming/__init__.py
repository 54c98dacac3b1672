from sensorfold.streaming.jobs import (
    clock_heartbeats,
    closed_co_group,
    closed_co_group_columns,
    closed_until,
    closed_windows,
    in_time,
    start_aggregate,
    start_pair,
    start_pipeline,
    start_raw,
    start_rows,
    wait_all,
    watched,
    with_heartbeats,
    writer_id,
)

__all__ = [
    "clock_heartbeats",
    "closed_co_group",
    "closed_co_group_columns",
    "closed_until",
    "closed_windows",
    "in_time",
    "start_aggregate",
    "start_pair",
    "start_pipeline",
    "start_raw",
    "start_rows",
    "wait_all",
    "watched",
    "with_heartbeats",
    "writer_id",
]
