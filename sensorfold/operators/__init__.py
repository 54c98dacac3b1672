from sensorfold.operators.cogroup import co_group, co_group_columns, co_group_lists, co_group_only
from sensorfold.operators.extract import (
    count_messages,
    extract_readings,
    parse_messages,
    rejected_messages,
    unescape_payload,
)
from sensorfold.operators.rows import agg_rows, key_value, raw_rows
from sensorfold.operators.summary import (
    comparison_from_readings,
    reduction_from_readings,
    reduction_report,
    summary_agg,
    summary_comparison,
    summary_raw,
)
from sensorfold.operators.tokens import token_counts, tokenize_letters
from sensorfold.operators.windows import (
    assign_window,
    count_per_measure,
    max_per_measure,
    mean_per_measure,
    min_per_measure,
    windowed_stats,
)

__all__ = [
    "agg_rows",
    "assign_window",
    "co_group",
    "co_group_columns",
    "co_group_lists",
    "co_group_only",
    "comparison_from_readings",
    "count_messages",
    "count_per_measure",
    "extract_readings",
    "key_value",
    "max_per_measure",
    "mean_per_measure",
    "min_per_measure",
    "parse_messages",
    "raw_rows",
    "reduction_from_readings",
    "reduction_report",
    "rejected_messages",
    "summary_agg",
    "summary_comparison",
    "summary_raw",
    "token_counts",
    "tokenize_letters",
    "unescape_payload",
    "windowed_stats",
]
