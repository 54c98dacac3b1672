from sensorfold.sources.compaction import compact
from sensorfold.sources.messages import broker_records, deal_out, once_only, read_messages
from sensorfold.sources.replay import event_messages, text_messages
from sensorfold.sources.tables import append_rows, commit_rows, ensure_table, readings_from_raw, stored_rows

__all__ = [
    "append_rows",
    "broker_records",
    "commit_rows",
    "compact",
    "deal_out",
    "ensure_table",
    "event_messages",
    "once_only",
    "read_messages",
    "readings_from_raw",
    "stored_rows",
    "text_messages",
]
