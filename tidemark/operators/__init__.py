from tidemark.operators.asof import Lookup, asof_join, asof_join_all
from tidemark.operators.dedupe import first_per_key, latest
from tidemark.operators.lookup import attach, attach_asked, attach_small, kept, missing_parents, sent
from tidemark.operators.neighbors import with_next, with_previous
from tidemark.operators.scd import (
    apply_revisions, changed_rows, close_keys, close_missing, history_changes, overwrite_current, update_columns, versions,
)
from tidemark.operators.stock import days_on_hand, expiry_flags, lot_expiry, pick_first_expiring
from tidemark.operators.trailing import activity_by_day, trailing_average
from tidemark.operators.upsert import IncrementalTable, merge_rows, since_lookback

__all__ = [
    "IncrementalTable", "Lookup", "activity_by_day", "apply_revisions", "asof_join", "asof_join_all", "attach", "attach_asked", "attach_small",
    "changed_rows", "close_keys", "close_missing", "days_on_hand", "expiry_flags", "first_per_key", "history_changes", "kept", "latest", "lot_expiry",
    "merge_rows", "missing_parents", "overwrite_current", "pick_first_expiring", "sent", "since_lookback",
    "trailing_average", "update_columns", "versions", "with_next", "with_previous",
]
