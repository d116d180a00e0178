from tidemark.quality.gate import GateError, at_risk_count, check_limit, failing_rows, run_suite, stored_failures
from tidemark.quality.rules import (
    RowRule, accepted_values, between, duplicate_keys, expired_shipments, freshness, freshness_of, not_null, orphans, row_failures,
    source_freshness, summarize_rows,
)
from tidemark.quality.suite import SUITE

__all__ = [
    "GateError", "RowRule", "SUITE", "accepted_values", "at_risk_count", "between", "check_limit", "duplicate_keys",
    "expired_shipments", "failing_rows", "freshness", "freshness_of", "not_null", "orphans", "row_failures", "run_suite", "source_freshness",
    "stored_failures", "summarize_rows",
]
