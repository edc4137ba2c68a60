"""Operators: line -> triple extraction and checks, and the set-form cleanup."""

from keysweep.operators.cleanup import (
    cleanup_summary,
    deleted_rows,
    event_outcome,
    key_violations,
    kept_rows,
    run_keys,
)
from keysweep.operators.triples import (
    bad_timestamp_lines,
    checked_lines,
    event_triples,
    failing_lines,
    malformed_lines,
    triple_columns,
    with_override,
)

__all__ = [
    "bad_timestamp_lines",
    "checked_lines",
    "cleanup_summary",
    "deleted_rows",
    "event_outcome",
    "event_triples",
    "failing_lines",
    "key_violations",
    "kept_rows",
    "malformed_lines",
    "run_keys",
    "triple_columns",
    "with_override",
]
