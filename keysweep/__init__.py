"""keysweep: clean a duplicate-tracking manifest after a failed load, on Spark.

A run folder of enriched event lines gives (event id, fingerprint, ETL time)
triples; every manifest row that matches a triple on all three is removed,
rows of other batches stay. Everything is DataFrame joins and projections.
"""

from keysweep.plans.job import (
    CleanupResult,
    StoreCleanupResult,
    check_run_lines,
    run_cleanup,
    run_outcome,
    run_store_cleanup,
    store_outcome,
)
from keysweep.sinks.snapshot import expire_snapshots, init_manifest, remove_orphans, run_report

__all__ = [
    "CleanupResult",
    "StoreCleanupResult",
    "check_run_lines",
    "expire_snapshots",
    "init_manifest",
    "remove_orphans",
    "run_cleanup",
    "run_outcome",
    "run_report",
    "run_store_cleanup",
    "store_outcome",
]
