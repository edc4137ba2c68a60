"""Plans: the cleanup job, tables derived from the test data, the query catalog."""

from keysweep.plans.job import CleanupResult, run_cleanup, run_outcome, run_store_cleanup, stage_triples

__all__ = ["CleanupResult", "run_cleanup", "run_outcome", "run_store_cleanup", "stage_triples"]
