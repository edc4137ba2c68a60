"""Sources: the enriched run folder (S1, S2) and the manifest snapshots (S3)."""

from keysweep.sources.enriched import normalize_run_folder, read_enriched, run_folder_glob
from keysweep.sources.manifest import current_version, read_current, read_snapshot

__all__ = [
    "current_version",
    "normalize_run_folder",
    "read_current",
    "read_enriched",
    "read_snapshot",
    "run_folder_glob",
]
