"""Sinks: snapshot publish of the manifest (K1), external store deletes (K2)."""

from keysweep.sinks.snapshot import PublishError, expire_snapshots, init_manifest, publish_snapshot, remove_orphans, run_report
from keysweep.sinks.store import Ledger, StoreError, delete_from_store, send_deletes

__all__ = [
    "Ledger",
    "PublishError",
    "StoreError",
    "delete_from_store",
    "expire_snapshots",
    "init_manifest",
    "publish_snapshot",
    "remove_orphans",
    "run_report",
    "send_deletes",
]
