"""K1: publish a cleaned manifest as a new version.

Parquet has no row-level DELETE, and overwriting the folder a query reads from
destroys it. A cleanup therefore writes the kept rows of the parts it touched (days,
or key buckets of large days) to a folder of its own, counts them, and then creates
the commit that makes the new version current; all other parts are carried over by
name. A failure at any step leaves the previous version current and readable.

Rows are rebalanced by part before they are written: each part is gathered, and a
part larger than the advisory partition size is split over tasks again by adaptive
execution. So the number of files follows the bytes of each part, not tasks x parts.
Small buckets of a day share a folder (see :mod:`keysweep.sources.manifest`); all steps
that cost something for each folder or file, such as listing, committing and opening
them, so follow the rows, however small the buckets are.

The commit is the only point of decision. Its number is the next free one after the
version that the rows were computed from, and it is created exclusively and whole: of
two cleanups that started from the same version one wins, the other gets a
:class:`PublishError` and has to run again on the new version. So a publish never
undoes another run's deletes.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keysweep.functions.timefmt import checked_int
from keysweep.operators.cleanup import key_violations
from keysweep.schemas import ETL_TIME, EVENT_ID, FINGERPRINT, REPORT_LINE
from keysweep.sources import fs
from keysweep.sources.manifest import (
    COMMITS,
    DATA,
    DAY,
    PART,
    Commit,
    commit_numbers,
    commit_path,
    current_version,
    day_path,
    etl_day,
    folder_counts,
    newest_whole,
    published_versions,
    read_commit,
    split_part,
    with_part,
    write_path,
    written_folders,
)

#: A day with more rows than this is cut into key buckets of about half to all of it (some gigabytes of parquet).
BUCKET_ROWS = 20_000_000
#: Buckets of a day share a folder up to about so many rows.
FOLDER_ROWS = 1_000_000


class PublishError(RuntimeError):
    pass


def _as_manifest(rows: DataFrame) -> DataFrame:
    """The manifest columns with the manifest types (readers pin that schema).

    A wider ETL time column is narrowed with a range check, never wrapped.
    """
    etl = F.col(ETL_TIME)
    return rows.select(F.col(EVENT_ID).cast("string").alias(EVENT_ID),
                       F.col(FINGERPRINT).cast("string").alias(FINGERPRINT),
                       checked_int(etl, etl.cast("string")).alias(ETL_TIME))


def day_buckets(rows: DataFrame, bucket_rows: int) -> dict[str, int]:
    """Number of key buckets, a power of two, of every day of ``rows`` that has more than ``bucket_rows``."""
    counts = _as_manifest(rows).groupBy(etl_day(F.col(ETL_TIME)).alias(DAY)).count().where(F.col("count") > bucket_rows)
    return {r[DAY]: 1 << (-(-r["count"] // bucket_rows) - 1).bit_length() for r in counts.collect()}


def sharing_buckets(rows: int) -> int:
    """How many buckets of about ``rows`` rows share a folder, a power of two."""
    return 1 << max(0, (FOLDER_ROWS // max(1, rows)).bit_length() - 1)


def _write(spark: SparkSession, rows: DataFrame, root: str, version: int, buckets: dict[str, int],
           per_folder: int) -> dict[str, tuple[str, int]]:
    """Write rows by part into a new folder; part -> (folder, rows)."""
    write = f"v{version:08d}-{uuid.uuid4().hex}" + (f"-by{per_folder}" if buckets and per_folder > 1 else "")
    path = write_path(root, write)
    if buckets and per_folder > 1:
        named = with_part(with_part(_as_manifest(rows), buckets, out=PART), folder_counts(buckets, per_folder))
        named.hint("rebalance", F.col(DAY)).sortWithinPartitions(DAY, PART).write.partitionBy(DAY).parquet(path)
        name = PART
    else:
        with_part(_as_manifest(rows), buckets).hint("rebalance", F.col(DAY)).write.partitionBy(DAY).parquet(path)
        name = DAY
    if not any(n.startswith(f"{DAY}=") for n in fs.list_names(spark, path)):
        return {}
    # Reads the parts' names, from the rows or from the folders alone, and the row counts of the footers.
    counts = spark.read.schema(f"{name} string").parquet(path).groupBy(name).count()
    return {r[name]: (write, int(r["count"])) for r in counts.collect()}


def publish_snapshot(spark: SparkSession, rows: DataFrame | None, root: str, expected_rows: int | None = None,
                     base_version: int | None = None, days: Iterable[str] | None = None,
                     bucket_rows: int = BUCKET_ROWS, run: Callable[[int], dict] | None = None) -> tuple[int, int]:
    """Publish the version after ``base_version`` (default: the current one); (version, rows).

    ``rows`` replace the rows of the parts ``days`` (names of days, or of buckets of
    days); without ``days`` they replace the whole manifest, whose days are then cut into
    buckets anew. ``rows`` may be None when there is nothing to replace. With
    ``expected_rows`` the new version's row count must match before it is published.
    ``run`` makes, from that count, what the commit says about the run. Nothing is
    published when another job published since.
    """
    def newest() -> tuple[int, int]:
        numbers = commit_numbers(spark, root)   # one listing: torn commits of later numbers keep theirs
        return newest_whole(spark, root, numbers) or 0, max(numbers, default=0) + 1

    base = newest()[0] if base_version is None else base_version

    def check_base() -> int:
        now, free = newest()
        if now != base:
            raise PublishError(f"{root} moved from version {base} to {now}; run the cleanup again")
        return free

    check_base()
    replaced = None if days is None else set(days)
    old = read_commit(spark, root, base) if base and replaced is not None else Commit({})
    new = {d: v for d, v in old.days.items() if d not in replaced} if replaced is not None else {}
    if rows is not None:
        buckets = old.buckets if replaced is not None else day_buckets(rows, bucket_rows)
        if replaced is not None:   # as large as the buckets that are replaced
            sizes = [n for d, (_, n) in old.days.items() if d in replaced and split_part(d)[1] > 1]
            bucket_rows = -(-sum(sizes) // len(sizes)) if sizes else bucket_rows
        written = _write(spark, rows, root, base + 1, buckets, sharing_buckets(bucket_rows))
        if replaced is not None and not set(written) <= replaced:
            raise PublishError(f"rows of days {sorted(set(written) - replaced)} aren't among the replaced days")
        new |= written
    commit = Commit(new)
    if expected_rows is not None and commit.rows != expected_rows:
        raise PublishError(f"the new version has {commit.rows} rows, expected {expected_rows}; not published")
    commit = Commit(new, run(commit.rows) if run else {})
    version = check_base()
    if not fs.create_marker(spark, commit_path(root, version), commit.to_text()):
        raise PublishError(f"version {version} of {root} was published by another job; run the cleanup again")
    return version, commit.rows


def init_manifest(spark: SparkSession, rows: DataFrame, root: str, bucket_rows: int = BUCKET_ROWS) -> int:
    """Publish the first version of a new manifest root; days of more than ``bucket_rows`` rows in key buckets.

    A key pair stored more than once is refused (one shuffle of the rows, once
    in a manifest's life; cleanups only remove rows, so repeats can't appear).
    """
    if current_version(spark, root) is not None:
        raise PublishError(f"{root} already holds a manifest")
    if not key_violations(rows).isEmpty():
        raise PublishError("a key pair (eventid, fingerprint) occurs more than once; a manifest holds each once")
    version, _ = publish_snapshot(spark, rows, root, bucket_rows=bucket_rows)
    return version


def expire_snapshots(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Remove versions older than the newest ``keep``; returns the versions removed.

    A folder goes when only removed versions name a part in it. Folders that no
    commit names are left alone: another cleanup may be writing them (see
    :func:`remove_orphans`).
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    published = published_versions(spark, root)
    doomed, kept = published[:-keep], published[-keep:]
    if not doomed:
        return []
    used = {day_path(root, w, d) for v in kept for d, (w, _) in read_commit(spark, root, v).days.items()}
    gone = {day_path(root, w, d) for v in doomed for d, (w, _) in read_commit(spark, root, v).days.items()} - used
    for version in doomed:   # commits first: a version without one is never read
        fs.delete(spark, commit_path(root, version))
    for path in sorted(gone):
        fs.delete(spark, path)
    return doomed


def remove_orphans(spark: SparkSession, root: str, older_than_seconds: int = 7 * 86400) -> list[str]:
    """Remove what no version needs and what is older than any running cleanup can be.

    Write folders that no commit names, torn commits, and the temporary files of
    writers that died; returns the names removed.
    """
    whole = published_versions(spark, root)
    named = {w for v in whole for w, _ in read_commit(spark, root, v).days.values()}
    limit = time.time() - older_than_seconds
    base, commits = f"{root.rstrip('/')}/{DATA}", f"{root.rstrip('/')}/{COMMITS}"
    doomed = {w: f"{base}/{w}" for w in written_folders(spark, root) if w not in named}
    doomed |= {n: f"{commits}/{n}" for n in fs.list_names(spark, commits)
               if n.startswith(fs.TEMPORARY) or n.isdigit() and int(n) not in whole and int(n) < max(whole, default=0)}
    gone = [n for n, path in sorted(doomed.items()) if fs.modified(spark, path) < limit]
    for name in gone:
        fs.delete(spark, doomed[name])
    return gone


def run_report(spark: SparkSession, root: str, version: int) -> str:
    """The report line of the cleanup that published a version, from its commit."""
    run = read_commit(spark, root, version).run
    if "deleted" not in run:
        raise ValueError(f"version {version} of {root} wasn't published by a cleanup")
    return REPORT_LINE.format(deleted=run["deleted"], skipped=run["skipped"])
