"""The cleanup job: one run folder against one manifest.

Stages::

    1. scan run folder -> triples -> parquet in the shared scratch folder
       (map only; computes every column of every line, so a malformed line
       or a bad timestamp fails here, before anything is deleted)
    2. line count, key bytes (observed during step 1) and the run's ETL days
    3. the manifest's folders of those days (of large days, the key buckets
       that the run hits) LEFT ANTI JOIN distinct run triples -> new folders
       (broadcast of the run side only below a checked size)
    4. commit: the new folders, by name the folders of everything else, and
       what the run deleted and skipped

deleted = rows of those folders before - after; skipped = lines - deleted.
Everything else in the manifest is neither read nor written. Staging also cuts the
lineage: a lost executor re-reads staged files, not the run folder. Staged lines
keep their file and split, from which :func:`read_positioned` numbers them.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from keysweep.functions.timefmt import run_time_value
from keysweep.operators.cleanup import deleted_rows, event_outcome, key_violations, kept_rows, run_keys
from keysweep.operators.triples import checked_lines, event_triples
from keysweep.schemas import (
    BLOCK,
    DAY_SECONDS,
    ETL_TSTAMP,
    EVENT_ID,
    FILE,
    FINGERPRINT,
    LINE_NUMBER,
    MANIFEST_KEYS,
    POSITIONED,
    REPORT_LINE,
    ROW_ID,
    STAGED,
    SUMMARY,
)
from keysweep.session import scratch_path
from keysweep.sinks.snapshot import PublishError, expire_snapshots, publish_snapshot
from keysweep.sinks.store import Ledger, send_deletes
from keysweep.sources.enriched import line_positions, read_enriched
from keysweep.sources.manifest import DAY, Commit, current_version, read_commit, read_days, split_part, with_part

log = logging.getLogger("keysweep")

BROADCAST_CONF = "spark.keysweep.broadcastMaxBytes"
DEFAULT_BROADCAST_MAX_BYTES = 256 * 1024 * 1024
# Layout of Spark's hash relation: each row is stored as a key row and a value
# row (null bits and one word per column, strings rounded up to words) with a
# header, in pages of at most 64 MiB; a slot table of 16 bytes a slot is kept
# at most half full.
_WORD = 8
_FIXED_BYTES = 4 * _WORD
_RECORD_HEADER = 16
_PAGE_BYTES = 64 * 1024 * 1024
_SLOT_BYTES = 16


@dataclass(frozen=True)
class StagedTriples:
    path: str
    lines: int
    key_bytes: int                # eventid and fingerprint in UTF-8, each rounded up to words
    longest_key: int              # the largest of those sums
    etl_days: tuple[int, ...]     # distinct ETL days (days since 1970); at most one per day INT can hold

    def broadcast_bytes(self) -> int:
        """Upper bound of the in-memory size of the run keys as a broadcast hash relation."""
        record = 2 * (_FIXED_BYTES + self.longest_key) + _RECORD_HEADER
        rows = 2 * (self.key_bytes + _FIXED_BYTES * self.lines) + _RECORD_HEADER * self.lines
        usable = max(_PAGE_BYTES - record, 1)          # a record never spans two pages
        pages = max(1, -(-rows // usable))
        slots = 1 << max(7, (2 * self.lines).bit_length())
        return pages * max(_PAGE_BYTES, record) + slots * _SLOT_BYTES


@dataclass(frozen=True)
class CleanupResult:
    deleted: int
    skipped: int
    lines: int
    manifest_before: int
    manifest_version: int   # snapshot the run was checked against
    version: int | None     # published snapshot version; None for a dry run
    broadcast: bool
    stage: str              # staged triples (rid, eventid, fingerprint, etltstamp)
    etl_days: tuple[int, ...]

    def report(self) -> str:
        return REPORT_LINE.format(deleted=self.deleted, skipped=self.skipped)

    def summary(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(self.deleted, self.skipped)], SUMMARY)


def _reported(result, quiet: bool):
    """Print the report line (A3) unless ``quiet``; return the result."""
    if not quiet:
        print(result.report())
    return result


def broadcast_limit(spark: SparkSession) -> int:
    value = spark.conf.get(BROADCAST_CONF, None)
    return int(value) if value else DEFAULT_BROADCAST_MAX_BYTES


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    """Staged triples (rid, eventid, fingerprint, etltstamp), schema declared."""
    return spark.read.schema(STAGED).parquet(path)


def read_positioned(spark: SparkSession, path: str) -> DataFrame:
    """Staged triples of a run folder with their ``file``, ``line`` and a ``rid`` in (file, line) order.

    These don't change with the size of splits, the number of tasks or their order.
    """
    return line_positions(spark.read.schema(POSITIONED).parquet(path))


def stage_triples(spark: SparkSession, lines: DataFrame, override_seconds: int | None = None) -> StagedTriples:
    """Steps 1-2: write (rid, eventid, fingerprint, etltstamp) and measure it.

    Other columns of ``lines`` (file and split of a scan with positions) are written too.
    Key bytes are observed while the write runs: no second pass over the data,
    two numbers to the driver, only used to bound the broadcast. The line
    count, which the report depends on, and the distinct ETL days are read back
    from the staged files.
    """
    triples = event_triples(lines.withColumn(ROW_ID, F.monotonically_increasing_id()), override_seconds)
    path = scratch_path(spark, "triples")
    measures = Observation("staged_triples")

    def words(name):
        return F.ceil(F.octet_length(name) / _WORD) * _WORD

    key = words(EVENT_ID) + words(FINGERPRINT)
    triples.observe(measures, F.coalesce(F.sum(key), F.lit(0)).alias("b"),
                    F.coalesce(F.max(key), F.lit(0)).alias("longest")).write.parquet(path)
    m = measures.get
    staged = read_staged(spark, path)
    days = staged.select(F.floor(F.col(ETL_TSTAMP) / DAY_SECONDS).alias("d")).distinct().collect()
    return StagedTriples(path, staged.count(), int(m["b"]), int(m["longest"]), tuple(sorted(int(r["d"]) for r in days)))


def run_cleanup(spark: SparkSession, run_folder: str, manifest_root: str, override_time: str | None = None,
                publish: bool = True, broadcast_max_bytes: int | None = None, check_keys: bool = False,
                verify: bool = False, keep_snapshots: int | None = None, quiet: bool = False) -> CleanupResult:
    """Remove from the manifest exactly the rows this run wrote.

    ``override_time`` (``yyyy-MM-dd-HH-mm-ss``, UTC) replaces every event's
    ETL time. ``publish=False`` is a dry run that only counts. ``check_keys``
    checks again what :func:`init_manifest` ensures, for the rows to delete
    (one more run-sized join). ``verify`` recounts the deleted rows with a
    second join before publishing. Publishing fails if another cleanup
    published since this one read the manifest. ``keep_snapshots`` removes all
    but that many newest versions after a publish (default: keep all).
    """
    override_seconds = run_time_value(spark, override_time)
    version = current_version(spark, manifest_root)
    if version is None:
        raise FileNotFoundError(f"no published manifest under {manifest_root}")
    commit = read_commit(spark, manifest_root, version)

    staged = stage_triples(spark, read_enriched(spark, run_folder, positions=True), override_seconds)
    triples = read_staged(spark, staged.path)
    touched = touched_parts(triples, staged.etl_days, commit)
    manifest = read_days(spark, manifest_root, touched)
    limit = broadcast_limit(spark) if broadcast_max_bytes is None else broadcast_max_bytes
    use_broadcast = staged.broadcast_bytes() <= limit
    log.info("run %s: %d lines staged at %s; %d ETL days, %d folders of the manifest; run side at most %d bytes, %s (cap %d)",
             run_folder, staged.lines, staged.path, len(staged.etl_days), len(touched.days), staged.broadcast_bytes(),
             "broadcast" if use_broadcast else "sort-merge", limit)

    if check_keys and not key_violations(deleted_rows(manifest, triples, use_broadcast)).isEmpty():
        raise PublishError(f"manifest {manifest_root} v{version} stores a key pair of this run more than once")
    new_version = None
    if publish:
        expected = None
        if verify:
            expected = commit.rows - deleted_rows(manifest, triples, use_broadcast).count()
        kept = kept_rows(manifest, triples, use_broadcast) if touched.days else None

        def done(after: int) -> dict:
            gone = commit.rows - after
            return {"folder": run_folder, "time": override_time, "lines": staged.lines, "deleted": gone,
                    "skipped": staged.lines - gone, "base": version}

        new_version, after = publish_snapshot(spark, kept, manifest_root, expected_rows=expected,
                                              base_version=version, days=touched.days, run=done)
        deleted = commit.rows - after
        log.info("manifest %s: version %d -> %d, %d -> %d rows", manifest_root, version, new_version, commit.rows, after)
        if keep_snapshots is not None:
            expired = expire_snapshots(spark, manifest_root, keep_snapshots)
            log.info("manifest %s: expired versions %s", manifest_root, expired)
    else:
        deleted = deleted_rows(manifest, triples, use_broadcast).count()

    return _reported(CleanupResult(deleted=deleted, skipped=staged.lines - deleted, lines=staged.lines,
                                   manifest_before=commit.rows, manifest_version=version, version=new_version,
                                   broadcast=use_broadcast, stage=staged.path, etl_days=staged.etl_days), quiet)


def touched_parts(triples: DataFrame, etl_days, commit: Commit) -> Commit:
    """The parts of a version that the run's triples can match: its days, of large days the buckets of its keys."""
    days = {str(d) for d in etl_days}
    buckets = {day: n for day, n in commit.buckets.items() if day in days}
    if buckets:
        named = with_part(triples.where(F.floor(F.col(ETL_TSTAMP) / DAY_SECONDS).isin(sorted(map(int, buckets)))), buckets, ETL_TSTAMP)
        days |= {r[DAY] for r in named.select(DAY).distinct().collect()}   # at most one for each folder of these days
    return commit.only(days)


def run_outcome(spark: SparkSession, result: CleanupResult, manifest_root: str) -> DataFrame:
    """J3 for a finished run: every line with the result of its delete.

    Reads the staged triples against the snapshot the run was checked against,
    so it can be asked after publish. Of a repeated triple the copy that comes
    first by file name and line is the one that was deleted.
    """
    triples = read_positioned(spark, result.stage)
    days = {str(d) for d in result.etl_days}
    commit = read_commit(spark, manifest_root, result.manifest_version)
    return event_outcome(triples, read_days(spark, manifest_root, commit.only(p for p in commit.days if split_part(p)[0] in days)))


@dataclass(frozen=True)
class StoreCleanupResult:
    deleted: int            # a lower bound when ``unknown`` is not 0
    skipped: int
    lines: int
    sent: int               # distinct triples sent to the store
    unknown: int            # keys whose first call may or may not have deleted them
    stage: str
    ledger: str | None = None   # folder of the outcomes; None for a dry run

    @property
    def exact(self) -> bool:
        return self.unknown == 0

    def report(self) -> str:
        return REPORT_LINE.format(deleted=self.deleted, skipped=self.skipped)


def stage_keys(spark: SparkSession, triples: DataFrame, parallelism: int | None = None) -> str:
    """The run's distinct keys, written: what is sent doesn't change with a task or a stage that runs again."""
    keys = run_keys(triples)
    if parallelism:
        keys = keys.repartition(parallelism, *keys.columns)
    path = scratch_path(spark, "keys")
    keys.write.parquet(path)
    return path


def run_store_cleanup(spark: SparkSession, run_folder: str, client_factory, override_time: str | None = None,
                      parallelism: int | None = None, concurrency: int = 1, quiet: bool = False,
                      publish: bool = True, ledger: str | None = None, look: bool = False) -> StoreCleanupResult:
    """The cleanup against a manifest held in an external keyed store (K2).

    Every distinct triple of the run is sent once as a conditional delete;
    the store answers whether a row with that key pair and ETL time existed.
    A repeated triple could only fail its second delete, so
    deleted = successful deletes and skipped = lines - deleted, the same
    totals as one call per line.

    Outcomes are rows of a ledger that Spark commits, and the totals are counted
    there (see :class:`keysweep.sinks.store.Ledger`). ``ledger`` names its folder; a
    folder that an earlier, broken-off call has left is resumed: its keys are sent on
    and not staged again. ``publish=False`` only counts, with a client that can look
    (``present``), and sends nothing. Speculative execution sends calls twice and must
    be off. ``parallelism`` sets the number of tasks (and so of clients); by default
    the shuffle partition count. ``concurrency`` is the number of calls each task
    keeps in flight.
    """
    if str(spark.sparkContext.getConf().get("spark.speculation", "false")).lower() == "true":
        raise ValueError("spark.speculation must be off: it would send deletes twice and miscount them")
    book = Ledger(spark, ledger or scratch_path(spark, "ledger"))
    begun = book.begun()
    if begun is None:
        override_seconds = run_time_value(spark, override_time)
        staged = stage_triples(spark, read_enriched(spark, run_folder), override_seconds)
        keys = stage_keys(spark, read_staged(spark, staged.path), parallelism)
        begun = {"folder": run_folder, "time": override_time, "lines": staged.lines, "stage": staged.path, "keys": keys}
        if publish:
            book.begin(begun)
    elif (begun["folder"], begun["time"]) != (run_folder, override_time):
        raise ValueError(f"the ledger {book.path} belongs to the run {begun['folder']} with time {begun['time']}")
    keys = spark.read.parquet(begun["keys"])
    if publish:
        send_deletes(keys, client_factory, book, concurrency, look)
        totals = book.totals()
    else:
        totals = book.count_present(keys, client_factory, concurrency)
    deleted = totals.get("deleted", 0)
    return _reported(StoreCleanupResult(deleted=deleted, skipped=begun["lines"] - deleted, lines=begun["lines"],
                                        sent=sum(totals.values()) if publish else 0, unknown=totals.get("unknown", 0),
                                        stage=begun["stage"], ledger=book.path if publish else None), quiet)


def store_outcome(spark: SparkSession, result: StoreCleanupResult) -> DataFrame:
    """(eventid, fingerprint, etltime, outcome): what came of each distinct key that was sent."""
    return Ledger(spark, result.ledger).outcomes().select(*MANIFEST_KEYS, "outcome")


def check_run_lines(spark: SparkSession, run_folder: str, out: str, override_time: str | None = None) -> dict:
    """F1/F2 over a whole run, without touching any manifest.

    Writes every line that would fail the job to ``out`` as parquet
    (``problem``, ``eventid``, ``file``, ``line`` number from 1 on, ``message`` with a
    bounded excerpt, ``value``) in one pass over the run and returns
    the counts per problem. With an override, field 2 is never read, so only
    malformed lines count.
    """
    run_time_value(spark, override_time)
    located_failures(spark, run_folder, override_time is not None).write.parquet(out)
    counts = spark.read.parquet(out).groupBy("problem").count().collect()
    return {r["problem"]: int(r["count"]) for r in counts}


def located_failures(spark: SparkSession, run_folder: str, override: bool = False) -> DataFrame:
    """(problem, eventid, file, line, message, value): the lines of a run that would fail the job, and where they stand.

    The run is read and parsed once; written are a few bytes for a good line, so that
    lines can be counted, and the whole of a failing one.
    """
    lines = read_enriched(spark, run_folder, positions=True).withColumn(ROW_ID, F.monotonically_increasing_id())
    path = scratch_path(spark, "checked")
    checked_lines(lines, override).select(FILE, BLOCK, ROW_ID, "problem", EVENT_ID, "message", "value").write.parquet(path)
    placed = line_positions(spark.read.parquet(path))
    return placed.where(F.col("problem").isNotNull()).select("problem", EVENT_ID, FILE, LINE_NUMBER, "message", "value")
