"""Registered queries: one per operator of the inventory, plus their SQL oracles.

Each query takes (spark, sf_dir), reads the whole ``events`` table of that
scale and returns a DataFrame. The SQL strings compute the same result from
the same table in plain SQL (DuckDB dialect), so the two can be compared row
for row. Output columns carry the same lower-case names on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keysweep.functions.timefmt import etl_epoch, run_time_seconds, run_time_value
from keysweep.operators.cleanup import (
    cleanup_summary,
    deleted_rows,
    event_outcome,
    key_violations,
    kept_rows,
    run_keys,
)
from keysweep.operators.triples import bad_timestamp_lines, event_triples, failing_lines, malformed_lines
from keysweep.plans.derived import (
    ORDERED_FILES,
    FolderStore,
    event_source,
    manifest_table,
    manifest_with_repeats,
    ordered_file_number,
    read_table,
    run_lines,
    write_folder_store,
    write_ordered_run_folder,
    write_run_folder,
)
from keysweep.plans.job import (
    located_failures,
    read_positioned,
    read_staged,
    run_cleanup,
    run_outcome,
    run_store_cleanup,
    stage_triples,
    store_outcome,
)
from keysweep.schemas import EVENT_ID, FILE, FINGERPRINT, LINE, LINE_NUMBER
from keysweep.session import scratch_path
from keysweep.sinks.snapshot import init_manifest
from keysweep.sources.enriched import read_enriched
from keysweep.sources.manifest import published_versions, read_commit, read_current

# Run time used by the override queries, and its epoch seconds in SQL.
OVERRIDE_TIME = "2024-01-15-00-00-00"
OVERRIDE_SECONDS = 1705276800


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def _triples(spark: SparkSession, events: DataFrame, override: str | None = None) -> DataFrame:
    return event_triples(run_lines(events), run_time_value(spark, override))


def _staged(spark: SparkSession, events: DataFrame, override: str | None = None) -> DataFrame:
    """The run's triples, every line parsed and checked once, read back from the stage."""
    return read_staged(spark, stage_triples(spark, run_lines(events), run_time_value(spark, override)).path)


def q_enriched_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = write_run_folder(spark, run_lines(_events(spark, sf_dir)))
    return read_enriched(spark, folder).select(F.md5(LINE).alias("line_md5"))


def q_enriched_scan_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = write_run_folder(spark, run_lines(_events(spark, sf_dir)), compression="gzip", gzip_suffix=True)
    return read_enriched(spark, folder).select(F.md5(LINE).alias("line_md5"))


def q_event_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _triples(spark, _events(spark, sf_dir))


def q_etl_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_source(_events(spark, sf_dir)).select("id", etl_epoch("etl_text").alias("etl"))


def q_triples_with_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _triples(spark, _events(spark, sf_dir), OVERRIDE_TIME)


def q_run_time_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_source(_events(spark, sf_dir)).select("id", run_time_seconds("run_text").alias("run_seconds"))


def q_malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = run_lines(_events(spark, sf_dir), variant="malformed", copies=False)
    return malformed_lines(lines).select(EVENT_ID, "n_fields")


def q_bad_timestamp_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = run_lines(_events(spark, sf_dir), variant="bad_timestamp", copies=False)
    return bad_timestamp_lines(lines).select(EVENT_ID, "etl_text")


def q_manifest_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return deleted_rows(manifest_table(events), _staged(spark, events))


def q_manifest_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return kept_rows(manifest_table(events), _staged(spark, events))


def q_event_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return event_outcome(_staged(spark, events), manifest_table(events))


def q_cleanup_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return cleanup_summary(manifest_table(events), _staged(spark, events))


def q_cleanup_with_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return deleted_rows(manifest_table(events, OVERRIDE_SECONDS), _staged(spark, events, OVERRIDE_TIME))


def q_kept_with_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return kept_rows(manifest_table(events, OVERRIDE_SECONDS), _staged(spark, events, OVERRIDE_TIME))


def q_summary_with_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job with an override: run folder, staging, publish, totals."""
    result, _ = _job(spark, sf_dir, OVERRIDE_TIME)
    return result.summary(spark)


def q_failing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = run_lines(_events(spark, sf_dir), variant="failing", copies=False)
    return failing_lines(lines).select("problem", EVENT_ID)


def q_store_deletes_sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_keys(_staged(spark, _events(spark, sf_dir)))


def _two_runs(spark: SparkSession, sf_dir: str, **layout: int) -> str:
    """Two disjoint parts of the events cleaned one after the other; the manifest's root."""
    events = _events(spark, sf_dir)
    root = scratch_path(spark, "manifest")
    init_manifest(spark, manifest_table(events), root, **layout)
    for part in (0, 1):
        folder = write_run_folder(spark, run_lines(events.where(F.col("event_id") % 2 == part)))
        run_cleanup(spark, folder, root, quiet=True)
    return root


def q_manifest_after_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_current(spark, _two_runs(spark, sf_dir))


def q_manifest_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over a manifest whose days of more than 1000 rows are cut into key buckets."""
    return read_current(spark, _two_runs(spark, sf_dir, bucket_rows=1000))


def q_committed_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the commits of two cleanups say about them."""
    root = _two_runs(spark, sf_dir)
    runs = {v: read_commit(spark, root, v).run for v in published_versions(spark, root)}
    rows = [(v, r["lines"], r["deleted"], r["skipped"]) for v, r in runs.items() if r]
    return spark.createDataFrame(rows, "version int, n_lines long, deleted_events long, skipped_events long")


def q_store_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run against a store that keeps a file for each row: the ledger's outcomes."""
    events = _events(spark, sf_dir)
    folder = write_folder_store(spark, manifest_table(events))
    result = run_store_cleanup(spark, write_run_folder(spark, run_lines(events)), lambda: FolderStore(folder), quiet=True)
    return store_outcome(spark, result)


def q_failing_lines_located(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = run_lines(_events(spark, sf_dir), variant="failing", copies=False, with_rid=True)
    found = located_failures(spark, write_ordered_run_folder(spark, lines))
    return found.select("problem", EVENT_ID, ordered_file_number(F.col(FILE)).alias("file_number"), LINE_NUMBER)


def q_line_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of a run folder with its file and its number there."""
    folder = write_ordered_run_folder(spark, run_lines(_events(spark, sf_dir), with_rid=True))
    staged = stage_triples(spark, read_enriched(spark, folder, positions=True))
    return read_positioned(spark, staged.path).select(
        EVENT_ID, FINGERPRINT, ordered_file_number(F.col(FILE)).alias("file_number"), LINE_NUMBER)


def q_manifest_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_violations(manifest_with_repeats(_events(spark, sf_dir)))


def _job(spark: SparkSession, sf_dir: str, override: str | None = None):
    """The whole job on files: run folder on disk, manifest version 1 -> 2."""
    events = _events(spark, sf_dir)
    folder = write_run_folder(spark, run_lines(events))
    root = scratch_path(spark, "manifest")
    init_manifest(spark, manifest_table(events, OVERRIDE_SECONDS if override else None), root)
    return run_cleanup(spark, folder, root, override_time=override, quiet=True), root


def q_manifest_after_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, root = _job(spark, sf_dir)
    return read_current(spark, root)


def q_cleanup_job_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    result, _ = _job(spark, sf_dir)
    return result.summary(spark)


def q_job_event_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    result, root = _job(spark, sf_dir)
    return run_outcome(spark, result, root)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "enriched_scan": q_enriched_scan,
    "enriched_scan_gzip": q_enriched_scan_gzip,
    "event_triples": q_event_triples,
    "etl_epoch": q_etl_epoch,
    "triples_with_override": q_triples_with_override,
    "run_time_seconds": q_run_time_seconds,
    "malformed_lines": q_malformed_lines,
    "bad_timestamp_lines": q_bad_timestamp_lines,
    "manifest_deleted": q_manifest_deleted,
    "manifest_kept": q_manifest_kept,
    "event_outcome": q_event_outcome,
    "cleanup_summary": q_cleanup_summary,
    "cleanup_with_override": q_cleanup_with_override,
    "manifest_key_violations": q_manifest_key_violations,
    "manifest_after_publish": q_manifest_after_publish,
    "cleanup_job_summary": q_cleanup_job_summary,
    "job_event_outcome": q_job_event_outcome,
    "kept_with_override": q_kept_with_override,
    "summary_with_override": q_summary_with_override,
    "failing_lines": q_failing_lines,
    "store_deletes_sent": q_store_deletes_sent,
    "manifest_after_two_runs": q_manifest_after_two_runs,
    "manifest_in_buckets": q_manifest_in_buckets,
    "committed_reports": q_committed_reports,
    "store_outcomes": q_store_outcomes,
    "failing_lines_located": q_failing_lines_located,
    "line_positions": q_line_positions,
}

# ---------------------------------------------------------------------------
# SQL oracles (DuckDB over the registered ``events`` view)
# ---------------------------------------------------------------------------
_SRC = """
src AS (
  SELECT event_id AS id,
         md5('ev-' || CAST(event_id AS VARCHAR)) AS eventid,
         md5(CAST(user_id AS VARCHAR) || '|' || event_type || '|' || props) AS fingerprint,
         CASE WHEN event_id % 3 = 1 THEN strftime(h, '%Y-%-m-%-d %-H:%-M:%-S') ELSE strftime(h, '%Y-%m-%d %H:%M:%S') END AS hour_text,
         CASE event_id % 4 WHEN 1 THEN '.5' WHEN 2 THEN '.25' WHEN 3 THEN '.999' ELSE '.000' END AS frac,
         CAST(epoch(h) AS INTEGER) AS run_seconds,
         CAST(CASE WHEN epoch(h) < 0 AND event_id % 4 <> 0 THEN epoch(h) + 1 ELSE epoch(h) END AS INTEGER) AS etl
  FROM (SELECT *, CASE WHEN event_id % 19 = 0 THEN date_trunc('hour', ts) + INTERVAL 1 HOUR - INTERVAL 60 YEARS
                       ELSE date_trunc('hour', ts) + INTERVAL 1 HOUR END AS h FROM events)),
lined AS (
  SELECT *, concat_ws(chr(9), 'app', 'web', hour_text || frac, '', '', 'ev', eventid,
                      repeat(chr(9), 121), fingerprint, '') AS line
  FROM src),
trip AS (
  SELECT id, 0 AS copy, eventid, fingerprint, etl AS etltstamp FROM src
  UNION ALL
  SELECT id, 1 AS copy, eventid, fingerprint, etl AS etltstamp FROM src WHERE id % 7 = 0),
man AS (
  SELECT eventid, fingerprint,
         CASE WHEN id % 6 = 0 THEN etl - 86400 ELSE etl END AS etltime
  FROM src WHERE id % 6 <> 3
  UNION ALL
  SELECT md5('old-' || CAST(event_id AS VARCHAR)), md5('x'), 0 FROM events WHERE event_id % 5 = 0),
orphan AS (
  SELECT eventid, fingerprint,
         CASE WHEN id % 4 = 1 THEN OVERRIDE WHEN id % 6 = 0 THEN etl - 86400 ELSE etl END AS etltime
  FROM src WHERE id % 6 <> 3
  UNION ALL
  SELECT md5('old-' || CAST(event_id AS VARCHAR)), md5('x'), 0 FROM events WHERE event_id % 5 = 0),
outcome AS (
  SELECT t.eventid, t.fingerprint, t.etltstamp,
         (m.eventid IS NOT NULL AND row_number() OVER (
             PARTITION BY t.eventid, t.fingerprint, t.etltstamp ORDER BY t.copy) = 1) AS deleted
  FROM trip t LEFT JOIN man m
    ON m.eventid = t.eventid AND m.fingerprint = t.fingerprint AND m.etltime = t.etltstamp)
"""


def _sql(body: str) -> str:
    return "WITH " + _SRC.strip().replace("OVERRIDE", str(OVERRIDE_SECONDS)) + "\n" + body.strip()


_KEPT = """
SELECT m.eventid, m.fingerprint, m.etltime FROM man m
WHERE NOT EXISTS (SELECT 1 FROM trip t WHERE t.eventid = m.eventid AND t.fingerprint = m.fingerprint
                  AND t.etltstamp = m.etltime)"""

_SUMMARY = """
SELECT count(*) FILTER (WHERE deleted) AS deleted_events,
       count(*) FILTER (WHERE NOT deleted) AS skipped_events
FROM outcome"""

_LINES_MD5 = """
SELECT md5(line) AS line_md5 FROM lined
UNION ALL
SELECT md5(line) AS line_md5 FROM lined WHERE id % 7 = 0"""

ORACLE_SQL: dict[str, str] = {
    "enriched_scan": _sql(_LINES_MD5),
    "enriched_scan_gzip": _sql(_LINES_MD5),
    "event_triples": _sql("SELECT eventid, fingerprint, etltstamp FROM trip"),
    "etl_epoch": _sql("SELECT id, etl FROM src"),
    "triples_with_override": _sql(f"SELECT eventid, fingerprint, {OVERRIDE_SECONDS} AS etltstamp FROM trip"),
    "run_time_seconds": _sql("SELECT id, run_seconds FROM src"),
    "malformed_lines": _sql("SELECT eventid, 7 AS n_fields FROM src WHERE id % 11 = 0 AND id % 13 <> 0"),
    "bad_timestamp_lines": _sql("SELECT eventid, hour_text AS etl_text FROM src WHERE id % 17 = 0"),
    "manifest_deleted": _sql("""
SELECT m.eventid, m.fingerprint, m.etltime FROM man m
WHERE EXISTS (SELECT 1 FROM trip t WHERE t.eventid = m.eventid AND t.fingerprint = m.fingerprint
              AND t.etltstamp = m.etltime)"""),
    "manifest_kept": _sql(_KEPT),
    "event_outcome": _sql("SELECT eventid, fingerprint, etltstamp, deleted FROM outcome"),
    "cleanup_summary": _sql(_SUMMARY),
    "cleanup_with_override": _sql(f"""
SELECT m.eventid, m.fingerprint, m.etltime FROM orphan m
WHERE m.etltime = {OVERRIDE_SECONDS}
  AND EXISTS (SELECT 1 FROM trip t WHERE t.eventid = m.eventid AND t.fingerprint = m.fingerprint)"""),
    "manifest_key_violations": _sql("""
, man2 AS (SELECT eventid, fingerprint, etltime FROM man
           UNION ALL
           SELECT eventid, fingerprint, etltime + 1 FROM man WHERE etltime % 7200 = 0)
SELECT eventid, fingerprint, count(*) AS n FROM man2 GROUP BY eventid, fingerprint HAVING count(*) > 1"""),
    "manifest_after_publish": _sql(_KEPT),
    "cleanup_job_summary": _sql(_SUMMARY),
    "job_event_outcome": _sql("SELECT eventid, fingerprint, etltstamp, deleted FROM outcome"),
    "kept_with_override": _sql(f"""
SELECT m.eventid, m.fingerprint, m.etltime FROM orphan m
WHERE NOT (m.etltime = {OVERRIDE_SECONDS}
           AND EXISTS (SELECT 1 FROM trip t WHERE t.eventid = m.eventid AND t.fingerprint = m.fingerprint))"""),
    "summary_with_override": _sql(f"""
SELECT gone AS deleted_events, (SELECT count(*) FROM trip) - gone AS skipped_events
FROM (SELECT count(*) AS gone FROM orphan m WHERE m.etltime = {OVERRIDE_SECONDS}
      AND EXISTS (SELECT 1 FROM trip t WHERE t.eventid = m.eventid AND t.fingerprint = m.fingerprint))"""),
    "failing_lines": _sql("""
SELECT CASE WHEN id % 11 = 0 AND id % 13 <> 0 THEN 'malformed' WHEN id % 17 = 0 THEN 'bad_timestamp' ELSE 'out_of_range' END AS problem, eventid
FROM src WHERE (id % 11 = 0 AND id % 13 <> 0) OR id % 17 = 0 OR id % 23 = 0"""),
    "store_deletes_sent": _sql("SELECT DISTINCT eventid, fingerprint, etltstamp AS etltime FROM trip"),
    "manifest_after_two_runs": _sql(_KEPT),
    "manifest_in_buckets": _sql(_KEPT),
    "committed_reports": _sql("""
SELECT CAST(2 + id % 2 AS INTEGER) AS version, count(*) AS n_lines,
       count(*) FILTER (copy = 0 AND found) AS deleted_events, count(*) FILTER (NOT (copy = 0 AND found)) AS skipped_events
FROM (SELECT t.id, t.copy, m.eventid IS NOT NULL AS found FROM trip t LEFT JOIN man m
      ON m.eventid = t.eventid AND m.fingerprint = t.fingerprint AND m.etltime = t.etltstamp)
GROUP BY id % 2"""),
    "store_outcomes": _sql("""
SELECT DISTINCT t.eventid, t.fingerprint, t.etltstamp AS etltime,
       CASE WHEN m.eventid IS NOT NULL THEN 'deleted' ELSE 'skipped' END AS outcome
FROM trip t LEFT JOIN man m ON m.eventid = t.eventid AND m.fingerprint = t.fingerprint AND m.etltime = t.etltstamp"""),
    "failing_lines_located": _sql(f"""
SELECT problem, eventid, file_number, line FROM (
  SELECT id, eventid, CASE WHEN id % 11 = 0 AND id % 13 <> 0 THEN 'malformed' WHEN id % 17 = 0 THEN 'bad_timestamp'
                           WHEN id % 23 = 0 THEN 'out_of_range' END AS problem,
         CAST(id % {ORDERED_FILES} AS INTEGER) AS file_number, row_number() OVER (PARTITION BY id % {ORDERED_FILES} ORDER BY id) AS line FROM src)
WHERE problem IS NOT NULL"""),
    "line_positions": _sql(f"""
SELECT eventid, fingerprint, CAST(id % {ORDERED_FILES} AS INTEGER) AS file_number,
       row_number() OVER (PARTITION BY id % {ORDERED_FILES} ORDER BY id, copy) AS line FROM trip"""),
}
