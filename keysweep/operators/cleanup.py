"""J1-J3, A1-A4: the conditional delete as set operations.

A manifest row is deleted when an event of the run carries its key pair
*and* its ETL time (equality on all three). A row of an earlier batch has a
different ETL time and stays; a null ETL time never matches.

Plan shape, chosen for a large manifest and a run of any size:

* Semi/anti joins on three keys. Broadcasting the run side is an explicit,
  size-checked choice of the caller (``broadcast=True``); otherwise Spark
  plans a sort-merge join and AQE may still switch with measured sizes.
* A shuffled run side is reduced to distinct triples first. That
  aggregation is partial (map-side), so a triple repeated by a bot
  collapses before the shuffle, and its output is already hash-partitioned
  on the join keys.
* Only manifest rows of the run's ETL days can match; given the days, the
  manifest is filtered before any shuffle and rows of other days bypass the
  join. One old line adds its own day, not the days between.
* The inputs are staged triples (:func:`keysweep.plans.job.stage_triples`):
  staging computes every column of every line, so a malformed line fails
  there, whatever these joins would read. Over a lazy projection of raw lines
  a join may skip lines and so their failures.
* The per-event outcome (J3) picks one winner per triple with ``min(rid)``
  (a partial aggregate), then joins back on the unique ``rid``: no window
  over a triple, so a hot triple never lands in a single task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keysweep.schemas import DAY_SECONDS, ETL_TIME, ETL_TSTAMP, EVENT_ID, FINGERPRINT, MANIFEST_KEYS, ROW_ID, TRIPLE_KEYS


def run_keys(triples: DataFrame, broadcast: bool = False) -> DataFrame:
    """(eventid, fingerprint, etltime) of a run, named like the manifest.

    Shuffled: made distinct first, so repeats collapse map-side and a hot
    triple cannot skew the join. Broadcast: taken as is; a hash relation
    holds repeats fine, the caller's size check already counts every line,
    and the aggregation would only add a shuffle stage.
    """
    keys = triples.select(EVENT_ID, FINGERPRINT, F.col(ETL_TSTAMP).alias(ETL_TIME))
    return F.broadcast(keys) if broadcast else keys.distinct()


def _manifest(manifest: DataFrame) -> DataFrame:
    return manifest.select(*MANIFEST_KEYS)


def day_filter(etl: Column, etl_days: Iterable[int]) -> Column:
    """True for ETL times (epoch seconds) on one of the days (day numbers since 1970).

    Adjacent days become one range of plain comparisons, which a parquet scan
    can push down. False or null for a null ETL time.
    """
    ranges: list[list[int]] = []
    for day in sorted(set(etl_days)):
        if ranges and day == ranges[-1][1] + 1:
            ranges[-1][1] = day
        else:
            ranges.append([day, day])
    hit = F.lit(False)
    for first, last in ranges:
        hit = hit | etl.between(F.lit(first * DAY_SECONDS), F.lit(last * DAY_SECONDS + DAY_SECONDS - 1))
    return hit


def _candidates(manifest: DataFrame, etl_days: Iterable[int] | None) -> DataFrame:
    rows = _manifest(manifest)
    return rows if etl_days is None else rows.where(day_filter(F.col(ETL_TIME), etl_days))


def deleted_rows(manifest: DataFrame, triples: DataFrame, broadcast: bool = False,
                 etl_days: Iterable[int] | None = None) -> DataFrame:
    """J1: manifest rows whose key pair and ETL time occur in the run.

    With ``etl_days`` (all days of the run, or more) the manifest is filtered
    to them before the join.
    """
    candidates = _candidates(manifest, etl_days)
    return candidates.join(run_keys(triples, broadcast), list(MANIFEST_KEYS), "left_semi")


def kept_rows(manifest: DataFrame, triples: DataFrame, broadcast: bool = False,
              etl_days: Iterable[int] | None = None) -> DataFrame:
    """J2: the manifest after the cleanup (complement of J1).

    With ``etl_days`` and a shuffled run side, rows of other days (and rows
    without an ETL time) pass through untouched, with no shuffle; only rows of
    the run's days meet the join.
    """
    rows = _manifest(manifest)
    keys = list(MANIFEST_KEYS)
    if broadcast or etl_days is None:
        # Broadcast: nothing is shuffled anyway, and one scan beats the split's two.
        return rows.join(run_keys(triples, broadcast), keys, "left_anti")
    hit = F.coalesce(day_filter(F.col(ETL_TIME), etl_days), F.lit(False))
    touched = _candidates(manifest, etl_days).join(run_keys(triples, broadcast), keys, "left_anti")
    return rows.where(~hit).unionByName(touched)


def event_outcome(triples: DataFrame, manifest: DataFrame, etl_days: Iterable[int] | None = None) -> DataFrame:
    """J3: one row per event with ``deleted`` = the result of its delete call.

    Of repeated triples the one with the smallest ``rid`` (read first) is the
    one whose delete succeeds; the others are skipped, as a second delete of
    the same row fails. ``rid`` must be unique and fixed per line, as staged
    triples have it. ``etl_days`` prunes the manifest as in
    :func:`deleted_rows`.
    """
    if ROW_ID not in triples.columns:
        raise ValueError(f"event_outcome needs the {ROW_ID} column of staged triples")
    keys = list(MANIFEST_KEYS)
    winners = (triples.groupBy(*TRIPLE_KEYS).agg(F.min(ROW_ID).alias(ROW_ID))
                      .withColumnRenamed(ETL_TSTAMP, ETL_TIME))
    # An inner join, not a semi join on top of ``winners``: Catalyst would
    # push a semi join below the aggregate and shuffle raw triples by key (a
    # hot triple in one task). ``distinct`` on the unique rid absorbs a key
    # pair stored twice in the manifest.
    matched = (_candidates(manifest, etl_days).join(winners, keys, "inner")
               .select(ROW_ID).distinct()
               .select(ROW_ID, F.lit(True).alias("deleted")))
    return (triples.join(matched, ROW_ID, "left")
                   .select(*TRIPLE_KEYS, F.coalesce(F.col("deleted"), F.lit(False)).alias("deleted")))


def cleanup_summary(manifest: DataFrame, triples: DataFrame, broadcast: bool = False,
                    etl_days: Iterable[int] | None = None) -> DataFrame:
    """A1-A3: one row (deleted_events, skipped_events).

    deleted = manifest rows removed (J1); skipped = lines - deleted. Both
    counts come from one global aggregate over a union, so the lines are
    only counted (partial aggregate), never shuffled. The manifest holds each
    key pair once (A4), so deleted never exceeds the lines.
    """
    lines = triples.select(F.lit(False).alias("is_deleted"))
    deleted = deleted_rows(manifest, triples, broadcast, etl_days).select(F.lit(True).alias("is_deleted"))
    flag = F.col("is_deleted")
    return lines.unionByName(deleted).agg(
        F.count_if(flag).alias("deleted_events"),
        (F.count_if(~flag) - F.count_if(flag)).alias("skipped_events"),
    )


def key_violations(manifest: DataFrame) -> DataFrame:
    """A4: key pairs stored more than once (the store's key forbids it; parquet does not)."""
    return (manifest.groupBy(EVENT_ID, FINGERPRINT)
                    .agg(F.count(F.lit(1)).alias("n"))
                    .where(F.col("n") > 1))
