"""K2: apply the deletes to an external keyed store.

For a manifest that lives in a remote key-value table instead of parquet.
The caller injects ``client_factory``; each task builds its own client (store
clients are rarely serialisable) and sends one conditional delete per row.

A client must offer ``delete(event_id, fingerprint, etl_time) -> bool``
(True when the row was removed, False when its condition failed) and may
offer ``present`` (the same arguments and answer, without removing) and ``close()``.

:func:`send_deletes` keeps a :class:`Ledger`: every call's outcome is a row that Spark
commits with its task, and totals are counted over committed rows, not over counters
that a failed task takes with it. A call that raises is a row too (``failed``); after
``TASK_ERRORS`` of them a task sends nothing more. Keys that failed or weren't sent are
sent in the next round, up to ``ROUNDS`` rounds, after which the job fails with the store's error. What may have been sent
before without an outcome on record (a call that raised, a task or a driver that
died) is known as such: when its repeated delete finds nothing, the outcome is
``unknown`` instead of ``skipped``. A client with ``present`` removes that doubt: with
``look`` every key is looked up, and the answers are committed, before the first delete.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keysweep.schemas import ETL_TIME, EVENT_ID, FINGERPRINT, MANIFEST_KEYS
from keysweep.sources import fs

#: Rounds of sending before a store that keeps raising fails the job.
ROUNDS = 4
#: Calls that may raise in a task before it stops sending for this round.
TASK_ERRORS = 3
DELETED, SKIPPED, UNKNOWN, FAILED = "deleted", "skipped", "unknown", "failed"
_ERROR_CHARS = 500


class StoreError(RuntimeError):
    pass


class DeleteClient(Protocol):
    def delete(self, event_id: str, fingerprint: str, etl_time: int) -> bool: ...


def _chunks(rows: Iterator, size: int) -> Iterator[list]:
    chunk = []
    for row in rows:
        chunk.append(row)
        if len(chunk) == size:
            yield chunk
            chunk = []
    if chunk:
        yield chunk


def delete_from_store(rows: DataFrame, client_factory: Callable[[], DeleteClient],
                      concurrency: int = 1) -> tuple[int, int, int]:
    """Send every row of ``rows`` (eventid, fingerprint, etltime) to the store, without a ledger.

    Returns (deleted, skipped, retried). The first two are what the client
    reported to the attempts that succeeded: Spark drops the counters of a
    failed attempt, while its deletes stay, so its retry sees them as skipped.
    ``retried`` counts the tasks that succeeded only on a later attempt; when
    it isn't 0, ``deleted`` is a lower bound.
    With ``concurrency`` > 1 each task keeps that many calls in flight on a
    thread pool (the client must then be thread-safe); rows are taken in
    fixed-size chunks, so a partition is never held in memory whole.
    """
    sc = rows.sparkSession.sparkContext
    deleted = sc.accumulator(0)
    skipped = sc.accumulator(0)
    retried = sc.accumulator(0)
    chunk_rows = max(1, concurrency) * 64

    def send(partition):
        client = None
        if TaskContext.get().attemptNumber() > 0:
            retried.add(1)
        pool = ThreadPoolExecutor(concurrency) if concurrency > 1 else None
        try:
            for chunk in _chunks(partition, chunk_rows):
                if client is None:
                    client = client_factory()
                call = client.delete
                keys = [(r[EVENT_ID], r[FINGERPRINT], r[ETL_TIME]) for r in chunk]
                if pool is None:
                    results = [call(*k) for k in keys]
                else:
                    results = list(pool.map(lambda k: call(*k), keys))
                ok = sum(1 for x in results if x)
                deleted.add(ok)
                skipped.add(len(results) - ok)
        finally:
            if pool is not None:
                pool.shutdown(wait=True)
            close = getattr(client, "close", None)
            if close is not None:
                close()

    rows.select(EVENT_ID, FINGERPRINT, ETL_TIME).foreachPartition(send)
    return deleted.value, skipped.value, retried.value


class Ledger:
    """Outcomes of a run's deletes, in a folder of their own::

        <path>/_begun              the run, its lines and the folder of its staged keys
        <path>/_sending-00000002   round 2 has begun to send
        <path>/looked              (key, present) of every key, from before the first delete
        <path>/round-00000002      (key, outcome, error) of round 2; counts once it is committed
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _names(self) -> list[str]:
        return fs.list_names(self.spark, self.path)

    def begun(self) -> dict | None:
        """What :meth:`begin` wrote, or None for a new ledger."""
        if "_begun" not in self._names():
            return None
        return json.loads(fs.read_small(self.spark, f"{self.path}/_begun"))

    def begin(self, about: dict) -> None:
        if not fs.create_marker(self.spark, f"{self.path}/_begun", json.dumps(about)):
            raise StoreError(f"another job uses the ledger {self.path}")

    def committed(self) -> list[str]:
        return [f"{self.path}/{n}" for n in sorted(self._names())
                if n.startswith("round-") and fs.exists(self.spark, f"{self.path}/{n}/_SUCCESS")]

    def lost_rounds(self) -> bool:
        """True when a round began to send and its outcomes were never committed."""
        done = {p.rpartition("-")[2] for p in self.committed()}
        return any(n.startswith("_sending-") and n.rpartition("-")[2] not in done for n in self._names())

    def next_round(self) -> str:
        began = [int(n.rpartition("-")[2]) for n in self._names() if n.startswith("_sending-")]
        return f"{max(began, default=-1) + 1:08d}"

    def rows(self) -> DataFrame:
        """All committed calls: (eventid, fingerprint, etltime, outcome, error)."""
        paths = self.committed()
        schema = f"{_KEY_SCHEMA}, outcome string, error string"
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def outcomes(self) -> DataFrame:
        """One row for each key whose outcome is on record."""
        return self.rows().where(F.col("outcome") != FAILED)

    def totals(self) -> dict[str, int]:
        return {r["outcome"]: r["count"] for r in self.outcomes().groupBy("outcome").count().collect()}

    def looked(self, keys: DataFrame, client_factory, concurrency: int = 1) -> DataFrame:
        """(key, present), written before the first delete and never again."""
        path = f"{self.path}/looked"
        if not fs.exists(self.spark, f"{path}/_SUCCESS"):
            if any(n.startswith("_sending-") for n in self._names()):
                raise StoreError(f"{self.path} has sent deletes already; it's too late to look")
            keys.select(*MANIFEST_KEYS).mapInArrow(_calls(client_factory, concurrency, "present"), f"{_KEY_SCHEMA}, present boolean"
                                                   ).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(f"{_KEY_SCHEMA}, present boolean").parquet(path)

    def count_present(self, keys: DataFrame, client_factory, concurrency: int = 1) -> dict[str, int]:
        """Totals that sending would give, without sending."""
        seen = self.looked(keys, client_factory, concurrency).groupBy("present").count().collect()
        return {DELETED if r["present"] else SKIPPED: r["count"] for r in seen}


_KEY_SCHEMA = f"{EVENT_ID} string, {FINGERPRINT} string, {ETL_TIME} int"


def _calls(client_factory: Callable[[], DeleteClient], concurrency: int, method: str):
    """Batches of keys -> batches of keys and the answers; ``method``: ``present`` or ``delete``.

    Rows of keys to delete also have ``unsure`` (sent before, outcome not on record)
    and ``present`` (null: nobody looked). After ``TASK_ERRORS`` deletes that raised, a
    task leaves the rest of its keys without rows.
    """
    size = max(1, concurrency) * 64
    deleting = method == "delete"

    def outcome(answer, unsure: bool, present: bool | None) -> str:
        if isinstance(answer, Exception):
            return FAILED
        if answer or (present and unsure):    # it was there, and nobody but this job deletes
            return DELETED
        return UNKNOWN if unsure and present is None else SKIPPED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client, errors = None, 0
        again = TaskContext.get().attemptNumber() > 0
        pool = ThreadPoolExecutor(concurrency) if concurrency > 1 else None

        def call(key):
            try:
                return getattr(client, method)(*key)
            except Exception as err:   # an outcome like others: the ledger says which key, and the round sends it again
                if not deleting:
                    raise
                return err

        try:
            for batch in batches:
                for at in range(0, batch.num_rows, size):
                    part = batch.slice(at, size)
                    columns = [c.to_pylist() for c in part.columns]
                    keys = list(zip(*columns[:3]))
                    if client is None:
                        client = client_factory()
                    if not deleting:
                        answers = list(map(call, keys)) if pool is None else list(pool.map(call, keys))
                        yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(map(bool, answers), pa.bool_())],
                                                         names=[*part.schema.names[:3], "present"])
                        continue
                    todo = [k for k, p in zip(keys, columns[4]) if p is not False]
                    if pool is None:
                        answers = []
                        for key in todo:
                            answers.append(call(key))
                            errors += isinstance(answers[-1], Exception)
                            if errors >= TASK_ERRORS:
                                break
                    else:
                        answers = list(pool.map(call, todo))
                        errors += sum(isinstance(a, Exception) for a in answers)
                    by_key = dict(zip(todo, answers))
                    rows = []
                    for key, unsure, present in zip(keys, *columns[3:5]):
                        if present is False:
                            rows.append((*key, SKIPPED, None))
                        elif key in by_key:
                            answer = by_key[key]
                            error = f"{type(answer).__name__}: {answer}"[:_ERROR_CHARS] if isinstance(answer, Exception) else None
                            rows.append((*key, outcome(answer, unsure or again, present), error))
                    types = [*[part.schema.field(i).type for i in range(3)], pa.string(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)],
                                                     names=[*part.schema.names[:3], "outcome", "error"])
                    if errors >= TASK_ERRORS:
                        return
        finally:
            if pool is not None:
                pool.shutdown(wait=True)
            close = getattr(client, "close", None)
            if close is not None:
                close()

    return run


def send_deletes(keys: DataFrame, client_factory: Callable[[], DeleteClient], ledger: Ledger, concurrency: int = 1,
                 look: bool = False, rounds: int = ROUNDS) -> None:
    """Send every key of ``keys`` (distinct, read from files) whose outcome isn't on record yet.

    Each round sends keys read straight from files, so no stage above it can make it
    run again; a task that does run again knows it from its attempt number.
    """
    spark = ledger.spark
    columns = [F.col(c) for c in MANIFEST_KEYS]
    for _ in range(rounds):
        todo, lost = keys.select(*columns), ledger.lost_rounds()
        if ledger.committed():
            failed = ledger.rows().where(F.col("outcome") == FAILED).select(*columns).distinct().withColumn("unsure", F.lit(True))
            todo = todo.join(ledger.outcomes().select(*columns), list(MANIFEST_KEYS), "left_anti").join(failed, list(MANIFEST_KEYS), "left")
            todo = todo.select(*columns, (F.coalesce("unsure", F.lit(False)) | F.lit(lost)).alias("unsure"))
        else:
            todo = todo.select(*columns, F.lit(lost).alias("unsure"))
        if look:
            todo = todo.join(ledger.looked(keys, client_factory, concurrency), list(MANIFEST_KEYS), "left")
        else:
            todo = todo.withColumn("present", F.lit(None).cast("boolean"))
        number = ledger.next_round()
        staged = f"{ledger.path}/keys-{number}"
        todo.select(*columns, "unsure", "present").write.parquet(staged)
        todo = spark.read.schema(f"{_KEY_SCHEMA}, unsure boolean, present boolean").parquet(staged)
        if not fs.create_marker(spark, f"{ledger.path}/_sending-{number}", "sending"):
            raise StoreError(f"another job sends for the ledger {ledger.path}")
        todo.mapInArrow(_calls(client_factory, concurrency, "delete"), f"{_KEY_SCHEMA}, outcome string, error string"
                        ).write.parquet(f"{ledger.path}/round-{number}")
        errors = spark.read.parquet(f"{ledger.path}/round-{number}").where(F.col("outcome") == FAILED)
        error = errors.select("error").first()
        if error is None:
            return
    raise StoreError(f"the store failed in {rounds} rounds ({error['error']}); outcomes so far are in {ledger.path}")
