"""Run lines and manifests derived from the ``events`` table.

The given test data has no enriched runs, so every event becomes one
131-field enriched line; its hour (end of the hour, UTC) plays the ETL time
of the run that wrote it. All rules are plain column expressions, so the
derived tables grow with ``events`` and Spark computes them in parallel.

Rules (the same ones the SQL side of the query catalog uses)::

    eventid      md5('ev-' || event_id)
    fingerprint  md5(user_id || '|' || event_type || '|' || props)
    etl          end of the event's hour, epoch seconds; event_id % 19 = 0: sixty years earlier
    etl text     event_id % 3 = 1: no leading zeros; fraction by event_id % 4: .000 .5 .25 .999
                 (a fraction before 1970 truncates toward zero: one second later)
    line         app, web, etl text, '', '', ev, eventid, 122 blank fields, fingerprint, ''
    copies       events with event_id % 7 = 0 occur twice in a run
    manifest     event_id % 6 = 3 absent; event_id % 6 = 0 one day earlier;
                 plus one unrelated row (md5('old-' || id), md5('x'), 0) per event_id % 5 = 0
    malformed    event_id % 11 = 0: fields 129 and 130 blank (fails);
                 event_id % 13 = 0 (wins): field 129 blank, field 130 filled (valid)
    bad time     event_id % 17 = 0: ETL timestamp without milliseconds
    failing      the malformed and bad-time rules, and event_id % 23 = 0: year 2040 (out of range)
    orphan       manifest for override runs: event_id % 4 = 1 stored with the override time
"""

from __future__ import annotations

import hashlib
import os
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keysweep.functions.pinning import pinned
from keysweep.schemas import ETL_TIME, EVENT_ID, EVENT_ID_FIELD, FIELD_SEP, FINGERPRINT, FINGERPRINT_FIELD, LINE, ROW_ID
from keysweep.session import scratch_path
from keysweep.sources import fs

_BLANK_RUN = FINGERPRINT_FIELD - EVENT_ID_FIELD - 2   # tabs between the two separators


# Columns of the given ``events`` table that the derivation reads (declared,
# not inferred: no schema-inference job per read).
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("props", T.StringType()),
])
TABLE_SCHEMAS = {"events": EVENTS}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _epoch_seconds(ts: Column) -> Column:
    """Epoch seconds of a zone-free timestamp read as UTC (whole seconds)."""
    return F.unix_seconds(F.make_timestamp(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                                           F.minute(ts), F.second(ts), F.lit("UTC")))


def _hour_end() -> Column:
    """End of the event's hour (column ``ts``) as a zone-free timestamp."""
    ts = F.col("ts").cast("timestamp_ntz")
    start = F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0))
    return start + F.expr("INTERVAL 1 HOUR")


def event_source(events: DataFrame) -> DataFrame:
    """(id, eventid, fingerprint, etl_text, run_text, run_seconds, etl) per event.

    The hour is pinned: joins on the derived times would otherwise repeat its whole
    derivation in every condition pushed into the scan.
    """
    id_ = F.col("event_id")
    hour = F.when(id_ % 19 == 0, _hour_end() - F.expr("INTERVAL 60 YEARS")).otherwise(_hour_end())
    events = events.select("event_id", "user_id", "event_type", "props", pinned(hour).alias("_hour_end"))
    hour_end = F.col("_hour_end")
    padded = F.date_format(hour_end, "yyyy-MM-dd HH:mm:ss")
    stamp = F.when(id_ % 3 == 1, F.date_format(hour_end, "yyyy-M-d H:m:s")).otherwise(padded)
    fraction = F.when(id_ % 4 == 1, ".5").when(id_ % 4 == 2, ".25").when(id_ % 4 == 3, ".999").otherwise(".000")
    seconds = _epoch_seconds(hour_end)
    truncated = F.when((seconds < 0) & (id_ % 4 != 0), seconds + 1).otherwise(seconds)
    return events.select(
        id_.alias("id"),
        F.md5(F.concat(F.lit("ev-"), id_.cast("string"))).alias(EVENT_ID),
        F.md5(F.concat(F.col("user_id").cast("string"), F.lit("|"), F.col("event_type"), F.lit("|"),
                       F.col("props"))).alias(FINGERPRINT),
        F.concat(stamp, fraction).alias("etl_text"),
        F.date_format(hour_end, "yyyy-MM-dd-HH-mm-ss").alias("run_text"),
        seconds.cast("int").alias("run_seconds"),
        truncated.cast("int").alias("etl"),
    )


def enriched_line(etl_text: Column, eventid: Column, fingerprint: Column, last: Column | None = None) -> Column:
    """131 tab-separated fields: 2 = etl text, 6 = event id, 129 = fingerprint."""
    return F.concat_ws(FIELD_SEP, F.lit("app"), F.lit("web"), etl_text, F.lit(""), F.lit(""), F.lit("ev"),
                       eventid, F.lit(FIELD_SEP * _BLANK_RUN), fingerprint,
                       F.lit("") if last is None else last)


def run_lines(events: DataFrame, variant: str = "clean", copies: bool = True, with_rid: bool = False) -> DataFrame:
    """Enriched lines of the events: DataFrame[value STRING (, rid BIGINT)].

    ``variant`` is ``clean``, ``malformed``, ``bad_timestamp`` or ``failing``. ``rid`` is
    ``2 * event_id + copy``: unique, and fixed by the data whatever the
    partitioning, as the per-event outcome needs.
    """
    src = event_source(events)
    id_ = F.col("id")
    etl_text, eventid, fingerprint, last = F.col("etl_text"), F.col(EVENT_ID), F.col(FINGERPRINT), F.lit("")
    if variant in ("malformed", "failing"):
        blank_fp = (id_ % 13 == 0) | (id_ % 11 == 0)
        fingerprint = F.when(blank_fp, F.lit("")).otherwise(fingerprint)
        last = F.when(id_ % 13 == 0, F.lit("filled")).otherwise(F.lit(""))
    if variant == "failing":
        etl_text = F.when(id_ % 23 == 0, F.lit("2040-01-01 00:00:00.000")).otherwise(etl_text)
    if variant in ("bad_timestamp", "failing"):
        etl_text = F.when(id_ % 17 == 0, F.substring_index(etl_text, ".", 1)).otherwise(etl_text)
    if variant not in ("clean", "malformed", "bad_timestamp", "failing"):
        raise ValueError(f"unknown variant {variant!r}")
    lines = src.select(id_, enriched_line(etl_text, eventid, fingerprint, last).alias(LINE))
    if copies:
        repeat = F.sequence(F.lit(0), F.when(id_ % 7 == 0, F.lit(1)).otherwise(F.lit(0)))
        lines = lines.select(id_, LINE, F.explode(repeat).alias("copy"))
    else:
        lines = lines.withColumn("copy", F.lit(0))
    if with_rid:
        return lines.select(LINE, (id_ * 2 + F.col("copy")).alias(ROW_ID))
    return lines.select(LINE)


def _rows(*candidates: Column) -> Column:
    """Explode the non-null structs among ``candidates`` into rows of their fields."""
    return F.inline(F.array_compact(F.array(*candidates)))


def manifest_table(events: DataFrame, orphan_time: int | None = None) -> DataFrame:
    """Manifest written by the runs of these events, some rows older or missing.

    With ``orphan_time`` every fourth event's row has that ETL time.

    One pass: each event yields its own row (unless absent) and, for every
    fifth event, one unrelated row of an old batch. (A union of two scans
    would let the optimizer copy the constant columns of the unrelated rows
    into filters on the other side of a join.)
    """
    src = event_source(events)
    id_ = F.col("id")
    written = F.when(id_ % 6 != 3, F.struct(
        F.col(EVENT_ID).alias(EVENT_ID),
        F.col(FINGERPRINT).alias(FINGERPRINT),
        (F.when(id_ % 4 == 1, F.lit(orphan_time)) if orphan_time is not None else F.when(F.lit(False), F.lit(0)))
        .when(id_ % 6 == 0, F.col("etl") - 86400).otherwise(F.col("etl")).cast("int").alias(ETL_TIME)))
    unrelated = F.when(id_ % 5 == 0, F.struct(
        F.md5(F.concat(F.lit("old-"), id_.cast("string"))).alias(EVENT_ID),
        F.md5(F.lit("x")).alias(FINGERPRINT),
        F.lit(0).cast("int").alias(ETL_TIME)))
    return src.select(_rows(written, unrelated))


def manifest_with_repeats(events: DataFrame) -> DataFrame:
    """Manifest with planted key repeats: rows at an even 2-hour ETL time twice."""
    man = manifest_table(events)
    etl = F.col(ETL_TIME)
    row = F.struct(F.col(EVENT_ID).alias(EVENT_ID), F.col(FINGERPRINT).alias(FINGERPRINT), etl.alias(ETL_TIME))
    repeat = F.when(etl % 7200 == 0, F.struct(F.col(EVENT_ID).alias(EVENT_ID), F.col(FINGERPRINT).alias(FINGERPRINT),
                                            (etl + 1).cast("int").alias(ETL_TIME)))
    return man.select(_rows(row, repeat))


def write_run_folder(spark: SparkSession, lines: DataFrame, compression: str | None = None,
                     gzip_suffix: bool = False) -> str:
    """Write lines as ``part-*`` text files in a new scratch folder; return it.

    With ``gzip_suffix`` the first ``.gz`` file is renamed to ``.gzip``, the
    suffix of older archives.
    """
    folder = scratch_path(spark, "run")
    writer = lines.select(LINE).write
    if compression:
        writer = writer.option("compression", compression)
    writer.text(folder)
    if gzip_suffix:
        gz = sorted(n for n in fs.list_names(spark, folder) if n.startswith("part-") and n.endswith(".gz"))
        if gz:
            fs.rename(spark, f"{folder}/{gz[0]}", f"{folder}/{gz[0][:-3]}.gzip")
    return folder


#: Files of an ordered run folder.
ORDERED_FILES = 4
#: Lines that one task sorts for it.
ORDERED_LINES = 250_000
_FILE_FOLDER = "part-file"   # a folder of this name matches the run folder's glob


def write_ordered_run_folder(spark: SparkSession, lines: DataFrame) -> str:
    """Write lines (value, rid) in ``ORDERED_FILES`` files; return the folder.

    An event's file is its id (half the rid) modulo the number of files, and lines stand in the order of
    their rid, so the place of every line is fixed by the data.

    Lines are dealt by ranges of (file, rid) and sorted in pieces of about ``ORDERED_LINES``, whatever
    their number; a task for each file then copies its pieces one after another. Where the scratch folder
    isn't mounted as a path, a task for each file sorts it whole.
    """
    folder = scratch_path(spark, "run")
    file, mounted = F.col(f"`{_FILE_FOLDER}`"), urlparse(folder).scheme in ("", "file")
    lines = lines.select(LINE, ROW_ID, F.pmod(F.floor(F.col(ROW_ID) / 2), F.lit(ORDERED_FILES)).alias(_FILE_FOLDER))
    if mounted:
        dealt = lines.repartitionByRange(max(ORDERED_FILES, -(-lines.count() // ORDERED_LINES)), file, ROW_ID)
        pieces = scratch_path(spark, "pieces")
    else:
        dealt, pieces = lines.repartition(ORDERED_FILES, file), folder
    dealt.sortWithinPartitions(file, ROW_ID).drop(ROW_ID).write.partitionBy(_FILE_FOLDER).text(pieces)
    if mounted:
        _join_pieces(spark, pieces, folder)
    return folder


def _join_pieces(spark: SparkSession, pieces: str, folder: str) -> None:
    """One file for every folder of ``pieces``, its files in the order of their names (the tasks'); these are removed."""
    source, target = urlparse(pieces).path, urlparse(folder).path

    def join(work):
        import os
        import shutil
        import uuid

        name, files = work
        os.makedirs(os.path.join(target, name), exist_ok=True)
        temporary = os.path.join(target, name, f"_{uuid.uuid4().hex}")   # a task that runs again makes the same file
        with open(temporary, "wb") as out:
            for file in files:
                with open(os.path.join(source, name, file), "rb") as piece:
                    shutil.copyfileobj(piece, out, 1 << 20)
        os.replace(temporary, os.path.join(target, name, "part-00000.txt"))

    folders = [n for n in fs.list_names(spark, pieces) if n.startswith(f"{_FILE_FOLDER}=")]
    work = [(n, sorted((f for f in fs.list_names(spark, f"{pieces}/{n}") if f.startswith("part-")),
                       key=lambda f: (int(f.split("-")[1]), f))) for n in sorted(folders)]
    if work:
        spark.sparkContext.parallelize(work, len(work)).foreach(join)
    fs.delete(spark, pieces)


def ordered_file_number(file: Column) -> Column:
    """The number of a file of an ordered run folder, from its path."""
    return F.regexp_extract(file, f"/{_FILE_FOLDER}=([0-9]+)/", 1).cast("int")


class FolderStore:
    """A keyed store for tests: an empty file for each row, removed by a delete.

    Its name holds key and ETL time, so removing it is the conditional delete, and atomic.
    """

    def __init__(self, folder: str):
        self.folder = folder

    def _path(self, event_id: str, fingerprint: str, etl_time: int) -> str:
        name = hashlib.sha256(f"{event_id}\0{fingerprint}\0{etl_time}".encode()).hexdigest()
        return os.path.join(self.folder, name[:2], name)

    def put(self, event_id: str, fingerprint: str, etl_time: int) -> None:
        path = self._path(event_id, fingerprint, etl_time)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        open(path, "w").close()

    def present(self, event_id: str, fingerprint: str, etl_time: int) -> bool:
        return os.path.exists(self._path(event_id, fingerprint, etl_time))

    def delete(self, event_id: str, fingerprint: str, etl_time: int) -> bool:
        try:
            os.remove(self._path(event_id, fingerprint, etl_time))
            return True
        except FileNotFoundError:
            return False


def write_folder_store(spark: SparkSession, manifest: DataFrame) -> str:
    """A :class:`FolderStore` of a manifest's rows, made by Spark's tasks; its folder, on a shared local path."""
    url = urlparse(scratch_path(spark, "store"))
    if url.scheme not in ("", "file"):
        raise ValueError(f"a folder store needs a checkpoint folder that is mounted as a path, not {url.scheme}://")
    folder = url.path

    def put(rows):
        store = FolderStore(folder)
        for r in rows:
            store.put(r[EVENT_ID], r[FINGERPRINT], r[ETL_TIME])

    manifest.select(EVENT_ID, FINGERPRINT, ETL_TIME).foreachPartition(put)
    return folder
