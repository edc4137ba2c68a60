"""S1/S2: scan of one enriched run folder.

A run folder holds ``part-*`` text files, one event per line, plain or
gzip-compressed (``.gz``, and ``.gzip`` from older archives; the DataFrame
text reader decodes both). Only files directly in the folder whose name
starts with ``part-`` are read; a folder without any is an error.

The reader decides whether a file may be cut by the registered codecs, which
know ``.gz`` but not ``.gzip``, and decodes by a list of its own, which knows
both: a ``.gzip`` file larger than a split would be cut and its second half
couldn't be decoded. Such files are therefore read through a sibling session
whose scan settings give every file a task of its own.

With ``positions`` every line comes with its file and the start of the split it
was read in; :func:`line_positions` turns these into line numbers that don't
depend on where files were cut.

The DataFrame text reader is used, not the CSV reader: CSV quote handling
would merge fields that start with a double quote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keysweep.schemas import BLOCK, FILE, LINE, LINE_NUMBER, ROW_ID, RUN_FILE_GLOB, S3_SCHEMES, UNCUT_SUFFIX
from keysweep.sources import fs

# Split size and cost of opening a file that leave no room for a second file, or a second part, in a task.
_WHOLE_FILE = str(1 << 60)
_SCAN_SETTINGS = ("spark.sql.files.ignoreCorruptFiles", "spark.sql.files.ignoreMissingFiles")
#: Row ids hold the number of the file above that of the line.
LINE_BITS = 40


def normalize_run_folder(folder: str) -> str:
    """Folder URI with a trailing slash; ``s3://`` and ``s3n://`` become ``s3a://``.

    Other schemes and local paths are left alone.
    """
    for scheme in S3_SCHEMES:
        if folder.startswith(scheme):
            folder = "s3a://" + folder[len(scheme):]
            break
    return folder if folder.endswith("/") else folder + "/"


def run_folder_glob(folder: str) -> str:
    return normalize_run_folder(folder) + RUN_FILE_GLOB


def _all_but(suffix: str) -> str:
    """A file-name glob for names that don't end with ``suffix``."""
    ends = [f"*[!{c}]{suffix[i + 1:]}" for i, c in enumerate(suffix)]
    return "{" + ",".join(ends) + "}"


def whole_file_session(spark: SparkSession) -> SparkSession:
    """A session on the same context whose scans never cut a file and never put two into one task."""
    sibling = spark.newSession()
    for name in _SCAN_SETTINGS:
        sibling.conf.set(name, spark.conf.get(name))
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        sibling.conf.set(name, _WHOLE_FILE)
    return sibling


def _lines(spark: SparkSession, glob: str, names: str | None, positions: bool) -> DataFrame:
    reader = spark.read if names is None else spark.read.option("pathGlobFilter", names)
    lines = reader.text(glob)
    if positions:
        return lines.select(LINE, F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK))
    return lines


def read_enriched(spark: SparkSession, folder: str, positions: bool = False) -> DataFrame:
    """Lines of every ``part-*`` file of the run folder: DataFrame[value STRING (, file STRING, block BIGINT)]."""
    glob = run_folder_glob(folder)
    if not fs.any_match(spark, glob + UNCUT_SUFFIX, glob + "/*" + UNCUT_SUFFIX):
        return _lines(spark, glob, None, positions)
    others = _lines(spark, glob, _all_but(UNCUT_SUFFIX), positions)
    uncut = _lines(whole_file_session(spark), glob, "*" + UNCUT_SUFFIX, positions)
    return others.unionByName(uncut)


def line_positions(rows: DataFrame) -> DataFrame:
    """``rows`` with ``line``, the line's number in its file from 1 on, and ``rid``, unique and in (file, line) order.

    ``rows`` are written lines of a scan with positions and must hold all of
    them, with the ``rid`` that :func:`pyspark.sql.functions.monotonically_increasing_id`
    gave them in the scan: within a split it counts lines. The lines of a file's
    earlier splits are added up over one row per split, and files are numbered
    over one row per file, so neither depends on where files were cut. The rows
    meet these by a broadcast, and are neither shuffled nor sorted.
    """
    splits = rows.groupBy(FILE, BLOCK).agg(F.min(ROW_ID).alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    files = splits.select(F.col(FILE).alias("_file")).distinct().withColumn(
        "_index", F.row_number().over(Window.orderBy("_file")).cast("long"))
    places = (splits.join(files, F.col(FILE) == F.col("_file"))
              .select(F.col("_file"), F.col(BLOCK).alias("_block"), "_first", "_before", "_index"))
    line = (F.col("_before") + F.col(ROW_ID) - F.col("_first") + 1).alias(LINE_NUMBER)
    keep = [c for c in rows.columns if c != ROW_ID]
    numbered = (rows.join(F.broadcast(places), (F.col(FILE) == F.col("_file")) & (F.col(BLOCK) == F.col("_block")))
                .select(*keep, line, "_index"))
    return numbered.select(*keep, LINE_NUMBER, (F.col("_index") * (1 << LINE_BITS) + F.col(LINE_NUMBER)).alias(ROW_ID))
