"""Fixed values of the enriched-event line format and the manifest table.

Everything in the first block must stay equal to the upstream format for the
results to be right; it is stated here once and imported everywhere else.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the enriched-event format and the manifest layout)
# ---------------------------------------------------------------------------
# 0-based positions in the tab-separated enriched event line.
ETL_TSTAMP_FIELD = 2
EVENT_ID_FIELD = 6
FINGERPRINT_FIELD = 129
# Field separator of an enriched event line.
FIELD_SEP = "\t"
# ETL timestamp text inside a line; always UTC.
ETL_TSTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss.SSS"
# It is read with fields of any width and a fraction of one to three digits, as the upstream parser reads it.
ETL_TSTAMP_PARSE_PATTERN = "y-M-d H:m:s.SSS"
# Run time given for orphan events (the run folder naming); read as UTC.
RUN_TIME_PATTERN = "yyyy-MM-dd-HH-mm-ss"
# It is read with fields of any width (07 or 7), as the upstream parser reads it.
RUN_TIME_PARSE_PATTERN = "y-M-d-H-m-s"
# Run-folder schemes that are rewritten to the s3a connector.
S3_SCHEMES = ("s3://", "s3a://", "s3n://")
# Only these files directly inside a run folder are read.
RUN_FILE_GLOB = "part-*"
# Suffix of gzip files of older archives; no registered codec has it.
UNCUT_SUFFIX = ".gzip"
# Failure messages.
MALFORMED_MESSAGE = "ERROR: Cannot split TSV [{line}]"
BAD_RUN_TIME_MESSAGE = "ETL Time {text} has invalid format"
BAD_TSTAMP_MESSAGE = "ERROR: Cannot parse ETL timestamp [{text}] in [{line}]"
OUT_OF_RANGE_MESSAGE = "ETL time out of INT range: {text} in [{line}]"
# Longest excerpt of a line or of one of its fields in a listing of failing lines.
EXCERPT_CHARS = 200
# Report line printed after a cleanup.
REPORT_LINE = "Manifest cleanup deleted {deleted} events. {skipped} events were skipped"
# ---------------------------------------------------------------------------

# Output column names. Lower case, so Spark and SQL engines agree on them.
EVENT_ID = "eventid"
FINGERPRINT = "fingerprint"
ETL_TSTAMP = "etltstamp"   # etl time carried by an event (triple)
ETL_TIME = "etltime"       # etl time stored in the manifest
LINE = "value"             # text source column
DAY_SECONDS = 86400
ROW_ID = "rid"             # position of a line in the scan, used as tie-break
FILE = "file"              # path of the file that a line stands in
BLOCK = "block"            # start of the split in which the scan read it
LINE_NUMBER = "line"       # number of the line in its file, from 1 on

TRIPLE_KEYS = (EVENT_ID, FINGERPRINT, ETL_TSTAMP)
MANIFEST_KEYS = (EVENT_ID, FINGERPRINT, ETL_TIME)

LINES = T.StructType([T.StructField(LINE, T.StringType(), False)])

TRIPLES = T.StructType([
    T.StructField(EVENT_ID, T.StringType(), True),
    T.StructField(FINGERPRINT, T.StringType(), True),
    T.StructField(ETL_TSTAMP, T.IntegerType(), True),
])

STAGED = T.StructType([
    T.StructField(ROW_ID, T.LongType(), False),
    *TRIPLES.fields,
])

POSITIONED = T.StructType([
    T.StructField(FILE, T.StringType(), False),
    T.StructField(BLOCK, T.LongType(), False),
    *STAGED.fields,
])

MANIFEST = T.StructType([
    T.StructField(EVENT_ID, T.StringType(), False),
    T.StructField(FINGERPRINT, T.StringType(), False),
    T.StructField(ETL_TIME, T.IntegerType(), True),
])

SUMMARY = T.StructType([
    T.StructField("deleted_events", T.LongType(), False),
    T.StructField("skipped_events", T.LongType(), False),
])
