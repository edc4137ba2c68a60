"""P4, P6, F1, F2: enriched lines -> deduplication triples, and the line checks.

Projections only, no Python: split each line once, pick three fields, parse
the ETL time. A malformed line (no fingerprint field) or an ETL timestamp that does
not parse fails the query with the line in the message; nothing is skipped.

The guards live inside the triple columns, so they run whenever a column is
computed. A plan that never computes a column (``count()`` alone) does not
run them; :func:`keysweep.plans.job.run_cleanup` therefore stages every
column of every line before it joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keysweep.functions.pinning import pinned
from keysweep.functions.timefmt import etl_epoch, etl_millis_div, fits_int, parse_etl_tstamp
from keysweep.functions.tsv import TRIPLE_SPLIT_LIMIT, is_malformed, leading_field, tsv_field, tsv_fields
from keysweep.schemas import (
    BAD_TSTAMP_MESSAGE,
    ETL_TSTAMP,
    ETL_TSTAMP_FIELD,
    EVENT_ID,
    EVENT_ID_FIELD,
    EXCERPT_CHARS,
    FINGERPRINT,
    FINGERPRINT_FIELD,
    LINE,
    MALFORMED_MESSAGE,
    OUT_OF_RANGE_MESSAGE,
)


def _message(template: str, **values: Column) -> Column:
    """Fill ``{name}`` slots of a fixed message with column values."""
    parts: list[Column] = []
    rest = template
    while "{" in rest:
        head, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        parts += [F.lit(head), values[name]]
    return F.concat(*parts, F.lit(rest))


_FIELDS = "_fields"


def triple_columns(line: Column, fields: Column, override_seconds: int | None = None) -> list[Column]:
    """P6 as three columns over a line and its field array (see :func:`tsv_fields`).

    With ``override_seconds`` (P4) every event gets that ETL time and field 2
    is never read, so its content cannot fail.
    """
    malformed = is_malformed(fields)
    split_error = F.raise_error(_message(MALFORMED_MESSAGE, line=line))

    def guarded(col: Column, unreachable) -> Column:
        # The coalesce default is never used: past the guards every value is
        # set. It declares the column non-null, so joins on it do not make
        # Catalyst infer IS NOT NULL filters and push them, with the whole
        # split and parse, into the scan a second time.
        return F.coalesce(F.when(malformed, split_error).otherwise(col), F.lit(unreachable))

    if override_seconds is None:
        etl_text = tsv_field(fields, ETL_TSTAMP_FIELD)
        parse_error = F.raise_error(_message(BAD_TSTAMP_MESSAGE, text=etl_text, line=line))
        etl = F.when(parse_etl_tstamp(etl_text).isNull(), parse_error).otherwise(
            etl_epoch(etl_text, F.concat(etl_text, F.lit(" in ["), line, F.lit("]"))))
    else:
        etl = F.lit(int(override_seconds)).cast("int")

    return [
        guarded(tsv_field(fields, EVENT_ID_FIELD), "").alias(EVENT_ID),
        guarded(tsv_field(fields, FINGERPRINT_FIELD), "").alias(FINGERPRINT),
        guarded(etl.cast("int"), 0).alias(ETL_TSTAMP),
    ]


def event_triples(lines: DataFrame, override_seconds: int | None = None, line_col: str = LINE) -> DataFrame:
    """P6: DataFrame with a line column -> (other columns..., eventid, fingerprint, etltstamp).

    Two projections: the field array is computed once per line and the three
    guarded columns read it. (Inlined into one projection, the split would be
    repeated in every conditional branch; Catalyst keeps the two apart
    because the array is referenced several times.)
    """
    keep = [c for c in lines.columns if c != line_col]
    line = F.col(line_col)
    split = lines.select(*keep, line, tsv_fields(line, TRIPLE_SPLIT_LIMIT).alias(_FIELDS))
    return split.select(*keep, *triple_columns(line, F.col(_FIELDS), override_seconds))


def with_override(override_seconds: int):
    """P4 as a ``DataFrame.transform`` step: ``lines.transform(with_override(t))``."""
    return lambda lines: event_triples(lines, override_seconds)


def malformed_lines(lines: DataFrame, line_col: str = LINE) -> DataFrame:
    """F1, read-only form: the lines that would fail the job.

    Adds ``n_fields`` (width after trailing blanks are dropped) and
    ``eventid`` (field 6, null when the line is shorter).
    """
    fields = tsv_fields(F.col(line_col))
    return (lines.where(is_malformed(fields))
                 .withColumn("n_fields", F.size(fields))
                 .withColumn(EVENT_ID, tsv_field(fields, EVENT_ID_FIELD)))


def bad_timestamp_lines(lines: DataFrame, line_col: str = LINE) -> DataFrame:
    """F2, read-only form: well-formed lines whose ETL timestamp does not parse.

    Adds ``etl_text`` (field 2) and ``eventid``. Only relevant without an
    override; with one, field 2 is never read. The timestamp is tested first
    from the head of the line; only lines that fail it are split in full.
    """
    line = F.col(line_col)
    etl_text = leading_field(line, ETL_TSTAMP_FIELD)
    bad = parse_etl_tstamp(etl_text).isNull() & ~is_malformed(tsv_fields(line))
    return (lines.where(bad)
                 .withColumn("etl_text", etl_text)
                 .withColumn(EVENT_ID, leading_field(line, EVENT_ID_FIELD)))


def checked_lines(lines: DataFrame, override: bool = False, line_col: str = LINE) -> DataFrame:
    """F1 and F2 in one pass: every line with its ``problem``, null for a good line.

    ``malformed``, ``bad_timestamp`` or ``out_of_range`` (an ETL time that INT
    can't hold). With an override field 2 is never read, so only malformed
    lines fail. Adds ``eventid`` (null when the line is shorter) and ``message``, the
    job's error with an excerpt of the line; all three, and the line itself, are null
    for a good line. The split and the parse happen once: the problem is pinned, so
    that a filter on it isn't rewritten into its whole definition below.
    """
    fields, etl_text, line = F.col(_FIELDS), F.col("_etl_text"), F.col(line_col)
    keep = [c for c in lines.columns if c != line_col]
    split = lines.select(*keep, line, tsv_fields(line, TRIPLE_SPLIT_LIMIT).alias(_FIELDS))
    timed = split.select(*keep, line, _FIELDS, tsv_field(fields, ETL_TSTAMP_FIELD).alias("_etl_text"))
    problem = F.when(is_malformed(fields), "malformed")
    if not override:
        seconds = etl_millis_div(etl_text)
        problem = problem.when(seconds.isNull(), "bad_timestamp").when(~fits_int(seconds), "out_of_range")
    judged = timed.select(*keep, line, pinned(problem).alias("problem"), "_etl_text",
                          tsv_field(fields, EVENT_ID_FIELD).alias(EVENT_ID))
    bad = F.col("problem").isNotNull()
    excerpt, text = F.substring(line, 1, EXCERPT_CHARS), F.substring(etl_text, 1, EXCERPT_CHARS)
    message = (F.when(F.col("problem") == "malformed", _message(MALFORMED_MESSAGE, line=excerpt))
               .when(F.col("problem") == "bad_timestamp", _message(BAD_TSTAMP_MESSAGE, text=text, line=excerpt))
               .when(F.col("problem") == "out_of_range", _message(OUT_OF_RANGE_MESSAGE, text=text, line=excerpt)))
    return judged.select(*keep, F.when(bad, line).alias(line_col), "problem", F.when(bad, F.col(EVENT_ID)).alias(EVENT_ID),
                         message.alias("message"))


def failing_lines(lines: DataFrame, override: bool = False, line_col: str = LINE) -> DataFrame:
    """The lines that would fail the job, with the columns of :func:`checked_lines`."""
    return checked_lines(lines, override, line_col).where(F.col("problem").isNotNull())
