"""Time column functions (P3, P5).

Both formats carry no zone in their text and are read as UTC. A literal
``Z`` is appended and parsed with the ``X`` zone letter, so the session time
zone cannot change a result. ``try_to_timestamp`` keeps the functions
independent of ANSI mode; failures are raised explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from keysweep.schemas import BAD_RUN_TIME_MESSAGE, ETL_TSTAMP_PARSE_PATTERN, RUN_TIME_PARSE_PATTERN

_INT_MIN = -(2 ** 31)
_INT_MAX = 2 ** 31 - 1


def _utc_timestamp(text: Column, pattern: str) -> Column:
    return F.try_to_timestamp(F.concat(text, F.lit("Z")), F.lit(pattern + "X"))


def checked_int(seconds: Column, what: Column) -> Column:
    """Cast epoch seconds to INT, raising instead of wrapping past 2038."""
    out_of_range = (seconds < F.lit(_INT_MIN)) | (seconds > F.lit(_INT_MAX))
    return F.when(
        out_of_range,
        F.raise_error(F.concat(F.lit("ETL time out of INT range: "), what)),
    ).otherwise(seconds).cast("int")


def parse_etl_tstamp(text: Column | str) -> Column:
    """Timestamp of an ETL timestamp text, or null when it does not parse.

    Fields may have any width; the fraction of one to three digits is required.
    """
    return _utc_timestamp(F.col(text) if isinstance(text, str) else text, ETL_TSTAMP_PARSE_PATTERN)


def etl_millis_div(text: Column) -> Column:
    """Epoch seconds of an ETL timestamp text as a long, not yet checked for its range."""
    return F.call_function("div", F.unix_millis(parse_etl_tstamp(text)), F.lit(1000))


def fits_int(seconds: Column) -> Column:
    return seconds.between(F.lit(_INT_MIN), F.lit(_INT_MAX))


def etl_epoch(text: Column | str, context: Column | None = None) -> Column:
    """P3: ETL timestamp text ``yyyy-MM-dd HH:mm:ss.SSS`` (UTC) -> INT epoch seconds.

    Milliseconds are divided by 1000 truncating toward zero (``div``), which
    differs from ``unix_seconds`` before 1970. Null when the text does not
    parse; callers that must fail use :func:`keysweep.operators.triples`.
    ``context`` is what an out-of-range error names (default: the text).
    """
    text = F.col(text) if isinstance(text, str) else text
    return checked_int(etl_millis_div(text), text if context is None else context)


def run_time_seconds(text: Column | str) -> Column:
    """P5: run time ``yyyy-MM-dd-HH-mm-ss`` (UTC) -> INT epoch seconds.

    Null stays null; any other text that does not parse raises.
    """
    text = F.col(text) if isinstance(text, str) else text
    ts = _utc_timestamp(text, RUN_TIME_PARSE_PATTERN)
    bad = text.isNotNull() & ts.isNull()
    message = F.replace(F.lit(BAD_RUN_TIME_MESSAGE), F.lit("{text}"), text)
    seconds = F.when(bad, F.raise_error(message)).otherwise(F.unix_seconds(ts))
    return checked_int(seconds, text)


def run_time_value(spark: SparkSession, text: str | None) -> int | None:
    """Evaluate :func:`run_time_seconds` once for a driver-side argument.

    Used for the orphan-event override, so the argument goes through exactly
    the same parser as the column form. ``None`` means no override.
    """
    if text is None:
        return None
    row = spark.range(1).select(run_time_seconds(F.lit(text)).alias("s")).first()
    return int(row["s"])
