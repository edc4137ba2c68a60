"""Column functions: TSV field access and time parsing."""

from keysweep.functions.timefmt import etl_epoch, parse_etl_tstamp, run_time_seconds, run_time_value
from keysweep.functions.tsv import is_malformed, leading_field, tsv_field, tsv_fields, tsv_width

__all__ = [
    "etl_epoch",
    "is_malformed",
    "leading_field",
    "parse_etl_tstamp",
    "run_time_seconds",
    "run_time_value",
    "tsv_field",
    "tsv_fields",
    "tsv_width",
]
