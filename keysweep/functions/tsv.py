"""Column functions over enriched TSV lines (P1, P2).

The upstream line splitter drops *trailing* empty fields (``String.split``
semantics), so a line whose last fields are blank is shorter than its tab
count suggests. ``split`` in Spark keeps them; trimming trailing tabs first
gives the same field array.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from keysweep.schemas import FIELD_SEP, FINGERPRINT_FIELD


def tsv_fields(line: Column | str, limit: int = -1) -> Column:
    """P1: the field array of a line, trailing empty fields dropped.

    With ``limit`` the array has at most that many elements, the last one
    holding the rest of the line; positions below ``limit - 1`` and the test
    ``size > i`` for ``i < limit - 1`` are unchanged.
    """
    return F.split(F.rtrim(line, F.lit(FIELD_SEP)), FIELD_SEP, limit)


# Elements the triple extraction needs: fields 0..129 plus one for the rest.
TRIPLE_SPLIT_LIMIT = FINGERPRINT_FIELD + 2


def tsv_field(fields: Column, index: int) -> Column:
    """P2: field ``index`` (0-based) of a field array; null when absent."""
    return F.get(fields, index)


def leading_field(line: Column | str, index: int) -> Column:
    """Field ``index`` read by scanning only up to the next tab.

    Equal to ``tsv_field(tsv_fields(line), index)`` on every line that has
    more than ``index`` fields (all well-formed lines), without splitting the
    rest of the line.
    """
    return F.substring_index(F.substring_index(line, FIELD_SEP, index + 1), FIELD_SEP, -1)


def tsv_width(line: Column | str) -> Column:
    """Number of fields of a line after trailing empty fields are dropped."""
    return F.size(tsv_fields(line))


def is_malformed(fields: Column) -> Column:
    """True when the fingerprint field does not exist in the field array."""
    return F.size(fields) <= FINGERPRINT_FIELD
