"""Keeping an expensive column where it is computed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pinned(column: Column) -> Column:
    """``column``, whose definition Catalyst must not copy into filters or conditions above.

    A filter or join on a computed column is pushed below its projection by writing the
    whole definition into it, where it is then computed again. A condition that reads
    the row number (always true) isn't deterministic to the optimizer, so the projection
    stays a barrier.
    """
    return F.when(F.monotonically_increasing_id() >= 0, column)
