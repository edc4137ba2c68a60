from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keysweep.schemas import FIELD_SEP  # noqa: E402
from keysweep.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", app="keysweep-tests", **{"spark.sql.shuffle.partitions": "8"})
    yield session
    session.stop()


@pytest.fixture()
def tmp_folder():
    return tempfile.mkdtemp(prefix="keysweep-test-")


def make_line(etl: str = "2017-07-20 18:47:06.000",
              event_id: str = "1799a90f-f570-4414-b91a-b0db8f39cc2e",
              fingerprint: str = "e79bef64f3185e9d7c10d5dfdf27b9a3",
              last: str = "", width: int = 131) -> str:
    """An enriched line with the shapes of a real one around the three read fields."""
    fields = [""] * 131
    # fields that are never read: text, stamps, numbers, URLs, JSON with quotes
    for i, value in enumerate(['shop', 'mob', '', '2001-02-03 04:05:06.007', 'a "quoted, text"', '{"k": ["v, w", null]}']):
        fields[(0, 1, 8, 4, 80, 124)[i]] = value
    fields[30] = "https://example.org/path?x=1&y=2"
    fields[90] = "31337"
    fields[2], fields[6], fields[129], fields[130] = etl, event_id, fingerprint, last
    return FIELD_SEP.join(fields[:width])


def lines_df(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")
