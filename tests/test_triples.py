"""Line -> triple extraction (P1-P6) and the line checks (F1, F2)."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import lines_df, make_line
from keysweep.functions import etl_epoch, leading_field, run_time_seconds, run_time_value, tsv_field, tsv_fields, tsv_width
from keysweep.operators import bad_timestamp_lines, event_triples, failing_lines, malformed_lines

GOLDEN = ("1799a90f-f570-4414-b91a-b0db8f39cc2e", "e79bef64f3185e9d7c10d5dfdf27b9a3")


def triples(spark, lines, override=None):
    return [tuple(r) for r in event_triples(lines_df(spark, lines), override).collect()]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_golden_line_without_override(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert triples(spark, [make_line()]) == [(*GOLDEN, 1500576426)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_golden_line_with_override(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        seconds = run_time_value(spark, "2017-07-20-14-44-13")
        assert seconds == 1500561853
        line = make_line(etl="2016-11-27 08:46:40.000")
        assert triples(spark, [line], seconds) == [(*GOLDEN, 1500561853)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_trailing_blank_fields_are_dropped(spark):
    df = lines_df(spark, ["a\tb\t\t", "", "\t\t", make_line(), make_line(fingerprint="")])
    assert [r[0] for r in df.select(tsv_width("value")).collect()] == [2, 1, 1, 130, 125]


def test_blank_fingerprint_and_last_field_is_malformed(spark):  # E1
    with pytest.raises(Exception, match="Cannot split TSV"):
        triples(spark, [make_line(fingerprint="", last="")])


def test_blank_fingerprint_with_filled_last_field_is_valid(spark):  # E2
    assert triples(spark, [make_line(fingerprint="", last="x")]) == [(GOLDEN[0], "", 1500576426)]


def test_short_and_blank_lines_are_malformed(spark):  # E3
    for line in ["", make_line(width=129), "only\tthree\tfields"]:
        with pytest.raises(Exception, match="Cannot split TSV"):
            triples(spark, [line])


def test_bad_timestamp_fails_without_override(spark):  # E4
    for etl in ["2017-07-20 18:47:06", "not a time", ""]:
        with pytest.raises(Exception, match="Cannot parse ETL timestamp"):
            triples(spark, [make_line(etl=etl)])


def test_bad_timestamp_is_never_read_with_override(spark):  # E5 (R5)
    assert triples(spark, [make_line(etl="garbage")], 7) == [(*GOLDEN, 7)]


def test_override_does_not_skip_the_split_check(spark):
    with pytest.raises(Exception, match="Cannot split TSV"):
        triples(spark, [make_line(width=100)], 7)


def test_etl_epoch_truncates_toward_zero_before_1970(spark):  # E9 (R6)
    df = spark.createDataFrame([("1969-12-31 23:59:58.500",), ("1970-01-01 00:00:01.999",)], "t string")
    assert [r[0] for r in df.select(etl_epoch("t")).collect()] == [-1, 1]


def test_etl_epoch_raises_past_2038(spark):  # E10 (R7)
    df = spark.createDataFrame([("2038-01-19 03:14:07.000",), ("2038-01-19 03:14:08.000",)], "t string")
    assert df.limit(1).select(etl_epoch("t")).first()[0] == 2 ** 31 - 1
    with pytest.raises(Exception, match="out of INT range"):
        df.select(etl_epoch("t")).collect()


def test_run_time_seconds_column(spark):
    df = spark.createDataFrame([("2017-07-20-14-44-13",), (None,), ("2017-7-20-14-44-13",)], "t string")
    assert [r[0] for r in df.select(run_time_seconds("t")).collect()] == [1500561853, None, 1500561853]
    assert run_time_value(spark, None) is None


@pytest.mark.parametrize("text", ["2017-07-20 14:44:13", "yesterday", "2017-13-20-14-44-13",
                                  "2017-07-20-14-44", "2017-07-20-14-44-13-01"])
def test_run_time_rejects_other_text(spark, text):
    with pytest.raises(PySparkException, match="has invalid format"):
        run_time_value(spark, text)


def test_malformed_and_bad_timestamp_lists(spark):
    lines = [make_line(), make_line(fingerprint=""), make_line(etl="x"), ""]
    df = lines_df(spark, lines)
    assert sorted(r["n_fields"] for r in malformed_lines(df).collect()) == [1, 125]
    bad = bad_timestamp_lines(df).collect()
    assert [r["etl_text"] for r in bad] == ["x"]


def test_other_columns_pass_through(spark):
    df = lines_df(spark, [make_line()]).withColumn("rid", F.lit(5))
    out = event_triples(df)
    assert out.columns == ["rid", "eventid", "fingerprint", "etltstamp"]
    assert out.first()["rid"] == 5


@settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab \"{},:\t", max_size=6), min_size=131, max_size=140))
def test_leading_field_equals_split_field(spark, fields):
    line = "\t".join(fields)
    row = lines_df(spark, [line]).select(
        *[leading_field("value", i).alias(f"l{i}") for i in (2, 6)],
        *[tsv_field(tsv_fields(F.col("value")), i).alias(f"s{i}") for i in (2, 6)],
        tsv_width("value").alias("w"),
    ).first()
    if row["w"] > 6:
        assert (row["l2"], row["l6"]) == (row["s2"], row["s6"])


def test_fixture_does_not_depend_on_session_zone(spark):
    from conftest import SF_SMALL
    from keysweep.plans.catalog import QUERIES

    def snapshot(key):
        return sorted((tuple(r) for r in QUERIES[key](spark, SF_SMALL).collect()), key=repr)

    keys = ["event_triples", "etl_epoch", "run_time_seconds", "cleanup_summary"]
    base = {k: snapshot(k) for k in keys}
    for zone in ["America/New_York", "Australia/Lord_Howe", "Asia/Kathmandu"]:
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert {k: snapshot(k) for k in keys} == base
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_wider_lines_keep_their_fingerprint(spark):
    wide = make_line() + "\textra\tmore\t\t"
    assert triples(spark, [wide]) == [(*GOLDEN, 1500576426)]
    df = lines_df(spark, [wide])
    assert df.select(tsv_width("value")).first()[0] == 133


def test_etl_text_shapes(spark):
    """Fields of any width, a fraction of one to three digits, truncation toward zero."""
    good = {"2017-07-20 18:47:06.000": 1500576426, "2017-07-20 18:47:06.5": 1500576426, "2017-07-20 18:47:06.25": 1500576426,
            "2017-7-20 8:47:6.5": 1500540426, "1969-12-31 23:59:59.999": 0, "1969-12-31 23:59:58.5": -1, "1960-1-2 3:4:5.0": -315521755}
    bad = ["2017-07-20 18:47:06.1234", "2017-07-20 18:47:06.123456789", "2017-07-20 18:47:06", "2017-07-20 18:47:06.",
           "2017-07-20T18:47:06.000", "2017-13-20 18:47:06.000"]
    df = spark.createDataFrame([(t,) for t in [*good, *bad]], "t string")
    assert [r[0] for r in df.select(etl_epoch("t")).collect()] == [*good.values(), *[None] * len(bad)]


def test_out_of_range_error_names_the_line(spark):
    with pytest.raises(Exception, match="out of INT range.*2040.*shop"):
        triples(spark, [make_line(etl="2040-01-01 00:00:00.000")])


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(
    st.builds(make_line, etl=st.sampled_from(["2017-07-20 18:47:06.000", "2017-7-2 1:2:3.4", "x", "", "2040-01-01 00:00:00.0",
                                               "1801-01-01 00:00:00.0", "2017-07-20 18:47:06.1234", "9999-12-31 23:59:59.999"]),
              fingerprint=st.sampled_from(["f", ""]), width=st.sampled_from([131, 129, 130, 7])),
    st.sampled_from(["", "a\tb", "\t" * 140])), max_size=4))
def test_a_run_without_failing_lines_stages_and_any_other_fails(spark, lines):
    df = lines_df(spark, lines or [make_line()])
    bad = failing_lines(df).count()
    if bad:
        with pytest.raises(Exception, match="Cannot split TSV|Cannot parse ETL timestamp|out of INT range"):
            event_triples(df).collect()
    else:
        assert event_triples(df).count() == df.count() and len(event_triples(df).collect()) == df.count()
    only_split = failing_lines(df, override=True)
    assert {r["problem"] for r in only_split.collect()} <= {"malformed"}
    assert only_split.count() == malformed_lines(df).count()


def test_override_as_a_transform_step(spark):
    from keysweep.operators import with_override

    out = lines_df(spark, [make_line(etl="not read")]).transform(with_override(42))
    assert [tuple(r) for r in out.collect()] == [(*GOLDEN, 42)]
