"""Delimited-text ingest from real files (S1-S7) and from line DataFrames."""

import datetime
import os

import pytest

from veloframe.sources import ingest
from veloframe.sources.fixtures import TRIP_HEADER
from veloframe.sources.schemas import TRIP_REQUIRED_TEXT, TRIP_SCHEMA, TRIP_DATE_SCHEMA

# Made-up trip lines in the files' format.
LINE_A = ("700123,431,8/31/2014 22:31,North Gate,28,8/31/2014 22:38,"
          "River Bridge at Mill,32,17,Subscriber,10440")
LINE_ROUND = "5101,63,8/29/2013 14:13,Old Town Square,66,8/29/2013 14:14,Old Town Square,66,520,Subscriber,10527"
LINE_ONEWAY = "5102,83,8/29/2013 12:02,Old Town Square,66,8/29/2013 12:04,Harbour Steps,67,319,Subscriber,10503"


def _write(dirpath, name, lines):
    p = os.path.join(dirpath, name)
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    return p


def test_load_with_header_and_types(spark, scratch_dir):
    p = _write(scratch_dir, "trips_a.csv", [TRIP_HEADER, LINE_A, LINE_ROUND])
    df = ingest.load_delimited(spark, p, TRIP_SCHEMA)
    rows = sorted(df.collect(), key=lambda r: r.trip_id)
    assert [r.trip_id for r in rows] == [5101, 700123]
    a = rows[1]
    assert a.duration == 431
    assert a.start_date == datetime.datetime(2014, 8, 31, 22, 31)
    assert a.end_station == "River Bridge at Mill"
    assert a.zip == "10440" and a.bike_no == 17
    assert df.schema == TRIP_SCHEMA


def test_header_dropped_everywhere_but_near_copy_kept(spark, scratch_dir):
    near = TRIP_HEADER.replace(",", ", ", 1)
    p = _write(scratch_dir, "trips_b.csv", [TRIP_HEADER, LINE_A, TRIP_HEADER, LINE_ONEWAY, near])
    df = ingest.load_delimited(spark, p, TRIP_SCHEMA)
    rows = df.collect()
    assert len(rows) == 3
    assert sum(r.trip_id is None for r in rows) == 1


def test_date_schema_keeps_the_day_only(spark, scratch_dir):
    p = _write(scratch_dir, "trips_c.csv", [TRIP_HEADER, LINE_A])
    r = ingest.load_delimited(spark, p, TRIP_DATE_SCHEMA).first()
    assert r.start_date == datetime.date(2014, 8, 31)


def test_required_text_filter(spark, scratch_dir):
    blank_zip = LINE_A.rsplit(",", 1)[0] + ","
    p = _write(scratch_dir, "trips_d.csv", [TRIP_HEADER, LINE_A, blank_zip])
    df = ingest.load_delimited(spark, p, TRIP_SCHEMA, required_text=TRIP_REQUIRED_TEXT)
    assert df.count() == 1


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_too_few_fields_fail_or_null(spark):
    short = "1,2,3"
    with pytest.raises(Exception):
        ingest.parse_lines(_lines(spark, [short]), TRIP_SCHEMA).collect()
    r = ingest.parse_lines(_lines(spark, [short, ""]), TRIP_SCHEMA, mode="null").collect()
    assert len(r) == 2
    assert r[0].trip_id == 1 and r[0].start_station is None and r[0].zip is None


def test_surplus_field_ignored_and_quoted_comma_shifts(spark):
    extra = LINE_A + ",surplus"
    quoted = LINE_A.replace("North Gate", '"Mountain View, Caltrain"')
    rows = ingest.parse_lines(_lines(spark, [extra, quoted]), TRIP_SCHEMA).collect()
    assert rows[0].zip == "10440"
    assert rows[1].start_station == '"Mountain View' and rows[1].start_terminal is None


def test_blank_strings_kept(spark):
    r = ingest.parse_lines(_lines(spark, [LINE_A.rsplit(",", 1)[0] + ","]), TRIP_SCHEMA).first()
    assert r.zip == ""


def test_parse_is_map_only_and_native(spark):
    df = ingest.parse_lines(_lines(spark, [LINE_A]), TRIP_SCHEMA, header=TRIP_HEADER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "EvalPython" not in plan


def test_unused_fields_are_pruned(spark):
    df = ingest.parse_lines(_lines(spark, [LINE_A]), TRIP_SCHEMA, mode="null").select("zip")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "make_timestamp" not in plan and "try_make_timestamp" not in plan


def test_each_path_has_its_own_header(spark, scratch_dir):
    a = _write(scratch_dir, "period_a.csv", [TRIP_HEADER, LINE_A, LINE_A])
    b = _write(scratch_dir, "period_b.csv", [TRIP_HEADER.upper(), LINE_ROUND])
    df = ingest.load_delimited(spark, [a, b], TRIP_SCHEMA, required_text=TRIP_REQUIRED_TEXT)
    assert sorted(r.trip_id for r in df.collect()) == [5101, 700123, 700123]


def test_keys_beyond_32_bits_are_kept(spark):
    line = LINE_A.replace("700123", "9000000000")
    df = ingest.parse_lines(spark.createDataFrame([(line,)], "value string"), TRIP_SCHEMA)
    assert df.first().trip_id == 9_000_000_000
