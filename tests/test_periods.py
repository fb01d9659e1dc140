"""Period tables that are loaded again, and station sums kept per period."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from veloframe.operators import features as feat
from veloframe.operators import state
from veloframe.plans import jobs
from veloframe.sources import fixtures as fx
from veloframe.sources import periods
from veloframe.sources.ingest import SHORT
from veloframe.sources.schemas import TRIP_SCHEMA

SCHEMA = StructType([StructField("id", IntegerType()), StructField("name", StringType())])


def put(where, name, *lines):
    os.makedirs(where, exist_ok=True)
    (where / name).write_text("".join(f"{x}\n" for x in lines))
    return str(where)


def files_of(root, period):
    """Name, size and time of change of all files of a period."""
    out = {}
    for d, _, names in os.walk(root):
        if f"period={period}" in d:
            for n in names:
                at = os.stat(os.path.join(d, n))
                out[os.path.join(d, n)] = (at.st_size, at.st_mtime_ns, at.st_ino)
    return out


@pytest.fixture
def table(spark, tmp_path):
    return periods.PeriodTable(spark, str(tmp_path / "table"), SCHEMA)


def ids(table, *args):
    return sorted((r.period, r.id) for r in table.rows(*args).collect())


def test_loading_again_replaces_one_period_alone(table, tmp_path):
    a = put(tmp_path / "a", "f1", "id,name", "1,x", "2,y")
    b = put(tmp_path / "b", "f1", "ID,NAME", "3,z", "4")
    assert table.load("2013", a).counts["lines"] == 2
    assert table.load("2014", b).counts == {"lines": 2, "short": 1, "unparsable": 0, "rejected": 1}
    assert ids(table) == [("2013", 1), ("2013", 2), ("2014", 3)]
    assert [(r.line, r.period) for r in table.rejects().collect()] == [("4", "2014")]
    untouched = files_of(table.root, "2013")
    assert not table.load("2014", b).loaded
    assert table.load("2014", b, again=True).loaded
    assert ids(table) == [("2013", 1), ("2013", 2), ("2014", 3)]
    put(tmp_path / "b", "f1", "ID,NAME", "5,w")
    put(tmp_path / "b", "f2", "other,head", "6,v")
    assert table.load("2014", b).loaded
    assert ids(table) == [("2013", 1), ("2013", 2), ("2014", 5), ("2014", 6)]
    assert table.rejects().count() == 0
    assert files_of(table.root, "2013") == untouched and untouched
    assert sorted(os.path.basename(r.file) for r in table.manifest(["2014"]).collect()) == ["f1", "f2"]
    assert ids(table, ["2014"]) == [("2014", 5), ("2014", 6)]


def test_manifest_sees_changed_added_and_removed_files(table, tmp_path):
    where = tmp_path / "in"
    path = put(where, "f1", "id,name", "1,x")
    assert table.load("p", path).loaded and not table.load("p", path).loaded
    put(where, "f2", "id,name", "2,x")
    assert table.load("p", path).loaded and not table.load("p", path).loaded
    put(where, "f1", "id,name", "7,changed")
    assert table.load("p", path).loaded and ids(table) == [("p", 2), ("p", 7)]
    os.remove(where / "f2")
    assert table.load("p", path).loaded and ids(table) == [("p", 7)]


def test_period_that_became_empty(table, tmp_path):
    path = put(tmp_path / "in", "f", "id,name", "1,x")
    table.load("p", path)
    table.load("q", path)
    put(tmp_path / "in", "f", "id,name")
    assert table.load("p", path).loaded
    assert ids(table) == [("q", 1)]


def test_cut_off_load_is_made_good(table, tmp_path):
    path = put(tmp_path / "in", "f", "id,name", "1,x")

    def fail(rows):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        table.load("p", path, derive=fail)
    seen = []
    assert table.load("p", path, derive=lambda rows: seen.append(rows.count())).loaded and seen == [1]


@pytest.mark.parametrize("name", ("", "a/b", "a=b", "x%2"))
def test_odd_period_names(table, name):
    with pytest.raises(ValueError):
        table.load(name, "nowhere")


def test_nothing_loaded_yet(table):
    assert table.rows().count() == 0 and table.rows().columns == ["id", "name", "period"]


def test_only_the_asked_period_is_read(table, tmp_path):
    table.load("p", put(tmp_path / "in", "f", "id,name", "1,x"))
    plan = table.rows(["p"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [period" in plan.replace("isnotnull(", "").replace("(period", "period")


def trips(spark, rows):
    return spark.createDataFrame(rows, "start_station string, duration int, start_dow string")


def test_merged_sums_equal_all_rows(spark, tmp_path):
    rows = [(s, d, c) for s in ("a", "b", None, "") for d, c in ((7, "weekday"), (None, "weekend"), (12, None), (3, "weekend"))]
    rows += [("only nulls", None, "weekday")]
    path = str(tmp_path / "state")
    parts = [rows[k::3] for k in range(3)]
    for k, part in enumerate([parts[1], parts[1], parts[2]]):
        state.save_state(state.group_state(trips(spark, part)), path, str(k))
    state.save_state(state.group_state(trips(spark, parts[0])), path, "0")
    whole = trips(spark, rows).withColumn("trip_id", F.monotonically_increasing_id())
    got = state.with_state_features(whole, state.merged_state(spark, path))
    want = feat.with_group_shares(feat.with_group_average(whole, "start_station", "duration"))
    columns = ["start_station", "duration", "start_dow", "average", "pct_weekday", "pct_weekend"]
    assert sorted(map(repr, got.select(columns).collect())) == sorted(map(repr, want.select(columns).collect()))
    some = state.with_state_features(trips(spark, [("new", 1, "weekday")]), state.merged_state(spark, path, periods=["0"]))
    assert some.select("average", "pct_weekday").collect()[0] == (None, None)


def test_sums_of_fractions_are_refused(spark):
    with pytest.raises(TypeError):
        state.group_state(spark.createDataFrame([("a", 1.5, "weekday")], "start_station string, duration double, start_dow string"))


def test_state_of_one_period_reads_one_period(spark, small_dir, tmp_path):
    halves = fx.write_trip_period_files(spark, small_dir, str(tmp_path / "in"))
    table = periods.PeriodTable(spark, str(tmp_path / "table"), TRIP_SCHEMA)
    for name, where in zip("ab", halves, strict=True):
        assert jobs.load_trip_period(table, name, where).counts[SHORT] == 0
    before = files_of(table.root, "a")
    assert any("station_state" in f for f in before)
    assert not jobs.load_trip_period(table, "b", halves[1]).loaded
    assert jobs.load_trip_period(table, "b", halves[1], again=True).loaded
    assert files_of(table.root, "a") == before
    assert jobs.trips_with_state(table).count() == fx.trips(spark, small_dir).count()
