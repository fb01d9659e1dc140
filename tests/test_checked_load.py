"""Headers per file of a folder, and ill-formed lines routed to rejects."""

import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from veloframe.operators import relational
from veloframe.sources import ingest

SCHEMA = StructType([StructField("id", IntegerType()), StructField("name", StringType()),
                     StructField("n", IntegerType())])


@pytest.fixture
def folder(tmp_path):
    def write(**files):
        for name, lines in files.items():
            (tmp_path / name).write_text("".join(f"{x}\n" for x in lines))
        return str(tmp_path)

    return write


def jobs_of(spark, run):
    tracker = spark.sparkContext.statusTracker()
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "count")
    try:
        run()
        return len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_each_file_has_its_own_header(spark, folder):
    path = folder(a=["id,name,n", "1,x,2", "id,name,n", "ID,NAME,N"], b=["ID,NAME,N", "2,y,3"], c=["9,head,9", "3,z,4", "9,head,9"],
                  d=["only,a,header"], e=[])
    rows = sorted(tuple(r) for r in ingest.load_delimited(spark, path, SCHEMA, header="file").collect() if r.id)
    assert rows == [(1, "x", 2), (2, "y", 3), (3, "z", 4)]
    # another file's header is data here
    assert ingest.load_delimited(spark, path, SCHEMA, header="file").where("name = 'NAME'").count() == 1


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    seen = []
    for n in (3, 40):
        where = tmp_path / str(n)
        os.mkdir(where)
        for k in range(n):
            (where / f"f{k}").write_text(f"h{k},h,h\n{k},x,1\n")
        out = []
        seen.append(jobs_of(spark, lambda: out.append(ingest.load_delimited(spark, str(where), SCHEMA, header="file"))))
        assert sorted(r.id for r in out[0].collect()) == list(range(n))
    assert seen[0] == seen[1]


def test_one_file_in_many_blocks(spark, tmp_path):
    """The header comes from the file's first block, whichever task reads the others."""
    (tmp_path / "big").write_text("id,name,n\n" + "".join(f"{k},x,1\n" for k in range(5000)) + "id,name,n\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = ingest.read_file_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 5
        df = ingest.load_delimited(spark, str(tmp_path), SCHEMA, header="file")
        assert sorted(r.id for r in df.collect()) == list(range(5000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_headers_joined_by_shuffle(spark, folder, monkeypatch):
    path = folder(a=["id,name,n", "1,x,2"], b=["i,a,m", "2,y,3"])
    monkeypatch.setattr(relational, "BROADCAST_BYTES", 0)
    assert sorted(r.id for r in ingest.load_delimited(spark, path, SCHEMA, header="file").collect()) == [1, 2]


LINES = ["id,name,n", "1,x,2", "2,y", "3,z,4,surplus", "4,w,", "5,v, ", "six,u,6", "seven,t,sept", "", "8,,1"]


def test_rejects_with_reasons_and_counts(spark, folder):
    found = ingest.load_checked(spark, folder(a=LINES), SCHEMA)
    assert sorted(tuple(r) for r in found.good.collect()) == [
        (1, "x", 2), (3, "z", 4), (4, "w", None), (5, "v", None), (8, "", 1)]
    assert sorted((r.line, r.reason) for r in found.rejects.collect()) == [
        ("", "short: 1 of 3 fields"), ("2,y", "short: 2 of 3 fields"), ("seven,t,sept", "unparsable: id n"),
        ("six,u,6", "unparsable: id")]
    assert {os.path.basename(r.file) for r in found.rejects.collect()} == {"a"}
    assert found.counts == {"lines": 9, "short": 2, "unparsable": 2, "rejected": 4}
    assert found.good.schema == SCHEMA


@pytest.mark.parametrize("reject, ids", [((), [1, 2, 3, 4, 5, 8, None, None, None]), (("short",), [1, 3, 4, 5, 8, None, None]),
                                         (("unparsable",), [1, 2, 3, 4, 5, 8, None])])
def test_kinds_that_are_turned_away(spark, folder, reject, ids):
    found = ingest.load_checked(spark, folder(a=LINES), SCHEMA, reject=reject)
    assert sorted((r.id for r in found.good.collect()), key=lambda x: (x is None, x)) == ids
    assert found.counts["rejected"] == found.rejects.count() == 9 - len(ids)


def test_given_header_none_and_no_lines(spark, folder, tmp_path):
    path = folder(a=LINES)
    assert ingest.load_checked(spark, path, SCHEMA, header="1,x,2").counts["lines"] == 9
    assert ingest.load_checked(spark, path, SCHEMA, header=None).counts["lines"] == 10
    os.mkdir(tmp_path / "none")
    (tmp_path / "none" / "f").write_text("")
    empty = ingest.load_checked(spark, str(tmp_path / "none"), SCHEMA)
    assert empty.good.count() == empty.rejects.count() == 0
    with pytest.raises(ValueError):
        ingest.load_checked(spark, path, SCHEMA, reject=("odd",))


def test_reading_one_side_leaves_the_other(spark, folder):
    found = ingest.load_checked(spark, folder(a=LINES), SCHEMA)
    plan = found.good._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__outcome" in plan and "__line" not in plan.split("ReadSchema")[1]
    assert found.good.select(F.sum("n")).first()[0] == 7
