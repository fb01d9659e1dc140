"""Period files as a stream: incremental, exactly-once appends."""

import os
import uuid

from veloframe.sources.fixtures import TRIP_HEADER
from veloframe.sources.schemas import TRIP_REQUIRED_TEXT, TRIP_SCHEMA
from veloframe.streaming import append_periods, read_period_stream

LINE = "{id},406,8/31/2014 22:31,A,28,8/31/2014 22:38,B,32,17,Subscriber,{zip}"


def _period(folder, name, ids, blank_zip=()):
    with open(os.path.join(folder, name), "w") as f:
        f.write(TRIP_HEADER + "\n")
        for i in ids:
            f.write(LINE.format(id=i, zip="" if i in blank_zip else "94040") + "\n")


def test_periods_append_once_each(spark, scratch_dir):
    root = os.path.join(scratch_dir, "stream-" + uuid.uuid4().hex)
    src, table, ckpt = (os.path.join(root, x) for x in ("in", "table", "ckpt"))
    os.makedirs(src)
    _period(src, "201402.csv", range(0, 5))
    _period(src, "201408.csv", range(5, 12), blank_zip={7})

    def run():
        df = read_period_stream(spark, src, TRIP_SCHEMA, header=TRIP_HEADER,
                                required_text=TRIP_REQUIRED_TEXT)
        append_periods(df, table, "periods_" + uuid.uuid4().hex, checkpoint=ckpt).awaitTermination()
        return spark.read.schema(TRIP_SCHEMA).parquet(table)

    first = run()
    assert first.count() == 11
    _period(src, "201502.csv", range(12, 15))
    second = run()
    assert second.count() == 14
    assert sorted(r.trip_id for r in second.collect()) == [i for i in range(15) if i != 7]
