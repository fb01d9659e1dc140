"""Period files as a stream: each new file is parsed and stacked onto a table.

The trip, station and weather data arrive as one file per period, and the
batch jobs stack the periods (``relational.stack``). With Structured
Streaming the same ``parse_lines`` plan runs incrementally over a file
source: every new file in the folder is parsed and appended to a parquet
table, exactly once, with progress kept in a checkpoint in the shared
folder (``spark.checkpoint.dir``). A stream has no "first line", so the
header must be named.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from veloframe.operators.relational import non_empty
from veloframe.sources.catalog import shared_path
from veloframe.sources.ingest import parse_lines


def read_period_stream(spark: SparkSession, folder: str, schema: StructType, header: str | None,
                       mode: str = "fail", required_text: Sequence[str] | None = None,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame of typed rows from the text files in ``folder``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = parse_lines(reader.load(folder), schema, header=header, mode=mode)
    return non_empty(df, list(required_text)) if required_text else df


def append_periods(df: DataFrame, table_path: str, name: str,
                   checkpoint: str | None = None, once: bool = True) -> StreamingQuery:
    """Append the parsed rows to the parquet table at ``table_path``.

    ``once=True`` processes every file present now and stops (a scheduled
    incremental load); otherwise the stream keeps polling the folder.
    """
    checkpoint = checkpoint or shared_path(df.sparkSession, "streams", name)
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("path", table_path).option("checkpointLocation", checkpoint)
              .queryName(name))
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start()
