"""Trip-shaped views derived from the benchmark tables.

The trip, station and weather files themselves are not available, so the
inputs are derived by Spark from the given parquet tables (orders, customer,
nation, supplier). Every view is a plain DataFrame plan over the whole
tables: its work grows with them, and Catalyst prunes the columns each
query needs down to the parquet scan.

``trips`` = orders JOIN customer JOIN nation:

* trip_id        = o_orderkey (bigint here and in the trip schema, so no key is cut at scale)
* duration       = floor(o_totalprice) % 5000 + 60 seconds
* start_date     = o_orderdate + (o_orderkey % 1440) minutes
* start_station  = n_name of the customer's nation, start_terminal = c_nationkey
* end_date       = start_date + duration seconds
* end_station    = 'NATION_' || o_orderkey % 25, end_terminal = o_orderkey % 25
* bike_no        = o_orderkey % 700
* sub_type       = 'Customer' if o_orderstatus = 'F' else 'Subscriber'
* zip            = c_custkey as text
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veloframe.sources.schemas import STATION_SCHEMA, TRIP_SCHEMA, WEATHER_SCHEMA

# The date that splits the trips into two "half-year" parts.
HALF_SPLIT = "1998-05-01 00:00:00"

# Start terminals below this are the customers' in the ``by_terminal`` variant.
CUSTOMER_TERMINALS = 4

# Start terminals below this are the customers' in the ``by_half`` variant.
HALF_TERMINALS = 12

# Header lines of the derived text files (bound by position).
TRIP_HEADER = ",".join(f.name for f in TRIP_SCHEMA.fields)
STATION_HEADER = ",".join(f.name for f in STATION_SCHEMA.fields)
WEATHER_HEADER = ",".join(f.name for f in WEATHER_SCHEMA.fields)

# Text formats of dates in the files.
TEXT_DATE = "M/d/yyyy"
TEXT_DATETIME = "M/d/yyyy H:mm"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The scan of a given (read-only) table."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def trips(spark: SparkSession, sf_dir: str, variant: str = "plain") -> DataFrame:
    """The derived trip table; ``variant`` adds NULLs or blanks.

    * ``plain``  – as described in the module doc.
    * ``nulls``  – start_station NULL where trip_id % 11 = 0,
                   end_station NULL where trip_id % 22 = 0.
    * ``blanks`` – zip '' where trip_id % 10 = 3, sub_type NULL where
                   trip_id % 10 = 4.
    * ``dirty``  – both of the above.
    * ``by_terminal`` – sub_type is Customer where start_terminal < CUSTOMER_TERMINALS, else
                   Subscriber: a label that the vector's inputs determine.
    * ``by_half`` – the same with HALF_TERMINALS: a label that a strongly penalised fit still sees.
    * ``by_day``  – sub_type is Customer on Saturdays and Sundays.
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)

    k = F.col("o_orderkey")
    duration = (F.floor("o_totalprice") % 5000 + 60).cast("int")
    start = F.timestamp_add("MINUTE", k % 1440, F.col("o_orderdate"))
    df = j.select(
        k.alias("trip_id"),
        duration.alias("duration"),
        start.alias("start_date"),
        F.col("n_name").alias("start_station"),
        F.col("c_nationkey").cast("int").alias("start_terminal"),
        F.timestamp_add("SECOND", duration, start).alias("end_date"),
        F.concat(F.lit("NATION_"), (k % 25).cast("string")).alias("end_station"),
        (k % 25).cast("int").alias("end_terminal"),
        (k % 700).cast("int").alias("bike_no"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Customer"))
         .otherwise(F.lit("Subscriber")).alias("sub_type"),
        F.col("c_custkey").cast("string").alias("zip"),
    )
    t = F.col("trip_id")
    if variant in ("nulls", "dirty"):
        df = df.withColumns({
            "start_station": F.when(t % 11 != 0, F.col("start_station")),
            "end_station": F.when(t % 22 != 0, F.col("end_station")),
        })
    if variant in ("blanks", "dirty"):
        df = df.withColumns({
            "zip": F.when(t % 10 == 3, F.lit("")).otherwise(F.col("zip")),
            "sub_type": F.when(t % 10 != 4, F.col("sub_type")),
        })
    if variant == "by_terminal":
        df = df.withColumn("sub_type", F.when(F.col("start_terminal") < CUSTOMER_TERMINALS, F.lit("Customer"))
                           .otherwise(F.lit("Subscriber")))
    if variant == "by_half":
        df = df.withColumn("sub_type", F.when(F.col("start_terminal") < HALF_TERMINALS, F.lit("Customer"))
                           .otherwise(F.lit("Subscriber")))
    if variant == "by_day":
        df = df.withColumn("sub_type", F.when(F.weekday("start_date") >= 5, F.lit("Customer"))
                           .otherwise(F.lit("Subscriber")))
    if variant not in ("plain", "nulls", "blanks", "dirty", "by_terminal", "by_half", "by_day"):
        raise ValueError(f"unknown trips variant {variant!r}")
    return df


def trip_halves(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two "half-year" parts: start before / from ``HALF_SPLIT``."""
    cut = F.lit(HALF_SPLIT).cast("timestamp_ntz")
    return df.where(F.col("start_date") < cut), df.where(F.col("start_date") >= cut)


def trip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips as comma-separated text lines (column ``value``), with dirt.

    Dates are written as ``M/d/yyyy H:mm`` (seconds are cut). Dirt by
    trip_id % 10: 0 -> duration 'abc'; 1 -> duration '12.0';
    2 -> start_date '2/30/2014 1:00'; 3 -> zip ''.
    """
    return trips(spark, sf_dir).selectExpr(
        f"concat_ws(',', {', '.join(_TRIP_TEXT)}) AS value", "start_date AS _start")


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _as_text(c: str) -> str:
    return f"coalesce(CAST({c} AS STRING), '')"


# The eleven trip fields as text with the dirt of ``trip_lines``, as SQL
# expression text (one call builds the projection).
_TRIP_TEXT = [
    _as_text("trip_id"),
    f"CASE trip_id % 10 WHEN 0 THEN 'abc' WHEN 1 THEN '12.0' ELSE {_as_text('duration')} END",
    f"CASE WHEN trip_id % 10 = 2 THEN '2/30/2014 1:00' ELSE date_format(start_date, '{TEXT_DATETIME}') END",
    _as_text("start_station"),
    _as_text("start_terminal"),
    f"date_format(end_date, '{TEXT_DATETIME}')",
    _as_text("end_station"),
    _as_text("end_terminal"),
    _as_text("bike_no"),
    _as_text("sub_type"),
    f"CASE WHEN trip_id % 10 = 3 THEN '' ELSE {_as_text('zip')} END",
]


def trip_text_fields() -> list[Column]:
    """The eleven trip fields as text (with the dirt of ``trip_lines``),
    named after the trip schema."""
    return [F.expr(e).alias(f.name) for e, f in zip(_TRIP_TEXT, TRIP_SCHEMA.fields)]


def write_trip_period_files(spark: SparkSession, sf_dir: str, folder: str) -> list[str]:
    """Write the two halves of the trips as comma-separated period files.

    Every written file starts with its period's header line, as real period
    files do; the second period's is in capitals. Fields are written as they are (no quoting, empty stays empty).
    Returns the two period folders.
    """
    t = trips(spark, sf_dir)
    out = []
    for i, half in enumerate(trip_halves(t)):
        path = f"{folder}/period={i}"
        named = half.select(*trip_text_fields())
        (named.toDF(*[c.upper() if i else c for c in named.columns]).write.mode("overwrite")
         .option("header", True).option("emptyValue", "").option("nullValue", "")
         .option("quote", "\u0000").option("escape", "\u0000")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(path))
        out.append(path)
    return out


def write_lines(lines: DataFrame, folder: str, header: str) -> None:
    """Append ``value`` lines to a folder as text files that each begin with ``header``."""
    (lines.select(F.col("value").alias(header)).write.mode("append").option("header", True)
     .option("sep", "\u0001").option("quote", "\u0000").option("escape", "\u0000")
     .option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(folder))


# Headers of the three kinds of files in a mixed folder.
MIXED_HEADERS = (TRIP_HEADER, TRIP_HEADER.upper(), TRIP_HEADER.replace("_", " "))

# A line of the ill-formed variant is cut to this many fields where trip_id % 13 is 5.
SHORT_FIELDS, SHORT_EVERY, SHORT_REST = 7, 13, 5


def write_mixed_folder(spark: SparkSession, sf_dir: str, folder: str, ill_formed: bool = False) -> None:
    """All trips' lines (``trip_lines``) in one folder: files of three kinds, by trip_id % 3, each with its
    own header; with ``ill_formed`` some lines are cut short."""
    fields = trips(spark, sf_dir).selectExpr("trip_id", f"array({', '.join(_TRIP_TEXT)}) AS f")
    line = "concat_ws(',', f)"
    if ill_formed:
        line = (f"CASE WHEN trip_id % {SHORT_EVERY} = {SHORT_REST} THEN concat_ws(',', slice(f, 1, {SHORT_FIELDS})) "
                f"ELSE {line} END")
    for i, header in enumerate(MIXED_HEADERS):
        write_lines(fields.where(F.col("trip_id") % 3 == i).selectExpr(f"{line} AS value"), folder, header)


def station_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations (supplier JOIN nation) as text lines; lat is '1.0f' where s_suppkey % 10 = 0."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    k = F.col("s_suppkey")
    frac = F.lpad((k % 100).cast("string"), 2, "0")
    fields = [
        _text(k),
        _text(F.col("s_name")),
        F.when(k % 10 == 0, F.lit("1.0f")).otherwise(F.concat(F.lit("37."), frac)),
        F.concat(F.lit("-122."), frac),
        _text(F.col("s_nationkey") + 10),
        _text(F.col("n_name")),
        F.concat_ws("/", (k % 12 + 1).cast("string"), (k % 28 + 1).cast("string"), F.lit("2013")),
    ]
    return j.select(F.concat_ws(",", *fields).alias("value"))


def weather_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily weather as text lines, one per order (whole orders table).

    Field 0 is the order date as ``M/d/yyyy``; integer field i is
    o_orderkey % (i + 50); pressure field i is '29.' || lpad((o_orderkey + i) % 100, 2, '0');
    precipitation is 'T' (trace, parses to NULL) where o_orderkey % 7 = 0,
    else '0.' || lpad(o_orderkey % 100, 2, '0'); events is '', 'Rain', 'Fog'
    by o_orderkey % 3; zip_code is 94000 + o_orderkey % 200.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    # 24 fields, written as SQL text: one call builds the whole projection
    fields = []
    for i, f in enumerate(WEATHER_SCHEMA.fields):
        if i == 0:
            fields.append(f"date_format(o_orderdate, '{TEXT_DATE}')")
        elif f.name.endswith("_pressure"):
            fields.append(f"concat('29.', lpad(CAST((o_orderkey + {i}) % 100 AS STRING), 2, '0'))")
        elif f.name == "precipitation":
            fields.append("CASE WHEN o_orderkey % 7 = 0 THEN 'T' "
                          "ELSE concat('0.', lpad(CAST(o_orderkey % 100 AS STRING), 2, '0')) END")
        elif f.name == "events":
            fields.append("element_at(array('', 'Rain', 'Fog'), CAST(o_orderkey % 3 + 1 AS INT))")
        elif f.name == "zip_code":
            fields.append("CAST(o_orderkey % 200 + 94000 AS STRING)")
        else:
            fields.append(f"CAST(o_orderkey % {i + 50} AS STRING)")
    return o.selectExpr(f"concat_ws(',', {', '.join(fields)}) AS value", "o_orderdate AS _date")


def with_header(spark: SparkSession, lines: DataFrame, header: str) -> DataFrame:
    """Prepend a header line to a DataFrame of lines (bag union, no shuffle)."""
    head = spark.range(1).select(F.lit(header).alias("value"))
    return head.unionByName(lines.select("value"))
