"""DuckDB SQL that computes each catalog query independently.

Every string runs on the benchmark tables registered as views (orders,
customer, nation, supplier, events, labels, ...). The derived trip view
is a CTE. Column names equal those of the Spark results. Shares are
rounded half-up with integer arithmetic, ``(200*w + n) // (2*n) / 100``,
which is exact, unlike rounding a double.
"""

from __future__ import annotations

TRIPS_CTE = """trips AS (
  SELECT o_orderkey AS trip_id,
         CAST(floor(o_totalprice) % 5000 + 60 AS INTEGER) AS duration,
         o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) AS start_date,
         n_name AS start_station,
         CAST(c_nationkey AS INTEGER) AS start_terminal,
         o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT))
           + to_seconds(CAST(floor(o_totalprice) % 5000 + 60 AS BIGINT)) AS end_date,
         'NATION_' || CAST(o_orderkey % 25 AS VARCHAR) AS end_station,
         CAST(o_orderkey % 25 AS INTEGER) AS end_terminal,
         CAST(o_orderkey % 700 AS INTEGER) AS bike_no,
         CASE WHEN o_orderstatus = 'F' THEN 'Customer' ELSE 'Subscriber' END AS sub_type,
         CAST(c_custkey AS VARCHAR) AS zip
  FROM orders JOIN customer ON o_custkey = c_custkey
              JOIN nation ON c_nationkey = n_nationkey)"""

TRIPS_NULLS_CTE = TRIPS_CTE + """,
trips_nulls AS (
  SELECT * REPLACE (
           CASE WHEN trip_id % 11 <> 0 THEN start_station END AS start_station,
           CASE WHEN trip_id % 22 <> 0 THEN end_station END AS end_station)
  FROM trips)"""

TRIPS_BLANKS_CTE = TRIPS_CTE + """,
trips_blanks AS (
  SELECT * REPLACE (
           CASE WHEN trip_id % 10 = 3 THEN '' ELSE zip END AS zip,
           CASE WHEN trip_id % 10 <> 4 THEN sub_type END AS sub_type)
  FROM trips)"""

TRIP_COLUMNS = ("trip_id, duration, start_date, start_station, start_terminal, end_date, "
                "end_station, end_terminal, bike_no, sub_type, zip")


def share_sql(part: str, total: str) -> str:
    return f"CAST((200 * {part} + {total}) // (2 * {total}) AS DOUBLE) / 100"


def day_sql(ts: str) -> str:
    return f"CAST(isodow({ts}) - 1 AS INTEGER)"


def dow_sql(day: str) -> str:
    return f"CASE WHEN {day} <= 4 THEN 'weekday' WHEN {day} IS NOT NULL THEN 'weekend' END"


def features_sql(source: str) -> str:
    """All trip features over the trip view named ``source``."""
    return f"""
f AS (
  SELECT {TRIP_COLUMNS},
         CAST(start_station IS NOT DISTINCT FROM end_station AS INTEGER) AS round_trip,
         {day_sql('start_date')} AS start_day
  FROM {source}),
g AS (SELECT *, {dow_sql('start_day')} AS start_dow FROM f),
s AS (
  SELECT start_station AS s_station, avg(duration) AS average,
         CAST(count(*) FILTER (WHERE start_dow = 'weekday') AS BIGINT) AS w,
         CAST(count(*) FILTER (WHERE start_dow = 'weekend') AS BIGINT) AS e,
         CAST(count(*) AS BIGINT) AS n
  FROM g GROUP BY start_station),
feat AS (
  SELECT g.*, s.average,
         CASE WHEN g.start_station IS NOT NULL THEN {share_sql('s.w', 's.n')} END AS pct_weekday,
         CASE WHEN g.start_station IS NOT NULL THEN {share_sql('s.e', 's.n')} END AS pct_weekend
  FROM g LEFT JOIN s ON g.start_station IS NOT DISTINCT FROM s.s_station)"""


FLAGSHIP = f"""
WITH {TRIPS_CTE},
{features_sql('trips')}
SELECT {TRIP_COLUMNS}, average, round_trip, start_day, start_dow, pct_weekday, pct_weekend
FROM feat
"""


PARSE_TRIP_LINES = f"""
WITH {TRIPS_CTE}
SELECT trip_id,
       CASE WHEN trip_id % 10 IN (0, 1) THEN NULL ELSE duration END AS duration,
       CASE WHEN trip_id % 10 = 2 THEN NULL ELSE date_trunc('minute', start_date) END AS start_date,
       start_station, start_terminal,
       date_trunc('minute', end_date) AS end_date,
       end_station, end_terminal, bike_no, sub_type,
       CASE WHEN trip_id % 10 = 3 THEN '' ELSE zip END AS zip
FROM trips
"""


# Lines of the ill-formed folder: text, whether it is cut short, and the field that has no value.
ILL_FORMED_CTE = TRIPS_CTE + """,
texts AS (
  SELECT trip_id, trip_id % 13 = 5 AS short,
         CASE WHEN trip_id % 10 IN (0, 1) THEN 'duration' WHEN trip_id % 10 = 2 THEN 'start_date' END AS bad,
         concat_ws(',', trip_id,
           CASE trip_id % 10 WHEN 0 THEN 'abc' WHEN 1 THEN '12.0' ELSE CAST(duration AS VARCHAR) END,
           CASE WHEN trip_id % 10 = 2 THEN '2/30/2014 1:00' ELSE strftime(start_date, '%-m/%-d/%Y %-H:%M') END,
           start_station, start_terminal, strftime(end_date, '%-m/%-d/%Y %-H:%M'), end_station) AS head,
         concat_ws(',', end_terminal, bike_no, sub_type,
                   CASE WHEN trip_id % 10 = 3 THEN '' ELSE zip END) AS tail
  FROM trips)"""

CHECKED_GOOD = f"""
SELECT * FROM ({PARSE_TRIP_LINES}) AS parsed
WHERE trip_id % 13 <> 5 AND trip_id % 10 NOT IN (0, 1, 2)
"""

CHECKED_REJECTS = f"""
WITH {ILL_FORMED_CTE}
SELECT CASE WHEN short THEN head ELSE head || ',' || tail END AS line,
       CASE WHEN short THEN 'short: 7 of 11 fields' ELSE 'unparsable: ' || bad END AS reason,
       1 AS has_file,
       (SELECT count(*) FROM texts) AS n_lines,
       (SELECT count(*) FROM texts WHERE short) AS n_short,
       (SELECT count(*) FROM texts WHERE NOT short AND bad IS NOT NULL) AS n_unparsable,
       (SELECT count(*) FROM texts WHERE short OR bad IS NOT NULL) AS n_rejected
FROM texts WHERE short OR bad IS NOT NULL
"""

# The parsed trips, then the emptiness filter of the loader.
LOAD_TRIP_FILES = f"""
SELECT * FROM ({PARSE_TRIP_LINES}) AS parsed
WHERE start_station <> '' AND end_station <> '' AND sub_type <> '' AND zip <> ''
"""


def _f32(text: str) -> str:
    """A decimal text read as double, then narrowed to 32 bits."""
    return f"CAST(CAST({text} AS DOUBLE) AS FLOAT)"


def _pad2(expr: str) -> str:
    return f"lpad(CAST({expr} AS VARCHAR), 2, '0')"


PARSE_STATION_LINES = f"""
SELECT CAST(s_suppkey AS INTEGER) AS station_id,
       s_name AS station_name,
       CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE {_f32("'37.' || " + _pad2('s_suppkey % 100'))} END AS lat,
       {_f32("'-122.' || " + _pad2('s_suppkey % 100'))} AS long,
       CAST(s_nationkey + 10 AS INTEGER) AS dock_ct,
       n_name AS city,
       make_date(2013, CAST(s_suppkey % 12 + 1 AS INTEGER), CAST(s_suppkey % 28 + 1 AS INTEGER)) AS install_dt
FROM supplier JOIN nation ON s_nationkey = n_nationkey
"""


def _weather_sql() -> str:
    from veloframe.sources.schemas import WEATHER_SCHEMA
    cols = []
    for i, f in enumerate(WEATHER_SCHEMA.fields):
        if i == 0:
            e = "CAST(o_orderdate AS DATE)"
        elif f.name.endswith("_pressure"):
            e = _f32("'29.' || " + _pad2(f"(o_orderkey + {i}) % 100"))
        elif f.name == "precipitation":
            e = f"CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE {_f32(chr(39) + '0.' + chr(39) + ' || ' + _pad2('o_orderkey % 100'))} END"
        elif f.name == "events":
            e = "CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'Rain' ELSE 'Fog' END"
        elif f.name == "zip_code":
            e = "CAST(94000 + o_orderkey % 200 AS VARCHAR)"
        else:
            e = f"CAST(o_orderkey % {i + 50} AS INTEGER)"
        cols.append(f"{e} AS {f.name}")
    return "SELECT " + ",\n       ".join(cols) + "\nFROM orders"


PARSE_WEATHER_LINES = _weather_sql()

SAFE_CASTS = """
WITH e AS (
  SELECT event_id, user_id, ts,
         CAST(user_id AS VARCHAR) AS b,
         lpad(CAST(event_id % 100 AS VARCHAR), 2, '0') AS a2,
         CAST(year(ts) AS VARCHAR) AS y, CAST(month(ts) AS VARCHAR) AS m,
         CAST(day(ts) AS VARCHAR) AS d, CAST(hour(ts) AS VARCHAR) AS hh,
         CAST(minute(ts) AS VARCHAR) AS mi, CAST(second(ts) AS VARCHAR) AS ss,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS whole,
         lpad(CAST(microsecond(ts) % 1000000 AS VARCHAR), 6, '0') AS micro,
         year(ts) AS yi
  FROM events),
t AS (
  SELECT *, m || '/' || d || '/' || y AS mdy, hh || ':' || lpad(mi, 2, '0') AS hm FROM e)
SELECT event_id,
  CASE event_id % 8 WHEN 0 THEN b WHEN 1 THEN ' ' || b || ' ' WHEN 2 THEN '+' || b
       WHEN 3 THEN '-' || b WHEN 4 THEN b || '.0' WHEN 5 THEN b || 'e3' WHEN 6 THEN '1_' || b
       ELSE '' END AS t_int,
  CASE WHEN event_id % 8 IN (0, 1, 2) THEN CAST(user_id AS INTEGER)
       WHEN event_id % 8 = 3 THEN CAST(-user_id AS INTEGER) END AS as_int,
  CASE event_id % 10 WHEN 0 THEN b || '.' || a2 WHEN 1 THEN ' ' || b || '.5 ' WHEN 2 THEN 'nan'
       WHEN 3 THEN '-inf' WHEN 4 THEN 'Infinity' WHEN 5 THEN b || '.0f' WHEN 6 THEN '.' || b
       WHEN 7 THEN b || 'e-2' WHEN 8 THEN '0x1p3' ELSE b || '.' END AS t_float,
  CASE event_id % 10
       WHEN 0 THEN CAST(CAST(b || '.' || a2 AS DOUBLE) AS FLOAT)
       WHEN 1 THEN CAST(CAST(b || '.5' AS DOUBLE) AS FLOAT)
       WHEN 2 THEN CAST('nan' AS FLOAT)
       WHEN 3 THEN CAST('-inf' AS FLOAT)
       WHEN 4 THEN CAST('inf' AS FLOAT)
       WHEN 6 THEN CAST(CAST('0.' || b AS DOUBLE) AS FLOAT)
       WHEN 7 THEN CAST(CAST(b || 'e-2' AS DOUBLE) AS FLOAT)
       WHEN 9 THEN CAST(CAST(b AS DOUBLE) AS FLOAT) END AS as_float,
  CASE event_id % 7 WHEN 0 THEN mdy WHEN 1 THEN lpad(m, 2, '0') || '/' || lpad(d, 2, '0') || '/' || y
       WHEN 2 THEN '2/30/' || y WHEN 3 THEN m || '/' || d || '/' || lpad(CAST(yi % 100 AS VARCHAR), 2, '0')
       WHEN 4 THEN ' ' || mdy WHEN 5 THEN mdy || ' 1:00' ELSE '' END AS t_date,
  CASE WHEN event_id % 7 IN (0, 1) THEN CAST(ts AS DATE) END AS as_date,
  CASE event_id % 8 WHEN 0 THEN mdy || ' ' || hm
       WHEN 1 THEN lpad(m, 2, '0') || '/' || lpad(d, 2, '0') || '/' || y || ' ' || hh || ':' || mi
       WHEN 2 THEN mdy || '  ' || hm WHEN 3 THEN mdy || ' 24:00' WHEN 4 THEN mdy || ' ' || hh || ':60'
       WHEN 5 THEN ' ' || mdy || ' ' || hm
       WHEN 6 THEN mdy || ' 0' || lpad(hh, 2, '0') || ':' || lpad(mi, 2, '0')
       ELSE '2/29/' || y || ' 0:0' END AS t_ts,
  CASE WHEN event_id % 8 IN (0, 1, 2) THEN date_trunc('minute', ts)
       WHEN event_id % 8 = 7 AND yi % 4 = 0 AND (yi % 100 <> 0 OR yi % 400 = 0)
         THEN make_timestamp(yi, 2, 29, 0, 0, 0) END AS as_ts,
  CASE event_id % 6 WHEN 0 THEN whole || '.' || micro WHEN 1 THEN whole || '.' || substr(micro, 1, 1)
       WHEN 2 THEN whole WHEN 3 THEN whole || '.' || micro || '0' WHEN 4 THEN whole || '.'
       ELSE y || '-' || m || '-' || d || ' ' || hh || ':' || mi || ':' || ss || '.' || substr(micro, 1, 2)
       END AS t_frac,
  CASE event_id % 6 WHEN 0 THEN ts
       WHEN 1 THEN date_trunc('second', ts) + to_microseconds(CAST(substr(micro, 1, 1) AS BIGINT) * 100000)
       WHEN 5 THEN date_trunc('second', ts) + to_microseconds(CAST(substr(micro, 1, 2) AS BIGINT) * 10000)
       END AS as_frac
FROM t
"""

HEADER_STRIP = f"""
WITH {TRIPS_CTE}
SELECT CAST(count(*) + 1 AS BIGINT) AS n, CAST(1 AS BIGINT) AS n_null_trip_id FROM trips
"""

DIRTY_CTE = TRIPS_CTE + """,
trips_dirty AS (
  SELECT * REPLACE (
           CASE WHEN trip_id % 11 <> 0 THEN start_station END AS start_station,
           CASE WHEN trip_id % 22 <> 0 THEN end_station END AS end_station,
           CASE WHEN trip_id % 10 = 3 THEN '' ELSE zip END AS zip,
           CASE WHEN trip_id % 10 <> 4 THEN sub_type END AS sub_type)
  FROM trips)"""

NON_EMPTY_FILTER = f"""
WITH {DIRTY_CTE}
SELECT trip_id FROM trips_dirty
WHERE start_station <> '' AND end_station <> '' AND sub_type <> '' AND zip <> ''
"""

HALF = "TIMESTAMP '1998-05-01 00:00:00'"

STACK_COUNTS = f"""
WITH {TRIPS_CTE}
SELECT 'first' AS part, count(*) AS n FROM trips WHERE start_date < {HALF}
UNION ALL SELECT 'second' AS part, count(*) AS n FROM trips WHERE start_date >= {HALF}
UNION ALL SELECT 'all' AS part, count(*) AS n FROM trips
"""

STACK_DUPLICATES = f"""
WITH {TRIPS_CTE}
SELECT trip_id, count(*) AS n FROM (SELECT trip_id FROM trips UNION ALL SELECT trip_id FROM trips)
GROUP BY trip_id
"""

DAYS_BETWEEN = f"""
WITH {TRIPS_CTE}
SELECT trip_id, CAST(date_diff('day', start_date, end_date) AS INTEGER) AS duration FROM trips
"""

STATION_AVERAGE = f"""
WITH {TRIPS_NULLS_CTE}
SELECT trip_id, avg(duration) OVER (PARTITION BY start_station) AS average FROM trips_nulls
"""

ROUND_TRIP = f"""
WITH {TRIPS_NULLS_CTE}
SELECT trip_id, CAST(start_station IS NOT DISTINCT FROM end_station AS INTEGER) AS round_trip
FROM trips_nulls
"""

DAY_OF_WEEK = f"""
WITH {TRIPS_CTE}
SELECT trip_id, {day_sql('start_date')} AS start_day, {dow_sql(day_sql('start_date'))} AS start_dow
FROM trips
"""

TRIPS_PER_WEEKDAY = f"""
WITH {TRIPS_CTE}
SELECT {day_sql('start_date')} AS start_day, count(*) AS n FROM trips GROUP BY 1 ORDER BY 1
"""


def _station_counts(source: str) -> str:
    return f"""
d AS (SELECT *, {dow_sql(day_sql('start_date'))} AS start_dow FROM {source}),
s AS (
  SELECT start_station,
         CAST(count(*) FILTER (WHERE start_dow = 'weekday') AS BIGINT) AS weekday_trips,
         CAST(count(*) FILTER (WHERE start_dow = 'weekend') AS BIGINT) AS weekend_trips,
         CAST(count(*) AS BIGINT) AS total_trips
  FROM d GROUP BY start_station)"""


STATION_SHARES = f"""
WITH {TRIPS_NULLS_CTE},
{_station_counts('trips_nulls')}
SELECT start_station, weekday_trips, weekend_trips, total_trips,
       {share_sql('weekday_trips', 'total_trips')} AS pct_weekday,
       {share_sql('weekend_trips', 'total_trips')} AS pct_weekend
FROM s
"""

SHARES_JOINED = f"""
WITH {TRIPS_NULLS_CTE},
{_station_counts('trips_nulls')}
SELECT d.trip_id,
       {share_sql('s.weekday_trips', 's.total_trips')} AS pct_weekday,
       {share_sql('s.weekend_trips', 's.total_trips')} AS pct_weekend
FROM d LEFT JOIN s ON d.start_station = s.start_station
"""

FIRST_TRIPS = f"""
WITH {TRIPS_CTE}
SELECT trip_id, duration, start_date, start_station, sub_type FROM trips ORDER BY trip_id LIMIT 20
"""

TABLE_ROUNDTRIP = f"""
WITH {TRIPS_CTE}
SELECT start_station, count(*) AS n FROM trips GROUP BY start_station
"""


def _labels_sql(source: str, cols: list[tuple[str, str]]) -> str:
    """(col, value, n, idx, k) for the listed (name, text expression) pairs."""
    union = "\n  UNION ALL ".join(
        f"SELECT trip_id, '{name}' AS col, {expr} AS value FROM {source}" for name, expr in cols)
    return f"""
v AS (
  {union}),
c AS (SELECT col, value, count(*) AS n FROM v WHERE value IS NOT NULL GROUP BY col, value),
r AS (
  SELECT col, value, n,
         row_number() OVER (PARTITION BY col ORDER BY n DESC, value) - 1 AS idx,
         count(*) OVER (PARTITION BY col) AS k
  FROM c)"""


INDEX_COLS = [("start_station", "start_station"), ("sub_type", "sub_type"),
              ("duration", "CAST(duration AS VARCHAR)")]

STRING_INDEX = f"""
WITH {TRIPS_CTE},
{_labels_sql('trips', INDEX_COLS)}
SELECT col, value, CAST(idx AS INTEGER) AS idx FROM r
"""

ONE_HOT = f"""
WITH {TRIPS_CTE},
{_labels_sql('trips', INDEX_COLS)}
SELECT v.trip_id, v.col, CAST(r.idx AS INTEGER) AS slot, CAST(r.k AS INTEGER) AS width
FROM v JOIN r ON v.col = r.col AND v.value = r.value
"""

ALL_INPUT_TEXT = [("start_station", "start_station"), ("end_station", "end_station"), ("zip", "zip"),
                  ("duration", "CAST(duration AS VARCHAR)"), ("round_trip", "CAST(round_trip AS VARCHAR)"),
                  ("average", "CAST(average AS VARCHAR)"), ("start_day", "CAST(start_day AS VARCHAR)"),
                  ("start_dow", "start_dow")]


def _distinct_sum() -> str:
    parts = [f"count(DISTINCT {name})" for name, _ in ALL_INPUT_TEXT]
    return " + ".join(parts)


ASSEMBLE_SIZE = f"""
WITH {TRIPS_CTE},
{features_sql('trips')}
SELECT CAST({_distinct_sum()} AS INTEGER) AS size,
       CAST(count(*) AS BIGINT) AS rows,
       CAST(8 * count(*) AS BIGINT) AS nnz
FROM feat
"""

ASSEMBLE_NUMERIC = f"""
WITH {TRIPS_CTE},
{_labels_sql('trips', [('sub_type', 'sub_type')])}
SELECT t.trip_id, CAST(t.duration AS DOUBLE) AS f0, CAST(t.start_terminal AS DOUBLE) AS f1,
       CAST(r.idx AS DOUBLE) AS label
FROM trips t JOIN r ON r.col = 'sub_type' AND r.value = t.sub_type
"""


def bucket_sql(key: str) -> str:
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8))::BIGINT % 100)"


SPLIT_HASH = f"""
WITH {TRIPS_CTE}
SELECT CASE WHEN {bucket_sql('trip_id')} < 80 THEN 'train' ELSE 'valid' END AS part, count(*) AS n
FROM trips GROUP BY 1
"""

# Holds when the fitted model is intercept-only (every prediction is the
# most frequent label, index 0): accuracy = that label's share of the
# validation part.
LR_ACCURACY = f"""
WITH {TRIPS_CTE},
top AS (SELECT sub_type FROM trips GROUP BY sub_type ORDER BY count(*) DESC, sub_type LIMIT 1),
valid AS (SELECT sub_type FROM trips WHERE {bucket_sql('trip_id')} >= 80)
SELECT CAST(sum(CASE WHEN sub_type = (SELECT sub_type FROM top) THEN 1 ELSE 0 END) AS DOUBLE)
       / count(*) AS accuracy
FROM valid
"""

SPLIT_RANDOM = f"""
WITH {TRIPS_CTE}
SELECT count(*) AS n, count(DISTINCT trip_id) AS n_trips FROM trips
"""

INDEX_UNSEEN = f"""
WITH {TRIPS_CTE},
counts AS (SELECT zip, count(*) AS n FROM trips WHERE start_date < TIMESTAMP '1998-05-01' GROUP BY zip),
ranked AS (SELECT zip, row_number() OVER (ORDER BY n DESC, zip) - 1 AS idx FROM counts)
SELECT trip_id, CAST(coalesce(idx, (SELECT count(*) FROM counts)) AS INTEGER) AS idx
FROM trips LEFT JOIN ranked USING (zip) WHERE start_date >= TIMESTAMP '1998-05-01'
"""

BY_TERMINAL_CTE = TRIPS_CTE + """,
by_terminal AS (
  SELECT * REPLACE (CASE WHEN start_terminal < 4 THEN 'Customer' ELSE 'Subscriber' END AS sub_type) FROM trips)"""


def found_by(*models: str) -> str:
    """Each model classifies the whole validation part of ``by_terminal`` rightly."""
    names = ", ".join(f"('{m}')" for m in models)
    return f"""
WITH {BY_TERMINAL_CTE},
valid AS (SELECT count(*) AS n FROM by_terminal WHERE {bucket_sql('trip_id')} >= 80)
SELECT model, CAST(1 AS DOUBLE) AS accuracy, CAST(0 AS DOUBLE) AS test_error, n
FROM (VALUES {names}) AS m(model), valid
"""


# Labels by falling frequency; equal counts by text.
LR_SCORED = f"""
WITH {BY_TERMINAL_CTE},
ranked AS (SELECT sub_type, CAST(row_number() OVER (ORDER BY count(*) DESC, sub_type) - 1 AS DOUBLE) AS label
           FROM by_terminal GROUP BY sub_type)
SELECT trip_id, label, label AS prediction, CAST(1 AS INTEGER) AS above_half
FROM by_terminal JOIN ranked USING (sub_type) WHERE {bucket_sql('trip_id')} >= 80
"""

ALL_FEATURES_TABLE = f"""
WITH {TRIPS_NULLS_CTE},
{features_sql('trips_nulls')}
SELECT trip_id, average, round_trip, start_day, start_dow, pct_weekday, pct_weekend FROM feat
"""

ACCURACY_FROM_PAIRS = """
WITH p AS (SELECT CAST(CAST(quality = toxic AS INTEGER) AS DOUBLE) AS hit FROM labels)
SELECT count(*) AS n,
       sum(hit) / count(hit) AS accuracy,
       CAST(1 AS DOUBLE) - sum(hit) / count(hit) AS test_error
FROM p
"""

PERIOD_RELOAD = f"""
SELECT parsed.trip_id, parsed.duration, parsed.start_date, parsed.start_station, parsed.end_date, parsed.zip,
       CASE WHEN o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) < {HALF} THEN 'h1' ELSE 'h2' END AS period
FROM ({PARSE_TRIP_LINES}) AS parsed JOIN orders ON trip_id = o_orderkey
"""

# The station figures over the parsed trips: durations and start dates that did not parse are NULL.
INCREMENTAL_FEATURES = f"""
WITH parsed AS ({PARSE_TRIP_LINES}),
d AS (SELECT *, {dow_sql(day_sql('start_date'))} AS start_dow FROM parsed),
s AS (
  SELECT start_station, avg(duration) AS average, CAST(count(*) AS BIGINT) AS n,
         CAST(count(*) FILTER (WHERE start_dow = 'weekday') AS BIGINT) AS w,
         CAST(count(*) FILTER (WHERE start_dow = 'weekend') AS BIGINT) AS e
  FROM d GROUP BY start_station)
SELECT trip_id, average, {share_sql('w', 'n')} AS pct_weekday, {share_sql('e', 'n')} AS pct_weekend
FROM d JOIN s USING (start_station)
"""

MERGED_FEATURES = f"""
WITH {TRIPS_NULLS_CTE},
{features_sql('trips_nulls')}
SELECT trip_id, average, pct_weekday, pct_weekend FROM feat
"""

LOAD_AND_STACK_JOBS = f"""
WITH {TRIPS_CTE}
SELECT 'station' AS dataset, 2 * count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey
UNION ALL SELECT 'trip' AS dataset, count(*) AS n FROM trips
UNION ALL SELECT 'weather' AS dataset, count(*) AS n FROM orders
"""

STREAM_TRIP_PERIODS = f"""
WITH {TRIPS_CTE}
SELECT count(*) AS n,
       count(*) FILTER (WHERE trip_id % 10 IN (0, 1)) AS n_null_duration,
       count(*) FILTER (WHERE trip_id % 10 = 2) AS n_null_start
FROM trips
"""

def draw_sql(key: str, seed: int = 42) -> str:
    """The seeded draw of the random split, in 2^-32."""
    return f"('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT"


# 0.8 of the draws, which are compared as doubles.
TRAIN_DRAW = f"CAST({draw_sql('trip_id')} AS DOUBLE) / 4294967296 < CAST(0.8 AS DOUBLE)"

SPLIT_RANDOM_ROWS = f"""
WITH {TRIPS_CTE}
SELECT trip_id, CASE WHEN {TRAIN_DRAW} THEN 'train' ELSE 'valid' END AS part FROM trips
"""

JOB_RANDOM_SPLIT = f"""
WITH {TRIPS_CTE},
valid AS (SELECT count(*) AS n FROM trips WHERE NOT {TRAIN_DRAW})
SELECT model, CAST(1 AS DOUBLE) AS accuracy, CAST(0 AS DOUBLE) AS test_error, n
FROM (VALUES ('random_forest'), ('decision_tree')) AS m(model), valid
"""

RULES = f"""
WITH {TRIPS_CTE}
SELECT count(*) AS n, CAST(0 AS BIGINT) AS mismatches FROM trips WHERE {bucket_sql('trip_id')} >= 80
"""

LR_OPTIMALITY = f"""
WITH {TRIPS_CTE}
SELECT count(*) AS n, CAST(1 AS INTEGER) AS has_coefficients, CAST(1 AS INTEGER) AS optimal
FROM trips WHERE {bucket_sql('trip_id')} < 80
"""

# The penalised fit worked out anew. Trip duration tells nothing of the label, so its coefficient is 0, and
# the fit is that of one standardised feature, start_terminal: Newton steps on the counts per terminal, for a
# falling probability (the penalty's sign), with regParam 0.3 and elasticNet 0.8. The accuracy is that of the
# side of one half on which each terminal falls.
PENALISED_BY_HALF = f"""
WITH RECURSIVE {TRIPS_CTE},
parts AS (SELECT start_terminal, CAST(start_terminal < 12 AS INTEGER) AS y, {bucket_sql('trip_id')} < 80 AS train FROM trips),
scale AS (SELECT stddev_samp(start_terminal) AS sd, CAST(count(*) AS DOUBLE) AS n FROM parts WHERE train),
cells AS (SELECT list(start_terminal / sd) AS z, list(CAST(c AS DOUBLE)) AS c, list(y) AS y, any_value(n) AS n
          FROM (SELECT start_terminal, y, count(*) AS c FROM parts WHERE train GROUP BY ALL), scale),
newton AS (
  SELECT 0 AS step, CAST(0 AS DOUBLE) AS b, CAST(0 AS DOUBLE) AS w
  UNION ALL
  SELECT step + 1, b - (h22 * g1 - h12 * g2) / (h11 * h22 - h12 * h12),
                   w - (h11 * g2 - h12 * g1) / (h11 * h22 - h12 * h12)
  FROM (
    SELECT step, b, w, list_sum(e1) / n AS g1, list_sum(e2) / n - 0.24 + 0.06 * w AS g2,
           list_sum(q11) / n AS h11, list_sum(q12) / n AS h12, list_sum(q22) / n + 0.06 AS h22
    FROM (
      SELECT *,
        list_transform(range(1, len(z) + 1), lambda k: c[k] * (p[k] - y[k])) AS e1,
        list_transform(range(1, len(z) + 1), lambda k: c[k] * (p[k] - y[k]) * z[k]) AS e2,
        list_transform(range(1, len(z) + 1), lambda k: c[k] * p[k] * (1 - p[k])) AS q11,
        list_transform(range(1, len(z) + 1), lambda k: c[k] * p[k] * (1 - p[k]) * z[k]) AS q12,
        list_transform(range(1, len(z) + 1), lambda k: c[k] * p[k] * (1 - p[k]) * z[k] * z[k]) AS q22
      FROM (SELECT newton.*, cells.*, list_transform(z, lambda x: 1 / (1 + exp(-(b + w * x)))) AS p
            FROM newton, cells WHERE step < 30)))),
fit AS (SELECT b, w FROM newton WHERE step = 30),
hits AS (SELECT CAST((b + w * start_terminal / sd > 0) = (y = 1) AS INTEGER) AS hit FROM parts, fit, scale WHERE NOT train)
SELECT 'logistic_regression' AS model, CAST(sum(hit) AS DOUBLE) / count(*) AS accuracy,
       CAST(1 AS DOUBLE) - CAST(sum(hit) AS DOUBLE) / count(*) AS test_error, count(*) AS n
FROM hits
"""

WINDOW_FEATURES_TABLE = f"""
WITH {TRIPS_NULLS_CTE},
{features_sql('trips_nulls')}
SELECT trip_id, average, round_trip FROM feat
"""

FITTED_SCORED = f"""
WITH {TRIPS_CTE}
SELECT trip_id, CASE WHEN isodow(start_date) >= 6 THEN 'Customer' ELSE 'Subscriber' END AS predicted,
       CAST(1 AS INTEGER) AS same
FROM trips WHERE start_date >= {HALF}
"""

SQL: dict[str, str] = {
    "parse_trip_lines": PARSE_TRIP_LINES,
    "parse_station_lines": PARSE_STATION_LINES,
    "parse_weather_lines": PARSE_WEATHER_LINES,
    "load_trip_files": LOAD_TRIP_FILES,
    "load_mixed_folder": PARSE_TRIP_LINES,
    "checked_good": CHECKED_GOOD,
    "checked_rejects": CHECKED_REJECTS,
    "safe_casts": SAFE_CASTS,
    "header_strip": HEADER_STRIP,
    "non_empty_filter": NON_EMPTY_FILTER,
    "stack_counts": STACK_COUNTS,
    "stack_duplicates": STACK_DUPLICATES,
    "days_between": DAYS_BETWEEN,
    "station_average": STATION_AVERAGE,
    "round_trip": ROUND_TRIP,
    "day_of_week": DAY_OF_WEEK,
    "trips_per_weekday": TRIPS_PER_WEEKDAY,
    "station_shares": STATION_SHARES,
    "shares_joined": SHARES_JOINED,
    "first_trips": FIRST_TRIPS,
    "table_roundtrip": TABLE_ROUNDTRIP,
    "flagship_trip_features": FLAGSHIP,
    "period_reload": PERIOD_RELOAD,
    "incremental_features": INCREMENTAL_FEATURES,
    "merged_features": MERGED_FEATURES,
    "string_index": STRING_INDEX,
    "one_hot": ONE_HOT,
    "assemble_size": ASSEMBLE_SIZE,
    "assemble_numeric": ASSEMBLE_NUMERIC,
    "split_hash": SPLIT_HASH,
    "split_random": SPLIT_RANDOM,
    "index_unseen": INDEX_UNSEEN,
    "split_random_rows": SPLIT_RANDOM_ROWS,
    "bucketed_shares": SHARES_JOINED,
    "dt_rules": RULES,
    "rf_rules": RULES,
    "lr_optimality": LR_OPTIMALITY,
    "job_baseline_lr": PENALISED_BY_HALF,
    "job_window_lr": PENALISED_BY_HALF,
    "job_all_features_lr": found_by("logistic_regression"),
    "job_random_split": JOB_RANDOM_SPLIT,
    "window_features_table": WINDOW_FEATURES_TABLE,
    "fitted_scored": FITTED_SCORED,
    "trees_by_terminal": found_by("random_forest", "decision_tree"),
    "window_job_by_terminal": found_by("random_forest", "decision_tree"),
    "all_features_by_terminal": found_by("decision_tree"),
    "all_features_table": ALL_FEATURES_TABLE,
    "lr_scored": LR_SCORED,
    "lr_accuracy": LR_ACCURACY,
    "accuracy_from_pairs": ACCURACY_FROM_PAIRS,
    "load_and_stack_jobs": LOAD_AND_STACK_JOBS,
    "stream_trip_periods": STREAM_TRIP_PERIODS,
}
