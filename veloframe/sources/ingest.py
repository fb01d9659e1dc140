"""Delimited-text ingest: lines -> typed DataFrame.

``parse_lines`` is the whole conversion as one ``select`` over a DataFrame
of text lines: drop header lines, split on every comma (no quoting, fields
kept as they are, trailing empty fields kept), then convert field ``i`` with
the safe cast of the schema's type and bind it to the field's name. Surplus
fields are ignored. The plan is map-only: no shuffle, no Python worker, and
Catalyst prunes the conversions of unused fields.

``load_delimited`` adds the file scan (``spark.read.text``), so the text is
split into tasks by Spark's file splitting (``spark.sql.files.maxPartitionBytes``).
``load_checked`` routes ill-formed lines to a table of rejects instead.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from veloframe.functions import casts
from veloframe.sources.catalog import cut_lineage, drop_files
from veloframe.sources.schemas import TEXT_FORMAT

# Field separator and the name of the text column of a line scan.
DELIMITER = ","
LINE_COLUMN = "value"

MODES = ("fail", "null")

#: Columns of a scan by file and of its findings, and the kinds of ill-formed lines.
FILE_COLUMN, REASON = "__file", "__reason"
SHORT, UNPARSABLE = "short", "unparsable"
#: A line has this many bytes, about, at least: bounds a file's lines by its size.
LEAST_LINE_BYTES = 16


def converter_for(data_type: DataType, text_format: str | None = None) -> Callable[[Column], Column]:
    """The safe cast used for a schema field of ``data_type`` (one stage)."""
    staged = staged_converter(data_type, text_format)
    if staged is not None:
        pattern, finish = staged
        return lambda c: finish(casts.text_parts(c, pattern)).cast(data_type)
    if isinstance(data_type, IntegerType):
        return casts.safe_int
    if isinstance(data_type, LongType):
        return casts.safe_long
    if isinstance(data_type, FloatType):
        return casts.safe_float
    if isinstance(data_type, DoubleType):
        return casts.safe_double
    if isinstance(data_type, StringType):
        return lambda c: c
    raise TypeError(f"no text converter for {data_type.simpleString()}")


def staged_converter(data_type: DataType, text_format: str | None = None):
    """(pattern, builder) for date/time fields, else None.

    ``text_format`` (a field's ``text_format`` metadata) picks the grammar
    explicitly; otherwise dates use ``%m/%d/%Y`` and timestamps
    ``%m/%d/%Y %H:%M``. The built value is cast to ``data_type``.
    """
    if text_format is None:
        if isinstance(data_type, DateType):
            text_format = casts.DATE_FORMAT
        elif isinstance(data_type, (TimestampNTZType, TimestampType)):
            text_format = casts.DATETIME_FORMAT
        else:
            return None
    if text_format not in casts.STAGED:
        raise ValueError(f"unsupported text format {text_format!r}")
    return casts.STAGED[text_format]


def drop_header(lines: DataFrame, header: str | None, column: str = LINE_COLUMN) -> DataFrame:
    """Drop every line equal to ``header``, wherever it stands."""
    if header is None:
        return lines
    return lines.where(F.col(column) != F.lit(header))


def split_fields(column: str = LINE_COLUMN) -> Column:
    """Split a line on every delimiter; trailing empty fields are kept."""
    return F.split(F.col(column), DELIMITER, -1)


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text_sql(data_type: DataType, x: str) -> str:
    """SQL form of ``converter_for`` for a non-date field."""
    if isinstance(data_type, IntegerType):
        return casts.int_sql(x)
    if isinstance(data_type, LongType):
        return casts.int_sql(x, "BIGINT")
    if isinstance(data_type, FloatType):
        return casts.float_sql(x)
    if isinstance(data_type, DoubleType):
        return casts.double_sql(x)
    if isinstance(data_type, StringType):
        return x
    raise TypeError(f"no text converter for {data_type.simpleString()}")


def parse_lines(lines: DataFrame, schema: StructType, header: str | None = None,
                mode: str = "fail", converters: Mapping[str, Callable[[Column], Column]] | None = None,
                column: str = LINE_COLUMN) -> DataFrame:
    """Typed rows from a DataFrame of text lines.

    ``mode='fail'`` fails the job on a line with fewer fields than the
    schema; ``mode='null'`` gives NULL for the missing fields instead.
    ``converters`` overrides the conversion of single fields by name.

    Stage 0 splits each line once; stage 1 projects every field's text, or
    for dates and times the array of their numeric parts; stage 2 builds the
    typed values. Catalyst keeps the stages apart (their columns are not
    cheap and are read more than once), so no split runs twice. The
    projections are written as SQL expression text, so a wide record costs
    a few driver calls rather than thousands.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    staged_lines, exprs = _staged(drop_header(lines, header, column), schema, converters, column)
    if mode == "fail":
        # one check per line; a filter is never pruned away with unused fields
        staged_lines = staged_lines.where(
            f"CASE WHEN __short THEN raise_error(concat('expected {len(schema.fields)} fields, got a line: ', "
            f"{_ident(column)})) ELSE true END")
    if all(isinstance(e, str) for e in exprs):
        return staged_lines.selectExpr(*exprs)
    return staged_lines.select(*[F.expr(e) if isinstance(e, str) else e for e in exprs])


def _staged(lines: DataFrame, schema: StructType, converters: Mapping[str, Callable[[Column], Column]] | None,
            column: str, keep: Sequence[str] = ()) -> tuple[DataFrame, list[str | Column]]:
    """The lines split and their fields prepared, and the projection of each typed field (SQL text, or a
    Column where a converter is given). ``keep`` carries further columns along, here and below."""
    converters = dict(converters or {})
    width = len(schema.fields)
    line, kept = _ident(column), [_ident(k) for k in keep]
    lines = lines.selectExpr(line, *kept, f"split({line}, '{DELIMITER}', -1) AS __fields")
    stage1 = [line, *kept, f"size(__fields) < {width} AS __short", *(["__fields"] if keep else [])]
    builders = []
    for i, field in enumerate(schema.fields):
        raw = f"get(__fields, {i})"
        staged = None if field.name in converters else staged_converter(
            field.dataType, (field.metadata or {}).get(TEXT_FORMAT))
        if staged is not None:
            pattern, _ = staged
            stage1.append(f"{casts.text_parts_sql(raw, pattern)} AS __f{i}")
            builders.append(casts.STAGED_SQL[_format_of(field)][1])
        else:
            stage1.append(f"{raw} AS __f{i}")
            builders.append(None if field.name in converters else
                            (lambda x, t=field.dataType: _text_sql(t, x)))
    exprs = [converters[f.name](F.col(f"__f{i}")).cast(f.dataType).alias(f.name) if b is None else
             f"CAST({b(f'__f{i}')} AS {f.dataType.simpleString()}) AS {_ident(f.name)}"
             for i, (b, f) in enumerate(zip(builders, schema.fields))]
    return lines.selectExpr(*stage1), exprs


def _format_of(field) -> str:
    fmt = (field.metadata or {}).get(TEXT_FORMAT)
    if fmt is not None:
        return fmt
    return casts.DATE_FORMAT if isinstance(field.dataType, DateType) else casts.DATETIME_FORMAT


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text files as a DataFrame of lines (``value string``)."""
    return spark.read.text(path)


def first_line(lines: DataFrame, column: str = LINE_COLUMN) -> str | None:
    """The first line of a scan (one row to the driver, nothing more)."""
    row = lines.select(column).first()
    return None if row is None else row[0]


def read_file_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S1 with each line's file: ``value``, the file's path and size, and where the line's block starts."""
    m = F.col("_metadata")
    return spark.read.text(path).select(
        LINE_COLUMN, m["file_path"].alias(FILE_COLUMN), m["file_size"].alias("__size"),
        m["file_block_start"].alias("__block"))


def file_headers(file_lines: DataFrame) -> DataFrame:
    """(file, header, rows at most): the first line of each file, found on the executors.

    Only a file's first block is looked at; within a task lines come in file order, so the first is the one
    with the least row number, and each map task sends one row per file. ``__rows`` is a bound on the file's
    lines by its size, for joins that split large files.
    """
    numbered = (file_lines.where(F.col("__block") == 0)
                .withColumn("__row", F.monotonically_increasing_id()))
    return numbered.groupBy(FILE_COLUMN).agg(
        F.min_by(LINE_COLUMN, "__row").alias("__header"),
        F.ceil(F.max("__size") / LEAST_LINE_BYTES).cast("long").alias("__rows"))


def drop_file_headers(file_lines: DataFrame) -> DataFrame:
    """S2 per file: drops every line equal to the first line of its own file; keeps ``value`` and the file.

    The headers, a row per file, are joined back to the lines (``relational.attach``: broadcast within its
    bound, else by shuffle with large files split). Two jobs run here, however many files there are.
    """
    from veloframe.operators.relational import attach

    lines = file_lines.select(LINE_COLUMN, FILE_COLUMN)
    joined = attach(lines, file_headers(file_lines), FILE_COLUMN, weight="__rows")
    return joined.where(~F.col(LINE_COLUMN).eqNullSafe(F.col("__header"))).drop("__header")


def load_delimited(spark: SparkSession, path: str | list[str], schema: StructType,
                   header: str | None = "first", mode: str = "fail",
                   converters: Mapping[str, Callable[[Column], Column]] | None = None,
                   required_text: list[str] | None = None) -> DataFrame:
    """Scan, strip the header, split, convert, bind the schema.

    ``header='file'`` takes the first line of every file as the header of that file and drops every line of
    the file equal to it, for any number of files and folders (two jobs in all; see ``drop_file_headers``).
    ``header='first'`` loads each path on its own and takes the first line of the path as the header of all
    its files (one job of one row per path runs here); the rows are stacked. Pass a string to name the header
    of all paths, or ``None`` for files without one. ``required_text`` keeps only rows whose named text
    fields are non-empty (and not NULL).
    """
    from veloframe.operators.relational import non_empty, stack

    if header == "file":
        lines = drop_file_headers(read_file_lines(spark, path))
        df = parse_lines(lines, schema, mode=mode, converters=converters)
        return non_empty(df, required_text) if required_text else df
    parts = []
    for one in [path] if isinstance(path, str) else path:
        lines = read_lines(spark, one)
        own = first_line(lines) if header == "first" else header
        parts.append(parse_lines(lines, schema, header=own, mode=mode, converters=converters))
    df = stack(*parts)
    return non_empty(df, required_text) if required_text else df


def checked_lines(file_lines: DataFrame, schema: StructType,
                  converters: Mapping[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """S4 with findings: line, file, the typed fields, and ``REASON`` where the line is ill-formed.

    A line is ``short`` if it has fewer fields than the schema, else ``unparsable`` if some field's text is
    neither empty nor blank and has no value of its type; the reason names those fields. Surplus fields are
    ignored, as in ``parse_lines``. Map-only.
    """
    width = len(schema.fields)
    staged, exprs = _staged(file_lines, schema, converters, LINE_COLUMN, [FILE_COLUMN])
    typed = staged.select(F.col(LINE_COLUMN).alias("__line"), FILE_COLUMN, "__short", "__fields",
                          *[F.expr(e) if isinstance(e, str) else e for e in exprs])
    bad = [f"CASE WHEN {_ident(f.name)} IS NULL AND trim(get(__fields, {i})) <> '' THEN '{f.name}' END"
           for i, f in enumerate(schema.fields) if not isinstance(f.dataType, StringType)]
    named = f"concat_ws(' ', {', '.join(bad)})" if bad else "''"
    reason = (f"CASE WHEN __short THEN concat('{SHORT}: ', size(__fields), ' of {width} fields') "
              f"WHEN {named} <> '' THEN concat('{UNPARSABLE}: ', {named}) END")
    return typed.selectExpr("__line", FILE_COLUMN, f"{reason} AS {REASON}", *[_ident(f.name) for f in schema.fields])


@dataclass(frozen=True)
class CheckedLoad:
    """Rows of well-formed lines; (file, line, reason) of the others; and counts by kind."""

    good: DataFrame
    rejects: DataFrame
    counts: dict[str, int]
    table: DataFrame

    def drop(self) -> None:
        """Remove the written pass, when neither side is read any more."""
        drop_files(self.table)


def load_checked(spark: SparkSession, path: str | list[str], schema: StructType, header: str | None = "file",
                 reject: Sequence[str] = (SHORT, UNPARSABLE),
                 converters: Mapping[str, Callable[[Column], Column]] | None = None) -> CheckedLoad:
    """S4/S6 without loss: one pass over the lines writes well-formed rows and rejects side by side.

    ``reject`` names the kinds that are turned away; unparsable fields of a line that stays are NULL, and
    so are the missing ones. ``header`` is as in ``load_delimited`` (``'file'``, a given line, or None).
    The pass is one job that writes below the session's shared folder, split by outcome, so reading one
    side never reads the other; the counts (``lines``, ``short``, ``unparsable``, ``rejected``) are taken
    from one narrow column of what it wrote. They are not observed in the pass: a session that has used
    ``Observation`` can no longer run a classifier that it has just fitted (Spark 4.1: the model's summary
    holds the session, whose observations cannot be sent to executors).
    """
    if unknown := set(reject) - {SHORT, UNPARSABLE}:
        raise ValueError(f"unknown kinds {sorted(unknown)}")
    lines = read_file_lines(spark, path)
    lines = drop_file_headers(lines) if header == "file" else drop_header(lines, header).drop("__size", "__block")
    kind = F.split(REASON, ":")[0]
    turned = F.coalesce(kind.isin(*reject), F.lit(False)) if reject else F.lit(False)
    checked = checked_lines(lines, schema, converters).withColumns({"__kind": kind, "__rejected": turned})
    kept = ["__line", FILE_COLUMN, REASON]
    routed = checked.select(
        *[F.when(F.col("__rejected"), F.col(c)).alias(c) for c in kept], "__kind",
        *[F.when(~F.col("__rejected"), F.col(_ident(f.name))).alias(f.name) for f in schema.fields],
        F.when(F.col("__rejected"), F.lit("reject")).otherwise(F.lit("good")).alias("__outcome"))
    table = cut_lineage(routed, "checked", partition_by=["__outcome"])
    counts = table.agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("__kind") == SHORT).alias(SHORT),
                       F.count_if(F.col("__kind") == UNPARSABLE).alias(UNPARSABLE),
                       F.count_if(F.col("__outcome") == "reject").alias("rejected")).first()
    good = table.where(F.col("__outcome") == "good").select(*[F.col(_ident(f.name)) for f in schema.fields])
    rejects = table.where(F.col("__outcome") == "reject").select(
        F.col(FILE_COLUMN).alias("file"), F.col("__line").alias("line"), F.col(REASON).alias("reason"))
    return CheckedLoad(good, rejects, counts.asDict(), table)
