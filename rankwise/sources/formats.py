"""File sources and sinks addressed by format name.

Everything goes through ``DataFrameReader`` / ``DataFrameWriter``, so
column pruning and filter pushdown reach parquet scans, and writes are
distributed (one file per task, no driver round trip).
"""
from __future__ import annotations

import contextlib
import datetime as _dt
import functools
import operator
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rankwise.contracts import conform
from rankwise.functions.columns import NULL_TOKEN, text_line
from rankwise.session import held_setting
from rankwise.sources.paths import dated_output_path, run_date_text

# Accepted format names (case-insensitive) and the Spark
# source each one maps to.
FORMATS = {"parquet": "parquet", "csv": "csv", "json": "json",
           "txt": "text", "text": "text"}
SAVE_MODES = ("overwrite", "errorifexists", "error", "append", "ignore")

# CSV options that round-trip empty strings, nulls, surrounding spaces,
# commas, quotes, line breaks and backslashes unchanged.
_CSV_COMMON = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "nullValue": NULL_TOKEN,
    "emptyValue": "",
}
CSV_WRITE_OPTIONS = {**_CSV_COMMON, "quoteAll": True}
# With a schema, check the header names against it instead of mapping
# columns by position (a reordered file would otherwise be misread).
CSV_READ_OPTIONS = {**_CSV_COMMON, "enforceSchema": False}


def resolve_format(name: str) -> str:
    """Spark source name for a format name; ``ValueError`` if unknown."""
    kind = FORMATS.get(str(name).lower())
    if kind is None:
        raise ValueError(f"Unsupported format: {name}")
    return kind


# Tasks per core that list the directories of a table, and the setting
# that says so (Spark's own value is a task each, to 10,000).
LISTING_TASKS_PER_CORE = 8
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

# What to do with a record that does not parse under the schema.
MALFORMED = ("fail", "null", "reject")
REJECT_COLUMN = "_malformed_record"


def _check_names(found: Sequence[str], schema: StructType, path: str) -> None:
    missing = [f.name for f in schema.fields if f.name not in found]
    if missing:
        raise ValueError(f"missing columns in {path}: {missing}")


def _csv_strings(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    """String columns of a CSV frame through ``change``."""
    return df.select(*[change(F.col(f"`{n}`")).alias(n) if t == "string" else F.col(f"`{n}`")
                       for n, t in df.dtypes])


def _escaped(value: Column) -> Column:
    """A leading backslash doubled, so that the text of the null token is no null."""
    return F.when(value.startswith("\\"), F.concat(F.lit("\\"), value)).otherwise(value)


def _unescaped(value: Column) -> Column:
    return F.when(value.startswith("\\"), F.substring(value, 2, 2 ** 31 - 1)).otherwise(value)


def _listing(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Directories are listed by few tasks, many each: a task costs more than a listing."""
    tasks = LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    return held_setting(spark, LISTING_TASKS,
                        str(min(tasks, int(spark.conf.get(LISTING_TASKS)))))


def read(spark: SparkSession, fmt: str, path: str | Sequence[str],
         schema: StructType | None = None, *,
         multiline: bool = False, malformed: str = "fail") -> DataFrame:
    """Read ``path`` as ``fmt``.

    With ``schema`` every column of it must be in the input: a missing one is a
    ``ValueError`` (parquet, before any row is read) or fails the scan (CSV, whose
    header is compared, and JSON). JSON has names in every record, so it is checked
    record by record, in the one scan that parses it: a record without the name of
    a column that may not be null is malformed, while a null written out is a null
    (``write`` writes them out). Nulls in the result are nulls of the file: a value
    or record that does not parse fails the job. ``malformed`` changes that for CSV
    and JSON: ``null`` keeps such rows with nulls, ``reject`` adds ``REJECT_COLUMN``
    with the record as it stood (see ``split_rejects``).

    CSV without a schema reads every column as a string. ``multiline`` (CSV)
    takes quoted line breaks as part of a value but makes files unsplittable;
    without it they are malformed records. CSV strings that begin with a backslash
    lose it: ``write`` doubles it, so that only ``\\N`` itself is null.
    """
    kind = resolve_format(fmt)
    if malformed not in MALFORMED:
        raise ValueError(f"unknown {malformed!r} for malformed; use one of {MALFORMED}")
    with _listing(spark):
        return _read(spark, kind, path, schema, multiline, malformed)


def _read(spark: SparkSession, kind: str, path: str | Sequence[str],
          schema: StructType | None, multiline: bool, malformed: str) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    if kind == "text":
        return spark.read.text(paths)
    if kind == "parquet":
        df = spark.read.parquet(*paths)
        if schema is None:
            return df
        _check_names(df.columns, schema, str(path))
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    if kind == "json" and schema is not None:
        return _json_rows(spark, paths, schema, malformed)
    reader = spark.read.option("mode", "FAILFAST" if malformed == "fail" else "PERMISSIVE")
    if schema is not None:
        wanted = schema
        if malformed == "reject":
            wanted = StructType([*schema.fields, StructField(REJECT_COLUMN, StringType())])
            reader = reader.option("columnNameOfCorruptRecord", REJECT_COLUMN)
        reader = reader.schema(wanted)
    if kind == "json":
        return reader.json(paths)
    options = dict(CSV_READ_OPTIONS)
    if malformed == "reject":
        # The extra column is not in the header, so names are compared here.
        options["enforceSchema"] = True
        if schema is not None:
            header = spark.read.options(**CSV_READ_OPTIONS).csv(paths).columns
            if header != schema.fieldNames():
                raise ValueError(f"columns of {path} are {header}, not {schema.fieldNames()}")
    if multiline:
        options["multiLine"] = True
    df = reader.options(**options).csv(paths)
    if malformed == "reject" and schema is not None:
        df = _with_whole_rejects(df)
    return _csv_strings(df, _unescaped)


def absent_names(record: Column, schema: StructType, parsed: str) -> Column:
    """Names of columns that may not be null and that a JSON record does not have.

    The names of a record are only looked up where ``parsed``, the struct read from
    it, has a null in such a column; so good records are gone through once.
    """
    names = [f.name for f in schema.fields if not f.nullable]
    none = F.array().cast("array<string>")
    if not names:
        return none
    some_null = functools.reduce(
        operator.or_, [F.col(parsed)[n].isNull() for n in names])
    there = F.coalesce(F.json_object_keys(record), none)
    return F.when(some_null, F.array_except(F.array(*map(F.lit, names)), there)).otherwise(none)


def json_records(spark: SparkSession, paths: Sequence[str], schema: StructType,
                 mode: str) -> DataFrame:
    """(record, row, absent): the lines of JSON files, each parsed under ``schema``
    with ``REJECT_COLUMN``, and the names that it should have and does not."""
    wanted = StructType([*schema.fields, StructField(REJECT_COLUMN, StringType())])
    lines = spark.read.text(list(paths)).filter(F.trim("value") != "")
    options = {"mode": mode}
    if mode == "PERMISSIVE":
        options["columnNameOfCorruptRecord"] = REJECT_COLUMN
    rows = lines.select(F.col("value").alias("record"),
                        F.from_json("value", wanted, options).alias("row"))
    return rows.select("record", "row", absent_names(F.col("record"), schema, "row").alias("absent"))


def _json_rows(spark: SparkSession, paths: Sequence[str], schema: StructType,
               malformed: str) -> DataFrame:
    rows = json_records(spark, paths, schema,
                        "FAILFAST" if malformed == "fail" else "PERMISSIVE")
    columns = [F.col("row")[f.name].alias(f.name) for f in schema.fields]
    lacks = F.size("absent") > 0
    if malformed == "fail":
        # Part of the struct, so that it is made whatever columns are used later; as
        # a filter it would parse the record once more.
        told = F.raise_error(F.concat(F.lit("missing columns in a record: "),
                                      F.array_join("absent", ", ")))
        return rows.select(F.when(lacks, told).otherwise(F.col("row")).alias("row")).select(*columns)
    if malformed == "null":
        return rows.select(*columns)
    bad = F.when(lacks | F.col("row")[REJECT_COLUMN].isNotNull(), F.col("record"))
    return _with_whole_rejects(rows.select(*columns, bad.alias(REJECT_COLUMN)))


def _with_whole_rejects(df: DataFrame) -> DataFrame:
    """Whether a record is malformed must not depend on the columns used later,
    so the reject column is made to need all of them; the size is never negative."""
    others = [F.col(f"`{c}`").cast("string") for c in df.columns if c != REJECT_COLUMN]
    bad = F.col(REJECT_COLUMN)
    return df.withColumn(REJECT_COLUMN, F.when(
        bad.isNotNull() & (F.size(F.array(*others)) >= 0), bad))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, records that did not) of a read with ``reject``.

    Both are lazy; counting the second tells how many records were rejected. The
    records are read whole for this, whatever columns are used later.
    """
    bad = F.col(REJECT_COLUMN).isNotNull()
    return df.filter(~bad).drop(REJECT_COLUMN), df.filter(bad).select(REJECT_COLUMN)


def bucket_name(columns: Sequence[str]) -> str:
    """The partition column of a table whose values of ``columns`` share directories."""
    return "_".join([*columns, "bucket"])


def _bucket(values: Sequence[Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*values), F.lit(buckets)).cast("int")


def of_value(df: DataFrame, column: str, value, buckets: int) -> DataFrame:
    """Rows of one value of a table written with ``buckets``: the other directories
    are not listed in the scan. A null value is found too."""
    typed = F.lit(value).cast(df.schema[column].dataType)
    return df.filter((F.col(bucket_name([column])) == _bucket([typed], buckets))
                     & F.col(column).eqNullSafe(typed))


def _dealt(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows by the columns ``parts``: a value in one task, a hot one in several.

    Rows of a value come together, so that it makes one file (no tasks x values small
    files), by a rebalance in which AQE cuts a hot value into pieces. It also merges
    small values, by their bytes, while a directory costs time whatever it holds: one
    task would make thousands. So values and pieces are dealt out once more, by number.
    """
    spark, piece = df.sparkSession, "_piece_of_value"
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                spark.sparkContext.defaultParallelism)
    cut = df.hint("rebalance", *parts).withColumn(piece, F.spark_partition_id())
    return cut.repartition(tasks, *[F.col(f"`{c}`") for c in parts], piece).drop(piece)


def write(df: DataFrame, fmt: str, path: str, *, mode: str = "overwrite",
          run_date: str | _dt.date | None = None, dated: bool = True,
          schema: StructType | None = None,
          partition_by: Sequence[str] = (), text_sep: str = ",",
          date_column: str | None = None, buckets: int | None = None,
          rows_per_file: int | None = None) -> str:
    """Write ``df`` as ``fmt`` and return the path actually written.

    ``dated`` stamps the run date into ``path`` (see ``dated_output_path``). With
    ``date_column`` the path stays as it is and the run date is a partition column
    of that name instead: all runs are one table, and ``overwrite`` replaces the
    partitions of this run's date alone.
    ``schema`` conforms the rows to a contract first (order, types,
    non-null values); text renders each row as one delimited line;
    ``partition_by`` writes one directory per value, by all tasks alike (see ``_dealt``). With
    ``buckets`` the values share that many directories by a hash instead
    (``bucket_name``), sorted by value and still in the rows, so that many small
    values make few files; ``of_value`` finds a value in its directory alone.
    ``rows_per_file`` splits what is larger.
    """
    kind = resolve_format(fmt)
    if mode not in SAVE_MODES:
        raise ValueError(f"unknown save mode {mode!r}; use one of {SAVE_MODES}")
    target = dated_output_path(path, run_date) if dated and not date_column else path
    if schema is not None:
        df = conform(df, schema)
    parts = list(partition_by)
    if buckets is not None:
        if buckets < 1 or not parts:
            raise ValueError("buckets are 1 at least, and of the columns in partition_by")
        df = df.withColumn(bucket_name(parts), _bucket([F.col(c) for c in parts], buckets))
        inside, parts = parts, [bucket_name(parts)]
    if date_column:
        if date_column in df.columns:
            raise ValueError(f"the rows have a column {date_column!r} already")
        df = df.withColumn(date_column, F.lit(run_date_text(run_date)).cast("date"))
    if kind == "text":
        beside = [*parts, *([date_column] if date_column else [])]
        body = [c for c in df.columns if c not in beside]
        df = df.select(text_line(body, text_sep).alias("value"), *map(F.col, beside))
    if parts:
        df = _dealt(df, parts)
        if buckets is not None and kind != "text":
            df = df.sortWithinPartitions(*parts, *inside)
    if kind == "csv":
        df = _csv_strings(df, _escaped)
    writer = df.write.mode(mode)
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if date_column:
        # One value a run: it needs no rebalance of its own.
        parts = [date_column, *parts]
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if parts:
        writer = writer.partitionBy(*parts)
    if kind == "csv":
        writer = writer.options(**CSV_WRITE_OPTIONS)
    if kind == "json":
        # A null is written out: a record without the name would be malformed.
        writer = writer.option("ignoreNullFields", False)
    writer.format(kind).save(target)
    return target
