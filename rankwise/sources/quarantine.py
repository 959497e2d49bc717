"""Inputs held to a contract row by row: good rows one place, the others another.

``read_checked`` gives every record of an input with the reason why it breaks the
contract, if it does; ``write_split`` writes both kinds in one pass. Nothing is lost
and nothing stops the job: the rows that break the contract stay readable, each with
its reason and, where it did not parse, the record as it stood.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rankwise.sources.formats import REJECT_COLUMN, json_records, read, resolve_format

REASON, RECORD, PLACE = "_reason", "_record", "_place"
KEPT, QUARANTINED = "kept", "quarantined"
MALFORMED_RECORD = "malformed record"


def _null_reasons(schema: StructType) -> list[Column]:
    """One column per field that may not be null: its reason where it is."""
    return [F.when(F.col(f"`{f.name}`").isNull(), F.lit(f"null {f.name}"))
            for f in schema.fields if not f.nullable]


def reasons(schema: StructType) -> list[str]:
    """All the reasons that ``read_checked`` may give for a contract."""
    names = [f.name for f in schema.fields]
    required = [f.name for f in schema.fields if not f.nullable]
    return [MALFORMED_RECORD, *[f"missing {n}" for n in required],
            *[f"unreadable {n}" for n in names], *[f"null {n}" for n in required]]


def read_checked(spark: SparkSession, fmt: str, path: str | Sequence[str], schema: StructType, *,
                 multiline: bool = False) -> DataFrame:
    """The columns of ``schema``, ``_reason`` (null for a good row) and ``_record``.

    A row has the first reason that holds: ``malformed record`` (CSV and JSON: it does
    not parse), ``missing <column>`` (JSON: a name that must be there is not),
    ``unreadable <column>`` (parquet: the value has no value in the contract's type)
    and ``null <column>`` (a null where none may be), columns in the contract's order.
    ``_record`` is the text of a CSV or JSON record that is malformed or misses a name.
    A parquet input without a column of the contract is a ``ValueError``; a CSV one
    fails on its header. One scan; an empty input gives no row.
    """
    kind = resolve_format(fmt)
    names, nulls = schema.fieldNames(), _null_reasons(schema)
    if kind == "json":
        rows = json_records(spark, [path] if isinstance(path, str) else path, schema, "PERMISSIVE")
        bad = F.col("row")[REJECT_COLUMN].isNotNull()
        rows = rows.select(*[F.col("row")[n].alias(n) for n in names], "record", "absent",
                           bad.alias("bad"))
        reason = F.coalesce(F.when(F.col("bad"), F.lit(MALFORMED_RECORD)),
                            F.when(F.size("absent") > 0, F.concat(
                                F.lit("missing "), F.get("absent", F.lit(0)))), *nulls)
        record = F.when(F.col("bad") | (F.size("absent") > 0), F.col("record"))
        return rows.select(*names, reason.alias(REASON), record.alias(RECORD))
    if kind == "csv":
        rows = read(spark, fmt, path, schema, multiline=multiline, malformed="reject")
        reason = F.coalesce(F.when(F.col(REJECT_COLUMN).isNotNull(), F.lit(MALFORMED_RECORD)), *nulls)
        return rows.select(*names, reason.alias(REASON), F.col(REJECT_COLUMN).alias(RECORD))
    if kind == "parquet":
        rows = read(spark, fmt, path)
        missing = [n for n in names if n not in rows.columns]
        if missing:
            raise ValueError(f"missing columns in {path}: {missing}")
        cast = rows.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name)
                             for f in schema.fields],
                           F.array(*[F.when(F.col(f"`{f.name}`").isNotNull()
                                            & F.col(f"`{f.name}`").try_cast(f.dataType).isNull(),
                                            F.lit(f"unreadable {f.name}"))
                                     for f in schema.fields]).alias("unreadable"))
        reason = F.coalesce(F.get(F.array_compact("unreadable"), F.lit(0)), *nulls)
        return cast.select(*names, reason.alias(REASON), F.lit(None).cast("string").alias(RECORD))
    raise ValueError(f"{fmt} input has no columns; use parquet, csv or json")


@dataclass(frozen=True)
class Split:
    """Where ``write_split`` put the rows, and how many of each reason there are."""
    path: str
    schema: StructType
    kept_rows: int
    reasons: dict[str, int]          # of the quarantined rows

    def _read(self, spark: SparkSession, place: str, columns: Sequence[StructField]) -> DataFrame:
        whole = StructType([*self.schema.fields, StructField(REASON, StringType()),
                            StructField(RECORD, StringType()), StructField(PLACE, StringType())])
        # The place is a folder, so only its files are listed and read.
        return spark.read.schema(whole).parquet(self.path).filter(F.col(PLACE) == place) \
            .select(*[F.col(f"`{f.name}`") for f in columns])

    def kept(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, KEPT, self.schema.fields)

    def quarantined(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, QUARANTINED, [*self.schema.fields, StructField(REASON, StringType()),
                                               StructField(RECORD, StringType())])


def write_split(checked: DataFrame, path: str, schema: StructType, *, mode: str = "errorifexists") -> Split:
    """Write the rows of ``read_checked`` in one pass: those that keep the contract to
    ``path/_place=kept``, the others to ``path/_place=quarantined``, as parquet."""
    seen = Observation()
    known = reasons(schema)
    counts = [F.count_if(F.col(REASON).isNull()).alias("kept")]
    counts += [F.count_if(F.col(REASON) == r).alias(f"r{i}") for i, r in enumerate(known)]
    place = F.when(F.col(REASON).isNull(), F.lit(KEPT)).otherwise(F.lit(QUARANTINED))
    checked.observe(seen, *counts).withColumn(PLACE, place) \
        .write.mode(mode).partitionBy(PLACE).parquet(path)
    found = {r: seen.get[f"r{i}"] for i, r in enumerate(known) if seen.get[f"r{i}"]}
    return Split(path, schema, seen.get["kept"], found)
