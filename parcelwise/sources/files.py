"""Reading typed tables from CSV and auditing what has landed."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise.functions.cleaning import (
    CSV_NULL_WORDS,
    LOAD_NULL_WORDS,
    null_words,
    strip_text,
    to_real,
    to_stamp,
    to_whole,
)
from parcelwise.schemas import FEATURE_TABLE, PREDICTIONS, RAW_TABLES, TableSpec
from parcelwise.session import scratch_dir
from parcelwise.sources import csv_ranges


def _serial_reader(spark: SparkSession, spec: TableSpec) -> DataFrameReader:
    return (
        spark.read.schema(spec.text_schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("multiLine", spec.multiline)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def read_text_csv(spark: SparkSession, path: str | list[str], spec: TableSpec, pattern: str | None = None) -> DataFrame:
    """All columns as text, mapped by position. Only files matching ``pattern`` are read; a torn row aborts the read.

    Tables declared multi-line are read by byte ranges too (:mod:`csv_ranges`), after a first pass that counts quotes; only
    files with quotes in places where parity can't be relied on are read whole, by one task each.
    """
    reader = _serial_reader(spark, spec)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if not spec.multiline:
        return reader.csv(path)
    records, whole_files = csv_ranges.records(spark, path, partial(_stored, label="csv-ranges"), pattern)
    rows = csv_ranges.parsed(records, spec.text_schema).select("parsed.*")
    return rows.unionAll(reader.csv(whole_files)) if whole_files else rows


def bad_rows(spark: SparkSession, path: str | list[str], spec: TableSpec, pattern: str | None = None) -> DataFrame:
    """file, key (the row's first value) and record of every row on which :func:`read_text_csv` aborts, for looking into an
    aborted load: rows with too many or too few values. The files are read anew, multi-line ones by one task each."""
    schema = T.StructType([*spec.text_schema.fields, T.StructField("_record", T.StringType())])
    reader = _serial_reader(spark, spec).schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_record")
    reader = reader.option("columnPruning", False)  # else only the values that are asked for are counted
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    key = F.col(schema[0].name).alias("key")
    return reader.csv(path).filter("_record is not null").select(F.col("_metadata.file_path").alias("file"), key, F.col("_record").alias("record"))


def bad_row_report(bad: DataFrame, first: int = 5) -> DataFrame:
    """file, bad_rows and the ``first`` records of each file with rows of :func:`bad_rows`, in the file's order."""
    placed = _stored(bad.withColumn("at", F.monotonically_increasing_id()), "bad-rows")
    rank = F.row_number().over(Window.partitionBy("file").orderBy("at"))
    examples = placed.withColumn("rank", rank).filter(F.col("rank") <= first).groupBy("file")
    examples = examples.agg(F.array_sort(F.collect_list(F.struct("rank", "record")))["record"].alias("records"))
    return placed.groupBy("file").agg(F.count("*").alias("bad_rows")).join(examples, "file")


def _stored(rows: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def typed(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Missing-value words to NULL, text stripped, dates and numbers cast with failures as NULL, repeated rows dropped."""
    casts = {T.StringType(): strip_text, T.TimestampNTZType(): to_stamp, T.DoubleType(): to_real, T.LongType(): to_whole}
    columns = [
        casts[kind](null_words(F.col(name), CSV_NULL_WORDS)).alias(name) for name, kind in spec.columns.items()
    ]
    return rows.select(*columns).dropDuplicates()


def load_nulls(rows: DataFrame, words: Iterable[str] = LOAD_NULL_WORDS) -> DataFrame:
    """The table load's missing-value words, for every text column."""
    words = tuple(words)
    return rows.select(
        *[
            (null_words(F.col(f.name), words) if isinstance(f.dataType, T.StringType) else F.col(f.name)).alias(f.name)
            for f in rows.schema
        ]
    )


def read_typed_csv(spark: SparkSession, path: str, table: str, pattern: str | None = None) -> DataFrame:
    spec = RAW_TABLES[table]
    return load_nulls(typed(read_text_csv(spark, path, spec, pattern), spec))


def read_features_csv(spark: SparkSession, path: str) -> DataFrame:
    """The exported feature table, columns by their header's names in any order and case, others left out.

    Numbers are read as real ones, also where the table declares whole ones; what is no number is NULL. A missing column
    and files with different headers are errors.
    """
    text = spark.read.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    present = {name.strip().lower(): name for name in text.columns}
    missing = [name for name in FEATURE_TABLE.columns if name not in present]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    casts = {T.StringType(): strip_text, T.BooleanType(): lambda column: strip_text(column).try_cast("boolean")}
    return text.select(
        *[casts.get(kind, to_real)(F.col(f"`{present[name]}`")).alias(name) for name, kind in FEATURE_TABLE.columns.items()]
    )


def read_predictions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Predictions by position, with the table load's missing-value words; unreadable times become NULL."""
    text = load_nulls(read_text_csv(spark, path, PREDICTIONS))
    return text.withColumn("predicted_at", F.col("predicted_at").try_cast("timestamp"))


def by_position(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rename columns by position; a different width is an error."""
    if len(rows.columns) != len(spec.columns):
        raise ValueError(f"{spec.name}: expected {len(spec.columns)} columns, found {len(rows.columns)}")
    return rows.toDF(*spec.columns)


def _table_of(path: Column) -> Column:
    """Table a file belongs to: by its name pattern, by the table's plain name, else by the folder it lies in."""
    name = F.element_at(F.split(path, "/"), -1)
    table = F.lit(None).cast("string")
    for spec in RAW_TABLES.values():
        pattern = "^" + re.escape(spec.file_glob).replace(r"\*", ".*") + "$"
        table = F.coalesce(table, F.when(name.rlike(pattern) | (name == f"{spec.name}.csv"), spec.name))
    return F.coalesce(table, F.element_at(F.split(path, "/"), -2))


def listed_files(spark: SparkSession, folder: str) -> DataFrame:
    """path, table_name of every CSV file below ``folder``, flat or nested. File contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(folder)
    return files.select("path", "length", _table_of(F.col("path")).alias("table_name"))


def table_paths(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """The files of every declared table, by the same listing as the audit."""
    found: dict[str, list[str]] = {}
    for row in listed_files(spark, folder).orderBy("path").collect():  # file names, which Spark lists on the driver anyway
        if row.table_name in RAW_TABLES:
            found.setdefault(row.table_name, []).append(row.path)
    return found


def missing_tables(spark: SparkSession, folder: str, expected: Iterable[str] = tuple(RAW_TABLES)) -> DataFrame:
    """Expected tables without a CSV file below ``folder``. Lists paths only; file contents are not read."""
    wanted = spark.createDataFrame([(name,) for name in expected], "table_name string")
    landed = listed_files(spark, folder).select("table_name").distinct()
    return wanted.join(landed, "table_name", "left_anti")


def require_tables(spark: SparkSession, folder: str, policy: str = "fail", expected: Iterable[str] = tuple(RAW_TABLES)) -> list[str]:
    """Names that have landed. ``fail`` raises if any is missing, ``skip`` leaves the missing ones out."""
    expected = tuple(expected)
    absent = {row.table_name for row in missing_tables(spark, folder, expected).collect()}  # at most one row per declared table
    if absent and policy == "fail":
        raise FileNotFoundError(f"tables not landed: {sorted(absent)}")
    return [name for name in expected if name not in absent]


def row_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, and their sum under ``total``."""
    counts = [rows.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, rows in tables.items()]
    each = reduce(DataFrame.unionByName, counts)
    return each.rollup("table_name").agg(F.sum("row_count").alias("row_count")).select(
        F.coalesce("table_name", F.lit("total")).alias("table_name"), "row_count"
    )
