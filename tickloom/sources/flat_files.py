"""Dated CSV / CSV.gz flat files, read in batch or as a stream.

Columns are matched by header name, file by file: the header line of each file is read by
a task, files of one header share a reader, and the readers' rows are put together by name.
``enforceSchema=false`` makes Spark reject a file whose header is not the one expected. A
filter on ``file_date`` prunes files before they are opened, for their header too: it is either
a partition column or a function of ``_metadata`` alone.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import scalars as sc
from tickloom.specs.base import as_schema

FILE_GLOB = "*.{csv,csv.gz}"
# Header lines read at a time.
READERS = 16


def _header(spark: SparkSession, path) -> list[str]:
    return (
        spark.read.option("header", True)
        .option("pathGlobFilter", FILE_GLOB)
        .csv(path)
        .drop("file_date")
        .columns
    )


def _dated(df: DataFrame) -> DataFrame:
    """Add ``file_date`` text from the partition folder, else from the file name."""
    if "file_date" in df.columns:
        return df.withColumn("file_date", F.col("file_date").cast("string"))
    folder = F.regexp_extract("_metadata.file_path", r"/file_date=([^/]+)/", 1)
    date = F.when(folder != "", folder).otherwise(sc.file_date("_metadata.file_name"))
    return df.withColumn("file_date", date).where(F.col("file_date").isNotNull())


def header_groups(
    spark: SparkSession,
    path: str | list[str],
    start: str | None = None,
    end: str | None = None,
    bookmark: str | None = None,
) -> dict[tuple[str, ...], list[str]]:
    """The files of each distinct header, of those that the dates leave. Empty files have none.

    A file costs a small job whose one task reads up to its first line end; ``READERS`` of
    them run at a time. The driver gets a path and a header per file, as many as it has
    listed to plan any scan.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", FILE_GLOB).load(path)
    kept = prune_dates(_dated(listed), start, end, bookmark).where("length > 0")
    files = sorted(row.path for row in kept.select("path").collect())
    out: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(READERS) as pool:
        for file, names in zip(files, pool.map(lambda f: _header(spark, f), files)):
            out.setdefault(tuple(names), []).append(file)
    return out


def _by_header(
    spark: SparkSession,
    path: str | list[str],
    header: list[str] | None,
    dates: tuple[str | None, str | None, str | None],
    read,
) -> list[DataFrame]:
    """``read(names, paths)`` for each distinct header."""
    if header:
        return [read(header, path)]
    groups = header_groups(spark, path, *dates)
    if len(groups) == 1:
        return [read(list(names), path) for names in groups]
    return [read(list(names), files) for names, files in groups.items()]


def coerce(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Cast text columns to ``schema``; a value that does not fit becomes NULL."""
    return df.select(*[_coerced(df, f) for f in as_schema(schema).fields])


def _coerced(df: DataFrame, field: T.StructField) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    c = F.col(field.name)
    if isinstance(field.dataType, (T.LongType, T.IntegerType)):
        c = sc.safe_int(c).try_cast(field.dataType)
    elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        c = sc.safe_double(c)
    elif isinstance(field.dataType, T.BooleanType):
        c = sc.to_bool(c)
    elif not isinstance(field.dataType, T.StringType):
        c = c.try_cast(field.dataType)
    return c.alias(field.name)


def prune_dates(
    df: DataFrame,
    start: str | None = None,
    end: str | None = None,
    bookmark: str | None = None,
    column: str = "file_date",
) -> DataFrame:
    """Keep dates from ``max(start, bookmark)`` to ``end``, both ends included."""
    floor = max((d for d in (start, bookmark) if d), default=None)
    if floor:
        df = df.where(F.col(column) >= floor)
    if end:
        df = df.where(F.col(column) <= end)
    return df


def scan_flat_files(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    start: str | None = None,
    end: str | None = None,
    bookmark: str | None = None,
    header: list[str] | None = None,
) -> DataFrame:
    """Rows of all dated files under ``path`` as ``schema``, dirty values as NULL.

    A column that a file's header lacks is NULL in its rows. ``header`` is the column order of
    all files, when known; no header line is read ahead then.
    """

    def read(names: list[str], paths: str | list[str]) -> DataFrame:
        raw = (
            spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
            .option("header", True)
            .option("enforceSchema", False)
            .option("pathGlobFilter", FILE_GLOB)
            .csv(paths)
        )
        return coerce(prune_dates(_dated(raw), start, end, bookmark), schema)

    return _together(spark, _by_header(spark, path, header, (start, end, bookmark), read), schema)


def _together(spark: SparkSession, parts: list[DataFrame], schema: T.StructType | str) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], as_schema(schema))
    return reduce(DataFrame.unionByName, parts)


def scan_quotes(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    start: str | None = None,
    end: str | None = None,
    bookmark: str | None = None,
    header: list[str] | None = None,
) -> DataFrame:
    """Strictly typed quote files: one bad value fails the job, and so does a missing column.

    Adds ``file_date`` and the source ``file_path``. Dates and ``header`` as in
    :func:`scan_flat_files`.
    """
    types = {f.name: f.dataType for f in as_schema(schema).fields}

    def read(names: list[str], paths: str | list[str]) -> DataFrame:
        missing = sorted(set(types) - set(names) - {"file_date"})
        if missing:
            raise ValueError(f"quote files lack columns {missing}")
        typed = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
        df = (
            spark.read.schema(typed)
            .option("header", True)
            .option("enforceSchema", False)
            .option("mode", "FAILFAST")
            .option("pathGlobFilter", FILE_GLOB)
            .csv(paths)
            .withColumn("file_path", F.col("_metadata.file_path"))
        )
        keep = [F.col(n) for n in types if n != "file_date"]
        dated = prune_dates(_dated(df), start, end, bookmark)
        return dated.select("file_date", "file_path", *keep)

    parts = _by_header(spark, path, header, (start, end, bookmark), read)
    rest = [f for f in as_schema(schema).fields if f.name != "file_date"]
    front = [T.StructField(n, T.StringType()) for n in ("file_date", "file_path")]
    return _together(spark, parts, T.StructType(front + rest))


def stream_flat_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    header: list[str] | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming twin of :func:`scan_flat_files`; the checkpoint is the bookmark.

    ``header`` is the column order of the files; by default it is read from the
    files already there.
    """
    names = header or _header(spark, path)
    reader = (
        spark.readStream.schema(
            T.StructType([T.StructField(n, T.StringType()) for n in names])
        )
        .option("header", True)
        .option("enforceSchema", False)
        .option("pathGlobFilter", FILE_GLOB)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return coerce(_dated(reader.csv(path)), schema)
