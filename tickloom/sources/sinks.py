"""Keyed and per-venue parquet output."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.universe import dedupe, upsert
from tickloom.session import scratch_path
from tickloom.specs.base import TableSpec

# Tasks that share a folder's rows, so that a large date is not one task's.
SLICES = 16


def _stored(df: DataFrame, path: str) -> DataFrame | None:
    """The rows at ``path``, with the columns and types of ``df``; None if there are none."""
    try:
        have = df.sparkSession.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return have.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in df.schema if f.name in have.columns]
    )


def replace_folders(df: DataFrame, path: str, folders: list[str], order: list[str]) -> None:
    """Write ``df``, replacing the folders that it has rows of."""
    key = F.xxhash64(*order) if order else F.lit(0)
    (
        df.repartition(*folders, F.pmod(key, F.lit(SLICES)))
        .sortWithinPartitions(*folders, *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders)
        .parquet(path)
    )


def _upsert(df: DataFrame, path: str, folders: list[str], keys: list[str], order: list[str]) -> None:
    """Bring the rows of ``df`` into the table at ``path``, one row per key.

    Only the folders that the batch touches are read and written again. They are built in a
    staging folder first: a run that fails leaves the table as it was or is run again.
    """
    once = dedupe(df, keys, order or keys, keep="last")
    stored = _stored(df, path)
    if stored is None:
        return replace_folders(once, path, folders, [k for k in keys if k not in folders])
    # Dates, or venues and dates, of one batch: bounded by the calendar.
    touched = F.broadcast(once.select(*folders).distinct())
    merged = upsert(stored.join(touched, folders, "left_semi"), once, keys, order)
    staging = scratch_path(df.sparkSession, "staging")
    merged.select(*df.columns).write.parquet(staging)
    ready = df.sparkSession.read.schema(df.schema).parquet(staging)
    replace_folders(ready, path, folders, [k for k in keys if k not in folders])


def write_table(
    df: DataFrame,
    spec: TableSpec,
    path: str,
    partition: str = "file_date",
    order: tuple[str, ...] = (),
) -> None:
    """Upsert ``df`` by the table's primary key; running it again changes nothing.

    Of rows with the same key the last by ``order`` stays, and the batch's on ties. Other
    rows of the dates that the batch touches stay as they are.
    """
    keys = list(spec.primary_keys)
    if not set(keys) <= set(df.columns):
        raise ValueError(f"{spec.name} is keyed by {keys}; the data has {df.columns}")
    _upsert(df, path, [partition], keys, list(order))


def write_by_venue(
    df: DataFrame,
    path: str,
    keys: tuple[str, ...] = ("ticker", "sip_timestamp", "sequence_number"),
    date: str = "file_date",
    order: tuple[str, ...] = (),
) -> None:
    """Upsert into one folder of parquet files per venue and date.

    A row is told by venue, date and ``keys``.
    """
    _upsert(df, path, ["venue", date], ["venue", date, *keys], list(order))


def order_output(df: DataFrame, *keys: str) -> DataFrame:
    """Total order by ``keys``, NULL text sorting as the empty string."""
    text = {n for n, t in df.dtypes if t == "string"}
    return df.orderBy(
        *[F.coalesce(F.col(k), F.lit("")) if k in text else F.col(k) for k in keys]
    )
