"""Streaming quote bars and unordered-input dedupe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import scalars as sc
from tickloom.session import scratch_path

ENDS = "end_ns bigint"


def declare_end(spark: SparkSession, folder: str, end_ns: int) -> None:
    """State that no quote up to ``end_ns`` will come any more, for the readers of ``folder``."""
    spark.createDataFrame([(end_ns,)], ENDS).coalesce(1).write.mode("append").parquet(folder)


def read_ends(spark: SparkSession, folder: str) -> DataFrame:
    """The ends declared in ``folder``, as a stream; there may be none yet."""
    spark.createDataFrame([], ENDS).write.mode("append").parquet(folder)
    return spark.readStream.schema(ENDS).parquet(folder)


def stream_quote_bars(
    quotes: DataFrame,
    interval_ns: int,
    delay: str,
    fields: list[str],
    by: str = "ticker",
    ends: DataFrame | None = None,
) -> DataFrame:
    """Streaming twin of ``quote_bars``: a bar is emitted once its bucket is closed.

    ``window()`` is ``[a, b)``; bars are ``(a, b]``, so the bucket end is its own
    column and carries the watermark. State is one last quote per key and open bucket.

    A bucket closes when quotes come that are ``delay`` later. With ``ends``, the stream of
    :func:`read_ends`, those up to a declared end close as well: its mark carries the
    watermark there. So a day's last bars come out when the day is declared over, from state
    and without reading the input again; a restarted stream goes on from its checkpoint.
    """
    boundary = sc.bucket_end("sip_timestamp", interval_ns)
    bucketed = quotes.withColumns(
        {"_end": F.timestamp_micros(sc.floor_div(boundary, 1000)), "_mark": F.lit(False)}
    )
    if ends is not None:
        over = F.timestamp_micros(sc.floor_div(sc.bucket_end("end_ns", interval_ns), 1000))
        marks = ends.select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in quotes.schema],
            (over + F.expr(f"INTERVAL '{delay}'")).alias("_end"),
            F.lit(True).alias("_mark"),
        )
        bucketed = bucketed.unionByName(marks)
    bucketed = bucketed.withWatermark("_end", delay)
    rest = [f for f in fields if f not in ("sip_timestamp", "sequence_number")]
    latest = F.max(
        F.struct(
            "sip_timestamp",
            F.col("sequence_number").isNull().alias("_no_seq"),
            "sequence_number",
            *rest,
        )
    ).alias("_last")
    return (
        bucketed.groupBy(by, "_end", "_mark")
        # Marks go by an aggregate: a filter on a key would be pushed below the watermark.
        .agg(latest, F.max("_mark").alias("_is_mark"))
        .where("NOT _is_mark")
        .select(
            by,
            sc.bucket_end("_last.sip_timestamp", interval_ns).alias("asof_timestamp"),
            *[F.col(f"_last.{f}").alias(f) for f in fields],
        )
    )


def closing_bars(
    emitted: DataFrame, quotes: DataFrame, interval_ns: int, fields: list[str], by: str = "ticker"
) -> DataFrame:
    """Bars that a stream still held open when its input ended.

    A stream emits a bar once its watermark has passed. When the input is declared complete,
    this is the rest: the bars of ``quotes``, the same input read as a table, whose boundary
    is after the last one emitted of all, or that were not emitted.
    """
    rest = [f for f in fields if f not in ("sip_timestamp", "sequence_number")]
    latest = F.max(
        F.struct("sip_timestamp", F.col("sequence_number").isNull().alias("_no_seq"), "sequence_number", *rest)
    ).alias("_last")
    bars = (
        quotes.withColumn("asof_timestamp", sc.bucket_end("sip_timestamp", interval_ns))
        .groupBy(by, "asof_timestamp")
        .agg(latest)
        .select(by, "asof_timestamp", *[F.col(f"_last.{f}").alias(f) for f in fields])
    )
    return bars.join(emitted.select(by, "asof_timestamp"), [by, "asof_timestamp"], "left_anti")


def dedupe_stream(
    stream: DataFrame, keys: list[str], time: str, delay: str
) -> DataFrame:
    """First copy of each key within the watermark delay."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def run_available(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    partition: str | None = None,
):
    """Process what is there now into parquet, then stop. A re-run resumes."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition:
        writer = writer.partitionBy(partition)
    query = writer.start()
    query.awaitTermination()
    return query


def collect_stream(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream to its present end in a new shared folder and read the result."""
    spark = stream.sparkSession
    base = scratch_path(spark, name)
    run_available(stream, f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{base}/out")
