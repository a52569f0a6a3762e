"""Backward as-of matching, cut by time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import scalars as sc
from tickloom.operators.skew import tie as tie_all

# Time that one task matches of a key, in nanoseconds or in the numbers of the time column.
BUCKET = 3_600_000_000_000
# Buckets over which rows without a key or a time are dealt, where they share the others' shuffle.
DEALT = 1024


def _bucket(time: Column, kind: T.DataType, size: int) -> Column:
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return sc.floor_div(F.unix_micros(time.cast("timestamp")), max(1, size // 1000))
    if isinstance(kind, T.DateType):
        return sc.floor_div(F.unix_date(time).cast("bigint") * sc.DAY_NS, size)
    return F.floor(time / F.lit(size)).cast("bigint")


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    by: list[str] | str,
    left_on: str,
    right_on: str,
    tie: tuple[str, ...] = (),
    prefix: str = "",
    bucket: int = BUCKET,
    spread: int = 1,
) -> DataFrame:
    """Every left row with the last right row at or before its time, or NULLs.

    Right columns other than the keys are added, with ``prefix``. Among right rows of one
    time the last by ``tie`` wins.

    The right side first collapses to one mark per key and time, in partial aggregates. Left
    rows and marks are then shuffled once, by key and bucket of ``bucket`` time, and sorted
    there: a left row takes the last mark before it. Where its bucket has none, it takes the
    last mark of the buckets before, found among one row per key and bucket. A key's history
    is thus spread over its buckets, whatever its size. Where one bucket of a key holds more
    left rows than a task should sort, many at a single instant say, ``spread`` deals them
    out to that many tasks, each with the bucket's marks. Left rows without a key or a time
    get nulls and are not shuffled.
    """
    by = [by] if isinstance(by, str) else list(by)
    values = [c for c in right.columns if c not in by]
    rows = left.select(*by, F.col(left_on).alias("_t"), F.struct(*left.columns).alias("_row"))
    complete = F.col("_t").isNotNull()
    for key in by:
        complete = complete & F.col(key).isNotNull()
    part = [*by, "_bucket", *(["_deal"] if spread > 1 else [])]

    marks = (
        right.select(*by, F.col(right_on).alias("_t"), F.struct(*values).alias("_mark"),
                     F.struct(*[F.col(c) for c in tie], F.lit(0)).alias("_tie"))
        .where(complete)
        .groupBy(*by, "_t")
        .agg(F.max_by("_mark", "_tie").alias("_mark"))
        .withColumn("_bucket", _bucket(F.col("_t"), right.schema[right_on].dataType, bucket))
    )
    asking = rows.where(complete).withColumn(
        "_bucket", _bucket(F.col("_t"), left.schema[left_on].dataType, bucket)
    )
    if spread > 1:
        marks = marks.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
        asking = asking.withColumn("_deal", F.floor(F.rand(7) * spread).cast("int"))
    # No bucket is null; said so, the join adds no filter and its sides share one shuffle.
    bucketed = [d.withColumn("_bucket", F.coalesce("_bucket", F.lit(0).cast("bigint"))) for d in (asking, marks)]
    merged = bucketed[0].unionByName(bucketed[1], allowMissingColumns=True).repartition(*part)

    # A key has one mark of a time.
    order = F.when(F.col("_mark").isNotNull(), F.col("_t"))
    matched = _matched(merged, part, order).select("_row", "_mark")
    rest = rows.where(~complete).select("_row")
    every = matched.unionByName(rest, allowMissingColumns=True)
    return every.select("_row.*", *[F.col(f"_mark.{c}").alias(f"{prefix}{c}") for c in values])


def _matched(merged: DataFrame, part: list[str], order: Column) -> DataFrame:
    """Left rows of ``merged``, shuffled by ``part``, with the last ``_mark`` up to each.

    ``order`` is that of a bucket's marks, null for left rows.
    """
    # Marks come before the rows of the same time.
    so_far = (
        Window.partitionBy(*part).orderBy("_t", F.col("_row").isNotNull(), order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    found = merged.withColumn("_mark", F.last("_mark", ignorenulls=True).over(so_far))

    last = F.max_by("_mark", order).alias("_last")
    earlier = Window.partitionBy(*[c for c in part if c != "_bucket"]).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = merged.groupBy(*part).agg(last, tie_all(merged)).select(
        *part, "_tie", F.last("_last", ignorenulls=True).over(earlier).alias("_start")
    )
    return (
        found.where(F.col("_row").isNotNull())
        .join(starts, part)
        # A hash is never null; the condition only keeps the column in use.
        .where(F.col("_tie").isNotNull())
        .withColumn("_mark", F.coalesce("_mark", "_start"))
    )


def asof_in_one(df: DataFrame, by: str, time: str, row: str, mark: str, bucket: int = BUCKET) -> DataFrame:
    """As :func:`asof_backward` for left and right rows that come in one frame.

    ``by`` is a text column; ``row`` and ``mark`` are structs: a left row has no mark, a right row
    has no row. The left rows come back with the last mark of their key at or before their time, or
    null, and that mark's time in ``mark_time``. Of several marks at one time the largest wins. The
    frame is read once and shuffled once, by key and bucket. Rows without a key or a time go along,
    dealt over ``DEALT`` buckets; left rows among them get nulls.
    """
    t = F.col(time)
    known = t.isNotNull() & F.col(by).isNotNull()
    place = F.when(known, _bucket(t, df.schema[time].dataType, bucket))
    dealt = F.floor(F.rand(7) * DEALT).cast("bigint")
    # Neither key nor bucket is null; said so, the join adds no filter and its sides share one shuffle.
    merged = df.select(
        F.coalesce(by, F.lit("")).alias("_by"),
        F.coalesce(place, dealt, F.lit(0).cast("bigint")).alias("_bucket"),
        t.alias("_t"), F.col(by).isNotNull().alias("_keyed"),
        F.col(row).alias("_row"), F.col(mark).alias("_mark"),
    ).repartition("_by", "_bucket")
    # A mark has its time from its row, and needs it only once the shuffle is done.
    known = F.col("_keyed") & F.col("_t").isNotNull()
    timed = F.when(known & F.col("_mark").isNotNull(), F.struct("_t", F.col("_mark").alias("_of")))
    matched = _matched(merged.withColumn("_mark", timed), ["_by", "_bucket"], F.col("_mark"))
    found = F.when(known, F.col("_mark"))
    return matched.select(
        F.when(F.col("_keyed"), F.col("_by")).alias(by), F.col("_t").alias(time), F.col("_row").alias(row),
        found["_of"].alias(mark), found["_t"].alias("mark_time"),
    )
