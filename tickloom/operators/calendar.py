"""Trading calendar, sampling grids and earnings windows.

A calendar is a table with one row per trading day: date, open_ns, close_ns. It is
an input; a century of civil days is 36,525 rows, so calendars are small whatever
the size of the tick tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import scalars as sc
from tickloom.operators.sizes import by_date

# --- fixed values -----------------------------------------------------------
# New York session hours.
SESSION_ZONE = "America/New_York"
SESSION_OPEN = "09:30:00"
SESSION_CLOSE = "16:00:00"
# ---------------------------------------------------------------------------


# Steps of a fixed grid that one row carries.
GRID_RUN = 86_400


def _local_ns(date: Column, clock: str | Column, zone: str) -> Column:
    clock = F.lit(clock) if isinstance(clock, str) else clock
    local = F.concat_ws(" ", date.cast("string"), clock).cast("timestamp")
    return sc.ts_to_ns(F.to_utc_timestamp(local, zone))


def with_session_hours(
    days: DataFrame,
    date: str = "date",
    opens: str = SESSION_OPEN,
    closes: str = SESSION_CLOSE,
    zone: str = SESSION_ZONE,
    exceptions: DataFrame | None = None,
) -> DataFrame:
    """Session bounds of each trading day, daylight saving included.

    ``exceptions`` holds days with hours of their own, such as half-days: a date, and local
    times ``opens`` and ``closes`` (null where as usual). One row per date.
    """
    if exceptions is None:
        return days.select(
            F.col(date).alias("date"),
            _local_ns(F.col(date), opens, zone).alias("open_ns"),
            _local_ns(F.col(date), closes, zone).alias("close_ns"),
        )
    columns = set(exceptions.columns)
    own = exceptions.select(
        F.col("date").alias(date),
        *[(F.col(c) if c in columns else F.lit(None).cast("string")).alias(f"_{c}") for c in ("opens", "closes")],
    )
    return days.join(by_date(own, date), date, "left").select(
        F.col(date).alias("date"),
        _local_ns(F.col(date), F.coalesce("_opens", F.lit(opens)), zone).alias("open_ns"),
        _local_ns(F.col(date), F.coalesce("_closes", F.lit(closes)), zone).alias("close_ns"),
    )


def sessions(calendar: DataFrame, start_ns: int, end_ns: int) -> DataFrame:
    """Open and close of the trading days from the date of ``start_ns`` to ``end_ns``."""
    first = sc.ns_to_date(F.lit(start_ns).cast("bigint"))
    last = sc.ns_to_date(F.lit(end_ns).cast("bigint"))
    return calendar.where(F.col("date").between(first, last)).select(
        "date", "open_ns", "close_ns"
    )


def session_grid(
    calendar: DataFrame, interval_ns: int, start_ns: int | None = None, end_ns: int | None = None
) -> DataFrame:
    """Sampling times of every session: from the open, by step, before the close."""
    step = F.lit(interval_ns).cast("bigint")
    grid = calendar.where(F.col("close_ns") > F.col("open_ns")).select(
        "date",
        F.explode(F.sequence("open_ns", F.col("close_ns") - 1, step)).alias("asof_timestamp"),
    )
    if start_ns is not None:
        grid = grid.where(F.col("asof_timestamp") >= F.lit(start_ns).cast("bigint"))
    if end_ns is not None:
        grid = grid.where(F.col("asof_timestamp") < F.lit(end_ns).cast("bigint"))
    return grid


def fixed_grid(ranges: DataFrame, interval_ns: int) -> DataFrame:
    """Sampling times of markets that never close.

    ``ranges`` has start_ns and end_ns (and any keys); steps run from the start,
    unaligned, before the end. A range is first cut into runs of ``GRID_RUN`` steps, so no
    row carries all steps of a long one.
    """
    step = F.lit(interval_ns).cast("bigint")
    run = F.lit(interval_ns * GRID_RUN).cast("bigint")
    runs = F.explode(F.sequence("start_ns", F.col("end_ns") - 1, run))
    last = F.least(F.col("_run") + run, F.col("end_ns")) - 1
    return (
        ranges.where(F.col("end_ns") > F.col("start_ns"))
        .withColumn("_run", runs)
        .withColumn("asof_timestamp", F.explode(F.sequence("_run", last, step)))
        .drop("_run")
    )


def date_spine(ranges: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Every civil day of each range, both ends included, today at the latest."""
    last = F.least(F.col(end), F.current_date())
    return (
        ranges.where(F.col(start) <= last)
        .withColumn("date", F.explode(F.sequence(F.col(start), last)))
        .drop(start, end)
    )


def neighbours(calendar: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Trading days strictly before and after each date, and whether it is one.

    ``dates`` (column date) are the dates asked for; by default every civil day of
    the calendar's span. One row per date in a single small window.
    """
    trading = calendar.select("date", F.lit(True).alias("_trading"))
    if dates is None:
        span = calendar.agg(F.min("date").alias("start"), F.max("date").alias("end"))
        dates = span.select(F.explode(F.sequence("start", "end")).alias("date"))
    asked = dates.select("date", F.lit(True).alias("_asked"))
    spine = (
        asked.unionByName(trading, allowMissingColumns=True)
        .groupBy("date")
        .agg(F.max("_asked").alias("_asked"), F.max("_trading").alias("_trading"))
        .where(F.col("date").isNotNull())
    )
    day = F.when(F.col("_trading"), F.col("date"))
    order = Window.orderBy("date")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    return spine.select(
        "date",
        F.coalesce("_trading", F.lit(False)).alias("is_trading"),
        F.last(day, ignorenulls=True).over(before).alias("prev_date"),
        F.first(day, ignorenulls=True).over(after).alias("next_date"),
        "_asked",
    ).where("_asked").drop("_asked")


def trading_spine(calendar: DataFrame) -> DataFrame:
    """Every civil day from the first trading day to the last, with its neighbours.

    One row per day, from the calendar alone: a trading day stands for itself and for the
    days up to the next one.
    """
    order = Window.orderBy("date")
    trading = calendar.where(F.col("date").isNotNull()).select("date").distinct()
    placed = trading.select(
        F.col("date").alias("_from"),
        F.lag("date").over(order).alias("_before"),
        F.lead("date").over(order).alias("next_date"),
    )
    stands_for = F.sequence("_from", F.coalesce(F.date_sub("next_date", 1), "_from"))
    own = F.col("date") == F.col("_from")
    return placed.withColumn("date", F.explode(stands_for)).select(
        "date",
        own.alias("is_trading"),
        F.when(own, F.col("_before")).otherwise(F.col("_from")).alias("prev_date"),
        "next_date",
    )


def earnings_windows(
    earnings: DataFrame, calendar: DataFrame, us_only: bool = False
) -> DataFrame:
    """Trading days around each earnings date: (ticker, snapshot_date), distinct.

    The day before, the day itself if it traded, and the day after. The calendar
    should reach past the earnings dates on both sides; a date beyond it has its one
    neighbour. The earnings are read once: neighbours hang on the calendar's days, of which
    a century has 36,525, so that side is broadcast.
    """
    listed = earnings.where((F.col("ticker") != "") & F.col("date").isNotNull())
    if us_only:
        listed = listed.where(sc.is_us_ticker("ticker"))
    ends = calendar.agg(F.struct(F.min("date").alias("first"), F.max("date").alias("last"))).scalar()
    first, last = ends.getField("first"), ends.getField("last")
    around = trading_spine(calendar).select(
        "date",
        F.array("prev_date", F.when(F.col("is_trading"), F.col("date")), "next_date").alias("_days"),
    )
    beyond = F.when(F.col("date") < first, F.array(first)).when(F.col("date") > last, F.array(last))
    return (
        listed.select("ticker", "date")
        .join(F.broadcast(around), "date", "left")
        .select("ticker", F.explode(F.coalesce("_days", beyond)).alias("snapshot_date"))
        .where(F.col("snapshot_date").isNotNull())
        .distinct()
    )


def tickers_on(windows: DataFrame) -> DataFrame:
    """(snapshot_date, ticker): the tickers that have a window on each date."""
    return windows.select("snapshot_date", "ticker").distinct()


def listed_tickers(tickers: DataFrame) -> DataFrame:
    """For display: one row per date with its sorted tickers, all in that row."""
    return tickers.groupBy("snapshot_date").agg(
        F.array_sort(F.collect_set("ticker")).alias("tickers")
    )


def first_window(windows: DataFrame) -> DataFrame:
    """First window date of each ticker."""
    return windows.groupBy("ticker").agg(F.min("snapshot_date").alias("first_date"))
