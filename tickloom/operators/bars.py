"""Trade bars, daily summaries, snapshots and movers.

Everything here is an aggregate with partial results on the map side, so a ticker
with a third of all trades leaves each map task as one row per bar.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import scalars as sc
from tickloom.operators.sizes import by_date

# --- fixed values -----------------------------------------------------------
# Length of one unit of a bar size, in nanoseconds.
TIMESPAN_NS = {
    "second": 1_000_000_000,
    "minute": 60_000_000_000,
    "hour": 3_600_000_000_000,
    "day": 86_400_000_000_000,
}
# Defaults of the movers report.
MOVERS_COUNT = 20
MOVERS_MIN_VOLUME = 10_000
# ---------------------------------------------------------------------------


def bar_start(c: Column | str, multiplier: int = 1, timespan: str = "minute") -> Column:
    """Start of the bar a nanosecond epoch falls into (weeks start on Monday, UTC)."""
    ns = F.col(c) if isinstance(c, str) else c
    if timespan in ("second", "minute", "hour") or (timespan == "day" and multiplier == 1):
        step = F.lit(TIMESPAN_NS[timespan] * multiplier).cast("bigint")
        return ns - F.pmod(ns, step)
    if multiplier != 1:
        raise ValueError("only seconds, minutes and hours take a multiplier")
    if timespan == "week":
        # Day 0 of the epoch is a Thursday.
        shift = F.lit(3 * sc.DAY_NS).cast("bigint")
        return ns - F.pmod(ns + shift, F.lit(7 * sc.DAY_NS).cast("bigint"))
    if timespan == "month":
        return sc.date_to_ns(F.trunc(sc.ns_to_date(ns), "month"))
    raise ValueError(f"unknown timespan {timespan!r}")


def _ohlcv(condition: Column | None = None) -> list[Column]:
    """Bar aggregates of trades, optionally over the rows meeting a condition."""
    pick = (lambda c: c) if condition is None else (lambda c: F.when(condition, c))
    moment = F.struct("sip_timestamp", "sequence_number", "price")
    notional = F.col("price") * F.col("size")
    return [
        F.min(pick(moment)).getField("price").alias("open"),
        F.max(pick(F.col("price"))).alias("high"),
        F.min(pick(F.col("price"))).alias("low"),
        F.max(pick(moment)).getField("price").alias("close"),
        F.sum(pick(F.col("size"))).alias("volume"),
        F.try_divide(F.sum(pick(notional)), F.sum(pick(F.col("size")))).alias("vwap"),
        F.count(pick(F.lit(1))).alias("transactions"),
    ]


def ohlcv_bars(
    trades: DataFrame,
    multiplier: int = 1,
    timespan: str = "minute",
    by: tuple[str, ...] = ("ticker",),
) -> DataFrame:
    """Bars at the start of each window that has a trade."""
    start = bar_start("sip_timestamp", multiplier, timespan)
    return (
        trades.withColumn("window_start", start)
        .groupBy(*by, "window_start")
        .agg(*_ohlcv())
    )


def on_file_date(df: DataFrame, date: str) -> DataFrame:
    """Only files of a UTC date, where rows carry their file's; others hold no tick of it."""
    if "file_date" not in df.columns:
        return df
    return df.where(F.col("file_date") == F.lit(date).cast(df.schema["file_date"].dataType))


def daily_market_summary(
    trades: DataFrame, date: str, include_otc: bool = True
) -> DataFrame:
    """Every ticker's bar of one UTC day; over-the-counter trades may be left out."""
    start = F.unix_date(F.lit(date).cast("date")).cast("bigint") * F.lit(sc.DAY_NS)
    ns = F.col("sip_timestamp")
    day = on_file_date(trades, date).where((ns >= start) & (ns < start + F.lit(sc.DAY_NS)))
    if not include_otc:
        day = day.where(~F.coalesce("otc", F.lit(False)))
    return ohlcv_bars(day, 1, "day")


def daily_ticker_summary(trades: DataFrame, calendar: DataFrame) -> DataFrame:
    """Session bar of each trading day with pre-market and after-hours prices.

    Pre-market is the day's first price before the open, after-hours its last price
    at or after the close.
    """
    ns = F.col("sip_timestamp")
    before, after = ns < F.col("open_ns"), ns >= F.col("close_ns")
    moment = F.struct("sip_timestamp", "sequence_number", "price")
    days = by_date(calendar.select(F.col("date").alias("from"), "open_ns", "close_ns"), "from")
    return (
        trades.withColumn("from", sc.ns_to_date(ns))
        .join(days, "from")
        .groupBy("ticker", "from")
        .agg(
            *_ohlcv(~before & ~after)[:5],
            F.min(F.when(before, moment)).getField("price").alias("pre_market"),
            F.max(F.when(after, moment)).getField("price").alias("after_hours"),
        )
    )


def previous_day_bar(
    bars: DataFrame, as_of: str, time: str = "window_start"
) -> DataFrame:
    """Each ticker's last daily bar of a day before ``as_of``."""
    limit = F.unix_date(F.lit(as_of).cast("date")).cast("bigint") * F.lit(sc.DAY_NS)
    fields = [time, *[c for c in bars.columns if c not in ("ticker", time)]]
    return (
        bars.where(F.col(time) < limit)
        .groupBy("ticker")
        .agg(F.max(F.struct(*fields)).alias("_bar"))
        .select("ticker", "_bar.*")
    )


def last_by_ticker(df: DataFrame, by: str = "ticker") -> DataFrame:
    """Latest record of each ticker by (sip_timestamp, sequence_number)."""
    first = ["sip_timestamp", "sequence_number"]
    fields = first + [c for c in df.columns if c not in (by, *first)]
    return (
        df.groupBy(by)
        .agg(F.max(F.struct(*fields)).alias("_last"))
        .select(*[F.col(c) if c == by else F.col(f"_last.{c}") for c in df.columns])
    )


def market_snapshot(
    trades: DataFrame, quotes: DataFrame | None, bars: DataFrame, as_of_ns: int
) -> DataFrame:
    """State of every ticker at one time, in nested columns.

    ``day`` and ``min`` come from the trades of that UTC day up to the time, rolled
    up through minute bars in one pass; ``prev_day`` is the last earlier daily bar of
    ``bars``; ``last_trade`` and ``last_quote`` are the latest of that day. Markets
    without quotes pass None for them.
    """
    day_ns = as_of_ns - as_of_ns % sc.DAY_NS
    today_text = _iso_date(day_ns)
    today = (F.col("sip_timestamp") >= F.lit(day_ns).cast("bigint")) & (
        F.col("sip_timestamp") <= F.lit(as_of_ns).cast("bigint")
    )
    minutes = (
        on_file_date(trades, today_text).where(today)
        .withColumn("_minute", bar_start("sip_timestamp", 1, "minute"))
        .groupBy("ticker", "_minute")
        .agg(
            *_ohlcv(),
            F.sum(F.col("price") * F.col("size")).alias("_notional"),
            F.max(
                F.struct("sip_timestamp", "sequence_number", "price", "size")
            ).alias("_trade"),
        )
    )
    current = minutes.groupBy("ticker").agg(
        F.struct(
            F.min_by("open", "_minute").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "_minute").alias("close"),
            F.sum("volume").alias("volume"),
            F.try_divide(F.sum("_notional"), F.sum("volume")).alias("vwap"),
        ).alias("day"),
        F.max_by(
            F.struct(
                "open",
                "high",
                "low",
                "close",
                "volume",
                "vwap",
                "transactions",
                F.col("_minute").alias("timestamp"),
            ),
            "_minute",
        ).alias("_min"),
        F.sum("volume").alias("_accumulated"),
        F.max("_trade").alias("last_trade"),
    )
    current = current.withColumn(
        "min", F.col("_min").withField("accumulated_volume", F.col("_accumulated"))
    ).drop("_min", "_accumulated")
    if quotes is not None:
        quote = last_by_ticker(quotes.where(today))
        fields = [c for c in quote.columns if c != "ticker"]
        quote = quote.select("ticker", F.struct(*fields).alias("last_quote"))
        current = current.join(quote, "ticker", "full")
    previous = previous_day_bar(bars, today_text)
    previous = previous.select(
        "ticker", F.struct(*[c for c in previous.columns if c != "ticker"]).alias("prev_day")
    )
    close, before = F.col("day.close"), F.col("prev_day.close")
    return (
        current.join(previous, "ticker", "full")
        .withColumn("todays_change", close - before)
        .withColumn("todays_change_percent", F.try_divide((close - before) * 100, before))
        .withColumn("updated", F.lit(as_of_ns).cast("bigint"))
    )


def unified_snapshot(snapshot: DataFrame, kind: str) -> DataFrame:
    """A snapshot in the form shared by all markets, with ``session`` and ``type``."""
    return snapshot.select(
        "ticker",
        F.lit(kind).alias("type"),
        F.struct(
            F.col("todays_change").alias("change"),
            F.col("todays_change_percent").alias("change_percent"),
            F.col("day.open").alias("open"),
            F.col("day.high").alias("high"),
            F.col("day.low").alias("low"),
            F.col("day.close").alias("close"),
            F.col("day.volume").alias("volume"),
            F.col("prev_day.close").alias("previous_close"),
        ).alias("session"),
        F.col("min").alias("last_minute"),
        "last_quote",
        "last_trade",
    )


def _iso_date(ns: int) -> str:
    return (date(1970, 1, 1) + timedelta(days=ns // sc.DAY_NS)).isoformat()


def top_movers(
    changes: DataFrame,
    direction: str = "both",
    n: int = MOVERS_COUNT,
    min_volume: float | None = MOVERS_MIN_VOLUME,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """The ``n`` largest gains and/or losses by ``todays_change_percent``.

    With ``by`` there are ``n`` per group. Ties go by ticker. Rows without a change are left
    out. The input is read once for both directions: a row stands for each of them, a map task
    keeps its own first ``n`` per group and direction, and only those are shuffled.
    """
    wanted = ["gainers", "losers"] if direction in ("", "both", None) else [direction]
    rows = changes.where(F.col("todays_change_percent").isNotNull())
    if min_volume is not None:
        rows = rows.where(F.col("volume") >= min_volume)
    pct = F.col("todays_change_percent")
    sides = [
        F.struct(F.lit(side).alias("direction"), (-pct if side == "gainers" else pct).alias("_key"))
        for side in wanted
    ]
    sided = rows.withColumn("_side", F.explode(F.array(*sides)))
    sided = sided.withColumns({"direction": F.col("_side.direction"), "_key": F.col("_side._key")})
    order = Window.partitionBy(*by, "direction").orderBy("_key", "ticker")
    ranked = sided.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= n).drop("_side", "_key")
