"""Moving averages, MACD, RSI and changes over bar series.

Bars are one row per (ticker, time), spaced by ``interval_ns`` or more. Recurrences are
evaluated block by block: within a block as running sums of scaled terms,
``y[i] = a**i * sum(b[j] * a**-j)`` from a state of zero, and the state before the block
comes from the blocks ahead, whose effects are affine maps and so combine in any grouping.
A block is a stretch of time with room for so many bars; its length only bounds the
scaling. No history is left out, for any window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import scalars as sc
from tickloom.operators.skew import (
    halo_blocks, in_block, owned, states_before, with_branches, with_ordinal,
)

# Bars per ranking chunk and, at most, per block.
CHUNK_BARS = 4096
# The largest power of e by which terms are scaled up within a block.
SCALE = 600.0


def _ranked(bars: DataFrame, by: str, time: str, interval_ns: int) -> DataFrame:
    ns = F.col(time)
    chunk = sc.floor_div(ns, CHUNK_BARS * interval_ns)
    return with_ordinal(bars, [by], [time], chunk)


def _in_block(by: str) -> Window:
    return Window.partitionBy(by, "_blk").orderBy("_pos")


def _so_far(by: str, time: str) -> Window:
    return in_block(by, time).rowsBetween(Window.unboundedPreceding, 0)


def block_length(block: int | None, *decays: float) -> int:
    """Bars per block: ``block`` if given, else the most that the decay factors allow."""
    logs = [-math.log(a) for a in decays if a > 0]
    most = min([int(SCALE / x) for x in logs if x > 0] + [CHUNK_BARS])
    if block is None:
        return most
    if not 1 <= block <= most:
        raise ValueError(f"a block has 1 to {most} bars for these windows, not {block}")
    return block


def _blocks(
    bars: DataFrame, by: str, time: str, interval_ns: int, block: int, ordinal: bool = False
) -> DataFrame:
    """Rows with ``_blk``, a stretch of at most ``block`` bars, and ``_pos``, the place in it."""
    return with_branches(bars, by, time, sc.floor_div(F.col(time), block * interval_ns), block, ordinal)


def _checked(window: int) -> int:
    if window < 1:
        raise ValueError(f"a window has 1 bar or more, not {window}")
    return window


def sma(
    bars: DataFrame,
    window: int = 10,
    *,
    interval_ns: int,
    by: str = "ticker",
    time: str = "window_start",
    value: str = "close",
    out: str = "value",
    block: int | None = None,
) -> DataFrame:
    """Simple mean of the last ``window`` bars; earlier bars emit nothing."""
    block = max(CHUNK_BARS, 8 * _checked(window)) if block is None else block
    df = halo_blocks(_ranked(bars, by, time, interval_ns), block, window - 1)
    frame = _in_block(by).rowsBetween(1 - window, 0)
    df = df.withColumn(out, F.avg(value).over(frame)).where(F.col("_ord") >= window - 1)
    return owned(df)


def _from_zero(term: Column, a: float, power: Column, so_far: Window) -> Column:
    """``sum(a**(power[i] - power[j]) * term[j])`` over the block so far."""
    if a == 0:
        return term
    # A power is exact to the last bit, where exp(pos * log(a)) loses three digits.
    decay = F.pow(F.lit(a), power)
    return F.sum(term / decay).over(so_far) * decay


def ema(
    bars: DataFrame,
    window: int = 10,
    *,
    interval_ns: int,
    by: str = "ticker",
    time: str = "window_start",
    value: str = "close",
    out: str = "value",
    block: int | None = None,
) -> DataFrame:
    """Exponential mean, ``alpha = 2 / (window + 1)``, seeded with the first value."""
    a = 1 - 2 / (_checked(window) + 1)
    df = _blocks(bars, by, time, interval_ns, block_length(block, a))
    so_far = _so_far(by, time)
    df = df.withColumns(
        {"_y": _from_zero((1 - a) * F.col(value), a, F.col("_pos"), so_far), "_first": F.first(value).over(so_far)}
    )
    fade = F.pow(F.lit(a), F.col("_pos") + 1)
    summary = [fade.alias("fade"), F.col("_y"), F.col("_first").cast("double").alias("x")]

    def step(y: Column, b: Column) -> Column:
        return b["fade"] * y + b["_y"]

    def combine(b: Column, c: Column) -> Column:
        return F.struct(
            (b["fade"] * c["fade"]).alias("fade"), step(b["_y"], c).alias("_y"), b["x"].alias("x")
        )

    # Before the first bar stands its own value, so that the first mean is that value.
    df = states_before(df, by, time, summary, lambda b: b["x"], step, combine)
    mean = F.pow(F.lit(a), F.col("_pos") + 1) * F.col("_state") + F.col("_y")
    first = F.col("_opens") & (F.col("_pos") == 0)
    mean = F.when(first, F.col(value).cast("double")).otherwise(mean)
    return df.withColumn(out, mean).drop("_blk", "_pos", "_y", "_first", "_state", "_opens")


def macd(
    bars: DataFrame,
    short: int = 12,
    long: int = 26,
    signal: int = 9,
    *,
    interval_ns: int,
    by: str = "ticker",
    time: str = "window_start",
    value: str = "close",
    block: int | None = None,
) -> DataFrame:
    """Difference of two exponential means, its own mean, and the histogram.

    The three means form one linear recurrence: what a mean's state before the block adds
    to the signal has a closed form, so one pass serves all windows.
    """
    s, l, g = (1 - 2 / (_checked(n) + 1) for n in (short, long, signal))
    df = _blocks(bars, by, time, interval_ns, block_length(block, s, l, g))
    x, pos, so_far = F.col(value), F.col("_pos"), _so_far(by, time)
    df = df.withColumns(
        {
            "_short": _from_zero((1 - s) * x, s, pos, so_far), "_long": _from_zero((1 - l) * x, l, pos, so_far),
            "_first": F.first(value).over(so_far),
        }
    )
    df = df.withColumn("_signal", _from_zero((1 - g) * (F.col("_short") - F.col("_long")), g, pos, so_far))
    zeros = {"s": F.col("_short"), "l": F.col("_long"), "g": F.col("_signal")}

    def carried(a: float, n: Column) -> Column:
        """What a state of 1 of a mean adds to the signal after n bars."""
        if a == g:
            return (1 - g) * n * F.pow(F.lit(a), n)
        return (1 - g) * a / (a - g) * (F.pow(F.lit(a), n) - F.pow(F.lit(g), n))

    def after(state: Column, n: Column, zero_s: Column, zero_l: Column, zero_g: Column) -> Column:
        g_now = F.pow(F.lit(g), n) * state["g"] + carried(s, n) * state["s"]
        return F.struct(
            (F.pow(F.lit(s), n) * state["s"] + zero_s).alias("s"),
            (F.pow(F.lit(l), n) * state["l"] + zero_l).alias("l"),
            (g_now - carried(l, n) * state["l"] + zero_g).alias("g"),
        )

    def step(state: Column, b: Column) -> Column:
        return after(state, b["n"], b["s"], b["l"], b["g"])

    def combine(b: Column, c: Column) -> Column:
        # What a stretch makes of a state of zero is a state like any other.
        now = step(b, c)
        return F.struct(
            (b["n"] + c["n"]).alias("n"), *[now[m].alias(m) for m in "slg"], b["x"].alias("x")
        )

    def seed(value: Column) -> Column:
        return F.struct(value.alias("s"), value.alias("l"), F.lit(0.0).alias("g"))

    summary = [
        (pos + 1).alias("n"), *[zeros[m].alias(m) for m in "slg"], F.col("_first").cast("double").alias("x"),
    ]
    df = states_before(df, by, time, summary, lambda b: seed(b["x"]), step, combine)
    now = after(F.col("_state"), pos + 1, *zeros.values())
    first = F.col("_opens") & (pos == 0)
    now = F.when(first, seed(x.cast("double"))).otherwise(now)
    df = df.withColumn("_now", now).withColumns(
        {"value": F.col("_now.s") - F.col("_now.l"), "signal": F.col("_now.g")}
    )
    return df.withColumn("histogram", F.col("value") - F.col("signal")).drop(
        "_blk", "_pos", "_short", "_long", "_signal", "_first", "_state", "_opens", "_now"
    )


def rsi(
    bars: DataFrame,
    window: int = 18,
    *,
    interval_ns: int,
    by: str = "ticker",
    time: str = "window_start",
    value: str = "close",
    out: str = "value",
    block: int | None = None,
) -> DataFrame:
    """Relative strength, seeded with the mean of the first ``window`` changes.

    The first ``window`` changes of a ticker carry equal weight: the averages decay from
    the bar after them on.
    """
    a = (_checked(window) - 1) / window
    df = _blocks(bars, by, time, interval_ns, block_length(block, a), ordinal=True)
    zero, x, so_far = F.lit(0.0), F.col(value), _so_far(by, time)

    def decays(ordinal: Column) -> Column:
        return F.greatest(ordinal - window, F.lit(0).cast("bigint"))

    power = decays(F.col("_ord")) - decays(F.col("_ord") - F.col("_pos") - 1)
    df = df.withColumns(
        {"_power": power, "_change": x - F.lag(value).over(in_block(by, time)), "_first": F.first(value).over(so_far)}
    )

    def term(sign: int) -> Column:
        # The first change of a block is known once the block before is.
        return F.coalesce(F.greatest(sign * F.col("_change"), zero), zero) / window

    df = df.withColumns(
        {
            "_gain": _from_zero(term(1), a, F.col("_power"), so_far),
            "_loss": _from_zero(term(-1), a, F.col("_power"), so_far),
            "_head": F.first("_power").over(so_far),
        }
    )

    def after(state: Column, first: Column, power: Column, head: Column, zeros: dict) -> dict:
        """Both averages from the state before the block and the block's first change."""
        change = F.coalesce(first - state["last"], zero)
        keep = F.pow(F.lit(a), power)
        # With no decay at all only a bar's own change counts.
        since = F.pow(F.lit(a), power - head)
        return {
            n: keep * state[n] + since * F.greatest(sign * change, zero) / window + zeros[n]
            for n, sign in (("gain", 1), ("loss", -1))
        }

    summary = [
        F.col("_first").cast("double").alias("first"), x.cast("double").alias("last"),
        F.col("_power").alias("power"), F.col("_head").alias("head"),
        F.col("_gain").alias("gain"), F.col("_loss").alias("loss"),
    ]

    def step(state: Column, b: Column) -> Column:
        now = after(state, b["first"], b["power"], b["head"], {"gain": b["gain"], "loss": b["loss"]})
        return F.struct(now["gain"].alias("gain"), now["loss"].alias("loss"), b["last"].alias("last"))

    def combine(b: Column, c: Column) -> Column:
        now = step(b, c)
        return F.struct(
            b["first"].alias("first"), c["last"].alias("last"),
            (b["power"] + c["power"]).alias("power"), b["head"].alias("head"),
            now["gain"].alias("gain"), now["loss"].alias("loss"),
        )

    nothing = F.struct(zero.alias("gain"), zero.alias("loss"), F.lit(None).cast("double").alias("last"))
    df = states_before(df, by, time, summary, lambda b: nothing, step, combine)
    now = after(
        F.col("_state"), F.col("_first").cast("double"), F.col("_power"), F.col("_head"),
        {"gain": F.col("_gain"), "loss": F.col("_loss")},
    )
    df = df.withColumns({"_up": now["gain"], "_down": now["loss"]})
    strength = 100 - 100 / (1 + F.try_divide("_up", "_down"))
    df = df.withColumn(out, F.when(F.col("_down") == 0, F.lit(100.0)).otherwise(strength))
    return df.where(F.col("_ord") >= window).drop(
        "_ord", "_blk", "_pos", "_power", "_change", "_gain", "_loss", "_state", "_opens", "_first", "_head", "_up", "_down"
    )


def with_change(
    bars: DataFrame,
    *,
    interval_ns: int,
    by: str = "ticker",
    time: str = "window_start",
    value: str = "close",
    block: int | None = None,
) -> DataFrame:
    """Add ``todays_change`` and ``todays_change_percent`` against the bar before."""
    df = halo_blocks(_ranked(bars, by, time, interval_ns), block or CHUNK_BARS, 1)
    before = F.lag(value).over(_in_block(by))
    df = owned(df.withColumn("_before", before))
    change = F.col(value) - F.col("_before")
    return (
        df.withColumn("todays_change", change)
        .withColumn("todays_change_percent", F.try_divide(change * 100, F.col("_before")))
        .drop("_before")
    )


def indicator_table(
    values: DataFrame,
    indicator: str,
    timespan: str = "day",
    window: int = 10,
    series: str = "close",
    time: str = "window_start",
) -> DataFrame:
    """Indicator rows in table form, with the bar each value was computed on.

    Values computed here stand on a bar of the same time, so no join is needed;
    for values that arrive from elsewhere use ``asof_backward``.
    """
    extra = [c for c in ("signal", "histogram") if c in values.columns]
    label = sc.series_label(F.lit(series), F.lit(timespan), F.lit(window))
    underlying = ("open", "high", "low", "close", "volume", "vwap", "transactions")
    stamp = sc.epoch_to_timestamp(time, "ns")
    return values.select(
        stamp.alias("timestamp"),
        stamp.alias("underlying_timestamp"),
        "ticker",
        F.lit(indicator).alias("indicator"),
        label.alias("series_window_timespan"),
        "value",
        F.col("ticker").alias("underlying_ticker"),
        *[F.col(c).alias(f"underlying_{c}") for c in underlying if c in values.columns],
        *extra,
    )
