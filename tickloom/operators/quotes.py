"""Point-in-time quote bars: the last quote of each half-open interval."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import scalars as sc
from tickloom.operators.sizes import by_date, dated, on_dates


@dataclass(frozen=True)
class QuoteAsset:
    """Quote columns of one asset class, and the names some of them arrive under."""

    fields: tuple[str, ...]
    csv: str
    renames: tuple[tuple[str, str], ...] = ()


# --- fixed values -----------------------------------------------------------
# Quote file columns by asset class, as a Spark schema, and the bar columns.
QUOTE_ASSETS = {
    "stock": QuoteAsset(
        fields=(
            "sip_timestamp",
            "participant_timestamp",
            "trf_timestamp",
            "sequence_number",
            "ask_exchange",
            "ask_price",
            "ask_size",
            "bid_exchange",
            "bid_price",
            "bid_size",
            "conditions",
            "indicators",
            "tape",
        ),
        csv="ticker string, ask_exchange bigint, ask_price double, ask_size double, "
        "bid_exchange bigint, bid_price double, bid_size double, conditions string, "
        "indicators string, participant_timestamp bigint, sequence_number bigint, "
        "sip_timestamp bigint, tape bigint, trf_timestamp bigint",
    ),
    "option": QuoteAsset(
        fields=(
            "sip_timestamp",
            "sequence_number",
            "ask_exchange",
            "ask_price",
            "ask_size",
            "bid_exchange",
            "bid_price",
            "bid_size",
        ),
        csv="ticker string, ask_exchange bigint, ask_price double, ask_size double, "
        "bid_exchange bigint, bid_price double, bid_size double, "
        "sequence_number bigint, sip_timestamp bigint",
    ),
    "future": QuoteAsset(
        fields=(
            "sip_timestamp",
            "sequence_number",
            "report_sequence",
            "ask_timestamp",
            "ask_price",
            "ask_size",
            "bid_timestamp",
            "bid_price",
            "bid_size",
            "exchange",
            "session_end_date",
            "venue",
        ),
        csv="ticker string, timestamp bigint, sequence_number bigint, "
        "report_sequence bigint, ask_timestamp bigint, ask_price double, "
        "ask_size double, bid_timestamp bigint, bid_price double, bid_size double, "
        "exchange bigint, session_end_date date",
        renames=(("timestamp", "sip_timestamp"),),
    ),
}
VENUES = ("cme", "cbot", "comex", "nymex")
# ---------------------------------------------------------------------------


def last_record(
    df: DataFrame,
    keys: list[str],
    fields: list[str],
    time: str = "sip_timestamp",
    sequence: str = "sequence_number",
) -> DataFrame:
    """The latest record per key by (time, sequence), as plain columns.

    A NULL sequence ranks above any number; full ties go to the larger remaining
    fields, so every run gives the same row. One aggregate with map-side partial
    results: a busy key shrinks to one row per task before the shuffle.
    """
    order = [time, "_no_seq", *([sequence] if sequence in fields else [])]
    rest = [f for f in fields if f not in order]
    latest = F.max(F.struct(*order, *rest)).alias("_last")
    return (
        df.withColumn(
            "_no_seq", F.col(sequence).isNull() if sequence in fields else F.lit(False)
        )
        .groupBy(*keys)
        .agg(latest)
        .select(*keys, *[F.col(f"_last.{f}").alias(f) for f in fields if f not in keys])
    )


def quote_bars(
    quotes: DataFrame,
    interval_ns: int,
    asset: str = "option",
    by_file_date: bool = False,
    venue: str | None = None,
) -> DataFrame:
    """Last quote of every ``(T - interval, T]`` per ticker; T is ``asof_timestamp``.

    ``by_file_date`` adds the file date to the key; the same file read twice gives
    the same bars.
    """
    spec = QUOTE_ASSETS[asset]
    df = quotes
    for source, name in spec.renames:
        if source in df.columns:
            df = df.withColumnRenamed(source, name)
    if venue is not None:
        df = df.withColumn("venue", F.lit(venue))
    fields = [f for f in spec.fields if f in df.columns]
    keys = [*(["file_date"] if by_file_date else []), "ticker", "asof_timestamp"]
    bucketed = df.withColumn("asof_timestamp", sc.bucket_end("sip_timestamp", interval_ns))
    return last_record(bucketed, keys, fields)


def _boundary(interval_ns: int, origin: Column, time: str) -> Column:
    """First grid time at or after ``time`` on the grid through ``origin``."""
    late = F.col(time) - origin + F.lit(interval_ns - 1).cast("bigint")
    step = F.lit(interval_ns).cast("bigint")
    return origin + sc.floor_div(late, interval_ns) * step


def _reach(calendar: DataFrame, interval_ns: int) -> DataFrame:
    """Open and last grid time of each session, by the dates of the quotes it can need."""
    step = F.lit(interval_ns).cast("bigint")
    steps = sc.floor_div(F.col("close_ns") - 1 - F.col("open_ns"), interval_ns)
    reach = calendar.where(F.col("close_ns") > F.col("open_ns")).select(
        F.col("open_ns").alias("_open"), (F.col("open_ns") + steps * step).alias("_last")
    )
    days = F.sequence(sc.ns_to_date(F.col("_open") - step + 1), sc.ns_to_date(F.col("_last")))
    return reach.withColumn("_day", F.explode(days))


def on_session_grid(
    quotes: DataFrame, calendar: DataFrame, interval_ns: int, time: str = "sip_timestamp"
) -> DataFrame:
    """Quotes that fall into an interval of a session's grid, with its boundary.

    The boundary is arithmetic on the session's open, so the only join is on the
    date, against the calendar.
    """
    step = F.lit(interval_ns).cast("bigint")
    return (
        quotes.withColumn("_day", sc.ns_to_date(time))
        .join(by_date(_reach(calendar, interval_ns), "_day"), "_day")
        .where((F.col(time) > F.col("_open") - step) & (F.col(time) <= F.col("_last")))
        .withColumn("asof_timestamp", _boundary(interval_ns, F.col("_open"), time))
        .drop("_day", "_open", "_last")
    )


def _fields(quotes: DataFrame, keys: list[str]) -> list[str]:
    return [c for c in quotes.columns if c not in keys]


def sample_at(
    quotes: DataFrame, calendar: DataFrame, interval_ns: int, by: str = "ticker"
) -> DataFrame:
    """Last quote in ``(T - interval, T]`` for every grid time T of every session.

    Grid times without a quote in their interval emit nothing. Files of dates that no
    session reaches are not opened.
    """
    keys = [by, "asof_timestamp"]
    reached = _on_file_dates(quotes, _reach(calendar, interval_ns), "_day")
    placed = on_session_grid(reached, calendar, interval_ns)
    return last_record(placed, keys, _fields(quotes, keys))


def sample_fixed(
    quotes: DataFrame, start_ns: int, end_ns: int, interval_ns: int, by: str = "ticker"
) -> DataFrame:
    """As :func:`sample_at` on a grid from ``start_ns`` by step, before ``end_ns``."""
    start = F.lit(start_ns).cast("bigint")
    keys = [by, "asof_timestamp"]
    placed = quotes.where(
        (F.col("sip_timestamp") > F.lit(start_ns - interval_ns).cast("bigint"))
        & (F.col("sip_timestamp") < F.lit(end_ns).cast("bigint"))
    ).withColumn("asof_timestamp", _boundary(interval_ns, start, "sip_timestamp"))
    placed = placed.where(F.col("asof_timestamp") < F.lit(end_ns).cast("bigint"))
    return last_record(placed, keys, _fields(quotes, keys))


def latest_before(quotes: DataFrame, at_ns: int, interval_ns: int) -> DataFrame:
    """The one latest record in ``(at - interval, at]``."""
    return (
        quotes.where(
            (F.col("sip_timestamp") <= F.lit(at_ns).cast("bigint"))
            & (F.col("sip_timestamp") > F.lit(at_ns - interval_ns).cast("bigint"))
        )
        .orderBy(F.desc("sip_timestamp"), F.desc("sequence_number"))
        .limit(1)
    )


def _on_file_dates(df: DataFrame, days: DataFrame, day: str) -> DataFrame:
    """Where rows carry their file's date, leave out files that none of ``days`` can need.

    A tick at the midnight after a day is in the next day's file, and a session's first
    interval may reach back to the file before. A file's ticks lie within a day of its date.
    """
    if "file_date" not in df.columns:
        return df
    near = F.array(F.date_sub(day, 1), F.col(day), F.date_add(day, 1))
    return on_dates(df, "file_date", days.select(F.explode(near).alias("_near")), "_near")


def ticks_in_windows(
    ticks: DataFrame, windows: DataFrame, by: str = "ticker", time: str = "sip_timestamp"
) -> DataFrame:
    """Every tick of each (ticker, snapshot_date), the next midnight included.

    A tick at exact midnight belongs to two days; it becomes two candidates, and the
    join stays an equality on (ticker, date).
    """
    day = sc.ns_to_date(time)
    at_midnight = F.pmod(F.col(time), F.lit(sc.DAY_NS)) == 0
    days = F.when(at_midnight, F.array(F.date_sub(day, 1), day)).otherwise(F.array(day))
    windows = dated(windows)
    wanted = windows.select(F.col("ticker").alias(by), "snapshot_date")
    ticks = _on_file_dates(ticks, windows, "snapshot_date")
    return ticks.withColumn("snapshot_date", F.explode(days)).join(wanted, [by, "snapshot_date"])


def bars_in_windows(
    quotes: DataFrame,
    windows: DataFrame,
    calendar: DataFrame,
    interval_ns: int,
    by: str = "ticker",
    underlying: str | None = None,
) -> DataFrame:
    """Session-grid quote bars of the windows' days only.

    The day of the boundary decides, and rows outside the windows are dropped
    before the aggregation. ``underlying`` names the column that windows refer to
    when bars are per contract.
    """
    on = underlying or by
    windows = dated(windows)
    wanted = windows.select(F.col("ticker").alias(on), F.col("snapshot_date").alias("_day"))
    keys = [by, "asof_timestamp"]
    placed = (
        on_session_grid(_on_file_dates(quotes, windows, "snapshot_date"), calendar, interval_ns)
        .withColumn("_day", sc.ns_to_date("asof_timestamp"))
        .join(wanted, [on, "_day"], "left_semi")
    )
    return last_record(placed, keys, _fields(quotes, keys))
