"""Incremental and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import ts_to_ns
from tickloom.operators import calendar as cal
from tickloom.operators import filters as fl
from tickloom.plans import market as m
from tickloom.plans.registry import query
from tickloom.session import scratch_path
from tickloom.sources import sinks
from tickloom.sources import versions as vs
from tickloom.specs.base import TableSpec
from tickloom.streaming import incremental as inc
from tickloom.streaming import quote_bars as sq


@query(
    "str01_starting_point",
    """SELECT user_id, greatest(max(epoch_us(ts)) FILTER (event_type = 'purchase'),
     CASE WHEN max(value) > 200 THEN epoch_us(TIMESTAMP '2024-01-28') END,
     epoch_us(TIMESTAMP '2024-01-20')) AS start_us FROM events GROUP BY user_id""",
)
def _(spark, d):
    state = m.table(spark, d, "events").groupBy("user_id").agg(
        F.max(F.when(F.col("event_type") == "purchase", F.col("ts").cast("timestamp"))).alias("state"),
        F.max("value").alias("top"),
    )
    configured = F.when(F.col("top") > 200, F.lit("2024-01-28").cast("timestamp"))
    start = inc.starting_point(F.col("state"), configured, F.lit("2024-01-20").cast("timestamp"))
    return state.select("user_id", F.unix_micros(start).alias("start_us"))


@query(
    "str02_read_since",
    f"""WITH {m.TICKS} SELECT CAST(file_date AS VARCHAR) AS file_date, ticker, sequence_number,
    round(price, 6) AS price FROM ticks""",
)
def _(spark, d):
    # A first run up to a date, then a second from that bookmark on: as one full run.
    spec = TableSpec(
        "ticks",
        "file_date date, ticker string, sequence_number bigint, price double",
        ("file_date", "ticker", "sequence_number"),
        "file_date",
    )
    rows = m.ticks(spark, d).select("file_date", "ticker", "sequence_number", "price")
    path = scratch_path(spark, "ticks")
    bookmark = "2024-01-14"
    sinks.write_table(fl.in_window(rows, "file_date", end=bookmark), spec, path)
    sinks.write_table(inc.read_since(rows, bookmark), spec, path)
    return spark.read.schema(spec.schema).parquet(path)


@query(
    "str03_adjust",
    f"""WITH {m.TICK_EARNINGS}, {m.TICK_CALENDAR}, {m.WINDOWS},
    b AS (SELECT 'U' || user_id AS ticker, max(epoch_us(ts)) * 1000 AS bookmark FROM events
     WHERE event_type = 'error' GROUP BY user_id),
    r AS (SELECT w.ticker, w.snapshot_date, epoch_us(CAST(snapshot_date AS TIMESTAMP)) * 1000
      AS start_ns, (epoch_us(CAST(snapshot_date AS TIMESTAMP)) + 86400000000) * 1000 AS end_ns,
     bookmark FROM windows w LEFT JOIN b USING (ticker))
    SELECT ticker, CAST(snapshot_date AS VARCHAR) AS snapshot_date,
    CASE WHEN bookmark IS NULL THEN start_ns ELSE greatest(start_ns, bookmark + 60000000000) END
     AS start_ns, end_ns FROM r
    WHERE bookmark IS NULL OR (end_ns > bookmark AND
     greatest(start_ns, bookmark + 60000000000) < end_ns)""",
)
def _(spark, d):
    windows = cal.earnings_windows(m.tick_earnings(spark, d), m.tick_calendar(spark, d))
    errors = m.table(spark, d, "events").where("event_type = 'error'").select(
        F.concat(F.lit("U"), "user_id").alias("ticker"), ts_to_ns("ts").alias("ns")
    )
    marks = inc.high_water(errors, ["ticker"], "ns")
    ranges = fl.day_ns_range(windows, "snapshot_date").join(marks, "ticker", "left")
    out = inc.adjust(ranges, 60_000_000_000)
    return out.select("ticker", "snapshot_date", "start_ns", "end_ns")


@query(
    "str04_advance",
    """SELECT user_id, event_type, max(event_id) AS bookmark FROM events
    GROUP BY user_id, event_type""",
)
def _(spark, d):
    events = m.table(spark, d, "events")
    keys = ["user_id", "event_type"]
    early = fl.in_window(events, "ts", end="2024-01-15")
    late = fl.in_window(events, "ts", start="2024-01-15")
    marks = inc.high_water(early, keys, "event_id")
    return inc.advance(marks, late, keys, "event_id")


@query(
    "str04_bookmark_store",
    """SELECT user_id, event_type, max(event_id) AS bookmark FROM events
    GROUP BY user_id, event_type""",
)
def _(spark, d):
    # Writers of different event types, one batch sent twice and one late batch with older marks.
    events = m.table(spark, d, "events").select("user_id", "event_type", "event_id", "ts")
    path, keys = scratch_path(spark, "bookmarks"), ["user_id", "event_type"]
    clicks = F.col("event_type") == "click"
    for writer, rows in (("clicks", events.where(clicks)), ("others", events.where(~clicks))):
        marks = inc.high_water(rows, keys, "event_id")
        for _ in range(2):
            vs.commit_marks(marks, path, keys, writer, 0)
    late = inc.high_water(fl.in_window(events, "ts", end="2024-01-10"), keys, "event_id")
    vs.commit_marks(late, path, keys, "late", 0)
    schema = T.StructType([events.schema[k] for k in keys] + [T.StructField("bookmark", late.schema["bookmark"].dataType)])
    return vs.read_marks(spark, path, schema)


def _event_stream(spark, d):
    """The events file as a stream."""
    schema = m.table(spark, d, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)


_STREAM_BARS = f"""WITH {m.quotes_sql()}, bars AS (SELECT ticker,
     ((sip_timestamp - 1) // {m.HOUR} + 1) * {m.HOUR} AS asof_timestamp,
     max({{'t': sip_timestamp, 's': sequence_number, 'ap': ask_price, 'bp': bid_price}}) AS q
     FROM quotes GROUP BY 1, 2)
    SELECT ticker, asof_timestamp, q.t AS sip_timestamp, q.s AS sequence_number,
    round(q.ap, 6) AS ask_price, round(q.bp, 6) AS bid_price FROM bars"""
_STREAM_FIELDS = ["sip_timestamp", "sequence_number", "ask_price", "bid_price"]


def _event_quotes(events):
    return events.select(
        F.col("event_type").alias("ticker"),
        ts_to_ns("ts").alias("sip_timestamp"),
        F.col("event_id").alias("sequence_number"),
        (F.col("value") + 0.05).alias("ask_price"),
        F.col("value").alias("bid_price"),
    )


@query("str05_stream_quote_bars", _STREAM_BARS)
def _(spark, d):
    stream = sq.stream_quote_bars(_event_quotes(_event_stream(spark, d)), m.HOUR, "1 day", _STREAM_FIELDS)
    emitted = sq.collect_stream(stream, "bars")
    open_ones = sq.closing_bars(emitted, _event_quotes(m.table(spark, d, "events")), m.HOUR, _STREAM_FIELDS)
    return emitted.unionByName(open_ones)


@query("str05_declared_end", _STREAM_BARS)
def _(spark, d):
    # A first run leaves the last bars open; after the end is declared a second run, from the
    # checkpoint, closes them.
    base = scratch_path(spark, "bars")
    for end_ns in (None, m.HOUR * 24 * 365 * 100):
        if end_ns is not None:
            sq.declare_end(spark, f"{base}/ends", end_ns)
        ends = sq.read_ends(spark, f"{base}/ends")
        quotes = _event_quotes(_event_stream(spark, d))
        bars = sq.stream_quote_bars(quotes, m.HOUR, "1 day", _STREAM_FIELDS, ends=ends)
        sq.run_available(bars, f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(bars.schema).parquet(f"{base}/out")


@query(
    "str06_dedupe_stream",
    """SELECT event_id, event_type, round(value, 6) AS value FROM events""",
)
def _(spark, d):
    copies = (
        _event_stream(spark, d)
        .withColumn("ts", F.col("ts").cast("timestamp"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3))))
    )
    once = sq.dedupe_stream(copies, ["event_id"], "ts", "60 days")
    return sq.collect_stream(once.select("event_id", "event_type", "value"), "dedupe")


@query(
    "str07_in_window",
    """SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-10'
    AND ts <= TIMESTAMP '2024-01-20 12:00:00'""",
)
def _(spark, d):
    rows = fl.in_window(
        m.table(spark, d, "events"), "ts", "2024-01-10 00:00:00", "2024-01-20 12:00:00"
    )
    return rows.select("event_id", "event_type")
