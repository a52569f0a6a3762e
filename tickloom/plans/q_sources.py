"""Sources and sinks: files are written from the tables, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import ns_to_date
from tickloom.functions.scalars import DAY_NS, floor_div
from tickloom.operators import bars as br
from tickloom.operators import quotes as qt
from tickloom.plans import market as m
from tickloom.plans.q_aggregates import bars_sql
from tickloom.plans.registry import query
from tickloom.session import scratch_path
from tickloom.sources import earnings as er
from tickloom.sources import flat_files as ff
from tickloom.sources import landed, sinks
from tickloom.sources import quote_tables as qtb
from tickloom.sources import versions as vs
from tickloom.sources.tables import load_indicator, load_table
from tickloom.specs import TABLES, conform
from tickloom.specs.base import TableSpec
from tickloom.streaming import quote_bars as sq

TICK_FILE = (
    "file_date string, ticker string, sip_timestamp bigint, sequence_number bigint, "
    "price double, size double"
)


def _write_dated_csv(df, path: str, compression: str = "gzip") -> str:
    (
        df.repartitionByRange("file_date", "ticker")
        .write.partitionBy("file_date")
        .option("header", True)
        .option("compression", compression)
        .csv(path)
    )
    return path


@query(
    "src01_scan_flat_files",
    f"""WITH {m.TICKS} SELECT CAST(file_date AS VARCHAR) AS file_date, ticker, sip_timestamp,
    sequence_number, round(price, 6) AS price, CAST(size AS DOUBLE) AS size FROM ticks""",
)
def _(spark, d):
    path = _write_dated_csv(m.ticks(spark, d), scratch_path(spark, "ticks-csv"))
    return ff.scan_flat_files(spark, path, TICK_FILE)


@query(
    "src01_files_by_name",
    f"""WITH {m.TICKS} SELECT CAST(file_date AS VARCHAR) AS file_date, ticker, sip_timestamp,
    sequence_number, CASE WHEN day(file_date) % 3 <> 2 THEN round(price, 6) END AS price,
    CAST(size AS DOUBLE) AS size FROM ticks""",
)
def _(spark, d):
    # One folder of files in three column orders, those of one order without a price.
    path = scratch_path(spark, "ticks-by-name")
    ticks = m.ticks(spark, d)
    names = ["ticker", "sip_timestamp", "sequence_number", "price", "size"]
    for k, order in enumerate((names, names[::-1], ["size", "ticker", "sequence_number", "sip_timestamp"])):
        part = ticks.where(F.dayofmonth(F.col("file_date").cast("date")) % 3 == k)
        part.select("file_date", *order).write.mode("append").partitionBy("file_date").option("header", True).csv(path)
    return ff.scan_flat_files(spark, path, TICK_FILE)


@query(
    "src02_coerce",
    """SELECT event_id,
    CASE event_type WHEN 'click' THEN k WHEN 'view' THEN k WHEN 'purchase' THEN k
     WHEN 'signup' THEN k * 10 END AS as_int,
    CASE event_type WHEN 'click' THEN CAST(k AS DOUBLE) WHEN 'view' THEN CAST(k AS DOUBLE)
     WHEN 'purchase' THEN k + 0.75 WHEN 'signup' THEN k * 10.0 END AS as_number,
    CASE event_type WHEN 'click' THEN 'true' WHEN 'view' THEN 'true' WHEN 'signup' THEN 'false'
     WHEN 'error' THEN 'true' END AS as_bool
    FROM (SELECT event_id, event_type,
     CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)""",
)
def _(spark, d):
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k")
    dirty = m.table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(kind == "click", k)
        .when(kind == "view", F.concat(F.lit(" "), k, F.lit(" ")))
        .when(kind == "purchase", F.concat(k, F.lit(".75")))
        .when(kind == "signup", F.concat(k, F.lit("e1")))
        .otherwise("n/a")
        .alias("as_int"),
        F.when(kind == "click", "TRUE")
        .when(kind == "view", "1")
        .when(kind == "purchase", "")
        .when(kind == "signup", "no")
        .otherwise(" true ")
        .alias("as_bool"),
    )
    schema = "event_id bigint, as_int bigint, as_number double, as_bool boolean"
    typed = ff.coerce(dirty.withColumn("as_number", F.col("as_int")), schema)
    return typed.withColumn("as_bool", F.col("as_bool").cast("string"))


@query(
    "src03_scan_quotes",
    f"""WITH {m.quotes_sql('option')} SELECT CAST(file_date AS VARCHAR) AS file_date, ticker,
    sip_timestamp, sequence_number, ask_exchange, round(ask_price, 6) AS ask_price, ask_size,
    bid_exchange, round(bid_price, 6) AS bid_price, bid_size FROM quotes""",
)
def _(spark, d):
    path = _write_dated_csv(m.quotes(spark, d, "option"), scratch_path(spark, "quotes-csv"))
    return ff.scan_quotes(spark, path, qt.QUOTE_ASSETS["option"].csv).drop("file_path")


@query(
    "src04_explode_results",
    """SELECT CAST(o_orderkey AS BIGINT) AS order_key, o_custkey AS cust_key,
    round(o_totalprice, 6) AS total_price, 'primary' AS role FROM orders
    UNION ALL
    SELECT CAST(o_orderkey AS BIGINT), o_custkey, NULL, 'copy' FROM orders
    WHERE o_orderstatus = 'O'""",
)
def _(spark, d):
    record = F.struct(
        F.col("o_orderkey").alias("orderKey"),
        F.col("o_custkey").alias("c"),
        F.col("o_totalprice").alias("totalPrice"),
        F.lit("primary").alias("role"),
    )
    copy = F.struct(
        F.col("o_orderkey").alias("orderKey"),
        F.col("o_custkey").alias("c"),
        F.lit("n/a").alias("totalPrice"),
        F.lit("copy").alias("role"),
    )
    status = F.col("o_orderstatus")
    listed = F.concat(
        F.lit('{"status":"OK","results":['), F.to_json(record), F.lit(","),
        F.to_json(copy), F.lit("]}"),
    )
    single = F.concat(F.lit('{"results":'), F.to_json(record), F.lit("}"))
    pages = m.table(spark, d, "orders").select(
        F.when(status == "O", listed)
        .when(status == "F", single)
        .otherwise(F.to_json(record))
        .alias("payload")
    )
    schema = "order_key bigint, cust_key bigint, total_price double, role string"
    return landed.read_records(landed.explode_results(pages), schema, {"c": "cust_key"})


_HOUR_US = 3_600_000_000


@query(
    "src04_indicator_pages",
    f"""WITH {m.DAY_BARS}, s AS (SELECT ticker, close, window_start AS t,
     lag(window_start) OVER w AS lt, lag(close) OVER w AS lc,
     (window_start // {DAY_NS}) % 3 AS k
     FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY window_start))
    SELECT ticker, CAST(t // 1000 + CASE k WHEN 1 THEN {_HOUR_US} WHEN 2 THEN -{_HOUR_US} ELSE 0 END
     AS BIGINT) AS timestamp_us, round(close / 2, 6) AS value, 'close_day_10' AS series,
    CAST(CASE WHEN k = 2 THEN lt ELSE t END // 1000 AS BIGINT) AS underlying_us,
    round(CASE WHEN k = 2 THEN lc ELSE close END, 6) AS underlying_close FROM s""",
)
def _(spark, d):
    # A page per ticker and month: values at, after and before their bar, and the bars. A value
    # before a month's first bar belongs to the last bar of another page. Trades are shuffled
    # once, by page, for their bars and for the page.
    month = F.date_format(ns_to_date("sip_timestamp"), "yyyy-MM")
    trades = m.tape(spark, d).withColumn("month", month).repartition("ticker", "month")
    bars = br.ohlcv_bars(trades, 1, "day", ("ticker", "month")).select("ticker", "month", "window_start", "close")
    ms = floor_div(F.col("window_start"), 1_000_000)
    kind = F.pmod(floor_div(F.col("window_start"), DAY_NS), F.lit(3))
    moved = F.when(kind == 1, ms + _HOUR_US // 1000).when(kind == 2, ms - _HOUR_US // 1000).otherwise(ms)
    point = F.struct(moved.alias("timestamp"), (F.col("close") / 2).alias("value"))
    bar = F.struct(F.col("ticker").alias("T"), ms.alias("t"), F.col("close").alias("c"))
    pages = bars.groupBy("ticker", "month").agg(
        F.collect_list(point).alias("values"), F.collect_list(bar).alias("aggregates")
    )
    results = F.struct("values", F.struct("aggregates").alias("underlying"))
    payload = F.to_json(F.struct(results.alias("results")))
    found = load_indicator(pages.select("ticker", payload.alias("payload")), "stock_sma", "close", "day", 10)
    return found.select(
        "ticker", F.unix_micros("timestamp").alias("timestamp_us"), "value",
        F.col("series_window_timespan").alias("series"),
        F.unix_micros("underlying_timestamp").alias("underlying_us"), "underlying_close",
    )


_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"


@query(
    "src04_landed_bars",
    f"""SELECT 'U' || user_id AS ticker, epoch_us(date_trunc('millisecond', ts)) AS timestamp_us,
    round(value, 6) AS open, round(value + {_K}, 6) AS high, CAST({_K} AS DOUBLE) AS volume,
    event_id AS transactions, event_type <> 'error' AS active FROM events
    WHERE event_type <> 'signup'""",
)
def _(spark, d):
    k = F.get_json_object("props", "$.k").cast("bigint")
    kind = F.col("event_type")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    # Bars of one type lack their time and are dropped; prices are partly text.
    record = F.struct(
        F.when(kind != "signup", ms).alias("t"),
        F.col("value").alias("o"),
        (F.col("value") + k).cast("string").alias("high"),
        k.alias("v"),
        F.col("event_id").alias("n"),
        F.lit("ignored").alias("T"),
    )
    pages = m.table(spark, d, "events").select(
        F.concat(F.lit("U"), "user_id").alias("ticker"),
        F.when(kind == "error", "no").when(kind == "view", "yes").alias("active"),
        F.concat(F.lit('{"results":['), F.to_json(record), F.lit("]}")).alias("payload"),
    )
    bars = load_table(pages, "stock_bars_1_minute", ("ticker", "active"))
    return bars.select(
        "ticker",
        F.unix_micros("timestamp").alias("timestamp_us"),
        "open",
        "high",
        "volume",
        "transactions",
        "active",
    )


@query(
    "src04_landed_snapshot",
    f"""SELECT 'E' || event_id AS ticker, round(value, 6) AS todays_change_percent,
    CAST({_K} AS DOUBLE) AS prev_close, round(value, 6) AS bid_price,
    CASE WHEN event_type = 'click' THEN user_id END AS ask_exchange,
    CASE WHEN event_type = 'click' THEN {_K} END AS bid_exchange,
    CASE WHEN event_type <> 'click' THEN {_K} END AS exchange,
    CAST({_K} AS DOUBLE) AS trade_price FROM events""",
)
def _(spark, d):
    k = F.get_json_object("props", "$.k").cast("bigint")
    quote = F.struct(
        F.col("value").alias("p"),
        F.when(F.col("event_type") == "click", F.col("user_id")).alias("X"),
        k.alias("x"),
    )
    record = F.struct(
        F.concat(F.lit("E"), "event_id").alias("ticker"),
        F.col("value").alias("todaysChangePerc"),
        F.struct(k.alias("c")).alias("prevDay"),
        quote.alias("lastQuote"),
        F.struct(k.alias("price")).alias("lastTrade"),
    )
    pages = m.table(spark, d, "events").select(
        F.concat(F.lit('{"status":"OK","ticker":'), F.to_json(record), F.lit("}")).alias("payload")
    )
    snapshot = load_table(pages, "stock_ticker_snapshot")
    return snapshot.select(
        "ticker",
        "todays_change_percent",
        F.col("prev_day.close").alias("prev_close"),
        "last_quote.bid_price",
        "last_quote.ask_exchange",
        "last_quote.bid_exchange",
        "last_quote.exchange",
        F.col("last_trade.price").alias("trade_price"),
    )


@query(
    "src05_declared_table",
    f"""WITH {m.DAY_BARS} SELECT CAST(make_date(1970, 1, 1) + CAST(window_start // 86400000000000
     AS INTEGER) AS VARCHAR) AS file_date, ticker, CAST(window_start AS BIGINT) AS window_start,
    round(open, 6) AS open, round(close, 6) AS close, round(high, 6) AS high, round(low, 6) AS low,
    round(volume, 6) AS volume, {m.settled('vwap')}, transactions,
    CAST(NULL AS VARCHAR) AS otc FROM bars""",
)
def _(spark, d):
    bars = m.day_bars(spark, d).withColumn(
        "file_date", ns_to_date("window_start").cast("string")
    )
    out = conform(bars, TABLES["stocks_flat_files_eod"])
    return out.withColumn("otc", F.col("otc").cast("string"))


@query(
    "src06_earnings_dates",
    f"""WITH {m.ORDER_EARNINGS} SELECT ticker, CAST(date AS VARCHAR) AS date FROM (
    SELECT ticker, date FROM order_earnings WHERE o_orderstatus = 'F'
     AND date BETWEEN DATE '{m.EARNINGS_START}' AND DATE '{m.EARNINGS_END}'
    UNION
    SELECT ticker, date FROM order_earnings WHERE o_orderstatus <> 'F'
     AND type IN ('earnings_announcement_date', 'earnings_conference_call',
      'earnings_results_announcement')
     AND date BETWEEN DATE '{m.EARNINGS_START}' AND DATE '{m.EARNINGS_END}')""",
)
def _(spark, d):
    return er.earnings_dates(
        m.releases(spark, d),
        m.corporate_events(spark, d),
        "both",
        m.EARNINGS_START,
        m.EARNINGS_END,
    )


@query(
    "src07_stream_flat_files",
    f"""WITH {m.TICKS} SELECT CAST(file_date AS VARCHAR) AS file_date, ticker, sip_timestamp,
    sequence_number, round(price, 6) AS price, CAST(size AS DOUBLE) AS size FROM ticks""",
)
def _(spark, d):
    path = _write_dated_csv(m.ticks(spark, d), scratch_path(spark, "ticks-csv"))
    return sq.collect_stream(ff.stream_flat_files(spark, path, TICK_FILE), "ticks-stream")


@query(
    "snk01_write_table",
    f"""WITH {m.TICKS} SELECT CAST(file_date AS VARCHAR) AS file_date, ticker, sequence_number,
    round(price, 6) AS price FROM ticks""",
)
def _(spark, d):
    spec = TableSpec(
        "ticks",
        "file_date date, ticker string, sequence_number bigint, price double",
        ("file_date", "ticker", "sequence_number"),
        "file_date",
    )
    rows = m.ticks(spark, d).select("file_date", "ticker", "sequence_number", "price")
    path = scratch_path(spark, "ticks")
    # Doubled input written twice: each key still has one row.
    for _ in range(2):
        sinks.write_table(rows.unionByName(rows), spec, path, order=("price",))
    return spark.read.schema(spec.schema).parquet(path)


@query(
    "snk01_upsert_part_of_a_date",
    f"""WITH {m.TICKS}, b AS (
     SELECT file_date, ticker, sequence_number, price, 0 AS batch FROM ticks
     WHERE sequence_number % 4 <> 1
     UNION ALL SELECT file_date, ticker, sequence_number, price + 1, 1 FROM ticks
     WHERE sequence_number % 4 < 2
     UNION ALL SELECT file_date, ticker, sequence_number, price + 1, 1 FROM ticks
     WHERE sequence_number % 4 = 0)
    SELECT CAST(file_date AS VARCHAR) AS file_date, ticker, sequence_number,
    round(arg_max(price, batch), 6) AS price FROM b
    GROUP BY file_date, ticker, sequence_number""",
)
def _(spark, d):
    """A second batch with new, changed and repeated keys of dates that are there already."""
    spec = TableSpec(
        "ticks",
        "file_date date, ticker string, sequence_number bigint, price double",
        ("file_date", "ticker", "sequence_number"),
        "file_date",
    )
    rows = m.ticks(spark, d).select("file_date", "ticker", "sequence_number", "price")
    part = F.pmod("sequence_number", F.lit(4))
    changed = rows.withColumn("price", F.col("price") + 1)
    path = scratch_path(spark, "ticks")
    sinks.write_table(rows.where(part != 1), spec, path)
    sinks.write_table(
        changed.where(part < 2).unionByName(changed.where(part == 0)), spec, path
    )
    return spark.read.schema(spec.schema).parquet(path)


@query(
    "snk01_versions",
    f"""WITH {m.TICKS} SELECT CAST(file_date AS VARCHAR) AS file_date, ticker, sequence_number,
    round(price, 6) AS price FROM ticks""",
)
def _(spark, d):
    # A stream of two batches and a replay of the last, then a batch writer for part of the dates.
    spec = TableSpec(
        "ticks",
        "file_date date, ticker string, sequence_number bigint, price double",
        ("file_date", "ticker", "sequence_number"),
        "file_date",
    )
    rows = m.ticks(spark, d).select("file_date", "ticker", "sequence_number", "price")
    path = scratch_path(spark, "versions")
    half = F.col("sequence_number") % 2 == 0
    wrong = rows.withColumn("price", F.lit(0.0))
    vs.upsert_version(wrong.where(half), spec, path, writer="feed", batch_id=0)
    vs.upsert_version(rows, spec, path, writer="feed", batch_id=1)
    vs.upsert_version(wrong, spec, path, writer="feed", batch_id=1)
    vs.upsert_version(rows.where(F.dayofmonth(F.col("file_date").cast("date")) == 3), spec, path)
    return vs.read_version(spark, path, spec.schema)


@query("snk01_quote_files_to_bars", bars_sql("option", m.HOUR, True))
def _(spark, d):
    # Files up to a date become bars; a second run goes on from there, a third finds nothing new.
    files, path = scratch_path(spark, "quotes-csv"), scratch_path(spark, "quote-bars")
    _write_dated_csv(m.quotes(spark, d, "option"), files)
    table = TABLES["options_quote_snapshots_flat_files_1_minute"]
    for end in ("2024-01-15", None, None):
        qtb.update_quote_bars(spark, files, path, table, m.HOUR, end=end)
    return vs.read_version(spark, path, table.schema)


@query(
    "snk02_write_by_venue",
    f"""WITH {m.quotes_sql('stock')}, tagged AS (SELECT *, CASE ticker WHEN 'click' THEN 'cme'
     WHEN 'view' THEN 'cbot' WHEN 'purchase' THEN 'comex' ELSE 'nymex' END AS venue FROM quotes)
    SELECT venue, ticker, sip_timestamp, sequence_number, round(bid_price, 6) AS bid_price
    FROM tagged""",
)
def _(spark, d):
    t = F.col("ticker")
    venue = (
        F.when(t == "click", "cme")
        .when(t == "view", "cbot")
        .when(t == "purchase", "comex")
        .otherwise("nymex")
    )
    path = scratch_path(spark, "venues")
    rows = m.quotes(spark, d, "stock").withColumn("venue", venue)
    # Two batches that share a third of their rows: the venues keep what each one brought.
    third = F.pmod("sequence_number", F.lit(3))
    sinks.write_by_venue(rows.where(third < 2), path)
    sinks.write_by_venue(rows.where(third > 0), path)
    return spark.read.parquet(path).select(
        "venue", "ticker", "sip_timestamp", "sequence_number", "bid_price"
    )
