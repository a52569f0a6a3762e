"""Aggregations and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import bars as br
from tickloom.operators import calendar as cal
from tickloom.operators import quotes as qt
from tickloom.operators import ratings as rt
from tickloom.operators import universe
from tickloom.plans import market as m
from tickloom.plans.registry import query
from tickloom.sources import earnings as er
from tickloom.streaming import incremental as inc

_BUCKET = "((sip_timestamp - 1) // {step} + 1) * {step}"


def bars_sql(kind: str, step: int, by_date: bool = False) -> str:
    fields = [f for f in m.QUOTE_FIELDS]
    packed = ", ".join(f"'{f}': {f}" for f in fields)
    shown = ", ".join(
        f"round(q.{f}, 6) AS {f}" if f.endswith("price") else f"q.{f} AS {f}" for f in fields
    )
    date = "file_date, " if by_date else ""
    date_out = "CAST(file_date AS VARCHAR) AS file_date, " if by_date else ""
    bucket = _BUCKET.format(step=step)
    return f"""WITH {m.quotes_sql(kind)}, bars AS (SELECT {date}ticker,
     {bucket} AS asof_timestamp, max({{{packed}}}) AS q FROM quotes
     GROUP BY {date}ticker, {bucket})
    SELECT {date_out}ticker, CAST(asof_timestamp AS BIGINT) AS asof_timestamp, {shown} FROM bars"""


@query("agg01_quote_bars", bars_sql("stock", m.HOUR))
def _(spark, d):
    return qt.quote_bars(m.quotes(spark, d), m.HOUR, "stock")


@query("agg02_quote_bars_by_file_date", bars_sql("option", 60_000_000_000, True))
def _(spark, d):
    quotes = m.quotes(spark, d, "option")
    # The same files listed twice change nothing.
    return qt.quote_bars(quotes.unionByName(quotes), 60_000_000_000, "option", True)


@query(
    "agg03_future_quote_bars",
    f"""WITH {m.quotes_sql('stock')}, bars AS (SELECT ticker,
     {_BUCKET.format(step=1_800_000_000_000)} AS asof_timestamp,
     max({{'t': sip_timestamp, 's': sequence_number, 'ap': ask_price, 'bp': bid_price,
      'ex': ask_exchange, 'd': file_date}}) AS q FROM quotes GROUP BY 1, 2)
    SELECT ticker, CAST(asof_timestamp AS BIGINT) AS asof_timestamp, q.t AS sip_timestamp,
    q.s AS sequence_number, q.s + 1 AS report_sequence, q.t - 1000 AS ask_timestamp,
    q.t - 2000 AS bid_timestamp, round(q.ap, 6) AS ask_price, round(q.bp, 6) AS bid_price,
    q.ex AS exchange, CAST(q.d AS VARCHAR) AS session_end_date, 'cme' AS venue FROM bars""",
)
def _(spark, d):
    futures = m.quotes(spark, d).select(
        "ticker",
        F.col("sip_timestamp").alias("timestamp"),
        "sequence_number",
        (F.col("sequence_number") + 1).alias("report_sequence"),
        (F.col("sip_timestamp") - 1000).alias("ask_timestamp"),
        "ask_price",
        (F.col("sip_timestamp") - 2000).alias("bid_timestamp"),
        "bid_price",
        F.col("ask_exchange").alias("exchange"),
        F.col("file_date").alias("session_end_date"),
    )
    return qt.quote_bars(futures, 1_800_000_000_000, "future", venue="cme")


_BAR_OUT = (
    """ticker, CAST(window_start AS BIGINT) AS window_start, round(open, 6) AS open,
 round(high, 6) AS high, round(low, 6) AS low, round(close, 6) AS close,
 CAST(volume AS {volume}) AS volume, """
    + m.settled("vwap")
    + ", transactions"
)

_SIZES = {
    "1_second": ("second", 1, "(sip_timestamp // 1000000000) * 1000000000"),
    "30_second": ("second", 30, "(sip_timestamp // 30000000000) * 30000000000"),
    "1_minute": ("minute", 1, "(sip_timestamp // 60000000000) * 60000000000"),
    "5_minute": ("minute", 5, "(sip_timestamp // 300000000000) * 300000000000"),
    "30_minute": ("minute", 30, "(sip_timestamp // 1800000000000) * 1800000000000"),
    "1_hour": ("hour", 1, "(sip_timestamp // 3600000000000) * 3600000000000"),
    "1_day": ("day", 1, m.DAY_START),
    "1_week": (
        "week", 1,
        "epoch_us(date_trunc('week', make_timestamp(sip_timestamp // 1000))) * 1000",
    ),
    "1_month": (
        "month", 1,
        "epoch_us(date_trunc('month', make_timestamp(sip_timestamp // 1000))) * 1000",
    ),
}


def _register_sizes() -> None:
    for size, (timespan, multiplier, start) in _SIZES.items():
        sql = f"""WITH {m.TICKS}, {m.bars_sql('ticks', start)}
        SELECT {_BAR_OUT.format(volume='BIGINT')} FROM bars"""

        def build(spark, d, timespan=timespan, multiplier=multiplier):
            return br.ohlcv_bars(m.ticks(spark, d), multiplier, timespan)

        query(f"agg04_ohlcv_bars_{size}", sql)(build)


_register_sizes()


@query(
    "agg05_daily_market_summary",
    f"""WITH {m.WIDE_TICKS}, {m.bars_sql('ticks', m.DAY_START)}
    SELECT {_BAR_OUT.format(volume='BIGINT')} FROM bars
    WHERE window_start = epoch_us(TIMESTAMP '2024-01-17') * 1000""",
)
def _(spark, d):
    return br.daily_market_summary(m.ticks(spark, d, wide=True), "2024-01-17")


@query(
    "agg06_daily_ticker_summary",
    f"""WITH {m.TICKS}, {m.TICK_CALENDAR}, t AS (SELECT *,
     {{'t': sip_timestamp, 's': sequence_number, 'p': price}} AS x,
     sip_timestamp < open_ns AS pre, sip_timestamp >= close_ns AS post
     FROM ticks JOIN calendar ON date = file_date)
    SELECT ticker, CAST(date AS VARCHAR) AS "from",
    round((min(x) FILTER (NOT pre AND NOT post)).p, 6) AS open,
    round(max(price) FILTER (NOT pre AND NOT post), 6) AS high,
    round(min(price) FILTER (NOT pre AND NOT post), 6) AS low,
    round((max(x) FILTER (NOT pre AND NOT post)).p, 6) AS close,
    CAST(sum(size) FILTER (NOT pre AND NOT post) AS BIGINT) AS volume,
    round((min(x) FILTER (pre)).p, 6) AS pre_market,
    round((max(x) FILTER (post)).p, 6) AS after_hours
    FROM t GROUP BY ticker, date""",
)
def _(spark, d):
    return br.daily_ticker_summary(m.ticks(spark, d), m.tick_calendar(spark, d))


@query(
    "agg07_previous_day_bar",
    f"""WITH {m.DAY_BARS}, last AS (SELECT ticker, max(window_start) AS window_start FROM bars
     WHERE window_start < epoch_us(TIMESTAMP '1999-06-15') * 1000 GROUP BY ticker)
    SELECT {_BAR_OUT.format(volume='DOUBLE')} FROM bars JOIN last USING (ticker, window_start)""",
)
def _(spark, d):
    return br.previous_day_bar(m.day_bars(spark, d), "1999-06-15")


@query(
    "agg08_last_by_ticker",
    f"""WITH {m.WIDE_TICKS} SELECT ticker, max(sip_timestamp) AS sip_timestamp,
    max_by(sequence_number, sip_timestamp) AS sequence_number,
    round(max_by(price, sip_timestamp), 6) AS price, max_by(size, sip_timestamp) AS size
    FROM ticks GROUP BY ticker""",
)
def _(spark, d):
    return br.last_by_ticker(m.ticks(spark, d, wide=True).drop("file_date"))


_AS_OF = 1_705_514_400_000_000_000  # 2024-01-17 18:00:00 UTC

_SNAPSHOT = f"""WITH {m.TICKS}, {m.bars_sql('ticks', m.DAY_START)}, {m.quotes_sql()},
 today AS (SELECT *, (sip_timestamp // 60000000000) * 60000000000 AS minute FROM ticks
  WHERE sip_timestamp >= {_AS_OF - _AS_OF % m.DAY} AND sip_timestamp <= {_AS_OF}),
 {m.bars_sql('today', m.DAY_START, name='days')}, {m.bars_sql('today', 'minute', name='minutes')},
 last_minute AS (SELECT * FROM minutes m WHERE window_start =
  (SELECT max(window_start) FROM minutes n WHERE n.ticker = m.ticker)),
 prev AS (SELECT ticker, max(window_start) AS window_start FROM bars
  WHERE window_start < {_AS_OF - _AS_OF % m.DAY} GROUP BY ticker),
 prev_day AS (SELECT bars.* FROM bars JOIN prev USING (ticker, window_start)),
 last_quote AS (SELECT ticker, max({{'t': sip_timestamp, 'a': ask_price, 'b': bid_price}}) AS q
  FROM quotes WHERE sip_timestamp >= {_AS_OF - _AS_OF % m.DAY} AND sip_timestamp <= {_AS_OF}
  GROUP BY ticker),
 last_trade AS (SELECT ticker, max({{'t': sip_timestamp, 'p': price, 'z': size}}) AS t
  FROM today GROUP BY ticker)
SELECT d.ticker, round(d.open, 6) AS day_open, round(d.high, 6) AS day_high,
 round(d.low, 6) AS day_low, round(d.close, 6) AS day_close,
 CAST(d.volume AS BIGINT) AS day_volume, round(d.vwap + {m.NUDGE}, 6) AS day_vwap,
 round(n.close, 6) AS min_close, CAST(n.volume AS BIGINT) AS min_volume,
 CAST(n.window_start AS BIGINT) AS min_timestamp, CAST(d.volume AS BIGINT) AS min_accumulated,
 round(p.close, 6) AS prev_close, q.t AS quote_ns, round(q.a, 6) AS ask_price,
 t.t AS trade_ns, round(t.p, 6) AS trade_price, t.z AS trade_size,
 round(d.close - p.close, 6) AS todays_change,
 round(100 * (d.close - p.close) / p.close, 6) AS todays_change_percent
 FROM days d JOIN last_minute n USING (ticker) JOIN prev_day p USING (ticker)
 JOIN last_quote USING (ticker) JOIN last_trade USING (ticker)"""


@query("agg09_market_snapshot", _SNAPSHOT)
def _(spark, d):
    trades = m.ticks(spark, d).drop("file_date")
    snap = br.market_snapshot(
        trades, m.quotes(spark, d), br.ohlcv_bars(trades, 1, "day"), _AS_OF
    )
    return snap.select(
        "ticker",
        *[F.col(f"day.{c}").alias(f"day_{c}") for c in ("open", "high", "low", "close", "volume", "vwap")],
        F.col("min.close").alias("min_close"),
        F.col("min.volume").alias("min_volume"),
        F.col("min.timestamp").alias("min_timestamp"),
        F.col("min.accumulated_volume").alias("min_accumulated"),
        F.col("prev_day.close").alias("prev_close"),
        F.col("last_quote.sip_timestamp").alias("quote_ns"),
        F.col("last_quote.ask_price").alias("ask_price"),
        F.col("last_trade.sip_timestamp").alias("trade_ns"),
        F.col("last_trade.price").alias("trade_price"),
        F.col("last_trade.size").alias("trade_size"),
        "todays_change",
        "todays_change_percent",
    )


@query(
    "agg09_unified_snapshot",
    f"""SELECT ticker, 'stocks' AS type, todays_change AS change,
    todays_change_percent AS change_percent, day_open AS open, day_close AS close,
    prev_close AS previous_close FROM ({_SNAPSHOT})""",
)
def _(spark, d):
    trades = m.ticks(spark, d).drop("file_date")
    snap = br.market_snapshot(
        trades, m.quotes(spark, d), br.ohlcv_bars(trades, 1, "day"), _AS_OF
    )
    return br.unified_snapshot(snap, "stocks").select(
        "ticker",
        "type",
        "session.change",
        "session.change_percent",
        "session.open",
        "session.close",
        "session.previous_close",
    )


@query(
    "agg10_distinct_pairs",
    f"""WITH {m.ORDER_EARNINGS} SELECT DISTINCT ticker, CAST(date AS VARCHAR) AS date
    FROM order_earnings""",
)
def _(spark, d):
    return er.distinct_pairs(m.order_earnings(spark, d))


_RATING = {
    "click": "hold", "view": "sell", "purchase": "strong_buy",
    "signup": "buy", "error": "strong_sell",
}


@query(
    "agg11_consensus",
    """WITH r AS (SELECT 'T' || (event_id // 100) AS ticker, user_id AS analyst,
     value AS price_target, CASE event_type WHEN 'click' THEN 3 WHEN 'view' THEN 2
      WHEN 'purchase' THEN 5 WHEN 'signup' THEN 4 ELSE 1 END AS v FROM events)
    SELECT ticker, count(*) FILTER (v = 1) AS strong_sell_ratings, count(*) FILTER (v = 2) AS sell_ratings,
    count(*) FILTER (v = 3) AS hold_ratings, count(*) FILTER (v = 4) AS buy_ratings,
    count(*) FILTER (v = 5) AS strong_buy_ratings, count(DISTINCT analyst) AS ratings_contributors,
    count(DISTINCT analyst) AS price_target_contributors,
    round(avg(price_target), 6) AS consensus_price_target,
    round(max(price_target), 6) AS high_price_target,
    round(min(price_target), 6) AS low_price_target,
    round(avg(v), 6) AS consensus_rating_value,
    CASE CAST(floor(avg(v) + 0.5) AS INTEGER) WHEN 1 THEN 'strong_sell' WHEN 2 THEN 'sell'
     WHEN 3 THEN 'hold' WHEN 4 THEN 'buy' ELSE 'strong_buy' END AS consensus_rating
    FROM r GROUP BY ticker""",
)
def _(spark, d):
    names = F.create_map(*[F.lit(x) for pair in _RATING.items() for x in pair])
    ratings = m.table(spark, d, "events").select(
        F.concat(
            F.lit("T"), F.call_function("div", F.col("event_id"), F.lit(100).cast("bigint"))
        ).alias("ticker"),
        F.col("user_id").alias("analyst"),
        F.col("value").alias("price_target"),
        names[F.col("event_type")].alias("rating"),
    )
    return rt.consensus(ratings)


@query(
    "agg12_rolling_accounts",
    """WITH s AS (SELECT event_type AS category, user_id AS account, CAST(ts AS DATE) AS date,
     value FROM events),
    days AS (SELECT category, date, sum(value) AS total_spend, count(*) AS total_transactions,
     count(DISTINCT account) AS total_accounts FROM s GROUP BY 1, 2),
    a AS (SELECT DISTINCT category, account, date FROM s)
    SELECT d.category, CAST(d.date AS VARCHAR) AS date, round(any_value(total_spend), 6)
     AS total_spend, any_value(total_transactions) AS total_transactions,
    any_value(total_accounts) AS total_accounts,
    count(DISTINCT a.account) FILTER (a.date > d.date - 8) AS rolling_8_day_accounts,
    count(DISTINCT a.account) AS rolling_28_day_accounts
    FROM days d JOIN a ON a.category = d.category AND a.date <= d.date AND a.date > d.date - 28
    GROUP BY d.category, d.date""",
)
def _(spark, d):
    spend = m.table(spark, d, "events").select(
        F.col("event_type").alias("category"),
        F.col("user_id").alias("account"),
        F.col("ts").cast("date").alias("date"),
        F.col("value").alias("amount"),
    )
    return rt.rolling_accounts(spend)


@query(
    "agg13_first_window",
    f"""WITH {m.EARNINGS}, {m.TAPE_CALENDAR}, {m.WINDOWS}
    SELECT ticker, CAST(min(snapshot_date) AS VARCHAR) AS first_date FROM windows
    GROUP BY ticker""",
)
def _(spark, d):
    windows = cal.earnings_windows(m.earnings(spark, d), m.tape_calendar(spark, d))
    return cal.first_window(windows)


@query(
    "agg14_coverage",
    f"""WITH {m.TAPE} SELECT ticker, CAST(min(file_date) AS VARCHAR) AS first_date,
    CAST(max(file_date) AS VARCHAR) AS last_date, count(DISTINCT file_date) AS days,
    CAST(min(file_date) - 1 AS VARCHAR) AS last_invalid_date FROM tape GROUP BY ticker""",
)
def _(spark, d):
    return rt.coverage(m.tape(spark, d), "file_date", ["ticker"])


@query(
    "agg14_coverage_gaps",
    f"""WITH {m.TAPE}, {m.TAPE_CALENDAR}, span AS (SELECT ticker, min(file_date) AS a,
     max(file_date) AS b FROM tape GROUP BY ticker)
    SELECT s.ticker, CAST(c.date AS VARCHAR) AS date FROM span s
    JOIN calendar c ON c.date > s.a AND c.date < s.b
    ANTI JOIN tape t ON t.ticker = s.ticker AND t.file_date = c.date""",
)
def _(spark, d):
    return rt.coverage_gaps(m.tape(spark, d), m.tape_calendar(spark, d), "file_date", ["ticker"])


@query(
    "agg15_high_water",
    """SELECT user_id, event_type, max(event_id) AS bookmark FROM events
    GROUP BY user_id, event_type""",
)
def _(spark, d):
    return inc.high_water(m.table(spark, d, "events"), ["user_id", "event_type"], "event_id")


# -- set operations ----------------------------------------------------------
@query(
    "set01_union_distinct",
    f"""WITH {m.ORDER_EARNINGS} SELECT ticker, CAST(date AS VARCHAR) AS date FROM (
    SELECT ticker, date FROM order_earnings WHERE o_orderstatus = 'F'
    UNION SELECT ticker, date FROM order_earnings WHERE o_orderstatus <> 'F')""",
)
def _(spark, d):
    events = m.corporate_events(spark, d).select("ticker", "date")
    return er.union_distinct(m.releases(spark, d), events)


@query(
    "set02_union_both",
    f"""WITH {m.CONTRACTS}, passes AS (
     SELECT ticker, strike_price, coalesce(expired, true) AS expired, 0 AS pass FROM contracts
      WHERE expired OR expired IS NULL
     UNION ALL
     SELECT ticker, strike_price + 1, coalesce(expired, false), 1 FROM contracts
      WHERE NOT expired OR expired IS NULL)
    SELECT ticker, round(arg_min(strike_price, pass), 6) AS strike_price,
    arg_min(expired, pass) AS expired FROM passes GROUP BY ticker""",
)
def _(spark, d):
    rows = m.contracts(spark, d).select("ticker", "strike_price", "expired")
    gone = rows.where(F.col("expired") | F.col("expired").isNull())
    live = rows.where(~F.col("expired") | F.col("expired").isNull())
    live = live.withColumn("strike_price", F.col("strike_price") + 1)
    return universe.union_both(gone, live, "expired", "ticker")


@query(
    "set03_all_assets",
    """SELECT 'stocks' AS market, c_name AS ticker, round(c_acctbal, 6) AS balance,
    c_mktsegment AS segment FROM customer
    UNION ALL SELECT 'forex', s_name, round(s_acctbal, 6), NULL FROM supplier""",
)
def _(spark, d):
    stocks = m.table(spark, d, "customer").select(
        F.col("c_name").alias("ticker"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    forex = m.table(spark, d, "supplier").select(
        F.col("s_name").alias("ticker"), F.col("s_acctbal").alias("balance")
    )
    return universe.all_assets({"stocks": stocks, "forex": forex})


@query(
    "set04_missing",
    f"""WITH {m.TAPE}, {m.ORDER_EARNINGS} SELECT CAST(date AS VARCHAR) AS date, ticker FROM (
    SELECT ticker, date FROM order_earnings EXCEPT SELECT ticker, file_date FROM tape)""",
)
def _(spark, d):
    seen = m.tape(spark, d).withColumnRenamed("file_date", "date")
    return universe.missing(m.earnings(spark, d), seen, ["ticker", "date"])
