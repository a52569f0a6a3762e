"""Window functions, sorting and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions.scalars import DAY_NS
from tickloom.operators import bars as br
from tickloom.operators import calendar as cal
from tickloom.operators import indicators as ind
from tickloom.operators import quotes as qt
from tickloom.operators import universe
from tickloom.plans import market as m
from tickloom.plans.registry import query
from tickloom.sources.sinks import order_output

_SERIES = f"""{m.DAY_BARS}, series AS (SELECT ticker, window_start, close,
 row_number() OVER (PARTITION BY ticker ORDER BY window_start) AS rn FROM bars)"""


def _ema_sql(name: str, source: str, column: str, window: int) -> str:
    alpha = f"(2.0::DOUBLE / {window + 1})"
    return f"""{name} AS (
 SELECT ticker, rn, window_start, {column} AS y FROM {source} WHERE rn = 1
 UNION ALL
 SELECT s.ticker, s.rn, s.window_start, {alpha} * s.{column} + (1 - {alpha}) * p.y
 FROM {name} p JOIN {source} s ON s.ticker = p.ticker AND s.rn = p.rn + 1)"""


@query(
    "win01_sma",
    f"""WITH {_SERIES}, w AS (SELECT ticker, window_start, rn, avg(close) OVER
     (PARTITION BY ticker ORDER BY window_start ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS value
     FROM series)
    SELECT ticker, CAST(window_start AS BIGINT) AS window_start, round(value, 6) AS value,
    'close_day_10' AS series_window_timespan FROM w WHERE rn >= 10""",
)
def _(spark, d):
    values = ind.sma(m.day_bars(spark, d), 10, interval_ns=DAY_NS)
    out = ind.indicator_table(values, "stock_sma", "day", 10)
    return out.select(
        "ticker",
        (F.unix_micros("timestamp") * 1000).alias("window_start"),
        "value",
        "series_window_timespan",
    )


def _closes(spark, d):
    """What the recurrences read, so that all uses of their shuffle are as narrow."""
    return m.day_bars(spark, d).select("ticker", "window_start", "close")


def _places(df, *values: str, places: int = 4):
    """Rounded values; of prices near 100,000 a double's recurrence has 4 sure decimals."""
    return df.select("ticker", "window_start", *[F.round(v, places).alias(v) for v in values])


@query(
    "win02_ema",
    f"""WITH RECURSIVE {_SERIES}, {_ema_sql('e', 'series', 'close', 10)}
    SELECT ticker, CAST(window_start AS BIGINT) AS window_start, round(y, 4) AS value FROM e""",
)
def _(spark, d):
    return _places(ind.ema(_closes(spark, d), 10, interval_ns=DAY_NS), "value")


@query(
    "win03_macd",
    f"""WITH RECURSIVE {_SERIES}, {_ema_sql('a', 'series', 'close', 12)},
    {_ema_sql('b', 'series', 'close', 26)},
    diff AS (SELECT a.ticker, a.rn, a.window_start, a.y - b.y AS macd
     FROM a JOIN b ON a.ticker = b.ticker AND a.rn = b.rn),
    {_ema_sql('g', 'diff', 'macd', 9)}
    SELECT g.ticker, CAST(g.window_start AS BIGINT) AS window_start, round(macd, 4) AS value,
    round(g.y, 4) AS signal, round(macd - g.y, 4) AS histogram
    FROM g JOIN diff USING (ticker, rn)""",
)
def _(spark, d):
    return _places(ind.macd(_closes(spark, d), interval_ns=DAY_NS), "value", "signal", "histogram")


_RSI = f"""WITH RECURSIVE {_SERIES}, ch AS (SELECT ticker, rn - 1 AS rn, window_start,
     greatest(close - lag(close) OVER w, 0) AS g, greatest(lag(close) OVER w - close, 0) AS l
     FROM series WINDOW w AS (PARTITION BY ticker ORDER BY rn)),
    seed AS (SELECT ticker, avg(g) AS g, avg(l) AS l FROM ch WHERE rn BETWEEN 1 AND 18
     GROUP BY ticker HAVING count(*) = 18),
    r AS (SELECT ch.ticker, ch.rn, ch.window_start, seed.g, seed.l FROM ch
      JOIN seed USING (ticker) WHERE ch.rn = 18
     UNION ALL
     SELECT c.ticker, c.rn, c.window_start, (r.g * 17 + c.g) / 18, (r.l * 17 + c.l) / 18
     FROM r JOIN ch c ON c.ticker = r.ticker AND c.rn = r.rn + 1)
    SELECT ticker, CAST(window_start AS BIGINT) AS window_start,
    round(CASE WHEN l = 0 THEN 100 ELSE 100 - 100 / (1 + g / l) END, 6) AS value FROM r"""


@query("win04_rsi", _RSI)
def _(spark, d):
    return _places(ind.rsi(_closes(spark, d), 18, interval_ns=DAY_NS), "value", places=6)


@query("win04_rsi_blocks", _RSI)
def _(spark, d):
    # Blocks of 7 bars: the seed of 18 changes spans three of them.
    out = ind.rsi(_closes(spark, d), 18, interval_ns=DAY_NS, block=7)
    return _places(out, "value", places=6)


# Prices near 100, where a double's recurrence is sure to six decimals, in blocks of a few bars.
_SMALL = _SERIES.replace("SELECT ticker, window_start, close,", "SELECT ticker, window_start, close / 1000 AS close,")


def _small(spark, d):
    return _closes(spark, d).withColumn("close", F.col("close") / 1000)


@query(
    "win02_ema_blocks",
    f"""WITH RECURSIVE {_SMALL}, {_ema_sql('e', 'series', 'close', 10)}
    SELECT ticker, CAST(window_start AS BIGINT) AS window_start, round(y, 6) AS value FROM e""",
)
def _(spark, d):
    return _places(ind.ema(_small(spark, d), 10, interval_ns=DAY_NS, block=9), "value", places=6)


@query(
    "win03_macd_blocks",
    f"""WITH RECURSIVE {_SMALL}, {_ema_sql('a', 'series', 'close', 12)},
    {_ema_sql('b', 'series', 'close', 26)},
    diff AS (SELECT a.ticker, a.rn, a.window_start, a.y - b.y AS macd
     FROM a JOIN b ON a.ticker = b.ticker AND a.rn = b.rn),
    {_ema_sql('g', 'diff', 'macd', 9)}
    SELECT g.ticker, CAST(g.window_start AS BIGINT) AS window_start, round(macd, 6) AS value,
    round(g.y, 6) AS signal, round(macd - g.y, 6) AS histogram
    FROM g JOIN diff USING (ticker, rn)""",
)
def _(spark, d):
    out = ind.macd(_small(spark, d), interval_ns=DAY_NS, block=11)
    return _places(out, "value", "signal", "histogram", places=6)


_CHANGES = f"""{m.TICK_DAY_BARS}, changes AS (SELECT ticker, window_start, close, volume,
 lag(close) OVER (PARTITION BY ticker ORDER BY window_start) AS before FROM bars)"""


@query(
    "win05_top_movers",
    f"""WITH {_CHANGES}, pct AS (SELECT ticker, window_start, volume,
     round(100 * (close - before) / before, 6) AS pct FROM changes
     WHERE before IS NOT NULL AND before <> 0 AND volume >= 100),
    g AS (SELECT 'gainers' AS direction, *, row_number() OVER (PARTITION BY window_start
      ORDER BY pct DESC, ticker) AS rank FROM pct),
    l AS (SELECT 'losers' AS direction, *, row_number() OVER (PARTITION BY window_start
      ORDER BY pct, ticker) AS rank FROM pct)
    SELECT direction, CAST(window_start AS BIGINT) AS window_start, rank, ticker,
    pct AS todays_change_percent FROM (SELECT * FROM g UNION ALL SELECT * FROM l)
    WHERE rank <= 20""",
)
def _(spark, d):
    changes = ind.with_change(m.tick_day_bars(spark, d), interval_ns=DAY_NS).withColumn(
        "todays_change_percent", F.round("todays_change_percent", 6)
    )
    top = br.top_movers(changes, "both", 20, min_volume=100, by=("window_start",))
    return top.select(
        "direction", "window_start", F.col("rank").cast("bigint"), "ticker", "todays_change_percent"
    )


@query(
    "win05_top_gainers",
    f"""WITH {_CHANGES} SELECT ticker, CAST(window_start AS BIGINT) AS window_start,
    round(100 * (close - before) / before, 6) AS todays_change_percent FROM changes
    WHERE before IS NOT NULL AND before <> 0
    ORDER BY todays_change_percent DESC, ticker, window_start LIMIT 20""",
)
def _(spark, d):
    changes = ind.with_change(m.tick_day_bars(spark, d), interval_ns=DAY_NS).withColumn(
        "todays_change_percent", F.round("todays_change_percent", 6)
    )
    top = br.top_movers(changes, "gainers", min_volume=None)
    return top.select("ticker", "window_start", "todays_change_percent")


@query(
    "win06_dedupe_first",
    """SELECT x.o AS l_orderkey, l_partkey, l_suppkey, x.n AS l_linenumber,
    round(x.p, 6) AS price FROM (SELECT l_suppkey, l_partkey,
     min({'o': l_orderkey, 'n': l_linenumber, 'p': l_extendedprice}) AS x
     FROM lineitem GROUP BY l_suppkey, l_partkey)""",
)
def _(spark, d):
    rows = m.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("price"),
    )
    keys = ["l_suppkey", "l_partkey"]
    return universe.dedupe(rows, keys, ["l_orderkey", "l_linenumber", "price"], keep="first")


@query(
    "win06_dedupe_context",
    """SELECT l_suppkey, l_returnflag, max(l_orderkey) AS last_order FROM lineitem
    GROUP BY l_suppkey, l_returnflag""",
)
def _(spark, d):
    # The same context written with its keys in two orders.
    supplier = F.col("l_suppkey").cast("string")
    one = F.create_map(F.lit("supplier"), supplier, F.lit("flag"), F.col("l_returnflag"))
    two = F.create_map(F.lit("flag"), F.col("l_returnflag"), F.lit("supplier"), supplier)
    rows = m.table(spark, d, "lineitem").select(
        F.when(F.col("l_linestatus") == "O", one).otherwise(two).alias("context"),
        F.col("l_orderkey").alias("last_order"),
    )
    out = universe.dedupe_context(rows, "context", ["last_order"])
    return out.select(
        F.col("context")["supplier"].cast("bigint").alias("l_suppkey"),
        F.col("context")["flag"].alias("l_returnflag"),
        "last_order",
    )


@query(
    "win07_neighbours",
    f"""WITH {m.TAPE_CALENDAR}, spine AS (SELECT CAST(unnest(generate_series(min(date), max(date),
     INTERVAL 1 DAY)) AS DATE) AS date FROM calendar)
    SELECT CAST(s.date AS VARCHAR) AS date,
    EXISTS (SELECT 1 FROM calendar c WHERE c.date = s.date) AS is_trading,
    CAST((SELECT max(c.date) FROM calendar c WHERE c.date < s.date) AS VARCHAR) AS prev_date,
    CAST((SELECT min(c.date) FROM calendar c WHERE c.date > s.date) AS VARCHAR) AS next_date
    FROM spine s""",
)
def _(spark, d):
    return cal.neighbours(m.tape_calendar(spark, d))


@query(
    "win08_with_change",
    f"""WITH {m.DAY_BARS}, c AS (SELECT ticker, window_start, close, lag(close) OVER
     (PARTITION BY ticker ORDER BY window_start) AS before FROM bars)
    SELECT ticker, CAST(window_start AS BIGINT) AS window_start,
    round(close - before, 6) AS todays_change,
    round(100 * (close - before) / before, 6) AS todays_change_percent FROM c""",
)
def _(spark, d):
    out = ind.with_change(m.day_bars(spark, d), interval_ns=DAY_NS)
    return out.select("ticker", "window_start", "todays_change", "todays_change_percent")


@query(
    "ord01_order_output",
    """SELECT p_partkey, nullif(p_brand, 'Brand#2') AS brand FROM part
    ORDER BY coalesce(brand, ''), p_partkey""",
)
def _(spark, d):
    rows = m.table(spark, d, "part").select(
        "p_partkey", F.nullif("p_brand", F.lit("Brand#2")).alias("brand")
    )
    return order_output(rows, "brand", "p_partkey")


@query(
    "ord02_latest_before",
    f"""WITH {m.quotes_sql()} SELECT ticker, sip_timestamp, sequence_number,
    round(bid_price, 6) AS bid_price FROM quotes
    WHERE sip_timestamp <= 1705514400000000000 AND sip_timestamp > 1705510800000000000
    ORDER BY sip_timestamp DESC, sequence_number DESC LIMIT 1""",
)
def _(spark, d):
    out = qt.latest_before(m.quotes(spark, d), 1_705_514_400_000_000_000, m.HOUR)
    return out.select("ticker", "sip_timestamp", "sequence_number", "bid_price")


@query(
    "ord03_top_k_per_group",
    f"""WITH {_CHANGES}, pct AS (SELECT ticker, window_start, close, volume,
     round(100 * (close - before) / before, 6) AS pct FROM changes
     WHERE before IS NOT NULL AND before <> 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY pct, ticker) AS rank
     FROM pct)
    SELECT CAST(window_start AS BIGINT) AS window_start, rank, ticker,
    pct AS todays_change_percent FROM r WHERE rank <= 5""",
)
def _(spark, d):
    changes = ind.with_change(m.tick_day_bars(spark, d), interval_ns=DAY_NS).withColumn(
        "todays_change_percent", F.round("todays_change_percent", 6)
    )
    top = br.top_movers(changes, "losers", 5, min_volume=None, by=("window_start",))
    return top.select(
        "window_start", F.col("rank").cast("bigint"), "ticker", "todays_change_percent"
    )
