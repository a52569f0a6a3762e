"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import ts_to_ns
from tickloom.operators import asof, universe
from tickloom.operators import calendar as cal
from tickloom.operators import quotes as qt
from tickloom.operators import ratings as rt
from tickloom.plans import market as m
from tickloom.plans.registry import query

FIVE_MINUTES = 300_000_000_000
TEN_MINUTES = 600_000_000_000

# The session grid and the last quote in each interval, as a range join.
_GRID = """grid AS (SELECT date, unnest(range(open_ns, close_ns, {step})) AS asof_timestamp
 FROM calendar)"""
_SAMPLED = """sampled AS (SELECT q.ticker, g.asof_timestamp,
 max({{'t': sip_timestamp, 's': sequence_number, 'ap': ask_price, 'bp': bid_price}}) AS q
 FROM grid g JOIN quotes q ON q.sip_timestamp > g.asof_timestamp - {step}
  AND q.sip_timestamp <= g.asof_timestamp GROUP BY 1, 2)"""


def _sampled_sql(step: int) -> str:
    return _GRID.format(step=step) + ",\n" + _SAMPLED.format(step=step)


_SAMPLED_OUT = """SELECT ticker, CAST(asof_timestamp AS BIGINT) AS asof_timestamp,
 q.t AS sip_timestamp, q.s AS sequence_number, round(q.ap, 6) AS ask_price,
 round(q.bp, 6) AS bid_price FROM sampled"""


def _sampled(df):
    return df.select(
        "ticker", "asof_timestamp", "sip_timestamp", "sequence_number", "ask_price", "bid_price"
    )


@query(
    "join01_earnings_windows",
    f"""WITH {m.EARNINGS}, {m.TAPE_CALENDAR}, {m.WINDOWS}
    SELECT ticker, CAST(snapshot_date AS VARCHAR) AS snapshot_date FROM windows""",
)
def _(spark, d):
    return cal.earnings_windows(m.earnings(spark, d), m.tape_calendar(spark, d))


@query(
    "join02_ticker_dim",
    f"""WITH {m.TAPE} SELECT ticker, sequence_number, round(price, 6) AS price, s_name AS name,
    CASE WHEN s_acctbal > 0 THEN 'true' WHEN s_acctbal <= 0 THEN 'false' END AS active
    FROM tape LEFT JOIN supplier ON ticker = 'S' || s_suppkey""",
)
def _(spark, d):
    dim = m.table(spark, d, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("ticker"),
        F.col("s_name").alias("name"),
        (F.col("s_acctbal") > 0).cast("string").alias("active"),
    )
    rows = m.tape(spark, d).select("ticker", "sequence_number", "price")
    return universe.with_ticker_dim(rows, dim)


@query(
    "join03_asof_backward",
    """WITH e AS (SELECT user_id, epoch_us(ts) * 1000 AS ns, event_id, event_type, value
     FROM events),
    l AS (SELECT * FROM e WHERE event_type = 'purchase'),
    r AS (SELECT * FROM e WHERE event_type = 'view')
    SELECT l.user_id, l.ns, l.event_id, round(l.value, 6) AS value, r.ns AS underlying_ns,
    r.event_id AS underlying_event_id, round(r.value, 6) AS underlying_value
    FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ns >= r.ns""",
)
def _(spark, d):


    events = m.table(spark, d, "events").select(
        "user_id", ts_to_ns("ts").alias("ns"), "event_id", "value", "event_type"
    )
    left = events.where("event_type = 'purchase'").drop("event_type")
    right = events.where("event_type = 'view'").drop("event_type")
    return asof.asof_backward(
        left, right, "user_id", "ns", "ns", tie=("event_id",), prefix="underlying_"
    )


@query(
    "join03_asof_skewed_key",
    """WITH e AS (SELECT CASE WHEN event_id % 10 < 7 THEN 'hot' ELSE event_type END AS k,
     epoch_us(ts) * 1000 AS ns, event_id, event_type, value FROM events),
    r AS (SELECT * FROM e WHERE event_type IN ('view', 'error'))
    SELECT e.k, e.ns, e.event_id, r.event_id AS mark_event_id, round(r.value, 6) AS mark_value
    FROM e ASOF LEFT JOIN r ON e.k = r.k AND e.ns >= r.ns""",
)
def _(spark, d):
    """All events as left rows, most of them of one key, cut into buckets of ten minutes."""
    key = F.when(F.pmod("event_id", F.lit(10)) < 7, "hot").otherwise(F.col("event_type"))
    events = m.table(spark, d, "events").select(
        key.alias("k"), ts_to_ns("ts").alias("ns"), "event_id", "value", "event_type"
    )
    marks = events.where(F.col("event_type").isin("view", "error")).drop("event_type")
    out = asof.asof_backward(
        events, marks, "k", "ns", "ns", tie=("event_id",), prefix="mark_", bucket=600_000_000_000
    )
    return out.select("k", "ns", "event_id", "mark_event_id", "mark_value")


@query(
    "join04_sample_at",
    f"WITH {m.quotes_sql()}, {m.TICK_CALENDAR}, {_sampled_sql(FIVE_MINUTES)} {_SAMPLED_OUT}",
)
def _(spark, d):
    sampled = qt.sample_at(m.quotes(spark, d), m.tick_calendar(spark, d), FIVE_MINUTES)
    return _sampled(sampled)


@query(
    "join05_ticks_in_windows",
    f"""WITH {m.WIDE_TICKS}, {m.TICK_EARNINGS}, {m.TICK_CALENDAR}, {m.WINDOWS}
    SELECT t.ticker, CAST(w.snapshot_date AS VARCHAR) AS snapshot_date, t.sip_timestamp,
    t.sequence_number, round(t.price, 6) AS price
    FROM ticks t JOIN windows w ON w.ticker = t.ticker
     AND t.sip_timestamp >= epoch_us(CAST(w.snapshot_date AS TIMESTAMP)) * 1000
     AND t.sip_timestamp <= (epoch_us(CAST(w.snapshot_date AS TIMESTAMP)) + 86400000000) * 1000""",
)
def _(spark, d):
    windows = cal.earnings_windows(m.tick_earnings(spark, d), m.tick_calendar(spark, d))
    rows = qt.ticks_in_windows(m.ticks(spark, d, wide=True), windows)
    return rows.select("ticker", "snapshot_date", "sip_timestamp", "sequence_number", "price")


@query(
    "join06_bars_in_windows",
    f"""WITH {m.quotes_sql('wide')}, {m.TICK_EARNINGS}, {m.TICK_CALENDAR}, {m.WINDOWS},
    {_sampled_sql(TEN_MINUTES)} {_SAMPLED_OUT}
    WHERE (ticker, make_date(1970, 1, 1) + CAST(asof_timestamp // 86400000000000 AS INTEGER))
     IN (SELECT (ticker, snapshot_date) FROM windows)""",
)
def _(spark, d):
    calendar = m.tick_calendar(spark, d)
    windows = cal.earnings_windows(m.tick_earnings(spark, d), calendar)
    bars = qt.bars_in_windows(m.quotes(spark, d, "wide"), windows, calendar, TEN_MINUTES)
    return _sampled(bars)


@query(
    "join07_expand_contracts",
    f"""WITH {m.CONTRACTS}, u AS (SELECT 'S' || s_suppkey AS underlying_ticker FROM supplier)
    SELECT underlying_ticker, c.ticker, CAST(c.expired AS VARCHAR) AS expired,
    round(c.strike_price, 6) AS strike_price FROM u JOIN contracts c USING (underlying_ticker)""",
)
def _(spark, d):
    underlyings = m.table(spark, d, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("underlying_ticker")
    )
    out = universe.expand_contracts(underlyings, m.contracts(spark, d))
    return out.select(
        "underlying_ticker", "ticker", F.col("expired").cast("string"), "strike_price"
    )


@query(
    "join08_tickers_on",
    f"""WITH {m.EARNINGS}, {m.TAPE_CALENDAR}, {m.WINDOWS}
    SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date,
    string_agg(ticker, ',' ORDER BY ticker) AS tickers FROM windows GROUP BY snapshot_date""",
)
def _(spark, d):
    windows = cal.earnings_windows(m.earnings(spark, d), m.tape_calendar(spark, d))
    listed = cal.listed_tickers(cal.tickers_on(windows))
    return listed.withColumn("tickers", F.array_join("tickers", ","))


# Currency codes by event type and by order priority, so that most orders find a rate.
_CURRENCIES = {"click": "EUR", "view": "GBP", "purchase": "JPY", "signup": "CHF", "error": "XXX"}
_CODE_SQL = "CASE event_type " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in _CURRENCIES.items()
) + " END"


@query(
    "join09_convert",
    f"""WITH {m.quotes_sql()}, rates AS (SELECT ticker AS event_type,
     max({{'t': sip_timestamp, 's': sequence_number, 'a': ask_price, 'b': bid_price}}) AS q
     FROM quotes GROUP BY ticker),
    pairs AS (SELECT {_CODE_SQL} AS code, q FROM rates)
    SELECT o_orderkey, currency AS "from", 'USD' AS "to",
    round(o_totalprice, 6) AS initial_amount, round(q.a, 6) AS ask, round(q.b, 6) AS bid,
    q.t AS last_timestamp, round(o_totalprice * ((q.a + q.b) / 2), 6) AS converted
    FROM (SELECT *, CASE o_orderpriority[1] WHEN '1' THEN 'EUR' WHEN '2' THEN 'GBP'
     WHEN '3' THEN 'JPY' WHEN '4' THEN 'CHF' ELSE 'AUD' END AS currency FROM orders)
    LEFT JOIN pairs ON code = currency""",
)
def _(spark, d):
    names = F.create_map(*[F.lit(x) for pair in _CURRENCIES.items() for x in pair])
    fx = m.quotes(spark, d).withColumn(
        "ticker", F.concat(F.lit("C:"), names[F.col("ticker")], F.lit("USD"))
    )
    first = F.substring("o_orderpriority", 1, 1)
    code = (
        F.when(first == "1", "EUR")
        .when(first == "2", "GBP")
        .when(first == "3", "JPY")
        .when(first == "4", "CHF")
        .otherwise("AUD")
    )
    amounts = m.table(spark, d, "orders").select(
        "o_orderkey",
        code.alias("from"),
        F.lit("USD").alias("to"),
        F.col("o_totalprice").alias("initial_amount"),
    )
    out = rt.convert(amounts, fx)
    return out.select(
        "o_orderkey",
        "from",
        "to",
        "initial_amount",
        "last.ask",
        "last.bid",
        F.col("last.timestamp").alias("last_timestamp"),
        "converted",
    )


# -- grids -------------------------------------------------------------------
@query(
    "fun01_session_grid",
    f"""WITH {m.TAPE_CALENDAR}, {_GRID.format(step=1_800_000_000_000)}
    SELECT CAST(date AS VARCHAR) AS date, CAST(asof_timestamp AS BIGINT) AS asof_timestamp
    FROM grid WHERE asof_timestamp >= 820454400000000000
     AND asof_timestamp < 915148800000000000""",
)
def _(spark, d):
    return cal.session_grid(
        m.tape_calendar(spark, d), 1_800_000_000_000, 820454400000000000, 915148800000000000
    )


@query(
    "fun01_half_days",
    f"""WITH {m.TICK_CALENDAR}, half AS (SELECT date, open_ns,
     CASE WHEN day(date) % 5 = 0 THEN open_ns + {7 * m.HOUR // 2} ELSE close_ns END AS close_ns
     FROM calendar)
    SELECT CAST(date AS VARCHAR) AS date,
    CAST(unnest(generate_series(open_ns, close_ns - 1, {m.HOUR})) AS BIGINT) AS asof_timestamp
    FROM half""",
)
def _(spark, d):
    """Every fifth day of a month closes at 13:00."""
    usual = m.tick_calendar(spark, d)
    early = usual.where(F.pmod(F.dayofmonth("date"), F.lit(5)) == 0).select(
        "date", F.lit("13:00:00").alias("closes")
    )
    days = cal.with_session_hours(usual.select("date"), exceptions=early)
    return cal.session_grid(days, m.HOUR).select("date", "asof_timestamp")


@query(
    "join04_sample_fixed",
    f"""WITH {m.quotes_sql()}, g AS (SELECT CAST(unnest(generate_series(1704844800000000000,
     1705104000000000000 - 1, {m.HOUR})) AS BIGINT) AS t),
    s AS (SELECT ticker, t AS asof_timestamp, max({{'t': sip_timestamp, 's': sequence_number}}) AS q
     FROM quotes JOIN g ON sip_timestamp > t - {m.HOUR} AND sip_timestamp <= t GROUP BY 1, 2)
    SELECT ticker, asof_timestamp, q.t AS sip_timestamp, q.s AS sequence_number FROM s""",
)
def _(spark, d):
    out = qt.sample_fixed(m.quotes(spark, d), 1_704_844_800_000_000_000, 1_705_104_000_000_000_000, m.HOUR)
    return out.select("ticker", "asof_timestamp", "sip_timestamp", "sequence_number")


@query(
    "fun02_fixed_grid",
    f"""WITH {m.WIDE_TICKS}, r AS (SELECT ticker, min(sip_timestamp) AS start_ns,
     max(sip_timestamp) AS end_ns FROM ticks GROUP BY ticker)
    SELECT ticker, CAST(unnest(range(start_ns, end_ns, 3600000000000)) AS BIGINT)
     AS asof_timestamp FROM r""",
)
def _(spark, d):
    ranges = (
        m.ticks(spark, d, wide=True)
        .groupBy("ticker")
        .agg(F.min("sip_timestamp").alias("start_ns"), F.max("sip_timestamp").alias("end_ns"))
    )
    return cal.fixed_grid(ranges, m.HOUR).select("ticker", "asof_timestamp")


@query(
    "fun03_date_spine",
    f"""WITH {m.TAPE}, r AS (SELECT ticker, min(file_date) AS a, max(file_date) AS b
     FROM tape GROUP BY ticker)
    SELECT ticker, CAST(CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS VARCHAR)
     AS date FROM r""",
)
def _(spark, d):
    ranges = (
        m.tape(spark, d)
        .groupBy("ticker")
        .agg(F.min("file_date").alias("start"), F.max("file_date").alias("end"))
    )
    return cal.date_spine(ranges)


@query(
    "fun04_sessions",
    f"""WITH {m.TAPE_CALENDAR} SELECT CAST(date AS VARCHAR) AS date,
    CAST(open_ns AS BIGINT) AS open_ns, CAST(close_ns AS BIGINT) AS close_ns FROM calendar
    WHERE date BETWEEN DATE '1996-01-01' AND DATE '1999-01-01'""",
)
def _(spark, d):
    return cal.sessions(m.tape_calendar(spark, d), 820454400000000000, 915148800000000000)


