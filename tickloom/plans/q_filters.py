"""Filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import is_us_ticker
from tickloom.functions import ns_to_date
from tickloom.operators import calendar as cal
from tickloom.operators import filters as fl
from tickloom.plans import market as m
from tickloom.plans.registry import query
from tickloom.sources import landed
from tickloom.sources.flat_files import prune_dates
from tickloom.specs import TABLES


@query(
    "flt01_select_tickers",
    f"""WITH {m.TICKS} SELECT ticker, sequence_number, round(price, 6) AS price FROM ticks
    WHERE ticker IN ('click', 'purchase')""",
)
def _(spark, d):
    config = {
        "forex_tickers": {"select_tickers": "*"},
        "stock_tickers": {"select_tickers": " click, purchase ,"},
    }
    chosen = fl.configured_tickers(config, ("forex_tickers",), "stock")
    rows = fl.select_tickers(m.ticks(spark, d), chosen)
    return rows.select("ticker", "sequence_number", "price")


@query(
    "flt02_select_futures",
    """SELECT p_partkey, p_brand AS product_code, p_type AS type FROM part
    WHERE p_brand IN ('Brand#3', 'Brand#7', 'Brand#17') AND p_type IN ('ECONOMY', 'STANDARD')""",
)
def _(spark, d):
    parts = m.table(spark, d, "part").select(
        "p_partkey", F.col("p_brand").alias("product_code"), F.col("p_type").alias("type")
    )
    return fl.select_futures(parts, "Brand#3, Brand#7,Brand#17", ["ECONOMY", "STANDARD"])


@query(
    "flt03_us_tickers",
    f"""WITH {m.ORDER_EARNINGS} SELECT ticker, CAST(date AS VARCHAR) AS date, type
    FROM order_earnings WHERE ticker NOT LIKE '%.%'""",
)
def _(spark, d):
    orders = m.order_earnings(spark, d).select("ticker", "date", "type")
    return orders.where(is_us_ticker("ticker"))


@query(
    "flt04_prune_dates",
    f"""WITH {m.TAPE} SELECT CAST(file_date AS VARCHAR) AS file_date, ticker, sequence_number
    FROM tape WHERE file_date >= DATE '1997-03-01' AND file_date <= DATE '1999-02-28'""",
)
def _(spark, d):
    rows = m.tape(spark, d).select("file_date", "ticker", "sequence_number")
    return prune_dates(rows, start="1996-01-01", end="1999-02-28", bookmark="1997-03-01")


@query(
    "flt05_between_ts",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS filing_date FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-02-01' AND o_orderdate < TIMESTAMP '1998-05-01'""",
)
def _(spark, d):
    rows = m.table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("filing_date")
    )
    params = {"filing_date.gte": "1996-02-01", "filing_date__lt": "1998-05-01"}
    return fl.apply_params(rows, params).withColumn("filing_date", F.to_date("filing_date"))


@query(
    "flt06_day_ns_range",
    f"""WITH {m.TICKS}, days AS (SELECT DISTINCT file_date FROM ticks),
    planted AS (SELECT ticker, sip_timestamp FROM ticks UNION ALL
     SELECT ticker, epoch_us(CAST(file_date AS TIMESTAMP)) * 1000 + 86400000000000 + off
     FROM ticks, (VALUES (-1), (0), (1)) AS o(off) WHERE sequence_number % 20 = 0)
    SELECT CAST(d.file_date AS VARCHAR) AS snapshot_date, t.ticker, count(*) AS records,
    min(t.sip_timestamp) AS first_ns, max(t.sip_timestamp) AS last_ns
    FROM planted t JOIN days d ON t.sip_timestamp >= epoch_us(CAST(d.file_date AS TIMESTAMP)) * 1000
     AND t.sip_timestamp <= (epoch_us(CAST(d.file_date AS TIMESTAMP)) + 86400000000) * 1000
    GROUP BY 1, 2""",
)
def _(spark, d):
    # Ticks at and beside midnight: the one at midnight is in both of its days.
    ticks = m.ticks(spark, d)
    ends = fl.day_ns_range(ticks.where(F.col("sequence_number") % 20 == 0), "file_date")
    around = F.array(*[F.col("end_ns") + n for n in (-1, 0, 1)])
    planted = ends.select("ticker", F.explode(around).alias("sip_timestamp"))
    rows = ticks.select("ticker", "sip_timestamp").unionByName(planted)
    own = ns_to_date("sip_timestamp")
    rows = rows.withColumn("snapshot_date", F.explode(F.array(own, F.date_sub(own, 1))))
    days = ticks.select(F.col("file_date").cast("date").alias("snapshot_date")).distinct()
    held = rows.where(fl.in_day(F.col("sip_timestamp"), F.col("snapshot_date"))).join(
        days, "snapshot_date", "left_semi"
    )
    return held.groupBy(F.col("snapshot_date").cast("string").alias("snapshot_date"), "ticker").agg(
        F.count(F.lit(1)).alias("records"),
        F.min("sip_timestamp").alias("first_ns"),
        F.max("sip_timestamp").alias("last_ns"),
    )


@query(
    "flt07_filter_earnings",
    f"""WITH {m.TAPE}, {m.EARNINGS}, {m.TAPE_CALENDAR}, {m.WINDOWS}
    SELECT CAST(file_date AS VARCHAR) AS file_date, ticker, sequence_number,
    round(price, 6) AS price FROM tape
    WHERE (ticker, file_date) IN (SELECT (ticker, snapshot_date) FROM windows)""",
)
def _(spark, d):
    windows = cal.earnings_windows(m.earnings(spark, d), m.tape_calendar(spark, d))
    rows = m.tape(spark, d).select("file_date", "ticker", "sequence_number", "price")
    return fl.filter_earnings(rows, windows)


@query(
    "flt08_filter_option_earnings",
    f"""WITH {m.quotes_sql('option')}, {m.TICK_CALENDAR}, earnings AS (
     SELECT DISTINCT CASE s_nationkey % 5 WHEN 0 THEN 'CLICK' WHEN 1 THEN 'VIEW'
      WHEN 2 THEN 'PURCHASE' WHEN 3 THEN 'SIGNUP' ELSE 'NONE' END AS ticker,
      DATE '2024-01-01' + s_nationkey AS date FROM supplier), {m.WINDOWS}
    SELECT CAST(file_date AS VARCHAR) AS file_date, ticker, sequence_number FROM quotes
    WHERE (regexp_extract(ticker, '^O:([A-Z]+)', 1), file_date)
     IN (SELECT (ticker, snapshot_date) FROM windows)""",
)
def _(spark, d):
    n = F.col("s_nationkey") % 5
    earnings = m.table(spark, d, "supplier").select(
        F.when(n == 0, "CLICK")
        .when(n == 1, "VIEW")
        .when(n == 2, "PURCHASE")
        .when(n == 3, "SIGNUP")
        .otherwise("NONE")
        .alias("ticker"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("s_nationkey")).alias("date"),
    )
    windows = cal.earnings_windows(earnings.distinct(), m.tick_calendar(spark, d))
    rows = m.quotes(spark, d, "option").select("file_date", "ticker", "sequence_number")
    return fl.filter_option_earnings(rows, windows)


@query(
    "flt09_schema_drift",
    """SELECT 'missing_in_record' AS side, unnest(['vwap', 'decimal_volume', 'source_feed',
     'active', 'timestamp']) AS field, (SELECT count(*) FROM orders) AS records
    UNION ALL
    SELECT 'missing_in_schema', 'o_orderkey', (SELECT count(*) FROM orders)
    UNION ALL
    SELECT 'missing_in_record', 'otc', count(*) FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL
    SELECT 'missing_in_schema', 'note', count(*) FROM orders WHERE o_orderstatus = 'O'""",
)
def _(spark, d):
    named = ("ticker", "open", "high", "low", "close", "volume", "transactions")
    status = F.col("o_orderstatus")
    pages = m.table(spark, d, "orders").select(
        F.to_json(
            F.struct(
                "o_orderkey",
                *[F.col("o_custkey").alias(n) for n in named],
                F.when(status == "F", True).alias("otc"),
                F.when(status == "O", "x").alias("note"),
            )
        ).alias("payload")
    )
    records = landed.explode_results(pages)
    return fl.record_drift(records, TABLES["stock_bars_1_day"].schema)


@query(
    "flt10_live_contracts",
    f"""WITH {m.CONTRACTS}, {m.EARNINGS}, {m.TAPE_CALENDAR}, {m.WINDOWS},
    first AS (SELECT ticker, min(snapshot_date) AS first_date FROM windows GROUP BY ticker)
    SELECT c.ticker, c.underlying_ticker, CAST(c.expiration_date AS VARCHAR) AS expiration_date
    FROM contracts c JOIN first f ON f.ticker = c.underlying_ticker
    WHERE c.expiration_date IS NULL OR c.expiration_date >= f.first_date""",
)
def _(spark, d):
    windows = cal.earnings_windows(m.earnings(spark, d), m.tape_calendar(spark, d))
    live = fl.live_contracts(m.contracts(spark, d), cal.first_window(windows))
    return live.select("ticker", "underlying_ticker", "expiration_date")
