"""The given tables seen as market tables, once as DataFrames and once as SQL.

Each view is written twice, in Spark and as DuckDB SQL text, from the same
definition: ``events`` are trades and quotes, ``lineitem`` is a daily trade tape,
``orders`` and ``supplier`` give earnings dates, ``part`` the option contracts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import scalars as sc
from tickloom.operators.bars import ohlcv_bars
from tickloom.operators.calendar import with_session_hours

HOUR = 3_600_000_000_000
DAY = 86_400_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _event_columns(spark, d) -> DataFrame:
    return table(spark, d, "events").select(
        "event_type",
        "user_id",
        sc.ts_to_ns("ts").alias("sip_timestamp"),
        F.col("event_id").alias("sequence_number"),
        "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.col("ts").cast("date").alias("file_date"),
    )


# -- trades ------------------------------------------------------------------
def ticks(spark, d, wide: bool = False) -> DataFrame:
    """Trades; ``wide`` has one ticker per user instead of one per event type."""
    ticker = F.concat(F.lit("U"), "user_id") if wide else F.col("event_type")
    return _event_columns(spark, d).select(
        ticker.alias("ticker"),
        "sip_timestamp",
        "sequence_number",
        F.col("value").alias("price"),
        (F.col("k") + 1).alias("size"),
        "file_date",
    )


_EVENT_SQL = """(SELECT event_type, user_id, epoch_us(ts) * 1000 AS sip_timestamp,
 event_id AS sequence_number, value,
 CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, CAST(ts AS DATE) AS file_date
 FROM events)"""

TICKS = f"""ticks AS (SELECT event_type AS ticker, sip_timestamp, sequence_number,
 value AS price, k + 1 AS size, file_date FROM {_EVENT_SQL})"""

WIDE_TICKS = f"""ticks AS (SELECT 'U' || user_id AS ticker, sip_timestamp, sequence_number,
 value AS price, k + 1 AS size, file_date FROM {_EVENT_SQL})"""


# -- quotes ------------------------------------------------------------------
def quotes(spark, d, kind: str = "stock") -> DataFrame:
    """Quotes by event type; option tickers wrap it, wide ones are per user."""
    ticker = {
        "stock": F.col("event_type"),
        "wide": F.concat(F.lit("U"), "user_id"),
        "option": F.concat(F.lit("O:"), F.upper("event_type"), F.lit("240119C00100000")),
    }[kind]
    return _event_columns(spark, d).select(
        ticker.alias("ticker"),
        "sip_timestamp",
        "sequence_number",
        (F.col("user_id") % 20).alias("ask_exchange"),
        (F.col("value") + 0.05).alias("ask_price"),
        (F.col("k") + 1).cast("double").alias("ask_size"),
        (F.col("user_id") % 20).alias("bid_exchange"),
        F.col("value").alias("bid_price"),
        (F.col("k") + 2).cast("double").alias("bid_size"),
        "file_date",
    )


def quotes_sql(kind: str = "stock") -> str:
    ticker = {
        "stock": "event_type",
        "wide": "'U' || user_id",
        "option": "'O:' || upper(event_type) || '240119C00100000'",
    }[kind]
    return f"""quotes AS (SELECT {ticker} AS ticker, sip_timestamp, sequence_number,
 user_id % 20 AS ask_exchange, value + 0.05 AS ask_price, CAST(k + 1 AS DOUBLE) AS ask_size,
 user_id % 20 AS bid_exchange, value AS bid_price, CAST(k + 2 AS DOUBLE) AS bid_size, file_date
 FROM {_EVENT_SQL})"""


QUOTE_FIELDS = (
    "sip_timestamp",
    "sequence_number",
    "ask_exchange",
    "ask_price",
    "ask_size",
    "bid_exchange",
    "bid_price",
    "bid_size",
)


# -- daily tape --------------------------------------------------------------
def tape(spark, d) -> DataFrame:
    """``lineitem`` as trades: one ticker per supplier."""
    return table(spark, d, "lineitem").select(
        F.concat(F.lit("S"), "l_suppkey").alias("ticker"),
        sc.ts_to_ns("l_shipdate").alias("sip_timestamp"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sequence_number"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("size"),
        F.col("l_shipdate").cast("date").alias("file_date"),
    )


TAPE = """tape AS (SELECT 'S' || l_suppkey AS ticker, epoch_us(l_shipdate) * 1000 AS sip_timestamp,
 l_orderkey * 10 + l_linenumber AS sequence_number, l_extendedprice AS price, l_quantity AS size,
 CAST(l_shipdate AS DATE) AS file_date FROM lineitem)"""


def bars_sql(source: str, start: str, by: str = "ticker", name: str = "bars") -> str:
    return f"""{name} AS (SELECT {by}, {start} AS window_start,
 min({{'t': sip_timestamp, 's': sequence_number, 'p': price}}).p AS open,
 max(price) AS high, min(price) AS low,
 max({{'t': sip_timestamp, 's': sequence_number, 'p': price}}).p AS close,
 sum(size) AS volume, sum(price * size) / sum(size) AS vwap, count(*) AS transactions
 FROM {source} GROUP BY {by}, {start})"""


DAY_START = "(sip_timestamp - sip_timestamp % 86400000000000)"


def day_bars(spark, d) -> DataFrame:
    """Daily bars of the tape: many days per ticker."""
    return ohlcv_bars(tape(spark, d), 1, "day")


DAY_BARS = TAPE + ",\n" + bars_sql("tape", DAY_START)


def tick_day_bars(spark, d) -> DataFrame:
    """Daily bars of the wide trades: many tickers, one month."""
    return ohlcv_bars(ticks(spark, d, wide=True), 1, "day")


TICK_DAY_BARS = WIDE_TICKS + ",\n" + bars_sql("ticks", DAY_START)


# -- calendars ---------------------------------------------------------------
def _weekdays(days: DataFrame) -> DataFrame:
    """Weekdays without three fixed holidays, with New York session hours."""
    trading = days.distinct().where(
        ~F.dayofweek("date").isin(1, 7)
        & ~F.date_format("date", "MM-dd").isin("01-01", "07-04", "12-25")
    )
    return with_session_hours(trading)


def _calendar_sql(days: str) -> str:
    def at(clock: str) -> str:
        return (
            f"epoch_us(timezone('America/New_York', date + INTERVAL '{clock}')) * 1000"
        )

    return f"""calendar AS (SELECT date, {at('9 hours 30 minutes')} AS open_ns,
 {at('16 hours')} AS close_ns FROM (SELECT DISTINCT {days})
 WHERE isodow(date) < 6 AND strftime(date, '%m-%d') NOT IN ('01-01', '07-04', '12-25'))"""


def tape_calendar(spark, d) -> DataFrame:
    days = table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("date"))
    return _weekdays(days)


TAPE_CALENDAR = _calendar_sql("CAST(l_shipdate AS DATE) AS date FROM lineitem")


def tick_calendar(spark, d) -> DataFrame:
    days = table(spark, d, "events").select(F.col("ts").cast("date").alias("date"))
    return _weekdays(days)


TICK_CALENDAR = _calendar_sql("CAST(ts AS DATE) AS date FROM events")


# -- earnings ----------------------------------------------------------------
def releases(spark, d) -> DataFrame:
    """Finished orders as earnings releases; low priorities are listed abroad."""
    return order_earnings(spark, d).where("o_orderstatus = 'F'").select("ticker", "date")


def corporate_events(spark, d) -> DataFrame:
    """The other orders as corporate events, the type from the priority."""
    return (
        order_earnings(spark, d)
        .where("o_orderstatus <> 'F'")
        .select("ticker", "date", "type")
    )


def order_earnings(spark, d) -> DataFrame:
    first = F.substring("o_orderpriority", 1, 1)
    kind = (
        F.when(first == "1", "earnings_announcement_date")
        .when(first == "2", "earnings_conference_call")
        .when(first == "3", "earnings_results_announcement")
        .otherwise("dividend")
    )
    suffix = F.when(first == "5", ".HK").otherwise("")
    return table(spark, d, "orders").select(
        F.concat(F.lit("S"), "o_custkey", suffix).alias("ticker"),
        F.col("o_orderdate").cast("date").alias("date"),
        kind.alias("type"),
        "o_orderstatus",
    )


ORDER_EARNINGS = """order_earnings AS (SELECT 'S' || o_custkey ||
 CASE WHEN o_orderpriority[1] = '5' THEN '.HK' ELSE '' END AS ticker,
 CAST(o_orderdate AS DATE) AS date, o_orderstatus,
 CASE o_orderpriority[1] WHEN '1' THEN 'earnings_announcement_date'
  WHEN '2' THEN 'earnings_conference_call' WHEN '3' THEN 'earnings_results_announcement'
  ELSE 'dividend' END AS type FROM orders)"""

EARNINGS_START, EARNINGS_END = "1995-06-01", "2001-06-30"


def earnings(spark, d) -> DataFrame:
    """Every order as an earnings date of its customer's ticker."""
    return order_earnings(spark, d).select("ticker", "date").distinct()


EARNINGS = ORDER_EARNINGS + """,
earnings AS (SELECT DISTINCT ticker, date FROM order_earnings)"""


def tick_earnings(spark, d) -> DataFrame:
    """Earnings dates of the wide tickers, from the suppliers' nations."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("s_nationkey"))
    return table(spark, d, "supplier").select(
        F.concat(F.lit("U"), "s_suppkey").alias("ticker"), day.alias("date")
    )


TICK_EARNINGS = """earnings AS (SELECT 'U' || s_suppkey AS ticker,
 DATE '2024-01-01' + s_nationkey AS date FROM supplier)"""

WINDOWS = """around AS (SELECT d.date,
  (SELECT max(c.date) FROM calendar c WHERE c.date < d.date) AS prev_date,
  (SELECT max(c.date) FROM calendar c WHERE c.date = d.date) AS same_date,
  (SELECT min(c.date) FROM calendar c WHERE c.date > d.date) AS next_date
 FROM (SELECT DISTINCT date FROM earnings) d),
windows AS (SELECT DISTINCT ticker, snapshot_date FROM (
  SELECT e.ticker, unnest([a.prev_date, a.same_date, a.next_date]) AS snapshot_date
  FROM earnings e JOIN around a USING (date) WHERE e.ticker <> '')
 WHERE snapshot_date IS NOT NULL)"""


# -- contracts ---------------------------------------------------------------
def contracts(spark, d) -> DataFrame:
    """``part`` as option contracts: the underlying is the supplier of like number."""
    months = F.col("p_size").cast("int")
    return table(spark, d, "part").select(
        F.concat(F.lit("O:S"), "p_partkey", F.lit("C"), "p_size").alias("ticker"),
        F.concat(F.lit("S"), F.regexp_extract("p_brand", "([0-9]+)", 1)).alias(
            "underlying_ticker"
        ),
        F.add_months(F.lit("1995-01-01").cast("date"), months).alias("expiration_date"),
        F.col("p_retailprice").alias("strike_price"),
        F.when(F.col("p_size") <= 20, True).when(F.col("p_size") > 40, False).alias("expired"),
        F.col("p_type").alias("contract_type"),
    )


CONTRACTS = """contracts AS (SELECT 'O:S' || p_partkey || 'C' || p_size AS ticker,
 'S' || regexp_extract(p_brand, '([0-9]+)', 1) AS underlying_ticker,
 CAST(DATE '1995-01-01' + to_months(p_size) AS DATE) AS expiration_date,
 p_retailprice AS strike_price,
 CASE WHEN p_size <= 20 THEN true WHEN p_size > 40 THEN false END AS expired,
 p_type AS contract_type FROM part)"""


# -- output ------------------------------------------------------------------
# A quotient of sums often lies exactly half-way between two rounded values, where
# the order of summation would decide. The nudge is far above that noise.
NUDGE = 1e-9


def settled(name: str) -> str:
    """SQL of a quotient of sums, rounded."""
    return f"round({name} + {NUDGE}, 6) AS {name}"


def shown(df: DataFrame) -> DataFrame:
    """Doubles to 6 places; dates and decimals as text or double, for comparison."""
    cols = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "double":
            c = F.round(c + NUDGE if name.endswith("vwap") else c, 6)
        elif kind.startswith("decimal"):
            c = F.round(c.cast("double"), 6)
        elif kind == "date":
            c = c.cast("string")
        cols.append(c.alias(name))
    return df.select(*cols)
