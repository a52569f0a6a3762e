"""Scalar functions, over text and numbers made from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom import functions as fn
from tickloom.plans import market as m
from tickloom.plans.registry import query

_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"
_DIRTY_SQL = f"""dirty AS (SELECT event_id, event_type, CASE event_type
  WHEN 'click' THEN ' ' || k || ' ' WHEN 'view' THEN '-' || k || '.75'
  WHEN 'purchase' THEN k || 'e2' WHEN 'signup' THEN '' ELSE 'abc' || k END AS text, k
 FROM (SELECT event_id, event_type, {_K} AS k FROM events))"""


def _dirty(spark, d):
    """Numbers of every event, written clean or dirty by event type."""
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k")
    return m.table(spark, d, "events").select(
        "event_id",
        F.when(kind == "click", F.concat(F.lit(" "), k, F.lit(" ")))
        .when(kind == "view", F.concat(F.lit("-"), k, F.lit(".75")))
        .when(kind == "purchase", F.concat(k, F.lit("e2")))
        .when(kind == "signup", "")
        .otherwise(F.concat(F.lit("abc"), k))
        .alias("text"),
    )


@query(
    "scl01_safe_decimal",
    f"""WITH {_DIRTY_SQL} SELECT event_id, round(CAST(try_cast(nullif(trim(text), '')
     AS DECIMAL(38,10)) AS DOUBLE), 6) AS value FROM dirty""",
)
def _(spark, d):
    return _dirty(spark, d).select("event_id", fn.safe_decimal("text").alias("value"))


@query(
    "scl02_safe_int",
    f"""WITH {_DIRTY_SQL} SELECT event_id, CASE event_type WHEN 'click' THEN k WHEN 'view' THEN -k
     WHEN 'purchase' THEN k * 100 END AS value FROM dirty""",
)
def _(spark, d):
    return _dirty(spark, d).select("event_id", fn.safe_int("text").alias("value"))


@query(
    "scl03_to_bool",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'true' WHEN 'F' THEN 'false' END AS flag,
    CASE o_orderpriority[1] WHEN '1' THEN 'true' ELSE 'false' END AS urgent FROM orders""",
)
def _(spark, d):
    status = F.col("o_orderstatus")
    text = F.when(status == "O", " TRUE ").when(status == "F", "F").otherwise("")
    return m.table(spark, d, "orders").select(
        "o_orderkey",
        fn.to_bool(text).cast("string").alias("flag"),
        fn.to_bool(F.substring("o_orderpriority", 1, 1)).cast("string").alias("urgent"),
    )


@query(
    "scl04_status_bool",
    """SELECT o_orderkey, CASE o_orderpriority[1] WHEN '1' THEN 'true' WHEN '2' THEN 'true'
     WHEN '3' THEN 'false' WHEN '4' THEN 'false' END AS flag FROM orders""",
)
def _(spark, d):
    first = F.substring("o_orderpriority", 1, 1)
    text = (
        F.when(first == "1", " Yes").when(first == "2", "1").when(first == "3", "N")
        .when(first == "4", "false").otherwise("perhaps")
    )
    return m.table(spark, d, "orders").select(
        "o_orderkey", fn.status_bool(text).cast("string").alias("flag")
    )


@query(
    "scl05_epoch_to_seconds",
    """WITH n AS (SELECT event_id, CASE event_type WHEN 'click' THEN epoch_us(ts) // 1000000
     WHEN 'view' THEN epoch_us(ts) // 1000 WHEN 'purchase' THEN epoch_us(ts) // 100
     ELSE epoch_us(ts) * 1000 END AS n FROM events)
    SELECT event_id, round(CASE WHEN abs(n) > 1e15 THEN n / 1e9 WHEN abs(n) > 1e13
     THEN abs(n) / 1e6 WHEN abs(n) > 1e10 THEN n / 1e3 ELSE n END, 6) AS seconds FROM n""",
)
def _(spark, d):
    kind, us = F.col("event_type"), F.unix_micros(F.col("ts").cast("timestamp"))
    n = (
        F.when(kind == "click", fn.whole_div(us, 1_000_000))
        .when(kind == "view", fn.whole_div(us, 1000))
        .when(kind == "purchase", fn.whole_div(us, 100))
        .otherwise(us * 1000)
    )
    return m.table(spark, d, "events").select(
        "event_id", fn.epoch_to_seconds(n).alias("seconds")
    )


@query(
    "scl06_iso_to_unix",
    """SELECT event_id, epoch_us(ts) // 1000000 AS s, epoch_us(ts) // 1000 AS ms,
    epoch_us(ts) * 1000 AS ns FROM events""",
)
def _(spark, d):
    naive = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = F.when(F.col("event_type") == "click", F.concat(naive, F.lit("Z"))).otherwise(naive)
    return m.table(spark, d, "events").select(
        "event_id", *[fn.iso_to_unix(text, unit).alias(unit) for unit in ("s", "ms", "ns")]
    )


@query(
    "scl07_bucket_end",
    """SELECT event_id, ((epoch_us(ts) * 1000 - 1) // 60000000000 + 1) * 60000000000 AS minute_end,
    ((event_id - 1) // 60 + 1) * 60 AS small_end, ((-event_id - 1) // 60 + 1) * 60 AS negative_end
    FROM events""",
)
def _(spark, d):
    return m.table(spark, d, "events").select(
        "event_id",
        fn.bucket_end(fn.ts_to_ns("ts"), 60_000_000_000).alias("minute_end"),
        fn.bucket_end("event_id", 60).alias("small_end"),
        fn.bucket_end(-F.col("event_id"), 60).alias("negative_end"),
    )


@query(
    "scl08_canonical_ticker",
    """WITH t AS (SELECT o_orderkey, o_orderpriority[1] AS p, o_orderstatus AS s FROM orders)
    SELECT o_orderkey, CASE p WHEN '1' THEN 'C:eurusd' WHEN '2' THEN 'C:GBPUSD'
     WHEN '3' THEN 'C:JPY' || s || 'SD' WHEN '4' THEN 'TOOLONG' || s ELSE '' END AS fx,
    CASE p WHEN '1' THEN 'eur/usd' WHEN '2' THEN 'C:GBPUSD' WHEN '3' THEN 'JPY-' || s || 'SD'
     WHEN '4' THEN 'TOOLONG' || s ELSE '' END AS stock FROM t""",
)
def _(spark, d):
    p, s = F.substring("o_orderpriority", 1, 1), F.col("o_orderstatus")
    text = (
        F.when(p == "1", " eur/usd ")
        .when(p == "2", "C:GBPUSD ")
        .when(p == "3", F.concat(F.lit("JPY-"), s, F.lit("SD")))
        .when(p == "4", F.concat(F.lit(" TOOLONG"), s))
        .otherwise("  ")
    )
    return m.table(spark, d, "orders").select(
        "o_orderkey",
        fn.canonical_ticker(text, "forex").alias("fx"),
        fn.canonical_ticker(text, "stock").alias("stock"),
    )


@query(
    "scl09_option_underlying",
    """SELECT p_partkey, CASE WHEN p_size > 10 THEN upper(split_part(p_name, ' ', 1)) END
    AS underlying FROM part""",
)
def _(spark, d):
    letters = F.upper(F.split_part("p_name", F.lit(" "), F.lit(1)))
    option = F.concat(F.lit("O:"), letters, F.lit("240119C00100000"))
    plain = F.concat(F.lit("o:"), letters)
    ticker = F.when(F.col("p_size") > 10, option).otherwise(plain)
    return m.table(spark, d, "part").select(
        "p_partkey", fn.option_underlying(ticker).alias("underlying")
    )


@query(
    "scl10_file_date",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O'
     THEN strftime(l_shipdate, '%Y-%m-%d') END AS file_date FROM lineitem""",
)
def _(spark, d):
    dated = F.concat(
        F.lit("trades_"), F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(".2001-01-01.csv.gz")
    )
    plain = F.concat(F.lit("trades_"), F.date_format("l_shipdate", "yyyyMMdd"), F.lit(".csv"))
    name = F.when(F.col("l_linestatus") == "O", dated).otherwise(plain)
    return m.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", fn.file_date(name).alias("file_date")
    )


@query(
    "scl11_interval_ns",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 1000000000 WHEN 'view' THEN 30000000000
     WHEN 'purchase' THEN 60000000000 WHEN 'signup' THEN 1800000000000 END AS interval_ns
    FROM events""",
)
def _(spark, d):
    kind = F.col("event_type")
    size = (
        F.when(kind == "click", "1_second")
        .when(kind == "view", "30_second")
        .when(kind == "purchase", "1_minute")
        .when(kind == "signup", "30_minute")
        .otherwise("1_day")
    )
    name = F.concat(F.lit("options_quote_snapshots_flat_files_"), size)
    return m.table(spark, d, "events").select("event_id", fn.interval_ns(name).alias("interval_ns"))


@query(
    "scl12_fingerprint",
    """SELECT c_custkey, sha256('{"market": "' || c_mktsegment || '", "name": "' || c_name ||
     '", "other": null}') AS fingerprint FROM customer""",
)
def _(spark, d):
    params = F.create_map(
        F.lit("other"), F.lit(None).cast("string"),
        F.lit("name"), F.col("c_name"),
        F.lit("market"), F.col("c_mktsegment"),
    )
    return m.table(spark, d, "customer").select(
        "c_custkey", fn.fingerprint(params).alias("fingerprint")
    )


@query(
    "scl13_series_label",
    """SELECT p_partkey, lower(p_type) || '_day_' || p_size AS label FROM part""",
)
def _(spark, d):
    label = fn.series_label(F.lower("p_type"), F.lit("day"), F.col("p_size"))
    return m.table(spark, d, "part").select("p_partkey", label.alias("label"))


@query(
    "scl14_snake_case",
    """SELECT p_partkey, ltrim(lower(regexp_replace(x, '([A-Z])', '_\\1', 'g')), '_') AS snake
    FROM (SELECT p_partkey, upper(p_name[1]) || substr(split_part(p_name, ' ', 1), 2) ||
     upper(split_part(p_name, ' ', 2)[1]) || substr(split_part(p_name, ' ', 2), 2) AS x
     FROM part)""",
)
def _(spark, d):
    camel = F.replace(F.initcap("p_name"), F.lit(" "), F.lit(""))
    return m.table(spark, d, "part").select("p_partkey", fn.snake_case(camel).alias("snake"))


@query(
    "scl15_slug",
    """SELECT c_custkey, lower(replace(c_mktsegment || '_' || c_name, '_', '')) AS slug
    FROM customer""",
)
def _(spark, d):
    name = F.concat_ws("_", "c_mktsegment", "c_name")
    return m.table(spark, d, "customer").select("c_custkey", fn.slug(name).alias("slug"))
