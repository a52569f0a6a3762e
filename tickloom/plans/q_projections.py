"""Projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import project as pr
from tickloom.plans import market as m
from tickloom.plans.registry import query


@query(
    "proj01_snake_case_columns",
    """SELECT l_orderkey AS order_key, l_linenumber AS line_number,
    round(l_extendedprice, 6) AS e_p_s_value, l_linestatus AS line_status,
    CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_date FROM lineitem""",
)
def _(spark, d):
    cased = m.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("orderKey"),
        F.col("l_linenumber").alias("lineNumber"),
        F.col("l_extendedprice").alias("EPSValue"),
        F.struct(
            F.col("l_linestatus").alias("lineStatus"),
            F.col("l_shipdate").cast("date").alias("shipDate"),
        ).alias("lineInfo"),
    )
    out = pr.snake_case_columns(cased)
    return out.select("order_key", "line_number", "e_p_s_value", "line_info.*")


def _coded(bars):
    names = {name: code for code, name in pr.BAR_CODES.items()}
    names["window_start"] = "t"
    return bars.toDF(*[names.get(c, c) for c in bars.columns])


@query(
    "proj02_apply_code_map",
    f"""WITH {m.DAY_BARS} SELECT ticker, CAST(window_start AS BIGINT) AS timestamp,
    round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low, round(close, 6) AS close,
    round(volume, 6) AS volume, {m.settled('vwap')}, transactions FROM bars""",
)
def _(spark, d):
    coded = _coded(m.day_bars(spark, d)).withColumn("volume", F.lit(-1.0))
    return pr.apply_code_map(coded, pr.BAR_CODES, overwrite=True)


@query(
    "proj03_normalize_bars",
    f"""WITH {m.DAY_BARS} SELECT ticker,
    strftime(make_timestamp(CAST(window_start // 1000 AS BIGINT)), '%Y-%m-%dT%H:%M:%S') || '+00:00'
     AS timestamp, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low,
    round(close, 6) AS close, round(volume, 6) AS volume, {m.settled('vwap')}, transactions,
    true AS active FROM bars WHERE transactions > 1""",
)
def _(spark, d):
    # Bars of a single trade lose their time, so that the row filter has work to do.
    bars = m.day_bars(spark, d).withColumn(
        "window_start",
        F.when(F.col("transactions") > 1, F.call_function("div", F.col("window_start"), F.lit(1_000_000).cast("bigint"))),
    )
    status = pr.resolve_status(F.lit(None), None, True)
    return pr.normalize_bars(_coded(bars), iso=True, status=status)


@query(
    "proj04_normalize_snapshot",
    """SELECT event_id, value AS ask_price, user_id AS bid_size, k AS trade_size,
    CASE WHEN event_type = 'click' THEN user_id END AS ask_exchange,
    CASE WHEN event_type = 'click' THEN k END AS bid_exchange,
    CASE WHEN event_type = 'view' THEN user_id WHEN event_type = 'error' THEN k END
     AS quote_exchange, value AS day_close, k AS todays_change_percent
    FROM (SELECT event_id, event_type, user_id, round(value, 6) AS value,
     CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)""",
)
def _(spark, d):
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("bigint")
    raw = m.table(spark, d, "events").select(
        "event_id",
        F.struct(
            F.col("value").alias("P"),
            F.col("user_id").alias("s"),
            F.when(kind.isin("click", "view"), F.col("user_id")).alias("X"),
            F.when(kind.isin("click", "error"), k).alias("x"),
        ).alias("lastQuote"),
        F.struct(F.col("value").alias("p"), k.alias("s")).alias("lastTrade"),
        F.struct(F.col("value").alias("c"), k.alias("v")).alias("prevDay"),
        k.alias("todaysChangePerc"),
    )
    out = pr.normalize_snapshot(raw)
    return out.select(
        "event_id",
        "last_quote.ask_price",
        "last_quote.bid_size",
        F.col("last_trade.size").alias("trade_size"),
        "last_quote.ask_exchange",
        "last_quote.bid_exchange",
        F.col("last_quote.exchange").alias("quote_exchange"),
        F.col("prev_day.close").alias("day_close"),
        "todays_change_percent",
    )


@query(
    "proj05_project",
    f"""WITH {m.quotes_sql('option')} SELECT ticker, sip_timestamp, sequence_number,
    round(ask_price, 6) AS ask_price, round(bid_price, 6) AS bid_price FROM quotes""",
)
def _(spark, d):
    wanted = ["ticker", "sip_timestamp", "sequence_number", "ask_price", "bid_price", "tape"]
    return pr.project(m.quotes(spark, d, "option"), wanted)


@query(
    "proj06_to_option_identity",
    f"""WITH {m.CONTRACTS} SELECT ticker AS option_ticker, underlying_ticker,
    round(l_extendedprice, 6) AS price, l_orderkey AS sequence_number
    FROM (SELECT 'O:S' || l_partkey || 'C' || p_size AS option_ticker, l_extendedprice, l_orderkey
     FROM lineitem JOIN part ON l_partkey = p_partkey) t
    JOIN contracts ON ticker = option_ticker""",
)
def _(spark, d):
    part = m.table(spark, d, "part").select("p_partkey", "p_size")
    lines = m.table(spark, d, "lineitem").select("l_partkey", "l_extendedprice", "l_orderkey")
    trades = lines.join(part, lines.l_partkey == part.p_partkey).select(
        F.concat(F.lit("O:S"), "l_partkey", F.lit("C"), "p_size").alias("ticker"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_orderkey").alias("sequence_number"),
    )
    return pr.to_option_identity(trades, m.contracts(spark, d))


@query(
    "proj07_coalesce_nested",
    """SELECT p_partkey, CASE WHEN p_size > 25 THEN p_brand ELSE p_name END AS ticker,
    p_type AS product_code FROM part""",
)
def _(spark, d):
    big = F.col("p_size") > 25
    parts = m.table(spark, d, "part").select(
        "p_partkey",
        F.when(big, F.col("p_brand")).otherwise("").alias("ticker"),
        F.struct(
            F.col("p_name").alias("ticker"), F.col("p_type").alias("product_code")
        ).alias("details"),
    )
    out = pr.coalesce_nested(parts, "ticker", "details.ticker", drop_source=True)
    out = pr.coalesce_nested(
        out, "product_code", "details.product_code", blank_is_missing=False
    )
    return out.drop("details")


@query(
    "proj08_fill_key",
    """SELECT l_orderkey, l_linenumber, coalesce(nullif(l_returnflag, 'N'), '') AS returnflag,
    coalesce(nullif(l_linestatus, 'O'), '') AS linestatus FROM lineitem""",
)
def _(spark, d):
    rows = m.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_returnflag", F.lit("N")).alias("returnflag"),
        F.nullif("l_linestatus", F.lit("O")).alias("linestatus"),
    )
    return pr.fill_key(rows, ["returnflag", "linestatus"])


@query(
    "proj09_surrogate_key",
    """WITH named AS (SELECT p_partkey, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') ||
     encode(coalesce(nullif(p_brand, 'Brand#1'), 'None') || '|' || p_partkey || '|' || p_type))
     AS h FROM part)
    SELECT p_partkey, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' ||
     translate(h[17], '0123456789abcdef', '89ab89ab89ab89ab') || h[18:20] || '-' || h[21:32]
     AS _surrogate_key FROM named""",
)
def _(spark, d):
    parts = m.table(spark, d, "part").select(
        "p_partkey", "p_type", F.nullif("p_brand", F.lit("Brand#1")).alias("p_brand")
    )
    keyed = pr.with_surrogate_key(parts, ["p_type", "p_partkey", "p_brand"])
    return keyed.select("p_partkey", "_surrogate_key")


@query(
    "proj10_sip_mapping",
    """SELECT c_custkey, 'CTA' AS feed, c_mktsegment AS code FROM customer
    UNION ALL
    SELECT c_custkey, 'UTP', c_name FROM customer WHERE c_mktsegment <> 'BUILDING'""",
)
def _(spark, d):
    segment = F.col("c_mktsegment")
    rows = m.table(spark, d, "customer").select(
        "c_custkey",
        F.create_map(
            F.lit("c_t_a"), segment,
            F.lit("utp"), F.when(segment != "BUILDING", F.col("c_name")),
            F.lit("other"), F.lit("x"),
        ).alias("sip_mapping"),
    )
    out = pr.normalize_sip_mapping(rows)
    return out.select("c_custkey", F.explode("sip_mapping").alias("feed", "code"))


@query(
    "proj11_normalize_trades",
    f"""WITH {m.TICKS} SELECT sequence_number, sip_timestamp, round(price, 6) AS price,
    CAST(size AS VARCHAR) || ',' || CAST(size * 10 AS VARCHAR) AS conditions FROM ticks""",
)
def _(spark, d):
    size = F.col("size").cast("string")
    raw = m.ticks(spark, d).select(
        "sequence_number",
        F.concat(F.lit(" "), F.col("sip_timestamp").cast("string")).alias("sip_timestamp"),
        F.col("price").cast("string").alias("price"),
        F.array(size, F.lit("x"), F.concat(size, F.lit("e1")), F.lit(None)).alias("conditions"),
    )
    out = pr.normalize_trades(raw)
    return out.withColumn(
        "conditions", F.array_join(F.col("conditions").cast("array<string>"), ",")
    )


@query(
    "proj12_narrow_integral",
    """SELECT l_orderkey, l_linenumber, round(l_quantity / 4, 6) AS size,
    CASE WHEN l_quantity / 4 = floor(l_quantity / 4) THEN CAST(l_quantity / 4 AS BIGINT) END
     AS whole_size FROM lineitem""",
)
def _(spark, d):
    size = F.col("l_quantity") / 4
    return m.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        size.alias("size"),
        pr.narrow_integral(size).alias("whole_size"),
    )


@query(
    "proj13_clean_ipos",
    """SELECT o_orderkey, lower(o_orderpriority) AS ipo_status,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END
     AS last_updated FROM orders""",
)
def _(spark, d):
    day = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = m.table(spark, d, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("ipo_status"),
        F.when(F.col("o_orderstatus") == "P", "soon").otherwise(day).alias("last_updated"),
    )
    out = pr.clean_ipos(rows)
    return out.withColumn("last_updated", F.to_date("last_updated"))


@query(
    "proj14_resolve_status",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN true ELSE false END AS active,
    CASE o_orderstatus WHEN 'O' THEN true ELSE false END AS expired,
    CASE o_orderstatus WHEN 'F' THEN false ELSE true END AS active_default FROM orders""",
)
def _(spark, d):
    status = F.col("o_orderstatus")
    flag = F.when(status == "O", " Yes ").when(status == "F", "0").otherwise("maybe")
    return m.table(spark, d, "orders").select(
        "o_orderkey",
        pr.resolve_status(flag, "false", True).alias("active"),
        pr.resolve_status(flag, None, False).alias("expired"),
        pr.resolve_status(flag, None, True).alias("active_default"),
    )
