from decimal import Decimal

from pyspark.sql import functions as F

from tickloom.operators import project as pr


def test_snake_case_goes_into_objects_not_arrays(spark):
    df = spark.range(1).select(
        F.struct(F.struct(F.lit(1).alias("innerKey")).alias("outerKey")).alias("topKey"),
        F.array(F.struct(F.lit(1).alias("keepMe"))).alias("listKey"),
    )
    out = pr.snake_case_columns(df)
    assert out.columns == ["top_key", "list_key"]
    assert out.schema["top_key"].dataType.simpleString() == "struct<outer_key:struct<inner_key:int>>"
    assert "keepMe" in out.schema["list_key"].dataType.simpleString()


def test_code_map_keeps_both_cases_apart(spark):
    df = spark.createDataFrame([("X", 5, 1.0)], "a string, b bigint, c double").toDF("T", "t", "o")
    out = pr.apply_code_map(df, pr.BAR_CODES)
    assert out.columns == ["ticker", "timestamp", "open"]
    assert out.first() == ("X", 5, 1.0)


def test_code_map_precedence(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (1.0, None)], "open double, o double")
    code_wins = pr.apply_code_map(df, pr.BAR_CODES, overwrite=True)
    own_wins = pr.apply_code_map(df, pr.BAR_CODES, overwrite=False)
    assert [r.open for r in code_wins.collect()] == [2.0, 2.0, 1.0]
    assert [r.open for r in own_wins.collect()] == [1.0, 2.0, 1.0]


def test_bars(spark):
    df = spark.createDataFrame(
        [(1_700_000_000_123, 1.5, True), (None, 2.0, False)], "t bigint, c double, otc boolean"
    )
    out = pr.normalize_bars(
        df, iso=True, ticker=F.lit("ABC"), status=pr.resolve_status(F.lit("no"), "true", True)
    )
    row = out.collect()
    assert len(row) == 1 and "otc" not in out.columns
    assert row[0].timestamp == "2023-11-14T22:13:20.123000+00:00"
    assert row[0].close == Decimal("1.5") and row[0].active is False


def test_status_precedence(spark):
    def flag(row, config, default):
        c = pr.resolve_status(F.lit(row).cast("string"), config, default)
        return spark.range(1).select(c).first()[0]

    assert flag(None, None, True) is True
    assert flag("false", "true", True) is False
    assert flag("maybe", "0", True) is False
    assert flag(None, None, False) is False


def test_quote_exchanges(spark):
    quote = "struct<X:int,x:int,P:double,ask_price:double>"
    df = spark.createDataFrame(
        [(1, (7, 8, 1.0, None)), (2, (7, None, 1.0, 9.0)), (3, (None, 8, 1.0, None)), (4, None)],
        f"i int, lastQuote {quote}",
    )
    out = {r.i: r.last_quote for r in pr.normalize_snapshot(df).collect()}
    assert (out[1].ask_exchange, out[1].bid_exchange, out[1].exchange) == (7, 8, None)
    assert (out[2].ask_exchange, out[2].bid_exchange, out[2].exchange) == (None, None, 7)
    assert out[3].exchange == 8 and out[4] is None
    assert out[1].ask_price == 1.0 and out[2].ask_price == 9.0


def test_single_exchange_code(spark):
    df = spark.createDataFrame([((7, 1.0),)], "lastQuote struct<x:int,p:double>")
    quote = pr.normalize_snapshot(df).first().last_quote
    assert quote.exchange == 7 and quote.bid_price == 1.0


def test_change_percent_spelling(spark):
    df = spark.range(1).select(F.lit(2.5).alias("todaysChangePerc"))
    assert pr.normalize_snapshot(df).columns == ["todays_change_percent"]


def test_sip_mapping_last_spelling_wins(spark):
    df = spark.range(1).select(
        F.create_map(
            F.lit("cta"), F.lit("a"), F.lit("c_t_a"), F.lit("b"),
            F.lit("opra"), F.lit(None).cast("string"), F.lit("zzz"), F.lit("d"),
        ).alias("sip_mapping")
    )
    assert pr.normalize_sip_mapping(df).first().sip_mapping == {"CTA": "b"}


def test_trades(spark):
    df = spark.createDataFrame(
        [("12.9", "3.25", ["1", "x", None, "4.0"])],
        "sip_timestamp string, price string, conditions array<string>",
    )
    row = pr.normalize_trades(df).first()
    assert row.sip_timestamp == 12 and row.price == Decimal("3.25") and row.conditions == [1, 4]


def test_nested_fallback(spark):
    df = spark.createDataFrame(
        [("", ("A",)), (None, ("B",)), ("C", ("D",))], "ticker string, details struct<ticker:string>"
    )
    assert [r.ticker for r in pr.coalesce_nested(df, "ticker", "details.ticker").collect()] == [
        "A", "B", "C",
    ]
    kept = pr.coalesce_nested(df, "ticker", "details.ticker", blank_is_missing=False)
    assert [r.ticker for r in kept.collect()] == ["", "B", "C"]


def test_ipos(spark):
    df = spark.createDataFrame(
        [("NEW", "2024-01-02T00:00:00Z"), ("History", "bad")], "ipo_status string, last_updated string"
    )
    out = pr.clean_ipos(df).collect()
    assert [r.ipo_status for r in out] == ["new", "history"]
    assert out[0].last_updated is not None and out[1].last_updated is None
