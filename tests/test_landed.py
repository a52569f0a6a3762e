import json

from tickloom.operators import filters as fl
from tickloom.operators import project as pr
from tickloom.sources import landed


def pages(spark, *docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "payload string")


def test_page_shapes(spark, rows):
    df = pages(
        spark,
        {"results": [{"a": 1}, {"a": 2}]},
        {"results": {"a": 3}},
        {"a": 4},
        [{"a": 5}, {}],
        {"results": []},
        {"results": None},
        {},
    )
    out = landed.read_records(landed.explode_results(df), "a bigint")
    assert rows(out) == [(1,), (2,), (3,), (4,), (5,)]


def test_inner_key(spark, rows):
    df = pages(
        spark,
        {"tickers": [{"t": 1}, {"t": 2}]},
        {"tickers": {"t": 3}},
        {"t": 4},
    )
    out = landed.read_records(landed.explode_results(df, inner="tickers"), "t bigint")
    assert rows(out) == [(1,), (2,), (3,), (4,)]


def test_codes_camel_case_and_dirt(spark):
    df = pages(spark, {"T": "ABC", "t": 5, "openInterest": "7", "c": "n/a", "tags": ["x"]})
    row = landed.read_records(
        landed.explode_results(df),
        "ticker string, timestamp bigint, open_interest bigint, close double, tags array<string>",
        pr.BAR_CODES,
    ).first()
    assert tuple(row) == ("ABC", 5, 7, None, ["x"])


def test_context_column(spark):
    df = pages(spark, {"results": [{"c": 1.5}]}).selectExpr("payload", "'ABC' AS ticker")
    row = landed.read_records(
        landed.explode_results(df), "ticker string, close double", pr.BAR_CODES, ("ticker",)
    ).first()
    assert tuple(row) == ("ABC", 1.5)


def test_bad_json_is_dropped(spark):
    df = spark.createDataFrame([("{broken",), ('{"a": 1}',)], "payload string")
    assert landed.explode_results(df).count() == 1


def test_drift(spark, rows):
    records = landed.explode_results(pages(spark, {"a": 1, "x": 2}, {"a": 1, "b": 3}))
    assert rows(fl.record_drift(records, "a bigint, b bigint")) == [
        ("missing_in_record", "b", 1),
        ("missing_in_schema", "x", 1),
    ]
    table = spark.createDataFrame([(1, 2)], "a int, x int")
    assert rows(fl.schema_diff(table, "a bigint, b bigint")) == [
        ("missing_in_record", "b"),
        ("missing_in_schema", "x"),
    ]
