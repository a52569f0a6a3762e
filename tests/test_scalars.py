import hashlib
import json
import uuid
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickloom.functions import scalars as sc
from tickloom import functions as fn

DIRTY = ["", " 5 ", "12.7", "-12.7", "1e3", "NaN", "abc", "TRUE", "0", None, "99999999999999999999"]


def column(spark, values, kind, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def test_safe_numbers(spark):
    assert column(spark, DIRTY, "string", fn.safe_int) == [
        None, 5, 12, -12, 1000, None, None, None, 0, None, None,
    ]
    decimals = column(spark, DIRTY, "string", fn.safe_decimal)
    assert decimals[:5] == [None, Decimal(5), Decimal("12.7"), Decimal("-12.7"), Decimal(1000)]
    assert decimals[5:10] == [None, None, None, Decimal(0), None]


def test_flags(spark):
    values = ["", None, " true ", "1", "yes", "No", "0", "x"]
    assert column(spark, values, "string", fn.to_bool) == [
        None, None, True, True, False, False, False, False,
    ]
    assert column(spark, values, "string", fn.status_bool) == [
        None, None, True, True, True, False, False, None,
    ]


def test_epoch_units(spark):
    values = [1_700_000_000, 1_700_000_000_000, 17_000_000_000_000_0, 1_700_000_000_000_000_000, -5]
    assert column(spark, values, "bigint", fn.epoch_to_seconds) == [
        1.7e9, 1.7e9, 1.7e8, 1.7e9, -5.0,
    ]


def test_iso_text(spark):
    values = ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05", "2024-01-02T04:04:05+01:00", "soon"]
    seconds = 1704164645
    got = column(spark, values, "string", lambda c: fn.iso_to_unix(c, "ns"))
    assert got == [seconds * 10**9] * 3 + [None]
    assert column(spark, values, "string", lambda c: fn.iso_to_unix(c, "ms"))[0] == seconds * 1000


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(1, 2**61), min_size=1, max_size=40), st.integers(1, 10**12))
def test_bucket_contains_its_time(spark, times, step):
    ends = column(spark, times, "bigint", lambda c: fn.bucket_end(c, step))
    for t, end in zip(times, ends):
        assert end % step == 0 and end - step < t <= end


def test_tickers(spark):
    values = ["EUR/USD", "C:eurusd", " eurusd ", "BACpK", "EURUSDT", ""]
    assert column(spark, values, "string", lambda c: fn.canonical_ticker(c, "fx")) == [
        "C:EURUSD", "C:eurusd", "C:eurusd", "BACpK", "EURUSDT", "",
    ]
    options = ["O:AAPL260220C00125000", "AAPL", "O:1X", None]
    assert column(spark, options, "string", fn.option_underlying) == ["AAPL", None, None, None]
    assert column(spark, ["AAPL", "0011.HK", "", None, "BRK-A"], "string", fn.is_us_ticker) == [
        True, False, False, False, True,
    ]


def test_names(spark):
    names = ["EPSValue", "openPrice", "already_snake", "X"]
    assert column(spark, names, "string", fn.snake_case) == [
        "e_p_s_value", "open_price", "already_snake", "x",
    ]
    files = ["2024-01-02.csv.gz", "q_2024-01-02_2023-01-01.csv", "none.csv"]
    assert column(spark, files, "string", fn.file_date) == ["2024-01-02", "2024-01-02", None]
    assert fn.interval_ns_of("stock_quote_snapshots_5_minute") == 300 * 10**9
    with pytest.raises(ValueError):
        fn.interval_ns_of("stock_bars_1_day")


def test_keys_match_the_standard_library(spark):
    data = [("a", 1, None), ("é😀\"\\b", 2, "x\n")]
    df = spark.createDataFrame(data, "a string, b int, c string")
    out = df.select(
        "*",
        fn.surrogate_key("b", "a", "c").alias("k"),
        fn.fingerprint(F.create_map(F.lit("z"), F.col("a"), F.lit('b"é'), F.col("c"))).alias("f"),
    ).collect()
    for r in out:
        text = "|".join(str(r[x]) for x in "abc")
        assert r.k == str(uuid.uuid5(uuid.NAMESPACE_DNS, text))
        canonical = json.dumps({"z": r.a, 'b"é': r.c}, sort_keys=True)
        assert r.f == hashlib.sha256(canonical.encode()).hexdigest()


def test_keys_over_doubles_follow_their_json_text(spark):
    import uuid

    from tickloom.operators.project import with_surrogate_key

    values = [100.0, 10_000_000.0, 0.1, 1234.5678, -2.5, 0.0, 0.0001, 123456789012.25, None]
    df = spark.createDataFrame([(v, "a") for v in values], "shares double, name string")
    for row in with_surrogate_key(df, ["shares", "name"]).collect():
        text = f"a|{row.shares}"
        assert row._surrogate_key == str(uuid.uuid5(uuid.NAMESPACE_DNS, text)), text


def test_nine_fraction_digits(spark):
    table = {
        "2024-01-02T03:04:05.123456789Z": 1704164645123456789,
        "2024-01-02T03:04:05.1234567+00:00": 1704164645123456700,
        "2024-01-02 03:04:05.12345678": 1704164645123456780,
        "2024-01-02T03:04:05.000000001-05:00": 1704182645000000001,
        "1969-12-31T23:59:59.999999999Z": -1,
        "2024-01-02T03:04:05.5Z": 1704164645500000000,
        "2024-01-02": 1704153600000000000,
        "oops.1234567": None,
    }
    df = spark.createDataFrame([(t,) for t in table], "t string")
    got = df.select("t", sc.iso_to_unix("t", "ns").alias("ns"), sc.iso_to_unix("t", "ms").alias("ms")).collect()
    assert {r.t: r.ns for r in got} == table
    assert all(r.ms == (None if r.ns is None else r.ns // 1_000_000) for r in got)
