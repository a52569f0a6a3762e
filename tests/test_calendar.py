from datetime import date, timedelta

from pyspark.sql import functions as F

from tickloom.operators import calendar as cal
from tickloom.operators import filters as fl

DAYS = [date(2024, 7, 1) + timedelta(days=i) for i in range(40)]
TRADING = [d for d in DAYS if d.weekday() < 5 and d != date(2024, 7, 4)]


def calendar(spark):
    return cal.with_session_hours(spark.createDataFrame([(d,) for d in TRADING], "date date"))


def test_hours_follow_daylight_saving(spark):
    days = spark.createDataFrame([(date(2024, 1, 2),), (date(2024, 7, 2),)], "date date")
    out = cal.with_session_hours(days).orderBy("date").collect()
    hours = [(r.open_ns // 10**9 % 86400 / 3600, r.close_ns // 10**9 % 86400 / 3600) for r in out]
    assert hours == [(14.5, 21.0), (13.5, 20.0)]


def test_grid_has_the_open_not_the_close(spark):
    grid = cal.session_grid(calendar(spark), 1800 * 10**9)
    first = grid.where(F.col("date") == "2024-07-01").orderBy("asof_timestamp").collect()
    assert len(first) == 13
    assert first[-1].asof_timestamp - first[0].asof_timestamp == 12 * 1800 * 10**9


def test_fixed_grid_is_unaligned(spark):
    ranges = spark.createDataFrame([(7, 30), (5, 5)], "start_ns bigint, end_ns bigint")
    assert [r.asof_timestamp for r in cal.fixed_grid(ranges, 10).collect()] == [7, 17, 27]


def test_neighbours(spark):
    asked = DAYS + [date(2024, 1, 1), date(2025, 1, 1)]
    out = cal.neighbours(calendar(spark), spark.createDataFrame([(d,) for d in asked], "date date"))
    got = {r.date: (r.prev_date, r.is_trading, r.next_date) for r in out.collect()}
    assert len(got) == len(asked)
    for d in asked:
        before = [t for t in TRADING if t < d]
        after = [t for t in TRADING if t > d]
        assert got[d] == (max(before, default=None), d in TRADING, min(after, default=None))


def test_earnings_windows(spark, rows):
    earnings = spark.createDataFrame(
        [("A", date(2024, 7, 4)), ("A", date(2024, 7, 5)), ("", date(2024, 7, 5)), ("X.HK", date(2024, 7, 6))],
        "ticker string, date date",
    )
    windows = cal.earnings_windows(earnings, calendar(spark), us_only=True)
    assert rows(windows.selectExpr("ticker", "CAST(snapshot_date AS string)")) == [
        ("A", "2024-07-03"),
        ("A", "2024-07-05"),
        ("A", "2024-07-08"),
    ]
    listed = cal.listed_tickers(cal.tickers_on(cal.earnings_windows(earnings, calendar(spark))))
    by_date = {r.snapshot_date: r.tickers for r in listed.collect()}
    assert by_date[date(2024, 7, 5)] == ["A", "X.HK"]


def test_windows_on_all_dates_match_a_plain_search(spark, rows):
    span = [TRADING[0] + timedelta(days=i) for i in range(-4, (TRADING[-1] - TRADING[0]).days + 5)]
    earnings = [(t, d) for t in "AB" for d in span] + [("A", None), (None, span[3]), ("A", span[5])]
    windows = cal.earnings_windows(spark.createDataFrame(earnings, "ticker string, date date"), calendar(spark))
    want = set()
    for ticker, d in earnings:
        if ticker and d:
            near = [max([t for t in TRADING if t < d], default=None), min([t for t in TRADING if t > d], default=None)]
            want |= {(ticker, n) for n in (*near, d if d in TRADING else None) if n}
    assert rows(windows) == sorted(want, key=str)
    nothing = cal.earnings_windows(spark.createDataFrame(earnings, "ticker string, date date"), calendar(spark).limit(0))
    assert nothing.count() == 0


def test_windows_read_earnings_once(spark, tmp_path):
    spark.createDataFrame([("A", TRADING[2])], "ticker string, date date").write.parquet(f"{tmp_path}/earnings")
    windows = cal.earnings_windows(spark.read.parquet(f"{tmp_path}/earnings"), calendar(spark))
    assert windows.count() == 3
    plan = windows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [ticker") == 1


def test_contracts_alive(spark, rows):
    first = spark.createDataFrame([("A", date(2024, 7, 3))], "ticker string, first_date date")
    contracts = spark.createDataFrame(
        [("1", "A", date(2024, 7, 2)), ("2", "A", date(2024, 7, 3)), ("3", "A", None), ("4", "B", None)],
        "ticker string, underlying_ticker string, expiration_date date",
    )
    assert rows(fl.live_contracts(contracts, first), "ticker") == [("2",), ("3",)]


def test_semi_join_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "flat")
    data = [(d, t, 1) for d in TRADING for t in "AB"]
    spark.createDataFrame(data, "file_date date, ticker string, n int").write.partitionBy(
        "file_date"
    ).parquet(path)
    windows = spark.createDataFrame([("A", TRADING[3])], "ticker string, snapshot_date date")
    out = fl.filter_earnings(spark.read.parquet(path), windows)
    assert [(r.ticker, r.file_date) for r in out.collect()] == [("A", TRADING[3])]
    plan = out._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan and "BroadcastHashJoin" in plan


def test_ticker_lists(spark, rows):
    df = spark.createDataFrame([("AAA",), ("BACpK",), ("C:EURUSD",)], "ticker string")
    assert rows(fl.select_tickers(df, "BACpK, AAA")) == [("AAA",), ("BACpK",)]
    assert rows(fl.select_tickers(df, ["eur-usd", "EURUSD"], market="fx")) == [("C:EURUSD",)]
    assert fl.select_tickers(df, "*").count() == 3 and fl.select_tickers(df, None).count() == 3
    many = [f"T{i}" for i in range(2000)] + ["AAA"]
    assert rows(fl.select_tickers(df, many)) == [("AAA",)]
    config = {"a": {"select_tickers": ["*"]}, "forex_tickers": {"select_tickers": "EUR/USD"}}
    chosen = fl.configured_tickers(config, ("a",), "fx")
    assert chosen == ["EUR/USD"] and rows(fl.select_tickers(df, chosen, market="fx")) == [("C:EURUSD",)]
    assert fl.configured_tickers(config, ("a",), None) is None


def test_chosen_tickers_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("C:EURUSD",), ("C:GBPUSD",)], "ticker string").write.parquet(path)
    out = fl.select_tickers(spark.read.parquet(path), "EUR-USD, JPY/USD", market="fx")
    assert [r.ticker for r in out.collect()] == ["C:EURUSD"]
    assert "In(ticker, [C:EURUSD,C:JPYUSD])" in out._jdf.queryExecution().toString()
