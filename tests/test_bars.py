import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators import bars as br
from tickloom.operators import ratings as rt

S = 10**9
DAY = 86400 * S


@pytest.fixture(scope="module")
def trades(spark):
    rng = random.Random(3)
    data = [
        (rng.choice("AAAB"), 19_700 * DAY + rng.randrange(5 * DAY), i, rng.randrange(100, 900) / 4, rng.randrange(1, 50))
        for i in range(4000)
    ]
    return spark.createDataFrame(
        data, "ticker string, sip_timestamp bigint, sequence_number bigint, price double, size bigint"
    )


def test_minutes_roll_up_to_hours(trades, rows):
    minutes = br.ohlcv_bars(trades, 1, "minute").withColumn(
        "hour", br.bar_start("window_start", 1, "hour")
    )
    rolled = minutes.groupBy("ticker", "hour").agg(
        F.min_by("open", "window_start"),
        F.max("high"),
        F.min("low"),
        F.max_by("close", "window_start"),
        F.sum("volume"),
        F.sum("transactions"),
    )
    hours = br.ohlcv_bars(trades, 1, "hour").drop("vwap")
    assert rows(rolled) == rows(hours)


def test_starts(spark):
    def start(text, *size):
        ns = F.unix_micros(F.lit(text).cast("timestamp")) * 1000
        got = spark.range(1).select(br.bar_start(ns, *size)).first()[0]
        return spark.range(1).select(F.timestamp_micros(F.lit(got // 1000)).cast("string")).first()[0]

    at = "2024-02-29 13:47:31"
    assert start(at, 30, "second") == "2024-02-29 13:47:30"
    assert start(at, 5, "minute") == "2024-02-29 13:45:00"
    assert start(at, 1, "day") == "2024-02-29 00:00:00"
    assert start(at, 1, "week") == "2024-02-26 00:00:00"
    assert start(at, 1, "month") == "2024-02-01 00:00:00"
    assert start("1969-12-30 05:00:00", 1, "week") == "1969-12-29 00:00:00"
    with pytest.raises(ValueError):
        br.bar_start("x", 2, "month")


def test_previous_day_is_strictly_before(spark, trades):
    days = br.ohlcv_bars(trades, 1, "day")
    as_of = date(1970, 1, 1) + timedelta(days=19_703)
    row = br.previous_day_bar(days, as_of.isoformat()).where("ticker = 'A'").first()
    assert row.window_start == 19_702 * DAY


def test_snapshot(trades):
    now = 19_703 * DAY + 12 * 3600 * S
    quotes = trades.withColumnRenamed("price", "bid_price").drop("size")
    snap = br.market_snapshot(trades, quotes, br.ohlcv_bars(trades, 1, "day"), now)
    for row in snap.collect():
        mine = sorted(
            tuple(t)
            for t in trades.where(f"ticker = '{row.ticker}'")
            .select("sip_timestamp", "sequence_number", "price", "size")
            .collect()
        )
        today = [t for t in mine if 19_703 * DAY <= t[0] <= now]
        before = [t for t in mine if t[0] < 19_703 * DAY]
        assert row.day.open == today[0][2] and row.day.close == today[-1][2]
        assert row["min"].accumulated_volume == sum(t[3] for t in today)
        assert row.prev_day.close == before[-1][2]
        assert row.last_trade.sip_timestamp == row.last_quote.sip_timestamp == today[-1][0]
        assert row.todays_change == today[-1][2] - before[-1][2]


def test_snapshot_without_quotes(trades):
    now = 19_703 * DAY + 12 * 3600 * S
    snap = br.market_snapshot(trades, None, br.ohlcv_bars(trades, 1, "day"), now)
    assert "last_quote" not in snap.columns and snap.count() == 2


def test_movers(spark):
    df = spark.createDataFrame(
        [("A", 5.0, 20000), ("B", -3.0, 20000), ("C", 9.0, 5), ("D", None, 20000), ("E", 5.0, 20000)],
        "ticker string, todays_change_percent double, volume bigint",
    )
    out = br.top_movers(df, "both", 2)
    got = [(r.direction, r.rank, r.ticker) for r in out.collect()]
    assert sorted(got) == [
        ("gainers", 1, "A"), ("gainers", 2, "E"), ("losers", 1, "B"), ("losers", 2, "A"),
    ]
    assert [r.ticker for r in br.top_movers(df, "gainers", 1, None).collect()] == ["C"]


def test_movers_read_their_input_once(spark, tmp_path):
    rng, path = random.Random(4), str(tmp_path / "changes")
    data = [(f"T{i:03d}", rng.choice([None, 0.0, rng.uniform(-9, 9), 5.0]), rng.randrange(20_000), i % 4) for i in range(400)]
    spark.createDataFrame(
        data, "ticker string, todays_change_percent double, volume bigint, day int"
    ).repartition(5).write.parquet(path)
    out = br.top_movers(spark.read.parquet(path), "both", 6, 10_000, by=("day",))
    want = set()
    for day in range(4):
        kept = [(p, t) for t, p, v, d in data if d == day and p is not None and v >= 10_000]
        for side, key in (("gainers", lambda r: (-r[0], r[1])), ("losers", lambda r: r)):
            want |= {(side, day, k, t) for k, (_, t) in enumerate(sorted(kept, key=key)[:6], 1)}
    assert {(r.direction, r.day, r.rank, r.ticker) for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and plan.count("WindowGroupLimit") == 2, plan


def test_rolling_accounts_against_brute_force(spark):
    rng = random.Random(9)
    first = date(2024, 1, 1)
    data = [
        (rng.choice("xy"), rng.randrange(40), first + timedelta(days=int(rng.random() ** 2 * 120)), 1.0)
        for _ in range(600)
    ]
    spend = spark.createDataFrame(data, "category string, account int, date date, amount double")
    active = defaultdict(set)
    for category, account, day, _ in data:
        active[category, day].add(account)
    for r in rt.rolling_accounts(spend).collect():
        for n in (8, 28):
            seen = set()
            for back in range(n):
                seen |= active.get((r.category, r.date - timedelta(days=back)), set())
            assert r[f"rolling_{n}_day_accounts"] == len(seen)
        assert r.total_accounts == len(active[r.category, r.date])


def test_consensus(spark):
    df = spark.createDataFrame(
        [("A", "buy", 10.0, "x"), ("A", "strong_buy", 20.0, "y"), ("A", "buy", None, "x"), ("B", "odd", 1.0, "z")],
        "ticker string, rating string, price_target double, analyst string",
    )
    out = {r.ticker: r for r in rt.consensus(df).collect()}
    assert (out["A"].buy_ratings, out["A"].strong_buy_ratings, out["A"].ratings_contributors) == (2, 1, 2)
    assert out["A"].consensus_rating == "buy" and out["A"].consensus_price_target == 15.0
    assert out["B"].consensus_rating is None and out["B"].ratings_contributors == 0


def test_coverage_gaps(spark, rows):
    d = date(2024, 1, 1)
    have = [("A", d), ("A", d + timedelta(days=4)), ("B", d)]
    df = spark.createDataFrame(have, "ticker string, day date")
    calendar = spark.createDataFrame([(d + timedelta(days=i),) for i in (0, 1, 3, 4, 5)], "date date")
    gaps = rt.coverage_gaps(df, calendar, "day", ["ticker"])
    assert rows(gaps.selectExpr("ticker", "CAST(date AS string)")) == [
        ("A", "2024-01-02"), ("A", "2024-01-04"),
    ]


def test_conversion(spark):
    quotes = spark.createDataFrame(
        [("C:EURUSD", 1, 1, 1.0, 1.2), ("C:EURUSD", 2, 2, 2.0, 2.2)],
        "ticker string, sip_timestamp bigint, sequence_number bigint, bid_price double, ask_price double",
    )
    amounts = spark.createDataFrame(
        [("EUR", "USD", 100.0), ("USD", "XXX", 1.0)], "from string, to string, initial_amount double"
    )
    out = {r["from"]: r for r in rt.convert(amounts, quotes).collect()}
    assert abs(out["EUR"].converted - 210.0) < 1e-9 and out["EUR"].last.timestamp == 2
    assert out["USD"].converted is None
