import random

import pytest

from tickloom.operators import quotes as qt

S = 10**9
QUOTE = "ticker string, sip_timestamp bigint, sequence_number bigint, bid_price double"


def quotes(spark, data):
    return spark.createDataFrame(data, QUOTE)


def test_minute_bars(spark, rows):
    df = quotes(
        spark,
        [("C", 60 * S, 1, 1.0), ("C", 90 * S, 2, 2.0), ("C", 100 * S, 3, 3.0), ("P", 95 * S, 4, 4.0)],
    )
    assert rows(qt.quote_bars(df, 60 * S), "ticker", "asof_timestamp", "sip_timestamp") == [
        ("C", 120 * S, 100 * S),
        ("C", 60 * S, 60 * S),
        ("P", 120 * S, 95 * S),
    ]


def test_equal_times_go_by_sequence(spark):
    df = quotes(spark, [("C", 5, 2, 1.0), ("C", 5, 10, 2.0), ("C", 5, 3, 9.0)])
    assert qt.quote_bars(df, 60).first().bid_price == 2.0


def test_null_sequence_ranks_highest(spark):
    df = quotes(spark, [("C", 5, 2, 1.0), ("C", 5, None, 2.0)])
    assert qt.quote_bars(df, 60).first().bid_price == 2.0


def test_same_file_twice_changes_nothing(spark, rows):
    df = quotes(spark, [("C", i * S, i, float(i)) for i in range(1, 200)]).selectExpr(
        "'2024-01-02' AS file_date", "*"
    )
    once = rows(qt.quote_bars(df, 60 * S, by_file_date=True))
    assert once == rows(qt.quote_bars(df.union(df), 60 * S, by_file_date=True))
    assert len(once) == 4


def test_futures_rename_and_venue(spark):
    df = spark.createDataFrame([("ES", 5, 1, 2.0)], "ticker string, timestamp bigint, sequence_number bigint, bid_price double")
    row = qt.quote_bars(df, 60, "future", venue="cme").first()
    assert (row.sip_timestamp, row.venue, row.asof_timestamp) == (5, "cme", 60)


@pytest.mark.parametrize(
    "times, expected",
    [
        ([150, 250, 350], [(200, 150), (300, 250), (400, 350)]),
        ([150], [(200, 150)]),
        ([120, 150, 180], [(200, 180)]),
        ([100, 200], [(200, 200)]),
        ([101, 400, 401], [(200, 101), (400, 400)]),
    ],
)
def test_fixed_grid_sampling(spark, rows, times, expected):
    df = quotes(spark, [("A", t, i, 1.0) for i, t in enumerate(times)])
    out = qt.sample_fixed(df, 200, 401, 100)
    assert rows(out, "asof_timestamp", "sip_timestamp") == expected


def _calendar(spark, sessions):
    return spark.createDataFrame(sessions, "day string, open_ns bigint, close_ns bigint").selectExpr(
        "CAST(day AS date) AS date", "open_ns", "close_ns"
    )


@pytest.mark.parametrize("step", [60, 300, 1800, 50_000])
def test_session_sampling_against_brute_force(spark, rows, step):
    rng = random.Random(step)
    day = 86400
    sessions = [("1970-01-02", day + 34200, day + 57600), ("1970-01-03", 2 * day + 1000, 2 * day + 9005)]
    calendar = _calendar(spark, [(d, o * S, c * S) for d, o, c in sessions])
    data = [
        (t, rng.randrange(day // 2, 3 * day) * S, i, rng.random())
        for t in "AB"
        for i in range(1500)
    ]
    # Times exactly on the grid and just after it.
    data += [("A", sessions[0][1] * S, 9001, 0.1), ("A", sessions[0][1] * S + 1, 9002, 0.2)]
    expected = []
    for _, start, close in sessions:
        for boundary in range(start * S, close * S, step * S):
            for ticker in "AB":
                inside = [
                    (q[1], q[2], q[3])
                    for q in data
                    if q[0] == ticker and boundary - step * S < q[1] <= boundary
                ]
                if inside:
                    expected.append((ticker, boundary, *max(inside)))
    out = qt.sample_at(quotes(spark, data), calendar, step * S)
    got = rows(out, "ticker", "asof_timestamp", "sip_timestamp", "sequence_number", "bid_price")
    assert got == sorted(expected, key=str)


def test_aligned_grid_equals_bars(spark, rows):
    day = 86400
    calendar = _calendar(spark, [("1970-01-02", day * S, 2 * day * S)])
    data = [("A", day * S + i * 7 * S, i, float(i)) for i in range(1, 5000)]
    sampled = qt.sample_at(quotes(spark, data), calendar, 600 * S)
    bars = qt.quote_bars(quotes(spark, data), 600 * S)
    columns = ("ticker", "asof_timestamp", "sequence_number")
    assert rows(sampled, *columns) == rows(bars, *columns)


def test_midnight_belongs_to_two_days(spark, rows):
    day = 86400 * S
    ticks = quotes(spark, [("A", day, 1, 1.0), ("A", day + 1, 2, 1.0), ("B", day, 3, 1.0)])
    windows = spark.createDataFrame(
        [("A", "1970-01-01"), ("A", "1970-01-02")], "ticker string, d string"
    ).selectExpr("ticker", "CAST(d AS date) AS snapshot_date")
    out = qt.ticks_in_windows(ticks, windows)
    assert rows(out.selectExpr("CAST(snapshot_date AS string)", "sequence_number")) == [
        ("1970-01-01", 1),
        ("1970-01-02", 1),
        ("1970-01-02", 2),
    ]


def test_latest_before(spark):
    df = quotes(spark, [("A", 500, 1, 1.0), ("A", 100, 2, 1.0), ("A", 1000, 3, 1.0), ("A", 1001, 4, 1.0)])
    assert qt.latest_before(df, 1000, 600).first().sequence_number == 3
    assert qt.latest_before(df, 450, 350).count() == 0


def test_contract_bars_follow_their_underlying(spark, rows):
    day = 86400
    calendar = _calendar(
        spark, [(f"1970-01-0{i + 1}", (i * day + 34200) * S, (i * day + 57600) * S) for i in (1, 2)]
    )
    data = [("O:A1", "A"), ("O:A2", "A"), ("O:B1", "B")]
    ticks = spark.createDataFrame(
        [(o, u, (i * day + 34200 + 90) * S, i, 1.0) for o, u in data for i in (1, 2)],
        "option_ticker string, underlying_ticker string, sip_timestamp bigint, "
        "sequence_number bigint, bid_price double",
    )
    windows = spark.createDataFrame(
        [("A", "1970-01-02"), ("B", "1970-01-09")], "ticker string, d string"
    ).selectExpr("ticker", "CAST(d AS date) AS snapshot_date")
    out = qt.bars_in_windows(
        ticks, windows, calendar, 60 * S, "option_ticker", "underlying_ticker"
    )
    boundary = (day + 34200 + 120) * S
    assert rows(out, "option_ticker", "asof_timestamp", "sequence_number") == [
        ("O:A1", boundary, 1),
        ("O:A2", boundary, 1),
    ]
