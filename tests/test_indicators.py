import math
import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import indicators as ind

DAY = 86_400 * 10**9


@pytest.fixture(scope="module")
def series():
    """A long ticker with gaps, one as long as a window, one of a single bar."""
    rng = random.Random(5)
    out, price = [], 100.0
    time = 0
    for _ in range(3000):
        price = max(1.0, price + rng.uniform(-3, 3))
        time += DAY * rng.choice([1, 1, 1, 3, 40])
        out.append(("LONG", time, round(price, 2)))
    out += [("MID", DAY * i, float(i % 4)) for i in range(19)]
    out.append(("ONE", DAY, 7.0))
    return out


@pytest.fixture(scope="module")
def bars(spark, series):
    return spark.createDataFrame(series, "ticker string, window_start bigint, close double").repartition(5)


def by_ticker(series):
    out = {}
    for ticker, time, close in sorted(series):
        out.setdefault(ticker, []).append((time, close))
    return out


def ema_of(xs, n):
    a, out = 2 / (n + 1), []
    for x in xs:
        out.append(x if not out else a * x + (1 - a) * out[-1])
    return out


def check(df, expected, column="value"):
    got = {(r.ticker, r.window_start): r[column] for r in df.collect()}
    assert got.keys() == expected.keys()
    for key, value in expected.items():
        assert math.isclose(got[key], value, rel_tol=1e-9, abs_tol=1e-9), (key, got[key], value)


@pytest.mark.parametrize("block", [None, 40])
def test_sma(bars, series, block):
    expected = {}
    for ticker, points in by_ticker(series).items():
        for i in range(9, len(points)):
            expected[ticker, points[i][0]] = sum(c for _, c in points[i - 9 : i + 1]) / 10
    check(ind.sma(bars, 10, interval_ns=DAY, block=block), expected)


@pytest.mark.parametrize("window, block", [(10, None), (10, 300), (2, None), (1, None), (50, 1300), (10_000, None), (50, 1)])
def test_ema(bars, series, window, block):
    expected = {}
    for ticker, points in by_ticker(series).items():
        values = ema_of([c for _, c in points], window)
        expected.update({(ticker, t): v for (t, _), v in zip(points, values)})
    check(ind.ema(bars, window, interval_ns=DAY, block=block), expected)


@pytest.mark.parametrize("windows, block", [((12, 26, 9), None), ((12, 26, 9), 700), ((2, 200, 2), None), ((12, 6000, 9), None), ((9, 26, 9), 5)])
def test_macd(bars, series, windows, block):
    short, long, signal = windows
    value, sig = {}, {}
    for ticker, points in by_ticker(series).items():
        xs = [c for _, c in points]
        line = [a - b for a, b in zip(ema_of(xs, short), ema_of(xs, long))]
        for (t, _), v, s in zip(points, line, ema_of(line, signal)):
            value[ticker, t], sig[ticker, t] = v, s
    out = ind.macd(bars, short, long, signal, interval_ns=DAY, block=block)
    check(out, value)
    check(out, sig, "signal")
    check(out, {k: value[k] - sig[k] for k in value}, "histogram")


def rsi_of(series, n):
    expected = {}
    for ticker, points in by_ticker(series).items():
        xs = [c for _, c in points]
        gains = [max(b - a, 0) for a, b in zip(xs, xs[1:])]
        losses = [max(a - b, 0) for a, b in zip(xs, xs[1:])]
        if len(gains) < n:
            continue
        g, l = sum(gains[:n]) / n, sum(losses[:n]) / n
        for i in range(n, len(xs)):
            if i > n:
                g, l = (g * (n - 1) + gains[i - 1]) / n, (l * (n - 1) + losses[i - 1]) / n
            expected[ticker, points[i][0]] = 100.0 if l == 0 else 100 - 100 / (1 + g / l)
    return expected


@pytest.mark.parametrize("n, block", [(18, None), (18, 900), (18, 7), (1, None), (1, 5), (2900, None)])
def test_rsi(bars, series, n, block):
    expected = rsi_of(series, n)
    check(ind.rsi(bars, n, interval_ns=DAY, block=block), expected)


def test_rsi_keeps_its_history_on_flat_prices(spark):
    """Gains and losses fade alike, so a flat stretch does not move their ratio."""
    rng, price, points = random.Random(2), 100.0, []
    for i in range(12_000):
        price = max(1.0, price + rng.choice([-1, 1])) if i < 8000 else price
        points.append(("T", DAY * i, price))
    flat = spark.createDataFrame(points, "ticker string, window_start bigint, close double")
    check(ind.rsi(flat, 18, interval_ns=DAY), rsi_of(points, 18))


def test_shapes_are_checked(bars):
    for build in (
        lambda: ind.ema(bars, 2, interval_ns=DAY, block=4096),
        lambda: ind.rsi(bars, 18, interval_ns=DAY, block=0),
        lambda: ind.ema(bars, 0, interval_ns=DAY),
    ):
        with pytest.raises(ValueError):
            build()
    with pytest.raises(TypeError):
        ind.ema(bars, 2)


def test_the_input_is_read_once(spark, tmp_path, series):
    frame = spark.createDataFrame(series, "ticker string, window_start bigint, close double")
    frame.write.parquet(str(tmp_path / "bars"))
    stored = spark.read.parquet(str(tmp_path / "bars"))
    for out in (ind.ema(stored, interval_ns=DAY), ind.macd(stored, interval_ns=DAY), ind.rsi(stored, interval_ns=DAY),
                ind.sma(stored, interval_ns=DAY), ind.with_change(stored, interval_ns=DAY)):
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("FileScan") == 1, plan


def test_change(bars, series):
    expected = {}
    for ticker, points in by_ticker(series).items():
        for (_, a), (t, b) in zip(points, points[1:]):
            expected[ticker, t] = b - a
    out = ind.with_change(bars, interval_ns=DAY, block=13)
    assert out.where("todays_change IS NULL").count() == 3
    check(out.where("todays_change IS NOT NULL"), expected, "todays_change")


def test_table_form(bars):
    out = ind.indicator_table(ind.macd(bars, interval_ns=DAY), "stock_macd", "day", 12)
    row = out.where("ticker = 'ONE'").first()
    assert row.series_window_timespan == "close_day_12" and row.underlying_close == 7.0
    assert row.signal == 0.0 and row.timestamp == row.underlying_timestamp


def test_states_come_through_nodes_branches_and_the_root(spark):
    """One bar a block: 9,000 blocks of a ticker make 141 nodes and three branches; gaps leave some out."""
    rng, price, time, points = random.Random(8), 100.0, 0, []
    for i in range(9000):
        price = max(1.0, price + rng.uniform(-1, 1))
        time += DAY * (5000 if i % 3000 == 2999 else 1)
        points.append(("T", time, round(price, 2)))
    table = spark.createDataFrame(points, "ticker string, window_start bigint, close double").repartition(7)
    values = ema_of([c for *_, c in points], 10)
    check(ind.ema(table, 10, interval_ns=DAY, block=1), {("T", t): v for (_, t, _), v in zip(points, values)})
    check(ind.rsi(table, 18, interval_ns=DAY, block=1), rsi_of(points, 18))


def test_no_row_holds_more_than_a_node(spark):
    """Lists of summaries grow to 63, however many blocks a ticker has."""
    from tickloom.operators import skew

    rows = spark.range(20_000).selectExpr("'T' AS ticker", "id AS place", "named_struct('n', 1L) AS _s")
    sizes = []
    real = skew._folded

    def watched(summaries, combine):
        sizes.append(summaries)
        return real(summaries, combine)

    skew._folded = watched
    try:
        found = skew.combined_before(
            rows, "ticker", "place", lambda a, b: F.struct((a["n"] + b["n"]).alias("n"))
        )
    finally:
        skew._folded = real
    assert len(sizes) == 3  # of a node, of a branch, of the root
    got = found.select("place", F.coalesce("_before.n", F.lit(0)).alias("n"))
    assert got.where("n <> place").count() == 0 and got.count() == 20_000


def test_blocks_query_reads_its_trades_once(spark, tmp_path):
    """What the bars hold beside their close is neither shuffled nor a reason to read them twice."""
    from tickloom.plans import QUERIES

    rng, trades, points = random.Random(3), [], []
    for supplier in (1, 2):
        for day in range(80):
            price = round(100 + rng.uniform(-5, 5), 2)
            trades.append((supplier * 1000 + day, 1, supplier, 3.0, price, 9000 + 3 * day))
            points.append((f"S{supplier}", DAY * (9000 + 3 * day), price))
    table = spark.createDataFrame(
        trades, "l_orderkey bigint, l_linenumber int, l_suppkey bigint, l_quantity double, l_extendedprice double, day int"
    )
    table = table.withColumn("l_shipdate", F.date_from_unix_date("day").cast("timestamp_ntz")).drop("day")
    table.write.parquet(str(tmp_path / "lineitem.parquet"))
    out = QUERIES["win04_rsi_blocks"](spark, str(tmp_path))
    expected = rsi_of(points, 18)
    got = {(r.ticker, r.window_start): r.value for r in out.collect()}
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[k], expected[k], abs_tol=2e-6) for k in expected)
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1, plan


def test_a_list_is_combined_in_one_pass(spark):
    from tickloom.operators import skew

    lists = spark.sql("SELECT array(1, 2, 3, 4) AS s UNION ALL SELECT array(7) UNION ALL SELECT array()")
    got = lists.select(skew._folded(F.col("s"), lambda a, b: a * 10 + b).alias("f")).collect()
    assert sorted(r.f for r in got) == [[], [1, 12, 123, 1234], [7]]


@pytest.mark.parametrize("block", [None, 7])
def test_more_than_one_branch_of_many_bars(spark, monkeypatch, block):
    """Branches of few rows: positions, states and first changes come over their ends."""
    from tickloom.operators import skew

    monkeypatch.setattr(skew, "BRANCH_ROWS", 32)
    rng, price, points = random.Random(6), 100.0, []
    for i in range(700):
        price = max(1.0, price + rng.uniform(-1, 1))
        points.append(("T", DAY * (i + 9000 * (i // 300)), round(price, 2)))
    table = spark.createDataFrame(points, "ticker string, window_start bigint, close double").repartition(3)
    check(ind.rsi(table, 40, interval_ns=DAY, block=block), rsi_of(points, 40))
    values = ema_of([c for *_, c in points], 10)
    check(ind.ema(table, 10, interval_ns=DAY, block=block), {("T", t): v for (_, t, _), v in zip(points, values)})
