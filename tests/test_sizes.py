import pytest
from pyspark.sql import functions as F

from tickloom.operators.sizes import by_date, on_dates
from tickloom.operators import filters as fl
from tickloom.operators import quotes as qt
from tickloom.operators.calendar import earnings_windows


def test_dates_are_bounded(spark):
    rows = spark.createDataFrame([("2024-01-02", 1), ("2024-01-02", 2), ("2024-01-03", 3)], "d string, n int")
    assert sorted(tuple(r) for r in by_date(rows, "d").collect()) == [
        ("2024-01-02", 1), ("2024-01-02", 2), ("2024-01-03", 3),
    ]
    crowded = spark.range(9).select(F.lit("2024-01-02").alias("d"), "id")
    with pytest.raises(Exception, match="too many rows of date 2024-01-02"):
        by_date(crowded, "d").collect()


def test_other_dates_are_not_opened(spark, tmp_path, plan_nodes):
    """The scan's own metrics: one file of five is read."""
    path = str(tmp_path / "ticks")
    rows = spark.range(50).selectExpr("date_add(DATE'2024-01-01', cast(id % 5 as int)) as file_date", "id")
    rows.repartition("file_date").write.partitionBy("file_date").parquet(path)
    wanted = spark.createDataFrame([("2024-01-03",), (None,)], "day string")
    out = on_dates(spark.read.parquet(path), "file_date", wanted.selectExpr("cast(day as date) as day"), "day")
    out = out.select("id")
    assert len(out.collect()) == 10
    assert _files_read(plan_nodes(out), "/ticks") == 1


def _scans(nodes, folder):
    found = [n for n in nodes["FileSourceScanExec"] if folder in str(n.relation().location().rootPaths())]
    return found


def _files_read(nodes, folder):
    (scan,) = _scans(nodes, folder)
    return scan.metrics().apply("numFiles").value()


DAY = 86_400 * 10**9


@pytest.fixture
def market(spark, tmp_path):
    """Ten days of ticks a file each, a calendar of them, earnings on the third day."""
    day = "date_add(DATE'2024-01-01', cast(id as int))"
    at = "(unix_date(day) * 86400L + 50400) * 1000000000L"
    days = spark.range(10).selectExpr(f"{day} AS date").selectExpr("*", *[
        f"{at.replace('day', 'date')} + {hours} * 3600000000000L AS {name}" for name, hours in (("open_ns", 0), ("close_ns", 6))
    ])
    ticks = spark.range(10).selectExpr(f"{day} AS day", "explode(array('A', 'B', null)) AS ticker").selectExpr(
        "day AS file_date", "ticker", f"{at} + 60 AS sip_timestamp", "1L AS sequence_number", "1.5D AS price"
    )
    earnings = spark.createDataFrame(
        [("A", "2024-01-03"), ("A", "2024-01-03"), (None, "2024-01-08"), ("B", None)], "ticker string, date string"
    ).selectExpr("ticker", "cast(date AS date) AS date")
    ticks.repartition("file_date").write.partitionBy("file_date").parquet(str(tmp_path / "ticks"))
    days.coalesce(1).write.parquet(str(tmp_path / "days"))
    earnings.coalesce(1).write.parquet(str(tmp_path / "earnings"))
    return [spark.read.parquet(str(tmp_path / name)) for name in ("ticks", "days", "earnings")]


@pytest.mark.parametrize(
    "operator, files",
    [
        (lambda ticks, windows, days: fl.filter_earnings(ticks, windows), 3),
        (lambda ticks, windows, days: qt.ticks_in_windows(ticks, windows), 5),
        (lambda ticks, windows, days: qt.bars_in_windows(ticks, windows, days, 3600 * 10**9), 5),
    ],
)
def test_windows_are_computed_once_and_prune(spark, market, plan_nodes, rows, operator, files):
    """Files of the windows' dates (and, for ticks, of their neighbours) are opened; the
    earnings are read once and the other use of the windows takes that shuffle."""
    ticks, days, earnings = market
    windows = earnings_windows(earnings, days)
    out = operator(ticks, windows, days).select("ticker", "sip_timestamp")
    got = out.collect()
    assert [r.ticker for r in got] == ["A"] * 3
    nodes = plan_nodes(out)
    assert _files_read(nodes, "/ticks") == files
    assert len(_scans(nodes, "/earnings")) == 1
    assert len(nodes["ReusedExchangeExec"]) >= 1


def test_sampling_opens_the_sessions_files_only(spark, market, plan_nodes):
    ticks, days, _ = market
    out = qt.sample_at(ticks, days.where("date = DATE'2024-01-05'"), 3600 * 10**9)
    assert len(out.collect()) == 3
    assert _files_read(plan_nodes(out), "/ticks") == 3
