import gzip

import pytest
from pyspark.sql import functions as F

from tickloom.operators import quotes as qt
from tickloom.session import scratch_path
from tickloom.sources import flat_files as ff
from tickloom.sources import sinks
from tickloom.specs import TABLES
from tickloom.specs.base import TableSpec
from tickloom.streaming import quote_bars as sq

SCHEMA = "file_date string, ticker string, volume bigint, otc boolean, vwap double"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "bars_2024-01-02.csv").write_text("vwap,ticker,volume,otc\n1.5,A,12.9,TRUE\n,B,x,\n")
    with gzip.open(tmp_path / "2024-01-03.csv.gz", "wt") as f:
        f.write("vwap,ticker,volume,otc\n2.5,A,1e3,no\n")
    (tmp_path / "undated.csv").write_text("vwap,ticker,volume,otc\n9,Z,9,1\n")
    (tmp_path / "notes_2024-01-03.txt").write_text("not a csv\n")
    return str(tmp_path)


def test_scan_coerces_by_header_name(spark, folder, rows):
    assert rows(ff.scan_flat_files(spark, folder, SCHEMA)) == [
        ("2024-01-02", "A", 12, True, 1.5),
        ("2024-01-02", "B", None, None, None),
        ("2024-01-03", "A", 1000, False, 2.5),
    ]


def test_dates_prune_files(spark, folder):
    df = ff.scan_flat_files(spark, folder, SCHEMA, start="2024-01-01", bookmark="2024-01-03")
    assert [r.file_date for r in df.collect()] == ["2024-01-03"]
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == 1


def test_partition_folders_give_the_date(spark, tmp_path):
    path = str(tmp_path / "dated")
    df = spark.createDataFrame([("2024-01-02", "A"), ("2024-01-03", "B")], "file_date string, ticker string")
    df.write.partitionBy("file_date").option("header", True).csv(path)
    out = ff.scan_flat_files(spark, path, "file_date string, ticker string", end="2024-01-02")
    assert [tuple(r) for r in out.collect()] == [("2024-01-02", "A")]


def test_strict_scan_fails_on_a_bad_value(spark, tmp_path):
    header = "ticker,ask_exchange,ask_price,ask_size,bid_exchange,bid_price,bid_size,sequence_number,sip_timestamp\n"
    good = tmp_path / "q_2024-01-02.csv"
    good.write_text(header + "O:A,1,1.5,10,1,1.4,10,7,60000000000\n")
    out = ff.scan_quotes(spark, str(good), qt.QUOTE_ASSETS["option"].csv).collect()
    assert out[0].file_date == "2024-01-02" and out[0].file_path.endswith("q_2024-01-02.csv")
    bad = tmp_path / "q_2024-01-03.csv"
    bad.write_text(header + "O:A,1,oops,10,1,1.4,10,7,60000000000\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        ff.scan_quotes(spark, str(bad), qt.QUOTE_ASSETS["option"].csv).collect()


def test_strict_scan_names_missing_columns(spark, tmp_path):
    path = tmp_path / "q_2024-01-02.csv"
    path.write_text("ticker\nA\n")
    with pytest.raises(ValueError, match="ask_price"):
        ff.scan_quotes(spark, str(path), qt.QUOTE_ASSETS["option"].csv)


def test_stream_resumes_at_its_checkpoint(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    (source / "a_2024-01-02.csv").write_text("ticker,volume\nA,1\n")
    for day, expected in (("2024-01-03", 2), ("2024-01-04", 3)):
        (source / f"a_{day}.csv").write_text("ticker,volume\nB,2\n")
        stream = ff.stream_flat_files(spark, str(source), "file_date string, ticker string, volume bigint")
        sq.run_available(stream, out, check)
        assert spark.read.parquet(out).count() == expected


def test_sink_is_idempotent(spark, rows):
    spec = TableSpec("t", "file_date date, ticker string, n bigint", ("file_date", "ticker"), "file_date")
    df = spark.createDataFrame(
        [("2024-01-02", "A", 1), ("2024-01-02", "A", 2), ("2024-01-03", "B", 3)],
        "file_date string, ticker string, n bigint",
    ).withColumn("file_date", F.to_date("file_date"))
    path = scratch_path(spark, "sink")
    sinks.write_table(df, spec, path, order=("n",))
    sinks.write_table(df.where("ticker = 'A'"), spec, path, order=("n",))
    assert rows(spark.read.parquet(path), "ticker", "n") == [("A", 2), ("B", 3)]
    part = spark.createDataFrame([("2024-01-02", "C", 9)], "file_date string, ticker string, n bigint")
    sinks.write_table(part.withColumn("file_date", F.to_date("file_date")), spec, path)
    assert rows(spark.read.parquet(path), "ticker", "n") == [("A", 2), ("B", 3), ("C", 9)]
    with pytest.raises(ValueError):
        sinks.write_table(df.drop("ticker"), spec, path)


def test_venues_keep_earlier_batches(spark, rows):
    schema = "venue string, file_date string, ticker string, sip_timestamp bigint, sequence_number bigint"
    first = spark.createDataFrame([("cme", "2024-01-02", "A", i, i) for i in range(10)], schema)
    later = spark.createDataFrame([("cme", "2024-01-03", "A", 99, 99)], schema)
    path = scratch_path(spark, "venues")
    for batch in (first, later, later, first.limit(1)):
        sinks.write_by_venue(batch, path)
    assert spark.read.parquet(path).count() == 11


def test_declared_flat_file(spark, tmp_path):
    path = tmp_path / "2024-01-02.csv"
    path.write_text(
        "ticker,volume,open,close,high,low,window_start,transactions\nA,1,2,3,4,1,1704153600000000000,5\n"
    )
    row = ff.scan_flat_files(spark, str(tmp_path), TABLES["stocks_flat_files_eod"].schema).first()
    assert (row.open, row.close, row.transactions, row.vwap, row.otc) == (2.0, 3.0, 5, None, None)


@pytest.fixture
def mixed(tmp_path):
    """Files of three column orders, one without a column, in a folder with a space."""
    folder = tmp_path / "of many"
    folder.mkdir()
    (folder / "a_2024-01-02.csv").write_text("vwap,ticker,volume,otc\n1.5,A,12,TRUE\n")
    with gzip.open(folder / "a_2024-01-03.csv.gz", "wt") as f:
        f.write("ticker,otc,volume,vwap\nB,no,3,2.5\nC,no,4,3.5\n")
    (folder / "a_2024-01-04.csv").write_text('\ufeffvolume,"ticker"\n5,D\n')
    (folder / "a_2024-01-05.csv").write_text("volume,ticker\n6,E\n")
    (folder / "a_2024-01-06.csv").write_text("")
    return str(folder)


def test_files_are_read_by_their_own_header(spark, mixed, rows):
    assert rows(ff.scan_flat_files(spark, mixed, SCHEMA)) == [
        ("2024-01-02", "A", 12, True, 1.5),
        ("2024-01-03", "B", 3, False, 2.5),
        ("2024-01-03", "C", 4, False, 3.5),
        ("2024-01-04", "D", 5, None, None),
        ("2024-01-05", "E", 6, None, None),
    ]
    groups = ff.header_groups(spark, mixed)
    assert sorted(len(files) for files in groups.values()) == [1, 1, 2]


def test_headers_of_dates_left_out_are_not_read(spark, mixed, rows):
    groups = ff.header_groups(spark, mixed, start="2024-01-03", end="2024-01-03")
    assert list(groups) == [("ticker", "otc", "volume", "vwap")]
    assert [r[1] for r in rows(ff.scan_flat_files(spark, mixed, SCHEMA, bookmark="2024-01-04"))] == ["D", "E"]
    assert ff.scan_flat_files(spark, mixed, SCHEMA, start="2025-01-01").collect() == []


def test_a_header_line_costs_no_full_read(spark, tmp_path):
    """The task ends at its first line end, far before the whole file is unpacked."""
    import time

    path = tmp_path / "a_2024-01-02.csv.gz"
    with gzip.open(path, "wt", compresslevel=1) as f:
        f.write("ticker,volume\n")
        for k in range(4_000_000):
            f.write(f"T{k},{k}\n")
    ff.header_groups(spark, str(path))
    start = time.perf_counter()
    assert list(ff.header_groups(spark, str(path))) == [("ticker", "volume")]
    took = time.perf_counter() - start
    start = time.perf_counter()
    assert spark.read.text(str(path)).selectExpr("max(sha2(value, 512))").first()
    assert took < time.perf_counter() - start


def test_quotes_of_two_orders_and_dates(spark, tmp_path):
    names = ["ticker", "ask_exchange", "ask_price", "ask_size", "bid_exchange", "bid_price", "bid_size", "sequence_number", "sip_timestamp"]
    values = ["O:A", "1", "1.5", "10", "1", "1.4", "10", "7", "60000000000"]
    for day, step in (("2024-01-02", 1), ("2024-01-03", -1), ("2024-01-04", 1)):
        (tmp_path / f"q_{day}.csv").write_text(",".join(names[::step]) + "\n" + ",".join(values[::step]) + "\n")
    kind = qt.QUOTE_ASSETS["option"].csv
    got = ff.scan_quotes(spark, str(tmp_path), kind).collect()
    assert sorted(r.file_date for r in got) == ["2024-01-02", "2024-01-03", "2024-01-04"]
    assert {(r.ticker, r.ask_price, r.sip_timestamp) for r in got} == {("O:A", 1.5, 60_000_000_000)}
    assert {r.file_date for r in ff.scan_quotes(spark, str(tmp_path), kind, bookmark="2024-01-03", end="2024-01-03").collect()} == {"2024-01-03"}
    one = ff.scan_quotes(spark, str(tmp_path), kind, end="2024-01-02", header=names)
    assert [r.file_date for r in one.collect()] == ["2024-01-02"]
