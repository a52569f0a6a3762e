from pyspark.sql import functions as F

from tickloom.functions import floor_div
from tickloom.operators import quotes as qt
from tickloom.streaming import quote_bars as sq

S = 10**9
FIELDS = ["sip_timestamp", "sequence_number", "bid_price"]
SCHEMA = "ticker string, sip_timestamp bigint, sequence_number bigint, bid_price double"


def drop(spark, folder, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_stream_equals_batch_and_restarts(spark, tmp_path, rows):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    first = [("A", i * 20 * S, i, float(i)) for i in range(1, 60)]
    second = [("A", i * 20 * S, i, float(i)) for i in range(60, 200)] + [("B", 3990 * S, 1, 1.0)]
    for data in (first, second, []):
        if data:
            drop(spark, source, data)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        bars = sq.stream_quote_bars(stream, 60 * S, "1 minute", FIELDS)
        sq.run_available(bars, out, check)
    got = spark.read.parquet(out)
    batch = qt.quote_bars(spark.createDataFrame(first + second, SCHEMA), 60 * S)
    closed = batch.where(F.col("asof_timestamp") <= 4020 * S - 60 * S)
    columns = ("ticker", "asof_timestamp", "sequence_number", "bid_price")
    assert rows(got, *columns) == rows(closed, *columns)


def test_exact_boundary_stays_in_its_bucket(spark, tmp_path, rows):
    source = str(tmp_path / "in")
    drop(spark, source, [("A", 60 * S, 1, 1.0), ("A", 60 * S + 1, 2, 2.0), ("A", 900 * S, 3, 3.0)])
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    out = sq.collect_stream(sq.stream_quote_bars(stream, 60 * S, "1 minute", FIELDS), "bars")
    assert rows(out, "asof_timestamp", "sequence_number") == [(120 * S, 2), (60 * S, 1)]


def test_copies_are_dropped(spark, tmp_path):
    source = str(tmp_path / "in")
    data = [("A", i * S, i % 10, float(i % 10)) for i in range(50)]
    drop(spark, source, data)
    stream = spark.readStream.schema(SCHEMA).parquet(source).withColumn(
        "ts", F.timestamp_micros(floor_div(F.col("sip_timestamp"), 1000))
    )
    out = sq.collect_stream(sq.dedupe_stream(stream, ["sequence_number"], "ts", "1 hour"), "once")
    assert out.count() == 10


def test_declared_ends_close_bars_from_state(spark, tmp_path, rows):
    """Day by day: what a run leaves open comes out when its day is declared over, once."""
    source, out, check, ends = (str(tmp_path / n) for n in ("in", "out", "check", "ends"))
    days = [[(t, (1000 * d + i * 25) * S, i, float(i)) for i in range(1, 30) for t in ("A", "B")] for d in range(3)]
    days[1].append((None, 1500 * S, 7, 7.0))
    columns = ("ticker", "asof_timestamp", "sequence_number", "bid_price")

    def run():
        quotes = spark.readStream.schema(SCHEMA).parquet(source)
        bars = sq.stream_quote_bars(quotes, 60 * S, "10 minutes", FIELDS, ends=sq.read_ends(spark, ends))
        sq.run_available(bars, out, check)
        return rows(spark.read.schema(bars.schema).parquet(out), *columns)

    seen = []
    for d, day in enumerate(days):
        drop(spark, source, day)
        seen += day
        batch = rows(qt.quote_bars(spark.createDataFrame(seen, SCHEMA), 60 * S), *columns)
        assert len(run()) < len(batch)
        sq.declare_end(spark, ends, (1000 * d + 780) * S)
        assert run() == batch
        assert run() == batch  # a restart with nothing new
    state = spark.read.format("statestore").load(check)
    assert state.count() <= 3  # no quote is kept, only marks
