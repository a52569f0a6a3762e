from pyspark.sql import functions as F

from tickloom.operators import universe as un
from tickloom.sources.sinks import order_output
from tickloom.streaming import incremental as inc


def test_both_passes(spark, rows):
    gone = spark.createDataFrame([("B", 1.0), ("A", 2.0)], "ticker string, strike double")
    live = spark.createDataFrame([("C", 3.0), ("A", 9.0)], "ticker string, strike double")
    out = un.union_both(gone, live, "expired", "ticker")
    assert [tuple(r) for r in out.select("ticker", "strike", "expired").collect()] == [
        ("A", 2.0, True), ("B", 1.0, True), ("C", 3.0, False),
    ]


def test_own_flag_is_kept(spark):
    gone = spark.createDataFrame([("A", False)], "ticker string, expired boolean")
    live = spark.createDataFrame([("B", None)], "ticker string, expired boolean")
    out = {r.ticker: r.expired for r in un.union_both(gone, live, "expired", "ticker").collect()}
    assert out == {"A": False, "B": False}


def test_dedupe_first_and_last(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, {"x": "1"}), ("a", 2, {"x": "2"}), ("b", 5, None)], "k string, n int, m map<string,string>"
    )
    assert rows(un.dedupe(df, ["k"], ["n"], "first"), "k", "n") == [("a", 1), ("b", 5)]
    last = un.dedupe(df, ["k"], ["n"], "last")
    assert last.columns == ["k", "n", "m"]
    assert rows(last, "k", "n") == [("a", 2), ("b", 5)]


def test_dedupe_context(spark):
    df = spark.createDataFrame([(1, 1), (2, 2)], "i int, v int").select(
        F.when(F.col("i") == 1, F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")))
        .otherwise(F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1")))
        .alias("context"),
        "v",
    )
    assert [r.v for r in un.dedupe_context(df, "context", ["v"]).collect()] == [2]


def test_upsert(spark, rows):
    old = spark.createDataFrame([("a", 1, "old"), ("b", 9, "old")], "k string, t int, v string")
    new = spark.createDataFrame([("a", 1, "new"), ("b", 3, "new"), ("c", 1, "new")], "k string, t int, v string")
    assert rows(un.upsert(old, new, ["k"], ["t"]), "k", "v") == [
        ("a", "new"), ("b", "old"), ("c", "new"),
    ]


def test_markets_and_difference(spark, rows):
    a = spark.createDataFrame([("X", 1)], "ticker string, n int")
    b = spark.createDataFrame([("Y",), ("X",)], "ticker string")
    assert rows(un.all_assets({"stocks": a, "fx": b}).select("market", "ticker", "n")) == [
        ("fx", "X", None), ("fx", "Y", None), ("stocks", "X", 1),
    ]
    assert rows(un.missing(b, a, ["ticker"])) == [("Y",)]


def test_order_puts_null_text_first(spark):
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", 3)], "k string, n int")
    assert [r.n for r in order_output(df, "k").collect()] == [2, 3, 1]


def test_bookmarks(spark, rows):
    marks = spark.createDataFrame([("a", 5), ("b", 7)], "k string, bookmark bigint")
    batch = spark.createDataFrame([("a", 9), ("b", 1), ("c", 2)], "k string, t bigint")
    assert rows(inc.advance(marks, batch, ["k"], "t")) == [("a", 9), ("b", 7), ("c", 2)]


def test_adjusted_ranges(spark, rows):
    df = spark.createDataFrame(
        [(1, 0, 100, None), (2, 0, 100, 40), (3, 0, 100, 95), (4, 0, 100, 100), (5, 50, 100, 10)],
        "i int, start_ns bigint, end_ns bigint, bookmark bigint",
    )
    assert rows(inc.adjust(df, 10), "i", "start_ns") == [(1, 0), (2, 50), (5, 50)]


def test_starting_point(spark):
    df = spark.createDataFrame([(1, 5, None), (None, None, None)], "a int, b int, c int")
    got = df.select(inc.starting_point(*[F.col(x) for x in "abc"]).alias("s")).collect()
    assert [r.s for r in got] == [5, None]
