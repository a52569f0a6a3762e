import random

import pytest

from tickloom.operators.asof import asof_backward


def brute(left, right):
    out = []
    for key, t, row in left:
        best = max(
            ((r[1], r[2]) for r in right if r[0] == key and None not in (key, t, r[1]) and r[1] <= t),
            default=(None, None),
        )
        out.append((key, t, row, *best))
    return sorted(out, key=str)


def run(spark, left, right, rows, **options):
    lhs = spark.createDataFrame(left, "k string, t bigint, id bigint")
    rhs = spark.createDataFrame(right, "k string, t bigint, id bigint")
    out = asof_backward(lhs, rhs, "k", "t", "t", tie=("id",), prefix="r_", **options)
    return rows(out, "k", "t", "id", "r_t", "r_id")


def data(seed, n=400):
    """One hot key, half of its rows at a single time, and a few small keys."""
    rng = random.Random(seed)

    def side(offset):
        out = []
        for i in range(n):
            key = "hot" if rng.random() < 0.7 else rng.choice("abc")
            t = 500 if key == "hot" and rng.random() < 0.5 else rng.randrange(1000)
            out.append((key, t, offset + i))
        return out

    return side(0), side(10_000)


@pytest.mark.parametrize("seed", range(3))
def test_plain(spark, rows, seed):
    left, right = data(seed)
    assert run(spark, left, right, rows) == brute(left, right)


@pytest.mark.parametrize("bucket", [1, 3, 60, 500, 5000])
def test_keys_cut_by_time(spark, rows, bucket):
    left, right = data(11)
    assert run(spark, left, right, rows, bucket=bucket) == brute(left, right)


def test_hot_key_with_marks_only_at_the_start(spark, rows):
    left = [("hot", t, t) for t in range(300)]
    right = [("hot", 5, 1), ("hot", 5, 2), ("cold", 0, 3)]
    assert run(spark, left, right, rows, bucket=20) == brute(left, right)


def test_all_rows_at_one_time(spark, rows):
    left = [("hot", 7, i) for i in range(200)]
    right = [("hot", 7, 1000 + i) for i in range(200)]
    assert run(spark, left, right, rows, bucket=50) == brute(left, right)


def test_nothing_before(spark, rows):
    left = [("a", 5, 1), ("b", 9, 2), ("a", None, 3), (None, 4, 5), (None, None, 6)]
    right = [("a", 6, 7), (None, 1, 8), ("a", None, 9)]
    assert run(spark, left, right, rows) == brute(left, right)


@pytest.mark.parametrize("spread", [2, 7])
def test_left_rows_of_a_bucket_dealt_out(spark, rows, spread):
    left, right = data(5)
    assert run(spark, left, right, rows, bucket=300, spread=spread) == brute(left, right)
    left = [("hot", 7, i) for i in range(200)] + [("hot", 900, 300), (None, 1, 301)]
    right = [("hot", 6, 1000), ("hot", 7, 1001), ("hot", 8, 1002)]
    assert run(spark, left, right, rows, bucket=50, spread=spread) == brute(left, right)


def test_each_side_is_read_and_shuffled_once(spark, tmp_path):
    left, right = data(2)
    sides = []
    for name, part in (("left", left), ("right", right)):
        spark.createDataFrame(part, "k string, t bigint, id bigint").write.parquet(f"{tmp_path}/{name}")
        sides.append(spark.read.parquet(f"{tmp_path}/{name}"))
    out = asof_backward(*sides, "k", "t", "t", tie=("id",), prefix="r_")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # Marks and left rows once; left rows without key or time by a pushed filter.
    assert plan.count("FileScan") == 3
    assert plan.count("ReusedExchange") == 1 and plan.count("REPARTITION_BY_COL") == 2
