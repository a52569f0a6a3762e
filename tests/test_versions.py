"""Versioned upserts: killed runs, replays, concurrent writers, bookmarks."""

import pytest

from tickloom.session import scratch_path
from tickloom.sources import flat_files as ff
from tickloom.sources import versions as vs
from tickloom.specs.base import TableSpec

SPEC = TableSpec("t", "file_date string, ticker string, n bigint", ("file_date", "ticker"), "file_date")


@pytest.fixture
def path(spark):
    return scratch_path(spark, "versions")


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SPEC.schema)


def stored(spark, path, rows):
    return rows(vs.read_version(spark, path, SPEC.schema))


def test_upsert_and_replay(spark, path, rows):
    assert stored(spark, path, rows) == []
    vs.upsert_version(batch(spark, ("2024-01-02", "A", 1), ("2024-01-02", "A", 2), ("2024-01-03", "B", 3)), SPEC, path, order=("n",), writer="w")
    assert stored(spark, path, rows) == [("2024-01-02", "A", 2), ("2024-01-03", "B", 3)]
    vs.upsert_version(batch(spark, ("2024-01-02", "A", 9)), SPEC, path, writer="w", batch_id=0)
    assert vs.latest(spark, path).number == 1
    vs.upsert_version(batch(spark, ("2024-01-02", "C", 4), (None, "N", 5)), SPEC, path, writer="w", batch_id=1)
    assert stored(spark, path, rows) == [("2024-01-02", "A", 2), ("2024-01-02", "C", 4), ("2024-01-03", "B", 3), (None, "N", 5)]
    vs.upsert_version(batch(spark), SPEC, path)
    assert len(stored(spark, path, rows)) == 4 and vs.latest(spark, path).number == 3
    old = vs.read_version(spark, path, SPEC.schema, vs.latest(spark, path, 1))
    assert rows(old) == [("2024-01-02", "A", 2), ("2024-01-03", "B", 3)]
    with pytest.raises(ValueError, match="keyed"):
        vs.upsert_version(batch(spark).drop("ticker"), SPEC, path)


def test_a_run_killed_between_folders_changes_nothing(spark, path, rows, monkeypatch):
    vs.upsert_version(batch(spark, ("2024-01-02", "A", 1), ("2024-01-03", "B", 1)), SPEC, path, writer="w")
    before = stored(spark, path, rows)
    new = batch(spark, ("2024-01-02", "A", 2), ("2024-01-03", "B", 2))
    real = vs.replace_folders

    def killed(df, target, folders, order):
        real(df.where("file_date = '2024-01-02'"), target, folders, order)
        raise RuntimeError("killed")

    monkeypatch.setattr(vs, "replace_folders", killed)
    with pytest.raises(RuntimeError):
        vs.upsert_version(new, SPEC, path, writer="w", batch_id=1)
    assert stored(spark, path, rows) == before
    monkeypatch.setattr(vs, "replace_folders", real)
    vs.upsert_version(new, SPEC, path, writer="w", batch_id=1)
    assert stored(spark, path, rows) == [("2024-01-02", "A", 2), ("2024-01-03", "B", 2)]


def test_the_second_of_two_writers_merges_anew(spark, path, rows, monkeypatch):
    """Both start from one version and one date; the first to commit does not lose its rows."""
    vs.upsert_version(batch(spark, ("2024-01-02", "A", 1)), SPEC, path)
    real, waiting = vs.replace_folders, [batch(spark, ("2024-01-02", "B", 2))]

    def overtaken(df, target, folders, order):
        real(df, target, folders, order)
        if waiting:
            vs.upsert_version(waiting.pop(), SPEC, path, writer="fast")

    monkeypatch.setattr(vs, "replace_folders", overtaken)
    made = vs.upsert_version(batch(spark, ("2024-01-02", "C", 3)), SPEC, path, writer="slow")
    assert stored(spark, path, rows) == [("2024-01-02", "A", 1), ("2024-01-02", "B", 2), ("2024-01-02", "C", 3)]
    assert (made.number, made.batches) == (3, {"fast": 0, "slow": 0})
    assert not vs.commit(spark, path, made)


def test_readers_keep_their_version(spark, path, rows):
    vs.upsert_version(batch(spark, ("2024-01-02", "A", 1)), SPEC, path)
    reader = vs.read_version(spark, path, SPEC.schema)
    vs.upsert_version(batch(spark, ("2024-01-02", "A", 2)), SPEC, path)
    assert rows(reader) == [("2024-01-02", "A", 1)]


def test_dates_prune_folders(spark, path):
    vs.upsert_version(batch(spark, *[(f"2024-01-0{i}", "A", i) for i in range(1, 8)]), SPEC, path)
    df = vs.read_version(spark, path, SPEC.schema).where("file_date = '2024-01-03'")
    assert [r.n for r in df.collect()] == [3]
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == 1


def test_stream_applies_a_batch_once(spark, tmp_path, path, rows, monkeypatch):
    """The stream dies after its version is made, before it can note the batch as done."""
    source = tmp_path / "in"
    source.mkdir()
    check = str(tmp_path / "check")

    def run():
        stream = ff.stream_flat_files(spark, str(source), SPEC.schema, header=["ticker", "n"])
        return vs.stream_upsert(stream, SPEC, path, check, "feed")

    (source / "a_2024-01-02.csv").write_text("ticker,n\nA,1\n")
    run()
    (source / "a_2024-01-03.csv").write_text("ticker,n\nB,2\n")
    real = vs.upsert_version

    def dies(*args):
        real(*args)
        raise RuntimeError("killed")

    monkeypatch.setattr(vs, "upsert_version", dies)
    with pytest.raises(Exception, match="killed"):
        run()
    monkeypatch.setattr(vs, "upsert_version", real)
    after = vs.latest(spark, path)
    assert stored(spark, path, rows) == [("2024-01-02", "A", 1), ("2024-01-03", "B", 2)]
    run()
    assert vs.latest(spark, path) == after and after.number == 2


def test_bookmarks_of_two_writers(spark, path, rows, monkeypatch):
    kind = "contract string, bookmark bigint"
    assert vs.read_marks(spark, path, kind).collect() == []
    first = spark.createDataFrame([("O:A", 5), ("O:B", 7)], kind)
    vs.commit_marks(first, path, ["contract"], "w")
    real, waiting = vs.replace_folders, [spark.createDataFrame([("O:A", 9), ("O:C", 1)], kind)]

    def overtaken(df, target, folders, order):
        real(df, target, folders, order)
        if waiting:
            vs.commit_marks(waiting.pop(), path, ["contract"], "other")

    monkeypatch.setattr(vs, "replace_folders", overtaken)
    vs.commit_marks(spark.createDataFrame([("O:A", 6), ("O:B", 8), ("O:B", 3)], kind), path, ["contract"], "w", 1)
    assert rows(vs.read_marks(spark, path, kind)) == [("O:A", 9), ("O:B", 8), ("O:C", 1)]
