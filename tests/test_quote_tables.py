import gzip
import os

from tickloom.operators.quotes import QUOTE_ASSETS
from tickloom.sources.quote_tables import last_date, update_quote_bars
from tickloom.sources.versions import Version, latest, read_version
from tickloom.specs import TABLES

S = 10**9
TABLE = TABLES["options_quote_snapshots_flat_files_1_minute"]
NAMES = [c.split()[0] for c in QUOTE_ASSETS["option"].csv.split(", ")]


def _file(folder, date, quotes, names=NAMES):
    """One day's file of (ticker, time, sequence, bid price)."""
    os.makedirs(folder, exist_ok=True)
    lines = [",".join(names)]
    for ticker, time, sequence, price in quotes:
        row = dict.fromkeys(NAMES, "1") | {
            "ticker": ticker, "sip_timestamp": str(time), "sequence_number": str(sequence), "bid_price": str(price)
        }
        lines.append(",".join(row[n] for n in names))
    with gzip.open(f"{folder}/{date}.csv.gz", "wt") as out:
        out.write("\n".join(lines) + "\n")


def _table(spark, path):
    picked = read_version(spark, path, TABLE.schema).select("file_date", "ticker", "asof_timestamp", "bid_price")
    return sorted(tuple(r) for r in picked.collect())


def test_files_grow_and_come(spark, tmp_path):
    files, path = str(tmp_path / "files"), str(tmp_path / "bars")
    _file(files, "2024-01-02", [("O:A", 30 * S, 1, 1.0), ("O:A", 60 * S, 2, 2.0), ("O:A", 61 * S, 3, 3.0)])
    first = update_quote_bars(spark, files, path, TABLE, 60 * S)
    assert last_date(first) == "2024-01-02"
    assert _table(spark, path) == [("2024-01-02", "O:A", 60 * S, 2.0), ("2024-01-02", "O:A", 120 * S, 3.0)]
    # The last file has grown, and a new one has its columns in another order.
    _file(files, "2024-01-02", [("O:A", 30 * S, 1, 1.0), ("O:A", 60 * S, 2, 2.0), ("O:A", 62 * S, 4, 4.0)])
    _file(files, "2024-01-03", [("O:B", 5 * S, 1, 7.0)], NAMES[::-1])
    # A file from before the table's last date, of no use to any reader, is never opened.
    with open(f"{files}/2024-01-01.csv.gz", "wb") as out:
        out.write(b"not a gzip file")
    second = update_quote_bars(spark, files, path, TABLE, 60 * S)
    grown = [
        ("2024-01-02", "O:A", 60 * S, 2.0), ("2024-01-02", "O:A", 120 * S, 4.0), ("2024-01-03", "O:B", 60 * S, 7.0)
    ]
    assert second.number > first.number and _table(spark, path) == grown
    update_quote_bars(spark, files, path, TABLE, 60 * S)
    assert _table(spark, path) == grown


def test_end_and_nothing_to_do(spark, tmp_path):
    files, path = str(tmp_path / "files"), str(tmp_path / "bars")
    for day in (2, 3, 4):
        _file(files, f"2024-01-0{day}", [("O:A", day * S, 1, float(day))])
    one = update_quote_bars(spark, files, path, TABLE, 60 * S, start="2024-01-03", end="2024-01-03")
    assert [r[0] for r in _table(spark, path)] == ["2024-01-03"]
    assert update_quote_bars(spark, files, path, TABLE, 60 * S, end="2024-01-01") == one
    assert latest(spark, path) == one
    assert last_date(Version()) is None
