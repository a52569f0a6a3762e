import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.sources import tables as tb
from tickloom.sources.pages import as_pages
from tickloom.sources.tables import cleaned, load_table
from tickloom.specs import TABLES

ROWS = 8


def _value(kind, name, n):
    """A value of any declared type, told apart by column and row."""
    if isinstance(kind, T.StructType):
        return F.struct(*[_cell(f, n, i, ("exchange",)) for i, f in enumerate(kind.fields)])
    if isinstance(kind, T.ArrayType):
        return F.array(_value(kind.elementType, name, n), _value(kind.elementType, name, n + 1))
    if isinstance(kind, T.MapType):
        return F.create_map(F.lit("CTA"), F.concat(F.lit(name), n.cast("string")))
    plain = {
        "string": F.concat(F.lit(f'{name} "é" '), n.cast("string")),
        "bigint": n * 1_000_003 + 1_700_000_000_000_000_000 + len(name),
        "double": n + 0.1,
        "boolean": n % 2 == 0,
        "date": F.date_add(F.lit("2024-02-28").cast("date"), n.cast("int")),
        "timestamp": F.timestamp_micros(n * 1_000_003 + 1_700_000_000_000_001),
        "variant": F.parse_json(F.concat(F.lit('{"k":[1,'), n.cast("string"), F.lit("]}"))),
    }
    return plain[kind.simpleString()]


def _cell(field, n, place, kept):
    """NULL in every third row, by the column's place, but for columns in ``kept``."""
    value = _value(field.dataType, field.name, n)
    if field.name.endswith(kept):
        return value.alias(field.name)
    return F.when((n + place) % 3 != 0, value).alias(field.name)


def _rows(spark, table):
    n = F.col("_row")
    kept = (*table.primary_keys, table.replication_key or table.primary_keys[0])
    cells = [_cell(f, n, i, kept) for i, f in enumerate(table.schema.fields)]
    return spark.range(0, ROWS, 1, 2).withColumnRenamed("id", "_row").select("_row", *cells)


def _texts(df, table):
    columns = [F.col(f"`{n}`") for n in table.schema.fieldNames()]
    return sorted(r[0] for r in df.select(F.to_json(F.struct(*columns))).collect())


def _kinds():
    """One table of each way to be loaded; the others differ from one of these by name alone."""
    kinds = {}
    for name in sorted(TABLES, key=lambda n: (len(n), n)):
        table = TABLES[name]
        way = (
            table.ddl, table.primary_keys, table.replication_key, table.surrogate,
            str(tb.record_codes(table)), tb.nested_codes(table) is None, tb.INNER.get(name),
            str(tb.BLANK_KEYS.get(name)), tb.FROM_DETAILS.get(name), "_bars_" in name, name.endswith("_trades"),
            name == "stock_ipos",
        )
        kinds.setdefault(way, name)
    return sorted(kinds.values())


@pytest.mark.parametrize("name", _kinds())
def test_every_kind_of_table_comes_back_from_its_pages(spark, name):
    """Objects, lists, maps, codes, nulls: half of the rows by name, half by code."""
    table = TABLES[name]
    rows = _rows(spark, table)
    even = F.col("_row") % 2 == 0
    pages = as_pages(rows.where(even).drop("_row"), name, 3).unionByName(
        as_pages(rows.where(~even).drop("_row"), name, 1, coded=True)
    )
    expected = _texts(cleaned(rows, table), table)
    assert len(expected) == ROWS
    assert _texts(load_table(pages, name), table) == expected


def test_page_sizes(spark):
    rows = spark.range(0, 10, 1, 1).selectExpr("cast(id AS string) AS ticker")
    sizes = as_pages(rows, "stock_float", 4).selectExpr("size(from_json(payload, 'results array<string>').results) AS n")
    assert sorted(r.n for r in sizes.collect()) == [2, 4, 4]
    assert as_pages(rows.where("false"), "stock_float").count() == 0
    assert load_table(as_pages(rows.limit(1), "stock_float"), "stock_float").first().ticker == "0"
