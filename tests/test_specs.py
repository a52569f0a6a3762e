from tickloom.specs import TABLES, conform


def test_registry_is_complete(spark):
    assert len(TABLES) == 241
    for name, table in TABLES.items():
        names = table.schema.fieldNames()
        assert len(set(names)) == len(names), name
        assert set(table.primary_keys) <= set(names), name
        assert set(table.surrogate) <= set(names), name
        if table.replication_key:
            assert table.replication_key in names, name


def test_option_tables_are_keyed_by_contract(spark):
    for name, table in TABLES.items():
        if name.startswith("options_bars") or name.startswith("options_earnings_quote"):
            assert "option_ticker" in table.primary_keys and "ticker" not in table.schema.fieldNames()


def test_types_hold_large_sequences(spark):
    for name in ("stock_quotes", "stock_earnings_quotes", "options_quotes", "stocks_flat_files_quotes"):
        kind = dict((f.name, f.dataType.simpleString()) for f in TABLES[name].schema.fields)
        assert kind["sequence_number"] == "bigint"
    assert "source_feed" in TABLES["all_tickers"].schema.fieldNames()


def test_conform(spark):
    table = TABLES["stock_float"]
    row = conform(spark.createDataFrame([("A", "5")], "ticker string, free_float string"), table).first()
    assert row.asDict() == {
        "effective_date": None, "free_float": 5, "free_float_percent": None, "ticker": "A",
    }
    assert table.empty(spark).count() == 0
