"""Rows of declared tables as landed API pages: what :func:`load_table` reads, written back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.sources.landed import record_names
from tickloom.sources.tables import INNER, nested_codes, record_codes
from tickloom.specs import TABLES

# Microseconds and offset, so that no digit of a time is lost.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _landed(column: Column, field: T.StructField, codes: dict, nested: dict, coded: bool) -> Column:
    """One column under the key it lands with: its name, or its last code or camel-case form."""
    key = record_names(field.name, codes)[-1] if coded else field.name
    if isinstance(field.dataType, T.StructType):
        own = nested.get(field.name.replace("_", ""), {})
        parts = [
            _landed(column.getField(f.name), f, own, nested, coded) for f in field.dataType.fields
        ]
        column = F.when(column.isNotNull(), F.struct(*parts))
    return column.alias(key)


def as_pages(rows: DataFrame, name: str, per_page: int = 1000, coded: bool = False) -> DataFrame:
    """Rows of declared table ``name`` as pages (column ``payload``) of at most ``per_page`` records.

    Columns that ``rows`` lacks are left out, and so is a surrogate key, which loading
    computes. With ``coded``, keys are the one-letter codes or else camel-case names, NULLs are
    written as JSON nulls, and records lie under the table's inner key where it has one.
    Which records share a page is not defined; an empty table has no pages.
    """
    table = TABLES[name]
    codes, nested = record_codes(table), nested_codes(table) or {}
    left_out = set() if not table.surrogate else {"_surrogate_key"}
    fields = [f for f in table.schema.fields if f.name in rows.columns and f.name not in left_out]
    record = F.struct(*[_landed(F.col(f.name), f, codes, nested, coded) for f in fields])
    text = F.to_json(
        record, {"timestampFormat": TIME_FORMAT, "ignoreNullFields": "false" if coded else "true"}
    )
    key = INNER.get(name, "results") if coded else "results"
    # Ids run on within a partition, so a page takes neighbours and never more than per_page.
    page = F.floor(F.monotonically_increasing_id() / per_page)
    return (
        rows.select(text.alias("_record"), page.alias("_page"))
        .groupBy("_page")
        .agg(F.concat_ws(",", F.collect_list("_record")).alias("_records"))
        .select(F.concat(F.lit(f'{{"{key}":['), "_records", F.lit("]}")).alias("payload"))
    )
