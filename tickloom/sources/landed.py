"""Landed API pages (JSON text, one page per row) to typed tables.

Pages are parsed once into ``VARIANT``; keys keep their case, so one-letter codes
such as ``t`` and ``T`` stay apart whatever the session's case sensitivity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import scalars as sc
from tickloom.specs.base import as_schema


def read_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per landed file, with its text in ``payload``."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "payload")


def explode_results(
    pages: DataFrame, payload: str = "payload", inner: str | None = None, empty: bool = False
) -> DataFrame:
    """One row per record of each page, in the variant column ``record``.

    A page is a list, or an object holding ``results`` (a list or one object), or
    itself the record. ``inner`` names a key of each record that holds the real
    record or list of records. Empty and NULL records are dropped, but with ``empty``,
    which saves a copy of each record where a caller reads only lists in it.
    """
    df = pages.withColumn("_page", F.try_parse_json(payload)).drop(payload)
    page = F.col("_page")
    as_list = F.try_variant_get(page, "$", "array<variant>")
    listed = F.try_variant_get(page, "$.results", "array<variant>")
    single = F.try_variant_get(page, "$.results", "variant")
    # A JSON null under "results" is a variant null, only an absent key is NULL.
    # Each read of a variant copies it.
    in_object = F.coalesce(listed, F.array(F.coalesce(single, page)))
    df = df.withColumn("record", F.explode(F.coalesce(as_list, in_object))).drop("_page")
    if inner:
        many = F.try_variant_get("record", f"$.{inner}", "array<variant>")
        one = F.try_variant_get("record", f"$.{inner}", "map<string,variant>")
        found = F.when(
            one.isNotNull(), F.array(F.try_variant_get("record", f"$.{inner}", "variant"))
        )
        df = df.withColumn(
            "record", F.explode(F.coalesce(many, found, F.array(F.col("record"))))
        )
    keys = F.try_variant_get("record", "$", "map<string,variant>")
    return df if empty else df.where(F.size(keys) > 0)


def _camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(p.capitalize() for p in rest)


def record_names(name: str, codes: dict[str, str]) -> list[str]:
    """The keys a column may arrive under, best first."""
    return list(dict.fromkeys((name, _camel(name), *[c for c, n in codes.items() if n == name])))


def _read(record: Column, names: list[str], kind: str) -> Column:
    reads = [F.try_variant_get(record, f"$['{n}']", kind) for n in names]
    return reads[0] if len(reads) == 1 else F.coalesce(*reads)


def record_time(text: Column, epoch: Column) -> Column:
    """A time read as ISO text or else as an epoch number."""
    return F.coalesce(F.try_to_timestamp(text), sc.epoch_to_timestamp(epoch))


def record_field(
    record: Column,
    field: T.StructField,
    codes: dict[str, str],
    nested: dict[str, dict[str, str]],
) -> Column:
    """One typed column of a record: by name, camel-case form or code.

    Times may be ISO text or epoch numbers. Objects are read field by field, with
    the codes that ``nested`` gives for their slug.
    """
    names = record_names(field.name, codes)
    if isinstance(field.dataType, T.TimestampType):
        return record_time(_read(record, names, "string"), _read(record, names, "bigint"))
    if isinstance(field.dataType, T.StructType):
        inside = _read(record, names, "variant")
        own = nested.get(field.name.replace("_", ""), {})
        parts = [
            record_field(inside, f, own, nested).alias(f.name) for f in field.dataType.fields
        ]
        present = F.try_variant_get(inside, "$", "map<string,variant>").isNotNull()
        return F.when(present, F.struct(*parts))
    return _settled(_read(record, names, field.dataType.simpleString()), field.dataType)


def _settled(read: Column, kind: T.DataType) -> Column:
    """A JSON null read as a variant is a value; in a column, a list or an object it is NULL, as for other types."""
    if "variant" not in kind.simpleString():
        return read
    if isinstance(kind, T.ArrayType):
        return F.transform(read, lambda v: _settled(v, kind.elementType))
    if isinstance(kind, T.StructType):
        parts = [_settled(read[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(read.isNotNull(), F.struct(*parts))
    return F.when(~F.is_variant_null(read), read) if isinstance(kind, T.VariantType) else read


def read_records(
    exploded: DataFrame,
    schema: T.StructType | str,
    codes: dict[str, str] | None = None,
    context: tuple[str, ...] = (),
    nested: dict[str, dict[str, str]] | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Records as ``schema``; what does not fit a type becomes NULL.

    ``codes`` maps one-letter codes to names, ``nested`` does so for objects, by
    their slug. Columns in ``context`` (a ticker known from the request, say) are
    taken from the page row instead; columns in ``keep`` stay beside the schema's.
    """
    return exploded.select(
        *keep,
        *[
            F.col(f.name)
            if f.name in context
            else record_field(F.col("record"), f, codes or {}, nested or {}).alias(f.name)
            for f in as_schema(schema).fields
        ]
    )
