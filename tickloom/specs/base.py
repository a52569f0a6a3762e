"""Declared tables: schema, primary key and replication key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_schema(schema: T.StructType | str) -> T.StructType:
    """A schema given as one or as DDL text (which needs a running session)."""
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


@dataclass(frozen=True)
class TableSpec:
    """One declared table. ``ddl`` is its schema as Spark DDL text.

    ``surrogate`` lists the identity columns of a table keyed by a surrogate.
    """

    name: str
    ddl: str
    primary_keys: tuple[str, ...]
    replication_key: str | None = None
    surrogate: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return as_schema(self.ddl)

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.schema)


def spec(
    name: str, keys: str, ddl: str, since: str | None = None, surrogate: str = ""
) -> TableSpec:
    """A table with its key columns given as words."""
    return TableSpec(name, ddl, tuple(keys.split()), since, tuple(surrogate.split()))


def each(kind: str, names: str) -> str:
    """DDL of several columns of one type."""
    return ", ".join(f"`{n}` {kind}" for n in names.split())


def nested(name: str, ddl: str) -> str:
    """DDL of a nested object, from the DDL of its fields."""
    fields = ", ".join(f"{n}: {kind}" for n, kind in _fields(ddl))
    return f"`{name}` struct<{fields}>"


def _fields(ddl: str) -> list[tuple[str, str]]:
    """Name and type of each top-level column of DDL text."""
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(ddl + ","):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            parts.append(ddl[start:i].strip())
            start = i + 1
    return [tuple(p.split(" ", 1)) for p in parts if p]


def conform(df: DataFrame, table: TableSpec) -> DataFrame:
    """``df`` in the table's columns and types; columns it lacks are NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in table.schema.fields
        ]
    )
