"""Keyed dedupe, unions and contract universes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.keys import canonical_json


def _content_hash(df: DataFrame) -> Column:
    """Hash of the whole row, to decide ties the same way on every run."""
    hashable = [
        F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name)
        for f in df.schema.fields
    ]
    return F.xxhash64(*hashable)


def dedupe(
    df: DataFrame, keys: list[str], order: list[str] | tuple[str, ...], keep: str = "first"
) -> DataFrame:
    """One row per key: the first or last by ``order``.

    An aggregate, not a window: copies collapse before the shuffle, so a key with
    very many copies costs no task more than others.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(keys)
    pick = {"first": F.min_by, "last": F.max_by}[keep]
    rank = F.struct(*[F.col(c) for c in order], _content_hash(df))
    best = df.groupBy(*keys).agg(pick(F.struct(*others), rank).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])


def dedupe_context(
    df: DataFrame, context: str, order: list[str], keep: str = "last"
) -> DataFrame:
    """One row per context map, whatever the order of the map's keys."""
    keyed = df.withColumn("_context", canonical_json(F.col(context)))
    pick = {"first": F.min_by, "last": F.max_by}[keep]
    row = F.struct(*df.columns)
    return (
        keyed.groupBy("_context")
        .agg(pick(row, F.struct(*order, F.xxhash64(F.col("_context")))).alias("_row"))
        .select("_row.*")
    )


def union_both(
    true_rows: DataFrame, false_rows: DataFrame, flag: str, key: str
) -> DataFrame:
    """Both passes of a flagged listing, the true pass winning, sorted by key.

    Rows that lack the flag get the one of their pass.
    """

    def stamped(df: DataFrame, value: bool) -> DataFrame:
        own = F.col(flag) if flag in df.columns else F.lit(None).cast("boolean")
        return df.withColumn(flag, F.coalesce(own, F.lit(value))).withColumn(
            "_pass", F.lit(0 if value else 1)
        )

    both = stamped(true_rows, True).unionByName(
        stamped(false_rows, False), allowMissingColumns=True
    )
    return dedupe(both, [key], ["_pass"], keep="first").drop("_pass").orderBy(key)


def all_assets(tables: dict[str, DataFrame], tag: str = "market") -> DataFrame:
    """One table over several markets; columns a market lacks are NULL."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in tables.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def missing(expected: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct expected keys that were not seen."""
    return expected.select(*keys).distinct().join(
        seen.select(*keys).distinct(), keys, "left_anti"
    )


def with_ticker_dim(df: DataFrame, tickers: DataFrame, key: str = "ticker") -> DataFrame:
    """Attributes of a ticker table (one row per ticker) on every row that has one."""
    return df.join(tickers, key, "left")


def expand_contracts(
    underlyings: DataFrame, contracts: DataFrame, key: str = "underlying_ticker"
) -> DataFrame:
    """Each underlying replaced by its contracts.

    The underlyings are few against the contracts, so adaptive execution leaves the
    contracts where they are unless the underlyings outgrow the broadcast threshold.
    """
    return contracts.join(underlyings.select(key).distinct(), key)



def upsert(
    existing: DataFrame, batch: DataFrame, keys: list[str], order: list[str]
) -> DataFrame:
    """Both tables with one row per key: the last by ``order``, the batch on ties."""
    both = existing.withColumn("_batch", F.lit(0)).unionByName(
        batch.withColumn("_batch", F.lit(1)), allowMissingColumns=True
    )
    return dedupe(both, keys, [*order, "_batch"], keep="last").drop("_batch")
