"""Projections: renaming, code maps, normalisation of bars, trades and snapshots."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import keys as keyfn
from tickloom.functions import scalars as sc

# --- fixed values -----------------------------------------------------------
# Short API codes and the column names they stand for.
BAR_CODES = {
    "T": "ticker",
    "t": "timestamp",
    "o": "open",
    "h": "high",
    "l": "low",
    "c": "close",
    "v": "volume",
    "vw": "vwap",
    "n": "transactions",
}
SNAPSHOT_BAR_CODES = {
    "o": "open",
    "h": "high",
    "l": "low",
    "c": "close",
    "v": "volume",
    "dv": "decimal_volume",
    "vw": "vwap",
    "av": "accumulated_volume",
    "dav": "decimal_accumulated_volume",
    "n": "transactions",
    "t": "timestamp",
    "otc": "otc",
}
SNAPSHOT_QUOTE_CODES = {
    "P": "ask_price",
    "S": "ask_size",
    "p": "bid_price",
    "s": "bid_size",
    "T": "ticker",
    "t": "timestamp",
    "X": "ask_exchange",
    "x": "bid_exchange",
    "a": "ask_price",
    "b": "bid_price",
    "i": "indicators",
    "c": "conditions",
    "f": "trf_timestamp",
    "q": "sequence_number",
    "y": "participant_timestamp",
    "z": "tape",
}
SNAPSHOT_TRADE_CODES = {
    "p": "price",
    "s": "size",
    "ds": "decimal_size",
    "T": "ticker",
    "t": "timestamp",
    "x": "exchange",
    "X": "exchange",
    "c": "conditions",
    "i": "id",
    "e": "correction",
    "f": "trf_timestamp",
    "q": "sequence_number",
    "r": "trf_id",
    "y": "participant_timestamp",
    "z": "tape",
}
LAST_TRADE_CODES = {
    "T": "ticker",
    "c": "conditions",
    "e": "correction",
    "f": "trf_timestamp",
    "i": "id",
    "p": "price",
    "q": "sequence_number",
    "r": "trf_id",
    "s": "size",
    "t": "sip_timestamp",
    "x": "exchange",
    "y": "participant_timestamp",
    "z": "tape",
}
LAST_QUOTE_CODES = {
    "T": "ticker",
    "f": "trf_timestamp",
    "q": "sequence_number",
    "t": "sip_timestamp",
    "y": "participant_timestamp",
    "P": "ask_price",
    "S": "ask_size",
    "X": "ask_exchange",
    "c": "conditions",
    "i": "indicators",
    "p": "bid_price",
    "s": "bid_size",
    "x": "bid_exchange",
    "z": "tape",
}
SIP_KEYS = {
    "cta": "CTA",
    "c_t_a": "CTA",
    "opra": "OPRA",
    "o_p_r_a": "OPRA",
    "utp": "UTP",
    "u_t_p": "UTP",
}
PRICE_COLUMNS = ("open", "high", "low", "close", "vwap")
# ---------------------------------------------------------------------------


def _snake(name: str) -> str:
    return re.sub(r"(?<!^)(?=[A-Z])", "_", name).lower()


def _snake_type(kind: T.DataType) -> T.DataType:
    if not isinstance(kind, T.StructType):
        return kind
    return T.StructType(
        [T.StructField(_snake(f.name), _snake_type(f.dataType)) for f in kind.fields]
    )


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Snake-case every column and every field of nested objects, not of arrays."""
    renamed = df.toDF(*[_snake(n) for n in df.columns])
    return renamed.select(
        *[
            F.col(f.name).cast(_snake_type(f.dataType)).alias(f.name)
            if isinstance(f.dataType, T.StructType)
            else F.col(f.name)
            for f in renamed.schema.fields
        ]
    )


def _by_target(names: list[str], codes: dict[str, str]) -> dict[str, dict[str, list[int]]]:
    """For each output name, the positions of its own column and of its codes."""
    out: dict[str, dict[str, list[int]]] = {}
    code_order = {code: i for i, code in enumerate(codes)}
    for i, name in enumerate(names):
        slot = out.setdefault(codes.get(name, name), {"own": [], "codes": []})
        slot["codes" if name in codes else "own"].append(i)
    for slot in out.values():
        slot["codes"].sort(key=lambda i: code_order[names[i]])
    return out


def apply_code_map(
    df: DataFrame, codes: dict[str, str], overwrite: bool = True
) -> DataFrame:
    """Rename short-code columns; where the named column exists too, one value wins.

    ``overwrite`` lets the code win, otherwise the named column does. Columns are
    first renamed by position, so ``t`` and ``T`` may both be present whatever the
    session's case sensitivity.
    """
    names = df.columns
    by_position = df.toDF(*[f"_c{i}" for i in range(len(names))])
    cols = []
    for target, slot in _by_target(names, codes).items():
        order = slot["codes"] + slot["own"] if overwrite else slot["own"] + slot["codes"]
        reads = [F.col(f"_c{i}") for i in order]
        cols.append((reads[0] if len(reads) == 1 else F.coalesce(*reads)).alias(target))
    return by_position.select(*cols)


def normalize_bars(
    df: DataFrame,
    include_otc: bool = False,
    iso: bool = False,
    ticker: Column | None = None,
    status: Column | None = None,
    status_name: str = "active",
) -> DataFrame:
    """API bars to named, typed columns; rows without a time are dropped."""
    out = apply_code_map(df, BAR_CODES).where(F.col("timestamp").isNotNull())
    for name in PRICE_COLUMNS:
        if name in out.columns:
            out = out.withColumn(name, sc.safe_decimal(name))
    stamp = sc.epoch_to_timestamp("timestamp")
    if iso:
        whole = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        has_fraction = F.pmod(F.unix_micros(stamp), F.lit(1_000_000)) != 0
        stamp = F.concat(F.when(has_fraction, micros).otherwise(whole), F.lit("+00:00"))
    out = out.withColumn("timestamp", stamp)
    if ticker is not None:
        out = out.withColumn("ticker", ticker)
    if not include_otc:
        out = out.drop("otc")
    if status is not None:
        out = out.withColumn(status_name, status)
    return out


def _renamed_struct(
    column: str, kind: T.StructType, codes: dict[str, str], quote: bool
) -> Column:
    """A struct with code fields renamed; a field already named keeps its value."""
    names = kind.fieldNames()
    safe = T.StructType(
        [T.StructField(f"_c{i}", f.dataType) for i, f in enumerate(kind.fields)]
    )
    payload = F.col(column).cast(safe)
    at = lambda i: payload.getField(f"_c{i}")
    codes = dict(codes)
    both = quote and "x" in names and "X" in names
    if quote and not both:
        # Only one exchange code exists at all: it is the quote's single exchange.
        codes.update({"x": "exchange", "X": "exchange"})
    fields = []
    upper = at(names.index("X")) if both else None
    lower = at(names.index("x")) if both else None
    for target, slot in _by_target(names, codes).items():
        reads = [at(i) for i in slot["own"] + slot["codes"]]
        if both and target in ("ask_exchange", "bid_exchange"):
            pair = upper.isNotNull() & lower.isNotNull()
            code = upper if target == "ask_exchange" else lower
            reads = [at(i) for i in slot["own"]] + [F.when(pair, code)]
        value = reads[0] if len(reads) == 1 else F.coalesce(*reads)
        fields.append((target, value))
    if both:
        lone = F.when(upper.isNull() | lower.isNull(), F.coalesce(upper, lower))
        own = [at(names.index("exchange"))] if "exchange" in names else []
        fields = [f for f in fields if f[0] != "exchange"]
        fields.append(("exchange", F.coalesce(*own, lone)))
    built = F.struct(*[value.alias(name) for name, value in fields])
    return F.when(F.col(column).isNotNull(), built)


def normalize_snapshot(df: DataFrame) -> DataFrame:
    """Nested snapshots to named fields, judged by each column's slug.

    A quote with one exchange code has one ``exchange``; with both codes they are
    the ask and the bid exchange. Top-level names become snake case.
    """
    kinds = {
        "lastquote": (SNAPSHOT_QUOTE_CODES, True),
        "lasttrade": (SNAPSHOT_TRADE_CODES, False),
        "day": (SNAPSHOT_BAR_CODES, False),
        "min": (SNAPSHOT_BAR_CODES, False),
        "prevday": (SNAPSHOT_BAR_CODES, False),
        "lastminute": (SNAPSHOT_BAR_CODES, False),
    }
    out = df
    for f in df.schema.fields:
        found = kinds.get(f.name.replace("_", "").lower())
        if found and isinstance(f.dataType, T.StructType):
            out = out.withColumn(f.name, _renamed_struct(f.name, f.dataType, *found))
    out = snake_case_columns(out)
    if "todays_change_perc" in out.columns:
        out = out.withColumnRenamed("todays_change_perc", "todays_change_percent")
    return out


def project(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """The listed columns that exist, in list order."""
    return df.select(*[c for c in columns if c in df.columns])


def to_option_identity(df: DataFrame, contracts: DataFrame | None = None) -> DataFrame:
    """``ticker`` becomes ``option_ticker``, with its ``underlying_ticker`` beside it.

    The underlying comes from ``contracts`` (ticker, underlying_ticker) when given,
    else it must already be a column.
    """
    out = df.withColumnRenamed("ticker", "option_ticker")
    if contracts is None:
        return out
    dim = contracts.select(
        F.col("ticker").alias("option_ticker"), "underlying_ticker"
    )
    return out.drop("underlying_ticker").join(dim, "option_ticker", "left")


def coalesce_nested(
    df: DataFrame,
    column: str,
    path: str,
    blank_is_missing: bool = True,
    drop_source: bool = False,
) -> DataFrame:
    """Fill ``column`` from a nested field where it is missing."""
    own = F.col(column) if column in df.columns else F.lit(None).cast("string")
    if blank_is_missing:
        own = F.when(own != "", own)
    out = df.withColumn(column, F.coalesce(own, F.col(path)))
    if drop_source:
        parent, _, leaf = path.rpartition(".")
        out = out.withColumn(parent, F.col(parent).dropFields(leaf))
    return out


def fill_key(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing text key parts become the empty string."""
    return df.na.fill("", columns)


def with_surrogate_key(
    df: DataFrame, columns: list[str], name: str = "_surrogate_key"
) -> DataFrame:
    """Add a name-based identifier over ``columns``."""
    doubles = tuple(n for n, kind in df.select(*columns).dtypes if kind in ("double", "float"))
    return df.withColumn(name, keyfn.surrogate_key(*columns, doubles=doubles))


def normalize_sip_mapping(df: DataFrame, column: str = "sip_mapping") -> DataFrame:
    """Upper-case the known feed keys of a map; drop other keys and NULL values."""
    known = F.create_map(*[F.lit(x) for pair in SIP_KEYS.items() for x in pair])
    renamed = F.transform(
        F.filter(
            F.map_entries(column),
            lambda e: known[e["key"]].isNotNull() & e["value"].isNotNull(),
        ),
        lambda e: F.struct(known[e["key"]].alias("key"), e["value"].alias("value")),
    )
    # Two spellings of one feed: the later entry wins.
    latest = F.filter(
        renamed,
        lambda e, i: ~F.exists(
            F.slice(renamed, i + 2, F.size(renamed)), lambda later: later["key"] == e["key"]
        ),
    )
    return df.withColumn(column, F.map_from_entries(latest))


def normalize_trades(df: DataFrame, time: str = "sip_timestamp") -> DataFrame:
    """Whole-number times and codes, decimal price, condition codes without dirt."""
    out = df
    whole = (time, "exchange", "participant_timestamp", "trf_timestamp", "correction")
    for name in whole:
        if name in out.columns:
            out = out.withColumn(name, sc.safe_int(name))
    if "price" in out.columns:
        out = out.withColumn("price", sc.safe_decimal("price"))
    if "conditions" in out.columns:
        ints = F.transform("conditions", lambda c: sc.safe_int(c))
        out = out.withColumn("conditions", F.filter(ints, lambda c: c.isNotNull()))
    return out


def narrow_integral(c: Column | str) -> Column:
    """The whole-number form of a number, NULL where it has a fraction."""
    n = F.col(c) if isinstance(c, str) else c
    return F.when(n == F.floor(n), n.try_cast("bigint"))


def clean_ipos(df: DataFrame) -> DataFrame:
    """Lower-case status; an update time that does not parse becomes NULL."""
    return df.withColumn("ipo_status", F.lower("ipo_status")).withColumn(
        "last_updated", F.try_to_timestamp(F.col("last_updated"))
    )


def resolve_status(row_flag: Column, config_flag: str | None, default: bool) -> Column:
    """The row's flag, else the configured one, else the default."""
    return F.coalesce(
        sc.status_bool(row_flag),
        sc.status_bool(F.lit(config_flag).cast("string")),
        F.lit(default),
    )
