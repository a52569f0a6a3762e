"""Surrogate keys and fingerprints, built from native hash functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# The DNS namespace of RFC 4122 name-based identifiers.
UUID_NAMESPACE_DNS = "6ba7b8109dad11d180b400c04fd430c8"
# ---------------------------------------------------------------------------


def uuid5(name: Column, namespace: str = UUID_NAMESPACE_DNS) -> Column:
    """RFC 4122 version 5 identifier of a text column."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), name.cast("binary")))
    # Two top bits of the clock field are fixed to 10, so 16 hex digits fold to 4.
    variant = F.translate(
        F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab"
    )
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-5"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )


def double_text(x: Column) -> Column:
    """Shortest decimal text of a double as landed JSON numbers print: ``100.0``, ``10000000.0``.

    Plain from 1e-4 to below 1e16; others keep their exponent form.
    """
    text = x.cast("string")
    plain = F.rtrim(text.try_cast("decimal(38,20)").cast("string"), F.lit("0"))
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    usual = (x == 0) | ((F.abs(x) >= 1e-4) & (F.abs(x) < 1e16))
    return F.when(usual & plain.isNotNull(), plain).otherwise(text)


def surrogate_key(*names: str, doubles: tuple[str, ...] = ()) -> Column:
    """Identifier over the named columns in name order; a NULL counts as ``None``.

    Text, whole-number and date columns go by their text, which is the same in every
    engine. Columns of doubles must be named in ``doubles``.
    """
    parts = [
        F.coalesce(double_text(F.col(n)) if n in doubles else F.col(n).cast("string"), F.lit("None"))
        for n in sorted(names)
    ]
    return uuid5(F.concat_ws("|", *parts))


def _json_text(c: Column) -> Column:
    """A JSON string literal, characters outside ASCII escaped."""
    quoted = F.to_json(F.array(c))
    body = F.substring(quoted, F.lit(2), F.length(quoted) - 2)

    def escape(ch: Column) -> Column:
        code = F.ascii(ch)
        unit = lambda n: F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(n)), 4, "0"))
        rest = code - 0x10000
        pair = F.concat(
            unit(F.shiftright(rest, 10) + 0xD800), unit(rest.bitwiseAND(0x3FF) + 0xDC00)
        )
        return F.when(code < 0x80, ch).when(code < 0x10000, unit(code)).otherwise(pair)

    escaped = F.array_join(F.transform(F.split(body, ""), escape), "")
    return F.when(body.rlike(r"[^\x00-\x7F]"), escaped).otherwise(body)


def canonical_json(m: Column) -> Column:
    """Key-sorted JSON text of a string map, with ``", "`` and ``": "`` separators."""
    entries = F.transform(
        F.array_sort(F.map_entries(m)),
        lambda e: F.concat(
            _json_text(e["key"]),
            F.lit(": "),
            F.when(e["value"].isNull(), F.lit("null")).otherwise(_json_text(e["value"])),
        ),
    )
    return F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))


def fingerprint(m: Column) -> Column:
    """SHA-256 of the key-sorted JSON text of a string map."""
    return F.sha2(canonical_json(m), 256)
