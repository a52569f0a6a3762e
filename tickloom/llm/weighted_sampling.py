"""Document fingerprints by consistent weighted sampling.

A document is a set of weighted terms: its words (lower case) and how often each occurs. For
each of ``SLOTS`` slots and each term, two hashes of the term give r and c, gamma-distributed
with shape 2, and a uniform b. With t = floor(ln w / r + b) the term's value is

    ln a = ln c - r (t - b + 1)

and the slot holds the least value (Ioffe, 2010). Two documents agree in a slot with a
probability equal to their generalised Jaccard similarity, the sum of the lesser weights over
the sum of the greater ones. The value depends on the slot, the term and t alone, so the least
value itself tells which sample was drawn and no term need be carried along: sampling is a
plain minimum, aggregated before any shuffle. A fingerprint is 16 bits of each slot's value.

Only DataFrame functions are used: whole texts are dealt by document once, and words are
counted and sampled where they are.

* A null text counts as empty. Documents without words have the fingerprint of zeros; two such
  are alike to the degree 1.
* Rows of the same doc_id and text have one result row. Ties of doc_id go by the text's hash.
* Next documents follow descending doc_id, nulls last; after the last comes the first. A sole
  document is its own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import SPACE, buckets_for
from tickloom.session import checkpointed

SLOTS = 32
DIGITS = 4
_UNIT = 2.0**-31


def _uniform(h: Column, shift: int) -> Column:
    """A number in (0, 1) from 31 bits of a hash."""
    bits = F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << 31) - 1).cast("bigint"))
    return (bits.cast("double") + 0.5) * _UNIT


def value(term: Column, log_weight: Column, slot: int) -> Column:
    """ln a of a term (a 64-bit hash) in a slot."""
    one, two, three = (F.xxhash64(term, F.lit(3 * slot + i)) for i in range(3))
    r = -F.ln(_uniform(one, 0) * _uniform(one, 33))
    c = -F.ln(_uniform(two, 0) * _uniform(two, 33))
    b = _uniform(three, 0)
    t = F.floor(log_weight / r + b)
    return F.ln(c) - r * (t - b + 1)


def signatures(texts: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One array of ``SLOTS`` doubles per text column, named alike, for each key.

    ``texts`` must be partitioned by a subset of ``keys``: then neither counting nor sampling
    needs a shuffle. Slots are null where a text has no words.
    """

    def words(column: str, side: int) -> Column:
        split = F.split(F.lower(F.coalesce(column, F.lit(""))), SPACE + "+")
        return F.transform(split, lambda w: F.struct(w.alias("w"), F.lit(side).alias("side")))

    both = F.concat(*[words(c, i) for i, c in enumerate(columns)])
    listed = texts.select(*keys, F.explode(both).alias("x")).where("x.w != ''")
    terms = listed.select(*keys, F.xxhash64("x.w").alias("term"), F.col("x.side").alias("side"))
    weights = [F.sum(F.when(F.col("side") == i, 1).otherwise(0)).alias(f"n{i}") for i in range(len(columns))]
    counted = terms.groupBy(*keys, "term").agg(*weights)
    logs = counted.select(*keys, "term", *[
        F.when(F.col(f"n{i}") > 0, F.ln(f"n{i}")).alias(f"log{i}") for i in range(len(columns))
    ])
    least = [
        F.min(value(F.col("term"), F.col(f"log{i}"), s)).alias(f"m{i}_{s}")
        for i in range(len(columns)) for s in range(SLOTS)
    ]
    sampled = logs.groupBy(*keys).agg(*least)
    return sampled.select(*keys, *[
        F.array(*[f"m{i}_{s}" for s in range(SLOTS)]).alias(c) for i, c in enumerate(columns)
    ])


def as_text(signature: Column) -> Column:
    """A signature as hexadecimal digits, ``DIGITS`` to a slot; null for no words."""
    mask = F.lit(16**DIGITS - 1).cast("bigint")

    def slot(v: Column) -> Column:
        return F.lpad(F.hex(F.xxhash64(v).bitwiseAND(mask)), DIGITS, "0")

    return F.when(signature[0].isNotNull(), F.lower(F.array_join(F.transform(signature, slot), "")))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal slots of two fingerprints as text, 0 to 1."""
    equal = [
        (F.substring(a, DIGITS * i + 1, DIGITS) == F.substring(b, DIGITS * i + 1, DIGITS)).cast("int") for i in range(SLOTS)
    ]
    return sum(equal[1:], equal[0]) / F.lit(float(SLOTS))


def _same(a: str, b: str) -> Column:
    """True for equal ids, nulls included, of two joined sides.

    Written as one expression over both sides, so that a join on ``k`` has no further key
    and its sides stay dealt by ``k`` alone.
    """
    return F.xxhash64(a).bitwiseXOR(F.xxhash64(b)) == 0


def with_next(ids: DataFrame) -> DataFrame:
    """(doc_id, k, next_id, next_k): descending doc_id, nulls last, the first after the last.

    Ids are dealt to ranges of about equal size; only the ends of the ranges, one row each,
    meet in one task.
    """
    descending = [F.col("doc_id").desc_nulls_last(), F.col("k")]
    ranged = checkpointed(
        ids.repartitionByRange(buckets_for(ids.count()), *descending).withColumn(
            "part", F.spark_partition_id()
        )
    )
    within = Window.partitionBy("part").orderBy(*descending)
    inside = ranged.withColumn("next", F.lead(F.struct("doc_id", "k")).over(within))
    heads = (
        ranged.withColumn("nth", F.row_number().over(within)).where("nth = 1")
        .select(F.col("part").alias("__part"), F.struct("doc_id", "k").alias("head"))
    )
    by_part = Window.orderBy("__part")
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("head").over(by_part), F.first("head").over(whole))
    after = heads.select("__part", following.alias("after"))
    ring = inside.join(after, F.col("part") == F.col("__part"))
    ring = ring.withColumn("next", F.coalesce("next", "after"))
    return ring.select(
        "doc_id", "k", F.col("next.doc_id").alias("next_id"), F.col("next.k").alias("next_k")
    )


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness.

    The edited text has its last floor(n_chars / 3) code points replaced by the first as many
    of the next document's. ``k`` is a hash of id and text: texts are dealt by it once, and
    the lent beginnings once more; all joins, counts and samples follow that dealing.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", text.alias("text")).withColumn("k", F.xxhash64("doc_id", "text"))
    ids = checkpointed(
        keyed.select("doc_id", "k", F.char_length("text").alias("n_chars")).distinct()
    )
    ring = with_next(ids.select("doc_id", "k"))
    lengths = ids.select(F.col("k").alias("__k"), F.col("doc_id").alias("__id"), "n_chars")
    ring = checkpointed(
        ring.join(lengths, (F.col("k") == F.col("__k")) & _same("doc_id", "__id"))
        .withColumn("cut", F.floor(F.col("n_chars") / 3).cast("int"))
        .drop("__k", "__id")
    )
    # One of the rows with the same id and text.
    once = F.row_number().over(Window.partitionBy("k", "doc_id").orderBy("k"))
    texts = keyed.repartition("k").withColumn("__nth", once).where("__nth = 1").drop("__nth")

    lent = texts.withColumnsRenamed({"doc_id": "__id", "k": "__k", "text": "__text"})
    named = ring.select(
        F.col("k").alias("to_k"), F.col("doc_id").alias("to_id"), "next_k", "next_id", "n_chars", "cut"
    )
    is_next = (F.col("__k") == F.col("next_k")) & _same("__id", "next_id")
    tails = lent.join(named, is_next).select(
        "to_k", "to_id", "next_k", "next_id", "n_chars", "cut",
        F.substring("__text", F.lit(1), F.col("cut")).alias("tail"),
    )
    is_own = (F.col("k") == F.col("to_k")) & _same("doc_id", "to_id")
    head = F.substring("text", F.lit(1), F.col("n_chars") - F.col("cut"))
    pairs = texts.join(tails, is_own).select(
        "k", "doc_id", "next_k", "next_id", F.col("n_chars").cast("bigint").alias("n_chars"),
        "text", F.concat(head, "tail").alias("edited"),
    )
    signed = signatures(pairs, ["k", "doc_id"], ["text", "edited"]).select(
        F.col("k").alias("__k"), F.col("doc_id").alias("__id"),
        as_text(F.col("text")).alias("fingerprint"), as_text(F.col("edited")).alias("edited_fingerprint"),
    )
    facts = pairs.select(
        "k", "doc_id", "next_k", "next_id", "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
    )
    same = (F.col("k") == F.col("__k")) & _same("doc_id", "__id")
    none = F.lit("0" * DIGITS * SLOTS)
    found = checkpointed(
        facts.join(signed, same, "left").drop("__k", "__id").withColumns(
            {c: F.coalesce(c, none) for c in ("fingerprint", "edited_fingerprint")}
        )
    )
    following = found.select(
        F.col("k").alias("__k"), F.col("doc_id").alias("__id"), F.col("fingerprint").alias("__next")
    )
    return found.join(following, is_next).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("__next")).alias("near_next"),
    )
