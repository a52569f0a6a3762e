"""Mixing sources to target weights by weighted fair queueing.

Each source may give a number of words, its target. Its documents are shuffled by a hash and
served one after another, twice over if need be; the virtual finish time of a served document
is the source's words so far divided by the target. All sources reach time 1 with their
target served, so sorting everything by finish time and stopping there would spend the budget,
with each source's share right at any earlier point too. The document in service at time 1 is
cut. What is served until then is known without a queue: ``taken`` and ``mixed`` clip a
source's running word sum at its target, and finish times only order the rows of ``mixed``.

Targets share ``BUDGET`` times all words by weight, none above ``CAP`` times its source's
words; what is above goes to the others by weight. That is min(weight * level, cap) for the
one level that spends the budget, found by one pass over the sources in order of cap / weight.

* A null or empty text has size 0 and is never served. A null source comes last.
* Repeated rows are served separately; ties in the hash go by doc_id, then size.
* An empty table, or one without words, gives targets of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import buckets_for, running_before, word_count

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
CAP = 2


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target of each source, from rows of (source, size).

    The windows run over one row per source, after a partial aggregate.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    weighed = per.withColumn("weight", weight)
    order = [F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()]
    ahead = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    here_on = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    capped = CAP * F.coalesce(F.sum("source_size").over(ahead), F.lit(0))
    left = BUDGET * F.sum("source_size").over(everything) - capped
    level = left / F.sum("weight").over(here_on)
    fits = level * F.col("weight") <= CAP * F.col("source_size")
    levels = weighed.select("*", F.when(fits, level).alias("level"))
    # Levels only fall once a source fits; the first that fits is the one.
    chosen = F.first("level", ignorenulls=True).over(everything)
    target = F.least(chosen * F.col("weight"), (CAP * F.col("source_size")).cast("double"))
    return levels.select("source", "source_size", target.alias("target"))


def served(docs: DataFrame, extra: list[Column] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target and ``before`` of every row, and ``extra``.

    ``before`` is the words of the source's documents ahead in the shuffled order.
    """
    sized = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("place"),
        *extra,
    )
    leading = F.conv(F.substring("place", 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    bucketed = sized.withColumn("bucket", F.floor(leading * buckets_for(docs.count())))
    ahead = running_before(
        bucketed, ["source"], "bucket", ["place", "doc_id", "size"], {"size": "before"}
    )
    t = targets(sized).withColumnRenamed("source", "of")
    return ahead.join(t, F.col("source").eqNullSafe(F.col("of"))).drop("of", "place", "bucket")


def _part(round_: int) -> Column:
    """Words served of a row in round 0 or 1."""
    start = F.col("before") + round_ * F.col("source_size")
    room = F.floor("target") - start
    return F.greatest(F.least(room, F.col("size")), F.lit(0)).cast("bigint")


def taken(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row."""
    both = sum((_part(r) for r in range(CAP)), F.lit(0)).cast("bigint")
    return served(docs).select("doc_id", "size", "source_size", "target", both.alias("taken"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, white space between words as it was."""
    pieces = F.split(text, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    leading = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    head = F.array_join(F.slice(pieces, F.lit(1), (n + leading).cast("int")), "")
    return F.regexp_replace(head, r"[\x20\x09-\x0D]+$", "")


def mixed(docs: DataFrame) -> DataFrame:
    """The mix: documents in order of virtual finish time, repeated or cut as served.

    Columns are those of ``docs``. A cut text ends after the last word served; if there is an
    ``n_chars`` column, it follows the text.
    """
    key = F.xxhash64("doc_id", "text")
    plan = served(docs, [key.alias("__row")])
    rounds = []
    for r in range(CAP):
        start = F.col("before") + r * F.col("source_size")
        finish = (start + _part(r)) / F.col("target")
        rounds.append(F.struct(_part(r).alias("words"), finish.alias("finish")))
    served_rounds = F.filter(F.array(*rounds), lambda x: x.words > 0)
    # Rows and services meet by id and text in one shuffle. Repeated rows share both: the first
    # takes the first service in the source's order, the second the next, and so on.
    services = plan.select(
        F.col("doc_id").alias("__id"), "__row", F.lit(False).alias("__is_row"),
        F.struct("before", served_rounds.alias("rounds")).alias("__service"),
    )
    rows = docs.select(
        F.col("doc_id").alias("__id"), key.alias("__row"), F.lit(True).alias("__is_row"),
        F.struct(*[docs[c] for c in docs.columns]).alias("__doc"),
    )
    met = rows.unionByName(services, allowMissingColumns=True).repartition("__id", "__row")
    alike = Window.partitionBy("__id", "__row", "__is_row").orderBy("__service.before")
    pair = Window.partitionBy("__id", "__row", "__nth")
    dealt = (
        met.withColumn("__nth", F.row_number().over(alike))
        .withColumn("__own", F.max("__service").over(pair))
        .where("__is_row")
        .select("__doc.*", F.explode("__own.rounds").alias("__s"))
    )
    whole = word_count(F.col("text")) <= F.col("__s.words")
    head = first_words(F.col("text"), F.col("__s.words"))
    text = F.when(whole, F.col("text")).otherwise(head)
    columns = {"text": text}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    picked = [columns[c].alias(c) if c in columns else F.col(f"`{c}`") for c in docs.columns]
    ordered = dealt.select(*picked, F.col("__s.finish").alias("__finish"))
    return ordered.repartitionByRange("__finish").sortWithinPartitions("__finish").drop("__finish")
