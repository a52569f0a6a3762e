"""Splitting long ordered series so that no task holds a whole key.

A window partitioned by ticker alone puts a ticker's full history into one task.
Here each row first gets its position within its key, counted chunk by chunk, and
the series is then cut into blocks of fixed length. For a window of a few rows, every
block repeats the last rows of the block before it (the halo). For recurrences the chunks
themselves are the blocks: each is summed up on its last row, and the summaries are
combined by a tree whose branches are spread over tasks (``states_before``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows below a node of the tree and nodes below a branch, as a power of two.
FAN_BITS = 6
# Rows of a key, about, that one task holds where blocks below a branch would be more.
BRANCH_ROWS = 1 << 17


def tie(df: DataFrame) -> Column:
    """An aggregate over all columns of ``df``.

    A summary that is joined back to its rows reads few columns, so Spark would prune the
    others below the shuffle and then run the input twice, once per shuffle. This keeps
    both sides' shuffles equal, and the second reuses the first.
    """
    return F.max(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).alias("_tie")


def with_ordinal(df: DataFrame, by: list[str], order: list[str], chunk: Column) -> DataFrame:
    """Add ``_ord``, the 0-based position of each row within its key.

    ``chunk`` must not decrease along ``order`` and must bound the rows of one
    (key, chunk) group. Counts per chunk are small and are summed per key; rows are
    only ranked within their chunk.
    """
    counted = with_blocks(df, by, order, chunk)
    return with_positions(counted, by).drop("_blk", "_pos")


def with_blocks(df: DataFrame, by: list[str], order: list[str], chunk: Column) -> DataFrame:
    """Add ``_blk``, the chunk of each row, and ``_pos``, its 0-based position there.

    Rows without a key or a chunk go. Later windows and joins by key and chunk need no
    further shuffle.
    """
    place = F.row_number().over(Window.partitionBy(*by, "_blk").orderBy(*order))
    return _chunked(df, by, chunk).repartition(*by, "_blk").withColumn("_pos", place.cast("bigint") - 1)


def _chunked(df: DataFrame, by: list[str], chunk: Column) -> DataFrame:
    chunked = df.withColumn("_blk", chunk)
    # Both sides of later joins drop null keys; said here, their shuffles stay equal.
    for key in (*by, "_blk"):
        chunked = chunked.where(F.col(key).isNotNull())
    # No null is left; said so, what is computed from the chunk needs no filter of its own.
    return chunked.withColumn("_blk", F.coalesce("_blk", F.lit(0).cast("bigint")))


def with_positions(blocked: DataFrame, by: list[str]) -> DataFrame:
    """Add ``_ord``, the position within the key, to rows of :func:`with_blocks`."""
    return _with_offset(blocked, by, "_blk").withColumn("_ord", F.col("_offset") + F.col("_pos")).drop("_offset")


def _with_offset(parts: DataFrame, by: list[str], part: str) -> DataFrame:
    """Add ``_offset``, the number of a key's rows in earlier parts; ``parts`` is shuffled by them."""
    sizes = parts.groupBy(*by, part).agg(F.count(F.lit(1)).alias("_n"), tie(parts))
    before = Window.partitionBy(*by).orderBy(part).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        "_tie", *by, part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return (
        parts.join(offsets, [*by, part])
        # A hash is never null; the condition only keeps the column in use.
        .where(F.col("_tie").isNotNull())
        .drop("_tie")
    )


def in_block(by: str, time: str) -> Window:
    """The rows of a block of :func:`with_branches`; windows over a node or a branch share its sort."""
    return Window.partitionBy(by, "_branch", "_node", "_blk").orderBy(time)


def with_branches(
    df: DataFrame, by: str, time: str, chunk: Column, block: int, ordinal: bool = False
) -> DataFrame:
    """Add ``_blk`` and ``_pos`` as :func:`with_blocks`, in one shuffle for whole branches of blocks.

    ``_end`` is true on a block's last row. ``block`` is the most rows that a block has. A branch has 4096 blocks, or fewer where those
    could have more than ``BRANCH_ROWS`` rows; ``_branch`` and ``_node`` tell where a row is in the
    tree of :func:`combined_before`. With ``ordinal``, also adds ``_ord``, the position within the key.
    """
    bits = max(0, min(2 * FAN_BITS, (BRANCH_ROWS // block).bit_length() - 1))
    rows = _in_tree(_chunked(df, [by], chunk), by, "_blk", bits)
    if ordinal:
        in_branch = Window.partitionBy(by, "_branch").orderBy("_node", "_blk", time)
        rows = _with_offset(rows, [by], "_branch")
        rows = rows.withColumn("_ord", F.col("_offset") + F.row_number().over(in_branch) - 1).drop("_offset")
    run = in_block(by, time)
    return rows.withColumns(
        {"_pos": F.row_number().over(run).cast("bigint") - 1, "_end": F.lead(F.lit(1)).over(run).isNull()}
    )


def _in_tree(rows: DataFrame, by: str, place: str, bits: int = 2 * FAN_BITS) -> DataFrame:
    # A shift of a column that is never null is never null: joins by it then add no filters,
    # which would make equal shuffles differ.
    return rows.withColumns(
        {"_branch": F.shiftright(place, bits), "_node": F.shiftright(place, min(bits, FAN_BITS))}
    ).repartition(by, "_branch")


Combine = Callable[[Column, Column], Column]


def _folded(summaries: Column, combine: Combine) -> Column:
    """An array's summaries, each combined with all before it, one step a summary."""
    rest = F.slice(summaries, F.lit(2), F.greatest(F.size(summaries), F.lit(1)))
    return F.aggregate(
        rest, F.slice(summaries, 1, 1), lambda done, s: F.concat(done, F.array(combine(F.element_at(done, -1), s)))
    )


def _scanned(
    rows: DataFrame, part: list[str], order: list[str], of: str, combine: Combine, before: str, whole: str
) -> DataFrame:
    """Add ``before``, all ``of`` on earlier rows of a part combined, and ``whole``, all of them, on its last row.

    The few rows of a part that have ``of`` are listed and combined once, on its first row.
    """
    run = Window.partitionBy(*part).orderBy(*order)
    every = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns(
        {
            "_list": F.collect_list(of).over(every),
            "_rank": F.count(of).over(run.rowsBetween(Window.unboundedPreceding, -1)).cast("int"),
            "_opens": F.lag(F.lit(1)).over(run).isNull(),
            "_ends": F.lead(F.lit(1)).over(run).isNull(),
        }
    )
    rows = rows.withColumn("_list", F.when(F.col("_opens"), _folded(F.col("_list"), combine)))
    rows = rows.withColumn("_list", F.first("_list").over(every))
    return rows.withColumns(
        {
            before: F.get("_list", F.col("_rank") - 1),
            whole: F.when(F.col("_ends"), F.element_at("_list", -1)),
        }
    ).drop("_list", "_rank", "_opens")


def combined_before(
    rows: DataFrame, by: str, place: str, combine: Combine, order: tuple[str, ...] = ()
) -> DataFrame:
    """Add ``_before``: the summaries ``_s`` of all earlier places of a key, combined; null for the first.

    ``combine(a, b)`` is the summary of a stretch from those of its two parts, so it may be
    applied in any grouping. A place has one row or, in rows of :func:`with_branches`, several
    by ``order``, the last of which has the summary. The places of a key are the leaves of a
    tree: 64 of them make a node, 64 nodes a branch, and a branch is what one task holds. What
    is before a place in its node, before its node in the branch and before its branch are
    combined, a step each: a node's summaries are listed once and combined from the left, and
    so are a branch's nodes. Only the root needs a second shuffle, of one row per branch. No
    row holds more than 64 summaries, but for the root's list of a key's branches.
    """
    own = "_branch" not in rows.columns
    if own:
        rows = _in_tree(rows, by, place)
    shuffled = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).alias("_tie")

    def together(first: Column, second: Column) -> Column:
        return F.when(first.isNull(), second).when(second.isNull(), first).otherwise(combine(first, second))

    rows = _scanned(rows, [by, "_branch", "_node"], [place, *order], "_s", combine, "_inner", "_whole")
    rows = _scanned(rows, [by, "_branch"], ["_node", place, *order], "_whole", combine, "_nodes", "_sum")
    branches = rows.where("_ends").select(by, "_branch", "_sum", shuffled)
    listed = branches.groupBy(by).agg(
        F.sort_array(F.collect_list(F.struct("_branch", "_sum"))).alias("_list"), F.max("_tie").alias("_tie")
    )
    # What is before a branch is what there is up to the one before it.
    after_first = F.slice(F.col("_list._branch"), F.lit(2), F.size("_list"))
    outer = listed.where(F.col("_tie").isNotNull()).select(
        F.col(by).alias("_by"), F.inline(F.arrays_zip(after_first.alias("_of"), _folded(F.col("_list._sum"), combine).alias("_outer"))),
    )
    here = (F.col(by) == F.col("_by")) & (F.col("_branch") == F.col("_of"))
    rows = (
        rows.join(outer, here, "left")
        .withColumn("_inner", together(F.col("_nodes"), F.col("_inner")))
        .withColumn("_before", together(F.col("_outer"), F.col("_inner")))
    )
    helpers = ("_by", "_of", "_outer", "_inner", "_nodes", "_whole", "_sum", "_ends")
    return rows.drop(*helpers, *(["_branch", "_node"] if own else []))


def states_before(
    df: DataFrame,
    by: str,
    time: str,
    summary: list[Column],
    start: Callable[[Column], Column],
    step: Combine,
    combine: Combine,
) -> DataFrame:
    """Rows of ``df`` (of :func:`with_branches`) and ``_state``, the state of their key before the block.

    ``summary`` are columns that sum up a block so far, on its last row all of it. ``start`` is
    the state before the first block, in terms of a summary ``b`` that begins with it;
    ``step(state, b)`` is the state after a stretch and ``combine(a, b)`` the summary of two
    stretches in a row. Also adds ``_opens``, true in a key's first block. Neither rows nor
    summaries of a key meet in one task: see :func:`combined_before`.
    """
    rows = df.withColumn("_so_far", F.struct(*summary)).withColumn("_s", F.when(F.col("_end"), F.col("_so_far")))
    found = combined_before(rows, by, "_blk", combine, (time,))
    before, own = F.col("_before"), F.col("_so_far")
    state = F.when(before.isNull(), start(own)).otherwise(step(start(before), before))
    return found.withColumn("_state", state).withColumn("_opens", before.isNull()).drop(
        "_s", "_so_far", "_before", "_branch", "_node", "_end"
    )


def halo_blocks(df: DataFrame, block: int, halo: int) -> DataFrame:
    """Cut rows carrying ``_ord`` into blocks of ``block`` rows.

    Adds ``_blk``, ``_pos`` (position within the block, halo included) and ``_own``
    (false for the repeated rows). A block has at most ``block + halo`` rows.
    """
    if halo > block:
        raise ValueError("the halo must fit into one block")
    ordinal, size = F.col("_ord"), F.lit(block).cast("bigint")
    home = F.call_function("div", ordinal, size)
    in_halo = F.pmod(ordinal, size) >= block - halo
    blocks = F.when(in_halo, F.array(home, home + 1)).otherwise(F.array(home))
    start = F.when(F.col("_blk") > 0, F.col("_blk") * size - halo).otherwise(F.lit(0))
    return (
        df.withColumn("_blk", F.explode(blocks))
        .withColumn("_pos", ordinal - start)
        .withColumn("_own", F.col("_blk") == home)
    )


def owned(df: DataFrame) -> DataFrame:
    """Drop the repeated rows and the helper columns."""
    return df.where("_own").drop("_ord", "_blk", "_pos", "_own")
