"""Cheapest repair of the turn structure of conversations, shared by equal endings.

Each row has a role initial and a fault: ``blank``, else ``duplicate`` (role and text seen
earlier in the conversation), else ``truncated`` (the last visible character ends no sentence),
else none. A conversation's signature has one symbol a row. Rows are sorted globally by range,
so a conversation of any size is spread over tasks, each giving the symbols of its share.

Distinct signatures are sorted from their ends. Two of them share the automaton's nodes of
their common ending: a node stands for one distinct rest of a signature (the minimal automaton
shared by suffixes). Along the sorted signatures only the nodes past the common ending are new,
and for each new node and each state of the grammar ``(s?(ua)+)?`` the cost-to-go and the first
edit of the best audit are worked out once, from those of the node after it. At equal costs the
candidates differ in their first edit, so the ASCII-least of these gives the least audit.

Edits: Keep 0, Rerole to user or assistant 2, Delete 3 (the only one for blank and duplicate
rows), Insert an empty user or assistant row 2; a truncated row that stays adds 1.

* Null roles and texts are one space. A null ``conv_id`` is a conversation like any other. Null
  turns come first. Rows of one turn go by role, then by the SHA-256 of role and text. Of equal
  rows (conversation, turn, role, text) the first stays and the others are duplicates.
* An empty table has no conversations. Other columns are not read, whatever their names.
* A signature and an audit have a character a row or edit and are cells of a row. The rows of a
  repaired conversation pass one after another through one task, which holds the audit and one
  batch; that is needed since a SHA-256 over a conversation's text has to be taken in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import checkpointed

SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
# Symbols of a row by fault, each for the initials s, u, a and all others.
SOUND, TRUNCATED, BLANK, DUPLICATE = "suax", "SUAX", "0123", "4567"
SYMBOLS = SOUND + TRUNCATED + BLANK + DUPLICATE
MUST_GO = "d"

# States of the grammar: at the start, after a system row, after a user row, after an assistant row.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = ({"s": AFTER_S, "u": AFTER_U}, {"u": AFTER_U}, {"a": AFTER_A}, {"u": AFTER_U})
# The one user or assistant row that may come next, by state.
FILL = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
FILL_ROLE = ("user", "user", "assistant", "user")
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
CUT_OFF = 1

# Cost-to-go and first edit by state: a node of the automaton.
Node = tuple[tuple[int, str], ...]


def _inserted(best: list[tuple[int, str]]) -> Node:
    """Let rows be inserted first; two fills lead from any state to one reached before."""
    for _ in range(2):
        best = [min(best[q], (INSERT + best[FILL[q]][0], "I")) for q in range(4)]
    return tuple(best)


FAR = 1 << 60
END_NODE = _inserted([(0, ""), (FAR, ""), (FAR, ""), (0, "")])


def node(symbol: str, rest: Node) -> Node:
    """The node of a signature's rest that begins with ``symbol``."""
    initial = symbol.lower()
    extra = CUT_OFF if symbol in TRUNCATED else 0
    best = []
    for q in range(4):
        found = (DELETE + rest[q][0], "D")
        if symbol != MUST_GO:
            found = min(found, (REROLE + extra + rest[FILL[q]][0], "R"))
            if initial in NEXT[q]:
                found = min(found, (KEEP + extra + rest[NEXT[q][initial]][0], "K"))
        best.append(found)
    return _inserted(best)


def audit(signature: str, nodes: list[Node]) -> str:
    """The edits of the best path; ``nodes[k]`` is that of the last k symbols."""
    state, left, out = START, len(signature), []
    while edit := nodes[left][state][1]:
        out.append(edit)
        if edit in "IR":
            state = FILL[state]
        elif edit == "K":
            state = NEXT[state][signature[-left].lower()]
        left -= edit != "I"
    return "".join(out)


def best_audits(backward: Iterator[str]) -> Iterator[tuple[str, int, str]]:
    """Signature, cost and audit for signatures written backward, which come in sorted order."""
    nodes, last = [END_NODE], ""
    for signature in backward:
        shared = len(commonprefix((last, signature)))
        del nodes[shared + 1 :]
        for symbol in signature[shared:]:
            nodes.append(node(symbol, nodes[-1]))
        forward = signature[::-1]
        yield forward, nodes[-1][START][0], audit(forward, nodes)
        last = signature


def _spaced(rows: DataFrame) -> DataFrame:
    one = [F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")]
    return rows.select("conv_id", "turn", *one)


def _digest() -> Column:
    """Tells role and text apart, in 32 bytes."""
    size = F.length("role").cast("string")
    return F.unhex(F.sha2(F.concat(size, F.lit(":"), "role", "text"), 256))


def _kind(rows: DataFrame, column: str) -> str:
    return rows.schema[column].dataType.simpleString()


def marked(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, n (equal rows) and the symbols of the first and the others."""
    bare = F.rtrim("text", F.lit(SPACE))
    lines = (
        _spaced(rows)
        .select(
            "conv_id", "turn", "role", _digest().alias("digest"), (bare == "").alias("blank"),
            (~F.right(bare, F.lit(1)).isin(*ENDS)).alias("cut"),
        )
        .groupBy("conv_id", "turn", "role", "digest", "blank", "cut")
        .agg(F.count("*").alias("n"))
    )
    # Nulls first: false sorts before true.
    firsts = lines.groupBy("conv_id", "digest").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first")
    )
    firsts = firsts.select(
        F.col("conv_id").alias("__conv"), F.col("digest").alias("__digest"),
        F.col("first.turn").alias("__turn"),
    )
    match = F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("digest") == F.col("__digest"))
    at = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.instr(F.lit("sua"), F.substring("role", 1, 1)))
    row = F.coalesce(at, F.lit(4))
    again = F.when(F.col("blank"), F.lit(BLANK)).otherwise(F.lit(DUPLICATE))
    first = (
        F.when(F.col("blank"), F.lit(BLANK))
        .when(~F.col("turn").eqNullSafe(F.col("__turn")), F.lit(DUPLICATE))
        .when(F.col("cut"), F.lit(TRUNCATED))
        .otherwise(F.lit(SOUND))
    )
    return lines.join(firsts, match).select(
        "conv_id", "turn", "role", "digest", "n",
        F.substring(first, row, F.lit(1)).alias("symbol"),
        F.substring(again, row, F.lit(1)).alias("again"),
    )


def _shares(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """One row per conversation of a sorted partition: its symbols and turns there."""
    part = TaskContext.get().partitionId()
    names = ["conv_id", "part", "symbols", "low", "high", "turns"]
    types = [kind, pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    done: list[list] = []
    current: list | None = None

    def batch() -> pa.RecordBatch:
        columns = zip(*[[c, part, "".join(s), *rest] for c, s, *rest in done])
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types)], names)

    for rows in batches:
        columns = [rows.column(c).to_pylist() for c in ("conv_id", "turn", "n", "symbol", "again")]
        for conv, turn, n, symbol, again in zip(*columns):
            if current is None or current[0] != conv:
                if current is not None:
                    done.append(current)
                current = [conv, [], None, None, 0]
            current[1].append(symbol + again * (n - 1))
            if turn is not None:
                if current[3] != turn:
                    current[4] += 1
                current[2] = turn if current[2] is None else current[2]
                current[3] = turn
        if len(done) >= 10_000:
            yield batch()
            done = []
    if current is not None:
        done.append(current)
        yield batch()


def signatures(rows: DataFrame) -> DataFrame:
    """conv_id, symbols (one a row, in order) and gaps, of every conversation of ``rows``."""
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]
    dealt = marked(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    kind = rows.sparkSession.createDataFrame([], rows.select("conv_id").schema).toArrow().schema[0].type

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _shares(batches, kind)

    schema = f"conv_id {_kind(rows, 'conv_id')}, part int, symbols string, low long, high long, turns long"
    shares = dealt.mapInArrow(share, schema)
    by_part = F.array_sort(F.collect_list(F.struct("part", "symbols", "low", "high", "turns")))
    whole = shares.groupBy("conv_id").agg(by_part.alias("shares"))
    known = F.filter("shares", lambda s: s["low"].isNotNull())
    # A turn that goes on in the next share has been counted in both.
    met = F.zip_with(
        F.slice("known", F.lit(1), F.size("known") - 1), F.slice("known", F.lit(2), F.size("known")),
        lambda a, b: F.when(a["high"] == b["low"], F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")),
    )
    total = F.aggregate("known", F.lit(0).cast("long"), lambda n, s: n + s["turns"])
    distinct = total - F.aggregate(met, F.lit(0).cast("long"), lambda n, m: n + m)
    span = F.array_max(F.transform("known", lambda s: s["high"])) - F.array_min(F.transform("known", lambda s: s["low"]))
    return whole.withColumn("known", known).select(
        "conv_id",
        F.array_join(F.transform("shares", lambda s: s["symbols"]), "").alias("symbols"),
        F.when(F.size("known") > 0, span + 1 - distinct).otherwise(F.lit(0).cast("long")).alias("gaps"),
    )


def audits(signatures: DataFrame) -> DataFrame:
    """signature, cost and audit of every distinct ``signature``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        backward = (s for batch in batches for s in batch.column("backward").to_pylist())
        rows: list[tuple] = []
        for found in best_audits(backward):
            rows.append(found)
            if len(rows) == 10_000:
                yield _audit_batch(rows)
                rows = []
        if rows:
            yield _audit_batch(rows)

    distinct = signatures.select(F.reverse("signature").alias("backward")).distinct()
    return (
        distinct.repartitionByRange("backward").sortWithinPartitions("backward")
        .mapInArrow(work, "signature string, cost long, audit string")
    )


def _audit_batch(rows: list[tuple]) -> pa.RecordBatch:
    signature, cost, edits = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(signature, pa.string()), pa.array(cost, pa.int64()), pa.array(edits, pa.string())],
        ["signature", "cost", "audit"],
    )


def _count(symbols: str) -> Column:
    return F.regexp_count("symbols", F.lit(f"[{symbols}]")).cast("long")


def judged(rows: DataFrame) -> DataFrame:
    """Gaps, faults, illegal neighbours, cost and audit of every conversation of ``rows``."""
    found = signatures(rows).withColumn(
        "signature", F.translate("symbols", BLANK + DUPLICATE, MUST_GO * 8)
    )
    # Read three times below; the sorted rows are not sorted again for each.
    found = checkpointed(found)
    initials = F.translate("symbols", SYMBOLS, SOUND * 4)
    legal = F.regexp_count(initials, F.lit("s(?=u)|u(?=a)|a(?=u)"))
    return found.join(audits(found), "signature").select(
        "conv_id", "gaps",
        _count(BLANK).alias("blank"),
        _count(DUPLICATE).alias("duplicate"),
        _count(TRUNCATED).alias("truncated"),
        (F.length("symbols") - 1 - legal).cast("long").alias("illegal"),
        "cost", "audit",
    )


def _edited(edits: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """edit, role and text of the repaired conversation; ``rows`` are the damaged ones in order."""
    state = START
    for edit in edits:
        if edit == "I":
            role, text = FILL_ROLE[state], ""
        else:
            role, text = next(rows)
        if edit == "D":
            continue
        if edit == "R":
            role = FILL_ROLE[state]
        state = NEXT[state][role[0]]
        yield edit, role, text


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """conv_id, audit and the rows of each conversation of a sorted partition."""
    flat = (
        row
        for batch in batches
        for row in zip(*[(v.as_py() for v in batch.column(c)) for c in ("conv_id", "audit", "role", "text")])
    )
    head = next(flat, None)
    while head is not None:
        conv, edits, following = head[0], head[1], []

        def rows(following=following):
            for row in flat:
                if row[1] is not None:
                    following.append(row)
                    return
                yield row[2], row[3]

        own = rows()
        yield conv, edits, own
        for _ in own:
            pass
        head = following[0] if following else None


def _dealt(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Audits and rows of a conversation in one task, the audit ahead of its sorted rows."""
    heads = found.select(
        "conv_id", F.lit(None).cast(_kind(rows, "turn")).alias("turn"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
        F.lit(None).cast("binary").alias("digest"), "audit",
    )
    lines = _spaced(rows).withColumn("digest", _digest()).withColumn("audit", F.lit(None).cast("string"))
    order = ["conv_id", F.col("audit").isNull(), F.asc_nulls_first("turn"), "role", "digest"]
    together = heads.unionByName(lines).repartition("conv_id").sortWithinPartitions(*order)
    return together.select("conv_id", "audit", "role", "text")


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: conv_id, at (from 0), edit, role and text.

    ``found`` is :func:`judged` of ``rows``.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, edits, own in _conversations(batches):
            rows: list[tuple] = []
            for at, (edit, role, text) in enumerate(_edited(edits, own)):
                rows.append((conv, at, edit, role, text))
                if len(rows) == 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names)

    names = ["conv_id", "at", "edit", "role", "text"]
    kind = found.sparkSession.createDataFrame([], found.select("conv_id").schema).toArrow().schema[0].type
    types = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
    schema = f"conv_id {_kind(rows, 'conv_id')}, at long, edit string, role string, text string"
    return _dealt(rows, found).mapInArrow(work, schema)


def joined_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, audit and the SHA-256 of the repaired ``role:text`` lines, joined by newlines."""
    kind = found.sparkSession.createDataFrame([], found.select("conv_id").schema).toArrow().schema[0].type

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for conv, edits, own in _conversations(batches):
            digest, between = hashlib.sha256(), ""
            for _, role, text in _edited(edits, own):
                digest.update(f"{between}{role}:{text}".encode())
                between = "\n"
            out.append((conv, digest.hexdigest()))
            if len(out) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)], names)

    names, types = ["conv_id", "repaired_sha256"], [kind, pa.string()]
    schema = f"conv_id {_kind(rows, 'conv_id')}, repaired_sha256 string"
    return _dealt(rows, found).mapInArrow(work, schema)
