"""Conversation repair against plain Python: all audits tried on short ones, a table of whole strings on long ones."""

import hashlib
import random
import zlib
from itertools import product

import pytest
from pyspark.sql import types as T

from tickloom.llm import conversations as C
from tickloom.llm.queries import damaged

from .conftest import SF

SPACES = " \t\n\x0b\x0c\r"
SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
    + [T.StructField(c, T.StringType()) for c in ("symbols", "audit", "digest", "first", "n", "cost", "part")]
)
DFA = {("0", "s"): "1", ("0", "u"): "2", ("1", "u"): "2", ("2", "a"): "3", ("3", "u"): "2"}
NAMES = {"u": "user", "a": "assistant"}


def faults(rows):
    """Fault of each (role, text), in order."""
    out, seen = [], set()
    for role, text in rows:
        bare = text.strip(SPACES)
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def apply(edits, rows, kinds):
    """Cost and repaired rows of a string of edits, or None where it does not fit."""
    state, i, cost, out = "0", 0, 0, []
    for e in edits:
        fill = {"0": "u", "1": "u", "2": "a", "3": "u"}[state]
        if e == "I":
            cost, state = cost + 2, DFA[state, fill]
            out.append((NAMES[fill], ""))
            continue
        if i == len(rows):
            return None
        (role, text), kind, i = rows[i], kinds[i], i + 1
        if e == "D":
            cost += 3
            continue
        if kind in ("blank", "duplicate"):
            return None
        cost += kind == "truncated"
        if e == "R":
            cost, role, now = cost + 2, NAMES[fill], fill
        else:
            now = role[:1]
        if (state, now) not in DFA:
            return None
        state = DFA[state, now]
        out.append((role, text))
    return (cost, out) if i == len(rows) and state in "03" else None


def best(rows):
    """Least (cost, audit) over whole strings, from the end."""
    kinds = faults(rows)
    n = len(rows)
    table = {(n, "0"): (0, ""), (n, "1"): (4, "II"), (n, "2"): (2, "I"), (n, "3"): (0, "")}
    for i in range(n - 1, -1, -1):
        for start in "0123":
            options = []
            state, lead, paid = start, "", 0
            for _ in range(4):
                fill = {"0": "u", "1": "u", "2": "a", "3": "u"}[state]
                cost, rest = table[i + 1, state]
                options.append((paid + 3 + cost, lead + "D" + rest))
                if kinds[i] not in ("blank", "duplicate"):
                    extra = paid + (kinds[i] == "truncated")
                    cost, rest = table[i + 1, DFA[state, fill]]
                    options.append((extra + 2 + cost, lead + "R" + rest))
                    if (state, rows[i][0][:1]) in DFA:
                        cost, rest = table[i + 1, DFA[state, rows[i][0][:1]]]
                        options.append((extra + cost, lead + "K" + rest))
                state, lead, paid = DFA[state, fill], lead + "I", paid + 2
            table[i, start] = min(options)
    return table[0, "0"]


def harm(rows):
    """The damage of the query in plain Python: (conv_id, turn, role, text)."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def expected(rows):
    """The query's result in plain Python."""
    convs = {}
    for conv, *_ in rows:
        convs.setdefault(conv, [])
    for conv, turn, role, text in harm(rows):
        digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        convs[conv].append((turn is not None, turn or 0, role, digest, turn, text))
    out = {}
    for conv, lines in convs.items():
        lines.sort(key=lambda r: r[:4])
        pairs = [(r[2], r[5]) for r in lines]
        turns = [r[4] for r in lines if r[4] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        kinds = faults(pairs)
        firsts = [role[:1] for role, _ in pairs]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:]))
        cost, edits = best(pairs)
        paid, kept = apply(edits, pairs, kinds)
        assert paid == cost
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, edits, digest)
    return out


def odd_conversations():
    pick = random.Random(3)
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(pick.randrange(1, 12)):
            role = pick.choice(["user", "assistant", "assistant", "user", "system", None, "", "Ärzte", "uncle"])
            text = pick.choice(["Yes.", "No", "  ", "", None, "x" * 500 + "!", "Why?\n", "ü. ", "a\nb.", "So."])
            rows.append((conv, pick.choice([turn, turn, turn + 2, None, -1]), role, text))
    rows += [(7, 3, "user", "Again.")] * 40
    rows += [(100, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(3000)]
    rows += [(101, None, "user", "Same.")] * 5
    gone = next(t for t in range(1000) if zlib.crc32(f"102:{t}".encode()) % 20 == 0)
    return rows + [(102, gone, "user", "Dropped.")]


@pytest.fixture(scope="module")
def odd_table(spark):
    more = ["x"] * (len(SCHEMA) - 4)
    return spark.createDataFrame([(*r, *more) for r in odd_conversations()], SCHEMA)


def answer(spark, monkeypatch, queries, rows):
    from tickloom.llm import queries as Q

    monkeypatch.setattr(Q, "table", lambda *_: rows)
    return queries["op12_conversation_repair"](spark, SF).collect()


def test_every_audit_of_short_conversations():
    """The automaton's audit is the least of all strings of edits that fit."""
    pick = random.Random(1)
    for _ in range(150):
        rows = [(pick.choice(["user", "assistant", "system", "x"]), pick.choice(["a.", "b.", "c", " "])) for _ in range(pick.randrange(4))]
        kinds = faults(rows)
        tried = []
        for size in range(len(rows), 2 * len(rows) + 3):
            for edits in product("DIKR", repeat=size):
                found = apply(edits, rows, kinds)
                if found:
                    tried.append((found[0], "".join(edits)))
        symbols = "".join(
            "d" if kind in ("blank", "duplicate") else s.upper() if kind else s
            for kind, s in zip(kinds, [r[0][0] for r in rows])
        )
        assert [r[1:] for r in C.best_audits(iter([symbols[::-1]]))] == [min(tried)] == [best(rows)]


def test_nodes_are_shared_by_endings(monkeypatch):
    """A node is worked out once for all signatures with its ending."""
    made = []
    real = C.node
    monkeypatch.setattr(C, "node", lambda s, rest: made.append(s) or real(s, rest))
    signatures = sorted("".join(p)[::-1] for n in range(5) for p in product("suAd", repeat=n))
    found = {s: (cost, edits) for s, cost, edits in C.best_audits(iter(signatures))}
    assert len(made) == len(found) - 1 == 4 + 16 + 64 + 256
    for signature, got in found.items():
        assert [(s, *got) for s in [signature]] == list(C.best_audits(iter([signature[::-1]])))


def test_query_against_plain_python(spark, queries):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries["op12_conversation_repair"](spark, SF).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == expected(rows)
    assert len(got) == len({r[0] for r in rows})


def test_odd_conversations(spark, odd_table, monkeypatch, queries):
    """Null ids, turns, roles and texts, ties, repeated rows, a long one over many partitions, dropped ones."""
    monkeypatch.setattr(C, "checkpointed", lambda df: df)
    got = answer(spark, monkeypatch, queries, odd_table)
    want = expected(odd_conversations())
    assert {r[0]: tuple(r)[1:] for r in got} == want and len(got) == len(want)
    assert want[102] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repaired_rows(odd_table):
    rows = damaged(odd_table)
    found = C.judged(rows)
    repaired = {}
    for r in C.repaired(rows, found).collect():
        repaired.setdefault(r.conv_id, []).append((r.at, r.edit, r.role, r.text))
    for r in found.collect():
        lines = sorted(repaired.get(r.conv_id, []))
        assert [x[0] for x in lines] == list(range(len(lines)))
        assert "".join(x[1] for x in lines) == r.audit.replace("D", "")
        firsts = "".join(x[2][0] for x in lines)
        assert firsts.removeprefix("s").replace("ua", "") == "" and firsts != "s"


def test_no_conversations(spark, monkeypatch, queries):
    assert answer(spark, monkeypatch, queries, spark.createDataFrame([], SCHEMA)) == []
