"""Conversation repair against a plain search over whole edit strings."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from conftest import SF0001
from ledgerlens.llm import catalog
from ledgerlens.llm import turn_repair as T
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"
ROWS = [
    (1, 0, "system", "Be kind."),
    (1, 1, "user", "Hello?"),
    (1, 2, "assistant", "Hello."),
    (1, 2, "assistant", "Hello."),
    (2, None, "user", "no turn"),
    (2, 5, None, None),
    (2, 9, "assistant", "cut off"),
    (3, None, None, None),
    (None, 1, "user", "a conversation without an id."),
    (None, 2, "tool", "calls!"),
    (4, 7, "", "role without a name."),
    (5, 1, "assistant", "first."),
    (5, 2, "assistant", "second."),
    (5, 3, "system", "late."),
    (6, 0, "user", "x " * 60_000),
    (7, 3, "umpire", "initials decide."),
    (8, 0, "system", " \t\n"),
    (9, 0, "system", "alone."),
]


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def fault_of(role, text, seen):
    solid = text.strip(SPACE)
    if not solid:
        return "blank"
    if (role, text) in seen:
        return "duplicate"
    return None if solid[-1] in ".!?" else "truncated"


def moves(state, initial):
    """Next states of a role initial; '' is the start, then 's', 'u' or 'a'."""
    if initial == "s":
        return ["s"] if state == "" else []
    if initial == "u":
        return ["u"] if state != "u" else []
    if initial == "a":
        return ["a"] if state == "u" else []
    return []


def cheapest(rows, faults):
    """(cost, audit, repaired rows): every state keeps whole strings, in plain dictionaries."""

    def better(best, state, candidate):
        if state not in best or candidate[:2] < best[state][:2]:
            best[state] = candidate
            return True
        return False

    def inserts(best):
        changed = True
        while changed:
            changed = False
            for state, (cost, audit, out) in list(best.items()):
                for initial, role in (("u", "user"), ("a", "assistant")):
                    for to in moves(state, initial):
                        changed |= better(best, to, (cost + 5, audit + "I", [*out, (role, "")]))

    best = {"": (0, "", [])}
    for (role, text), fault in zip(rows, faults):
        inserts(best)
        after = {}
        for state, (cost, audit, out) in best.items():
            better(after, state, (cost + 2, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            for to in moves(state, role[:1]):
                better(after, to, (cost + more, audit + "K", [*out, (role, text)]))
            for initial, name in (("u", "user"), ("a", "assistant")):
                for to in moves(state, initial):
                    better(after, to, (cost + 1 + more, audit + "R", [*out, (name, text)]))
        best = after
    inserts(best)
    return min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])


def enumerate_all(rows, faults):
    """The same by writing out every edit string (few rows only)."""
    found = []
    options = [("D",) if f in ("blank", "duplicate") else ("D", "K", "R") for f in faults]
    gaps = len(rows) + 1
    for letters in itertools.product(*options):
        for holes in itertools.product(range(3), repeat=gaps):
            if sum(holes) > 4:
                continue
            for first in ("u", "a"):
                state, cost, audit, legal, out = "", 0, "", True, []

                def put(initial, role, text):
                    nonlocal state, legal
                    to = moves(state, initial)
                    legal &= bool(to)
                    state = to[0] if to else state
                    out.append((role, text))

                def due():
                    return ("a", "assistant") if state == "u" else ("u", "user")

                for i in range(gaps):
                    for _ in range(holes[i]):
                        put(*due(), "")
                        cost, audit = cost + 5, audit + "I"
                    if i == len(rows):
                        break
                    (role, text), letter = rows[i], letters[i]
                    audit += letter
                    if letter == "D":
                        cost += 2
                        continue
                    cost += 5 if faults[i] == "truncated" else 0
                    if letter == "K":
                        put(role[:1], role, text)
                    else:
                        cost += 1
                        put(*due(), text)
                if legal and state in ("", "a"):
                    found.append((cost, audit, list(out)))
    return min(found, key=lambda x: x[:2])


def expected(original, rows):
    by = {}
    for conv, *rest in original:
        by.setdefault(conv, [])
    for conv, turn, role, text in rows:
        by[conv].append((turn, role, text))
    out = {}
    for conv, own in by.items():
        mark = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        own = sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], mark(r)))
        if not own:
            out[conv] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
            continue
        faults, seen = [], set()
        for _, role, text in own:
            faults.append(fault_of(role, text, seen))
            seen.add((role, text))
        cost, audit, kept = cheapest([r[1:] for r in own], faults)
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        counts = [faults.count(k) for k in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, sha)
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def result(df):
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def long_conversation(conv, n, seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "assistant", "user", "system", "tool"]
    texts = ["Yes.", "no", "Why?", "", "again!", "  ", "more and more"]
    return [
        (conv, t * rng.choice([1, 2]), rng.choice(roles), rng.choice(texts) + str(rng.randrange(40)) + rng.choice(". "))
        for t in range(n)
    ]


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF0001}/conversations.parquet")
    original = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = result(catalog.op12_turn_repair(spark, SF0001))
    assert got == expected(original, damaged(original))
    assert sum(v[5] for v in got.values()) > 0


def test_awkward_rows(spark):
    table = spark.createDataFrame(ROWS, SCHEMA)
    for name in ("ck", "part", "mark", "seq", "text_", "letters", "n", "salt"):
        table = table.withColumn(name, F.lit(7))
    assert result(T.audit(table, T.damage(table))) == expected(ROWS, damaged(ROWS))
    assert result(T.audit(table, table)) == expected(ROWS, [(c, t, r or " ", x or " ") for c, t, r, x in ROWS])


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert T.audit(empty, T.damage(empty)).count() == 0
    assert T.repair_turns(empty).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_conversation_over_many_parts(spark, seed):
    """One conversation holds most rows: its parts are solved apart and chained."""
    rows = long_conversation(1, 600, seed) + long_conversation(2, 9, seed) + long_conversation(None, 30, seed + 9)
    table = spark.createDataFrame(rows, SCHEMA)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = T.ordered(table).where("ck = '1'").select("part").distinct().count()
        got = result(T.audit(table, table))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert parts > 2
    assert got == expected(rows, rows)


def test_edits_and_rows_agree(spark):
    rows = long_conversation(1, 40, 5)
    table = spark.createDataFrame(rows, SCHEMA)
    fixed = sorted(T.repair_turns(table).collect(), key=lambda r: (r["part"], r["nth"]))
    initials = "".join(r["role"][0] for r in fixed)
    assert re.fullmatch("(s?(ua)+)?", initials)
    audit = result(T.audit(table, table))[1][6]
    assert [r["edit"] for r in fixed] == [c for c in audit if c != "D"]


def test_search_agrees_with_written_out_edits():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randrange(1, 4)
        rows = [(rng.choice(["user", "assistant", "system", "x"]), str(i)) for i in range(n)]
        faults = [rng.choice([None, None, "truncated", "blank"]) for _ in rows]
        assert cheapest(rows, faults) == enumerate_all(rows, faults)


def test_survivors_are_bounded():
    """However long the conversation, the tree holds the unresolved letters only."""
    field = T.Survivors(T.NOTHING)
    rng = random.Random(1)
    held = 0
    for i in range(20_000):
        field.row(rng.choice("uuaasx"), rng.choice([T.FINE, T.FINE, T.CUT, T.BLANK]))
        held = max(held, field.unresolved())
    assert held <= 200
    assert len(field.emitted) > 19_000
