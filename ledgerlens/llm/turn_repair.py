"""Conversation structure repair: the cheapest edits that give legal turns.

A repaired conversation's role initials are ``(s?(ua)+)?``.  Edits: Keep a row
(0), Rerole it to user or assistant (1), Delete it (2; blank and duplicate rows
must go), Insert an empty user or assistant row anywhere (5); a truncated row
that isn't deleted adds 5.  Of equally cheap edits the least string of initials
wins.

Method: Viterbi over four states (nothing yet, after s, after u, after a) with
survivors in a backpointer tree.  Nodes count their references; a node that no
survivor needs goes at once, and once all survivors share an ancestor the edits
up to it are emitted, so a conversation of any length is read as a stream.  A
tie compares the complete unresolved suffixes.  A survivor that another one
beats whatever follows is dropped, else "all deleted so far" would never share
an ancestor with the rest.  (Rows whose best edits hang on the very end, such
as user rows alone, stay unresolved until then: one node a row.)

At scale: rows are range-partitioned by conversation and turn, so a
conversation of a third of all rows is spread over many tasks.  A part
(range partition) that begins inside a conversation solves its rows from each
of the four states; those few paths per part are then chained, in order, by the
same Viterbi with whole parts as steps, and each part applies its own edits.
Paths of equal rows and cost are never prefixes of each other (a row gives one
letter of fixed cost, inserts cost more), so chaining least parts is exact.

Only the digest of the repaired rows passes a conversation through one task:
SHA-256 is a chain.  It streams there and holds one Arrow batch.

Defined cases: null roles and texts count as one space; null turns come first;
rows of one turn are ordered by role and the hash of role and text; a null
conversation id is a conversation of its own, written as a space where it is
hashed.  An empty role has no initial and is legal nowhere.  A conversation
without rows after the damage has zeros, an empty audit and the hash of the
empty string; an empty table gives no rows.  Further columns of the input play
no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import scratch
from ledgerlens.llm.tasks import map_task

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: What is wrong with a row, first fault first.
FINE, BLANK, DUPLICATE, CUT = 0, 1, 2, 3
#: States: role initials so far, by their end.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Copies of the narrow side in the join that finds repeated rows.
SALTS = 16

_PATHS = "array<struct<start:int,end:int,cost:long,letters:string>>"
SEGMENTS = (
    "ck string, part long, n long, blank long, duplicate long, truncated long, illegal long, turns long, "
    "least long, most long, first_turn long, last_turn long, opens string, closes string, "
    f"paths {_PATHS}"
)
SOLVED = (
    "ck string, part long, start int, letters string, gaps long, blank long, duplicate long, "
    "truncated long, illegal long, cost long, audit string"
)
REPAIRED = "ck string, part long, nth long, turn long, role string, text string, edit string"


# ------------------------------------------------------------------ survivors


def _moves(state: int) -> dict[str, int]:
    """Next state by the initial of the next row that stays."""
    if state == USER:
        return {"a": ASSISTANT}
    return {"u": USER, "s": SYSTEM} if state == NOTHING else {"u": USER}


def _steps(initial: str, fault: int) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, letters) of one row, inserts before it included."""
    least: dict[tuple[int, int], tuple[int, str]] = {}
    for begin in range(4):
        state, cost, inserts = begin, 0, ""
        for _ in range(3):
            moves = _moves(state)
            options = [(state, DELETE, "D")]
            if fault not in (BLANK, DUPLICATE):
                extra = TRUNCATED if fault == CUT else 0
                options += [(to, extra, "K") for i, to in moves.items() if i == initial]
                options += [(to, extra + REROLE, "R") for i, to in moves.items() if i != "s"]
            for to, more, letter in options:
                found = (cost + more, inserts + letter)
                least[begin, to] = min(found, least.get((begin, to), found))
            state, cost, inserts = moves.get("a", moves.get("u")), cost + INSERT, inserts + "I"
    return [(begin, to, *found) for (begin, to), found in least.items()]


_ROW_STEPS = {(i, f): _steps(i, f) for i in ("s", "u", "a", "") for f in (FINE, BLANK, DUPLICATE, CUT)}
_END_STEPS = [
    (NOTHING, NOTHING, 0, ""),
    (SYSTEM, NOTHING, 2 * INSERT, "II"),
    (USER, NOTHING, INSERT, "I"),
    (ASSISTANT, NOTHING, 0, ""),
]
#: _LAG[y][x]: whatever follows, the rest costs from state y at most so much more
#: than from x (y inserts its way to x, or deletes the system row x may keep).
_LAG = {
    NOTHING: {SYSTEM: 0, USER: INSERT, ASSISTANT: 0},
    SYSTEM: {NOTHING: 2 * INSERT + DELETE, USER: INSERT, ASSISTANT: 2 * INSERT},
    USER: {NOTHING: INSERT + DELETE, SYSTEM: INSERT, ASSISTANT: INSERT},
    ASSISTANT: {NOTHING: DELETE, SYSTEM: 0, USER: INSERT},
}


class Node:
    """Letters after those of the parent; ``refs`` counts children and survivors."""

    __slots__ = ("parent", "label", "refs", "depth", "tag")

    def __init__(self, parent: Node | None, label: str, tag=None):
        self.parent, self.label, self.refs, self.tag = parent, label, 1, tag
        self.depth = parent.depth + 1 if parent else 0
        if parent:
            parent.refs += 1


def release(node: Node) -> None:
    """A survivor leaves: nodes that nothing else refers to go, from its own upwards."""
    node.refs -= 1
    while node.refs == 0 and node.parent is not None:
        up, node.parent = node.parent, None
        up.refs -= 1
        node = up


class Survivors:
    """The best path to each state; emits what all of them share.

    ``best[state]`` is (cost, rank, node).  Ranks order the survivors' complete
    unresolved strings: none is a prefix of another, since each ends with a
    row's letter, so longer strings compare as (rank of the old one, new
    letters) and a tie costs the same however long the unresolved strings are.
    A survivor goes as well if another one is cheaper whatever follows.
    """

    def __init__(self, start: int):
        self.root = Node(None, "")
        self.best: dict[int, tuple[int, int, Node]] = {start: (0, 0, self.root)}
        self.emitted: list[tuple[str, object]] = []
        self.limit = 64

    def _advance(self, steps) -> None:
        found: dict[int, tuple[tuple[int, int, str], Node, object]] = {}
        for begin, to, cost, letters, tag in steps:
            old = self.best.get(begin)
            if old is not None:
                key = (old[0] + cost, old[1], letters)
                if to not in found or key < found[to][0]:
                    found[to] = (key, old[2], tag)
        lost = [x for x in found for y in found if x != y and found[y][0][0] + _LAG[y][x] < found[x][0][0]]
        for state in set(lost):
            del found[state]
        before, self.best = self.best, {}
        for rank, (state, (key, node, tag)) in enumerate(sorted(found.items(), key=lambda f: f[1][0][1:])):
            self.best[state] = (key[0], rank, Node(node, key[2], tag))
        for _, _, node in before.values():
            release(node)
        if self.unresolved() >= self.limit:
            self.settle()
            self.limit = max(64, 2 * self.unresolved())

    def unresolved(self) -> int:
        return max(node.depth for _, _, node in self.best.values()) - self.root.depth

    def settle(self) -> None:
        """Emit the letters up to the survivors' latest common ancestor."""
        chain, node = [], next(iter(self.best.values()))[2]
        while node is not self.root:
            chain.append(node)
            node = node.parent
        while chain and self.root.refs == 1:
            below = chain.pop()
            self.emitted.append((below.label, below.tag))
            below.parent, self.root = None, below

    def row(self, initial: str, fault: int) -> None:
        steps = _ROW_STEPS[initial if initial in ("s", "u", "a") else "", fault]
        self._advance((*step, None) for step in steps)

    def chain(self, paths: list[dict], tag) -> None:
        """A whole part as one step: its paths from each state to each state."""
        self._advance((p["start"], p["end"], p["cost"], p["letters"], (tag, p["start"])) for p in paths)

    def finish(self) -> int:
        """Keep the best legal end only; its cost."""
        self._advance((*step, None) for step in _END_STEPS)
        self.settle()
        return self.best[NOTHING][0]

    def paths(self, start: int) -> list[dict]:
        """The survivors as paths; ``start`` is where they began."""
        shared = "".join(label for label, _ in self.emitted)
        out = []
        for state, (cost, _, node) in sorted(self.best.items()):
            tail = []
            while node is not self.root:
                tail.append(node.label)
                node = node.parent
            out.append({"start": start, "end": state, "cost": cost, "letters": shared + "".join(reversed(tail))})
        return out


# ------------------------------------------------------------------ parts


class Segment:
    """The rows of one conversation in one part."""

    def __init__(self, ck: str, part: int, inside: bool):
        self.starts = {s: Survivors(s) for s in (range(4) if inside else (NOTHING,))}
        self.row_ = {"ck": ck, "part": part, "n": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.row_ |= {"turns": 0, "least": None, "most": None, "first_turn": None, "last_turn": None}
        self.row_ |= {"opens": None, "closes": None}

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        r = self.row_
        if r["n"] == 0:
            r["opens"], r["first_turn"] = initial, turn
        else:
            r["illegal"] += r["closes"] + initial not in ("su", "ua", "au")
        if turn is not None:
            if r["most"] is None or turn != r["most"]:
                r["turns"] += 1
            r["least"], r["most"] = turn if r["least"] is None else r["least"], turn
        r["closes"], r["last_turn"] = initial, turn
        r["n"] += 1
        r["blank"] += fault == BLANK
        r["duplicate"] += fault == DUPLICATE
        r["truncated"] += fault == CUT
        for survivors in self.starts.values():
            survivors.row(initial, fault)

    def result(self) -> dict:
        return self.row_ | {"paths": [p for s, v in self.starts.items() for p in v.paths(s)]}


_SEGMENT_ARROW = pa.schema(
    [("ck", pa.string()), ("part", pa.int64()), ("n", pa.int64())]
    + [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "turns", "least", "most")]
    + [("first_turn", pa.int64()), ("last_turn", pa.int64()), ("opens", pa.string()), ("closes", pa.string())]
    + [
        (
            "paths",
            pa.list_(
                pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("letters", pa.string())])
            ),
        )
    ]
)
_SOLVED_ARROW = pa.schema(
    [("ck", pa.string()), ("part", pa.int64()), ("start", pa.int32()), ("letters", pa.string())]
    + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string())]
)
_REPAIRED_ARROW = pa.schema(
    [("ck", pa.string()), ("part", pa.int64()), ("nth", pa.int64()), ("turn", pa.int64())]
    + [(c, pa.string()) for c in ("role", "text", "edit")]
)
_ROWS_OUT = 4096


def _tuples(batches, *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(n).to_pylist() for n in names])


def _batched(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    out: list[dict] = []
    for row in rows:
        out.append(row)
        if len(out) >= _ROWS_OUT:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def segment_batches(batches) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part and place in it, to one row per conversation and part."""

    def segments():
        own, at = None, None
        for ck, part, turn, initial, fault in _tuples(batches, "ck", "part", "turn", "initial", "fault"):
            if (part, ck) != at:
                if own:
                    yield own.result()
                # A part's first conversation may have begun in an earlier part.
                own, at = Segment(ck, part, inside=at is None or at[0] != part), (part, ck)
            own.add(turn, initial, fault)
        if own:
            yield own.result()

    yield from _batched(segments(), _SEGMENT_ARROW)


def _solve(parts: list[dict]) -> Iterator[dict]:
    field = Survivors(NOTHING)
    sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    turns, least, most, before = 0, None, None, None
    for p in parts:
        field.chain(p["paths"], p["part"])
        for name in sums:
            sums[name] += p[name]
        turns += p["turns"]
        if before is not None:
            sums["illegal"] += before["closes"] + p["opens"] not in ("su", "ua", "au")
            if p["first_turn"] is not None and p["first_turn"] == before["last_turn"]:
                turns -= 1
        least = p["least"] if least is None else least
        most = p["most"] if p["most"] is not None else most
        before = p
    cost = field.finish()
    letters: dict[int, list] = {}
    last = None
    for label, tag in field.emitted:
        if tag is not None:
            last, start = tag
            letters[last] = [start, label]
        else:
            letters[last][1] += label
    gaps = 0 if least is None else most - least + 1 - turns
    for part, (start, own) in letters.items():
        yield {"ck": parts[0]["ck"], "part": part, "start": start, "letters": own}
    audit = "".join(own for _, own in letters.values())
    yield {"ck": parts[0]["ck"], "gaps": gaps, "cost": cost, "audit": audit, **sums}


def solve_batches(batches) -> Iterator[pa.RecordBatch]:
    """Segments sorted by conversation and part, to the parts' edits and a conversation's totals."""

    def solved():
        parts: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if parts and parts[0]["ck"] != row["ck"]:
                    yield from _solve(parts)
                    parts = []
                parts.append(row)
        if parts:
            yield from _solve(parts)

    yield from _batched(solved(), _SOLVED_ARROW)


def repair_batches(batches) -> Iterator[pa.RecordBatch]:
    """A part's rows after the row with its edits, to the rows that the edits leave."""

    def rows():
        letters, at, state, nth, part, ck = "", 0, NOTHING, 0, None, None

        def step(role: str) -> None:
            nonlocal state
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]]

        def inserted():
            nonlocal at, nth
            while at < len(letters) and letters[at] == "I":
                role = "assistant" if state == USER else "user"
                step(role)
                yield {"ck": ck, "part": part, "nth": nth, "turn": None, "role": role, "text": "", "edit": "I"}
                at, nth = at + 1, nth + 1

        columns = ("ck", "part", "turn", "role", "text", "start", "letters")
        for own, own_part, turn, role, text, start, own_letters in _tuples(batches, *columns):
            if own_letters is not None:
                yield from inserted()  # those at the end of the part before
                letters, at, state, nth, part, ck = own_letters, 0, start, 0, own_part, own
                continue
            yield from inserted()
            edit, at = letters[at], at + 1
            if edit == "D":
                continue
            if edit == "R":
                role = "assistant" if state == USER else "user"
            step(role)
            yield {"ck": ck, "part": part, "nth": nth, "turn": turn, "role": role, "text": text, "edit": edit}
            nth += 1
        yield from inserted()

    yield from _batched(rows(), _REPAIRED_ARROW)


def digest_batches(batches) -> Iterator[pa.RecordBatch]:
    """Repaired rows in order, to one hash per conversation."""

    def hashes():
        at, digest = None, None
        for ck, role, text in _tuples(batches, "ck", "role", "text"):
            line = f"{role}:{text}".encode()
            if ck == at:
                digest.update(b"\n" + line)
                continue
            if at is not None:
                yield {"ck": at, "sha": digest.hexdigest()}
            at, digest = ck, hashlib.sha256(line)
        if at is not None:
            yield {"ck": at, "sha": digest.hexdigest()}

    yield from _batched(hashes(), pa.schema([("ck", pa.string()), ("sha", pa.string())]))


# ------------------------------------------------------------------ frames


def _written(name: str) -> Column:
    """A value as text, null as one space."""
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given the role user, by crc32(conv_id:turn) mod 20."""
    kind = F.crc32(F.concat(_written("conv_id"), F.lit(":"), _written("turn"))) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(_written("role")).alias("role"),
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.translate(_written("text"), ".!?", ""))
        .otherwise(_written("text"))
        .alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(kind == 3, F.lit(2)).otherwise(F.lit(1)))).alias("copy"),
        kind.alias("kind"),
    )
    return rows.where(F.col("kind") != 0).select("conv_id", "turn", "role", "text")


def ordered(turns: DataFrame) -> DataFrame:
    """The rows in order, cut into parts, written once: ``seq`` numbers them, ``part`` is their part."""
    rows = turns.select(
        _written("conv_id").alias("ck"),
        F.col("turn").cast("long").alias("turn"),
        _written("role").alias("role"),
        _written("text").alias("text"),
    ).withColumn("mark", F.unhex(F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256)))
    order = ["ck", "turn", "role", "mark"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.withColumn("seq", F.monotonically_increasing_id())
    # The upper bits of the number are the partition it was given in.
    return scratch(rows.withColumn("part", F.shiftright("seq", 33)), "turns-ordered")


def faults(rows: DataFrame) -> DataFrame:
    """Ordered rows without texts, with each row's first fault."""
    solid = F.regexp_extract("text", r"(?s)([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    narrow = rows.select(
        "ck", "part", "seq", "turn", "mark", F.substring("role", 1, 1).alias("initial"), solid.alias("end")
    )
    repeated = narrow.groupBy("ck", "mark").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    repeated = repeated.where("n > 1").select("ck", "mark", "first", salts.alias("salt"))
    salted = narrow.withColumn("salt", F.pmod(F.xxhash64("seq"), F.lit(SALTS)).cast("int"))
    joined = salted.join(repeated, ["ck", "mark", "salt"], "left")
    fault = (
        F.when(F.col("end") == "", F.lit(BLANK))
        .when(F.coalesce(F.col("seq") > F.col("first"), F.lit(False)), F.lit(DUPLICATE))
        .when(~F.col("end").isin(".", "!", "?"), F.lit(CUT))
        .otherwise(F.lit(FINE))
    )
    return joined.select("ck", "part", "seq", "turn", "initial", fault.alias("fault"))


def solve(rows: DataFrame) -> DataFrame:
    """Totals of each conversation (``part`` null) and the edits of each of its parts."""
    stream = faults(rows).repartition("part").sortWithinPartitions("part", "seq")
    segments = stream.mapInArrow(map_task(segment_batches), SEGMENTS)
    chained = segments.repartition("ck").sortWithinPartitions("ck", "part")
    return scratch(chained.mapInArrow(map_task(solve_batches), SOLVED), "turns-solved")


def repair(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """The rows that stay and those inserted, in order of ``part`` and ``nth``."""
    none = F.lit(None)
    edits = solved.where(F.col("part").isNotNull()).select(
        "part",
        "ck",
        F.lit(-1).cast("long").alias("seq"),
        none.cast("long").alias("turn"),
        none.cast("string").alias("role"),
        none.cast("string").alias("text"),
        "start",
        "letters",
    )
    texts = rows.select(
        "part",
        "ck",
        "seq",
        "turn",
        "role",
        "text",
        none.cast("int").alias("start"),
        none.cast("string").alias("letters"),
    )
    stream = texts.unionByName(edits).repartition("part").sortWithinPartitions("part", "ck", "seq")
    return stream.mapInArrow(map_task(repair_batches), REPAIRED)


def repair_turns(turns: DataFrame) -> DataFrame:
    """Repaired rows of any conversations: ``conv_id, nth, turn, role, text, edit`` by order of ``nth``."""
    rows = ordered(turns)
    fixed = repair(rows, solve(rows))
    ids = turns.select(_written("conv_id").alias("ck"), F.col("conv_id").cast("long").alias("conv_id")).distinct()
    return fixed.join(ids, "ck").select("conv_id", "part", "nth", "turn", "role", "text", "edit")


def audit(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per conversation of ``conversations``: faults and edits of ``turns``, hash of the repaired rows."""
    rows = ordered(turns)
    solved = solve(rows)
    fixed = repair(rows, solved).select("ck", "part", "nth", "role", "text")
    hashes = fixed.repartition("ck").sortWithinPartitions("ck", "part", "nth")
    hashes = hashes.mapInArrow(map_task(digest_batches), "ck string, sha string")
    totals = solved.where(F.col("part").isNull()).drop("part", "start", "letters")
    ids = conversations.select(
        _written("conv_id").alias("ck"), F.col("conv_id").cast("long").alias("conv_id")
    ).distinct()
    joined = ids.join(totals, "ck", "left").join(hashes, "ck", "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "conv_id",
        *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
