r"""Repair of conversation structure by the cheapest edits, decided by one scalar minimum.

A conversation is the rows of one id in the order of their turns. It is well formed when the initials of its roles read
``(s?(ua)+)?`` and no row is blank (without a character outside ``[\x20\x09-\x0D]``) or a duplicate (role and text seen
earlier). Edits: Keep 0, Rerole to user or assistant 3, Delete 4 (the only one open to blank and duplicate rows), Insert an
empty user or assistant row 3; a truncated row (its last such character is none of ``.!?``) costs 3 more unless deleted.
Of equally cheap edits the ASCII-least string of their initials wins, a prefix before what it begins.

* The choice is a shortest path in a layered graph: a layer for each row, a node for each place in the pattern (nothing
  yet, after s, u, a). Every node holds one integer: its high digits are the cost, its low ones, DIGIT bits each, the
  letters of the edits from here on, left-aligned, zeros behind them. The smaller integer is therefore the better path in
  both respects, and a plain minimum over the edges, from the last layer to the first, decides everything.
* Rows meet their conversation in streams. The first carries a few bytes a row (initial, faults, hash of role and text)
  and yields the edits, the second, in the same order, carries the texts behind the edits of their conversation. A task
  holds the edits of one conversation, never its texts, whatever its length.

Defined results: null roles and texts are one space. An empty role has no initial and fits nowhere, so its row is never kept
as it is. Rows of equal turns are in the order of role and of a hash of role and
text; null turns come first. Rows without an id are one conversation, whose id is null. An empty table gives empty results,
a conversation without rows zeros and an empty string. Columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.storage import stored

SPACES = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LETTERS = "DIKR"            # in ASCII order, from 1; 0 is the end of the string
DIGIT = 3
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: The node that a row of this initial leads to, by the node before it.
LEGAL = {"s": {START: AFTER_S}, "u": {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, "a": {AFTER_U: AFTER_A}}
#: The node that a new user or assistant row leads to: the pattern leaves one choice.
NEXT = {START: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}
ROLE = {AFTER_U: "user", AFTER_A: "assistant"}


def _rows(table: DataFrame) -> DataFrame:
    blank = F.lit(" ")
    return table.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"))


def damage(table: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) hurt by a hash of id and turn: one in twenty each is dropped, emptied, loses its
    ``.!?``, comes twice, or becomes a user's."""
    rows = _rows(table)
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")), F.lit(20))
    hurt = rows.withColumn("_kind", kind).where("_kind <> 0")
    text = F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role"))
    return hurt.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                       F.explode(F.sequence(F.lit(1), F.when(F.col("_kind") == 3, 2).otherwise(1))).alias("_copy")).drop("_copy")


def cheapest(initials: list[str], faults: list[str]) -> tuple[int, str]:
    """Cost and letters of the best edits of one conversation; ``faults`` are '', 'blank', 'duplicate' or 'truncated'."""
    n = len(initials)
    length = n + (4 * n) // 3 + 3       # deleting all rows bounds the cost, hence the inserts
    high, top = DIGIT * length, DIGIT * (length - 1)
    low = (1 << high) - 1
    never = 1 << (high + 8 * n.bit_length() + 64)

    def before(letter: str, cost: int, rest: int) -> int:
        """The integer of the path that puts an edit in front of ``rest``."""
        return (((rest >> high) + cost) << high) | ((LETTERS.index(letter) + 1) << top) | ((rest & low) >> DIGIT)

    def with_inserts(node: list[int]) -> list[int]:
        """Inserts lead from node to node within a layer; going round in them is never cheapest."""
        u = min(node[AFTER_U], before("I", INSERT, node[AFTER_A]))
        a = min(node[AFTER_A], before("I", INSERT, node[AFTER_U]))
        return [min(node[START], before("I", INSERT, u)), min(node[AFTER_S], before("I", INSERT, u)), u, a]

    node = with_inserts([0, never, never, 0])
    for initial, fault in zip(reversed(initials), reversed(faults), strict=True):
        here = [before("D", DELETE, v) for v in node]
        if fault not in ("blank", "duplicate"):
            more = TRUNCATED if fault == "truncated" else 0
            for old, new in NEXT.items():
                here[old] = min(here[old], before("R", REROLE + more, node[new]))
            for old, new in LEGAL.get(initial, {}).items():
                here[old] = min(here[old], before("K", more, node[new]))
        node = with_inserts(here)
    best = node[START]
    shown = format(best & low, "o").zfill(length).rstrip("0")
    return best >> high, shown.translate({ord("1") + i: c for i, c in enumerate(LETTERS)})


def edited(letters: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(letter, role, text) of the rows that stay or come in, from the edits and the (role, text) of a conversation."""
    node = START
    for letter in letters:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        node = LEGAL[role[:1]][node] if letter == "K" else NEXT[node]
        yield letter, role if letter == "K" else ROLE[node], text


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_PLAN = "conv_id bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", audit string"


class _Conversation:
    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.initials, self.faults = conv_id, [], []
        self.seen: set[bytes] = set()
        self.first_turn = self.turn = None
        self.turns = 0

    def add(self, turn: int | None, initial: str, mark: bytes, blank: bool, truncated: bool) -> None:
        if turn is not None and turn != self.turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.turn, self.turns = turn, self.turns + 1
        self.faults.append("blank" if blank else "duplicate" if mark in self.seen else "truncated" if truncated else "")
        self.seen.add(mark)
        self.initials.append(initial)

    def plan(self) -> tuple:
        cost, audit = cheapest(self.initials, self.faults)
        gaps = self.turn - self.first_turn + 1 - self.turns if self.turns else 0
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(self.initials, self.initials[1:]))
        return (self.conv_id, gaps, *[self.faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit)


def _plan(batches):
    """Rows in order to one row per conversation, whose rows may span batches."""
    types = [pa.int64()] * 7 + [pa.string()]
    names = ["conv_id", *_COUNTS, "audit"]
    now = None
    for batch in batches:
        done = []
        for conv_id, *row in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "mark", "blank", "truncated")]):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.plan())
                now = _Conversation(conv_id)
            now.add(*row)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(now.plan(), types)], names=names)


_ORDER = ("conv_id", "turn", "role", "mark")


def _ordered(table: DataFrame) -> DataFrame:
    rows = _rows(table)
    named = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.withColumn("mark", F.unhex(F.sha2(named.cast("binary"), 256)))


def plan(table: DataFrame) -> DataFrame:
    """Per conversation with rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    last = F.substring(body, -1, 1)
    marked = _ordered(table).select(
        "conv_id", "turn", "role", "mark", F.substring("role", 1, 1).alias("initial"),
        (body == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"))
    return marked.repartition("conv_id").sortWithinPartitions(*_ORDER).mapInArrow(_plan, _PLAN)


_REPAIRED = "conv_id bigint, place bigint, edit string, role string, text string"
#: Rows sent on at a time.
STEP = 4096


def _apply(batches):
    """Edits, then rows in order, of one conversation after another, to the repaired rows."""
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def stream():
        for batch in batches:
            yield from zip(*[batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text")])

    rows = stream()
    held = []
    for conv_id, audit, _, _ in rows:
        # a conversation's edits say how many rows of its own follow
        for place, row in enumerate(edited(audit, ((r[2], r[3]) for r in rows))):
            held.append((conv_id, place, *row))
            if len(held) == STEP:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=["conv_id", "place", "edit", "role", "text"])
                held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=["conv_id", "place", "edit", "role", "text"])


def repaired(table: DataFrame, plans: DataFrame) -> DataFrame:
    """The rows after the edits: (conv_id, place, edit, role, text). A conversation's rows are together, in order."""
    none = lambda t: F.lit(None).cast(t)
    edits = plans.select("conv_id", F.lit(0).alias("kind"), none("bigint").alias("turn"), none("string").alias("role"),
                         none("binary").alias("mark"), none("string").alias("text"), "audit")
    rows = _ordered(table).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "mark", "text", none("string").alias("audit"))
    return edits.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_ORDER[1:]) \
        .select("conv_id", "audit", "role", "text").mapInArrow(_apply, _REPAIRED)


def _digests(batches):
    """Rows of ``repaired`` to one hash per conversation of its ``role:text`` lines."""
    def row(conv_id, digest):
        return pa.RecordBatch.from_arrays([pa.array([conv_id], pa.int64()), pa.array([digest.hexdigest()])], names=["_id", "_sha"])

    now = None
    for batch in batches:
        for conv_id, place, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text")]):
            if place == 0:
                if now is not None:
                    yield row(*now)
                now = (conv_id, hashlib.sha256())
            now[1].update(("\n" * (place > 0) + role + ":" + text).encode("utf-8", "surrogatepass"))
    if now is not None:
        yield row(*now)


def report(table: DataFrame, hurt: DataFrame) -> DataFrame:
    """One row per conversation of ``table``, from the repair of its rows ``hurt``: the plan and the hash of its result."""
    plans = stored(plan(hurt), "chat-plans")
    shas = repaired(hurt, plans).mapInArrow(_digests, "_id bigint, _sha string")
    ids = table.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    kept = plans.select(F.col("conv_id").alias("_plan_id"), *_COUNTS, "audit")
    out = ids.join(kept, F.col("conv_id").eqNullSafe(F.col("_plan_id")), "left") \
        .join(shas, F.col("conv_id").eqNullSafe(F.col("_id")), "left")
    zero = F.lit(0).cast("bigint")
    return out.select("conv_id", *[F.coalesce(c, zero).alias(c) for c in _COUNTS], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("_sha", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
