"""Conversation repair against a search over all strings of edits."""

import hashlib
import random
import re
import zlib

import pytest

from tradewind.llm import chats

SCHEMA = "conv_id bigint, turn bigint, role string, text string, mark int, audit string"  # extra columns with clashing names
SPACE = " \t\n\x0b\x0c\r"


def search(initials, faults):
    """Cheapest edits, then the least string: every string is tried, inserts included."""
    best, n = None, len(initials)

    def go(i, shown, cost, letters):
        nonlocal best
        if cost > (best[0] if best else 4 * n + 6):
            return
        if i == n and re.fullmatch("(s?(ua)+)?", shown):
            best = min(best or (cost, letters), (cost, letters))
        for r in "ua":
            go(i, shown + r, cost + 3, letters + "I")
        if i < n:
            go(i + 1, shown, cost + 4, letters + "D")
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                go(i + 1, shown + initials[i], cost + more, letters + "K")
                for r in "ua":
                    go(i + 1, shown + r, cost + 3 + more, letters + "R")

    go(0, "", 0, "")
    return best


def test_cheapest_equals_search():
    rng = random.Random(3)
    for _ in range(150):
        n = rng.randint(0, 4)
        initials = [rng.choice("uuaasx") for _ in range(n)]
        faults = [rng.choice(["", "", "", "blank", "duplicate", "truncated"]) for _ in range(n)]
        assert chats.cheapest(initials, faults) == search(initials, faults), (initials, faults)


def test_long_conversations():
    cost, audit = chats.cheapest(list("uauaauuasu") * 300, [""] * 3000)
    # edits must give the pattern, and their letters must add up to the cost
    rows = list(chats.edited(audit, iter([(r, "x") for r in "uauaauuasu" * 300])))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for _, r, _ in rows))
    assert cost == sum({"K": 0, "D": 4, "I": 3, "R": 3}[c] for c in audit)


def brute(rows):
    """The report of one damaged conversation from the contract, row by row."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(SPACE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    cost, audit = search(initials, faults)
    kept, left, node = [], iter(rows), ""
    for c in audit:
        _, role, text = (None, "", "") if c == "I" else next(left)
        if c == "D":
            continue
        if c != "K":
            role = "assistant" if kept and kept[-1][0][0] == "u" else "user"
        kept.append((role, text))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            illegal, cost, audit, sha)


def hurt(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        mine = out.setdefault(conv, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def report(spark, rows):
    table = spark.createDataFrame([(*r, 1, "") for r in rows], SCHEMA).repartition(6)
    got = chats.report(table, chats.damage(table)).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got}


def test_report_equals_contract(spark):
    rng = random.Random(8)
    texts = ["Yes.", "No!", "cut off", " \n", "", "Aha? ", "Fin. \t", "tab\tinside.\n", "end. ", None]
    rows = []
    for conv in [*range(60), None]:
        turns = rng.sample([None, *range(-1, 7)], rng.randint(1, 5))
        rows += [(conv, t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None]), rng.choice(texts)) for t in turns]
    want = {c: brute(r) for c, r in hurt(rows).items()}
    assert report(spark, rows) == want


def test_dropped_conversations_and_empty_tables(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256().hexdigest()
    assert report(spark, [(gone, 0, "user", "Hi.")]) == {gone: (0, 0, 0, 0, 0, 0, "", empty)}
    assert report(spark, []) == {}


def test_equal_turns_have_one_order(spark):
    rows = [(5, 1, "user", "b."), (5, 1, "user", "a."), (5, 1, "assistant", "c."), (5, None, "user", "z."), (5, None, "", "y.")]
    table = spark.createDataFrame([(*r, 1, "") for r in rows], SCHEMA)
    first = chats.plan(table).collect()
    for parts in (1, 4):
        again = table.repartition(parts)
        plans = chats.plan(again)
        assert plans.collect() == first
        out = chats.repaired(again, plans).collect()
        assert [r.place for r in out] == list(range(len(out)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in out))


def test_a_long_conversation_spans_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(1, t, ("user", "assistant")[t % 2], f"Line {t}.") for t in range(100)] + [(2, 0, "user", "Q?"), (2, 1, "assistant", "A.")]
        table = spark.createDataFrame([(*r, 1, "") for r in rows], SCHEMA)
        plans = chats.plan(table)
        assert {(r.conv_id, r.cost, r.audit) for r in plans.collect()} == {(1, 0, "K" * 100), (2, 0, "KK")}
        assert chats.repaired(table, plans).where("conv_id = 1").count() == 100
        got = {r.conv_id: r.repaired_sha256 for r in chats.report(table, table).collect()}
        want = "\n".join(f"{r}:{t}" for c, _, r, t in rows if c == 1)
        assert got[1] == hashlib.sha256(want.encode()).hexdigest()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("role", ["", " ", "tool"])
def test_roles_that_fit_nowhere_are_never_kept(role):
    cost, audit = chats.cheapest([role[:1], "u", "a"], ["", "", ""])
    assert (cost, audit) == (4, "DKK")
