"""Conversation repair against an exhaustive search."""

import hashlib
import itertools
import random
import re
import time

import pytest

from stackweave.llm import repair
from tests.llm import helpers

SCHEMA = "conv_id long, turn long, role string, text string"


def exhaustive(rows):
    """(cost, audit) over all edit strings with at most two insertions in a row; rows are (initial, fault)."""
    best = None
    choices = [["D"] if fault in ("blank", "duplicate") else ["K", "R", "D"] for _, fault in rows]
    for picked in itertools.product(*choices):
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            audit = "".join("I" * gap + edit for gap, edit in zip(gaps, [*picked, ""], strict=True))
            cost, out, k = 0, "", 0
            for edit in audit:
                if edit == "I":
                    cost, out = cost + 2, out + "?"
                    continue
                initial, fault = rows[k]
                k += 1
                cost += {"K": 0, "R": 2, "D": 3}[edit] + (fault == "truncated" and edit != "D")
                out += {"K": initial or "-", "R": "?", "D": ""}[edit]
            head = out[:1] == "s"
            want = ("s" if head else "") + "ua" * ((len(out) - head) // 2)
            fits = len(want) == len(out) and all(a in ("?", b) for a, b in zip(out, want, strict=True)) and out != "s"
            if fits and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


@pytest.mark.parametrize("seed", range(6))
def test_search_equals_exhaustive(seed):
    dice = random.Random(seed)
    for _ in range(40):
        rows = [(dice.choice("suuaat"), dice.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(dice.randrange(5))]
        search = repair.Search()
        for row in rows:
            search.row(*row)
        assert search.end() == exhaustive(rows), rows


def simple(rows):
    """The same search with whole paths in its states, for conversations of any length."""
    moves = {"K": {"s": ["Es>S"], "u": ["E>U", "S>U", "A>U"], "a": ["U>A"]}, "R": ["E>U", "S>U", "A>U", "U>A"]}
    layer = {"E": (0, ""), "U": (2, "I"), "A": (4, "II")}
    for initial, fault in rows:
        new = {}

        def offer(state, cost, audit, new=new):
            if state not in new or (cost, audit) < new[state]:
                new[state] = (cost, audit)

        for state, (cost, audit) in layer.items():
            offer(state, cost + 3, audit + "D")
            if fault not in ("blank", "duplicate"):
                late = fault == "truncated"
                for edit, price, ways in (("K", late, moves["K"].get(initial, [])), ("R", 2 + late, moves["R"])):
                    for way in ways:
                        if way[0] == state:
                            offer(way[-1], cost + price, audit + edit)
        for a, b in (("E", "U"), ("S", "U"), ("A", "U"), ("U", "A")):
            if a in new:
                offer(b, new[a][0] + 2, new[a][1] + "I")
        layer = new
    return min(layer[s] for s in "EA" if s in layer)


@pytest.mark.parametrize("letters", ["suuaat", "t", "ua", "uuuuat", "a"])
def test_long_conversations(letters):
    dice = random.Random(7)
    for n in (50, 400):
        rows = [(dice.choice(letters), dice.choice(["", "", "", "", "duplicate", "truncated"])) for _ in range(n)]
        search = repair.Search()
        for row in rows:
            search.row(*row)
        assert search.end() == simple(rows)


def test_the_tree_stays_small():
    """Edits leave the tree as soon as the survivors agree, and a long run without roles takes linear time."""
    search, most = repair.Search(), 0
    for k in range(20_000):
        search.row("ua"[k % 2] if k % 7 else "u", "")
        nodes = {id(n): len(n.edits) for _, leaf in search.alive.values() for n in repair._up(leaf)}
        most = max(most, len(nodes) + sum(nodes.values()))
    assert most < 100 and len(search.done) > 19_000
    began = time.monotonic()
    search = repair.Search()
    for _ in range(100_000):
        search.row("t", "")
    cost, audit = search.end()
    assert (cost, len(audit)) == (200_000, 100_000) and time.monotonic() - began < 60


def by_hand(rows):
    """The contract for one conversation's damaged rows (turn, role, text), in plain Python."""
    rows = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    seen, faults = set(), []
    for _, role, text in rows:
        end = re.sub(r"[\x20\x09-\x0D]+", "", text)[-1:]
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else "")
        seen.add((role, text))
    cost, audit = simple([(role[:1], fault) for (_, role, _), fault in zip(rows, faults, strict=True)])
    left, out = iter(rows), []
    for edit in audit:
        _, role, text = (None, None, "") if edit == "I" else next(left)
        if edit != "D":
            headed = bool(out) and out[0].startswith("s") and out[0] != "assistant:"
            nth = len(out) - headed
            out.append(f"{role if edit == 'K' else ('user', 'assistant')[nth % 2]}:{text}")
    turns = sorted({t for t, _, _ in rows if t is not None})
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    return (
        turns[-1] - turns[0] + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


def test_rows_of_all_kinds(spark):
    dice = random.Random(3)
    pick = lambda: (
        dice.choice([None, 0, 1, 2, 3, 7, -4]), dice.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]),
        dice.choice(["One.", "Two!", "no end", "", " \n", None, "Why? \t", "a ", "x" * 3000 + "."]),
    )
    convs = {k: [pick() for _ in range(dice.randrange(1, 9))] for k in range(60)}
    convs[None] = convs[0]
    # Rows repeated within a turn: the first of equals is kept, the others go.
    convs |= {200 + k: [(0, "user", f"Q{k}.")] * 2 + [(1, "assistant", "A.")] * 3 for k in range(40)}
    convs[99] = [(0, "user", f"t{k}.") for k in range(3000)]
    df = spark.createDataFrame([(k, *row) for k, rows in convs.items() for row in rows], SCHEMA).withColumn("_kind", repair.F.lit("mine"))
    got = {r[0]: tuple(r)[1:] for r in repair.audited(df.repartition(5), df).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}
    assert got == {k: by_hand(rows) for k, rows in convs.items()}
    laid = [r for r in repair.repair(df).collect() if r.conv_id == 99]
    assert [r.place for r in laid] == list(range(len(laid))) and laid[0].role == "user" and laid[1].role == "assistant"


def test_damage_and_conversations_without_rows(spark):
    import zlib

    rows = [(c, t, "user", "Hi. You? ok!") for c in range(40) for t in range(4)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = []
    for c, t, role, text in rows:
        name = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{name(c)}:{name(t)}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        want += [] if kind == 0 else [row, row] if kind == 3 else [row]
    assert helpers.rows(repair.damage(df), "conv_id", "turn", "role", "text") == sorted(want, key=repr)
    none = repair.audited(df, repair.damage(df).limit(0))
    assert {tuple(r)[1:] for r in none.collect()} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert none.count() == 41
    assert repair.audited(df.limit(0), df.limit(0)).count() == 0
