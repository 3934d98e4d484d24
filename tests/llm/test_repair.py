from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import pytest

from skyledger.llm import repair

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def plain(rows):
    """One conversation's report from a table of all rows and states, with the edits spelt out."""
    rows = sorted(((t is not None, t or 0, " " if r is None else r, " " if x is None else x) for t, r, x in rows))
    turns = [t for named, t, *_ in rows if named]
    seen, faults = set(), []
    for *_, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    ways = {"": (0, "", ())}  # by the last initial

    def inserted(ways):
        for last, (cost, audit, made) in ways.items():
            for _ in range(4):
                yield last, cost, audit, made
                last = NEXT[last]
                cost, audit, made = cost + 3, audit + "I", (*made, NAMES[last] + ":")

    for (*_, role, text), fault in zip(rows, faults):
        new = {}
        for last, cost, audit, made in inserted(ways):
            found = [(last, cost + 4, audit + "D", made)]
            if fault not in ("blank", "duplicate"):
                cost += 3 * (fault == "truncated")
                to = NEXT[last]
                found.append((to, cost + 3, audit + "R", (*made, f"{NAMES[to]}:{text}")))
                if (last, role[:1]) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                    found.append((role[:1], cost, audit + "K", (*made, f"{role}:{text}")))
            for to, *way in found:
                new[to] = min(new.get(to, tuple(way)), tuple(way))
        ways = new
    cost, audit, made = min(way for last, *way in map(lambda x: x, inserted(ways)) if last in ("", "a"))
    count = collections.Counter(faults)
    letters = [r[:1] for *_, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count["blank"], count["duplicate"], count["truncated"],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:])), cost, audit,
            hashlib.sha256("\n".join(made).encode()).hexdigest())


def broken(rows):
    """The planted faults of (conv_id, turn, role, text) rows, as rows by conversation."""
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        shown = [" " if x is None else str(x) for x in (conv, turn)]
        kind = zlib.crc32(":".join(shown).encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


SCHEMA = "conv_id long, turn long, role string, text string, fault string, piece string"
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
ROLES = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "usher", "User"]
TEXTS = ["Yes.", "No!", "Why?", "and so", "", " \t\n", None, "done.  ", "é.\x0b", ".", "x　"]


def conversations(seed, n=150, longest=14):
    pick = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        size, own = pick.randrange(1, longest), []
        for i in range(size):
            turn = pick.choice([i, i, i, i + 5, None, 2]) if conv is not None and conv % 3 == 0 else i
            role = ROLES[1 + i % 2] if conv is not None and conv % 2 else pick.choice(ROLES)
            text = f"{pick.choice(TEXTS[:3])} {i}." if pick.random() < 0.6 else pick.choice(TEXTS)
            own.append((conv, turn, role, text))
        rows += own
    return rows


def reported(turns, **settings):
    rows = repair.repair(turns, **settings).reports().collect()
    out = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("rows_per_piece", [100_000, 40, 3])
def test_reports_are_those_of_the_full_table(spark, rows_per_piece):
    rows = conversations(rows_per_piece)
    turns = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    expected = {conv: plain(own) for conv, own in broken(rows).items() if own}
    assert reported(repair.damage(turns), rows_per_piece=rows_per_piece) == expected


def test_long_conversation_over_many_pieces(spark):
    pick = random.Random(4)
    rows = [(7, i // 2, pick.choice(ROLES), pick.choice([f"t{i}.", f"u{i}", "", "Yes."])) for i in range(1_500)] + [(8, 0, "user", "Hi.")]
    turns = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    done = repair.repair(turns, rows_per_piece=100)
    assert done.rows.select("piece").distinct().count() > 5
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in done.reports().collect()}
    assert got == {c: plain([r[1:] for r in rows if r[0] == c]) for c in (7, 8)}
    repaired = [r for r in done.turns().collect() if r["conv_id"] == 7]
    repaired.sort(key=lambda r: r["place"])
    assert [r["place"] for r in repaired] == list(range(len(repaired)))
    lines = "\n".join(f"{r['role']}:{r['text']}" for r in repaired)
    assert hashlib.sha256(lines.encode()).hexdigest() == got[7][-1]
    assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in repaired))


def test_edits_of_all_short_conversations():
    """Every sequence of four rows, whole and in pieces, against trying all edits."""
    steps = repair.Steps()
    kinds = [("system", "Yes {}."), ("user", "Yes {}."), ("assistant", "Yes {}."), ("tool", "Yes {}."), ("user", ""), ("assistant", "so {}"), ("system", "")]
    code = {0: 0, 1: 3, 2: 6, 3: 9, 4: 4, 5: 8, 6: 1}
    for number in range(7**4):
        own = [number // 7**i % 7 for i in range(4)]
        codes = bytes(code[k] for k in own)
        expected = plain([(i, kinds[k][0], kinds[k][1].format(i)) for i, k in enumerate(own)])
        for parts in ([codes], [codes[:1], codes[1:3], codes[3:]]):
            cost, states = repair.cuts([steps.weigh(p) for p in parts])
            audit = "".join(steps.solve(p, a, b) for p, (a, b) in zip(parts, states)) + "I" * repair.TO_CLOSE[states[-1][1]]
            assert (cost, audit) == expected[5:7]


def test_empty_table(spark):
    turns = spark.createDataFrame([], SCHEMA)
    assert repair.repair(turns).reports().count() == 0 and repair.repair(turns).turns().count() == 0
