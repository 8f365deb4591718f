import hashlib
import itertools
import random
import re
import zlib

import pytest

from tunelake.llm import conversations as c

INITIAL = {"system": "s", "user": "u", "assistant": "a", "tool": "t", "": "", " ": " "}


def every_repair(rows):
    """Cost, edits and result of all edits of ``rows`` (fault, role, text), two insertions at a place."""
    found = []
    for edits in itertools.product("KRD", repeat=len(rows)):
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            audit = "".join("I" * g + e for g, e in zip(gaps, edits)) + "I" * gaps[-1]
            cost, shown, source = 0, [], iter(rows)
            for edit in audit:
                fault, role, text = (None, None, "") if edit == "I" else next(source)
                if edit != "D" and fault in ("blank", "duplicate"):
                    break
                cost += {"K": 0, "R": 3, "D": 4, "I": 3}[edit] + 3 * (fault == "truncated" and edit != "D")
                if edit != "D":
                    shown.append((role if edit == "K" else None, text))
            else:
                system = bool(shown and shown[0][0] and shown[0][0].startswith("s"))
                full = [
                    (r if r is not None else ("user", "assistant")[(n - system) % 2], t)
                    for n, (r, t) in enumerate(shown)
                ]
                letters = "".join(r[:1] or "-" for r, _ in full)
                if re.fullmatch("(s?(ua)+)?", letters):
                    found.append((cost, audit, [f"{r}:{t}" for r, t in full]))
    return min(found)


def repaired(rows):
    repair, edits = c.Repair(), []
    for place, row in enumerate(rows):
        edits += repair.add((place, *row))
    edits += repair.end()
    cost = sum(
        {"K": 0, "R": 3, "D": 4, "I": 3}[e[3]] + 3 * (e[1] == "truncated" and e[3] != "D") for e in edits
    )
    return cost, "".join(e[3] for e in edits), [f"{e[4]}:{e[5]}" for e in edits if e[3] != "D"]


def test_cheapest_edits_of_short_conversations():
    pick = random.Random(4)
    roles = list(INITIAL)
    for n in range(260):
        size = n % 5
        rows = [
            (pick.choice([None, None, None, "blank", "duplicate", "truncated"]),
             pick.choice(roles if n % 3 else roles[:3]), f"t{i}") for i in range(size)
        ]
        assert repaired(rows) == every_repair(rows)


def plain(rows):
    """The same by whole strings: for each state the least of (cost, edits), nothing given up."""
    states = {0: (0, "")}

    def better(table, state, value):
        if state not in table or value < table[state]:
            table[state] = value

    def inserted(table):
        for _ in range(2):
            for state, (cost, audit) in list(table.items()):
                better(table, 3 if state == 2 else 2, (cost + 3, audit + "I"))
        return table

    for fault, role, _ in rows:
        before, states = inserted(dict(states)), {}
        more = 3 * (fault == "truncated")
        for state, (cost, audit) in before.items():
            better(states, state, (cost + 4, audit + "D"))
            if fault in ("blank", "duplicate"):
                continue
            following, letter = (3, "a") if state == 2 else (2, "u")
            kept = role[:1] == letter
            better(states, following, (cost + more + 3 * (not kept), audit + ("K" if kept else "R")))
            if state == 0 and role[:1] == "s":
                better(states, 1, (cost + more, audit + "K"))
    states = inserted(dict(states))
    return min(states[s] for s in (0, 3) if s in states)


@pytest.mark.parametrize("seed", range(6))
def test_long_conversations_against_whole_strings(seed):
    pick = random.Random(seed)
    for _ in range(40):
        weights = [pick.random() for _ in range(4)]
        roles = pick.choices(["user", "assistant", "system", "tool"], weights, k=pick.randrange(5, 120))
        if pick.random() < 0.5:
            roles = [r if pick.random() < 0.1 else ("user", "assistant")[i % 2] for i, r in enumerate(roles)]
        rows = [(pick.choice([None] * 8 + ["blank", "duplicate", "truncated"]), r, "x") for r in roles]
        assert repaired(rows)[:2] == plain(rows)


def test_edits_are_settled_early():
    repair = c.Repair()
    most = 0
    for place in range(20_000):
        role = "tool" if place % 97 == 5 else ("user", "assistant")[place % 2]
        for _ in repair.add((place, None, role, "text")):
            pass
        most = max(most, len(repair._open))
    assert most < 200


def test_roles_that_never_fit_stay_small():
    rows = [(None, "tool", "x")] * 30_000  # the survivors never meet; the tree stays a few stretches
    repair = c.Repair()
    for place, row in enumerate(rows):
        for _ in repair.add((place, *row)):
            pass
    nodes = {id(n) for s in repair._survivors if s for n in c._line(s[1])}
    assert len(nodes) <= 7
    assert [e[3] for e in repair.end()] == ["R"] * 30_000


def expected(rows):
    """The contract on rows (conv, turn, role, text), by plain code."""
    found, shown = {}, lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        own = found.setdefault(conv, [])
        kind = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        own += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    result = []
    for conv, own in found.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults, before = set(), [], None
        illegal = 0
        for turn, role, text in own:
            end = text.rstrip(c.SPACE)
            faults.append("blank" if not end else "duplicate" if (role, text) in seen
                          else None if end[-1] in ".!?" else "truncated")
            seen.add((role, text))
            illegal += before is not None and before + role[:1] not in ("su", "ua", "au")
            before = role[:1]
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, lines = repaired([(f, r, t) for f, (_, r, t) in zip(faults, own)])
        assert (cost, audit) == plain([(f, r, t) for f, (_, r, t) in zip(faults, own)])
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        result.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return sorted(result, key=repr)


def test_whole_query_on_odd_rows(spark, make, rows):
    pick = random.Random(8)
    roles = ["user", "assistant", "system", "tool", "", None, "userx"]
    texts = ["Yes.", "No!", "what?  \n", "cut off", "", " \t", None, "é.", "x" * 200_000 + "."]
    given = [
        (pick.choice([None, *range(40)]), pick.choice([None, *range(9), 12]), pick.choice(roles), pick.choice(texts))
        for _ in range(500)
    ]
    given += [(77, t, ("user", "assistant")[t % 2], f"answer {t}.") for t in range(300)]
    given += given[:40] + [(88, None, "user", "Hi.")] * 5
    gone = next(k for k in range(100, 1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    given.append((gone, 0, "user", "away."))
    schema = "conv_id long, turn long, role string, text string, fault int, edit string, again string, conv int"
    df = make([(*r, 1, "x", "y", 2) for r in given], schema)
    got = rows(c.report(c.repair(c.damaged(df))))
    assert got == expected(given)
    assert (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got


def test_edits_in_order(make):
    given = [(1, 0, "user", "Hi."), (1, 1, "user", "So."), (2, 0, "assistant", "Yes.")]
    edits = c.repair(make(given, "conv long, turn long, role string, text string")).collect()
    by_conv = {k: [tuple(r)[1:] for r in edits if r.conv == k and r.place is not None] for k in (1, 2)}
    assert by_conv[1] == [(0, 0, None, "user", "K", "user", "Hi."), (1, 1, None, "user", "R", "assistant", "So.")]
    assert by_conv[2] == [(0, None, None, None, "I", "user", ""), (1, 0, None, "assistant", "K", "assistant", "Yes.")]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert c.report(c.repair(c.damaged(empty))).collect() == []
