"""Conversation repair against a plain version that compares whole audits."""

import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache
from hashlib import sha256
from itertools import product

import pytest

from tidemark.llm import chat_repair
from tidemark.llm.chat_repair import Automaton, SIGNS

SPACE = "\x20\t\n\x0b\x0c\r"
SHAPE = "conv_id long, turn long, role string, text string"


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (2 if kind == 3 else 1)


@lru_cache(None)
def cheapest(rows):
    """(cost, audit, roles given) of the cheapest repair of rows of (role initial, fault), by trying everything."""

    def ways(at, made):
        state = made[-1:] or ("start",)
        due = {"start": "u", "s": "u", "u": "a", "a": "u"}[state[0]]
        found = []
        if at == len(rows):
            if state[0] in ("start", "a"):
                found.append((0, "", ()))
        else:
            role, fault = rows[at]
            found += [(2 + c, "D" + a, r) for c, a, r in [best(at + 1, made[-1:])]]
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                if role and (role == due or (role == "s" and state[0] == "start")):
                    found += [(extra + c, "K" + a, (role, *r)) for c, a, r in [best(at + 1, (role,))]]
                found += [(1 + extra + c, "R" + a, (due, *r)) for c, a, r in [best(at + 1, (due,))]]
        return found, due

    @lru_cache(None)
    def best(at, made):
        # up to two inserts before what comes next
        options, given = [], made
        for n in range(3):
            found, due = ways(at, given)
            put = tuple(given[len(made) :])
            options += [(5 * n + c, "I" * n + a, put + r) for c, a, r in found]
            given = (*given, due)
        return min(options, key=lambda o: o[:2]) if options else (10**9, "", ())

    cost, audit, roles = best(0, ())
    assert re.fullmatch("(s?(ua)+)?", "".join(roles))
    return cost, audit, roles


def brute(rows):
    kept = defaultdict(list)
    for row in damage(rows):
        kept[row[0]].append(row)
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted(kept[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), sha256(r[3].encode()).hexdigest()))
        signs, seen = [], set()
        for _, _, role, text in mine:
            plain = text.strip(SPACE)
            fault = "blank" if not plain else "duplicate" if (role, text) in seen else "truncated" if plain[-1] not in ".!?" else "none"
            seen.add((role, text))
            signs.append((role[:1], fault))
        cost, audit, roles = cheapest(tuple(signs))
        lines, given, at = [], list(roles), 0
        names = {"u": "user", "a": "assistant"}
        for edit in audit:
            if edit == "I":
                lines.append(f"{names[given.pop(0)]}:")
                continue
            _, _, role, text = mine[at]
            at += 1
            if edit in "KR":
                new = given.pop(0)
                lines.append(f"{role if edit == 'K' else names[new]}:{text}")
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        count = lambda f: sum(s[1] == f for s in signs)
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(signs, signs[1:]))
        out.append((conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, parts=4):
    table = spark.createDataFrame(rows, SHAPE).selectExpr("*", "1 as pos", "2 as copies", "'x' as sign", "3 as edit").repartition(parts)
    return sorted(map(tuple, chat_repair.report(table).collect()), key=str)


def talk(rng, conv, n):
    roles = ["system"] * (rng.random() < 0.3) + ["user", "assistant"] * n
    texts = ["Yes.", "No!", "so", "a b c?", "", " \n", "end.  ", "Ünd.", None, "x\x1c"]
    return [
        (conv, None if rng.random() < 0.03 else t, rng.choice(["user", "assistant", "system", "tool", "", None]) if rng.random() < 0.2 else role,
         rng.choice(texts) if rng.random() < 0.4 else f"Turn {conv} {t}.")
        for t, role in enumerate(roles[:n])
    ]


def test_every_short_signature():
    """All strings of up to four signs, on one automaton, against trying every repair."""
    automaton = Automaton()
    for n in range(5):
        for signs in product(range(16) if n < 4 else (0, 1, 3, 4, 5, 8, 9, 12), repeat=n):
            node = automaton.node("".join(SIGNS[s] for s in signs), "end")
            rows = tuple(("sua?"[s // 4], ("none", "truncated", "duplicate", "blank")[s % 4]) for s in signs)
            cost, audit, _ = cheapest(tuple(("" if r == "?" else r, f) for r, f in rows))
            assert (automaton.costs[node][0], automaton.walk(node, 0)[0]) == (cost, audit)
    shared = Automaton()
    for letter in "AEIM":
        shared.node(letter + "EIEIEI", "end")
    assert len(shared.costs) == 1 + 6 + 4  # the root, one shared ending, four beginnings


@pytest.mark.parametrize("bits", [12, 2])
def test_against_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(chat_repair, "SEGMENT_BITS", bits)
    rng = random.Random(bits)
    rows = [row for conv in range(60) for row in talk(rng, conv, rng.randint(1, 9))]
    rows += talk(rng, None, 6) + talk(rng, 1000, 90) + rows[:20]
    rows += [(2000, t, "user", "Same text.") for t in range(40)] + [(2001, 5, "user", "Same text.")] * 30 + [(2002, None, None, None)] * 3
    rows += [(2003, 7, "assistant", f"Other {i}.") for i in range(25)]
    assert run(spark, rows) == brute(rows)


def test_few_nodes(spark, monkeypatch):
    """An automaton begun anew gives the same edits."""
    automaton, small = Automaton(), Automaton()
    monkeypatch.setattr(chat_repair, "NODES", 3)
    rng = random.Random(1)
    for _ in range(200):
        signature, behind = "".join(rng.choice(SIGNS) for _ in range(9)), rng.choice(["end", "0,4,2,1"])
        state = rng.randrange(4)
        wide = automaton.walk(automaton.node(signature, behind), state)
        assert small.walk(small.node(signature, behind), state) == wide


def test_empty_and_all_dropped(spark):
    table = spark.createDataFrame([], SHAPE)
    assert chat_repair.report(table).collect() == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = run(spark, [(gone, 0, "user", "Hi.")])
    assert got == [(gone, 0, 0, 0, 0, 0, 0, "", sha256().hexdigest())]


def test_long_texts(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"{t} " + "word " * 200_000 + ".") for t in range(1, 5)]
    assert run(spark, rows) == brute(rows)
