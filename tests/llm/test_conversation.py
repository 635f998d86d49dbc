import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from bourse.llm.conversation import Lattice, cheapest_edits, repair_conversations

ROWS = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def least_edits(rows):
    """(cost, audit, lines) of the cheapest edits: row after row, the least way to each last role.

    ``rows``: (role, text, must delete, truncated).
    """
    def state(lines):
        return "".join(x[0] for x in lines)[-1:] if lines else ""

    def with_inserts(ways):
        for _ in range(2):
            new = dict(ways)
            for cost, audit, lines in ways.values():
                last = state(lines)
                made = "assistant:" if last == "u" else "user:"
                way = (cost + 2, audit + "I", (*lines, made))
                key = state(way[2])
                if key not in new or way[:2] < new[key][:2]:
                    new[key] = way
            ways = new
        return ways

    ways = with_inserts({"": (0, "", ())})
    for role, text, must, cut in rows:
        new = {}
        for cost, audit, lines in ways.values():
            last = state(lines)
            ok = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
            made = "assistant" if last == "u" else "user"
            options = [(cost + 3, audit + "D", lines)]
            if not must:
                options.append((cost + 2 + cut, audit + "R", (*lines, f"{made}:{text}")))
                if role[:1] and role[:1] in ok:
                    options.append((cost + cut, audit + "K", (*lines, f"{role}:{text}")))
            for way in options:
                key = state(way[2])
                if key not in new or way[:2] < new[key][:2]:
                    new[key] = way
        ways = with_inserts(new)
    return min((w for k, w in ways.items() if k in ("", "a")), key=lambda w: w[:2])


def brute(rows):
    out = {}
    after = damage(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        seen, facts, n = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in mine:
            shown = text.rstrip(SPACE)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            facts.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(facts, facts[1:]))
        cost, audit, lines = least_edits(facts)
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def result(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def conversations(seed, many, longest):
    rnd = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "well", "a. b", "", " \t", None, "Ende.\n", "x.\xa0", "# .", "long " * 2000 + "."]
    rows = []
    for conv in range(many):
        for turn in range(rnd.randint(1, longest)):
            if rnd.random() < 0.9:
                text = rnd.choice(texts)
                # texts of their own, or rows of one turn would need an order between them
                rows.append((conv, turn * rnd.choice([1, 1, 1, 2]) * 100 + turn, rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), text))
    rnd.shuffle(rows)
    return rows


def test_equals_plain_search(spark):
    rows = conversations(1, 120, 12) + [(500, t, "user" if t % 2 else "assistant", f"turn {t}" + "." * (t % 3)) for t in range(400)]
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (7000, None, "user", "Hi."), (7001, None, None, None)]
    df = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit(-1) for c in ("phase", "conv", "fault", "h1", "entry", "end")})
    assert result(repair_conversations(df)) == brute(rows)


def test_conversations_that_lose_every_row(spark):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = result(repair_conversations(spark.createDataFrame([(lost, 0, "user", "Hi.")], ROWS)))
    assert got == {lost: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert repair_conversations(spark.createDataFrame([], ROWS)).count() == 0


def test_rows_of_one_turn_and_repeated_rows(spark):
    turn = next(t for t in range(100) if zlib.crc32(f"9:{t}".encode()) % 20 > 4)
    rows = [(9, turn, "user", "b."), (9, turn, "assistant", "c."), (9, turn, "assistant", "c."), (9, turn, "system", "s.")]
    got = result(repair_conversations(spark.createDataFrame(rows, ROWS)))
    assert got == brute(sorted(rows, key=lambda r: r[2]))  # of one turn: by role
    assert got[9][:5] == (0, 0, 1, 0, 2)
    assert result(repair_conversations(spark.createDataFrame(rows[::-1], ROWS))) == got


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_search_on_every_small_conversation(n):
    kinds = [("s", False, False), ("u", False, False), ("a", False, False), ("u", True, False), ("a", False, True), ("t", False, False)]
    for rows in product(kinds, repeat=n):
        want = least_edits([(r, "", must, cut) for r, must, cut in rows])
        assert cheapest_edits(Lattice(*[[r[c] for r in rows] for c in range(3)])) == want[:2], rows


def test_search_on_random_conversations():
    rnd = random.Random(4)
    for _ in range(1500):
        n = rnd.randint(4, 14)
        rows = [(rnd.choice("suuuaaat"), rnd.random() < 0.2, rnd.random() < 0.3) for _ in range(n)]
        want = least_edits([(r, "", must, cut) for r, must, cut in rows])
        assert cheapest_edits(Lattice(*[[r[c] for r in rows] for c in range(3)])) == want[:2], rows


def test_search_stays_linear_in_a_very_long_conversation():
    import time

    rnd = random.Random(8)
    rows = [(rnd.choice("uuaa"), False, False) for _ in range(100_000)]
    began = time.time()
    cost, audit = cheapest_edits(Lattice(*[[r[c] for r in rows] for c in range(3)]))
    assert len(audit) >= 100_000 and cost > 0 and time.time() - began < 60


def apply(edits, rows):
    """(cost, role initials) of an edit string on rows of (initial, must delete, truncated), or None if it does not fit them."""
    cost, out, i = 0, "", 0
    for e in edits:
        made = "a" if out[-1:] == "u" else "u"
        if e == "I":
            cost, out = cost + 2, out + made
            continue
        if i == len(rows):
            return None
        initial, must, cut = rows[i]
        i += 1
        if e == "D":
            cost += 3
        elif must:
            return None
        else:
            cost, out = cost + cut + (2 if e == "R" else 0), out + (made if e == "R" else initial)
    return (cost, out) if i == len(rows) and re.fullmatch("(s?(ua)+)?", out) else None


def test_search_against_every_edit_string():
    kinds = [("s", False, False), ("u", False, False), ("a", False, True), ("u", True, False), ("t", False, False)]
    strings = ["".join(p) for n in range(7) for p in product("DIKR", repeat=n)]
    for rows in [p for n in range(3) for p in product(kinds, repeat=n)]:
        want = min((found[0], e) for e in strings if (found := apply(e, rows)))
        assert cheapest_edits(Lattice(*[[r[c] for r in rows] for c in range(3)])) == want, rows
