import binascii
import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from tablerich.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = binascii.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        yield from [(conv, turn, role, text)] * (2 if kind == 3 else 1)


def cheapest(items):
    """By dynamic programming over whole strings: ``items`` are (initial, fault, role, text)."""
    ways = {"": (0, "", ())}

    def more(ways):
        out = dict(ways)
        for _ in range(3):
            for state, (c, e, t) in list(out.items()):
                role = "assistant" if state == "u" else "user"
                way = (c + 3, e + "I", (*t, role + ":"))
                out[role[0]] = min(out.get(role[0], way), way)
        return out

    def inserted(ways):
        """Every number of insertions, kept apart."""
        every = [(s, w) for s, w in ways.items()]
        for s, (c, e, t) in list(every):
            for _ in range(3):
                role = "assistant" if s == "u" else "user"
                s, c, e, t = role[0], c + 3, e + "I", (*t, role + ":")
                every.append((s, (c, e, t)))
        return every

    for initial, fault, role, text in items:
        nxt = {}
        for state, (c, e, t) in inserted(ways):
            ends = [(state, (c + 4, e + "D", t))]
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                new = "assistant" if state == "u" else "user"
                ends.append((new[0], (c + 3 + extra, e + "R", (*t, f"{new}:{text}"))))
                if (initial, state) in {("s", ""), ("u", ""), ("u", "s"), ("u", "a"), ("a", "u")}:
                    ends.append((initial, (c + extra, e + "K", (*t, f"{role}:{text}"))))
            for s, way in ends:
                nxt[s] = min(nxt.get(s, way), way)
        ways = nxt
    return min(w for s, w in inserted(ways) if s in ("", "a"))


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = list(damage([r for r in rows if r[0] == conv]))
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, items, counts = set(), [], collections.Counter()
        for _, _, role, text in mine:
            last = re.sub(r"[\x20\x09-\x0D]", "", text)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            items.append((role[:1], fault, role, text))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(items, items[1:]))
        cost, audit, lines = cheapest(items)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest)
    return out


def got(spark, rows, parts=3, **sizes):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS part", "'x' AS kind", "2 AS copies", "3 AS place").repartition(parts)
    found = [tuple(r) for r in repair.repair(repair.damaged(df), **sizes).collect()]
    assert len(found) == len({r[0] for r in found})
    return {r[0]: r[1:] for r in found}


def conversations(seed, n, longest=9):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "", " \t", "Why?", "same.", None, "end. \n", "\x0c"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "User", "", None, "sys", "ab"]
    rows = []
    for conv in [*range(n), None]:
        for t in range(rng.randrange(longest)):
            rows.append((conv, rng.choice([t, t, t, 2 * t, None]), rng.choice(roles), rng.choice([*texts, f"text {t}.", f"text {t}"])))
    return rows


def test_against_brute_force(spark):
    rows = conversations(1, 400)
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("chunk", [3, 50])
def test_long_conversations_are_split(spark, many_parts, chunk):
    rng = random.Random(chunk)
    rows = conversations(chunk, 40)
    # One conversation holds most rows; another repeats one row.
    rows += [(777, t, rng.choice(["user", "assistant", "system"]), f"t{t % 300}{rng.choice('.!,')}") for t in range(1500)]
    rows += [(778, 5, "assistant", "again.")] * 300 + [(778, 6, "user", "once.")] + [(779, None, "user", " ")] * 200
    assert got(spark, rows, chunk=chunk, piece=40) == brute(rows)


def every_way(items):
    """All edits of a few rows: the cheapest, then the first by its letters, that gives a conversation."""
    best = None
    choices = [["D"] if f in ("blank", "duplicate") else ["D", "K", "Ru", "Ra"] for _, f, _, _ in items]
    gaps = list(itertools.chain.from_iterable(itertools.product("ua", repeat=k) for k in range(3)))
    for picks in itertools.product(*choices):
        for inserts in itertools.product(gaps, repeat=len(items) + 1):
            cost, audit, lines, initials = 0, "", [], ""
            for i in range(len(items) + 1):
                for x in inserts[i]:
                    cost, audit, initials = cost + 3, audit + "I", initials + x
                    lines.append({"u": "user:", "a": "assistant:"}[x])
                if i == len(items):
                    break
                initial, fault, role, text = items[i]
                cost += {"D": 4, "K": 0}.get(picks[i], 3) + (3 if fault == "truncated" and picks[i] != "D" else 0)
                audit += picks[i][0]
                if picks[i] != "D":
                    new = {"K": role, "Ru": "user", "Ra": "assistant"}[picks[i]]
                    initials += new[:1]
                    lines.append(f"{new}:{text}")
            if re.fullmatch("(s?(ua)+)?", initials):
                way = (cost, audit, tuple(lines))
                best = way if best is None else min(best, way)
    return best


def test_dynamic_programming_against_every_way():
    rng = random.Random(5)
    for _ in range(60):
        items = []
        for i in range(rng.randrange(4)):
            role = rng.choice(["user", "assistant", "system", "tool"])
            items.append((role[0], rng.choice(["", "", "truncated", "duplicate", "blank"]), role, f"x{i}"))
        assert cheapest(items) == every_way(items)


def test_halves_give_what_the_whole_does():
    rng = np.random.default_rng(7)
    n = 500
    sizes = rng.integers(0, 60, n)
    group = np.repeat(np.arange(n), sizes)
    initial, fault = rng.integers(0, 4, len(group)), rng.integers(0, 4, len(group))
    copies = rng.choice([1, 1, 1, 2, 5], len(group))
    ways = repair.Stretches(group, initial, fault, copies, np.ones(n, bool))
    roles = [("s", "u", "a", "x")[i] for i in initial]
    found = list(ways.repaired(np.zeros(n, np.int64), np.full(n, 3), roles, ["t"] * len(group)))
    names = ["", "truncated", "duplicate", "blank"]
    for g in range(n):
        items = []
        for i in np.flatnonzero(group == g):
            items += [(roles[i], names[fault[i]], roles[i], "t")]
            items += [(roles[i], "duplicate", roles[i], "t")] * (copies[i] - 1)
        cost, audit, lines = cheapest(items)
        assert (ways.cost[g, 0, 3], *found[g]) == (cost, audit, list(lines))


def test_small_tables(spark):
    assert got(spark, []) == {}
    empty = hashlib.sha256(b"").hexdigest()
    dropped = next(c for c in range(100) if binascii.crc32(f"{c}:0".encode()) % 20 == 0)
    assert got(spark, [(dropped, 0, "user", "Hi.")]) == {dropped: (0, 0, 0, 0, 0, 0, "", empty)}
    rows = [(None, None, None, None), (5, None, "user", "x" * 300_000 + "."), (5, 3, "assistant", "y.")]
    assert got(spark, rows) == brute(rows)
