import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from trendspark.llm import conversations as conv

GRAMMAR = re.compile(r"(s?(ua)+)?")
BLANK = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        end = text.rstrip(BLANK)
        f = "blank" if not end else "duplicate" if (role, text) in seen else "" if end[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(f)
    return out


def cheapest(rows, found):
    """(cost, letters, repaired lines) by trying every edit, least first."""
    @lru_cache(None)
    def rest(i, roles, spent):
        best = None
        tries = []
        if spent < 2:
            tries += [(5, "I", (r, ""), i, spent + 1) for r in ("user", "assistant")]
        if i < len(rows):
            tries.append((2, "D", None, i + 1, 0))
            if found[i] not in ("blank", "duplicate"):
                _, role, text = rows[i]
                extra = 5 * (found[i] == "truncated")
                tries.append((extra, "K", (role, text), i + 1, 0))
                tries += [(1 + extra, "R", (r, text), i + 1, 0) for r in ("user", "assistant") if r != role]
        elif GRAMMAR.fullmatch(roles):
            best = (0, "", ())
        for cost, letter, line, j, now in tries:
            grown = roles
            if line is not None:
                grown = roles + (line[0][:1] or "?")
                if not re.fullmatch(r"s?(ua)*u?", grown):
                    continue
            more = rest(j, grown, now)
            if more is not None:
                one = (cost + more[0], letter + more[1], ((line,) if line is not None else ()) + more[2])
                best = one if best is None else min(best, one)
        return best
    return rest(0, "", 0)


def expected(table):
    convs = {}
    for c, turn, role, text in table:
        role, text = (" " if x is None else x for x in (role, text))
        f = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        own = convs.setdefault(c, [])
        if f:
            text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
            own += [(turn, "user" if f == 4 else role, text)] * (2 if f == 3 else 1)
    out = []
    for c, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        found = faults(rows)
        turns = [r[0] for r in rows if r[0] is not None]
        initials = [r[1][:1] for r in rows]
        cost, audit, lines = cheapest(tuple(rows), tuple(found))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                    *(found.count(k) for k in ("blank", "duplicate", "truncated")),
                    sum((a, b) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in zip(initials, initials[1:])),
                    cost, audit, sha))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn long, role string, text string"


def digest(spark, table):
    return sorted((tuple(r) for r in conv.structure_digest(spark.createDataFrame(table, SCHEMA)).collect()), key=str)


def test_equals_brute_force(spark):
    rng = random.Random(3)
    table = []
    for c in range(150):
        for t in range(rng.randrange(1, 7)):
            table.append((c, rng.choice([t, t, t, t + 2, None]), rng.choice(["system", "user", "assistant", "assistant", "user", "tool", None, ""]),
                          rng.choice(["Yes.", "No!", "what", "Ok. ", "…", " \n", "a. b", None, " ", "Long text? " * 5])))
    assert digest(spark, table) == expected(table)


def test_odd_tables(spark):
    """Null ids, repeated rows, ties of turn, very long texts, extra columns; all turns dropped; an empty table."""
    dropped = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    table = [(None, None, None, None), (None, 1, "user", "a."), (None, 1, "user", "a."), (9, dropped, "user", "gone."),
             (2, 1, "user", "x " * 300_000 + "."), (2, 2, "assistant", "é" * 100_000 + "!"), (3, 5, "assistant", "b."), (3, 5, "user", "a."),
             (3, 5, "user", "b."), (4, -3, "user", "q?"), (4, 4, "assistant", "a.")]
    got = digest(spark, table)
    assert got == expected(table)
    empty = hashlib.sha256(b"").hexdigest()
    assert (9, 0, 0, 0, 0, 0, 0, "", empty) in got
    more = spark.createDataFrame(table, SCHEMA).selectExpr("*", "1 as audit", "2 as n", "3 as conv", "4 as head", "5 as place")
    assert sorted((tuple(r) for r in conv.structure_digest(more).collect()), key=str) == got
    assert digest(spark, []) == []


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 99, 100, 101, 3000])
def test_checkpoints_give_what_all_vectors_give(n):
    rng = random.Random(n)
    codes = bytes(4 * rng.choice([0, 1, 1, 2, 2, 3]) + rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n))
    vectors = [conv._END]
    for c in reversed(codes):
        vectors.append(conv._before(c, vectors[-1]))
    vectors.reverse()
    out, q = b"", 0
    for i, c in enumerate(codes):
        low = min(vectors[i + 1])
        more, q = conv._letters(c, tuple(v - low for v in vectors[i + 1]), q)
        out += more
    assert conv.script(codes) == (out + b"I" * (conv._END[q] // 5), vectors[0][0])


def test_repaired_turns_of_one_long_conversation(spark):
    """The operator without planted faults: the repaired turns alternate, in order, whatever the input."""
    rows = [(1, i, ["user", "assistant", "user", "tool"][i * i % 4], f"turn {i}" + ".?"[i % 2] * (i % 11 > 0)) for i in range(2500)]
    audits, fixed = conv.repair(spark.createDataFrame(rows, SCHEMA))
    a = audits.collect()
    assert len(a) == 1 and len(a[0].audit.replace("I", "")) == 2500
    lines = sorted(tuple(r) for r in fixed.collect())
    assert [r[1] for r in lines] == list(range(len(lines)))
    assert GRAMMAR.fullmatch("".join(r[2][0] for r in lines))
    price = {"K": 0, "R": 1, "D": 2, "I": 5}
    kept = {int(r[3].split()[1].rstrip(".?")) for r in lines if r[3]}
    assert a[0].cost == sum(price[c] for c in a[0].audit) + 5 * sum(i % 11 == 0 for i in kept)
