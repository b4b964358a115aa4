"""Conversation repair against a search over all edits of each conversation."""

import hashlib
import itertools
import random
import zlib

import pytest

from strata.llm import conversations as conv
from strata.llm import queries

BLANK = " \t\n\x0b\x0c\r"


def _regular(initials):
    rest = initials[1:] if initials[:1] == "s" else initials
    return initials == "" or (rest != "" and rest == "ua" * (len(rest) // 2))


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(BLANK)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else
                   "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """(cost, audit, repaired lines): from the last row to the first, the
    least (cost, audit) from each state, row by row."""
    told = faults(rows)
    n = len(rows)
    value = {}
    for i in range(n, -1, -1):
        for s in range(4):
            value[i, s] = (10 ** 9, "~", ())
        for _ in range(6):
            for s in range(4):
                nxt = {0: "u", 1: "u", 2: "a", 3: "u"}[s]
                after = {"u": 2, "a": 3}[nxt]
                full = {"u": "user", "a": "assistant"}[nxt]
                options = [value[i, s]]
                if i == n and s in (0, 3):
                    options.append((0, "", ()))

                def add(cost, letter, line, j, t):
                    c, a, lines = value[j, t]
                    options.append((cost + c, letter + a, ((line,) if line else ()) + lines))
                add(3, "I", full + ":", i, after)
                if i < n:
                    role, text = rows[i]
                    add(4, "D", None, i + 1, s)
                    if told[i] not in ("blank", "duplicate"):
                        extra = 3 if told[i] == "truncated" else 0
                        add(3 + extra, "R", full + ":" + text, i + 1, after)
                        if role[:1] == "s" and s == 0:
                            add(extra, "K", role + ":" + text, i + 1, 1)
                        elif role[:1] == nxt:
                            add(extra, "K", role + ":" + text, i + 1, after)
                value[i, s] = min(options, key=lambda o: o[:2])
    return value[0, 0]


def every_audit(rows, most):
    """Least (cost, audit) over all audits of at most ``most`` letters."""
    told, found = faults(rows), []
    for size in range(most + 1):
        for letters in itertools.product("DIKR", repeat=size):
            if sum(x != "I" for x in letters) != len(rows):
                continue
            i, cost, out, ok = 0, 0, "", True
            for x in letters:
                due = "u" if out in ("", "s") or out[-1] in "sa" else "a"
                if x == "I":
                    out, cost = out + due, cost + 3
                    continue
                gone = told[i] in ("blank", "duplicate")
                ok = ok and (x == "D" or not gone)
                cost += {"D": 4, "K": 0, "R": 3}[x] + (3 if x != "D" and told[i] == "truncated" else 0)
                out += {"D": "", "K": rows[i][0][:1] or "?", "R": due}[x]
                i += 1
            if ok and _regular(out):
                found.append((cost, "".join(letters)))
    return min(found)


def expected(rows):
    """Row of the digest for the ordered (turn, role, text) of one conversation."""
    plain = [(r, t) for _, r, t in rows]
    told = faults(plain)
    cost, audit, lines = brute(plain)
    turns = [t for t, _, _ in rows if t is not None]
    bad = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(plain, plain[1:]))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(told.count(f) for f in ("blank", "duplicate", "truncated")),
            bad, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def ordered(rows):
    """Copies expanded, by turn (nulls first) and the MD5 of role and text."""
    out = []
    for turn, role, text, copies in rows:
        out += [(turn, role, text)] * copies
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0,
                                      hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))


def digest(spark, table):
    df = spark.createDataFrame([(c, *r) for c, rows in table.items() for r in rows],
                               "conv_id long, turn long, role string, text string, copies int")
    return {r["conv_id"]: tuple(r)[1:] for r in conv.audit(df).collect()}


def _random_rows(rng, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "uncle"]
    texts = ["Yes.", "No!", "why", "Well?", "", " \n", "cut off", "Ends.  \t"]
    return [(rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts) + ("" if rng.random() < .5 else f" {i}."),
             rng.choice([0, 1, 1, 1, 2])) for i in range(n)]


def test_brute_form_is_the_least_of_all_audits():
    rng = random.Random(3)
    for _ in range(25):
        rows = [(r, t) for _, r, t in ordered(_random_rows(rng, rng.randrange(0, 4)))][:4]
        assert brute(rows)[:2] == every_audit(rows, len(rows) + 3)


@pytest.mark.parametrize("tasks", [1, 7, 40])
def test_random_conversations(spark, tasks):
    """Also in more tasks than conversations, so that every one is cut."""
    rng = random.Random(11)
    table = {i: _random_rows(rng, rng.randrange(1, 9)) for i in range(60)}
    table[1000] = _random_rows(rng, 400)
    table[1001] = [(0, "system", "Rules.", 1)] + [(i, "user" if i % 2 else "assistant", f"t {i}.", 1) for i in range(1, 301)]
    table[1002] = [(i, "user", "same.", 1) for i in range(100)]
    table[1003] = [(5, "user", "again.", 50), (5, "assistant", "", 30), (None, "user", "first?", 1)]
    table[1004] = [(i, "user", f"line {i}.", 1) for i in range(120)]
    table[None] = _random_rows(rng, 6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    try:
        got = digest(spark, table)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {c: expected(ordered(rows)) for c, rows in table.items()}


def test_nothing_left(spark):
    empty = hashlib.sha256(b"").hexdigest()
    assert digest(spark, {1: [(0, "user", "x.", 0)], 2: [(None, "user", "", 1)]}) == {
        1: (0, 0, 0, 0, 0, 0, "", empty), 2: (0, 1, 0, 0, 0, 4, "D", empty)}
    schema = "conv_id long, turn long, role string, text string, copies int"
    assert conv.audit(spark.createDataFrame([], schema)).collect() == []


def test_damage(spark, tmp_path):
    """Planted faults, nulls as one space, extra columns, the query itself."""
    rng = random.Random(8)
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, *range(9)]), rng.choice([None, "user", "assistant", "system"]),
             rng.choice([None, "", "One. Two!", "three?", "no end"]), "x", 1) for _ in range(400)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, copies string, name int")
    df.coalesce(2).write.parquet(f"{tmp_path}/conversations.parquet")
    table: dict = {}
    for c, t, role, text, *_ in rows:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        text = "" if fate == 1 else "".join(x for x in text if x not in ".!?") if fate == 2 else text
        table.setdefault(c, []).append((t, "user" if fate == 4 else role, text, {0: 0, 3: 2}.get(fate, 1)))
    got = {r["conv_id"]: r for r in queries.QUERIES["op11_conversations"](spark, str(tmp_path)).collect()}
    assert set(got) == set(table)
    for c, mine in table.items():
        r = got[c]
        assert (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"],
                r["repaired_sha256"]) == expected(ordered(mine))


def test_run_powers_are_products_of_single_rows():
    for symbol in "suaoSUAOdb":
        for n in (1, 2, 3, 7, 64, 100):
            step = conv.END
            for _ in range(n):
                step = conv.product(conv.power(symbol, 0), step)
            assert conv.advance(symbol, n, conv.END) == step
            whole = conv.advance(symbol, n, conv.ONE)
            assert conv.product(whole, conv.END) == step
