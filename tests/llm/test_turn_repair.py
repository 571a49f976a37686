import hashlib
import random
import re
import zlib

from shelfwise.llm import turn_repair as tr

SCHEMA = "conv_id long, turn long, role string, text string, cid int, place string"
EMPTY = hashlib.sha256().hexdigest()
TARGET = re.compile(r"(s?(ua)+)?")


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "own") for r in rows], SCHEMA)


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        read = lambda x: " " if x is None else str(x)
        fault = zlib.crc32(f"{read(conv)}:{read(turn)}".encode()) % 20
        role, text = read(role), read(text)
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        shown = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute_edits(rows, marks):
    """Every state's cheapest (cost, audit, repaired) row by row, inserts relaxed until nothing changes; no agenda."""
    step = {"": "su", "s": "u", "u": "a", "a": "u"}
    now = {"": (0, "", ())}

    def better(table, key, value):
        if key not in table or value[:2] < table[key][:2]:
            table[key] = value
            return True
        return False

    def insert(table):
        changed = True
        while changed:
            changed = False
            for key, (cost, audit, done) in list(table.items()):
                for said in set(step[key]) & {"u", "a"}:
                    full = {"u": "user", "a": "assistant"}[said]
                    changed |= better(table, said, (cost + 5, audit + "I", (*done, f"{full}:")))

    insert(now)
    for (role, text), mark in zip(rows, marks, strict=True):
        then = {}
        for key, (cost, audit, done) in now.items():
            better(then, key, (cost + 2, audit + "D", done))
            if mark in ("blank", "duplicate"):
                continue
            extra = 5 * (mark == "truncated")
            if role[:1] and role[:1] in step[key]:
                better(then, role[:1], (cost + extra, audit + "K", (*done, f"{role}:{text}")))
            for full in ("user", "assistant"):
                if full[0] in step[key]:
                    better(then, full[0], (cost + 1 + extra, audit + "R", (*done, f"{full}:{text}")))
        insert(then)
        now = then
    return min(now[k] for k in ("", "a") if k in now)


def brute(rows, convs):
    out = []
    for conv in convs:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        said = [r[2:] for r in mine]
        marks = faults(said)
        cost, audit, done = brute_edits(said, marks)
        initials = [r[:1] for r, _ in said]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        assert TARGET.fullmatch("".join(x[0] for x in done))
        out.append((conv, gaps, *(marks.count(m) for m in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256("\n".join(done).encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **how):
    turns = frame(spark, rows)
    got = tr.repair(tr.damage(turns), turns.selectExpr("conv_id AS conv"))
    return sorted((tuple(r) for r in got.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()), key=str)


def some_rows(seed, convs, most):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \n", None, "same.", "Ende. \x0b", "é.", "dot. "]
    roles = ["user", "assistant", "system", "tool", None, "", "user", "assistant", "umpire"]
    return [(c, rng.choice([None, t, t, t, t + 1]), rng.choice(roles), rng.choice(texts)) for c in convs for t in range(rng.randint(0, most))]


def test_damage(spark):
    rows = some_rows(1, [*range(60), None], 12)
    got = sorted((tuple(r) for r in tr.damage(frame(spark, rows)).collect()), key=str)
    assert got == sorted(brute_damage(rows), key=str)


def test_matches_brute_force(spark):
    rows = some_rows(2, [*range(150), None], 14)
    assert found(spark, rows) == brute(brute_damage(rows), list({r[0] for r in rows}))


def test_long_conversations_in_blocks(spark, monkeypatch):
    rows = some_rows(3, range(6), 90)
    monkeypatch.setattr(tr, "BLOCK", 4)
    monkeypatch.setattr(tr, "FAN", 3)
    assert found(spark, rows) == brute(brute_damage(rows), list({r[0] for r in rows}))


def test_spans_of_blocks_combine_to_the_whole():
    rng = random.Random(4)
    for _ in range(200):
        rows = [(rng.choice("suax"), rng.choice("-bdt-")) for _ in range(rng.randint(1, 12))]
        cut = [rows[i:i + 3] for i in range(0, len(rows), 3)]
        assert tr.combine([tr.spans(x, False) for x in cut], True) == tr.spans(rows, True)


def test_agenda_stops_at_the_goal():
    popped = []

    def after(item, final):
        popped.append(item)
        n = item[0]
        return [((n + 1,), (final[item][0] + 1, final[item][1] + "x"))]

    final = tr.agenda([((0,), (0, ""))], after, (5,))
    assert final[(5,)] == (5, "xxxxx") and popped == [(i,) for i in range(5)]


def test_repaired_turns_hash_to_the_digest(spark):
    rows = some_rows(5, range(40), 10)
    turns = tr.damage(frame(spark, rows))
    said = {}
    for r in sorted(tr.repaired_turns(turns).collect()):
        said.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
    for r in tr.repair(turns).collect():
        assert hashlib.sha256("\n".join(said.get(r.conv, [])).encode()).hexdigest() == r.repaired_sha256


def test_all_rows_dropped_and_empty_table(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert found(spark, [(gone, 0, "user", "Hi.")]) == [(gone, 0, 0, 0, 0, 0, 0, "", EMPTY)]
    assert found(spark, []) == []


def test_very_long_text_and_string_ids(spark):
    turns = spark.createDataFrame([("a", 1, "user", "x" * 2_000_000 + "."), ("a", 2, "assistant", "y."), (None, 1, "user", "z")],
                                  "conv string, turn int, role string, text string")
    got = {r.conv: (r.cost, r.audit) for r in tr.repair(turns).collect()}
    assert got == {"a": (0, "KK"), None: (2, "D")}
