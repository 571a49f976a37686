"""Conversation structure repair as a lightest derivation (Knuth's agenda).

Repairing turns is a weighted deduction: an item says that the turns up to some place have been edited into roles that leave the target
pattern in some state, its weight is (cost, audit), the edits' initials in order. Every rule adds a cost of zero or more and appends to the
audit, so weights only grow (superior functions) and the agenda may finalise an item the first time it is popped. Two derivations of one item
consume the same turns, so neither of two audits of one cost begins the other and appending keeps their order.

Conversations of any length are cut into blocks; a block gives the lightest span from every state to every state, and spans of neighbouring
blocks are combined by a rule with two antecedents, a bounded number at a time, until one goal item is left per conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import map_rows, stored
from shelfwise.operators.grouping import prefix_sums

KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATED = 5
#: State before anything and after a role initial. Start and assistant end a repaired conversation: ``(s?(ua)+)?``.
START, SYSTEM, USER, ASSISTANT = 0, 1, 2, 3
FOLLOWS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ENDS = (START, ASSISTANT)
SPOKEN = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
#: Turns of a block, and blocks combined at a time.
BLOCK, FAN = 256, 64

Weight = tuple[int, str]
Item = tuple
_TEXT = r"[^\x20\x09-\x0D]"
_SPAN = "array<struct<start:int,end:int,cost:long,audit:string>>"
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_PART = f"cid long, block long, blocks long, {', '.join(f'{c} long' for c in _COUNTS)}, first string, last string, spans {_SPAN}"


def damage(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text) of every row after a fault decided by CRC-32 of ``conv:turn``, modulo 20.

    0 drops the row, 1 empties its text, 2 removes its ``. ! ?``, 3 repeats it, 4 makes it the user's; nulls are read as one space.
    """
    conv, turn = F.col(conv_col), F.col(turn_col)
    read = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(read(conv), F.lit(":"), read(turn)).cast("binary")) % 20
    role, text = read(F.col(role_col)), read(F.col(text_col))
    copies = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    return turns.select(
        conv.alias("conv"), turn.alias("turn"), F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.sequence(F.lit(0), copies)).alias("copy")).filter("copy > 0").drop("copy")


def agenda(axioms: Iterable[tuple[Item, Weight]], consequences: Callable[[Item, dict[Item, Weight]], Iterable[tuple[Item, Weight]]],
           goal: Item | None = None) -> dict[Item, Weight]:
    """Lightest weight of every item derivable, or of those up to ``goal``.

    ``consequences`` gives what a newly finalised item yields alone or together with other finalised ones.
    """
    best: dict[Item, Weight] = {}
    final: dict[Item, Weight] = {}
    heap: list[tuple[int, str, Item]] = []

    def offer(derived: Iterable[tuple[Item, Weight]]) -> None:
        for item, weight in derived:
            if item not in final and (item not in best or weight < best[item]):
                best[item] = weight
                heappush(heap, (*weight, item))

    offer(axioms)
    while heap:
        cost, audit, item = heappop(heap)
        if item in final:
            continue
        final[item] = cost, audit
        if item == goal:
            break
        offer(consequences(item, final))
    return final


GOAL = ("goal",)


def _edits(rows: list[tuple[str, str]], entry: int, place: int, state: int) -> Iterator[tuple[int, int, int, str]]:
    """(place, state, cost, initial) after each edit possible before ``rows[place]`` in ``state``; a row is its role initial and fault."""
    for said in SPOKEN:
        if (then := FOLLOWS.get((state, said))) is not None:
            yield place, then, INSERT, "I"
    if place == len(rows):
        return
    initial, fault = rows[place]
    yield place + 1, state, DELETE, "D"
    if fault in ("b", "d"):
        return
    extra = TRUNCATED if fault == "t" else 0
    if (then := FOLLOWS.get((state, initial))) is not None:
        yield place + 1, then, KEEP + extra, "K"
    for said in SPOKEN:
        if (then := FOLLOWS.get((state, said))) is not None:
            yield place + 1, then, REROLE + extra, "R"


def spans(rows: list[tuple[str, str]], whole: bool) -> list[tuple[int, int, int, str]]:
    """Lightest (start, end, cost, audit) over a block from every state, or, for a whole conversation, the goal's alone."""
    n = len(rows)

    def after(item: Item, final: dict[Item, Weight]) -> Iterator[tuple[Item, Weight]]:
        entry, place, state = item
        cost, audit = final[item]
        if whole and place == n and state in ENDS:
            yield GOAL, (cost, audit)
        for to, then, paid, initial in _edits(rows, entry, place, state):
            yield (entry, to, then), (cost + paid, audit + initial)

    entries = (START,) if whole else (START, SYSTEM, USER, ASSISTANT)
    found = agenda([((q, 0, q), (0, "")) for q in entries], after, GOAL if whole else None)
    if whole:
        return [(START, START, *found[GOAL])]
    return [(item[0], item[2], *weight) for item, weight in found.items() if item[1] == n]


def combine(children: list[list[tuple[int, int, int, str]]], whole: bool) -> list[tuple[int, int, int, str]]:
    """Lightest spans over neighbouring blocks: a span so far and the next block's span meet in a state."""
    n = len(children)
    axioms = [(("block", i, q, r), (c, a)) for i, child in enumerate(children) for q, r, c, a in child]
    entries = (START,) if whole else (START, SYSTEM, USER, ASSISTANT)
    axioms += [(("so far", 0, q, q), (0, "")) for q in entries]

    def join(left: Item, right: Item, final: dict[Item, Weight]) -> tuple[Item, Weight]:
        (c, a), (d, b) = final[left], final[right]
        return ("so far", left[1] + 1, left[2], right[3]), (c + d, a + b)

    def after(item: Item, final: dict[Item, Weight]) -> Iterator[tuple[Item, Weight]]:
        kind, place, first, last = item
        if kind == "so far":
            if whole and place == n and last in ENDS:
                yield GOAL, final[item]
            for state in range(4):
                if (right := ("block", place, last, state)) in final:
                    yield join(item, right, final)
        else:
            for entry in entries:
                if (left := ("so far", place, entry, first)) in final:
                    yield join(left, item, final)

    found = agenda(axioms, after, GOAL if whole else None)
    if whole:
        return [(START, START, *found[GOAL])]
    return [(i[2], i[3], *weight) for i, weight in found.items() if i[0] == "so far" and i[1] == n]


def _blocks(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
    for b in batches:
        out = []
        for cid, block, blocks, codes in zip(b["cid"], b["block"], b["blocks"], b["codes"], strict=True):
            rows = [(x["code"][0], x["code"][1]) for x in codes]
            faults = "".join(f for _, f in rows)
            illegal = sum(p[0] + q[0] not in LEGAL for p, q in zip(rows, rows[1:], strict=False))
            out.append((cid, block, blocks, faults.count("b"), faults.count("d"), faults.count("t"), illegal, rows[0][0], rows[-1][0],
                        _structs(spans(rows, blocks == 1))))
        yield _columns(out)


def _merged(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
    for b in batches:
        out = []
        for cid, block, blocks, parts in zip(b["cid"], b["block"], b["blocks"], b["parts"], strict=True):
            illegal = sum(p["last"] + q["first"] not in LEGAL for p, q in zip(parts, parts[1:], strict=False))
            sums = [sum(p[c] for p in parts) for c in _COUNTS]
            found = combine([[(s["start"], s["end"], s["cost"], s["audit"]) for s in p["spans"]] for p in parts], blocks == 1)
            out.append((cid, block, blocks, *sums[:3], sums[3] + illegal, parts[0]["first"], parts[-1]["last"], _structs(found)))
        yield _columns(out)


def _structs(found: list[tuple[int, int, int, str]]) -> list[dict]:
    return [dict(zip(("start", "end", "cost", "audit"), x, strict=True)) for x in found]


def _columns(rows: list[tuple]) -> dict[str, list]:
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    kinds = [pa.int64()] * 7 + [pa.string()] * 2 + [span]
    names = ("cid", "block", "blocks", *_COUNTS, "first", "last", "spans")
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return {n: pa.array(list(c), k) for n, c, k in zip(names, columns, kinds, strict=True)}


def _edited(batches: Iterator[dict[str, list]]) -> Iterator[tuple[int, str | None, str]]:
    """(cid, role, text) of repaired turns, after one without role where a conversation begins.

    A conversation's first row brings its audit as text, the others are its turns in order; only the audit and one row are held. An audit
    fixes all roles: those of edited and inserted turns are what the state asks for.
    """
    audit, at, state = "", 0, START

    def spoken() -> str:
        return "a" if state == USER else "u"

    for b in batches:
        for cid, place, role, text in zip(b["cid"], b["place"], b["role"], b["text"], strict=True):
            if place < 0:
                audit, at, state = text, 0, START
                yield cid, None, ""
            else:
                edit, at = audit[at], at + 1
                if edit != "D":
                    said = role[:1] if edit == "K" else spoken()
                    state = FOLLOWS[state, said]
                    yield cid, role if edit == "K" else SPOKEN[said], text
            while audit[at:at + 1] == "I":
                said, at = spoken(), at + 1
                state = FOLLOWS[state, said]
                yield cid, SPOKEN[said], ""


def _digests(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
    now, digest, join = None, hashlib.sha256(), b""
    for cid, role, text in _edited(batches):
        if role is None:
            if now is not None:
                yield {"cid": [now], "repaired_sha256": [digest.hexdigest()]}
            now, digest, join = cid, hashlib.sha256(), b""
        else:
            digest.update(join + f"{role}:{text}".encode())
            join = b"\n"
    if now is not None:
        yield {"cid": [now], "repaired_sha256": [digest.hexdigest()]}


def _turns(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
    out, size, place = [], 0, 0
    for cid, role, text in _edited(batches):
        place = 0 if role is None else place + 1
        if role is not None:
            out.append((cid, place - 1, role, text))
            size += len(text)
        if len(out) >= 1024 or size > 1 << 22:
            yield dict(zip(("cid", "place", "role", "text"), map(list, zip(*out, strict=True)), strict=True))
            out, size = [], 0
    if out:
        yield dict(zip(("cid", "place", "role", "text"), map(list, zip(*out, strict=True)), strict=True))


def _code() -> Column:
    """Two characters: role initial (``x`` for any but s, u, a) and fault (b, t or a dash; duplicates are marked later)."""
    initial = F.substring("role", 1, 1)
    said = F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", "")
    fault = F.when(~F.col("text").rlike(_TEXT), "b").when(F.substring(said, -1, 1).isin(".", "!", "?"), "-").otherwise("t")
    return F.concat(F.when(initial.isin("s", "u", "a"), initial).otherwise("x"), fault)


def _solved(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Conversations (of, cid, gaps), their counts with goal cost and audit (by cid), and for each its audit and rows as a stream in order."""
    read = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    own = turns.select("conv", "turn", read("role"), read("text"), F.lit(1).alias("one"))
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "text")]
    placed = prefix_sums(own, order, "one").select("conv", "turn", "role", "text", "position")
    # a conversation is known by the place of its first row, so that keys of any type, or none, are plain numbers below
    per_turn = placed.groupBy("conv", "turn").agg(F.min("position").alias("low"), F.count(F.lit(1)).alias("n"))
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long")
    known = stored(per_turn.groupBy(F.col("conv").alias("of")).agg(
        F.min("low").alias("cid"), F.sum("n").alias("n"), gaps.alias("gaps")), "conversations")
    rows = stored(
        placed.join(known.select("of", "cid", "n"), F.col("conv").eqNullSafe(F.col("of")))
        .select("cid", (F.col("position") - F.col("cid")).alias("place"), "n", "role", "text"), "turns")
    marks = rows.select("cid", "place", "n", _code().alias("code"), F.md5(F.concat_ws(":", F.length("role"), "role", "text")).alias("said"))
    first = marks.groupBy("cid", "said").agg(F.min("place").alias("first"))
    again = (F.col("place") > F.col("first")) & ~F.col("code").endswith("b")
    coded = marks.join(first, ["cid", "said"]).select(
        "cid", "place", "n", F.when(again, F.concat(F.substring("code", 1, 1), F.lit("d"))).otherwise(F.col("code")).alias("code"))
    ceil = lambda n, by: F.expr(f"({n} + {by - 1}) div {by}")
    parts = stored(map_rows(
        coded.groupBy("cid", F.expr(f"place div {BLOCK}").alias("block"), ceil("n", BLOCK).alias("blocks"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "code"))).alias("codes")), _blocks, _PART), "blocks")
    done = parts.filter("blocks = 1")
    rest = parts.filter("blocks > 1")
    while not rest.isEmpty():
        grouped = rest.groupBy("cid", F.expr(f"block div {FAN}").alias("block"), ceil("blocks", FAN).alias("blocks")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("block").alias("at"), *_COUNTS, "first", "last", "spans"))).alias("parts"))
        level = stored(map_rows(grouped, _merged, _PART), "blocks")
        done, rest = done.unionByName(level.filter("blocks = 1")), level.filter("blocks > 1")
    solved = done.select("cid", *_COUNTS, F.get("spans", F.lit(0)).alias("goal")).select("cid", *_COUNTS, "goal.cost", "goal.audit")
    lead = solved.select("cid", F.lit(-1).cast("long").alias("place"), F.lit("").alias("role"), F.col("audit").alias("text"))
    stream = lead.unionByName(rows.select("cid", "place", "role", "text")).repartition("cid").sortWithinPartitions("cid", "place")
    return known.drop("n"), solved, stream


def repair(turns: DataFrame, convs: DataFrame | None = None) -> DataFrame:
    """One row per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 (``role:text`` by lines).

    ``turns`` has conv, turn, role, text, as made by ``damage``; ``convs`` (conv) lists conversations to report even without rows. Rows are
    taken by turn, nulls first, ties by role and text; null roles and texts count as one space. A row's first fault counts: blank, duplicate
    (role and text seen earlier), truncated (last visible character not one of ``. ! ?``). ``gaps`` are turn numbers missing between the
    lowest and highest, zero without numbers. The cheapest edits giving role initials ``(s?(ua)+)?``, of these the ASCII-least audit, are
    applied. A null conv is a conversation too; without rows: zeros, an empty audit, the hash of nothing. Other columns are not read.
    """
    known, solved, stream = _solved(turns)
    digests = map_rows(stream, _digests, "cid long, repaired_sha256 string")
    found = known.join(solved, "cid").join(digests, "cid").drop("cid")
    if convs is None:
        return found.withColumnRenamed("of", "conv")
    zeros = {c: 0 for c in ("gaps", *_COUNTS, "cost")} | {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    listed = convs.select("conv").distinct()
    return listed.join(found, F.col("conv").eqNullSafe(F.col("of")), "left").drop("of").fillna(zeros, list(zeros))


def repaired_turns(turns: DataFrame) -> DataFrame:
    """(conv, place from 0, role, text) of every turn after the edits ``repair`` reports; conversations that end up empty have no rows."""
    known, _, stream = _solved(turns)
    rows = map_rows(stream, _turns, "cid long, place long, role string, text string")
    return known.select(F.col("of").alias("conv"), "cid").join(rows, "cid").drop("cid")
