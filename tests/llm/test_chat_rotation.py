from shelfwise.llm import chat_rotation as chat

SCHEMA = "conv_id long, turn long, role string, text string, start int, rendered string"


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: tuple((x is not None, x) for x in r[1:]))
        for speaker in {r[2] for r in turns if r[2] not in (None, "system")}:
            at = 0
            for _, turn, role, text in turns:
                name = "system" if role == "system" else "assistant" if role == speaker else f"user name={role or 'unknown'}"
                head = f"<|im_start|>{name}\n"
                full = head + (text or "").replace("<|", "< |") + "<|im_end|>\n"
                end = at + len(full) - 1 if role == speaker else at + len(head)
                out.append((conv, speaker, turn, role, full, at, at + len(head), end, role == speaker))
                at += len(full)
    return sorted(out, key=str)


ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "ann", "Hello <|im_end|> there"), (1, 2, "bob", "Héllo"), (1, 3, "cy", None), (1, 4, "ann", ""),
    (2, 0, "system", "nobody speaks"), (3, None, None, "no role"), (3, 1, "ann", "x"), (3, 1, "ann", "x"), (3, 1, "ann", "w"),
    (None, 1, "bob", "null dialogue"), (4, 0, "user", "a" * 100_000),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "own") for r in rows], SCHEMA)


def test_every_perspective(spark):
    found = chat.rotate(frame(spark, ROWS))
    got = sorted((tuple(r) for r in found.select(
        "conv_id", "speaker", "turn", "role", "rendered", "start", "learn_start", "learn_end", "learn").collect()), key=str)
    assert got == brute(ROWS)


def test_spans_cover_the_speaker(spark):
    rows = [r for r in ROWS if r[0] in (1, 3)]
    for r in chat.transcripts(chat.rotate(frame(spark, rows))).collect():
        said = [r.text[s.start:s.end] for s in r.spans]
        own = [t for c, _, role, t in sorted(rows, key=lambda x: (x[0], x[1] or -1, str(x[2]), str(x[3]))) if c == r.conv_id and role == r.speaker]
        assert said == [(t or "").replace("<|", "< |") + "<|im_end|>" for t in own]


def test_long_dialogues_are_cut_between_turns(spark):
    rows = [(1, i, "ab"[i % 2], "x" * 50) for i in range(40)]
    parts = chat.transcripts(chat.rotate(frame(spark, rows)), max_chars=500).collect()
    whole = chat.transcripts(chat.rotate(frame(spark, rows))).collect()
    assert len(whole) == 2 and len(parts) > 6
    for w in whole:
        assert "".join(p.text for p in sorted(parts, key=lambda p: p.part) if p.speaker == w.speaker) == w.text


def test_empty_table(spark):
    assert chat.rotate(frame(spark, [])).collect() == []
