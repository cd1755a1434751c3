import random

from pyspark.sql import functions as F

from tallyloom.llm.chat_format import PARTS, escaped, format_chats, learned_text, read_turns, text_parts, turn_texts, unescaped

PIECES = ["<|turn|>", "<|body|>", "<|end|>", "<|", "|>", "</s>", "<s>", "[INST]", "[/INST]", "\\", "\\\\", "<", "|", "a",
          "\n", "é😀", "image", "<|image|>", "s>", "/", "[", "]", " "]


def test_escapes_are_reversible(frame):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 9))) for _ in range(800)]
    got = frame("t string", *[(t,) for t in texts]).select("t", escaped(F.col("t")).alias("e"), unescaped(escaped(F.col("t"))).alias("u"))
    for r in got.collect():
        assert r.u == r.t
        assert not any(mark in r.e for mark in ("<|", "</s>", "<s>", "[INST]", "[/INST]"))


def test_round_trip_of_random_chats(frame):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 6)))
    rows = [(c, t, rnd.choice(["user", "assistant", "<|end|>"]), word()) for c in range(20) for t in range(rnd.randint(1, 7))]
    turns = frame("conv_id long, turn long, role string, text string", *rows)
    chats = format_chats(turns, text_parts(turns.text))
    got = chats.select("conv_id", turn_texts("formatted").alias("t"), learned_text(F.col("formatted"), F.col("turns")).alias("l"), "n_turns")
    for r in got.collect():
        own = sorted(x for x in rows if x[0] == r.conv_id)
        assert [tuple(t) for t in r.t] == [x[2:] for x in own] and r.n_turns == len(own)
        assert r.l == "".join(x[3] for x in own if x[2] == "assistant")


def test_round_trip_of_random_parts(spark):
    """Texts cut inside control strings, side by side and between attachments, read back exactly."""
    rnd = random.Random(3)
    marks = ["<|turn|>", "<|body|>", "<|end|>", "<|image|>", "</s>", "<s>", "[INST]", "[/INST]", "a\\\\", "\\", "é😀\n"]

    def parts():
        text = "".join(rnd.choices(marks, k=rnd.randint(0, 5)))
        cuts = sorted(rnd.randint(0, len(text)) for _ in range(rnd.randint(0, 4)))
        texts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]
        files = ("image", "audio", "document")
        return [("text", t, None, None) if rnd.random() < 0.8 else (rnd.choice(files), None, t, len(t)) for t in texts]

    rows = [(c, t, rnd.choice(["user", "assistant", "<|e"]), parts()) for c in range(500) for t in range(rnd.randint(1, 3))]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {PARTS}")
    chats = format_chats(turns, turns.parts)
    got = chats.select("*", read_turns("formatted").alias("back"), learned_text(F.col("formatted"), F.col("turns")).alias("l"))
    seen = got.collect()
    assert len(seen) == 500
    for r in seen:
        own = sorted((x for x in rows if x[0] == r.conv_id), key=lambda x: x[1])
        wanted, shown = [], ""
        for _, _, role, some in own:
            runs = [""]
            for kind, text, _, _ in some:
                runs[-1:] = [runs[-1] + text] if kind == "text" else [runs[-1], (kind,), ""]
            wanted.append((role, [x for x in runs if x]))
            shown += "".join(x if isinstance(x, str) else f"<|{x[0]}|>" for x in runs) if role == "assistant" else ""
        back = []
        for turn in r.back:
            runs = [""]
            for p in turn.parts:
                runs[-1:] = [runs[-1] + p.text] if p.type == "text" else [runs[-1], (p.type,), ""]
            back.append((turn.role, [x for x in runs if x]))
        assert back == wanted and r.l == shown
        files = [(t + 1, i + 1, p[0], p[2], p[3]) for t, x in enumerate(own) for i, p in enumerate(x[3]) if p[0] != "text"]
        assert [(m.turn, m.part, m.type, m.ref, m.n_tokens) for m in r.attachments] == files
        assert all(r.formatted[m.start :].startswith(f"<|{m.type}|>") for m in r.attachments)


def test_parts_become_placeholders_in_order(spark):
    rows = [
        (1, 0, "user", [("text", "look: <|image|>", None, None), ("image", None, "s://1.png", 85), ("text", " and ", None, None),
                        ("audio", None, "s://2.wav", 40), ("video", None, "s://3", None)]),
        (1, 1, "assistant", [("document", None, "s://4.pdf", -3), (None, "seen", None, None)]),
        (1, 2, "user", None),
    ]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {PARTS}")
    (r,) = format_chats(turns, turns.parts).select("*", read_turns("formatted").alias("back")).collect()
    marks = [(m.turn, m.part, m.type, m.ref, m.n_tokens) for m in r.attachments]
    assert marks == [
        (1, 2, "image", "s://1.png", 85), (1, 4, "audio", "s://2.wav", 40), (1, 5, "video", "s://3", 0),
        (2, 1, "document", "s://4.pdf", 0),
    ]
    shown = ["<|image|>", "<|audio|>", "<|unknown|>", "<|document|>"]
    assert [r.formatted[m.start :].startswith(s) for m, s in zip(r.attachments, shown, strict=True)] == [True] * 4
    assert r.n_expanded == 125 and r.n_turns == 3
    back = [[(p.type, p.text) for p in t.parts] for t in r.back]
    assert back == [
        [("text", "look: <|image|>"), ("image", None), ("text", " and "), ("audio", None), ("unknown", None)],
        [("document", None), ("text", "seen")],
        [],
    ]
    learn = [r.formatted[t.a : t.b] for t in r.turns if t.learn]
    assert learn == ["<|document|>seen"]


def test_odd_rows(frame):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (None, None, None, "x"), (None, 1, "assistant", ""), (2, 5, None, "\x00 long " * 9000)]
    turns = frame("conv_id long, turn long, role string, text string", *rows).withColumn("_at", F.lit(1)).withColumn("_text", F.lit("z"))
    chats = format_chats(turns, text_parts(turns.text))
    got = {r.conv_id: r for r in chats.select("*", turn_texts("formatted").alias("t")).collect()}
    assert [tuple(t) for t in got[1].t] == [("user", "")] * 2
    assert [tuple(t) for t in got[None].t] == [("", "x"), ("assistant", "")]
    assert got[2].t[0].text == rows[4][3]
    assert format_chats(turns.where("false"), text_parts(turns.text)).count() == 0
