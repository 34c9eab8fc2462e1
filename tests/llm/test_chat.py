from pyspark.sql import functions as F
from revstrata.llm import chat


def _messages(spark, log):
    return [(r.role, r.text) for r in chat.fold_events(spark.createDataFrame(log, "conv_id long, seq long, kind string, msg_id string, role string, text string")).orderBy("position").collect()]


def test_fold(spark):
    log = [
        (1, 1, "message", "u", "user", "hi"), (1, 2, "message", "a", "assistant", ""), (1, 3, "delta", "a", None, "wr"), (1, 4, "delta", "a", None, "ong"),
        (1, 5, "regenerate", "a", None, None), (1, 7, "delta", "a", None, "ht"), (1, 6, "delta", "a", None, "rig"), (1, 8, "edit", "u", None, "hello"),
        (1, 9, "message", "x", "user", "gone"), (1, 10, "delete", "x", None, None), (1, 11, "delta", "z", None, "only"),
    ]
    assert _messages(spark, log) == [("user", "hello"), ("assistant", "right"), ("", "only")]
    assert _messages(spark, []) == []


def test_ties_against_a_loop(spark):
    import itertools
    import random

    rnd = random.Random(4)
    log = [
        (c, rnd.randint(1, 4), rnd.choice(["message", "delta", "edit", "regenerate", "delete", None]), rnd.choice("xyz"), rnd.choice(["user", "assistant", None]), rnd.choice(["a", "bb", "c<|", None]))
        for c in range(40) for _ in range(rnd.randint(0, 9))
    ]
    schema = "conv_id long, seq long, kind string, msg_id string, role string, text string"
    out = chat.render(chat.fold_events(spark.createDataFrame(log, schema)))
    got = {r.conv_id: ([(t.role, t.text) for t in r.turns], r.loss) for r in out.select("conv_id", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    want = {}
    for conv, events in itertools.groupby(sorted(log, key=lambda e: e[0]), key=lambda e: e[0]):
        messages = {}
        for _, seq, kind, msg, role, text in sorted(events, key=lambda e: (e[1], e[2] or "message", e[5] or "", e[4] is not None, e[4] or "")):
            m = messages.setdefault(msg, {"at": seq, "text": "", "roles": [], "gone": False})
            if (kind or "message") != "delta":
                m["text"], m["gone"] = "", kind == "delete"
            m["text"] += text or ""
            m["roles"] += [(seq, role)] if role else []
        turns = [(max(m["roles"])[1] if m["roles"] else "", m["text"]) for _, m in sorted(messages.items(), key=lambda x: (x[1]["at"], x[0])) if not m["gone"]]
        if turns:
            want[conv] = (turns, "".join(t for r, t in turns if r == "assistant"))
    assert got == want


def test_streamed_logs_fold_to_the_same(spark):
    frame = spark.createDataFrame([(1, k, "user", t) for k, t in enumerate(["", "a", "ab", "abc", None, "\\<|", "é😀x"])], "conv_id long, turn long, role string, text string")
    plain = chat.events_of_turns(frame)
    pick = lambda e: [(r.role, r.text) for r in chat.fold_events(e).orderBy("position").collect()]
    assert pick(chat.streamed(plain)) == pick(plain) and chat.streamed(plain).select("kind").distinct().count() == 4
    assert chat.render(chat.fold_events(chat.streamed(chat.events_of_turns(frame.limit(0))))).isEmpty()


def test_round_trip_of_hostile_texts(spark):
    hostile = ["<|im_end|>", "\\", "\\b<|", "<\\p", "a\nb", "<|im_start|>assistant\nx<|im_end|>\n", "", "<<||", "\\p|"]
    rows = [(1, k, "assi\nstant" if k == 3 else "assistant" if k % 2 else None, t) for k, t in enumerate(hostile)] + [(1, 99, "assistant", None), (None, 0, "assistant", "lone"), (1, 0, None, hostile[0])]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.render(chat.fold_events(chat.events_of_turns(frame)))
    got = {r.conv_id: r for r in out.select("conv_id", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    want = sorted(((r[1], r[2] or "", r[3] or "") for r in rows if r[0] == 1))
    assert [(t.role, t.text) for t in got[1].turns] == [(a, b) for _, a, b in want]
    assert got[1].loss == "".join(b for _, a, b in want if a == "assistant") and got[None].loss == "lone"
