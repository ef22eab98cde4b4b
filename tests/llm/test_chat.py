import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from kamienica.llm import chat

CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<\\s>", "<", "[", "ok", "\n", " é😀 ", "/s>", "<<s>>", "[[INST]]"]


def log(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, seq long, kind string, turn long, role string, text string")


def fold_brute(events):
    turns = {}
    for _, seq, kind, turn, role, text in sorted(events, key=lambda e: (e[1], e[3], e[2], e[5] or "")):
        text, role = text or "", role or ""
        if kind == "message":
            turns[turn] = [role, text]
        elif kind == "delta":
            turns.setdefault(turn, ["", ""])[1] += text
        elif kind == "edit":
            turns.setdefault(turn, ["", ""])[1] = text
        elif kind == "regenerate":
            role = turns.get(turn, [""])[0]
            for t in [t for t in turns if t >= turn]:
                del turns[t]
            turns[turn] = [role, ""]
    return {t: tuple(v) for t, v in turns.items()}


def test_fold_against_replay(spark):
    rng = random.Random(2)
    rows = []
    for conv in range(40):
        for seq in range(rng.randint(1, 25)):
            kind = rng.choice(["message", "delta", "delta", "delta", "edit", "regenerate", "noise"])
            rows.append((conv, seq, kind, rng.randint(0, 4), rng.choice(["user", "assistant", None]), rng.choice(["a", "b", None, ""])))
    got = {}
    for r in chat.fold(log(spark, rows)).collect():
        got.setdefault(r["conv_id"], {})[r["turn"]] = (r["role"], r["text"])
    for conv in range(40):
        assert got.get(conv, {}) == fold_brute([e for e in rows if e[0] == conv]), conv


def told(rows):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in rows).encode()).hexdigest()


def test_round_trip_and_mask(spark):
    rng = random.Random(3)
    convs = {c: [(rng.choice(["user", "assistant", "system", "<s>", "a\nb", None]),
                  "".join(rng.choice(CONTROL) for _ in range(rng.randint(0, 12))) if rng.random() > .1 else None)
                 for _ in range(rng.randint(1, 6))] for c in [*range(60), None]}
    rows = [(c, t, role, text) for c, turns in convs.items() for t, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    rendered = chat.render(chat.fold(chat.log_of(messages)))
    for r in rendered.collect():
        wanted = [(a or "", b or "") for a, b in convs[r["conv_id"]]]
        assert r["formatted"].count("<s>") == r["formatted"].count("</s>") == r["formatted"].count("[/INST]") == len(wanted)
        spans = ["".join(r["formatted"][s["first"]:s["first"] + s["n"]]) for s in r["mask"]]
        assert [chat_unescape(s) for s in spans] == [t for a, t in wanted if a == "assistant"]
    for r in chat.digest(rendered).collect():
        wanted = [(a or "", b or "") for a, b in convs[r["conv_id"]]]
        loss = "".join(t for a, t in wanted if a == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(wanted), told(wanted))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def chat_unescape(text):
    out, i = "", 0
    while i < len(text):
        if text[i] == "\\":
            out += "\\" if text[i + 1:i + 2] == "\\" else ""
            i += 2 if text[i + 1:i + 2] == "\\" else 1
        else:
            out, i = out + text[i], i + 1
    return out


@given(st.lists(st.lists(st.sampled_from(CONTROL), max_size=8).map("".join), min_size=1, max_size=20))
@settings(max_examples=10, deadline=None)
def test_escape_is_reversible(spark, texts):
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect()
    for r in rows:
        assert r["u"] == r["t"] and not any(c in r["e"] for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_repeated_rows_are_turns_and_empty_table(spark):
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, None, None, None)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out, = chat.digest(chat.render(chat.fold(chat.log_of(messages)))).collect()
    assert out["n_turns"] == 3 and out["loss_chars"] == 0
    assert chat.digest(chat.render(chat.fold(chat.log_of(messages.limit(0))))).collect() == []


def test_long_conversation(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"é{t} " * 50) for t in range(3000)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out, = chat.digest(chat.render(chat.fold(chat.log_of(messages)))).collect()
    assert out["n_turns"] == 3000 and out["turns_sha256"] == told([(r[2], r[3]) for r in rows])
