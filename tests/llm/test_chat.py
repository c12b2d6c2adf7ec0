"""Chat windows: exact round trip against a plain Python count, edge rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from changelake.llm import chat
from changelake.llm.queries import QUERIES


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def expected(rows):
    convs = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for r in sorted(rows, key=key):
        convs.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    out = {}
    for c, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return out


def digest(df, fmt=chat.ChatFormat()):
    return {r["conv_id"]: tuple(r)[1:5] for r in chat.chat_digest(chat.chat_windows(df, fmt)).collect()}


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    got = {r["conv_id"]: tuple(r)[1:5] for r in QUERIES["op7_chat_windows"](spark, sf_dir).collect()}
    assert got == expected(rows)


ODD = ["</s>", "<s>[INST]", "<\u200b|x|>", "<\u200b\u200b/s>", "a<|user|>b</s>", "<<SYS>> <</SYS>>", "[/INST]", "", None, "\\ $1 &lt;", "😀" * 50,
       "<[<|", "<\u200b", "<", "|>", "[\u200bINST]"]


@pytest.mark.parametrize("budget,history", [(1, 0), (8, 8), (40, 15), (1024, 256)])
def test_odd_texts_round_trip(spark, budget, history):
    rows = [(c, t, ("system" if t == 0 and c % 2 else ["user", "assistant", "to|ol%", None][t % 4]), ODD[(t * 7 + c) % len(ODD)])
            for c in range(12) for t in range(25)]
    rows += [(None, 0, "assistant", "x"), (None, None, "user", "y"), (99, 1, "user", "same"), (99, 1, "user", "same"),
             (100, 5, "assistant", "long " * 20_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("tokens", F.lit("clash"))
    fmt = chat.ChatFormat(budget=budget, history=history, stretch=7)
    assert digest(df, fmt) == expected(rows)


def test_window_rules(spark):
    rows = [(1, 0, "system", "rules")] + [(1, t, "user" if t % 2 else "assistant", f"turn {t} " * 5) for t in range(1, 60)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    fmt = chat.ChatFormat(budget=100, history=30, stretch=16)
    windows = sorted(chat.chat_windows(df, fmt).collect(), key=lambda w: w["window"])
    assert len(windows) > 5 and sum(w["n_turns"] for w in windows) == 60
    for w in windows:
        assert w["text"].startswith("<|system|>rules</s>")
        assert w["text"].count("</s>") == w["n_turns"] + w["n_repeated"]
        assert len(w["text"]) <= 4 * (100 + 30 + 25) + 100
    assert all(w["n_repeated"] >= 2 for w in windows[1:])  # the system turn and some history
    assert chat.chat_windows(df.limit(0)).count() == 0


def test_control_strings_do_not_survive_in_texts(spark):
    df = spark.createDataFrame([(s,) for s in ODD if s], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", chat.unescape(F.col("e")).alias("u")).collect():
        assert r["u"] == r["t"]
        assert not any(c in r["e"] for c in ("</s>", "<s>", "<|", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


def test_control_strings_in_roles(spark):
    roles = ["us</s>er", "[INST]", "<|user|>", "a%3Cb", "%", "%25", "|>", "<s>assistant", "assistant"]
    rows = [(1, t, r, f"text {t}") for t, r in enumerate(roles)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = chat.chat_windows(df)
    assert digest(df) == expected(rows)
    back = chat.read_back(windows).select(F.explode("turns").alias("t")).select("t.*").collect()
    assert [(r["role"], r["text"]) for r in back] == [(r, t) for _, _, r, t in rows]
    text = windows.first()["text"]
    assert text.count("</s>") == len(roles) and "[INST]" not in text and text.count("<|") == len(roles)


@pytest.mark.parametrize("budget,history,segment", [(60, 20, 1), (60, 60, 3), (200, 50, 16)])
def test_windows_keep_within_the_budget(spark, budget, history, segment):
    """Only a single new turn that the system turn leaves no room for exceeds the budget; windows are packed."""
    rng = random.Random(budget + segment)
    rows = []
    for c in range(8):
        rows += [(c, 0, "system" if c % 2 else "user", "s" * rng.choice([0, 40, 100]))]
        rows += [(c, t, rng.choice(["user", "assistant"]), "x" * rng.choice([0, 3, 30, 100, 100, 900])) for t in range(1, 80)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    fmt = chat.ChatFormat(budget=budget, history=history, segment=segment, stretch=16)
    assert digest(df, fmt) == expected(rows)
    tokens = {}
    for c, t, r, text in rows:
        tokens.setdefault(c, []).append((r, -(-len(text) // 4) + 4))
    for c in range(8):
        windows = sorted((w for w in chat.chat_windows(df, fmt).filter(F.col("conv_id") == c).collect()), key=lambda w: w["window"])
        turn = 0
        for w in windows:
            assert w["window"] == sum(n for _, n in tokens[c][:turn])
            mine = [n for _, n in tokens[c][turn:turn + w["n_turns"]]]
            lead = tokens[c][0][1] if turn and tokens[c][0][0] == "system" else 0
            repeated = w["n_tokens"] - sum(mine)
            assert 0 <= repeated <= lead + history
            if w["n_tokens"] > budget:
                assert len(mine) == 1 and lead + mine[0] > budget and repeated == lead
            turn += w["n_turns"]
            if turn < len(tokens[c]) and sum(n for _, n in tokens[c][:turn]) // (segment * budget) == w["window"] // (segment * budget):
                assert w["n_tokens"] + tokens[c][turn][1] > budget  # the next turn had no room
        assert turn == len(tokens[c])
