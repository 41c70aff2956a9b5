import hashlib
import random

from factorfall.llm import chat_format as m

BITS = ["<", "[", "\\", "|im_start|>", "|im_end|>", "/s>", "s>", "/INST]", "INST]", "\n", "user", "ok", "é", "\U0001f600", "<|im_end|>\n", "<\\|im_end|>"]


def rows_of(spark, turns):
    return spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")


def expected(turns):
    by = {}
    for conv, turn, role, text in turns:
        by.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    out = {}
    for conv, ts in by.items():
        ts.sort(key=lambda t: (t[0], t[1] or 0, t[2], t[3]))
        spoken = "".join(f"{r}\n{t}\n" for _, _, r, t in ts)
        loss = "".join(t for _, _, r, t in ts if r == "assistant")
        out[conv] = (len(ts), hashlib.sha256(spoken.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def digests(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in m.chat_digest(df).collect()}


def test_round_trip_of_hostile_texts(spark):
    rng = random.Random(1)
    turns = []
    for conv in range(150):
        for turn in range(rng.randint(1, 6)):
            text = "".join(rng.choice(BITS) for _ in range(rng.randint(0, 8)))
            role = rng.choice(["user", "assistant", "assistant", "system", "", "a\nb\\n", "<|im_end|>", "\\"])
            turns.append((conv, turn, role, text))
    assert digests(rows_of(spark, turns)) == expected(turns)


def test_whole_table(spark, table):
    turns = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table("conversations").collect()]
    assert digests(table("conversations")) == expected(turns)


def test_one_example_per_assistant_turn(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "A</s>"), (1, 3, "user", "v"), (1, 4, "assistant", "B"), (1, 5, "user", "w"), (2, 0, "user", "x")]
    found = sorted(m.examples(rows_of(spark, turns)).collect())
    assert [(r["conv_id"], r["example"]) for r in found] == [(1, 0), (1, 1), (1, 2), (2, 0)]
    for r, reply in zip(found, ["A<\\/s>", "B"]):
        assert r["formatted"][r["loss_start"] : r["loss_end"]] == reply
        assert r["formatted"].endswith(reply + m.END + "\n")
    assert found[0]["formatted"].count(m.START) == 3 and found[1]["formatted"].count(m.START) == 5
    assert found[2]["loss_start"] is None and found[2]["formatted"].count(m.START) == 6
    for r in found:
        assert "</s>" not in r["formatted"]


def test_odd_rows(spark):
    turns = [(1, 0, None, None), (1, 0, None, None), (1, None, "assistant", ""), (None, 3, "user", "x"), (None, 1, "assistant", "y" * 50_000), (4, 1, "assistant", "b"), (4, 1, "assistant", "a")]
    df = rows_of(spark, turns).selectExpr("*", "'x' AS own", "1 AS example", "'c' AS context")
    assert digests(df) == expected(turns)
    assert m.chat_digest(df.filter("1 = 0")).count() == 0
