from collections import defaultdict
from hashlib import sha256

from corpusmill.llm import chat_format as cf

SF = "/root/testdata/sf0.001"
HARD = ["\\", "\\\\b", "\\b\\l\\q", "</turn>", "<turn role=\"a\">", "a</turn", "\\l/turn>", "", None, "\\### Assistant: </turn> ok", "x\n\n</turn></turn>", '">']


def digest(text):
    return sha256(text.encode()).hexdigest()


def expected(turns):
    text = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), digest(text), len(loss), digest(loss)


def check(rows, got):
    source = defaultdict(list)
    for conv, turn, role, text in rows:
        source[conv].append(((-1 if turn is None else turn), role or "", text or ""))
    assert set(got) == set(source)
    for conv, turns in source.items():
        r = got[conv]
        assert r["round_trip"]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == expected([t[1:] for t in sorted(turns)])


def test_conversations(spark, run_query):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "\\### Assistant: </turn> ok"
    check([*rows, (-7, 0, "user", said), (-7, 1, "assistant", said)], run_query("op5_chat_format", "conv_id"))


def test_hard_turns(spark):
    rows = [(i // 3, i % 3, role, text) for i, (role, text) in enumerate((r, t) for r in ["user", "assistant", None, 'a">\\q<'] for t in HARD)]
    rows += [(99, 1, "user", "same"), (99, 1, "user", "same"), (99, 1, "assistant", "tie"), (99, None, "user", "no number"), (None, 0, "user", "lost")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = cf.format_conversations(turns)
    check(rows, {r["conv_id"]: r for r in cf.conversation_digests(got).collect()})
    assert cf.format_conversations(turns.filter("false")).count() == 0


def test_plain_text_is_left_alone(spark):
    turns = spark.createDataFrame([(1, 0, "user", "1 < 2 \\n"), (1, 1, "assistant", "yes </turn> no")], "conv_id long, turn long, role string, text string")
    row = cf.format_conversations(turns).first()
    assert row["formatted"] == '<turn role="user">1 < 2 \\n</turn><turn role="assistant">yes \\l/turn> no</turn>'
