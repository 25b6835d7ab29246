"""Chat formatting."""

import hashlib
import random

from roadpulse.llm import chat, queries
from tests.compare import connect, difference

TRICKY = ["", "</s>", "[INST] a [/INST]", r"[\INST]", r"<\\s>", "[SEP]", "<<s>>", "a\n\nb", "<s", "s>", "[", None,
          r"\[SEP]\\[\\SEP]", "é🙂[/INST]é", "<\\<s>", "INST]"]


def test_equals_sql(spark, sf_dir):
    name = "op9_chat_format"
    assert difference(spark, connect(sf_dir), sf_dir, queries.QUERIES[name], queries.ORACLES[name]) is None


def test_everything_comes_back(spark):
    rnd = random.Random(5)
    rows = [(c, t, rnd.choice(["user", "assistant", "assistant", "system", None, "ro[INST]le</s>"]),
             "".join(x or "" for x in rnd.choices(TRICKY, k=3)) if rnd.random() < .9 else None)
            for c in range(40) for t in range(rnd.randrange(1, 9))]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, turns int")
    made = chat.format_conversations(df)
    got = {r.conv_id: r for r in chat.digest(made).collect()}
    plain = {r.conv_id: r for r in made.collect()}
    for c in range(40):
        own = [(r or "", t or "") for _, _, r, t in sorted((x for x in rows if x[0] == c), key=lambda x: x[1])]
        assert got[c].n_turns == len(own)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        loss = "".join(t for r, t in own if r == "assistant")
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].formatted_chars == len(plain[c].formatted)
        runs = 1 + sum(a[0] != b[0] for a, b in zip(own, own[1:]))
        assert plain[c].formatted.count("</s>") == runs == plain[c].formatted.count("<s>")


def test_defined_cases(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(None, 1, "user", "a"), (1, 2, "user", "late"), (1, None, "user", "early"), (1, 2, "user", "late"),
            (2, 0, None, None)]
    got = {r.conv_id: r.formatted for r in chat.format_conversations(spark.createDataFrame(rows, schema)).collect()}
    assert got == {None: "<s>user[INST]a</s>", 1: "<s>user[INST]early[SEP]late[SEP]late</s>", 2: "<s>[INST]</s>"}
    assert chat.digest(chat.format_conversations(spark.createDataFrame([], schema))).collect() == []


def test_no_python(spark, sf_dir):
    text = queries.op9_chat_format(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
