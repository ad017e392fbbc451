"""Chat formatting: spans, masks, reversibility and templates that rewrite history."""

import random

from vigil.llm.chat import CONTROLS, escape, format_conversations, instruct, locate, op2_chat, read_back, unescape

PIECES = ["<", "s>", "/", "[", "]", "INST", "SYS", "ROLE", "AS", "\\", " ", "a", "</s>", "[/INST]", " [/INST]", "[AS]", "<s>", "\\\\", "\n", "é"]


def test_random_conversations():
    rnd = random.Random(3)
    for _ in range(3000):
        turns = [(rnd.choice(["user", "assistant", "system", "tool", "", "[AS]", " "]), "".join(rnd.choices(PIECES, k=rnd.randint(0, 8))))
                 for _ in range(rnd.randint(0, 5))]
        out, spans = locate(turns, instruct)
        assert read_back(out) == turns
        assert [unescape(out[c:d]) for _, _, c, d in spans] == [t for _, t in turns]
        assert [s[0] for s in spans] == [0, *(s[1] for s in spans[:-1])][:len(spans)]
        assert not any(c in escape(t) for _, t in turns for c in CONTROLS)


def test_rewriting_templates_are_found():
    def last_only(turns):                           # drops what was said before
        return turns[-1][1] if turns else ""

    def strips_old_thoughts(turns):
        return "".join(f"|{r}:{t if i == len(turns) - 1 else t.split('</think>')[-1]}" for i, (r, t) in enumerate(turns))

    assert locate([("user", "x"), ("user", "y")], last_only)[1] is None
    thought = [("user", "q"), ("assistant", "<think>hm</think>a"), ("user", "r")]
    assert locate(thought, strips_old_thoughts) == (strips_old_thoughts(thought), None)
    assert locate(thought[:2], strips_old_thoughts)[1] is not None


def test_a_text_that_is_not_shown_has_no_spans():
    assert locate([("user", "x")], lambda turns: "#" * len(turns))[1] is None


def test_odd_rows(spark):
    rows = [(1, 1, "assistant", None, 0), (1, 0, None, "hi", 0), (1, None, "user", "first", 0), (None, 0, "user", "x" * 100_000, 0),
            (2, 5, "assistant", "twice", 0), (2, 5, "assistant", "twice", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, spans int")
    got = {r.conv_id: r for r in format_conversations(df).collect()}
    assert read_back(got[1].formatted) == [("user", "first"), ("", "hi"), ("assistant", "")]
    assert got[1].loss_spans[0].start == got[1].loss_spans[0].end
    assert read_back(got[2].formatted) == [("assistant", "twice")] * 2 and len(got[2].loss_spans) == 2
    assert len(got[None].formatted) > 100_000 and not got[None].rewrites_history
    assert format_conversations(df.limit(0)).count() == 0


def test_fixed_conversation(spark):
    row = [r for r in op2_chat(spark, "/root/testdata/sf0.001").collect() if r.conv_id == -7][0]
    text = "</s>[INST] ok [/INST]"
    import hashlib
    assert (row.n_turns, row.loss_chars) == (2, len(text))
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
