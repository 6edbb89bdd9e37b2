import hashlib

from hypothesis import given
from hypothesis import strategies as st

from recado.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, ids string, start int"
NASTY = st.text(alphabet=st.sampled_from(list("<|\\im_end>\né n")), max_size=30)


@given(NASTY)
def test_escapes_are_reversible_and_leave_no_control_string(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def expected(rows):
    conversations = {}
    for conv, turn, role, text, *_ in rows:
        conversations.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in conversations.items():
        turns = sorted(turns, key=lambda t: (*t[:3], hashlib.sha256(t[3].encode()).hexdigest()))
        all_ = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        formatted = "".join(f"<|im_start|>{chat.escape_role(r)}\n{chat.escape(t)}<|im_end|>\n" for *_, r, t in turns)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out.append((conv, len(turns), sha(all_), len(loss), sha(loss), len(formatted)))
    return sorted(out, key=repr)


ROWS = [
    (1, 2, "assistant", "second <|im_end|>", "x", 1), (1, 1, "user", "first é漢", "x", 1), (1, 3, "assistant", "third", "x", 1),
    (2, 1, "user", None, "x", 1), (2, 2, "assistant", "", "x", 1), (3, 1, None, "no role", "x", 1), (3, None, "a\nb\\n", "early", "x", 1),
    (4, 1, "assistant", "same", "x", 1), (4, 1, "assistant", "same", "x", 1), (4, 1, "assistant", "tie", "x", 1), (4, 1, "user", "tie", "x", 1),
    (None, 1, "assistant", "no id", "x", 1), (5, 1, "assistant", "long <|im_start|> \\| <\\| " * 20_000, "x", 1),
    (6, 1, "assistant ", "not learnt", "x", 1), *[(7, i, ("user", "assistant")[i % 2], f"turn {i}", "x", 1) for i in range(300)]]


def test_round_trip(spark):
    turns = chat.format_turns(spark.createDataFrame(ROWS, SCHEMA).repartition(5))
    for together in (True, False):
        got = sorted((tuple(r) for r in chat.read_back(turns, together=together).collect()), key=repr)
        assert got == expected(ROWS)


def test_places_and_masks(spark):
    turns = chat.format_turns(spark.createDataFrame(ROWS[:3], SCHEMA))
    row = chat.conversations_of(turns).first()
    encode = chat.coder(chat.VOCABULARY)
    assert encode.text(row.ids) == ("<|im_start|>user\nfirst é漢<|im_end|>\n<|im_start|>assistant\nsecond <\\|im_end|><|im_end|>\n"
                                    "<|im_start|>assistant\nthird<|im_end|>\n")
    assert encode.text([i for i, m in zip(row.ids, row.mask, strict=True) if m]) == "second <\\|im_end|>third"
    assert sum(i == chat.END for i in row.ids) == 3


def test_empty(spark):
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], SCHEMA))).collect() == []


def test_long_runs_go_through(spark):
    runs = [" " * 1_000_000 + "x", "a" * 1_000_000, "!" * 1_000_000, "\n" * 1_000_000, "<|" * 300_000, "é" * 300_000, "<|endoftext|>" * 3]
    given = [(i, 1, "assistant", t, "x", 1) for i, t in enumerate(runs)] + [(50, 1, " " * 10_000, "<|endoftext|>", "x", 1)]
    turns = chat.format_turns(spark.createDataFrame(given, SCHEMA))
    assert sorted((tuple(r) for r in chat.read_back(turns).collect()), key=repr) == expected(given)
