import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helixframe.llm import chat

LOG = "conv_id long, seq long, kind string, message_id long, role string, text string, at int, turns string"


def read(events):
    return chat.read_back(chat.render(chat.fold_events(events)))


def test_folding(spark):
    log = [
        (1, 0, "message", 7, "user", "hel"), (1, 1, "delta", 7, None, "lo"), (1, 2, "delta", 8, "assistant", "wr"), (1, 3, "delta", 8, "assistant", "ong"),
        (1, 4, "regenerate", 8, None, None), (1, 5, "delta", 8, None, "rig"), (1, 6, "delta", 8, None, "ht"), (1, 7, "edit", 7, "user", "bye"),
        (1, 8, None, None, "assistant", "x"), (1, 9, "message", None, None, None), (2, 0, "message", None, "assistant", "y"), (2, 0, "message", None, "assistant", "y"),
        (None, 0, "message", None, "user", "z"),
    ]
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in read(spark.createDataFrame([(*x, 1, "t") for x in log], LOG)).collect()}
    assert got == {1: [("user", "bye"), ("assistant", "right"), ("assistant", "x"), ("", "")], 2: [("assistant", "y")] * 2, None: [("user", "z")]}
    assert read(spark.createDataFrame([], LOG)).count() == 0


PIECES = st.lists(st.sampled_from(["<|im_end|>", "<|im_start|>", "<", "|", "\\", "\n", "a", "é", "🙂", "%", "%0A", "", "user\n"]), max_size=9).map("".join)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant"]) | PIECES, PIECES), min_size=1, max_size=5), min_size=1, max_size=25))
def test_any_text_can_be_read_back(spark, conversations):
    rows = [(c, k, r, t) for c, turns in enumerate(conversations) for k, (r, t) in enumerate(turns)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = read(chat.conversation_events(table))
    got = {r.conv_id: r for r in back.collect()}
    sums = {r.conv_id: r for r in chat.digests(back).collect()}
    for c, turns in enumerate(conversations):
        assert [tuple(t) for t in got[c].turns] == turns
        assert got[c].loss_text == "".join(t for r, t in turns if r == "assistant")
        assert got[c].formatted.count(chat.START) == got[c].formatted.count(chat.END) == len(turns) == sums[c].n_turns
        assert sums[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_spans_are_of_the_output(spark):
    r = chat.render(chat.fold_events(spark.createDataFrame([(1, 0, "message", None, "user", "🙂"), (1, 1, "message", None, "assistant", "a<|b")], LOG.split(", at")[0]))).first()
    assert [r.formatted[s.start : s.end] for s in r.loss_spans] == ["a<\\|b"]
    assert chat.unescaped(F.lit("x")) is not None
