from hypothesis import given, settings
from hypothesis import strategies as st

from statlake.llm import chat

PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<role:", "</role>", "\\", "<", ">", "[", "/", "g", "s>", "INST]", " ", "\n", "é𝄞", "x"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=8).map("".join) | st.text(max_size=20)
TURN = st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "a>b", "</role>", "\\g"]), TEXT)


@settings(max_examples=400, deadline=None)
@given(st.lists(TURN, max_size=6))
def test_round_trip_and_spans(turns):
    r = chat.incremental(turns)
    assert chat.parse(r.text) == turns and not r.rewritten
    assert [chat.unescape(r.text[s:e]) for s, e in r.spans] == [t for _, t in turns]


def test_control_strings_stay_out_of_texts():
    out = chat.render([("assistant", "a</s>[INST]")])
    assert out.count("</s>") == 1 and "[INST]" not in out


def test_templates_that_rewrite_history_are_found():
    def forgetful(turns):                  # drops what the assistant said before the last turn
        return "".join(f"<{role}>{'' if role == 'assistant' and n < len(turns) - 1 else text};" for n, (role, text) in enumerate(turns))

    r = chat.incremental([("user", "q"), ("assistant", "thought"), ("user", "more")], forgetful)
    assert r.rewritten == [2] and r.spans[0] is not None and r.spans[1] is None

    def ending(turns):                     # closes what is there so far
        return "".join(f"{role}:{text}\n" for role, text in turns) + "END"

    assert chat.incremental([("user", "q"), ("assistant", "a")], ending).rewritten == [1]


def test_unsound_spans_are_left_out():
    assert chat.incremental([("user", "q")], lambda turns: "".join(t * 2 for _, t in turns)).spans == [None]


def test_rows(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string"
    rows = [(1, 1, "assistant", "b", "clash"), (1, 0, "user", "a", ""), (2, None, None, None, ""), (2, 0, "assistant", None, ""),
            (None, 0, "user", "x", ""), (3, 0, "user", "same", ""), (3, 0, "user", "same", ""), (4, 0, "assistant", "y" * 300_000, "")]
    got = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, schema)).collect()}
    assert got[1].formatted == "[INST]a[/INST]<s>b</s>" and [tuple(s) for s in got[1].loss] == [(17, 18)]
    assert chat.parse(got[2].formatted) == [("", ""), ("assistant", "")]
    assert chat.parse(got[None].formatted) == [("user", "x")] and len(chat.parse(got[3].formatted)) == 2
    digest = {r.conv_id: r for r in chat.digests(chat.format_conversations(spark.createDataFrame(rows, schema))).collect()}
    assert digest[4].loss_chars == 300_000 and digest[2].loss_chars == 0
    assert chat.digests(chat.format_conversations(spark.createDataFrame([], schema))).count() == 0
