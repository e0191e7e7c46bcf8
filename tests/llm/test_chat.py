from hypothesis import given, settings
from hypothesis import strategies as st

from opinara.llm import chat

PARTS = st.sampled_from([*chat.CONTROL, "\\", "\\\\", " ", "\n", "x", "<", "[", "]", ">", "", "é"])
TEXT = st.lists(PARTS, max_size=8).map("".join)
ROLE = st.one_of(st.sampled_from(["user", "assistant", "system", ""]), TEXT)


@given(st.lists(st.tuples(ROLE, TEXT), max_size=6))
@settings(max_examples=300, deadline=None)
def test_round_trip(turns):
    f = chat.format_turns(turns)
    assert f.rewritten_at is None
    assert chat.read_back(f.text) == turns
    assert [chat.unescape(f.text[a:b]) for a, b in f.texts] == [t for _, t in turns]
    assert "".join(f.text[a:b] for a, b in f.spans) == f.text


def test_rewriting_template_is_found():
    def last_only(turns):
        """Marks the last turn alone, so that a new turn changes the one before."""
        return "".join(f"{r}: {t}{' *' if i + 1 == len(turns) else ''}\n" for i, (r, t) in enumerate(turns))

    turns = [("user", "a"), ("assistant", "b"), ("user", "c")]
    f = chat.format_turns(turns, last_only)
    assert (f.rewritten_at, f.spans, f.texts) == (1, [], [])
    assert f.text == last_only(turns)
    assert chat.format_turns(turns[:1], last_only).rewritten_at is None


def test_template_that_leaves_a_text_out():
    f = chat.format_turns([("system", "s"), ("user", "u")], lambda ts: "".join(t for r, t in ts if r != "system"))
    assert f.text == "u" and f.texts == [(0, 0), (0, 1)]


def test_conversations(spark):
    rows = [
        (1, 1, "assistant", "b", "x"),
        (1, 0, "user", "a", "x"),
        (1, 1, "assistant", "b", "x"),
        (2, 0, None, None, None),
        (None, None, "user", "x" * 50_000, "y"),
        (None, 3, "assistant", "</s>", "y"),
        (3, 0, "assistant", "", "z"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, roles string")
    found = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(frame)).collect()}
    assert set(found) == {1, 2, 3, None}
    assert found[1]["n_turns"] == 3 and found[1]["loss_sha256"] == chat.sha256("bb")
    assert found[2]["turns_sha256"] == chat.sha256("\n\n") and found[2]["loss_chars"] == 0
    assert found[None]["turns_sha256"] == chat.sha256("user\n" + "x" * 50_000 + "\nassistant\n</s>\n")
    assert found[3]["loss_chars"] == 0
    assert chat.format_conversations(frame.limit(0)).count() == 0
    formatted = chat.format_conversations(frame.where("conv_id = 1")).first()
    assert formatted["roles"] == ["user", "assistant", "assistant"]
