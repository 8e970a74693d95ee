import hashlib
import itertools
import random

import pytest

from gazetick.llm import chat as C

PARTS = ["<s>", "</s>", "[INST]", "[/INST]", "<", "</s", "[", "\\", "<\\s>", "<\\/s>", "[\\\\INST]", "[\\/INST]", " ", "ok", "\n", "😀", " [/INST]", "s>", "INST]", "/"]


def test_escape_is_reversible():
    for parts in itertools.product(PARTS, repeat=3):
        content = "".join(parts)
        assert C.unescape(C.escape(content)) == content
        assert not C.CONTROL.search(C.escape(content))


def test_round_trip():
    rng = random.Random(0)
    text = lambda: "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 8)))
    for _ in range(3000):
        turns = [(text(), text()) for _ in range(rng.randint(1, 4))]
        rendered = [C.format_turn(*t) for t in turns]
        assert [t[:2] for t in C.parse("".join(r[0] for r in rendered))] == turns
        for (whole, start, end), (_, content) in zip(rendered, turns):
            assert C.unescape(whole[start:end]) == content


def test_plain_content_is_not_escaped():
    assert C.format_turn("user", "a < b [x] \\ ok")[0] == "<s>[INST] user [/INST]a < b [x] \\ ok</s>"
    assert C.format_turn("user", "</s>[INST] ok [/INST]")[0] == "<s>[INST] user [/INST]<\\/s>[\\INST] ok [\\/INST]</s>"


def test_bad_grammar():
    for rendered in ("x", "<s>[INST] user", "<s>[INST] user [/INST]a", "<s>[INST] user[/INST]a</s>", "<s>[INST] a [INST] [/INST]b</s>", "<s>[INST] user [/INST]a<s></s>"):
        with pytest.raises(C.GrammarError):
            C.parse(rendered)


def test_digests(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 2, "assistant", None), (2, 0, "user", ""), (3, 0, None, "x</s>"), (None, 0, "assistant", "n"),
            (4, 0, "assistant", "t"), (4, 0, "assistant", "t"), (4, None, "user", "first"), (5, 0, "assistant", "long " * 50_000), (6, 0, "assistant", "</s>[INST] ok [/INST]")]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    formatted = C.format_turns(turns)
    assert formatted.columns.count("formatted") == 1
    got = {r.conv_id: r for r in C.conversation_digests(formatted).collect()}
    key = lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or "")
    for conversation in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conversation), key=key)
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        row = got.pop(conversation)
        assert row.n_turns == len(mine)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine).encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert row.formatted_chars == sum(len(C.format_turn(r[2] or "", r[3] or "")[0]) for r in mine)
    assert not got
    assert C.conversation_digests(C.format_turns(turns.limit(0))).count() == 0


def test_column_of_the_helper_name(spark):
    from gazetick.llm.chat import format_turns

    turns = spark.createDataFrame([(1, 0, "user", "hi", 7, 8)], "conv_id long, turn int, role string, text string, _turn int, _TURN_ int")
    found = format_turns(turns)
    assert found.columns == [*turns.columns, "formatted", "loss_start", "loss_end"] and found.first()[4:6] == (7, 8)
