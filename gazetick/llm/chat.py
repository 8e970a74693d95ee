r"""Chat formatting that proves itself by a grammar round trip.

    conversation := turn*
    turn         := "<s>[INST] " role " [/INST]" text "</s>"

The control strings are ``<s>``, ``</s>``, ``[INST]`` and ``[/INST]``. A deterministic parser reads a
rendered turn back; a control string where the grammar has none is an error. A turn is rendered as it
is first. If the parser fails or finds another role or text, the content is escaped (one backslash
more after the bracket of everything that is, or reads like, a control string; parsing takes one
away) and rendered anew, until what is read back is identical.

Turns are rendered row by row, so a conversation of any length needs no task of its own; its text is
its turns' texts in order. Only the digests, which are sequential by nature, stream a conversation
through one task, and keep no more than their hash states.

Null roles and texts count as empty, a null conversation id is a conversation of its own, null turns
come first, and ties of a turn are ordered by role, then text. Repeated rows are turns of their own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetick.llm.common import fresh

HEAD, MIDDLE, END = "<s>[INST] ", " [/INST]", "</s>"
CONTROL = re.compile(r"</?s>|\[/?INST\]")
ESCAPABLE = re.compile(r"(?:<\\*)(?=/?s>)|(?:\[\\*)(?=/?INST\])")
ESCAPED = re.compile(r"(?:<\\+)(?=/?s>)|(?:\[\\+)(?=/?INST\])")
LEARNED_ROLES = ("assistant",)
TURN = "struct<formatted: string, loss_start: int, loss_end: int>"


class GrammarError(ValueError):
    pass


def escape(content: str) -> str:
    return ESCAPABLE.sub(lambda m: m[0] + "\\", content)


def unescape(content: str) -> str:
    return ESCAPED.sub(lambda m: m[0][:-1], content)


def render(role: str, text: str) -> str:
    return f"{HEAD}{role}{MIDDLE}{text}{END}"


def _field(rendered: str, at: int, closing: str) -> tuple[str, int]:
    """Content from ``at`` to ``closing``, whose control string must be the next one, and the place behind."""
    found = CONTROL.search(rendered, at)
    if not found or not rendered.startswith(closing, begin := found.end() - len(closing)) or begin < at:
        raise GrammarError(f"no {closing!r} after {at}")
    return unescape(rendered[at:begin]), found.end()


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """``role, text, start, end`` of every turn; start and end bound the text as it was rendered."""
    turns, at = [], 0
    while at < len(rendered):
        if not rendered.startswith(HEAD, at):
            raise GrammarError(f"no {HEAD!r} at {at}")
        role, start = _field(rendered, at + len(HEAD), MIDDLE)
        text, at = _field(rendered, start, END)
        turns.append((role, text, start, at - len(END)))
    return turns


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The rendered turn that reads back as given, and the bounds of its text."""
    as_role, as_text = role, text
    for _ in range(2):
        rendered = render(as_role, as_text)
        try:
            turns = parse(rendered)
        except GrammarError:
            turns = []
        if len(turns) == 1 and turns[0][:2] == (role, text):
            return rendered, turns[0][2], turns[0][3]
        as_role, as_text = escape(as_role), escape(as_text)
    raise GrammarError(f"a turn of role {role!r} doesn't read back")


def format_turns(turns: DataFrame, role: str = "role", text: str = "text", learned: tuple[str, ...] = LEARNED_ROLES) -> DataFrame:
    """``turns`` with ``formatted, loss_start, loss_end``: the rendered turn and, in code points, the
    part of it under the loss mask (null for roles that are not learned). Columns of these names are replaced."""

    @F.arrow_udf(TURN.replace(": ", ":"))
    def formatted_turn(roles: pa.Array, texts: pa.Array) -> pa.Array:
        rows = []
        for one_role, one_text in zip(roles.to_pylist(), texts.to_pylist(), strict=True):
            rendered, start, end = format_turn(one_role or "", one_text or "")
            rows.append((rendered, start, end) if one_role in learned else (rendered, None, None))
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.int32(), pa.int32()))]
        return pa.StructArray.from_arrays(columns, names=["formatted", "loss_start", "loss_end"])

    names = ["formatted", "loss_start", "loss_end"]
    plain = turns.drop(*names)
    made = fresh(plain, "_turn")
    return plain.withColumn(made, formatted_turn(F.col(role), F.col(text))).withColumns({n: F.col(made)[n] for n in names}).drop(made)


class _Digest:
    """What is read back of one conversation so far."""

    def __init__(self):
        self.turns, self.characters, self.loss_characters = 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, rendered: str, start: int | None, end: int | None) -> None:
        for role, text, _, _ in parse(rendered):
            self.all.update(f"{role}\n{text}\n".encode())
            self.turns += 1
        self.characters += len(rendered)
        if start is not None:
            text = unescape(rendered[start:end])
            self.loss.update(text.encode())
            self.loss_characters += len(text)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def shown(rows):
        columns = zip(*[(c, d.turns, d.all.hexdigest(), d.loss_characters, d.loss.hexdigest(), d.characters) for c, d in rows], strict=True)
        return pa.record_batch([pa.array(list(x), kind) for x, kind in zip(columns, kinds, strict=True)], names=names)

    at, state = None, None
    for batch in batches:
        done = []
        for conversation, rendered, start, end in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if state is None or conversation != at:
                if state is not None:
                    done.append((at, state))
                at, state = conversation, _Digest()
            state.add(rendered, start, end)
        if done:
            yield shown(done)
    if state is not None:
        yield shown([(at, state)])


def conversation_digests(formatted: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per conversation counts and digests of what its formatted turns read back as."""
    ordered = formatted.repartition(conversation).sortWithinPartitions(conversation, turn, role, text)
    wanted = ordered.select(F.col(conversation).cast("bigint").alias("conv_id"), "formatted", "loss_start", "loss_end")
    return wanted.mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
