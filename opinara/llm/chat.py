"""Conversations rendered by a chat template that is known only by what it renders.

A template is any function from a list of (role, text) to a string. The turns of a conversation are
rendered one by one: each output must begin with the one before, and what is new is the span of the last
turn. A template that alters what it rendered before is found out by that and marked, with the first turn
whose rendering rewrote history; its spans are void. Where the turn's text lies in its span is found by
rendering the same turn with a probe in place of the text. The spans of the assistant's texts are the loss
mask.

`TEMPLATE` marks turns with fixed control strings and escapes these inside of roles and texts, so that a
rendered conversation can be read back, whatever the texts hold.

A conversation is handled as one row; the prefixes make its cost grow with the square of its length, which
is the price of not looking into the template. Conversations spread over tasks by their id, and a task
holds one at a time.

Defined results: rows are turns, in the order of turn, then role and text; a missing text or role is empty;
rows that repeat are turns of their own; rows without an id form one conversation without id; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Render = Callable[[Sequence[Turn]], str]
PROBE = "\ue000"  # a private character, repeated where a text holds it

# The control strings of the template.
CONTROL = (
    "<s>",
    "</s>",
    "[INST]",
    "[/INST]",
    "<<SYS>>",
    "<</SYS>>",
    "[ROLE]",
    "[/ROLE]",
    "[/TURN]",
)
_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROL))
_ESCAPED = re.compile(r"\\(.)", re.S)
# what a turn of each role stands between; any other role is written out
MARKS = {
    "user": ("<s>[INST] ", " [/INST]"),
    "assistant": (" ", " </s>"),
    "system": ("<<SYS>>\n", "\n<</SYS>>\n"),
}


def escape(text: str) -> str:
    """Double the backslashes, then break every control string by one after its first character."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def marks(role: str) -> tuple[str, str]:
    return MARKS.get(role) or (f"[ROLE]{escape(role)}[/ROLE]", "[/TURN]")


def TEMPLATE(turns: Sequence[Turn]) -> str:  # noqa: N802
    return "".join(f"{marks(role)[0]}{escape(text)}{marks(role)[1]}" for role, text in turns)


def read_back(rendered: str) -> list[Turn]:
    """The turns of a conversation rendered by TEMPLATE."""
    turns, at = [], 0
    while at < len(rendered):
        for role, (head, foot) in MARKS.items():
            if rendered.startswith(head, at):
                break
        else:
            end = rendered.index("[/ROLE]", at)
            role, head, foot = unescape(rendered[at + len("[ROLE]") : end]), rendered[at:end] + "[/ROLE]", "[/TURN]"
        # no control string stands in an escaped text, so the next one ends it
        end = rendered.index(foot.strip(), at + len(head)) - foot.index(foot.strip())
        turns.append((role, unescape(rendered[at + len(head) : end])))
        at = end + len(foot)
    return turns


@dataclass
class Formatted:
    text: str
    spans: list[tuple[int, int]]  # of each turn, with its marks
    texts: list[tuple[int, int]]  # of each turn's text as it was rendered
    rewritten_at: int | None  # the first turn whose rendering changed what stood before


def format_turns(turns: Sequence[Turn], render: Render = TEMPLATE) -> Formatted:
    before, spans, texts = render([]), [], []
    for k in range(1, len(turns) + 1):
        now = render(turns[:k])
        if not now.startswith(before):
            return Formatted(render(turns), [], [], k - 1)
        spans.append((len(before), len(now)))
        texts.append(text_span(turns[:k], before, now, render))
        before = now
    return Formatted(before, spans, texts, None)


def text_span(turns: Sequence[Turn], before: str, now: str, render: Render) -> tuple[int, int]:
    """Where the last turn's text lies: what replaces the probe. Empty at the span's end if the template
    leaves the text out."""
    role, text = turns[-1]
    probe = PROBE
    while probe in text or probe in role:
        probe += PROBE
    tried = render([*turns[:-1], (role, probe)])
    at = tried.find(probe, len(before) if tried.startswith(before) else 0)
    if at < 0:
        return len(now), len(now)
    foot = len(tried) - at - len(probe)
    return at, max(at, len(now) - foot)


def conversations_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[Turn]]]:
    """Conversations of rows (conv_id, role, text) that come sorted."""
    conv, turns, begun = None, [], False
    for batch in batches:
        for c, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if begun and c != conv:
                yield conv, turns
                turns = []
            conv, begun = c, True
            turns.append((role, text))
    if begun:
        yield conv, turns


SCHEMA = (
    "conv_id long, text string, turn_starts array<long>, turn_ends array<long>, text_starts array<long>, "
    "text_ends array<long>, roles array<string>, rewritten_at long"
)


def sorted_turns(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text")


def format_conversations(conversations: DataFrame, render: Render = TEMPLATE) -> DataFrame:
    """Per conversation the rendered text, the turns' spans, their texts' spans and roles, and the first
    turn that rewrote history, null as it should be. Offsets are in code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, turns in conversations_in(batches):
            f = format_turns(turns, render)
            longs, strings = pa.list_(pa.int64()), pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([conv], pa.int64()),
                    pa.array([f.text], pa.string()),
                    *(pa.array([[s[i] for s in spans]], longs) for spans in (f.spans, f.texts) for i in (0, 1)),
                    pa.array([[r for r, _ in turns]], strings),
                    pa.array([f.rewritten_at], pa.int64()),
                ],
                names=[c.split()[0] for c in SCHEMA.split(", ")],
            )

    return sorted_turns(conversations).mapInArrow(run, SCHEMA)


def digests(formatted: DataFrame) -> DataFrame:
    """What the rendered text holds, read back from it: the turns, and the text under the loss mask."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                turns = read_back(r["text"])
                spans = zip(r["roles"], r["text_starts"], r["text_ends"], strict=True)
                loss = "".join(unescape(r["text"][a:b]) for role, a, b in spans if role == "assistant")
                rows.append(
                    {
                        "conv_id": r["conv_id"],
                        "n_turns": len(turns),
                        "turns_sha256": sha256("".join(f"{a}\n{t}\n" for a, t in turns)),
                        "loss_chars": len(loss),
                        "loss_sha256": sha256(loss),
                        "formatted_chars": len(r["text"]),
                    }
                )
            kinds = {"turns_sha256": pa.string(), "loss_sha256": pa.string()}
            names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
            yield pa.RecordBatch.from_pydict(
                {n: pa.array([r[n] for r in rows], kinds.get(n, pa.int64())) for n in names}
            )

    return formatted.where("rewritten_at is null").mapInArrow(
        read,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long",
    )


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
