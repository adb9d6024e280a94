"""Chat formatting: a reversible template, spans by incremental black-box rendering.

The span finder knows nothing of a template but ``render(turns) -> str``. It renders the first
0, 1, 2, ... turns and compares neighbouring outputs: where an output begins with the one before,
the new turn's span is what was added; where it doesn't, the template has rewritten history, and
the turn is reported instead of being given a wrong span. Inside a span the text is found by
rendering the turn with the texts "x" and "y": what both outputs share at either end is the frame.
That is done for every prefix of every conversation of at most ``WHOLE`` turns, whatever the template.
Rendering all prefixes takes time in the square of the turns, so of longer conversations the prefixes of
a template that declares that it renders from left to right (``Template``, the default one) are put
together from what each turn adds, and whole renderings of 1, 2, 4, ... and all turns are
compared with them; if one differs, the declaration is wrong and every prefix is rendered after all.

Defined results: null roles and texts are empty; turns are taken in the order (turn, role, text),
nulls first, so ties and repeated rows give one result; a conversation without rows has no
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscope.llm.common import tune

Turn = tuple[str, str]

START, END = "<|im_start|>", "<|im_end|>"
#: Conversations of so many turns have every prefix rendered whole.
WHOLE = 1000
_OPEN, _OPENED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    """No control string is left: ``<|`` gets a backslash inside, and so does each escaped one."""
    return _OPEN.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _OPENED.sub(r"<\1|", text)


def _role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unrole(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Template:
    """A template that is rendered from left to right: what a turn adds depends on a state alone.

    ``add(state, turn)`` gives the text that the turn adds and the next state. As a function it
    renders all turns, like any black box.
    """

    def __init__(self, add: Callable[[object, Turn], tuple[str, object]], opening: str = "", state: object = None) -> None:
        self.add, self.opening, self.state = add, opening, state

    def __call__(self, turns: Sequence[Turn]) -> str:
        out, state = [self.opening], self.state
        for turn in turns:
            more, state = self.add(state, turn)
            out.append(more)
        return "".join(out)


def _chatml_turn(state: object, turn: Turn) -> tuple[str, object]:
    return f"{START}{_role(turn[0])}\n{escape(turn[1])}{END}\n", state


#: The default template.
chatml = Template(_chatml_turn)


def parse(formatted: str) -> list[Turn]:
    """The turns of chatml()'s output."""
    found, at = [], 0
    while m := _TURN.match(formatted, at):
        found.append((_unrole(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"not a formatted conversation, from character {at}")
    return found


def spans(turns: Sequence[Turn], render: Callable[[Sequence[Turn]], str] = chatml) -> tuple[str, list[tuple[int, int, int, int]], list[int]]:
    """The whole output; for each turn (start, end, text start, text end); the turns that rewrote history.

    A turn that rewrote history has the span (-1, -1, -1, -1), as have those before it whose
    characters it changed. Every prefix is rendered, but for a Template and more than WHOLE turns,
    see _linear().
    """
    if isinstance(render, Template) and len(turns) > WHOLE:
        made = _linear(turns, render)
        if made is not None:
            return made
    found: list[tuple[int, int, int, int]] = []
    rewrote: list[int] = []
    before = render(turns[:0])
    for i, (role, _) in enumerate(turns):
        now = render(turns[: i + 1])
        if not now.startswith(before):
            same = _common(before, now)
            rewrote.append(i)
            found = [(-1,) * 4 if s[1] > same else s for s in found] + [(-1,) * 4]
        else:
            x, y = (render([*turns[:i], (role, probe)]) for probe in "xy")
            head = _common(x, y)
            found.append((len(before), len(now), head, len(now) - (len(x) - head - 1)))
        before = now
    return before, found, rewrote


def _linear(turns: Sequence[Turn], template: Template) -> tuple[str, list[tuple[int, int, int, int]], list[int]] | None:
    """As spans(), from what each turn adds; None if a rendering of 0, 1, 2, 4, ... or all turns isn't the sum of that."""
    out, state, at = [template.opening], template.state, len(template.opening)
    found = []
    for role, text in turns:
        (x, _), (y, _) = (template.add(state, (role, probe)) for probe in "xy")
        now, state = template.add(state, (role, text))
        head = _common(x, y)
        found.append((at, at + len(now), at + head, at + len(now) - (len(x) - head - 1)))
        out.append(now)
        at += len(now)
    whole = "".join(out)
    sizes = {0, len(turns), *(1 << i for i in range(len(turns).bit_length()))}
    if any(template(turns[:n]) != whole[: found[n - 1][1] if n else len(template.opening)] for n in sizes):
        return None
    return whole, found, []


def _common(a: str, b: str) -> int:
    """Characters that both begin with, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a.startswith(b[low:mid], low):
            low = mid
        else:
            high = mid - 1
    return low


def format_one(turns: Sequence[Turn], render: Callable[[Sequence[Turn]], str] = chatml, trained: str = "assistant") -> dict:
    """formatted, the loss mask as [start, end) pairs in code points, and the turns that rewrote history."""
    out, found, rewrote = spans(turns, render)
    return {"formatted": out, "loss_spans": [list(s[2:]) for s, (r, _) in zip(found, turns) if r == trained and s[0] >= 0], "rewrote": rewrote}


SCHEMA = T.StructType([T.StructField("formatted", T.StringType()), T.StructField("loss_spans", T.ArrayType(T.ArrayType(T.IntegerType()))), T.StructField("rewrote", T.ArrayType(T.IntegerType()))])


def format_conversations(df: DataFrame, render: Callable[[Sequence[Turn]], str] = chatml) -> DataFrame:
    """One row a conversation: conv_id, formatted, loss_spans, rewrote.

    The output of a conversation is one string, so its turns meet in one task; conversations are
    dealt by id and streamed one after another.
    """
    tune(df.sparkSession)
    turns = df.select("conv_id", F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    kind = whole.schema["conv_id"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [format_one([(x["role"], x["text"]) for x in t], render) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m["formatted"] for m in made], pa.string()), pa.array([m["loss_spans"] for m in made], pa.list_(pa.list_(pa.int32()))), pa.array([m["rewrote"] for m in made], pa.list_(pa.int32()))], names=["conv_id", *SCHEMA.names])

    return whole.mapInArrow(run, T.StructType([kind, *SCHEMA.fields]))


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from format_conversations(): counts and digests of turns and loss text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, mask in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = parse(text)
                all_turns = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                loss = "".join([unescape(text[a:b]) for a, b in mask])
                rows.append((len(turns), all_turns, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.string() if i in (1, 3) else pa.int64()) for i, c in enumerate(cols))], names=["conv_id", *DIGESTS.names])

    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(run, T.StructType([formatted.schema["conv_id"], *DIGESTS.fields]))


DIGESTS = T.StructType([T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])
