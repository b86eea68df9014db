"""Chat formatting with a loss mask, found by incremental black-box rendering.

The template is any function from a list of turns to a string. The prefixes of one, two,
three ... turns are rendered; where an output begins with the one before, the rest is the
new turn. Where it does not, the template has rewritten history, which is reported. Inside
a turn its text is found by rendering the turn twice more with two one-letter texts: what
both outputs share in front and behind is the template's.

The default template marks each turn and breaks up its own control strings inside texts,
reversibly, so that no text can end its turn or open another.

Defined results: null texts and roles are empty; rows of a conversation are ordered by
turn (null first), then role and text, repeated rows are turns; conversations without
rows do not exist, an empty table gives an empty result; extra columns are ignored. A
conversation is one row of the output and is rendered in one task; the cost is
quadratic in its number of turns, as successive prefixes are rendered.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

_MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
_OTHER = ("<role:", "</role>")
_CONTROL = re.compile("|".join(re.escape(x) for x in sorted([m for pair in _MARKS.values() for m in pair] + list(_OTHER), key=len, reverse=True)))
_OPEN = re.compile("|".join(re.escape(x) for x in [m[0] for m in _MARKS.values()] + [_OTHER[0]]))


def escape(text: str) -> str:
    r"""Backslashes are doubled; a single one goes after the first character of a control string."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def render(turns: list[Turn]) -> str:
    """The default template."""
    out = []
    for role, text in turns:
        if role in _MARKS:
            before, after = _MARKS[role]
        else:
            before, after = f"{_OTHER[0]}{escape(role).replace('>', chr(92) + 'g')}>", _OTHER[1]
        out.append(before + escape(text) + after)
    return "".join(out)


def parse(formatted: str) -> list[Turn]:
    """Turns read back from the default template's output."""
    turns, at = [], 0
    while at < len(formatted):
        mark = _OPEN.match(formatted, at)
        if not mark:
            raise ValueError(f"no turn at {at}")
        at, role = mark.end(), next((r for r, m in _MARKS.items() if m[0] == mark[0]), None)
        close = _OTHER[1] if role is None else _MARKS[role][1]
        if role is None:
            end = formatted.index(">", at)
            role = re.sub(r"\\(\\|g|)", lambda m: {"\\": "\\", "g": ">", "": ""}[m[1]], formatted[at:end])
            at = end + 1
        end = formatted.index(close, at)
        turns.append((role, unescape(formatted[at:end])))
        at = end + len(close)
    return turns


@dataclass(frozen=True)
class Rendered:
    text: str
    #: (start, end) of each turn's own text; None where it could not be told.
    spans: list[tuple[int, int] | None]
    #: numbers of turns whose rendering changed what was there before
    rewritten: list[int]


def _shared(a: str, b: str) -> int:
    """Length of the common beginning."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def incremental(turns: list[Turn], template: Template = render) -> Rendered:
    """Render ``turns`` and locate the text of each."""
    before, spans, rewritten = "", [], []
    for n, (role, _) in enumerate(turns):
        now = template(turns[:n + 1])
        if not now.startswith(before):
            rewritten.append(n)
            kept = _shared(before, now)
            spans = [s if s and s[1] <= kept else None for s in spans] + [None]
        else:
            one, two = (template(turns[:n] + [(role, probe)]) for probe in ("x", "y"))
            front, back = _shared(one, two), _shared(one[::-1], two[::-1])
            sound = len(one) == len(two) == front + 1 + back and front >= len(before) and len(now) >= front + back
            spans.append((front, len(now) - back) if sound else None)
        before = now
    return Rendered(before, spans, rewritten)


def loss_spans(turns: list[Turn], rendered: Rendered, roles: tuple[str, ...] = ("assistant",)) -> list[tuple[int, int]]:
    return [s for (role, _), s in zip(turns, rendered.spans) if role in roles and s is not None]


SCHEMA = "conv_id long, formatted string, loss array<struct<start:int,end:int>>, rewritten array<int>"


def format_conversations(rows: DataFrame, template: Template = render, roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``conv_id, formatted, loss, rewritten``, a row each conversation."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for conv_id, turns in zip(frame["conv_id"], frame["turns"]):
                turns = [(t["role"], t["text"]) for t in turns]
                r = incremental(turns, template)
                out.append((None if pd.isna(conv_id) else int(conv_id), r.text, [{"start": s, "end": e} for s, e in loss_spans(turns, r, roles)], r.rewritten))
            yield pd.DataFrame(out, columns=["conv_id", "formatted", "loss", "rewritten"]).astype({"conv_id": "Int64"})

    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
            .mapInPandas(run, SCHEMA))


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from the default template's output."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for conv_id, text, loss in zip(frame["conv_id"], frame["formatted"], frame["loss"]):
                turns = parse(text)
                masked = "".join(unescape(text[s["start"]:s["end"]]) for s in loss)
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                out.append((None if pd.isna(conv_id) else int(conv_id), len(turns), hashlib.sha256(whole.encode("utf-8", "surrogatepass")).hexdigest(), len(masked),
                            hashlib.sha256(masked.encode("utf-8", "surrogatepass")).hexdigest(), len(text)))
            yield pd.DataFrame(out, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]).astype({"conv_id": "Int64"})

    return formatted.mapInPandas(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
