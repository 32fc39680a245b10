"""Chat formatting: layouts found by schema fingerprint, one reversible template.

A record's layout is the set of its nested field paths; the hash of that set selects a
declarative mapping, which turns the record into canonical turns. Turns of one
conversation are put in order and written with a template that marks turns and escapes
its own control strings inside texts.

Definite results: null texts and null roles are empty; null orders come first; turns
that tie are ordered by place in their record, role and text; rows without conversation
id form one conversation with a null id; records of unknown layout, or that are no
JSON object, keep their row with a null layout and no turns; an empty table gives no
rows. A conversation is one text, so it has to fit into memory; texts are never cut.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import Columns, map_columns, named


@dataclass(frozen=True)
class Mapping:
    """How to read a layout.

    turns: (role, text path) in order, where role is a fixed word or "$path"; with
    `each`, paths start at each element of that array. paths must all be there, optional
    ones may be. order: path of a number that orders records of one conversation.
    """

    name: str
    paths: frozenset[str]
    turns: tuple[tuple[str, tuple[str, ...]], ...]
    each: str = ""
    order: str = ""
    optional: frozenset[str] = field(default_factory=frozenset)


# Role words of other layouts.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

MAPPINGS = (
    Mapping(
        "turn rows", frozenset({"conv_id", "turn", "role", "text"}),
        (("$role", ("text",)),), order="turn",
    ),
    Mapping(
        "messages", frozenset({"messages[].role", "messages[].content"}),
        (("$role", ("content",)),), each="messages",
        optional=frozenset({"id", "source", "messages[].name"}),
    ),
    Mapping(
        "from and value", frozenset({"conversations[].from", "conversations[].value"}),
        (("$from", ("value",)),), each="conversations", optional=frozenset({"id", "source"}),
    ),
    Mapping(
        "prompt and response", frozenset({"prompt", "response"}),
        (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))),
        optional=frozenset({"id", "system", "source"}),
    ),
    Mapping(
        "instruction", frozenset({"instruction", "output"}),
        (("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))),
        optional=frozenset({"id", "input", "system", "source"}),
    ),
    Mapping(
        "nested question", frozenset({"data.question", "data.answer"}),
        (("user", ("data.question",)), ("assistant", ("data.answer",))),
        optional=frozenset({"id", "data.id"}),
    ),
)


def field_paths(value: object, at: str = "") -> set[str]:
    """Paths of all leaves; elements of an array share the path `name[]`."""
    if isinstance(value, dict) and value:
        return set(
            chain.from_iterable(
                field_paths(v, f"{at}.{k}" if at else str(k)) for k, v in value.items()
            )
        )
    if isinstance(value, list):
        return set(chain.from_iterable(field_paths(v, f"{at}[]") for v in value)) or {f"{at}[]"}
    return {at} if at else set()


def fingerprint(paths: set[str] | frozenset[str]) -> str:
    """Hash of a set of field paths."""
    return hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=16).hexdigest()


def registry(mappings: tuple[Mapping, ...] = MAPPINGS) -> dict[str, Mapping]:
    """Every fingerprint a mapping stands for: its paths with any of the optional ones."""
    return {
        fingerprint(m.paths | set(more)): m
        for m in mappings
        for k in range(len(m.optional) + 1)
        for more in combinations(sorted(m.optional), k)
    }


def _get(value: object, path: str) -> object:
    for key in path.split("."):
        value = value.get(key) if isinstance(value, dict) else None
    return value


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value)


def canonical(record: object, known: dict[str, Mapping]) -> tuple[str | None, object, list]:
    """(layout, order, [(role, text), ...]) of a parsed record."""
    mapping = known.get(fingerprint(field_paths(record)))
    if mapping is None:
        return None, None, []
    parts = _get(record, mapping.each) if mapping.each else [record]
    turns = []
    for part in parts if isinstance(parts, list) else []:
        for role, paths in mapping.turns:
            got = [_get(part, p) for p in paths]
            if role.startswith("$"):
                role = _text(_get(part, role[1:]))
            elif all(g is None for g in got) and any(p in mapping.optional for p in paths):
                continue
            turns.append((ROLES.get(role, role), "\n".join(_text(g) for g in got if g is not None)))
    return mapping.name, _get(record, mapping.order) if mapping.order else None, turns


def canonical_turns(
    records: DataFrame, id_col: str = "conv_id", json_col: str = "record",
    mappings: tuple[Mapping, ...] = MAPPINGS,
) -> DataFrame:
    """Per record: conv_id, layout (null if unknown), ord, turns (array of role, text)."""
    known = registry(mappings)

    def read(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            found = []
            for text in batch["record"]:
                try:
                    found.append(canonical(json.loads(text or "null"), known))
                except ValueError:
                    found.append((None, None, []))
            yield {
                "conv_id": batch["conv_id"],
                "layout": [f[0] for f in found],
                "ord": [f[1] if isinstance(f[1], int) else None for f in found],
                "turns": [[{"role": r, "text": t} for r, t in f[2]] for f in found],
            }

    chosen = records.select(
        named(id_col).cast("long").alias("conv_id"), named(json_col).alias("record")
    )
    schema = "conv_id long, layout string, ord long, turns array<struct<role: string, text: string>>"
    return map_columns(chosen, read, schema)


# The template. A backslash before one of these strings makes it plain text.
OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
_CONTROL = re.compile(r"\\|###|</turn>|: ")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|: )")
_MARKS = re.compile(r"\\(?:\\|###|</turn>|: )|(?P<middle>: )|(?P<close></turn>\n)")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text, and the ranges of it under the loss mask (assistant texts)."""
    parts, mask, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role)}{MIDDLE}", escape(text)
        if role == "assistant":
            mask.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), mask


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    turns, at, middle = [], 0, None
    for mark in _MARKS.finditer(formatted):
        if mark["middle"] and middle is None:
            middle = mark.span()
        elif mark["close"] and middle is not None:
            role = formatted[at + len(OPEN) : middle[0]]
            turns.append((unescape(role), unescape(formatted[middle[1] : mark.start()])))
            at, middle = mark.end(), None
    return turns


def formatted_chats(turns: DataFrame) -> DataFrame:
    """Per conversation: conv_id, formatted, loss_mask; input as from canonical_turns."""
    flat = turns.select("conv_id", "ord", F.posexplode_outer("turns").alias("at", "turn"))
    whole = flat.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(F.struct("ord", "at", F.col("turn.role"), F.col("turn.text")))
        ).alias("turns")
    )

    def write(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            done = [
                render([(t["role"], t["text"]) for t in each if t["at"] is not None])
                for each in batch["turns"]
            ]
            yield {
                "conv_id": batch["conv_id"],
                "formatted": [d[0] for d in done],
                "loss_mask": [[{"start": a, "end": b} for a, b in d[1]] for d in done],
            }

    return map_columns(
        whole, write,
        "conv_id long, formatted string, loss_mask array<struct<start: int, end: int>>",
    )


def chat_digests(chats: DataFrame) -> DataFrame:
    """What a reader gets back from the formatted texts and their loss masks."""

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def read(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            turns = [parse(f) for f in batch["formatted"]]
            loss = [
                "".join(unescape(f[m["start"] : m["end"]]) for m in mask)
                for f, mask in zip(batch["formatted"], batch["loss_mask"], strict=True)
            ]
            yield {
                "conv_id": batch["conv_id"],
                "n_turns": [len(t) for t in turns],
                "turns_sha256": [sha("".join(f"{r}\n{x}\n" for r, x in t)) for t in turns],
                "loss_chars": [len(x) for x in loss],
                "loss_sha256": [sha(x) for x in loss],
                "formatted_chars": [len(f) for f in batch["formatted"]],
            }

    return map_columns(
        chats, read,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
        " formatted_chars long",
    )
