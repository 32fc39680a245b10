"""Secret scans: plain patterns, and assignments read by a small lexer.

The lexer finds name-literal pairs of source and configuration text (`name = "x"`,
`name: x`, `"name": "x"`, `NAME=x`, `name := 'a' + 'b'`), follows names that stand on
the right of a later assignment back to their literals, and scores each literal by the
most sensitive name that it reaches. Texts joined by + are scored as one. A call's
quoted arguments count as what it gives (of a lookup by name, all but the first); so do
triple-quoted texts, a value on the next line in parentheses, and an element's text
(`<pwd>x</pwd>`). A name or a path of names without quotes is a reference, not a literal,
unless letters and digits alternate in it as in no name, and it is not called or
subscripted.

The plain patterns take references too, and their spans are reported as they are;
`masked` leaves those alone, so that code stays code.

Definite results: a null text is the empty text and has no spans; null ids are kept;
repeated rows are scanned one by one; equal spans of one kind count once. Texts are
scanned whole; every pattern is linear in the text's length.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import Columns, id_and_text, map_columns, named

Span = tuple[str, int, int]

KINDS = ("assign", "access", "hex", "literal")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
# A run that is too short has no long enough rest, so the length can stand in the pattern.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")

# Words of a name that make it sensitive, and how much.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 1.0,
    "apikey": 1.0, "credential": 1.0, "credentials": 1.0, "privatekey": 1.0, "accesskey": 1.0,
    "secretkey": 1.0, "authkey": 1.0, "signingkey": 0.9, "encryptionkey": 0.9, "bearer": 0.9,
    "auth": 0.7, "authorization": 0.8, "dsn": 0.7, "key": 0.5, "pass": 0.7,
}
# Literals that stand for a secret without being one. The whole literal has to
# be such words, with separators between them, or a reference to a value kept elsewhere.
_PLACEHOLDER = (
    r"(?:your|my|example|sample|dummy|changeme|placeholder|redacted|todo|none|null|true|false"
    r"|undefined|x{4,}|\*{3,}|\.{3,})"
)
_FILLER = (
    r"(?:here|goes|the|value|string|name|user|id|api|app|db|client|access|private|auth|key|token"
    r"|secret|password|passwd|pwd|passphrase|credentials?)"
)
PLACEHOLDERS = re.compile(
    rf"{_PLACEHOLDER}(?:[-_. :]+(?:{_PLACEHOLDER}|{_FILLER}))*+[0-9]{{0,4}}[.!]*"
    r"|<[A-Za-z][A-Za-z_ -]*>?|\$\{[^{}]*\}|\{\{[^{}]*\}\}|%\([^()]*\)[sd]?",
    re.IGNORECASE,
)
THRESHOLD = 0.5

_PAIR = re.compile(
    r"""(?<![\w.-])(?P<q>["']?)(?P<name>[A-Za-z_][\w.-]*+)(?P=q)(?:(?<=["'])[ \t]*+\])?[ \t]*+"""
    # a type may stand between the name and =, as in name: str | None = "x"
    r"""(?:\??:[ \t]*+(?P<type>[A-Za-z_][\w.]*+)(?:\[[\w., |\[\]]{0,80}\])?(?:[ \t]*+[|?][ \t]*+[\w.\[\]]*+){0,8}[ \t]*+=(?![=>])"""
    r"""|:=|=>|=(?!=)|:(?![:/]))[ \t]*+"""
)
_VALUE = re.compile(
    r"""(?:[fFrRbBuU]{1,2}(?=["']))?+(?:\"\"\"(?P<t>(?:[^"\\]|\\.|"(?!""))*+)\"\"\"|'''(?P<u>(?:[^'\\]|\\.|'(?!''))*+)'''"""
    r"""|"(?P<d>(?:[^"\\\n]|\\.)*+)"|'(?P<s>(?:[^'\\\n]|\\.)*+)')|(?P<name>[A-Za-z_][\w.]*+)(?![\w+/=$@!#%^&*~-])|(?P<bare>[^\s"',;()\[\]{}]++)""",
    re.DOTALL,
)
_GROUPS = ("t", "u", "d", "s", "bare")
# What may follow an assignment before its value: a parenthesis, and then another line.
_OPEN = re.compile(r"\((?:[ \t]*+\r?\n)?[ \t]*+")
# The arguments of a call up to the end of its line, without calls inside.
_ARGUMENTS = re.compile(r"""[(\[](?:[^()\[\]"'\n]|"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+')*+[)\]]""")
_QUOTED = re.compile(r""""((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)'""")
# Calls that look a value up by the name in their first argument.
LOOKUPS = ("get", "getenv", "getproperty", "getorelse", "getordefault", "pop", "setdefault", "env")
_ELEMENT = re.compile(r"<([A-Za-z_][\w.-]*+)>([^<>\s]{8,})</\1>")
_PATH = re.compile(r"[A-Za-z_$][\w$]*(?:\.[A-Za-z_$][\w$]*)*")
_TURNS = re.compile(r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
_PLUS = re.compile(r"[ \t]*+[+.][ \t]*+(?=[\"'A-Za-z_])")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|[^A-Za-z0-9]+")


def is_reference(word: str, after: str) -> bool:
    """Whether a word without quotes names a value: `after` is the text behind it.

    Names seldom change between letters and digits more than once (`key2`, `v2Key`);
    secrets do.
    """
    if not _PATH.fullmatch(word):
        return False
    if after[:1] in {"(", "["}:
        return True
    return all(len(_TURNS.findall(name)) < 3 for name in word.split("."))


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of the plain patterns; matches that fail a length rule are dropped."""
    found = [
        ("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12
    ]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return found


def sensitivity(name: str) -> float:
    """Of a variable's name, 0 to 1: its words, and pairs of neighbouring words joined."""
    words = [w.lower() for w in _CAMEL.split(name) if w]
    joined = words + [a + b for a, b in zip(words, words[1:], strict=False)]
    return max((SENSITIVE.get(w, 0.0) for w in joined), default=0.0)


def strength(literal: str) -> float:
    """How much a literal looks like a secret, 0 to 1: length, variety and kinds of character.

    Blanks are no kind of their own; words in small letters count as a weak passphrase.
    """
    if len(literal) < 8 or PLACEHOLDERS.fullmatch(literal):
        return 0.0
    counts = Counter(literal).values()
    bits = -sum(c / len(literal) * math.log2(c / len(literal)) for c in counts)
    kinds = sum(
        bool(re.search(p, literal)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9 ]")
    )
    one_kind = 0.6 if " " in literal.strip() else 0.4
    return min(1.0, bits / 3) * (1.0 if kinds > 1 else one_kind)


def assigned_literals(text: str) -> list[tuple[str, str, int, int]]:
    """Pairs (name, literal, start, end), with constants carried on to the names they reach."""
    known: dict[str, list[tuple[str, int, int]]] = {}
    found = []
    for pair in _PAIR.finditer(text):
        name, at = pair["name"], pair.end()
        kind = pair["type"]
        reached: list[tuple[str, int, int]] = []
        if opened := _OPEN.match(text, at):
            at = opened.end()
        while value := _VALUE.match(text, at):
            end = value.end()
            if value["name"] is not None:
                word = value["name"]
                call = _ARGUMENTS.match(text, end)
                if call:
                    quoted = list(_QUOTED.finditer(text, *call.span()))
                    lookup = word.rpartition(".")[2].lower() in LOOKUPS or call[0][0] == "["
                    for q in quoted[lookup:]:
                        found.append((name, q[q.lastindex or 1], *q.span(q.lastindex or 1)))
                    end = call.end()
                elif word in known:
                    reached += known[word]
                elif not reached and not is_reference(word, text[end : end + 1]):
                    reached.append((word, *value.span()))  # as in configuration files
            else:
                group = next(g for g in _GROUPS if value[g] is not None)
                if group != "bare" or not is_reference(value[group], text[end : end + 1]):
                    reached.append((value[group], *value.span(group)))
            plus = _PLUS.match(text, end)
            if not plus:
                break
            at = plus.end()
        known[name] = reached
        # what is joined is one text, and each of its parts gives it away
        whole = "".join(literal for literal, _, _ in reached)
        found += [(name, whole, start, end) for _, start, end in reached]
        if kind is not None:  # `note: password = "x"` looks like a type too
            found += [(kind, whole, start, end) for _, start, end in reached]
            found += [(name, *x) for x in known.get(kind, [(kind, *pair.span("type"))])]
            known[kind] = reached
    found += [(m[1], m[2], *m.span(2)) for m in _ELEMENT.finditer(text)]
    return found


def literal_spans(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """Literals whose best score over all names they reach meets the threshold."""
    best: dict[tuple[int, int], float] = {}
    for name, literal, start, end in assigned_literals(text):
        weight = sensitivity(name)
        if weight:
            score = weight * strength(literal)
            best[start, end] = max(best.get((start, end), 0.0), score)
    return [("literal", a, b) for (a, b), score in best.items() if score >= threshold]


def listed(spans: list[Span]) -> list[Span]:
    """By start, then kind."""
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, base and all spans as arrays of (kind, start, end) in code points."""

    def scan(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            base = [base_spans(t) for t in batch["text"]]
            every = [
                b + literal_spans(t) for t, b in zip(batch["text"], base, strict=True)
            ]
            yield {
                "doc_id": batch["doc_id"],
                "base": [_structs(b) for b in base],
                "spans": [_structs(s) for s in every],
            }

    span = "array<struct<kind: string, start: int, end: int>>"
    return map_columns(
        id_and_text(docs, id_col, text_col), scan, f"doc_id long, base {span}, spans {span}"
    )


def _structs(spans: list[Span]) -> list[dict]:
    return [{"kind": k, "start": a, "end": b} for k, a, b in listed(spans)]


def joined(spans: str) -> Column:
    """kind:start:end, comma-joined, of a column of spans."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def count_of(spans: str, kind: str) -> Column:
    """How many spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _takes_reference(text: str, start: int, stop: int) -> bool:
    """Whether the value of a plain assignment is a path of names, or is called."""
    value = _ASSIGN.match(text, start)
    if value is None or text[value.start(2) - 1] in "\"'":
        return False
    after = text[stop : stop + 1]
    # a single word that is neither a path nor called may be a password
    joint = "." in value[2] or "_" in value[2] or after in {"(", "["}
    return joint and is_reference(value[2], after)


def masked(text: str, mark: str = "[SECRET]") -> str:
    """The text with every span, overlapping ones together, replaced by a mark."""
    plain = [
        (kind, start, stop)
        for kind, start, stop in base_spans(text)
        if kind != "assign" or not _takes_reference(text, start, stop)
    ]
    out, at, end = [], 0, -1
    for _, start, stop in listed(plain + literal_spans(text)):
        if start >= end:
            out += [text[at:start], mark]
        end = max(end, stop)
        at = end
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns, secrets replaced; null texts stay null. Uses an Arrow UDF."""

    @F.pandas_udf("string")
    def mask(texts):  # noqa: ANN001, ANN202
        return texts.map(lambda t: None if t is None else masked(t))

    return docs.withColumn(text_col, mask(named(text_col).cast("string")))
