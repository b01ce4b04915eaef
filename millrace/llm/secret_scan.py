"""Secret scan: fixed patterns, and an assignment-aware lexer.

The lexer reads source and configuration syntax (``a = "x"``, ``a: x``, ``"a": "x"``,
``export A=x``, ``<a>x</a>``, ``set(a, "x")``) into name-literal pairs, in text order. A name given
a literal, or a sum of literals and known names, is a constant; a later use of the name as a
value takes its literal. A pair counts when its score, from words of the target name and the
variety of the literal, reaches ``THRESHOLD``; a constant that is passed to a sensitive target
is marked where its literal stands, a sum with a span for each place that holds a part of it.
Types after a name, subscripts, triple quotes, adjacent literals and indented blocks are read; a
call, or a bare word that reads as the name of something, is no literal.
Scores lie in 0 to 1.

Null and empty texts have no span. Equal rows give equal spans. Every step moves forward in the
text, so the work is in proportion to it. The constants of a text are all kept while it is read, so
memory is in proportion to it as well.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from millrace.llm.common import arrow_map, extended
from millrace.llm.spans import Span, add_spans

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "literal", "constant")
THRESHOLD = 0.6
SHORTEST = 8
REDACTED = "<secret>"

# The patterns of the contract. Runs are taken whole, so a shortest length inside
# the pattern finds the same matches as a test of the length afterwards.
ASSIGN = re.compile(
    r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
HINT = re.compile(r"(?ai:passw|secret|token|api_?key)")

# Words of a target name and how much they tell.
SENSITIVE = {
    "password": 0.6, "passwd": 0.6, "pwd": 0.6, "passphrase": 0.6, "secret": 0.55, "token": 0.5,
    "apikey": 0.6, "api": 0.2, "key": 0.25, "private": 0.25, "access": 0.2, "auth": 0.35,
    "credential": 0.55, "credentials": 0.55, "bearer": 0.4, "signature": 0.3, "salt": 0.3,
    "client": 0.1, "session": 0.2, "cookie": 0.25,
}
HARMLESS = re.compile(
    r"(?ai:true|false|null|none|undefined|example|changeme|placeholder|todo|x+|\*+|\.+|<.*>|\$\{?\w+\}?)"
)
NAME_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

# Runs are possessive, and begin where no run of the same kind goes on, so each is read a fixed
# number of times however long it is. A name may stand in a subscript, and a type may follow it.
PAIR = re.compile(
    r"""(?ax)
    (?<![\w.-]) (?P<quote>["']?) (?P<name>[A-Za-z_][\w.-]*+) (?P=quote) \]?+ [\x20\t]*+
    (?: :[\x20\t]*+ [&*]?+ (?:'\w++\x20)?+ (?:(?:mut|const)\x20)?+ [A-Za-z_][\w.:]*+
            (?:<[^<>\n]*+>|\[[^\[\]\n]*+\])?+ \??+ (?:[\x20]*+\|[\x20]*+None)?+ [\x20\t]*+ =(?![=>~])
      | :?=(?![=>~]) | => | :(?![:/=]) ) [\x20\t]*+ (?=\S)
    """
)
TERM = re.compile(
    r"""(?ax)
    \"\"\"(?P<long_double>(?:[^"\\]|\\[\s\S]|"(?!""))*+)\"\"\" | '''(?P<long_single>(?:[^'\\]|\\[\s\S]|'(?!''))*+)'''
    | "(?P<double>[^"\\\n]*+(?:\\.[^"\\\n]*+)*+)" | '(?P<single>[^'\\\n]*+(?:\\.[^'\\\n]*+)*+)'
    | (?P<bare>(?:[A-Za-z0-9/_.=~$@%-]|\+(?!["']))++)
    """
)
PLUS = re.compile(r"[\x20\t]*+\+[\x20\t]*+(?=[\"'A-Za-z_])")
NEXT_LITERAL = re.compile(r"[\x20\t]*+(?=[\"'])")
# A value of the lines that follow, indented more than the line of the name.
BLOCK = re.compile(r"[|>][+-]?[0-9]?[\x20\t]*+\n")
LINE = re.compile(r"(?P<indent>[\x20\t]*+)(?P<line>[^\n]*+)\n?")
ARMOUR = re.compile(r"-----[A-Z\x20]++-----")
# A bare word of one or more plain words: the name of something, not a literal.
PLAIN = re.compile(r"(?a)[$@%]?(?:(?:[A-Z]?[a-z]{2,}|[A-Z]{2,}|[A-Z][a-z]+(?=[A-Z]))+[0-9]{0,2}|[A-Za-z]?[0-9]{0,2})")
IDENTIFIER = re.compile(r"(?a)[A-Za-z_][\w.-]*+")
ELEMENT = re.compile(r"(?a)<([A-Za-z_][\w.-]*+)>([^<>\n]++)</\1>")
ACCESSED = re.compile(r"(?a)\bset\w*+\(\s*+[\"']?([A-Za-z_][\w.-]*+)[\"']?\s*+,\s*+[\"']([^\"'\n]++)[\"']")


def entropy(literal: str) -> float:
    """Bits for each character."""
    n = len(literal)
    return -sum(c / n * math.log2(c / n) for c in Counter(literal).values()) if n else 0.0


def name_score(name: str) -> float:
    words = [w.lower() for w in NAME_WORD.findall(name)]
    return min(0.7, sum(SENSITIVE.get(w, 0.0) for w in words))


def literal_score(literal: str) -> float:
    """How much the literal looks made by a machine: variety, and more than one class."""
    if len(literal) < SHORTEST or HARMLESS.fullmatch(literal) or " " in literal:
        return 0.0
    kinds = sum(bool(re.search(p, literal)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^\w\s]"))
    return min(0.4, 0.07 * entropy(literal)) + 0.05 * (kinds - 1)


def score(name: str, literal: str) -> float:
    named, varied = name_score(name), literal_score(literal)
    return round(min(1.0, named + varied), 4) if named and varied else 0.0


def base_spans(text: str) -> list[Span]:
    spans: list[Span] = []
    if HINT.search(text):
        spans += [
            ("assign", m.start(), m.end(), True, 1.0)
            for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= SHORTEST
        ]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end(), True, 1.0) for m in ACCESS.finditer(text)]
    spans += [("hex", m.start(), m.end(), True, 1.0) for m in HEX.finditer(text)]
    return spans


class Value:
    """What a name stands for: runs of literal text that are written in one place, and other values.

    A value refers to those it is made of, so a constant passed on many times costs one entry each.
    """

    __slots__ = ("parts", "shown", "single")

    def __init__(self, parts: list[str | Value], start: int = 0, end: int = 0) -> None:
        self.parts = parts
        self.single = (start, end)
        self.shown = 0.0

    def walk(self):
        """Runs of literal text, in order."""
        waiting = [self]
        while waiting:
            value = waiting.pop()
            if value.parts and isinstance(value.parts[0], str):
                yield value
            else:
                waiting.extend(reversed(value.parts))

    def literal(self) -> str:
        return "".join("".join(run.parts) for run in self.walk())

    def runs(self, worth: float):
        """Each run that was not given before with this worth or more."""
        waiting = [self]
        while waiting:
            value = waiting.pop()
            if value.shown >= worth:
                continue
            value.shown = worth
            if isinstance(value.parts[0], str):
                yield value
            else:
                waiting.extend(value.parts)


def plain(word: str) -> bool:
    """Whether a bare word reads as a name: ``settings.PRIVATE_KEY``, ``loadToken``, ``established1``."""
    return all(PLAIN.fullmatch(part) for part in re.split("[._/-]", word))


def block_value(text: str, name_at: int, at: int) -> tuple[Value | None, int]:
    """The lines of an indented block as runs of one value, and where it ends. Armour is no part."""
    begin = text.rfind("\n", 0, name_at) + 1
    outer = len(text[begin:name_at]) - len(text[begin:name_at].lstrip(" \t"))
    runs: list[Value] = []
    while at < len(text):
        m = LINE.match(text, at)
        line = m["line"].rstrip()
        if line and len(m["indent"]) <= outer:
            break
        if line and not ARMOUR.fullmatch(line):
            runs.append(Value([line], m.start("line"), m.start("line") + len(line)))
        at = m.end()
    return (Value(runs) if len(runs) > 1 else runs[0] if runs else None), at


def pairs(text: str):
    """(name, value, own) in text order.

    ``own`` has the runs of the value that stand with the name; its other runs came through a
    constant, and their places are those of the constant's literals. The parts of a sum that are
    written side by side are one run; a run never holds the text between two places. A call, and
    a bare word that names something unknown, are no literals, and the name has no value then.
    """
    constants: dict[str, Value] = {}
    at = 0
    while found := PAIR.search(text, at):
        name, at = found["name"], found.end()
        block = BLOCK.match(text, at)
        if block:
            value, at = block_value(text, found.start(), block.end())
            if value:
                yield name, value, {id(run) for run in value.walk()}
            continue
        parts: list[Value] = []
        own: set[int] = set()
        joins, known = False, True
        while term := TERM.match(text, at):
            at = term.end()
            group = term.lastgroup
            word = term[group]
            names = word.split("+") if group == "bare" else []
            if names and all(n in constants for n in names):
                parts += [constants[n] for n in names]
                joins = False
            elif names and (text[at : at + 1] in ("(", "[") or plain(word)):
                known = False
            elif joins:
                parts[-1].parts.append(word)
                parts[-1].single = (parts[-1].single[0], term.end(group))
            else:
                parts.append(Value([word], term.start(group), term.end(group)))
                own.add(id(parts[-1]))
                joins = True
            more = PLUS.match(text, at) or (None if names else NEXT_LITERAL.match(text, at))
            if not more:
                break
            at = more.end()
        if not parts or not known:
            constants.pop(name, None)
            # The literals of a sum with something unknown are still literals of this name.
            if not parts:
                continue
        value = parts[0] if len(parts) == 1 else Value(parts)
        if known and IDENTIFIER.fullmatch(name):
            constants[name] = value
        yield name, value, own
    for pattern in (ELEMENT, ACCESSED):
        for m in pattern.finditer(text):
            value = Value([m[2]], m.start(2), m.end(2))
            yield m[1], value, {id(value)}


def find_secrets(text: str) -> list[Span]:
    spans = base_spans(text)
    if "=" in text or ":" in text or "</" in text or "set" in text:
        best: dict[tuple[int, int], tuple[float, bool]] = {}
        for name, value, own in pairs(text):
            worth = score(name, value.literal()) if name_score(name) else 0.0
            if worth < THRESHOLD:
                continue
            for run in value.runs(worth):
                if run.single[0] < run.single[1] and worth > best.get(run.single, (0.0, False))[0]:
                    best[run.single] = (worth, id(run) not in own)
        spans += [
            ("constant" if through else "literal", start, end, False, worth)
            for (start, end), (worth, through) in best.items()
        ]
    return spans


def scan_secrets(frame: DataFrame, text: str = "text") -> DataFrame:
    """``frame`` with ``spans`` of secrets in the whole of ``text``."""
    return add_spans(frame, text, find_secrets, KINDS)


def without(text: str, spans: Iterable[tuple[int, int]]) -> str:
    """``text`` with each run of overlapping spans, given by start, replaced by one mark."""
    out, at = [], 0
    for start, end in spans:
        if start >= at:
            out += [text[at:start], REDACTED]
        at = max(at, end)
    return "".join([*out, text[at:]])


def hide_secrets(frame: DataFrame, text: str = "text") -> DataFrame:
    """``frame`` with each run of overlapping spans in ``text`` replaced by one mark, and ``hidden``:

    whether there was one. Texts go through Python once. A column called ``hidden`` is replaced.
    """
    kept = [c for c in frame.columns if c != "hidden"]
    source = frame.select(*(F.col(f"`{c}`") for c in kept))
    at = kept.index(text)

    def run(batches):
        for batch in batches:
            texts, hidden = [], []
            for value in batch.column(at).to_pylist():
                spans = sorted((s[1], s[2]) for s in find_secrets(value)) if value else []
                texts.append(without(value, spans) if spans else value)
                hidden.append(bool(spans))
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(hidden)], names=[*kept, "hidden"])

    return arrow_map(source, run, extended(source.schema, hidden=BooleanType()))


def redact(frame: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``text`` with each run of overlapping spans replaced by one mark; the spans are dropped."""
    names = frame.columns
    at, places = names.index(text), names.index(spans)
    kept = [c for c in names if c != spans]

    def run(batches):
        for batch in batches:
            columns = list(batch.columns)
            found = zip(columns[at].to_pylist(), columns[places].to_pylist(), strict=True)
            columns[at] = pa.array(
                [without(t, sorted((s["start"], s["end"]) for s in own)) if own else t for t, own in found], pa.string()
            )
            yield pa.RecordBatch.from_arrays([c for k, c in enumerate(columns) if k != places], names=kept)

    return arrow_map(frame, run, frame.drop(spans).schema)
