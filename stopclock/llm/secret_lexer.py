"""Secrets in texts: fixed patterns, and literals that reach a name which tells a secret.

The lexer reads source code and configuration as assignments: a name (bare, quoted, in a
subscript, annotated with a type, one of several before an ``=``, or the tag of an element),
one of ``= : := =>`` and a value.  A value is made of literals (quoted, triple-quoted or bare)
and references to other names (bare, ``$NAME`` or ``${NAME}``), joined by ``+``; a call stands
for each of its arguments.  References are followed through the text, so a literal that is
first stored under a harmless name still counts once a sensitive name receives it, and joined
pieces are folded into the one value that they make.  Each literal, and each folded value, is
scored by the words of its target name and by its own make-up.

Results in special cases: a null text counts as empty and has no spans; repeated rows and
null ids are kept row by row; an empty table gives an empty result; every pattern works in
linear time, so very long texts are scanned whole.  Input columns other than ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from stopclock.llm.common import chunks, texts_of
from stopclock.llm.spans import Span, joined

# The patterns and limits of the base kinds.
BASE_KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ASSIGN_LEAST = 6
# A greedy run of at least the least length is found where the open pattern finds it.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

KINDS = (*BASE_KINDS, "literal")

#: Weights of name words; a name scores its heaviest word or pair of words.
NAME_WEIGHTS = {
    "password": 1.0,
    "passwd": 1.0,
    "passphrase": 1.0,
    "pwd": 1.0,
    "secret": 1.0,
    "token": 1.0,
    "apikey": 1.0,
    "accesskey": 1.0,
    "privatekey": 1.0,
    "secretkey": 1.0,
    "credential": 0.9,
    "credentials": 0.9,
    "auth": 0.7,
    "authorization": 0.7,
    "bearer": 0.7,
    "signature": 0.5,
    "pass": 0.7,
    "key": 0.5,
    "salt": 0.5,
}
#: Name weight times literal strength that makes a literal a secret.
THRESHOLD = 0.5
#: Literals that stand for a secret but are none.
PLACEHOLDERS = {"changeme", "example", "password", "secret", "undefined", "required", "optional", "redacted"}

#: Repeats of a character that are told apart in a folded value; no text has as many.
MOST_FOLDED = 1 << 40

_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_HINT = re.compile(r"pass|pwd|secret|token|key|cred|auth|bearer|sign|salt", re.I | re.A)
_ANY_NAME = r"[A-Za-z_][A-Za-z0-9_.-]*+"
# A closing bracket may follow a quoted name, a type may stand before the sign.
_NAME = re.compile(
    rf"""(?<![A-Za-z0-9_.-])(["']?)({_ANY_NAME})\1(?:(?<=["'])[ \t]*+\])?+[ \t]*+"""
    r"""(?::=|=>|=(?!=)|:[ \t]*+[A-Za-z_][A-Za-z0-9_.]*+[ \t]*+=(?![=>])|:(?!//))[ \t]*+"""
)
_NAMES = re.compile(rf"^[ \t]*+({_ANY_NAME}(?:[ \t]*+,[ \t]*+{_ANY_NAME})++)[ \t]*+=(?!=)[ \t]*+", re.M)
_ELEMENT = re.compile(rf"<({_ANY_NAME})(?:[ \t][^<>\n]*+)?+>\s*+([^<>]*+)</\1>")
_TRIPLE = re.compile(r'''[A-Za-z]{0,2}(?:"{3}(.*?)"{3}|'{3}(.*?)'{3})''', re.S)
_QUOTED = re.compile(r"""[A-Za-z]{0,2}(?:"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)')""")
_CALL = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*+\(")
_GAP, _BLANK = re.compile(r"\s*+"), re.compile(r"[ \t]*+")
_REFERENCE = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_.-]*+)\}|\$([A-Za-z_][A-Za-z0-9_]*+)")
_BARE = re.compile(r"[A-Za-z0-9+/_.~!@%^&*-]++=*+")


class Piece(NamedTuple):
    """Part of a value: a literal's span, a name that is referred to, or what may be either."""

    span: tuple[int, int] | None
    name: str | None


class Definition(NamedTuple):
    name: str
    at: int
    pieces: list[Piece]


def name_weight(name: str) -> float:
    words = [w.lower() for w in _WORD.findall(name)]
    pairs = [a + b for a, b in zip(words, words[1:])]
    return max((NAME_WEIGHTS.get(w, 0.0) for w in words + pairs), default=0.0)


def strength(literal: str) -> float:
    """0 to 1: how much a literal looks drawn at random.  Entropy of its characters in bits
    over four, cut for few kinds of characters and for short literals."""
    return 0.0 if literal.lower() in PLACEHOLDERS else _make_up(Counter(literal))


def _make_up(counts: Counter) -> float:
    n = sum(counts.values())
    if n < 6:
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    found = "".join(counts)
    kinds = [bool(re.search(p, found)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]")]
    if not kinds[2] and sum(kinds) < 3:
        return 0.0  # a word, not a key
    return min(1.0, entropy / 4) * min(1.0, 0.4 + 0.3 * sum(kinds)) * min(1.0, n / 10)


def base_spans(text: str) -> list[Span]:
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def _values(text: str, at: int) -> tuple[list[list[Piece]], int]:
    """The values that start at ``at`` and where they end; several only for a call."""
    values: list[list[Piece]] = [[]]
    depth = 0
    while True:
        if q := _CALL.match(text, at):
            depth += 1
            at = _GAP.match(text, q.end()).end()
            continue
        if q := _TRIPLE.match(text, at) or _QUOTED.match(text, at):
            values[-1].append(Piece(q.span(1 if q[1] is not None else 2), None))
        elif q := _REFERENCE.match(text, at):
            values[-1].append(Piece(None, q[1] or q[2]))
        elif q := _BARE.match(text, at):
            values[-1].append(Piece(q.span(), q[0]))
        else:
            break
        at = (_GAP if depth else _BLANK).match(text, q.end()).end()
        while depth and text.startswith(")", at):
            depth -= 1
            at = (_GAP if depth else _BLANK).match(text, at + 1).end()
        if depth and text.startswith(",", at):
            values.append([])
        elif not text.startswith("+", at):
            break
        at = _GAP.match(text, at + 1).end() if depth else _BLANK.match(text, at + 1).end()
    return [v for v in values if v], at


def definitions(text: str) -> list[Definition]:
    """All assignments of a text by place; a name with several values has one for each."""
    out, taken = [], set()
    for m in _NAMES.finditer(text):
        names, each, at = re.split(r"[ \t]*,[ \t]*", m[1]), [], m.end()
        taken.add(at)
        for _ in names:
            values, at = _values(text, at)
            each.append(values)
            if not text.startswith(",", at):
                break
            at = _BLANK.match(text, at + 1).end()
        if len(each) == 1:  # one value that is taken apart
            each *= len(names)
        out += [Definition(n, m.start(), v) for n, values in zip(names, each) for v in values]
    for m in _NAME.finditer(text):
        if m.end() not in taken:
            out += [Definition(m[2], m.start(), v) for v in _values(text, m.end())[0]]
    for m in _ELEMENT.finditer(text):
        a, b = m.start(2), m.start(2) + len(m[2].rstrip())
        if a < b:
            out.append(Definition(m[1], m.start(), [Piece((a, b), None)]))
    return sorted(out, key=lambda d: d.at)


def _meant(i: int, listed: list[int]) -> int:
    """Of a name's definitions, the last one before ``i``, or else the first one."""
    return listed[max(0, bisect_left(listed, i) - 1)]


def _folded(text: str, found: list[Definition], held: dict[str, list[int]], roots: list[int]) -> dict[int, Counter]:
    """Characters of the whole value of each root, with those of the names in it; a name that
    is defined by itself stands for nothing."""
    done: dict[int, Counter] = {}
    for root in roots:
        path, open_ = [root], set()
        while path:
            i = path[-1]
            if i in done:
                path.pop()
                continue
            open_.add(i)
            inner = [_meant(i, held[p.name]) for p in found[i].pieces if p.name in held]
            if waits := [j for j in inner if j not in done and j not in open_]:
                path += waits
                continue
            total: Counter = Counter()
            for p in found[i].pieces:
                if p.name in held:
                    total.update(done.get(_meant(i, held[p.name]), {}))
                elif p.span:
                    total.update(text[slice(*p.span)])
            # Names that double each other make numbers beyond any text; they end here.
            done[i] = Counter({c: min(k, MOST_FOLDED) for c, k in total.items()})
            open_.discard(path.pop())
    return done


def literal_spans(text: str) -> list[Span]:
    """Literals that a sensitive name holds, directly, through other names or in pieces."""
    if not _HINT.search(text):
        return []
    found = definitions(text)
    held: dict[str, list[int]] = {}
    for i, d in enumerate(found):
        held.setdefault(d.name, []).append(i)
    weights = {n: w for n in held if (w := name_weight(n))}
    best: dict[tuple[int, int], float] = {}
    for weight in sorted(set(weights.values()), reverse=True):
        # One walk for all names of a weight: every name is entered once.
        open_, seen = [n for n, w in weights.items() if w == weight], set()
        while open_:
            name = open_.pop()
            if name in seen:
                continue
            seen.add(name)
            for p in (p for i in held[name] for p in found[i].pieces):
                if p.name in held:
                    open_.append(p.name)
                elif p.span:
                    best.setdefault(p.span, weight)
    spans = {s for s, w in best.items() if w * strength(text[slice(*s)]) >= THRESHOLD}
    roots = [i for n in weights for i in held[n] if len(found[i].pieces) > 1]
    folded = _folded(text, found, held, roots)
    open_ = [i for i in roots if weights[found[i].name] * _make_up(folded[i]) >= THRESHOLD]
    entered = set(open_)
    while open_:
        i = open_.pop()
        for p in found[i].pieces:
            if p.name not in held:
                spans.update([p.span] if p.span else [])
            elif (j := _meant(i, held[p.name])) not in entered:
                entered.add(j)
                open_.append(j)
    return [(a, b, "literal") for a, b in spans]


def find_in(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and those that the method adds beyond them."""
    base = base_spans(text)
    inside = sorted(base)
    starts, ends = [x for x, _, _ in inside], list(accumulate((y for _, y, _ in inside), max))
    added = []
    for a, b, kind in sorted(literal_spans(text)):
        before = bisect_right(starts, a)
        if not before or ends[before - 1] < b:
            added.append((a, b, kind))
    return base, added


FIELDS = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_spans string, spans string"


def find(docs: DataFrame) -> DataFrame:
    """Secrets of every text: counts of the base kinds, the base spans and all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch):
                rows = []
                for text in texts_of(piece):
                    base, added = find_in(text)
                    n = Counter(k for _, _, k in base)
                    rows.append((*(n[k] for k in BASE_KINDS), joined(base, KINDS), joined(base + added, KINDS)))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        *(pa.array(c, pa.int64()) for c in columns[:3]),
                        *(pa.array(c, pa.string()) for c in columns[3:]),
                    ],
                    names=[f.split()[0] for f in FIELDS.split(", ")],
                )

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(run, FIELDS)
