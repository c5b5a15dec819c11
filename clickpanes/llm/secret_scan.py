"""Secret scanning by assignment-aware lexing.

Source and configuration text is read as name-literal pairs: ``name = "literal"``,
``name: literal``, ``"name": "literal"``, ``name := ...``, ``'name' => ...``,
``<name>literal</name>``, ``#define NAME "literal"`` and ``setName("literal")``. Literals may have a
prefix (``f"..."``, ``@"..."``), three quotes, stand in brackets, on the next line after an
open bracket or a backslash, in a list, or in the place of their name in ``a, b = x, y``. Constants are propagated within a text: a right-hand side that
names an earlier constant, joins literals and names with ``+`` or contains
``${name}`` stands for the literals it refers to, beside its own text. In a typed declaration
(``name: type = "literal"``) the name is that of what follows ``=``. A call, an indexed
or a dotted name is no literal; of a call that looks a setting up, the default is one. A literal is scored by the names
it reaches and by its own form (length, entropy, not a placeholder); from
``THRESHOLD`` on its span is reported as kind ``named``.

Base kinds, by pattern: ``assign``, ``access`` and ``hex``. All spans count code points
of the text, end exclusive. Texts are read whole, in time linear in their length.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column

# The base patterns, with the least length of what they find.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so shorter ones need no look
KINDS = ["assign", "access", "hex", "named"]
ASSIGN_WORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]

# How sensitive a part of a name is, and what is no secret.
SENSITIVE = {
    "password": 1.0,
    "passwd": 1.0,
    "passphrase": 1.0,
    "passcode": 1.0,
    "pwd": 1.0,
    "secret": 1.0,
    "apikey": 1.0,
    "token": 0.9,
    "credential": 0.9,
    "credentials": 0.9,
    "bearer": 0.9,
    "auth": 0.7,
    "authorization": 0.8,
    "key": 0.5,
}
KEY_BEFORE = {"api", "access", "private", "secret", "encryption", "signing", "auth", "account", "storage", "master"}
PLACEHOLDERS = ["changeme", "example", "placeholder", "your", "xxxx", "****", "dummy", "redacted", "todo", "none", "null", "true", "false", "undefined"]
THRESHOLD = 0.6
LEAST = 6
_HINTS = sorted(SENSITIVE)

# Calls that look a setting up, with a default after its name.
LOOKUPS = {"get", "getenv", "env", "getproperty", "getordefault", "get_or", "setdefault", "config"}

_OPERATOR = re.compile(r"=>|:=|=(?!=)|:(?![:/])|</|#[ \t]*define[ \t]+(\w+)[ \t]|\bset_?(\w+)\((?=[ \t]*[\"'`@])")
_PREFIX = r"(?:[fbruFBRU]{1,3}|L|@\$?|\$@?)?"
_QUOTED = re.compile(rf"{_PREFIX}(?:\"((?:[^\"\\\n]|\\.)*)\"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`)")
_TRIPLE = re.compile(rf"{_PREFIX}(\"\"\"|''')")
_GAP = re.compile(r"(?:[ \t]|\\\r?\n)*")
_LINES = re.compile(r"(?:\s|\\\r?\n)*")
_WORDS = r"[A-Za-z_]++(?:\d{1,2}+_[A-Za-z_]*+)*+\d{0,2}+"
_DOTTED = re.compile(rf"{_WORDS}(?:\.{_WORDS})++")
_NAMES = re.compile(r"[A-Za-z_]\w*")
_BARE = re.compile(r"[^\s\"'`,;(){}\[\]<>]+")
_REFERENCE = re.compile(r"\$\{([A-Za-z_]\w*)\}|\$([A-Za-z_]\w*)|\{([A-Za-z_]\w*)\}")
_ATOM = r"[&*]*+(?:'\w++[ \t]++)?+[A-Za-z_][\w.]*+(?:\[[^\[\]\n=:]*+(?:\[[^\[\]\n=:]*+\][^\[\]\n=:]*+)*+\]|<[^<>\n=:]*+>)*+\??+"
_TYPED = re.compile(rf"[ \t]*+(?:{_ATOM}|\[[^\[\]\n=:]*+\])(?:[ \t]*+\|[ \t]*+{_ATOM})*+(?:[ \t]++=(?![=>~])|=(?=[\"'`]))")
_NAME = re.compile(r"[A-Za-z_][\w.\-]*")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def name_score(name: str) -> float:
    """How sensitive a target name is, 0 to 1."""
    parts = [p.lower() for p in _PART.findall(name)]
    # A part may be joined words, as in dbpwd: its end counts.
    best = max((weight for p in parts for word, weight in SENSITIVE.items() if p.endswith(word)), default=0.0)
    joined = [p[:-3] for p in parts if p.endswith("key")]
    if any(b == "key" and a in KEY_BEFORE for a, b in zip(parts, parts[1:])) or any(p.endswith(tuple(KEY_BEFORE)) for p in joined):
        best = 1.0
    return max(best, SENSITIVE.get("".join(parts), 0.0))


def literal_score(value: str) -> float:
    """How much a literal looks like a secret, 0 to 1."""
    low = value.lower()
    if len(value) < LEAST or any(p in low for p in PLACEHOLDERS) or any(c.isspace() for c in value):
        return 0.0
    n = len(value)
    bits = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    mixed = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit))
    return min(1.0, 0.4 * min(1.0, bits / 3.0) + 0.2 * mixed + (0.2 if n >= 16 else 0.1 if n >= 8 else 0.0))


def _target(text: str, at: int) -> str | None:
    """The name that ends before the operator at ``at``."""
    end = at
    while end and text[end - 1] in " \t":
        end -= 1
    while end and text[end - 1] in "\"'`])":
        end -= 1
    start = end
    while start and (text[start - 1].isalnum() or text[start - 1] in "_.-"):
        start -= 1
    found = _NAME.search(text, start, end)
    return found.group() if found else None


@dataclass
class Constant:
    """What a name stands for: spans of literals, and the constants it refers to."""

    parts: list[tuple[int, int] | Constant]
    weight: float = 0.0  # the highest with which it was resolved

    def resolve(self, weight: float) -> Iterator[tuple[int, int]]:
        """The spans it reaches, without those of constants that were resolved with
        this weight before: so the work is linear, however names are joined."""
        left = [self]
        while left:
            node = left.pop()
            if node.weight < weight:
                node.weight = weight
                for part in node.parts:
                    if isinstance(part, Constant):
                        left.append(part)
                    else:
                        yield part


class _Reader:
    """Reads expressions of one text. ``known`` holds its constants; a literal that refers to known
    names has its text without them in ``own``."""

    def __init__(self, text: str):
        self.text = text
        self.known: dict[str, Constant] = {}
        self.own: dict[tuple[int, int], str] = {}
        self.open: set[str] = set()  # three quotes that are not closed any more

    def quoted(self, at: int) -> tuple[tuple[int, int], int] | None:
        """The span within the quotes of the literal at ``at``, and its end."""
        text = self.text
        triple = _TRIPLE.match(text, at)
        if triple and triple.group(1) not in self.open:
            end = text.find(triple.group(1), triple.end())
            if end >= 0:
                return (triple.end(), end), end + 3
            self.open.add(triple.group(1))
        found = _QUOTED.match(text, at)
        return (found.span(found.lastindex), found.end()) if found else None

    def parts(self, span: tuple[int, int]) -> list[tuple[int, int] | Constant]:
        """What a quoted literal stands for: constants it refers to, and its own text."""
        inner = self.text[span[0] : span[1]]
        refs = [m for m in _REFERENCE.finditer(inner) if next(filter(None, m.groups())) in self.known]
        out: list[tuple[int, int] | Constant] = [self.known[next(filter(None, m.groups()))] for m in refs]
        ends = [0, *(m.end() for m in refs)]
        rest = "".join(inner[a:b] for a, b in zip(ends, [*(m.start() for m in refs), len(inner)]))
        if rest:
            out.append(span)
            if refs:
                self.own[span] = rest
        return out

    def defaults(self, at: int) -> tuple[list[tuple[int, int] | Constant], int]:
        """The literals after the first argument of the call whose arguments begin at ``at``."""
        out: list[tuple[int, int] | Constant] = []
        first = True
        while True:
            at = _LINES.match(self.text, at).end()
            found = self.quoted(at)
            if not found:
                return out, at
            if not first:
                out += self.parts(found[0])
            at, first = _LINES.match(self.text, found[1]).end(), False
            if self.text[at : at + 1] != ",":
                return out, at
            at += 1

    def operand(self, at: int, bare_too: bool) -> tuple[list[tuple[int, int] | Constant], int] | None:
        """One literal, name or call, and its end."""
        text = self.text
        found = self.quoted(at)
        if found:
            return self.parts(found[0]), found[1]
        bare = _BARE.match(text, at)
        if not bare:
            return None
        word = bare.group()
        plus = word.find("+") if word[0] != "+" and word.partition("+")[0] in self.known else -1
        if plus > 0:
            word = word[:plus]
        end = at + len(word)
        if word.lstrip("$") in self.known:
            return [self.known[word.lstrip("$")]], end
        if text[end : end + 1] == "(":
            if word.rpartition(".")[2].lower() in LOOKUPS:
                return self.defaults(end + 1)
            return [], end
        if text[end : end + 1] == "[" or not bare_too or _DOTTED.fullmatch(word):
            return [], end
        cut = at + len(word.rstrip("."))
        return ([(at, cut)] if cut > at else []), end

    def expression(self, at: int) -> tuple[list[tuple[int, int] | Constant], int]:
        """Literals' spans and constants that the expression at ``at`` stands for, and its end."""
        text, spans = self.text, []
        at = _GAP.match(text, at).end()
        inside = False
        while text[at : at + 1] in ("(", "["):
            at, inside = _LINES.match(text, at + 1).end(), True
        gap = _LINES if inside else _GAP
        while True:
            found = self.operand(at, not inside)
            if not found:
                return spans, at
            spans += found[0]
            after = gap.match(text, found[1]).end()
            sign = text[after : after + 1]
            # Inside brackets, elements of a list and literals side by side follow.
            if sign == "+" or (inside and sign == ","):
                at = gap.match(text, after + 1).end()
            elif inside and after > found[1] and self.quoted(after):
                at = after
            else:
                return spans, found[1] if not inside else after

    def row(self, at: int, n: int) -> tuple[list[list[tuple[int, int] | Constant]], int] | None:
        """``n`` expressions separated by commas, if that is how many there are, and their end."""
        out = []
        while True:
            at = _GAP.match(self.text, at).end()
            spans, end = self.expression(at)
            if not self.quoted(at) and "=" in self.text[at:end]:
                return None  # the next argument's name
            after = _GAP.match(self.text, end).end()
            sign = self.text[after : after + 1]
            out.append(spans)
            if sign == "," and len(out) < n:
                at = after + 1
            else:
                return (out, end) if len(out) == n and sign not in ("=", ",", ":") else None


def _targets(text: str, at: int) -> list[str]:
    """The names of ``a, b = ...`` if the line up to the operator at ``at`` holds nothing else."""
    start = text.rfind("\n", max(0, at - 200), at) + 1
    if not start and at > 200:
        return []
    names = [n.strip(" \t()[]") for n in text[start:at].split(",")]
    return names if len(names) > 1 and all(_NAMES.fullmatch(n) for n in names) else []


def named_literals(text: str) -> list[tuple[int, int, str, float]]:
    """Spans of literals assigned to sensitive names, with name and score."""
    low = text.lower()
    if not any(h in low for h in _HINTS):
        return []
    reader = _Reader(text)
    found: dict[tuple[int, int], tuple[str, float]] = {}
    done = 0
    for operator in _OPERATOR.finditer(text):
        if operator.start() < done:
            continue  # inside an expression that was read
        sign, end = operator.group(), operator.end()
        pairs: list[tuple[str, list]] = []
        if sign == "</":  # <name>literal</name>
            close = _NAME.match(text, end)
            start = text.rfind(">", done, operator.start()) + 1
            tag = f"<{close.group()}>" if close else None
            done = end
            if tag and start and text.startswith(tag, start - len(tag)):
                pairs = [(close.group(), [(start, operator.start())])]
        elif operator.lastindex:  # #define NAME literal, setName(literal)
            spans, done = reader.expression(end)
            pairs = [(operator.group(operator.lastindex), spans)]
        else:
            name = _target(text, operator.start())
            if not name:
                continue
            names = _targets(text, operator.start()) if sign in ("=", ":=") else []
            row = reader.row(end, len(names)) if names else None
            if row:
                pairs, done = list(zip(names, row[0])), row[1]
            else:
                typed = _TYPED.match(text, end) if sign == ":" else None
                spans, done = reader.expression(typed.end() if typed else end)
                if typed:  # a word with a digit may be no type: it stays a literal
                    word, _ = reader.expression(end)
                    spans = [s for s in word if isinstance(s, tuple) and s[1] <= typed.end() and any(map(str.isdigit, text[s[0] : s[1]]))] + spans
                pairs = [(name, spans)]
        for name, spans in pairs:
            if not spans:
                continue
            reader.known[name] = constant = Constant(spans)
            weight = name_score(name)
            for span in constant.resolve(weight):
                score = weight * literal_score(reader.own.get(span) or text[span[0] : span[1]])
                if score >= THRESHOLD and score > found.get(span, ("", 0.0))[1]:
                    found[span] = name, score
    return [(*span, name, score) for span, (name, score) in found.items()]


def scan(text: str | None) -> list[tuple[str, int, int, str | None, float]]:
    """All spans (kind, start, end, name, score) of a text, by start, then kind."""
    text = text or ""
    low = text.lower()
    out = []
    if any(w in low for w in ASSIGN_WORDS):
        out += [("assign", *m.span(), m.group(1), 1.0) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [("access", *m.span(), None, 1.0) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [("hex", *m.span(), None, 1.0) for m in HEX.finditer(text)]
    if any(sign in text for sign in ("=", ":", "</", "define", "(")):
        out += [("named", *found) for found in named_literals(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = "array<struct<kind:string,start:long,end:long,name:string,score:double>>"
_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())])
)


def secret_spans(docs: DataFrame, text_col: str = "text") -> Column:
    """A ``SPANS`` column; null and empty texts have none."""

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fields = ["kind", "start", "end", "name", "score"]
        for texts in columns:
            yield pa.array([[dict(zip(fields, s)) for s in scan(t.as_py())] for t in texts], _TYPE)

    return F.arrow_udf(run, SPANS)(column(docs, text_col).cast("string"))


def span_list(spans: Column, kinds: list[str] | None = None) -> Column:
    """``kind:start:end`` of spans, comma-joined; ``kinds``: of those only."""
    if kinds:
        spans = F.filter(spans, lambda s: s["kind"].isin(kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
