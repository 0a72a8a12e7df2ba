"""Secrets in texts: fixed patterns, and literals assigned to sensitive names."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import small_batches, text_or_empty, without

KINDS = ["assign", "access", "hex", "literal"]
#: Base patterns. Fixed values.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
#: What a text in which ``ASSIGN`` matches has in lower case.
ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")
#: Sensitive parts of names and their weights. Fixed values.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 0.95, "token": 0.9,
    "apikey": 0.95, "api_key": 0.95, "private_key": 1.0, "access_key": 0.95, "credential": 0.85,
    "client_key": 0.8, "auth_key": 0.9, "encryption_key": 0.9, "signing_key": 0.9,
}
#: Values that stand for one to be filled in. Fixed values.
PLACEHOLDERS = re.compile(r"(?i)^(your|my|the|some)?[_-]?(example|sample|dummy|test|changeme|change_me|placeholder|"
                          r"redacted|none|null|true|false|todo|insert)|^[xX*.]+$|^<.*>$|^\$\{?.*\}?$|^%.*%$|^\{\{.*\}\}$")
LEAST_SCORE = 0.5

#: Possessive repeats and escapes as tokens of their own: no character is looked at more than a
#: few times, whatever the text. An apostrophe inside a word opens no string.
_TOKEN = re.compile(r"""
    (?P<comment>(?:\#|//)[^\n]*+)
  | (?P<string>(?:(?<![A-Za-z0-9_$])[fFrRbBuU]{1,2})?+(?:
        \"\"\"(?:[^"\\]|\\.|"(?!\"\"))*+\"\"\" | '''(?:[^'\\]|\\.|'(?!''))*+'''
      | "(?:[^"\\\n]|\\.)*+" | (?<![A-Za-z0-9])'(?:[^'\\\n]|\\.)*+' | (?<=[fFrRbBuU])'(?:[^'\\\n]|\\.)*+'
      | `(?:[^`\\\n]|\\.)*+`))
  | (?P<escape>\\.)
  | (?P<name>[A-Za-z_$][A-Za-z0-9_$]*+(?:[.-][A-Za-z_$][A-Za-z0-9_$]*+)*+)
  | (?P<op>:=|=>|==+|!=|<=|>=|[=:+])
  | (?P<line>\n)
  | (?P<space>[^\S\n]++)
  | (?P<other>.)
""", re.VERBOSE | re.ASCII | re.DOTALL)
#: An unquoted value of a configuration line, to the end of its line.
_BARE = re.compile(r"[A-Za-z0-9+/_.=@!$%^&*~-]+(?=[ \t]*(?:\n|\Z|[#;,]))", re.ASCII)


def name_weight(name: str) -> float:
    """The weight of the most sensitive part of a name, in snake, kebab or camel case."""
    flat = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower().replace("-", "_").replace(".", "_")
    return max((w for part, w in NAME_WEIGHTS.items() if part in flat), default=0.0)


def literal_weight(value: str) -> float:
    """How much a value looks like a credential: length, mixture and unevenness of characters."""
    if len(value) < 8 or PLACEHOLDERS.search(value):
        return 0.0
    if any(c.isspace() for c in value):
        return 0.3
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())
    kinds = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit)) + (not value.isalnum())
    return min(1.0, 0.25 + 0.15 * kinds + 0.1 * bits)


#: Characters and literals of one constant; a name with more is none, as no credential is so long.
LONGEST, MOST_PLACES = 4096, 64
#: Tokens of a type that may stand between a name's colon and its equals sign.
TYPE_TOKENS = 12


class _Value:
    """Text of a constant and the places of the literals that it was made from, each once."""

    def __init__(self, text: str, places: tuple[tuple[int, int], ...]):
        self.text, self.places = text, places

    def joined(self, other: _Value) -> _Value | None:
        """Both, one after the other; nothing if that is longer than any constant may be."""
        places = tuple(dict.fromkeys(self.places + other.places))
        if len(self.text) + len(other.text) > LONGEST or len(places) > MOST_PLACES:
            return None
        return _Value(self.text + other.text, places)


class _Lexed:
    """Tokens of a text, and what its assignments say of names so far."""

    def __init__(self, text: str):
        self.text = text
        self.tokens = [(m.lastgroup, m.start(), m.end()) for m in _TOKEN.finditer(text)
                       if m.lastgroup not in ("space", "comment")]
        self.known: dict[str, _Value] = {}

    def shown(self, i: int) -> str:
        return self.text[self.tokens[i][1]: self.tokens[i][2]] if 0 <= i < len(self.tokens) else ""

    def kind(self, i: int) -> str:
        return self.tokens[i][0] if 0 <= i < len(self.tokens) else ""

    def inside(self, i: int) -> tuple[int, int]:
        """Place of what stands between a string's quotes."""
        _, start, end = self.tokens[i]
        while self.text[start] not in "\"'`":
            start += 1
        n = 3 if self.text.startswith(('"""', "'''"), start) and end - start >= 6 else 1
        return start + n, end - n

    def names_before(self, i: int) -> list[str]:
        """Names that the operator at ``i`` may assign to: the nearest first."""
        kind = self.kind(i - 1)
        if kind == "string":
            a, b = self.inside(i - 1)
            return [self.text[a:b]]
        if self.shown(i - 1) == "]":  # a["name"] = …
            if self.shown(i - 3) != "[":
                return []
            if self.kind(i - 2) == "string":
                a, b = self.inside(i - 2)
                return [self.text[a:b]]
            return [self.shown(i - 2)] if self.kind(i - 2) == "name" else []
        if kind != "name":
            return []
        # String name = …, or name string = …
        return [self.shown(k) for k in (i - 1, i - 2) if self.kind(k) == "name"]

    def after_type(self, i: int) -> int:
        """The equals sign that ends the type which begins at ``i``, or -1."""
        for j in range(i, min(i + TYPE_TOKENS, len(self.tokens))):
            shown = self.shown(j)
            if shown == "=":
                return j if j > i else -1
            if self.kind(j) != "name" and shown not in ("[", "]", ",", "|", "."):
                return -1
        return -1

    def operand(self, i: int) -> _Value | None:
        kind = self.kind(i)
        if kind == "string":
            a, b = self.inside(i)
            return _Value(self.text[a:b], ((a, b),))
        return self.known.get(self.shown(i)) if kind == "name" else None

    def value_at(self, i: int) -> tuple[_Value | None, int]:
        """The value whose tokens begin at ``i``, and the token behind it."""
        j = i
        while self.shown(j) == "(":
            j += 1
        value = self.operand(j)
        if value is not None:
            j += 1
            while self.shown(j) == "+" and (more := self.operand(j + 1)) is not None:
                value, j = value and value.joined(more), j + 2
            if self.shown(j) == "+":  # something that isn't known follows
                value = None
            return value, j
        # A bare word to the end of its line.
        if j < len(self.tokens) and self.kind(j) in ("name", "other") and (bare := _BARE.match(self.text, self.tokens[j][1])):
            while j < len(self.tokens) and self.tokens[j][1] < bare.end():
                j += 1
            return _Value(bare[0], (bare.span(),)), j
        return None, i


def assigned_literals(text: str) -> Iterator[tuple[int, int, float]]:
    """(start, end, score) of literals that reach a sensitive name.

    Names followed by ``=``, ``:``, ``:=`` or ``=>`` take the value on the right: strings and
    names joined by ``+``, in brackets or not, or a bare word to the end of its line. A type may
    stand before the name, behind it, or between its colon and equals sign, and the name may be a
    quoted key or a subscript; of several names the most sensitive counts. A name whose value is
    known is a constant, and passes it on, with the places of the literals it came from, to the
    names it is assigned to; it is forgotten when something else is assigned to it. Comments are
    skipped. Time and memory grow with the text's length only.
    """
    lexed = _Lexed(text)
    i = 1
    while i + 1 < len(lexed.tokens):
        op = lexed.shown(i) if lexed.kind(i) == "op" else ""
        names = lexed.names_before(i) if op in ("=", ":", ":=", "=>") else []
        if not names:
            i += 1
            continue
        begin = i + 1
        if op == ":" and (equals := lexed.after_type(begin)) > 0:
            names = [*names[:1], lexed.shown(equals - 1)]
            begin = equals + 1
        name = max(names, key=name_weight)
        value, behind = lexed.value_at(begin)
        if value is None:
            lexed.known.pop(name, None)
            i += 1
            continue
        lexed.known[name] = value
        score = name_weight(name) * literal_weight(value.text)
        if score >= LEAST_SCORE:
            for a, b in value.places:
                yield a, b, score
        i = max(behind, i + 1)


def find_secrets(text: str) -> list[tuple[int, int, str, float]]:
    """All spans of a text as (start, end, kind, score), sorted by start, then by kind."""
    low = text.lower()
    found = []
    if any(h in low for h in ASSIGN_HINTS):
        found += [(*m.span(), "assign", 1.0) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(*m.span(), "access", 1.0) for m in ACCESS.finditer(text)]
    found += [(*m.span(), "hex", 1.0) for m in HEX.finditer(text)]
    # As in name_weight: a text is skipped only if none of its names can have a weight.
    flat = low.replace("-", "_").replace(".", "_")
    if any(p in flat or p.replace("_", "") in flat for p in NAME_WEIGHTS):
        best: dict[tuple[int, int], float] = {}
        for a, b, score in assigned_literals(text):
            best[a, b] = max(score, best.get((a, b), 0.0))
        found += [(a, b, "literal", s) for (a, b), s in best.items()]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def secret_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``secrets``: array of (kind, start, end, score), places in code points, end exclusive.

    Kinds ``assign``, ``access`` and ``hex`` are the base patterns, leftmost and without overlap
    within their kind; ``literal`` spans are values that an assignment, directly or by constants,
    gives to a sensitive name. No shuffle; every text is scanned whole.

    Cases: a null or empty text has no spans; repeated rows stay; an empty table gives an empty
    one; other columns stay, and a column called secrets is replaced.
    """
    small_batches(docs.sparkSession)
    kind = "array<struct<kind:string,start:long,end:long,score:double>>"
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    @F.arrow_udf(kind)
    def scan(texts: pa.Array) -> pa.Array:
        return pa.array([[{"kind": k, "start": a, "end": b, "score": s} for a, b, k, s in find_secrets(t)]
                         for t in texts.to_pylist()], arrow)

    return without(docs, "secrets").withColumn("secrets", scan(text_or_empty(text)))


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
