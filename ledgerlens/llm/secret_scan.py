"""Secrets in text: three fixed patterns, and literals that source or configuration syntax assigns to sensitive names.

The lexer reads ``name = literal`` pairs of the usual syntaxes (``=``, ``:``, ``:=``, ``=>``; a type beside the name;
quoted literals with or without a prefix and bare ones, also on the next line; literals and names joined by ``+``). A name
given as a value stands for the literal it was last assigned, so a constant that later reaches a sensitive name marks the
literal itself. A literal counts when the words of its name and its own make-up
score at least SCORE together.

Defined cases: null and empty texts have no spans; repeated rows are scanned each for itself; spans are code points,
end exclusive; a lexed literal is not listed again where a pattern's span holds all of it. Output columns replace input
columns of the same name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.batches import kept as kept_tables
from ledgerlens.llm.batches import trim

SPANS = T.ArrayType(
    T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType())])
)
KINDS = ["assign", "access", "hex", "lexed"]

# The three patterns and their least lengths.
ASSIGN = re.compile(r"""(?a:(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of [0-9a-f]+ is as long as it can be, so short runs can be passed over at once
LEAST = {"assign": 8, "access": 16}

OPERATOR = re.compile(r"=>|:=|(?<![=!<>:])=(?![=~])|(?<!:):(?![:/=])")
NAME = re.compile(r"""([A-Za-z_$][\w$.\-]*)["'\]]?[ \t]*\Z""")
# A type between name and operator: ``name: type =`` of most languages, ``name string =`` and ``name As String =``.
ATOM = r"""[&*]?(?:'\w+[ \t]+)?(?:mut[ \t]+)?[A-Za-z_][\w.]*(?:::\w+)*(?>[\[<](?:[^\n=;:]|::)*[\]>])?[?!*]?(?:\[\])?"""
TYPED = re.compile(rf"""(?<![A-Za-z_$])([A-Za-z_$][\w$.\-]*+)(?:["'\]]?[?!]?[ \t]*:[ \t]*{ATOM}(?:[ \t]*\|[ \t]*{ATOM})*|[ \t]+(?:As[ \t]+)?[Ss]tring)[ \t]*\Z""")
# Groups: prefix; contents in each kind of quotes; a bare literal. One line break may stand before it.
LITERAL = re.compile(
    r"""[ \t]*+(?:(?:\([ \t]*+)?\\?\r?\n[ \t]*+)?"""
    r"""(?:(b?r\#+|u8|[bBrRuUfFL]{1,2}|[@$]{1,2})?(?:"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)')|`([^`\n]*)`|([^\s"'`,;(){}\[\]<>#]+))"""
)
BARE = 5
HOLE = re.compile(r"\{[^{}]*\}")  # of an interpolated literal; what it holds is not part of the literal
KEY = re.compile(r"[ \t]*(?:=>|[:=])")
LINE_END = re.compile(r"[ \t]*(?:\r?\n|\Z)")
JOIN = re.compile(r"""[ \t]*(?:\\?\r?\n[ \t]+)?\+(?![+=])""")
TYPE_NAMES = {"str", "string", "String", "bytes", "char", "text", "Text", "any", "Any", "object", "Object"}
ONLY_NAME = re.compile(r"[A-Za-z_$][\w$.\-]*")
NAME_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
LONGEST_NAME = 200
SLICE_ROWS = 500  # of a batch that are worked on and passed on at a time

# Words of names and how much they tell by themselves.
SENSITIVE = {
    "password": 1.0,
    "passwd": 1.0,
    "passphrase": 1.0,
    "pwd": 1.0,
    "secret": 1.0,
    "token": 0.9,
    "credential": 0.9,
    "credentials": 0.9,
    "apikey": 1.0,
    "pass": 0.7,
    "auth": 0.6,
    "bearer": 0.9,
    "signature": 0.5,
}
KEY_OWNERS = {"api", "access", "private", "signing", "encryption", "auth", "master", "account", "storage", "client", "session"}
PLACEHOLDER = re.compile(r"(?i)changeme|example|placeholder|dummy|your[_-]|xxxx|\*\*\*|\$\{|\{\{|%s|^(?:none|null|true|false|undefined)$")
SCORE = 0.5


def name_score(name: str) -> float:
    """How sensitive a name sounds, 0 to 1: its strongest word, or ``key`` beside an owner such as ``api``."""
    parts = [p.lower() for p in NAME_PART.findall(name)]
    best = max((SENSITIVE.get(p, 0.0) for p in parts), default=0.0)
    if "key" in parts and KEY_OWNERS.intersection(parts):
        best = max(best, 1.0)
    return best


def literal_score(value: str, quoted: bool) -> float:
    """How much a literal looks like a secret, 0 to 1: long, varied, no placeholder; a bare one needs a digit."""
    if len(value) < 8 or PLACEHOLDER.search(value) or any(c.isspace() for c in value):
        return 0.0
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    kinds = sum([any(c.islower() for c in value), any(c.isupper() for c in value), any(c.isdigit() for c in value), not value.isalnum()])
    if not any(c.isdigit() for c in value) and (not quoted or kinds < 2):
        return 0.0
    return min(1.0, entropy / 3.0) * min(1.0, 0.5 + 0.25 * kinds)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def literals(value: tuple) -> list[tuple[int, int, str, bool]]:
    """The literals (start, end, text, quoted) that a value is joined from, in order, each once.

    A value is a tuple of literals and of earlier values, which are shared and not copied.
    """
    out: dict[tuple, None] = {}
    seen, todo = set(), [value]
    while todo:
        part = todo.pop()
        if part and isinstance(part[0], int):
            out[part] = None
        elif id(part) not in seen:
            seen.add(id(part))
            todo.extend(reversed(part))
    return list(out)


def values_at(text: str, at: int, operator: str, constants: dict[str, tuple]) -> list[tuple]:
    """What may stand after an operator, likeliest first: literals and names joined by ``+``, or one bare literal.

    Names that have no literal add nothing. A literal on the next line is none if it is the key of that line; a bare one
    there must follow a colon and fill the line.
    """
    parts: list[tuple] = []
    alone: tuple = ()  # a bare literal at the start, which before a ``+`` may be a name without a literal
    while (m := LITERAL.match(text, at)) is not None:
        group, first, at = m.lastindex, not parts and not alone, m.end()
        start, end, own = m.start(group), m.end(group), m[group]
        lines = "\n" in text[m.start() : start]
        opens = False
        if group != BARE:
            if lines and KEY.match(text, at):
                break
            interpolated = any(c in "fF$" for c in m[1] or "")
            parts.append((start, end, HOLE.sub("", own) if interpolated else own, True))
        else:
            opens = own.endswith("+") and text[end : end + 1] in {'"', "'", "`"}
            names = (own[:-1] if opens else own).split("+")
            if all(n in constants for n in names):
                parts += [constants[n] for n in names]
            else:
                fills = operator == ":" and LINE_END.match(text, end) and not OPERATOR.search(text, start, end - 1) and own[-1] != ":"
                if first and (not lines or fills):
                    alone = (start, end, own, False)
                if not all(ONLY_NAME.fullmatch(n) for n in names):
                    break
                parts += [constants[n] for n in names if n in constants and (opens or len(names) == 1)]
        if not opens:
            joined = JOIN.match(text, at)
            if joined is None:
                break
            at = joined.end()
    return [v for v in (tuple(parts), (alone,)) if v and v[0]]


def lexed_spans(text: str) -> list[tuple[int, int, str]]:
    """Literals that reach a sensitive name, directly or through constants."""
    constants: dict[str, tuple] = {}
    found: set[tuple[int, int]] = set()
    for op in OPERATOR.finditer(text):
        left = max(0, op.start() - LONGEST_NAME)
        name = NAME.search(text, left, op.start()) if op.start() else None
        if name is None and text[op.start() - 1 : op.start()] not in {" ", "\t", ">", "]", "?", "!", "*"}:
            continue
        names = [name[1]] if name else []
        if op[0] == "=":
            typed = TYPED.search(text, max(left, text.rfind("\n", left, op.start()) + 1), op.start())
            names = [typed[1], *[n for n in names if n not in TYPE_NAMES]] if typed else names
        values = values_at(text, op.end(), op[0], constants) if names else []
        if values:
            constants.update(dict.fromkeys(names, values[0]))
        sensitive = max(map(name_score, names), default=0.0)
        for parts in map(literals, values if sensitive else []):
            if sensitive * literal_score("".join(v[2] for v in parts), all(v[3] for v in parts)) >= SCORE:
                found.update((v[0], v[1]) for v in parts if v[1] > v[0])
                break
    return [(a, b, "lexed") for a, b in found]


def spans_of(text: str | None) -> list[tuple[int, int, str]]:
    """All spans (start, end, kind) by start, then kind as listed."""
    if not text:
        return []
    base = base_spans(text)
    more = lexed_spans(text) if "=" in text or ":" in text else []
    base += [s for s in more if not any(b[0] <= s[0] and s[1] <= b[1] for b in base)]
    return sorted(base, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each stretch that overlapping spans cover replaced by the kind of the span that opens it."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, text: str = "text", redact: bool = False, name: str = "spans") -> DataFrame:
    """``docs`` with the spans, an array of (start, end, kind), as column ``name``. ``redact``: the text without them."""
    kept = [c for c in docs.columns if c != name]
    schema = docs.select(*[f"`{c}`" for c in kept]).schema.add(name, SPANS)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_tables("secrets")
        for batch in (whole.slice(at, SLICE_ROWS) for whole in batches for at in range(0, whole.num_rows, SLICE_ROWS)):
            texts = batch.column(text).to_pylist()
            found = [spans_of(t) for t in texts]
            columns = {c: batch.column(c) for c in kept}
            if redact:
                columns[text] = pa.array([redacted(t, s) if s else t for t, s in zip(texts, found, strict=True)], columns[text].type)
            columns[name] = pa.array([[dict(zip(("start", "end", "kind"), s, strict=True)) for s in x] for x in found], kind)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
        trim()

    return docs.mapInArrow(run, schema)


def span_texts(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
