"""Secrets by patterns and by assignments to names that tell of a secret.

Three patterns give the base spans. Beside them, texts that mention a sensitive name are
read as source or configuration: statements ``name = value`` in the forms of programming
languages, ``.env``, INI, YAML, JSON, shell options and XML give pairs of a name and
literals. A name that is given a literal keeps it, so that ``k = "..."; password = k`` and
``password = a + b`` lead to the literals; giving the name something else forgets it. Each
pair is scored by its name's words and by what its literal looks like, and literals that
reach the threshold and that no base span covers are added as spans of kind ``literal``.

Texts are scanned where they are, in Arrow batches; nothing is shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "literal")
THRESHOLD = 5.0

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")

#: What a word in a target's name says about its value.
NAME_WEIGHTS = {
    "password": 4, "passwd": 4, "passphrase": 4, "pwd": 4, "passcode": 4, "pass": 3,
    "secret": 4, "secrets": 4, "credential": 4, "credentials": 4, "cred": 3, "creds": 3,
    "token": 4, "apikey": 4, "authkey": 4, "privatekey": 4, "secretkey": 4, "accesskey": 4,
    "bearer": 3, "auth": 2, "private": 2, "api": 2, "access": 1, "signing": 2, "encryption": 2,
    "master": 1, "key": 2, "salt": 2,
    "public": -4, "pub": -3, "path": -3, "file": -3, "filename": -4, "dir": -3, "url": -3, "uri": -3,
    "name": -3, "id": -2, "type": -3, "length": -4, "len": -4, "size": -3, "count": -4, "max": -2,
    "min": -2, "limit": -3, "regex": -3, "pattern": -3, "prompt": -3, "label": -3, "hint": -3,
    "field": -3, "expires": -4, "expiry": -4, "ttl": -4, "header": -2, "prefix": -2, "policy": -3,
}
#: A name of weight 3 or more has one of these in it.
_SENSITIVE = ("pass", "pwd", "secret", "cred", "token", "bearer", "key", "auth", "private", "api", "sign", "encrypt", "salt")
#: Words in a literal that mark a sample or a place to fill in.
PLACEHOLDERS = ("example", "changeme", "change_me", "placeholder", "your", "insert", "dummy", "sample", "todo", "none", "null", "undefined", "xxxx", "****", "redacted")

_TARGET = re.compile(
    r"""(?<![\w$.\-])                                   # at the beginning of a name
    (?:--)?+(?P<name>[A-Za-z_$][\w$]*+                  # a name, with members, keys and indexes
        (?:(?:\.|->|::|-)[\w$]++|\[[\x20]?["']?[\w.\-]++["']?[\x20]?\])*+)
    ["']?+[\x20\t]*+
    (?::[\x20\t]*+[A-Za-z_][\w.<>\[\]|]*+[\x20\t]*+(?==[^=]))?+  # a declared type
    (?::=|=>|=(?![=~>])|:(?![:/=]))[\x20\t]*+
    (?P<value>(?=[^\s])) """,
    re.X,
)
_ELEMENT = re.compile(r"<(?P<name>[A-Za-z_][\w.:\-]*+)>(?P<literal>[^<>\n]++)</(?P=name)>")
_TERM = re.compile(
    r"""[rbufRBUF]{0,2}"(?P<double>(?:[^"\\\n]|\\.)*+)"
    | [rbufRBUF]{0,2}'(?P<single>(?:[^'\\\n]|\\.)*+)'
    | `(?P<back>[^`\n]*+)`
    | \$\{?(?P<shell>\w++)\}?
    | %(?P<percent>\w++)%
    | (?P<bare>[^\s"'`,;#(){}\[\]<>+]++(?:\+[^\s"'`,;#(){}\[\]<>+]++)*+)""",
    re.X,
)
_JOIN = re.compile(r"[\x20\t]*+\+[\x20\t]*+")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three patterns, leftmost without overlap in each kind."""
    out, lower = [], text.lower()
    if any(w in lower for w in ("passw", "secret", "token", "apikey", "api_key")):
        out += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    return out + [(*m.span(), "hex") for m in _HEX.finditer(text)]


def name_score(name: str) -> float:
    """How much a target's name tells of a secret: the sum of its words' weights.

    Names are split at signs and at capitals; the last member of a path weighs fully,
    those before it a quarter.
    """
    members = [m for m in re.split(r"\.|->|::|\[", name) if m]
    total = 0.0
    for place, member in enumerate(reversed(members)):
        weight = sum(NAME_WEIGHTS.get(w.lower(), 0) for w in _WORD.findall(member))
        total += weight if place == 0 else max(0, weight) / 4
    return total


def literal_score(literal: str, quoted: bool) -> float:
    """How much a literal looks like a secret: its length, alphabet and spread of signs."""
    lower = literal.lower()
    if len(literal) < 6 or any(p in lower for p in PLACEHOLDERS) or re.search(r"[{}<>$\s]|://", literal):
        return -math.inf
    kinds = sum(bool(re.search(p, literal)) for p in (r"[a-z]", r"[A-Z]", r"[0-9]", r"[^A-Za-z0-9]"))
    if not quoted and kinds < 2 or re.fullmatch(r"[\w]+(\.[A-Za-z_]\w*)+", literal):
        return -math.inf
    counts = Counter(literal)
    spread = -sum(n / len(literal) * math.log2(n / len(literal)) for n in counts.values())
    if spread < 2.0:
        return -math.inf
    return min(2.0, len(literal) / 10) + (kinds - 1) * 0.5 + (spread - 2.5)


def pairs(text: str) -> list[tuple[str, list[tuple[int, int, bool]]]]:
    """(name, literals) per assignment in order; a literal is (start, end, quoted).

    Literals come from the statement itself or from the names it uses.
    """
    known: dict[str, list[tuple[int, int, bool]]] = {}
    out = []
    statements = list(_TARGET.finditer(text))
    if "</" in text:
        statements = sorted([*statements, *_ELEMENT.finditer(text)], key=lambda m: m.start())
    for found in statements:
        name = found["name"]
        if found.re is _ELEMENT:
            out.append((name, [(*found.span("literal"), False)]))
            continue
        at, literals, whole = found.end(), [], True
        while True:
            term = _TERM.match(text, at)
            if term is None:
                whole = whole and bool(literals)
                break
            at = term.end()
            kind = term.lastgroup
            if kind in ("shell", "percent") or kind == "bare" and term["bare"] in known:
                literals += known.get(term[kind], [])
            elif kind == "bare":
                if text[at : at + 1] in ("(", "[", "{"):
                    whole = False
                    break
                literals.append((term.start(), at - len(term["bare"]) + len(term["bare"].rstrip(".")), False))
            else:
                literals.append((*term.span(kind), True))
            more = _JOIN.match(text, at)
            if more is None:
                break
            at = more.end()
        if whole and literals:
            known[name] = literals
            out.append((name, literals))
        else:
            known.pop(name, None)
    return out


def literal_spans(text: str) -> list[tuple[int, int]]:
    """Spans of literals that are given to sensitive names, each once."""
    lower = text.lower()
    if not any(w in lower for w in _SENSITIVE) or not ("=" in text or ":" in text or "</" in text):
        return []
    found = set()
    for name, literals in pairs(text):
        weight = name_score(name)
        if weight < 3:
            continue
        whole = "".join(text[a:b] for a, b, _ in literals)
        if weight + literal_score(whole, all(q for _, _, q in literals)) >= THRESHOLD:
            found.update((a, b) for a, b, _ in literals if b > a)
    return sorted(found)


def spans(text: str) -> list[tuple[int, int, str]]:
    """All spans of a text by start, then kind: the base ones and literals none of them covers."""
    base = base_spans(text)
    extra = [(a, b, "literal") for a, b in literal_spans(text) if not any(s <= a and b <= e for s, e, _ in base)]
    return sorted(base + extra, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ``spans``, an array of (kind, start, end).

    ``start`` and ``end`` count code points, the end is exclusive. Null and empty texts have
    no spans. Ids may be null or repeat, every row is returned. Other columns are ignored.
    """
    struct = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def work(batches):
        for batch in batches:
            found = []
            for text in batch.column(1):
                found.append([{"kind": k, "start": a, "end": b} for a, b, k in spans(text.as_py() or "")])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(struct))], [id_col, "spans"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return rows.mapInArrow(work, f"{id_col} {docs.schema[id_col].dataType.simpleString()}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def joined(found: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
