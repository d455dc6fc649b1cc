"""Operator 12 - secret scans by assignment-aware lexing.

Three plain kinds are found by pattern in every text: ``assign`` (a sensitive
word, ``:`` or ``=``, a value), ``access`` (access key ids) and ``hex`` (long
hex runs).  The fourth, ``literal``, is found by reading: a text in which a
sensitive name stands before an assignment is cut into tokens (strings, names,
variables, operators, comments; ``lexed``), the tokens into bindings of names
to expressions (``bindings``) as source code and configuration files write them:

    name = "v"   name: str = "v"   cfg["name"] = "v"   "name": "v"   name => "v"
    name := 'v'  f(name="v")  <name>v</name>  NAME=v  name: v  -Dname=v  "a" + "b"

Constants are propagated: a binding to another name, ``$NAME`` or ``${NAME}`` has
the literals that name was bound to before (else first after), through any
number of steps.  A binding's literals score by its target: the sensitivity of
the name's parts times how much the value looks like a secret (length, digits,
character classes, entropy; no placeholders, no sentences).  From ``MIN_SCORE``
on every literal part is reported by its own span, without quotes, unless a
plain span covers it.

Spans are code points, the end exclusive.  Defined results: null and empty texts
have no spans; repeated rows repeat; a span found through several targets is
reported once, with the highest score; a cyclic definition has no literals;
texts are read whole, long ones too; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, prepare

KINDS = ("assign", "access", "hex", "literal")
MIN_VALUE = 6
MIN_SCORE = 0.5
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.ASCII | re.IGNORECASE)
# the lengths asked for are those of whole runs, so they can be part of the pattern
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_STEMS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Parts of names that say "secret" alone, those that need company, and those that speak against it.
STRONG = {"password", "passwd", "pwd", "passphrase", "passcode", "secret", "token", "apikey", "credential", "credentials",
          "privatekey", "secretkey", "accesskey"}
KEY_OWNERS = {"api", "access", "private", "secret", "signing", "encryption", "auth", "client", "service", "master", "ssh"}
WEAK = {"auth": 0.6, "bearer": 0.7, "key": 0.5, "salt": 0.6, "pin": 0.5, "cookie": 0.5}
AGAINST = {"hash", "field", "label", "name", "prompt", "hint", "url", "uri", "path", "file", "type", "length", "min", "max",
           "expiry", "expires", "count", "limit", "regex", "pattern", "policy", "public", "error", "message", "help",
           "placeholder", "title", "description", "example"}
PLACEHOLDERS = re.compile(r"(?i)change.?me|example|your[_\- ]|placeholder|dummy|todo|redacted|^<.*>$|^\$?\{.*\}$|^(.)\1*$"
                          r"|^(?:null|none|true|false|undefined|password|secret|token|string|required|optional)$")
_STEMS = (b"pass", b"pwd", b"secret", b"token", b"key", b"credential", b"auth", b"bearer", b"salt", b"cookie")
#: A sensitive stem shortly before an assignment: only such texts are lexed.
_SITE = re.compile(rb"(?:pass|pwd|secret|token|key|credential|auth|bearer|salt|cookie)[\w.-]{0,64}[\"'`\])]{0,4}\s{0,64}"
                   rb"(?::|=|<-|>)")
_TOKEN = re.compile(r"""
  (?P<string>\"\"\"(?:\\.|[^\\])*?\"\"\"|'''(?:\\.|[^\\])*?'''|"(?:\\.|[^"\\\n])*"|(?<!\w)'(?:\\.|[^'\\\n])*'|`(?:\\.|[^`\\\n])*`)
 |(?P<element><(?P<tag>[A-Za-z_][\w.:-]*)>(?P<inner>[^<>\n]*)</(?P=tag)>)
 |(?P<variable>\$\{[A-Za-z_][\w.]*\}|\$[A-Za-z_]\w*|%[A-Za-z_]\w*%)
 |(?P<name>[^\W\d][\w-]*(?:(?:\.|::|->)[^\W\d][\w-]*)*)
 |(?P<op>:=|=>|<-|===?|!==?|<=|>=|\+=|&&|\|\||[=:+,;()\[\]{}.<>?])
 |(?P<line>\n)
 |(?P<bare>[^\s"'`=:+,;()\[\]{}<>?]+)
""", re.X)
_PLAIN_VALUE = re.compile(r"[^\s\"'`,;(){}\[\]<>$]+")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the three plain kinds, in reported order."""
    low = text.encode("utf-8", "surrogatepass").lower()
    out = []
    if any(s in low for s in _ASSIGN_STEMS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if b"akia" in low:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def may_bind_secret(text: str) -> bool:
    low = text.encode("utf-8", "surrogatepass").lower()
    return any(s in low for s in _STEMS) and _SITE.search(low) is not None


class Token:
    __slots__ = ("kind", "text", "start", "end")

    def __init__(self, kind, text, start, end):
        self.kind, self.text, self.start, self.end = kind, text, start, end


def lexed(text: str) -> list[Token]:
    """Tokens of a text; a string's span and text are its content without quotes."""
    out = []
    for m in _TOKEN.finditer(text):
        kind = m.lastgroup
        if kind in ("tag", "inner"):
            kind = "element"
        s, e = m.span()
        if kind == "element":  # read as a binding of the tag's name
            out += [Token("name", m["tag"], s, s), Token("op", "=", s, s), Token("string", m["inner"], *m.span("inner")),
                    Token("op", ";", e, e)]
            continue
        if kind == "string":
            q = 3 if text[s:s + 3] in ('"""', "'''") and e - s >= 6 else 1
            s, e = s + q, e - q
        elif kind == "variable":
            out.append(Token("name", m[0].strip("${}%"), s, e))
            continue
        out.append(Token(kind, text[s:e], s, e))
    return out


class Binding:
    """A target name, where it is bound, and the items of its value: ("literal",
    start, end) spans and ("name", name) references."""

    __slots__ = ("name", "at", "items")

    def __init__(self, name, at, items):
        self.name, self.at, self.items = name, at, items


def _target(tokens: list[Token], i: int) -> str | None:
    """The name that ends before token ``i``, the operator."""
    j = i - 1
    if j < 0:
        return None
    t = tokens[j]
    if t.text == "]" and j >= 2 and tokens[j - 1].kind in ("string", "name") and tokens[j - 2].text == "[":
        return tokens[j - 1].text  # cfg["name"] = ...
    if t.kind == "name":
        # name: str = "v" - the annotation is not the target
        if tokens[i].text == "=" and j >= 2 and tokens[j - 1].text == ":" and tokens[j - 2].kind == "name":
            return tokens[j - 2].text
        return t.text
    return t.text if t.kind == "string" and "\n" not in t.text else None


def _value(text: str, tokens: list[Token], i: int) -> list[tuple]:
    """Items of the expression after the operator at token ``i``."""
    items, j, joined = [], i + 1, True
    while j < len(tokens) and tokens[j].kind == "line" and tokens[i].text in (":", "=>"):
        j += 1  # a value on the next line
    first = tokens[j] if j < len(tokens) else None
    if first is None:
        return items
    if first.kind in ("name", "bare"):
        # an unquoted value of a configuration line: one run up to the end of the line
        run = _PLAIN_VALUE.match(text, first.start)
        rest = text[run.end():text.find("\n", run.end()) if text.find("\n", run.end()) >= 0 else len(text)] if run else "x"
        if run and (not rest.strip() or rest.lstrip()[:1] in "#;") and not text.startswith("$", first.start):
            items.append(("name", first.text, run.start(), run.end()) if run.end() == first.end and first.kind == "name"
                         else ("literal", run.start(), run.end()))
            return items
    while j < len(tokens):
        t = tokens[j]
        if t.kind == "string" and (joined or items):
            items.append(("literal", t.start, t.end))
            joined = False
        elif t.kind == "name" and joined:
            if j + 1 < len(tokens) and tokens[j + 1].text == "(" and tokens[j + 1].start == t.end:
                return []  # a call's result is not a constant
            items.append(("name", t.text, -1, -1))
            joined = False
        elif t.text in ("+", ".") and not joined:
            joined = True
        elif t.kind == "line" and joined and items:
            pass  # "a" + <line> "b"
        else:
            break
        j += 1
    return items


def bindings(text: str, tokens: list[Token]) -> list[Binding]:
    out = []
    for i, t in enumerate(tokens):
        if t.kind == "op" and t.text in ("=", ":", ":=", "=>", "<-", "+="):
            name = _target(tokens, i)
            if name:
                items = _value(text, tokens, i)
                if items:
                    out.append(Binding(name, t.start, items))
    return out


def _known_as(name: str) -> str:
    return re.sub(r"^(?:self|this|process\.env|env|os\.environ)(?:\.|->)", "", name)


def literals_of(binding: Binding, defined: dict[str, list[Binding]], seen: frozenset = frozenset()) -> list[tuple[int, int]]:
    """Literal spans of a binding, names replaced by what they were bound to."""
    out = []
    for item in binding.items:
        if item[0] == "literal":
            out.append(item[1:3])
            continue
        _, name, start, end = item
        options = [b for b in defined.get(_known_as(name), ()) if id(b) not in seen and b is not binding]
        if options:
            before = [b for b in options if b.at < binding.at]
            out += literals_of(before[-1] if before else options[0], defined, seen | {id(binding)})
        elif start >= 0 and any(c.isdigit() for c in name):  # NAME=value: not a name, an unquoted value
            out.append((start, end))
    return out


def name_score(name: str) -> float:
    """How sensitive a target name is, from 0 to 1."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    score = 0.0
    for i, p in enumerate(parts):
        if p in STRONG:
            score = 1.0
        elif p == "key" and i and parts[i - 1] in KEY_OWNERS:
            score = 1.0
        else:
            score = max(score, WEAK.get(p, 0.0))
    return 0.0 if parts and parts[-1] in AGAINST else score


def value_score(value: str) -> float:
    """How much a value looks like a secret, from 0 to 1."""
    if len(value) < MIN_VALUE or PLACEHOLDERS.search(value):
        return 0.0
    classes = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    score = 0.4 + 0.2 * any(map(str.isdigit, value)) + 0.2 * (classes >= 3) + 0.2 * (entropy >= 3)
    return score - (0.6 if any(map(str.isspace, value)) else 0)


def literal_spans(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, target name, score) of the literals bound to sensitive names."""
    if not may_bind_secret(text):
        return []
    found = bindings(text, lexed(text))
    defined: dict[str, list[Binding]] = {}
    for b in found:
        defined.setdefault(_known_as(b.name), []).append(b)
    best: dict[tuple[int, int], tuple[str, float]] = {}
    for b in found:
        sensitive = name_score(b.name)
        if not sensitive:
            continue
        spans = literals_of(b, defined)
        score = sensitive * value_score("".join(text[s:e] for s, e in spans))
        if score >= MIN_SCORE:
            for span in spans:
                if span[0] < span[1] and score > best.get(span, ("", 0.0))[1]:
                    best[span] = b.name, score
    return [(s, e, n, x) for (s, e), (n, x) in sorted(best.items())]


def all_spans(text: str | None) -> list[tuple[str, int, int, str | None, float | None]]:
    """(kind, start, end, target, score) in reported order."""
    text = text or ""
    plain = plain_spans(text)
    out = [(s, k, e, None, None) for s, k, e in plain]
    for s, e, name, score in literal_spans(text):
        if not any(a <= s and e <= b for a, _, b in plain):
            out.append((s, 3, e, name, score))
    return [(KINDS[k], s, e, n, x) for s, k, e, n, x in sorted(out, key=lambda x: x[:3])]


SPANS = "array<struct<kind string, start int, end int, target string, score double>>"


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans`` of every document: kind, start, end and, for literals, target name and score."""
    prepare(docs.sparkSession)

    @F.pandas_udf(SPANS)
    def scan(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("kind", "start", "end", "target", "score"), s)) for s in all_spans(t)] for t in texts],
                         dtype=object)

    return docs.select("doc_id", scan("text").alias("spans"))


def op12_secret_scan(spark, sf_dir):
    found = secret_spans(documents(spark, sf_dir).select("doc_id", "text"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda x: x.kind == kind)).cast("long")

    base = F.filter("spans", lambda x: x.kind != "literal")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"), count("literal").alias("n_literal"))
