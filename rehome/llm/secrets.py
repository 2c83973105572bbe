"""Secret scan by assignment-aware lexing.

Three base kinds are plain patterns.  The lexer adds ``lexed`` spans: it
parses source and configuration syntax (``name = "literal"``, ``"name":
"literal"``, ``name: literal``, ``name: type = "literal"``,
``<name>literal</name>``) into name-literal pairs, propagates constants
(``x = "..."; password = x`` makes ``password`` a target name of the literal)
and scores each literal by the most sensitive of its target names and by its
own look.  A quoted literal may stand in backticks and on the line after the
operator; one of several words counts under a name that ends in password or
passphrase.  Literals that overlap a base span are not reported twice.

Edge cases.  Null text is empty and has no spans; any length of text is
scanned whole in time linear in its length; repeated rows are judged alike.
An empty table gives an empty result.  Extra columns go along by ``keep`` or ``row``, whatever their names
(see ``common.map_texts``).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

from pyspark.sql import DataFrame

from rehome.llm.common import BLANK_TABLE, decode, map_texts

KINDS = ("assign", "access", "hex", "lexed")
N_BASE = 3

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_HEX_TABLE = bytes(0x78 if chr(c) in "0123456789abcdef" else 0x20 for c in range(256))
_HEX_RUN = b"x" * 32

# Assignments start at the beginning of a name, so a long run of name
# characters is tried once and not from each of its characters.
# Brackets of a type, without ":" and "=", so they hide no pair.
_ARGS = r"(?:[^\[\]<>()\n=:]|::){0,200}+"
for _ in range(3):  # levels
    _ARGS = rf"(?:[^\[\]<>()\n=:]|::|[\[<(]{_ARGS}[\]>)]){{0,200}}+"
_TYPE = (r"[&*?]{0,2}+(?:'[a-z_]+[ \t]+)?+(?:(?:mut|dyn|const|readonly|final)[ \t]+)?+"
         r"[A-Za-z_](?:[A-Za-z0-9_.]|::)*+(?:[\[<(]" + _ARGS + r"[\]>)]){0,3}+[?!]?+")
_QUOTED = r"""(?:"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'|`(?:[^`\\\n]|\\.)*+`)"""
PAIR = re.compile(
    r"""(?<![A-Za-z0-9_$.-])(?P<name>[A-Za-z_$][A-Za-z0-9_$.-]*)["'\]]{0,2}[ \t]*"""
    # A type and "="; without a blank before it (or base64 padding would do) a quote must follow.
    rf"""(?:[?!]?:[ \t]*(?P<type>{_TYPE}(?:[ \t]*[|&][ \t]*{_TYPE}){{0,8}}+)"""
    r"""(?:[ \t]+:?=(?![=>~])|:?=(?=[ \t]*["'`]))"""
    r"""|:=|=>|=(?!=)|:(?![:/]))[ \t]*"""
    # A quoted literal on the next line, unless it is itself a key there.
    rf"""(?:[\\(]?[ \t]*\r?\n[ \t]*(?={_QUOTED}(?![ \t]*[:=])))?"""
    r"""(?:"(?P<dq>(?:[^"\\\n]|\\.)*)"|'(?P<sq>(?:[^'\\\n]|\\.)*)'|`(?P<bq>(?:[^`\\\n]|\\.)*)`"""
    r"""|(?P<bare>[^\s"'`,;<>(){}\[\]]+))""")
STATEMENT = re.compile(r"[a-z_][A-Za-z0-9_.]*\Z")
TAG = re.compile(r"<(?P<name>[A-Za-z_][A-Za-z0-9_.-]*)>(?P<bare>[^<>\s]+)</(?P=name)>")
IDENT = re.compile(r"[A-Za-z_$][A-Za-z0-9_$.]*\Z")
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

# How sensitive a part of a target name is, alone or as a pair.
NAME_SCORE = {"password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0,
              "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.8,
              "auth": 0.6, "authorization": 0.7, "signature": 0.6, "salt": 0.5, "pin": 0.4,
              "key": 0.4}
PAIR_SCORE = {("api", "key"): 1.0, ("access", "key"): 1.0, ("private", "key"): 1.0,
              ("secret", "key"): 1.0, ("signing", "key"): 0.9, ("encryption", "key"): 0.9,
              ("account", "key"): 0.9, ("client", "secret"): 1.0, ("pass", "word"): 1.0,
              ("pass", "phrase"): 1.0,
              ("auth", "key"): 0.9, ("db", "pass"): 1.0}
# Names whose literal may be several words.
PHRASE_NAMES = (["password"], ["passwd"], ["pwd"], ["passphrase"], ["pass", "word"],
                ["pass", "phrase"])
MIN_LITERAL = 8
MIN_SCORE = 0.5


def name_score(name: str) -> float:
    parts = [p.lower() for p in PARTS.findall(name)]
    return max([NAME_SCORE.get(p, 0.0) for p in parts]
               + [PAIR_SCORE.get(p, 0.0) for p in zip(parts, parts[1:], strict=False)], default=0.0)


def phrase_name(name: str) -> bool:
    """Whether the name ends in password or passphrase, numbered or not."""
    parts = [p.lower() for p in PARTS.findall(name) if not p.isdigit()]
    return parts[-1:] in PHRASE_NAMES or parts[-2:] in PHRASE_NAMES


def literal_score(value: str, phrase: bool = False) -> float:
    """0 for placeholders and short or uniform values, up to 1 for mixed ones;
    several words count only as a ``phrase``."""
    if len(value) < MIN_LITERAL or value[:2] in ("${", "{{", "%(") or "://" in value:
        return 0.0
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    classes = (any(c.islower() for c in value) + any(c.isupper() for c in value)
               + any(c.isdigit() for c in value) + any(not c.isalnum() for c in value))
    if classes < 2 or " " in value and not phrase:
        return 0.0
    return min(1.0, entropy / 3.0)


def base_spans(raw: bytes, text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base kinds."""
    spans = []
    lower = raw.translate(BLANK_TABLE)
    if any(w in lower for w in _ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if b"AKIA" in raw:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= 16]
    if _HEX_RUN in raw.translate(_HEX_TABLE):
        spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def lexed_spans(text: str, base: list[tuple]) -> list[tuple[int, int, int]]:
    literals: list[tuple[str, int, int, bool]] = []  # name, start, end, may be a phrase
    aliases: dict[str, set[str]] = defaultdict(set)  # constant -> names assigned from it
    for rx in (PAIR, TAG):
        for m in rx.finditer(text):
            group = m.lastgroup
            value = m[group]
            start = m.start(group)
            end = start + len(value)
            names = [m["name"]]
            if rx is PAIR and m["type"]:
                if STATEMENT.match(m["type"]):  # also ``else: name = "literal"``
                    names.append(m["type"])
                if group == "bare":  # also ``name: literal = ...``
                    literals.append((m["name"], *m.span("type"), False))
            if group == "bare" and rx is PAIR:
                value = value.rstrip(".")
                end = start + len(value)
                if IDENT.match(value):
                    aliases[value].update(names)
                    # A bare word may also be the literal itself (key: value).
            if group == "bq" and "${" in value:
                continue
            # Backticks right after "=" may be a shell command.
            phrase = group in ("dq", "sq") or group == "bq" and text[start - 2] != "="
            literals += [(n, start, end, phrase) for n in names]
    best: dict[str, tuple[float, bool]] = {}

    def reach(name: str) -> tuple[float, bool]:
        """Highest score of the names that the constant ``name`` flows into,
        and whether one of them takes phrases."""
        if name in best:
            return best[name]
        seen, todo, top, phrase = {name}, [name], 0.0, False
        while todo:
            at = todo.pop()
            top = max(top, name_score(at))
            phrase = phrase or phrase_name(at)
            for nxt in aliases.get(at, ()):
                if nxt not in seen:
                    seen.add(nxt)
                    todo.append(nxt)
        best[name] = top, phrase
        return best[name]

    out, covered, k = [], base, 0
    for name, s, e, words in sorted(literals, key=lambda x: x[1:]):
        top, phrase = reach(name)
        if top < MIN_SCORE or top * literal_score(text[s:e], phrase and words) < MIN_SCORE:
            continue
        if out and out[-1] == (s, N_BASE, e):
            continue
        while k < len(covered) and covered[k][2] <= s:
            k += 1
        if any(b[0] < e and b[2] > s for b in covered[k:k + 4]):
            continue
        out.append((s, 3, e))
    return out


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(raw: bytes | None):
    raw = raw or b""
    text = decode(raw)
    base = base_spans(raw, text)
    more = lexed_spans(text, base) if b"=" in raw or b":" in raw or b"</" in raw else []
    n = [0, 0, 0]
    for _, k, _e in base:
        n[k] += 1
    return (*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(sorted(base + more)))


FIELDS = [("n_assign", "bigint"), ("n_access", "bigint"), ("n_hex", "bigint"),
          ("base_sha256", "string"), ("spans", "string")]


def find_secrets(docs: DataFrame, text_col: str = "text", keep: tuple = (),
                 row: bool = False) -> DataFrame:
    """One row per document: base counts, digest of the base spans, all spans
    as ``kind:start:end`` in code points (end exclusive)."""
    def make():
        return lambda texts: [list(c) for c in zip(*[scan(t) for t in texts], strict=True)]
    return map_texts(docs, text_col, make, FIELDS, keep, row)
