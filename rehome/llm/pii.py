"""Personal data by patterns and a skip-chain conditional random field.

Base spans come from four plain patterns.  The field's nodes are the base
spans and *weak* mentions: number groups and obfuscated or bare addresses
that no pattern accepts.  Each node has a potential for every label from its
own features and the cue words before it; neighbouring nodes share a weak
chain potential; and distant nodes with the same or similar content (the same
trailing digits, the same mailbox) share a strong skip potential.  Loopy
sum-product passing then gives marginals, so a weak mention takes the label
of its repeated counterpart elsewhere in the document.  Mentions of one
cluster are linked one after another, not pairwise, and each weak one to the
nearest base mention of its cluster, so the graph stays linear in the text.
Base labels are given, not inferred: however many weak repeats doubt a base
mention, it tells each of them the same.  Weak nodes with a label's marginal above ``MIN_MARGINAL`` add a
span ``ctx_<label>``; base spans always stay.

``fit_field`` fits the weights by pseudo-likelihood: base mentions are the
labelled rows, their features are the words before them and the shape of the
value (digits, grouping, separators, without the leading ``+`` that only base
mentions have), and their neighbours' labels give the chain and skip weights.
"Other" is learned from weak mentions that repeat no base mention, and from
contrasts: the same shape behind the words of another place in the text, so
that a shape alone or a common word is no evidence.  The fixed potentials are
the means of a Gaussian prior; without labelled rows they stay.

Weak mentions are numbers of 7 to 26 characters, obfuscated addresses with a
name of 2 to 64 and bare mailboxes of 6 or more; cues stand within 24
characters before a mention.  These bounds concern added spans only.

Edge cases.  Null text is empty and has no spans; whole texts of any length
are scanned in linear time; repeated rows are judged alike, and the fit counts
equal lines of features once, so copies have no more say.  An empty table leaves the
prior field and gives an empty result.  Extra columns go along by ``keep`` or
``row``, whatever their names (see ``common.map_texts``).
"""

from __future__ import annotations

import hashlib
import re
from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rehome.llm.common import decode, map_texts
from rehome.session import materialize

LABELS = ("email", "ip", "card", "phone")
KINDS = LABELS + tuple(f"ctx_{x}" for x in LABELS)

# A name part is tried from its first character only; a match that follows
# another at once may also start inside one (see ``emails``).
_MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
MAIL_HERE = re.compile(_MAIL)
MAIL = re.compile(r"(?<![A-Za-z0-9._%+-])" + _MAIL)
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")

# Weak mentions.
NUMBER = re.compile(r"(?<![0-9A-Za-z+])[0-9(][0-9().\x20-]{5,24}[0-9](?![0-9A-Za-z])")
OBFUSCATED = re.compile(
    r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]{2,64})\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?"
    r"[A-Za-z0-9-]+(?:(?:\.|\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?)[A-Za-z0-9-]+)+")
# A bare mailbox stands alone: one scan finds the runs, each is looked up.
MIN_MAILBOX = 6
MAILBOX = re.compile(rf"[A-Za-z0-9._%+@-]{{{MIN_MAILBOX},}}")
CUE = re.compile(r"[A-Za-z]+")
CUE_CHARS = 24

# Bounds of the fit: about so many documents are read for mentions, and so
# many distinct lines of features of each class are collected.
FIT_DOCS = 200_000
FIT_LINES = 4_000
FIT_ROUNDS = 300
MIN_LINES = 5  # a feature seen in fewer lines keeps its prior mean
RIDGE = 1.0
OTHER_WEIGHT = 3.0  # marking a clean number costs more than missing a weak mention

# Log-potentials: means of the prior, and the field where nothing is fitted.
CUES = {"mail": (2.0, 0, 0, 0), "email": (2.0, 0, 0, 0), "contact": (1.0, 0, 0, 0.5),
        "ip": (0, 2.0, 0, 0), "host": (0, 1.0, 0, 0), "server": (0, 1.0, 0, 0),
        "address": (0.5, 0.5, 0, 0), "card": (0, 0, 2.0, 0), "visa": (0, 0, 2.0, 0),
        "mastercard": (0, 0, 2.0, 0), "credit": (0, 0, 1.5, 0), "tel": (0, 0, 0, 2.0),
        "phone": (0, 0, 0, 2.0), "telephone": (0, 0, 0, 2.0), "mobile": (0, 0, 0, 2.0),
        "call": (0, 0, 0, 1.5), "fax": (0, 0, 0, 2.0), "cell": (0, 0, 0, 1.5)}
BASE_POTENTIAL = 1e3  # as good as observed
OTHER_POTENTIAL = 2.0
CHAIN_POTENTIAL = 0.3
SKIP_POTENTIAL = 3.0
ANCHOR_POTENTIAL = 5.0  # to the base mention: above "other" and two neighbours by a margin
ROUNDS = 10
MIN_MARGINAL = 0.6
TAIL_DIGITS = 7


def emails(text: str):
    """Leftmost non-overlapping matches, linear in the text: a run that has
    no ``@`` after it is tried once and not from each of its characters."""
    at = 0
    while True:
        m = (MAIL_HERE.match(text, at) if at else None) or MAIL.search(text, at)
        if m is None:
            return
        yield m.start(), m.end()
        at = m.end()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_spans(raw: bytes, text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base kinds."""
    spans = []
    if b"@" in raw:
        spans += [(s, 0, e) for s, e in emails(text)]
    if not DIGIT.search(text):
        return spans
    if b"." in raw:
        spans += [(m.start(), 1, m.end()) for m in IP.finditer(text)
                  if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
                         for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
    if b"+" in raw:
        spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
                  if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(spans)


class Field(NamedTuple):
    """Potentials: per feature one weight a label, and the shared ones."""

    weights: dict
    other: float
    chain: float
    skip: float


PRIOR = Field({f"c:{w}": np.array(v, float) for w, v in CUES.items()},
              OTHER_POTENTIAL, CHAIN_POTENTIAL, SKIP_POTENTIAL)


def _cues(text: str, start: int) -> list[str]:
    return [f"c:{w.lower()}" for w in CUE.findall(text[max(0, start - CUE_CHARS):start])[-3:]]


def _shape(value: str) -> list[str]:
    """Number of digits, sizes of the digit groups, separators; nothing for
    a value with letters."""
    if CUE.search(value):
        return []
    groups = [str(len(g)) for g in NOT_DIGIT.split(value) if g]
    marks = sorted({f"{ord(c):x}" for c in "".join(NOT_DIGIT.findall(value)) if c != "+"})
    return [f"n:{min(sum(map(int, groups)), 20)}", "s:" + ".".join(marks)] + (
        ["g:" + "-".join(groups)] if len(groups) <= 6 else [])


def _nodes(text: str, raw: bytes, base: list[tuple], field: Field = PRIOR):
    """(start, end, label potentials, cluster keys, is base) in text order."""
    nodes = []
    for s, k, e in base:
        pot = np.zeros(5)
        pot[1 + k] = BASE_POTENTIAL
        nodes.append((s, e, pot, _keys(text[s:e], k), True))
    weak = []
    if DIGIT.search(text):
        weak += [(m.start(), m.end(), None) for m in NUMBER.finditer(text)]
    if b"at" in raw:
        weak += [(m.start(), m.end(), 0) for m in OBFUSCATED.finditer(text)]
    mailboxes = {text[s:e].split("@")[0].lower() for s, k, e in base if k == 0}
    if any(len(box) >= MIN_MAILBOX for box in mailboxes):
        weak += [(m.start(), m.end(), 0) for m in MAILBOX.finditer(text)
                 if m[0].lower() in mailboxes]
    k, done = 0, -1
    for s, e, kind in sorted(weak, key=lambda w: (w[0], -w[1])):
        while k < len(base) and base[k][2] <= s:
            k += 1
        if s < done or any(b[0] < e and b[2] > s for b in base[k:k + 4]):
            continue
        done = e
        pot = np.zeros(5)
        pot[0] = field.other
        for f in _cues(text, s) + _shape(text[s:e]):
            if f in field.weights:
                pot[1:] += field.weights[f]
        nodes.append((s, e, pot, _keys(text[s:e], kind), False))
    return sorted(nodes, key=lambda n: n[:2])


def _keys(value: str, kind: int | None) -> list[str]:
    """Content by which distant mentions are the same or similar."""
    if kind == 0:
        return ["m" + re.split(r"@|\x20?[\[(]at[\])]|\x20at\x20", value)[0].lower()]
    digits = NOT_DIGIT.sub("", value)
    if kind == 1:
        return ["i" + NOT_DIGIT.sub(".", value)]
    keys = ["d" + digits[-TAIL_DIGITS:]] if len(digits) >= TAIL_DIGITS else []
    if kind is None and value.count(".") == 3:
        keys.append("i" + NOT_DIGIT.sub(".", value))
    return keys


def marginals(unary: np.ndarray, edges: np.ndarray, weight: np.ndarray,
              rounds: int = ROUNDS) -> np.ndarray:
    """Loopy sum-product with agreement potentials; rows are label marginals."""
    n, labels = unary.shape
    both = np.concatenate([edges, edges[:, ::-1]])
    w = np.exp(np.concatenate([weight, weight]))[:, None] - 1.0
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    msg = np.zeros((len(both), labels))
    for _ in range(rounds):
        belief = unary.copy()
        np.add.at(belief, both[:, 1], msg)
        out = belief[both[:, 0]] - msg[back]
        out -= out.max(axis=1, keepdims=True)
        p = np.exp(out)
        new = np.log(p.sum(axis=1, keepdims=True) + w * p)
        new -= new.max(axis=1, keepdims=True)
        if np.abs(new - msg).max() < 1e-6:
            break
        msg = 0.5 * msg + 0.5 * new
    belief = unary.copy()
    np.add.at(belief, both[:, 1], msg)
    belief -= belief.max(axis=1, keepdims=True)
    p = np.exp(belief)
    return p / p.sum(axis=1, keepdims=True)


def _anchors(nodes: list[tuple]) -> list[tuple[int, int]]:
    """(base, weak) node pairs: the nearest base mention of each key."""
    before: dict[str, int] = {}
    after: dict[str, int] = {}
    found: dict[tuple[int, str], int] = {}
    for i, node in enumerate(nodes):
        for key in node[3]:
            if node[4]:
                before[key] = i
            elif key in before:
                found[i, key] = before[key]
    for i in range(len(nodes) - 1, -1, -1):
        for key in nodes[i][3]:
            if nodes[i][4]:
                after[key] = i
            elif key in after:
                b = found.get((i, key))
                if b is None or nodes[after[key]][0] - nodes[i][1] < nodes[i][0] - nodes[b][1]:
                    found[i, key] = after[key]
    return sorted({(b, i) for (i, _), b in found.items()})


def field_spans(raw: bytes, text: str, base: list[tuple],
                field: Field = PRIOR) -> list[tuple[int, int, int]]:
    nodes = _nodes(text, raw, base, field)
    if all(n[4] for n in nodes):
        return []
    edges = [(i, i + 1) for i in range(len(nodes) - 1)]
    weight = [field.chain] * len(edges)
    last: dict[str, int] = {}
    for i, node in enumerate(nodes):
        for key in node[3]:
            if key in last:
                edges.append((last[key], i))
                weight.append(field.skip)
            last[key] = i
    anchors = _anchors(nodes)
    edges += anchors
    # Fitted weights may speak against a label; its base mention outweighs them.
    weight += [ANCHOR_POTENTIAL + 2 * (field.chain - CHAIN_POTENTIAL)
               + max(0.0, _lead(nodes[i][2], nodes[b][2]) - OTHER_POTENTIAL) for b, i in anchors]
    unary = np.array([n[2] for n in nodes])
    if edges:
        p = marginals(unary, np.array(edges), np.array(weight))
    else:
        p = np.exp(unary - unary.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
    best = p[:, 1:].argmax(axis=1)
    return [(n[0], 4 + int(best[i]), n[1]) for i, n in enumerate(nodes)
            if not n[4] and p[i, 1 + best[i]] >= MIN_MARGINAL]


def _lead(pot: np.ndarray, base: np.ndarray) -> float:
    """By how much a weak mention's best rival exceeds its base mention's label."""
    k = int(base.argmax())
    return float(np.delete(pot, k).max() - pot[k])


def _lines(raw: bytes | None) -> list[str]:
    """Training lines of one text, ``class|chain labels|skip labels|features``:
    classes 1 to 4 are base mentions, 0 weak ones without a counterpart or a
    prior cue, 5 contrasts."""
    raw = raw or b""
    text = decode(raw)
    base = base_spans(raw, text)
    nodes = _nodes(text, raw, base)
    known = [int(n[2].argmax()) if n[4] else 0 for n in nodes]
    keys = {key for n in nodes if n[4] for key in n[3]}
    out, last = [], {}
    for i, (s, e, pot, own, is_base) in enumerate(nodes):
        beside = "".join(str(known[j]) for j in (i - 1, i + 1) if 0 <= j < len(nodes))
        same = "".join(sorted({str(last[k]) for k in own if k in last}))
        if is_base:
            last |= dict.fromkeys(own, known[i])
            shape = _shape(text[s:e])
            out.append("|".join([str(known[i]), beside, same, " ".join(_cues(text, s) + shape)]))
            elsewhere = _cues(text, (s + len(text) // 2) % max(len(text), 1))
            out.append("|".join(["5", beside, "", " ".join(elsewhere + shape)]))
        elif not pot[1:].any() and not keys.intersection(own):
            out.append("|".join(["0", beside, "", " ".join(_cues(text, s) + _shape(text[s:e]))]))
    return out


def fit_lines(lines: list[str], rounds: int = FIT_ROUNDS) -> Field:
    """Maximum a posteriori pseudo-likelihood: softmax over the five labels,
    diagonal upper bounds of the curvature as step sizes."""
    if not any(x[0] in "1234" for x in lines):
        return PRIOR
    parts = [x.split("|", 3) for x in sorted(lines)]
    seen: dict[str, int] = {}
    for p in parts:
        for f in set(p[3].split()):
            seen[f] = seen.get(f, 0) + 1
    names = sorted(f for f, n in seen.items() if n >= MIN_LINES)
    at = {f: i for i, f in enumerate(names)}
    n = len(parts)
    pairs = [(i, at[f]) for i, p in enumerate(parts) for f in set(p[3].split()) if f in at]
    row, col = np.array(pairs, np.int64).reshape(-1, 2).T
    y = np.array([int(p[0]) % 5 for p in parts])
    weight = np.where(y == 0, OTHER_WEIGHT, 1.0)
    links = np.zeros((2, n, 5))
    for which in (0, 1):
        for i, p in enumerate(parts):
            for label in p[1 + which]:
                links[which, i, int(label)] += 1
    target = np.eye(5)[y]
    mean = np.array([PRIOR.weights.get(f, np.zeros(4)) for f in names]).reshape(-1, 4)
    shared_mean = np.array([PRIOR.other, PRIOR.chain, PRIOR.skip])
    w, shared = mean.copy(), shared_mean.copy()
    size = 1.0 + np.bincount(row, minlength=n) + links.sum(axis=(0, 2))
    step = 1 / (0.5 * np.bincount(col, (weight * size)[row], minlength=len(names)) + RIDGE)
    shared_step = 1 / (0.5 * np.array([(weight * size).sum(), *(
        (weight * size * x.sum(axis=1)).sum() for x in links)]) + RIDGE)
    for _ in range(rounds):
        z = shared[1] * links[0] + shared[2] * links[1]
        z[:, 0] += shared[0]
        for k in range(4):
            z[:, 1 + k] += np.bincount(row, w[col, k], minlength=n)
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        g = (p - target) * weight[:, None]
        for k in range(4):
            slope = np.bincount(col, g[row, 1 + k], minlength=len(names))
            w[:, k] -= step * (slope + RIDGE * (w[:, k] - mean[:, k]))
        slope = np.array([g[:, 0].sum(), (g * links[0]).sum(), (g * links[1]).sum()])
        shared -= shared_step * (slope + RIDGE * (shared - shared_mean))
        shared[1:] = np.maximum(shared[1:], 0)
    return Field(PRIOR.weights | dict(zip(names, w, strict=True)), *map(float, shared))


def fit_field(docs: DataFrame, text_col: str = "text") -> Field:
    """Fit the field on base mentions of a bounded sample of ``docs``: texts by
    hash, about ``FIT_DOCS`` of them, then the ``FIT_LINES`` smallest hashes
    among the distinct lines of each class."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(text.cast("binary").alias("_text")).where(F.col("_text").isNotNull())
    share = min(1.0, FIT_DOCS / max(rows.count(), 1))
    u = F.pmod(F.xxhash64("_text"), F.lit(1 << 30))
    rows = rows.where(u < int(share * (1 << 30)))

    def make():
        return lambda texts: [[_lines(t) for t in texts]]

    lines = materialize(map_texts(rows, "_text", make, [("lines", "array<string>")]).select(
        F.explode("lines").alias("line")).distinct(), "pii-lines")
    picked = [lines.where(F.col("line").startswith(str(k))).orderBy(F.xxhash64("line"), "line")
              .limit(FIT_LINES) for k in range(6)]
    return fit_lines([r["line"] for r in reduce(DataFrame.unionAll, picked).collect()])


def find_spans(raw: bytes | None, field: Field = PRIOR) -> tuple[str, list[tuple], list[tuple]]:
    raw = raw or b""
    text = decode(raw)
    base = base_spans(raw, text)
    return text, base, sorted(base + field_spans(raw, text, base, field))


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def masked(text: str, spans: list[tuple]) -> str:
    """Every span replaced by its kind in brackets; overlapping ones as one."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"[{LABELS[k % 4].upper()}]"]
        at = max(at, e)
    out.append(text[at:])
    return "".join(out)


FIELDS = [("n_email", "bigint"), ("n_ip", "bigint"), ("n_card", "bigint"), ("n_phone", "bigint"),
          ("base_sha256", "string"), ("spans", "string")]


def find_pii(docs: DataFrame, text_col: str = "text", keep: tuple = (),
             row: bool = False, field: Field = PRIOR) -> DataFrame:
    """One row per document: base counts, digest of the base spans, all spans
    as ``kind:start:end`` in code points (end exclusive)."""
    def make():
        def one(raw):
            _, base, spans = find_spans(raw, field)
            n = [0, 0, 0, 0]
            for _, k, _e in base:
                n[k] += 1
            return (*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))
        return lambda texts: [list(c) for c in zip(*[one(t) for t in texts], strict=True)]
    return map_texts(docs, text_col, make, FIELDS, keep, row)


def mask_pii(docs: DataFrame, text_col: str = "text", keep: tuple = (),
             row: bool = False, field: Field = PRIOR) -> DataFrame:
    """One row per document: ``masked`` text (null stays null) and ``n_spans``."""
    def make():
        def one(raw):
            if raw is None:
                return None, 0
            text, _, spans = find_spans(raw, field)
            return masked(text, spans), len(spans)
        return lambda texts: [list(c) for c in zip(*[one(t) for t in texts], strict=True)]
    return map_texts(docs, text_col, make, [("masked", "string"), ("n_spans", "bigint")], keep, row)
