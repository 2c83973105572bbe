"""Language identification by a string kernel.

The kernel of two texts is the share of distinct character n-grams (one to
three letters, blended) that both have: ``|A & B| / sqrt(|A| |B|)``.
``n_landmarks`` sampled documents per language are Nystroem landmarks; kernel
ridge regression on a bounded labelled sample gives one-versus-rest weights
per landmark; prediction is the product of the texts' presence vectors with the landmarks',
then with the weights.  N-grams are compared as they are, not by hash.

The sample has ``N_LANDMARKS`` landmarks and about ``N_TRAIN`` training
documents a label, picked by hash of id and text among the distinct ones.  There
may be any number of labels: beyond ``MAX_LANDMARKS`` or ``MAX_TRAIN`` in all,
each label gets fewer (never under ``MIN_TRAIN`` training documents), and every
label is still fitted.  Only the sample is collected, as n-gram sets and kernel
rows; texts never are.

Edge cases.  A text that is null or has no letter is ``und`` with score 0.
Without any labelled row every text is ``und``.  Repeated rows are judged
alike.  ``lang``, ``source`` and the id are never inputs of a prediction.  An
empty table gives no model and an empty result.  Extra columns go along by ``keep`` or ``row``, whatever their names
(see ``common.map_texts``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rehome.llm.common import decode, map_texts
from rehome.session import bounded_broadcast, materialize

N_LANDMARKS = 24
N_TRAIN = 400
MAX_LANDMARKS = 100 * N_LANDMARKS
MAX_TRAIN = 100 * N_TRAIN
MIN_TRAIN = 8
RIDGE = 1e-2
TEMPERATURE = 8.0
BATCH = 128
UNKNOWN = "und"


def ngram_codes(text: str) -> np.ndarray:
    """Codes of the n-grams of one to three characters of a text: lower-cased
    letters, everything else as one blank; 21 bits a character, so no two
    n-grams share a code."""
    chars = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    letter = _letters(chars)
    if not letter.any():
        return np.empty(0, np.int64)
    chars = np.where(letter, chars, np.uint32(32))
    blank = chars == 32
    keep = ~(blank & np.concatenate(([True], blank[:-1])))  # runs of blanks count once
    c = np.concatenate(([32], chars[keep], [32])).astype(np.int64)
    two = c[:-1] << 21 | c[1:]
    return np.concatenate((c, two, two[:-1] << 21 | c[2:]))


_TABLE: dict[str, np.ndarray] = {}


def _letters(chars: np.ndarray) -> np.ndarray:
    """Which code points are letters (Unicode's, up to the last plane)."""
    if "t" not in _TABLE:
        _TABLE["t"] = np.array([chr(i).isalpha() for i in range(0x110000)], dtype=bool)
    return _TABLE["t"][np.minimum(chars, 0x10FFFF)]


def presence(text: str) -> np.ndarray:
    """Sorted distinct n-gram codes of a text."""
    return np.unique(ngram_codes(text))


class Landmarks:
    """The landmarks' presence vectors as lists of landmarks per n-gram, so
    memory follows the sizes of their sets."""

    def __init__(self, sets: list[np.ndarray]):
        codes = np.concatenate(sets)
        order = np.argsort(codes, kind="stable")
        self.mark = np.repeat(np.arange(len(sets)), [len(x) for x in sets])[order].astype(np.int32)
        self.used, first = np.unique(codes[order], return_index=True)
        self.at = np.append(first, len(codes))
        self.scale = 1.0 / np.sqrt([len(x) for x in sets])

    def kernel_of(self, codes: np.ndarray) -> np.ndarray:
        """Kernel row of one text's distinct codes."""
        pos = np.minimum(np.searchsorted(self.used, codes), len(self.used) - 1)
        pos = pos[self.used[pos] == codes]
        n = self.at[pos + 1] - self.at[pos]
        both = np.repeat(self.at[pos] - np.cumsum(n) + n, n) + np.arange(n.sum())
        shared = np.bincount(self.mark[both], minlength=len(self.scale))
        return (shared * self.scale / np.sqrt(max(len(codes), 1))).astype(np.float32)

    def kernel(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(kernel rows, whether the text has a letter)."""
        sets = [presence(t) for t in texts]
        return np.stack([self.kernel_of(x) for x in sets]), np.array([len(x) > 0 for x in sets])


def _sample(labelled: DataFrame, counts: DataFrame, per_label: float, salt: int) -> DataFrame:
    """About ``per_label`` of the distinct rows of each label, by hash of id and
    text: a row's chance is the wanted number over the label's count, so no
    label is gathered."""
    rows = labelled.join(bounded_broadcast(counts), "_label")
    u = (F.pmod(F.xxhash64(F.lit(salt), "_row"), F.lit(1 << 30)) / F.lit(float(1 << 30)))
    return rows.where(u * F.col("count") < per_label).groupBy("_label", "_row").agg(
        F.first("_text").alias("_text"))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
          where=None, n_landmarks: int = N_LANDMARKS, n_train: int = N_TRAIN,
          ridge: float = RIDGE) -> dict | None:
    """Fit on the rows that ``where`` admits; None when none has a label."""
    rows = docs if where is None else docs.where(where)
    text = F.col(f"`{text_col}`")
    rows = rows.select(F.col(f"`{label_col}`").cast("string").alias("_label"),
                       F.xxhash64(F.col(f"`{id_col}`").cast("string"), text).alias("_row"),
                       text.alias("_text")).where(
        F.col("_label").isNotNull() & F.col("_text").isNotNull())
    # A text without a letter can teach nothing and takes no place in the sample.
    rows = rows.where(F.col("_text").cast("string").rlike(r"\p{L}"))
    counts = materialize(rows.groupBy("_label", "_row").agg(F.lit(1)).groupBy("_label").count(),
                         "langid-labels")
    n = max(counts.count(), 1)

    def make_sets():
        return lambda texts: [[presence(decode(t)) for t in texts]]

    picked = [(r["_label"], r["codes"]) for r in map_texts(
        _sample(rows, counts, min(n_landmarks, MAX_LANDMARKS / n), 1), "_text", make_sets, [("codes", "array<bigint>")],
        ["_label"]).collect() if r["codes"]]
    if not picked:
        return None
    picked.sort(key=lambda x: (x[0], x[1]))
    sets = [np.array(c, np.int64) for _, c in picked]
    marks = Landmarks(sets)
    held = docs.sparkSession.sparkContext.broadcast(marks)

    def make_rows():
        def fn(texts):
            k, ok = held.value.kernel([decode(t) for t in texts])
            return [[r if o else None for r, o in zip(k.tolist(), ok, strict=True)]]
        return fn

    got = map_texts(
        _sample(rows, counts, min(n_train, max(MIN_TRAIN, MAX_TRAIN / n)), 2), "_text", make_rows,
        [("k", "array<float>")], ["_label"]).where("k IS NOT NULL").toArrow().combine_chunks()
    own = np.stack([marks.kernel_of(x) for x in sets])
    names = got.column("_label").to_pylist() + [x for x, _ in picked]
    k_nm = np.concatenate([*(c.flatten().to_numpy().reshape(-1, len(picked))
                             for c in got.column("k").chunks), own])
    order = sorted(range(len(names)), key=lambda i: (names[i], k_nm[i].tobytes()))
    k_nm = k_nm[order]
    labels, first, size = np.unique([names[i] for i in order], return_index=True,
                                    return_counts=True)
    labels = labels.tolist()
    # Every label weighs the same in the fit; its targets are 1 in its own rows, else -1.
    weight = np.repeat(len(names) / (len(labels) * size), size).astype(np.float32)
    k_w = weight[:, None] * k_nm
    right = np.add.reduceat(k_w, first, axis=0, dtype=np.float64)
    right = (2 * right - right.sum(axis=0)).T
    left = (k_nm.T @ k_w).astype(np.float64) + ridge * len(names) * own.astype(np.float64) \
        + 1e-6 * np.eye(len(picked))
    alpha = np.linalg.solve(left, right)
    held.unpersist()
    return {"labels": labels, "landmarks": marks, "alpha": alpha.astype(np.float32)}


FIELDS = [("lang_pred", "string"), ("score", "double")]


def predict(docs: DataFrame, model: dict | None, text_col: str = "text", keep: tuple = (),
            row: bool = False) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (0 to 1: softmax of the margins)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def fn(texts):
            m, names, scores = held.value, [], []
            for at in range(0, len(texts), BATCH):
                part = [decode(t) for t in texts[at:at + BATCH]]
                if m is None:
                    names += [UNKNOWN] * len(part)
                    scores += [0.0] * len(part)
                    continue
                k, ok = m["landmarks"].kernel(part)
                f = (k @ m["alpha"]).astype(np.float64) * TEMPERATURE
                p = np.exp(f - f.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                best = p.argmax(axis=1)
                for i, b in enumerate(best):
                    names.append(m["labels"][b] if ok[i] else UNKNOWN)
                    scores.append(float(p[i, b]) if ok[i] else 0.0)
            return [names, scores]
        return fn

    return map_texts(docs, text_col, make, FIELDS, keep, row)
