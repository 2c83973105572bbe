"""The fitted weights of the personal-data field."""

import random

import numpy as np
import pytest

from rehome.llm import pii
from rehome.llm.pii import PRIOR, find_spans, fit_field, fit_lines


def corpus(seed=3, n=400):
    """Phones stand behind the invented cue ``ruf``, clean numbers behind ``los``."""
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    out = []
    for _ in range(n):
        pad = [" ".join(rng.choices(words, k=8)) for _ in range(4)]
        phone = f"+{rng.randrange(1, 9)} {rng.randrange(200, 999)} 555 {rng.randrange(1000, 9999)}"
        clean = f"{rng.randrange(200, 999)} {rng.randrange(100, 999)} {rng.randrange(1000, 9999)}"
        out.append(f"{pad[0]} ruf {phone} {pad[1]} {pad[2]} los {clean} {pad[3]}")
    return out


def lines(texts):
    return sorted({x for t in texts for x in pii._lines(t.encode())})


def ctx(text, field):
    _, base, spans = find_spans(text.encode(), field)
    return [(pii.KINDS[k], text[s:e]) for s, k, e in spans if k >= 4]


@pytest.fixture(scope="module")
def field():
    return fit_lines(lines(corpus()))


def test_cues_are_learned(field):
    assert field.weights["c:ruf"][3] > 1 > field.weights.get("c:los", np.zeros(4))[3]
    assert ctx("alpha ruf 1 988 555 2485 beta", field) == [("ctx_phone", "1 988 555 2485")]
    assert ctx("alpha ruf 1 988 555 2485 beta", PRIOR) == []
    assert ctx("alpha los 988 555 2485 beta", field) == []
    assert ctx("alpha beta 1 988 555 2485 gamma", field) == []


def test_prior_cues_stay(field):
    """Cue words the rows do not show keep their weights, against the learned ``other``."""
    assert all((field.weights[f] == v).all() for f, v in PRIOR.weights.items())
    text = "phone telephone mobile 988 555 2485 x"
    assert ctx(text, field) == ctx(text, PRIOR) == [("ctx_phone", "988 555 2485")]


@pytest.mark.parametrize("n", [1, 2, 5, 50])
def test_repeats_take_the_base_label(field, n):
    weak = " omega los 988 555 2485" * n
    for text in (f"x +1 (988) 555-2485{weak} y", f"x{weak} omega +1 (988) 555-2485 y"):
        assert ctx(text, field) == [("ctx_phone", "988 555 2485")] * n


def test_base_spans_do_not_depend_on_the_field(field):
    for t in corpus(9, 20):
        assert find_spans(t.encode(), field)[1] == find_spans(t.encode(), PRIOR)[1]


def test_nothing_labelled_keeps_the_prior():
    assert fit_lines([]) is PRIOR
    assert fit_lines(["0|||c:los n:10", "5|||n:10"]) is PRIOR


def test_fit_is_the_optimum():
    """Against a dense version: no small step lowers the penalised loss."""
    rows = lines(corpus(5, 60))
    got = fit_lines(rows, rounds=20_000)
    parts = [x.split("|", 3) for x in rows]
    seen = {}
    for p in parts:
        for f in set(p[3].split()):
            seen[f] = seen.get(f, 0) + 1
    names = sorted(f for f, n in seen.items() if n >= pii.MIN_LINES)

    def loss(w, shared):
        total = 0.0
        for p in parts:
            z = np.zeros(5)
            z[0] = shared[0]
            for f in set(p[3].split()) & set(names):
                z[1:] += w[f]
            for c in p[1]:
                z[int(c)] += shared[1]
            for c in p[2]:
                z[int(c)] += shared[2]
            y = int(p[0]) % 5
            total -= (pii.OTHER_WEIGHT if y == 0 else 1) * (z[y] - np.log(np.exp(z).sum()))
        total += pii.RIDGE / 2 * sum(
            ((w[f] - PRIOR.weights.get(f, np.zeros(4))) ** 2).sum() for f in names)
        return total + pii.RIDGE / 2 * ((shared - np.array(PRIOR[1:])) ** 2).sum()

    w = {f: got.weights[f] for f in names}
    shared = np.array(got[1:])
    at = loss(w, shared)
    rng = np.random.default_rng(1)
    for _ in range(30):
        near = {f: v + rng.normal(0, 1e-2, 4) for f, v in w.items()}
        assert loss(near, shared) > at
        moved = shared + rng.normal(0, 1e-2, 3)
        if (moved[1:] >= 0).all():
            assert loss(w, moved) > at


def test_fit_in_spark(spark):
    texts = corpus()
    df = spark.createDataFrame([(t,) for t in texts] + [(None,), ("",)], "text string")
    one = fit_field(df)
    want = fit_lines(lines(texts))
    again = fit_field(df.unionAll(df).repartition(7))  # copies and order change nothing
    for got in (one, again):
        assert got[1:] == want[1:] and got.weights.keys() == want.weights.keys()
        assert all((got.weights[f] == want.weights[f]).all() for f in want.weights)
    empty = spark.createDataFrame([], "text string")
    assert fit_field(empty) is PRIOR
    rows = pii.find_pii(df, field=one).collect()
    assert len(rows) == len(texts) + 2 and sum(r["n_phone"] for r in rows) == len(texts)
