"""LM scoring: the network against plain Python, and scores that do not depend on files."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlake.llm import lm_score as L


def _plain_logprob(net, target, around):
    """One token's log-probability in plain Python."""
    embed, w1, b1, w2, b2 = [v.tolist() for v in net]
    x = [value for c in around for value in embed[c]]
    h = [math.tanh(sum(a * w1[i][j] for i, a in enumerate(x)) + b1[j]) for j in range(len(b1))]
    z = [sum(a * w2[i][j] for i, a in enumerate(h)) + b2[j] for j in range(len(b2))]
    top = max(z)
    return z[target] - top - math.log(sum(math.exp(v - top) for v in z))


def _case(seed=5, n=40):
    rng = np.random.default_rng(seed)
    net = [v.astype(np.float64) + rng.normal(0, 0.1, v.shape) for v in L.initial()]
    return net, rng.integers(0, L.EDGE, n), rng.integers(0, L.CLASSES, (n, 2 * L.SIDE))


@pytest.mark.parametrize("scale", [1, 400])
def test_forward_pass_equals_plain_python(scale):
    net, targets, around = _case()
    net[3] = net[3] * scale  # the larger outputs would overflow without their offset
    got = L.log_probabilities(net, targets, around)
    for value, t, a in zip(got, targets.tolist(), around.tolist()):
        assert value == pytest.approx(_plain_logprob(net, t, a), rel=1e-9, abs=1e-9)


def test_gradients_equal_finite_differences():
    net, targets, around = _case()
    loss = lambda: -L.log_probabilities(net, targets, around).mean()
    rng, step = random.Random(3), 1e-5
    for values, found in zip(net, L.gradients(net, targets, around)):
        for _ in range(12):
            at = tuple(rng.randrange(k) for k in values.shape)
            own = values[at]
            values[at] = own + step
            up = loss()
            values[at] = own - step
            down = loss()
            values[at] = own
            assert found[at] == pytest.approx((up - down) / (2 * step), abs=1e-7)


def test_windows_hold_the_neighbours_of_each_text():
    targets, around = L.windows([np.array([1, 2, 3]), np.array([], np.int64), np.array([4])])
    e = L.EDGE
    assert targets.tolist() == [1, 2, 3, 4]
    assert around.tolist() == [[e, e, 2, 3], [e, 1, 3, e], [1, 2, e, e], [e, e, e, e]]


def _documents(spark, n=400):
    rng = random.Random(9)
    rows = [(i if i % 50 else None, " ".join(f"w{int(rng.paretovariate(0.7)) % 900}" for _ in range(rng.randint(0, 60)))) for i in range(n)]
    return spark.createDataFrame(rows + rows[:20], "doc_id long, text string")


def test_scores_do_not_depend_on_how_rows_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(L, "PARTS", 8)  # several parts in a round
    docs = _documents(spark)
    one, other = (sorted((r.doc_id or -1, r.n_tokens, r.sum_logprob) for r in L.lm_scores(docs.repartition(k)).collect()) for k in (2, 9))
    for a, b in zip(one, other, strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=1e-3)


def test_own_columns_are_kept_and_may_have_any_name(spark):
    docs = _documents(spark, 60)
    more = docs.withColumns({c: F.lit(c) for c in ("__row", "__tokens", "__text", "__hash", "__codes", "word", "more", "row")})
    got = L.lm_scores(more)
    assert got.columns == [*more.columns, *L.RESULT]
    assert {r["__row"] + r["__codes"] + r["more"] for r in got.collect()} == {"__row__codesmore"} and got.count() == 80
    few = L.lm_scores(more, columns=["doc_id", "__row"])
    assert few.columns == ["doc_id", "__row", *L.RESULT]
    key = lambda r: (r.doc_id or -1, r.n_tokens, round(r.sum_logprob, 3))
    assert sorted(map(key, few.collect())) == sorted(map(key, got.collect()))
