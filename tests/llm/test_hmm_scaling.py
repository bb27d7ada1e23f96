"""Scaling at every few steps only: expected counts and likelihoods of long and short texts side by side are exact."""

import numpy as np
import pytest

from riskfeat.llm import hmm


def brute(seq, start, trans, emit):
    """Starts, transitions, emissions and log10 likelihood of one sequence, scaled at every step in extended precision."""
    start, trans, emit = (np.asarray(x, np.longdouble) for x in (start, trans, emit))
    alpha, beta, c = [], [np.ones(len(start), np.longdouble)], []
    for t, o in enumerate(seq):
        now = (alpha[-1] @ trans if t else start) * emit[o]
        c.append(now.sum())
        alpha.append(now / c[-1])
    for t in range(len(seq) - 1, 0, -1):
        beta.insert(0, trans @ (emit[seq[t]] * beta[0]) / c[t])
    e_trans, e_emit = np.zeros(trans.shape), np.zeros(emit.shape)
    for t, o in enumerate(seq):
        e_emit[o] += (alpha[t] * beta[t]).astype(float)
        if t:
            e_trans += (alpha[t - 1][:, None] * trans * emit[o] * beta[t] / c[t]).astype(float)
    return (alpha[0] * beta[0]).astype(float), e_trans, e_emit, float(np.sum(np.log10(np.array(c))))


def test_unlikely_runs_and_lengths_about_the_scaled_steps():
    rng = np.random.default_rng(3)
    emit = rng.random((50, 4)) ** 3 + 1e-9
    emit[40:] = 1e-30 * (1 + rng.random((10, 4)))  # as rare as a class can be
    start, trans = np.full(4, .25), np.full((4, 4), .1) + .6 * np.eye(4)
    k = hmm.SCALED
    seqs = [rng.integers(0, 50, n).astype("<u2") for n in (1, 2, k - 1, k, k + 1, 2 * k, 2 * k + 1, 300, 300, 5)]
    seqs.append(rng.integers(40, 50, 200).astype("<u2"))
    want = [brute(s, start, trans, emit) for s in seqs]
    for got, own in zip(hmm.expected(seqs, start, trans, emit), list(zip(*want))[:3], strict=True):
        assert np.allclose(got, sum(own), rtol=1e-9, atol=1e-12)
    assert hmm.log10_likelihood(seqs, start, trans, emit) == pytest.approx([w[3] for w in want], rel=1e-12)


def test_few_array_steps_a_token():
    """Texts of like length go side by side: the recursions take one step for all, and more tokens than before together."""
    lengths = np.full(30, 13_000)
    assert len(list(hmm.side_by_side(lengths))) == 1
