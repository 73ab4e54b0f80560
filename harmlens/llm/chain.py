"""Two-state linear-chain CRF: sum-product over many sequences at once.

Sequences are laid end to end; at a boundary the chain restarts, so one pass over the whole run is exact
for each of them. The run is cut into equally long strips whose 2 x 2 products are computed side by side,
joined in a short loop, and then filled in: that gives long sequences the same treatment as short ones.
"""

from __future__ import annotations

import numpy as np

Matrices = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _steps(unary: np.ndarray, first: np.ndarray, start: np.ndarray, moves: np.ndarray) -> Matrices:
    """Transition into each position times its own potential, as the four entries; ``unary`` is state 1's."""
    emit = (np.exp(-np.maximum(unary, 0.0)), np.exp(np.minimum(unary, 0.0)))
    move, begin = np.exp(moves - moves.max()), np.exp(start - start.max())
    out = []
    for a in (0, 1):
        for b in (0, 1):
            out.append(np.where(first, begin[b], move[a, b]) * emit[b])
    return tuple(out)


def _strips(m: np.ndarray, width: int, strips: int, fill: float) -> np.ndarray:
    """Position j of every strip side by side."""
    padded = np.full(strips * width, fill)
    padded[: len(m)] = m
    return np.ascontiguousarray(padded.reshape(strips, width).T)


def _messages(m: Matrices, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Normalised forward message and backward message of state 1 at each position."""
    width = max(1, int(np.sqrt(n)))
    strips = -(-n // width)
    m00, m01, m10, m11 = (_strips(x, width, strips, f) for x, f in zip(m, (1.0, 0.0, 0.0, 1.0)))
    # products of whole strips
    t00, t01, t10, t11 = np.ones(strips), np.zeros(strips), np.zeros(strips), np.ones(strips)
    for j in range(width):
        a, b, c, d = m00[j], m01[j], m10[j], m11[j]
        t00, t01, t10, t11 = t00 * a + t01 * c, t00 * b + t01 * d, t10 * a + t11 * c, t10 * b + t11 * d
        norm = 1.0 / (t00 + t01 + t10 + t11)
        t00, t01, t10, t11 = t00 * norm, t01 * norm, t10 * norm, t11 * norm
    left, right = np.full(strips, 0.5), np.full(strips, 0.5)
    for k in range(1, strips):
        q = left[k - 1]
        one = (1 - q) * t01[k - 1] + q * t11[k - 1]
        left[k] = one / (one + (1 - q) * t00[k - 1] + q * t10[k - 1])
    for k in range(strips - 2, -1, -1):
        q = right[k + 1]
        one = t10[k + 1] * (1 - q) + t11[k + 1] * q
        right[k] = one / (one + t00[k + 1] * (1 - q) + t01[k + 1] * q)
    forward, backward = np.empty((width, strips)), np.empty((width, strips))
    q = left
    for j in range(width):
        p = 1 - q
        one = p * m01[j] + q * m11[j]
        q = forward[j] = one / (one + p * m00[j] + q * m10[j])
    q = right
    for j in range(width - 1, -1, -1):
        backward[j] = q
        p = 1 - q
        one = m10[j] * p + m11[j] * q
        q = one / (one + m00[j] * p + m01[j] * q)
    return forward.T.reshape(-1)[:n], backward.T.reshape(-1)[:n]


def marginals(unary: np.ndarray, first: np.ndarray, start: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """P(state 1) per position. ``unary`` is state 1's potential; ``first`` marks where sequences begin."""
    n = len(unary)
    if not n:
        return np.zeros(0)
    forward, backward = _messages(_steps(unary, first, start, moves), n)
    one = forward * backward
    return one / (one + (1 - forward) * (1 - backward))


def log_likelihood_gradient(unary, first, start, moves, tags):
    """Gradient of the tag sequences' log-likelihood by (unary, start, moves)."""
    n = len(unary)
    m = _steps(unary, first, start, moves)
    forward, backward = _messages(m, n)
    one = forward * backward
    p = one / (one + (1 - forward) * (1 - backward))
    inner = np.flatnonzero(~first)
    before, after = forward[inner - 1], backward[inner]
    pair = np.stack([x[inner] * f * b for x, (f, b) in zip(m, ((1 - before, 1 - after), (1 - before, after), (before, 1 - after), (before, after)))])
    expected = (pair / pair.sum(axis=0)).sum(axis=1).reshape(2, 2)
    observed = np.zeros((2, 2))
    np.add.at(observed, (tags[inner - 1].astype(int), tags[inner].astype(int)), 1.0)
    d_unary = tags - p
    d_start = float(d_unary[first].sum())
    return d_unary, np.array([-d_start, d_start]), observed - expected
