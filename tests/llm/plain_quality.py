"""The quality rules written plainly: one gram, one row and one weight at a time, grams by name instead of bucket."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np


def features(text):
    raw = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    lower = [w.lower() for w in words]
    families = [lower, list(zip(lower, lower[1:])), [raw[i : i + 4] for i in range(len(raw) - 3)]]
    return {(k, g): n / math.sqrt(len(grams)) for k, grams in enumerate(families) for g, n in Counter(grams).items()}


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-500, min(500, x))))


def score(weights, found):
    return sum(weights[f] * v for f, v in found.items())


def zero_of(gradient):
    """Where an increasing function is zero."""
    low, high = -200.0, 200.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (low, middle) if gradient(middle) > 0 else (middle, high)
    return low


def calibrated(scores, truth):
    """Slope and shift of least logistic loss with a small ridge, one after the other until both stand."""
    slope, shift = 1.0, 0.0
    s, t = np.array(scores), np.array(truth, dtype=float)

    def rest(a, b):
        return 1 / (1 + np.exp(-np.clip(a * s + b, -500, 500))) - t

    for _ in range(400):
        slope = zero_of(lambda a: (rest(a, shift) * s).sum() + 1e-2 * (a - 1))
        shift = zero_of(lambda b: rest(slope, b).sum() + 1e-2 * b)
    return slope, shift


def fitted(rows):
    """``(weights, slope, shift)`` of rows ``(doc_id, text, truth)``."""
    rows = sorted(rows, key=lambda r: r[0] * 0x9E3779B97F4A7C15 & 0xFFFFFFFF)
    found = [features(t) for _, t, _ in rows]
    held = [len(rows) >= 50 and i % 5 == 4 for i in range(len(rows))]
    learn = [i for i, h in enumerate(held) if not h]
    weights, squares = defaultdict(float), defaultdict(lambda: 1e-6)
    for epoch in range(8):
        order = np.random.default_rng(epoch).permutation(len(learn))
        for at in range(0, len(order), 64):
            picked = [learn[k] for k in order[at : at + 64]]
            gradient = defaultdict(float)
            for i in picked:
                error = (sigmoid(score(weights, found[i])) - rows[i][2]) / len(picked)
                for f, v in found[i].items():
                    gradient[f] += error * v
            for f, g in gradient.items():
                squares[f] += g * g
                weights[f] -= 0.05 * g / math.sqrt(squares[f])
    judge = [i for i, h in enumerate(held) if h] or learn
    return weights, *calibrated([score(weights, found[i]) for i in judge], [rows[i][2] for i in judge])


def probabilities(texts, rows):
    """Probability of each text being true, after fitting rows ``(doc_id, text, truth)``."""
    weights, slope, shift = fitted(rows)
    return [sigmoid(slope * score(weights, features(t)) + shift) for t in texts]
