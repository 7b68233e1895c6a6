"""Resampling by a polyphase filter bank: each phase of the output meets one row of taps, whatever the lengths."""

from __future__ import annotations

from functools import lru_cache
from math import gcd

import numpy as np

#: Zero crossings of the low pass on either side, and the shape of its window.
CROSSINGS, BETA = 16, 8.0


def ratio(rate: int, to: int) -> tuple[int, int]:
    """(up, down) in lowest terms."""
    g = gcd(rate, to)
    return to // g, rate // g


@lru_cache(maxsize=16)
def bank(up: int, down: int) -> tuple[np.ndarray, int]:
    """Taps of each phase (up, 2 * reach + 1), and how many input samples they reach to either side."""
    reach = -(-CROSSINGS * max(up, down) // up)
    # where the taps of phase p lie from the output, in input samples
    at = np.arange(-reach, reach + 1)[None, :] - np.arange(up)[:, None] / up
    cut = min(1.0, up / down)
    inside = np.clip(1 - (at / (reach + 1)) ** 2, 0, None)
    taps = cut * np.sinc(cut * at) * np.i0(BETA * np.sqrt(inside)) / np.i0(BETA)
    # a constant stays as it is in every phase
    return taps / taps.sum(axis=1, keepdims=True), reach


def length(n: int, up: int, down: int) -> int:
    return -(-n * up // down)


def span(first: int, last: int, up: int, down: int) -> tuple[int, int]:
    """The input samples, some beyond the ends, that outputs first to last (not included) are made of."""
    reach = bank(up, down)[1]
    return first * down // up - reach, (last - 1) * down // up + reach + 1


def outputs(x: np.ndarray, first: int, last: int, up: int, down: int) -> np.ndarray:
    """Outputs first to last of a signal, of which x is what span() asks for, with zeros beyond its ends."""
    taps, reach = bank(up, down)
    out = np.empty(last - first)
    begin = first * down // up - reach
    view = np.lib.stride_tricks.sliding_window_view(x.astype(np.float64), 2 * reach + 1)
    for r in range(min(up, last - first)):
        # outputs of one phase are `up` apart, and their inputs `down`
        at = np.arange(first + r, last, up) * down
        out[r::up] = view[at[0] // up - reach - begin :: down][: len(at)] @ taps[at[0] % up]
    return out


def resample(y: np.ndarray, rate: int, to: int = 16000) -> np.ndarray:
    """All of a signal at another rate, within -1 and 1; some hundred thousand outputs at a time."""
    if rate == to or not y.size:
        return y.astype(np.float32)
    up, down = ratio(rate, to)
    total, block = length(y.size, up, down), max(up, (1 << 17) // up * up)
    parts = []
    for first in range(0, total, block):
        last = min(first + block, total)
        a, b = span(first, last, up, down)
        x = np.pad(y[max(a, 0) : min(b, y.size)], (max(-a, 0), max(b - y.size, 0)))
        parts.append(np.clip(outputs(x, first, last, up, down), -1, 1).astype(np.float32))
    return np.concatenate(parts)
