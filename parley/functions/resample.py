"""Windowed-sinc polyphase resampling in exact integers.

Output n stands at input position n * down / up.  Its value is the sum of
the input samples around there, weighted by a low-pass filter whose cutoff
is the lower of the two Nyquist frequencies.  Samples and weights are
integers of ``BITS`` fraction bits and are added up exactly, so an output
depends on nothing but the samples around it: blocks of any size, and tasks
that hold a part of a recording each, give the same samples.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from math import ceil, gcd

import numpy as np

BITS = 28                # fraction bits of samples and weights
ZEROS = 24               # zero crossings of the sinc on each side
ROLLOFF = 0.95           # of the target's Nyquist frequency, when it is the lower one
# The four-term Blackman-Harris window.
WINDOW = (0.35875, 0.48829, 0.14128, 0.01168)
_OUTPUTS = 1 << 14       # outputs worked out at once


@lru_cache(maxsize=4)
def weights(up: int, down: int) -> np.ndarray:
    """Integer weights, one row for each of the ``up`` phases; every row adds up to 2**BITS."""
    cutoff = 1.0 if up >= down else ROLLOFF * up / down
    half = ceil(ZEROS / cutoff)
    t = np.arange(1 - half, half + 1)[None, :] - np.arange(up)[:, None] / up
    turn = np.pi * t / half
    window = sum(a * np.cos(k * turn) for k, a in enumerate(WINDOW))
    row = cutoff * np.sinc(cutoff * t) * np.where(np.abs(t) <= half, window, 0)
    found = np.round(row * (1 << BITS)).astype(np.int64)
    found[:, half - 1] += (1 << BITS) - found.sum(axis=1)    # a constant stays as it is
    return found


class Resampler:
    """From ``rate`` to ``target`` samples a second."""

    def __init__(self, rate: int, target: int):
        common = gcd(rate, target)
        self.up, self.down = target // common, rate // common
        self.weights = weights(self.up, self.down) if self.up != self.down else np.ones((1, 2), np.int64)
        self.half = self.weights.shape[1] // 2

    def length(self, frames: int) -> int:
        """Outputs of a recording of so many input samples."""
        return int(round(frames * self.up / self.down))

    def inputs(self, first: int, stop: int, frames: int) -> tuple[int, int]:
        """The input samples that outputs ``first`` to before ``stop`` are made of."""
        low = first * self.down // self.up - self.half + 1
        high = (stop - 1) * self.down // self.up + self.half + 1
        return min(max(0, low), frames), min(frames, max(0, high))

    def pcm16(self, samples: Callable[[int, int], np.ndarray], frames: int, first: int,
              stop: int) -> np.ndarray:
        """Outputs ``first`` to before ``stop`` as 16-bit samples.

        ``samples(a, b)`` gives input samples a to before b as floats in
        [-1, 1).  Before its begin and after its end a recording goes on
        with its first and last sample.
        """
        out = np.zeros(max(0, stop - first), "<i2")
        for at in range(first, stop, _OUTPUTS):
            to = min(at + _OUTPUTS, stop)
            low, high = self.inputs(at, to, frames)
            if high <= low:
                continue                       # no samples at all
            x = np.round(samples(low, high) * (1 << BITS)).astype(np.int64)
            if self.up == self.down:
                value = x[at - low:to - low] << BITS
            else:
                place = np.arange(at, to, dtype=np.int64) * self.down
                base = place // self.up
                begin = int(base[0]) - self.half + 1
                end = int(base[-1]) + self.half + 1
                x = np.pad(x, (max(0, low - begin), max(0, end - high)), "edge")
                around = np.lib.stride_tricks.sliding_window_view(x, 2 * self.half)
                value = np.einsum("ij,ij->i", around[base - base[0]], self.weights[place % self.up])
            value = (value + (1 << (2 * BITS - 16))) >> (2 * BITS - 15)
            out[at - first:to - first] = np.clip(value, -32768, 32767)
        return out
