"""Waveform helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PCM16_SCALE = 32767.0
PCM16_MIN = -32768
PCM16_MAX = 32767


def pcm16(samples: str | Column) -> Column:
    """Float samples in [-1, 1] -> signed 16-bit PCM.

    Multiply by 32767 in single precision, clip to [-32768, 32767] and
    truncate toward zero, the way a float32 array cast to int16 behaves.
    """
    arr = F.col(samples) if isinstance(samples, str) else samples
    scale = F.lit(PCM16_SCALE).cast("float")

    def quantize(x):
        y = x.cast("float") * scale
        y = F.greatest(F.least(y, F.lit(float(PCM16_MAX)).cast("float")),
                       F.lit(float(PCM16_MIN)).cast("float"))
        return y.cast("short")

    return F.transform(arr, quantize)
