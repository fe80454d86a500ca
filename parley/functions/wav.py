"""PCM16 / WAV bytes as JVM column expressions (no Python).

Little-endian integers are written through hex strings, so a WAV header
and its samples are built in codegen, linear in the number of samples.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WAV_HEADER_BYTES = 44


def _le_hex(x: Column, nbytes: int) -> Column:
    """Hex text of ``x`` as an unsigned little-endian integer of ``nbytes``."""
    mask = (1 << (8 * nbytes)) - 1
    h = F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(mask))), 2 * nbytes, "0")
    h = F.substring(h, -2 * nbytes, 2 * nbytes)
    return F.concat(*[F.substring(h, 2 * nbytes - 2 * i - 1, 2) for i in range(nbytes)])


def le_bytes(x: Column, nbytes: int) -> Column:
    return F.unhex(_le_hex(x, nbytes))


def pcm16_bytes(samples: Column) -> Column:
    """``array<short>`` -> little-endian PCM16 bytes."""
    return F.unhex(F.array_join(F.transform(samples, lambda s: _le_hex(s, 2)), ""))


def wav_header(data_bytes: Column, sample_rate: int | Column, channels: int = 1) -> Column:
    """Canonical 44-byte PCM16 WAV header for ``data_bytes`` of samples."""
    rate = sample_rate if isinstance(sample_rate, Column) else F.lit(sample_rate)
    block = 2 * channels
    ascii_ = lambda s: F.lit(s).cast("binary")
    return F.concat(
        ascii_("RIFF"), le_bytes(data_bytes + F.lit(36), 4), ascii_("WAVE"),
        ascii_("fmt "), le_bytes(F.lit(16), 4), le_bytes(F.lit(1), 2), le_bytes(F.lit(channels), 2),
        le_bytes(rate, 4), le_bytes(rate * F.lit(block), 4), le_bytes(F.lit(block), 2),
        le_bytes(F.lit(16), 2), ascii_("data"), le_bytes(data_bytes, 4))


def wav_file(pcm: Column, sample_rate: int | Column, channels: int = 1) -> Column:
    """WAV bytes for PCM16 ``pcm`` bytes."""
    return F.concat(wav_header(F.octet_length(pcm).cast("long"), sample_rate, channels), pcm)


def silence_wav(seconds: float = 1.0, sample_rate: int = 16_000) -> Column:
    """A mono PCM16 WAV of zeros, e.g. a warm-up payload for an endpoint."""
    n = int(round(seconds * sample_rate))
    return wav_file(F.unhex(F.lit("00" * (2 * n))), sample_rate)
