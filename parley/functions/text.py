"""String helpers: previews, cuts, payload sizes, list encoding, tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley import config

# Letters only; the same class works in Java and RE2 regex engines.
TOKEN_PATTERN = r"[^\p{L}]+"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def preview(c: str | Column, n: int = config.PREVIEW_CHARS) -> Column:
    """First ``n`` characters (``LEFT(c, n)``)."""
    return F.left(_col(c), F.lit(n))


def byte_length(c: str | Column) -> Column:
    return F.octet_length(_col(c)).cast("long")


def base64_length(nbytes: str | Column) -> Column:
    """Length of unwrapped base64 text for ``nbytes`` input bytes.

    Computed arithmetically: Spark's ``base64()`` may insert MIME line breaks,
    the wire format does not.
    """
    n = _col(nbytes).cast("long")
    return (F.lit(4) * F.floor((n + F.lit(2)) / F.lit(3))).cast("long")


def payload_size(nbytes: str | Column, envelope: int = config.PAYLOAD_ENVELOPE_BYTES) -> Column:
    """Bytes of the JSON request for ``nbytes`` of audio."""
    return base64_length(nbytes) + F.lit(envelope)


def mib(nbytes: str | Column) -> Column:
    return _col(nbytes) / F.lit(1024.0 * 1024.0)


def format_mib(nbytes: str | Column, decimals: int = 2) -> Column:
    """``12.34`` – two decimals as the size messages print them (the file
    inventory prints one)."""
    return F.format_string(f"%.{decimals}f", mib(nbytes))


def encode_list(arr: str | Column, sep: str = config.CHUNK_PATH_SEPARATOR) -> Column:
    return F.array_join(_col(arr), sep)


def decode_list(s: str | Column, sep: str = config.CHUNK_PATH_SEPARATOR) -> Column:
    """Inverse of :func:`encode_list`; ``split`` takes a regex, so escape."""
    import re
    return F.split(_col(s), re.escape(sep))


def tokens(c: str | Column, min_len: int = 1) -> Column:
    """Lower-cased letter runs of ``c`` as an array (empty strings removed)."""
    arr = F.split(F.lower(_col(c)), TOKEN_PATTERN)
    return F.filter(arr, lambda t: F.length(t) >= F.lit(max(min_len, 1)))


def build_prompt(text: str | Column, prompt: str) -> Column:
    """Prompt + transcript as a column expression (NULL text gives NULL).

    Built with ``concat`` rather than spliced into SQL text, so quotes in
    the prompt or transcript cannot break a statement.
    """
    return F.concat(F.lit(prompt), _col(text))
