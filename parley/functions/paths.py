"""Path-derived keys of recordings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley import config


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def path_segment(path: str | Column, from_end: int) -> Column:
    """Segment ``from_end`` counted from the end (-1 = basename).

    ``try_element_at`` keeps short paths NULL instead of failing under ANSI.
    """
    return F.try_element_at(F.split(_col(path), "/"), F.lit(from_end))


def basename(path: str | Column) -> Column:
    return path_segment(path, -1)


def parent_folder(path: str | Column) -> Column:
    return path_segment(path, -2)


def file_id(folder: str | Column, name: str | Column) -> Column:
    """Surrogate id: folder and name joined with ``_``, every ``/`` and ``.``
    mapped to ``_``.  Not injective: ``(a_b, c.wav)`` and ``(a, b_c.wav)``
    give the same id, see :func:`parley.operators.reports.file_id_collisions`.
    """
    return F.regexp_replace(F.concat_ws("_", _col(folder), _col(name)), "[/.]", "_")


def strip_prefix(path: str | Column, prefix: str, replacement: str = "") -> Column:
    """Literal prefix rewrite (e.g. a URI scheme) anywhere in the string."""
    return F.replace(_col(path), F.lit(prefix), F.lit(replacement))


def recording_name(index: str | Column, fmt: str = config.RECORDING_NAME_FORMAT) -> Column:
    """``conversation_007.wav``; widens past three digits like a format spec."""
    return F.format_string(fmt, _col(index))


def with_path_parts(df, path_col: str = "path"):
    """Discovery projection: filename, parent_folder, full_path, file_id."""
    return (df.withColumn("filename", basename(path_col))
              .withColumn("parent_folder", parent_folder(path_col))
              .withColumn("full_path", F.col(path_col))
              .withColumn("file_id", file_id("parent_folder", "filename")))
