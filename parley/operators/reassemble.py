"""Ordered reassembly of per-chunk results into one row per recording.

``transcription_text`` = successful chunk texts joined by a space in chunk
order (NULL if none); ``error_message`` = chunk errors joined by ``"; "``
in chunk order, cut at 1000 characters (NULL if none).  A row may carry
both a text and an error.

Skew: a recording may hold a very large share of all chunks.  With
``fanout`` set, chunks are first concatenated per ``(key, chunk_idx //
fanout)`` block — spreading a hot key over many tasks, with map-side
partial aggregation — and only the ordered block strings meet in the
final per-key step.

The price is a second shuffle of the concatenated text for every key.  It
is deliberately not skipped for single-block keys: splitting the keys into
two branches makes Catalyst prune the branches differently, the shared
first-level exchange is then no longer reused, and the step below it (the
remote inference call) would run twice.  Text is small next to the audio
it came from, so the second shuffle is the cheaper side of that trade.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley import config
from parley.operators.inference import COUNT_MARK

DEFAULT_FANOUT = 512


def _ordered_join(order: Column, value: Column, sep: str) -> Column:
    """Aggregate: non-null ``value`` joined by ``sep`` in ``order``; NULL if none."""
    items = F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v"))))
    # sort_array and struct-field extraction are codegen'd (array_sort /
    # transform would evaluate a lambda per element); items are never NULL.
    joined = F.array_join(F.sort_array(items).getField("v"), sep)
    return F.when(F.count(value) > 0, joined)


def reassemble(chunks: DataFrame, keys: list[str], *, order_col: str = "chunk_idx",
               text_col: str = "chunk_text", error_col: str = "chunk_error",
               sums: list[str] = (), firsts: list[str] = (),
               fanout: int | None = DEFAULT_FANOUT, block_col: str | None = None,
               blocks_only: bool = False, full_errors: bool = False, full_col: str | None = None,
               text_sep: str = config.TEXT_SEPARATOR, error_sep: str = config.ERROR_SEPARATOR,
               error_chars: int = config.FILE_ERROR_CHARS) -> DataFrame:
    """Group chunks by ``keys``; adds ``num_chunks, transcription_text,
    error_message`` plus ``sum_<c>`` for each column in ``sums`` and the
    minimum of each column in ``firsts`` (key-constant attributes).

    ``block_col`` names an existing ``chunk_idx // fanout`` column.

    Errors whose chunk count is still open (:data:`inference.COUNT_MARK`) get
    it here, where it is known.  ``full_errors`` adds ``error_full``, the
    joined errors without the cut; ``full_col`` names a column of uncut chunk
    messages to take for it.

    ``blocks_only`` stops after the first level and returns one ordered row
    per ``(key, block)`` (``first_chunk``, ``num_chunks``, text, error): for
    a recording too large to hold its transcript in one row, consumers read
    the blocks in ``first_chunk`` order instead.
    """
    order, text, err = F.col(order_col), F.col(text_col), F.col(error_col)
    if fanout:
        block = F.col(block_col) if block_col else block_of(order, fanout)
        blocks = chunks.groupBy(*keys, block.alias("_block")).agg(
            F.min(order).alias("first_chunk"), F.count(F.lit(1)).cast("int").alias("num_chunks"),
            _ordered_join(order, text, text_sep).alias("transcription_text"),
            _ordered_join(order, err, error_sep).alias("error_message"),
            *([_ordered_join(order, F.col(full_col), error_sep).alias("error_whole")] if full_col else []),
            *[F.sum(c).alias(f"sum_{c}") for c in sums],
            *[F.min(c).alias(c) for c in firsts]).drop("_block")
        if blocks_only:
            return blocks
        return join_blocks(blocks, keys, sums=sums, firsts=firsts, full_errors=full_errors,
                           text_sep=text_sep, error_sep=error_sep, error_chars=error_chars)
    aggs = [F.count(F.lit(1)).cast("int").alias("num_chunks"),
            _ordered_join(order, text, text_sep).alias("transcription_text"),
            _ordered_join(order, err, error_sep).alias("error_full"),
            *([_ordered_join(order, F.col(full_col), error_sep).alias("error_whole")] if full_col else []),
            *[F.sum(c).alias(f"sum_{c}") for c in sums],
            *[F.min(c).alias(c) for c in firsts]]
    return _finish(chunks.groupBy(*keys).agg(*aggs), keys, error_chars, full_errors)


def join_blocks(blocks: DataFrame, keys: list[str], *, sums: list[str] = (), firsts: list[str] = (),
                full_errors: bool = False, text_sep: str = config.TEXT_SEPARATOR,
                error_sep: str = config.ERROR_SEPARATOR,
                error_chars: int = config.FILE_ERROR_CHARS) -> DataFrame:
    """One row per recording from the block rows of :func:`reassemble`."""
    first = F.col("first_chunk")
    aggs = [F.sum("num_chunks").cast("int").alias("num_chunks"),
            _ordered_join(first, F.col("transcription_text"), text_sep).alias("transcription_text"),
            _ordered_join(first, F.col("error_message"), error_sep).alias("error_full"),
            *([_ordered_join(first, F.col("error_whole"), error_sep).alias("error_whole")]
              if "error_whole" in blocks.columns else []),
            *[F.sum(f"sum_{c}").alias(f"sum_{c}") for c in sums],
            *[F.min(c).alias(c) for c in firsts]]
    return _finish(blocks.groupBy(*keys).agg(*aggs), keys, error_chars, full_errors)


def _finish(merged: DataFrame, keys: list[str], error_chars: int, full_errors: bool) -> DataFrame:
    """Fill in open chunk counts, cut the displayed message, order the columns."""
    def counted(name: str) -> Column:
        return F.replace(F.col(name), F.lit(COUNT_MARK), F.col("num_chunks").cast("string"))
    full = counted("error_whole" if "error_whole" in merged.columns else "error_full")
    rest = [c for c in merged.columns
            if c not in (*keys, "num_chunks", "transcription_text", "error_full", "error_whole")]
    return merged.select(
        *keys, "num_chunks", "transcription_text",
        F.left(counted("error_full"), F.lit(error_chars)).alias("error_message"),
        *rest, *([full.alias("error_full")] if full_errors else []))


def block_of(order: Column, fanout: int) -> Column:
    return F.floor(order / F.lit(fanout)).cast("long")
