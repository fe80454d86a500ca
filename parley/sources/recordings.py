"""Recording listings derived from the conversation and document tables.

A conversation is a recorded call: every turn is one chunk of it, in turn
order.  A document is one long recording whose length axis (characters)
is chunked like audio milliseconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions import paths, pcm, wav

CALL_ROOT = "/recordings"
TEAMS = 10  # calls are filed under team_0 .. team_9 by conversation id


def call_keys(conv_id: str = "conv_id"):
    """Key columns of a call, computed per row (narrow, no shuffle)."""
    cid = F.col(conv_id)
    folder = F.concat(F.lit("team_"), (cid % F.lit(TEAMS)).cast("string"))
    name = paths.recording_name(cid)
    full = F.concat_ws("/", F.lit(CALL_ROOT), folder, name)
    return [folder.alias("parent_folder"), name.alias("filename"), full.alias("full_path"),
            paths.file_id(folder, name).alias("file_id")]


def call_chunks(conversations: DataFrame) -> DataFrame:
    """One row per recorded turn: call keys, ``chunk_idx`` and the payload."""
    return conversations.select(
        "conv_id", *call_keys(), F.col("turn").alias("chunk_idx"), "role",
        F.col("text").alias("payload"))


def document_recordings(documents: DataFrame) -> DataFrame:
    """One row per document, filed as ``/corpus/{lang}/{source}/doc_{id}.wav``;
    ``length`` in characters (the chunked axis), ``nbytes`` its size."""
    full = F.format_string("/corpus/%s/%s/doc_%d.wav", F.col("lang"), F.col("source"),
                           F.col("doc_id"))
    return (documents.select("doc_id", full.alias("path"), "text",
                             F.char_length("text").cast("long").alias("length"),
                             F.octet_length("text").cast("long").alias("nbytes"))
            .transform(paths.with_path_parts))


def page_recordings(pages: DataFrame) -> DataFrame:
    """Web pages as a file listing: the URL is the path (hosts are roots)."""
    return pages.select("page_id", F.col("url").alias("path"),
                        F.octet_length("html").cast("long").alias("length")).transform(
        paths.with_path_parts)


EMBEDDING_SAMPLE_RATE = 8_000   # vectors are read as 8 kHz telephone audio


def embedding_recordings(embeddings: DataFrame, rate: int = EMBEDDING_SAMPLE_RATE) -> DataFrame:
    """Embedding vectors as short mono recordings: samples -> PCM16 -> WAV
    bytes (``content``), filed under ``/embeddings/label_{label}/``."""
    full = F.format_string("/embeddings/label_%d/vec_%d.wav", F.col("label"), F.col("vec_id"))
    content = wav.wav_file(wav.pcm16_bytes(pcm.pcm16("embedding")), rate)
    return (embeddings.select("vec_id", full.alias("path"), content.alias("content"))
            .withColumn("length", F.octet_length("content").cast("long"))
            .transform(paths.with_path_parts))
