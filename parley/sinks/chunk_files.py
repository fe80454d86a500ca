"""A data source that writes every chunk as a file of its own, and reads them back.

The name of a chunk's file follows from the recording's path and the chunk's
number alone: ``<root>/<h>/<digest>/{file_id}_chunk{i}.wav``, with a digest
of the whole path, because different paths can share a ``file_id``, and its
first two digits ``h`` so that no folder holds all recordings.

A task writes to a staging folder of its own attempt and moves a file to its
name when it is whole.  A killed attempt leaves only staged files; the next
one writes the same names again.  The commit removes the staging folder and
writes the totals that the tasks' messages add up to into ``_SUCCESS``; an
abort removes the staging folder, and without ``_SUCCESS`` the folder is not
a finished output.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from parley import config
from parley.sources.files import open_store

NAMES = ("full_path", "file_id", "chunk_idx", "payload")
SUCCESS = "_SUCCESS"


def chunk_file(full_path: Column, file_id: Column, idx: Column, root: str) -> Column:
    """The address of a chunk's file.

    A null path counts as empty text, a null or empty id as ``unknown``, a
    null chunk number as -1.  An id that begins with ``_`` or ``.``, which
    Spark's readers would take for a hidden file, gets a ``-`` before it.
    """
    given = F.coalesce(F.nullif(file_id, F.lit("")), F.lit("unknown"))
    file_id = F.when(given.rlike("^[_.]"), F.concat(F.lit("-"), given)).otherwise(given)
    digest = F.sha2(F.coalesce(full_path, F.lit("")).cast("binary"), 256)
    name = F.format_string(config.CHUNK_FILE_FORMAT, file_id,
                           F.coalesce(idx.cast("long"), F.lit(-1).cast("long")))
    return F.concat_ws("/", F.lit(root.rstrip("/")), F.left(digest, F.lit(2)),
                       F.left(digest, F.lit(32)), name)


@dataclass
class Written(WriterCommitMessage):
    files: int
    bytes: int


class ChunkFileWriter(DataSourceArrowWriter):
    """Rows (relative name, payload) to files below ``root``."""

    def __init__(self, root: str, overwrite: bool):
        self.root, self.run = root, uuid.uuid4().hex
        store, path, _ = open_store(root)
        store.create_dir(path, recursive=True)
        done = store.get_file_info(f"{path}/{SUCCESS}")
        if done.is_file:
            if not overwrite:
                raise FileExistsError(f"{root} holds a finished output; use mode('overwrite')")
            store.delete_file(done.path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, path, _ = open_store(self.root)
        staging = f"{path}/_staging/{self.run}/{uuid.uuid4().hex}"
        store.create_dir(staging, recursive=True)
        files = size = 0
        for batch in iterator:
            for name, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = payload.as_buffer()
                if data is None:
                    continue                       # a chunk without bytes has no file
                with store.open_output_stream(f"{staging}/chunk") as out:
                    out.write(data)
                store.create_dir(f"{path}/{name.rsplit('/', 1)[0]}", recursive=True)
                store.move(f"{staging}/chunk", f"{path}/{name}")
                files, size = files + 1, size + len(data)
        return Written(files, size)

    def _clear(self):
        store, path, _ = open_store(self.root)
        store.delete_dir_contents(f"{path}/_staging/{self.run}", missing_dir_ok=True)
        store.delete_dir(f"{path}/_staging/{self.run}")
        return store, path

    def commit(self, messages: list[Written | None]) -> None:
        store, path = self._clear()
        done = [m for m in messages if m is not None]
        totals = {"files": sum(m.files for m in done), "bytes": sum(m.bytes for m in done)}
        with store.open_output_stream(f"{path}/{SUCCESS}") as out:
            out.write(json.dumps(totals).encode())

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()


class ChunkFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "chunk_files"

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField("name", T.StringType()),
                             T.StructField("payload", T.BinaryType())])

    def writer(self, schema: T.StructType, overwrite: bool) -> ChunkFileWriter:
        return ChunkFileWriter(self.options["path"], overwrite)


def write_chunk_files(chunks: DataFrame, root: str, payload_col: str = "payload",
                      overwrite: bool = True) -> dict[str, int]:
    """Write one file for each chunk (K8); gives the numbers of files and bytes.

    Needs ``full_path, file_id, chunk_idx`` and the payload.  Rows whose
    payload is null write no file; rows of one path and number are one file,
    the bytes of either; an empty table writes only ``_SUCCESS``.
    """
    spark = chunks.sparkSession
    spark.dataSource.register(ChunkFiles)
    name = chunk_file(F.col("full_path"), F.col("file_id"), F.col("chunk_idx"), "")
    rows = chunks.select(F.ltrim(name, F.lit("/")).alias("name"), F.col(payload_col).alias("payload"))
    rows.write.format(ChunkFiles.name()).mode("overwrite" if overwrite else "append").save(root)
    return totals(root)


def totals(root: str) -> dict[str, int]:
    """What the last finished write of a folder held; an unfinished one raises."""
    store, path, _ = open_store(root)
    with store.open_input_stream(f"{path}/{SUCCESS}") as done:
        return json.loads(done.read())


def chunk_addresses(full_path: Column, file_id: Column, n: Column, root: str) -> Column:
    """All chunk addresses of a recording, in one ``|``-joined text (P11)."""
    idx = F.sequence(F.lit(0).cast("long"), (n - F.lit(1)).cast("long"))
    return F.array_join(F.transform(idx, lambda i: chunk_file(full_path, file_id, i, root)),
                        config.CHUNK_PATH_SEPARATOR)


def read_chunk_files(spark: SparkSession, metadata: DataFrame, root: str) -> DataFrame:
    """The chunks that a metadata table names, with their bytes as ``payload``.

    One row for each name in ``chunk_paths``, with the metadata's other
    columns and ``chunk_idx``; a file that is missing gives a null payload.
    """
    names = F.split("chunk_paths", "\\" + config.CHUNK_PATH_SEPARATOR)
    rest = [c for c in metadata.columns if c != "chunk_paths"]
    listed = metadata.where("chunk_paths IS NOT NULL").select(
        *rest, F.posexplode(names).alias("_i", "_address")).select(
        *rest, F.col("_i").cast("long").alias("chunk_idx"), "_address")
    # names below the root are the same whatever scheme the address has
    tail = F.substring_index(F.col("_address"), "/", -3)
    held = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.wav").load(root)
            .select(F.substring_index("path", "/", -3).alias("_name"), F.col("content").alias("payload")))
    return (listed.withColumn("_name", tail).join(held, "_name", "left")
            .select(*rest, "chunk_idx", "payload"))
