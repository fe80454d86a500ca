"""Run in a subprocess by test_chunk_files.py: a writer that dies in the middle
of each task's first attempt."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from parley.session import build_session  # noqa: E402
from parley.sinks import chunk_files  # noqa: E402


class DyingWriter(chunk_files.ChunkFileWriter):
    def write(self, iterator):
        from pyspark import TaskContext

        def some():
            for k, batch in enumerate(iterator):
                for at in range(batch.num_rows):
                    if k + at == 3 and TaskContext.get().attemptNumber() == 0:
                        os._exit(3)
                    yield batch.slice(at, 1)
        return super().write(some())


class DyingFiles(chunk_files.ChunkFiles):
    def writer(self, schema, overwrite):
        return DyingWriter(self.options["path"], overwrite)


def main() -> None:
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark = build_session(master="local[2,3]", shuffle_partitions=2)
    chunk_files.ChunkFiles = DyingFiles
    chunks = spark.range(40).repartition(4).select(
        F.concat(F.lit("/calls/"), F.col("id") % 5).alias("full_path"), F.lit("same_id").alias("file_id"),
        F.floor(F.col("id") / 5).alias("chunk_idx"),
        F.concat(F.lit("bytes of "), F.col("id")).cast("binary").alias("payload"))
    print(json.dumps(chunk_files.write_chunk_files(chunks, sys.argv[1])))


if __name__ == "__main__":
    main()
