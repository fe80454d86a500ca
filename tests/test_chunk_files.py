import json
import os
import subprocess
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

from parley.sinks import chunk_files


def _found(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names
            if not f.startswith((".", "_"))}


def _chunks(spark, rows):
    return spark.createDataFrame(rows, "full_path string, file_id string, chunk_idx int, payload binary")


def test_every_chunk_is_a_file_and_comes_back(spark):
    root = tempfile.mkdtemp(prefix="parley-files-")
    # ids collide: a_b/c and a/b_c
    rows = [(p, "a_b_c", i, f"{p} {i}".encode()) for p in ("/x/a_b/c", "/x/a/b_c") for i in range(12)]
    rows += [("/x/empty", "e", 0, b""), ("/x/none", "n", 0, None), (None, None, None, b"?"),
             ("/x/_h", "_h", 0, b"hidden")]
    chunks = _chunks(spark, rows).repartition(3)
    done = chunk_files.write_chunk_files(chunks, root)
    assert done == {"files": 27, "bytes": sum(len(r[3] or b"") for r in rows)}
    files = _found(root)
    assert len(files) == 27 and not os.listdir(os.path.join(root, "_staging"))
    named = chunks.select("*", chunk_files.chunk_file(
        F.col("full_path"), F.col("file_id"), F.col("chunk_idx"), root).alias("name")).collect()
    for r in named:
        if r["payload"] is not None:
            with open(r["name"], "rb") as f:
                assert f.read() == bytes(r["payload"])
    meta = spark.createDataFrame([("/x/a_b/c", "a_b_c", 12), ("/x/a/b_c", "a_b_c", 12), ("/x/none", "n", 1),
                                  ("/x/_h", "_h", 1)],
                                 "full_path string, file_id string, n int").select(
        "full_path", "file_id", chunk_files.chunk_addresses(
            F.col("full_path"), F.col("file_id"), F.col("n"), root).alias("chunk_paths"))
    back = {(r["full_path"], r["chunk_idx"]): r["payload"] for r in
            chunk_files.read_chunk_files(spark, meta, root).collect()}
    assert len(back) == 26 and back.pop(("/x/none", 0)) is None
    assert bytes(back.pop(("/x/_h", 0))) == b"hidden"
    assert all(bytes(v) == f"{p} {i}".encode() for (p, i), v in back.items())


def test_a_killed_attempt_leaves_one_file_a_chunk():
    root = tempfile.mkdtemp(prefix="parley-files-")
    job = os.path.join(os.path.dirname(os.path.abspath(__file__)), "chunk_file_job.py")
    out = subprocess.run([sys.executable, job, root], capture_output=True, text=True, timeout=600)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("{")]
    assert line, out.stderr[-2000:]
    assert json.loads(line[-1])["files"] == 40
    files = _found(root)
    assert len(files) == 40 and not os.listdir(os.path.join(root, "_staging"))
    held = sorted(open(f).read() for f in files)
    assert held == sorted(f"bytes of {i}" for i in range(40))


def test_an_abort_is_no_finished_output(spark):
    root = tempfile.mkdtemp(prefix="parley-files-")
    bad = _chunks(spark, [(f"/p{i}", "p", i, b"x") for i in range(20)]).withColumn(
        "payload", F.when(F.col("chunk_idx") == 13, F.raise_error(F.lit("lost"))).otherwise(F.col("payload")))
    with pytest.raises(Exception, match="lost"):
        chunk_files.write_chunk_files(bad, root)
    assert not os.listdir(os.path.join(root, "_staging"))
    with pytest.raises(FileNotFoundError):
        chunk_files.totals(root)
    assert chunk_files.write_chunk_files(_chunks(spark, []), root) == {"files": 0, "bytes": 0}
    with pytest.raises(Exception, match="finished output"):
        chunk_files.write_chunk_files(_chunks(spark, []), root, overwrite=False)
