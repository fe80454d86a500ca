import numpy as np
import pandas as pd
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from parley.functions import batches
from parley.operators import inference


@given(st.lists(st.integers(0, 50)), st.integers(1, 60))
def test_pieces_cover_all_rows_in_order(sizes, limit):
    found = list(batches.pieces(np.array(sizes, np.int64), limit))
    assert [i for a, b in found for i in range(a, b)] == list(range(len(sizes)))
    assert all(sum(sizes[a:b - 1]) <= limit for a, b in found)


def test_frames_and_batches():
    texts = pd.Series(["ab", None, "", "cdef", "g"], index=[4, 5, 6, 7, 8])
    assert batches.by_pieces(texts, lambda s: s.fillna("-") + "!", None, 2).tolist() == ["ab!", "-!", "!", "cdef!", "g!"]
    assert batches.by_pieces(texts.iloc[:0], str.upper, "none") == "none"
    batch = pa.RecordBatch.from_pydict({"t": texts.tolist(), "n": [1, 2, 3, 4, 5]})
    assert sum((b.column(1).to_pylist() for b in batches.batch_pieces(iter([batch]), 2)), []) == [1, 2, 3, 4, 5]


def test_calls_one_by_one_hold_pieces_of_a_batch():
    mb = batches.PIECE_BYTES
    rows = ["a" * mb, "b", None, "c" * (2 * mb), "d", "e" * (mb // 2)]
    for kind in (pa.string(), pa.binary()):
        batch = pa.RecordBatch.from_arrays(
            [pa.array(range(6), pa.int64()), pa.array([None] * 4 + ["guarded", None], pa.string()),
             pa.array(rows, pa.string()).cast(kind)], ["i", "_guard", "payload"])

        def run(concurrency, batch=batch):
            call = inference._call_partition(lambda p: (200, f"{p[:1]!r} {len(p)} " + "x" * len(p)),
                                             "payload", "_guard", ["i"], concurrency)
            return list(call(iter([batch])))
        found, together = run(1), run(2)
        assert [b.num_rows for b in together] == [6]               # calls in flight together keep all rows
        assert [b.num_rows for b in found] == [1, 3, 2]            # a piece ends with the row that fills it
        assert pa.Table.from_batches(found).to_pylist() == together[0].to_pylist()
        assert [r["_status"] for r in together[0].to_pylist()] == [200, 200, None, 200, None, 200]
