from hypothesis import given, settings
from hypothesis import strategies as st

from parley.config import ChunkSpec
from parley.operators import chunking

SPEC = ChunkSpec()  # 300000 ms, 1500 ms overlap, step 298500


def _plan(spark, lengths, spec=SPEC):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "id long, len long")
    rows = chunking.plan_chunks(df, "len", spec).orderBy("id", "chunk_idx").collect()
    out = {}
    for r in rows:
        out.setdefault(r.id, []).append((r.chunk_idx, r.chunk_start, r.chunk_end, r.num_chunks))
    return [out[i] for i in range(len(lengths))]


def test_literal_chunk_counts(spark):
    # FIXTURES: 0->1; 300000->1; 300001->2; 597000->3 (last empty);
    # 597500->3 (last inside the previous); 900000->4
    plans = _plan(spark, [0, 300000, 300001, 597000, 597500, 900000])
    assert [len(p) for p in plans] == [1, 1, 2, 3, 3, 4]
    assert plans[0] == [(0, 0, 0, 1)]
    assert plans[2] == [(0, 0, 300000, 2), (1, 298500, 300001, 2)]
    assert plans[3][-1] == (2, 597000, 597000, 3)          # empty last chunk
    assert plans[4][-1] == (2, 597000, 597500, 3)          # inside chunk 1
    assert plans[4][1] == (1, 298500, 597500, 3)


def test_drop_empty(spark):
    plans = _plan(spark, [597000], ChunkSpec(drop_empty=True))
    assert [c[:3] for c in plans[0]] == [(0, 0, 300000), (1, 298500, 597000)]
    assert plans[0][0][3] == 2


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=3_000_000), min_size=1, max_size=8))
def test_plan_covers_without_gaps(spark, lengths):
    for n, plan in zip(lengths, _plan(spark, lengths)):
        assert plan[0][1] == 0
        assert max(c[2] for c in plan) == n
        for (_, s0, e0, _), (_, s1, _, _) in zip(plan, plan[1:]):
            assert s1 <= e0                      # overlap, no gap
        for _, s, e, _ in plan:
            assert e - s <= SPEC.max_len


def test_chunk_text_matches_python_slices(spark):
    text = "abcdefghij" * 7
    df = spark.createDataFrame([(1, text)], "id long, text string")
    spec = ChunkSpec(max_len=20, overlap=5)
    rows = chunking.chunk_text(df, "text", spec).orderBy("chunk_idx").collect()
    step = spec.step
    n = len(text) // step + 1
    assert [r.chunk_text for r in rows] == [text[i * step:i * step + 20] for i in range(n)]
    assert all(r.num_chunks == n for r in rows)
