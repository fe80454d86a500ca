from pyspark.sql import functions as F

from parley.config import SizeLimits
from parley.functions import json as jfn
from parley.functions import paths, pcm
from parley.functions import text as tfn
from parley.operators import inference


def test_path_parts_and_file_id_collision(spark):
    df = spark.createDataFrame([("/root/a_b/c.wav",), ("/root/a/b_c.wav",), ("x.wav",)], "path string")
    rows = df.transform(paths.with_path_parts).collect()
    assert rows[0].filename == "c.wav" and rows[0].parent_folder == "a_b"
    assert rows[0].file_id == rows[1].file_id == "a_b_c_wav"     # not injective
    assert rows[2].parent_folder is None                       # short path: NULL, no error
    assert rows[2].file_id == "x_wav"


def test_recording_name_widens(spark):
    r = spark.range(1).select(paths.recording_name(F.lit(7)).alias("a"),
                              paths.recording_name(F.lit(1234)).alias("b")).head()
    assert (r.a, r.b) == ("conversation_007.wav", "conversation_1234.wav")


def test_payload_size_and_guard(spark):
    lim = SizeLimits()
    assert lim.file_limit == 12_520_310
    df = spark.createDataFrame([(12_520_310,), (12_520_311,), (9_600_044,)], "n long")
    rows = df.select("n", tfn.payload_size("n").alias("p"),
                     inference.size_guard(F.col("n"), F.lit(0), F.lit(1), lim).alias("g")).collect()
    assert rows[0].g is None
    assert rows[1].g == "CHUNK_TOO_LARGE: Chunk 1/1 is 11.94 MB"
    assert rows[2].p == 12_800_105 and rows[2].g is None
    # PAYLOAD_TOO_LARGE is unreachable with the default limits
    assert rows[0].p < lim.max_payload_bytes


def test_base64_length_has_no_line_breaks(spark):
    import base64
    for n in (0, 1, 2, 3, 100, 1000):
        got = spark.range(1).select(tfn.base64_length(F.lit(n))).head()[0]
        assert got == len(base64.b64encode(b"x" * n))


def test_list_roundtrip(spark):
    df = spark.createDataFrame([(["a|b", "c"],)], "a array<string>")
    # the separator inside an element is the documented hazard of the encoding
    r = df.select(tfn.decode_list(tfn.encode_list("a")).alias("d")).head()
    assert r.d == ["a", "b", "c"]
    df = spark.createDataFrame([(["p/0.wav", "p/1.wav"],)], "a array<string>")
    assert df.select(tfn.decode_list(tfn.encode_list("a"))).head()[0] == ["p/0.wav", "p/1.wav"]


def test_parse_analysis_cases(spark):
    cases = [
        ('{"speaker_1":"A","speaker_2":"B","main_topics":"x","conversation_tone":"t","conversation_summary":"s"}',),
        ('{"speaker_1":"A"}',),            # missing fields
        ("bad",),                          # malformed
        ('{"a":"x"',),                     # truncated
        ("",),
        (None,),
        ('{"speaker_1": 5}',),             # number in a string field
        ('{"speaker_1": {"n": 1}}',),      # nested object
    ]
    df = spark.createDataFrame(cases, "conversation_analysis string")
    out = jfn.parse_analysis(df, drop_source=False).withColumn(
        "viol", jfn.contract_violations("conversation_analysis")).collect()
    assert out[0].speaker_1 == "A" and out[0].viol == []
    assert out[1].speaker_1 == "A" and out[1].speaker_2 is None
    assert out[1].viol == ["speaker_2", "main_topics", "conversation_tone", "conversation_summary"]
    for r in out[2:6]:
        assert r.speaker_1 is None and len(r.viol) == 5
    assert out[6].speaker_1 == "5" and "speaker_1" in out[6].viol    # stringified, still a violation
    assert out[7].speaker_1 == '{"n":1}' and "speaker_1" in out[7].viol


def test_response_decoding(spark):
    bodies = [
        (200, '{"predictions": [{"transcription": "hi"}]}'),
        (200, '{"dataframe_records": [{"transcription": "yo"}]}'),
        (200, '{"predictions": [{"other": 1}]}'),        # envelope without field -> ""
        (200, '{"something": 1}'),                      # neither envelope -> NULL
        (200, '{"predictions": [{"transcription": null, "error": "boom"}]}'),
        (503, "Service Unavailable"),                   # non-JSON error
        (400, '{"error_code": "BAD_REQUEST", "message": "too big"}'),
        (400, '{"message": "m"}'),
    ]
    df = spark.createDataFrame(bodies, "status int, body string")
    rows = df.select(jfn.response_transcription("body").alias("t"),
                     jfn.endpoint_error("status", "body").alias("e")).collect()
    assert [r.t for r in rows[:5]] == ["hi", "yo", "", None, None]
    assert rows[5].e == "ENDPOINT_ERROR: HTTP_503 - Service Unavailable"
    assert rows[6].e == "ENDPOINT_ERROR: BAD_REQUEST - too big"
    assert rows[7].e == "ENDPOINT_ERROR: UNKNOWN - m"


def test_pcm16_truncates_and_clips(spark):
    import numpy as np
    vals = [0.5, -0.5, 1.0, -1.0, 1.5, -1.5, 0.123456, -0.99999]
    df = spark.createDataFrame([(vals,)], "a array<float>")
    got = df.select(pcm.pcm16("a")).head()[0]
    want = np.clip(np.array(vals, dtype=np.float32) * 32767, -32768, 32767).astype(np.int16).tolist()
    assert got == want
