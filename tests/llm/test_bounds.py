"""Ids beside nulls, bounds of samples, and features that read a text alike whatever it holds."""

import re
import unicodedata
from collections import Counter
from math import log1p

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from parley.llm import labelled, packing, presplit, quality

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def test_packing_keeps_large_ids_beside_nulls(spark):
    ids = [2**53 + 1, None, 2**53 + 3, None, -(2**60) - 1]
    docs = spark.createDataFrame([(k, f"text number {i}") for i, k in enumerate(ids)],
                                 "doc_id bigint, text string")
    rows = packing.pack(docs, VOCABULARY).collect()
    assert sorted((r["doc_id"] for r in rows), key=str) == sorted(ids, key=str)
    # rows of one id spread over groups
    many = spark.range(3000).select(F.lit(5).cast("long").alias("doc_id"),
                                    F.concat(F.lit("words "), "id").alias("text"))
    sizes = Counter(r["sequence_id"] >> 32 for r in packing.pack(many, VOCABULARY, group_bytes=4000).collect())
    assert len(sizes) > 5 and max(sizes.values()) < 1500


def test_word_ids_equal_the_library():
    split = presplit.Presplitter(VOCABULARY)
    text = "It's Ünïcode <|endoftext|> 日本 don't 12 — ... mentené\tAÉ naïve ﬁ I'LL 'tis ''s"
    words = split(text)
    want = split.tokenizer.encode(text, add_special_tokens=False).ids
    assert [i for w in words for i in split.ids(w)] == want
    small = presplit.WordCache(lambda w: w.encode(), limit=1000)
    assert [small[w] for w in words * 20] == [w.encode() for w in words * 20]
    assert small.held <= 1000 + 300 and len(small) < 8


def test_sample_bound_is_of_documents(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "good one")],
                                 "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id bigint, quality int")
    sample = labelled.labelled_sample(docs, labels, "quality", F.lit(True), 1, 2)
    assert sample.groupBy("_label").count().sort("_label").collect() == [(0, 2), (1, 1)]
    ranker = quality.learn(docs, labels, F.lit(True), ones=1, zeros=2)
    assert ranker.weights.any()


def _plain_features(text):
    """The features by one loop over characters, words and lines each."""
    words = (text or "").split()
    if not words:
        return [0.0] * 16
    n, chars = len(words), len(text)
    letters = digits = capitals = 0
    for c in text:
        kind = unicodedata.category(c)
        letters += kind[0] in "L" or kind in ("No", "Nl")
        digits += c in "0123456789"
        capitals += c.lower() != c
    spaces = chars - sum(len(w) for w in words)
    longest, run = 1, 1
    for a, b in zip(words, words[1:]):
        run = run + 1 if a == b else 1
        longest = max(longest, run)
    lines = [x for x in text.split("\n") if x.strip()]
    ends = sum(len(re.findall(r"\S[^\w\s]{2,}$", w)) for w in words)
    return [letters / chars, capitals / max(1, letters), digits / chars,
            (chars - letters - spaces - digits) / chars, sum(w == "|" for w in words) / n, ends / n,
            sum(c == "!" for c in text) / n, sum(w.isupper() for w in words) / n, len(set(words)) / n,
            max(Counter(words).values()) / n, sum(a == b for a, b in zip(words, words[1:])) / n,
            log1p(longest), sum(map(len, words)) / n / 10, len(lines) / n,
            1 - len(set(lines)) / max(1, len(lines)), log1p(n) / 10]


def test_features_equal_a_plain_loop(spark):
    texts = ["HELLO world İ", "HELLO world I", "", None, " \n", "a a a b!!! c... | 12\nx\nx\n\ny",
             "ÄÖ straße ² Ⅷ ΑΣ 日本", "one"]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in texts:
        assert quality.document_features(text) == pytest.approx(_plain_features(text), abs=1e-12)
    a, b = (quality.document_features(t)[1] for t in ("HELLO world İ", "HELLO world I"))
    assert a == b


def test_measured_rows_keep_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", 5.0, "k"), (2, None, None, None)],
                                 "doc_id bigint, text string, _x double, score string")
    features = quality.measured(docs, keep_rows=True)
    assert features.columns == [*docs.columns, "__x"]
    kept = quality.good_rows(features, quality.learn_measured(
        features, spark.createDataFrame([], "doc_id bigint, quality int"), F.lit(True)))
    assert sorted(map(tuple, kept.collect())) == [(1, "a b c", 5.0, "k"), (2, None, None, None)]
