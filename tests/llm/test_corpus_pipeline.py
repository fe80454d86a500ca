import os
import random
import sys
import tempfile
import zlib
from array import array

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
import public_tokenizers  # noqa: E402
from parley.llm import quality, queries, simhash, substring, toxicity  # noqa: E402
from parley.llm.words import ascii_words, crc_mod  # noqa: E402


@pytest.fixture(scope="module")
def corpus(spark):
    """Clean prose, toxic, low-quality, copies, near copies and a shared passage."""
    rnd = random.Random(21)
    syllables = [a + b for a in "bdfgklmnprstv" for b in ("a", "e", "i", "o", "un", "er")]
    vocab = ["".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 3))) for _ in range(900)]

    def prose(sentences):
        return " ".join(" ".join(rnd.choice(vocab) for _ in range(rnd.randint(6, 14))).capitalize() + "."
                        for _ in range(sentences))
    docs, labels = {}, {}
    for i in range(400):
        docs[i], labels[i] = prose(rnd.randint(5, 25)), (1, 0)
    for i in range(400, 460):
        docs[i] = prose(6) + f" You {rnd.choice(['grolk', 'grolken', 'vammit'])}. " + prose(3)
        labels[i] = (1, 1)
    for i in range(460, 520):
        docs[i] = " | ".join(prose(8).split()) if i % 2 else " ".join([rnd.choice(vocab)] * 150)
        labels[i] = (0, 0)
    passage = " ".join(rnd.choice(vocab) for _ in range(60))
    for i in (10, 50, 90):
        docs[i] += " " + passage + " " + prose(4)
    for i in range(520, 530):
        docs[i] = docs[i - 420]                               # exact copies
    long = prose(150)
    docs[530], docs[531] = long, long + " tail"               # near copies
    docs[532], docs[533] = "", None
    rows = [(k, t, "en", f"s{k % 3}", None if t is None else len(t)) for k, t in docs.items()]
    folder = tempfile.mkdtemp(prefix="parley-corpus-")
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"
                          ).repartition(5).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, *v) for k, v in labels.items()], "doc_id bigint, quality int, toxic int"
                          ).write.parquet(f"{folder}/labels.parquet")
    return folder, docs


def _stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, apply in corpus_pipeline.STAGES:
        before, docs = docs, apply(spark, docs, folder)
        path = os.path.join(tempfile.mkdtemp(prefix="parley-stage-"), "out")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        yield name, before, docs


def test_every_stage_against_plain_python(spark, corpus):
    folder, texts = corpus
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    stages = {name: (before, after) for name, before, after in _stages(spark, folder)}
    assert list(stages) == ["toxicity", "quality classifier", "SimHash near-dedup", "substring dedup",
                            "best-fit packing"]
    for name in list(stages)[:-1]:
        before, after = stages[name]
        assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert [f.dataType for f in after.schema] == [f.dataType for f in before.schema]

    def held(frame):
        return {r["doc_id"]: r["text"] for r in frame.collect()}

    before, after = stages["toxicity"]
    grammar = toxicity.learn(before, labels, crc_mod("doc_id", 4) != 2)
    import numpy as np
    expected = {k: t for k, t in held(before).items()
                if grammar.score(np.array([grammar.matches(t)], float))[0] < 0.3}
    assert held(after) == expected
    assert not set(range(400, 460)) & set(expected) and set(range(400)) <= set(expected)

    before, after = stages["quality classifier"]
    ranker = quality.learn(before, labels, crc_mod("doc_id", 5) != 0)
    expected = {k: t for k, t in held(before).items()
                if ranker.score(np.array([quality.document_features(t)]))[0] >= 0.3}
    assert held(after) == expected
    assert not set(range(460, 520)) & set(expected) and set(range(400)) <= set(expected)

    before, after = stages["SimHash near-dedup"]
    given = sorted(held(before).items())
    fps = [simhash.simhash(ascii_words(t)) & (2 ** 64 - 1) for _, t in given]
    parent = list(range(len(given)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(given)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    expected = {k: t for i, (k, t) in enumerate(given) if top(i) == i}
    assert held(after) == expected
    assert not set(range(520, 530)) & set(expected) and 531 not in expected

    before, after = stages["substring dedup"]
    seen, expected = set(), {}
    for k, t in sorted(held(before).items()):
        words = ascii_words(t, lower=False)
        gone = [False] * len(words)
        for i in range(len(words) - substring.WINDOW + 1):
            window = tuple(words[i:i + substring.WINDOW])
            if window in seen:
                gone[i:i + substring.WINDOW] = [True] * substring.WINDOW
            seen.add(window)
        expected[k] = t if not any(gone) else b" ".join(
            w for w, g in zip(words, gone, strict=True) if not g).decode()
    assert held(after) == expected
    assert len(expected[50].split()) <= len(texts[50].split()) - 60

    before, after = stages["best-fit packing"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = set()
    for k, t in held(before).items():
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        pieces |= {(k, s // 2048, s, len(ids[s:s + 2048]),
                    zlib.crc32(array("I", ids[s:s + 2048]).tobytes())) for s in range(0, len(ids), 2048)}
    rows = after.collect()
    assert {tuple(r[:5]) for r in rows} == pieces and len(rows) == len(pieces)
    total = after.agg(F.sum("length")).first()[0]
    assert len({r["sequence_id"] for r in rows}) <= -(-total // 2048) + 2


def test_run_gives_the_stages_result(spark, corpus):
    folder, _ = corpus
    whole = corpus_pipeline.run(spark, folder).drop("sequence_id", "offset").collect()
    *_, (_, _, last) = _stages(spark, folder)
    assert sorted(map(tuple, whole)) == sorted(map(tuple, last.drop("sequence_id", "offset").collect()))


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)
