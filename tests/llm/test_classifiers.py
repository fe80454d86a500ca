import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parley.llm import quality, toxicity
from parley.llm.labelled import values_at
from parley.llm.words import crc_mod


def _auc(scores, labels):
    pairs = [(s, t) for s, a in zip(scores, labels, strict=True) if a
             for t, b in zip(scores, labels, strict=True) if not b]
    return sum((s > t) + 0.5 * (s == t) for s, t in pairs) / len(pairs)


@pytest.fixture(scope="module")
def grammar():
    return toxicity.Grammar(frozenset(["moron", "scum$"]), toxicity.PRIOR)


@pytest.mark.parametrize("text, match", [
    ("You are a moron.", "insult_at_target"), ("What a moron", "insult"), ("morons everywhere", "insult"),
    ("You are not a moron!", "insult_negated"), ("He said you are scum.", "insult_reported"),
    ("I will kill you", "threat_at_target"), ("kill the lights", "threat"),
    ("nobody will hurt anyone", "threat_negated"), ("they wrote: kill", "threat_reported"),
    ("scumbag", None), ("", None), (None, None), ("not at all near the word: a moron", "insult")])
def test_clauses(grammar, text, match):
    counts = dict(zip(toxicity.MATCHES, grammar.matches(text), strict=True))
    assert {k for k, n in counts.items() if n} == ({match} if match else set())


def test_a_boundary_ends_the_clause(grammar):
    counts = dict(zip(toxicity.MATCHES, grammar.matches("He said so. You moron.\nmoron"), strict=True))
    assert counts["insult_at_target"] == 1 and counts["insult"] == 1 and counts["insult_reported"] == 0


def test_composed_states_are_those_of_the_parts():
    machine = toxicity.ClauseMachine()
    assert all(0 <= to < len(machine.step) for arcs in machine.step for to, _ in arcs)
    assert all(arcs[toxicity.BOUNDARY][0] == 0 for arcs in machine.step)


def test_negated_and_reported_insults_score_lower(grammar):
    score = {t: grammar.score(np.array([grammar.matches(t)], float))[0] for t in
             ("you moron", "you are not a moron", "she said you moron", "hello")}
    assert score["you moron"] > 0.3 > score["you are not a moron"]
    assert score["she said you moron"] < 0.3 and score["hello"] < 0.06


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(9)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ru", "ta") for b in ("n", "s", "r", "lin", "dor")]
    docs, labels = [], []
    for i in range(600):
        text = ". ".join(" ".join(rnd.choice(words) for _ in range(9)) for _ in range(6))
        toxic, good = i % 6 == 0, i % 5 != 0
        if toxic:
            good = True
            text += f". {rnd.choice(words)} {rnd.choice(['blarg', 'blargen', 'snokker'])}"
        elif not good:
            text = " | ".join(text.split()) if i % 2 else " ".join([text.split()[0]] * 60)
        docs.append((i, text))
        labels.append((i, int(good), int(toxic)))
    docs += [(None, "x"), (9001, None), (9002, ""), (9003, docs[0][1]), (9003, docs[0][1])]
    labels += [(None, 1, 1), (77, None, None), (3, 1, 0), (555555, 0, 1)]
    d = spark.createDataFrame([(k, t, "src", 3) for k, t in docs],
                              "doc_id bigint, text string, source string, score int")
    return d, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("module, label, mod, held", [(toxicity, "toxic", 4, 2), (quality, "quality", 5, 0)])
def test_held_out_accuracy(labelled, module, label, mod, held):
    docs, labels = labelled
    model = module.learn(docs, labels, crc_mod("doc_id", mod) != held, label)
    truth = {r["doc_id"]: r[label] for r in labels.where(crc_mod("doc_id", mod) == held).collect()}
    rows = module.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    kept = [(r["score"], truth[r["doc_id"]]) for r in rows if truth.get(r["doc_id"]) is not None]
    assert _auc(*zip(*kept, strict=True)) > 0.97
    assert np.mean([(s >= 0.3) == bool(y) for s, y in kept]) > 0.93


def test_filters_keep_columns_and_clean_documents(labelled, edge_docs, no_docs):
    docs, labels = labelled
    grammar = toxicity.learn(docs, labels, crc_mod("doc_id", 4) != 2)
    ranker = quality.learn(docs, labels, crc_mod("doc_id", 5) != 0)
    clean = toxicity.reject(docs, grammar)
    assert clean.columns == docs.columns
    gone = {r["doc_id"] for r in docs.select("doc_id").subtract(clean.select("doc_id")).collect()}
    assert gone <= {i for i in range(600) if i % 6 == 0} | {9003} and len(gone) > 80
    assert quality.keep_good(edge_docs, ranker).columns == edge_docs.columns
    for table in (edge_docs, no_docs):
        assert toxicity.score(table, grammar).count() == table.count()
        assert quality.score(table, ranker).count() == table.count()


def test_without_labels(labelled, edge_docs):
    docs, labels = labelled
    none = labels.where(F.lit(False))
    assert toxicity.learn(docs, none, F.lit(True)).stems == frozenset()
    ranker = quality.learn(docs, none, F.lit(True))
    assert all(r["score"] == pytest.approx(0.3) for r in quality.score(edge_docs, ranker).collect())
    assert quality.keep_good(edge_docs, ranker).count() == edge_docs.count()


def test_pairwise_fit_prefers_the_better():
    rnd = np.random.default_rng(0)
    good, bad = rnd.normal(1, 1, (300, 3)), rnd.normal(-1, 1, (60, 3))
    ranker = quality.fit_pairs(good, bad, 60 / 360)
    assert (ranker.weights > 0).all()
    both = np.concatenate([ranker.score(good), ranker.score(bad)])
    assert abs((both < 0.3).mean() - 60 / 360) < 0.01        # the quantile


def test_threshold_is_the_quantile_of_all_labelled_documents(labelled):
    """Not of the sample that the weights are fitted on."""
    docs, labels = labelled
    keep = crc_mod("doc_id", 5) != 0
    ranker = quality.learn(docs, labels, keep, ones=12, zeros=5)
    usable = {r["doc_id"]: r["quality"] for r in labels.where(keep).collect()
              if r["doc_id"] is not None and r["quality"] is not None}
    scores = [(r["score"], usable[r["doc_id"]]) for r in quality.score(docs, ranker).collect()
              if r["doc_id"] in usable]
    assert sum(s < 0.3 for s, _ in scores) == sum(not y for _, y in scores) > 50


def test_values_at_ranks(spark):
    rnd = random.Random(4)
    values = [rnd.choice([-1e9, 0.0, 1e-300, 5e-324, 3.5, rnd.gauss(0, 1)]) for _ in range(900)]
    column = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    ranks = [0, 1, 150, 449, 450, 700, 898, 899]
    assert values_at(column, ranks, bins=8) == [sorted(values)[r] for r in ranks]
    assert values_at(column.where("x = 3.5"), [0]) == [3.5]


def test_insults_of_few_toxic_documents_are_learned(spark):
    """However many toxic documents hold another insult."""
    rnd = random.Random(11)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ru", "ta") for b in ("n", "s", "r", "lin", "dor")]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(30)) + end, toxic) for i, (end, toxic) in
            enumerate([(". you blarg", 1)] * 400 + [(". du zworf", 1)] * 6 + [(". you du", 0)] * 1200)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    grammar = toxicity.learn(table.drop("toxic"), table.drop("text"), F.lit(True))
    assert grammar.stems == {"blarg$", "zworf$"}
    assert toxicity.reject(table, grammar).where("toxic = 1").count() == 0


def test_stems_are_counted_in_small_pieces():
    """A sample is in one or two partitions, so all its stems at once fill a worker."""
    texts = [" ".join(f"w{i:02d}{'abcdefgh'[n % 8]}{n}" for n in range(9000)) for i in range(50)] + ["you moron", None]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string()),
                                        "_label": pa.array([i % 2 for i in range(len(texts))], pa.int32())})
    out = list(toxicity._counted_stems(iter([batch])))
    assert len(out) >= sum(len(t or "") for t in texts) // toxicity.STEM_BATCH > 2
    rows = [r for piece in out for r in piece.to_pylist()]
    expected = {}
    for i, text in enumerate(texts):
        for stem in toxicity.stems_of(text):
            n = expected.setdefault(stem, [0, 0])
            n[1 - i % 2] += 1
    found = {}
    for r in rows:
        n = found.setdefault(r["stem"], [0, 0])
        n[0], n[1] = n[0] + r["toxic"], n[1] + r["clean"]
    assert found == expected
