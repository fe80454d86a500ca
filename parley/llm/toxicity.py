"""Toxicity by a weighted finite-state pattern grammar.

Words are read as classes (insult, threat, target, negation, report,
boundary, other).  Five small transducers follow the classes of a clause:
what hostile word was read, whether someone is addressed, whether a negation
is open (for the three words after it), and whether the clause reports
speech; the insult and threat transducers write a hostile word's event, the
others change which.  They are composed into one table of states, built once
by walking all states that the classes can reach.  A clause is matched when
it ends with a hostile word read, and only matched clauses count; a word of
an insult list alone has no weight of its own.

Threat, target, negation and report words are fixed lists.  Insults are
learned: word beginnings (a beginning is a path of the word transducer, so
inflected and compounded forms follow it) that are far more frequent in
documents labelled toxic.  Those of many documents come first; then, in
rounds, those of the toxic documents that the grammar so far misses, from
four documents on, so that rare insults are not judged by the share of
common ones.  Clause weights are a logistic fit around prior
weights, so patterns that the labels do not show keep their prior.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.labelled import label_rate, labelled_sample, logistic, sigmoid
from parley.llm.presplit import WordCache
from parley.llm.words import small_batches

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, BOUNDARY = range(7)
# Word classes of the grammar, in English, German, French and Spanish.
_FIXED = {
    THREAT: "kill murder hurt destroy burn beat shoot stab strangle töten umbringen schlagen "
            "verprügeln tuer frapper brûler étrangler matar golpear quemar apuñalar",
    TARGET: "you your yours yourself u he she they them him her his their du dich dir dein euch "
            "ihr euer er sie ihnen tu toi te vous votre ils elles lui tú ti usted ustedes él "
            "ella ellos ellas vosotros",
    NEGATION: "not never no nobody isn't aren't wasn't don't doesn't didn't can't won't without "
              "nicht kein keine nie niemals ohne pas jamais aucun aucune sans nunca jamás sin ni",
    REPORT: "said says told wrote claimed reported quoted called according sagte sagt schrieb "
            "behauptete laut dit disait écrit raconta selon dijo dice escribió afirmó según",
}
_MARKS = ".!?;\n"
_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;\n]").findall

MATCHES = ("insult", "insult_at_target", "insult_negated", "insult_reported",
           "threat", "threat_at_target", "threat_negated", "threat_reported")
# Prior weights: bias, then one for log(1 + count) of each match.
PRIOR = np.array([-3.0, 3.0, 4.5, 0.5, 0.5, 1.0, 4.0, 0.2, 0.2])
PRIOR_STRENGTH = 0.5
THRESHOLD = 0.3
SAMPLE_TOXIC, SAMPLE_CLEAN = 1500, 4500
STEM_LENGTHS = range(3, 11)
STEM_BATCH = 1 << 20        # bytes of text whose stems are held at once
LEAST_DOCS, LEAST_RATIO = 4, 20
FIRST_SUPPORT = 0.025       # of the toxic documents, in the first round only
LEAST_EVIDENCE = 15.1       # log-likelihood ratio: a chance of about 1 in 10,000


# ---- transducers: state 0 is the start, a boundary is handled by the composition
def _hostile(state: int, word: int) -> int:
    """Bit 1 once an insult was read, bit 2 once a threat was."""
    return state | {INSULT: 1, THREAT: 2}.get(word, 0)


def _addressed(state: int, word: int) -> int:
    return 1 if word == TARGET else state


def _negated(state: int, word: int) -> int:
    """Words for which the negation is still open."""
    return 3 if word == NEGATION else max(0, state - 1)


def _reported(state: int, word: int) -> int:
    return 1 if word == REPORT else state


class ClauseMachine:
    """The composition: ``step[state][class]`` is (next state, match or -1).

    A state also keeps how the clause's hostile words were read: plainly,
    negated or reported; the match is written at the boundary.
    """

    def __init__(self):
        start = (0, 0, 0, 0, 0)       # hostile, addressed, negated, reported, plain
        number, walk = {start: 0}, [start]
        self.step: list[list[tuple[int, int]]] = []
        for state in walk:
            arcs = []
            for word in range(7):
                to, match = self._arc(state, word, start)
                if to not in number:
                    number[to] = len(walk)
                    walk.append(to)
                arcs.append((number[to], match))
            self.step.append(arcs)

    @staticmethod
    def _arc(state, word, start):
        hostile, addressed, negated, reported, plain = state
        if word == BOUNDARY:
            if not hostile:
                return start, -1
            threat = 4 if hostile & 2 else 0
            if reported:
                return start, threat + 3
            if not plain:
                return start, threat + 2
            return start, threat + (1 if addressed else 0)
        if word in (INSULT, THREAT) and not negated:
            plain = 1
        return (_hostile(hostile, word), _addressed(addressed, word), _negated(negated, word),
                _reported(reported, word), plain), -1


_MACHINE = ClauseMachine()


@dataclass
class Grammar:
    """Learned insult stems (``$`` ends a whole word) and clause weights."""
    stems: frozenset[str]
    weights: np.ndarray

    def __post_init__(self):
        fixed = {w: c for c, words in _FIXED.items() for w in words.split()}
        fixed |= dict.fromkeys(_MARKS, BOUNDARY)
        stems = self.stems

        def classify(word: str) -> int:
            if word in fixed:
                return fixed[word]
            for n in STEM_LENGTHS:
                if n > len(word):
                    break
                if word[:n] in stems:
                    return INSULT
            return INSULT if word + "$" in stems else OTHER
        self._class = WordCache(classify)

    def matches(self, text: str | None) -> list[int]:
        """How many clauses of the text match each pattern."""
        counts = [0] * len(MATCHES)
        classes = list(map(self._class.__getitem__, _TOKEN((text or "").lower())))
        if INSULT in classes or THREAT in classes:
            state, step = 0, _MACHINE.step
            for word in classes:
                state, match = step[state][word]
                if match >= 0:
                    counts[match] += 1
            match = step[state][BOUNDARY][1]
            if match >= 0:
                counts[match] += 1
        return counts

    def score(self, counts: np.ndarray) -> np.ndarray:
        return sigmoid(features(counts) @ self.weights)


def features(counts: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(counts)), np.log1p(counts)])


def stems_of(text: str | None) -> set[str]:
    """Beginnings of the text's words, and the words themselves, marked as whole."""
    words = {w for w in _TOKEN((text or "").lower()) if w not in _MARKS}
    return {w[:n] for w in words for n in STEM_LENGTHS if n <= len(w)} | {w + "$" for w in words}


def choose_stems(found: list[tuple[str, int]]) -> frozenset[str]:
    """Of stems and their support: longest beginnings first, none twice.

    A stem goes if a longer one keeps nine tenths of its support, so what
    stays is as long as it can be without losing forms; then those that
    begin with a shorter one that stayed go too.
    """
    support = dict(found)
    shadowed = set()
    for stem, n in found:
        word = stem.rstrip("$")
        for k in STEM_LENGTHS:
            part = word[:k]
            if part != stem and part in support and n >= 0.9 * support[part]:
                shadowed.add(part)
    left = sorted((s for s, _ in found if s not in shadowed), key=lambda s: (len(s), s))
    chosen: set[str] = set()
    for stem in left:
        if not any(stem[:n] in chosen for n in STEM_LENGTHS if n < len(stem)):
            chosen.add(stem)
    return frozenset(chosen)


def _evidence(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    """Log-likelihood ratio of a stem's documents against an even spread over both classes."""
    n, with_stem = all_toxic + all_clean, toxic + clean
    cells = [(toxic, all_toxic, with_stem), (all_toxic - toxic, all_toxic, n - with_stem),
             (clean, all_clean, with_stem), (all_clean - clean, all_clean, n - with_stem)]
    return 2 * sum(x * math.log(x * n / (row * column)) for x, row, column in cells if x)


def _counted_stems(batches):
    """(stem, toxic, clean) of pieces of the batches: a text has many times its letters of stems."""
    for batch in small_batches(batches, "text", STEM_BATCH):
        seen = Counter()
        for text, label in zip(batch.column("text").to_pylist(),
                               batch.column("_label").to_pylist(), strict=True):
            for stem in stems_of(text):
                seen[stem, label] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([s for s, _ in seen], pa.string()),
             pa.array([n if label else 0 for (_, label), n in seen.items()], pa.int64()),
             pa.array([0 if label else n for (_, label), n in seen.items()], pa.int64())],
            ["stem", "toxic", "clean"])


def _mine(sample: DataFrame, toxic: int, clean: int,
          missing: DataFrame | None = None) -> frozenset[str]:
    """Stems at least ``LEAST_RATIO`` times as frequent in toxic documents.

    Support is at least ``FIRST_SUPPORT`` of the toxic documents (and
    ``LEAST_DOCS``).  With ``missing``, toxic documents that a grammar does
    not find, only their stems are looked at, and the floors are
    ``LEAST_DOCS``, however many toxic documents there are, and
    ``LEAST_EVIDENCE``.
    """
    least = LEAST_DOCS if missing is not None else max(LEAST_DOCS, FIRST_SUPPORT * toxic)
    ratio = (F.col("toxic") / toxic) / ((F.col("clean") + 0.5) / (clean + 1))
    schema = "stem string, toxic bigint, clean bigint"
    found = (sample.mapInArrow(_counted_stems, schema)
             .groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
             .where((F.col("toxic") >= least) & (ratio >= LEAST_RATIO)))
    if missing is not None:
        found = found.join(missing.mapInArrow(_counted_stems, schema).select("stem"), "stem", "left_semi")
    return choose_stems([
        (r["stem"], r["toxic"]) for r in found.collect()
        if missing is None or _evidence(r["toxic"], r["clean"], toxic, clean) >= LEAST_EVIDENCE])


def learn(docs: DataFrame, labels: DataFrame, keep: Column, label: str = "toxic",
          key: str = "doc_id", text: str = "text", ones: int = SAMPLE_TOXIC,
          zeros: int = SAMPLE_CLEAN) -> Grammar:
    """Grammar fitted on at most ``ones`` + ``zeros`` labelled documents.

    Without toxic documents among them it has no learned insults and keeps
    the prior weights.
    """
    sample = labelled_sample(docs, labels, label, keep, ones, zeros, key, text)
    sizes = {r["_label"]: r["count"] for r in sample.groupBy("_label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic:
        return Grammar(frozenset(), PRIOR)
    rate = label_rate(docs, labels, label, keep, key) or 0.1
    stems = _mine(sample, toxic, clean)
    while True:
        grammar = _fit(sample, stems, rate)
        missing = reject(sample.where("_label = 1"), grammar)
        if missing.isEmpty():
            return grammar
        more = _mine(sample, toxic, clean, missing)
        if more <= stems:
            return grammar
        stems |= more


def _fit(sample: DataFrame, stems: frozenset[str], rate: float) -> Grammar:
    """The clause weights for these insults; each class weighs as in ``rate``."""
    rows = _counted(sample, Grammar(stems, PRIOR), "_label int, counts array<int>",
                    ["_label"]).collect()
    y = np.array([r["_label"] for r in rows], float)
    counts = np.array([r["counts"] for r in rows], float)
    toxic = y.sum()
    weight = np.where(y == 1, rate * len(y) / max(1, toxic),
                      (1 - rate) * len(y) / max(1, len(y) - toxic))
    return Grammar(stems, logistic(features(counts), y, weight, PRIOR, PRIOR_STRENGTH))


def _counted(docs: DataFrame, grammar: Grammar, schema: str, keys: list[str],
             text: str = "text") -> DataFrame:
    stems, weights = grammar.stems, grammar.weights
    scored = "score" in schema

    def run(batches):
        own = Grammar(stems, weights)
        for batch in small_batches(batches, text):
            counts = np.array([own.matches(t) for t in batch.column(text).to_pylist()], float)
            out = [batch.column(k) for k in keys]
            out.append(pa.array(list(counts.astype(np.int32)), pa.list_(pa.int32())))
            names = [*keys, "counts"]
            if scored:
                out.append(pa.array(own.score(counts)))
                names.append("score")
            yield pa.RecordBatch.from_arrays(out, names)
    return docs.select(*keys, text).mapInArrow(run, schema)


def score(docs: DataFrame, grammar: Grammar, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, counts, score) of every row: matched clauses and toxicity from 0 to 1.

    Null and empty texts match nothing and get the score of the bias.
    Repeated rows stay repeated; other columns are not read.
    """
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return _counted(source, grammar, "doc_id bigint, counts array<int>, score double", ["doc_id"])


def reject(docs: DataFrame, grammar: Grammar, threshold: float = THRESHOLD,
           text: str = "text") -> DataFrame:
    """The documents that score below the threshold, all columns, where they are read."""
    stems, weights = grammar.stems, grammar.weights

    def run(batches):
        own = Grammar(stems, weights)
        for batch in small_batches(batches, text):
            counts = np.array([own.matches(t) for t in batch.column(text).to_pylist()], float)
            yield batch.filter(pa.array(own.score(counts) < threshold))
    return docs.mapInArrow(run, docs.schema)
