"""Sentiment words induced from a few seed words, and texts scored with them.

Words that stand near each other in one clause tend to share a polarity, and
words on two sides of a contrast ("slow but friendly") to differ.  The signed
graph of words adds up both over the whole corpus.  Seed words are labelled
first; in each round every unlabelled word takes the sign of the weighted sum
of its labelled neighbours, and keeps it.  Labels only grow in number, so the
rounds reach a fixed point.  A sum of zero leaves a word open for later.

A text scores with the labelled words it holds; a word counts the less, the
later its round.  All sums are integers, so any partitioning gives the same
result.  The graph stays in chunks, one row for some megabytes of text; a
round sums over the chunks by word and brings the labels back to the chunks,
cut by reliable checkpoints.  So words cross a shuffle, their pairs do not.
The graph and the lexicon, which grow with the vocabulary, are never broadcast
by hand or collected.

Null and empty texts hold no words and score neutral.  Rows of equal keys are
one text; a null key is a key like others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.batches import batch_pieces
from parley.operators import topics
from parley.operators.enrich import NEGATIVE_TERMS, POSITIVE_TERMS, sentiment_label
from parley.session import ensure_checkpoint_dir

# ---- fixed values ----------------------------------------------------------
CONTRAST_TERMS = ("but", "however", "although", "aber", "jedoch", "sondern", "doch", "mais", "pourtant",
                  "pero", "sino", "aunque")
WINDOW = 4                   # words apart at most
STRENGTH = 60                # of a seed word; a word of round r has STRENGTH // (r + 1)
MAX_ROUNDS = 20
CHUNK_BYTES = 16 << 20       # of texts whose pairs or counts travel as one row
# ----------------------------------------------------------------------------

SEEDS = {t: 1 for t in POSITIVE_TERMS} | {t: -1 for t in NEGATIVE_TERMS}


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and word code of each token of :func:`topics.word_string`, and the words, ascending."""
    tokens = pd.Series(texts.to_pandas()).fillna("").str.split(" ").explode()
    code, names = pd.factorize(tokens.to_numpy(), sort=True)
    return tokens.index.to_numpy().astype(np.int64), code, names


def _content(names: np.ndarray, seeds: frozenset[str], heavy: frozenset[str]) -> np.ndarray:
    return np.array([w in seeds or (len(w) >= topics.MIN_LETTERS and w not in heavy and w not in CONTRAST_TERMS)
                     for w in names], bool)


def _pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def _gather(batches: Iterator[pa.RecordBatch], take: Callable, limit: int) -> Iterator[tuple[int, list]]:
    """``take`` of each piece of the batches, listed by chunks of about ``limit`` bytes, with the chunk's number."""
    from pyspark import TaskContext
    number, held, size = TaskContext.get().partitionId() << 32, [], 0
    for piece in batch_pieces(batches):
        held.append(take(piece))
        size += piece.nbytes
        if size >= limit:
            yield number, held
            number, held, size = number + 1, [], 0
    if held:
        yield number, held


def _one_vocabulary(lists: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The codes of each list's words in the words of all, and those, ascending."""
    code, names = pd.factorize(np.concatenate([np.empty(0, object), *lists]), sort=True)
    return np.split(code.astype(np.int64), np.cumsum([len(x) for x in lists])[:-1]), names


def _state(number: int, words: pa.Table, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A chunk of the graph as one row, with the words of its pairs alone; nothing without pairs."""
    if len(a):
        kept, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        first, second = np.split(place.astype(np.int32), 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([_pack(words.take(pa.array(kept)))], pa.binary()),
             pa.array([_pack(pa.table({"a": first, "b": second, "weight": weight}))], pa.binary())],
            names=["chunk", "words", "pairs"])


_STATE = "chunk long, words binary, pairs binary"


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for number, words, pairs in zip(*batch.columns, strict=True):
            pairs = _unpack(pairs.as_buffer())
            yield (number.as_py(), _unpack(words.as_buffer()),
                   *(pairs[name].to_numpy() for name in ("a", "b", "weight")))


def _pairs(seeds: frozenset[str], heavy: frozenset[str], limit: int):
    def near_pairs(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        row, code, names = _tokens(batch.column(0))
        good = _content(names, seeds, heavy)[code]
        breaks = np.cumsum((names == topics._BREAK)[code])
        contrasts = np.cumsum(np.isin(names, CONTRAST_TERMS)[code])
        width, keys, signs = max(1, len(names)), [], []
        for apart in range(1, WINDOW + 1):
            a = np.flatnonzero(good[:-apart])
            b = a + apart
            near = good[b] & (row[a] == row[b]) & (breaks[a] == breaks[b]) & (code[a] != code[b])
            a, b = a[near], b[near]
            keys.append(np.minimum(code[a], code[b]).astype(np.int64) * width + np.maximum(code[a], code[b]))
            signs.append(np.where(contrasts[b] > contrasts[a], -1, 1))
        found, place = np.unique(np.concatenate(keys), return_inverse=True)
        weight = np.bincount(place, np.concatenate(signs), len(found)).astype(np.int64)
        used, place = np.unique(np.concatenate([found // width, found % width]), return_inverse=True)
        return names[used], *np.split(place, 2), weight

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, held in _gather(batches, near_pairs, limit):
            codes, names = _one_vocabulary([h[0] for h in held])
            width = max(1, len(names))
            keys = np.concatenate([c[a] * width + c[b] for c, (_, a, b, _) in zip(codes, held, strict=True)])
            found, place = np.unique(keys, return_inverse=True)
            weight = np.bincount(place, np.concatenate([h[3] for h in held]), len(found)).astype(np.int64)
            found, weight = found[weight != 0], weight[weight != 0]
            words = pa.table({"term": pa.array(names, pa.string()), "polarity": np.zeros(len(names), np.int32),
                              "known": np.zeros(len(names), bool)})
            yield from _state(number, words, found // width, found % width, weight)
    return pairs


def word_graph(df: DataFrame, heavy: list[str], text_col: str = "transcription_text",
               seeds: dict[str, int] = SEEDS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The graph in chunks, each of about ``chunk_bytes`` of text: number, packed words, packed pairs.

    Sums of weights over the chunks are those of the graph, so the pairs,
    far more than the words, need not be brought together; see :func:`edges`.
    """
    return (df.select(topics.word_string(text_col).alias("words"))
              .mapInArrow(_pairs(frozenset(seeds), frozenset(heavy), chunk_bytes), _STATE))


def edges(graph: DataFrame) -> DataFrame:
    """Columns a, b, weight with a < b: agreements less contrasts; zero sums are left out."""
    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words, a, b, weight in _states(batches):
            terms = words["term"].combine_chunks()
            yield pa.RecordBatch.from_arrays([terms.take(pa.array(a)), terms.take(pa.array(b)), pa.array(weight)],
                                             names=["a", "b", "weight"])
    return (graph.mapInArrow(unpacked, "a string, b string, weight long")
                 .groupBy("a", "b").agg(F.sum("weight").alias("weight")).filter("weight <> 0"))


def _learned(number: int, words: pa.Table, pairs: tuple[np.ndarray, ...], place: np.ndarray,
             polarity: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The chunk with more labels, less the pairs of two labelled words: they pull nothing any more."""
    signs, known = words["polarity"].to_numpy().copy(), words["known"].to_numpy().copy()
    signs[place], known[place] = polarity, True
    a, b, weight = pairs
    left = ~(known[a] & known[b])
    yield from _state(number, pa.table({"term": words["term"], "polarity": signs, "known": known}),
                      a[left], b[left], weight[left])


def _seeded(seeds: dict[str, int]):
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = pa.array(list(seeds), pa.string())
        signs = np.array(list(seeds.values()), np.int32)
        for number, words, *pairs in _states(batches):
            at = pc.index_in(words["term"], terms).fill_null(-1).to_numpy()
            place = np.flatnonzero(at >= 0)
            yield from _learned(number, words, pairs, place, signs[at[place]])
    return label


def _pulls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every unlabelled word of each chunk, its place there and what the labelled ones near it in the chunk add up to."""
    for number, words, a, b, weight in _states(batches):
        signs = words["polarity"].to_numpy()
        pull = (np.bincount(b, weight * signs[a], len(signs)) + np.bincount(a, weight * signs[b], len(signs)))
        place = np.flatnonzero(~words["known"].to_numpy())
        yield pa.RecordBatch.from_arrays(
            [words["term"].combine_chunks().take(pa.array(place)), pa.array(np.full(len(place), number, np.int64)),
             pa.array(place.astype(np.int32)), pa.array(pull[place].astype(np.int64))],
            names=["term", "chunk", "place", "pull"])


def _relabel(chunk: pa.Table, new: pa.Table) -> pa.Table:
    found = []
    for number, words, *pairs in _states(iter(chunk.to_batches())):
        found += _learned(number, words, pairs, new["place"].to_numpy(), new["polarity"].to_numpy())
    return pa.Table.from_batches(found, chunk.schema)


def induce(graph: DataFrame, seeds: dict[str, int] = SEEDS, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """Columns term, polarity (1 or -1), round (0: seed), at the fixed point.

    In each round the chunks of the graph give the sums of their unlabelled
    words, and get the labels back to the places of these words.

    ``max_rounds`` is a stop for graphs of very long chains; words that would
    be labelled later have a strength below a twentieth of a seed's.
    """
    spark = graph.sparkSession
    ensure_checkpoint_dir(spark)
    labels = spark.createDataFrame([(t, int(p), 0) for t, p in sorted(seeds.items())],
                                   "term string, polarity int, round int")
    chunks = graph.mapInArrow(_seeded(seeds), _STATE).checkpoint()
    of_term = Window.partitionBy("term")
    for number in range(1, max_rounds + 1):
        new = (chunks.mapInArrow(_pulls, "term string, chunk long, place int, pull long")
                     .withColumns({"pull": F.sum("pull").over(of_term), "first": F.min("chunk").over(of_term)})
                     .filter("pull <> 0")
                     .select(F.when(F.col("chunk") == F.col("first"), F.col("term")).alias("term"), "chunk", "place",
                             F.signum("pull").cast("int").alias("polarity"))).checkpoint()
        if new.isEmpty():
            break
        labels = labels.unionByName(new.filter("term IS NOT NULL")
                                       .select("term", "polarity", F.lit(number).alias("round")))
        if number < max_rounds:
            chunks = (chunks.groupBy("chunk").cogroup(new.select("chunk", "place", "polarity").groupBy("chunk"))
                            .applyInArrow(_relabel, _STATE)).checkpoint()
    return labels


def _counts(seeds: frozenset[str], heavy: frozenset[str], limit: int):
    def count(batch: pa.RecordBatch) -> tuple:
        row, code, names = _tokens(batch.column(0))
        good = _content(names, seeds, heavy)[code]
        width = max(1, len(names))
        found, n = np.unique(row[good] * width + code[good], return_counts=True)
        used, place = np.unique(found % width, return_inverse=True)
        keys = pa.RecordBatch.from_arrays(batch.columns[1:], schema=pa.schema(list(batch.schema)[1:]))
        return names[used], found // width, place, n, keys

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, held in _gather(batches, count, limit):
            codes, names = _one_vocabulary([h[0] for h in held])
            first = np.cumsum([0, *(h[4].num_rows for h in held)])
            table = pa.table({
                "row": np.concatenate([h[1] + n for h, n in zip(held, first, strict=False)]).astype(np.int32),
                "word": np.concatenate([c[h[2]] for c, h in zip(codes, held, strict=True)]).astype(np.int32),
                "n": np.concatenate([h[3] for h in held]).astype(np.int64)})
            packed = [pa.Table.from_batches([h[4] for h in held]), pa.table({"term": pa.array(names, pa.string())}),
                      table]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), *(pa.array([_pack(t)], pa.binary()) for t in packed)],
                names=["chunk", "keys", "words", "counts"])
    return counts


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, words in zip(*batch.columns, strict=True):
            terms = _unpack(words.as_buffer())["term"].combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [terms, pa.array(np.full(len(terms), number.as_py(), np.int64)),
                 pa.array(np.arange(len(terms), dtype=np.int32))], names=["term", "chunk", "place"])


def _score_chunk(chunk: pa.Table, hits: pa.Table) -> pa.Table:
    keys, counts = _unpack(chunk["keys"][0].as_buffer()), _unpack(chunk["counts"][0].as_buffer())
    row, word, n = (counts[name].to_numpy() for name in ("row", "word", "n"))
    place, strength = hits["place"].to_numpy(), hits["strength"].to_numpy()
    words = 1 + max(word.max(initial=-1), place.max(initial=-1))
    for name, value in (("positive", np.maximum(strength, 0)), ("negative", np.maximum(-strength, 0))):
        of_word = np.bincount(place, value, words)
        keys = keys.append_column(name, pa.array(
            np.bincount(row, n * of_word[word], keys.num_rows).astype(np.int64)))
    return keys


def score_texts(df: DataFrame, lexicon: DataFrame, heavy: list[str], keys: tuple[str, ...],
                text_col: str = "transcription_text", seeds: dict[str, int] = SEEDS,
                chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Columns of ``keys``, positive, negative, sentiment: one row a key.

    Texts are counted in chunks of about ``chunk_bytes``, written once; each
    word of a chunk, not of a text, meets the lexicon.
    """
    ensure_checkpoint_dir(df.sparkSession)
    numbered = [f"_k{i}" for i in range(len(keys))]
    # Case and clashing names of keys do not matter below: they are numbered.
    texts = df.select(topics.word_string(text_col).alias("_words"),
                      *(F.col(k).alias(n) for k, n in zip(keys, numbered, strict=True)))
    schema = ", ".join(f"{n} {texts.schema[n].dataType.simpleString()}" for n in numbered)
    chunks = texts.mapInArrow(_counts(frozenset(seeds), frozenset(heavy), chunk_bytes),
                              "chunk long, keys binary, words binary, counts binary").checkpoint()
    strength = F.floor(F.lit(STRENGTH) / (F.col("round") + 1)) * F.signum("polarity")
    hits = (chunks.select("chunk", "words").mapInArrow(_places, "term string, chunk long, place int")
                  .join(lexicon, "term").select("chunk", "place", strength.cast("long").alias("strength")))
    scored = (chunks.select("chunk", "keys", "counts").groupBy("chunk").cogroup(hits.groupBy("chunk"))
                    .applyInArrow(_score_chunk, f"{schema}, positive long, negative long"))
    sums = scored.groupBy(*numbered).agg(F.sum("positive").alias("positive"), F.sum("negative").alias("negative"))
    return sums.select(*(F.col(n).alias(k) for k, n in zip(keys, numbered, strict=True)), "positive", "negative",
                       sentiment_label(F.col("positive"), F.col("negative")).alias("sentiment"))


def _lexicon_sql(source: str, key: str, text: str, rounds: int) -> str:
    seeds = ", ".join(f"('{t}', {p})" for t, p in sorted(SEEDS.items()))
    contrast = ", ".join(f"'{w}'" for w in CONTRAST_TERMS)
    steps = [f"l0 AS MATERIALIZED (SELECT term, CAST(p AS INTEGER) AS polarity, 0 AS round FROM seeds)"]
    for r in range(1, rounds + 1):
        steps.append(f"""
l{r} AS MATERIALIZED (SELECT * FROM l{r - 1} UNION ALL
  SELECT b, CAST(sign(sum(weight * polarity)) AS INTEGER), {r} FROM arcs JOIN l{r - 1} ON term = a
  WHERE b NOT IN (SELECT term FROM l{r - 1}) GROUP BY b HAVING sum(weight * polarity) <> 0)""")
    return f"""WITH {topics._tokens_sql(source, key, text)},
seeds(term, p) AS (VALUES {seeds}),
marked AS MATERIALIZED (SELECT {key}, i, w,
    sum(CASE WHEN w = '{topics._BREAK}' THEN 1 ELSE 0 END) OVER o AS brk,
    sum(CASE WHEN w IN ({contrast}) THEN 1 ELSE 0 END) OVER o AS con,
    w IN (SELECT term FROM seeds) OR (length(w) >= {topics.MIN_LETTERS} AND w NOT IN ({contrast})
      AND w NOT IN (SELECT term FROM heavy)) AS good
  FROM tok WINDOW o AS (PARTITION BY {key} ORDER BY i)),
good AS MATERIALIZED (SELECT * FROM marked WHERE good),
ahead AS (SELECT *, i + d AS j FROM good, (SELECT unnest(range(1, {WINDOW + 1})) AS d)),
graph AS MATERIALIZED (SELECT least(x.w, y.w) AS a, greatest(x.w, y.w) AS b,
    sum(CASE WHEN y.con > x.con THEN -1 ELSE 1 END) AS weight
  FROM ahead x JOIN good y ON y.{key} = x.{key} AND y.i = x.j
  WHERE x.brk = y.brk AND x.w <> y.w GROUP BY ALL HAVING sum(CASE WHEN y.con > x.con THEN -1 ELSE 1 END) <> 0),
arcs AS MATERIALIZED (SELECT a, b, weight FROM graph UNION ALL SELECT b, a, weight FROM graph),
{",".join(steps)},
lexicon AS (SELECT * FROM l{rounds})"""


def lexicon_sql(source: str, key: str, text: str, rounds: int = MAX_ROUNDS) -> str:
    """The induced lexicon as DuckDB SQL; ``key`` is unique in ``source``."""
    return f"{_lexicon_sql(source, key, text, rounds)}\nSELECT term, polarity, round FROM lexicon"


def scores_sql(source: str, key: str, text: str, rounds: int = MAX_ROUNDS) -> str:
    return f"""{_lexicon_sql(source, key, text, rounds)},
per AS (SELECT {key}, CAST(sum(CASE WHEN polarity > 0 THEN {STRENGTH} // (round + 1) ELSE 0 END) AS BIGINT) AS pos,
    CAST(sum(CASE WHEN polarity < 0 THEN {STRENGTH} // (round + 1) ELSE 0 END) AS BIGINT) AS neg
  FROM good JOIN lexicon ON term = w GROUP BY {key}),
whole AS (SELECT d.{key}, coalesce(pos, 0) AS positive, coalesce(neg, 0) AS negative
  FROM {source} d LEFT JOIN per ON per.{key} = d.{key})
SELECT *, CASE WHEN positive = 0 AND negative = 0 THEN 'neutral'
               WHEN positive > 0 AND negative > 0 AND positive < negative * 2 AND negative < positive * 2 THEN 'mixed'
               WHEN positive > negative THEN 'positive' ELSE 'negative' END AS sentiment FROM whole"""
