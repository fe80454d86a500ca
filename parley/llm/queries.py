"""The numbered queries of this subpackage and their SQL.

Each query applies one operator to its whole table and derives the digest
columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import (bpe, chat, contamination, hnsw, iblt, ngrams, packing, quality, runs,
                        simhash, simplex, substring, toxicity)
from parley.llm.words import crc_mod, read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

WORD_BPE = "word_bpe_49k.json"


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


@register("op2_best_fit_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return packed.drop("ids")


@register("op8_bpe_automaton")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


@register("op4_simhash_balls")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


@register("op5_substring_dedup", r"""
WITH ws AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM ws WHERE len(ws) >= 20),
windows AS (SELECT doc_id, i, sha256(array_to_string(ws[i:i + 19], ' ')) AS k FROM starts),
repeats AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM repeats),
words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM ws),
kept AS (SELECT words.doc_id, string_agg(w, ' ' ORDER BY words.i) AS text, count(*) AS n
         FROM words LEFT JOIN covered ON covered.doc_id = words.doc_id AND covered.i = words.i
         WHERE covered.i IS NULL GROUP BY words.doc_id)
SELECT ws.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM ws LEFT JOIN kept ON kept.doc_id = ws.doc_id
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


CONTROL_TEXT = "\\### Assistant: </turn> ok"


@register("op6_chat_prefixes", r"""
WITH turns AS (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
           coalesce(role = 'assistant', FALSE) AS trained,
           15 + length(replace(replace(replace(replace(coalesce(role, ''), '&', '&amp;'),
                    '<', '&lt;'), '#', '&num;'), ':', '&colon;'))
              - 1 + length(replace(replace(replace(coalesce(text, ''), '&', '&amp;'),
                    '<', '&lt;'), '#', '&num;')) AS chars,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n,
           count(*) OVER (PARTITION BY conv_id) AS of
    FROM turns),
prefixes AS (
    SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY n) AS upto FROM sized)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(sum(CASE WHEN trained THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN trained THEN text ELSE '' END, '' ORDER BY n)) AS loss_sha256,
       CAST(sum(CASE WHEN trained OR n = of THEN upto ELSE 0 END) AS BIGINT) AS formatted_chars
FROM prefixes GROUP BY conv_id
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.element_at(F.array(F.lit("user"), F.lit("assistant")), F.col("id").cast("int") + 1)
        .alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    return chat.digests(chat.prefix_examples(turns.unionByName(control)))


@register("op3_iblt_fingerprints")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.compare_neighbours(read(spark, sf_dir, "documents"))


def classified(scored: DataFrame, mod: int, held: int, threshold: float) -> DataFrame:
    return scored.select("doc_id", (crc_mod("doc_id", mod) == held).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


@register("op7_toxicity_grammar")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    grammar = toxicity.learn(docs, read(spark, sf_dir, "labels"), crc_mod("doc_id", 4) != 2)
    return classified(toxicity.score(docs, grammar), 4, 2, toxicity.THRESHOLD)


@register("op10_quality_ranking")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = quality.measured(read(spark, sf_dir, "documents"))
    ranker = quality.learn_measured(features, read(spark, sf_dir, "labels"), crc_mod("doc_id", 5) != 0)
    return classified(quality.score_measured(features, ranker), 5, 0, quality.THRESHOLD)


@register("op9_hnsw_shards")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return hnsw.nearest(vectors, vectors.where(F.pmod("vec_id", F.lit(20)) == 0), k=20)


@register("op1_ngram_trie")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.score_texts(read(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2)


@register("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = runs.find_runs(runs.echo_tails(docs))
    best = runs.strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"_best.{name}").alias(name) for name in ("start", "length", "period")),
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("kept_text", 256).alias("collapsed_sha256"))


WORDS_SQL = ("regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


@register("op12_benchmark_overlaps", f"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce({WORDS_SQL}, []) AS words FROM documents),
items AS (
    SELECT item_id, {WORDS_SQL} AS words FROM benchmark WHERE text IS NOT NULL),
cuts AS (
    SELECT item_id, least(len(words), 10) AS n, words,
           unnest(range(1, len(words) - least(len(words), 10) + 2)) AS b
    FROM items WHERE len(words) > 0),
windows AS (
    SELECT DISTINCT item_id, n, array_to_string(list_slice(words, b, b + n - 1), ' ') AS piece FROM cuts),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT rid, n, words, unnest(range(1, len(words) - n + 2)) AS b
    FROM docs, sizes WHERE len(words) >= n),
found AS (
    SELECT p.rid, p.n, p.b, w.item_id
    FROM (SELECT rid, n, b, array_to_string(list_slice(words, b, b + n - 1), ' ') AS piece FROM places) p
    JOIN windows w ON w.n = p.n AND w.piece = p.piece),
hit AS (
    SELECT rid, count(DISTINCT word) AS n_hit
    FROM (SELECT rid, unnest(range(b, b + n)) AS word FROM (SELECT DISTINCT rid, n, b FROM found))
    GROUP BY rid),
named AS (
    SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL)
    GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination.find_overlaps(docs, read(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))


def _cluster_sql(rounds: int, clusters: int) -> str:
    """Assignment and update rounds, one after the other, over components as rows."""
    steps = [f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, embedding FROM embeddings
    WHERE len(embedding) = {simplex.DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL
          OR isnan(x) OR isinf(x))) = 0),
points AS MATERIALIZED (
    SELECT rid, i, CAST(floor({simplex.SCALE} * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
    FROM (SELECT rid, embedding, unnest(range(1, {simplex.DIMENSIONS + 1})) AS i FROM kept)),
seeds AS (
    SELECT rid, row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR))) - 1 AS k
    FROM kept QUALIFY k < {clusters}),
centres0 AS MATERIALIZED (SELECT k, i, x FROM seeds JOIN points USING (rid))"""]
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (
    SELECT rid, arg_min(k, d * {clusters} + k) AS k, min(d) AS d
    FROM (SELECT p.rid, c.k, sum((p.x - c.x) * (p.x - c.x)) AS d
          FROM points p JOIN centres{r} c ON p.i = c.i GROUP BY p.rid, c.k) GROUP BY rid)""")
        if r < rounds:
            steps.append(f"""
sums{r} AS (SELECT n.k, p.i, sum(p.x) AS s, count(*) AS n
            FROM near{r} n JOIN points p ON n.rid = p.rid GROUP BY n.k, p.i),
centres{r + 1} AS MATERIALIZED (
    SELECT c.k, c.i, CASE WHEN s.n IS NULL THEN c.x
           ELSE CAST((s.s - (s.s % s.n + s.n) % s.n) // s.n AS BIGINT) END AS x
    FROM centres{r} c LEFT JOIN sums{r} s ON c.k = s.k AND c.i = s.i)""")
    return ",".join(steps) + f"""
SELECT v.vec_id, CAST(n.k AS INTEGER) AS cluster, CAST(n.d AS BIGINT) AS distance,
       CAST(sum(n.d) OVER (PARTITION BY n.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(n.d) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM near{rounds} n JOIN kept v ON n.rid = v.rid JOIN (
    SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256
    FROM centres{rounds} GROUP BY k) h ON h.k = n.k"""


@register("op13_simplex_clusters", _cluster_sql(simplex.ROUNDS, simplex.CLUSTERS))
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simplex.with_inertia(*simplex.cluster_vectors(read(spark, sf_dir, "embeddings")))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        "centroid_sha256")
