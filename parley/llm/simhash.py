"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at distance 2r or less have a value between them that is
within r of both.  So every distinct fingerprint emits all variants within
r = half the maximum distance, and equal variants meet.

Shipping each of the 2,081 variants of a 64-bit fingerprint (r = 2) as a row
would shuffle thousands of rows a document.  The shuffle key is therefore
the variant's first bits only: the fingerprint goes once to each prefix that
any of its variants has (one row for each way to flip up to r of the prefix
bits), and its variants with that prefix are made there.  The prefix is as
long as the number of fingerprints needs for groups of bounded size, and a
prefix that still holds too many is split again by a hash of the variant.

Fingerprints that share a variant are linked in a chain, not all with all,
after checking their distance; each group then keeps a spanning forest, and
the forests of all groups are joined into components.  Copies share one
fingerprint row throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.components import roots
from parley.llm.words import ascii_words, small_batches
from parley.session import ensure_checkpoint_dir

SHINGLE = 4
MAX_DISTANCE = 4
BITS = 64
GROUP_VARIANTS = 2_000_000
_BLOCK = 1 << 18        # shingles, or variants, handled at once


def shingle_hashes(words: list[bytes], shingle: int, seed: int = 42) -> Iterator[np.ndarray]:
    """XXH64 of all space-joined shingles, in blocks; repeats included.

    Fewer words than a shingle count as one shingle, none as no shingle.
    """
    if not words:
        return
    text, n = b" ".join(words), len(words)
    width = min(shingle, n)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    digest = xxhash.xxh64_intdigest
    for at in range(0, n - width + 1, _BLOCK):
        to = min(at + _BLOCK, n - width + 1)
        yield np.array([digest(text[s:e - 1], seed) for s, e in
                        zip(starts[at:to], starts[at + width:to + width], strict=True)], np.uint64)


def simhash(words: list[bytes], shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint: a bit is 1 if set in over half the hashes; none gives 0."""
    ones, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(words, shingle):
        n += len(hashes)
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS)
        for at in range(0, len(bits), 255):     # 255 rows fit a byte's sum
            ones += np.add.reduce(bits[at:at + 255], axis=0, dtype=np.uint8)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id",
                 text: str = "text", digest: Column | None = None) -> DataFrame:
    """(doc_id, fp) of every row, and ``digest`` if given; null and empty texts have fingerprint 0."""
    more = [] if digest is None else ["digest"]

    def run(batches):
        for batch in small_batches(batches, "_text"):
            fps = [simhash(ascii_words(t), shingle) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(fps, pa.int64()), *map(batch.column, more)],
                ["doc_id", "fp", *more])
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("_text"),
                       *([] if digest is None else [digest.alias("digest")]))
    return rows.mapInArrow(run, "doc_id bigint, fp bigint" + "".join(f", {c} string" for c in more))


def flips(bits: int, most: int) -> list[int]:
    """All masks over the lowest ``bits`` bits with at most ``most`` ones."""
    return [sum(1 << b for b in chosen) for k in range(most + 1)
            for chosen in combinations(range(bits), k)]


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node of each node's component, for links a[i] - b[i] among n nodes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _mix(v: np.ndarray) -> np.ndarray:
    v = (v ^ (v >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return v ^ (v >> np.uint64(33))


def group_links(fps: np.ndarray, group: int, prefix_bits: int, radius: int, max_distance: int,
                part: int = 0, parts: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (fingerprint, smallest) among those that share a variant in one group."""
    fps = np.unique(fps.view(np.uint64))
    low_bits = BITS - prefix_bits
    used = np.bitwise_count((fps >> np.uint64(low_bits)) ^ np.uint64(group))
    base = fps & np.uint64((1 << low_bits) - 1)
    values, sources, radii = [], [], []
    for flipped in range(radius + 1):
        members = np.flatnonzero(used == flipped).astype(np.int32)
        masks = np.array(flips(low_bits, radius - flipped), np.uint64)
        far = np.bitwise_count(masks) + np.uint8(flipped)
        step = max(1, _BLOCK // len(masks))
        for at in range(0, len(members), step):
            some = members[at:at + step]
            made = (base[some][:, None] ^ masks[None, :]).ravel()
            source = np.repeat(some, len(masks))
            mine = _mix(made) % np.uint64(parts) == np.uint64(part) if parts > 1 else slice(None)
            values.append(made[mine])
            sources.append(source[mine])
            if max_distance % 2:
                radii.append(np.tile(far, len(some))[mine])
    made, source = np.concatenate(values), np.concatenate(sources)
    if max_distance % 2:
        # Sharers up to the radius may be one bit too far apart.  A linked pair has a
        # variant that one of the two is nearer to: link all to the nearest sharer.
        radius_of = np.concatenate(radii)
        order = np.lexsort((radius_of, made))
        made, source, radius_of = made[order], source[order], radius_of[order]
        begins = np.flatnonzero(np.concatenate([[True], made[1:] != made[:-1]])[:len(made)])
        first = np.repeat(begins, np.diff(np.append(begins, len(made))))
        meet = np.flatnonzero((first != np.arange(len(made)))
                              & (radius_of[first] + radius_of <= max_distance))
        a, b = source[first[meet]], source[meet]
    else:
        order = np.argsort(made)
        made, source = made[order], source[order]
        meet = np.flatnonzero(made[1:] == made[:-1])
        a, b = source[meet], source[meet + 1]
    pairs = np.unique(np.minimum(a, b).astype(np.int64) << 32 | np.maximum(a, b))
    a, b = pairs >> 32, pairs & 0xFFFFFFFF
    near = np.bitwise_count(fps[a] ^ fps[b]) <= max_distance
    label = forest(a[near], b[near], len(fps))
    child = np.flatnonzero(label != np.arange(len(fps)))
    return fps[child].view(np.int64), fps[label[child]].view(np.int64)


def links(distinct: DataFrame, max_distance: int = MAX_DISTANCE,
          group_variants: int = GROUP_VARIANTS) -> DataFrame:
    """Edges (a > b) whose components are those of all pairs within ``max_distance``.

    ``distinct`` holds each fingerprint once, in ``fp``.  An odd distance
    uses the next larger half; pairs are verified.
    """
    radius = (max_distance + 1) // 2
    variants = distinct.count() * len(flips(BITS, radius))
    prefix = min(24, max(1, (max(1, variants // group_variants)).bit_length()))
    low_bits = BITS - prefix

    masks = F.array(*[F.lit(m) for m in flips(prefix, radius)])
    here = F.shiftrightunsigned("fp", low_bits).cast("int")
    sent = distinct.select("fp", here.alias("own"), F.explode(masks).alias("mask")).select(
        "fp", F.col("own").bitwiseXOR(F.col("mask")).alias("group"),
        F.bit_count("mask").alias("used"))
    made = [len(flips(low_bits, radius - k)) for k in range(radius + 1)]
    here_made = F.element_at(F.array(*[F.lit(m) for m in made]), F.col("used").cast("int") + 1)
    hot = (sent.groupBy("group").agg(F.sum(here_made.cast("long")).alias("made"))
           .select("group", F.ceil(F.col("made") / (4 * group_variants)).cast("int").alias("parts"))
           .where("parts > 1"))
    dealt = (sent.join(hot, "group", "left")
             .withColumn("parts", F.coalesce("parts", F.lit(1)))
             .select("fp", "group", "parts",
                     F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")))

    def meet(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        a, b = group_links(frame["fp"].to_numpy(), int(key[0]), prefix, radius, max_distance,
                           int(key[2]), int(key[1]))
        return pd.DataFrame({"a": np.maximum(a, b), "b": np.minimum(a, b)})

    return dealt.groupBy("group", "parts", "part").applyInPandas(meet, "a bigint, b bigint").distinct()


def _groups(marked: DataFrame, max_distance: int) -> DataFrame:
    """(fp, group, component_id) of every fingerprint among rows (doc_id, fp)."""
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("least")).checkpoint()
    parent = roots(links(distinct.select("fp"), max_distance))
    rooted = distinct.join(parent.select(F.col("a").alias("fp"), F.col("b").alias("group")),
                           "fp", "left").withColumn("group", F.coalesce("group", "fp"))
    least = rooted.groupBy("group").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "group").select("fp", "group", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, group, component_id) of every row.

    ``component_id`` is the smallest doc_id that chains of links reach from
    the row, its own included; ``group`` is the smallest fingerprint there.
    Rows with equal fingerprints are always linked, also null and empty
    texts (fingerprint 0).  Repeated rows stay repeated; a null doc_id is no
    candidate for the smallest, and a component without any other has a null
    id.  Other columns are not read.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    marked = fingerprints(docs, shingle, key, text).checkpoint()
    return marked.join(_groups(marked, max_distance), "fp").select(
        "doc_id", "fp", "group", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE,
             key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group, with all columns: of the smallest id, then the smallest MD5 of its text.

    Null ids come after all others.  Groups are of texts, so an id with
    several texts keeps one row in each group that it is the smallest of;
    rows equal in id and text count as one.  An empty table stays empty.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    digest = F.coalesce(F.md5(F.col(text).cast("binary")), F.lit(""))
    marked = fingerprints(docs, shingle, key, text, digest).checkpoint()
    groups = _groups(marked, max_distance).select("fp", "group")
    # nulls sort first in a struct, so whether an id is null stands before it
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("first")
    chosen = marked.join(groups, "fp").groupBy("group").agg(first).select(
        F.col("first.doc_id").alias("chosen_id"), F.col("first.digest").alias("chosen_digest"))
    given, mine, text_is = docs.columns, "_id", "_digest"
    while {mine, text_is} & set(given):
        mine, text_is = "_" + mine, "_" + text_is
    named = docs.withColumns({mine: F.col(key).cast("long"), text_is: digest})
    # one shuffle of the texts serves the join and the removal of equal rows
    same = named[mine].eqNullSafe(chosen["chosen_id"]) & (named[text_is] == chosen["chosen_digest"])
    return named.join(chosen, same, "left_semi").dropDuplicates([mine, text_is]).select(*given)
