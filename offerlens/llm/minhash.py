"""Near-duplicate classes of word-shingle sets.

Used by the document operator (odd sketches) and the paragraph operator.

1. every text becomes its set of hashed shingles, MinHash samples, band keys
   and (optionally) an odd sketch, in one pass over the texts;
2. equal sets are one class member: only its smallest id goes on;
3. every band bucket compares its members with one of them, its pivot (a
   star, linear in the bucket), candidates are estimated by their sketches and
   sizes and confirmed on the full sets (written once for the texts that share
   a bucket); confirmed links are closed to
   components.  The pivot is the member that meets most others over all its
   buckets, the text that the others were copied from;
4. where buckets still hold many pairs between different components (more than
   ``SPARSE`` a member on average), they are compared with four times as many
   further pivots, one a component, as long as that finds links.  New links
   only merge the components of the rounds before;
5. then all pairs of a bucket that still are in different components are
   compared, so no candidate link between different components is left out.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerlens.llm.common import Stages, bloom_filters, connected_components, lean, passing, ship

ship(__name__)

SIGMAS = 5.0
SLICE = 512  # texts turned into sets at once
SPARSE = 4  # pairs per member that step 5 takes without another pivot


def tune_bands(percent: int, recall: float, most: int) -> tuple[int, int]:
    """(bands, rows) with the longest bands, hence the fewest false
    candidates, that still find a pair at the threshold with probability
    ``recall`` using at most ``most`` samples."""
    t, best = percent / 100, (most, 1)
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - t ** rows)) if t < 1 else 1
        if bands * rows <= most:
            best = (bands, rows)
    return best


class WordHashes(dict):
    """64-bit hash of each word seen by this task; emptied when it gets large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        v = self[word] = xxhash.xxh64_intdigest(word)
        return v


def shingles(body: bytes | None, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles; a text with fewer
    words has its whole sequence as one; no words: none."""
    words = (body or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(n, len(words))
    out = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        out = (out ^ h[i:i + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _family(samples: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    a = rng.integers(0, 2**32, (samples, 1), np.uint64).astype(np.uint32) | np.uint32(1)
    b = rng.integers(0, 2**32, (samples, 1), np.uint64).astype(np.uint32)
    return a, b


def minhash(items: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    a, b = family
    x = (items ^ (items >> np.uint64(32))).astype(np.uint32)
    low = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(low, (x[None, i:i + 2048] * a + b).min(axis=1), out=low)
    return low


def odd_sketch(items: np.ndarray, longs: int) -> np.ndarray:
    """Parity bitmap of ``64 * longs`` bits: each of the ``32 * longs`` smallest
    hashes of the set (its bottom-k MinHash samples) flips one bit."""
    bits = 64 * longs
    odd = np.bincount(items[:32 * longs] * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32) & np.uint64(bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketch_cap(percent: int, longs: int, a: Column, b: Column) -> Column:
    """The largest population count that the XOR of the sketches of two linked
    sets of a and b shingles shows, with ``SIGMAS`` standard deviations to spare.

    Linked sets have at least t / (1 + t) (a + b) common shingles.  Those below
    the lower sampling threshold are in both samples; the samples then differ
    in at most d elements, and d elements flip m / 2 (1 - exp(-2 d / m)) of m
    bits on average."""
    t, k, m = percent / 100, 32 * longs, 64 * longs
    ka, kb = F.least(a, F.lit(float(k))), F.least(b, F.lit(float(k)))
    share = F.least(ka / a, kb / b)
    common = share * (t / (1 + t)) * (a + b)
    d = F.greatest(F.lit(0.0), ka + kb - 2 * common)
    p = F.least(F.lit(1.0), common / F.least(ka, kb))
    sampled = F.when(share < 1, 4 * F.least(ka, kb) * F.greatest(p * (1 - p), F.lit(t * (1 - t)))).otherwise(F.lit(0.0))
    slope = F.exp(-4 * d / m)
    var = slope * sampled + F.greatest(F.lit(0.0), m / 4 * (1 - slope) - d * slope)
    return F.floor(m / 2 * (1 - F.exp(-2 * d / m)) + SIGMAS * F.sqrt(var) + 1).cast("int")


def may_link(percent: int, longs: int) -> Column:
    """Whether sets a and b (sizes ``n_``, caps ``c_`` and sketches ``s_``) can
    reach the threshold: by their sizes; by the smaller set's cap, kept per
    row; by the cap for both sizes."""
    odd = functools.reduce(lambda u, v: u + v, [F.bit_count(F.col("s_a")[i].bitwiseXOR(F.col("s_b")[i])) for i in range(longs)])
    cap = sketch_cap(percent, longs, F.col("n_a").cast("double"), F.col("n_b").cast("double"))
    return ((F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent) & (odd <= F.least("c_a", "c_b"))) & (odd <= cap)


def signatures(items: DataFrame, n: int, bands: int, rows: int, longs: int) -> DataFrame:
    """``(id, n, key, bands, sketch)`` of ``items(id, body)``; an empty set has
    null key, bands and sketch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, family = WordHashes(), _family(bands * rows)
        salt = np.arange(bands, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)
        for pdf in batches:
            out = []
            for body in pdf["body"]:
                s = shingles(body, n, hashes)
                if not len(s):
                    out.append((0, None, None, None))
                    continue
                low = minhash(s, family)
                key = salt.copy()
                for r in range(rows):
                    key = (key ^ low.reshape(bands, rows)[:, r]) * np.uint64(0x9E3779B97F4A7C15)
                    key ^= key >> np.uint64(31)
                out.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), key.view(np.int64),
                            odd_sketch(s, longs)))
            yield pd.DataFrame({"id": pdf["id"], "n": [x[0] for x in out], "key": [x[1] for x in out],
                                "bands": [x[2] for x in out], "sketch": [x[3] for x in out]})

    return items.select("id", F.col("body").cast("binary").alias("body")).mapInPandas(
        lean(run), "id long, n long, key binary, bands array<long>, sketch array<long>")


def full_sets(items: DataFrame, n: int) -> DataFrame:
    """``(id, set)``: the whole shingle set of ``items(id, body)``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for pdf in batches:
            for lo in range(0, len(pdf), SLICE):
                part = pdf.iloc[lo:lo + SLICE]
                yield pd.DataFrame({"id": part["id"].to_numpy(), "set": [shingles(x, n, hashes).view(np.int64) for x in part["body"]]})

    return items.mapInPandas(lean(run), "id long, set array<long>")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""
    # sort-merge at every size: sets are shuffled for their own pairs only
    in_a, in_b = bloom_filters(pairs.select("a", "b"))
    b = passing(sets, "id", in_b).select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    a = passing(sets, "id", in_a).select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    both = pairs.hint("merge").join(b, "b").hint("merge").join(a, "a")
    common = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    linked = 100 * common >= percent * (F.size("set_a") + F.size("set_b") - common)
    return both.where(linked).select("a", "b").distinct()


def near_duplicates(stages: Stages, items: DataFrame, n: int, percent: int, bands: int, rows: int, longs: int) -> DataFrame:
    """``(id, n, component)`` of every row of ``items(id, body)``."""
    items = items.select("id", F.col("body").cast("binary").alias("body"))
    sig = stages.put(signatures(items, n, bands, rows, longs), "signatures")
    # one member per distinct set; a row's set with a null id stands alone
    reps = stages.put(sig.where("key IS NOT NULL AND id IS NOT NULL").groupBy("key").agg(F.min("id").alias("rep")), "sets")
    one = (sig.join(reps, (sig["key"] == reps["key"]) & (sig["id"] == reps["rep"]), "left_semi")
           .dropDuplicates(["id", "key"]).select("id", "n", "bands", "sketch"))
    one = stages.put(one, "members")

    rows_ = one.select("id", F.explode("bands").alias("band"))
    buckets = rows_.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    member = stages.put(rows_.join(buckets, "band"), "bucket-members")
    weights = stages.put(member.groupBy("id").agg(F.sum("members").alias("weight")), "weights")
    # the full sets of those that share a bucket, tokenised once
    met, = bloom_filters(weights.select("id"))
    sets = stages.put(full_sets(passing(items.where("id IS NOT NULL"), "id", met), n).dropDuplicates(["id", "set"]), "full-sets")

    def marks_with(*more: str) -> DataFrame:
        cap = sketch_cap(percent, longs, F.col("n").cast("double"), F.col("n") / (percent / 100))
        return one.select("id", "n", "sketch", cap.alias("cap"), *more)

    def side(df: DataFrame, i: str) -> DataFrame:
        return df.withColumnsRenamed({"id": i, "n": "n_" + i, "cap": "c_" + i, "sketch": "s_" + i, "bands": "bands_" + i})

    now = member.select("band", "id", F.col("id").alias("c"))
    comp = stages.put(weights.select("id", F.col("id").alias("c")), "components")
    tested: list[DataFrame] = []
    used: list[DataFrame] = []

    def links(pairs: DataFrame, name: str) -> DataFrame | None:
        """Confirm the pairs that were not confirmed or refused before, and
        merge the components that new links join: ``(c, merged)`` of those
        that changed, None if there are none."""
        nonlocal comp
        p = pairs.join(stages.together(tested), ["a", "b"], "left_anti") if tested else pairs
        tested.append(stages.put(p, f"{name}-candidates"))
        new = stages.put(_confirm(tested[-1], sets, percent), f"{name}-links")
        ends = new.join(comp.select(F.col("id").alias("a"), F.col("c").alias("x")), "a").join(
            comp.select(F.col("id").alias("b"), F.col("c").alias("y")), "b")
        edges = stages.put(ends.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), f"{name}-edges")
        if not edges.head(1):
            return None
        merged = stages.put(connected_components(stages, edges).select(F.col("node").alias("c"), F.col("component").alias("merged")), "merged")
        comp = stages.put(_renamed(comp, merged), "components")
        return merged

    pivots_a_bucket = 1
    while True:
        # of each component in a bucket the member that meets most others; of
        # those the first few, which have not been pivots
        rank = now.join(weights, "id")
        if used:
            rank = rank.join(stages.together(used), ["band", "id"], "left_anti")
        heads = rank.groupBy("band", "c").agg(F.max(F.struct("weight", F.negative("id").alias("id"))).alias("p"))
        order = Window.partitionBy("band").orderBy(F.desc("p"))
        heads = heads.withColumn("k", F.row_number().over(order)).where(F.col("k") <= pivots_a_bucket)
        pivots = stages.put(heads.select("band", F.negative("p.id").alias("pivot"), F.col("c").alias("pc")), "pivots")
        used.append(stages.put(pivots.select("band", F.col("pivot").alias("id")), "used"))
        # a pair that cannot link by sizes and sketches does not leave the join
        x = side(now.join(marks_with(), "id"), "a")
        y = side(pivots.withColumnRenamed("pivot", "id").join(marks_with(), "id"), "b").withColumnRenamed("band", "band_b")
        star = x.join(y, (F.col("band") == F.col("band_b")) & (F.col("c") != F.col("pc")) & may_link(percent, longs))
        merged = links(star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "star")
        now = _renamed(now, merged) if merged is not None else now
        # pairs of a bucket's members between different components
        now = stages.put(now, "bucket-components")
        held = now.groupBy("band", "c").agg(F.count("*").cast("double").alias("k"))
        held = held.groupBy("band").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("within"),
                                        F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi")
        mixed = stages.put(held.select("band", "k", ((F.col("k") * F.col("k") - F.col("within")) / 2).alias("across")),
                           "mixed-buckets")
        now = now.join(mixed.select("band"), "band", "left_semi")
        across, held = mixed.agg(F.sum("across"), F.sum("k")).first()
        if merged is None or not held or across <= SPARSE * held:
            break
        now = stages.put(now, "mixed-members")
        pivots_a_bucket *= 4

    now = now.join(marks_with("bands"), "id")
    x, y = (side(now, i).withColumnRenamed("c", "comp_" + i) for i in "ab")
    # a pair comes out of the first bucket that it shares
    first = F.element_at(F.array_intersect("bands_a", "bands_b"), 1) == x["band"]
    rest = x.join(y, (x["band"] == y["band"]) & (F.col("comp_a") < F.col("comp_b")) & may_link(percent, longs) & first)
    links(rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "rest")

    for done in (sets, member, weights):  # read by no later plan
        stages.drop(done)
    name = reps.join(comp, reps["rep"] == comp["id"], "left").select("key", F.coalesce("c", "rep").alias("component"))
    out = sig.select("id", "n", "key").join(name, "key", "left")
    return out.select("id", "n", F.coalesce("component", "id").alias("component"))


def _renamed(df: DataFrame, merged: DataFrame) -> DataFrame:
    """``df`` with the merged name of its component ``c``."""
    return df.join(merged, "c", "left").withColumn("c", F.coalesce("merged", "c")).drop("merged")
