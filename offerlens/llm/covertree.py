"""Hard negatives by exact inner-product search in cover trees.

An anchor's positives are the rows of its label with the highest inner
product; for each positive the hard negatives are the best rows of other
labels whose score lies in a window below the positive's score.  Vectors are
whole numbers, so every score is exact.

Candidates are dealt to blocks of bounded size: near rows together (the
nearest of a few pivots), cells that hold more rows than a block split.  In a
block each label has a cover tree.  Its points get one more coordinate,
``sqrt(M^2 - |x|^2)`` with ``M`` the label's largest norm, so all lie on one
sphere; a level halves the radius inside which a node covers its points, and a
node keeps its exact covering radius.  The radius is an angle on the sphere
and with the angle to the anchor it bounds the inner products under the node
from above and below.  Search takes the nodes best first, skips those whose
bounds lie outside all windows still open (or below the rows already found),
and verifies the points of opened nodes exactly.  Anchors are a stated query
set, met block by block: every tree is built once and written, and a task gets
one tree and a bounded chunk of anchors.

Results in special cases: rows with a null id, label or vector or a null
component take no part; vectors of different lengths are never compared; rows
that share an id are rows of their own but never partners of each other, ties
between them go by label; repeated anchor rows count once; empty vectors score
0 among themselves; an anchor without positives, and a positive without rows in
its window, have no result; a component beyond +-2^24 counts as +-2^24, so
that a score fits a long; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerlens.llm.common import Stages, read_table, ship
from offerlens.llm.registry import register

ship(__name__)

BLOCK = 2**19  # components of a block's vectors
CHUNK = 2**17  # components of a chunk's anchors
PIVOTS, PIVOT_ROWS = 16, 2048  # pivots only make blocks local; any choice gives the same result
LEAF = 24
LIMIT = 2**24


def scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers held as doubles."""
    if x.size and np.abs(x).max() * np.abs(q).max() * x.shape[-1] >= 2.0**53:
        return x.astype(np.int64) @ q.astype(np.int64)
    return (x @ q).astype(np.int64)


def build(x: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
    """Cover trees of the rows of ``x``, one per label, as flat arrays.

    Node ``i`` has the centre row ``centre[i]``, the covering angle
    ``angle[i]``, the sphere ``norm[i]``, children ``first[i]:last[i]`` and
    own points ``points[start[i]:stop[i]]``.  The first nodes are the roots,
    in the order of ``labels``."""
    norms = np.sqrt((x * x).sum(axis=1))
    labels, group = np.unique(label, return_inverse=True)
    order = np.argsort(group, kind="stable")
    sets = np.split(order, np.searchsorted(group[order], np.arange(1, len(labels))))
    queue, nodes, points, taken = [], [], [], 0
    for rows in sets:
        top = norms[rows].max()
        y = np.column_stack([x[rows], np.sqrt(np.maximum(top * top - norms[rows]**2, 0.0))])
        queue.append((rows, y, np.sqrt(((y - y[0])**2).sum(axis=1)), top))
    at = 0
    while at < len(queue):
        rows, y, dist, top = queue[at]  # the first row is the centre
        queue[at] = None
        at += 1
        radius = dist.max()
        first, own = len(queue), rows
        if len(rows) > LEAF and radius > 0:
            inner = 2.0**(np.ceil(np.log2(radius)) - 1)
            if inner >= radius:
                inner = radius / 2
            own, left, near = [], np.arange(len(rows)), dist
            while len(left):
                inside = near <= inner
                members = left[inside]
                if len(members) == 1:
                    own.append(rows[members[0]])  # a child that covers only itself
                else:
                    queue.append((rows[members], y[members], near[inside], top))
                left = left[~inside]
                if len(left):
                    near = np.sqrt(((y[left] - y[left[0]])**2).sum(axis=1))
            own = np.array(own, np.int64)
        angle = 2 * np.arcsin(min(1.0, radius / (2 * top))) if top > 0 else 0.0
        nodes.append((rows[0], angle, top, first, len(queue), taken, taken + len(own)))
        points.append(own)
        taken += len(own)
    centre, angle, norm, first, last, start, stop = zip(*nodes)
    place = np.concatenate(points)
    return {"labels": labels, "centre": np.array(centre), "angle": np.array(angle), "norm": np.array(norm),
            "first": np.array(first), "last": np.array(last), "start": np.array(start), "stop": np.array(stop), "points": place}


class Forest:
    """The trees of one block, ready for search."""

    def __init__(self, blob: bytes):
        z = np.load(io.BytesIO(blob))
        self.labels, self.points = z["labels"], z["points"]
        self.centre, self.angle, self.norm = z["centre"], z["angle"], z["norm"]
        self.first, self.last, self.start, self.stop = z["first"], z["last"], z["start"], z["stop"]
        self.x, self.ids, self.label = z["x"].astype(np.float64), z["ids"], z["label"]
        self.own, self.centres = self.x[self.points], self.x[self.centre]
        self.opened = 0

    def bounds(self, lo: int, hi: int, q: np.ndarray, size: float) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) bounds of the inner products under nodes lo:hi."""
        reach = size * self.norm[lo:hi]
        cos = np.divide(scores(self.centres[lo:hi], q), reach, out=np.ones(hi - lo), where=reach > 0)
        angle = np.arccos(np.clip(cos, -1.0, 1.0))
        slack = 1 + 1e-7 * reach
        return (reach * np.cos(np.minimum(angle + self.angle[lo:hi], np.pi)) - slack,
                reach * np.cos(np.maximum(angle - self.angle[lo:hi], 0.0)) + slack)

    def search(self, q: np.ndarray, anchor: int, label, same: bool, low: np.ndarray, high: np.ndarray, k: int) -> list:
        """Per window ``low[w] <= score <= high[w]`` the first ``k`` rows
        ``(-score, id, label)`` whose label is (not) the anchor's."""
        found: list[list] = [[] for _ in low]
        need = low.astype(np.float64)
        top = high.astype(np.float64)
        size = float(np.sqrt((q * q).sum()))
        heap: list = []

        def offer(lo: int, hi: int, allowed=None) -> None:
            below, above = self.bounds(lo, hi, q, size)
            alive = ((above[:, None] >= need) & (below[:, None] <= top)).any(axis=1)
            if allowed is not None:
                alive &= allowed
            for i in np.flatnonzero(alive):
                heapq.heappush(heap, (-above[i], below[i], lo + int(i)))

        offer(0, len(self.labels), (self.labels == label) == same)
        while heap:
            above, below, node = heapq.heappop(heap)
            if -above < need.min():
                break
            if not ((-above >= need) & (below <= top)).any():
                continue
            self.opened += 1
            lo, hi = self.start[node], self.stop[node]
            if hi > lo:
                s = scores(self.own[lo:hi], q)
                for w in range(len(found)):
                    good = np.flatnonzero((s >= need[w]) & (s <= high[w]))
                    if len(good):
                        rows = self.points[lo + good]
                        new = [(-int(v), int(i), y) for v, i, y in zip(s[good], self.ids[rows], self.label[rows]) if i != anchor]
                        found[w] = heapq.nsmallest(k, found[w] + new)
                        if len(found[w]) == k:
                            need[w] = max(need[w], -found[w][-1][0])
            if self.last[node] > self.first[node]:
                offer(int(self.first[node]), int(self.last[node]))
        return found


def _matrix(v: pd.Series) -> np.ndarray:
    return np.stack(v.to_numpy()).astype(np.float64) if len(v) else np.zeros((0, 0))


def _cells(rows: DataFrame) -> DataFrame:
    """``cell``: the nearest pivot of the row's length."""
    sample = rows.select("v", "dim").orderBy(F.xxhash64("id", "v")).limit(PIVOT_ROWS).toPandas()
    pivots = {}
    for dim, part in sample.groupby("dim"):
        x = _matrix(part["v"])
        chosen, dist = [0], ((x - x[0])**2).sum(axis=1)
        while len(chosen) < PIVOTS and dist.max() > 0:
            chosen.append(int(dist.argmax()))
            dist = np.minimum(dist, ((x - x[chosen[-1]])**2).sum(axis=1))
        pivots[dim] = x[chosen]

    @F.pandas_udf("int")
    def nearest(v: pd.Series) -> pd.Series:
        size = v.map(len).to_numpy()
        out = np.zeros(len(v), np.int32)
        for dim in np.unique(size):
            if dim in pivots and dim > 0:
                at, p = np.flatnonzero(size == dim), pivots[dim]
                out[at] = ((p * p).sum(axis=1) - 2 * _matrix(v.iloc[at]) @ p.T).argmin(axis=1)
        return pd.Series(out)

    return rows.withColumn("cell", nearest("v"))


def hard_negatives(rows: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, per: int = 100) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)`` from ``rows(id, label, vector, anchor)``; the window of
    a positive is ``low * positive <= per * negative <= high * positive``."""
    spark = rows.sparkSession
    stages = Stages(spark, "covertree")
    whole = F.transform("vector", lambda x: F.greatest(F.least(x.cast("long"), F.lit(LIMIT)), F.lit(-LIMIT)).cast("int"))
    v = rows.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND forall(vector, x -> x IS NOT NULL)")
    v = v.select(F.col("id").cast("long").alias("id"), F.col("label").cast("string").alias("label"), whole.alias("v"),
                 F.size("vector").alias("dim"), F.coalesce("anchor", F.lit(False)).alias("anchor"))
    v = stages.put(v, "rows")
    v = stages.put(_cells(v).withColumn("row", F.monotonically_increasing_id()), "cells")
    share = F.greatest(F.lit(256), F.floor(F.lit(BLOCK) / F.greatest("dim", F.lit(1)))).cast("long")
    parts = v.groupBy("dim", "cell").agg(F.ceil(F.count("*") / share).alias("parts"))
    v = v.join(parts, ["dim", "cell"]).withColumn("block", F.xxhash64("dim", "cell", F.pmod(F.xxhash64("row"), "parts")))

    def plant(pdf: pd.DataFrame) -> pd.DataFrame:
        x, label = _matrix(pdf["v"]), pdf["label"].to_numpy(dtype=object).astype(str)
        out = io.BytesIO()
        np.savez(out, x=x.astype(np.int32), ids=pdf["id"].to_numpy(np.int64), label=label, **build(x, label))
        return pd.DataFrame({"dim": [pdf["dim"].iloc[0]], "block": [pdf["block"].iloc[0]], "tree": [out.getvalue()],
                             "labels": [np.unique(label).tolist()]})

    trees = v.select("id", "label", "v", "dim", "block").groupBy("dim", "block").applyInPandas(
        plant, "dim int, block long, tree binary, labels array<string>")
    trees = stages.put(trees, "trees")
    blocks = spark.read.schema(trees.schema).parquet(trees._stage_path).select("dim", "block", "labels")
    anchors = v.where("anchor").select("id", "label", "v", "dim").distinct()
    anchors = stages.put(anchors.withColumn("a", F.monotonically_increasing_id()), "anchors")
    load = anchors.agg(F.sum(F.greatest("dim", F.lit(16)).cast("long"))).first()[0] or 0
    chunks = max(1, -(-load // CHUNK))
    anchors = anchors.withColumn("chunk", F.pmod(F.xxhash64("a"), F.lit(chunks)).cast("int"))
    trees = trees.select("block", "tree").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def seek(same: bool, k: int):
        def run(trees_: pd.DataFrame, anchors_: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(trees_) and len(anchors_):
                forest = Forest(trees_["tree"].iloc[0])
                for a, i, label, x, windows in zip(anchors_["a"], anchors_["id"], anchors_["label"], anchors_["v"], anchors_["windows"]):
                    w = np.asarray(windows, np.int64)
                    lo = -((-low * w) // per) if not same else np.full(1, -2**62)
                    hi = (high * w) // per if not same else np.full(1, 2**62)
                    hits = forest.search(np.asarray(x, np.float64), i, label, same, lo, hi, k)
                    out += [(a, int(t), j, y, -s) for t, found in zip(w, hits) for s, j, y in found]
            return pd.DataFrame(out, columns=["a", "w", "id", "label", "score"]).astype({"a": "int64", "w": "int64", "id": "int64", "score": "int64"})
        return run

    def search(asked: DataFrame, where, same: bool, k: int) -> DataFrame:
        """The first ``k`` rows per anchor and window, over all blocks."""
        met = asked.join(blocks, "dim").where(where).drop("labels")
        hits = trees.groupBy("block", "chunk").cogroup(met.groupBy("block", "chunk")).applyInPandas(
            seek(same, k), "a long, w long, id long, label string, score long")
        order = Window.partitionBy("a", "w").orderBy(F.desc("score"), "id", "label")
        return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    has = F.array_contains("labels", F.col("label"))
    pos = search(anchors.withColumn("windows", F.array(F.lit(0).cast("long"))), has, True, positives)
    pos = stages.put(pos.select("a", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    asked = anchors.join(pos.groupBy("a").agg(F.collect_set("positive_score").alias("windows")), "a")
    neg = search(asked, ~has | (F.size("labels") > 1), False, negatives)
    neg = stages.put(neg.select("a", F.col("w").alias("positive_score"), "rank", F.col("id").alias("negative_id"),
                                F.col("score").alias("negative_score")), "negatives")
    return (pos.join(neg, ["a", "positive_score"]).join(anchors.select("a", F.col("id").alias("anchor_id")), "a")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))


ORACLE = r"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS v, vec_id % 100 = 0 AS anchor
         FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
         AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
         FROM e a JOIN e b ON a.anchor AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
         QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INTEGER AS rank, s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 5
"""


@register("op11_cover_tree_hard_negatives", ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings")
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    near = F.transform(x, lambda c: F.floor(F.greatest(F.least(c, F.lit(2.0**20)), F.lit(-2.0**20)) * 256))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(e.select(F.col("vec_id").alias("id"), label.alias("label"), F.when(finite, near).alias("vector"),
                                   (F.col("vec_id") % 100 == 0).alias("anchor")))
