"""Embedding near-duplicates by iterative quantisation (ITQ).

Vectors are compared only inside their label and length.  Equal vectors are one
member.  A rotation for balanced binary codes is learned by ITQ on a bounded
sample of unit vectors of each length (``FIT_ROWS``): centre, project on the
principal directions, then alternate codes ``sign(V R)`` and the orthogonal
Procrustes rotation ``R``.  Every vector is coded and put into multi-index
Hamming tables: the code is cut into chunks, a pair meets if some chunk differs
in at most one bit.  Candidates inside the Hamming radius are re-ranked with the
original vectors: cosine in double precision, links at ``0.98`` or more.

The fit samples, the index holds every row.  How many bits a pair at the
threshold flips depends on the vectors: 0.064 of them if these are spread
around zero, many more if they share a large mean, since centring takes the
mean away and the difference stays.  So each length takes the first of
``INDEXES`` (more bits and tables the further down) that finds at least
``RECALL`` of sample pairs made at exactly the threshold, and a radius that
holds nearly all of these.  The last ones do not centre; there 0.064 holds
whatever the mean, and more false candidates are re-ranked.

Results in special cases: null, empty or zero vectors and vectors with null or
non-finite components, null labels: no links, own component; vectors of
different lengths are not compared (they have no cosine); repeated rows
are vectors of their own (equal ones link); rows that share an id share its
component; a null id has a null component; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerlens.llm.common import Stages, connected_components, lean, plain, read_table, release, ship, sorted_join
from offerlens.llm.registry import register
from offerlens.session import fine_tasks

ship(__name__)

COSINE = 0.98
BITS = 64  # of a word of the code
FIT_ROWS = 4096  # of each length
ROUNDS = 30
RECALL = 0.97  # of sample pairs at the threshold


class Index(NamedTuple):
    """Codes of ``words`` words, each cut into chunks of ``width`` bits."""

    words: int
    width: int
    centred: bool

    def chunks(self) -> list[tuple[int, int]]:
        """(word, first bit) of each chunk."""
        return [(w, self.width * i) for w in range(self.words) for i in range(BITS // self.width)]


INDEXES = [Index(1, 16, True), Index(2, 16, True), Index(4, 16, True), Index(4, 12, True), Index(8, 12, True), Index(16, 12, True),
           Index(1, 16, False), Index(2, 16, False), Index(4, 12, False)]


def fit(sample: np.ndarray, words: int = 1, centred: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection) of unit vectors: codes are ``(x - mean) @ projection > 0``."""
    dim = sample.shape[1]
    mean = sample.mean(axis=0) if centred else np.zeros(dim)
    _, _, vt = np.linalg.svd(sample - mean, full_matrices=True)
    out = []
    for word in range(words):  # the next directions, from the first again after the last: another rotation tells them apart
        base = vt[(np.arange(BITS) + word * BITS) % dim].T
        v = (sample - mean) @ base
        r, _ = np.linalg.qr(np.random.default_rng(7 + word).normal(size=(BITS, BITS)))
        for _ in range(ROUNDS):
            u, _, w = np.linalg.svd(np.where(v @ r > 0, 1.0, -1.0).T @ v)
            r = (u @ w).T
        out.append(base @ r)
    return mean, np.concatenate(out, axis=1)


def code(x: np.ndarray, mean: np.ndarray, proj: np.ndarray) -> np.ndarray:
    """The code words of unit vectors, as longs."""
    return np.packbits((x - mean) @ proj > 0, axis=1).copy().view(np.int64)


def threshold_pairs(sample: np.ndarray, cosine: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of unit vectors at exactly ``cosine``, of two kinds: each sample vector and one
    turned in a random direction, and one turned towards another sample vector."""
    rng = np.random.default_rng(11)
    out = []
    for away in (rng.normal(size=sample.shape), sample[rng.permutation(len(sample))]):
        away = away - (away * sample).sum(axis=1, keepdims=True) * sample
        size = np.linalg.norm(away, axis=1)
        some = size > 1e-9
        x, away = sample[some], away[some] / size[some, None]
        if len(x):
            out.append((x, cosine * x + np.sqrt(1 - cosine**2) * away))
    return out


def meets(a: np.ndarray, b: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """(whether some chunk differs in at most one bit, bits that differ)."""
    bits = np.unpackbits((a ^ b).byteswap().view(np.uint8), axis=1).reshape(len(a), index.words, BITS)[:, :, ::-1]  # lowest bit first
    near = np.zeros(len(a), bool)
    for word, at in index.chunks():
        near |= bits[:, word, at:at + index.width].sum(axis=1) <= 1
    return near, bits.sum(axis=(1, 2))


def choose(sample: np.ndarray, cosine: float, indexes: list[Index] = INDEXES) -> tuple[Index, int, np.ndarray, np.ndarray]:
    """(index, radius, mean, projection) for a sample of unit vectors."""
    pairs = threshold_pairs(sample, cosine)
    best = None
    for index in indexes:
        mean, proj = fit(sample, index.words, index.centred)
        kinds = [meets(code(x, mean, proj), code(y, mean, proj), index) for x, y in pairs]
        # 1 of 1,000 sample pairs beyond the radius, and never below the one that centred vectors take
        radius = max([BITS * index.words // 4, *(int(np.ceil(np.quantile(apart, 0.999))) for _, apart in kinds)])
        recall = min((near.mean() for near, _ in kinds), default=1.0)
        if best is None or recall > best[0]:
            best = (recall, index, radius, mean, proj)
        if recall >= RECALL:
            break
    return best[1:]


def _codes(vectors: DataFrame, models: dict[int, tuple]) -> DataFrame:
    """``code`` (words of 64 bits) of each row of ``vectors(id, g, v)``; ``models`` by length."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for length, part in pdf.groupby(pdf["v"].map(len)):
                x = np.stack(part["v"].to_numpy()).astype(np.float64)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                _, _, mean, proj = models[length]
                yield pd.DataFrame({"id": part["id"].to_numpy(), "g": plain(part["g"]), "code": list(code(x, mean, proj))})

    return vectors.mapInPandas(lean(run), "id long, g string, code array<long>")


def near_duplicate_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of
    ``vectors(vec_id, embedding, label)``."""
    spark = vectors.sparkSession
    stages = Stages(spark, "itq")
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("g"),
                       F.col("embedding").cast("array<double>").alias("v"))
    finite = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # scaled by the largest component, so that squares neither overflow nor vanish
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    good = F.coalesce(finite & F.col("g").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    scaled = F.when(good & (largest > 0), F.transform("v", lambda x: x / largest))
    v = v.select("vec_id", "g", scaled.alias("v"))
    v = v.withColumn("key", F.when(F.col("v").isNotNull(), F.md5(F.concat_ws("|", "g", F.to_json("v")).cast("binary"))))
    rows = stages.put(v, "rows")
    sets = stages.put(rows.where("key IS NOT NULL").groupBy("key").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "sets")
    one = rows.where("key IS NOT NULL").dropDuplicates(["key"]).select("key", "g", "v").join(sorted_join(sets), "key")
    one = stages.put(one, "members")

    by = Window.partitionBy("size").orderBy("h", "key")
    sample = one.select(F.size("v").alias("size"), F.xxhash64("key").alias("h"), "key", "v").withColumn("i", F.row_number().over(by))
    models = {}
    for size, part in sample.where(F.col("i") <= FIT_ROWS).select("size", "v").toPandas().groupby("size"):
        x = np.stack(part["v"].to_numpy()).astype(np.float64)
        models[int(size)] = choose(x / np.linalg.norm(x, axis=1, keepdims=True), cosine)
    release()
    parts = []
    for index in sorted({m[0] for m in models.values()}):  # lengths with the same index go together
        some = {size: m for size, m in models.items() if m[0] == index}
        mine = one.where(F.size("v").isin(list(some))).withColumn("g", F.concat_ws("|", F.size("v").cast("string"), "g"))
        links = _links(stages, mine, some, index, cosine)
        with fine_tasks(spark, parts=1):  # vectors are sorted: the session's number of parts, small tasks
            parts.append(stages.put(links, "links"))
    found = stages.together(parts) if parts else one.select(F.col("key").alias("a"), F.col("key").alias("b")).limit(0)

    # links between sets are links between all their copies
    copies = sets.select("key", "copies")
    both = found.union(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = stages.put(both.join(sorted_join(copies.withColumnRenamed("key", "b")), "b").groupBy("a").agg(F.sum("copies").alias("near")), "near")
    ids = sets.select("key", "id")
    edges = (found.join(sorted_join(ids.select(F.col("key").alias("a"), F.col("id").alias("x"))), "a")
             .join(sorted_join(ids.select(F.col("key").alias("b"), F.col("id").alias("y"))), "b").select(F.col("x").alias("a"), F.col("y").alias("b")))
    # rows that share an id are one vector of several forms: they hang together
    same = rows.where("key IS NOT NULL").join(sorted_join(sets), "key").where("vec_id <> id").select(F.col("vec_id").alias("a"), F.col("id").alias("b"))
    repeated = rows.groupBy("vec_id").agg(F.countDistinct("key").alias("forms")).where("forms > 1").select("vec_id")
    same = same.join(sorted_join(repeated), F.col("a") == F.col("vec_id"), "left_semi")
    comp = connected_components(stages, edges.union(same))
    out = rows.select("vec_id", "key").join(sorted_join(sets), "key", "left").join(sorted_join(near), F.col("key") == F.col("a"), "left")
    out = out.withColumn("start", F.coalesce("id", "vec_id")).join(sorted_join(comp), F.col("start") == F.col("node"), "left")
    c = F.coalesce("component", "start")
    return out.select("vec_id", (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("near", F.lit(0))).cast("long").alias("n_links"),
                      c.alias("component_id"), F.col("vec_id").eqNullSafe(c).alias("kept"))


def _links(stages: Stages, one: DataFrame, models: dict[int, tuple], index: Index, cosine: float) -> DataFrame:
    """Linked pairs ``(a, b)`` of set keys.  In the index a member goes by a
    64-bit hash of its key; members that share one are all re-ranked."""
    one = one.select("g", "key", "v", F.xxhash64("key").alias("id"))
    codes = stages.put(_codes(one.select("id", "g", "v"), models).distinct(), "codes")
    mask = 2**index.width - 1
    chunks = index.chunks()
    chunk = [F.shiftrightunsigned(F.col("code")[w], at).bitwiseAND(mask) for w, at in chunks]
    table = F.array(*[F.struct(F.lit(c).alias("c"), x.alias("chunk")) for c, x in enumerate(chunk)])
    probe = F.array(*[F.struct(F.lit(c).alias("c"), x.bitwiseXOR(p).alias("chunk"))
                      for c, x in enumerate(chunk) for p in (0, *(1 << i for i in range(index.width)))])
    # a group's name begins with the length of its vectors
    size = F.substring_index("g", "|", 1).cast("int")
    radius = F.lit(None)
    for length, m in models.items():
        radius = F.when(size == length, m[1]).otherwise(radius)
    x = codes.select("g", radius.alias("radius"), F.col("id").alias("x"), F.col("code").alias("cx"), F.explode(probe).alias("t")).select("g", "radius", "x", "cx", "t.*")
    y = codes.select("g", F.col("id").alias("y"), F.col("code").alias("cy"), F.explode(table).alias("t")).select("g", "y", "cy", "t.*")
    diff = [F.col("cx")[w].bitwiseXOR(F.col("cy")[w]) for w in range(index.words)]
    apart = sum((F.bit_count(d) for d in diff[1:]), F.bit_count(diff[0]))
    first = None
    for c, (w, at) in enumerate(chunks):
        near = F.bit_count(F.shiftrightunsigned(diff[w], at).bitwiseAND(mask)) <= 1
        first = F.when(near, c) if first is None else first.when(near, c)
    # a pair is made in the first table where it meets only
    pairs = x.join(sorted_join(y), ["g", "c", "chunk"]).where((F.col("x") < F.col("y")) & (apart <= F.col("radius")) & (first == F.col("c")))
    pairs = stages.put(pairs.select("g", "x", "y").distinct(), "candidates")
    left = one.select("g", F.col("id").alias("x"), F.col("key").alias("a"), F.col("v").alias("va"))
    right = one.select("g", F.col("id").alias("y"), F.col("key").alias("b"), F.col("v").alias("vb"))

    @F.pandas_udf("boolean")
    def linked(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            if not len(a):
                yield pd.Series([], dtype=bool)
                continue
            u, w = np.stack(a.to_numpy()), np.stack(b.to_numpy())
            dot = np.einsum("ij,ij->i", u, w)
            yield pd.Series(dot / (np.sqrt(np.einsum("ij,ij->i", u, u)) * np.sqrt(np.einsum("ij,ij->i", w, w))) >= cosine)
        release()

    return pairs.join(sorted_join(right), ["g", "y"]).join(sorted_join(left), ["g", "x"]).where(linked("va", "vb")).select("a", "b")


ORACLE = r"""
WITH RECURSIVE e0 AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) AS q
         FROM embeddings),
e AS (SELECT *, sqrt(q) AS nv FROM e0 WHERE label IS NOT NULL AND q > 0 AND NOT isnan(q) AND NOT isinf(q)),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM e x JOIN e y ON x.label = y.label AND x.vec_id <> y.vec_id
         WHERE list_dot_product(x.v, y.v) / (x.nv * y.nv) >= 0.98),
r AS (SELECT vec_id AS node, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.node)
SELECT d.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, g.c AS component_id, d.vec_id = g.c AS kept
FROM embeddings d JOIN (SELECT node, min(c) AS c FROM r GROUP BY node) g ON g.node = d.vec_id
LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) n ON n.a = d.vec_id
"""


@register("op2_itq_near_dedup", ORACLE)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))
