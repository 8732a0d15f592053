"""Mixing sources to target weights by Sainte-Lague apportionment.

Every document has a size (its words).  Sources, in code point order with
null last, weigh 3, 1, 2, repeating, and share 150% of all words; a target
stops at twice its source's size and the excess goes to the others by
weight.  The mix is dealt in blocks of about ``block`` words:

1. the documents of a source are dealt by a hash of their id over about
   ``sqrt(blocks)`` shards, laid end to end inside a shard in hash order and
   cut into equal blocks;
2. the blocks of the whole mix go to sources by highest Sainte-Lague
   quotients ``target / (2 * seats + 1)``, a source's blocks to its shards in
   the same way, so every shard has an integer quota;
3. a shard takes all blocks ``quota div blocks`` times and the remainder by a
   seeded systematic selection of blocks.

A document's ``taken`` is the words of it inside the selected blocks.

Results in special cases: null or empty text has size 0 and takes 0; a null
source is a source of its own; a null id is an id like any other; repeated
rows are mixed as separate rows (the same id and size are interchangeable);
an empty table gives an empty result; extra columns are ignored.

Only DataFrame operations run.  Windows are over one source's shards or one
shard's documents, both about the square root of the source's size, or over
the list of sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerlens.llm.common import Stages, read_table
from offerlens.llm.registry import register

WEIGHTS = (3, 1, 2)
BLOCK = 64
SEED = "mix-1"
BUDGET = 1.5
MOST = 2


def _hash(*cols):
    """60 bits of md5, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(SEED), *cols)), 1, 15), 16, 10).cast("long")


def _apportion(parties: DataFrame, group: list[str], key: list[str], weight: str, seats: str) -> DataFrame:
    """Sainte-Lague seats per party (``key``), within ``group``, for the
    group's number of ``seats``, proportional to ``weight``.

    With the divisor W / (seats - n / 2) rounding gives at most ``seats`` and
    at least ``seats - n`` seats, so only the next few quotients of each party
    are ranked: their number is bounded by three times the parties."""
    w = Window.partitionBy(*group)
    p = parties.withColumns({"_w": F.sum(weight).over(w), "_n": F.count("*").over(w)})
    share = F.when(F.col("_w") > 0, F.col(weight) / F.col("_w")).otherwise(F.lit(0.0))
    low = F.greatest(F.lit(0.0), F.col(seats) - F.col("_n") / 2)
    p = p.withColumn("_share", share).withColumn("_base", F.floor(F.col("_share") * low + 0.4999999).cast("long"))
    p = p.withColumn("_left", F.col(seats) - F.sum("_base").over(w))
    more = F.ceil(F.col("_share") * F.col("_n")).cast("long") + 2
    q = p.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), more)))
    q = q.withColumn("_q", F.col(weight).cast("double") / (2 * (F.col("_base") + F.col("_k")) - 1))
    order = Window.partitionBy(*group).orderBy(F.desc("_q"), *[F.col(k).asc_nulls_last() for k in key], "_k")
    q = q.withColumn("_r", F.row_number().over(order))
    return q.groupBy(*[c for c in parties.columns]).agg(
        (F.first("_base") + F.sum((F.col("_r") <= F.col("_left")).cast("long"))).alias("quota"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """``(source, source_size, target)``: weighted shares of ``budget`` times
    all words, none above ``most`` times its source.  Sources are filled up in
    the order of ``size / weight``: all before the first that stays under its
    limit are full, the rest share by weight."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.partitionBy(F.lit(0))  # one row per source
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1).cast("int"))
    s = s.withColumns({"weight": w, "total": F.sum("source_size").over(every)})
    fill = every.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = s.withColumn("level", (F.col("total") * budget - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most)
                     / F.sum("weight").over(after))
    s = s.withColumn("free", F.col("level") * F.col("weight") < F.col("source_size") * most)
    s = s.withColumn("level", F.min(F.when(F.col("free"), F.struct(F.col("source_size") / F.col("weight"),
                                                                   F.col("source").isNull(), "source", "level"))).over(every)["level"])
    cap = (F.col("source_size") * most).cast("double")
    return s.select("source", "source_size",
                    F.when(F.col("level").isNull(), cap).otherwise(F.least(cap, F.col("level") * F.col("weight"))).alias("target"))


def mix(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)`` per row."""
    stages = Stages(docs.sparkSession, "mix")
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    sizes = stages.put(docs.select("doc_id", "source", size.alias("size")), "sizes")
    t = source_targets(sizes).withColumn("_s", F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")))
    blocks = F.greatest(F.lit(1), F.round(F.col("source_size") / block)).cast("long")
    t = t.withColumn("shards", F.greatest(F.lit(1), F.floor(F.sqrt(blocks))).cast("long"))
    t = stages.put(t, "targets")  # one row per source

    d = sizes.withColumn("_s", F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))).drop("source")
    d = d.join(t, "_s").withColumn("_h", _hash("_s", F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    d = d.withColumn("shard", F.col("_h") % F.col("shards"))
    shard = Window.partitionBy("_s", "shard")
    before = shard.orderBy("_h", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumns({"_at": F.coalesce(F.sum("size").over(before), F.lit(0)).cast("long"),
                       "_all": F.sum("size").over(shard).cast("long")})
    d = stages.put(d, "laid")

    parts = (d.groupBy("_s", "shard").agg(F.first("_all").alias("_all"))
             .withColumn("_blocks", F.when(F.col("_all") > 0, F.greatest(F.lit(1), F.round(F.col("_all") / block)))
                         .otherwise(F.lit(0)).cast("long")))
    n = parts.groupBy("_s").agg(F.sum("_blocks").alias("_sb")).join(t.select("_s", "source_size", "target"), "_s")
    n = n.withColumn("_want", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") * F.col("_sb"))
                     .otherwise(F.lit(0.0)))
    n = n.withColumn("_seats", F.round(F.sum("_want").over(Window.partitionBy(F.lit(0)))).cast("long")).withColumn("_g", F.lit(0))
    n = _apportion(n.select("_g", "_s", "_want", "_seats", "_sb"), ["_g"], ["_s"], "_want", "_seats")
    n = n.select("_s", F.least("quota", F.col("_sb") * MOST).alias("_source_quota"))
    q = _apportion(parts.join(n, "_s"), ["_s"], ["shard"], "_blocks", "_source_quota")
    q = q.select("_s", "shard", "_blocks", F.least("quota", F.col("_blocks") * MOST).alias("quota"))
    d = d.join(q, ["_s", "shard"])

    rest = F.col("quota") % F.col("_blocks")
    start = _hash(F.lit("start"), "_s", F.col("shard").cast("string")) % F.col("_blocks")
    d = d.withColumns({"_rest": F.when(F.col("_blocks") > 0, rest).otherwise(F.lit(0)),
                       "_full": F.when(F.col("_blocks") > 0, F.floor(F.col("quota") / F.col("_blocks"))).otherwise(F.lit(0)).cast("long"),
                       "_start": F.when(F.col("_blocks") > 0, start).otherwise(F.lit(0))})
    # the blocks that a document touches: block j is [floor(j all / n), floor((j + 1) all / n))
    first = F.floor(F.col("_at") * F.col("_blocks") / F.col("_all")).cast("long")
    last = F.floor((F.col("_at") + F.col("size")) * F.col("_blocks") / F.col("_all")).cast("long")
    edge = lambda j: (j * F.col("_all") - (j * F.col("_all")) % F.col("_blocks")) / F.col("_blocks")
    chosen = lambda j: ((j + F.col("_start")) * F.col("_rest")) % F.col("_blocks") < F.col("_rest")
    inside = lambda j: F.greatest(F.lit(0.0), F.least(edge(j + 1), (F.col("_at") + F.col("size")).cast("double"))
                                  - F.greatest(edge(j), F.col("_at").cast("double")))
    extra = F.aggregate(F.sequence(F.greatest(F.lit(0).cast("long"), first - 1), F.least(last + 1, F.col("_blocks") - 1)),
                        F.lit(0.0), lambda a, j: a + F.when(chosen(j), inside(j)).otherwise(F.lit(0.0)))
    taken = F.when(F.col("size") == 0, F.lit(0)).otherwise(F.col("_full") * F.col("size") + F.round(extra)).cast("long")
    return d.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


ORACLE = r"""
WITH d0 AS (SELECT doc_id, CASE WHEN source IS NULL THEN '-' ELSE '=' || source END AS s, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s0 AS (SELECT s, any_value(source) AS source, sum(size)::BIGINT AS source_size FROM d0 GROUP BY s),
s1 AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
         (sum(source_size) OVER ())::BIGINT AS total FROM s0),
s2 AS (SELECT *, source_size / weight AS f, (total * 1.5::DOUBLE - coalesce((sum(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::BIGINT, 0) * 2)
         / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s1),
lv AS (SELECT level FROM s2 WHERE level * weight < source_size * 2 ORDER BY f, source NULLS LAST LIMIT 1),
t AS (SELECT s, source_size, weight, CASE WHEN (SELECT level FROM lv) IS NULL THEN source_size * 2::DOUBLE
         ELSE least(source_size * 2::DOUBLE, (SELECT level FROM lv) * weight) END AS target,
         greatest(1, floor(sqrt(greatest(1, round(source_size / 64.0::DOUBLE)))))::BIGINT AS shards FROM s2),
d1 AS (SELECT d0.doc_id, d0.s, d0.size, source_size, target, shards,
         ('0x' || substr(md5('mix-1:' || d0.s || ':' || coalesce(doc_id::VARCHAR, '-')), 1, 15))::BIGINT AS h FROM d0 JOIN t USING (s)),
d2 AS (SELECT *, h % shards AS shard FROM d1),
d3 AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY s, shard ORDER BY h, doc_id NULLS LAST, size
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos, (sum(size) OVER (PARTITION BY s, shard))::BIGINT AS alls FROM d2),
p AS (SELECT s, shard, any_value(alls) AS alls, CASE WHEN any_value(alls) > 0 THEN greatest(1, round(any_value(alls) / 64.0::DOUBLE)) ELSE 0 END::BIGINT AS blocks
         FROM d3 GROUP BY s, shard),
n0 AS (SELECT s, sum(blocks)::BIGINT AS sb FROM p GROUP BY s),
n1 AS (SELECT s, sb, CASE WHEN source_size > 0 THEN target / source_size * sb ELSE 0 END AS want FROM n0 JOIN t USING (s)),
n2 AS (SELECT *, round(sum(want) OVER ())::BIGINT AS seats FROM n1),
n3 AS (SELECT s, sb, seats, want, k, want / (2 * k - 1) AS q FROM n2, LATERAL (SELECT unnest(generate_series(1, ceil(want)::BIGINT + 3)) AS k)),
n4 AS (SELECT *, row_number() OVER (ORDER BY q DESC, s, k) AS r FROM n3),
n5 AS (SELECT s, least(count(*) FILTER (WHERE r <= seats), any_value(sb) * 2)::BIGINT AS quota FROM n4 GROUP BY s),
q0 AS (SELECT p.*, n5.quota AS seats, (sum(blocks) OVER (PARTITION BY s))::DOUBLE AS w FROM p JOIN n5 USING (s)),
q1 AS (SELECT *, blocks / (2 * k - 1)::DOUBLE AS q FROM q0, LATERAL (SELECT unnest(generate_series(1, (3 * blocks + 3)::BIGINT)) AS k)),
q2 AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY q DESC, shard, k) AS r FROM q1),
q3 AS (SELECT s, shard, any_value(blocks) AS blocks, least(count(*) FILTER (WHERE r <= seats), any_value(blocks) * 2)::BIGINT AS quota FROM q2 GROUP BY s, shard),
e AS (SELECT d3.*, blocks, quota, CASE WHEN blocks > 0 THEN quota % blocks ELSE 0 END AS rest, CASE WHEN blocks > 0 THEN quota // blocks ELSE 0 END AS fulls,
         CASE WHEN blocks > 0 THEN ('0x' || substr(md5('mix-1:start:' || s || ':' || shard::VARCHAR), 1, 15))::BIGINT % blocks ELSE 0 END AS start
         FROM d3 JOIN q3 USING (s, shard))
SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE fulls * size + coalesce((SELECT sum(greatest(0,
         least(((j + 1) * alls) // blocks, pos + size) - greatest((j * alls) // blocks, pos)))
         FROM (SELECT unnest(generate_series(0, blocks - 1)) AS j) WHERE ((j + start) * rest) % blocks < rest), 0) END::BIGINT AS taken
FROM e
"""


@register("op4_mix_sources", ORACLE)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
