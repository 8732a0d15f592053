"""Registered queries: discount ladder, optimum, recommendation and its
evaluation table (the flagship)."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerlens.operators import ladder as L
from offerlens.operators import prep
from offerlens.plans import master as M
from offerlens.plans.master import rounded
from offerlens.plans.oracle_chain import md5_unit_sql, rsql, with_modelling
from offerlens.plans.registry import ORACLES, register

SCORER = L.LogisticScorer()
GAMMAS = L.DEFAULT_GAMMAS
ROW_KEY = ["offer_id", "product_cluster_shp", "discount_shp", "published_revenue_shp"]


def test_rows(spark, sf_dir):
    _, test = M.split(M.modelling_table(spark, sf_dir))
    return test


def _ladder_cte(src: str = "test", cols: str = "*") -> list[tuple[str, str]]:
    """Long ladder 0..99 per row (row id by row_number in the oracle)."""
    p = SCORER.sql_prob("CAST(d AS DOUBLE)")
    return [
        ("rows_", f"SELECT row_number() OVER () AS rid, {cols} FROM {src}"),
        ("lad", f"""
            SELECT rid, d, p, (1.0::DOUBLE - CAST(d AS DOUBLE) / 100.0::DOUBLE) * p AS r
            FROM (SELECT rid, d, {p} AS p FROM rows_, range(0, 100) t(d)) x"""),
        ("lad_max", """
            SELECT l.rid, max(r) AS mx, min(CASE WHEN r = m.mx0 THEN d END) AS opt
            FROM lad l JOIN (SELECT rid, max(r) AS mx0 FROM lad GROUP BY rid) m ON l.rid = m.rid
            GROUP BY l.rid"""),
    ]


def _interval_sql(g: float) -> str:
    return (f"(SELECT l.rid, min(d) AS lo, max(d) AS hi FROM lad l JOIN lad_max m ON l.rid = m.rid "
            f"WHERE r > (1.0::DOUBLE - {float(g)!r}::DOUBLE / 100.0::DOUBLE) * m.mx GROUP BY l.rid)")


# --- R5 / R6 -------------------------------------------------------------------

REC_GAMMA, REC_CC = 6, 3


@register("recommend", with_modelling(*_ladder_cte()) + f"""
    SELECT offer_id, product_cluster_shp, discount_shp, CAST(i.lo AS INTEGER) AS discount_low,
           CAST(i.hi AS INTEGER) AS discount_high,
           CAST(least(97, m.opt + {REC_CC}) AS INTEGER) AS discount_opt,
           CAST(m.opt AS INTEGER) AS discount_opt_wo_adj
    FROM rows_ r JOIN lad_max m ON r.rid = m.rid JOIN {_interval_sql(REC_GAMMA)} i ON r.rid = i.rid""",
          headline=True)
def q_recommend(spark, sf_dir):
    """R5 + R6 (+W6): optimum on the 0..99 ladder, gamma interval, adjusted optimum."""
    t = test_rows(spark, sf_dir)
    r = L.recommend(t, SCORER, gamma=REC_GAMMA, cc_adjustment=REC_CC)
    return r.select("offer_id", "product_cluster_shp", "discount_shp", "discount_low",
                    "discount_high", "discount_opt", "discount_opt_wo_adj")


def flagship(spark, sf_dir):
    """entry(): the recommendation for every test-window offer line."""
    return q_recommend(spark, sf_dir)


# A closed form whose acceptance falls with the discount, as a
# tree model without constraints may have it.
FALLING = L.LogisticScorer(intercept=1.0, discount_coef=-0.02)


def _monotone_ctes() -> list[tuple[str, str]]:
    p = FALLING.sql_prob("CAST(d AS DOUBLE)")
    return [("rows_", "SELECT row_number() OVER () AS rid, * FROM test"),
            ("raw", f"SELECT rid, d, {p} AS p FROM rows_, range(0, 100) t(d)"),
            ("lad", """SELECT rid, d, p, (1.0::DOUBLE - CAST(d AS DOUBLE) / 100.0::DOUBLE) * p AS r FROM (
               SELECT rid, d, max(p) OVER (PARTITION BY rid ORDER BY d ROWS UNBOUNDED PRECEDING) AS p FROM raw) x"""),
            _ladder_cte()[2]]


@register("recommend_monotone", with_modelling(*_monotone_ctes()) + f"""
    SELECT offer_id, product_cluster_shp, discount_shp, CAST(i.lo AS INTEGER) AS discount_low,
           CAST(i.hi AS INTEGER) AS discount_high, CAST(m.opt AS INTEGER) AS discount_opt_wo_adj
    FROM rows_ r JOIN lad_max m ON r.rid = m.rid JOIN {_interval_sql(REC_GAMMA)} i ON r.rid = i.rid""")
def q_recommend_monotone(spark, sf_dir):
    """W9 + R6: the recommendation on the running maximum of the ladder."""
    r = L.recommend(test_rows(spark, sf_dir), FALLING, gamma=REC_GAMMA, monotone=True)
    return r.select("offer_id", "product_cluster_shp", "discount_shp", "discount_low", "discount_high", "discount_opt_wo_adj")


# --- R7 + P18 -------------------------------------------------------------------

def _eval_cols() -> list[str]:
    cols = ["real_discount", "pub_rev", "accepted", "rom_discount", "rom_pa", "rom_exp_rev"]
    for g in GAMMAS:
        cols += [f"rom_discount_{g}_low", f"rom_discount_{g}_mid", f"rom_discount_{g}_high"]
    return cols + ["real_rev", "rom_diff"]


EVAL_DOUBLE = {"real_discount", "pub_rev", "rom_pa", "rom_exp_rev", "real_rev", "rom_diff"} | {
    f"rom_discount_{g}_mid" for g in GAMMAS}


def eval_sql_ctes() -> list[tuple[str, str]]:
    """R7 table ``rom_eval`` in SQL (reused by the evaluation queries)."""
    p_opt = SCORER.sql_prob("CAST(m.opt AS DOUBLE)")
    gam = []
    joins = []
    for g in GAMMAS:
        a = f"i{g}"
        gam += [f"CAST({a}.lo AS INTEGER) AS rom_discount_{g}_low",
                f"(CAST({a}.lo AS INTEGER) + CAST({a}.hi AS INTEGER)) / 2.0::DOUBLE AS rom_discount_{g}_mid",
                f"CAST({a}.hi AS INTEGER) AS rom_discount_{g}_high"]
        joins.append(f"JOIN {_interval_sql(g)} {a} ON r.rid = {a}.rid")
    return _ladder_cte() + [("rom_eval", f"""
        SELECT r.rid, offer_id, product_cluster_shp, organization_id,
               discount_shp AS real_discount, exp(log_published_revenue) AS pub_rev, accepted,
               CAST(m.opt AS INTEGER) AS rom_discount, {p_opt.replace('CAST(m.opt AS DOUBLE)', 'CAST(m.opt AS DOUBLE)')} AS rom_pa,
               m.mx AS rom_exp_rev, {', '.join(gam)},
               (1.0::DOUBLE - discount_shp / 100.0::DOUBLE) * exp(log_published_revenue) * accepted AS real_rev,
               m.opt - discount_shp AS rom_diff
        FROM rows_ r JOIN lad_max m ON r.rid = m.rid {' '.join(joins)}""")]


def rom_eval(spark, sf_dir):
    t = test_rows(spark, sf_dir)
    return L.recommendation_eval(t, SCORER, GAMMAS, keep=["offer_id", "product_cluster_shp", "organization_id"])


@register("recommendation_eval", with_modelling(*eval_sql_ctes()) + "SELECT offer_id, product_cluster_shp, " + ", ".join(
    f"{rsql(c)} AS {c}" if c in EVAL_DOUBLE else c for c in _eval_cols()) + " FROM rom_eval")
def q_recommendation_eval(spark, sf_dir):
    """R7 + P18 + J9: evaluation row per test line for gammas 2..10."""
    e = rom_eval(spark, sf_dir)
    return e.select("offer_id", "product_cluster_shp",
                    *[rounded(F.col(c)).alias(c) if c in EVAL_DOUBLE else F.col(c) for c in _eval_cols()])


# --- R3 / R4 / A10 (current-generation simulation) -------------------------------

SIM_STEPS = L.ladder_steps(0.0, 1.0, 0.1)


def _sim(spark, sf_dir, unit="percent"):
    t = test_rows(spark, sf_dir)
    s = L.simulate_discount_effect(t, SCORER, "published_revenue_shp", 0.0, 1.0, 0.1, unit=unit)
    return L.find_optimal_discount(s)


def _sim_sql_ctes(unit: str = "percent") -> list[tuple[str, str]]:
    feat = "CAST(d AS DOUBLE) / 100.0::DOUBLE" if unit == "fraction" else "CAST(d AS DOUBLE)"
    steps = ", ".join(f"({s})" for s in SIM_STEPS)
    return [
        ("srows", "SELECT row_number() OVER () AS rid, * FROM test"),
        ("sim", f"""
            SELECT rid, offer_id, product_cluster_shp, discount_shp, d, p,
                   (1.0::DOUBLE - CAST(d AS DOUBLE) / 100.0::DOUBLE) * p * published_revenue_shp AS rev
            FROM (SELECT s.*, t.d, {SCORER.sql_prob(feat)} AS p FROM srows s, (VALUES {steps}) t(d)) x"""),
        ("sim_opt", """
            SELECT s.rid, max(rev) AS rev_opt, min(CASE WHEN rev = m.mx THEN d END) AS d_opt
            FROM sim s JOIN (SELECT rid, max(rev) AS mx FROM sim GROUP BY rid) m ON s.rid = m.rid
            GROUP BY s.rid"""),
    ]


@register("simulate_optimum", with_modelling(*_sim_sql_ctes()) + f"""
    SELECT s.offer_id, s.product_cluster_shp, s.discount_shp, {rsql('o.rev_opt', 4)} AS converted_revenue_optimized,
           'converted_revenue_' || lpad(CAST(o.d_opt AS VARCHAR), 3, '0') AS converted_revenue_optimized_col
    FROM srows s JOIN sim_opt o ON s.rid = o.rid""")
def q_simulate_optimum(spark, sf_dir):
    """R3 + R4 + R2: ladder 0..90 % in steps of 10 on the discount feature,
    converted revenue, row-wise maximum and the label of its column."""
    s = _sim(spark, sf_dir)
    return s.select("offer_id", "product_cluster_shp", "discount_shp",
                    rounded(F.col("converted_revenue_optimized"), 4).alias("converted_revenue_optimized"),
                    "converted_revenue_optimized_col")


@register("simulate_ladder_fraction", with_modelling(*_sim_sql_ctes("fraction")) + f"""
    SELECT offer_id, product_cluster_shp, d AS discount, {rsql('p')} AS pred_prob,
           {rsql('rev', 4)} AS converted_revenue,
           'pred_prob_' || lpad(CAST(d AS VARCHAR), 3, '0') AS label
    FROM sim""")
def q_simulate_ladder_fraction(spark, sf_dir):
    """R3 in the reference's unit (fraction fed into the discount feature),
    long form with the R2 labels."""
    s = _sim(spark, sf_dir, unit="fraction")
    z = s.select("offer_id", "product_cluster_shp",
                 F.explode(F.arrays_zip("sim_discount", "sim_prob", "sim_revenue")).alias("z"))
    return z.select("offer_id", "product_cluster_shp", F.col("z.sim_discount").alias("discount"),
                    rounded(F.col("z.sim_prob")).alias("pred_prob"),
                    rounded(F.col("z.sim_revenue"), 4).alias("converted_revenue"),
                    L.step_label("pred_prob_", F.col("z.sim_discount")).alias("label"))


@register("response_curve", with_modelling(*_sim_sql_ctes()) + f"""
    SELECT d AS discount, {rsql('avg(p)')} AS mean_prob, {rsql('avg(rev)', 4)} AS mean_revenue
    FROM sim GROUP BY d""")
def q_response_curve(spark, sf_dir):
    """A10: mean probability and converted revenue per ladder step."""
    c = L.response_curve(_sim(spark, sf_dir))
    return c.select("discount", rounded(F.col("mean_prob")).alias("mean_prob"),
                    rounded(F.col("mean_revenue"), 4).alias("mean_revenue"))


# --- R8 / F6: curve samples -------------------------------------------------------

SAMPLE_N, SAMPLE_SEED = 200, 0


@register("ladder_samples", with_modelling(*eval_sql_ctes()) + f"""
    , smp AS (
        SELECT * FROM (
          SELECT e.*, row_number() OVER (PARTITION BY organization_id ORDER BY
                 {md5_unit_sql(str(SAMPLE_SEED), 'offer_id', 'product_cluster_shp')}, offer_id, product_cluster_shp,
                 real_discount, pub_rev, rid) AS rn
          FROM rom_eval e) x WHERE rn <= {SAMPLE_N})
    SELECT s.organization_id, s.offer_id, s.product_cluster_shp, CAST(l.d AS INTEGER) AS discount,
           {rsql('l.p')} AS prob, {rsql('l.r')} AS exp_rev,
           s.rom_discount_6_low AS low, s.rom_discount_6_high AS high
    FROM smp s JOIN lad l ON s.rid = l.rid""")
def q_ladder_samples(spark, sf_dir):
    """F6 + R8: at most 200 test lines per organization (hash order shared by
    all configs), their full ladder and the gamma-6 interval."""
    t = test_rows(spark, sf_dir)
    feats = list(SCORER.coefs)
    e = L.recommendation_eval(t, SCORER, GAMMAS, keep=["offer_id", "product_cluster_shp",
                                                        "organization_id", *feats])
    s = prep.sample_per_group(e, "organization_id", SAMPLE_N, ["offer_id", "product_cluster_shp"],
                              seed=SAMPLE_SEED, tie_break=["real_discount", "pub_rev"])
    lad = L.ladder_long(s, SCORER, keep=["organization_id", "offer_id", "product_cluster_shp",
                                         "rom_discount_6_low", "rom_discount_6_high"])
    return lad.select("organization_id", "offer_id", "product_cluster_shp", "discount",
                      rounded(F.col("prob")).alias("prob"), rounded(F.col("exp_rev")).alias("exp_rev"),
                      F.col("rom_discount_6_low").alias("low"), F.col("rom_discount_6_high").alias("high"))


@register("stream_recommend", ORACLES["recommend"])
def q_stream_recommend(spark, sf_dir):
    """Streaming form of R5/R6: test lines arrive as files, every micro-batch
    is scored by the same recommendation operator, results go to an
    exactly-once file sink; the sink is read back."""
    from offerlens.sources import io
    from offerlens.streaming.scoring import start_file_scoring
    base = io.scratch_path(spark, "stream_recommend")
    t = test_rows(spark, sf_dir)
    t.write.mode("overwrite").parquet(f"{base}/source")
    schema = spark.read.parquet(f"{base}/source").schema

    def transform(df):
        r = L.recommend(df, SCORER, gamma=REC_GAMMA, cc_adjustment=REC_CC)
        return r.select("offer_id", "product_cluster_shp", "discount_shp", "discount_low",
                        "discount_high", "discount_opt", "discount_opt_wo_adj")
    q = start_file_scoring(spark, f"{base}/source", schema, f"{base}/sink", f"{base}/checkpoint", transform)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/sink")
