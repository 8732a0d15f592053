"""Experiment evaluation over several model configurations (E11-E21,
S10-S11 listing helpers, A11-A16 building blocks).

The evaluation table holds one row per (config, test line) -- configs are
exploded per row from a literal array, so scoring several configurations
is one narrow pass, not a join.  Every check is a ``groupBy(config, ...)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerlens.functions.exprs import pearson
from offerlens.functions.running import exact_quantiles, running_sums
from offerlens.operators import ladder as L
from offerlens.session import stage

# Fixed values of the reference's evaluation notebook.
EPSILONS = [0.2, 0.5, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 14, 16]
WITHIN_TOLERANCE = 0.2
# Warning and penalty thresholds and scores of the same notebook.
ZERO_DISCOUNT_BELOW = 3
MEDIAN_DIFF_THRESHOLD = 9
LARGE_DIFF_THRESHOLD = 40
AUC_WARN_THRESHOLD = 0.55
WITHIN_SCORE_THRESHOLDS = ((27, 1.2), (12, 1.7), (40, 0.8))


def configs_array(configs: Sequence[tuple[str, float, float]]) -> Column:
    """Literal array of (config, intercept, discount_coef) structs."""
    return F.array(*[F.struct(F.lit(n).alias("config"), F.lit(float(b0)).alias("b0"),
                              F.lit(float(bd)).alias("bd")) for n, b0, bd in configs])


def rom_eval_configs(df: DataFrame, scorer: L.LogisticScorer,
                     configs: Sequence[tuple[str, float, float]],
                     gammas: Sequence[int] = L.DEFAULT_GAMMAS,
                     keep: Sequence[str] = ()) -> DataFrame:
    """R7 for every configuration: explode the config array per row, then
    score with the row's config coefficients."""
    x = df.withColumn("__cfg", F.explode(configs_array(configs)))
    x = x.withColumn("config", F.col("__cfg.config"))
    ev = L.recommendation_eval(x, scorer, gammas, keep=["config", *keep],
                               intercept=F.col("__cfg.b0"), discount_coef=F.col("__cfg.bd"))
    return ev


def rom_eval_models(df: DataFrame, models: Mapping[str, L.Scorer], gammas: Sequence[int] = L.DEFAULT_GAMMAS,
                    keep: Sequence[str] = (), monotone: bool = False) -> DataFrame:
    """R7 with several scorers, fitted models among them, one config each."""
    parts = [L.recommendation_eval(df.withColumn("config", F.lit(n)), s, gammas, keep=["config", *keep], monotone=monotone)
             for n, s in models.items()]
    return reduce(DataFrame.unionByName, parts)


def scored_models(df: DataFrame, models: Mapping[str, L.Scorer], keep: Sequence[str] = ()) -> DataFrame:
    """Classification table per scorer: probability at the real discount."""
    parts = [s.score(df, "pred").select(F.lit(n).alias("config"), *keep, "accepted", "pred") for n, s in models.items()]
    return reduce(DataFrame.unionByName, parts)


def scored_configs(df: DataFrame, scorer: L.LogisticScorer,
                   configs: Sequence[tuple[str, float, float]], keep: Sequence[str] = ()) -> DataFrame:
    """Classification table per config: probability at the real discount."""
    x = df.withColumn("__cfg", F.explode(configs_array(configs)))
    p = scorer.prob(F.col("discount_shp"), F.col("__cfg.b0"), F.col("__cfg.bd"))
    return x.select(F.col("__cfg.config").alias("config"), *keep, "accepted", p.alias("pred"))


def gamma_long(ev: DataFrame, gammas: Sequence[int], keep: Sequence[str]) -> DataFrame:
    """Unpivot the per-gamma low/mid/high columns (narrow explode)."""
    arr = F.array(*[F.struct(F.lit(g).alias("gamma"), F.col(f"rom_discount_{g}_low").alias("low"),
                             F.col(f"rom_discount_{g}_mid").alias("mid"),
                             F.col(f"rom_discount_{g}_high").alias("high")) for g in gammas])
    return ev.select(*keep, F.explode(arr).alias("__g")).select(
        *keep, "__g.gamma", "__g.low", "__g.mid", "__g.high")


def score_histogram(scored: DataFrame, n_bins: int = 20, p: str = "pred") -> DataFrame:
    """Score histogram by class and config (equal widths on [0, 1])."""
    b = F.least(F.floor(F.col(p) * F.lit(n_bins)), F.lit(n_bins - 1)).cast("int")
    return scored.groupBy("config", "accepted", b.alias("bin")).agg(F.count("*").alias("n"))


def interval_size_histogram(ev: DataFrame, gammas: Sequence[int]) -> DataFrame:
    """Sizes ``high - low`` of the recommended intervals."""
    g = gamma_long(ev, gammas, ["config"])
    return g.groupBy("config", "gamma", (F.col("high") - F.col("low")).alias("size")).agg(
        F.count("*").alias("n"))


def interval_size_stats(ev: DataFrame, gammas: Sequence[int], q: float = 0.97) -> DataFrame:
    """Mean and upper quantile of the interval size per (config, gamma)."""
    g = gamma_long(ev, gammas, ["config"]).groupBy("config", "gamma", (F.col("high") - F.col("low")).alias("size")).agg(F.count("*").alias("__k"))
    g = stage(g, "interval_sizes")  # at most steps x gammas x configs rows
    mean = g.groupBy("config", "gamma").agg((F.sum(F.col("size") * F.col("__k")) / F.sum(F.when(F.col("size").isNotNull(), F.col("__k")))).alias("mean_size"))
    qs = exact_quantiles(g, ["config", "gamma"], "size", [q], count_col="__k")
    return mean.join(qs, ["config", "gamma"], "left").select("config", "gamma", "mean_size", F.col("quantiles")[0].alias("q_size"))


def _sq(x: Column) -> Column:
    return x * x


def _medians(ev: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Exact median of each value per config, one row per config."""
    long = ev.select("config", F.explode(F.array(*[F.struct(F.lit(k).alias("name"), v.cast("double").alias("value"))
                                                  for k, v in values.items()])).alias("__m")).select("config", "__m.name", "__m.value")
    m = exact_quantiles(long, ["config", "name"], "value", [0.5])
    return m.groupBy("config").agg(*[F.max(F.when(F.col("name") == k, F.col("quantiles")[0])).alias(k) for k in values])


def discount_checks(ev: DataFrame) -> DataFrame:
    """Share of near-zero discounts (real vs recommended), medians,
    warnings and scores."""
    ev = stage(ev.select("config", "real_discount", "rom_discount"), "discounts")
    g = ev.groupBy("config").agg(
        F.count("*").alias("n"),
        F.sum((F.col("real_discount") < ZERO_DISCOUNT_BELOW).cast("long")).alias("real0"),
        F.sum((F.col("rom_discount") < ZERO_DISCOUNT_BELOW).cast("long")).alias("rom0"))
    g = g.join(_medians(ev, {"real_median": F.col("real_discount"), "rom_median": F.col("rom_discount")}), "config", "left")
    g = g.withColumns({"real0_pct": F.col("real0") / F.col("n") * 100,
                       "rom0_pct": F.col("rom0") / F.col("n") * 100,
                       "med_diff": F.bround(F.abs(F.col("real_median") - F.col("rom_median")), 0)})
    zero = (F.col("rom0") > 2 * F.col("real0")) & (F.col("rom0_pct") > F.col("real0_pct") + 1.2)
    return g.withColumns({
        "zero_warning": zero,
        "zero_score": F.when(zero, F.lit(10.0)).otherwise(F.lit(0.0)),
        "median_score": F.when(F.col("med_diff") > MEDIAN_DIFF_THRESHOLD,
                               F.least(_sq(F.col("med_diff") - MEDIAN_DIFF_THRESHOLD), F.lit(50.0))
                               ).otherwise(F.lit(0.0)),
    })


def diff_checks(ev: DataFrame) -> DataFrame:
    """Recommended - real discount by outcome: medians per class,
    0.1 % / 99.9 % limits, share of large negative differences, scores."""
    d = F.col("rom_diff")
    ev = stage(ev.select("config", "accepted", "rom_diff"), "differences")
    g = ev.groupBy("config").agg((F.sum((d < -LARGE_DIFF_THRESHOLD).cast("long")) / F.count("*") * 100).alias("large_diff_pct"))
    q = exact_quantiles(ev, ["config"], "rom_diff", [0.001, 0.999])
    g = (g.join(_medians(ev, {"med0": F.when(F.col("accepted") == 0, d), "med1": F.when(F.col("accepted") == 1, d)}), "config", "left")
         .join(q.select("config", F.col("quantiles")[0].alias("q001"), F.col("quantiles")[1].alias("q999")), "config", "left"))
    m0, m1 = F.col("med0"), F.col("med1")
    c0, c1 = (m0 < -5), (m1 > 5)
    c20, c21 = (m0 > 19), (m1 < -13)
    n_c = c0.cast("int") + c1.cast("int")
    n_c2 = c20.cast("int") + c21.cast("int")
    s1 = F.least(F.lit(100.0), (F.when(c0, _sq(F.abs(m0) - 4)).otherwise(0.0)
                                + F.when(c1, _sq(F.abs(m1) - 4)).otherwise(0.0)) * n_c)
    s2 = F.least(F.lit(100.0), F.when(c20, _sq(m0 - 19)).otherwise(0.0)
                 + F.when(c21, _sq(F.abs(m1) - 13)).otherwise(0.0))
    return g.withColumns({
        "lim": F.greatest(F.abs("q001"), F.abs("q999")),
        "median_score": F.when((n_c + n_c2) > 0, s1 + F.when(n_c2 > 0, s2).otherwise(0.0)).otherwise(0.0),
        "large_diff_score": F.when(F.col("large_diff_pct") > 3, F.lit(10.0)).otherwise(F.lit(0.0)),
    })


def rcr_by_gamma(ev: DataFrame, gammas: Sequence[int], tol: float = WITHIN_TOLERANCE) -> DataFrame:
    """E15 + E16: revenue conversion ratio of the lines whose real discount
    lies inside ``[low - tol, high + tol]``, its predicted variant, count,
    share and acceptance; the overall ("Real") values per config."""
    g = gamma_long(ev, gammas, ["config", "real_discount", "real_rev", "pub_rev", "accepted", "rom_exp_rev"])
    inside = (F.col("real_discount") >= F.col("low") - tol) & (F.col("real_discount") <= F.col("high") + tol)
    w = F.when(inside, F.lit(1.0))
    r = g.groupBy("config", "gamma").agg(
        F.sum(F.col("real_rev") * w).alias("__rr"), F.sum(F.col("pub_rev") * w).alias("__pr"),
        F.sum(F.col("rom_exp_rev") * w).alias("__er"),
        F.sum(inside.cast("long")).alias("n_within"), F.count("*").alias("n"),
        F.avg(F.when(inside, F.col("accepted").cast("double"))).alias("__acc"),
        F.sum("real_rev").alias("__rr_all"), F.sum("pub_rev").alias("__pr_all"),
        F.avg(F.col("accepted").cast("double")).alias("__acc_all"))
    return r.select(
        "config", "gamma", "n_within", "n",
        (F.col("n_within") / F.col("n") * 100).alias("within_pct"),
        (F.col("__rr") / F.col("__pr") * 100).alias("rcr"),
        (F.col("__er") / F.col("__pr") * 100).alias("rcr_predicted"),
        (F.col("__acc") * 100).alias("acc_rate"),
        (F.col("__rr_all") / F.col("__pr_all") * 100).alias("rcr_real"),
        (F.col("__acc_all") * 100).alias("acc_rate_real"))


def eps_rcr(ev: DataFrame, epsilons: Sequence[float] = EPSILONS, tol: float = WITHIN_TOLERANCE) -> DataFrame:
    """For each epsilon the lines with ``|rom_diff| < eps + tol``: RCR,
    average per-line RCR, acceptance, count and increase over the overall
    RCR.  The epsilon list is exploded per row (narrow) instead of a range
    join."""
    eps = F.array(*[F.lit(float(e)) for e in epsilons])
    x = ev.select("config", "rom_diff", "real_rev", "pub_rev", "accepted", F.explode(eps).alias("eps"))
    close = F.abs(F.col("rom_diff")) < F.col("eps") + tol
    r = x.groupBy("config", "eps").agg(
        F.sum(F.when(close, F.col("real_rev"))).alias("__rr"),
        F.sum(F.when(close, F.col("pub_rev"))).alias("__pr"),
        F.avg(F.when(close, F.try_divide("real_rev", "pub_rev"))).alias("__arcr"),
        F.avg(F.when(close, F.col("accepted").cast("double"))).alias("acc_rate"),
        F.sum(close.cast("long")).alias("counts"),
        F.sum("real_rev").alias("__rr0"), F.sum("pub_rev").alias("__pr0"))
    r = r.withColumns({"rcr": F.try_divide("__rr", "__pr") * 100, "arcr": F.col("__arcr") * 100,
                       "__rcr0": F.try_divide("__rr0", "__pr0") * 100})
    return r.select("config", "eps", (F.try_divide("rcr", "__rcr0") * 100 - 100).alias("rcr_increase"),
                    "rcr", "arcr", "acc_rate", "counts")


def within_score(within: Column) -> Column:
    """Coverage penalty: three power terms below thresholds."""
    s = F.lit(0.0)
    for thr, pw in WITHIN_SCORE_THRESHOLDS:
        s = s - F.pow(F.lit(float(thr)) - F.least(F.lit(float(thr)), within), F.lit(pw))
    return s


def _scaled(value: str, best: str) -> Column:
    """Gain over the real RCR as a percentage of the best gain; undefined
    (NULL) if the best equals the real one."""
    return F.try_divide(F.col(value) - F.col("rcr_real"), F.col(best) - F.col("rcr_real")) * 100


def best_config(rcr: DataFrame) -> DataFrame:
    """RCR scaled between the real RCR and the best config's mean RCR,
    plus the coverage penalty; the best config is flagged."""
    per = rcr.groupBy("config").agg(F.avg("rcr").alias("rcr_mean"), F.avg("n_within").alias("within_n"),
                                    F.first("n").alias("n"), F.first("rcr_real").alias("rcr_real"))
    w = Window.partitionBy()  # config table: one row per config
    per = per.withColumn("rcr_max", F.max("rcr_mean").over(w))
    per = per.withColumns({
        "rcr_score": _scaled("rcr_mean", "rcr_max"),
        "within": F.col("within_n") / F.col("n") * 100})
    per = per.withColumn("within_score", within_score(F.col("within")))
    per = per.withColumn("score", F.col("rcr_score") + F.col("within_score"))
    best = F.max_by("config", F.struct("score", F.col("config"))).over(w)
    return per.withColumn("is_best", F.col("config") == best).drop("rcr_max", "within_n")


def best_gamma(rcr: DataFrame, config: str) -> DataFrame:
    """The same score over the gammas of one config (the argument)."""
    r = rcr.filter(F.col("config") == config)
    w = Window.partitionBy()
    r = r.withColumn("__max", F.max("rcr").over(w))
    r = r.withColumns({"rcr_score": _scaled("rcr", "__max"),
                       "within": F.col("n_within") / F.col("n") * 100})
    r = r.withColumn("within_score", within_score(F.col("within")))
    r = r.withColumn("score", F.col("rcr_score") + F.col("within_score"))
    best = F.max_by("gamma", F.struct("score", -F.col("gamma"))).over(w)
    return r.select("config", "gamma", "rcr_score", "within_score", "score",
                    (F.col("gamma") == best).alias("is_best"))


def warnings_table(rcr: DataFrame, auc: DataFrame, disc: DataFrame, diff: DataFrame,
                   second_gamma: int, n_configs: int) -> DataFrame:
    """One row per raised warning ``(config, warning, score)`` and the
    contribution to the total score (score / number of configs)."""
    per = rcr.groupBy("config").agg(F.avg("rcr").alias("rcr_mean"), F.first("rcr_real").alias("rcr_real"))
    w1 = per.filter(F.col("rcr_mean") < F.col("rcr_real")).select(
        "config", F.lit("rcr_below_real").alias("warning"), F.lit(50.0).alias("score"))
    w2 = rcr.filter((F.col("gamma") == second_gamma) & (F.col("within_pct") < 10)).select(
        "config", F.lit("subset_below_10pct").alias("warning"), F.lit(30.0).alias("score"))
    w3 = auc.filter(F.col("auc") < AUC_WARN_THRESHOLD).select(
        "config", F.lit("auc_below_0.55").alias("warning"), F.lit(1.0).alias("score"))
    w4 = disc.filter(F.col("zero_warning")).select("config", F.lit("zero_discounts").alias("warning"),
                                                   F.col("zero_score").alias("score"))
    w5 = disc.filter(F.col("median_score") > 0).select("config", F.lit("median_discounts_differ").alias("warning"),
                                                       F.col("median_score").alias("score"))
    w6 = diff.filter(F.col("median_score") > 0).select("config", F.lit("unexpected_diff_median").alias("warning"),
                                                       F.col("median_score").alias("score"))
    w7 = diff.filter(F.col("large_diff_score") > 0).select("config", F.lit("large_negative_diff").alias("warning"),
                                                           F.col("large_diff_score").alias("score"))
    out = w1.unionByName(w2).unionByName(w3).unionByName(w4).unionByName(w5).unionByName(w6).unionByName(w7)
    return out.withColumn("contribution", F.col("score") / F.lit(float(n_configs)))


def total_warning_score(warnings: DataFrame) -> DataFrame:
    """The score of each config and the total, in which a warning counts
    by the share of configs that raise it."""
    per = warnings.groupBy("config").agg(F.sum("score").alias("score"), F.sum("contribution").alias("contribution"), F.count("*").alias("n_warnings"))
    total = warnings.agg(F.lit("total").alias("config"), F.coalesce(F.sum("score"), F.lit(0.0)).alias("score"),
                         F.coalesce(F.sum("contribution"), F.lit(0.0)).alias("contribution"), F.count("*").alias("n_warnings"))
    return per.unionByName(total)


def auc_per_config(scored: DataFrame) -> DataFrame:
    """AUC per config from grouped scores (mid-rank), via running sums."""
    g = scored.groupBy("config", F.col("pred").alias("score")).agg(
        F.sum(F.col("accepted").cast("long")).alias("pos"),
        F.sum((F.lit(1) - F.col("accepted")).cast("long")).alias("neg"))
    g = running_sums(g, "score", ["neg"], ["config"])  # inclusive ascending
    term = F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.lit(0.5) * F.col("neg"))
    pos, neg = F.sum("pos"), F.sum("neg")
    return g.groupBy("config").agg(F.when((pos > 0) & (neg > 0), F.sum(term) / (pos.cast("double") * neg)).alias("auc"))


def logloss_rcr_correlation(scored: DataFrame, rcr: DataFrame, eps: float = 1e-15) -> DataFrame:
    """Correlation, slope and intercept of RCR on log-loss over configs."""
    p = F.least(F.greatest(F.col("pred"), F.lit(eps)), F.lit(1 - eps))
    y = F.col("accepted").cast("double")
    ll = scored.groupBy("config").agg(F.avg(-(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("logloss"))
    r = rcr.groupBy("config").agg(F.avg("rcr").alias("rcr"))
    j = ll.join(r, "config")
    return j.agg(pearson("logloss", "rcr").alias("corr"),
                 F.regr_slope("rcr", "logloss").alias("slope"),
                 F.regr_intercept("rcr", "logloss").alias("intercept"),
                 F.count("*").alias("n_configs"))
