"""Registered queries: experiment evaluation over several configurations."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerlens.operators import evaluate as V
from offerlens.plans.master import rounded
from offerlens.plans.oracle_chain import rsql, with_modelling
from offerlens.plans.q_ladder import GAMMAS, SCORER, test_rows
from offerlens.plans.registry import ORACLES, register
from offerlens.session import stage

# Three model configurations (name, intercept, discount coefficient).
CONFIGS = [("cfg_a", -2.0, 0.045), ("cfg_b", -1.5, 0.03), ("cfg_c", -2.5, 0.06)]
BEST_GAMMA_CONFIG = "cfg_a"


def ev_table(spark, sf_dir):
    return V.rom_eval_configs(test_rows(spark, sf_dir), SCORER, CONFIGS, GAMMAS,
                              keep=["offer_id", "product_cluster_shp"])


def scored_table(spark, sf_dir):
    return V.scored_configs(test_rows(spark, sf_dir), SCORER, CONFIGS)


def _cfg_values() -> str:
    return ", ".join(f"('{n}', {b0!r}::DOUBLE, {bd!r}::DOUBLE)" for n, b0, bd in CONFIGS)


def _ev_ctes() -> list[tuple[str, str]]:
    p = SCORER.sql_prob("CAST(d AS DOUBLE)", "c.b0", "c.bd")
    gam, joins = [], []
    for g in GAMMAS:
        a = f"i{g}"
        gam += [f"CAST({a}.lo AS INTEGER) AS rom_discount_{g}_low",
                f"(CAST({a}.lo AS INTEGER) + CAST({a}.hi AS INTEGER)) / 2.0::DOUBLE AS rom_discount_{g}_mid",
                f"CAST({a}.hi AS INTEGER) AS rom_discount_{g}_high"]
        joins.append(
            f"JOIN (SELECT l.rid, l.config, min(d) AS lo, max(d) AS hi FROM ladc l JOIN ladc_max m "
            f"ON l.rid = m.rid AND l.config = m.config "
            f"WHERE r > (1.0::DOUBLE - {float(g)!r}::DOUBLE / 100.0::DOUBLE) * m.mx GROUP BY l.rid, l.config) {a} "
            f"ON r.rid = {a}.rid AND m.config = {a}.config")
    p_opt = SCORER.sql_prob("CAST(m.opt AS DOUBLE)", "c.b0", "c.bd")
    return [
        ("cfgs", f"SELECT * FROM (VALUES {_cfg_values()}) t(config, b0, bd)"),
        ("rows_", "SELECT row_number() OVER () AS rid, * FROM test"),
        ("ladc", f"""
            SELECT rid, config, d, p, (1.0::DOUBLE - CAST(d AS DOUBLE) / 100.0::DOUBLE) * p AS r
            FROM (SELECT rid, c.config, d, {p} AS p FROM rows_, cfgs c, range(0, 100) t(d)) x"""),
        ("ladc_max", """
            SELECT l.rid, l.config, max(r) AS mx, min(CASE WHEN r = m.mx0 THEN d END) AS opt
            FROM ladc l JOIN (SELECT rid, config, max(r) AS mx0 FROM ladc GROUP BY rid, config) m
              ON l.rid = m.rid AND l.config = m.config
            GROUP BY l.rid, l.config"""),
        ("ev", f"""
            SELECT m.config, offer_id, product_cluster_shp, discount_shp AS real_discount,
                   exp(log_published_revenue) AS pub_rev, accepted,
                   CAST(m.opt AS INTEGER) AS rom_discount, {p_opt} AS rom_pa, m.mx AS rom_exp_rev,
                   {', '.join(gam)},
                   (1.0::DOUBLE - discount_shp / 100.0::DOUBLE) * exp(log_published_revenue) * accepted AS real_rev,
                   m.opt - discount_shp AS rom_diff
            FROM rows_ r JOIN ladc_max m ON r.rid = m.rid JOIN cfgs c ON m.config = c.config
            {' '.join(joins)}"""),
        ("gl", " UNION ALL ".join(
            f"SELECT config, {g} AS gamma, rom_discount_{g}_low AS low, rom_discount_{g}_high AS high, "
            f"real_discount, real_rev, pub_rev, accepted, rom_exp_rev FROM ev" for g in GAMMAS)),
        ("scored_c", f"""
            SELECT c.config, accepted, {SCORER.sql_prob('discount_shp', 'c.b0', 'c.bd')} AS pred
            FROM test, cfgs c"""),
        ("rcr", """
            SELECT config, gamma, n_within, n, n_within * 100.0 / n AS within_pct,
                   rr / pr * 100 AS rcr, er / pr * 100 AS rcr_predicted, acc * 100 AS acc_rate,
                   rr_all / pr_all * 100 AS rcr_real, acc_all * 100 AS acc_rate_real
            FROM (SELECT config, gamma,
                    sum(CASE WHEN ins THEN real_rev END) AS rr, sum(CASE WHEN ins THEN pub_rev END) AS pr,
                    sum(CASE WHEN ins THEN rom_exp_rev END) AS er, CAST(sum(CAST(ins AS BIGINT)) AS BIGINT) AS n_within,
                    count(*) AS n, avg(CASE WHEN ins THEN CAST(accepted AS DOUBLE) END) AS acc,
                    sum(real_rev) AS rr_all, sum(pub_rev) AS pr_all, avg(CAST(accepted AS DOUBLE)) AS acc_all
                  FROM (SELECT *, real_discount >= low - 0.2 AND real_discount <= high + 0.2 AS ins FROM gl) x
                  GROUP BY config, gamma) t"""),
    ]


def with_ev(*extra) -> str:
    return with_modelling(*_ev_ctes(), *extra)


def _r(df, cols, d=6):
    return [rounded(F.col(c), d).alias(c) if c in cols else F.col(c) for c in df.columns]


@register("eval_score_histogram", with_ev() + """
    SELECT config, accepted, CAST(least(floor(pred * 20), 19) AS INTEGER) AS bin, count(*) AS n
    FROM scored_c GROUP BY 1, 2, 3""")
def q_eval_score_histogram(spark, sf_dir):
    """Distribution of predicted probabilities by class, per config."""
    return V.score_histogram(scored_table(spark, sf_dir), 20)


@register("interval_size_histogram", with_ev() + """
    SELECT config, gamma, high - low AS size, count(*) AS n FROM gl GROUP BY 1, 2, 3""")
def q_interval_size_histogram(spark, sf_dir):
    """Sizes of the recommended intervals per gamma and config."""
    return V.interval_size_histogram(ev_table(spark, sf_dir), GAMMAS)


@register("interval_size_stats", with_ev() + f"""
    SELECT config, gamma, {rsql('avg(high - low)')} AS mean_size,
           {rsql('quantile_cont(high - low, 0.97)')} AS q_size
    FROM gl GROUP BY 1, 2""")
def q_interval_size_stats(spark, sf_dir):
    """Mean and 97 % quantile of the interval size."""
    s = V.interval_size_stats(ev_table(spark, sf_dir), GAMMAS)
    return s.select(*_r(s, {"mean_size", "q_size"}))


@register("discount_checks", with_ev() + f"""
    SELECT config, n, real0, rom0, {rsql('real_median')} AS real_median, {rsql('rom_median')} AS rom_median,
           {rsql('real0 * 100.0 / n')} AS real0_pct, {rsql('rom0 * 100.0 / n')} AS rom0_pct,
           {rsql('med_diff')} AS med_diff, zero_warning,
           CASE WHEN zero_warning THEN 10.0::DOUBLE ELSE 0.0::DOUBLE END AS zero_score,
           {rsql('CASE WHEN med_diff > 9 THEN least((med_diff - 9) * (med_diff - 9), 50.0) ELSE 0.0 END')} AS median_score
    FROM (SELECT *, round_even(abs(real_median - rom_median), 0) AS med_diff,
                 rom0 > 2 * real0 AND rom0 * 100.0 / n > real0 * 100.0 / n + 1.2 AS zero_warning
          FROM (SELECT config, count(*) AS n, CAST(sum(CAST(real_discount < 3 AS BIGINT)) AS BIGINT) AS real0,
                       CAST(sum(CAST(rom_discount < 3 AS BIGINT)) AS BIGINT) AS rom0, median(real_discount) AS real_median,
                       median(CAST(rom_discount AS DOUBLE)) AS rom_median
                FROM ev GROUP BY config) a) b""")
def q_discount_checks(spark, sf_dir):
    """Near-zero discount shares, medians, warnings and scores."""
    d = V.discount_checks(ev_table(spark, sf_dir))
    d = d.select("config", "n", "real0", "rom0", "real_median", "rom_median", "real0_pct", "rom0_pct",
                 "med_diff", "zero_warning", "zero_score", "median_score")
    return d.select(*_r(d, {"real_median", "rom_median", "real0_pct", "rom0_pct", "med_diff", "median_score"}))


@register("diff_checks", with_ev() + f"""
    SELECT config, {rsql('med0')} AS med0, {rsql('med1')} AS med1, {rsql('q001')} AS q001, {rsql('q999')} AS q999,
           {rsql('large_diff_pct')} AS large_diff_pct, {rsql('greatest(abs(q001), abs(q999))')} AS lim,
           {rsql('''CASE WHEN nc + nc2 > 0 THEN
                  least(100.0, (CASE WHEN c0 THEN (abs(med0) - 4) * (abs(med0) - 4) ELSE 0.0 END
                              + CASE WHEN c1 THEN (abs(med1) - 4) * (abs(med1) - 4) ELSE 0.0 END) * nc)
                  + CASE WHEN nc2 > 0 THEN least(100.0, CASE WHEN c20 THEN (med0 - 19) * (med0 - 19) ELSE 0.0 END
                              + CASE WHEN c21 THEN (abs(med1) - 13) * (abs(med1) - 13) ELSE 0.0 END) ELSE 0.0 END
                ELSE 0.0 END''')} AS median_score,
           CASE WHEN large_diff_pct > 3 THEN 10.0::DOUBLE ELSE 0.0::DOUBLE END AS large_diff_score
    FROM (SELECT *, med0 < -5 AS c0, med1 > 5 AS c1, med0 > 19 AS c20, med1 < -13 AS c21,
                 CAST(med0 < -5 AS INTEGER) + CAST(med1 > 5 AS INTEGER) AS nc,
                 CAST(med0 > 19 AS INTEGER) + CAST(med1 < -13 AS INTEGER) AS nc2
          FROM (SELECT config, median(rom_diff) FILTER (WHERE accepted = 0) AS med0,
                       median(rom_diff) FILTER (WHERE accepted = 1) AS med1,
                       quantile_cont(rom_diff, 0.001) AS q001, quantile_cont(rom_diff, 0.999) AS q999,
                       sum(CAST(rom_diff < -40 AS BIGINT)) * 100.0 / count(*) AS large_diff_pct
                FROM ev GROUP BY config) a) b""")
def q_diff_checks(spark, sf_dir):
    """Recommended - real discount by outcome; limits and scores."""
    d = V.diff_checks(ev_table(spark, sf_dir))
    d = d.select("config", "med0", "med1", "q001", "q999", "large_diff_pct", "lim", "median_score",
                 "large_diff_score")
    return d.select(*_r(d, {"med0", "med1", "q001", "q999", "large_diff_pct", "lim", "median_score"}))


_RCR_COLS = ["within_pct", "rcr", "rcr_predicted", "acc_rate", "rcr_real", "acc_rate_real"]


@register("rcr_by_gamma", with_ev() + "SELECT config, gamma, n_within, n, " + ", ".join(
    f"{rsql(c)} AS {c}" for c in _RCR_COLS) + " FROM rcr")
def q_rcr_by_gamma(spark, sf_dir):
    """E15 + E16: RCR within the recommended interval per gamma and config."""
    r = V.rcr_by_gamma(ev_table(spark, sf_dir), GAMMAS)
    return r.select(*_r(r, set(_RCR_COLS)))


@register("eps_rcr", with_ev() + f"""
    SELECT config, eps, {rsql('rcr / rcr0 * 100 - 100')} AS rcr_increase, {rsql('rcr')} AS rcr,
           {rsql('arcr')} AS arcr, {rsql('acc_rate')} AS acc_rate, counts
    FROM (SELECT config, eps,
                 sum(CASE WHEN cl THEN real_rev END) / sum(CASE WHEN cl THEN pub_rev END) * 100 AS rcr,
                 avg(CASE WHEN cl THEN real_rev / pub_rev END) * 100 AS arcr,
                 avg(CASE WHEN cl THEN CAST(accepted AS DOUBLE) END) AS acc_rate,
                 CAST(sum(CAST(cl AS BIGINT)) AS BIGINT) AS counts, sum(real_rev) / sum(pub_rev) * 100 AS rcr0
          FROM (SELECT ev.*, e.eps, abs(rom_diff) < e.eps + 0.2 AS cl
                FROM ev, (VALUES {', '.join(f'({float(e)!r}::DOUBLE)' for e in V.EPSILONS)}) e(eps)) x
          GROUP BY config, eps) t""")
def q_eps_rcr(spark, sf_dir):
    """Epsilon-RCR table."""
    r = V.eps_rcr(ev_table(spark, sf_dir))
    return r.select(*_r(r, {"rcr_increase", "rcr", "arcr", "acc_rate"}))


def _within_score_sql(x: str) -> str:
    return " ".join(f"- power({float(t)!r} - least({float(t)!r}, {x}), {p!r})" for t, p in V.WITHIN_SCORE_THRESHOLDS)


@register("best_config", with_ev() + f"""
    SELECT config, {rsql('rcr_mean')} AS rcr_mean, n, {rsql('rcr_real')} AS rcr_real,
           {rsql('rcr_score')} AS rcr_score, {rsql('within')} AS within, {rsql('within_score')} AS within_score,
           {rsql('rcr_score + within_score')} AS score,
           config = arg_max(config, (rcr_score + within_score, config)) OVER () AS is_best
    FROM (SELECT *, (rcr_mean - rcr_real) / (max(rcr_mean) OVER () - rcr_real) * 100 AS rcr_score,
                 0.0 {_within_score_sql('within')} AS within_score
          FROM (SELECT config, avg(rcr) AS rcr_mean, first(n) AS n, first(rcr_real) AS rcr_real,
                       avg(n_within) / first(n) * 100 AS within
                FROM rcr GROUP BY config) a) b""")
def q_best_config(spark, sf_dir):
    """Score of each config and the best one."""
    b = V.best_config(V.rcr_by_gamma(ev_table(spark, sf_dir), GAMMAS))
    b = b.select("config", "rcr_mean", "n", "rcr_real", "rcr_score", "within", "within_score", "score", "is_best")
    return b.select(*_r(b, {"rcr_mean", "rcr_real", "rcr_score", "within", "within_score", "score"}))


@register("best_gamma", with_ev() + f"""
    SELECT config, gamma, {rsql('rcr_score')} AS rcr_score, {rsql('within_score')} AS within_score,
           {rsql('rcr_score + within_score')} AS score,
           gamma = arg_max(gamma, (rcr_score + within_score, -gamma)) OVER () AS is_best
    FROM (SELECT config, gamma, (rcr - rcr_real) / (max(rcr) OVER () - rcr_real) * 100 AS rcr_score,
                 0.0 {_within_score_sql('n_within * 100.0 / n')} AS within_score
          FROM rcr WHERE config = '{BEST_GAMMA_CONFIG}') t""")
def q_best_gamma(spark, sf_dir):
    """Best gamma for the given config."""
    b = V.best_gamma(V.rcr_by_gamma(ev_table(spark, sf_dir), GAMMAS), BEST_GAMMA_CONFIG)
    return b.select(*_r(b, {"rcr_score", "within_score", "score"}))


@register("logloss_rcr_corr", with_ev() + f"""
    SELECT {rsql('corr(logloss, r)')} AS corr, {rsql('regr_slope(r, logloss)')} AS slope,
           {rsql('regr_intercept(r, logloss)')} AS intercept, count(*) AS n_configs
    FROM (SELECT s.config, s.logloss, r.r FROM
            (SELECT config, avg(-(accepted * ln(least(greatest(pred, 1e-15), 1 - 1e-15))
                    + (1 - accepted) * ln(1 - least(greatest(pred, 1e-15), 1 - 1e-15)))) AS logloss
             FROM scored_c GROUP BY config) s
          JOIN (SELECT config, avg(rcr) AS r FROM rcr GROUP BY config) r ON s.config = r.config) t""")
def q_logloss_rcr_corr(spark, sf_dir):
    """Correlation of log-loss and RCR over configs."""
    c = V.logloss_rcr_correlation(scored_table(spark, sf_dir), V.rcr_by_gamma(ev_table(spark, sf_dir), GAMMAS))
    return c.select(*_r(c, {"corr", "slope", "intercept"}))


@register("auc_per_config", with_ev() + f"""
    SELECT config, {rsql('CASE WHEN P > 0 AND N > 0 THEN s / (P * N) END')} AS auc FROM (
      SELECT config, sum(pos * (cum_neg - neg + 0.5 * neg)) AS s, first(P) AS P, first(N) AS N FROM (
        SELECT *, sum(neg) OVER (PARTITION BY config ORDER BY score ROWS UNBOUNDED PRECEDING) AS cum_neg,
               sum(pos) OVER (PARTITION BY config) AS P, sum(neg) OVER (PARTITION BY config) AS N
        FROM (SELECT config, pred AS score, sum(accepted) AS pos, sum(1 - accepted) AS neg
              FROM scored_c GROUP BY config, pred) g) c
      GROUP BY config) t""")
def q_auc_per_config(spark, sf_dir):
    """E1 AUC per configuration (input of the E20 AUC alert)."""
    a = V.auc_per_config(scored_table(spark, sf_dir))
    return a.select("config", rounded(F.col("auc")).alias("auc"))


def _warnings_sql() -> str:
    """Rows (config, warning, score), from the SQL of the single checks."""
    def of(name: str) -> str:  # the check's own SELECT behind the shared CTEs
        return ORACLES[name][len(with_ev()):]

    return f"""
      SELECT config, 'rcr_below_real' AS warning, 50.0::DOUBLE AS score FROM rcr GROUP BY config HAVING avg(rcr) < first(rcr_real)
      UNION ALL SELECT config, 'subset_below_10pct', 30.0 FROM rcr WHERE gamma = {GAMMAS[1]} AND within_pct < 10
      UNION ALL SELECT config, 'auc_below_0.55', 1.0 FROM ({of('auc_per_config')}) a WHERE auc < {V.AUC_WARN_THRESHOLD}
      UNION ALL SELECT config, 'zero_discounts', zero_score FROM ({of('discount_checks')}) d WHERE zero_warning
      UNION ALL SELECT config, 'median_discounts_differ', median_score FROM ({of('discount_checks')}) d WHERE median_score > 0
      UNION ALL SELECT config, 'unexpected_diff_median', median_score FROM ({of('diff_checks')}) d WHERE median_score > 0
      UNION ALL SELECT config, 'large_negative_diff', large_diff_score FROM ({of('diff_checks')}) d WHERE large_diff_score > 0"""


def _warnings(spark, sf_dir):
    ev = stage(ev_table(spark, sf_dir), "evaluation")
    rcr = V.rcr_by_gamma(ev, GAMMAS)
    return V.warnings_table(rcr, V.auc_per_config(scored_table(spark, sf_dir)), V.discount_checks(ev),
                            V.diff_checks(ev), GAMMAS[1], len(CONFIGS))


@register("eval_warnings", with_ev() + f"""
    SELECT config, warning, {rsql('score')} AS score, {rsql(f'score / {len(CONFIGS)}')} AS contribution FROM ({_warnings_sql()}) w""")
def q_eval_warnings(spark, sf_dir):
    """Warning table (config, warning, score, contribution) from the
    RCR, coverage, AUC, discount and difference checks."""
    out = _warnings(spark, sf_dir)
    return out.select("config", "warning", rounded(F.col("score")).alias("score"),
                      rounded(F.col("contribution")).alias("contribution"))


@register("eval_warning_score", with_ev() + f""", w AS ({_warnings_sql()})
    SELECT config, {rsql('sum(score)')} AS score, {rsql(f'sum(score) / {len(CONFIGS)}')} AS contribution, count(*) AS n_warnings
    FROM w GROUP BY config UNION ALL
    SELECT 'total', {rsql('coalesce(sum(score), 0)')}, {rsql(f'coalesce(sum(score), 0) / {len(CONFIGS)}')}, count(*) FROM w""")
def q_eval_warning_score(spark, sf_dir):
    """Score per config and in all."""
    t = V.total_warning_score(_warnings(spark, sf_dir))
    return t.select("config", *[rounded(F.col(c)).alias(c) for c in ("score", "contribution")], "n_warnings")
