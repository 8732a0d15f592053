"""Registered queries: exploratory statistics, folds and samples on the
master table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.operators import eda as D
from offerlens.operators import prep
from offerlens.operators import folds as FO
from offerlens.plans import master as M
from offerlens.plans.master import rounded
from offerlens.plans.oracle_chain import md5_unit_sql, rsql, with_features, with_modelling
from offerlens.plans.registry import register
from offerlens.session import stage

NUM = ["discount_shp", "log_published_revenue", "log_potential_revenue", "log_shipments",
       "log_weight", "prod_mix_tdexport", "ecomm"]
CAT = ["product_cluster_shp", "loyalty_code_cust", "industry", "competitor_oppo", "final_outcome"]
MISSING_COLS = M.MASTER_COLUMNS + ["accepted"]


def targeted(spark, sf_dir):
    return prep.fix_target(M.master_table(spark, sf_dir, with_ids=True), "final_outcome", "accepted")


def _r(df, cols, d=6):
    return df.select(*[rounded(F.col(c), d).alias(c) if c in cols else F.col(c) for c in df.columns])


def _union(parts):
    return " UNION ALL ".join(parts)


@register("eda_numeric_summary", with_modelling() + _union(
    f"""SELECT '{c}' AS "column", count(v) AS count, {rsql('avg(v)')} AS mean, {rsql('stddev_samp(v)')} AS std,
               {rsql('min(v)')} AS min, {rsql('quantile_cont(v, 0.25)')} AS p25, {rsql('quantile_cont(v, 0.5)')} AS p50,
               {rsql('quantile_cont(v, 0.75)')} AS p75, {rsql('max(v)')} AS max
        FROM (SELECT CAST({c} AS DOUBLE) AS v FROM targeted) t WHERE v IS NOT NULL AND NOT isnan(v)"""
    for c in NUM))
def q_eda_numeric_summary(spark, sf_dir):
    """D1 numeric: count, mean, std, min, quartiles, max for all columns in one pass."""
    return _r(D.numeric_summary(targeted(spark, sf_dir), NUM), {"mean", "std", "min", "p25", "p50", "p75", "max"})


@register("eda_categorical_summary", with_modelling() + _union(
    f"""SELECT '{c}' AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
               arg_min(value, (-n, value)) AS top, max(n) AS freq
        FROM (SELECT CAST({c} AS VARCHAR) AS value, count(*) AS n FROM targeted WHERE {c} IS NOT NULL GROUP BY 1) t"""
    for c in CAT))
def q_eda_categorical_summary(spark, sf_dir):
    """D1 categorical: count, unique, top, freq."""
    return D.categorical_summary(targeted(spark, sf_dir), CAT)


@register("eda_missing_values", with_modelling() + "SELECT * FROM (" + _union(
    f"""SELECT '{c}' AS "column", CAST(count(*) - count({c}) AS BIGINT) AS n_missing FROM targeted"""
    for c in MISSING_COLS) + ") t WHERE n_missing > 0")
def q_eda_missing_values(spark, sf_dir):
    """Missing values per column (only columns with any)."""
    t = targeted(spark, sf_dir).select(*MISSING_COLS)
    return D.missing_values(t)


@register("eda_histograms", with_modelling() + f"""
    SELECT "column", bin, count(*) AS n, {rsql('first(lo)')} AS lo, {rsql('first(hi)')} AS hi FROM (
      SELECT u."column", lo, hi, CAST(CASE WHEN hi = lo THEN 0
               ELSE least(floor((v - lo) / ((hi - lo) / 10.0)), 9) END AS INTEGER) AS bin
      FROM ({_union(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v FROM targeted" for c in NUM)}) u
      JOIN (SELECT "column", min(v) AS lo, max(v) AS hi FROM
            ({_union(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v FROM targeted" for c in NUM)}) x
            WHERE v IS NOT NULL GROUP BY 1) r ON u."column" = r."column"
      WHERE v IS NOT NULL) t GROUP BY 1, 2""")
def q_eda_histograms(spark, sf_dir):
    """D3: 10 equal-width bins per numeric column."""
    h = D.histograms(targeted(spark, sf_dir), NUM, 10)
    return _r(h, {"lo", "hi"})


@register("eda_frequencies", with_modelling() + f"""
    SELECT "column", value, n, {rsql('n * 1.0 / sum(n) OVER (PARTITION BY "column")')} AS share FROM (
      SELECT "column", value, count(*) AS n FROM
        ({_union(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM targeted" for c in CAT)}) u
      GROUP BY 1, 2) t""")
def q_eda_frequencies(spark, sf_dir):
    """Value counts with NULLs and normalized shares."""
    return _r(D.value_frequencies(targeted(spark, sf_dir), CAT), {"share"})


@register("eda_target_correlation", with_modelling() + _union(
    f"""SELECT '{c}' AS "column", {rsql(f'corr(CAST({c} AS DOUBLE), CAST(accepted AS DOUBLE))')} AS corr FROM targeted"""
    for c in NUM if c != "ecomm"))
def q_eda_target_correlation(spark, sf_dir):
    """Correlation of each numeric column with the (numeric) target."""
    return _r(D.numeric_target_correlations(targeted(spark, sf_dir), "accepted",
                                            [c for c in NUM if c != "ecomm"]), {"corr"})


def _simpson_sql(f: str, upper: str, n: int = 20000) -> str:
    """Integral of ``f(t)`` from 0 to ``upper`` by Simpson's rule."""
    return (f"(SELECT sum(CASE WHEN i IN (0, {n}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * ({f})) * ({upper}) / {3 * n} "
            f"FROM (SELECT i, ({upper}) * i / {n} AS t FROM range(0, {n + 1}) r(i)) g)")


def _f_survival_sql(f: str, d1: str, d2: str) -> str:
    """P(F > f) by numerical integration of the beta density over an angle."""
    a, b = f"(({d2}) / 2.0)", f"(({d1}) / 2.0)"
    pdf = (f"2 * exp((2 * {a} - 1) * ln(greatest(sin(t), 1e-300)) + (2 * {b} - 1) * ln(greatest(cos(t), 1e-300)) "
           f"+ lgamma({a} + {b}) - lgamma({a}) - lgamma({b}))")
    return _simpson_sql(pdf, f"asin(sqrt(({d2}) / (({d2}) + ({d1}) * {f})))")


def _chi2_survival_sql(x: str, k: str) -> str:
    pdf = f"2 * exp((({k}) - 1) * ln(greatest(t, 1e-300)) - t * t / 2 - (({k}) / 2.0) * ln(2) - lgamma(({k}) / 2.0))"
    return f"1 - {_simpson_sql(pdf, f'least(sqrt({x}), 60.0)')}"


def _anova_sql(src: str, cols, group: str, digits: int | None = 4) -> str:
    def rs(x):
        return rsql(x, digits) if digits is not None else x
    u = _union(f"SELECT '{c}' AS \"column\", {group} AS g, CAST({c} AS DOUBLE) AS v FROM {src}" for c in cols)
    return f"""
    SELECT "column", k, "N", {rs('ssb')} AS ss_between, {rs('ssw')} AS ss_within,
           {rs('CASE WHEN k > 1 THEN (ssb / (k - 1)) / (ssw / ("N" - k)) END')} AS f_stat,
           k - 1 AS df_between, "N" - k AS df_within,
           {rs(_f_survival_sql('(ssb / (k - 1)) / (ssw / ("N" - k))', 'k - 1', '"N" - k')) if digits is not None else 'NULL'} AS p_value
    FROM (SELECT "column", count(*) AS k, CAST(sum(n) AS BIGINT) AS "N",
                 sum(n * (m - gm) * (m - gm)) AS ssb, sum(coalesce(var_samp_g * (n - 1), 0)) AS ssw
          FROM (SELECT g1.*, sum(n * m) OVER (PARTITION BY "column") / sum(n) OVER (PARTITION BY "column") AS gm
                FROM (SELECT "column", g, count(*) AS n, avg(v) AS m, var_samp(v) AS var_samp_g
                      FROM ({u}) u WHERE v IS NOT NULL AND g IS NOT NULL GROUP BY 1, 2) g1) g2
          GROUP BY 1) t"""


@register("eda_anova", with_modelling() + _anova_sql("targeted", NUM, "accepted"))
def q_eda_anova(spark, sf_dir):
    """One-way ANOVA F of each numeric column by the target class."""
    a = D.anova(targeted(spark, sf_dir), NUM, "accepted")
    return _r(a, {"ss_between", "ss_within", "f_stat", "p_value"}, 4)


@register("eda_numeric_target", with_modelling() + _union(
    [f"""SELECT '{c}' AS "column", 'correlation' AS test, {rsql(f'corr(CAST({c} AS DOUBLE), discount_shp)', 4)} AS statistic,
                CAST(NULL AS DOUBLE) AS p_value FROM targeted""" for c in NUM if c not in ("discount_shp", "ecomm")]
    + [f"""SELECT '{c}' AS "column", 'anova' AS test, f_stat AS statistic, p_value FROM
           ({_anova_sql('targeted', ['discount_shp'], c)}) x""" for c in CAT]))
def q_eda_numeric_target(spark, sf_dir):
    """A numeric target (the discount): correlation with the numeric
    columns, ANOVA F and p-value across each categorical column."""
    t = targeted(spark, sf_dir)
    corr = D.numeric_target_correlations(t, "discount_shp", [c for c in NUM if c not in ("discount_shp", "ecomm")])
    anova = D.anova_by_category(t, "discount_shp", CAT)
    return _r(corr.select("column", F.lit("correlation").alias("test"), F.col("corr").alias("statistic"), F.lit(None).cast("double").alias("p_value"))
              .unionByName(anova.select("column", F.lit("anova").alias("test"), F.col("f_stat").alias("statistic"), "p_value")),
              {"statistic", "p_value"}, 4)


def _chi2_sql(cells: str, keys: str, x: str, y: str, yates: bool) -> str:
    yc = "(dd - least(0.5, dd)) * (dd - least(0.5, dd)) * n * sr * sc"
    chi = f"CASE WHEN r = 2 AND c = 2 THEN {yc} ELSE chi2_raw END" if yates else "chi2_raw"
    return f"""
      SELECT {keys}, {chi} AS chi2, r, c, n, (r - 1) * (c - 1) AS dof FROM (
        SELECT {keys}, sum(o * o / e) - first(nn) AS chi2_raw, first(abs(o - e)) AS dd,
               sum(CASE WHEN fx THEN 1.0 / rr END) AS sr, sum(CASE WHEN fy THEN 1.0 / cc END) AS sc,
               count(DISTINCT {x}) AS r, count(DISTINCT {y}) AS c, first(nn) AS n
        FROM (SELECT *, rr * cc / nn AS e FROM (
                SELECT *, sum(o) OVER (PARTITION BY {keys}, {x}) AS rr, sum(o) OVER (PARTITION BY {keys}, {y}) AS cc,
                       CAST(sum(o) OVER (PARTITION BY {keys}) AS BIGINT) AS nn,
                       row_number() OVER (PARTITION BY {keys}, {x} ORDER BY {y}) = 1 AS fx,
                       row_number() OVER (PARTITION BY {keys}, {y} ORDER BY {x}) = 1 AS fy
                FROM ({cells}) c0) c1) c2
        GROUP BY {keys}) t"""


_CHI_CELLS = _union(f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, CAST(accepted AS VARCHAR) AS target,
                        count(*) AS o FROM targeted WHERE {c} IS NOT NULL AND accepted IS NOT NULL GROUP BY 1, 2, 3"""
                    for c in CAT if c != "final_outcome")


@register("eda_chi2", with_modelling() + f"""
    SELECT "column", {rsql('chi2', 4)} AS chi2, r, c, n, dof, {rsql(_chi2_survival_sql('chi2', 'dof'))} AS p_value FROM ({_chi2_sql(_CHI_CELLS, '"column"', 'value', 'target', True)}) x""")
def q_eda_chi2(spark, sf_dir):
    """Chi-square of each categorical column against the target class."""
    t = targeted(spark, sf_dir).withColumn("accepted", F.col("accepted").cast("string"))
    c = D.contingency_chi2(t, [c for c in CAT if c != "final_outcome"], "accepted")
    c = c.select("column", rounded(F.col("chi2"), 4).alias("chi2"), "r", "c", "n", "dof", "p_value")
    return _r(c, {"p_value"})


@register("eda_contingency", with_modelling() + f"SELECT \"column\", value, target, o FROM ({_CHI_CELLS}) x")
def q_eda_contingency(spark, sf_dir):
    """Contingency counts of each categorical column vs the target."""
    t = targeted(spark, sf_dir).withColumn("accepted", F.col("accepted").cast("string"))
    return D.contingency_table(t, [c for c in CAT if c != "final_outcome"], "accepted")


_PAIRS = D.lower_tri(CAT[:4])
_CV_CELLS = _union(f"""SELECT '{a}' AS a, '{b}' AS b, CAST({a} AS VARCHAR) AS x, CAST({b} AS VARCHAR) AS y, count(*) AS o
                       FROM targeted WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2, 3, 4""" for a, b in _PAIRS)


@register("eda_cramers_v", with_modelling() + f"""
    SELECT a, b, {rsql('CASE WHEN den > 0 THEN sqrt(phi2c / den) END')} AS cramers_v FROM (
      SELECT a, b, greatest(0.0, chi2 / n - (r - 1) * (c - 1) / (n - 1.0)) AS phi2c,
             least(r - (r - 1) * (r - 1) / (n - 1.0) - 1, c - (c - 1) * (c - 1) / (n - 1.0) - 1) AS den
      FROM ({_chi2_sql(_CV_CELLS, 'a, b', 'x', 'y', False)}) t) u""")
def q_eda_cramers_v(spark, sf_dir):
    """D6 nominal-nominal association (bias-corrected Cramer's V)."""
    return _r(D.cramers_v(targeted(spark, sf_dir), _PAIRS), {"cramers_v"})


ALL_NUMERIC, ALL_CATEGORICAL = [c for c in M.NUMERIC], [c for c in M.CATEGORICAL]


def _cramers_sql(cells: str) -> str:
    return f"""
      SELECT a, b, CASE WHEN den > 0 THEN sqrt(phi2c / den) END AS v FROM (
        SELECT a, b, greatest(0.0, chi2 / n - (r - 1) * (c - 1) / (n - 1.0)) AS phi2c,
               least(r - (r - 1) * (r - 1) / (n - 1.0) - 1, c - (c - 1) * (c - 1) / (n - 1.0) - 1) AS den
        FROM ({_chi2_sql(cells, 'a, b', 'x', 'y', False)}) t) u"""


_ALL_CELLS = _union(f"""SELECT '{a}' AS a, '{b}' AS b, CAST({a} AS VARCHAR) AS x, CAST({b} AS VARCHAR) AS y, count(*) AS o
                        FROM targeted WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2, 3, 4"""
                    for a, b in D.lower_tri(ALL_CATEGORICAL))


@register("eda_associations", with_modelling() + f"""
    SELECT a, b, 'cramers_v' AS kind, {rsql('v', 4)} AS value FROM ({_cramers_sql(_ALL_CELLS)}) c UNION ALL """ + _union(
    [f"""SELECT '{a}' AS a, "column" AS b, 'correlation_ratio' AS kind,
                {rsql('CASE WHEN ss_between + ss_within > 0 THEN sqrt(ss_between / (ss_between + ss_within)) ELSE 0.0 END', 4)} AS value
         FROM ({_anova_sql('targeted', ALL_NUMERIC, a, None)}) t""" for a in ALL_CATEGORICAL]
    + [f"""SELECT '{a}' AS a, '{b}' AS b, 'pearson' AS kind,
                  {rsql(f'(CASE WHEN min({a}) < max({a}) AND min({b}) < max({b}) THEN corr({a}, {b}) END)', 4)} AS value FROM targeted"""
       for a, b in D.lower_tri(ALL_NUMERIC)]))
def q_eda_associations(spark, sf_dir):
    """The association matrix of all 25 features, upper triangle."""
    return _r(D.association_matrix(targeted(spark, sf_dir), ALL_NUMERIC, ALL_CATEGORICAL), {"value"}, 4)


@register("eda_overview", with_modelling() + "SELECT * FROM (" + _union(
    f"""SELECT '{c}' AS "column", count(*) AS n_rows, {len(MISSING_COLS)} AS n_columns, count({c}) AS n_values FROM targeted"""
    for c in MISSING_COLS) + ") t")
def q_eda_overview(spark, sf_dir):
    """Rows, columns and known values."""
    return D.overview(targeted(spark, sf_dir).select(*MISSING_COLS)).drop("type")


def _section(name: str, sql: str) -> str:
    return f"SELECT '{name}' AS section, ({sql}) AS n_rows"


@register("eda_report", with_modelling() + _union([
    _section("overview", f"SELECT {len(set(NUM) | set(CAT))}"), _section("numeric_summary", f"SELECT {len(NUM)}"),
    _section("categorical_summary", f"SELECT {len(CAT)}"),
    _section("missing_values", "SELECT count(*) FROM (" + _union(f"SELECT count(*) - count({c}) AS n FROM targeted" for c in sorted(set(NUM) | set(CAT))) + ") t WHERE n > 0"),
    _section("frequencies", "SELECT sum(n)::BIGINT FROM (" + _union(f"SELECT count(DISTINCT {c}) + (CASE WHEN count(*) > count({c}) THEN 1 ELSE 0 END) AS n FROM targeted" for c in CAT) + ") t"),
    _section("histograms", "SELECT sum(n)::BIGINT FROM (" + _union(
        f"SELECT count(DISTINCT CASE WHEN hi = lo THEN 0 ELSE least(floor((v - lo) / ((hi - lo) / 10.0)), 9) END) AS n "
        f"FROM (SELECT CAST({c} AS DOUBLE) AS v, min(CAST({c} AS DOUBLE)) OVER () AS lo, max(CAST({c} AS DOUBLE)) OVER () AS hi FROM targeted) t WHERE v IS NOT NULL"
        for c in NUM) + ") t"),
    _section("anova", f"SELECT {len(NUM)}"), _section("chi2", f"SELECT {len(CAT) - 1}"),
    _section("contingency", "SELECT sum(n)::BIGINT FROM (" + _union(
        f"SELECT count(*) AS n FROM (SELECT DISTINCT {c}, final_outcome FROM targeted WHERE {c} IS NOT NULL AND final_outcome IS NOT NULL) d"
        for c in CAT if c != "final_outcome") + ") t")]))
def q_eda_report(spark, sf_dir):
    """The report against the outcome without its association part, as
    the number of rows of each section."""
    t = stage(targeted(spark, sf_dir).select(*sorted(set(NUM) | set(CAT))), "report")
    parts = D.eda_report(t, NUM, CAT, "final_outcome", include_association_analysis=False)
    rows = [df.agg(F.count("*").alias("n_rows")).select(F.lit(k).alias("section"), "n_rows") for k, df in parts.items()]
    return reduce(DataFrame.unionByName, rows)


@register("eda_pearson", with_modelling() + _union(
    f"SELECT '{a}' AS a, '{b}' AS b, {rsql(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS r FROM targeted"
    for a, b in D.lower_tri(NUM)))
def q_eda_pearson(spark, sf_dir):
    """D6 numeric-numeric: Pearson upper triangle in one aggregation."""
    return _r(D.pearson_matrix(targeted(spark, sf_dir), NUM), {"r"})


@register("eda_correlation_ratio", with_modelling() + f"""
    SELECT 'product_cluster_shp' AS a, "column" AS b,
           {rsql('CASE WHEN ss_between + ss_within > 0 THEN sqrt(ss_between / (ss_between + ss_within)) ELSE 0.0 END')} AS eta
    FROM ({_anova_sql('targeted', NUM, 'product_cluster_shp', None)}) t""")
def q_eda_correlation_ratio(spark, sf_dir):
    """D6 nominal-numeric: correlation ratio."""
    a = D.anova(targeted(spark, sf_dir), NUM, "product_cluster_shp")
    tot = F.col("ss_between") + F.col("ss_within")
    e = a.select(F.lit("product_cluster_shp").alias("a"), F.col("column").alias("b"),
                 F.when(tot > 0, F.sqrt(F.col("ss_between") / tot)).otherwise(F.lit(0.0)).alias("eta"))
    return _r(e, {"eta"})


@register("eda_box_quartiles", with_modelling() + f"""
    SELECT product_cluster_shp, {rsql('min(discount_shp)')} AS min, {rsql('quantile_cont(discount_shp, 0.25)')} AS q1,
           {rsql('quantile_cont(discount_shp, 0.5)')} AS median, {rsql('quantile_cont(discount_shp, 0.75)')} AS q3,
           {rsql('max(discount_shp)')} AS max, count(*) AS n
    FROM targeted WHERE discount_shp IS NOT NULL GROUP BY 1""")
def q_eda_box_quartiles(spark, sf_dir):
    """Quartiles of the discount per product cluster."""
    return _r(D.group_quartiles(targeted(spark, sf_dir), "discount_shp", "product_cluster_shp"),
              {"min", "q1", "median", "q3", "max"})


@register("conversion_by_month", with_modelling() + f"""
    SELECT strftime(date_trunc('month', created_date_off), '%Y-%m') AS month,
           {rsql('avg(CAST(accepted AS DOUBLE))')} AS conversion_rate, count(accepted) AS n
    FROM targeted GROUP BY 1""")
def q_conversion_by_month(spark, sf_dir):
    """Conversion rate per month."""
    c = D.conversion_by_month(targeted(spark, sf_dir), "accepted", "created_date_off")
    c = c.withColumn("month", F.date_format("month", "yyyy-MM"))
    return _r(c, {"conversion_rate"})


@register("conversion_windows", with_modelling() + f"""
    SELECT {rsql(f"avg(CASE WHEN created_date_off >= TIMESTAMP '{M.TRAIN_WINDOW[0]}' AND created_date_off <= TIMESTAMP '{M.TRAIN_WINDOW[1]}' THEN CAST(accepted AS DOUBLE) END)")} AS train_set,
           {rsql(f"avg(CASE WHEN created_date_off >= TIMESTAMP '{M.TEST_WINDOW[0]}' AND created_date_off <= TIMESTAMP '{M.TEST_WINDOW[1]}' THEN CAST(accepted AS DOUBLE) END)")} AS test_set
    FROM targeted""")
def q_conversion_windows(spark, sf_dir):
    """Conversion in the train and test windows (closed intervals)."""
    c = D.conversion_in_windows(targeted(spark, sf_dir), "accepted", "created_date_off",
                                {"train_set": M.TRAIN_WINDOW, "test_set": M.TEST_WINDOW})
    return _r(c, {"train_set", "test_set"})


_CONC_SQL = f"""
    , per AS (SELECT gsfa_customer_id, avg(offer_expected_revenue) AS rev FROM features
              WHERE gsfa_customer_id IS NOT NULL GROUP BY 1),
    cur AS (SELECT gsfa_customer_id, rev,
                   sum(rev) OVER (ORDER BY rev DESC, gsfa_customer_id ROWS UNBOUNDED PRECEDING) / sum(rev) OVER () AS cum_rev_perc,
                   (row_number() OVER (ORDER BY rev DESC, gsfa_customer_id) - 1) * 1.0 / count(*) OVER () AS share_cust
            FROM per WHERE rev IS NOT NULL)"""


@register("revenue_concentration", with_features("orders") + _CONC_SQL + f"""
    SELECT gsfa_customer_id, {rsql('cum_rev_perc')} AS cum_rev_perc,
           {rsql('share_cust')} AS share_cust FROM cur""")
def q_revenue_concentration(spark, sf_dir):
    """A13 + W7: Lorenz curve of mean expected offer revenue per customer."""
    curve, _ = D.revenue_concentration(M.stored_feature_table(spark, sf_dir), "gsfa_customer_id", "offer_expected_revenue")
    c = curve.select("gsfa_customer_id", rounded(F.col("cum_rev_perc")).alias("cum_rev_perc"),
                     rounded(F.col("share_cust")).alias("share_cust"))
    return c


@register("revenue_concentration_point", with_features("orders") + _CONC_SQL + f"""
    SELECT {rsql('share_cust')} AS share_cust, {rsql('cum_rev_perc')} AS cum_rev_perc
    FROM cur WHERE cum_rev_perc > 0.8 ORDER BY share_cust LIMIT 1""")
def q_revenue_concentration_point(spark, sf_dir):
    """First point of the curve above 80 % of revenue (a top-1 report)."""
    _, first = D.revenue_concentration(M.stored_feature_table(spark, sf_dir), "gsfa_customer_id", "offer_expected_revenue")
    return first.select(rounded(F.col("share_cust")).alias("share_cust"),
                        rounded(F.col("cum_rev_perc")).alias("cum_rev_perc"))


@register("accepted_discount", with_modelling() + f"""
    SELECT organization_id, {rsql('avg(discount_shp)')} AS mean_discount FROM targeted WHERE accepted = 1 GROUP BY 1""")
def q_accepted_discount(spark, sf_dir):
    """Mean discount of accepted offers per organization."""
    return _r(D.accepted_discount_by_group(targeted(spark, sf_dir)), {"mean_discount"})


@register("distinct_organizations", with_modelling() + "SELECT DISTINCT organization_id FROM targeted")
def q_distinct_organizations(spark, sf_dir):
    """Distinct values of a column."""
    return D.distinct_values(targeted(spark, sf_dir), "organization_id")


@register("date_range", with_modelling() + """
    SELECT min(created_date_off) AS min_date, max(created_date_off) AS max_date FROM targeted""")
def q_date_range(spark, sf_dir):
    """First and last offer date."""
    return D.date_range(targeted(spark, sf_dir), "created_date_off")


SCATTER_N = 500


@register("scatter_sample", with_modelling() + f"""
    SELECT offer_id, {rsql('discount_shp')} AS discount_shp, {rsql('log_published_revenue')} AS log_published_revenue
    FROM targeted
    ORDER BY {md5_unit_sql('0', 'offer_id', 'product_cluster_shp')}, offer_id, product_cluster_shp,
             discount_shp, log_published_revenue
    LIMIT {SCATTER_N}""")
def q_scatter_sample(spark, sf_dir):
    """A fixed-size sample of two numeric columns by hash order
    (the sample size is the feature)."""
    t = targeted(spark, sf_dir)
    s = prep.sample_rows(t, SCATTER_N, ["offer_id", "product_cluster_shp"], seed=0, portable=True,
                         tie_break=["discount_shp", "log_published_revenue"])
    return _r(s.select("offer_id", "discount_shp", "log_published_revenue"),
              {"discount_shp", "log_published_revenue"})


def _fold_sql(n_splits: int) -> str:
    return f"""
    , ix AS (SELECT *, row_number() OVER (ORDER BY created_date_off, offer_id, product_cluster_shp,
                                                   discount_shp, published_revenue_shp) - 1 AS row_index,
                    count(*) OVER () AS n_rows FROM train),
    fb AS (SELECT *, n_rows // {n_splits + 1} AS ts FROM ix),
    folds AS (SELECT CAST(f.fold AS INTEGER) AS fold, CASE WHEN row_index < n_rows - ({n_splits} - f.fold) * ts THEN 'train'
                                  WHEN row_index < n_rows - ({n_splits} - f.fold) * ts + ts THEN 'test' END AS role, fb.*
              FROM fb, range(0, {n_splits}) f(fold))"""


@register("time_series_folds", with_modelling() + _fold_sql(5) + """
    SELECT fold, role, count(*) AS n, min(created_date_off) AS first_date, max(created_date_off) AS last_date,
           CAST(sum(accepted) AS BIGINT) AS n_accepted
    FROM folds WHERE role IS NOT NULL GROUP BY 1, 2""")
def q_time_series_folds(spark, sf_dir):
    """expanding-window folds (5 splits) over the date-ordered train
    window, as a (fold, role) table."""
    train, _ = M.split(M.modelling_table(spark, sf_dir))
    f = FO.time_series_folds(train, 5, ["created_date_off", "offer_id", "product_cluster_shp",
                                        "discount_shp", "published_revenue_shp"])
    return f.groupBy("fold", "role").agg(
        F.count("*").alias("n"), F.min("created_date_off").alias("first_date"),
        F.max("created_date_off").alias("last_date"), F.sum("accepted").cast("bigint").alias("n_accepted"))


@register("ordered_holdout", with_modelling() + """
    , ix AS (SELECT *, row_number() OVER (ORDER BY created_date_off, offer_id, product_cluster_shp,
                                                   discount_shp, published_revenue_shp) - 1 AS row_index,
                    count(*) OVER () AS n_rows FROM train)
    SELECT CASE WHEN row_index < n_rows - CAST(ceil(n_rows * 0.3) AS BIGINT) THEN 'train' ELSE 'validation' END AS role,
           count(*) AS n, min(created_date_off) AS first_date, max(created_date_off) AS last_date
    FROM ix GROUP BY 1""")
def q_ordered_holdout(spark, sf_dir):
    """last 30 % (rounded up) of the date-ordered rows as validation."""
    train, _ = M.split(M.modelling_table(spark, sf_dir))
    h = FO.ordered_holdout(train, 0.3, ["created_date_off", "offer_id", "product_cluster_shp",
                                        "discount_shp", "published_revenue_shp"])
    return h.groupBy("role").agg(F.count("*").alias("n"), F.min("created_date_off").alias("first_date"),
                                 F.max("created_date_off").alias("last_date"))

