"""Registered queries: classifier metrics and curves on the test window,
scored with the closed-form acceptance model."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerlens.functions.exprs import md5_unit
from offerlens.operators import metrics as E
from offerlens.plans import master as M
from offerlens.plans.master import rounded
from offerlens.plans.oracle_chain import md5_unit_sql, rsql, with_modelling
from offerlens.plans.q_ladder import SCORER, test_rows
from offerlens.plans.registry import register


def scored_test(spark, sf_dir):
    """R1 with the closed-form model: class and probability of class 1, plus
    a random-score baseline."""
    t = test_rows(spark, sf_dir)
    t = t.withColumn("y_pred_proba", SCORER.prob(F.col("discount_shp")))
    return t.withColumns({"y_pred": E.predicted_class(F.col("y_pred_proba")),
                          "random_score": md5_unit(F.lit(1), "offer_id", "product_cluster_shp")})


def _scored_sql() -> tuple[str, str]:
    p = SCORER.sql_prob("discount_shp")
    return ("scored", f"""
        SELECT *, CAST(y_pred_proba > 0.5 AS INTEGER) AS y_pred FROM (
          SELECT *, {p} AS y_pred_proba, {md5_unit_sql('1', 'offer_id', 'product_cluster_shp')} AS random_score
          FROM test) t""")


_CURVE_CTES = [
    ("sg", """
        SELECT model, score, CAST(sum(accepted) AS BIGINT) AS pos, CAST(sum(1 - accepted) AS BIGINT) AS neg FROM (
          SELECT 'y_pred_proba' AS model, y_pred_proba AS score, accepted FROM scored
          UNION ALL SELECT 'random_score', random_score, accepted FROM scored) u
        GROUP BY model, score"""),
    ("sc", """
        SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_pos,
                  sum(neg) OVER (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_neg,
                  sum(pos) OVER (PARTITION BY model) AS P, sum(neg) OVER (PARTITION BY model) AS N
        FROM sg"""),
]


@register("classification_metrics", with_modelling(_scored_sql()) + f"""
    SELECT tp, fp, fn, tn, {rsql('log_loss')} AS log_loss, {rsql('acceptance_rate')} AS acceptance_rate,
           {rsql('ks_abc')} AS ks_abc, n, {rsql('precision')} AS precision, {rsql('recall')} AS recall,
           {rsql('CASE WHEN precision + recall > 0 THEN 2.0 * precision * recall / (precision + recall) ELSE 0.0 END')} AS f1,
           {rsql('(tp + tn) / n')} AS accuracy
    FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
                    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall
          FROM (SELECT CAST(sum(CAST(accepted = 1 AND y_pred = 1 AS INTEGER)) AS BIGINT) AS tp,
                       CAST(sum(CAST(accepted = 0 AND y_pred = 1 AS INTEGER)) AS BIGINT) AS fp,
                       CAST(sum(CAST(accepted = 1 AND y_pred = 0 AS INTEGER)) AS BIGINT) AS fn,
                       CAST(sum(CAST(accepted = 0 AND y_pred = 0 AS INTEGER)) AS BIGINT) AS tn,
                       avg(-(accepted * ln(least(greatest(y_pred_proba, 1e-15), 1 - 1e-15))
                           + (1 - accepted) * ln(1 - least(greatest(y_pred_proba, 1e-15), 1 - 1e-15)))) AS log_loss,
                       avg(CAST(accepted AS DOUBLE)) AS acceptance_rate,
                       avg(CASE WHEN accepted = 1 THEN y_pred_proba END) - avg(CASE WHEN accepted = 0 THEN y_pred_proba END) AS ks_abc,
                       count(*) AS n
                FROM scored) a) b""", headline=True)
def q_classification_metrics(spark, sf_dir):
    """E1 (precision, recall, F1, log-loss, accuracy) + E2 rate + E3 area."""
    m = E.classification_metrics(scored_test(spark, sf_dir), "accepted", "y_pred_proba", "y_pred")
    return m.select("tp", "fp", "fn", "tn", *[rounded(F.col(c)).alias(c) for c in
                    ["log_loss", "acceptance_rate", "ks_abc"]], "n",
                    *[rounded(F.col(c)).alias(c) for c in ["precision", "recall", "f1", "accuracy"]])


@register("score_metrics", with_modelling(_scored_sql(), *_CURVE_CTES) + f"""
    SELECT model, {rsql('CASE WHEN P > 0 AND N > 0 THEN auc_num / (P * N) END')} AS auc,
           {rsql('ap')} AS average_precision, {rsql('ks')} AS ks_max_gap, n_thresholds
    FROM (SELECT model, first(P) AS P, first(N) AS N,
                 sum(pos * ((N - cum_neg) + 0.5 * neg)) AS auc_num,
                 sum(pos / P * (cum_pos / (cum_pos + cum_neg))) AS ap,
                 max(abs((N - cum_neg + neg) / N - (P - cum_pos + pos) / P)) AS ks,
                 count(*) AS n_thresholds
          FROM sc GROUP BY model) t""")
def q_score_metrics(spark, sf_dir):
    """E1 AUC + E2 average precision + E3 KS gap per model (incl. a random
    baseline) from exact distributed running sums."""
    c = E.score_curves(scored_test(spark, sf_dir), "accepted", ["y_pred_proba", "random_score"])
    m = E.score_curve_metrics(c)
    return m.select("model", *[rounded(F.col(x)).alias(x) for x in ["auc", "average_precision", "ks_max_gap"]],
                    "n_thresholds")


@register("roc_pr_curves", with_modelling(_scored_sql(), *_CURVE_CTES) + f"""
    SELECT model, {rsql('score')} AS score, pos, neg, {rsql('cum_pos / P')} AS tpr, {rsql('cum_neg / N')} AS fpr,
           {rsql('cum_pos / (cum_pos + cum_neg)')} AS precision, {rsql('cum_pos / P')} AS recall
    FROM sc""")
def q_roc_pr_curves(spark, sf_dir):
    """E4 + E5: ROC and PR points per distinct score, two models side by side."""
    c = E.score_curves(scored_test(spark, sf_dir), "accepted", ["y_pred_proba", "random_score"])
    return c.select("model", rounded(F.col("score")).alias("score"),
                    F.col("pos").cast("bigint").alias("pos"), F.col("neg").cast("bigint").alias("neg"),
                    *[rounded(F.col(x)).alias(x) for x in ["tpr", "fpr", "precision", "recall"]])


@register("confusion_matrix", with_modelling(_scored_sql()) + """
    SELECT accepted AS actual, y_pred AS predicted, count(*) AS n FROM scored GROUP BY 1, 2""")
def q_confusion_matrix(spark, sf_dir):
    """E6."""
    return E.confusion_matrix(scored_test(spark, sf_dir))


@register("calibration_curve", with_modelling(_scored_sql()) + f"""
    SELECT bin, {rsql('avg(y_pred_proba)')} AS prob_pred, {rsql('avg(CAST(accepted AS DOUBLE))')} AS prob_true,
           count(*) AS n
    FROM (SELECT *, {' + '.join(f'CAST({e!r} < y_pred_proba AS INTEGER)' for e in E.CALIBRATION_INNER_EDGES)} AS bin
          FROM scored) t GROUP BY bin""")
def q_calibration_curve(spark, sf_dir):
    """Five uniform bins."""
    c = E.calibration_curve(scored_test(spark, sf_dir))
    return c.select("bin", rounded(F.col("prob_pred")).alias("prob_pred"),
                    rounded(F.col("prob_true")).alias("prob_true"), "n")


AVE_NUMERIC = ["discount_shp", "log_published_revenue", "log_offer_published_revenue",
               "log_shipments", "prod_mix_tdexport", "ecomm"]
AVE_CATEGORICAL = ["product_cluster_shp", "industry", "competitor_oppo"]


def _ave_sql() -> str:
    num = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, accepted, y_pred_proba FROM scored"
                             for c in AVE_NUMERIC)
    cat = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS bin, accepted, y_pred_proba FROM scored"
                             for c in AVE_CATEGORICAL)
    qs = ", ".join(repr(q) for q in E.DECILES)
    return f"""
    , nl AS ({num}),
    ed AS (SELECT feature, list_sort(list_distinct(quantile_cont(v, [{qs}]))) AS edges FROM nl WHERE v IS NOT NULL GROUP BY feature),
    nb AS (SELECT n.feature, CAST(CASE WHEN v IS NOT NULL THEN
                   len(list_filter(edges[2:len(edges) - 1], lambda e: e < v)) END AS VARCHAR) AS bin,
                  accepted, y_pred_proba
           FROM nl n LEFT JOIN ed ON n.feature = ed.feature),
    allb AS (SELECT * FROM nb UNION ALL SELECT feature, bin, accepted, y_pred_proba FROM ({cat}) c)
    SELECT feature, bin, {rsql('avg(CAST(accepted AS DOUBLE))')} AS observed, {rsql('avg(y_pred_proba)')} AS predicted,
           count(*)::DOUBLE AS exposure,
           {rsql('avg(y_pred_proba) - avg(CAST(accepted AS DOUBLE))')} AS weighted_diff
    FROM allb WHERE bin IS NOT NULL GROUP BY feature, bin"""


@register("actual_vs_expected", with_modelling(_scored_sql()) + _ave_sql())
def q_actual_vs_expected(spark, sf_dir):
    """E8 (+W5 decile bins): all features in one unpivot + one aggregation."""
    a = E.actual_vs_expected(scored_test(spark, sf_dir), AVE_NUMERIC, AVE_CATEGORICAL)
    return a.select("feature", "bin", rounded(F.col("observed")).alias("observed"),
                    rounded(F.col("predicted")).alias("predicted"), "exposure",
                    rounded(F.col("weighted_diff")).alias("weighted_diff"))


@register("same_result", "SELECT true AS equal, CAST(0 AS BIGINT) AS n_different")
def q_same_result(spark, sf_dir):
    """The recommendation computed on 3 and on 8 input partitions is
    the same multiset (determinism under repartitioning)."""
    from offerlens.operators import ladder as L
    t = test_rows(spark, sf_dir)
    a = L.recommend(t.repartition(3), SCORER, gamma=6)
    b = L.recommend(t.repartition(8, "offer_id"), SCORER, gamma=6)
    cols = ["offer_id", "product_cluster_shp", "discount_shp", "discount_low", "discount_high", "discount_opt"]
    return E.same_rows(a.select(cols), b.select(cols))
