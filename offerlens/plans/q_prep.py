"""Registered queries: target, filters, split, X/y, augmentation."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerlens.operators import augment as aug
from offerlens.operators import prep
from offerlens.plans import master as M
from offerlens.plans.master import rounded
from offerlens.plans.oracle_chain import md5_unit_sql, rsql, with_features, with_modelling
from offerlens.plans.registry import register
from offerlens.sources import fixtures as fx


@register("fix_target", with_modelling() + """
    SELECT final_outcome, accepted, count(*) AS n FROM targeted GROUP BY final_outcome, accepted""")
def q_fix_target(spark, sf_dir):
    """Outcome -> 0/1/NULL (unknown words raise)."""
    m = prep.fix_target(M.master_table(spark, sf_dir, with_ids=True), "final_outcome", "accepted")
    return m.groupBy("final_outcome", "accepted").agg(F.count("*").alias("n"))


@register("drop_null_target", with_modelling() + """
    SELECT organization_id, count(*) AS n, CAST(sum(accepted) AS BIGINT) AS n_accepted
    FROM targeted WHERE accepted IS NOT NULL GROUP BY organization_id""")
def q_drop_null_target(spark, sf_dir):
    """rows without a known outcome go, whatever their discount."""
    m = prep.fix_target(M.master_table(spark, sf_dir, with_ids=True), "final_outcome", "accepted")
    return prep.drop_null_target(m).groupBy("organization_id").agg(
        F.count("*").alias("n"), F.sum("accepted").cast("bigint").alias("n_accepted"))


@register("filter_dataset", with_modelling() + """
    SELECT organization_id, count(*) AS n, CAST(sum(accepted) AS BIGINT) AS n_accepted,
           min(discount_shp) AS min_discount, max(discount_shp) AS max_discount
    FROM modelling GROUP BY organization_id""")
def q_filter_dataset(spark, sf_dir):
    """closed discount range [0, 99] and non-NULL target."""
    m = M.modelling_table(spark, sf_dir)
    return m.groupBy("organization_id").agg(
        F.count("*").alias("n"), F.sum("accepted").cast("bigint").alias("n_accepted"),
        F.min("discount_shp").alias("min_discount"), F.max("discount_shp").alias("max_discount"))


@register("train_test_split", with_modelling() + """
    SELECT 'train' AS role, count(*) AS n, CAST(sum(accepted) AS BIGINT) AS n_accepted,
           min(created_date_off) AS first_date, max(created_date_off) AS last_date FROM train
    UNION ALL
    SELECT 'test', count(*), CAST(sum(accepted) AS BIGINT), min(created_date_off), max(created_date_off) FROM test""")
def q_train_test_split(spark, sf_dir):
    """half-open date windows."""
    train, test = M.split(M.modelling_table(spark, sf_dir))

    def summary(df, role):
        return df.agg(F.lit(role).alias("role"), F.count("*").alias("n"),
                      F.sum("accepted").cast("bigint").alias("n_accepted"),
                      F.min("created_date_off").alias("first_date"),
                      F.max("created_date_off").alias("last_date"))
    return summary(train, "train").unionByName(summary(test, "test"))


_XY = ["offer_id"] + M.FEATURES + ["accepted"]


@register("x_y_split", with_modelling() + "SELECT " + ", ".join(
    f"{rsql(c)} AS {c}" if c in M.NUMERIC else c for c in _XY) + " FROM test")
def q_x_y_split(spark, sf_dir):
    """Features + label kept on one row for the test window."""
    _, test = M.split(M.modelling_table(spark, sf_dir))
    xy = prep.x_y_split(test, M.FEATURES, "accepted", keep=["offer_id"])
    return xy.select(*[rounded(F.col(c)).alias(c) if c in M.NUMERIC else F.col(c) for c in _XY])


@register("clean_for_training", with_modelling() + """
    SELECT organization_id, count(*) AS n FROM (SELECT DISTINCT * FROM modelling) d GROUP BY 1""")
def q_clean_for_training(spark, sf_dir):
    """range + target + de-duplication; usable column lists."""
    m = M.modelling_table(spark, sf_dir)
    df, _, _ = prep.clean_for_training(m, ["ecomm"], M.CATEGORICAL, M.NUMERIC[1:])
    return df.groupBy("organization_id").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------------------
# Augmentation
# ---------------------------------------------------------------------------

AUG_CONFIGS = {
    "augment_basic": aug.AugmentConfig("basic", (10, 20)),
    "augment_basic_weighted": aug.AugmentConfig("basic", (8, 26), weight=0.5, weight_asym=True),
    "augment_orig": aug.AugmentConfig("orig"),
    "augment_1sided": aug.AugmentConfig("1sided"),
    "augment_none": aug.AugmentConfig("no-augmentation"),
    "augment_shift": aug.AugmentConfig("shift", (10, 20), sigma=2.0, seed=7, portable_noise=True),
    "augment_shift_uni": aug.AugmentConfig("shift-uni", (10, 20), seed=7, portable_noise=True),
}
AUG_KEY = ["offer_id", "product_cluster_shp"]


def _aug_sql(cfg: aug.AugmentConfig) -> str:
    """The variant as a UNION ALL of branches over the train window."""
    base = "offer_id, product_cluster_shp"
    rows = [f"SELECT {base}, discount_shp AS d, accepted AS y, 1.0::DOUBLE AS w, 0 AS b FROM train"]
    v = cfg.variant
    key = AUG_KEY

    def uni(branch, radius):
        return f"(({md5_unit_sql(str(cfg.seed), str(branch), *key)}) * 2.0::DOUBLE - 1.0::DOUBLE) * {radius}::DOUBLE"

    def normal(branch):
        u1 = f"greatest({md5_unit_sql(str(cfg.seed), str(branch), '1', *key)}, 1e-300::DOUBLE)"
        u2 = md5_unit_sql(str(cfg.seed), str(branch), "2", *key)
        return f"(sqrt(-2.0::DOUBLE * ln({u1})) * cos({2 * 3.141592653589793!r}::DOUBLE * {u2}))"

    if v == "1sided":
        m = "(CASE WHEN accepted = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END)"
        for i, s in enumerate(aug.ONE_SIDED_STEPS):
            rows.append(f"SELECT {base}, d, y, 1.0::DOUBLE, {i + 1} FROM (SELECT {base}, discount_shp + {m} * {s}.0::DOUBLE AS d, accepted AS y FROM train) t WHERE d >= 0 AND d < 100")
    elif v != "no-augmentation":
        a, b = (aug.ORIG_PARAMS if v == "orig" else cfg.params)
        a, b = f"{float(a)!r}::DOUBLE", f"{float(b)!r}::DOUBLE"
        w = f"{float(cfg.weight) if v == 'basic' else 1.0!r}::DOUBLE"
        w_acc = "1.0::DOUBLE" if (v == "orig" or cfg.weight_asym) else w
        if v == "shift":
            s1, s2 = f"{cfg.sigma!r}::DOUBLE * {normal(1)}", f"{cfg.sigma!r}::DOUBLE * {normal(2)}"
            acc1, acc2 = f"discount_shp - ({b} + {s1})", f"discount_shp + ({a} + {s2})"
            rej1, rej2 = f"discount_shp - ({a} + {s1})", f"discount_shp + ({b} + {s2})"
            wa1, wa2, wr1, wr2 = "1.0::DOUBLE", "1.0::DOUBLE", "1.0::DOUBLE", "1.0::DOUBLE"
        elif v == "shift-uni":
            acc1, acc2 = f"discount_shp - ({b} + {uni(1, aug.UNIFORM_RADIUS_FLIP)})", f"discount_shp + ({a} + {uni(2, aug.UNIFORM_RADIUS_SAME)})"
            rej1, rej2 = f"discount_shp - ({a} + {uni(1, aug.UNIFORM_RADIUS_SAME)})", f"discount_shp + ({b} + {uni(2, aug.UNIFORM_RADIUS_FLIP)})"
            wa1, wa2, wr1, wr2 = "1.0::DOUBLE", "1.0::DOUBLE", "1.0::DOUBLE", "1.0::DOUBLE"
        else:
            acc1, acc2 = f"discount_shp - {b}", f"discount_shp + {a}"
            rej1, rej2 = f"discount_shp - {a}", f"discount_shp + {b}"
            wa1, wa2, wr1, wr2 = w_acc, "1.0::DOUBLE", "1.0::DOUBLE", w
        rows.append(f"SELECT {base}, CASE WHEN accepted = 1 THEN {acc1} ELSE {rej1} END, "
                    f"CASE WHEN accepted = 1 THEN 0 ELSE accepted END, "
                    f"CASE WHEN accepted = 1 THEN {wa1} ELSE {wr1} END, 1 FROM train WHERE accepted IN (0, 1)")
        rows.append(f"SELECT {base}, CASE WHEN accepted = 1 THEN {acc2} ELSE {rej2} END, "
                    f"CASE WHEN accepted = 1 THEN accepted ELSE 1 END, "
                    f"CASE WHEN accepted = 1 THEN {wa2} ELSE {wr2} END, 2 FROM train WHERE accepted IN (0, 1)")
    union = "\nUNION ALL\n".join(rows)
    return with_modelling() + f"""
        SELECT offer_id, product_cluster_shp, {rsql('d')} AS discount_shp, y AS accepted,
               w AS weight, b AS aug_branch
        FROM ({union}) u WHERE d >= 0 AND d < 100"""


def _aug_query(name: str, cfg: aug.AugmentConfig):
    def q(spark, sf_dir):
        train, _ = M.split(M.modelling_table(spark, sf_dir))
        t = train.select("offer_id", "product_cluster_shp", "discount_shp", "accepted")
        out = aug.augment(t, cfg, key_cols=AUG_KEY)
        return out.select("offer_id", "product_cluster_shp", rounded(F.col("discount_shp")).alias("discount_shp"),
                          "accepted", "weight", "aug_branch")
    q.__name__ = f"q_{name}"
    q.__doc__ = f"G-variant '{cfg.variant}': augmentation of the train window."
    return q


for _name, _cfg in AUG_CONFIGS.items():
    register(_name, _aug_sql(_cfg))(_aug_query(_name, _cfg))


@register("standardize_rename", with_features("orders") + """
    SELECT published_revenue_shp AS pub, discount_shp AS disc, organization_id
    FROM (SELECT round(published_revenue_shp, 6) AS published_revenue_shp,
                 round(discount_shp, 6) AS discount_shp, organization_id FROM features) f""")
def q_standardize_rename(spark, sf_dir):
    """P1 with a rename map (an absent name is ignored) and a keep list."""
    ft = M.stored_feature_table(spark, sf_dir).select(
        rounded(F.col("published_revenue_shp")).alias("published_revenue_shp"),
        rounded(F.col("discount_shp")).alias("discount_shp"), "organization_id")
    return prep.standardize_dataset(ft, {"published_revenue_shp": "pub", "discount_shp": "disc",
                                         "not_there": "x"}, ["pub", "disc", "organization_id"])


# ---------------------------------------------------------------------------
# Small operators: P16, P17, P20, F15, F16, F17
# ---------------------------------------------------------------------------

def _initcap_sql(x: str) -> str:
    return (f"list_aggregate(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ')")


@register("clean_names", fx.fixture_ctes() + f"""
    SELECT organization_id, upper(replace(trim(name), ' ', '_')) AS name,
           {_initcap_sql("replace(upper(replace(trim(name), ' ', '_')), '_', ' ')")} AS name_title
    FROM f_countries""")
def q_clean_names(spark, sf_dir):
    """Trim, underscores, upper case, capitalised words."""
    c = fx.countries(spark, sf_dir)
    return prep.clean_names(c, "name").select("organization_id", "name", "name_title")


@register("fill_absent_numeric", with_features("orders") + """
    SELECT organization_id, count(*) AS n, sum(prod_mix_x) AS prod_mix_x_sum
    FROM (SELECT organization_id, 0.0::DOUBLE AS prod_mix_x FROM features) t GROUP BY 1""")
def q_fill_absent_numeric(spark, sf_dir):
    """A numeric feature absent from the table is added as 0."""
    ft = M.stored_feature_table(spark, sf_dir)
    f = prep.fill_absent_numeric(ft, ["prod_mix_x", "prod_mix_tdexport"])
    return f.groupBy("organization_id").agg(F.count("*").alias("n"), F.sum("prod_mix_x").alias("prod_mix_x_sum"))


@register("channel_remap_share", with_features("orders") + f"""
    SELECT organization_id, count(*) AS n_rows, CAST(sum(CAST(o <> r AS INTEGER)) AS BIGINT) AS n_changed,
           {rsql('avg(CAST(o <> r AS DOUBLE))')} AS share_changed
    FROM (SELECT organization_id, coalesce(physical_channel_cust, '~') AS o,
                 coalesce(CASE WHEN physical_channel_cust IN ('B2C E-Commerce', 'B2B E-Commerce')
                               THEN physical_channel_cust END, '~') AS r FROM features) t
    GROUP BY 1""")
def q_channel_remap_share(spark, sf_dir):
    """P20: channel re-mapping check -- share of rows whose value changes."""
    ft = M.stored_feature_table(spark, sf_dir)
    r = prep.channel_remap_share(ft, "physical_channel_cust", ["B2C E-Commerce", "B2B E-Commerce"])
    return r.select("organization_id", "n_rows", "n_changed", rounded(F.col("share_changed")).alias("share_changed"))


@register("differs_filter", with_features("orders") + """
    SELECT organization_id, count(*) AS n FROM features
    WHERE log_potential_revenue IS NOT NULL OR log_potential_revenue_tpr IS NOT NULL GROUP BY 1""")
def q_differs_filter(spark, sf_dir):
    """rows where either of two columns is non-NULL."""
    ft = M.stored_feature_table(spark, sf_dir)
    return prep.differs(ft, "log_potential_revenue", "log_potential_revenue_tpr") \
        .groupBy("organization_id").agg(F.count("*").alias("n"))


@register("distinct_pairs", with_features("orders") + """
    SELECT count(*) AS n_pairs FROM (SELECT DISTINCT gsfa_customer_id, product_cluster_shp FROM features) t""")
def q_distinct_pairs(spark, sf_dir):
    """F16: number of distinct (customer, product) pairs."""
    return prep.distinct_pairs(M.stored_feature_table(spark, sf_dir), "gsfa_customer_id", "product_cluster_shp")


@register("top_per_domain", with_features("orders") + f"""
    SELECT product_domain, offer_id, product_cluster_shp, {rsql('published_revenue_shp')} AS published_revenue_shp
    FROM (SELECT *, row_number() OVER (PARTITION BY product_domain ORDER BY published_revenue_shp DESC,
                                       offer_id, product_cluster_shp, discount_shp) AS rn FROM features) t
    WHERE rn <= 4""")
def q_top_per_domain(spark, sf_dir):
    """top 4 lines per product domain (a top-n report)."""
    ft = M.stored_feature_table(spark, sf_dir)
    t = prep.top_n_per_group(ft, "product_domain", 4,
                             [F.col("published_revenue_shp").desc(), "offer_id", "product_cluster_shp", "discount_shp"])
    return t.select("product_domain", "offer_id", "product_cluster_shp",
                    rounded(F.col("published_revenue_shp")).alias("published_revenue_shp"))
