"""Registered queries: sources, raw-to-feature chain, master table."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerlens.operators import features as feat
from offerlens.operators import prep
from offerlens.plans import master as M
from offerlens.plans.oracle_chain import AUDIT_OUTCOME_SQL, rsql, with_features
from offerlens.plans.registry import register
from offerlens.plans.master import rounded
from offerlens.sources import fixtures as fx


def rnd(c: str, d: int = 6):
    return rounded(F.col(c), d).alias(c)


FEATURE_OUT = ["organization_id", "offer_id", "product_cluster_shp", "discount_shp",
               "final_outcome", "final_discount_shp", "order_in_oppo", "offers_in_oppo",
               "finality", "revenue_bin", "offer_products", "industry", "lead_cust",
               "lead_oppo", "initiator_cust", "initiator_oppo", "competitor_oppo",
               "competitor_cust", "ecomm", "product_domain", "product_mix"]
FEATURE_OUT_D6 = ["fraction_tdi", "fraction_ddi", "fraction_dom", "prod_mix_tdexport",
                  "prod_mix_tdimport", "prod_mix_td3rd", "prod_mix_tddom", "prod_mix_ddexport",
                  "log_published_revenue", "log_potential_revenue", "log_offer_published_revenue",
                  "log_shipments", "log_wps", "log_weight", "log_discount", "time_taken",
                  "offer_discount", "discount_oms", "discount_delta", "published_revenue_shp"]
FEATURE_OUT_D2 = ["offer_published_revenue", "offer_expected_revenue",
                  "offer_recommended_revenue"]


def _feature_projection(df):
    return df.select(*FEATURE_OUT, *[rnd(c) for c in FEATURE_OUT_D6],
                     *[rnd(c, 4) for c in FEATURE_OUT_D2])


def _feature_projection_sql() -> str:
    cols = (FEATURE_OUT + [f"{rsql(c)} AS {c}" for c in FEATURE_OUT_D6]
            + [f"{rsql(c, 4)} AS {c}" for c in FEATURE_OUT_D2])
    return ", ".join(cols)


@register("features_chain", with_features("orders") + f"SELECT {_feature_projection_sql()} FROM features",
          headline=True)
def q_features_chain(spark, sf_dir):
    """The whole archived chain."""
    return _feature_projection(M.feature_table(spark, sf_dir, "orders", keep=FEATURE_OUT + FEATURE_OUT_D6 + FEATURE_OUT_D2))


@register("features_chain_audit", with_features("audit") + f"SELECT {_feature_projection_sql()} FROM features")
def q_features_chain_audit(spark, sf_dir):
    """Same chain with the outcome derived from the audit log (A2-A4)."""
    return _feature_projection(M.feature_table(spark, sf_dir, "audit", keep=FEATURE_OUT + FEATURE_OUT_D6 + FEATURE_OUT_D2))


@register("audit_outcome", fx.fixture_ctes() + f"""
    SELECT organization_id, offer_id, new_value, old_value, updated_date, CAST(sent_out AS BIGINT) AS sent_out, outcome
    FROM ({AUDIT_OUTCOME_SQL}) t""")
def q_audit_outcome(spark, sf_dir):
    """A2 last status per column, A3 sent-out count, A4 outcome rule."""
    o = feat.audit_outcome(fx.offer_audit(spark, sf_dir))
    return o.select("organization_id", "offer_id", "new_value", "old_value", "updated_date",
                    F.col("sent_out").cast("bigint").alias("sent_out"), "outcome")


_MASTER_D6 = [c for c in M.MASTER_COLUMNS if c.startswith("log_") or c.startswith("prod_mix_")
              or c in ("discount_shp", "ecomm", "published_revenue_shp")]
_MASTER_D2: list[str] = []
_MASTER_PLAIN = [c for c in M.MASTER_COLUMNS if c not in _MASTER_D6 + _MASTER_D2]


def _master_sql_select(src: str = "features") -> str:
    cols = (_MASTER_PLAIN + [f"{rsql(c)} AS {c}" for c in _MASTER_D6] + [f"{rsql(c, 2)} AS {c}" for c in _MASTER_D2])
    kept = _MASTER_PLAIN + [f"CAST({c} AS DOUBLE) AS {c}" for c in _MASTER_D6] + list(_MASTER_D2)
    return f"SELECT {', '.join(cols)} FROM (SELECT DISTINCT {', '.join(kept)} FROM {src}) m"


@register("master_table", with_features("orders") + _master_sql_select())
def q_master_table(spark, sf_dir):
    """P1 standardize (rename + keep list), P2 casts and F1 de-duplication of
    the feature table."""
    m = M.master_table(spark, sf_dir)
    return m.select(*_MASTER_PLAIN, *[rnd(c) for c in _MASTER_D6], *[rnd(c, 2) for c in _MASTER_D2])


@register("organizations", fx.fixture_ctes() + """
    SELECT c.organization_id, c.int_cur, c.dom_cur,
           (c.dom_cur IS DISTINCT FROM c.int_cur) AS dual_currency,
           round(d.rate_eur / i.rate_eur, 6) AS ex_rate_dom2int
    FROM f_countries c
    LEFT JOIN (SELECT from_currency, arg_max(rate_eur_ber, bill_per_dt) AS rate_eur FROM f_rates GROUP BY 1) i
      ON c.int_cur = i.from_currency
    LEFT JOIN (SELECT from_currency, arg_max(rate_eur_ber, bill_per_dt) AS rate_eur FROM f_rates GROUP BY 1) d
      ON c.dom_cur = d.from_currency""")
def q_organizations(spark, sf_dir):
    """S2b + J8 + A8 + P21: organizations dimension with latest rates."""
    o = feat.organizations(fx.countries(spark, sf_dir), fx.exchange_rate(spark, sf_dir))
    return o.select("organization_id", "int_cur", "dom_cur", "dual_currency", rnd("ex_rate_dom2int"))


@register("row_counts", with_features("orders") + """
    SELECT organization_id, count(*) AS n_offers FROM features GROUP BY organization_id""")
def q_row_counts(spark, sf_dir):
    """A1 / S5 counts: rows per organization (sorted descending)."""
    ft = M.stored_feature_table(spark, sf_dir)
    return ft.groupBy("organization_id").agg(F.count("*").alias("n_offers")).orderBy(F.desc("n_offers"))


@register("clean_dedup", fx.fixture_ctes() + """
    SELECT organization_id, count(*) AS n_rows FROM (
      SELECT DISTINCT * FROM (SELECT * FROM f_lines UNION ALL SELECT * FROM f_lines) u) d
    GROUP BY organization_id""")
def q_clean_dedup(spark, sf_dir):
    """Whole-row de-duplication of the line table unioned with
    itself; counts per organization."""
    li = fx.lines(spark, sf_dir)
    d = prep.clean_dataset(li.unionByName(li))
    return d.groupBy("organization_id").agg(F.count("*").alias("n_rows"))
