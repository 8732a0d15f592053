"""The feature chain written once more in plain SQL (DuckDB dialect) as the
correctness oracle.  Independent of the Spark code path: only the fixture
views and the fixed vocabularies are shared."""

from __future__ import annotations

from offerlens.operators.features import (DOMAIN_SHARE_COLUMNS, ECOMM_CHANNELS,
                                          MIX_SHARE_COLUMNS, PRODUCT_DOMAIN,
                                          PRODUCT_DOMAIN_OTHER, PRODUCT_MIX,
                                          PRODUCT_MIX_OTHER, REVENUE_BIN_LABELS)
from offerlens.sources import fixtures as fx


def _case(col: str, mapping: dict, default: str | None = None) -> str:
    return fx._sql_case(col, mapping, default)


def _vocab(src: str, mapping: dict, other: str) -> str:
    targets = ", ".join(f"'{t}'" for t in sorted(set(mapping.values())))
    return (f"CASE WHEN {src} IS NULL THEN NULL ELSE coalesce({_case(src, mapping)}, "
            f"CASE WHEN {src} IN ({targets}) THEN {src} END, '{other}') END")


def xsum(x: str) -> str:
    """Exact (decimal) sum returned as double, as the Spark side."""
    return f"CAST(sum(CAST({x} AS DECIMAL(38, 10))) AS DOUBLE)"


def rsql(x: str, d: int = 6) -> str:
    """Rounded double without negative zero."""
    return f"(CASE WHEN round({x}, {d}) = 0 THEN 0.0::DOUBLE ELSE round({x}, {d}) END)"


def _ln(x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN ln({x}) END"


AUDIT_OUTCOME_SQL = """
    SELECT organization_id, offer_id, new_value, old_value, updated_date, sent_out,
      CASE WHEN new_value = 'Invalidated' AND coalesce(old_value IN ('Customer Rejected', 'Customer Accepted', 'Offer with Customer'), false) THEN 'Rejected'
           WHEN new_value = 'Invalidated' THEN 'Invalidated Internally'
           WHEN new_value = 'Customer Rejected' THEN 'Rejected'
           WHEN new_value = 'Agreement Created' THEN 'Accepted'
           ELSE 'In Progress' END AS outcome
    FROM (
      SELECT organization_id, offer_id,
        arg_max(new_value, (updated_date, new_value, old_value)) FILTER (WHERE new_value IS NOT NULL) AS new_value,
        arg_max(old_value, (updated_date, new_value, old_value)) FILTER (WHERE old_value IS NOT NULL) AS old_value,
        arg_max(updated_date, (updated_date, new_value, old_value)) FILTER (WHERE updated_date IS NOT NULL) AS updated_date,
        CASE WHEN count(*) FILTER (WHERE new_value = 'Offer with Customer') > 0
             THEN count(*) FILTER (WHERE new_value = 'Offer with Customer') END AS sent_out
      FROM (SELECT DISTINCT organization_id, offer_id, created_date, updated_date, old_value, new_value FROM f_audit) a
      WHERE offer_id IS NOT NULL
      GROUP BY organization_id, offer_id) g
    WHERE sent_out IS NOT NULL"""


def feature_ctes(outcome_source: str = "orders") -> list[tuple[str, str]]:
    outcome = ("SELECT organization_id, offer_id, outcome, sent_out, new_value, old_value FROM f_orders_outcome"
               if outcome_source == "orders" else
               f"SELECT organization_id, offer_id, outcome, sent_out, new_value, old_value FROM ({AUDIT_OUTCOME_SQL}) ao")
    shares_sum = ",\n".join(
        [f"{xsum(f"CASE WHEN product_domain = '{d}' THEN published_revenue_shp END")} AS s_{n}"
         for d, n in DOMAIN_SHARE_COLUMNS.items()]
        + [f"{xsum(f"CASE WHEN product_mix = '{m}' THEN published_revenue_shp END")} AS s_{n}"
           for m, n in MIX_SHARE_COLUMNS.items()])
    shares = ",\n".join(
        f"coalesce(s_{n} / CASE WHEN offer_published_revenue <> 0 THEN offer_published_revenue END, 0.0::DOUBLE) AS {n}"
        for n in list(DOMAIN_SHARE_COLUMNS.values()) + list(MIX_SHARE_COLUMNS.values()))
    ecomm = ", ".join(f"'{c}'" for c in ECOMM_CHANNELS)
    labels = ", ".join(f"'{v}'" for v in REVENUE_BIN_LABELS)
    edges = " + ".join(f"CAST({i} * (q / 5.0::DOUBLE) <= offer_published_revenue AS INTEGER)" for i in range(1, 5))
    return [
        ("p_lines", f"""
            SELECT organization_id, offer_id, gsfa_customer_id,
                   product_cluster AS product_cluster_shp, created_date AS created_date_shp,
                   last_updated_date AS updated_date_shp,
                   CASE WHEN published_revenue <> 0 THEN published_revenue END AS published_revenue_shp,
                   expected_revenue AS expected_revenue_shp, recommended_revenue AS recommended_revenue_shp,
                   shipments AS shipments_shp, wps AS wps_shp, selected_pid_name AS selected_pid_name_shp,
                   {rsql("100.0::DOUBLE - 100.0::DOUBLE * expected_revenue / CASE WHEN published_revenue <> 0 THEN published_revenue END")} AS discount_shp
            FROM f_lines"""),
        ("p_offers", """
            SELECT organization_id, offer_id, gsfa_customer_id, opportunity_id,
                   creation_date AS created_date_off, updated_date AS updated_date_off,
                   (epoch_us(updated_date) - epoch_us(creation_date)) / 86400000000.0::DOUBLE AS time_taken
            FROM (SELECT DISTINCT * FROM f_offers) o"""),
        ("p_oppo", """
            SELECT DISTINCT organization_id, opportunity_id, gsfa_customer_id,
                   opportunity_type AS opportunity_type_oppo,
                   new_potential_revenue AS new_potential_revenue_oppo,
                   opportunity_tpr AS opportunity_tpr_oppo, reason_for_lead AS reason_for_lead_oppo,
                   lead_source_type AS lead_source_type_oppo, primary_competitor AS primary_competitor_oppo
            FROM f_opportunity"""),
        ("p_cust", """
            SELECT organization_id, gsfa_customer_id, loyalty_code AS loyalty_code_cust,
                   industry_code AS industry_code_cust, physical_channel AS physical_channel_cust,
                   reason_for_lead AS reason_for_lead_cust, lead_source_type AS lead_source_type_cust,
                   competitor AS competitor_cust
            FROM (SELECT DISTINCT * FROM f_customer) c"""),
        ("p_outcome", outcome),
        ("j_all", """
            SELECT l.*, o.opportunity_id, o.created_date_off, o.updated_date_off, o.time_taken,
                   op.opportunity_type_oppo, op.new_potential_revenue_oppo, op.opportunity_tpr_oppo,
                   op.reason_for_lead_oppo, op.lead_source_type_oppo, op.primary_competitor_oppo,
                   c.loyalty_code_cust, c.industry_code_cust, c.physical_channel_cust,
                   c.reason_for_lead_cust, c.lead_source_type_cust, c.competitor_cust,
                   oc.outcome, oc.sent_out, oc.new_value, oc.old_value
            FROM p_lines l
            LEFT JOIN p_offers o ON l.organization_id = o.organization_id AND l.offer_id = o.offer_id
                 AND l.gsfa_customer_id = o.gsfa_customer_id
            LEFT JOIN p_oppo op ON l.organization_id = op.organization_id
                 AND o.opportunity_id IS NOT DISTINCT FROM op.opportunity_id
                 AND l.gsfa_customer_id = op.gsfa_customer_id
            LEFT JOIN p_cust c ON l.organization_id = c.organization_id AND l.gsfa_customer_id = c.gsfa_customer_id
            LEFT JOIN p_outcome oc ON l.organization_id = oc.organization_id AND l.offer_id = oc.offer_id"""),
        ("e_lines", f"""
            SELECT * FROM (
              SELECT *, {_case('product_cluster_shp', PRODUCT_MIX, PRODUCT_MIX_OTHER)} AS product_mix,
                     {_case('product_cluster_shp', PRODUCT_DOMAIN, PRODUCT_DOMAIN_OTHER)} AS product_domain,
                     CAST(coalesce(discount_shp >= 0 AND discount_shp <= 100, false) AS INTEGER) AS valid_discount
              FROM j_all
              WHERE sent_out IS NOT NULL AND outcome IS DISTINCT FROM 'Invalidated Internally') x
            WHERE valid_discount = 1"""),
        ("o_rates", "SELECT from_currency, arg_max(rate_eur_ber, bill_per_dt) AS rate_eur FROM f_rates GROUP BY from_currency"),
        ("o_orgs", """
            SELECT c.organization_id, (c.dom_cur IS DISTINCT FROM c.int_cur) AS dual_currency,
                   d.rate_eur / i.rate_eur AS ex_rate_dom2int
            FROM f_countries c LEFT JOIN o_rates i ON c.int_cur = i.from_currency
            LEFT JOIN o_rates d ON c.dom_cur = d.from_currency"""),
        ("c_lines", """
            SELECT e.* REPLACE (
              CASE WHEN coalesce(g.dual_currency, false) AND e.product_domain = 'DOM'
                   THEN e.published_revenue_shp / g.ex_rate_dom2int ELSE e.published_revenue_shp END AS published_revenue_shp,
              CASE WHEN coalesce(g.dual_currency, false) AND e.product_domain = 'DOM'
                   THEN e.recommended_revenue_shp / g.ex_rate_dom2int ELSE e.recommended_revenue_shp END AS recommended_revenue_shp,
              CASE WHEN coalesce(g.dual_currency, false) AND e.product_domain = 'DOM'
                   THEN e.expected_revenue_shp / g.ex_rate_dom2int ELSE e.expected_revenue_shp END AS expected_revenue_shp)
            FROM e_lines e LEFT JOIN o_orgs g ON e.organization_id = g.organization_id"""),
        ("o_level0", f"""
            SELECT organization_id, offer_id,
                   coalesce({xsum('expected_revenue_shp')}, 0.0::DOUBLE) AS offer_expected_revenue,
                   coalesce({xsum('published_revenue_shp')}, 0.0::DOUBLE) AS offer_published_revenue,
                   coalesce({xsum('recommended_revenue_shp')}, 0.0::DOUBLE) AS offer_recommended_revenue,
                   count(DISTINCT product_cluster_shp) AS offer_products,
                   max(CAST(selected_pid_name_shp = 'CustomPID' AS INTEGER)) AS has_custom_pid,
                   {shares_sum}
            FROM c_lines WHERE organization_id IS NOT NULL AND offer_id IS NOT NULL GROUP BY organization_id, offer_id"""),
        ("o_level", f"""
            SELECT organization_id, offer_id, offer_expected_revenue, offer_published_revenue, offer_recommended_revenue,
                   offer_products, has_custom_pid, {shares},
                   {_ln('offer_published_revenue')} AS log_offer_published_revenue,
                   100.0::DOUBLE * (1.0::DOUBLE - offer_expected_revenue
                       / CASE WHEN offer_published_revenue <> 0 THEN offer_published_revenue END) AS offer_discount
            FROM o_level0"""),
        ("l_lines", f"""
            SELECT * REPLACE (sh AS shipments_shp, wp AS wps_shp, pot AS new_potential_revenue_oppo, tpr AS opportunity_tpr_oppo,
                              {_vocab('competitor_cust', fx.COMPETITOR_MAP, 'COMP:OTHER')} AS competitor_cust),
                   sh * wp AS weight,
                   {_ln('sh')} AS log_shipments, {_ln('wp')} AS log_wps, {_ln('sh * wp')} AS log_weight,
                   {_ln('discount_shp')} AS log_discount,
                   {_ln('published_revenue_shp')} AS log_published_revenue,
                   {_ln('published_revenue_shp')} * {_ln('published_revenue_shp')} AS log_published_revenue_sq,
                   {_ln('pot')} AS log_potential_revenue, {_ln('tpr')} AS log_potential_revenue_tpr,
                   CAST(coalesce(lower(physical_channel_cust) IN ({ecomm}), false) AS INTEGER) AS ecomm,
                   {_vocab('reason_for_lead_oppo', fx.LEAD_MAP, 'LEAD:OTHER')} AS lead_oppo,
                   {_vocab('reason_for_lead_cust', fx.LEAD_MAP, 'LEAD:OTHER')} AS lead_cust,
                   {_vocab('lead_source_type_oppo', fx.INITIATOR_MAP, 'INIT:?')} AS initiator_oppo,
                   {_vocab('lead_source_type_cust', fx.INITIATOR_MAP, 'INIT:?')} AS initiator_cust,
                   {_vocab('primary_competitor_oppo', fx.COMPETITOR_MAP, 'COMP:OTHER')} AS competitor_oppo,
                   CASE WHEN 'IND:' || substr(coalesce(industry_code_cust, 'NODATA'), 1, 4) <> 'IND:NODA'
                        THEN 'IND:' || substr(coalesce(industry_code_cust, 'NODATA'), 1, 4) END AS industry
            FROM (SELECT c.*, o.* EXCLUDE (organization_id, offer_id),
                         CASE WHEN shipments_shp <> 0 THEN shipments_shp END AS sh,
                         CASE WHEN wps_shp <> 0 THEN wps_shp END AS wp,
                         CASE WHEN new_potential_revenue_oppo <> 0 THEN new_potential_revenue_oppo END AS pot,
                         CASE WHEN opportunity_tpr_oppo <> 0 THEN opportunity_tpr_oppo END AS tpr
                  FROM c_lines c LEFT JOIN o_level o ON c.organization_id = o.organization_id AND c.offer_id = o.offer_id) x"""),
        ("f_lines2", """
            SELECT * EXCLUDE (sh, wp, pot, tpr, has_custom_pid) FROM l_lines
            WHERE fraction_other = 0
              AND NOT coalesce(has_custom_pid = 1 AND expected_revenue_shp = 0, false)"""),
        ("w_order", """
            SELECT organization_id, opportunity_id, offer_id,
                   CAST(row_number() OVER (PARTITION BY organization_id, opportunity_id ORDER BY c ASC NULLS LAST, offer_id) AS INTEGER) AS order_in_oppo,
                   count(*) OVER (PARTITION BY organization_id, opportunity_id) AS offers_in_oppo
            FROM (SELECT organization_id, opportunity_id, offer_id, min(created_date_off) AS c FROM f_lines2
                  WHERE opportunity_id IS NOT NULL AND offer_id IS NOT NULL GROUP BY 1, 2, 3) t"""),
        ("w_final", """
            SELECT organization_id, opportunity_id, product_cluster_shp,
              arg_max(outcome, (created_date_off IS NULL, coalesce(created_date_off, TIMESTAMP '1900-01-01'), offer_id, coalesce(discount_shp, -1.0::DOUBLE)))
                FILTER (WHERE outcome IS NOT NULL) AS final_outcome,
              arg_max(discount_shp, (created_date_off IS NULL, coalesce(created_date_off, TIMESTAMP '1900-01-01'), offer_id, coalesce(discount_shp, -1.0::DOUBLE)))
                FILTER (WHERE discount_shp IS NOT NULL) AS final_discount_shp
            FROM f_lines2 WHERE opportunity_id IS NOT NULL AND product_cluster_shp IS NOT NULL
            GROUP BY 1, 2, 3"""),
        ("w_q", """
            SELECT organization_id, quantile_cont(offer_published_revenue, 0.95) AS q
            FROM (SELECT DISTINCT organization_id, offer_id, offer_published_revenue FROM f_lines2) d
            GROUP BY organization_id"""),
        ("features", f"""
            SELECT f.*, w.order_in_oppo, w.offers_in_oppo,
                   CASE WHEN w.offers_in_oppo = w.order_in_oppo THEN 'final' ELSE 'interim' END AS finality,
                   s.final_outcome, s.final_discount_shp,
                   CASE WHEN offer_published_revenue >= 0 AND offer_published_revenue < q
                        THEN list_extract([{labels}], 1 + {edges}) END AS revenue_bin,
                   100.0::DOUBLE - 100.0::DOUBLE * recommended_revenue_shp
                       / CASE WHEN published_revenue_shp <> 0 THEN published_revenue_shp END AS discount_oms,
                   discount_shp - (100.0::DOUBLE - 100.0::DOUBLE * recommended_revenue_shp
                       / CASE WHEN published_revenue_shp <> 0 THEN published_revenue_shp END) AS discount_delta
            FROM f_lines2 f
            LEFT JOIN w_order w ON f.organization_id = w.organization_id AND f.opportunity_id = w.opportunity_id AND f.offer_id = w.offer_id
            LEFT JOIN w_final s ON f.organization_id = s.organization_id AND f.opportunity_id = s.opportunity_id AND f.product_cluster_shp = s.product_cluster_shp
            LEFT JOIN w_q q ON f.organization_id = q.organization_id"""),
    ]


def with_features(outcome_source: str = "orders", *extra: tuple[str, str]) -> str:
    return fx.fixture_ctes(*feature_ctes(outcome_source), *extra)


def master_ctes() -> list[tuple[str, str]]:
    """Master table (keep list + ids, numerics as double), target, modelling
    filter, train/test windows -- as SQL."""
    from offerlens.plans.master import MASTER_COLUMNS, NUMERIC, TEST_WINDOW, TRAIN_WINDOW
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in NUMERIC else c for c in MASTER_COLUMNS)
    return [
        ("master", f"SELECT DISTINCT {cols}, offer_id, gsfa_customer_id FROM features"),
        ("targeted", """
            SELECT *, CASE WHEN final_outcome = 'Accepted' THEN 1
                           WHEN final_outcome = 'Rejected' THEN 0
                           WHEN final_outcome IS NULL OR final_outcome = 'In Progress' THEN CAST(NULL AS INTEGER)
                           ELSE CAST(error('Unknown final outcome: ' || final_outcome) AS INTEGER) END AS accepted
            FROM master"""),
        ("modelling", """
            SELECT * FROM targeted
            WHERE discount_shp <= 99 AND discount_shp >= 0 AND accepted IS NOT NULL"""),
        ("train", f"""
            SELECT * FROM modelling WHERE created_date_off >= TIMESTAMP '{TRAIN_WINDOW[0]}'
              AND created_date_off < TIMESTAMP '{TRAIN_WINDOW[1]}'"""),
        ("test", f"""
            SELECT * FROM modelling WHERE created_date_off >= TIMESTAMP '{TEST_WINDOW[0]}'
              AND created_date_off < TIMESTAMP '{TEST_WINDOW[1]}'"""),
    ]


def with_modelling(*extra: tuple[str, str]) -> str:
    return fx.fixture_ctes(*feature_ctes("orders"), *master_ctes(), *extra)


def md5_unit_sql(*exprs: str) -> str:
    """SQL twin of ``functions.exprs.md5_unit``."""
    s = "concat_ws('|', " + ", ".join(f"CAST({e} AS VARCHAR)" for e in exprs) + ")"
    return f"(CAST(('0x' || substr(md5({s}), 1, 13)) AS BIGINT)::DOUBLE / 4503599627370496.0::DOUBLE)"
