"""Raw tables -> one feature table ("master") for all organizations at once.

and does every step eagerly in memory; here the whole chain is one lazy plan
keyed by ``organization_id``/``offer_id``.  The small entities are joined to
the offers first and the lines meet them where they lie by offer, so a line is
shuffled once by offer and once by opportunity.  Offer- and opportunity-level
values are windows over the rows that lie together there (rows of a window
spill, none are kept in memory as a whole).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerlens.functions.exprs import (add_suffix, bool_int, days_between, discount_pct,
                                       exact_decimal_sum, last_non_null, lookup, lower_columns, nullif_zero,
                                       safe_ln, vocab_map)
from offerlens.functions.running import exact_quantiles
from offerlens.functions.sizing import checked_broadcast
from offerlens.session import stage

# Product mix and domain vocabularies of the reference.
PRODUCT_MIX = {
    "TDExport": "PROD.MIX:TDEXPORT",
    "TDImport": "PROD.MIX:TDIMPORT",
    "TD3rd": "PROD.MIX:TD3RD",
    "DDExport": "PROD.MIX:DDEXPORT",
    "DDImport": "PROD.MIX:DDIMPORT",
    "DD3rd": "PROD.MIX:DD3RD",
    "TDDom": "PROD.MIX:TDDOM",
    "TD3rdDom": "PROD.MIX:TD3DOM",
}
PRODUCT_MIX_OTHER = "PROD.MIX:OTHER"
PRODUCT_DOMAIN = {
    "TDExport": "TDI", "TDImport": "TDI", "TD3rd": "TDI",
    "TDDom": "DOM", "TD3rdDom": "DOM",
    "DDExport": "DDI", "DDImport": "DDI", "DD3rd": "DDI",
}
PRODUCT_DOMAIN_OTHER = "OTHER"
DOMAIN_SHARE_COLUMNS = {"TDI": "fraction_tdi", "DDI": "fraction_ddi",
                        "DOM": "fraction_dom", "OTHER": "fraction_other"}
# Rename of the mix shares used by the master table (PROD.MIX:X -> prod_mix_x).
MIX_SHARE_COLUMNS = {
    "PROD.MIX:TDEXPORT": "prod_mix_tdexport",
    "PROD.MIX:TDIMPORT": "prod_mix_tdimport",
    "PROD.MIX:TD3RD": "prod_mix_td3rd",
    "PROD.MIX:DDEXPORT": "prod_mix_ddexport",
    "PROD.MIX:DDIMPORT": "prod_mix_ddimport",
    "PROD.MIX:DD3RD": "prod_mix_dd3rd",
    "PROD.MIX:TDDOM": "prod_mix_tddom",
    "PROD.MIX:TD3DOM": "prod_mix_td3dom",
    "PROD.MIX:OTHER": "prod_mix_other",
}
ECOMM_CHANNELS = ["e-commerce", "b2c e-commerce", "b2b e-commerce"]
REVENUE_BIN_LABELS = ["low", "mid-low", "medium", "mid-high", "high"]
STATUS_SENT = "Offer with Customer"
OUTCOME_INVALIDATED = "Invalidated Internally"   # offer withdrawn by the seller
OFFER_DROP_COLUMNS = ["customer_id", "offer_row_id", "aag_id", "cpa_id", "composite_id",
                      "bpm_integration_id"]


@dataclass
class FeatureParams:
    lead_map: Mapping[str, str] = field(default_factory=dict)
    initiator_map: Mapping[str, str] = field(default_factory=dict)
    competitor_map: Mapping[str, str] = field(default_factory=dict)
    revenue_quantile: float = 0.95
    # None = exact percentile (parity); an int = approx_percentile accuracy,
    # mergeable and bounded in memory for organizations of any size.
    percentile_accuracy: int | None = None
    convert_tdi_recommended: bool = False   # P15 optional scratch-cell variant
    max_broadcast_rows: int = 200_000


# ---------------------------------------------------------------------------
# Entity preparation
# ---------------------------------------------------------------------------

def prepare_offers(offers: DataFrame) -> DataFrame:
    df = offers.withColumnRenamed("creation_date", "created_date")
    df = lower_columns(df)
    df = df.drop(*[c for c in OFFER_DROP_COLUMNS if c in df.columns]).dropDuplicates()
    df = add_suffix(df, "_off", ["organization_id", "offer_id", "gsfa_customer_id", "opportunity_id"])
    return df.withColumn("time_taken", days_between("updated_date_off", "created_date_off"))


def prepare_opportunity(oppo: DataFrame) -> DataFrame:
    df = lower_columns(oppo).dropDuplicates()
    return add_suffix(df, "_oppo", ["organization_id", "opportunity_id", "gsfa_customer_id"])


def prepare_customer(customer: DataFrame) -> DataFrame:
    df = lower_columns(customer).dropDuplicates()
    df = add_suffix(df, "_cust", ["organization_id", "gsfa_customer_id"])
    return df.drop("customer_name_cust")


def prepare_lines(lines: DataFrame) -> DataFrame:
    """Shipment profile: not de-duplicated (the reference drops the result of
    its de-duplication call)."""
    df = lower_columns(lines).withColumnRenamed("last_updated_date", "updated_date")
    df = df.withColumn("published_revenue", nullif_zero("published_revenue"))
    df = df.withColumn("discount", discount_pct("expected_revenue", "published_revenue"))
    return add_suffix(df, "_shp", ["organization_id", "offer_id", "gsfa_customer_id"])


# ---------------------------------------------------------------------------
# Audit log -> outcome per offer (A2, A3, A4)
# ---------------------------------------------------------------------------

# ids repeat between organizations: every offer key carries the organization
OFFER = ["organization_id", "offer_id"]


def outcome_rule(new_value: Column, old_value: Column) -> Column:
    """A4: later rules overwrite earlier ones in the reference; as a CASE the
    most specific rule comes first."""
    rejected_before = old_value.isin("Customer Rejected", "Customer Accepted", STATUS_SENT)
    return (F.when((new_value == "Invalidated") & F.coalesce(rejected_before, F.lit(False)), "Rejected")
             .when(new_value == "Invalidated", OUTCOME_INVALIDATED)
             .when(new_value == "Customer Rejected", "Rejected")
             .when(new_value == "Agreement Created", "Accepted")
             .otherwise("In Progress"))


def audit_outcome(audit: DataFrame, keep_unsent: bool = False) -> DataFrame:
    """Last status per offer (last non-NULL value per column in the order
    ``updated_date, new_value``), number of "sent out" rows (NULL if none),
    outcome by rule.  One mergeable aggregation keyed by (organization, offer)."""
    a = lower_columns(audit)
    a = a.drop(*[c for c in ["contactrole"] if c in a.columns]).dropDuplicates()
    a = a.filter(F.col("offer_id").isNotNull())
    order = [F.col("updated_date"), F.col("new_value"), F.col("old_value")]
    g = a.groupBy(*OFFER).agg(
        last_non_null("new_value", *order).alias("new_value"),
        last_non_null("old_value", *order).alias("old_value"),
        last_non_null("updated_date", *order).alias("updated_date"),
        F.count_if(F.col("new_value") == STATUS_SENT).alias("n_sent"),
    )
    g = g.withColumn("sent_out", F.when(F.col("n_sent") > 0, F.col("n_sent"))).drop("n_sent")
    g = g.withColumn("outcome", outcome_rule(F.col("new_value"), F.col("old_value")))
    if not keep_unsent:
        g = g.filter(F.col("sent_out").isNotNull())
    return g


# ---------------------------------------------------------------------------
# Organizations dimension
# ---------------------------------------------------------------------------

def latest_rates(rates: DataFrame) -> DataFrame:
    """Latest EUR rate per currency that is not null; currency codes are trimmed."""
    known = F.when(F.col("rate_eur_ber").isNotNull(), F.col("bill_per_dt"))
    return rates.withColumn("from_currency", F.trim("from_currency")).groupBy("from_currency").agg(
        F.max_by("rate_eur_ber", known).alias("rate_eur"),
        F.max("bill_per_dt").alias("rate_date"))


def organizations(countries: DataFrame, rates: DataFrame) -> DataFrame:
    """J8 + P21: countries joined twice to the latest rates; dual currency
    when the two currencies differ (NULL-safe: NULL differs from anything)."""
    lr = latest_rates(rates)
    i = lr.select(F.col("from_currency").alias("int_cur"), F.col("rate_eur").alias("int2eur"))
    d = lr.select(F.col("from_currency").alias("dom_cur"), F.col("rate_eur").alias("dom2eur"))
    org = countries.join(F.broadcast(i), "int_cur", "left").join(F.broadcast(d), "dom_cur", "left")
    return org.withColumns({
        "dual_currency": ~F.col("dom_cur").eqNullSafe(F.col("int_cur")),
        "ex_rate_dom2int": F.col("dom2eur") / F.col("int2eur"),
    })


# ---------------------------------------------------------------------------
# The chain
# ---------------------------------------------------------------------------

def _left_join(left: DataFrame, right: DataFrame, keys: list[str],
               null_safe: tuple[str, ...] = ()) -> DataFrame:
    """Left join on ``keys``; keys in ``null_safe`` match NULL to NULL (the
    reference's join semantics).  Spark still plans an equi-join."""
    if not null_safe:
        return left.join(right, keys, "left")
    r = right.toDF(*[f"__r_{c}" if c in keys else c for c in right.columns])
    cond = None
    for k in keys:
        c = (F.col(k).eqNullSafe(F.col(f"__r_{k}")) if k in null_safe
             else F.col(k) == F.col(f"__r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left").drop(*[f"__r_{k}" for k in keys])


def join_entities(lines: DataFrame, offers: DataFrame, oppo: DataFrame, customer: DataFrame,
                  outcome: DataFrame) -> DataFrame:
    """J1-J4 on prepared entities."""
    step1 = _left_join(prepare_lines(lines), prepare_offers(offers),
                       ["organization_id", "offer_id", "gsfa_customer_id"])
    step2 = _left_join(step1, prepare_opportunity(oppo),
                       ["organization_id", "opportunity_id", "gsfa_customer_id"],
                       null_safe=("opportunity_id",))
    step3 = _left_join(step2, prepare_customer(customer), ["organization_id", "gsfa_customer_id"])
    out = outcome.select(*OFFER, "outcome", "sent_out", "new_value", "old_value")
    return step3.join(out, OFFER, "left")


NO_OFFER = "__no_offer"


def join_by_offer(lines: DataFrame, offers: DataFrame, oppo: DataFrame, customer: DataFrame,
                  outcome: DataFrame) -> DataFrame:
    """J1-J4 for lines whose offer is known: opportunity and customer join the
    offers, and only the result meets the lines, which stay where the last
    join by offer put them.  A line without its offer has ``NO_OFFER`` set and
    only the outcome; its customer is found by ``join_entities``."""
    by_customer = "gsfa_customer_id"
    entities = _left_join(prepare_offers(offers), prepare_customer(customer), ["organization_id", by_customer])
    entities = _left_join(entities, prepare_opportunity(oppo), ["organization_id", "opportunity_id", by_customer],
                          null_safe=("opportunity_id",))
    df = _matches_by_offer(prepare_lines(lines), entities, ["organization_id", by_customer], "__known")
    out = outcome.select(*OFFER, "outcome", "sent_out", "new_value", "old_value")
    df = _matches_by_offer(df, out, ["organization_id"], "__outcome")
    return df.withColumn(NO_OFFER, F.col("__known").isNull()).drop("__known", "__outcome")


def _matches_by_offer(df: DataFrame, right: DataFrame, keys: list[str], found: str) -> DataFrame:
    """Left join on ``offer_id`` and ``keys`` whose shuffle is by ``offer_id``
    alone (rows that already lie by offer stay there): the few rows of an id
    come as one array, of which a row takes those with its own keys."""
    cols = [c for c in right.columns if c not in ("offer_id", *keys)]
    rows = right.groupBy("offer_id").agg(F.collect_list(F.struct(*keys, *cols)).alias("__rows"))
    own = F.filter("__rows", lambda r: reduce(Column.__and__, [r[k] == F.col(k) for k in keys]))
    df = df.join(rows, "offer_id", "left").withColumn(found, F.explode_outer(own)).drop("__rows")
    return df.select(*[c for c in df.columns], *[F.col(found)[c].alias(c) for c in cols])


def product_groups(df: DataFrame) -> DataFrame:
    """Mix and domain of the product cluster."""
    return df.withColumns({
        "product_mix": lookup("product_cluster_shp", PRODUCT_MIX, PRODUCT_MIX_OTHER),
        "product_domain": lookup("product_cluster_shp", PRODUCT_DOMAIN, PRODUCT_DOMAIN_OTHER),
    })


def enrich_lines(df: DataFrame) -> DataFrame:
    """F7, P11, P10, F8."""
    df = df.filter(F.col("sent_out").isNotNull() & ~F.col("outcome").eqNullSafe(OUTCOME_INVALIDATED))
    df = product_groups(df).withColumns({
        "empty_exp": F.col("expected_revenue_shp").isNull().cast("int"),
        "empty_pub": F.col("published_revenue_shp").isNull().cast("int"),
    })
    df = df.withColumns({
        "empty_any": F.col("empty_exp").bitwiseOR(F.col("empty_pub")),
        "empty_all": F.col("empty_exp").bitwiseAND(F.col("empty_pub")),
        "valid_discount": bool_int(F.col("discount_shp").between(0, 100)),
    })
    return df.filter(F.col("valid_discount") == 1)


def currency_adjust(df: DataFrame, orgs: DataFrame, convert_tdi_recommended: bool = False,
                    max_broadcast_rows: int = 200_000) -> DataFrame:
    """For dual-currency organizations divide DOM revenues by the rate."""
    o = orgs.select("organization_id", "dual_currency", "ex_rate_dom2int")
    df = df.join(checked_broadcast(o, max_broadcast_rows), "organization_id", "left")
    dual = F.coalesce(F.col("dual_currency"), F.lit(False))
    dom = dual & (F.col("product_domain") == "DOM")
    cols = {c: F.when(dom, F.col(c) / F.col("ex_rate_dom2int")).otherwise(F.col(c))
            for c in ["published_revenue_shp", "recommended_revenue_shp", "expected_revenue_shp"]}
    if convert_tdi_recommended:
        tdi = dual & (F.col("product_domain") == "TDI")
        cols["recommended_revenue_shp"] = (F.when(dom | tdi, F.col("recommended_revenue_shp") / F.col("ex_rate_dom2int"))
                                           .otherwise(F.col("recommended_revenue_shp")))
    return df.withColumns(cols).drop("dual_currency", "ex_rate_dom2int")


def offer_level(df: DataFrame) -> DataFrame:
    """A5 + A6 + F10 flag per offer, on each of its lines.

    Exact sums over the lines of an offer, which lie together after the joins
    by offer: no further shuffle, no second reading of the lines.  Sums of an
    all-NULL group are 0 (pandas); shares are sum per category / offer sum, 0
    when undefined.  Lines without organization or offer have no sums."""
    w = Window.partitionBy(*OFFER)
    keyed = F.col("organization_id").isNotNull() & F.col("offer_id").isNotNull()

    def total_of(c) -> Column:
        return exact_decimal_sum(c).over(w).cast("double")

    pub = F.col("published_revenue_shp")
    sums = {f"offer_{c}_revenue": F.coalesce(total_of(f"{c}_revenue_shp"), F.lit(0.0)) for c in ("expected", "published", "recommended")}
    sums["offer_products"] = F.size(F.collect_set("product_cluster_shp").over(w)).cast("bigint")
    sums["has_custom_pid"] = F.max((F.col("selected_pid_name_shp") == "CustomPID").cast("int")).over(w)
    shares = {name: total_of(F.when(F.col("product_domain") == d, pub)) for d, name in DOMAIN_SHARE_COLUMNS.items()}
    shares.update({name: total_of(F.when(F.col("product_mix") == m, pub)) for m, name in MIX_SHARE_COLUMNS.items()})
    df = df.withColumns({**sums, **shares})
    total = F.when(F.col("offer_published_revenue") != 0, F.col("offer_published_revenue"))
    df = df.withColumns({name: F.coalesce(F.col(name) / total, F.lit(0.0)) for name in shares})
    return df.withColumns({c: F.when(keyed, F.col(c)) for c in [*sums, *shares]})


def offer_logs(df: DataFrame) -> DataFrame:
    """P6 + A5 on the offer sums."""
    total = F.when(F.col("offer_published_revenue") != 0, F.col("offer_published_revenue"))
    return df.withColumns({
        "log_offer_published_revenue": safe_ln("offer_published_revenue"),
        "offer_discount": F.lit(100.0) * (F.lit(1.0) - F.col("offer_expected_revenue") / total),
    })


def log_features(df: DataFrame) -> DataFrame:
    """P6 + P8 + P14."""
    df = df.withColumns({
        "shipments_shp": nullif_zero("shipments_shp"),
        "wps_shp": nullif_zero("wps_shp"),
        "new_potential_revenue_oppo": nullif_zero("new_potential_revenue_oppo"),
        "opportunity_tpr_oppo": nullif_zero("opportunity_tpr_oppo"),
    })
    df = df.withColumn("weight", F.col("shipments_shp") * F.col("wps_shp"))
    df = df.withColumns({
        "log_shipments": safe_ln("shipments_shp"),
        "log_wps": safe_ln("wps_shp"),
        "log_weight": safe_ln("weight"),
        "log_discount": safe_ln("discount_shp"),
        "log_published_revenue": safe_ln("published_revenue_shp"),
        "log_potential_revenue": safe_ln("new_potential_revenue_oppo"),
        "log_potential_revenue_tpr": safe_ln("opportunity_tpr_oppo"),
    })
    df = df.withColumn("log_published_revenue_sq",
                       F.col("log_published_revenue") * F.col("log_published_revenue"))
    return df.withColumn("ecomm", bool_int(F.lower("physical_channel_cust").isin(ECOMM_CHANNELS)))


def map_categoricals(df: DataFrame, p: FeatureParams) -> DataFrame:
    """P12 + P13."""
    ind = F.concat(F.lit("IND:"), F.substring(F.coalesce(F.col("industry_code_cust"), F.lit("NODATA")), 1, 4))
    return df.withColumns({
        "lead_oppo": vocab_map("reason_for_lead_oppo", p.lead_map, "LEAD:OTHER"),
        "lead_cust": vocab_map("reason_for_lead_cust", p.lead_map, "LEAD:OTHER"),
        "initiator_oppo": vocab_map("lead_source_type_oppo", p.initiator_map, "INIT:?"),
        "initiator_cust": vocab_map("lead_source_type_cust", p.initiator_map, "INIT:?"),
        "competitor_oppo": vocab_map("primary_competitor_oppo", p.competitor_map, "COMP:OTHER"),
        "competitor_cust": vocab_map("competitor_cust", p.competitor_map, "COMP:OTHER"),
        "industry": F.when(ind != "IND:NODA", ind),
    })


def final_filters(df: DataFrame, spare: Column | None = None) -> DataFrame:
    """F9 + F10; rows that meet ``spare`` stay."""
    drop = (F.col("has_custom_pid") == 1) & (F.col("expected_revenue_shp") == 0)
    keep = (F.col("fraction_other") == 0) & ~F.coalesce(drop, F.lit(False))
    return df.filter(keep if spare is None else keep | spare).drop("has_custom_pid")


OPPORTUNITY = ["organization_id", "opportunity_id"]


def opportunity_order(df: DataFrame) -> DataFrame:
    """W1 + A7: position of the line's offer among the offers of its
    opportunity, and their number, as ``order_in_oppo`` and
    ``offers_in_oppo``.  Ties on the creation date break on ``offer_id``.
    Rows without opportunity or offer have neither.  One shuffle by
    opportunity, shared with ``final_status``."""
    w = Window.partitionBy(*OPPORTUNITY)
    keyed = F.col("opportunity_id").isNotNull() & F.col("offer_id").isNotNull()
    df = df.withColumn("__created", F.min("created_date_off").over(Window.partitionBy(*OPPORTUNITY, "offer_id")))
    order = w.orderBy(F.col("offer_id").isNull(), F.col("__created").asc_nulls_last(), "offer_id")
    df = df.withColumn("order_in_oppo", F.when(keyed, F.dense_rank().over(order))).drop("__created")
    return df.withColumn("offers_in_oppo", F.when(keyed, F.max("order_in_oppo").over(w).cast("bigint")))


def final_status(df: DataFrame) -> DataFrame:
    """``final_outcome`` and ``final_discount_shp``, the last outcome and
    discount per (organization, opportunity, product cluster) by creation date
    (NULL dates last); none without opportunity or cluster."""
    created = F.col("created_date_off")
    order = [created.isNull(), F.coalesce(created, F.lit("1900-01-01").cast("timestamp_ntz")),
             F.col("offer_id"), F.coalesce(F.col("discount_shp"), F.lit(-1.0))]
    w = Window.partitionBy(*OPPORTUNITY, "product_cluster_shp")
    keyed = F.col("opportunity_id").isNotNull() & F.col("product_cluster_shp").isNotNull()
    return df.withColumns({"final_outcome": F.when(keyed, last_non_null("outcome", *order).over(w)),
                           "final_discount_shp": F.when(keyed, last_non_null("discount_shp", *order).over(w))})


def revenue_quantiles(df: DataFrame, quantile: float = 0.95, accuracy: int | None = None) -> DataFrame:
    """W4 edges: quantile of the distinct (offer, offer revenue) pairs per
    organization (one row per organization)."""
    pairs = df.select("organization_id", "offer_id", "offer_published_revenue").dropDuplicates()
    if accuracy is None:
        q = exact_quantiles(pairs, ["organization_id"], "offer_published_revenue", [quantile])
        return q.select("organization_id", F.col("quantiles")[0].alias("__q"))
    q = F.percentile_approx(F.col("offer_published_revenue"), F.lit(quantile), F.lit(accuracy))
    return pairs.groupBy("organization_id").agg(q.cast("double").alias("__q"))


def revenue_bin(x: Column, q: Column) -> Column:
    """Five equal-width bins on [0, q), left-closed; >= q -> NULL."""
    step = q / F.lit(5.0)
    n_edges_below = sum((F.lit(i) * step <= x).cast("int") for i in range(1, 5))
    label = F.element_at(F.array(*[F.lit(v) for v in REVENUE_BIN_LABELS]), n_edges_below + 1)
    return F.when((x >= 0) & (x < q), label)


def recommended_discount(df: DataFrame) -> DataFrame:
    """Discount implied by the recommended price and the difference."""
    pub = F.when(F.col("published_revenue_shp") != 0, F.col("published_revenue_shp"))
    df = df.withColumn("discount_oms", F.lit(100.0) - F.lit(100.0) * F.col("recommended_revenue_shp") / pub)
    return df.withColumn("discount_delta", F.col("discount_shp") - F.col("discount_oms"))


# raw columns that the steps after the offer-level filters read
LATE_INPUTS = ["organization_id", "offer_id", "opportunity_id", "gsfa_customer_id", "product_cluster_shp",
               "outcome", "created_date_off", "discount_shp", "published_revenue_shp", "recommended_revenue_shp",
               "shipments_shp", "wps_shp", "new_potential_revenue_oppo", "opportunity_tpr_oppo", "industry_code_cust",
               "physical_channel_cust", "reason_for_lead_oppo", "reason_for_lead_cust", "lead_source_type_oppo",
               "lead_source_type_cust", "primary_competitor_oppo", "competitor_cust", "offer_published_revenue",
               "offer_expected_revenue"]


def build_features(lines: DataFrame, offers: DataFrame, oppo: DataFrame, customer: DataFrame,
                   outcome: DataFrame, orgs: DataFrame | None = None,
                   params: FeatureParams | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """The whole archived preprocessing chain, once for all organizations;
    ``keep`` names the wanted columns (all by default).

    One stage boundary (Parquet in the shared checkpoint folder) sits where
    the plan branches, after the offer-level filters, and holds only the
    columns that are still read.  Order in opportunity and final status come
    from one shuffle of that stage by opportunity, the revenue quantiles are
    an aggregate of it; logs and vocabularies are computed at the end.  Where a line names an
    offer with another customer, or none, the joins of ``join_entities`` take
    the place of those by offer."""
    p = params or FeatureParams()

    def filtered(df: DataFrame) -> DataFrame:
        df = enrich_lines(df)
        if orgs is not None:
            df = currency_adjust(df, orgs, p.convert_tdi_recommended, p.max_broadcast_rows)
        df = offer_level(df)
        if NO_OFFER in df.columns:
            df = final_filters(df, F.col(NO_OFFER))
        else:
            df = final_filters(df)
        df = df.drop("product_mix", "product_domain")
        return df if keep is None else df.select(*[c for c in df.columns if c in {NO_OFFER, *LATE_INPUTS, *keep}])

    st = stage(filtered(join_by_offer(lines, offers, oppo, customer, outcome)), "filtered_lines", fine=True)
    if st.filter(NO_OFFER).isEmpty():
        st = st.drop(NO_OFFER)
    else:
        st = stage(filtered(join_entities(lines, offers, oppo, customer, outcome)), "filtered_lines", fine=True)
    # rows without an opportunity stay out of the shuffle by opportunity
    known, unknown = (st.filter(c) for c in (F.col("opportunity_id").isNotNull(), F.col("opportunity_id").isNull()))
    out = final_status(opportunity_order(known)).unionByName(unknown, allowMissingColumns=True)
    quantiles = revenue_quantiles(st, p.revenue_quantile, p.percentile_accuracy)
    out = out.join(checked_broadcast(quantiles, p.max_broadcast_rows), "organization_id", "left")
    out = map_categoricals(log_features(offer_logs(product_groups(out))), p)
    out = out.withColumns({
        "finality": F.when(F.col("offers_in_oppo") == F.col("order_in_oppo"), "final").otherwise("interim"),
        "revenue_bin": revenue_bin(F.col("offer_published_revenue"), F.col("__q")),
    }).drop("__q")
    out = recommended_discount(out)
    return out if keep is None else out.select(*keep)
