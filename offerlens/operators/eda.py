"""Exploratory statistics as tables.

Every all-column statistic is computed in one pass over an unpivoted
table (one aggregation for all columns), never one job per column.
p-values are column expressions (``functions.stats``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerlens.functions.exprs import pearson
from offerlens.functions.running import exact_quantiles, running_sums
from offerlens.functions.stats import chi2_survival, f_survival
from offerlens.session import stage

QUARTILES = [0.25, 0.5, 0.75]


def _unpivot_numeric(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(*keep, F.explode(arr).alias("__u")).select(*keep, "__u.column", "__u.value")


def _unpivot_string(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    return df.select(*keep, F.explode(arr).alias("__u")).select(*keep, "__u.column", "__u.value")


def numeric_summary(df: DataFrame, cols: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear interpolation),
    max per numeric column -- one aggregation for all columns, the quartiles
    by rank over ranges of (column, value)."""
    u = _unpivot_numeric(df, cols).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    if accuracy is None:
        qs = exact_quantiles(u, ["column"], "value", QUARTILES)
    else:
        qs = u.groupBy("column").agg(F.percentile_approx("value", F.array(*[F.lit(q) for q in QUARTILES]), accuracy).alias("quantiles"))
    g = u.groupBy("column").agg(F.count("*").alias("count"), F.avg("value").alias("mean"),
                                F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    g = g.join(F.broadcast(qs.withColumnRenamed("quantiles", "__q")), "column")  # one row per column
    return g.select("column", "count", "mean", "std", "min",
                    F.col("__q")[0].alias("p25"), F.col("__q")[1].alias("p50"),
                    F.col("__q")[2].alias("p75"), "max")


def categorical_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count (non-NULL), unique, top (most frequent; ties -> smallest
    value), freq."""
    u = _unpivot_string(df, cols).filter(F.col("value").isNotNull())
    vc = u.groupBy("column", "value").agg(F.count("*").alias("n"))
    return vc.groupBy("column").agg(
        F.sum("n").alias("count"), F.count("*").alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"))


def missing_values(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL (and NaN) count per column, only columns with any."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)

    def miss(c):
        isn = F.col(c).isNull()
        if types[c] in ("double", "float"):
            isn = isn | F.isnan(c)
        return F.sum(isn.cast("long")).alias(c)
    row = df.agg(*[miss(c) for c in cols])
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_missing")) for c in cols])
    out = row.select(F.explode(arr).alias("__m")).select("__m.column", "__m.n_missing")
    return out.filter(F.col("n_missing") > 0)


def histograms(df: DataFrame, cols: Sequence[str], n_bins: int = 10) -> DataFrame:
    """D3: equal-width histogram per numeric column between its min and max
    (the max falls in the last bin)."""
    u = _unpivot_numeric(df, cols).filter(F.col("value").isNotNull())
    rng = u.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    u = u.join(F.broadcast(rng), "column")  # one row per column
    width = (F.col("hi") - F.col("lo")) / F.lit(float(n_bins))
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(n_bins - 1))).cast("int")
    return u.groupBy("column", b.alias("bin")).agg(
        F.count("*").alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))


def value_frequencies(df: DataFrame, cols: Sequence[str], normalize: bool = True) -> DataFrame:
    """Value counts per column, NULL counted as a value, with the
    share of rows."""
    u = _unpivot_string(df, cols)
    vc = u.groupBy("column", "value").agg(F.count("*").alias("n"))
    if normalize:
        vc = vc.withColumn("share", F.col("n") / F.lit(float(df.count())))  # every row counts once per column
    return vc


def numeric_target_correlations(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of each numeric column with a numeric target,
    one aggregation."""
    row = df.agg(*[pearson(c, target).alias(c) for c in cols])
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("corr")) for c in cols])
    return row.select(F.explode(arr).alias("__c")).select("__c.column", "__c.corr")


def anova(df: DataFrame, value_cols: Sequence[str], group_col: str) -> DataFrame:
    """One-way ANOVA F statistic of each numeric column across the
    groups of ``group_col`` (NULL groups/values dropped).  Between and
    within sums of squares come from group means and group variances
    (numerically stable, no difference of large sums)."""
    u = _unpivot_numeric(df, value_cols, keep=[group_col]).withColumnRenamed(group_col, "__g")
    return _anova(u)


def anova_by_category(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """The same for a numeric target across the groups of each
    categorical column."""
    u = _unpivot_string(df.withColumn("__v", F.col(target).cast("double")), cols, keep=["__v"])
    return _anova(u.select("column", F.col("value").alias("__g"), F.col("__v").alias("value")))


def _anova(u: DataFrame) -> DataFrame:
    """One row per ``column`` of ``u(column, __g, value)``."""
    u = u.filter(F.col("value").isNotNull() & F.col("__g").isNotNull())
    g = u.groupBy("column", "__g").agg(F.count("*").alias("n"), F.avg("value").alias("m"),
                                       F.var_samp("value").alias("v"))
    mean = g.groupBy("column").agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("gm"))
    g = g.join(F.broadcast(mean), "column")  # one row per column
    t = g.groupBy("column").agg(
        F.count("*").alias("k"), F.sum("n").alias("N"),
        F.sum(F.col("n") * (F.col("m") - F.col("gm")) * (F.col("m") - F.col("gm"))).alias("ss_between"),
        F.sum(F.coalesce(F.col("v") * (F.col("n") - 1), F.lit(0.0))).alias("ss_within"))
    # undefined (NULL) for one group, constant groups, or as many groups as rows
    f = F.try_divide(F.try_divide("ss_between", F.col("k") - 1), F.try_divide("ss_within", F.col("N") - F.col("k")))
    t = t.select("column", "k", "N", "ss_between", "ss_within", f.alias("f_stat"),
                 (F.col("k") - 1).alias("df_between"), (F.col("N") - F.col("k")).alias("df_within"))
    return t.withColumn("p_value", f_survival(F.col("f_stat"), F.col("df_between"), F.col("df_within")))


def contingency_table(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Observed counts ``(column, value, target, o)`` of every
    categorical column against the target (NULLs dropped)."""
    u = _unpivot_string(df, cols, keep=[target]).filter(
        F.col("value").isNotNull() & F.col(target).isNotNull())
    return u.groupBy("column", "value", F.col(target).alias("target")).agg(F.count("*").alias("o"))


def _chi2_from_cells(cells: DataFrame, keys: Sequence[str], x: str, y: str, yates: bool) -> DataFrame:
    """Chi-square from the non-empty cells only: sum(o^2 / e) - n, with
    e = row * col / n.  Yates' 2x2 correction uses |o - e| (equal in all
    four cells) and sum over all cells of 1/e = n * sum(1/row) * sum(1/col).
    The cell table has one row per (category, class): no grid of empty
    cells is ever built."""
    k = list(keys)
    c = cells.withColumns({"__r": F.sum("o").over(Window.partitionBy(*k, x)),
                           "__c": F.sum("o").over(Window.partitionBy(*k, y)),
                           "__n": F.sum("o").over(Window.partitionBy(*k))})
    e = F.col("__r").cast("double") * F.col("__c") / F.col("__n")
    first_x = F.row_number().over(Window.partitionBy(*k, x).orderBy(y)) == 1
    first_y = F.row_number().over(Window.partitionBy(*k, y).orderBy(x)) == 1
    c = c.withColumns({"__e": e, "__fx": first_x, "__fy": first_y})
    g = c.groupBy(*k).agg(
        (F.sum(F.col("o").cast("double") * F.col("o") / F.col("__e")) - F.first("__n")).alias("chi2_raw"),
        F.first(F.abs(F.col("o") - F.col("__e"))).alias("__dd"),
        F.sum(F.when(F.col("__fx"), F.lit(1.0) / F.col("__r"))).alias("__sr"),
        F.sum(F.when(F.col("__fy"), F.lit(1.0) / F.col("__c"))).alias("__sc"),
        F.count_distinct(x).alias("r"), F.count_distinct(y).alias("c"), F.first("__n").alias("n"))
    dd = F.col("__dd") - F.least(F.lit(0.5), F.col("__dd"))
    yc = dd * dd * F.col("n") * F.col("__sr") * F.col("__sc")
    chi2 = F.when(F.lit(yates) & (F.col("r") == 2) & (F.col("c") == 2), yc).otherwise(F.col("chi2_raw"))
    return g.select(*k, chi2.alias("chi2"), "r", "c", "n", ((F.col("r") - 1) * (F.col("c") - 1)).alias("dof"),
                    "chi2_raw")


def contingency_chi2(df: DataFrame, cols: Sequence[str], target: str, yates: bool = True) -> DataFrame:
    """Chi-square statistic of each categorical column against a
    categorical target (Yates' continuity correction on 2x2 tables, as the
    reference's library does by default)."""
    cells = contingency_table(df, cols, target)
    c = _chi2_from_cells(cells, ["column"], "value", "target", yates).drop("chi2_raw")
    return c.withColumn("p_value", chi2_survival(F.col("chi2"), F.col("dof")))


def cramers_v(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """D6 nominal-nominal: bias-corrected Cramer's V per column pair from
    grouped counts (chi-square without continuity correction)."""
    parts = []
    for a, b in pairs:
        cells = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(
            F.col(a).cast("string").alias("x"), F.col(b).cast("string").alias("y")).agg(F.count("*").alias("o"))
        parts.append(cells.withColumns({"a": F.lit(a), "b": F.lit(b)}))
    cells = parts[0]
    for p in parts[1:]:
        cells = cells.unionByName(p)
    return _cramers_v(cells)


def _cramers_v(cells: DataFrame) -> DataFrame:
    """``(a, b, cramers_v)`` of ``cells(a, b, x, y, o)``."""
    g = _chi2_from_cells(cells, ["a", "b"], "x", "y", yates=False)
    phi2 = F.col("chi2") / F.col("n")
    n1 = F.when(F.col("n") > 1, F.col("n") - 1)
    phi2c = F.greatest(F.lit(0.0), phi2 - (F.col("r") - 1) * (F.col("c") - 1) / n1)
    rc = F.col("r") - (F.col("r") - 1) * (F.col("r") - 1) / n1
    cc = F.col("c") - (F.col("c") - 1) * (F.col("c") - 1) / n1
    den = F.least(rc - 1, cc - 1)
    return g.select("a", "b", F.when(den > 0, F.sqrt(phi2c / den)).alias("cramers_v"))


def correlation_ratio(df: DataFrame, cat_col: str, num_cols: Sequence[str]) -> DataFrame:
    """D6 nominal-numeric: eta = sqrt(SS_between / SS_total) per numeric."""
    a = anova(df, num_cols, cat_col)
    tot = F.col("ss_between") + F.col("ss_within")
    return a.select(F.lit(cat_col).alias("a"), F.col("column").alias("b"),
                    F.when(tot > 0, F.sqrt(F.col("ss_between") / tot)).otherwise(F.lit(0.0)).alias("eta"))


def pearson_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D6 numeric-numeric upper triangle in one aggregation, after one for the
    means.  Columns without NULLs need only the sums of their products about
    their means; a pair with NULLs has moments of its own rows."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    x = {c: F.col(c).cast("double") for c in cols}
    stats = df.agg(F.count("*").alias("n"), *[F.struct(F.count(x[c]).alias("n"), F.avg(x[c]).alias("mean")).alias(f"c{i}")
                                              for i, c in enumerate(cols)]).first()
    whole = {c: stats[f"c{i}"]["mean"] for i, c in enumerate(cols) if 0 < stats["n"] == stats[f"c{i}"]["n"]}
    d = {c: x[c] - F.lit(m) for c, m in whole.items()}
    n = F.lit(float(stats["n"]))

    def r(a: str, b: str) -> Column:
        if a not in whole or b not in whole:
            return pearson(a, b)
        co = lambda p, q: F.sum(d[p] * d[q]) / n - F.sum(d[p]) / n * (F.sum(d[q]) / n)
        differ = (F.min(x[a]) < F.max(x[a])) & (F.min(x[b]) < F.max(x[b]))
        return F.when(differ, F.try_divide(co(a, b), F.sqrt(co(a, a)) * F.sqrt(co(b, b))))

    row = df.agg(*[r(a, b).alias(f"{a}|{b}") for a, b in pairs])
    arr = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("r"))
                    for a, b in pairs])
    return row.select(F.explode(arr).alias("__p")).select("__p.a", "__p.b", "__p.r")


def association_matrix(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Association of every column pair, ``(a, b, kind, value)`` of the
    upper triangle: Pearson for two numeric columns, bias-corrected Cramer's V
    for two categorical ones, the correlation ratio for one of each.  Rows
    with a NULL in the pair are left out.

    Pearson is one aggregation.  The rows are counted once per combination of
    all categories, and the pairs of categories are counted from these.  For
    the correlation ratio a row counts once per categorical column, with the
    sums of all numeric ones and their squares less the column's mean (a
    constant column's value); the groups are categories, not rows."""
    text = {c: F.col(c).cast("string") for c in categorical}
    struct = lambda xs: F.array(*[F.struct(*[v.alias(k) for k, v in x.items()]) for x in xs])
    pairs = struct({"a": F.lit(a), "b": F.lit(b), "x": F.col(f"__{i}"), "y": F.col(f"__{j}")}
                   for i, a in enumerate(categorical) for j, b in enumerate(categorical) if i < j)
    parts = []
    if len(categorical) > 1:
        every = df.groupBy(*[text[c].alias(f"__{i}") for i, c in enumerate(categorical)]).agg(F.count("*").alias("__o"))
        cells = every.select("__o", F.explode(pairs).alias("__c")).select("__c.*", "__o").filter("x IS NOT NULL AND y IS NOT NULL")
        cells = stage(cells.groupBy("a", "b", "x", "y").agg(F.sum("__o").alias("o")), "associations")
        parts.append(_cramers_v(cells).select("a", "b", F.lit("cramers_v").alias("kind"), F.col("cramers_v").alias("value")))
    if categorical and numeric:
        x = {c: F.col(c).cast("double") for c in numeric}
        row = df.agg(*[F.struct(F.min(x[c]).alias("lo"), F.max(x[c]).alias("hi"), F.avg(x[c]).alias("m")).alias(f"c{i}")
                       for i, c in enumerate(numeric)]).first()
        about = {c: r["m"] if r["lo"] != r["hi"] else r["lo"] for c, r in ((c, row[f"c{i}"]) for i, c in enumerate(numeric))}
        rows = df.select(F.struct(*[(x[c] - F.lit(about[c]).cast("double")).alias(f"v{i}") for i, c in enumerate(numeric)]).alias("v"),
                         F.explode(struct({"a": F.lit(a), "x": text[a]} for a in categorical)).alias("c")).select("v.*", "c.*")
        v = [F.col(f"v{i}") for i in range(len(numeric))]
        sums = rows.filter("x IS NOT NULL").groupBy("a", "x").agg(*[f(y).alias(f"{k}{i}") for i, y in enumerate(v) for k, f in (
            ("n", F.count), ("s", F.sum), ("q", lambda y: F.sum(y * y)))])
        long = stage(sums.select("a", F.explode(struct({"b": F.lit(c), "n": F.col(f"n{i}"), "s": F.col(f"s{i}"), "q": F.col(f"q{i}")}
                                                       for i, c in enumerate(numeric))).alias("__n")).select("a", "__n.*").filter("n > 0"), "moments")
        mean = long.groupBy("a", "b").agg((F.sum("s") / F.sum("n")).alias("gm"))
        m = F.col("s") / F.col("n") - F.col("gm")
        ss = long.join(F.broadcast(mean), ["a", "b"]).groupBy("a", "b").agg(  # one row per pair
            F.sum(F.col("n") * m * m).alias("between"),
            F.sum(F.greatest(F.col("q") - F.col("s") * F.col("s") / F.col("n"), F.lit(0.0))).alias("within"))
        total = F.col("between") + F.col("within")
        parts.append(ss.select("a", "b", F.lit("correlation_ratio").alias("kind"),
                               F.when(total > 0, F.sqrt(F.col("between") / total)).otherwise(F.lit(0.0)).alias("value")))
    linear = pearson_matrix(df, numeric).select("a", "b", F.lit("pearson").alias("kind"), F.col("r").alias("value"))
    return reduce(DataFrame.unionByName, [*parts, linear])


def overview(df: DataFrame) -> DataFrame:
    """One row per column: its type, the number of rows and columns, and
    how many values are not NULL."""
    row = df.agg(F.count("*").alias("__rows"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(c).alias("n_values")) for c, t in df.dtypes])
    return row.select(F.col("__rows").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"), F.explode(arr).alias("__o")).select(
        "__o.column", "__o.type", "n_rows", "n_columns", "__o.n_values")


def group_quartiles(df: DataFrame, value_col: str, group_col: str) -> DataFrame:
    """Box-plot quartiles per group (plus min/max)."""
    q = exact_quantiles(df, [group_col], value_col, QUARTILES).select(F.col(group_col).alias("__g"), F.col("quantiles").alias("__q"))
    g = df.filter(F.col(value_col).isNotNull()).groupBy(group_col).agg(
        F.min(value_col).alias("min"), F.max(value_col).alias("max"), F.count("*").alias("n"))
    g = g.join(q, F.col(group_col).eqNullSafe(F.col("__g")))
    return g.select(group_col, "min", F.col("__q")[0].alias("q1"), F.col("__q")[1].alias("median"),
                    F.col("__q")[2].alias("q3"), "max", "n")


def conversion_by_month(df: DataFrame, target: str, date_col: str) -> DataFrame:
    """Conversion rate per calendar month (NULL targets ignored)."""
    return df.groupBy(F.date_trunc("month", F.col(date_col)).alias("month")).agg(
        F.avg(F.col(target).cast("double")).alias("conversion_rate"), F.count(target).alias("n"))


def conversion_in_windows(df: DataFrame, target: str, date_col: str, windows: dict) -> DataFrame:
    """Conversion in named windows, closed on both ends (unlike the
    half-open train/test split)."""
    aggs = []
    for name, (start, end) in windows.items():
        inside = (F.col(date_col) >= F.lit(start).cast("timestamp_ntz")) & (
            F.col(date_col) <= F.lit(end).cast("timestamp_ntz"))
        aggs.append(F.avg(F.when(inside, F.col(target).cast("double"))).alias(name))
    return df.agg(*aggs)


def revenue_concentration(df: DataFrame, customer_col: str, revenue_col: str,
                          share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """A13 + W7: mean revenue per customer, sorted descending, cumulative
    share of revenue vs share of customers (exact distributed running sum),
    and the first point above ``share``."""
    per = df.groupBy(customer_col).agg(F.avg(revenue_col).alias("rev"))
    per = per.filter(F.col("rev").isNotNull())
    # grand totals: one small statistics row, read once on the driver
    t = per.agg(F.sum("rev").alias("tot"), F.count("*").alias("n")).first()
    cur = running_sums(per.withColumn("__one", F.lit(1)), "rev", ["rev", "__one"], descending=True,
                       tie_cols=[F.col(customer_col)])
    curve = cur.select(customer_col, "rev", "cum_rev",
                       (F.col("cum_rev") / F.lit(t["tot"])).alias("cum_rev_perc"),
                       ((F.col("cum___one") - 1) / F.lit(float(t["n"]))).alias("share_cust"))
    first = curve.filter(F.col("cum_rev_perc") > share).orderBy("share_cust").limit(1)
    return curve, first


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A16."""
    return df.select(col).distinct()


def date_range(df: DataFrame, col: str) -> DataFrame:
    """A16."""
    return df.agg(F.min(col).alias("min_date"), F.max(col).alias("max_date"))


def accepted_discount_by_group(df: DataFrame, group_col: str = "organization_id",
                               target: str = "accepted", discount: str = "discount_shp") -> DataFrame:
    """Mean discount of accepted offers per group."""
    return df.filter(F.col(target) == 1).groupBy(group_col).agg(F.avg(discount).alias("mean_discount"))


def eda_report(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str | None = None,
               include_data_overview: bool = True, include_data_quality_summary: bool = True,
               include_univariate_analysis: bool = True, include_association_analysis: bool = True,
               include_bivariate_analysis: bool = True) -> dict[str, DataFrame]:
    """Report composition by flags -- a dict of lazy result tables.  The
    target's type chooses the bivariate tables: correlations and ANOVA across
    categories for a numeric one, ANOVA by class and chi-square otherwise."""
    out: dict[str, DataFrame] = {}
    if include_data_overview:
        out |= {"overview": overview(df), "numeric_summary": numeric_summary(df, numeric),
                "categorical_summary": categorical_summary(df, categorical)}
    if include_data_quality_summary:
        out["missing_values"] = missing_values(df)
    if include_univariate_analysis:
        out |= {"histograms": histograms(df, numeric), "frequencies": value_frequencies(df, categorical)}
    if include_association_analysis:
        out["associations"] = association_matrix(df, numeric, categorical)
    if target and include_bivariate_analysis:
        others, cats = [c for c in numeric if c != target], [c for c in categorical if c != target]
        if dict(df.dtypes)[target] in ("string", "boolean"):
            out |= {"anova": anova(df, others, target), "contingency": contingency_table(df, cats, target),
                    "chi2": contingency_chi2(df, cats, target)}
        else:
            out |= {"target_correlation": numeric_target_correlations(df, target, others), "anova": anova_by_category(df, target, cats)}
    return out


def scatter_sample(df: DataFrame, x: str, y: str, n: int = 1000, seed: int = 0,
                   key_cols: Sequence[str] = ()) -> DataFrame:
    """N points of two columns in hash order."""
    from offerlens.operators.prep import sample_rows
    return sample_rows(df.select(*key_cols, x, y), n, list(key_cols) or [x, y], seed=seed, portable=True)


def lower_tri(cols: Sequence[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
