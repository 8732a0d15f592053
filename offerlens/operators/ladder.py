"""What-if discount ladder, optimum and recommendation (R2-R9, W6, W9, A10,
J9, J10, P18).

The whole ladder of a row is an array built with higher-order functions on
that row -- no explode, no shuffle, no row id.  The scorer is a closed form or
a fitted model compiled to column expressions (``compiled.CompiledModel``).
For models that cannot be compiled there is the other shape:
``explode(sequence)`` -> one ``transform`` pass for all steps -> group by row
id, where the rows of one offer are produced in one task, so the partial
aggregate collapses the ladder to one row before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.functions.exprs import along, scan

DEFAULT_GAMMAS = (2, 4, 6, 8, 10)


# ---------------------------------------------------------------------------
# Scorers
# ---------------------------------------------------------------------------

class Scorer(Protocol):
    """What the ladder needs of a model: closed forms (``LogisticScorer``)
    and fitted models (``compiled.CompiledModel``) alike."""

    def curve(self, df: DataFrame, values: Sequence[float], name: str) -> DataFrame: ...

    def score(self, df: DataFrame, name: str) -> DataFrame: ...


@dataclass
class LogisticScorer:
    """P(accept) = sigmoid(b0 + b_d * discount + sum(b_j * coalesce(x_j, fill_j))).

    A closed form of a fitted logistic regression; usable inside
    higher-order functions and reproducible in SQL."""
    intercept: float = -2.0
    discount_coef: float = 0.045
    coefs: dict[str, float] = field(default_factory=lambda: {
        "log_published_revenue": -0.15, "ecomm": 0.4, "prod_mix_tdexport": 0.5})
    fills: dict[str, float] = field(default_factory=lambda: {"log_published_revenue": 10.0})

    def base_logit(self, intercept: Column | None = None) -> Column:
        """Row part of the logit (everything but the discount term); a plain
        codegen'd column, computed once per row, not once per ladder step."""
        z = F.lit(self.intercept) if intercept is None else intercept
        for c, b in self.coefs.items():
            z = z + F.lit(b) * F.coalesce(F.col(c).cast("double"), F.lit(self.fills.get(c, 0.0)))
        return z

    def prob_from_base(self, base: Column, discount: Column,
                       discount_coef: Column | None = None) -> Column:
        bd = F.lit(self.discount_coef) if discount_coef is None else discount_coef
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(base + bd * discount)))

    def prob(self, discount: Column, intercept: Column | None = None,
             discount_coef: Column | None = None) -> Column:
        """Columns for ``intercept``/``discount_coef`` score several model
        configurations in one pass (a config struct per exploded row)."""
        return self.prob_from_base(self.base_logit(intercept), discount, discount_coef)

    def curve(self, df: DataFrame, values: Sequence[float], name: str, intercept: Column | None = None,
              discount_coef: Column | None = None) -> DataFrame:
        """Adds the array ``name`` of P(accept) at each discount of
        ``values``.  The row part of the logit is evaluated once per row; the
        per-step lambda is a few nodes."""
        return df.withColumn(name, along(self.base_logit(intercept), values, lambda z, d: self.prob_from_base(z, d, discount_coef)))

    def prepare(self, df: DataFrame) -> DataFrame:
        return df

    def shares(self) -> tuple[float, dict[str, Callable[[str | None], str]]]:
        """The intercept and, by feature, SQL of its share in the logit at a
        value (SQL; ``None``: the row's own)."""

        def share(f: str, b: float, fill: float | None) -> Callable[[str | None], str]:
            def sql(x: str | None) -> str:
                x = f"`{f}`" if x is None else x
                return f"({float(b)!r}D * {x if fill is None else f'coalesce(CAST({x} AS DOUBLE), {float(fill)!r}D)'})"

            return sql

        return self.intercept, {"discount_shp": share("discount_shp", self.discount_coef, None),
                                **{c: share(c, b, self.fills.get(c, 0.0)) for c, b in self.coefs.items()}}

    def score(self, df: DataFrame, name: str, discount_col: str = "discount_shp") -> DataFrame:
        """Adds P(accept) at the row's own discount."""
        return df.withColumn(name, self.prob(F.col(discount_col)))

    def sql_prob(self, discount: str, intercept: str | None = None,
                 discount_coef: str | None = None) -> str:
        b0 = f"{self.intercept!r}::DOUBLE" if intercept is None else intercept
        bd = f"{self.discount_coef!r}::DOUBLE" if discount_coef is None else discount_coef
        z = f"{b0}"
        for c, b in self.coefs.items():
            z += f" + {b!r}::DOUBLE * coalesce(CAST({c} AS DOUBLE), {self.fills.get(c, 0.0)!r}::DOUBLE)"
        return f"(1.0::DOUBLE / (1.0::DOUBLE + exp(-(({z}) + {bd} * ({discount})))))"


# ---------------------------------------------------------------------------
# R2 labels
# ---------------------------------------------------------------------------

def step_label(prefix: str, pct: Column) -> Column:
    """R2: ``prefix + 3-digit percent``."""
    return F.format_string(f"{prefix}%03d", pct)


def ladder_steps(min_discount: float = 0.0, max_discount: float = 1.0,
                 price_steps: float = 0.1) -> list[int]:
    """Integer percent steps of ``[min, max)`` (no float drift)."""
    lo, hi, st = round(min_discount * 100), round(max_discount * 100), round(price_steps * 100)
    return list(range(lo, hi, st))


# ---------------------------------------------------------------------------
# Archived recommendation, closed-form scorer
# ---------------------------------------------------------------------------

def _interval(ds: Column, revs: Column, thr: Column) -> Column:
    return F.filter(ds, lambda d: F.element_at(revs, d + 1) > thr)


def _ladder_arrays(df: DataFrame, scorer: Scorer, n_steps: int, monotone: bool, **coefs: Column | None) -> DataFrame:
    """Adds ``__p`` (probabilities), ``__r`` (expected revenue per step),
    ``__mx`` (its maximum) and ``__opt`` (first arg-max)."""
    out = scorer.curve(df, range(n_steps), "__p", **coefs)
    if monotone:
        out = out.withColumn("__p", running_max(F.col("__p")))
    out = out.withColumn("__r", F.transform(
        F.col("__p"), lambda p, i: (F.lit(1.0) - i / F.lit(100.0)) * p))
    out = out.withColumn("__mx", F.array_max("__r"))
    return out.withColumn("__opt", F.array_position(F.col("__r"), F.col("__mx")) - 1)


def _with_intervals(df: DataFrame, gammas: Mapping[str, float], n_steps: int) -> DataFrame:
    """By name of an array column: the steps whose revenue is strictly above
    ``(1 - gamma/100) * max`` (computed once, then min/max read from it).
    Revenues are not negative, so the steps of a smaller gamma are among those
    of a larger one."""
    steps = F.sequence(F.lit(0), F.lit(n_steps - 1))
    for name, gamma in sorted(gammas.items(), key=lambda x: -x[1]):
        thr = (F.lit(1.0) - F.lit(float(gamma)) / F.lit(100.0)) * F.col("__mx")
        df = df.withColumn(name, F.filter(steps, lambda d: F.element_at(F.col("__r"), d + 1) > thr))
        steps = F.col(name)
    return df


def recommend(df: DataFrame, scorer: Scorer, gamma: float = 6, cc_adjustment: int = 0,
              discount_col: str = "discount_shp", n_steps: int = 100,
              monotone: bool = False) -> DataFrame:
    """R5 + R6 per row: expected revenue ``(1 - d/100) * P(d)`` on 0..99,
    optimum (first on ties), interval of steps with revenue strictly above
    ``(1 - gamma/100) * max`` (may have holes), adjusted optimum
    ``min(97, opt + cc)``."""
    out = _with_intervals(_ladder_arrays(df, scorer, n_steps, monotone), {"__i": gamma}, n_steps)
    out = out.withColumns({
        "discount_low": F.array_min("__i").cast("int"),
        "discount_high": F.array_max("__i").cast("int"),
        "discount_opt_wo_adj": F.col("__opt").cast("int"),
    })
    out = out.withColumn("discount_opt", F.least(F.lit(97), F.col("discount_opt_wo_adj") + F.lit(cc_adjustment)))
    return out.drop("__p", "__r", "__mx", "__opt", "__i")


def running_max(arr: Column) -> Column:
    """Running maximum along an array (monotone ladder)."""
    return scan(arr.cast("array<double>"), lambda last, x: F.greatest(x, F.coalesce(last, x)), F.lit(None).cast("double"))


def recommendation_eval(df: DataFrame, scorer: Scorer,
                        gammas: Sequence[int] = DEFAULT_GAMMAS,
                        discount_col: str = "discount_shp", target_col: str = "accepted",
                        n_steps: int = 100, keep: Sequence[str] = (), monotone: bool = False,
                        **coefs: Column | None) -> DataFrame:
    """R7 (+P18, J9): per test row the optimum, its probability and expected
    revenue, low/mid/high for every gamma, published and realised revenue,
    and the difference to the real discount.  One row in, one row out."""
    out = _ladder_arrays(df, scorer, n_steps, monotone, **coefs)
    out = _with_intervals(out, {f"__i{g}": g for g in gammas}, n_steps)
    cols = {
        "real_discount": F.col(discount_col),
        "pub_rev": F.exp(F.col("log_published_revenue")),
        "accepted": F.col(target_col),
        "rom_discount": F.col("__opt").cast("int"),
        "rom_pa": F.element_at(F.col("__p"), F.col("__opt").cast("int") + 1),
        "rom_exp_rev": F.col("__mx"),
    }
    for g in gammas:
        lo, hi = F.array_min(f"__i{g}").cast("int"), F.array_max(f"__i{g}").cast("int")
        cols[f"rom_discount_{g}_low"] = lo
        cols[f"rom_discount_{g}_high"] = hi
    out = out.select(*keep, *[c.alias(k) for k, c in cols.items()])
    out = out.withColumns({f"rom_discount_{g}_mid": (F.col(f"rom_discount_{g}_low") + F.col(f"rom_discount_{g}_high")) / F.lit(2.0)
                           for g in gammas})
    cols_order = list(keep) + ["real_discount", "pub_rev", "accepted", "rom_discount", "rom_pa", "rom_exp_rev"]
    for g in gammas:
        cols_order += [f"rom_discount_{g}_low", f"rom_discount_{g}_mid", f"rom_discount_{g}_high"]
    out = out.select(*cols_order)
    out = out.withColumn("real_rev", (F.lit(1.0) - F.col("real_discount") / F.lit(100.0))
                         * F.col("pub_rev") * F.col("accepted"))
    return out.withColumn("rom_diff", F.col("rom_discount") - F.col("real_discount"))


def ladder_long(df: DataFrame, scorer: Scorer, keep: Sequence[str],
                n_steps: int = 100) -> DataFrame:
    """The long ladder ``(keep..., discount, prob, exp_rev)`` of the
    given rows (narrow explode of a per-row array)."""
    out = scorer.curve(df, range(n_steps), "__p").select(*keep, F.posexplode("__p").alias("discount", "prob"))
    return out.withColumn("exp_rev", (F.lit(1.0) - F.col("discount") / F.lit(100.0)) * F.col("prob"))


# ---------------------------------------------------------------------------
# Current-generation simulation (ladder on the feature)
# ---------------------------------------------------------------------------

def simulate_discount_effect(df: DataFrame, scorer: Scorer, revenue_col: str,
                             min_discount: float = 0.0, max_discount: float = 1.0,
                             price_steps: float = 0.1, unit: str = "percent") -> DataFrame:
    """For every step override the discount feature, score, and compute
    the converted revenue ``(1 - d) * p * revenue``.  ``unit='fraction'``
    feeds the fraction into the feature (reference parity); ``'percent'``
    feeds the percent the model was trained on.  Adds arrays ``sim_discount``
    (percent), ``sim_prob``, ``sim_revenue`` aligned by step."""
    steps = ladder_steps(min_discount, max_discount, price_steps)
    ds = F.array(*[F.lit(s) for s in steps])
    out = scorer.curve(df, [s / 100.0 if unit == "fraction" else float(s) for s in steps], "sim_prob")
    out = out.withColumn("sim_discount", ds)
    rev = F.col(revenue_col)
    return out.withColumn("sim_revenue", F.transform(
        F.arrays_zip(F.col("sim_discount"), F.col("sim_prob")),
        lambda z: (F.lit(1.0) - z["sim_discount"] / F.lit(100.0)) * z["sim_prob"] * rev))


def find_optimal_discount(df: DataFrame, prefix: str = "converted_revenue_") -> DataFrame:
    """R4 + W6: maximum converted revenue and the label of its first step."""
    mx = F.array_max("sim_revenue")
    out = df.withColumn(f"{prefix}optimized", mx)
    pos = F.array_position(F.col("sim_revenue"), F.col(f"{prefix}optimized"))
    return out.withColumn(f"{prefix}optimized_col",
                          step_label(prefix, F.element_at(F.col("sim_discount"), pos.cast("int"))))


def to_wide(df: DataFrame, steps: Sequence[int], keep: Sequence[str]) -> DataFrame:
    """Wide form ``pred_prob_000, discount_000, converted_revenue_000, ...``
    straight from the per-row arrays (no pivot shuffle)."""
    cols = [F.col(k) for k in keep]
    for i, s in enumerate(steps):
        lab = f"{s:03d}"
        cols += [F.element_at("sim_prob", i + 1).alias(f"pred_prob_{lab}"),
                 (F.lit(s) / F.lit(100.0)).alias(f"discount_{lab}"),
                 F.element_at("sim_revenue", i + 1).alias(f"converted_revenue_{lab}")]
    return df.select(*cols)


def response_curve(sim: DataFrame) -> DataFrame:
    """A10: mean probability and mean converted revenue per step over all
    rows.  The per-row arrays are reduced in a single aggregation."""
    z = sim.select(F.explode(F.arrays_zip("sim_discount", "sim_prob", "sim_revenue")).alias("z"))
    return z.groupBy(F.col("z.sim_discount").alias("discount")).agg(
        F.avg("z.sim_prob").alias("mean_prob"), F.avg("z.sim_revenue").alias("mean_revenue"))


# ---------------------------------------------------------------------------
# Generic (fitted model) ladder: explode -> transform -> group
# ---------------------------------------------------------------------------

def model_ladder(df: DataFrame, predict: Callable[[DataFrame], DataFrame], row_id: str,
                 discount_col: str = "discount_shp", n_steps: int = 100,
                 prob_col: str = "prob") -> DataFrame:
    """J10 + R3 with any fitted model: one scoring pass over the exploded
    ladder.  ``predict`` must add ``prob_col``.  Returns the long form."""
    lad = df.withColumn(discount_col, F.explode(F.sequence(F.lit(0), F.lit(n_steps - 1))))
    lad = lad.withColumn(discount_col, F.col(discount_col).cast("double"))
    scored = predict(lad)
    return scored.select(row_id, F.col(discount_col).cast("int").alias("discount"), F.col(prob_col).alias("prob"))


def recommend_from_long(long: DataFrame, row_id: str, gamma: float = 6, cc_adjustment: int = 0,
                        monotone: bool = True) -> DataFrame:
    """R6 on a long ladder: one aggregation per row id (partial aggregation
    happens in the task that produced the ladder), then array functions.
    ``monotone`` applies the running maximum W9 (trees have no monotone
    constraint in Spark ML)."""
    g = long.groupBy(row_id).agg(F.array_sort(F.collect_list(F.struct("discount", "prob"))).alias("__l"))
    probs = F.transform("__l", lambda s: s["prob"])
    if monotone:
        probs = running_max(probs)
    g = g.withColumn("__p", probs)
    ds = F.transform("__l", lambda s: s["discount"])
    g = g.withColumn("__d", ds)
    revs = F.transform(F.arrays_zip("__d", "__p"), lambda z: (F.lit(1.0) - z["__d"] / F.lit(100.0)) * z["__p"])
    g = g.withColumn("__r", revs).withColumn("__mx", F.array_max("__r"))
    pos = F.array_position(F.col("__r"), F.col("__mx"))
    thr = (F.lit(1.0) - F.lit(gamma) / F.lit(100.0)) * F.col("__mx")
    close = F.filter(F.arrays_zip("__d", "__r"), lambda z: z["__r"] > thr)
    g = g.withColumns({
        "discount_low": F.array_min(F.transform(close, lambda z: z["__d"])),
        "discount_high": F.array_max(F.transform(close, lambda z: z["__d"])),
        "discount_opt_wo_adj": F.element_at(F.col("__d"), pos.cast("int")),
        "rom_pa": F.element_at(F.col("__p"), pos.cast("int")),
        "rom_exp_rev": F.col("__mx"),
    })
    g = g.withColumn("discount_opt", F.least(F.lit(97), F.col("discount_opt_wo_adj") + F.lit(cc_adjustment)))
    return g.drop("__l", "__p", "__d", "__r", "__mx")
