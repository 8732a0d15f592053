"""Training-data augmentation (G1-G8): one row -> several rows.

Every variant is a single narrow ``explode`` over an array of structs built
with CASE on the label: no UDF, no shuffle, rows stay in their partition.
Random shifts come from hashes of the row key, so a recomputed partition
(executor loss) reproduces the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.functions.exprs import hash_normal, hash_unit, md5_unit

VARIANTS = ("basic", "shift", "shift-uni", "orig", "1sided", "no-augmentation")
# Fixed values of the reference's variants.
ORIG_PARAMS = (10, 20)
ONE_SIDED_STEPS = (5, 15, 25)
UNIFORM_RADIUS_FLIP = 3.0
UNIFORM_RADIUS_SAME = 1.5


@dataclass
class AugmentConfig:
    variant: str = "basic"
    params: tuple[float, float] = (10, 20)      # (a, b)
    weight: float = 1.0
    weight_asym: bool = False
    sigma: float = 2.0
    seed: int = 0
    portable_noise: bool = False   # md5-based noise, reproducible in SQL engines


def _row(d: Column, y: Column, w: Column, branch: int) -> Column:
    return F.struct(d.cast("double").alias("d"), y.cast("int").alias("y"),
                    w.cast("double").alias("w"), F.lit(branch).alias("branch"))


def _noise_unit(key: Sequence[Column], branch: int, cfg: AugmentConfig) -> Column:
    if cfg.portable_noise:
        return md5_unit(F.lit(cfg.seed), F.lit(branch), *key)
    return hash_unit(*key, F.lit(branch), seed=cfg.seed)


def _noise_normal(key: Sequence[Column], branch: int, cfg: AugmentConfig) -> Column:
    if cfg.portable_noise:
        u1 = F.greatest(md5_unit(F.lit(cfg.seed), F.lit(branch), F.lit(1), *key), F.lit(1e-300))
        u2 = md5_unit(F.lit(cfg.seed), F.lit(branch), F.lit(2), *key)
        return F.sqrt(F.lit(-2.0) * F.ln(u1)) * F.cos(F.lit(2 * 3.141592653589793) * u2)
    return hash_normal(*key, F.lit(branch), seed=cfg.seed)


def _generated(d: Column, y: Column, cfg: AugmentConfig, key: Sequence[Column]) -> Column:
    """Array of generated rows (without the original)."""
    one = F.lit(1.0)
    empty = F.array().cast("array<struct<d:double,y:int,w:double,branch:int>>")
    v = cfg.variant
    if v == "no-augmentation":
        return empty
    if v == "1sided":
        m = F.when(y == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        steps = [_row(d + m * F.lit(float(s)), y, one, i + 1) for i, s in enumerate(ONE_SIDED_STEPS)]
        # Steps are monotone, so "stop at the first step out of range" is a filter.
        return F.filter(F.array(*steps), lambda r: (r["d"] >= 0) & (r["d"] < 100))
    a, b = ORIG_PARAMS if v == "orig" else cfg.params
    a, b = F.lit(float(a)), F.lit(float(b))
    if v == "shift":
        s1 = F.lit(cfg.sigma) * _noise_normal(key, 1, cfg)
        s2 = F.lit(cfg.sigma) * _noise_normal(key, 2, cfg)
        acc = [_row(d - (b + s1), F.lit(0), one, 1), _row(d + (a + s2), y, one, 2)]
        rej = [_row(d - (a + s1), y, one, 1), _row(d + (b + s2), F.lit(1), one, 2)]
    elif v == "shift-uni":
        def uni(radius, branch):
            return (_noise_unit(key, branch, cfg) * F.lit(2.0) - F.lit(1.0)) * F.lit(radius)
        acc = [_row(d - (b + uni(UNIFORM_RADIUS_FLIP, 1)), F.lit(0), one, 1),
               _row(d + (a + uni(UNIFORM_RADIUS_SAME, 2)), y, one, 2)]
        rej = [_row(d - (a + uni(UNIFORM_RADIUS_SAME, 1)), y, one, 1),
               _row(d + (b + uni(UNIFORM_RADIUS_FLIP, 2)), F.lit(1), one, 2)]
    elif v in ("basic", "orig"):
        w = F.lit(float(cfg.weight)) if v == "basic" else one
        w_acc_flip = one if (v == "orig" or cfg.weight_asym) else w
        acc = [_row(d - b, F.lit(0), w_acc_flip, 1), _row(d + a, y, one, 2)]
        rej = [_row(d - a, y, one, 1), _row(d + b, F.lit(1), w, 2)]
    else:
        raise NotImplementedError(v)
    return (F.when(y == 1, F.array(*acc))
             .when(y == 0, F.array(*rej))
             .otherwise(empty))


def augment(df: DataFrame, cfg: AugmentConfig, key_cols: Sequence[str] = ("offer_id",),
            discount_col: str = "discount_shp", target_col: str = "accepted",
            weight_col: str = "weight", branch_col: str = "aug_branch") -> DataFrame:
    """Keep each row, add the variant's generated rows, then drop every row
    (originals included) whose discount is outside ``[0, 100)``."""
    d, y = F.col(discount_col), F.col(target_col)
    key = [F.col(k) for k in key_cols]
    orig = _row(d, y, F.lit(1.0), 0)
    rows = F.concat(F.array(orig), _generated(d, y, cfg, key))
    out = df.withColumn("__aug", F.explode(rows))
    out = out.withColumns({
        discount_col: F.col("__aug.d"),
        target_col: F.col("__aug.y"),
        weight_col: F.col("__aug.w"),
        branch_col: F.col("__aug.branch"),
    }).drop("__aug")
    dd = F.col(discount_col)
    return out.filter((dd >= 0) & (dd < 100))
