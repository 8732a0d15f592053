"""Projection, casting, target, filters, splits and samples (P1-P3, P16-P20,
F1-F6, F12-F17)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerlens.functions.exprs import hash_unit, md5_unit, with_columns_if_absent
from offerlens.functions.sizing import DEFAULT_MAX_BROADCAST_ROWS
from offerlens.session import stage


# --- P1 / P2 / P3 -----------------------------------------------------------

def standardize_dataset(df: DataFrame, rename_columns: Mapping[str, str],
                        keep_columns: Sequence[str] | None = None) -> DataFrame:
    """Rename (absent names ignored), then select in the given order (a
    missing keep column raises at analysis time)."""
    present = {k: v for k, v in rename_columns.items() if k in df.columns}
    if present:
        df = df.withColumnsRenamed(present)
    return df.select(*keep_columns) if keep_columns else df


def convert_dtype_columns(df: DataFrame, to_numeric: Sequence[str] = (),
                          to_category: Sequence[str] = (),
                          to_datetime: Sequence[str] = ()) -> DataFrame:
    """Numeric list is strict (absent column raises; with ANSI on, a bad value
    raises at run time); category/datetime lists skip absent columns."""
    missing = [c for c in to_numeric if c not in df.columns]
    if missing:
        raise KeyError(f"numeric columns missing: {missing}")
    casts = {c: F.col(c).cast("double") for c in to_numeric}
    casts.update({c: F.col(c).cast("string") for c in to_category if c and c in df.columns})
    for c in to_datetime:
        if c and c in df.columns:
            t = df.schema[c].dataType.typeName()
            casts[c] = F.col(c) if t in ("timestamp", "timestamp_ntz") else F.col(c).cast("timestamp_ntz")
    return df.withColumns(casts)


TARGET_VALUES = {"Accepted": 1, "Rejected": 0}
TARGET_NULL_VALUES = ["In Progress"]


def fix_target(df: DataFrame, original_target_col: str, target_col: str) -> DataFrame:
    """Accepted -> 1, Rejected -> 0, In Progress / NULL -> NULL, anything else
    raises at run time (``raise_error`` inside the CASE)."""
    c = F.col(original_target_col)
    t = (F.when(c == "Accepted", F.lit(1))
          .when(c == "Rejected", F.lit(0))
          .when(c.isNull() | c.isin(TARGET_NULL_VALUES), F.lit(None).cast("int"))
          .otherwise(F.raise_error(F.concat(F.lit("Unknown final outcome: "), c)).cast("int")))
    return df.withColumn(target_col, t)


# --- F1 / F2 / F3 / F4 / F12 ----------------------------------------------------

def clean_dataset(df: DataFrame, organization_id: str | None = None, stored: bool = False) -> DataFrame:
    """Optional organization filter, then whole-row de-duplication.

    Of ``stored`` rows (cheap to read twice) those whose hash no other row has
    are distinct as they are; only the others are shuffled as a whole and
    compared by all columns.  Where those are too many for a broadcast, all
    rows are.  Without any, the rows are returned as they came."""
    if organization_id is not None:
        df = df.filter(F.col("organization_id") == organization_id)
    if not stored:
        return df.dropDuplicates()
    keyed = df.withColumn("__h", F.xxhash64(*df.columns))
    shared = stage(keyed.groupBy("__h").agg(F.count("*").alias("__n")).filter("__n > 1").select("__h"), "shared_hashes")
    if shared.isEmpty():
        return df
    if shared.limit(DEFAULT_MAX_BROADCAST_ROWS + 1).count() > DEFAULT_MAX_BROADCAST_ROWS:
        return df.dropDuplicates()
    alone = keyed.join(F.broadcast(shared), "__h", "left_anti").drop("__h")
    return alone.unionByName(keyed.join(F.broadcast(shared), "__h", "left_semi").drop("__h").dropDuplicates())


def filter_dataset(df: DataFrame, target_col: str, clip_min: float = 0, clip_max: float = 99,
                   discount_col: str = "discount_shp") -> DataFrame:
    """Closed discount range and non-NULL target (no de-duplication, as the
    reference's code)."""
    d = F.col(discount_col)
    return df.filter((d <= clip_max) & (d >= clip_min) & F.col(target_col).isNotNull())


def clean_for_training(df: DataFrame, bin_cols: Sequence[str], cat_cols: Sequence[str],
                       num_cols: Sequence[str], organization_id: str | None = None,
                       clip_min: float = 0, clip_max: float = 99, target_col: str = "accepted"):
    """F2 + organization + de-duplication + usable column lists.

    Returns ``(df, [bin, cat, num], missing)``."""
    cond = ((F.col("discount_shp") <= clip_max) & (F.col("discount_shp") >= clip_min)
            & F.col(target_col).isNotNull())
    if organization_id is not None:
        cond = cond & (F.col("organization_id") == organization_id)
    df = df.filter(cond).dropDuplicates()
    cols = set(df.columns)
    usable = [[c for c in group if c in cols] for group in (bin_cols, cat_cols, num_cols)]
    missing = [c for group in (bin_cols, cat_cols, num_cols) for c in group if c not in cols]
    return df, usable, missing


def train_test_split(df: DataFrame, date_col: str, train_start: str, train_end: str,
                     test_start: str, test_end: str) -> tuple[DataFrame, DataFrame]:
    """Half-open ``[start, end)`` windows on ``date_col`` (partition pruning
    applies when the data is stored by date)."""
    d = F.col(date_col)
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    train = df.filter((d >= ts(train_start)) & (d < ts(train_end)))
    test = df.filter((d >= ts(test_start)) & (d < ts(test_end)))
    return train, test


def drop_null_target(df: DataFrame, target_col: str = "accepted") -> DataFrame:
    return df.dropna(subset=[target_col])


def x_y_split(df: DataFrame, features: Sequence[str], target_col: str,
              keep: Sequence[str] = ()) -> DataFrame:
    """Features and label stay on one row (no physical split)."""
    return df.select(*keep, *features, target_col)


def fill_absent_numeric(df: DataFrame, columns: Sequence[str], value: float = 0.0) -> DataFrame:
    """P17."""
    return with_columns_if_absent(df, {c: F.lit(value) for c in columns})


# --- F5 / F6 / F17 -------------------------------------------------------------

def sample_rows(df: DataFrame, n: int, key_cols: Sequence[str], seed: int = 0,
                portable: bool = False, tie_break: Sequence[str] = ()) -> DataFrame:
    """n rows chosen by hash order of the key.  Stable under
    repartitioning (unlike ``sample``); a top-n, so Spark plans
    ``TakeOrderedAndProject`` (per-partition top-n, then merge)."""
    u = md5_unit(F.lit(seed), *key_cols) if portable else hash_unit(*key_cols, seed=seed)
    return df.withColumn("__u", u).orderBy("__u", *key_cols, *tie_break).limit(n).drop("__u")


def sample_per_group(df: DataFrame, group_col: str, n: int, key_cols: Sequence[str],
                     seed: int = 0, tie_break: Sequence[str] = ()) -> DataFrame:
    """at most n rows per group, by hash order (shared by all configs).

    A bounded top-n per group: rows are pre-filtered by a per-group hash
    threshold first would need statistics; a window rank with a limit keeps it
    simple and Spark applies the per-partition rank limit before the
    shuffle (WindowGroupLimit)."""
    u = md5_unit(F.lit(seed), *key_cols)
    w = Window.partitionBy(group_col).orderBy(u, *key_cols, *tie_break)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def top_n_per_group(df: DataFrame, group_col: str, n: int, order_cols: Sequence[str]) -> DataFrame:
    """first n rows per group in the given order."""
    w = Window.partitionBy(group_col).orderBy(*order_cols)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


# --- F15 / F16 / P16 / P20 ---------------------------------------------------------

def differs(df: DataFrame, a: str, b: str) -> DataFrame:
    """rows where either column is non-NULL."""
    return df.filter(F.col(a).isNotNull() | F.col(b).isNotNull())


def distinct_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """F16 as a one-row table."""
    return df.select(a, b).distinct().agg(F.count("*").alias("n_pairs"))


def clean_names(df: DataFrame, column: str, replacements: Mapping[str, str] | None = None) -> DataFrame:
    """Trim, underscores for spaces, upper case, spelling fixes; plus a
    capitalised form."""
    c = F.upper(F.regexp_replace(F.trim(F.col(column)), " ", "_"))
    for k, v in (replacements or {}).items():
        c = F.regexp_replace(c, k, v)
    return df.withColumns({column: c, f"{column}_title": F.initcap(F.regexp_replace(c, "_", " "))})


def channel_remap_share(df: DataFrame, column: str, keep_values: Sequence[str],
                        group_col: str = "organization_id") -> DataFrame:
    """P20: keep two known values else NULL, NULL -> '~', share of rows whose
    value changed, per group."""
    orig = F.coalesce(F.col(column), F.lit("~"))
    remap = F.coalesce(F.when(F.col(column).isin(list(keep_values)), F.col(column)), F.lit("~"))
    return df.groupBy(group_col).agg(
        F.count("*").alias("n_rows"),
        F.sum((orig != remap).cast("int")).cast("bigint").alias("n_changed"),
        F.avg((orig != remap).cast("double")).alias("share_changed"))
