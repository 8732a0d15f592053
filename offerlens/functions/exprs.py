"""Reusable column expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nullif_zero(c) -> Column:
    """Zero -> NULL (the reference's ``replace(0, nan)``)."""
    c = col(c)
    return F.when(c != 0, c)


def safe_ln(c) -> Column:
    """Natural log; NULL for NULL and non-positive input."""
    c = col(c)
    return F.when(c > 0, F.ln(c))


def discount_pct(expected, published, digits: int = 6) -> Column:
    """``100 - 100 * expected / published`` rounded so exact zeros stay zero.

    A zero published value gives NULL (ANSI division by zero raises).
    """
    pub = nullif_zero(published)
    r = F.round(F.lit(100.0) - F.lit(100.0) * col(expected) / pub, digits)
    return F.when(r == 0, F.lit(0.0)).otherwise(r)


def days_between(later, earlier) -> Column:
    """Fractional days ``later - earlier``; on timestamp_ntz the difference
    is taken on wall-clock fields, so the session time zone (DST) never
    changes it."""
    return F.timestamp_diff("MICROSECOND", col(earlier), col(later)) / F.lit(86_400_000_000.0)


def lookup(c, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Literal dictionary lookup as a CASE chain (vocabulary-sized, no join)."""
    c = col(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    if expr is None:
        return F.lit(default).cast("string")
    return expr.otherwise(F.lit(default)) if default is not None else expr


def vocab_map(c, mapping: Mapping[str, str], other: str) -> Column:
    """Map a categorical onto a closed vocabulary with a catch-all.

    NULL stays NULL; a mapped source gives its target; a value that is
    already a target is kept; anything else becomes ``other``.
    """
    c = col(c)
    targets = sorted(set(mapping.values()))
    mapped = lookup(c, mapping)
    return (F.when(c.isNull(), F.lit(None).cast("string"))
             .otherwise(F.coalesce(mapped, F.when(c.isin(targets), c), F.lit(other))))


def last_non_null(value, *order) -> Column:
    """Aggregate: value of the row with the greatest ``order`` among rows
    whose ``value`` is not NULL (pandas ``groupby().last()`` per column).
    Mergeable, so it partially aggregates before the shuffle."""
    v = col(value)
    key = F.struct(*[col(o) for o in order]) if len(order) > 1 else col(order[0])
    return F.max_by(v, F.when(v.isNotNull(), key))


def exact_sum(c) -> Column:
    """Order-independent sum of a double column: added up exactly as
    DECIMAL(38, 10), returned as double.  A recomputed partition or a
    different shuffle arrival order gives bit-identical results, so values
    derived from the sum in two branches of a plan agree."""
    return exact_decimal_sum(c).cast("double")


def exact_decimal_sum(c) -> Column:
    """The same sum left as a decimal, to be added up further."""
    return F.sum(col(c).cast("decimal(38,10)"))


def pearson(x, y) -> Column:
    """Aggregate: correlation of the rows where both are known; NULL where one
    of them is constant (``corr`` fails there)."""
    x, y = col(x).cast("double"), col(y).cast("double")
    var_x, var_y = F.var_pop(F.when(y.isNotNull(), x)), F.var_pop(F.when(x.isNotNull(), y))
    differ = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))  # merged variances of a constant are not exactly 0
    return F.when(differ, F.try_divide(F.covar_pop(x, y), F.sqrt(var_x) * F.sqrt(var_y)))


def bool_int(cond: Column) -> Column:
    """Boolean -> 0/1 with NULL treated as false (pandas comparison rule)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def hash_unit(*cols, seed: int = 0) -> Column:
    """Deterministic uniform [0, 1) from a 64-bit hash of the given columns.

    Independent of partitioning and of the number of executors, so a re-run
    after executor loss reproduces the same value."""
    h = F.xxhash64(F.lit(seed), *[col(c) for c in cols])
    return (F.pmod(h, F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53)))


def hash_normal(*cols, seed: int = 0) -> Column:
    """Deterministic standard normal by Box-Muller on two hash uniforms."""
    u1 = hash_unit(*cols, seed=seed * 2 + 1)
    u2 = hash_unit(*cols, seed=seed * 2 + 2)
    u1 = F.greatest(u1, F.lit(1e-300))
    return F.sqrt(F.lit(-2.0) * F.ln(u1)) * F.cos(F.lit(2 * 3.141592653589793) * u2)


def md5_unit(*cols) -> Column:
    """Uniform [0, 1) from md5 of the '|'-joined string form of integer/string
    columns; reproducible in any SQL engine with md5 (used by oracles)."""
    s = F.concat_ws("|", *[col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(s), 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))


def with_columns_if_absent(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Add columns only when the frame lacks them."""
    missing = {k: v for k, v in defaults.items() if k not in df.columns}
    return df.withColumns(missing) if missing else df


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def add_suffix(df: DataFrame, suffix: str, keep: Iterable[str] = ()) -> DataFrame:
    """Suffix every column except the join keys."""
    keep = set(keep)
    return df.toDF(*[c if c in keep else f"{c}{suffix}" for c in df.columns])


def xxhash_id(*cols) -> Column:
    """96-bit content id of a row (64-bit xxhash + 32-bit murmur3): equal
    rows share an id (and a result), distinct rows collide with negligible
    probability even at 10^10 rows.  Deterministic under recomputation."""
    cs = [col(c) for c in cols]
    return F.struct(F.xxhash64(*cs).alias("h64"), F.hash(*cs).alias("h32"))


def along(value: Column, at: Sequence[float], step: Callable[[Column, Column], Column]) -> Column:
    """The array of ``step(value, x)`` for each ``x`` of ``at``.  ``value`` is
    an argument of the function over the array, so it is evaluated once per
    row; a column that a lambda refers to may be inlined into every step."""
    xs = F.array(*[F.lit(float(x)) for x in at])
    return F.zip_with(F.array_repeat(value, len(at)), xs, step)


SCAN_BLOCK = 10  # about the root of a ladder's length


def scan(arr: Column, step: Callable[[Column, Column], Column], start: Column) -> Column:
    """The array of ``step(last, x)`` along an array of doubles, ``last``
    being the result before (``start`` at first).  An element appended to an
    array copies it, so blocks are scanned by themselves and put together."""
    empty = F.array().cast("array<double>")
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.size(arr) - 1, F.lit(0)), F.lit(SCAN_BLOCK)),
                         lambda i: F.slice(arr, i + 1, F.lit(SCAN_BLOCK)))

    def block(acc: Column, xs: Column) -> Column:
        last = F.when(F.size(acc) > 0, F.get(acc, F.size(acc) - 1)).otherwise(start)
        own = F.aggregate(xs, F.array(last.cast("double")), lambda a, x: F.concat(a, F.array(step(F.get(a, F.size(a) - 1), x))))
        return F.concat(acc, F.slice(own, F.lit(2), F.lit(SCAN_BLOCK)))

    return F.aggregate(blocks, empty, block)
