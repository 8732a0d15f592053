"""Global running sums, row positions and exact quantiles without funnelling
the data into one task.

A bare ``Window.orderBy(x)`` (no partition key) moves every row into a single
task, and an exact ``percentile`` keeps a whole group in one buffer.  Here the
input is written once and cut into ranges of its full order key (group, order
columns, ties, and the row itself, so that even equal keys are split).  The
number of ranges follows from the number of rows.  Sums run inside a range,
and one row per (group, range) carries the sum of all ranges before it.  A
quantile is the value whose run of ranks holds the wanted position; a sketch
first says which few values come into question.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerlens.functions.sizing import checked_broadcast
from offerlens.session import stage

RANGE_ROWS = 2**20  # rows that a task sorts at most
SPREAD_ROWS = 2**14  # a range is not made smaller than this for the sake of idle cores


def n_ranges(rows: int, cores: int, range_rows: int = RANGE_ROWS) -> int:
    return max(1, math.ceil(rows / range_rows), min(cores, math.ceil(rows / min(SPREAD_ROWS, range_rows))))


def key_ranges(df: DataFrame, keys: Sequence[Column | str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """``df`` written to the shared folder with ``__b``, the number of the
    range of ``keys`` that a row lies in, and ``__r``, which tells equal keys
    apart.  Range ``i`` holds smaller keys than range ``i + 1``."""
    rows = stage(df, "rows")
    n = n_ranges(rows.count(), df.sparkSession.sparkContext.defaultParallelism, range_rows)
    rows = rows.withColumn("__r", F.monotonically_increasing_id())
    return stage(rows.repartitionByRange(n, *keys, "__r").withColumn("__b", F.spark_partition_id()), "ranges")


def running_sums(df: DataFrame, order_col: str, sum_cols: Sequence[str],
                 partition_cols: Sequence[str] = (), descending: bool = False,
                 prefix: str = "cum_", tie_cols: Sequence = (), total_prefix: str | None = None,
                 range_rows: int = RANGE_ROWS) -> DataFrame:
    """Add inclusive running sums ``cum_<c>`` of ``sum_cols`` in the order of
    ``order_col`` then ``tie_cols`` (a unique ``(order_col, tie_cols)`` gives
    a deterministic order).

    ``partition_cols`` restart the sums per group (e.g. per model); a group
    of any size is spread over ranges.  ``total_prefix`` also adds the sums
    over the whole group."""
    pcols = list(partition_cols)
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    keys = [order, *tie_cols]
    d = key_ranges(df, [*pcols, *keys], range_rows)
    totals = d.groupBy(*pcols, "__b").agg(*[F.sum(c).alias(f"__t_{c}") for c in sum_cols])
    group = Window.partitionBy(*pcols)  # one row per range of a group
    before = group.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*pcols, "__b", *[F.coalesce(F.sum(f"__t_{c}").over(before), F.lit(0)).alias(f"__o_{c}") for c in sum_cols],
                            *[F.sum(f"__t_{c}").over(group).alias(f"__s_{c}") for c in sum_cols])
    w = Window.partitionBy(*pcols, "__b").orderBy(*keys, "__r").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumns({f"__w_{c}": F.coalesce(F.sum(c).over(w), F.lit(0)) for c in sum_cols})
    d = _same(d, offsets, [*pcols, "__b"])
    d = d.withColumns({f"{prefix}{c}": F.col(f"__o_{c}") + F.col(f"__w_{c}") for c in sum_cols})
    if total_prefix is not None:
        d = d.withColumns({f"{total_prefix}{c}": F.col(f"__s_{c}") for c in sum_cols})
    return d.drop("__b", "__r", *[f"__{k}_{c}" for k in "osw" for c in sum_cols])


def _same(d: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on equal keys, null keys included."""
    small = small.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in small.columns if c not in keys])
    cond = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    return d.join(small, cond).drop(*[f"__k_{k}" for k in keys])


def row_index(df: DataFrame, order_cols: Sequence[Column | str], partition_cols: Sequence[str] = (),
              range_rows: int = RANGE_ROWS, name: str = "row_index") -> DataFrame:
    """0-based row position in ``order_cols`` order, per group of
    ``partition_cols``; rows that share all of these get positions next to
    each other."""
    pcols = list(partition_cols)
    d = key_ranges(df, [*pcols, *order_cols], range_rows)
    counts = d.groupBy(*pcols, "__b").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*pcols).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*pcols, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    w = Window.partitionBy(*pcols, "__b").orderBy(*order_cols, "__r")
    d = _same(d.withColumn("__i", F.row_number().over(w)), offsets, [*pcols, "__b"])
    return d.withColumn(name, F.col("__o") + F.col("__i") - 1).drop("__b", "__r", "__i", "__o")


BRACKET_ACCURACY = 10_000  # the sketch errs by at most this share of the ranks


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str, probs: Sequence[float],
                    count_col: str | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``(group..., quantiles)``: exact quantiles of the non-null values of a
    group, interpolated between the two ranks around ``p * (n - 1)``; groups
    without values have no row.  A row stands for ``count_col`` equal values.

    A mergeable sketch brackets each quantile; the rows below a bracket are
    only counted, so of each group a few values around the quantile are
    shuffled and sorted.  Groups whose brackets turn out to miss a rank (small
    ones) are counted value by value."""
    g = list(group_cols)
    if count_col is not None:
        return _counted_quantiles(df, g, value_col, probs, count_col, range_rows)
    values = df.select(*g, F.col(value_col).cast("double").alias("__v")).filter(F.col("__v").isNotNull())
    values = values.withColumn("__w", F.when(F.isnan("__v"), F.lit(float("inf"))).otherwise(F.col("__v")))
    off = 3.0 / BRACKET_ACCURACY
    at = [x for p in probs for x in (max(0.0, p - off), min(1.0, p + off))]
    brackets = stage(values.groupBy(*g).agg(F.percentile_approx("__w", at, BRACKET_ACCURACY).alias("__q"),
                                            F.count("*").alias("__all")).filter("__all > 0"), "brackets")
    d = _same(values, checked_broadcast(brackets), g) if g else values.crossJoin(F.broadcast(brackets))  # one row
    sides = F.array(*[F.struct(F.lit(i).alias("i"), (F.col("__w") <= F.col("__q")[2 * i + 1]).alias("take"),
                               F.when(F.col("__w") >= F.col("__q")[2 * i], F.col("__v")).alias("v")) for i in range(len(probs))])
    d = d.select(*g, "__all", F.explode(F.filter(sides, lambda s: s["take"])).alias("__s"))
    counts = d.groupBy(*g, "__all", F.col("__s.i").alias("__i"), F.col("__s.v").alias("__v")).agg(F.count("*").alias("__n"))
    # the rows below a bracket, with no value, come first and hold the ranks before it
    c = running_sums(counts, "__v", ["__n"], [*g, "__i"], prefix="__cum", range_rows=range_rows).filter(F.col("__v").isNotNull())
    q = stage(_at_ranks(c, g, probs, F.col("__i")), "quantiles")
    out = q.filter("__whole").drop("__whole")
    missed = q.filter("NOT __whole").drop("__whole", "quantiles")
    if missed.isEmpty():
        return out
    rest = _same(df, checked_broadcast(missed.withColumn("__m", F.lit(1))), g).drop("__m") if g else df
    return out.unionByName(_counted_quantiles(rest, g, value_col, probs, None, range_rows))


DRIVER_VALUES = 2**16  # distinct values around the quantiles that the driver takes


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], range_rows: int = RANGE_ROWS) -> dict[str, list[float]]:
    """The quantiles of ``exact_quantiles`` for whole columns, by column;
    columns without values have none.

    A row is not copied per column: one aggregation sketches all columns, one
    counts the rows below and inside the brackets, and of the rows that have a
    value inside one only those values are counted.  Where the brackets miss a
    rank, a column is counted value by value."""
    v = {c: F.col(c).cast("double") for c in cols}
    w = {c: F.when(F.isnan(x), F.lit(float("inf"))).otherwise(x) for c, x in v.items()}
    off = 3.0 / BRACKET_ACCURACY
    at = [x for p in probs for x in (max(0.0, p - off), min(1.0, p + off))]
    if not cols:
        return {}
    first = df.agg(*[F.struct(F.percentile_approx(w[c], at, BRACKET_ACCURACY).alias("q"), F.count(v[c]).alias("n")).alias(f"c{i}")
                     for i, c in enumerate(cols)]).first()
    size = {c: first[f"c{i}"]["n"] for i, c in enumerate(cols) if first[f"c{i}"]["n"]}
    # (column, quantile): a single value with all its rows, a bracket, or (None) all values of the column
    brackets: dict[tuple[str, int], tuple[float, float] | None] = {}
    for i, c in enumerate(cols):
        for j in range(len(probs)) if c in size else ():
            lo, hi = first[f"c{i}"]["q"][2 * j:2 * j + 2]
            brackets[c, j] = None if size[c] <= 1 / off else (lo + 0.0, hi + 0.0)
    counted = [k for k, b in brackets.items() if b is not None]
    counts = df.agg(*[F.struct(F.count_if(w[c] < brackets[c, j][0]).alias("below"),
                               F.count_if((w[c] >= brackets[c, j][0]) & (w[c] <= brackets[c, j][1])).alias("inside")).alias(f"k{i}")
                      for i, (c, j) in enumerate(counted)]).first() if counted else []
    found: dict[tuple[str, int], list] = {}  # (value, rows, rows before) of the known runs of ranks
    below = dict.fromkeys(brackets, 0)
    for (c, j), k in zip(counted, counts):
        rank = probs[j] * (size[c] - 1)
        if not (k["below"] <= math.floor(rank) and math.ceil(rank) < k["below"] + k["inside"]):
            brackets[c, j] = None
            continue
        below[c, j] = k["below"]
        if brackets[c, j][0] == brackets[c, j][1] < float("inf"):
            found[c, j] = [(brackets[c, j][0], k["inside"], k["below"])]
    todo = [k for k in brackets if k not in found]
    whole = [c for c in dict.fromkeys(c for c, j in todo if brackets[c, j] is None)]
    todo = [(c, j) for c, j in todo if brackets[c, j] is not None]
    out: dict[str, list] = {c: [None] * len(probs) for c in size}
    if todo or whole:
        take = [(i, c, (w[c] >= brackets[c, j][0]) & (w[c] <= brackets[c, j][1])) for i, (c, j) in enumerate(todo)]
        take += [(len(todo) + i, c, v[c].isNotNull()) for i, c in enumerate(whole)]
        inside = reduce(Column.__or__, [t for _, _, t in take])
        values = F.array(*[F.struct(F.lit(i).alias("i"), F.when(t, v[c]).alias("v")) for i, c, t in take])
        rows = df.filter(inside).select(F.explode(values).alias("__e")).select("__e.i", "__e.v").filter("v IS NOT NULL")
        rows = stage(rows.groupBy("i", "v").agg(F.count("*").alias("n")), "quantile_values")
        if rows.count() <= DRIVER_VALUES:
            runs: dict[int, list] = {}
            for r in sorted(rows.collect(), key=lambda r: (r["i"], math.isnan(r["v"]), r["v"])):
                own = runs.setdefault(r["i"], [])
                own.append((r["v"], r["n"], own[-1][1] + own[-1][2] if own else (below[todo[r["i"]]] if r["i"] < len(todo) else 0)))
            found |= {k: runs[i] for i, k in enumerate(todo)}
            for i, c in enumerate(whole, len(todo)):
                found |= {(c, j): runs[i] for j in range(len(probs)) if brackets[c, j] is None}
        else:
            sums = running_sums(rows, "v", ["n"], ["i"], range_rows=range_rows)
            wanted = [(i, k, below[k]) for i, k in enumerate(todo)]
            wanted += [(i, (c, j), 0) for i, c in enumerate(whole, len(todo)) for j in range(len(probs)) if brackets[c, j] is None]
            ends = []
            for i, (c, j), before in wanted:
                rank = probs[j] * (size[c] - 1)
                ends += [(F.col("i") == i) & (F.col("cum_n") - F.col("n") <= r - before) & (F.lit(r - before) < F.col("cum_n"))
                         for r in (math.floor(rank), math.ceil(rank))]
            held = sums.filter(reduce(Column.__or__, ends)).collect()  # at most two a quantile
            for i, k, before in wanted:
                found[k] = [(r["v"], r["n"], r["cum_n"] - r["n"] + before) for r in held if r["i"] == i]
    for (c, j), runs in found.items():
        rank = probs[j] * (size[c] - 1)
        lo, hi = (next(x for x, n, before in runs if before <= r < before + n) for r in (math.floor(rank), math.ceil(rank)))
        part = rank - math.floor(rank)
        out[c][j] = lo if lo == hi else (1 - part) * lo + part * hi
    return out


def _counted_quantiles(df: DataFrame, g: list[str], value_col: str, probs: Sequence[float], count_col: str | None,
                       range_rows: int) -> DataFrame:
    """Equal values are counted first; the counts' running sums give the ranks
    that a value holds, so no buffer grows with a group."""
    n = F.lit(1) if count_col is None else F.col(count_col)
    counts = (df.select(*g, F.col(value_col).cast("double").alias("__v"), n.alias("__n")).filter(F.col("__v").isNotNull())
              .groupBy(*g, "__v").agg(F.sum("__n").alias("__n")))
    c = running_sums(counts, "__v", ["__n"], g, prefix="__cum", total_prefix="__all", range_rows=range_rows)
    return _at_ranks(c.withColumnRenamed("__all__n", "__all"), g, probs).drop("__whole")


def _at_ranks(c: DataFrame, g: list[str], probs: Sequence[float], index: Column | None = None) -> DataFrame:
    """The quantiles of values that end at rank ``__cum__n`` of ``__all``, and
    whether all their ranks were there; ``index`` tells which of ``probs`` a
    row is for."""
    first, last = F.col("__cum__n") - F.col("__n"), F.col("__cum__n") - 1
    picks = []
    for i, p in enumerate(probs):
        at = F.lit(float(p)) * (F.col("__all") - 1)
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (first <= rank) & (rank <= last)
            picks.append(F.max(F.when(here if index is None else here & (index == i), F.col("__v"))).alias(f"__{side}{i}"))
        picks.append(F.max(at - F.floor(at)).alias(f"__f{i}"))
    q = c.groupBy(*g).agg(*picks)
    values = [F.when(F.col(f"__lo{i}") == F.col(f"__hi{i}"), F.col(f"__lo{i}"))
              .otherwise((1 - F.col(f"__f{i}")) * F.col(f"__lo{i}") + F.col(f"__f{i}") * F.col(f"__hi{i}")) for i in range(len(probs))]
    found = [F.col(f"__{s}{i}").isNotNull() for i in range(len(probs)) for s in ("lo", "hi")]
    return q.select(*g, F.array(*values).alias("quantiles"), reduce(Column.__and__, found).alias("__whole"))
