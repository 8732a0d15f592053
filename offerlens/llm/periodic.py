"""Runs of repeating words, found with a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period ``q`` (words
``q`` apart are equal), of at least ``exponent * q`` and ``least`` words, that
cannot be extended on either side.  The dictionary names every factor of a
text whose length is a power of two: the name of a factor of length ``2L`` is
the pair of names of its halves.  Per length ``L`` the next occurrence of each
factor is looked up; occurrences within twice the length form an arithmetic
progression, and its difference is the period of the stretch from the first
occurrence to the end of the second.  A period ``q`` with ``L/2 < q <= L`` is
taken from length ``L`` only: a run of exponent 3 or more holds the factor at
its start twice there, and no nearer occurrence, since the root of length
``q <= L`` is primitive.  Neighbouring positions that propose the same period
extend each other to the whole run, so each run comes out once.

A factor that occurs once in its text can be no part of a longer repeated one:
only repeated positions go on to the next length.  Texts are taken in batches,
as one array of words numbered per text.  A run's words after its first ``q``
are repetitions; ``collapsed`` is the text without them, words joined by one
space.

Results in special cases: null, empty and blank texts have no words, no runs
and an empty collapsed text; texts of any length go through whole; null ids,
repeated rows and rows that share an id are kept, each with its own result; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.llm.common import plain, read_table, ship
from offerlens.llm.registry import register

ship(__name__)

BATCH = 2**20  # characters of texts taken together; a longer text goes alone
RUN = "struct<start:long,length:long,period:long>"


def factor_runs(names: np.ndarray, text: np.ndarray, exponent: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of the words ``names`` (whole
    numbers, equal words of a text equal); ``text`` is the text of a word and
    grows."""
    if exponent < 3:
        raise ValueError("a period is taken from one factor length only if the exponent is 3 or more")
    found = [np.zeros((0, 3), np.int64)]
    n, size = len(names), 1
    at = np.arange(n)  # positions whose factor may be repeated
    key = text.astype(np.int64) * (int(names.max(initial=0)) + 1) + names
    longest = int(np.bincount(text).max()) if n else 0
    while len(at) and size < 2 * max(1, longest // exponent):
        order = np.argsort(key, kind="stable")
        near = key[order[1:]] == key[order[:-1]]
        step = np.zeros(len(at), np.int64)  # to the next occurrence, 0: none
        step[order[:-1][near]] = at[order[1:][near]] - at[order[:-1][near]]
        again = step > 0
        again[order[1:][near]] = True
        name = np.zeros(n, np.int64)
        name[at[order]] = np.concatenate([[0], np.cumsum(~near)])
        proposing = (2 * step > size) & (step <= size)
        p, q = at[proposing], step[proposing]
        if len(p):
            cut = np.flatnonzero((np.diff(p) != 1) | (np.diff(q) != 0)) + 1
            first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(p)]]) - 1
            length = p[last] - p[first] + q[first] + size
            good = length >= np.maximum(least, exponent * q[first])
            found.append(np.column_stack([p[first], length, q[first]])[good])
        repeated = np.zeros(n, bool)
        repeated[at[again]] = True
        at = at[again & (at + size < n)]
        at = at[repeated[at + size] & (text[at] == text[at + size])]
        key = name[at] * (len(order) + 1) + name[at + size]
        size *= 2
    runs = np.concatenate(found)
    return tuple(runs[np.lexsort((runs[:, 2], runs[:, 0]))].T)


def _collapse(texts: list, exponent: int, least: int) -> tuple[list, list]:
    """Runs and collapsed text of each text."""
    words = [(x or "").encode().split() for x in texts]  # on white space of ASCII
    count = np.array([len(w) for w in words], np.int64)
    text = np.repeat(np.arange(len(words)), count)
    numbers: dict = {}
    names = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in words for w in ws), np.int64, int(count.sum()))
    start, length, period = factor_runs(names, text, exponent, least)
    drop = np.zeros(len(names) + 1, np.int64)
    np.add.at(drop, start + period, 1)
    np.add.at(drop, start + length, -1)
    keep = np.cumsum(drop)[:-1] == 0
    offset = np.concatenate([[0], np.cumsum(count)])
    runs: list = [[] for _ in words]
    for s, n, q in zip(start.tolist(), length.tolist(), period.tolist()):
        t = int(text[s])
        runs[t].append({"start": s - int(offset[t]), "length": n, "period": q})
    kept = [b" ".join(ws if not r else [w for w, k in zip(ws, keep[offset[i]:offset[i + 1]]) if k]).decode()
            for i, (ws, r) in enumerate(zip(words, runs))]
    return runs, kept


def periodic_runs(docs: DataFrame, exponent: int = 4, least: int = 6) -> DataFrame:
    """``(doc_id, runs, collapsed)`` per row of ``docs(doc_id, text)``; runs by
    start, then period."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            size = pdf["text"].str.len().fillna(0).to_numpy(np.int64)
            part = (np.cumsum(size) - 1) // BATCH
            for _, piece in pdf.groupby(part, sort=False):
                runs, kept = _collapse([None if x is None or x is pd.NA or x != x else x for x in piece["text"]], exponent, least)
                yield pd.DataFrame({"doc_id": plain(piece["doc_id"]), "runs": runs, "collapsed": kept})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, runs array<{RUN}>, collapsed string")


def digest(runs: DataFrame) -> DataFrame:
    """Number of runs, the run of the greatest exact exponent, digests."""
    better = "r.length * b.period > b.length * r.period OR (r.length * b.period = b.length * r.period AND (r.start < b.start OR (r.start = b.start AND r.period < b.period)))"
    best = F.expr(f"aggregate(runs, CAST(NULL AS {RUN}), (b, r) -> IF(b IS NULL OR {better}, r, b))")
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    out = runs.withColumn("best", best)
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
                      F.col("best.period").alias("period"), F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
                      F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with the words of every text whose
    ``h = crc32(doc_id)`` is divisible by 10 repeated from word ``a`` with
    period ``p``; all other texts as they are."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')")
    d = docs.select("doc_id", "text", h.alias("h")).withColumn("g", F.floor(F.col("h") / 10))
    d = d.withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("w"))
    planted = "a + pmod(i - a, p)"
    d = d.withColumn("a", F.expr("IF(n > 0, g % n, 0)")).withColumn("p", F.expr("1 + (n - a) DIV (3 + g % 8)"))
    again = F.expr(f"array_join(transform(sequence(0L, CAST(n - 1 AS BIGINT)), i -> w[CAST(IF(i < a, i, {planted}) AS INT)]), ' ')")
    return d.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))


@register("op12_basic_factor_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(periodic_runs(with_planted_runs(read_table(spark, sf_dir, "documents"))))
