"""Benchmark decontamination by winnowing.

Words are the runs of digits, ASCII letters (lower-cased) and characters above
ASCII.  A window is ``SPAN`` consecutive words of a benchmark item (the whole
item if it has fewer, but not none).  Every window of items and documents is
represented by its winnowed fingerprint: the minimum of its k-gram hashes.
Equal windows have equal fingerprints, so every shared span is guaranteed to
meet.

The items' fingerprints fill a Bloom filter of a fixed size (its size does
not grow with the benchmark; a fuller filter only lets more windows through).
Documents are read once; windows whose fingerprint passes are extended to the
whole window (a 128-bit hash of its words) and joined with the items' windows.
Joined windows are merged to runs of hit words.

Results in special cases: null or empty text and texts without words have
no words and no hits; an item without words has no window; a document shorter
than a window cannot contain it; repeated rows each get their own (equal)
result; a null id is kept as an id like any other; an empty benchmark or
document table gives no hits or no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerlens.llm.common import Stages, bloom_filters, bloom_places, lean, plain, read_table, ship, unpack
from offerlens.llm.minhash import WordHashes
from offerlens.llm.registry import register

ship(__name__)

SPAN = 10
GRAM = 5
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_WORD = bytes(c if c >= 0x80 or 48 <= c < 58 or 97 <= c < 123 else 32 for c in range(256))
_TABLE = bytes(_WORD[_LOWER[c]] for c in range(256))


def word_hashes(body: bytes | None, hashes: WordHashes) -> np.ndarray:
    words = (body or b"").translate(_TABLE).split()
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def _grams(h: np.ndarray, k: int, seed: int) -> np.ndarray:
    out = np.full(len(h) - k + 1, seed, np.uint64)
    for i in range(k):
        out = (out ^ h[i:i + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out


def fingerprints(h: np.ndarray, span: int) -> np.ndarray:
    """For each window of ``span`` words the minimum hash of its k-grams."""
    k = min(GRAM, span)
    g = _grams(h, k, span)
    return np.lib.stride_tricks.sliding_window_view(g, span - k + 1).min(axis=1)


def _windows(h: np.ndarray, span: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hash of the windows that start at ``at``."""
    part = np.lib.stride_tricks.sliding_window_view(h, span)[at]
    hi, lo = np.full(len(at), span, np.uint64), np.full(len(at), span + 1000, np.uint64)
    for i in range(span):
        hi = (hi ^ part[:, i]) * np.uint64(0x9E3779B97F4A7C15)
        hi ^= hi >> np.uint64(32)
        lo = (lo ^ part[:, i]) * np.uint64(0xC2B2AE3D27D4EB4F)
        lo ^= lo >> np.uint64(29)
    return hi, lo


def item_windows(benchmark: DataFrame, span: int) -> DataFrame:
    """``(item_id, span, fp, hi, lo)`` of every window of every item."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for pdf in batches:
            for item, body in zip(pdf["item_id"], pdf["body"]):
                h = word_hashes(body, hashes)
                if len(h):
                    n = min(span, len(h))
                    hi, lo = _windows(h, n, np.arange(len(h) - n + 1))
                    yield pd.DataFrame({"item_id": item, "span": n, "fp": fingerprints(h, n).view(np.int64),
                                        "hi": hi.view(np.int64), "lo": lo.view(np.int64)}).drop_duplicates()

    return benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("body")).mapInPandas(
        lean(run), "item_id string, span int, fp long, hi long, lo long")


def scan(docs: DataFrame, bloom: bytes, spans: list[int]) -> DataFrame:
    """``(doc_id, key, n_words, hits[(pos, span, hi, lo)])``: the windows of
    each document whose fingerprint passes the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom)  # of a fixed size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        bits = unpack(shared.value)
        for pdf in batches:
            n_words, hits = [], []
            for body in pdf["body"]:
                h = word_hashes(body, hashes)
                n_words.append(len(h))
                found = []
                for span in spans:
                    if len(h) < span:
                        continue
                    x, y, z = bloom_places(fingerprints(h, span))
                    at = np.flatnonzero(bits[x] & bits[y] & bits[z])
                    if len(at):
                        hi, lo = _windows(h, span, at)
                        found += [{"pos": p, "span": span, "hi": u, "lo": v} for p, u, v in
                                  zip(at.tolist(), hi.view(np.int64).tolist(), lo.view(np.int64).tolist())]
                hits.append(found)
            yield pd.DataFrame({"doc_id": plain(pdf["doc_id"]), "key": plain(pdf["key"]), "n_words": n_words, "hits": hits})

    # equal rows share a key, and so their hits
    key = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))).cast("binary"))
    return docs.select("doc_id", key.alias("key"), F.col("text").cast("binary").alias("body")).mapInPandas(
        lean(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key string, n_words long, "
             "hits array<struct<pos: long, span: int, hi: long, lo: long>>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """``(doc_id, key, n_words, n_hit, n_items, items_sha256, contaminated)`` per row;
    ``key`` is a digest of the id and the text."""
    stages = Stages(docs.sparkSession, "winnow")
    items = stages.put(item_windows(benchmark, span), "items")
    spans = sorted(r["span"] for r in items.select("span").distinct().collect())  # at most SPAN lengths
    bloom = bloom_filters(items.select("fp"))[0]
    base = stages.put(scan(docs, bloom, spans), "scan")

    hits = base.where(F.size("hits") > 0).select("key", F.explode("hits").alias("h")).select("key", "h.*").distinct()
    windows = stages.put(items.select("item_id", "span", "hi", "lo").distinct(), "windows")
    found = stages.put(hits.join(windows, ["span", "hi", "lo"]).select("key", "pos", "span", "item_id"), "hits")

    ends = found.groupBy("key", "pos").agg(F.max(F.col("pos") + F.col("span")).alias("end"))
    before = Window.partitionBy("key").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)  # one document's hits
    words = F.greatest(F.lit(0), F.col("end") - F.greatest("pos", F.coalesce(F.max("end").over(before), F.lit(0))))
    n_hit = ends.select("key", words.alias("w")).groupBy("key").agg(F.sum("w").alias("n_hit"))
    named = found.select("key", "item_id").distinct().groupBy("key").agg(F.sort_array(F.collect_list(
        F.coalesce("item_id", F.lit("null")))).alias("items"))
    out = base.select("doc_id", "key", "n_words").join(n_hit, "key", "left").join(named, "key", "left")
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.size(items_).cast("long").alias("n_items"),
                      F.sha2(F.array_join(items_, ","), 256).alias("items_sha256"),
                      (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


ORACLE = r"""
WITH lw AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(ws)) AS span, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS w
         FROM bw, LATERAL (SELECT unnest(generate_series(1, len(ws) - least(10, len(ws)) + 1)) AS i) WHERE len(ws) > 0),
dw AS (SELECT doc_id, span, i, array_to_string(ws[i:i + span - 1], ' ') AS w
         FROM lw, (SELECT DISTINCT span FROM win), LATERAL (SELECT unnest(generate_series(1, len(ws) - span + 1)) AS i)),
hit AS (SELECT doc_id, item_id, i, span FROM dw JOIN win USING (span, w)),
pos AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + span - 1)) AS p FROM hit),
n AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
         FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(ws), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM documents d JOIN lw USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@register("op9_winnowing_decontamination", ORACLE)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("key")
