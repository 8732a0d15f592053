"""MinHash near-duplicate documents with odd sketches.

A document's set is its distinct word shingles (A-Z lower-cased, words
separated by ASCII white space).  MinHash samples are banded for candidates;
bottom-k samples fold into a parity bitmap (the odd sketch): the population count of two
sketches' XOR estimates a high similarity precisely, so candidates far below
the threshold go before any set is compared; the rest is confirmed on the
full sets.  Documents are linked at ``100 * intersection >= 80 * union`` and
closed to components.

Results in special cases: null, empty or blank text has an empty set, is
linked with nothing and is its own component; fewer words than a shingle: the
whole sequence is one shingle; repeated rows and equal texts share a
component; a null id is linked with nothing and has a null component (and is
kept); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.llm.common import Stages, read_table
from offerlens.llm.minhash import near_duplicates
from offerlens.llm.registry import register

BANDS, ROWS = 30, 5  # finds a pair at 0.8 with probability 1 - 7e-6
PERCENT = 80
SKETCH = 16  # longs: 1024 bits for the 512 smallest hashes


def near_duplicate_documents(docs: DataFrame, shingle: int = 5, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row."""
    stages = Stages(docs.sparkSession, "oddsketch")
    items = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("body"))
    out = near_duplicates(stages, items, shingle, percent, BANDS, ROWS, SKETCH)
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
                      F.col("id").eqNullSafe(F.col("component")).alias("kept"))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) = 1 THEN ws[1] ELSE ws[i] || ' ' || ws[i + 1] END AS sh
         FROM w, LATERAL (SELECT unnest(generate_series(1, greatest(1, len(ws) - 1))) AS i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (sh) WHERE x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, g.c AS component_id, d.doc_id = g.c AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(c) AS c FROM r GROUP BY node) g ON g.node = d.doc_id
"""


@register("op10_odd_sketch_near_dedup", ORACLE)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_documents(read_table(spark, sf_dir, "documents"), shingle=2)
