"""A training corpus from raw documents, in stages.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
one's docs.  All but the last return the columns of ``documents``.

* ``toxicity`` drops the documents that the classifier, trained on ``labels``,
  predicts to be toxic;
* ``near_dedup`` keeps the smallest id of every group of near copies
  (five-word shingles, similarity 0.8 or more);
* ``suffix_dedup`` removes every run of bytes inside 200-byte strings that occur
  elsewhere as well, if it holds more than 50 words or 400 bytes (a character cut
  at an edge goes whole); the document stays with what remains;
* ``benchmark_decontamination`` drops the documents that contain a window of a benchmark
  item;
* ``mix`` returns what the mix to target weights takes of every document.

Results in special cases: a null id is no group and stays; of rows equal in id
and text one stays at ``near_dedup``; rows that share an id with different
texts are one document of several forms and go together, when one form is toxic
or a copy of a document with a smaller id; null texts stay as they are; empty
tables give empty results; extra columns are carried through where they do
not clash with a column of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.functions.sizing import checked_broadcast
from offerlens.llm.common import Stages, read_table
from offerlens.llm.decontaminate import decontaminate
from offerlens.llm.mixing import mix
from offerlens.llm.oddsketch import near_duplicate_documents
from offerlens.llm.suffixes import remove_repeats
from offerlens.llm.toxicity import score_documents

# a repeated passage: more than so many words, found by strings of so many bytes
PASSAGE_WORDS, PASSAGE_SPAN = 50, 200
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def text_key():
    """A digest that rows equal in id and text share."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                             F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))).cast("binary"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = score_documents(docs, read_table(spark, sf_dir, "labels"))
    toxic = scored.where((F.col("predicted") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(toxic, "doc_id", "left_anti").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = near_duplicate_documents(docs, shingle=5)
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    kept = docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").withColumn("_key", text_key())
    # repeated rows: only they are brought together
    again = docs.groupBy(text_key().alias("_key")).agg(F.count("*").alias("_n")).where("_n > 1").select("_key")
    again = checked_broadcast(Stages(spark, "repeated-rows").put(again, "keys"))
    one = kept.join(again, "_key", "left_semi").dropDuplicates(["_key"])
    return kept.join(again, "_key", "left_anti").unionByName(one).select(*COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = remove_repeats(docs.select(*COLUMNS), PASSAGE_SPAN, PASSAGE_WORDS)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return out.withColumn("text", text).withColumn(
        "n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    hit = found.where("contaminated").select("key").distinct()
    return docs.select(*COLUMNS).withColumn("_key", text_key()).join(
        hit.withColumnRenamed("key", "_key"), "_key", "left_anti").select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("benchmark_decontamination", benchmark),
    ("mixing", mixing),
]

# the toxicity model has no SQL form; the pipeline is tested against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    stages = Stages(spark, "pipeline")
    for name, stage in STAGES:
        docs = stages.put(stage(spark, docs, sf_dir), name)
    return docs
