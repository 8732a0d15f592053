"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
import gc
import sys
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.session import ensure_checkpoint_dir


def ship(module: str) -> None:
    """Send the module's functions to the executors by value, so a job needs
    no copy of the package on the workers."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def plain(x: pd.Series) -> np.ndarray:
    """A column as Python objects; a string column that came in several Arrow
    chunks cannot be handed back as it is."""
    return x.to_numpy(dtype=object)


def release() -> None:
    """Hand freed memory back to the system: a Python worker lives on after its
    task, idle beside the workers of the next stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable) -> Callable:
    """A function of ``mapInPandas`` whose worker releases memory at the end."""

    @functools.wraps(run)
    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from run(batches)
        release()

    return task


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Stages:
    """Intermediate tables of one operator, written as Parquet to the shared
    checkpoint folder and read back: lineage ends there, so a lost executor
    re-reads files instead of re-running the upstream plan."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def put(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:03d}-{name}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._stage_path = path
        return out

    def together(self, parts: list[DataFrame]) -> DataFrame:
        """Tables of one schema as one scan, however many they are."""
        return self.spark.read.schema(parts[0].schema).parquet(*[p._stage_path for p in parts])

    def drop(self, df: DataFrame) -> None:
        """Remove a table that no later plan reads."""
        self._delete(df._stage_path)

    def clear(self) -> None:
        """Remove all tables, once no later plan reads any."""
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def sorted_join(df: DataFrame) -> DataFrame:
    """The side of a join that is not to be broadcast.  A table is chosen for that
    by the size of its files or shuffle, compressed; in the driver's memory the
    same rows may take thirty times as much."""
    return df.hint("merge")


def fold(col: str, training_modulus: int) -> Column:
    """crc32 of the id as text, modulo: the fold that fixes held-out rows."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(training_modulus))


def connected_components(stages: Stages, edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``edges(a, b)``; a component is
    named by its smallest node.

    Alternating large-star / small-star rounds: the smallest neighbour is a
    partially aggregated minimum joined back to the edges, so a hub's edges
    can be split between tasks; each round is written to the shared folder.
    Rounds end when every component is a star around its smallest node."""
    cur = stages.put(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                     .distinct(), "edges")
    while not _stars(cur):
        both = cur.select("a", "b").union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = (both.join(low, F.col("a") == F.col("k")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        large = stages.put(large, "large")
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
        small = large.join(low, F.col("a") == F.col("k"))
        small = (small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
                 .where("a <> b").distinct())
        nxt = stages.put(small, "small")
        stages.drop(cur)
        stages.drop(large)
        cur = nxt
    roots = cur.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _stars(edges: DataFrame) -> bool:
    """Whether every upper node of ``edges(a, b)``, a > b, has one lower node
    that has none itself."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    per = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per.agg(F.count_if(F.expr("up > 1 OR (up = 1 AND down = 1)"))).first()[0] == 0


BLOOM_BITS = 24  # 2**24 bits, 2 MB: a fixed size, whatever is put in


def bloom_places(x: np.ndarray) -> tuple[np.ndarray, ...]:
    mask = np.uint64(2**BLOOM_BITS - 1)
    x = x.astype(np.uint64) ^ (x.astype(np.uint64) >> np.uint64(32))
    return tuple((x * np.uint64(c) >> np.uint64(24)) & mask for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def bloom_filters(keys: DataFrame) -> list[bytes]:
    """A Bloom filter of each column of longs: one bitmap per task and column,
    combined in a tree, compressed on its way (a task with few keys sends few
    bytes).  What passes is a superset; a fuller filter lets more through."""
    size, n = 2**BLOOM_BITS, len(keys.columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros((n, size), bool)
        for pdf in batches:
            for i in range(n):
                for at in bloom_places(pdf.iloc[:, i].to_numpy(np.int64).view(np.uint64)):
                    bits[i, at] = True
        if bits.any():
            yield pd.DataFrame({"bits": [zlib.compress(np.packbits(bits).tobytes(), 1)]})

    def either(x: bytes, y: bytes) -> bytes:
        if not x or not y:  # nothing yet
            return x or y
        both = [np.frombuffer(zlib.decompress(b), np.uint8) for b in (x, y)]
        return zlib.compress(np.bitwise_or(*both).tobytes(), 1)

    all_ = keys.mapInPandas(lean(run), "bits binary").rdd.map(lambda r: bytes(r[0])).treeAggregate(b"", either, either)
    all_ = zlib.decompress(all_) if all_ else bytes(n * size // 8)
    release()
    return [all_[i * size // 8:(i + 1) * size // 8] for i in range(n)]


def unpack(filter_: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(filter_, np.uint8)).view(bool)


def passing(df: DataFrame, column: str, filter_: bytes) -> DataFrame:
    """The rows whose ``column`` (long) may be in the filter; only that column
    goes through Python."""
    shared = df.sparkSession.sparkContext.broadcast(filter_)  # 2**BLOOM_BITS bits
    cache: dict = {}

    @F.pandas_udf("boolean")
    def inside(x: pd.Series) -> pd.Series:
        if "bits" not in cache:
            cache["bits"] = unpack(shared.value)
        null = x.isna().to_numpy()
        a, b, c = bloom_places(x.fillna(0).to_numpy(np.int64).view(np.uint64))
        return pd.Series(cache["bits"][a] & cache["bits"][b] & cache["bits"][c] & ~null)

    return df.where(inside(column))


ship(__name__)
