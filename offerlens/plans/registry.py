"""Registry of (name -> Spark query, name -> oracle SQL).

Each Spark query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the driver's tables; each oracle is DuckDB SQL over the same tables.  Both
sides alias and type every output column identically (counts BIGINT,
doubles rounded)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
HEADLINE: list[str] = []


def register(name: str, oracle: str | None = None, headline: bool = False):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        if headline:
            HEADLINE.append(name)
        return fn
    return deco


def load_all() -> None:
    # Importing the query modules fills the registry.
    from offerlens.plans import (q_eda, q_evaluate, q_features, q_io,  # noqa: F401
                                 q_ladder, q_metrics, q_model, q_prep)
