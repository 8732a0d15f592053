"""Queries of this subpackage (name -> Spark query, name -> oracle SQL)."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    import importlib
    for m in ("html", "itq", "paragraphs", "mixing", "ctw", "suffixes", "toxicity", "quality", "decontaminate", "oddsketch",
              "covertree", "periodic", "chat"):
        importlib.import_module(f"offerlens.llm.{m}")
