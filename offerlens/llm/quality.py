"""Quality classifier: a generalised additive model with pairwise interactions.

Each text gives a few numeric features (lengths, character classes,
repetition), computed over the whole text.  The model is a lookup table per
feature and per chosen pair of features over quantile bins, learned by cyclic
gradient boosting of shallow trees on the logistic loss: one small tree per
feature in turn, over and over; then the pairs whose residuals a two-way tree
explains best get tables in the same way.  Scoring adds table entries by
vectorised bin look-ups.

The model is fitted on at most ``FIT_ROWS`` labelled rows outside the held-out
fold, chosen by a hash of the id; features and scores cover all rows.

Results in special cases: null text counts as empty; empty and blank texts
have zero features and get the score that the tables give them; rows without
a label are scored like any other; null labels are not learned from; repeated
rows get equal scores; without labels of both kinds the score is the share of
label 1 (0.5 without any); an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.llm.common import Stages, fold, lean, plain, read_table, ship
from offerlens.llm.registry import register

ship(__name__)

FIT_ROWS = 20_000
BINS, PAIR_BINS = 64, 12
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 60, 6
RATE, LEAST = 0.1, 5
THRESHOLD = 0.7
FEATURES = ("log_words", "word_length", "symbols", "upper", "digits", "short_words", "stops", "commas", "bars", "distinct",
            "repeated_lines", "line_words", "wordlike", "doubled")
_SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,'-")
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_CLEAN = bytes(c for c in range(256) if c >= 0x80 or chr(c).isalpha())


def features(body: bytes | None) -> list[float]:
    t = body or b""
    words = t.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, w = len(t), len(words)
    lines = [x for x in t.split(b"\n") if x.strip()]
    gone = lambda chars: n - len(t.translate(None, chars))
    lengths = np.fromiter(map(len, words), np.int64, w)
    low = [x.lower() for x in words]
    return [float(np.log1p(w)), float(lengths.mean()), gone(_SYMBOLS) / n, gone(_UPPER) / n, gone(_DIGITS) / n,
            float((lengths <= 3).mean()), (t.count(b".") + t.count(b"?")) / w, t.count(b",") / w, t.count(b"|") / w,
            len(set(low)) / w, 1 - len(set(lines)) / len(lines), w / len(lines),
            sum(map(len, words)) and 1 - len(t.translate(None, _CLEAN)) / n, sum(map(bytes.__eq__, low, low[1:])) / w]


def bin_edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaves(grad: np.ndarray, hess: np.ndarray, least: int, count: np.ndarray, depth: int = 2) -> np.ndarray:
    """A shallow tree over the ordered bins: each bin's Newton step."""
    def value(g: float, h: float) -> float:
        return g / (h + 1.0)

    if depth == 0 or len(grad) < 2:
        return np.full(len(grad), value(grad.sum(), hess.sum()))
    g, h, c = np.cumsum(grad)[:-1], np.cumsum(hess)[:-1], np.cumsum(count)[:-1]
    gt, ht, ct = grad.sum(), hess.sum(), count.sum()
    gain = g**2 / (h + 1) + (gt - g)**2 / (ht - h + 1)
    gain[(c < least) | (ct - c < least)] = -1.0
    k = int(np.argmax(gain))
    if gain[k] <= gt**2 / (ht + 1):
        return np.full(len(grad), value(gt, ht))
    return np.concatenate([_leaves(grad[:k + 1], hess[:k + 1], least, count[:k + 1], depth - 1),
                           _leaves(grad[k + 1:], hess[k + 1:], least, count[k + 1:], depth - 1)])


def _pair_leaves(grad: np.ndarray, hess: np.ndarray, count: np.ndarray, least: int) -> tuple[np.ndarray, float]:
    """A two-way tree over the grid: the best cut of one axis, then a cut of
    the other axis on either side.  Returns steps and the gain."""
    best, out = -1.0, np.zeros_like(grad)
    for axis in (0, 1):
        g, h, c = (x if axis == 0 else x.T for x in (grad, hess, count))
        for k in range(1, g.shape[0]):
            step, gain = np.zeros_like(g), 0.0
            for rows in (slice(0, k), slice(k, None)):
                leaf = _leaves(g[rows].sum(0), h[rows].sum(0), least, c[rows].sum(0), 1)
                step[rows] = leaf
                gain += float((leaf * g[rows].sum(0) - leaf**2 * h[rows].sum(0) / 2).sum())
            if gain > best:
                best, out = gain, step if axis == 0 else step.T
    return out, best


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """The additive model: base score, bin edges and tables."""
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    model = {"base": float(np.log(share / (1 - share))), "edges": [], "tables": [], "pairs": [], "pair_edges": [], "pair_tables": []}
    if len(y) == 0 or y.min() == y.max():
        return model
    edges = [bin_edges(x[:, f], BINS) for f in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    z = np.full(len(y), model["base"])

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, b in enumerate(bins):
            m = len(tables[f])
            g, h = gradients()
            step = RATE * _leaves(np.bincount(b, g, m), np.bincount(b, h, m), LEAST, np.bincount(b, minlength=m))
            tables[f] += step
            z += step[b]
    coarse = [bin_edges(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    cells = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(coarse)]

    def grids(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        at, m = cells[i] * shape[1] + cells[j], shape[0] * shape[1]
        g, h = gradients()
        return np.bincount(at, g, m).reshape(shape), np.bincount(at, h, m).reshape(shape), np.bincount(at, minlength=m).reshape(shape)

    gains = []
    for i, j in itertools.combinations(range(x.shape[1]), 2):
        gains.append((_pair_leaves(*grids(i, j), LEAST)[1], i, j))
    pairs = [(i, j) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
    pair_tables = [np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)) for i, j in pairs]
    for _ in range(PAIR_ROUNDS):
        for t, (i, j) in zip(pair_tables, pairs):
            step = RATE * _pair_leaves(*grids(i, j), LEAST)[0]
            t += step
            z += step[cells[i], cells[j]]
    return model | {"edges": edges, "tables": tables, "pairs": pairs, "pair_edges": coarse, "pair_tables": pair_tables}


def score(model: dict, x: np.ndarray) -> np.ndarray:
    z = np.full(len(x), model["base"])
    for f, (e, t) in enumerate(zip(model["edges"], model["tables"])):
        z += t[np.searchsorted(e, x[:, f], side="right")]
    for (i, j), t in zip(model["pairs"], model["pair_tables"]):
        z += t[np.searchsorted(model["pair_edges"][i], x[:, i], side="right"), np.searchsorted(model["pair_edges"][j], x[:, j], side="right")]
    return 1 / (1 + np.exp(-z))


def feature_table(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": plain(pdf["doc_id"]), "x": [features(b) for b in pdf["body"]]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("body")).mapInPandas(lean(run), f"doc_id {kind}, x array<double>")


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 4, held: int = 2,
             fit_rows: int = FIT_ROWS) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs(doc_id, text)``,
    learned from ``labels(doc_id, label)`` outside the fold ``held``."""
    stages = Stages(docs.sparkSession, "quality")
    table = stages.put(feature_table(docs), "features")
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).alias("y"))
    known = known.where(fold("doc_id", modulus) != held).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(fit_rows)
    known = stages.put(known, "labels")
    train = table.join(known, "doc_id").toPandas().sort_values("doc_id")  # at most fit_rows labels
    x = np.array(train["x"].tolist(), float).reshape(len(train), len(FEATURES))
    model = fit(x, train["y"].to_numpy(float))

    @F.pandas_udf("double")
    def scored(v: pd.Series) -> pd.Series:
        return pd.Series(score(model, np.array(v.tolist(), float).reshape(len(v), len(FEATURES))))

    out = table.select("doc_id", (fold("doc_id", modulus) == held).alias("held_out"), scored("x").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


@register("op8_quality_gam")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
