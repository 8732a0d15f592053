"""Toxicity by a subsequence string kernel with Nystroem landmarks.

The kernel of two words is the gap-weighted sum over their common character
subsequences of length ``P`` (a gap costs ``DECAY`` per character), normalised,
so insults with inserted characters, gaps or other endings stay close to the
plain ones.  A linear support vector machine is trained on the Nystroem
features ``K(x, landmarks) K(landmarks, landmarks)^(-1/2)``.

Training uses sentences of at most ``FIT_DOCS`` labelled documents of each
label outside the held-out fold (chosen by a hash of the id).  A toxic
document's label belongs to some sentence of it, and there to some word: the
witnesses are the words that set toxic from other documents, taken greedily
until no further word covers two more toxic documents (a word that is surely
on the toxic side may cover a document a second and third time).  Words of documents
with label 0 are the negatives.  The machine's weights fold into one weight
per subsequence, so a word is scored by summing over its own subsequences.

A document's margin is the largest of its words, whole text; words above
``WIDTH`` characters are scored in overlapping windows over all of it, runs of
single characters are also read as one word.  Platt scaling on the training
labels maps margins to scores.

Results in special cases: null, empty and blank texts have the score of the
lowest margin; null labels are not learned from; repeated rows get equal
scores; without training labels of both kinds every score is the share of
label 1 (0 without any); an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import string
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.llm.common import Stages, fold, lean, plain, read_table, release, ship
from offerlens.llm.registry import register

ship(__name__)

P, DECAY, ALPHABET = 3, 0.6, 32
WIDTH, STEP = 16, 8
FIT_DOCS = 6_000
CANDIDATES, NEGATIVES, LANDMARKS = 4_000, 12_000, 160
LOWEST = -4.0
LEAST_ODDS, SURE_ODDS = 1.5, 2.5
THRESHOLD = 0.7
_EDGES = string.punctuation + "¡¿«»“”„‘’…–—"
_NO_EDGES = dict.fromkeys(map(ord, _EDGES))
# fixed values: characters commonly written for letters
_LOOKS = dict(zip("013457@$!|+", "oieastasiit"))


def _class(c: int) -> int:
    """a-z: 1 to 26, also with accents, as capitals and in look-alikes; other characters 27 to 31."""
    x = _LOOKS.get(chr(c)) or unicodedata.normalize("NFKD", chr(c))[0].lower()
    return ord(x) - 96 if "a" <= x <= "z" else 27 + c % 5


_CODE = np.array([_class(c) for c in range(0x250)], np.int64)


def encode(words: list[str], n: int) -> np.ndarray:
    """(len(words), n) character classes of words of n characters."""
    cp = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), n).astype(np.int64)
    return np.where(cp < len(_CODE), _CODE[np.minimum(cp, len(_CODE) - 1)], 27 + cp % 5)


def pieces(word: str) -> list[str]:
    """The word without punctuation around it, and also without any inside;
    long ones in overlapping windows."""
    w = word.lower().strip(_EDGES)
    bare = w if w.isalnum() else w.translate(_NO_EDGES)
    out = []
    for x in (w,) if bare == w else (w, bare):
        out += [x] if len(x) <= WIDTH else [x[i:i + WIDTH] for i in range(0, len(x) - WIDTH + STEP, STEP)]
    return out


def self_kernel(c: np.ndarray) -> np.ndarray:
    """K(x, x) of each row, by the usual recursion over prefixes."""
    m, n = c.shape
    same = c[:, :, None] == c[:, None, :]
    prev = np.ones((m, n + 1, n + 1))
    for _ in range(P - 1):
        cur, row = np.zeros((m, n + 1, n + 1)), np.zeros((m, n + 1, n + 1))
        for i in range(1, n + 1):
            for j in range(1, n + 1):
                row[:, i, j] = DECAY * row[:, i, j - 1] + same[:, i - 1, j - 1] * DECAY**2 * prev[:, i - 1, j - 1]
            cur[:, i] = DECAY * cur[:, i - 1] + row[:, i]
        prev = cur
    return DECAY**2 * np.einsum("mij,mij->m", same, prev[:, :n, :n])


def _triples(n: int) -> Iterator[tuple[int, int, int]]:
    for i in range(n - 2):
        for j in range(i + 1, n - 1):
            for k in range(j + 1, n):
                yield i, j, k


def embed(words: list[str]) -> np.ndarray:
    """Dense subsequence features, normalised; for a bounded list."""
    out = np.zeros((len(words), ALPHABET**P), np.float32)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths[lengths >= P]):
        at = np.flatnonzero(lengths == n)
        c = encode([words[i] for i in at], int(n))
        for i, j, k in _triples(int(n)):
            out[at, (c[:, i] * ALPHABET + c[:, j]) * ALPHABET + c[:, k]] += DECAY ** (k - i + 1)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def kernel(words: list[str], marks: np.ndarray) -> np.ndarray:
    """Normalised kernel of words and embedded landmarks."""
    used = np.flatnonzero(marks.any(axis=0))
    m = np.ascontiguousarray(marks[:, used].T)
    out = []
    for i in range(0, len(words), 500):
        few = [embed(words[k:k + 50])[:, used] for k in range(i, min(i + 500, len(words)), 50)]  # all subsequences of a few words at once
        out.append(np.concatenate(few) @ m)
    return np.concatenate(out)


def margins(words: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    """The machine's margin of each word (at most WIDTH characters each)."""
    out = np.full(len(words), bias)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths[lengths >= P]):
        at = np.flatnonzero(lengths == n)
        for part in np.array_split(at, -(-len(at) // 8192)):
            c = encode([words[i] for i in part], int(n))
            total = np.zeros(len(part))
            for i, j, k in _triples(int(n)):
                total += weights[(c[:, i] * ALPHABET + c[:, j]) * ALPHABET + c[:, k]] * DECAY ** (k - i + 1)
            out[part] = bias + total / np.sqrt(self_kernel(c))
    return out


def fit(witnesses: list[str], others: list[str]) -> tuple[np.ndarray, float]:
    """(weight per subsequence, bias) of the support vector machine.  All
    witnesses are landmarks, beside them as many of the negatives nearest to a
    witness (``LANDMARKS`` at least)."""
    pos = sorted({p for w in witnesses for p in pieces(w) if len(p) >= P})
    neg = sorted({p for w in others for p in pieces(w) if len(p) >= P} - set(pos))
    if not pos or not neg:
        return np.zeros(ALPHABET**P), LOWEST
    e_pos = embed(pos)
    hard = np.argsort(-kernel(neg, e_pos).max(axis=1), kind="stable")[:max(LANDMARKS, len(pos))]
    marks = np.concatenate([e_pos, embed([neg[i] for i in hard])])
    kmm = (marks @ marks.T).astype(float)
    val, vec = np.linalg.eigh(kmm)
    root = (vec / np.sqrt(np.maximum(val, 1e-3))) @ vec.T
    x = kernel(pos + neg, marks).astype(float) @ root
    y = np.concatenate([np.ones(len(pos)), -np.ones(len(neg))])
    weight = np.where(y > 0, len(neg) / len(pos) * 0.5, 1.0)
    # squared hinge loss by Newton steps on the active rows
    x1 = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    del x, e_pos
    v = np.zeros(x1.shape[1])
    for _ in range(40):
        active = y * (x1 @ v) < 1
        a = x1[active] * weight[active, None]
        h = a.T @ x1[active] + np.diag([1.0] * len(marks) + [1e-3])
        new = np.linalg.solve(h, a.T @ y[active])
        if np.abs(new - v).max() < 1e-6:
            break
        v = new
    alpha = root @ v[:-1]
    return (alpha @ marks).astype(float), float(v[-1])


def training_words(stages: Stages, docs: DataFrame, known: DataFrame) -> tuple[list[str], list[str], DataFrame]:
    """(witnesses, words of other documents, all counted words) of the bounded
    training sample."""
    texts = stages.put(docs.join(known, "doc_id").select("doc_id", "y", "text").dropDuplicates(["text", "y"]), "texts")
    n = {r["y"]: r["n"] for r in texts.groupBy("y").agg(F.count("*").alias("n")).collect()}
    sentence = F.explode(F.split("text", r"[\n.!?]+"))
    words = texts.select("doc_id", "y", sentence.alias("s")).select("doc_id", "y", F.explode(F.split(F.lower("s"), r"\s+")).alias("w"))
    words = words.select("doc_id", "y", F.regexp_replace("w", r"^[\p{Punct}]+|[\p{Punct}]+$", "").alias("w")).where(F.length("w") >= P).distinct()
    words = stages.put(words, "words")
    by = words.groupBy("w").agg(F.sum((F.col("y") == 1).cast("long")).alias("a"), F.sum((F.col("y") == 0).cast("long")).alias("b"))
    by = stages.put(by, "word-counts")
    n1, n0 = n.get(1, 0), n.get(0, 0)
    odds = F.log((F.col("a") + 0.5) / (n1 + 1.0)) - F.log((F.col("b") + 0.5) / (n0 + 1.0))
    z = odds - 1.64 * F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))  # lower bound of the log odds
    top = by.where("a >= 2").select("w", z.alias("z")).where(F.col("z") > LEAST_ODDS).orderBy(F.desc("z"), "w").limit(CANDIDATES)
    top = stages.put(top, "candidates")
    places = (words.where("y = 1").join(top, "w").groupBy("w").agg(F.first("z").alias("z"), F.collect_set("doc_id").alias("ids"))
              .collect())  # at most CANDIDATES words in FIT_DOCS documents
    covered: dict = {}
    witnesses: list[str] = []
    for r in sorted(places, key=lambda r: (-r["z"], r["w"])):
        most = 3 if r["z"] > SURE_ODDS else 1
        if sum(covered.get(i, 0) < most for i in r["ids"]) >= 2:
            witnesses.append(r["w"])
            for i in r["ids"]:
                covered[i] = covered.get(i, 0) + 1
    other = by.where("b > 0").select("w").orderBy(F.xxhash64("w")).limit(NEGATIVES)
    return witnesses, sorted({r["w"] for r in other.collect()} | {r["w"] for r in by.orderBy(F.desc("b"), "w").limit(2000).collect()}), by


def hard_negatives(by: DataFrame, weights: np.ndarray, bias: float) -> list[str]:
    """The words of documents with label 0 only that a first machine takes for toxic most."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            known = Margins(weights, bias)
            known.learn(set(pdf["w"]))
            yield pd.DataFrame({"w": plain(pdf["w"]), "m": pdf["w"].map(known.__getitem__)})

    m = by.where("b > 0 AND a * 20 <= b").select("w").mapInPandas(lean(run), "w string, m double")
    return [r["w"] for r in m.orderBy(F.desc("m"), "w").limit(2000).collect()]


class Margins(dict):
    """Margin of each token seen by this task; emptied when it gets large."""

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        super().__init__()
        self.weights, self.bias = weights, bias

    def learn(self, tokens: set[str]) -> None:
        new = [t for t in tokens if t not in self]
        if len(self) + len(new) > 1_500_000:
            self.clear()
            new = list(tokens)
        parts = [pieces(t) for t in new]
        flat = [p for x in parts for p in x]
        m = margins(flat, self.weights, self.bias)
        i = 0
        for t, x in zip(new, parts):
            self[t] = float(m[i:i + len(x)].max())
            i += len(x)


def tokens(text: str | None) -> list[str]:
    """White-space tokens, and runs of single characters read as one word."""
    words = (text or "").split()
    if sum(1 for w in words if len(w) == 1) > 3:
        run: list[str] = []
        for w in [*words, ""]:
            if len(w) == 1 and (w.isalnum() or w in "@$!*"):
                run.append(w)
            else:
                if len(run) > 3:
                    words.append("".join(run))
                run = []
    return words


def document_margins(docs: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Margins(weights, bias)
        for pdf in batches:
            out = []
            for i in range(0, len(pdf), 256):
                lists = [tokens(t) for t in pdf["text"].iloc[i:i + 256]]
                known.learn(set().union(*lists))
                out += [max(map(known.__getitem__, x), default=LOWEST) for x in lists]
            yield pd.DataFrame({"doc_id": plain(pdf["doc_id"]), "margin": np.maximum(out, LOWEST)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(lean(run), f"doc_id {kind}, margin double")


def platt(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the scores ``1 / (1 + exp(-(slope m + offset)))``."""
    n1, n0 = y.sum(), (1 - y).sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, v = np.stack([m, np.ones(len(m))], axis=1), np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (t - p) - 1e-6 * v)
        v = v + step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return float(v[0]), float(v[1])


def score_documents(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, fit_docs: int = FIT_DOCS) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs(doc_id, text)``,
    learned from ``labels(doc_id, toxic)`` outside the fold ``held``."""
    stages = Stages(docs.sparkSession, "toxicity")
    docs = docs.select("doc_id", "text")
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (fold("doc_id", modulus) != held))
    known = known.select("doc_id", F.col("toxic").alias("y"))
    known = stages.put(known.where("y = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs)
                       .union(known.where("y = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs)), "labels")
    witnesses, others, by = training_words(stages, docs, known)
    weights, bias = fit(witnesses, others)
    if weights.any():
        weights, bias = fit(witnesses, others + hard_negatives(by, weights, bias))
    release()
    table = stages.put(document_margins(docs, weights, bias), "margins")
    train = table.join(known, "doc_id").select("doc_id", "margin", "y").toPandas().sort_values(["doc_id", "margin", "y"])
    y = train["y"].to_numpy(float)
    if len(y) and 0 < y.sum() < len(y):
        slope, offset = platt(train["margin"].to_numpy(float), y)
        score = 1 / (1 + F.exp(-(F.col("margin") * slope + offset)))
    else:
        score = F.lit(float(y.mean()) if len(y) else 0.0)
    out = table.select("doc_id", (fold("doc_id", modulus) == held).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


@register("op7_subsequence_kernel_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
