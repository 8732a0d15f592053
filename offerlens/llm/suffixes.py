"""Repeated substrings by suffix arrays (linear grouping construction).

Texts are UTF-8 bytes.  A byte goes if it lies in a string of ``span`` bytes
(``SPAN`` unless asked otherwise) that starts anywhere else as well, in the same or
another document; strings are judged on the input and all their occurrences go.
With ``words``, a run of such bytes stays if it is shorter than ``SPAN`` bytes and
holds no more than so many words.

A corpus-wide suffix array cannot be built in one place, so suffixes are first
dealt into small independent sets in which all strings that can be equal meet:

1. every window of ``span`` bytes has an anchor, the position of the least hash
   among its grams of half as many bytes; equal windows have equal anchors.  Anchors
   whose gram occurs once are done, and so are windows around anchors whose
   whole surroundings (all windows of the anchor) occur twice: they repeat;
2. of the others, the windows of an anchor that start 25 j to 25 j + 24 bytes
   before it share 376 of 400 bytes; a hash of these is their set.  In a set a text
   is what is left: up to 24 bytes, one symbol for the shared bytes, and up to
   24 bytes; equal texts are one;
3. the suffix array of the texts of many sets is built by grouping: suffixes
   are grouped by their Lyndon prefix, groups are processed in descending
   order and split by previous-smaller pointers, then each group's order is
   emitted by one ascending pass, without recursive renaming.  A window is
   repeated if a neighbour in the array begins with the same 25 symbols.

Sets above ``SET_TEXTS`` texts are compared by grouping their windows (exact,
partially aggregated) instead of one task's suffix array.

Results in special cases: null and empty texts have no bytes; texts under
``span`` bytes lose nothing; equal rows make each other's long strings repeat;
null ids are ids like any other; an empty table gives an empty result; extra
columns are ignored.  Remaining bytes may end inside a character: ``kept`` has
the bytes, ``kept_text`` only whole characters, as all bytes of a cut one go.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.llm.common import Stages, bloom_filters, bloom_places, lean, plain, read_table, ship, unpack
from offerlens.llm.registry import register

ship(__name__)

SPAN = 400
STEP = 25
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SET_TEXTS = 1_000
CHUNK = 1 << 18
BATCH_TEXTS = 500  # of a suffix array, beyond a set's end


# ---- suffix array ----------------------------------------------------------

def next_smaller(t: str, reach: int) -> list[int]:
    """For each suffix the next suffix that is smaller (len(t) if none).
    ``reach`` symbols tell any two suffixes apart."""
    n = len(t)
    out = [n] * n
    for i in range(n - 2, -1, -1):
        here, j = t[i:i + reach], i + 1
        while j < n and t[j:j + reach] > here:
            j = out[j]
        out[i] = j
    return out


def suffix_array(t: str, reach: int) -> list[int]:
    """Suffix array by linear grouping."""
    n = len(t)
    nss = next_smaller(t, reach)
    parent = [-1] * n  # previous smaller suffix
    stack: list[int] = []
    for i in range(n):
        while stack and nss[stack[-1]] <= i:
            stack.pop()
        parent[i] = stack[-1] if stack else -1
        stack.append(i)
    # groups in ascending order as a linked list; a suffix starts in the group of its first symbol
    at: dict[str, list[int]] = {}
    for i, c in enumerate(t):
        at.setdefault(c, []).append(i)
    members: list[set[int]] = [set(at[c]) for c in sorted(at)]
    group = [0] * n
    for g, m in enumerate(members):
        for i in m:
            group[i] = g
    below = list(range(-1, len(members) - 1))
    above = [*range(1, len(members)), -1]
    g = len(members) - 1
    while g >= 0:
        # this group is final; its members lengthen the Lyndon prefix of their parents by the same word
        times: dict[int, int] = {}
        for i in members[g]:
            p = parent[i]
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for p, k in times.items():
            moved.setdefault((group[p], -k), []).append(p)
        for (old, _), ps in sorted(moved.items()):
            if len(ps) == len(members[old]):
                continue  # all of the group take the same word: its order among the others stays
            members[old].difference_update(ps)
            new = len(members)
            members.append(set(ps))
            for p in ps:
                group[p] = new
            up = above[old]  # most words first, so fewer words come in below
            below.append(old)
            above.append(up)
            above[old] = new
            if up >= 0:
                below[up] = new
        g = below[g]
    start, place = 0, [0] * len(members)
    order = next(i for i in range(len(members)) if below[i] == -1) if n else -1
    while order >= 0:
        place[order] = start
        start += len(members[order])
        order = above[order]
    # after its Lyndon prefix a suffix goes on with a smaller one, whose place is known before
    sa = [0] * n
    follow: dict[int, list[int]] = {}
    for i, j in enumerate(nss):
        follow.setdefault(j, []).append(i)
    for i in follow.get(n, ()):
        sa[place[group[i]]] = i
        place[group[i]] += 1
    for r in range(n):
        for i in follow.get(sa[r], ()):
            sa[place[group[i]]] = i
            place[group[i]] += 1
    return sa


def repeated_starts(texts: list[tuple[int, bytes, bytes]]) -> list[int]:
    """For each text (set, left, right) a bit per number of left bytes whose
    window is in another text of its set as well."""
    parts, owner = [], []
    for i, (s, left, right) in enumerate(texts):
        parts.append("".join(chr(0x100 + c) for c in left) + chr(0x80000 + s) + "".join(chr(0x100 + c) for c in right) + chr(0x10000 + i))
        owner += [(i, len(left) - k) for k in range(len(left) + 1)] + [None] * (len(right) + 1)
    t = "".join(parts)
    sa = suffix_array(t, 2 * STEP + 2)
    bits = [0] * len(texts)
    last = ""
    for r, i in enumerate(sa):
        head = t[i:i + STEP] if owner[i] else ""
        if head and head == last:
            for x in (owner[i], owner[sa[r - 1]]):
                bits[x[0]] |= 1 << x[1]
        last = head
    return bits


# ---- anchors ---------------------------------------------------------------

def gram_of(span: int) -> int:
    """Bytes of a gram: a window has half as many places for an anchor, a
    multiple of ``STEP`` (200 and 201 bytes of 400)."""
    return span - span // 2 // STEP * STEP + 1


class Hashes:
    """Range hashes (two of 64 bits) of all bytes of a chunk."""

    def __init__(self) -> None:
        rng = np.random.default_rng(17)
        self.values = rng.integers(0, 2**64, (2, 256), np.uint64, endpoint=False)
        self.size = 0

    def grow(self, n: int) -> None:
        if n > self.size:
            self.size = max(n, CHUNK + 1)
            self.power, self.inverse = [], []
            for b in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93):
                for to, base in ((self.power, b), (self.inverse, pow(b, -1, 2**64))):
                    x = np.full(self.size, base, np.uint64)
                    x[0] = 1
                    to.append(np.cumprod(x, dtype=np.uint64))

    def load(self, data: np.ndarray) -> None:
        self.grow(len(data) + 1)
        self.sums = []
        for v, p in zip(self.values, self.power):
            s = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(v[data] * p[:len(data)], out=s[1:])
            self.sums.append(s)

    def of(self, a: np.ndarray, b: np.ndarray, which: int = 0) -> np.ndarray:
        h = (self.sums[which][b] - self.sums[which][a]) * self.inverse[which][a]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xC2B2AE3D27D4EB4F)
        return h ^ (h >> np.uint64(29))


def anchors(data: np.ndarray, ends: np.ndarray, hashes: Hashes, span: int = SPAN) -> tuple[np.ndarray, ...]:
    """(anchor, first and last start of its windows, index of the document) of
    a chunk: documents laid end to end."""
    none = np.empty(0, np.int64)
    gram = gram_of(span)
    offsets = span - gram + 1
    hashes.load(data)
    n = len(data)
    if n < span:
        return none, none, none, none
    bits = np.uint64(max(1, int(n).bit_length()))
    i = np.arange(n - gram + 1)
    low = (hashes.of(i, i + gram) >> bits << bits) | i.astype(np.uint64)
    width = 1
    while width * 2 <= offsets:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:len(low) - (offsets - width)], low[offsets - width:])
    p = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    s = np.arange(len(p))
    doc = np.searchsorted(ends, s, side="right")
    good = s + span <= ends[np.minimum(doc, len(ends) - 1)]
    s, p, doc = s[good], p[good], doc[good]
    if not len(s):
        return none, none, none, none
    cut = np.flatnonzero((np.diff(p) != 0) | (np.diff(s) != 1)) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(s)]]) - 1
    return p[first], s[first], s[last], doc[first]


def _chunks(pdf: pd.DataFrame, span: int = SPAN) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(rows, bytes, ends) of texts of ``span`` bytes or more, about CHUNK bytes at once."""
    rows, size = [], 0
    for i, body in enumerate(pdf["body"]):
        if body is not None and len(body) >= span:
            rows.append(i)
            size += len(body)
        if rows and (size >= CHUNK or i == len(pdf) - 1):
            parts = [pdf["body"].iloc[r] for r in rows]
            yield rows, np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(x) for x in parts])
            rows, size = [], 0
    if rows:
        parts = [pdf["body"].iloc[r] for r in rows]
        yield rows, np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(x) for x in parts])


def gram_counts(texts: DataFrame, span: int = SPAN) -> DataFrame:
    """``(h, n)``: the anchors' grams, counted per task."""
    gram = gram_of(span)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for pdf in batches:
            for _, data, ends in _chunks(pdf, span):
                p, *_ = anchors(data, ends, hashes, span)
                h, n = np.unique(hashes.of(p, p + gram), return_counts=True)
                yield pd.DataFrame({"h": h.view(np.int64), "n": n})

    return texts.select("body").mapInPandas(lean(run), "h long, n long")


def surroundings(texts: DataFrame, filter_: bytes, span: int = SPAN) -> DataFrame:
    """``(h, c1, c2, key, lo, hi)``: anchors whose gram may repeat, the hash of
    all their windows' bytes, and the first and last start."""
    shared = texts.sparkSession.sparkContext.broadcast(filter_)
    gram = gram_of(span)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, bits = Hashes(), unpack(shared.value)
        for pdf in batches:
            for rows, data, ends in _chunks(pdf, span):
                p, lo, hi, doc = anchors(data, ends, hashes, span)
                h = hashes.of(p, p + gram)
                x, y, z = bloom_places(h)
                ok = np.flatnonzero(bits[x] & bits[y] & bits[z])
                if not len(ok):
                    continue
                p, lo, hi, doc, h = (v[ok] for v in (p, lo, hi, doc, h))
                begin = np.concatenate([[0], ends])[doc]
                yield pd.DataFrame({"h": h.view(np.int64), "c1": (hashes.of(lo, hi + span) + (p - lo).astype(np.uint64)).view(np.int64),
                                    "c2": hashes.of(lo, hi + span, 1).view(np.int64),
                                    "key": plain(pdf["key"])[np.array(rows)[doc]], "lo": lo - begin, "hi": hi - begin})

    return texts.mapInPandas(lean(run), "h long, c1 long, c2 long, key string, lo long, hi long")


def set_texts(texts: DataFrame, filter_: bytes, span: int = SPAN) -> DataFrame:
    """``(s1, s2, j, left, right, key, at)`` of the anchors in mixed groups:
    their sets, what is left beside the shared bytes, and where these begin."""
    shared = texts.sparkSession.sparkContext.broadcast(filter_)
    gram = gram_of(span)
    common = span - STEP + 1  # bytes that a set's texts share

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, bits = Hashes(), unpack(shared.value)
        for pdf in batches:
            for rows, data, ends in _chunks(pdf, span):
                p, lo, hi, doc = anchors(data, ends, hashes, span)
                h = hashes.of(p, p + gram)
                x, y, z = bloom_places(h)
                ok = np.flatnonzero(bits[x] & bits[y] & bits[z])
                p, lo, hi, doc = (v[ok] for v in (p, lo, hi, doc))
                begin = np.concatenate([[0], ends])[doc]
                raw = data.tobytes()
                for j in range((span - gram + 1) // STEP):
                    at = p - STEP * j  # the shared bytes of this set begin here
                    on = np.flatnonzero((at >= lo) & (at - (STEP - 1) <= hi))
                    if not len(on):
                        continue
                    a, e = at[on], np.minimum(at[on] + common + STEP - 1, hi[on] + span)
                    # with no window that begins at the shared bytes themselves, the text ends inside them
                    full = e >= a + common
                    on, a, e = on[full], a[full], e[full]
                    if not len(on):
                        continue
                    left = np.maximum(lo[on], a - (STEP - 1))
                    yield pd.DataFrame({
                        "s1": hashes.of(a, a + common).view(np.int64), "s2": hashes.of(a, a + common, 1).view(np.int64), "j": j,
                        "left": [raw[u:v] for u, v in zip(left, a)], "right": [raw[u:v] for u, v in zip(a + common, e)],
                        "key": plain(pdf["key"])[np.array(rows)[doc[on]]], "at": a - begin[on]})

    return texts.mapInPandas(lean(run), "s1 long, s2 long, j int, left binary, right binary, key string, at long")


def _arrays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Suffix arrays over whole sets, a few thousand texts at once; the input
    is sorted by set."""
    held: list = []

    def solve(rows: list) -> pd.DataFrame:
        number: dict = {}
        bits = repeated_starts([(number.setdefault(r[:3], len(number)), r[3], r[4]) for r in rows])
        out = [(*r[:5], b) for r, b in zip(rows, bits) if b]
        return pd.DataFrame(out, columns=["s1", "s2", "j", "left", "right", "starts"])

    for pdf in batches:
        for row in pdf[["s1", "s2", "j", "left", "right"]].itertuples(index=False, name=None):
            if len(held) >= BATCH_TEXTS and held[-1][:3] != row[:3]:
                if len(out := solve(held)):
                    yield out
                held = []
            held.append(row)
    if held and len(out := solve(held)):
        yield out


def repeated_windows(stages: Stages, texts: DataFrame, span: int = SPAN) -> DataFrame:
    """``(key, lo, hi)``: runs of starts of repeated windows; ``texts(key, body)``."""
    counts = gram_counts(texts, span).groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    around = stages.put(surroundings(texts, bloom_filters(counts)[0], span), "surroundings")
    same = stages.put(around.groupBy("h", "c1", "c2").agg(F.count("*").alias("n")), "contexts")
    whole = around.join(same.where("n > 1").select("h", "c1", "c2"), ["h", "c1", "c2"], "left_semi").select("key", "lo", "hi")
    mixed = same.groupBy("h").agg(F.count("*").alias("contexts"), F.min("n").alias("least")).where("contexts > 1 AND least = 1").select("h")
    parts = stages.put(set_texts(texts, bloom_filters(mixed)[0], span), "parts")

    name = ["s1", "s2", "j", "left", "right"]
    one = parts.groupBy(*name).agg(F.count("*").alias("n"))
    one = stages.put(one, "set-texts")
    sets = one.groupBy("s1", "s2", "j").agg(F.count("*").alias("texts")).where("texts > 1")
    sets = stages.put(sets, "sets")
    small = one.join(sets.where(F.col("texts") <= SET_TEXTS), ["s1", "s2", "j"], "left_semi").select(*name)
    small = small.repartition("s1", "s2", "j").sortWithinPartitions("s1", "s2", "j")
    found = small.mapInPandas(lean(_arrays), "s1 long, s2 long, j int, left binary, right binary, starts int")
    # the windows of a large set, grouped by what they hold beside the shared bytes
    large = one.join(sets.where(F.col("texts") > SET_TEXTS), ["s1", "s2", "j"], "left_semi")
    k = F.explode(F.sequence(F.greatest(F.lit(0), STEP - 1 - F.length("right")), F.length("left")))
    w = large.where(F.length("left") + F.length("right") >= STEP - 1).select(*name, k.alias("k"))
    w = w.withColumn("window", F.concat(F.expr("substring(left, length(left) - k + 1, k)"), F.expr(f"substring(right, 1, {STEP - 1} - k)")))
    often = stages.put(w.groupBy("s1", "s2", "j", "k", "window").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "large-sets")
    hit = w.join(often, ["s1", "s2", "j", "k", "window"], "left_semi")
    found = found.union(hit.groupBy(*name).agg(F.bit_or(F.expr("shiftleft(1, k)")).alias("starts")))
    every = one.where("n > 1").select(*name, F.lit((1 << STEP) - 1).alias("starts"))
    found = stages.put(found.union(every).groupBy(*name).agg(F.bit_or("starts").alias("starts")), "repeated")
    # runs of starts: at - k for the bits k that leave room on either side
    low = "greatest(0, %d - length(right))" % (STEP - 1)
    bits = F.expr(f"shiftleft(shiftright(starts & (shiftleft(2, length(left)) - 1), {low}), {low})")
    starts = parts.join(found, name).select("key", "at", bits.alias("m")).where("m <> 0")
    runs = F.expr(f"""arrays_zip(
        filter(sequence(0, {STEP - 1}), k -> (shiftright(m, k) & 1) = 1 AND (shiftright(m, k + 1) & 1) = 0),
        filter(sequence(0, {STEP - 1}), k -> (shiftright(m, k) & 1) = 1 AND (shiftright(shiftleft(m, 1), k) & 1) = 0))""")
    starts = starts.select("key", "at", F.explode(runs).alias("run"))
    starts = starts.select("key", (F.col("at") - F.col("run")["0"]).alias("lo"), (F.col("at") - F.col("run")["1"]).alias("hi"))
    return whole.union(starts).distinct()


def cut_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """The bytes of every UTF-8 character of which a byte is in ``gone``."""
    character = np.cumsum((data & 0xC0) != 0x80)
    hit = np.zeros(len(data) + 1, bool)
    hit[character[gone]] = True
    return hit[character]


def long_runs(body: bytes, gone: np.ndarray, words: int) -> np.ndarray:
    """``gone`` without the runs under ``SPAN`` bytes of at most ``words`` words;
    a word counts if no letter of it lies outside."""
    turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]))).reshape(-1, 2)
    spans = np.array([m.span() for m in WORD.finditer(body)], np.int64).reshape(-1, 2)
    out = np.zeros(len(gone), bool)
    for a, b in turn:
        inside = np.searchsorted(spans[:, 1], b, side="right") - np.searchsorted(spans[:, 0], a)
        if b - a >= SPAN or inside > words:
            out[a:b] = True
    return out


def remove_repeats(docs: DataFrame, span: int = SPAN, words: int | None = None) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, kept_text)``
    per row and the row's other columns; ``kept`` are the remaining bytes,
    ``kept_text`` the remaining characters (null if nothing is removed).
    ``span`` is a multiple of ``2 * STEP``."""
    stages = Stages(docs.sparkSession, "suffixes")
    body = F.coalesce("text", F.lit("")).cast("binary")
    docs = docs.withColumn("key", F.md5(body)).withColumn("body", body)
    windows = repeated_windows(stages, docs.select("key", "body"), span)
    runs = windows.groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))  # of one text
    runs = stages.put(runs.select("key", F.col("runs.lo").alias("los"), F.col("runs.hi").alias("his")), "runs")

    @F.pandas_udf("n_removed long, n_spans long, kept_sha256 string, kept binary, characters binary")
    def cut(bodies: pd.Series, los: pd.Series, his: pd.Series) -> pd.DataFrame:
        out = []
        for b, lo, hi in zip(bodies, los, his):
            n, spans, whole = 0, 0, None
            if lo is not None and len(lo):
                edge = np.zeros(len(b) + 1, np.int32)
                np.add.at(edge, lo, 1)
                np.add.at(edge, hi + span, -1)
                gone = np.cumsum(edge[:-1]) > 0
                if words is not None:
                    gone = long_runs(b, gone, words)
                n, spans = int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                data = np.frombuffer(b, np.uint8)
                whole = data[~cut_characters(data, gone)].tobytes()
                b = data[~gone].tobytes()
            out.append((n, spans, hashlib.sha256(b).hexdigest(), b, whole))
        return pd.DataFrame(out, columns=["n_removed", "n_spans", "kept_sha256", "kept", "characters"])

    out = docs.join(runs, "key", "left").withColumn("cut", cut("body", "los", "his"))
    out = out.withColumn("n_bytes", F.length("body").cast("long")).select("*", "cut.*").drop("key", "body", "los", "his", "cut")
    return out.withColumn("kept_text", F.col("characters").cast("string")).drop("characters")


@register("op6_suffix_grouping_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = remove_repeats(docs).withColumn("text", F.coalesce("kept_text", "text", F.lit("")))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text")
