"""Hard negatives, word runs and chat formatting: brute force, round trips,
special cases."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerlens.llm import chat, covertree, periodic
from tests.conftest import SF_SMALL
from tests.oracle_harness import duck, rows_of


@pytest.mark.parametrize("module, query", [(covertree, "op11"), (chat, "op13")])
def test_oracles(spark, module, query):
    df = getattr(module, query)(spark, SF_SMALL)
    cur = duck(SF_SMALL).execute(module.ORACLE)
    cols = [d[0] for d in cur.description]
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, cur.fetchall())


# hard negatives

VECTORS = "id long, label string, vector array<long>, anchor boolean, v string, dim int, block long, row long, w long"


def plain_negatives(rows, positives=5, negatives=5):
    good = [r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None and None not in r[2]]
    out = []
    for i, label, x, _ in {(i, y, tuple(x), a) for i, y, x, a in good if a}:
        s = sorted((-sum(p * q for p, q in zip(x, z)), j, y) for j, y, z, _ in good if j != i and len(z) == len(x))
        for p, j, _ in [t for t in s if t[2] == label][:positives]:
            near = [t for t in s if t[2] != label and 80 * -p <= 100 * -t[0] <= 100 * -p][:negatives]
            out += [(i, j, r, k, -p, -n) for r, (n, k, _) in enumerate(near, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 3, 4, 5, 6) for r in rows], VECTORS)


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(covertree, "BLOCK", 1)  # 256 rows a block
    monkeypatch.setattr(covertree, "CHUNK", 200)
    centres = rng.normal(size=(7, 6)) * 60
    x = np.floor(centres[rng.integers(0, 7, 1500)] + rng.normal(size=(1500, 6)) * rng.choice([0.5, 4, 30], size=(1500, 1))).astype(int)
    x[rng.integers(0, 1500, 200)] = x[0]  # a large group of copies
    x[rng.integers(0, 1500, 20)] = 0
    label = rng.choice(["a", "b", "c", "d"], p=[0.6, 0.2, 0.15, 0.05], size=1500)
    rows = [(i, label[i], x[i].tolist(), i % 40 == 0) for i in range(1500)]
    got = covertree.hard_negatives(frame(spark, rows))
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows)


def test_hard_negatives_special_cases(spark):
    rows = [(0, "a", [3, 4], True), (0, "a", [3, 4], True), (100, "a", [3, 4], True), (1, "a", [6, 8], False), (2, "b", [3, 4], False),
            (2, "b", [3, 4], False), (3, "c", [5, 5], False), (4, None, [9, 9], False), (None, "b", [9, 9], False), (5, "b", None, True),
            (6, "b", [None, 1], False), (7, "b", [3, 4, 0], False), (8, "a", [1, 1, 1], True), (9, "z", [], True), (10, "y", [], False),
            (11, "z", [], False), (12, "n", [-1, 0], True), (13, "n", [1, 0], False), (14, "o", [-1, 0], False), (15, "b", [2**40, 0], False)]
    got = covertree.hard_negatives(frame(spark, rows)).collect()
    expect = plain_negatives([r if r[0] != 15 else (15, "b", [2**24, 0], False) for r in rows])
    assert sorted(map(tuple, got)) == expect and {r.anchor_id for r in got} == {0, 100, 9}
    assert [r for r in got if r.anchor_id == 9][0].asDict() == {"anchor_id": 9, "positive_id": 11, "rank": 1, "negative_id": 10,
                                                              "positive_score": 0, "negative_score": 0}
    assert covertree.hard_negatives(frame(spark, [])).collect() == []


def test_cover_tree_covers_and_prunes():
    rng = np.random.default_rng(5)
    x = np.floor(np.repeat(rng.normal(size=(40, 8)) * 200, 50, axis=0) + rng.normal(size=(2000, 8)) * 2)
    label = np.array(["a"] * 1500 + ["b"] * 500)
    z = covertree.build(x, label)
    assert sorted(z["points"].tolist()) == list(range(2000))
    norms = np.sqrt((x * x).sum(axis=1))

    def under(i):
        own = z["points"][z["start"][i]:z["stop"][i]].tolist()
        return own + [p for c in range(z["first"][i], z["last"][i]) for p in under(c)]

    for i in range(len(z["centre"])):
        rows, top = under(i), z["norm"][i]
        y = np.column_stack([x[rows], np.sqrt(np.maximum(top**2 - norms[rows]**2, 0))])
        c = np.append(x[z["centre"][i]], np.sqrt(max(top**2 - norms[z["centre"][i]]**2, 0)))
        assert np.sqrt(((y - c)**2).sum(axis=1)).max() <= 2 * top * np.sin(z["angle"][i] / 2) + 1e-6
        for child in range(z["first"][i], z["last"][i]):
            assert z["angle"][child] < z["angle"][i]
    import io
    out = io.BytesIO()
    np.savez(out, x=x.astype(np.int32), ids=np.arange(2000), label=label, **z)
    forest = covertree.Forest(out.getvalue())
    found = forest.search(x[7], 7, "a", True, np.array([-2**62]), np.array([2**62]), 5)
    s = (x[:1500] @ x[7]).astype(int)
    assert found[0] == sorted((-int(s[i]), i, "a") for i in range(1500) if i != 7)[:5]
    assert forest.opened < len(z["centre"]) / 2


# runs of words

def plain_runs(w, e=4, least=6):
    n, out = len(w), []
    for q in range(1, n // e + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            part = w[s:i + q]
            if len(part) >= max(least, e * q) and not any(part[k:] == part[:-k] for k in range(1, q)):
                out.append((s, len(part), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, text):
    import re
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def random_texts(seed, count):
    r = random.Random(seed)
    for _ in range(count):
        n, k = r.choice([0, 1, 5, 6, 7, 20, 60, 130]), r.choice([1, 2, 2, 3, 10])
        w = [r.choice("abcdefghij"[:k]) for _ in range(n)]
        if n and r.random() < 0.6:
            a = r.randrange(n)
            p = 1 + (n - a) // (3 + r.randrange(8))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        yield w


@pytest.mark.parametrize("exponent", [3, 4, 5])
def test_factor_runs_equal_brute_force(exponent):
    texts = list(random_texts(exponent, 400))
    names = np.array([ord(x) for w in texts for x in w], np.int64)
    text = np.repeat(np.arange(len(texts)), [len(w) for w in texts])
    got = list(zip(*(x.tolist() for x in periodic.factor_runs(names, text, exponent, 6))))
    offset = np.cumsum([0] + [len(w) for w in texts]).tolist()
    assert got == [(s + o, n, q) for w, o in zip(texts, offset) for s, n, q in plain_runs(w, exponent)]
    with pytest.raises(ValueError):
        periodic.factor_runs(names, text, 2, 6)


DOCS = "doc_id long, text string, runs string, h long, g long, w string, n long, a long, p long"


def test_runs_query_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(periodic, "BATCH", 300)
    seps = [" ", "\n", "  \t", " \x0b", "\r\n"]
    r = random.Random(2)
    texts = [r.choice(seps).join(w) for w in random_texts(11, 300)]
    texts += [None, "", " \n ", "é é " * 9, "one", "a\x1cb " * 8, "no break " * 7]
    texts.append(" ".join(["x y z"] * 5000 + [str(i) for i in range(3000)] + ["q"] * 4000))
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "b b b b b b b"), (4, texts[4]), (4, texts[5])]
    d = spark.createDataFrame([(*x, "r", 1, 1, "w", 1, 1, 1) for x in docs], DOCS)
    out = periodic.digest(periodic.periodic_runs(periodic.with_planted_runs(d)))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(str(plain_digest(*x)) for x in docs)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in docs) > 10
    assert periodic.periodic_runs(d.limit(0)).collect() == []
    long = [x for x in periodic.periodic_runs(d).where("doc_id = 307").collect()][0]
    assert [tuple(x) for x in long.runs] == [(0, 15000, 3), (18000, 4000, 1)]
    assert long.collapsed == " ".join(["x y z"] + [str(i) for i in range(3000)] + ["q"])


# chat

TURNS = "conv_id long, turn long, role string, text string, part long, whole boolean, loss string, formatted string"
CONTROL = ["</s>", "<s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[AS]", "[/ROLE]"]


def nasty(r):
    bits = CONTROL + [c[0] + "\\" * r.randint(1, 3) + c[1:] for c in CONTROL] + ["<", "[", "\\", "/s>", "INST]", " ", "\n", "é", "", "𝒳", "s>"]
    return "".join(r.choice(bits) for _ in range(r.randint(0, 8)))


def plain_chat(rows):
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    out = []
    for conv, turns in convs.items():
        turns = [(t[3], t[5]) for t in sorted(turns)]
        learned = "".join(x for y, x in turns if y == "assistant")
        out.append((conv, len(turns), hashlib.sha256("".join(f"{y}\n{x}\n" for y, x in turns).encode()).hexdigest(), len(learned),
                    hashlib.sha256(learned.encode()).hexdigest()))
    return sorted(out, key=str)


def chat_rows():
    r = random.Random(8)
    rows = [(c, t, r.choice(["system", "user", "assistant", "assistant", "tool", "a [AS] b"]), nasty(r)) for c in range(60) for t in range(r.randint(1, 7))]
    rows += [(100, t, "user" if t % 2 else "assistant", nasty(r)) for t in range(1500)]  # one conversation over all tasks
    rows += [(None, 0, "user", "x"), (None, None, None, None), (200, None, "assistant", None), (200, None, "assistant", "a" * 300000 + "é"),
             (201, 1, "assistant", "[INST]"), (201, 1, "assistant", "[INST]"), (201, 1, "assistant", "</s>"), (202, 5, "user", ""), (203, 0, "", "")]
    return rows


@pytest.mark.parametrize("piece, copy, batch", [(2**26, 2**22, 10000), (700, 64, 7)])
def test_chat_round_trip(spark, monkeypatch, piece, copy, batch):
    monkeypatch.setattr(chat, "PIECE", piece)
    monkeypatch.setattr(chat, "COPY", copy)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        rows = chat_rows()
        turns = spark.createDataFrame([(*x, 1, True, "l", "f") for x in rows], TURNS).repartition(5)
        parts = chat.format_conversations(turns)
        got = chat.digests(parts)
        assert sorted((tuple(x)[:5] for x in got.collect()), key=str) == plain_chat(rows)
        every = parts.collect()
        assert len(got.collect()) == len({x[0] for x in rows}) and sum(x.turns for x in every) == len(rows)
        cut = collections.Counter(x.conv_id for x in every)
        assert all(cut[x.conv_id] == 1 for x in every if x.whole) and sum(x.whole for x in every) > 20
        chars = {x.conv_id: x.formatted_chars for x in got.collect()}
        for conv in (100, 200):
            assert chars[conv] == sum(len(x.formatted) for x in every if x.conv_id == conv)
        assert chat.digests(chat.format_conversations(turns.limit(0))).collect() == []
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def test_chat_template(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "</s>[INST] ok"), (1, 2, "assistant", "<\\s>é"), (1, 3, "tool", "x")]
    row = chat.format_conversations(spark.createDataFrame([(*x, 1, True, "l", "f") for x in rows], TURNS)).collect()[0]
    assert row.formatted == "[SYS] be kind [/SYS][INST] <\\/s>[\\INST] ok [/INST]<s> <\\\\s>é </s>[ROLE] tool [AS] x [/ROLE]"
    data = row.formatted.encode()
    assert [data[s.start:s.end].decode() for s in row.loss] == ["<\\\\s>é"] and row.turns == 4
    assert list(chat.read_back(row.formatted)) == [x[2:] for x in rows]
    with pytest.raises(ValueError):
        list(chat.read_back(row.formatted + "x"))


def test_pipeline_keeps_one_of_repeated_rows(spark):
    import corpus_pipeline
    words = [f"w{i}" for i in range(200)]
    docs = spark.createDataFrame([(1, " ".join(words), "en", "s", 1, "x"), (1, " ".join(words), "en", "s", 1, "x"), (2, " ".join(words), "de", None, 1, "y"),
                                  (3, "other words here", "en", "s", 2, "z"), (None, None, None, None, None, None), (None, None, None, None, None, None)],
                                 "doc_id long, text string, lang string, source string, n_chars long, _n string")
    out = corpus_pipeline.near_dedup(spark, docs, SF_SMALL)
    assert out.columns == corpus_pipeline.COLUMNS and sorted(str(r.doc_id) for r in out.collect()) == ["1", "3", "None"]
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), SF_SMALL).collect() == []
