"""Small tests of the training-data operators: brute force, special cases."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.oracle_harness import duck, rows_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, body string, n long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(400)) for _ in range(n))


def rows(texts):
    # extra columns with names that the operators use inside
    return [(i, t, "en" if i else None, None if i == 1 else f"s{(i or 0) % 3}", len(t or ""), "k", "b", 1) for i, t in texts]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank, long, repeated rows, ties, a null id."""
    long = prose(5, 6000)
    base = prose(1, 300)
    near = base.replace(base.split()[7], "changed", 1)
    texts = [(0, None), (1, ""), (2, "  \n \t"), (3, "one"), (4, base), (5, base), (6, near), (7, long), (8, long),
             (4, base), (None, prose(9, 40)), (10, prose(10, 120))]
    return spark.createDataFrame(rows(texts), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", ["op2_itq_near_dedup", "op4_mix_sources", "op9_winnowing_decontamination", "op10_odd_sketch_near_dedup"])
def test_oracles(spark, name):
    from offerlens.llm import registry
    registry.load_all()
    df = registry.QUERIES[name](spark, SF_SMALL)
    cur = duck(SF_SMALL).execute(registry.ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, cur.fetchall())


def test_near_documents_special_cases(odd, none):
    from offerlens.llm.oddsketch import near_duplicate_documents
    got = near_duplicate_documents(odd, shingle=2).collect()
    comp = collections.defaultdict(set)
    for r in got:
        comp[r.doc_id].add(r.component_id)
    assert len(got) == odd.count()
    assert comp[4] == comp[5] == comp[6] == {4} and comp[7] == comp[8] == {7}
    assert all(comp[i] == {i} for i in (0, 1, 2, 3, 10)) and comp[None] == {None}
    assert {r.doc_id: r.n_shingles for r in got}[3] == 1 and {r.doc_id: r.n_shingles for r in got}[2] == 0
    assert near_duplicate_documents(none).collect() == []


def test_mix_special_cases(odd, none):
    from offerlens.llm.mixing import mix
    got = mix(odd).collect()
    assert len(got) == odd.count() and all(r.taken <= 2 * r.size for r in got)
    total = sum(r.size for r in got)
    taken = collections.Counter()
    for r in got:
        taken[r.source] += r.taken
    targets = {r.source: r.target for r in got}
    assert abs(sum(targets.values()) - 1.5 * total) < 1e-6 * total
    for s, t in targets.items():
        assert abs(taken[s] - t) <= 0.02 * t + 64
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mix(odd).collect()), key=str)
    assert mix(none).collect() == []


def test_decontamination_special_cases(spark, odd, none):
    from offerlens.llm.decontaminate import decontaminate
    shared = " ".join(prose(10, 120).split()[30:45])
    items = spark.createDataFrame([(1, shared, "x"), (2, "one", "x"), (3, None, "x"), (10, "one", "x"), (4, "", "x")],
                                  "item_id long, text string, key string")
    got = {r.doc_id: r for r in decontaminate(odd, items).collect()}
    assert (got[10].n_hit, got[10].n_items) == (15, 1) and not got[4].contaminated and got[0].n_words == 0
    assert got[3].n_hit == 1 and got[3].items_sha256 == hashlib.sha256(b"10,2").hexdigest()
    assert got[1].items_sha256 == hashlib.sha256(b"").hexdigest()
    assert decontaminate(none, items).collect() == [] and not any(r.contaminated for r in decontaminate(odd, items.limit(0)).collect())


def test_suffix_array_by_grouping():
    from offerlens.llm.suffixes import suffix_array
    r = random.Random(3)
    for _ in range(200):
        t = "".join(r.choice("abc"[:r.randint(1, 3)]) for _ in range(r.randint(0, 40))) + "!"
        assert suffix_array(t, 100) == sorted(range(len(t)), key=lambda i: t[i:])


@pytest.mark.parametrize("limit", [1000, 1])
def test_suffix_dedup_brute_force(spark, odd, none, monkeypatch, limit):
    from offerlens.llm import suffixes
    monkeypatch.setattr(suffixes, "SET_TEXTS", limit)  # 1: every set is a large one
    passage = prose(20, 90)
    texts = [(100 + i, prose(30 + i, 40) + passage[:380 + 5 * i] + prose(60 + i, 40)) for i in range(12)] + [(200, "ab" * 500), (201, "ä" * 450)]
    docs = odd.union(spark.createDataFrame(rows(texts), DOCS))
    data = [((r.text or "").encode(), r.doc_id) for r in docs.collect()]
    n = collections.Counter(b[i:i + 400] for b, _ in data for i in range(len(b) - 399))
    want = []
    for b, i in data:
        gone = bytearray(len(b))
        for k in range(len(b) - 399):
            if n[b[k:k + 400]] > 1:
                gone[k:k + 400] = b"\1" * 400
        kept = bytes(x for x, g in zip(b, gone) if not g)
        want.append((i, len(b), sum(gone), sum(g > p for g, p in zip(gone, b"\0" + gone)), hashlib.sha256(kept).hexdigest()))
    got = suffixes.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert suffixes.remove_repeats(none).collect() == []


@pytest.mark.parametrize("limit", [1000, 1])
def test_suffix_dedup_of_passages_brute_force(spark, odd, monkeypatch, limit):
    """Runs of 200-byte strings go with more than 50 words or 400 bytes."""
    import corpus_pipeline as p
    from offerlens.llm import suffixes
    monkeypatch.setattr(suffixes, "SET_TEXTS", limit)
    short, few, wide = (prose(seed, 90).split() for seed in (22, 23, 24))
    short = [w[:4] for w in short]
    shared = [" ".join(short[:51]), " ".join(few[:40])[:390], " ".join(w * 3 for w in wide[:30])]
    texts = [(300 + i, f"{prose(40 + i, 30 + i)} {' '.join(shared[k:k + 1])} {prose(80 + i, 30 + i)}") for i in range(9) for k in (i % 3,)]
    docs = odd.union(spark.createDataFrame(rows(texts), DOCS))
    data = [((r.text or "").encode(), r.doc_id) for r in docs.collect()]
    n = collections.Counter(b[i:i + 200] for b, _ in data for i in range(len(b) - 199))
    want, seen = [], set()
    for b, i in data:
        gone = bytearray(len(b) + 1)
        for k in range(len(b) - 199):
            if n[b[k:k + 200]] > 1:
                gone[k:k + 200] = b"\1" * 200
        kept, at = b"", 0
        for m in re.finditer(b"\1+", bytes(gone)):
            words = sum(m.start() <= w.start() and w.end() <= m.end() for w in re.finditer(rb"[^\x20\x09-\x0D]+", b))
            seen.add((words > 50, m.end() - m.start() >= 400))
            if words > 50 or m.end() - m.start() >= 400:
                kept, at = kept + b[at:m.start()], m.end()
        kept += b[at:]
        want.append((i, len(b), len(b) - len(kept), hashlib.sha256(kept).hexdigest()))
    assert {(True, False), (False, False), (False, True)} <= seen
    got = suffixes.remove_repeats(docs, p.PASSAGE_SPAN, p.PASSAGE_WORDS).select("doc_id", "n_bytes", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_pipeline_removes_short_worded_passages(spark):
    """A passage of 51 words in fewer than 400 bytes goes from every document."""
    import corpus_pipeline as p
    passage = " ".join(w[:4] for w in prose(25, 51).split())
    assert len(passage) < 400 and len(passage.split()) == 51
    texts = [(i, f"{prose(50 + i, 30)} {passage} {prose(90 + i, 30)}") for i in range(3)] + [(9, prose(99, 60))]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in p.suffix_dedup(spark, docs, "").collect()}
    assert got[9] == texts[3][1] and all(passage not in got[i] and prose(50 + i, 30) in got[i] for i in range(3))


def test_suffix_dedup_query_returns_the_kept_text(spark, tmp_path):
    from offerlens.llm import suffixes
    passage, ends = prose(21, 90)[:420], [(prose(31, 9), prose(61, 9)), (prose(32, 9), prose(62, 9))]
    docs = [(i, f"{a}{passage}{b}") for i, (a, b) in enumerate(ends)] + [(2, prose(33, 20)), (3, None), (4, passage)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in suffixes.op6(spark, str(tmp_path)).collect()}
    assert got[2].text == prose(33, 20) and got[3].text == got[4].text == "" and got[4].n_removed == 420
    assert all(passage not in r.text and hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256 for r in got.values())
    assert got[0].n_removed >= 420 and got[0].n_bytes == len(docs[0][1])


def test_bloom_filters_move_few_bytes_for_few_keys(spark, monkeypatch):
    from pyspark import RDD

    from offerlens.llm.common import BLOOM_BITS, bloom_filters, bloom_places, unpack
    sent = []
    aggregate = RDD.treeAggregate

    def seen(rdd, zero, *ops):
        sent.extend([len(zero), *rdd.map(len).collect()])
        return aggregate(rdd, zero, *ops)

    monkeypatch.setattr(RDD, "treeAggregate", seen)
    keys = spark.range(0, 90, 1, 40).selectExpr("id * 7919 AS a", "-id AS b")
    got = bloom_filters(keys)
    for f, column in zip(got, ("a", "b")):
        want = np.zeros(2**BLOOM_BITS, bool)
        for at in bloom_places(np.array([r[column] for r in keys.collect()], np.int64).view(np.uint64)):
            want[at] = True
        assert (unpack(f) == want).all()
    assert len(sent) == 41 and sum(sent) < 2_000_000
    assert bloom_filters(keys.where("a < 0")) == [bytes(2**BLOOM_BITS // 8)] * 2


def test_paragraphs(spark, odd, none):
    from offerlens.llm.paragraphs import repeated_paragraphs
    p, q = prose(40, 60), prose(41, 60)
    close = p.rsplit(" ", 1)[0] + " other"
    docs = odd.union(spark.createDataFrame(rows([(300, f"{p}\n\n{q}"), (301, f"short line\n{close}"), (302, prose(42, 60))]), DOCS))
    got = {r.doc_id: r for r in repeated_paragraphs(docs).collect()}
    assert (got[300].n_paragraphs, got[300].n_repeated, got[300].n_removed) == (2, 1, 0) and got[300].text == f"{p}\n\n{q}"
    assert got[301].n_removed == 1 and got[301].text == "short line" and got[302].n_repeated == 0
    assert got[0].text == "" and got[5].n_removed == 1 and got[4].n_removed == 0
    assert repeated_paragraphs(none).collect() == []


def test_passages_brute_force(spark, odd, none):
    from offerlens.llm.paragraphs import repeated_paragraphs
    a, b, c = prose(50, 54), prose(51, 160).split(), "\u00e9t\u00e9 " + prose(52, 70)
    lines = lambda w, n: "\n".join(" ".join(w[i:i + n]) for i in range(0, len(w), n))
    texts = [(400, prose(53, 90) + " " + a + "  " + prose(54, 95)), (401, a + " odd"),  # within a longer line
             (402, lines(b, 9)), (403, "Title\n\n" + lines(b[:120], 12) + "\nlast"), (404, lines(b, 9)),  # short lines
             (405, prose(55, 70) + " " + c), (406, c + " " + prose(56, 80) + "\t" + c + " " + prose(57, 60)),  # twice in a text
             (407, prose(58, 60) + " " + " ".join(a.split()[:49])), (408, "x y " * 60), (None, lines(b, 7))]
    docs = spark.createDataFrame(rows(texts), DOCS)
    seen, want = set(), {}
    for i, t in texts:
        w = t.split()
        gone = set()
        for k in range(len(w) - 49):
            if (x := tuple(w[k:k + 50])) in seen:
                gone.update(range(k, k + 50))
            seen.add(x)
        want[i] = [x for k, x in enumerate(w) if k not in gone], len(gone)
    got = {r.doc_id: r for r in repeated_paragraphs(docs).collect()}
    assert all(r.n_removed == 0 for r in got.values())
    assert {i: (r.text.split(), r.n_cut) for i, r in got.items()} == want
    assert got[401].text == "odd" and got[403].text == "Title\n\n\nlast" and got[400].text == texts[0][1] and got[407].n_cut == 0
    assert want[404][0] == want[None][0] == [] and want[406][1] == 142
    assert all(r.n_cut == 0 for r in repeated_paragraphs(odd).collect()) and repeated_paragraphs(none).collect() == []


def test_vectors_special_cases(spark):
    from offerlens.llm.itq import near_duplicate_vectors
    r = np.random.default_rng(1)
    x = r.normal(size=(400, 32))
    x[200:] = x[:200] + r.normal(size=(200, 32)) * r.uniform(0.0, 0.25, (200, 1))
    data = [(i, [float(v) for v in row], i % 2 if i < 200 else (i - 200) % 2) for i, row in enumerate(x)]
    special = [(900, None, 1), (901, [0.0] * 32, 1), (902, [float("nan")] * 32, 1), (903, data[0][1], None), (904, data[0][1], 0),
               (905, [None] + data[0][1][1:], 0), (906, [v * 1e200 for v in data[0][1]], 0)]
    got = {v.vec_id: v for v in near_duplicate_vectors(spark.createDataFrame(data + special, "vec_id long, embedding array<double>, label int")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([d[2] for d in data])
    link = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    want = link.sum(axis=1) - 1
    assert sum(got[i].n_links for i in range(1, 400)) >= 0.98 * (want[1:].sum())
    assert all(got[i].n_links <= want[i] + 2 for i in range(400))
    assert all(got[i].n_links == 0 and got[i].kept for i in (900, 901, 902, 903, 905))
    assert got[904].component_id == got[906].component_id == 0
    assert near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def brute_links(x, label):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    return link.sum(axis=1) - 1


@pytest.mark.parametrize("mean", [0.0, 0.8, 0.9, 0.95])
def test_vector_recall_with_a_common_mean(spark, mean):
    """Recall of pairs just above the threshold when all vectors share a direction."""
    from offerlens.llm.itq import near_duplicate_vectors
    r = np.random.default_rng(4)
    m = r.normal(size=64)
    u = r.normal(size=(1500, 64))
    a = np.sqrt(mean) * m / np.linalg.norm(m) + np.sqrt(1 - mean) * u / np.linalg.norm(u, axis=1, keepdims=True)
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    d = r.normal(size=a.shape)
    d -= (d * a).sum(axis=1, keepdims=True) * a
    x = np.concatenate([a, 0.981 * a + np.sqrt(1 - 0.981**2) * d / np.linalg.norm(d, axis=1, keepdims=True)])
    label = np.arange(len(x)) % 1500 % 3
    data = [(i, [float(v) for v in row], int(g)) for i, (row, g) in enumerate(zip(x, label))]
    got = {v.vec_id: v.n_links for v in near_duplicate_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")).collect()}
    want = brute_links(x, label)
    assert all(got[i] <= want[i] for i in range(len(x)))
    assert sum(got.values()) >= 0.93 * want.sum() >= 0.93 * 3000


def test_vectors_of_every_length(spark):
    """Lengths of few vectors are indexed too; ids may repeat, extra columns may clash."""
    from offerlens.llm.itq import near_duplicate_vectors
    r = np.random.default_rng(5)
    long = r.normal(size=(40, 24))
    data = [(i, [float(v) for v in row], 1, "g", "v") for i, row in enumerate(long)]
    data += [(100, [1.0, 2.0, 3.0], 1, "g", "v"), (101, [1.0, 2.001, 3.0], 1, "g", "v"), (102, [-1.0, 2.0, 3.0], 1, "g", "v"),
             (103, [1.0, 2.0, 3.0], 2, "g", "v"), (110, [2.0], 1, "g", "v"), (111, [5.0], 1, "g", "v"), (112, [-5.0], 1, "g", "v"),
             (120, [3.0, 1.0], 1, "g", "v"), (120, [0.0, 1.0], 1, "g", "v"), (None, [3.0, 1.0], 1, "g", "v")]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int, key string, code string")
    got = [(v.vec_id, v.n_links, v.component_id) for v in near_duplicate_vectors(frame).collect() if v.vec_id is None or v.vec_id >= 100]
    assert sorted(got, key=str) == sorted([(100, 1, 100), (101, 1, 100), (102, 0, 102), (103, 0, 103), (110, 1, 110), (111, 1, 110),
                                           (112, 0, 112), (120, 0, 120), (120, 0, 120), (None, 0, None)], key=str)


def test_html_class_names():
    """Names of boilerplate count as whole names only."""
    from offerlens.llm.html import main_text
    body = "Many words of the article stand here, more than in any menu of the page."
    for name in ('class="table-responsive"', 'class="elementor-widget-wrap"', 'id="related-work"', 'class="search-algorithms"', 'class="share-prices"'):
        page = f"<body><article><p>{body}</p><section {name}><p>{body}</p></section></article></body>"
        assert main_text(page) == f"{body}\n{body}", name
    for name in ('class="ad"', 'class="x ad-slot"', 'id="comments"', 'class="cookie-notice"', 'class="related-posts"', 'class="site-header"',
                 'id="left_sidebar"', 'class="newsletter-signup"', 'role="search"', 'class="social-share-buttons"'):
        page = f"<body><article><p>{body}</p><div {name}><p>Buy.</p></div></article></body>"
        assert main_text(page) == body, name


def test_html_rows(spark):
    """Nulls, empty pages, repeated rows, clashing columns, an empty table; pages made of known blocks."""
    from offerlens.llm.html import extract
    r = random.Random(8)
    made = []
    for i in range(30):
        blocks = [prose(100 * i + k, r.randint(1, 40)) for k in range(r.randint(1, 9))]
        inner = "".join(f"<p>{b.replace(' ', chr(10) * r.randint(1, 2), 1)}</p>" + '<div class="ad">Buy now</div>' * r.randint(0, 1) for b in blocks)
        page = f"<html><body><nav><a href=x>Home</a></nav><article>{inner}</article><footer>&copy; all</footer></body></html>"
        made.append((i, f"u{i}", page, "t", 3, "\n".join(blocks)))
    odd = [(50, None, None, "t", 3, ""), (None, "u", "", "t", 3, ""), (None, "u", "", "t", 3, ""), (51, "u", "<p>a &lt; b", "t", 3, "a < b")]
    frame = spark.createDataFrame(made + odd, "page_id long, url string, html string, text string, n_chars long, want string")
    got = [tuple(x) for x in extract(frame).collect()]
    assert sorted(got, key=str) == sorted([(i, u, w, len(w)) for i, u, _, _, _, w in made + odd], key=str)
    assert extract(frame.limit(0)).collect() == []


def test_html():
    from offerlens.llm.html import main_text
    page = """<html><head><title>t</title><script>var x="<p>no</p>";</script></head><body><header><h1>Site</h1></header>
      <nav><ul><li>Home</ul></nav><div class="cookie-notice">We use cookies.</div><article><h1>A &amp; B</h1><p><b>First  line<br>goes on
      <p>Short.</p><aside>Aside</aside><form><label>Name</label></form><div class="ad">Buy</div></article>
      <div id="comments"><p>A reader says many words that are long enough.</p></div><footer>&copy; x</footer>"""
    assert main_text(page) == "A & B\nFirst line goes on\nShort."
    assert main_text(None) == main_text("") == main_text("<nav>x</nav>") == "" and main_text("plain &lt;text") == "plain <text"


def test_ctw_probabilities(spark, odd, none):
    from offerlens.llm.ctw import score_texts
    got = {r.doc_id: r for r in score_texts(odd).collect()}
    assert all(r.score < 0 for r in got.values()) and got[0].n_tokens == got[2].n_tokens == 1 and got[0].score == got[1].score
    assert got[7].score == pytest.approx(got[8].score) and got[7].bits_per_byte < 8
    assert got[4].train_tokens > 0 and score_texts(none).collect() == []


def test_ctw_brute_force(spark, monkeypatch):
    import math
    from offerlens.llm import ctw
    monkeypatch.setattr(ctw, "GRAMS", 500)  # many sets of contexts in a task
    texts = [(i, prose(90 + i % 7, 25) + (" \u00e9t\u00e9" if i % 3 else "") + " and a long ending"[:i]) for i in range(20)] + [(50, "Zebra!"), (51, "")]
    docs = spark.createDataFrame(rows(texts), DOCS)
    got = {r.doc_id: r for r in ctw.score_texts(docs, 4).collect()}

    def decisions(body):  # (bits so far, the 7 bytes before, nearest first, bit)
        past = [0] * 7
        for x in [*body.encode().lower(), 255]:
            for k in range(8):
                yield (1 << k) | (x >> (8 - k)), tuple(past[::-1][:7]), x >> (7 - k) & 1
            past.append(x)

    n = collections.defaultdict(lambda: [0, 0])
    below = collections.defaultdict(set)
    for i, t in texts:
        if not got[i].held_out:
            for v, c, b in decisions(t):
                for d in range(8):
                    n[v, c[:d]][b] += 1
                    if d:
                        below[v, c[:d - 1]].add((v, c[:d]))
    own = lambda n0, n1: sum(map(math.lgamma, (n0 + 0.5, n1 + 0.5))) - math.lgamma(n0 + n1 + 1) - math.log(math.pi)
    lw, w = {}, {}
    for node in sorted(n, key=lambda x: -len(x[1])):
        e = own(*n[node])
        if len(node[1]) == 7:
            lw[node], w[node] = e, 1.0
        else:
            lw[node] = np.logaddexp(e, sum(lw[x] for x in below[node])) - math.log(2)
            w[node] = math.exp(e - math.log(2) - lw[node])

    def one(v, c, d=0):
        if (v, c[:d]) not in n:
            return 0.5
        x = v, c[:d]
        kt = (n[x][1] + 0.5) / (sum(n[x]) + 1)
        return w[x] * kt + ((1 - w[x]) * one(v, c, d + 1) if d < 7 else 0)

    assert len({r.held_out for r in got.values()}) == 2
    for i, t in texts:
        want = sum(math.log10(p if b else 1 - p) for v, c, b in decisions(t) for p in [one(v, c)])
        assert got[i].score == pytest.approx(want, rel=1e-6)


def test_classifiers(spark, none):
    from offerlens.llm.quality import classify
    from offerlens.llm.toxicity import score_documents
    texts = [(i, prose(i, 60) + (" you idiot" if i % 5 == 0 else "") + (" ###%%% @@@" * 40 if i % 3 == 0 else "")) for i in range(300)]
    docs = spark.createDataFrame(rows(texts + [(1000, None), (1001, ""), (1002, "x" * 5000), (1003, "what an i.d.i.o.t he is")]), DOCS)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 5 == 0), "x") for i in range(300)] + [(None, 1, 1, "x"), (5, None, None, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    toxic = {r.doc_id: r for r in score_documents(docs, labels).collect()}
    assert all(toxic[i].predicted == (i % 5 == 0) for i in range(300)) and toxic[1003].predicted == 1
    assert toxic[1000].score == toxic[1001].score <= 0.5
    good = {r.doc_id: r for r in classify(docs, labels).collect()}
    assert all(good[i].predicted == (i % 3 > 0) for i in range(300) if good[i].held_out) and 0 <= good[1000].score <= 1
    for f in (score_documents, classify):
        assert f(none, labels).collect() == [] and len(f(docs, labels.limit(0)).collect()) == docs.count()


def test_toxicity_landmarks_are_all_witnesses():
    """Witnesses late in the alphabet count as much as the first 160."""
    from offerlens.llm import toxicity as t
    r = random.Random(7)
    word = lambda letters: "".join(r.choice(letters) for _ in range(7))
    early, late = sorted({word("abcdefgh") for _ in range(170)}), sorted({word("uvwxyz") for _ in range(30)})
    weights, bias = t.fit(early + late, [word("ijklmnopqrst") for _ in range(600)])
    assert len(early) >= t.LANDMARKS
    assert (t.margins(late, weights, bias) > 0).all() and (t.margins(early, weights, bias) > 0).all()
    assert (t.margins([word("ijklmnopqrst") for _ in range(100)], weights, bias) < 0).all()


def test_pipeline_stages(spark):
    import corpus_pipeline as p
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").cache()
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    near = p.near_dedup(spark, docs, SF_SMALL)
    assert near.columns == p.COLUMNS and {r.doc_id for r in near.select("doc_id").collect()} < ids
    cut = p.suffix_dedup(spark, docs, SF_SMALL)
    assert cut.count() == docs.count() and cut.columns == p.COLUMNS
    assert cut.where(F.length("text") != F.col("n_chars")).count() == 0
    hit = {r.doc_id for r in docs.select("doc_id").subtract(p.benchmark(spark, docs, SF_SMALL).select("doc_id")).collect()}
    cur = duck(SF_SMALL)
    from offerlens.llm.decontaminate import ORACLE
    assert hit == {r[0] for r in cur.execute(f"SELECT doc_id FROM ({ORACLE}) WHERE contaminated").fetchall()}


def test_pipeline_brute_force(spark, tmp_path):
    """All stages on texts whose repeated passage begins and ends inside an accented character."""
    import corpus_pipeline as p
    from offerlens.llm.mixing import mix
    passage = prose(70, 90)[:500]
    texts = [(1, prose(71, 60) + "\u00a9" + passage + "\u00e9" + prose(72, 60) + " \ufffd end"),  # c2 a9 ... c3 a9
             (2, prose(73, 60) + "\u0129" + passage + "\u00e8" + prose(74, 60)),  # c4 a9 ... c3 a8: c4 and a8 would make a letter
             (3, prose(75, 60) + "\u0169" + passage + "\u00e9" + prose(76, 60)),  # c5 a9 ... c3 a9
             (4, "\U0001f600" + prose(77, 300)), (5, prose(77, 300).replace("alpha", "other", 1)), (6, prose(78, 50)),
             (7, prose(79, 20) + " " + prose(80, 20) + " " + prose(81, 20)), (8, ""), (9, None)]
    item = prose(80, 20)
    data = [(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in texts]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    shingles = {i: {tuple((t or "").split()[k:k + 5]) for k in range(len((t or "").split()) - 4)} for i, t in texts}
    left = []
    for i, t in texts:
        if not any(j < i and shingles[i] and len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j]) for j in shingles):
            left.append((i, t))
    n = collections.Counter((t or "").encode()[k:k + 400] for _, t in left for k in range(len((t or "").encode()) - 399))
    want, halves = [], 0
    for i, t in left:
        b = (t or "").encode()
        gone = {j for k in range(len(b) - 399) if n[b[k:k + 400]] > 1 for j in range(k, k + 400)}
        text, at = "", 0
        for c in t or "":
            whole = range(at, at + len(c.encode()))
            halves += 0 < len(gone.intersection(whole)) < len(whole)
            text += "" if gone.intersection(whole) else c
            at = whole.stop
        want.append((i, None if t is None else text))
    assert [i for i, _ in left] == [1, 2, 3, 4, 6, 7, 8, 9] and halves >= 3
    assert dict(want)[1].endswith("\ufffd end") and dict(want)[1] != dict(texts)[1]

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in p.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path))
    got = docs.collect()
    assert sorted((r.doc_id, r.text) for r in got) == want
    assert all(r.n_chars == len(r.text or "") for r in got)
    clean = [(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in want if item not in (t or "")]
    assert len(clean) == len(want) - 1
    final = mix(spark.createDataFrame(clean, docs.schema))
    out = p.run(spark, str(tmp_path))
    assert out.columns == final.columns and out.count() > 0
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, final.collect()), key=str)
