import math
import os
import random
import sys
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import cases  # noqa: E402

import corpus_pipeline  # noqa: E402
from cohortlens.llm import cover_tree, html_extract, tables, topk_search  # noqa: E402
from cohortlens.llm.cover_tree import CoverTree, linked, unit  # noqa: E402
from cohortlens.llm.queries import VOCAB  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def vectors(n=300, dims=16, seed=2):
    """Random vectors, near copies, exact copies, scaled copies; then the awkward ones."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    x[n // 2:] = x[rng.integers(0, 20, n - n // 2)] + rng.normal(size=(n - n // 2, dims)) * rng.choice([0, 0.02, 0.2, 0.4], (n - n // 2, 1))
    x[n // 2:n // 2 + 40] = x[0] + rng.normal(size=(40, dims)) * 0.01
    x[7] = 3 * x[0]
    rows = [(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(x)]
    nan, inf = float("nan"), float("inf")
    return rows + [(1000, None), (1001, [0.0] * dims), (1002, [nan] + [1.0] * (dims - 1)), (1003, [inf] * dims),
                   (1004, [None] + [1.0] * (dims - 1)), (1005, []), (1006, rows[3][1][:5]), (40, rows[40][1]), (None, rows[0][1]),
                   (1008, [1e30] * dims), (1009, [1e-30] * dims), (1020, [2e18] * dims)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, "x") for i, v in rows],
                                 "vec_id long, embedding array<double>, label int, id long, rep long, score string")


def usable(rows, zero):
    out = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v)):
            out[i] = min(out.get(i, v), v)
    return out


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "CANDIDATE_BLOCK", 100)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 8)
    rows = vectors()
    got = topk_search.top_k(frame(spark, rows), F.col("id") % 20 == 0, 20).collect()
    v = {i: [math.floor(64 * x) for x in e] for i, e in usable(rows, True).items()}
    want = set()
    for q in v:
        if q % 20 == 0:
            score = lambda c: min(max(sum(a * b for a, b in zip(v[q], v[c])), -2 ** 63), 2 ** 63 - 1)
            best = sorted((-score(c), c) for c in v if c != q)[:20]
            want |= {(q, k + 1, c, -s) for k, (s, c) in enumerate(best)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert topk_search.top_k(frame(spark, rows).limit(0), F.col("id") % 20 == 0, 20).count() == 0
    few = topk_search.top_k(frame(spark, rows[:4]), F.col("id") % 20 == 0, 20).collect()
    assert sorted(r["rank"] for r in few) == [1, 2, 3]


def test_branch_and_bound_prunes_exactly():
    rng = np.random.default_rng(0)
    q = np.floor(rng.normal(size=(5, 64)) * 20)
    c = np.floor(rng.normal(size=(64, 3000)) * 20 / (1 + np.arange(64))[:, None])
    c[:, 100:120] = q[0][:, None]
    pos, score = topk_search.branch_and_bound(q[:1], c, 20, np.full(1, -np.inf))
    assert len(pos) < 3000 and set(range(100, 120)) <= set(pos.tolist())
    assert (score == q[:1] @ c[:, pos]).all()


def test_cover_tree_pairs():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 8))
    x[200:] = x[:200] + rng.normal(size=(200, 8)) * 0.1
    trees = [CoverTree(unit(x)), CoverTree(unit(x[::3]))]
    for a, b, ta, tb in ((x, x, trees[0], trees[0]), (x, x[::3], trees[0], trees[1])):
        cos = (a @ b.T) / np.linalg.norm(a, axis=1)[:, None] / np.linalg.norm(b, axis=1)[None, :]
        assert (linked(a, b, ta, tb, 0.95) == (cos >= 0.95)).all()
    assert sorted(trees[0].order.tolist()) == list(range(400))
    for node, kids in enumerate(trees[0].children):                       # children partition, radii cover
        if kids:
            spans = [trees[0].span[k] for k in kids]
            assert spans[0][0] == trees[0].span[node][0] and spans[-1][1] == trees[0].span[node][1]
            assert all(trees[0].radii[k] <= trees[0].radii[node] / 2 + 1e-9 for k in kids)


@pytest.mark.parametrize("chunk", [4096, 60])
def test_near_vectors(spark, monkeypatch, chunk):
    monkeypatch.setattr(cover_tree, "CHUNK", chunk)
    rows = vectors()
    got = {r.vec_id: r for r in cover_tree.near_duplicates(frame(spark, rows)).collect()}
    v = usable(rows, False)
    ids = sorted({i for i, _ in rows if i is not None})
    assert sorted(got) == ids
    x = unit(cover_tree.matrix([v[i] for i in v], 16))
    link = {i: {j for j, c in zip(v, r) if c >= 0.95 and j != i} for i, r in zip(v, x @ x.T)}
    label = {i: i for i in ids}
    for _ in ids:
        new = {i: min([label[i], *(label[j] for j in link.get(i, ()))]) for i in ids}
        if new == label:
            break
        label = new
    for i in ids:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (len(link.get(i, ())), label[i], label[i] == i), i
    assert cover_tree.near_duplicates(frame(spark, rows).limit(0)).count() == 0


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(500 + k, 501 + k) for k in range(40)] + [(3, 3)]
    label = {i: i for p in pairs for i in p}
    for _ in range(500):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    edges = spark.createDataFrame([*pairs, (None, 1)], "a long, b long")
    got = {r.id: r.component for r in tables.components(edges).collect()}
    assert got == {i: c for i, c in label.items() if any(i in p and p[0] != p[1] for p in pairs)}
    assert tables.components(edges.limit(0)).count() == 0


# -- pages -------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x="</p><p>no</p>";</script></head><body>
<nav><ul><li><a href="/">Home</a></ul></nav><header>Site</header><!-- note <p>no</p> --><div class="cookie-notice">We use cookies</div>
<div class="strip">Join our mailing list</div>{body}<aside>Side</aside><form><p>Search</p></form>
<section id="comments"><p>Nice page {n}</p></section><footer>&copy; 2020</footer></body></html>"""


def test_main_text():
    article = "<article><h1>A &amp; B</h1><p>One <b>t</b>wo<p>three&nbsp;\n four<br>five<div class=ad>Buy</div></article>"
    assert html_extract.main_text(PAGE.format(body=article, n=1)) == "A & B One two three four five"
    assert html_extract.main_text("") == "" and html_extract.main_text("plain < text &lt;x&gt;") == "plain < text <x>"
    assert html_extract.main_text("<p>open <b>never closed <p>next") == "open never closed next"
    assert html_extract.main_text("<div hidden>no</div><div style='display: none'>no</div><p>yes<script>if (a<b) {}") == "yes"
    assert html_extract.main_text("<main><p>a</main><article><p>b</article><p>c") == "a b"


def test_names_around_and_inside_an_article():
    text = html_extract.main_text
    article = "<article><h1>T</h1><p>One</p></article>"
    for name in ("layout has-sidebar", "no-sidebar", "header-fixed", "sidebar", "page-header", "comments"):
        assert text(f'<body><div class="{name}">{article}</div><div class=ad>no</div></body>') == "T One"
    assert text('<div class="no-sidebar"><main><p>a</main></div>') == "a"
    assert text('<article><p>a<section class="legal"><p>b</section><section id="related-work"><p>c</section></article>') == "a b c"
    assert text("<article><figure><figcaption>f</figcaption></figure><p>x<math><mi>y</mi></math></article>") == "f xy"
    assert text("<div><select><option>o</div><p>rest") == "rest"
    assert text('<article><p>a<p class="advert">no<p>b<div class="comments">no</div></article>') == "a b"
    assert text('<article><p>a</article><div class="user-feedback"><article>no</article></div>') == "a"
    assert text('<p>long enough</p><div class="comments"><article>no</article></div>') == "long enough"
    assert text('<div class="cookie-bar">no</div><div class="site-footer">no</div><div class="main-content">yes</div>') == "yes"
    assert text("<p>a <span class=ad>no</span>b</p>") == "a b"


def brute_template(pages, support):
    """Classes by whole occurrence vectors; the slot by walking the skeleton's tags."""
    contents = {tuple(sorted(html_extract.tokens(p).items())) for p in pages}
    contents = [dict(c) for c in contents]
    vector = {k: tuple(c.get(k, (0,))[0] for c in contents) for k in set().union(*contents)}
    texts, slot = set(), None
    for v in set(vector.values()):
        members = [k for k in vector if vector[k] == v]
        if sum(n > 0 for n in v) >= support and any(k & 1 for k in members):
            texts |= {k for k in members if not k & 1}
            if html_extract.ROOT in members:
                mass = {k: sum(c[k][1] for c in contents) for k in members if k & 1}
                held = [k for k in mass if mass[k] and 2 * mass[k] > mass[html_extract.ROOT]]
                slot = max(held, key=lambda k: contents[0][k][2], default=None)
    return texts, slot


def test_template_against_brute_force(spark):
    rng = random.Random(5)
    rows, by_host = [], {}
    for h in range(12):
        lines = [f"fixed line {h} {k}" for k in range(4)]
        for n in range(rng.randint(3, 12)):
            blocks = [f"<div class=b{k}><p>{rng.choice(lines) if rng.random() < .5 else lines[k]}</p></div>" for k in range(4) if rng.random() < .8]
            words = "".join(f"<p>{rng.randint(0, 99)} words {rng.randint(0, 9)}</p>" for _ in range(rng.randint(0, 5)))
            page = f"<body>{''.join(blocks)}<div class=c><section>{words}</section></div></body>"
            rows.append((len(rows), f"http://h{h}.example/{n}", page))
            by_host.setdefault(f"h{h}.example", []).append(page)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", html_extract.host_of(F.col("url")))
    got = {r.host: (set(r.texts), r.slot) for r in html_extract.templates(df, 4).collect()}
    for host, pages in by_host.items():
        texts, slot = brute_template(pages, 4)
        assert got.get(host, (set(), None)) == (texts, slot)


def test_slot_takes_the_text(spark):
    """Pages without article or main: what the host's slot holds, not the text beside it."""
    pages = [(k, f"http://s.example/{k}", f"<body><div class=top>Today {k * 3}</div><div class=wide><div class=story><p>Story {k} is told here at "
              f"length.</p><p>It ends {k}.</p></div></div><div class=foot>Seen {k * 11} times</div></body>") for k in range(9)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {k: f"Story {k} is told here at length. It ends {k}." for k in range(9)}


def test_templates_and_extract(spark):
    pages = [(k, f"http://a.example/{k}", PAGE.format(body=f"<div class=x><p>Text of page {k}</p><p>More {k * 7}</p></div>", n=k)) for k in range(12)]
    same = [(100 + k, "http://b.example/p", PAGE.format(body="<article><p>All the same</article>", n=0)) for k in range(12)]
    odd = [(None, None, None), (200, "no url", ""), (201, None, "<p>" + "word " * 50_000), (201, None, "<p>again")]
    df = spark.createDataFrame([(*r, "x", 1, "h") for r in pages + same + odd],
                               "page_id long, url string, html string, text string, n_chars int, host string")
    got = html_extract.extract(df).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(pages + same + odd) and all(r.n_chars == len(r.text) for r in got)
    for k in range(12):
        assert text[k] == f"Text of page {k} More {k * 7}"              # the mailing list line is template
        assert text[100 + k] == "All the same"                          # a page's copies are not
    assert text[None] == "" and text[200] == ""
    assert Counter(r.n_chars for r in got if r.page_id == 201) == Counter([249_999, 5])
    assert html_extract.extract(df.limit(0)).count() == 0


def test_copies_of_a_page_are_no_template(spark):
    page = ("<body><div class=strip><a href=/{u}>Top</a> <a href=/x>All posts</a></div>"
            "<div id=post-{k}><p>Article {k} begins.</p><p>And ends {k}.</p></div></body>")
    copies = [(k, f"http://c.example/{k}", page.format(u=k, k=7)) for k in range(6)]       # links differ, the page does not
    others = [(10 + k, f"http://c.example/p{k}", page.format(u=0, k=20 + k)) for k in range(6)]
    got = {r.page_id: r.text for r in html_extract.extract(
        spark.createDataFrame(copies + others, "page_id long, url string, html string")).collect()}
    assert len(got) == 12
    for k in range(6):
        assert got[k] == "Article 7 begins. And ends 7."
        assert got[10 + k] == f"Article {20 + k} begins. And ends {20 + k}."         # what all pages share is left out


# -- pipeline ----------------------------------------------------------------------

def test_pipeline_stages(spark, tmp_path):
    from test_text_operators import brute_lines, brute_near, check_packing, sample_texts
    from tokenizers import Tokenizer
    rows = sample_texts(160) + [(500 + (i or 0), t) for i, t in cases.awkward() if i is not None]
    rows += [(900, "x y token=abcdef123 z\nmore words here")]
    docs = cases.documents(spark, rows, extra=False)
    spark.createDataFrame([(i, 1) for i, _ in rows[:80]], "doc_id long, quality int").withColumn("toxic", F.lit(0)).write.parquet(
        f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    spark_docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = corpus_pipeline.quality(spark, spark_docs, str(tmp_path))
    assert kept.columns == docs.columns and kept.count() >= 0.9 * len(rows)
    lined = corpus_pipeline.lines(spark, spark_docs, str(tmp_path))
    assert lined.columns == docs.columns and lined.schema == spark_docs.schema
    some = sample_texts(160)
    want = brute_lines(some, 50)
    got = {r.doc_id: r.text for r in lined.where("doc_id < 500").collect()}
    assert got == {i: t for i, t in want.items() if t.strip() or t == dict(some)[i]}
    near = corpus_pipeline.near_duplicates(spark, spark_docs, str(tmp_path))
    label, _ = brute_near(rows, 80)
    assert {r.doc_id for r in near.collect()} == {i for i, c in label.items() if i == c}
    clean = corpus_pipeline.secrets(spark, spark_docs, str(tmp_path))
    assert clean.columns == docs.columns and clean.where("doc_id = 900").first().text == "x y [secret] z\nmore words here"
    assert clean.count() == len(rows) and clean.where("n_chars <> length(text)").count() == 0
    out = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert len(out) and (out.groupby("sequence_id")["length"].sum() <= 2048).all()
    check_packing(corpus_pipeline.pack(spark, spark_docs, str(tmp_path)).toPandas(), rows, Tokenizer.from_file(VOCAB), 2048)
    empty = spark_docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
