"""Main text of pages, filter interaction audit and vector codes."""

import html
import math
import random
import re
from hashlib import sha256
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, SF, WORDS, connect, docs, same_as_oracle
from wattline.llm import filter_audit, html_text, queries, vector_codes


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", ["op11_text_density", "op12_filter_audit", "op13_vector_codes"])
def test_oracle(spark, con, name):
    same_as_oracle(queries.QUERIES[name](spark, SF), con.sql(queries.ORACLE[name]))


# ---- main text

MENU = '<nav><ul><li><a href="/a">Home</a><li><a href="/b">About us</a></ul></nav>'
PARAS = ["The council met on Tuesday to talk about the bridge, and most of its members agreed with the plan.",
         "Costs would be shared by both towns over ten years, as the report of the engineers had proposed.",
         "A vote is expected next month; until then the old ferry goes on crossing the river four times a day."]
REMARK = "I have used this ferry for thirty years and I can only say that a bridge would be the end of it, my friends."


def body(*parts):
    return "<html><head><title>T</title><style>p{}</style></head><body>" + "".join(parts) + "</body></html>"


def ps(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


@pytest.mark.parametrize("page", [
    body(MENU, "<article>", ps(PARAS), "</article>", "<footer>Imprint</footer>"),
    body(MENU, "<header><h1>The Gazette</h1></header>", "<main>", ps(PARAS), "</main>"),
    body('<div class="site-header"><h1>The Gazette</h1></div>', '<div id="x1">', ps(PARAS), "</div>", '<div id="foot" class="page-footer">(c)</div>'),
    body('<div class="cookie-notice"><p>', REMARK, "</p></div>", '<div class="story">', ps(PARAS), "</div>"),
    body('<div class="story">', ps(PARAS), "</div>", '<section id="comments">', ps([REMARK] * 9), "</section>"),
    body("<article>", ps(PARAS), '<section class="comments"><article><p>', REMARK, "</p></article></section>", "</article>"),
    body('<div class="wrapper has-sidebar"><div class="col">', ps(PARAS), '</div><div class="sidebar"><p>', REMARK, "</p></div></div>"),
    body("<form><input name=q><button>Go</button></form>", "<div>", ps(PARAS), "</div>", '<ul>', *(f'<li><a href="/{k}">Link {k} to more</a>' for k in range(9)), "</ul>"),
    body("<div>", ps(PARAS[:1]), '<div class="ad">Buy this ferry</div>', "<script>var p = '<p>no</p>';</script>", ps(PARAS[1:]), "</div>"),
    body('<form id="aspnet"><div class="article-body">', ps(PARAS), "</div></form>"),
    "<article><p>" + "<p>".join(PARAS) + "</article><footer>no end tags",
    body("<article>", "<!-- <p>old</p> -->", ps(PARAS), "<!-- never closed </article><aside>x</aside>"),
])
def test_article_without_the_rest(page):
    assert html_text.main_text(page) == "\n".join(PARAS)


def test_heading_above_the_core():
    page = body(MENU, "<h1>Bridge</h1><h2>A vote</h2>", '<div class="c">', ps(PARAS), "</div>", "<footer><h2>Imprint</h2></footer>")
    assert html_text.main_text(page) == "\n".join(["Bridge", "A vote", *PARAS])


def test_headings_and_blocks():
    page = body(MENU, "<article><header><h1>The <em>bridge</em></h1><p class=byline>By A. N. Other</p></header>",
                "<p>One\n\t two<br>three</p><p>four<br><br>five</p>six<ul><li>seven<li><b>ei</b>ght</ul>"
                "<table><tr><td>nine<td>ten</table><blockquote>a &amp; b &lt;c&gt; &#233; &nbsp;d &amp;amp; &unknown; AT&T</blockquote></article>")
    assert html_text.main_text(page).split("\n") == [
        "The bridge", "One two three", "four", "five", "six", "seven", "eight", "nine", "ten", "a & b <c> é \xa0d &amp; &unknown; AT&T"]


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), (" \n ", ""), ("<article></article>", ""), ("just text &lt; 5", "just text < 5"), ("a < b <i>c</i> >d", "a < b c >d"),
    ('<p>x <a href="unclosed>y</a> z', "x y z"), ("<p title='a > b'>t</p>", "t"), ("<P CLASS=x>t</P></div></section>u", "t\nu"),
    ("<script>if (a < b) '</p>'", ""), ('<div class="widget">all there is</div>', "all there is"), ("<body><body><p>t</body>u</html>", "tu")])
def test_page_edges(page, text):
    assert html_text.main_text(page) == text


def test_pages_against_generator(spark):
    """Every page of the tables, cut out by its known form."""
    space = re.compile(r"[\x20\x09-\x0D]+")
    for r in html_text.extract(spark.read.parquet(f"{SF}/pages.parquet"), keep=["page_id", "html"]).collect():
        inner = re.search("<article>(.*?)</article>", r.html, re.S)[1].replace("<b>", "").replace("</b>", "").replace("<br>", " ")
        blocks = (space.sub(" ", html.unescape(b)).strip(" ") for b in re.split("</?(?:p|h1)>", inner))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_long_and_odd_pages(spark):
    long = "<article>" + ps([f"paragraph {k} " + "word " * 50 for k in range(20_000)]) + "</article>"
    deep = "<div>" * 20_000 + "x" + "</span>" * 20_000
    rows = [(1, "u", long, 1, "t"), (1, "u", long, 1, "t"), (2, None, None, 2, None), (None, "v", deep, 3, ""), (4, "w", "<a '" * 50_000 + ">", 0, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long, text string")
    got = html_text.extract(df).collect()
    assert got[0] == got[1] and len(got[0].text.split("\n")) == 20_000 and got[0].n_chars == len(got[0].text)
    assert (got[2].text, got[2].n_chars, got[3].text, got[3].page_id) == ("", 0, "x", None)
    assert html_text.extract(df.limit(0)).count() == 0


# ---- filter audit

def plain_audit(rows, labels):
    """rows: (id, text, part)"""
    fails = []
    for i, text, part in rows:
        t = text or ""
        w = WORDS.findall(t)
        fails.append((part or "", {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                                   "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search("[#$%&*|]", t)),
                                   "E": any(j is not None and i is not None and j < i and (u or "") == t for j, u, _ in rows)},
                      any(q == 1 for j, q, _ in labels if j == i and i is not None), any(x == 1 for j, _, x in labels if j == i and i is not None)))
    out = {}
    for part in {p for p, *_ in fails}:
        mine = [f for f in fails if f[0] == part]
        for order in permutations("ABCDE"):
            for k, own in enumerate(order):
                here = [f for f in mine if f[1][own] and not any(f[1][x] for x in order[:k])]
                out[part, "".join(order), k + 1] = [
                    sum(not any(f[1][x] for x in order[:k + 1]) for f in mine), len(here),
                    sum(f[1][own] and any(f[1][x] for x in order[:k]) for f in mine),
                    sum(f[1][own] and sum(f[1].values()) == 1 for f in mine), sum(f[2] for f in here), sum(f[3] for f in here)]
    for (part, order, step), v in out.items():
        v.append(sum(w[1] for (p, o, s), w in out.items() if p == part and o[s - 1] == order[step - 1]))
    return out


def audited(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
            for r in df.collect()}


@pytest.fixture(scope="module")
def audit_rows():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)] + ["Big", "LOUD", "a#b", "50%"]
    texts = [" ".join(rng.choices(vocabulary[:rng.choice([40, 400, 404])], k=rng.choice([0, 3, 199, 200, 201, 450]))) for _ in range(60)]
    texts += [None, "", " ", "AbcAbc", "É" * 100 + "A" * 3, "x" * 97 + "A" * 3, "x" * 96 + "A" * 4, "long " * 40_000 + "end"]
    texts += rng.choices(texts, k=60)
    ids = [rng.choice([None, *range(90)]) if k % 9 == 0 else k for k in range(len(texts))]
    parts = [rng.choice(["en", "de", None, ""]) for _ in texts]
    return list(zip(ids, texts, parts)), [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in [*range(0, 120, 2), 4, 8, None]]


@pytest.mark.parametrize("most_bits", [filter_audit.SKETCH_BITS, 64])
def test_audit(spark, audit_rows, most_bits):
    """Also with a sketch of 64 counters, which is full and clears nearly nothing."""
    rows, labels = audit_rows
    table = spark.createDataFrame([(i, t, p, "x", k, 1) for k, (i, t, p) in enumerate(rows)], "doc_id long, text string, lang string, part string, h long, mask int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit(1))
    assert audited(filter_audit.audit(table, marks, most_bits=most_bits)) == plain_audit(rows, labels)


def test_audit_empty(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(spark.createDataFrame([], DOCS), none).count() == 0
    one = filter_audit.audit(docs(spark, ["x"]), none)
    assert one.count() == 600 and one.where("step = 1 and filter_order = 'ABCDE'").first().removed == 1


def test_shared_hash(spark):
    """Different texts under one hash get their own first ids."""
    rows = [(7, 1, "a"), (7, 2, "b"), (7, 3, "a"), (7, 4, "b"), (7, 5, "c"), (8, 6, "d"), (9, 7, "e"), (9, 8, "e")]
    texts = spark.createDataFrame(rows, "h long, id long, text string")
    got = {r.id: r.first_id for r in filter_audit.with_first_id(texts.select("h", "id"), texts).collect()}
    assert {i for i, f in got.items() if f is not None and i > f} == {3, 4, 8}


def test_sketch(spark):
    rng = np.random.default_rng(2)
    once, often = rng.integers(-2**63, 2**63, 4000), rng.integers(-2**63, 2**63, 100)
    hashes = [int(x) for x in np.concatenate([once, often, often, np.repeat(often[:1], 3000)])]
    rng.shuffle(hashes)
    bits = filter_audit.sketch_bits(len(hashes))
    plane = filter_audit.sketch(spark.createDataFrame([(h,) for h in hashes], "h long").repartition(7), bits)
    assert filter_audit.repeated(plane, often).all()                     # no repeat is cleared
    assert filter_audit.repeated(plane, once).mean() < 0.1
    # merged sketches count as one sketch of all rows
    whole = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
    filter_audit.add(*whole, np.array(hashes))
    assert (whole[1] == plane).all()


# ---- vector codes

def plain_codes(rows, parts=8, entries=16, rounds=6):
    """rows: (id, vector) -> id -> (code, error), all entries; full scans in Python integers."""
    vs = sorted((i, [math.floor(4096 * x) for x in v]) for i, v in rows)
    at = vector_codes.cuts(len(vs[0][1]), parts)
    cut = [[tuple(v[at[p]:at[p + 1]]) for p in range(parts)] for _, v in vs]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [nearest(c[p], books[p])[1] for c in cut]
            for k in set(own):
                mine = [c[p] for c, o in zip(cut, own) if o == k]
                books[p][k] = tuple(sum(col) // len(mine) for col in zip(*mine))
    out = {}
    for (i, _), c in zip(vs, cut):
        near = [nearest(c[p], books[p]) for p in range(parts)]
        out[i] = ("".join(f"{k:02x}" for _, k in near), sum(d for d, _ in near))
    return out, sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def check_codes(spark, rows, labels):
    df = spark.createDataFrame([(i, v, la, "x", 0) for (i, v), la in zip(rows, labels)],
                               "vec_id long, embedding array<float>, label int, code string, error long")
    usable = [(i, [float(np.float32(x)) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    want, digest = plain_codes(usable)
    by_label = {}
    for (i, v), la in zip(rows, labels):
        if i in want:
            by_label[la] = by_label.get(la, 0) + want[i][1]
    got = vector_codes.codes(df.repartition(3)).collect()
    assert {r.vec_id: (r.code, r.error) for r in got} == want and len(got) == len(usable)
    assert {r.codebooks_sha256 for r in got} == {digest}
    assert {r.vec_id: r.label_error for r in got} == {i: by_label[la] for (i, _), la in zip(rows, labels) if i in want}


def test_codes(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 16))
    rows = [(int(k), [float(x) for x in centres[k % 5] + rng.normal(scale=0.2, size=16)]) for k in rng.permutation(300)]
    rows += [(400 + k, [round(x) * 0.25 for x in rows[k][1]]) for k in range(60)]            # ties
    rows += [(500 + k, list(rows[7][1])) for k in range(40)]                                 # copies
    rows += [(-1, None), (-2, []), (-3, [float("nan")] * 16), (-4, [None] + [0.0] * 15), (-5, [float("inf")] * 16)]
    check_codes(spark, rows, [rng.choice([1, 2, None]) if k % 3 else None for k in range(len(rows))])


def test_few_vectors(spark):
    check_codes(spark, [(3, [0.5] * 8), (1, [-0.25] * 8), (2, [0.5] * 8)], [None, 1, None])
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vector_codes.codes(empty).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert vector_codes.codes(empty).count() == 0
    odd = spark.createDataFrame([(None, [0.5] * 11, 1), (5, [0.25] * 11, 1), (5, [0.25] * 11, 1), (6, [1.0] * 9, 1)], "vec_id long, embedding array<float>, label int")
    got = vector_codes.codes(odd).collect()                              # another dimension; a width that 8 doesn't divide
    assert sorted((r.vec_id or 0, r.error) for r in got) == [(0, 0), (5, 0), (5, 0)]


def test_bounds_save_scans_and_use_net_moves(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(600, 24)) + rng.integers(0, 6, 600)[:, None] * 3.0
    df = spark.createDataFrame([(k, x.tolist(), 0) for k, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    state, history = vector_codes.compress(df)
    assert len(history) == 7 and state.agg(F.sum("scans")).first()[0] < 600 * 8 / 2
    # an entry that came back has not moved, whatever the way it took
    book = [np.array([[0, 0], [100, 0]])]
    assert (vector_codes.lowered([book, [np.array([[0, 0], [500, 0]])], book], 0)[0] == 0).all()
    far = vector_codes.lowered([book, [np.array([[0, 0], [103, 4]])]], 0)
    assert far[0, 0] == pytest.approx(5) and far[0, 1] == 0 and far[0, 0] >= 5
