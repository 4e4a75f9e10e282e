"""URL templates, nearest neighbours, the quality classifier, and the pipeline."""

import math
import os
import random
import re
import shutil
import subprocess
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import DOCS, SF, connect, docs, near_components
from wattline.llm import ann, mixing, quality, queries, url_filter

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def url_by_hand(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return host, path, best and best[1] + best[2], best and best[0]


def check_urls(rows, urls):
    assert len(rows) == len(urls)
    for r in rows:
        host, path, rule, verdict = url_by_hand(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block")
        assert verdict is None or r.verdict == verdict


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://Ex.ORG/a", "http://x.org", "http://x.org/", "http://example.org/es/1", "http://a.example.org/en/1",
            "http://myexample.org/es/1", "http://a.com/fr/x?y=://z", "http://a.com/de/#f", "http://com/de/", "http://xcom/de/", "a://b://c/d", "x://h?/de/",
            "http://h#/x", "http://é.com/de/Ä", "http://a\nb.com/de/\nq", "http://a.com//de/", "http://deep.net/" + "/".join("abcdefghijkl"),
            "http://u:p@Host.com:80/fr/", "http://long.net/" + "x" * 50_000] + ["http://hot.com/de/1"] * 40
    pages = spark.createDataFrame([(i, u, "<p>", "h", "t") for i, u in enumerate(urls)], "page_id long, url string, html string, host string, template string")
    check_urls(url_filter.filter_urls(pages, queries.RULES).collect(), urls)
    assert url_filter.filter_urls(pages.limit(0), queries.RULES).count() == 0


def test_url_whole_table(spark):
    check_urls(queries.op2_url_templates(spark, SF).collect(), dict(connect().sql("SELECT page_id, url FROM pages").fetchall()))


def test_url_templates_follow_labels(spark):
    """A branch that is always bad stays apart and is rejected; branches that look alike merge."""
    rows = []
    for k in range(400):
        kind = ("news", "blog", "spam")[k % 3]
        rows.append((k, f"http://h.net/{kind}/{k}", kind == "spam" if k % 2 else None))
    pages = spark.createDataFrame(rows, "page_id long, url string, bad boolean")
    got = url_filter.filter_urls(pages, [], label=F.col("bad")).collect()
    assert {(r.verdict, r.template) for r in got if "/spam/" in r.path} == {("block", "/spam/*")}
    assert {r.verdict for r in got if "/spam/" not in r.path} == {"allow"}


def test_url_branches_of_a_wide_host(spark):
    """100 sections of 1 % each: the ones that are always bad stay apart, the others merge."""
    rows = [(k, f"http://wide.net/s{k % 100}/{k}", k % 100 < 10 if k % 200 < 100 else None) for k in range(800)]
    pages = spark.createDataFrame(rows, "page_id long, url string, bad boolean")
    got = url_filter.filter_urls(pages, [], label=F.col("bad")).collect()
    assert {(r.template, r.verdict) for r in got if r.page_id % 100 < 10} == {("/~s0+9/*", "block")}
    assert {(r.template, r.verdict) for r in got if r.page_id % 100 >= 10} == {("/*/*", "allow")}


def test_url_siblings_and_single_labels(spark):
    """Branches that are alike share a template; one label parts nothing."""
    rows = [(k, f"http://two.net/{('bad1', 'bad2', 'good')[k % 3]}/{k}", k % 3 < 2) for k in range(120)]
    rows += [(1000 + k, f"http://one.net/g/{k}", False) for k in range(100)] + [(2000 + k, f"http://one.net/u/{k}", True if k == 7 else None) for k in range(51)]
    rows += [(3000 + k, f"http://odd.net/{'abcd'[k % 4]}/{k}", (k % 4 == 0) or (k % 4 == 1 and k % 8 == 1)) for k in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, bad boolean")
    got = {r.page_id: r for r in url_filter.filter_urls(pages, [], label=F.col("bad")).collect()}
    assert {(got[k].template, got[k].verdict) for k in range(120)} == {("/~bad1+1/*", "block"), ("/good/*", "allow")}
    assert {(r.template, r.verdict) for i, r in got.items() if 1000 <= i < 3000} == {("/*/*", "allow")}
    assert {r.template for i, r in got.items() if i >= 3000} == {"/a/*", "/*/*", "/~c+1/*"}      # b is as bad as all


def plain_templates(rows):
    """(host, path) -> (template, bad rate) by a plain tree; rows: (host, path, label)."""
    pages, chance = {}, url_filter.DIFFERS
    for host, path, label in rows:
        p = pages.setdefault((host, path), [0, 0, 0])
        p[0] += 1
        p[1] += label is not None
        p[2] += label is True
    template = {}

    def kl(bad, n, rate):
        return sum(k * math.log(k / (n * p)) for k, p in ((bad, rate), (n - bad, 1 - rate)) if k)

    def go(members, done, at):
        segments = {m: re.sub("^/", "", m[1]).split("/") for m in members}
        for pos in range(at, max(map(len, segments.values()))):
            here = [m for m in members if len(segments[m]) > pos]
            labelled, bad = (sum(pages[m][k] for m in here) for k in (1, 2))
            if not 0 < bad < labelled:
                continue
            children = {}
            for m in here:
                children.setdefault(segments[m][pos], []).append(m)
            literal = []
            for segment, own in children.items():
                n, lab, b = (sum(pages[m][k] for m in own) for k in range(3))
                if n >= url_filter.LITERAL_PAGES and lab >= 2 and kl(b, lab, (bad + 0.5) / (labelled + 1)) > chance:
                    literal.append((math.floor(math.asin(math.sqrt((b + 0.5) / (lab + 1))) * 512 / math.pi), lab, b, segment))
            if not literal:
                continue
            groups = [[[c], sum(x[1] for x in literal if x[0] == c), sum(x[2] for x in literal if x[0] == c)] for c in sorted({x[0] for x in literal})]

            def off(a, b):
                r = (a[2] + b[2]) / (a[1] + b[1])
                return sum(kl(g[2], g[1], r) if 0 < r < 1 else 0.0 for g in (a, b))
            while len(groups) > 1:
                least, k = min((off(a, b), k) for k, (a, b) in enumerate(zip(groups, groups[1:])))
                if least > chance:
                    break
                a, b = groups[k:k + 2]
                groups[k:k + 2] = [[a[0] + b[0], a[1] + b[1], a[2] + b[2]]]
            names = {}
            for cells, _, _ in groups:
                mine = sorted(x[3] for x in literal if x[0] in cells)
                names |= {s: mine[0] if len(mine) == 1 else f"~{mine[0]}+{len(mine) - 1}" for s in mine}
            parts = {}
            for m in here:
                parts.setdefault(names.get(segments[m][pos], "*"), []).append(m)
            for name, own in parts.items():
                go(own, done + "/*" * (pos - at) + "/" + name, pos + 1)
            members = [m for m in members if len(segments[m]) <= pos]
            break
        for m in members:
            template[m] = done + "/*" * (len(segments[m]) - at)

    for host in {h for h, _ in pages}:
        go([m for m in pages if m[0] == host], "", 0)
    base = (sum(p[2] for p in pages.values()) + 0.5) / (sum(p[1] for p in pages.values()) + 1)

    def counts(keep):
        return [sum(p[k] for m, p in pages.items() if keep(m)) for k in (1, 2)]
    out = {}
    for m, t in template.items():
        every, own = counts(lambda x: template[x] == t), counts(lambda x: x[0] == m[0] and template[x] == t)
        prior = (every[1] + 2 * base) / (every[0] + 2)
        out[m] = (t, (own[1] + 2 * prior) / (own[0] + 2))
    return out


def test_url_templates_against_plain_tree(spark):
    rng = random.Random(3)
    rows = []
    for k in range(900):
        a, b, c = rng.choice(["news", "blog", "spam", "shop"]), rng.choice("xyz"), rng.choice(["p", str(k)])
        bad = rng.random() < {"spam": 0.9, "shop": 0.85, "news": 0.05, "blog": 0.5 if b == "x" else 0.02}[a]
        path = "/" + "/".join([a, b, c][:rng.choice([1, 2, 3, 3])]) + rng.choice(["", "/"])
        rows.append((rng.choice(["one.net", "two.net"]), path, rng.choice([None, bad, bad])))
    want = plain_templates(rows)
    pages = spark.createDataFrame([(k, f"http://{h}{p}", y) for k, (h, p, y) in enumerate(rows)], "page_id long, url string, bad boolean")
    got = url_filter.filter_urls(pages, [], label=F.col("bad")).collect()
    assert len({t for t, _ in want.values()}) > 6
    for r in got:
        assert (r.template, r.bad_rate) == (want[r.host, r.path][0], pytest.approx(want[r.host, r.path][1], abs=1e-6))
        assert r.verdict == ("block" if want[r.host, r.path][1] >= 0.5 else "allow")


def test_url_branches_below_eight_segments(spark):
    """Branches that part at segment 11 stay apart, and again at segment 14; a path of 3,000 segments takes no round for each."""
    deep = "/".join("abcdefghij")
    rows = []
    for k in range(400):
        kind, part = ("good", "spam")[k % 2], ("x", "y")[k // 2 % 2]
        bad = kind == "spam" and part == "y"
        rows.append((k, f"http://deep.net/{deep}/{kind}/m/n/{part}/{k}", bad if k % 3 else None))
    rows.append((400, "http://deep.net/" + "q/" * 3000, None))
    pages = spark.createDataFrame(rows, "page_id long, url string, bad boolean")
    got = {r.page_id: r for r in url_filter.filter_urls(pages, [], label=F.col("bad")).collect()}
    assert {r.verdict for r in got.values() if "/spam/m/n/y/" in r.path} == {"block"}
    assert {r.verdict for r in got.values() if "/spam/m/n/y/" not in r.path} == {"allow"}
    assert got[3].template == "/*" * 10 + "/spam/*/*/y/*" and got[400].template == "/*" * 3001


# --- nearest neighbours ------------------------------------------------------------------------

def cosines(x, q):
    return [float(np.dot(q, y) / (math.sqrt(np.dot(q, q)) * math.sqrt(np.dot(y, y)))) for y in x]


def recall(rows, ids, vectors, asks):
    by_query, hits, total = {}, 0, 0
    for r in sorted(rows, key=lambda r: r["rank"]):
        by_query.setdefault(r.query_id, []).append(r)
    for q in asks:
        s = cosines(vectors, vectors[q])
        order = [k for k in sorted(range(len(ids)), key=lambda k: (-round(s[k], 13), ids[k])) if ids[k] != ids[q]][:5]
        got = by_query.get(ids[q], [])
        assert [r["rank"] for r in got] == list(range(1, len(order) + 1))
        for r in got:
            assert r.score == pytest.approx(s[ids.index(r.vec_id)], abs=1e-12)
        hits += len({r.vec_id for r in got} & {ids[k] for k in order})
        total += len(order)
    return hits / max(total, 1)


def test_ann_whole_table(spark):
    rows = connect("/root/testdata/sf0.01").sql("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    ids, x = [r[0] for r in rows], np.array([r[1] for r in rows], dtype=np.float64)
    got = queries.op3_ann_projections(spark, "/root/testdata/sf0.01").collect()
    assert recall(got, ids, x, [k for k, i in enumerate(ids) if i % 50 == 0]) >= 0.9


def test_ann_cells_and_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL_ROWS", 200)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 60)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    x = centres[rng.integers(0, 30, 2000)] + 0.3 * rng.normal(size=(2000, 16))
    x[::3] = x[0]
    x = x.astype(np.float32).astype(np.float64)
    table = spark.createDataFrame([(i, [float(v) for v in row], 0, 1) for i, row in enumerate(x)], "vec_id long, embedding array<float>, id long, query long")
    got = ann.nearest(table, F.col("vec_id") % 50 == 0).collect()
    assert recall(got, list(range(2000)), x, range(0, 2000, 50)) >= 0.9
    hot = [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 150]
    assert hot == [0, 3, 6, 9, 12]


def test_ann_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]),
            (8, [2.0, 0.0]), (9, [0.0, 1.0]), (None, [1.0, 1.0]), (10, [1.0, 0.0, 0.0]), (7, [1.0, 0.0]), (50, [0.0, 0.0]), (100, [0.0, -1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in sorted(ann.nearest(table, F.col("vec_id") % 50 == 0).collect(), key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(r.score, 9)))
    assert got == {0: [(1, 7, 1.0), (2, 8, 1.0), (3, 9, 0.0), (4, 100, 0.0)],
                   100: [(1, 0, 0.0), (2, 7, 0.0), (3, 8, 0.0), (4, 9, -1.0)]}
    assert ann.nearest(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_chi_square():
    assert ann.chi_square_cdf(ann.chi_square_quantile(0.95)) == pytest.approx(0.95)
    assert ann.chi_square_quantile(0.95) == pytest.approx(15.507, abs=1e-3)      # fixed value: 8 degrees of freedom


# --- quality -----------------------------------------------------------------------------------

def test_gradient():
    rng = np.random.default_rng(1)
    n = np.array([1, 3, 2])
    x = rng.normal(size=(6, quality.FEATURES)).astype(np.float64)
    y = np.array([1.0, 0.0, 1.0])
    model = quality.fit(x.astype(np.float32), n, y.astype(np.float32), epochs=1, steps=1)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}

    def loss():
        s = model._forward(x, n)["y"]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    grad = model.gradient(x, n, y, 0.0)
    for k in model.p:
        at = tuple(rng.integers(0, d) for d in model.p[k].shape)
        keep = model.p[k][at]
        model.p[k][at] = keep + 1e-5
        up = loss()
        model.p[k][at] = keep - 1e-5
        down = loss()
        model.p[k][at] = keep
        assert grad[k][at] == pytest.approx((up - down) / 2e-5, abs=1e-5)


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op4_quality_attention(spark, sf).collect()
    labels = dict(connect(sf).sql("SELECT doc_id, quality FROM labels").fetchall())
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert len(rows) == 1000 and np.mean([r.predicted == labels[r.doc_id] for r in held]) >= 0.95


def test_quality_edges(spark):
    texts = [None, "", " ", "fine words in a row " * 20, "junk$$$ junk### " * 30, "x" * 200_000, "fine words in a row " * 20]
    table = docs(spark, texts)
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (6, None, 0), (None, 1, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality.train(table, labels)
    rows = quality.score(table, model, table.columns, out_col="points").collect()
    got = {r.doc_id: r.points for r in rows}
    assert len(rows) == 7 and got[0] == got[1] and got[3] == got[6] and got[3] > 0.5 > got[4] and rows[0]["size"] == 0.5
    empty = quality.train(table, labels.limit(0))
    assert {r.score for r in quality.score(table, empty, ["doc_id"]).collect()} == {0.5}
    assert quality.score(spark.createDataFrame([], DOCS), model, ["doc_id"]).count() == 0


def test_quality_does_not_depend_on_neighbours(spark):
    """A text scores the same alone and beside a long one without spaces in its block."""
    texts = ["fine words in a row " * 20, "longer wording everywhere, considerably " * 9, "junk$$$ junk### " * 30, "a b c d $ # " * 40]
    cut = [quality.passages(np.array([0, len(t)])) for t in texts]
    x = np.concatenate([quality.encode(np.frombuffer(t.encode(), np.uint8), cuts) for t, (cuts, _) in zip(texts, cut)])
    model = quality.fit(x, np.concatenate([n for _, n in cut]), np.array([1, 1, 0, 0], np.float32), steps=60)
    alone = [quality.score(docs(spark, [t]), model, ["doc_id"]).first().score for t in texts]
    beside = quality.score(docs(spark, [*texts, "x" * 500_000]).coalesce(1), model, ["doc_id"]).orderBy("doc_id").collect()
    assert [r.score for r in beside[:4]] == pytest.approx(alone, abs=1e-5)


def test_passages_cover_texts():
    bounds = np.array([0, 0, 5, 5 + 700, 705 + 1_000_000])
    cuts, n = quality.passages(bounds)
    assert n.tolist() == [1, 1, 2, quality.PASSAGES] and cuts[0] == 0 and cuts[-1] == bounds[-1] and np.all(np.diff(cuts) >= 0)
    assert np.isin(bounds, cuts).all()


# --- pipeline ----------------------------------------------------------------------------------

def test_pipeline(spark, tmp_path):
    """Each stage against its plain form on what the stage before has kept."""
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    columns, after = rows.columns, [rows]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, after[-1], SF).write.parquet(str(tmp_path / name))
        after.append(spark.read.parquet(str(tmp_path / name)))
        assert k == len(corpus_pipeline.STAGES) - 1 or after[-1].columns == columns
    ids = [sorted(r.doc_id for r in df.select("doc_id").collect()) for df in after]
    labels = dict(connect().sql("SELECT doc_id, quality FROM labels").fetchall())
    gone = set(ids[0]) - set(ids[1])
    assert gone and np.mean([labels[i] == 0 for i in gone if i in labels]) > 0.8
    first = {}
    for i, t in sorted((r.doc_id, " ".join(re.split(r"[\x20\x09-\x0D]+", r.text))) for r in after[1].collect()):
        first.setdefault(t, i)
    assert ids[2] == sorted(first.values())
    want = near_components([(r.doc_id, r.text) for r in after[2].collect()], 5, 80)
    assert ids[3] == sorted(set(want.values()))
    mixed = mixing.mix(after[3], by_text=True).collect()
    assert ids[4] == sorted(r.doc_id for r in mixed for _ in range(r.copies))
    assert ids[5] == ids[4] and after[5].where("n_tokens <> size(ids)").count() == 0


def test_entry_without_the_subpackage(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    copy = shutil.copytree(repo, tmp_path / "repo", ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op1_') or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=120)
