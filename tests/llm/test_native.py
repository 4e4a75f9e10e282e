"""License scan, mixing, sharding and exact deduplication (DataFrame functions only)."""

import random
import re
import textwrap
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, SF, WORDS, connect, docs, same_as_oracle
from wattline.llm import exact_dedup, license_scan, mixing, queries, sharding


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", ["op1_license_scan", "op10_exact_dedup_stream"])
def test_oracle(spark, con, name):
    same_as_oracle(queries.QUERIES[name](spark, SF), con.sql(queries.ORACLE[name]))


def test_license_edges(spark):
    header = max((t for x, t in license_scan.TEMPLATES if x == "Apache-2.0"), key=len)
    texts = [None, "", " \n ", "prose\nReleased under the MIT License.\nmore prose", "RELEASED  under the *MIT* license",
             "Released under the MIT License.", "Released under the MIT License.", "word " * 50_000,
             "intro\n\n" + header.replace(" ", "\n", 5) + "\n\noutro", "Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0."]
    got = {r.doc_id: r for r in license_scan.scan(docs(spark, texts)).collect()}
    assert [got[i].licences for i in range(len(texts))] == [
        "", "", "", "MIT", "MIT", "MIT", "MIT", "", "Apache-2.0", "Apache-2.0,CC-BY-NC-4.0"]
    assert got[3].best_score == 1.0 and got[0].best is None and got[2].n_passages == 0
    assert license_scan.scan(spark.createDataFrame([], DOCS)).count() == 0


def test_license_windows(spark):
    """Notices that are no passage: wrapped and followed by text, in mid-line, without line breaks."""
    def longest(licence):
        return max((t for x, t in license_scan.TEMPLATES if x == licence), key=len)
    apache, gpl = longest("Apache-2.0"), longest("GPL-3.0")
    mit = min((t for x, t in license_scan.TEMPLATES if x == "MIT" and t.startswith("Permission")), key=len)
    code = "\n".join(f"value_{k} = compute(of_the_{k}, in_the_{k})" for k in range(60))

    def wrapped(text, n=6):
        words = text.split()
        return "\n".join("# " + " ".join(words[i:i + n]) for i in range(0, len(words), n))

    prose = " ".join(f"the rest of the work {k} and the parts {k} of it" for k in range(60))
    texts = [wrapped(apache) + "\n" + code, wrapped(mit, 4) + "\n" + prose, prose + " " + gpl + " " + prose,
             "MIT License Copyright (c) 2020 A. N. Author " + mit + " The above copyright notice shall be included. " + prose,
             "one word, then Licensed under CC BY 4.0. and more words, Licensed under CC BY 4.0. again, Released under the MIT License, " + prose,
             prose + "\nReleased under the MIT License.\n" + prose, prose + code, wrapped(gpl)]
    got = {r.doc_id: r for r in license_scan.scan(docs(spark, texts)).collect()}
    assert [got[i].licences for i in range(len(texts))] == [
        "Apache-2.0", "MIT", "GPL-3.0", "MIT", "CC-BY-4.0,MIT", "MIT", "", "GPL-3.0"]
    assert [got[i].n_passages for i in (1, 2, 3, 4, 5, 6)] == [1, 1, 1, 2, 1, 0]
    assert got[1].best_score == got[2].best_score == got[3].best_score == got[4].best_score == 1.0 and got[2].best == "GPL-3.0"


def test_one_licence_of_a_family(spark):
    """Every notice gives its own licence alone, as a passage, in mid-line and wrapped; ties are listed."""
    prose = " ".join(f"some words {k} of another kind {k}" for k in range(40))
    cases = [(licence, text) for licence, t in license_scan.TEMPLATES
             for text in (t, f"{prose}\n{t}\n{prose}", f"{prose} {t} {prose}", "\n".join("# " + x for x in textwrap.wrap(t, 60)) + "\ncode = 1")]
    got = {r.doc_id: r for r in license_scan.scan(docs(spark, [t for _, t in cases])).collect()}
    wrong = [(licence, text[:80], got[k].licences) for k, (licence, text) in enumerate(cases) if got[k].licences != licence]
    assert not wrong
    bsd = max((t for x, t in license_scan.TEMPLATES if x == "BSD-3-Clause"), key=len)
    parts = re.split(r" (?=\d\. )", bsd)
    two, three = "\n\n".join(["Copyright (c) 2020 A. N. Author", *parts[:3], prose]), "\n\n".join(["/* some file */", *parts, prose])
    assert [r.licences for r in license_scan.scan(docs(spark, [two, three])).orderBy("doc_id").collect()] == ["BSD-2-Clause", "BSD-3-Clause"]
    twins = [("One", "a b c d e f g h"), ("Other", "a b c d e f g h"), ("Third", "a b c d e f g h i")]
    tie = license_scan.scan(docs(spark, ["a b c d e f g h", "a b c d e f g h i"]), twins).orderBy("doc_id").collect()
    assert [(r.licences, r.best) for r in tie] == [("One,Other", "One"), ("Third", "Third")]


def plain_scan(text, templates, t=0.8):
    """Passages, then windows of what they leave: (n_passages, licences, best, best_score)."""
    def words(x):
        return re.sub(r"[^\w]+|_+", " ", x.lower()).strip().split(" ")

    def grams(w):
        return [f"{a} {b}" for a, b in zip(w, w[1:])]

    sets = [(licence, license_scan.template_bigrams(x), len(re.findall(r"[^\W_]+", x.lower()))) for licence, x in templates]
    fewest = max(2, int(min(len(g) for _, g, _ in sets) * t / (2 - t)) + 1)
    paragraphs = re.split(license_scan.PARAGRAPHS, text)
    found, matched = {}, set()
    for p in [text, *paragraphs, *text.split("\n")]:
        g = set(grams(words(p))) if len(words(p)) >= fewest else set()
        scores = [(2 * len(g & set(b)) / (len(g) + len(b)), licence) for licence, b, _ in sets
                  if len(b) * t / (2 - t) <= len(g) <= len(b) * (2 - t) / t]
        top = max((s for s, _ in scores if s >= t), default=None)
        if top is not None:
            matched.add(p)
            found[p] = [x for x in scores if x[0] == top]
    def blank(p, other):
        return license_scan.MATCHED if p in matched else other
    rest = words(blank(text, "\n".join(blank(p, "\n".join(blank(x, x) for x in p.split("\n"))) for p in paragraphs)) if matched else text)
    g, windows = grams(rest), []

    def apart(ws):
        out = []
        for w in ws:
            if not out or w[0] > out[-1][0] + out[-1][1]:
                out.append(w)
            elif (w[2], w[1]) > (out[-1][2], out[-1][1]):
                out[-1] = w
        return out
    for licence, b, n_words in sets:
        b, lo = set(b), len(b) * t / (2 - t)
        span, mine = int(len(b) * (2 - t) / t) + n_words - 1 - len(b), []
        for s in range(len(g)):
            if g[s] in b and len(set(g[s:s + span]) & b) >= lo:
                ends = [(2 * len(set(g[s:s + k + 1]) & b) / (len(set(g[s:s + k + 1])) + len(b)), -k - 1)
                        for k in range(len(g[s:s + span])) if k + 1 >= lo and g[s + k] in b]
                if ends and max(ends)[0] >= t:
                    mine.append((s + 1, -max(ends)[1], max(ends)[0], licence))
        windows += apart(mine)
    windows = apart(sorted(windows))
    every = [x for m in found.values() for x in m] + [(w[2], w[3]) for w in windows]
    texts = {" ".join(rest[s - 1:s + n]) for s, n, _, _ in windows}
    best = min(((-s, licence) for s, licence in every), default=None)
    return len(matched) + len(texts), ",".join(sorted({x for _, x in every})), best and best[1], best and round(-best[0], 6)


def test_scan_against_plain_form(spark):
    """Random texts of notice words, whole and damaged notices among them."""
    r = random.Random(11)
    templates = [("A", "the quick brown fox jumps over the lazy dog and runs away"), ("B", "the quick brown fox jumps over the lazy cat and runs away"),
                 ("C", "all rights in this text are given away for free to all"), ("D", "all rights kept"), ("A", "quick fox licence")]
    vocabulary = sorted({w for _, t in templates for w in t.split()}) + ["x", "y", "z"]
    texts = []
    for _ in range(120):
        parts = []
        for _ in range(r.randint(1, 5)):
            words = r.choices(vocabulary, k=r.randint(0, 12)) if r.random() < 0.5 else r.choice(templates)[1].split()
            if words and r.random() < 0.4:
                words[r.randrange(len(words))] = r.choice(vocabulary)
            parts.append(" ".join(words))
        texts.append("".join(p + r.choice([" ", "\n", "\n\n", ", "]) for p in parts))
    got = license_scan.scan(docs(spark, texts), templates).orderBy("doc_id").collect()
    for text, row in zip(texts, got):
        assert (row.n_passages, row.licences, row.best, row.best_score) == plain_scan(text, templates), text


def targets_by_resharing(sizes, share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * sizes[s] + 1e-9}
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def mixed_rows(spark, n=900, seed=1):
    r = random.Random(seed)
    names = ["hot"] * 5 + ["a", "B", "é", "😀", "\uffee", None, "tiny"]
    sources = [r.choice(names) for _ in range(n)]
    texts = [" ".join(["w"] * (1 if s == "tiny" else r.choice([0, 1, 5, 30, 200]))) for s in sources]
    texts[0], texts[1], texts[2] = None, "", " \t\x0b\x0c\r\n "
    return texts, sources


def test_mixing(spark):
    texts, sources = mixed_rows(spark)
    table = docs(spark, texts, sources)
    got = mixing.mix(table).collect()
    assert len(got) == len(texts)
    words = [len(WORDS.findall(t or "")) for t in texts]
    size, taken = defaultdict(int), defaultdict(int)
    for w, s in zip(words, sources):
        size[s] += w
    want = targets_by_resharing(size)
    for r in got:
        assert (r["size"], r.source, r.source_size) == (words[r.doc_id], sources[r.doc_id], size[sources[r.doc_id]])
        assert r.target == pytest.approx(want[r.source]) and r.taken <= 2 * r["size"] and r.taken == r.copies * r["size"]
        assert r.copies in (int(want[r.source] / max(size[r.source], 1)), int(want[r.source] / max(size[r.source], 1)) + 1) or not r["size"]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 200 for s in size)
    again = mixing.mix(table.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixing_keeps_expectations(spark):
    table = docs(spark, ["w " * n for n in (1, 2, 3, 5, 8, 13, 21, 34)] + ["w " * 60] * 2, ["a"] * 8 + ["b", "c"])
    copies = defaultdict(list)
    for seed in range(12):
        for r in mixing.mix(table, seed=100 * seed).collect():
            copies[r.doc_id].append(r.copies - r.target / r.source_size)
    assert abs(sum(map(sum, copies.values())) / sum(map(len, copies.values()))) < 0.15


def test_mixing_levels_and_edges(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 4)
    texts, sources = mixed_rows(spark, 300, 2)
    table = docs(spark, texts, sources, [i // 2 for i in range(300)])
    got = mixing.mix(table).collect()
    assert len(got) == 300 and all(r.copies in (0, 1, 2) for r in got)
    same = mixing.mix(docs(spark, ["a b c"] * 40, ids=[7] * 40))
    assert same.count() == 40 and same.agg(F.sum("taken")).first()[0] == 180
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0
    assert mixing.mix(docs(spark, [None, ""])).agg(F.sum("taken")).first()[0] == 0


def test_repeated_rows_follow_the_mix(spark):
    """Also where an id stands on several texts, is missing, or a row stands several times."""
    texts, sources = mixed_rows(spark, 300, 2)
    texts += ["a b c"] * 20 + ["a b d"] * 3
    sources += ["x", None] * 10 + ["x"] * 3
    for ids in (None, [i // 2 for i in range(323)], [None] * 323, [7] * 323):
        table = docs(spark, texts, sources, ids).repartition(5)
        mixed = mixing.mix(table, by_text=True)
        rows = mixing.repeat_rows(table, mixed)
        assert rows.columns == table.columns
        want = {(r.doc_id, r.source, r.size): r.n for r in mixed.groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("n")).collect() if r.n}
        got = defaultdict(int)
        for r in rows.collect():
            got[r.doc_id, r.source, len(WORDS.findall(r.text or ""))] += 1
        assert got == want
        # rows that are alike are taken one by one: none more often than twice its source's rate allows
        times = rows.groupBy("doc_id", "source", "text").count().where("text = 'a b c'").agg(F.sum("count")).first()[0]
        assert times <= 20 * 2


def shards_by_hand(rows, n):
    rows = sorted(rows)
    total, before, out, first = sum(s for _, s, _ in rows), 0, [], {}
    for k, (i, s, c) in enumerate(rows):
        shard = min((2 * before + s) * n // (2 * total), n - 1)
        first.setdefault(shard, k)
        out.append((i, s, c, shard, k - first[shard]))
        before += s
    return out


@pytest.mark.parametrize("ids", [None, [5] * 300, [i // 100 for i in range(300)]])
def test_sharding(spark, ids):
    r = random.Random(3)
    texts = [None, "", "é" * 40_000] + [r.choice(["same", "x" * r.randint(0, 400)]) for _ in range(297)]
    table = docs(spark, texts, ids=ids)
    got = sharding.shard_by_bytes(table, 16).collect()
    raw = [(t or "").encode() for t in texts]
    keys = list(range(300)) if ids is None else ids
    want = shards_by_hand([(i, len(b) + 1, zlib.crc32(b)) for i, b in zip(keys, raw)], 16)
    assert sorted((x.doc_id, x["size"], x.text_crc32, x.shard, x.slot) for x in got) == sorted(want)
    assert {(x.law, x.grown_shard) for x in got} == {("bytes", None)}


def test_sharding_whole_table(spark, con):
    want = shards_by_hand([(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
                           for i, t in con.sql("SELECT doc_id, text FROM documents").fetchall()], 16)
    got = queries.op9_shard_bytes(spark, SF).collect()
    assert sorted((x.doc_id, x["size"], x.text_crc32, x.shard, x.slot) for x in got) == sorted(want)
    assert sharding.shard_by_bytes(spark.createDataFrame([], DOCS)).count() == 0


def groups_by_hand(rows):
    text = {}
    for i, t in rows:
        text.setdefault(" ".join(__import__("re").split(r"[\x20\x09-\x0D]+", t or "")), []).append(i)
    return sorted((i, min((x for x in ids if x is not None), default=None), len(ids), sha256(t.encode()).hexdigest())
                  for t, ids in text.items() for i in ids if i is not None)


EXACT = [None, "", " ", "a b", "a  b", "a\t\x0bb", "a b ", "A b", "\u00a0", "a\u00a0b", "long " * 40_000, "long " * 40_000, "a b"]


def check_exact(spark, tmp_path, monkeypatch=None):
    path = str(tmp_path / "docs")
    ids = [12, 11, 10, 9, 8, 7, 6, 5, 4, 3, 2, 1, 9]
    docs(spark, EXACT, ids=ids).repartition(3).write.parquet(path)
    table = spark.read.parquet(path)
    got = exact_dedup.exact_groups(table).collect()
    want = groups_by_hand(list(zip(ids, EXACT)))
    assert sorted((r.doc, r.keep_id, r.group_size) for r in got) == [w[:3] for w in want]
    kept = sorted(r.doc for r in got if r.kept)
    assert kept == sorted({w[1] for w in want})
    assert sorted(r.doc_id for r in exact_dedup.keep_first(table).collect()) == kept
    assert exact_dedup.keep_first(table).columns == table.columns


def test_exact_dedup(spark, tmp_path):
    check_exact(spark, tmp_path)


def test_exact_dedup_checks_full_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exact_dedup, "_digest", lambda c: F.lit(b"same"))
    check_exact(spark, tmp_path)


def test_exact_dedup_edges(spark, tmp_path):
    nulls = exact_dedup.exact_groups(docs(spark, ["x", "x", "y"], ids=[None, 4, None])).collect()
    assert sorted((str(r.doc), str(r.keep_id), r.kept) for r in nulls) == [("4", "4", True), ("None", "4", False), ("None", "None", True)]
    assert exact_dedup.exact_groups(spark.createDataFrame([], DOCS)).count() == 0


def test_exact_dedup_takes_new_files_only(spark, tmp_path):
    log, checkpoint, updates = (str(tmp_path / x) for x in ("log", "checkpoint", "updates"))
    for part, ids in ((["a", "b", "a"], [5, 6, 7]), (["b", "c", "a"], [1, 2, 9])):
        exact_dedup.arrival_log(docs(spark, part, ids=ids), log)
        state = exact_dedup.drain(spark, log, checkpoint, updates)
    assert sorted((r.keeper.doc, r.group_size) for r in state.collect()) == [(1, 2), (2, 1), (5, 3)]


def test_exact_dedup_on_a_table_that_grows(spark, tmp_path, monkeypatch):
    """Later micro-batches and later runs hit the state of earlier ones; only new rows are logged."""
    monkeypatch.setattr(exact_dedup, "LEAST_BATCH", 512)
    path, folder = str(tmp_path / "docs"), str(tmp_path / "state")
    rng = random.Random(9)
    rows = []
    for load in range(3):
        new = [(rng.choice([None, 1000 * (3 - load) + k]), f"text {rng.randint(0, 60)}" + " " * rng.randint(1, 3) + "end") for k in range(80)]
        rows += new
        spark.createDataFrame(new, "doc_id long, text string").repartition(5).write.mode("append").parquet(path)
        got = exact_dedup.exact_groups(spark.read.parquet(path), folder=folder).collect()
        groups = defaultdict(list)
        for i, t in rows:
            groups[" ".join(t.split())].append(i)
        assert len(got) == len(rows) and spark.read.parquet(f"{folder}/log").count() == len(rows)
        assert sorted((str(r.doc), r.group_size, str(r.keep_id)) for r in got) == sorted(
            (str(i), len(g), str(min((x for x in g if x is not None), default=None))) for g in groups.values() for i in g)
        assert sum(r.kept for r in got) == len(groups)
    batches = spark.read.schema("digest binary, batch int").parquet(f"{folder}/updates").select("batch").distinct().count()
    assert batches >= 7
    # digests that first came in an earlier micro-batch were hit
    times = spark.read.schema("digest binary, group_size long, batch int").parquet(f"{folder}/updates").groupBy("digest").count()
    assert times.where("count > 1").count() > 10
