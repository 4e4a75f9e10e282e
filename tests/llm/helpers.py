"""Plain Python forms of the contracts, and tables to try them on."""

import os
import re

import duckdb

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def connect(sf=SF):
    con = duckdb.connect()
    for t in ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]:
        path = f"{sf}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def docs(spark, texts, sources=None, ids=None):
    """A documents table with extra columns whose names clash with the operators' own."""
    ids = list(range(len(texts))) if ids is None else ids
    sources = ["s"] * len(texts) if sources is None else sources
    rows = [(i, t, "en", s, len(t or ""), -1, "x", 0.5) for i, t, s in zip(ids, texts, sources)]
    return spark.createDataFrame(rows, DOCS + ", doc long, _text string, size double")


def same_as_oracle(df, rel):
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    at = [rel.columns.index(c) for c in cols]
    got = sorted(tuple(map(str, (r[c] for c in cols))) for r in df.collect())
    want = sorted(tuple(str(r[i]) for i in at) for r in rel.fetchall())
    assert got == want


def shingles(text, width):
    w = WORDS.findall((text or "").translate(ASCII_LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1)))


def near_components(rows, width, percent):
    """id -> smallest id of its component, by comparing all pairs of distinct sets; rows: (id, text)."""
    sets = {}
    for i, t in rows:
        sets.setdefault(shingles(t, width), []).append(i)
    keys = [s for s in sets if s]
    parent = list(range(len(keys)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(keys)):
        for b in range(a):
            x, y = keys[a], keys[b]
            if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    parent[find(a)] = find(b)
    groups = {}
    for k, s in enumerate(keys):
        groups.setdefault(find(k), []).extend(sets[s])
    out = {i: i for i in sets.get(frozenset(), [])}
    for ids in groups.values():
        for i in ids:
            out[i] = min(ids)
    return out


def repeats_removed(rows, window):
    """id -> kept words; rows: (id, text), ids unique."""
    words = {i: WORDS.findall(t or "") for i, t in rows}
    seen, out = set(), {}
    for i in sorted(words):
        w, gone = words[i], set()
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            if key in seen:
                gone.update(range(s, s + window))
            seen.add(key)
        out[i] = [x for k, x in enumerate(w) if k not in gone]
    return out
