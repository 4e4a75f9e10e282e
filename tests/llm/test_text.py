"""Near duplicates, substring deduplication, BPE, and the kernels below them."""

import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import ASCII_LOWER, DOCS, SF, WORDS, connect, docs, near_components, repeats_removed, same_as_oracle, shingles
from wattline.llm import bpe, near_dedup, queries, substring_dedup
from wattline.llm.components import components
from wattline.llm.recompression import Parse
from wattline.llm.tokens import Words, blocks, joined

RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PIECES = ["a", "b", "the", "I", "'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c",
          "\u00a0", "\u3000", "\u2028", "\x85", "é", "ß", "漢", "字", "١", "2", "½", "²", "_", "-", "!!", "😀", "\u0301", "\u200b", "'S", "\x00", "ǅ"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=30).map("".join), max_size=8), st.integers(1, 60))
def test_words(texts, block):
    for lower in (False, True):
        for i, j, data, bounds in blocks(pa.array(texts, pa.string()), block):
            w = Words(data, bounds, lower)
            cut = [WORDS.findall(t.translate(ASCII_LOWER) if lower else t) for t in texts[i:j]]
            raw = w.data.tobytes()
            got = [raw[a:b].decode() for a, b in zip(w.start, w.end)]
            assert got == [x for c in cut for x in c] and w.count.tolist() == [len(c) for c in cut]
            by_word = dict(zip(got, w.hash.tolist()))
            assert [by_word[x] for x in got] == w.hash.tolist() and len(set(by_word.values())) == len(by_word)
            assert joined(w, np.ones(len(got), bool)) == [" ".join(c).encode() for c in cut]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=30).map("".join), max_size=8))
def test_bpe_matches_tiktoken(texts):
    tool = bpe.Codec(RANKS, bpe.class_runs(), np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.uint32))
    for i, j, data, bounds in blocks(pa.array(texts, pa.string()), 64):
        ids, first = tool.encode(data, bounds)
        assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [TIKTOKEN.encode_ordinary(t) for t in texts[i:j]]
        assert tool.decode(ids).tobytes() == data.tobytes()


def test_fold_in_spark(spark):
    words = ["a", " the", "tionally", "éßé", "漢字", "  \n", "zqxj" * 16, "aaaaaaaaaaaa", "'ll"]
    rows = spark.createDataFrame([(w.encode(),) for w in words], "word binary")
    got = rows.select("word", bpe.fold_merges(F.col("word"), bpe.rank_literal(RANKS)).alias("ids")).collect()
    for r in got:
        assert r.ids == TIKTOKEN._encode_single_piece(bytes(r.word)) == bpe.merge_word(bytes(r.word), RANKS)


def check_bpe(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r.doc_id] or ""
        ids = TIKTOKEN.encode_ordinary(t)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(t.encode()).hexdigest())


@pytest.mark.parametrize("most", [bpe.DICTIONARY_WORDS, 3])
def test_bpe_edges(spark, most):
    r = random.Random(4)
    texts = [None, "", " ", "x" * 30_000, " " * 9_999 + "b", "same text", "same text"] + ["".join(r.choices(PIECES, k=60)) for _ in range(60)]
    rows = bpe.encode(docs(spark, texts), RANKS, most=most, keep_ids=True).collect()
    check_bpe(rows, texts)
    assert all(r.ids == TIKTOKEN.encode_ordinary(texts[r.doc_id] or "") and bytes(r.decoded).decode() == (texts[r.doc_id] or "") for r in rows)
    assert bpe.encode(spark.createDataFrame([], DOCS), RANKS).count() == 0


def test_bpe_whole_table(spark):
    texts = dict(connect().sql("SELECT doc_id, text FROM documents").fetchall())
    check_bpe(queries.op8_byte_bpe(spark, SF).collect(), texts)


# --- near duplicates ---------------------------------------------------------------------------

@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abC"), max_size=12).map(" ".join), min_size=1, max_size=6), st.integers(1, 6))
def test_shingle_sets(texts, width):
    for i, j, data, bounds in blocks(pa.array(texts, pa.string())):
        values, size = near_dedup.shingle_sets(Words(data, bounds, lower=True), width)
        sets = [shingles(t, width) for t in texts[i:j]]
        assert size.tolist() == [len(s) for s in sets]
        end = np.cumsum(size)
        got = [frozenset(values[e - n:e].tolist()) for e, n in zip(end, size)]
        for a in range(len(got)):
            for b in range(a):
                assert len(got[a] & got[b]) == len(sets[a] & sets[b])


def test_least_matches():
    bounds = dict(near_dedup.least_matches(0.8, 300))
    assert bounds[300] < 240 and all(bounds[n] <= 0.8 * n for n in bounds) and bounds[300] > 190


def near_rows(seed=6):
    """A base text with copies at many similarities, chains, a hot group, short texts and odd rows."""
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    texts = [None, "", " \n", "one", "ONE", "one two", "one  TWO", "two one"]
    base = r.choices(vocab, k=120)
    for k in range(60):
        copy = list(base)
        for _ in range(r.randint(0, 12)):
            copy[r.randrange(len(copy))] = r.choice(vocab)
        texts.append(" ".join(copy))
    chain = r.choices(vocab, k=100)
    for _ in range(30):
        for _ in range(3):
            chain[r.randrange(len(chain))] = r.choice(vocab)
        texts.append(" ".join(chain).upper() if r.random() < 0.3 else " ".join(chain))
    texts += [texts[10]] * 20 + [" ".join(r.choices(vocab, k=r.randint(3, 50))) for _ in range(60)] + ["long " * 20_000]
    ids = list(range(len(texts)))
    r.shuffle(ids)
    return ids, texts


@pytest.mark.parametrize("width,chunk", [(2, near_dedup.CHUNK), (2, 5), (5, near_dedup.CHUNK)])
def test_near_duplicates(spark, monkeypatch, width, chunk):
    monkeypatch.setattr(near_dedup, "CHUNK", chunk)
    ids, texts = near_rows()
    table = docs(spark, texts, ids=ids)
    got = near_dedup.near_duplicates(table, width).collect()
    want = near_components(list(zip(ids, texts)), width, 80)
    assert {r.doc_id: r.component_id for r in got} == want and len(got) == len(ids)
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(shingles(texts[ids.index(r.doc_id)], width)) for r in got)


def test_near_duplicates_whole_table(spark):
    rows = connect().sql("SELECT doc_id, text FROM documents").fetchall()
    got = queries.op6_minhash_bayes(spark, SF).collect()
    assert {r.doc_id: r.component_id for r in got} == near_components(rows, 2, 80)


def test_near_duplicates_edges(spark):
    same = near_dedup.near_duplicates(docs(spark, ["a b c d e f"] * 3 + ["other words of a text", None], ids=[None, 4, 4, None, None])).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in same) == [
        ("4", "4", True), ("4", "4", True), ("None", "4", False), ("None", "None", True), ("None", "None", True)]
    assert near_dedup.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    kept = near_dedup.keep_one(docs(spark, ["a b c d e f"] * 3 + [None]))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3] and "_text" in kept.columns


def test_near_duplicates_by_document(spark):
    """An id on two texts is two documents; documents without id are told apart by their text."""
    near, clean = "a b c d e f g h i j k l m n o p", "nothing of this stands in the other text at all"
    texts = [near, near + " q", clean, near + " r", clean + " or here", None, near + " s"]
    kept = near_dedup.keep_one(docs(spark, texts, ids=[1, 2, 2, None, None, None, 2])).collect()
    assert len(kept) == 4 and {(r.doc_id, r.text) for r in kept} >= {(1, near), (2, clean), (None, None)}
    assert not {near + x for x in (" q", " r", " s")} & {r.text for r in kept}
    # every component keeps one document, also where all its documents lack an id
    lone = near_dedup.keep_one(docs(spark, [near, near + " q", clean, "x " * 400_000 + "y"], ids=[None] * 4)).collect()
    assert len(lone) == 3 and sum(r.text.startswith(near) for r in lone) == 1


def test_components(spark):
    r = random.Random(8)
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(r.randint(200, 299), r.randint(200, 299)) for _ in range(80)]
    got = {x.a: x.b for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {n: n for l in links for n in l}
    for _ in want:
        for a, b in links:
            want[a] = want[b] = min(want[a], want[b])
    assert {n: got.get(n, n) for n in want} == want


# --- substring deduplication -------------------------------------------------------------------

@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=0, max_size=40), st.lists(st.integers(0, 3), max_size=12),
       st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), max_size=12), st.integers(1, 6))
def test_equal_substrings_get_equal_interior_symbols(core, a, b, c, rounds):
    def symbols(left, right):
        words = np.array(left + core + right, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
        p = Parse(words, np.array([0, len(words)]), rounds)
        inside = (p.low >= len(left)) & (p.high <= len(left) + len(core))
        assert np.all(p.low <= p.start) and np.all(p.high >= p.end)
        return {(s - len(left), e - len(left), n) for s, e, n in zip(p.start[inside], p.end[inside], p.name[inside].tolist())}
    assert symbols(a, b) == symbols(c, a) == symbols(b + c, c)


def repeat_rows(seed):
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)]
    passage = r.choices(vocab, k=30)
    texts = [None, "", "x " * 200, "x " * 200, "x y " * 60, " ".join(r.choices(["p", "q"], k=400)), " ".join(r.choices(["p", "q"], k=400))]
    for _ in range(60):
        w = r.choices(vocab, k=r.randint(0, 80))
        at = r.randint(0, len(w))
        texts.append(r.choice([" ", "\n", "\u00a0 "]).join(w[:at] + r.choice([[], passage, passage[:20], passage[3:22], passage[:19]]) + w[at:]))
    texts += [texts[20]] * 3 + [" ".join(r.choices(vocab, k=20_000))]
    ids = list(range(len(texts)))
    r.shuffle(ids)
    return ids, texts


@pytest.mark.parametrize("seed,block", [(1, substring_dedup.BLOCK), (2, 300)])
def test_substring_dedup(spark, monkeypatch, seed, block):
    monkeypatch.setattr(substring_dedup, "BLOCK", block)
    ids, texts = repeat_rows(seed)
    want = repeats_removed(list(zip(ids, texts)), 20)
    table = docs(spark, texts, ids=ids).repartition(4)
    for r in substring_dedup.remove_repeats(table, 20, keep_text=True).collect():
        words = WORDS.findall(texts[ids.index(r.doc_id)] or "")
        kept = " ".join(want[r.doc_id])
        assert (r.n_words, r.n_removed, r.kept_text) == (len(words), len(words) - len(want[r.doc_id]), kept)
        assert r.kept_sha256 == sha256(kept.encode()).hexdigest()


def test_substring_dedup_edges(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = substring_dedup.remove_repeats(docs(spark, [text] * 4 + [text + " end"], ids=[3, 3, None, 5, 3]), 20).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed) for r in rows) == [
        ("3", 30, 0), ("3", 30, 0), ("3", 31, 0), ("5", 30, 30), ("None", 30, 30)]
    assert substring_dedup.remove_repeats(spark.createDataFrame([], DOCS), 20).count() == 0
    # rows without id: by a hash of their text, after all others; different texts are different documents
    texts = [text, text + " x", "y " + text, text, None, ""]
    rows = substring_dedup.remove_repeats(docs(spark, texts, ids=[None] * 6), 20).collect()
    assert sum(r.n_removed == 0 for r in rows if r.n_words >= 30) in (1, 2) and sum(r.n_removed >= 30 for r in rows) >= 2
    top = (1 << 63) - 1
    rows = substring_dedup.remove_repeats(docs(spark, [text, text, text + " x"], ids=[top, None, 1]), 20).collect()
    assert [r.n_removed for r in sorted(rows, key=lambda r: r.doc_id or 0)][1:] == [0, 30]


def test_sums_of_powers_do_not_decide(spark):
    """Words and whole texts in the order of Thue and Morse and its complement have equal sums of powers modulo 2^64."""
    bits = [bin(k).count("1") & 1 for k in range(2048)]
    one, two = (" ".join(f"u{k} " + ("alpha", "beta")[b ^ flip] for k, b in enumerate(bits[:1024])) for flip in (0, 1))
    long = ["".join("ab"[b ^ flip] for b in bits) for flip in (0, 1)]
    around = " ".join(f"w{k}" for k in range(19))
    texts = [one, two, f"{around} {long[0]}", f"{around} {long[1]}", one]
    rows = {r.doc_id: r for r in substring_dedup.remove_repeats(docs(spark, texts), 20).collect()}
    assert [rows[i].n_removed for i in range(5)] == [0, 0, 0, 0, 2048]
    with_copies = substring_dedup.remove_repeats(docs(spark, texts + [two + " end"], ids=[0, 1, 2, 3, 4, 5]).repartition(6), 20)
    assert {r.doc_id: r.n_removed for r in with_copies.collect()}[5] == 2048


def test_substring_dedup_whole_table(spark):
    same_as_oracle(queries.op7_recompression(spark, SF), connect().sql(queries.ORACLE["op7_recompression"]))
