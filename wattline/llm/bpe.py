"""Byte-level BPE: encoding by ranks, and decoding.

1. *Words.*  Texts are cut into pattern matches ("words") on their UTF-8 bytes with numpy, block by
   block; Spark counts the distinct words of the corpus.
2. *Merges.*  Spark's higher-order functions fold the ranked merges over the byte arrays of the
   distinct words: each step of the fold joins the leftmost pair of lowest rank.  The ranks are a
   literal: an array of small maps, indexed by the CRC of the joined pair.
3. *Texts.*  The folded words, most frequent first and at most ``DICTIONARY_WORDS`` of them (a bound
   on what is broadcast, whatever the corpus), go to the tasks as a dictionary.  A task looks the
   words of a text up in it; rarer words are merged there by the same rule.  Nothing is shuffled by
   text, and no word is left out.
4. *Decoding* concatenates the binary pieces of the ids.  Each block's decoded bytes are compared with
   its input; a block that differed (two words of one 64-bit hash) would be encoded again word by word.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import map_batches, written
from wattline.llm.tokens import blocks, ragged, segment_hash

#: Words of the broadcast dictionary at most (about 30 bytes each).
DICTIONARY_WORDS = 1 << 18
#: Longest word that is folded in Spark (the fold is quadratic in the bytes of a word).
FOLD_BYTES = 64
#: Slots of the literal rank map, a power of two.
SLOTS = 1 << 13
#: Words that a Python worker remembers besides the dictionary.
CACHE_WORDS = 200_000

_OTHER, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3


def load_ranks(path: str) -> dict[bytes, int]:
    """Read a rank file (base64 piece and rank on each line) on the driver: a fixed vocabulary."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


# --- words ------------------------------------------------------------------------------------

@lru_cache(maxsize=1)
def class_runs() -> tuple[np.ndarray, np.ndarray]:
    """Classes of all code points as runs (class, length): letter (L*), number (N*), white space, other."""
    out = np.zeros(0x110000, dtype=np.uint8)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))[0]
        if kind == "L":
            out[i] = _LETTER
        elif kind == "N":
            out[i] = _NUMBER
    # fixed values: code points with the property White_Space
    out[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = _SPACE
    at = np.append(0, np.flatnonzero(np.diff(out)) + 1)
    return out[at], np.diff(np.append(at, len(out)))


def byte_classes(data: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of valid UTF-8: the class of its character, and whether it opens the character."""
    opens = (data & 0xC0) != 0x80
    kind = classes[:256][data]
    high = np.flatnonzero(data >= 0xC0)
    if len(high):
        padded = np.append(data, np.zeros(3, np.uint8)).astype(np.uint32)
        lead = padded[high]
        n = np.where(lead >= 0xF0, 4, np.where(lead >= 0xE0, 3, 2))
        c1, c2, c3 = padded[high + 1] & 63, padded[high + 2] & 63, padded[high + 3] & 63
        code = np.where(n == 2, (lead & 31) << 6 | c1, np.where(
            n == 3, (lead & 15) << 12 | c1 << 6 | c2, (lead & 7) << 18 | c1 << 12 | c2 << 6 | c3))
        of = classes[np.minimum(code, 0x10FFFF)]
        kind[high] = of
        for k in (1, 2, 3):
            longer = n > k
            kind[np.minimum(high[longer] + k, len(data) - 1)] = of[longer]
    return kind, opens


def word_starts(data: np.ndarray, bounds: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Byte offsets at which the pattern's matches start (the matches cover every text).

    The pattern: ``'s 't 're 've 'm 'll 'd``, then runs of letters, of numbers or of other characters,
    each with one leading blank if there is one, then white space: all of a run but its last
    character if something follows, else the rest.
    """
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64)
    kind, opens = byte_classes(data, classes)
    edge = np.zeros(n + 1, dtype=bool)               # starts of texts
    edge[bounds] = True
    run = edge[:n].copy()
    run[0] = True
    run[1:] |= kind[1:] != kind[:-1]                  # starts of runs of one class
    start = run.copy()
    at = np.flatnonzero(run)
    end = np.append(at[1:], n)
    # a white-space run before something else in the same text
    before = (kind[at] == _SPACE) & (end < n) & ~edge[end]
    close = end[before]
    char = np.maximum.accumulate(np.where(opens, np.arange(n), 0))
    last = char[close - 1]                            # its last character starts a word of its own ...
    start[last] = True
    blank = data[last] == 0x20                        # ... or, if it is a blank, belongs to the next word
    start[close[blank]] = False
    # contractions: an apostrophe that opens a word, with the letters after it
    quote = at[(data[at] == 0x27) & start[at]]
    if len(quote):
        limit = np.append(bounds, n)
        text_end = limit[np.searchsorted(limit, quote, side="right")]
        padded = np.append(data, np.zeros(3, np.uint8))
        a, b = padded[quote + 1], padded[quote + 2]
        one = np.isin(a, np.frombuffer(b"stmd", np.uint8)) & (quote + 1 < text_end)
        two = ((((a == ord("r")) | (a == ord("v"))) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))) & (quote + 2 < text_end)
        hit = one | two
        length = np.where(one, 2, 3)[hit]
        quote = quote[hit]
        start[quote + 1] = False
        rest = quote + length
        inside = rest < n
        start[rest[inside]] = True
    return np.flatnonzero(start)


# --- merges -----------------------------------------------------------------------------------

def rank_literal(ranks: dict[bytes, int], slots: int = SLOTS) -> Column:
    """The ranks as a literal array of maps; pieces are strings of one character (0-255) per byte."""
    table: list[dict[str, int]] = [{} for _ in range(slots)]
    for piece, rank in ranks.items():
        key = piece.decode("latin-1")
        table[zlib.crc32(key.encode()) & (slots - 1)][key] = rank
    return F.from_json(F.lit(json.dumps(table)), "array<map<string,int>>")


def fold_merges(word: Column, ranks: Column, slots: int = SLOTS) -> Column:
    """Ids of a word (binary), by a fold of ranked merges over its bytes."""
    text = F.decode(word, "ISO-8859-1")

    def rank(piece: Column) -> Column:
        return F.element_at(F.get(ranks, F.crc32(piece.cast("binary")).bitwiseAND(F.lit(slots - 1).cast("long")).cast("int")), piece)

    def join(parts: Column, at: Column) -> Column:
        return F.concat(F.slice(parts, F.lit(1), at - 1), F.array(F.concat(F.get(parts, at - 1), F.get(parts, at))),
                        F.slice(parts, at + 2, F.size(parts)))

    def step(parts: Column, _: Column) -> Column:
        pair_ranks = F.zip_with(F.slice(parts, F.lit(1), F.size(parts) - 1), F.slice(parts, F.lit(2), F.size(parts)),
                                lambda a, b: rank(F.concat(a, b)))
        # a one-element array binds the ranks, so that they are looked up once
        return F.element_at(F.transform(F.array(pair_ranks), lambda r: F.when(
            F.array_min(r).isNull(), parts).otherwise(join(parts, F.array_position(r, F.array_min(r)).cast("int")))), 1)

    bytes_of = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(text, i, F.lit(1)))
    parts = F.aggregate(F.sequence(F.lit(1), F.length(text)), bytes_of, step)
    return F.transform(parts, rank)


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for one word, by a heap over linked parts (long words included)."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end = list(range(1, n + 1))                       # part at i is word[i:end[i]]
    back = list(range(-1, n - 1))                     # start of the part before
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, e = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != e:
            continue
        j = end[i]
        alive[j] = False
        end[i] = e
        if e < n:
            back[e] = i
            if (r := ranks.get(word[i:end[e]])) is not None:
                heapq.heappush(heap, (r, i, end[e]))
        b = back[i]
        if b >= 0 and (r := ranks.get(word[b:e])) is not None:
            heapq.heappush(heap, (r, b, e))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


# --- tables -----------------------------------------------------------------------------------

class Codec:
    """What a task needs: the pieces of the ids, the ranks and the dictionary of folded words."""

    def __init__(self, ranks: dict[bytes, int], runs: tuple[np.ndarray, np.ndarray], keys: np.ndarray,
                 first: np.ndarray, ids: np.ndarray):
        self.ranks, self.keys, self.first, self.ids = ranks, keys, first, ids
        pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            pieces[rank] = piece
        self.size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.at = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.cache: dict[bytes, list[int]] = {}
        self.classes = np.repeat(*runs)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[ragged(self.at[ids], self.size[ids])]

    def _merged(self, word: bytes) -> list[int]:
        found = self.cache.get(word)
        if found is None:
            found = merge_word(word, self.ranks)
            if len(word) <= FOLD_BYTES:
                if len(self.cache) >= CACHE_WORDS:
                    self.cache.clear()
                self.cache[word] = found
        return found

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in ``data``, and where each text's ids start."""
        start = word_starts(data, bounds, self.classes)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        end = np.append(start[1:], len(data))
        key, where, of = np.unique(segment_hash(data, start), return_index=True, return_inverse=True)
        slot = np.searchsorted(self.keys, key)
        known = np.zeros(len(key), dtype=bool)
        inside = slot < len(self.keys)
        known[inside] = self.keys[slot[inside]] == key[inside]
        raw = data.tobytes()
        rare = [self._merged(raw[start[w]:end[w]]) for w in where[~known]]
        rare_len = np.fromiter(map(len, rare), np.int64, len(rare))
        rare_ids = np.fromiter((i for ids in rare for i in ids), np.uint32, int(rare_len.sum()))
        length = np.empty(len(key), np.int64)
        first = np.empty(len(key), np.int64)
        length[known] = (self.first[1:] - self.first[:-1])[slot[known]]
        first[known] = self.first[:-1][slot[known]]
        length[~known] = rare_len
        first[~known] = len(self.ids) + np.cumsum(rare_len) - rare_len
        ids = np.concatenate([self.ids, rare_ids]) if len(rare_ids) else self.ids
        per_word = length[of]
        out = ids[ragged(first[of], per_word)]
        if not np.array_equal(self.decode(out), data):
            words = [self._merged(raw[s:e]) for s, e in zip(start, end)]
            per_word = np.fromiter(map(len, words), np.int64, len(words))
            out = np.fromiter((i for ids in words for i in ids), np.uint32, int(per_word.sum()))
        before = np.append(0, np.cumsum(per_word))
        return out, before[np.searchsorted(start, bounds)]


def distinct_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word binary, times) of all texts."""
    runs = class_runs()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = np.repeat(*runs)
        for batch in batches:
            for _, _, data, bounds in blocks(batch.column(0)):
                start = word_starts(data, bounds, classes)
                if not len(start):
                    continue
                end = np.append(start[1:], len(data))
                _, where, times = np.unique(segment_hash(data, start), return_index=True, return_counts=True)
                short = end[where] - start[where] <= FOLD_BYTES
                where, times = where[short], times[short]
                size = end[where] - start[where]
                packed = data[ragged(start[where], size)]
                offsets = np.append(0, np.cumsum(size)).astype(np.int32)
                words = pa.Array.from_buffers(pa.binary(), len(where), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
                yield pa.RecordBatch.from_arrays([words, pa.array(times, pa.int64())], ["word", "times"])

    return (docs.select(F.col(text_col).alias("text")).transform(map_batches, count, "word binary, times long")
            .groupBy("word").agg(F.sum("times").alias("times")))


def dictionary(docs: DataFrame, ranks: dict[bytes, int], text_col: str = "text",
               most: int = DICTIONARY_WORDS) -> DataFrame:
    """(word, ids) of at most ``most`` distinct words: all, or those above the count that fits."""
    words = written(distinct_words(docs, text_col), "bpe-words")
    level = F.floor(F.log2("times") * 8).cast("int")       # at most 512 levels
    per_level = words.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    cut, total = 512, 0
    for row in per_level:
        if total + row["count"] > most:
            break
        cut, total = row["level"], total + row["count"]
    return words.where(level >= cut).select("word", fold_merges(F.col("word"), rank_literal(ranks)).alias("ids"))


def codec_parts(docs: DataFrame, ranks: dict[bytes, int], text_col: str = "text",
                most: int = DICTIONARY_WORDS) -> tuple:
    """The arguments of ``Codec``, as plain values; the dictionary is bounded by ``most``."""
    found = dictionary(docs, ranks, text_col, most).toArrow()
    words, ids = found["word"].combine_chunks(), found["ids"].combine_chunks()
    if isinstance(words, pa.ChunkedArray):
        words, ids = pa.concat_arrays(words.chunks), pa.concat_arrays(ids.chunks)
    words = words.cast(pa.large_binary())
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8) if len(words) else np.zeros(0, np.uint8)
    key = segment_hash(data[at[0]:at[-1]], at[:-1] - at[0])
    order = np.argsort(key)
    size = np.diff(np.asarray(ids.offsets)).astype(np.int64) if len(words) else np.zeros(0, np.int64)
    flat = np.asarray(ids.flatten()).astype(np.uint32)
    first = np.cumsum(size) - size
    flat = flat[ragged(first[order], size[order])]
    return ranks, class_runs(), key[order], np.append(0, np.cumsum(size[order])), flat


def encode(docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text",
           most: int = DICTIONARY_WORDS, keep_ids: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``, and with
    ``keep_ids`` also ``ids`` (array of int) and ``decoded`` (binary).

    Null and empty texts have no tokens (the digests are those of no bytes).  Repeated rows give
    repeated results, an empty table none.  Other columns aren't read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(codec_parts(docs, ranks, text_col, most))
    empty = hashlib.sha256(b"").hexdigest()
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        schema += ", ids array<int>, decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Codec(*shared.value)
        for batch in batches:
            for i, j, data, bounds in blocks(batch.column(1)):
                ids, first = tool.encode(data, bounds)
                decoded = tool.decode(ids).tobytes()
                sizes = np.append(0, np.cumsum(tool.size[ids]))[first]
                raw = ids.astype("<u4").tobytes()
                digests = [hashlib.sha256(raw[4 * a:4 * b]).hexdigest() if b > a else empty for a, b in zip(first, first[1:])]
                back = [hashlib.sha256(decoded[a:b]).hexdigest() if b > a else empty for a, b in zip(sizes, sizes[1:])]
                out = [batch.column(0).slice(i, j - i), pa.array(np.diff(first), pa.int64()), pa.array(digests, pa.string()),
                       pa.array(back, pa.string())]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    out += [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids.astype(np.int32))),
                            pa.array([decoded[a:b] for a, b in zip(sizes, sizes[1:])], pa.binary())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(out, names)

    return docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_text")).transform(map_batches, run, schema)
