"""Substring deduplication by recompression.

Repeated windows of ``window`` words are found without hashing every window of the corpus:

1. *Name.*  Every text is parsed by ``ROUNDS`` rounds of recompression (see ``recompression``).  Equal
   substrings get equal interior symbols with equal deciding contexts, so a symbol whose context fits
   into a window, named by itself and the words of its context, is a fingerprint of all windows that
   hold that context.  Windows that hold no context of the last round fall back on the symbols of the
   rounds before.  Spark counts the names: a block of texts sends each of its names once, and what
   occurs twice inside a block is known to be shared at once, so a very common passage sends a row
   for each block, not for each occurrence.
2. *Reveal.*  A window that holds a symbol which occurs nowhere else can't be a repeat.  The shared
   symbols go back to their documents (texts travel compressed); windows without an unshared symbol
   are candidates.  Later copies of a whole document need no windows: all their words go.
3. *Verify.*  Only candidates are compared by (document, start): a window by 96 bits over all its words, of
   which 64 are mixed word after word (see ``window_keys``), a whole document by 128 bits; a block
   sends each window once.  A window is removed if an equal one starts earlier.

The filter never drops a repeat: all symbols of a repeated window occur at least twice.  Names and the
prefix sums behind them only decide what is a candidate; sums alone would take some different texts for
equal (a word sequence and its complement in the order of Thue and Morse).
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.common import map_batches, written
from wattline.llm.recompression import Parse
from wattline.llm.tokens import Words, blocks, compress, compressed_blocks, joined, mix, pair_hash

#: Rounds of recompression: a symbol stands for 3.3 words on average, its context for 9.6.
ROUNDS = 4
BLOCK = 2 << 20
#: The last place in the order of documents.
_LAST = (1 << 63) - 1

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Runs:
    """64-bit hashes of runs of words, by differences of prefix sums."""

    def __init__(self, words: np.ndarray):
        up, down = np.full(len(words) + 1, _STEP), np.full(len(words) + 1, _BACK)
        up[0] = down[0] = 1
        self.down = np.multiply.accumulate(down)
        self.prefix = np.append(np.uint64(0), np.cumsum(words * np.multiply.accumulate(up)[:-1], dtype=np.uint64))

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.down[start])


def window_keys(hashes: np.ndarray, runs: Runs, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two keys of the windows that start at ``at``: 64 bits mixed over the word hashes in order (runs of 1, 2,
    4, ... words, joined to the window's length), and 32 bits of the window's prefix-sum hash."""
    key, done, size, power = None, 0, 1, hashes
    left = window
    while left:
        if left & 1:
            part = power[at + done]
            key = mix(part) if key is None else pair_hash(key, part)
            done += size
        left >>= 1
        if left:
            power = pair_hash(power[:-size], power[size:]) if len(power) > size else power[:0]
            size *= 2
    return key, (runs.hash(at, at + window) >> np.uint64(32)).astype(np.uint32).view(np.int32)


class Symbols:
    """The fingerprints of a block: ``name``, context ``low:high``, ``doc`` and ``number`` in the document.

    ``level`` says which rounds a symbol comes from (0: all of them), and ``bare[level]`` which windows held
    no context of the levels before.  A symbol speaks for those only: it is named in every place where
    such a window stands, but not in every place where its own context does.
    """

    def __init__(self, words: Words, window: int):
        runs, first = Runs(words.hash), words.first
        n = len(words.hash)
        owner = np.repeat(np.arange(len(words.count)), words.count)
        starts = max(n - window + 1, 0)
        bare = owner[:starts] == owner[window - 1:][:starts]            # windows without a context so far
        found, self.bare = [], []
        for name, low, high, doc in reversed(Parse(words.hash, first, ROUNDS).levels):
            fits = (high - low <= window) & (low >= first[doc]) & (high <= first[doc + 1])
            name, low, high, doc = name[fits], low[fits], high[fits], doc[fits]
            before = np.append(0, np.cumsum(bare))
            a, b = np.clip(high - window, 0, starts), np.clip(low + 1, 0, starts)
            needed = before[np.maximum(a, b)] > before[a]
            name, low, high, doc, a, b = name[needed], low[needed], high[needed], doc[needed], a[needed], b[needed]
            level = np.full(len(name), len(self.bare))
            found.append((pair_hash(name, runs.hash(low, high)), low, high, doc, level))
            self.bare.append(bare)
            bare = bare & ~spanned(a, b, starts)
            if not bare.any():
                break
        name, low, high, doc, level = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(doc, kind="stable")
        self.name, self.low, self.high, self.doc, self.level = name[order], low[order], high[order], doc[order], level[order]
        self.begins = np.searchsorted(self.doc, np.arange(len(words.count) + 1))
        self.number = np.arange(len(order)) - self.begins[self.doc]
        self.runs, self.window, self.starts = runs, window, starts

    def closed(self, alone: np.ndarray) -> np.ndarray:
        """Windows that a symbol among ``alone`` speaks for: those that hold its context start at
        high - window .. low."""
        out = np.zeros(self.starts, dtype=bool)
        for level, bare in enumerate(self.bare):
            at = alone[self.level[alone] == level]
            out |= bare & spanned(np.clip(self.high[at] - self.window, 0, self.starts), np.clip(self.low[at] + 1, 0, self.starts), self.starts)
        return out


def spanned(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Which of 0..n-1 lie in one of the ranges a:b."""
    change = np.bincount(a, minlength=n + 1) - np.bincount(np.maximum(a, b), minlength=n + 1)
    return np.cumsum(change)[:n] > 0


def _digests(words: Words, runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of whole documents: by prefix sums, and by the sum of each word mixed with its place."""
    place = np.arange(len(words.hash)) - np.repeat(words.first[:-1], words.count)
    placed = np.append(np.uint64(0), np.cumsum(mix(words.hash ^ mix(place.astype(np.uint64) + _STEP)), dtype=np.uint64))
    return (pair_hash(runs.hash(words.first[:-1], words.first[1:]), words.count.astype(np.uint64)),
            mix(placed[words.first[1:]] - placed[words.first[:-1]]))


def _named(digests: tuple[np.ndarray, np.ndarray]) -> list[bytes]:
    return [int(a).to_bytes(8, "big") + int(b).to_bytes(8, "big") for a, b in zip(*digests)]


def _packed(values: np.ndarray, owner: np.ndarray, n: int) -> list[bytes | None]:
    """Values (sorted by owner) as bytes for each owner 0..n-1; None where there are none."""
    at = np.searchsorted(owner, np.arange(n + 1))
    return [values[a:b].tobytes() if b > a else None for a, b in zip(at, at[1:])]


#: Marks in the column ``number``: a row for a whole document, and one for a copy found in its block.
_WHOLE, _COPY = -1, -2


def shared_symbols(docs: DataFrame, window: int) -> DataFrame:
    """(doc, numbers, packed, copies): of each document the symbols that occur more than once in the
    corpus, and the digests with which it is a later copy of another document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(name: np.ndarray, doc: np.ndarray, number: np.ndarray, packed: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(name.view(np.int64)), pa.array(number.astype(np.int32), mask=number < _COPY), pa.array(doc, pa.int64()),
                 pa.array(packed, pa.binary())], ["name", "number", "doc", "packed"])

        for batch in batches:
            ids = batch.column(0).to_numpy()
            for i, j, data, bounds in blocks(batch.column(1), BLOCK):
                words, doc = Words(data, bounds), ids[i:j]
                s = Symbols(words, window)
                _, where, of, times = np.unique(s.name, return_index=True, return_inverse=True, return_counts=True)
                where.sort()                     # by document, which packs better than by name
                yield rows(s.name[where], doc[s.doc[where]], s.number[where], [None] * len(where))
                # what occurs twice in the block is settled; it only travels along, spread over all partitions
                twice = times[of] > 1
                packed = _packed(s.number[twice].astype(np.int32), s.doc[twice], j - i)
                some = np.array([k for k, p in enumerate(packed) if p is not None], dtype=np.int64)
                spread = pair_hash(doc.astype(np.uint64), np.full(j - i, i, np.uint64))
                yield rows(spread[some], doc[some], np.full(len(some), _COPY - 1), [packed[k] for k in some])
                long = np.flatnonzero(words.count >= window)
                one, two = (d[long] for d in _digests(words, s.runs))
                order = np.lexsort((doc[long], two, one))
                long, one, two = long[order], one[order], two[order]
                head = np.ones(len(long), dtype=bool)
                head[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
                lead = np.maximum.accumulate(np.where(head, np.arange(len(long)), 0))
                copy = doc[long] != doc[long[lead]]
                yield rows(one[head], doc[long[head]], np.full(head.sum(), _WHOLE), _named((one[head], two[head])))
                yield rows(spread[long[copy]], doc[long[copy]], np.full(copy.sum(), _COPY), _named((one[copy], two[copy])))

    # columns that stay the same from row to row stand together, which packs better in the shuffle
    rows = docs.transform(map_batches, run, "name long, number int, doc long, packed binary")
    rows = rows.withColumn("whole", F.when(F.col("number") == _WHOLE, F.col("packed")))
    same = Window.partitionBy("name", "whole")
    counted = rows.withColumn("times", F.count("number").over(same)).withColumn("first", F.min("doc").over(same))
    copy = F.when(((F.col("number") == _WHOLE) & (F.col("first") < F.col("doc"))) | (F.col("number") == _COPY), F.hex("packed"))
    kept = counted.select("doc", copy.alias("copy"), F.when((F.col("number") >= 0) & (F.col("times") > 1), F.col("number")).alias("number"),
                          F.when(F.col("number").isNull(), F.col("packed")).alias("packed"))
    return (kept.where("copy is not null or number is not null or packed is not null").groupBy("doc")
            .agg(F.collect_list("number").alias("numbers"), F.collect_list("packed").alias("packed"),
                 F.collect_set("copy").alias("copies")))


def _unshared(s: Symbols, numbers: list, packed: list) -> np.ndarray:
    """Symbols that occur once in the corpus."""
    known = np.zeros(len(s.number), dtype=bool)
    for d, (plain, packs) in enumerate(zip(numbers, packed)):
        size = s.begins[d + 1] - s.begins[d]
        for part in [np.asarray(plain or [], dtype=np.int64), *(np.frombuffer(p, np.int32) for p in packs or [])]:
            known[s.begins[d] + part[part < size]] = True      # rows that share an id may have other lengths
    return np.flatnonzero(~known)


def candidates(docs: DataFrame, shared: DataFrame, window: int, all_texts: bool = False) -> DataFrame:
    """One row per row of ``docs`` (id, doc, text): ``n_words``, ``copy`` (of an earlier document: all words go);
    without candidates ``sha256`` of the joined words; else ``text`` (compressed), ``gone`` (starts that
    an earlier window of the same block repeats), and ``starts`` of the candidates that are first in
    their block.  ``all_texts`` keeps the text of every row that isn't a copy."""
    empty = sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = batch.column(1).to_numpy()
            for i, j, data, bounds in compressed_blocks(batch.column(2), BLOCK):
                words = Words(data, bounds)
                s = Symbols(words, window)
                numbers, packed, copies = (batch.column(c).slice(i, j - i).to_pylist() for c in (3, 4, 5))
                alone = _unshared(s, numbers, packed)
                copy = np.array([bool(c) and n >= window and d.hex().upper() in c
                                 for c, n, d in zip(copies, words.count, _named(_digests(words, s.runs)))], dtype=bool)
                n = len(words.hash)
                owner = np.repeat(np.arange(j - i), words.count)
                # the first level has all windows bare
                open_ = s.bare[0] & ~s.closed(alone) & ~copy[owner[:s.starts]]
                at = np.flatnonzero(open_)
                (h, more), of = window_keys(words.hash, s.runs, at, window), owner[at]
                start, doc = at - words.first[of], order[i:j][of]
                sort = np.lexsort((start, doc, more, h))
                new = np.ones(len(sort), dtype=bool)
                new[1:] = (h[sort][1:] != h[sort][:-1]) | (more[sort][1:] != more[sort][:-1])
                lead = sort[np.maximum.accumulate(np.where(new, np.arange(len(sort)), 0))]
                later = np.zeros(len(sort), dtype=bool)
                later[sort] = (doc[lead] != doc[sort]) | (start[lead] != start[sort])
                some = ((np.bincount(of, minlength=j - i) > 0) | all_texts) & ~copy
                whole = joined(words, ~some[owner])
                texts = [None if t else empty if c else sha256(b).hexdigest() for t, c, b in zip(some, copy, whole)]
                start = start.astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(words.count, pa.int64()),
                     pa.array(copy), pa.array(texts, pa.string()),
                     pa.array([t.as_py() if k else None for t, k in zip(batch.column(2).slice(i, j - i), some)], pa.binary()),
                     pa.array(_packed(start[later], of[later], j - i), pa.binary()),
                     pa.array(_packed(start[~later], of[~later], j - i), pa.binary())],
                    ["id", "doc", "n_words", "copy", "sha256", "text", "gone", "starts"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), compress(batch.column(2))], ["id", "doc", "text"])

    packed = docs.select("id", "doc", "text").transform(map_batches, pack, "id long, doc long, text binary")
    return packed.join(shared, "doc", "left").select("id", "doc", "text", "numbers", "packed", "copies").transform(map_batches, 
        run, "id long, doc long, n_words long, copy boolean, sha256 string, text binary, gone binary, starts binary")


def later_windows(found: DataFrame, window: int) -> DataFrame:
    """(row, starts): windows of each row of ``found`` of which an equal one starts earlier."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, doc = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i, j, data, bounds in compressed_blocks(batch.column(2), BLOCK):
                words = Words(data, bounds)
                packed = batch.column(3).slice(i, j - i).to_pylist()
                start = np.frombuffer(b"".join(packed), np.int32)
                of = np.repeat(np.arange(j - i), [len(p) // 4 for p in packed])
                at = words.first[of] + start
                h, more = window_keys(words.hash, Runs(words.hash), at, window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(more), pa.array(start), pa.array(doc[i:j][of]), pa.array(row[i:j][of])],
                    ["hash", "more", "start", "doc", "row"])

    # columns that stay the same from row to row stand together, which packs better in the shuffle
    windows = (found.where("starts is not null").select("row", "doc", "text", "starts")
               .transform(map_batches, run, "hash long, more int, start int, doc long, row long"))
    here = F.struct("doc", "start")
    first = F.first(here).over(Window.partitionBy("hash", "more").orderBy("doc", "start")
                               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return windows.withColumn("first", first).where(F.col("first") != here).groupBy("row").agg(
        F.collect_list("start").alias("later"))


def _without_id(top: int) -> Column:
    """Order of rows without id: after ``top``, the largest id, by a hash of the text.  Equal texts count as one
    document; different ones don't meet in one group."""
    room = min(1 << 40, _LAST - top)
    return F.lit(top) + 1 + F.pmod(F.xxhash64("text"), F.lit(room)) if room > 1 else F.lit(_LAST)


def remove_repeats(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   keep_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_removed``, ``kept_sha256``, with ``keep_text`` also
    ``kept_text``: the words that no removed window covers, joined by one space.

    A window is ``window`` consecutive words of one document; it is removed if the same words also start
    earlier (smaller id; or the same id, earlier start).  Rows without id come last, by a hash of their text.  Null texts have no words, and
    texts shorter than a window stay whole.  Repeated rows of a document get the same result.  An empty
    table gives no rows.  Other columns aren't read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    top = rows.agg(F.max("id")).first()[0]
    rows = rows.withColumn("doc", F.coalesce("id", _without_id(0 if top is None else top)))
    shared = shared_symbols(rows.select("doc", "text"), window)
    # zstd, as runs of starts pack well
    found = written(candidates(rows, shared, window, keep_text).withColumn("row", F.monotonically_increasing_id()), "substring-found",
                    compression="zstd")
    later = later_windows(found, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, bounds in compressed_blocks(batch.column(1), BLOCK):
                words = Words(data, bounds)
                change = np.zeros(len(words.hash) + 1, dtype=np.int64)
                for d, (gone, more) in enumerate(zip(batch.column(2).slice(i, j - i).to_pylist(),
                                                     batch.column(3).slice(i, j - i).to_pylist())):
                    start = np.unique(np.concatenate([np.frombuffer(gone or b"", np.int32), np.asarray(more or [], np.int32)])).astype(np.int64)
                    np.add.at(change, words.first[d] + start, 1)
                    np.add.at(change, words.first[d] + start + window, -1)
                keep = np.cumsum(change)[:-1] == 0
                kept = joined(words, keep)
                left = np.diff(np.append(0, np.cumsum(keep))[words.first])
                out = [batch.column(0).slice(i, j - i), pa.array(words.count, pa.int64()), pa.array(words.count - left, pa.int64()),
                       pa.array([sha256(k).hexdigest() for k in kept], pa.string())]
                if keep_text:
                    out.append(pa.array([k.decode() for k in kept], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names)

    names = ["id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * keep_text
    cut = found.where("text is not null").select("id", "text", "gone", "row").join(later, "row", "left").select(
        "id", "text", "gone", "later").transform(map_batches, run, "id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * keep_text)
    removed = F.when(F.col("copy"), F.col("n_words")).otherwise(F.lit(0)).cast("long")
    whole = found.where("text is null").select("id", "n_words", removed.alias("n_removed"), F.col("sha256").alias("kept_sha256"))
    if keep_text:
        whole = whole.withColumn("kept_text", F.lit(""))     # copies only: the other rows have their text
    return cut.unionByName(whole).withColumnRenamed("id", id_col)
