"""MinHash near-duplicates with sequential Bayesian verification.

1. *Sketch.*  Each document gets the number and a digest of its distinct word shingles and a signature of
   ``BANDS * ROWS`` MinHash values (16 bits each).  Documents with one shingle set are one class; only
   classes go on.
2. *Candidates.*  Classes that agree on all ``ROWS`` values of one of the ``BANDS`` bands share a bucket.
   At a similarity of 0.8 a pair shares none with probability (1 - 0.8^6)^50 = 2.5e-7.
3. *Verification.*  A candidate's signatures are compared batch by batch; it is dropped as soon as the
   posterior probability (uniform prior) that its similarity reaches the threshold falls below ``MISS``.
   Survivors are confirmed on the full shingle sets.
4. *Links.*  First each class is compared with the smallest class of each of its buckets, which joins
   groups of copies in linear work.  Then buckets that still hold classes of different components
   compare exactly those, inside tasks, which return confirmed links only.  A large bucket is cut into
   chunks, and each pair of chunks is a unit of work of its own.

All sets are of 64-bit hashes of whole shingles; nothing is cut off or sampled.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import free_name, map_batches, written
from wattline.llm.components import components
from wattline.llm.tokens import Words, blocks, pair_hash

BANDS, ROWS, SEED = 50, 6, 3
#: Probability at which a candidate that might be a link is dropped.
MISS = 1e-6
#: Signature values compared at once.
BATCH = 30
#: Classes of a bucket in one chunk at most (on average, by hash).
CHUNK = 2048


def shingle_sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each document: (sorted hashes document by document, number of each).

    With fewer than ``width`` words the whole sequence is the one shingle; without words the set is empty.
    """
    n, h, first = words.count, words.hash, words.first
    owner = np.repeat(np.arange(len(n)), n)
    value, left = h, len(h)
    for k in range(1, width):
        if left - 1 <= 0:
            value, left = np.zeros(0, np.uint64), 0
            break
        left -= 1
        value = pair_hash(value[:left], h[k:k + left])
    whole = np.zeros(left, dtype=bool)
    if left:
        whole = owner[:left] == owner[width - 1:width - 1 + left]
    value, of = value[whole], owner[:left][whole]
    short = np.flatnonzero((n > 0) & (n < width))
    rest = []
    for i in short:                                   # shorter than a shingle: a few words
        v = h[first[i]]
        for x in h[first[i] + 1:first[i + 1]]:
            v = pair_hash(np.array([v]), np.array([x]))[0]
        rest.append(v)
    value = np.concatenate([value, np.array(rest, dtype=np.uint64)])
    of = np.concatenate([of, short])
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    return value[new], np.bincount(of[new], minlength=len(n))


def signatures(values: np.ndarray, size: np.ndarray, hashes: int) -> np.ndarray:
    """MinHash signatures (uint16) of non-empty sets; rows of empty sets are 0."""
    rng = np.random.default_rng(SEED)
    times = rng.integers(0, 1 << 32, hashes, dtype=np.uint32) | np.uint32(1)
    flip = rng.integers(0, 1 << 32, hashes, dtype=np.uint32)
    out = np.zeros((len(size), hashes), dtype=np.uint16)
    some = size > 0
    if some.any():
        first = (np.cumsum(size) - size)[some]
        short = (values ^ (values >> np.uint64(32))).astype(np.uint32)
        for k in range(hashes):
            low = np.minimum.reduceat((short ^ flip[k]) * times[k], first)
            out[some, k] = (low ^ (low >> np.uint32(16))).astype(np.uint16)
    return out


def least_matches(threshold: float, hashes: int, miss: float = MISS) -> list[tuple[int, int]]:
    """(values compared so far, matches below which a candidate is dropped) after each batch.

    With a uniform prior and m of n matches, P(similarity >= t) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in [*range(BATCH, hashes, BATCH), hashes]:
        total, m = 0.0, -1
        while total < miss and m < n:
            m += 1
            total += exp(lgamma(n + 2) - lgamma(m + 1) - lgamma(n + 2 - m) + m * log(threshold) + (n + 1 - m) * log(1 - threshold))
        out.append((n, m))
    return out


def plausible(sig: np.ndarray, others: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Places of the rows of ``others`` that survive the sequential comparison with ``sig`` (one row, or a row each)."""
    rows, matches, lo = np.arange(len(others)), np.zeros(len(others), dtype=np.int64), 0
    for hi, least in bounds:
        if not len(rows):
            break
        mine = sig[lo:hi] if sig.ndim == 1 else sig[rows, lo:hi]
        matches = matches + (others[rows, lo:hi] == mine).sum(1)
        stay = matches >= least
        rows, matches, lo = rows[stay], matches[stay], hi
    return rows


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted distinct values."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= percent * (len(both) - common)


def sketch(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(doc, text_hash, size, digest, sig) of each row; digest and signature are null for an empty set."""
    hashes = BANDS * ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, bounds in blocks(batch.column(2)):
                values, size = shingle_sets(Words(data, bounds, lower=True), width)
                sig = signatures(values, size, hashes)
                end = np.cumsum(size)
                digest = [blake2b(values[e - n:e].tobytes(), digest_size=16).digest() if n else None for e, n in zip(end, size)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(size, pa.int64()),
                     pa.array(digest, pa.binary()), pa.array([s.tobytes() if n else None for s, n in zip(sig, size)], pa.binary())],
                    ["doc", "text_hash", "size", "digest", "sig"])

    return docs.select(F.col(id_col).cast("long").alias("doc"), text_hash(text_col).alias("text_hash"), F.col(text_col).alias("text")).transform(
        map_batches, run, "doc long, text_hash long, size long, digest binary, sig binary")


def text_hash(text_col: str) -> Column:
    """With the id, what tells documents apart: an id may stand on several texts, or be missing."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _place() -> Column:
    """Orders documents: the smallest id first, null ids last, then by text."""
    return F.struct(F.col("doc").isNull().alias("no_doc"), "doc", "text_hash")


def full_sets(docs: DataFrame, wanted: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(node, set) of the classes in ``wanted`` (node, doc, text_hash, digest), read again from their first documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, bounds in blocks(batch.column(2)):
                values, size = shingle_sets(Words(data, bounds, lower=True), width)
                end = np.cumsum(size)
                sets = [values[e - n:e].tobytes() for e, n in zip(end, size)]
                same = [blake2b(s, digest_size=16).digest() == d for s, d in zip(sets, batch.column(1).slice(i, j - i).to_pylist())]
                out = pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(sets, pa.binary())], ["node", "set"])
                yield out.filter(pa.array(same, pa.bool_()))

    rows = (docs.select(F.col(id_col).cast("long").alias("_doc"), text_hash(text_col).alias("_hash"), F.col(text_col).alias("text"))
            .join(wanted, F.col("_doc").eqNullSafe(F.col("doc")) & (F.col("_hash") == F.col("text_hash"))).select("node", "digest", "text"))
    return rows.transform(map_batches, run, "node long, set binary").dropDuplicates(["node"])     # repeated rows


def _star_links(pairs: DataFrame, involved: DataFrame, threshold: float, percent: int) -> DataFrame:
    """Links (a, b) among ``pairs`` (a, b): Bayesian comparison, then the full sets."""
    hashes = BANDS * ROWS
    bounds = least_matches(threshold, hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = ([np.frombuffer(s, np.uint16) for s in batch.column(c).to_pylist()] for c in (2, 4))
            if not left:
                continue
            keep = [r for r in plausible(np.stack(left), np.stack(right), bounds)
                    if linked(np.frombuffer(batch.column(3)[r].as_py(), np.uint64),
                              np.frombuffer(batch.column(5)[r].as_py(), np.uint64), percent)]
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    one = involved.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"), F.col("set").alias("set_a"))
    two = involved.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"), F.col("set").alias("set_b"))
    return (pairs.join(one, "a").join(two, "b").select("a", "b", "sig_a", "set_a", "sig_b", "set_b")
            .transform(map_batches, run, "a long, b long"))


def _unit_links(rows: list[dict], band: int, across: bool, bounds: list[tuple[int, int]], percent: int) -> list[tuple[int, int]]:
    """Links between different labels in one unit: the members of a bucket, or of two of its chunks.

    A pair is taken up in the first band it shares.  Once two labels are linked here, their other
    pairs aren't looked at.
    """
    sig = np.stack([r["sig"] for r in rows])
    in_bands = sig.reshape(len(rows), BANDS, ROWS)
    size = np.array([len(r["set"]) for r in rows])
    side = np.array([r["side"] for r in rows])
    _, root = np.unique([r["label"] for r in rows], return_inverse=True)
    found = []
    for i in range(len(rows)):
        other = (root != root[i]) & (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i]))
        if across:
            other &= side > side[i]
        else:
            other[:i + 1] = False
        at = np.flatnonzero(other)
        at = at[plausible(sig[i], sig[at], bounds)]
        if not len(at):
            continue
        shared = (in_bands[at] == in_bands[i]).all(2)
        at = at[shared.argmax(1) == band]
        matches = (sig[at] == sig[i]).sum(1)
        for j in at[np.argsort(-matches, kind="stable")]:
            if root[j] != root[i] and linked(rows[i]["set"], rows[j]["set"], percent):
                found.append((rows[i]["node"], rows[j]["node"]))
                root[root == root[j]] = root[i]
    return found


def _cross_links(members: DataFrame, involved: DataFrame, threshold: float, percent: int) -> DataFrame:
    """Links between the labels that share a bucket; ``members``: (bucket, band, node, label, in_bucket)."""
    bounds = least_matches(threshold, BANDS * ROWS)
    chunks = F.ceil(F.col("in_bucket") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("node"), chunks).cast("int")
    units = (members.withColumn("chunks", chunks).withColumn("side", own)
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("bucket", F.least("side", "with").alias("u"), F.greatest("side", "with").alias("v"),
                     "band", "node", "label", "side"))
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = units.join(involved, "node").repartition(n, "bucket", "u", "v").sortWithinPartitions("bucket", "u", "v", "node")
    rows = rows.select("bucket", "u", "v", "band", "node", "label", "side", "sig", "set")

    def links(unit: list[dict], key: tuple) -> Iterator[pa.RecordBatch]:
        found = _unit_links(unit, unit[0]["band"], key[1] != key[2], bounds, percent) if unit else []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, unit = None, []
        for batch in batches:
            for r in batch.to_pylist():
                here = (r["bucket"], r["u"], r["v"])
                if here != key:
                    yield from links(unit, key)
                    key, unit = here, []
                unit.append({"band": r["band"], "node": r["node"], "label": r["label"], "side": r["side"],
                             "sig": np.frombuffer(r["sig"], np.uint16), "set": np.frombuffer(r["set"], np.uint64)})
        yield from links(unit, key)

    return rows.transform(map_batches, run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``, ``kept``.

    Links join documents with 100 * intersection >= ``percent`` * union of their distinct shingles of ``width``
    words (A-Z lower-cased).  Null, empty and wordless texts are linked with nothing and kept.  ``component_id``
    is the smallest id of the component; null ids never win over an id, and are kept where there is
    no other.  An id that stands on several texts is several documents; rows that agree in id and text are
    one.  An empty table gives no rows.  Other columns aren't read.
    """
    return _judged(docs, width, percent, id_col, text_col).select(
        F.col("doc").alias(id_col), F.col("size").alias("n_shingles"), "component_id",
        F.col("doc").eqNullSafe(F.col("component_id")).alias("kept"))


def _judged(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(doc, text_hash, size, component_id, stays) of each row; one document of each component stays."""
    threshold = percent / 100
    sketched = written(sketch(docs, width, id_col, text_col), "near-sketch")
    classes = (sketched.where("digest is not null").groupBy("digest")
               .agg(F.min(_place()).alias("first"), F.first("sig").alias("sig")))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "near-classes")

    bands = F.array(*[F.struct(F.lit(b).alias("band"), F.xxhash64(F.lit(b), F.substring("sig", 1 + 2 * ROWS * b, 2 * ROWS)).alias("bucket"))
                      for b in range(BANDS)])
    banded = classes.select("node", F.explode(bands).alias("x")).select("node", "x.band", "x.bucket")
    buckets = written(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("in_bucket"), F.min("node").alias("center"))
                      .where("in_bucket > 1"), "near-buckets")
    members = written(banded.join(buckets, "bucket"), "near-members")

    wanted = classes.join(members.select("node").distinct(), "node", "left_semi")
    sets = full_sets(docs, wanted.select("node", "first.doc", "first.text_hash", "digest"), width, id_col, text_col)
    involved = written(wanted.select("node", "sig").join(sets, "node"), "near-sets")

    stars = members.where("node <> center").select(F.col("node").alias("a"), F.col("center").alias("b")).distinct()
    joined = components(_star_links(stars, involved, threshold, percent))
    labelled = written(members.drop("center").join(joined.withColumnRenamed("a", "node"), "node", "left")
                       .withColumn("label", F.coalesce("b", "node")).drop("b"), "near-labelled")
    # of buckets with the same members the one of the first band stays: no pair can share an earlier one
    members_of = [F.count(F.lit(1)).alias("n"), *(F.bit_xor(F.xxhash64(F.lit(k), "node")).alias(f"x{k}") for k in range(2))]
    mixed = labelled.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("band").alias("band"), *members_of)
    mixed = written(mixed.where("lo <> hi").groupBy("n", "x0", "x1").agg(F.min_by("bucket", "band").alias("bucket")).select("bucket"), "near-mixed")
    cross = _cross_links(labelled.join(mixed, "bucket", "left_semi"), involved, threshold, percent)
    joined = components(joined.unionByName(cross))

    named = classes.select("digest", "first", "node").join(joined.withColumnRenamed("a", "node"), "node", "left")
    named = written(named.select("digest", "first", F.coalesce("b", "node").alias("label")), "near-named")
    smallest = named.groupBy("label").agg(F.min("first").alias("keeper"))
    final = written(named.join(smallest, "label").select("digest", "keeper"), "near-components")
    rows = sketched.select("doc", "text_hash", "size", "digest")
    some = rows.where("digest is not null").join(final, "digest").select(
        "doc", "text_hash", "size", F.col("keeper.doc").alias("component_id"), (F.col("keeper") == _place()).alias("stays"))
    none = rows.where("digest is null").select("doc", "text_hash", "size", F.col("doc").alias("component_id"), F.lit(True).alias("stays"))
    return some.unionByName(none)


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one document of each component, which is an id with
    its text (rows that agree in both stay or go together), and all texts without words.

    The documents that go are far fewer than those that stay, so they are the side that is joined."""
    key, text = free_name(docs, "_dropped"), free_name(docs, "_dropped_text")
    dropped = written(_judged(docs, width, percent, id_col, text_col).where("not stays")
                      .select(F.col("doc").alias(key), F.col("text_hash").alias(text)).distinct(), "near-dropped")
    same = F.col(id_col).cast("long").eqNullSafe(F.col(key)) & (text_hash(text_col) == F.col(text))
    return docs.join(dropped, same, "left_anti")
