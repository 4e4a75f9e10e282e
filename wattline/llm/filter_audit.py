"""How text filters interact: what each removes at each step of every order, and what it would share.

1. One scan of the texts computes the flags of the filters that look at a text alone, and its 64-bit hash;
   these narrow rows are written.
2. Duplicate prepass: tasks add the hashes of their rows to counting Bloom sketches whose counters stop at
   two (two bit planes: seen, seen again), merged additively piece by piece on executors.  A text with a
   counter that stayed below two occurs once.  The sketch has eight counters for each row, at most
   ``SKETCH_BITS``; a fuller sketch clears fewer texts, it never changes a result.
3. The texts that may repeat, and only those, are shuffled, combined in each task first, for the smallest id
   of each full text (texts are read a second time for that).  The id goes back to the narrow rows by hash;
   hashes that two different texts share are told apart by the text.
4. The flags form a mask for each row.  Rows, and those with labels, are counted by part and mask: at most
   32 counts for each part.  Every figure of every order is a sum of such counts, so the orders never touch
   the rows again.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import WORD, map_batches, written

FILTERS = "ABCDE"
#: Counters of the sketch at most: 64 MB for the plane that is sent to the tasks.
SKETCH_BITS = 1 << 29
PROBES = 4
_PIECE = 1 << 20        # bytes of a plane in one row


def flags(text: Column) -> list[Column]:
    """Failure conditions of the filters A to D."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [F.size(words) < 200, 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
            100 * capitals > 3 * F.length(text), text.rlike(r"[#$%&*|]")]


def sketch_bits(rows: int, most: int = SKETCH_BITS) -> int:
    return min(most, 1 << max(13, (8 * rows - 1).bit_length()))


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """``PROBES`` different counters for each hash (double hashing with an odd step; bits is a power of two)."""
    h = hashes.astype(np.uint64)
    step = ((h >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    probes = np.arange(PROBES, dtype=np.uint64)[:, None]
    return ((h + probes * step) & np.uint64(bits - 1)).astype(np.int64)


def add(seen: np.ndarray, again: np.ndarray, hashes: np.ndarray) -> None:
    """Count hashes into the two bit planes."""
    bits = 8 * len(seen)
    at, times = np.unique(positions(hashes, bits).ravel(), return_counts=True)
    byte, bit = at >> 3, (1 << (at & 7)).astype(np.uint8)
    twice = (times > 1) | (seen[byte] & bit > 0)
    np.bitwise_or.at(again, byte[twice], bit[twice])
    np.bitwise_or.at(seen, byte, bit)


def merge(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of two sketches (or pieces of them) whose counters stop at two."""
    return a[0] | b[0], a[1] | b[1] | (a[0] & b[0])


def repeated(again: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """False for hashes that were counted once for sure."""
    at = positions(hashes, 8 * len(again))
    return (again[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(axis=0)


_PIECES = "piece int, seen binary, again binary"


def sketch(hashes: DataFrame, bits: int) -> np.ndarray:
    """The merged "seen again" plane of the long column of ``hashes`` (bits / 8 bytes)."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = again = None
        for batch in batches:
            if batch.num_rows:
                if seen is None:
                    seen, again = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
                add(seen, again, batch.column(0).to_numpy())
        for at in range(0, bits // 8 if seen is not None else 0, _PIECE):
            if (part := seen[at:at + _PIECE]).any():
                yield rows([(at // _PIECE, part, again[at:at + _PIECE])])

    def rows(pieces) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([p for p, _, _ in pieces], pa.int32()), pa.array([s.tobytes() for _, s, _ in pieces], pa.binary()),
             pa.array([a.tobytes() for _, _, a in pieces], pa.binary())], ["piece", "seen", "again"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums = None, None
        for batch in batches:
            for piece, seen, again in zip(*(c.to_pylist() for c in batch.columns)):
                planes = np.frombuffer(seen, np.uint8), np.frombuffer(again, np.uint8)
                if piece != at:
                    if at is not None:
                        yield rows([(at, *sums)])
                    at, sums = piece, planes
                else:
                    sums = merge(sums, planes)
        if at is not None:
            yield rows([(at, *sums)])

    # partial sketches are combined within salted groups first, so no task folds the pieces of all tasks
    spark = hashes.sparkSession
    parts = spark.sparkContext.defaultParallelism
    local = map_batches(hashes, build, _PIECES).withColumn("salt", F.spark_partition_id() % 16)
    half = map_batches(local.repartition(parts, "piece", "salt").sortWithinPartitions("piece").select("piece", "seen", "again"),
                       fold, _PIECES)
    whole = map_batches(half.repartition(parts, "piece").sortWithinPartitions("piece"), fold, _PIECES)
    plane = np.zeros(bits // 8, np.uint8)
    for row in whole.select("piece", "again").collect():      # SKETCH_BITS / 8 bytes at most
        part = np.frombuffer(row.again, np.uint8)
        plane[row.piece * _PIECE:row.piece * _PIECE + len(part)] = part
    return plane


def possible_repeats(texts: DataFrame, plane: np.ndarray) -> DataFrame:
    """Rows of ``texts`` (first column a long hash) that the sketch doesn't clear."""
    sent = texts.sparkSession.sparkContext.broadcast(plane.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again = np.frombuffer(sent.value, np.uint8)
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(repeated(again, batch.column(0).to_numpy())))

    return map_batches(texts, run, texts.schema)


def with_first_id(rows: DataFrame, texts: DataFrame, most_bits: int = SKETCH_BITS) -> DataFrame:
    """``rows`` (``h``, ``id``, more) with ``first_id``: the smallest id of the row's full text, null where the
    text occurs once.  ``texts`` has ``h``, ``id`` and ``text`` of the same rows."""
    plane = sketch(rows.select("h"), sketch_bits(rows.count(), most_bits))
    exact = F.min("id").alias("first_id")
    by_hash = written(possible_repeats(texts.select("h", "id", "text"), plane)
                      .groupBy("h", "text").agg(exact, F.count(F.lit(1)).alias("n"))
                      .groupBy("h").agg(F.min("first_id").alias("first_id"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
                      .where("n > 1"), "filter-audit-hashes")
    out = rows.join(by_hash.where("texts = 1").select("h", "first_id"), "h", "left")
    shared = by_hash.where("texts > 1").select("h")
    if not shared.take(1):
        return out
    # different texts under one hash: their rows are matched by the text itself
    apart = texts.select("h", "id", "text").join(shared, "h", "left_semi")
    apart = (apart.join(apart.groupBy("h", "text").agg(F.min("id").alias("exact_id")), ["h", "text"])
             .groupBy("h", "id").agg(F.min("exact_id").alias("exact_id")))
    return (out.join(apart, ["h", "id"], "left")
            .withColumn("first_id", F.coalesce("exact_id", "first_id")).drop("exact_id"))


def masks(docs: DataFrame, part_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
          most_bits: int = SKETCH_BITS) -> DataFrame:
    """``id``, ``part``, ``mask`` of every row: bit k is set if the row fails filter k of ``FILTERS``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.xxhash64(text).alias("h"), F.col(id_col).cast("long").alias("id"), text.alias("text"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    bits = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(flags(F.col("text")))), F.lit(0))
    rows = written(base.select("h", "id", "part", bits.alias("mask")), "filter-audit-rows")
    first = with_first_id(rows, base.select("h", "id", "text"), most_bits)
    copy = F.coalesce(F.col("id") > F.col("first_id"), F.lit(False))
    return first.select("id", "part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"))


def counts(masked: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows, rows labelled good and rows labelled toxic for each part and mask."""
    marks = labels.groupBy(F.col(id_col).cast("long").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")).where("good + toxic > 0")
    return (masked.join(marks, "id", "left").groupBy("part", "mask")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"),
                 F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic")))


def _orders() -> Column:
    """All (order, step, bit of the step's filter, bits of the filters before it), as a literal array."""
    return F.array(*(F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(k + 1).alias("step"),
                              F.lit(1 << FILTERS.index(order[k])).alias("own"),
                              F.lit(sum(1 << FILTERS.index(f) for f in order[:k])).alias("before"))
                     for order in permutations(FILTERS) for k in range(len(FILTERS))))


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
          most_bits: int = SKETCH_BITS) -> DataFrame:
    """One row for each part, order of the filters and step; see the module.

    Null texts count as empty and null parts as the empty string.  E needs a smaller id on the same text: rows
    without id don't fail it and don't make others fail; a repeated row (same id and text) doesn't either.  A
    document with several labels is good or toxic if one of them says so.  An empty table gives no rows.
    """
    total = counts(masks(docs, part_col, id_col, text_col, most_bits), labels, id_col)
    fails, earlier = F.col("mask").bitwiseAND(F.col("own")) > 0, F.col("mask").bitwiseAND(F.col("before")) > 0
    here = fails & ~earlier

    def added(which: Column, what: str = "n") -> Column:
        return F.sum(F.when(which, F.col(what)).otherwise(0)).cast("long")

    steps = (total.select("*", F.inline(_orders()))
             .groupBy("part", "filter_order", "step", "own")
             .agg(added(~fails & ~earlier).alias("kept"), added(here).alias("removed"), added(fails & earlier).alias("redundant"),
                  added(F.col("mask") == F.col("own")).alias("unique_fails"),
                  added(here, "good").alias("good_lost"), added(here, "toxic").alias("toxic_lost")))
    # the 120 steps of a filter, summed: at most 5 rows for each part
    shapley = steps.groupBy("part", "own").agg(F.sum("removed").alias("shapley"))
    return steps.join(shapley, ["part", "own"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def oracle() -> str:
    """DuckDB SQL of the audit of ``documents`` by language."""
    return r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT part, doc_id, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
             100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) AS c,
             regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
x AS (SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS m, count(*) AS n,
             coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
s AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS v),
o AS (SELECT p.f || q.f || r.f || s.f || t.f AS filter_order, [p.v, q.v, r.v, s.v, t.v] AS v
      FROM s AS p, s AS q, s AS r, s AS s, s AS t WHERE p.v + q.v + r.v + s.v + t.v = 31
        AND len(list_distinct([p.v, q.v, r.v, s.v, t.v])) = 5),
k AS (SELECT filter_order, i AS step, v[i] AS own, coalesce(list_sum(v[1 : i - 1]), 0)::INT AS before FROM o, range(1, 6) AS g(i)),
z AS (SELECT part, filter_order, step, own,
             sum(CASE WHEN m & own = 0 AND m & before = 0 THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN m & own > 0 AND m & before = 0 THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN m & own > 0 AND m & before > 0 THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN m = own THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN m & own > 0 AND m & before = 0 THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN m & own > 0 AND m & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM x, k GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM z"""
