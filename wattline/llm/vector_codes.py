"""Vector compression by product codes: Lloyd rounds in integers, with norm-of-sum bounds.

A vector is cut into ``PARTS`` consecutive parts; each part is coded by the nearest entry of its position's
codebook.  The codebooks start from the first vectors and are averaged in rounds.

Each row keeps, for each of its parts, its code, a lower bound on the distance to every other entry, and the
round in which that bound was measured.  The codebooks of all rounds are kept (they are small), so a bound of
round s is lowered by how far the entries have moved in total since s, ``|c_now - c_s|``: the norm of the sum
of their moves, which is at most the sum of the norms that accumulated drifts would subtract, and zero for an
entry that came back (Newling and Fleuret, "Fast k-means with accurate bounds").  A part whose own distance,
always taken exactly, lies below the lowered bound keeps its code; the others are scanned again.  Distances
are integers; the bounds are rounded down, so they never decide a tie.

A round is one pass over the rows, which are written to the shared folder with their state, and one sum of
them by entry, combined in each task first.  Vectors are never shuffled; the driver holds codebooks only.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import map_batches, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096

Codebooks = list[np.ndarray]        # one array (entries, width) for each part
_STATE = "vec_id long, label {label}, v binary, codes binary, bounds binary, stamps binary, error long, scans long"


def usable(vector: Column) -> Column:
    """Neither null nor empty, and without null or non-finite components."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(odd, F.lit(True))


def scaled(vector: Column) -> Column:
    """Integer components: floor(4096 * x)."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))


def cuts(dimension: int, parts: int = PARTS) -> np.ndarray:
    """Bounds of the parts; if they can't be equal, the first ones are longer by one."""
    return np.cumsum([0] + [len(x) for x in np.array_split(np.arange(dimension), parts)])


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(axis=-1)


def lowered(history: list[Codebooks], part: int) -> np.ndarray:
    """(stamp, entry): how far any other entry of the part has moved since the stamp, at most (rounded up)."""
    now = history[-1][part]
    moved = np.sqrt([squared(now, then[part]).astype(np.float64) for then in history]) * (1 + 1e-12)
    out = np.zeros_like(moved)
    for k in range(len(now)):
        out[:, k] = np.delete(moved, k, axis=1).max(axis=1, initial=0.0)
    return out


def assign(v: np.ndarray, history: list[Codebooks], codes: np.ndarray, bounds: np.ndarray, stamps: np.ndarray) -> tuple[np.ndarray, int]:
    """Move ``codes``, ``bounds`` and ``stamps`` (rows, parts; changed in place) to the newest codebooks.

    Returns each row's squared distance, and the number of parts that had to be scanned."""
    at, total, scans = cuts(v.shape[1], len(history[-1])), np.zeros(len(v), np.int64), 0
    for p, book in enumerate(history[-1]):
        x = v[:, at[p]:at[p + 1]]
        own = squared(x, book[codes[:, p]])
        left = bounds[:, p] - lowered(history, p)[stamps[:, p], codes[:, p]]
        again = np.flatnonzero(~((left > 0) & (left * left * (1 - 1e-9) > own)))
        if len(again):
            every = np.stack([squared(x[again], entry) for entry in book], axis=1)
            best = every.argmin(axis=1)                # the first of equals
            codes[again, p], own[again] = best, every[np.arange(len(again)), best]
            every[np.arange(len(again)), best] = np.iinfo(np.int64).max
            others = every.min(axis=1)
            bounds[again, p] = np.where(others == np.iinfo(np.int64).max, np.inf, np.sqrt(others.astype(np.float64)) * (1 - 1e-12))
            stamps[again, p] = len(history) - 1
            scans += len(again)
        total += own
    return total, scans


def _matrix(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def _pack(rows: np.ndarray, dtype: str) -> pa.Array:
    return pa.array([r.tobytes() for r in rows.astype(dtype)], pa.binary())


def _round(state: DataFrame, dimension: int, history: list[Codebooks], label: str) -> DataFrame:
    """Rows with the state of the newest codebooks; written, so the next round starts from files."""
    parts = len(history[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v = _matrix(b.column(2), "<i8", dimension)
            codes = _matrix(b.column(3), "u1", parts).astype(np.int64)
            bounds, stamps = _matrix(b.column(4), "<f8", parts).copy(), _matrix(b.column(5), "u1", parts).astype(np.int64)
            error, scans = assign(v, history, codes, bounds, stamps)
            counted = np.zeros(len(v), np.int64)
            counted[0] = scans
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), _pack(codes, "u1"), _pack(bounds, "<f8"), _pack(stamps, "u1"),
                 pa.array(error), pa.array(counted)], ["vec_id", "label", "v", "codes", "bounds", "stamps", "error", "scans"])

    return written(map_batches(state, run, _STATE.format(label=label)), "vector-codes")


def _averaged(state: DataFrame, dimension: int, book: Codebooks) -> Codebooks:
    """Each entry replaced by the floored mean of its parts; entries without parts stay."""
    parts, at = len(book), cuts(dimension, len(book))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = [np.zeros_like(b) for b in book], [np.zeros(len(b), np.int64) for b in book]
        for b in batches:
            if not b.num_rows:
                continue
            v, codes = _matrix(b.column(0), "<i8", dimension), _matrix(b.column(1), "u1", parts)
            for p in range(parts):
                for k in np.unique(codes[:, p]):
                    mine = codes[:, p] == k
                    sums[p][k] += v[mine, at[p]:at[p + 1]].sum(axis=0)
                    n[p][k] += mine.sum()
        cells = [(p, int(k), i, int(x)) for p in range(parts) for k in np.flatnonzero(n[p])
                 for i, x in enumerate([n[p][k], *sums[p][k]])]
        if cells:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*cells), (pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
                ["part", "entry", "i", "x"])

    rows = (map_batches(state.select("v", "codes"), run, "part int, entry int, i int, x long")
            .groupBy("part", "entry", "i").agg(F.sum("x").alias("x")).collect())     # one row a codebook component
    sums = {(r.part, r.entry, r.i): r.x for r in rows}
    out = [b.copy() for b in book]
    for (p, k, i), n in sums.items():
        if i == 0:
            out[p][k] = [sums[p, k, j + 1] // n for j in range(out[p].shape[1])]
    return out


def digest(book: Codebooks) -> str:
    return sha256(",".join(str(int(x)) for part in book for x in part.ravel()).encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[Codebooks]]:
    """State of every usable vector after the last round (``vec_id``, ``label``, ``codes``, ``error``, ...), and the
    codebooks of all rounds, the last ones final.

    Vectors that are null, empty or hold null or non-finite components take no part; neither do vectors of
    another dimension than the smallest id's.  Null ids come last, equal ids in the order of their components.
    Fewer vectors than entries make smaller codebooks.  An empty table gives no rows and no codebooks.
    Components may be so large that squared distances fit a long; beyond that, the job fails.
    """
    label = vectors.schema[label_col].dataType.simpleString()
    kept = vectors.where(usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), scaled(F.col(vector_col)).alias("c"))
    order = [F.col("vec_id").asc_nulls_last(), F.col("c")]
    first = kept.orderBy(*order).limit(1).collect()
    if not first:
        return kept.select("vec_id", "label", F.lit(b"").alias("codes"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("scans")), []
    dimension = len(first[0].c)
    kept = kept.where(F.size("c") == dimension)
    start = np.array([r.c for r in kept.orderBy(*order).limit(entries).collect()], dtype=np.int64)
    at = cuts(dimension, parts)
    history: list[Codebooks] = [[start[:, at[p]:at[p + 1]] for p in range(parts)]]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            v = b.column(2).flatten().to_numpy().reshape(n, dimension)
            if n and 4.0 * float(np.abs(v.astype(np.float64)).max()) ** 2 * dimension >= 2.0 ** 62:
                raise ValueError("components are too large for squared distances in 64 bits")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), _pack(v, "<i8"), _pack(np.zeros((n, parts)), "u1"), _pack(np.full((n, parts), -1.0), "<f8"),
                 _pack(np.zeros((n, parts)), "u1"), pa.array(np.zeros(n, np.int64)), pa.array(np.zeros(n, np.int64))],
                ["vec_id", "label", "v", "codes", "bounds", "stamps", "error", "scans"])

    state = _round(map_batches(kept, packed, _STATE.format(label=label)), dimension, history, label)
    for _ in range(rounds):
        history.append(_averaged(state, dimension, history[-1]))
        state = _round(state, dimension, history, label)
    return state, history


def codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id``, ``code`` (two hex digits for each part), ``error``, ``label_error`` (summed over rows with the
    same label, nulls together) and ``codebooks_sha256`` of every usable vector; see ``compress``."""
    state, history = compress(vectors, id_col, vector_col, label_col)
    # one row a label, summed in each task first; joined as a written table, so a hot label can be split
    sums = written(state.groupBy("label").agg(F.sum("error").alias("label_error")), "vector-codes-labels").alias("s")
    rows = state.alias("r").join(sums, F.col("r.label").eqNullSafe(F.col("s.label")))
    return rows.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error",
                       F.lit(digest(history[-1]) if history else "").alias("codebooks_sha256"))


def oracle() -> str:
    """DuckDB SQL of the codes of ``embeddings``: plain Lloyd rounds with full scans."""
    distance = "list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    steps = [f"""
v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, label, part::INT AS part, v[part * (len(v) // {PARTS}) + 1 : (part + 1) * (len(v) // {PARTS})] AS x
  FROM v, range({PARTS}) AS g(part)),
c0 AS MATERIALIZED (SELECT part, (row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1)::INT AS k, x FROM p
  QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= {ENTRIES})"""]
    for r in range(ROUNDS + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT p.vec_id, p.part, any_value(p.x) AS x, min(struct_pack(d := {distance}, k := c.k)) AS m
  FROM p JOIN c{r} AS c ON p.part = c.part GROUP BY p.vec_id, p.part)""")
        if r < ROUNDS:
            steps.append(f"""
s{r} AS (SELECT part, m.k AS k, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS y FROM a{r}),
t{r} AS (SELECT part, k, i, sum(y) AS s, count(*) AS n FROM s{r} GROUP BY part, k, i),
u{r} AS (SELECT part, k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x FROM t{r} GROUP BY part, k),
c{r + 1} AS MATERIALIZED (SELECT c.part, c.k, coalesce(u.x, c.x) AS x FROM c{r} AS c LEFT JOIN u{r} AS u ON u.part = c.part AND u.k = c.k)""")
    return "WITH " + ",".join(steps) + f""",
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, k)) AS codebooks_sha256 FROM c{ROUNDS}),
e AS (SELECT vec_id, string_agg(printf('%02x', m.k), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error FROM a{ROUNDS} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM e JOIN (SELECT vec_id, label FROM v) USING (vec_id), h"""
