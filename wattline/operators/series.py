"""Skew-safe building blocks for per-series windows.

A plain ``Window.partitionBy(node).orderBy(ts)`` sends every row of a node to one task; if one
node holds a third of the data that task holds a third of the data.  The helpers here cut the order of
all rows, by (key, time), into balanced slices instead (``sliced``: written once, so that every later
step sees the same slices and the input is evaluated once).  A hot key is spread over as many slices as it
fills, whatever its density.  Windows run inside (slice, key), and the slices' edges are repaired from
tables of one row for each slice, or for each slice and key:

* ``previous_row`` / ``next_row`` — LAG / LEAD of the whole series: the first row of a slice takes the
  last row of the slice before, if the key is the same.
* ``running_total`` — the sum inside the slice plus the key's totals of earlier slices.
* ``carried_last`` — the last value so far that isn't null, from earlier slices where need be.

``with_halo`` serves windows that look back (or ahead) at most a fixed time: rows near a bucket edge
are copied into the neighbouring bucket as read-only halo rows, so a range frame inside (key, bucket)
sees everything it would see over the whole series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.session import materialized

DAY = 86_400
WEEK = 7 * DAY
#: Rows that the densest (key, bucket) may hold; buckets are shortened until it does.
BUCKET_ROWS = 1_000_000


def epoch_seconds(ts: str | Column) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp")) / F.lit(1_000_000)


def bucket_of(ts: str | Column, seconds: int) -> Column:
    return F.floor(epoch_seconds(ts) / F.lit(seconds)).cast("long")


def fitted(df: DataFrame, keys: Sequence[str], ts: str | Column, seconds: int, least: int = 60) -> int:
    """Bucket length for ``df``: ``seconds``, shortened (to ``least`` at most) so that the densest
    (key, bucket) holds about ``BUCKET_ROWS`` rows.  One counting aggregate over key and time."""
    per = df.groupBy(*keys, bucket_of(ts, seconds).alias("_b")).count()
    densest = per.agg(F.max("count")).first()[0] or 0
    return max(least, seconds // max(1, -(-densest // BUCKET_ROWS)))


def sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` cut into balanced ranges of (keys, order), numbered by ``_pid`` and written once."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialized(df.repartitionByRange(n, *keys, *order).withColumn("_pid", F.spark_partition_id()), "slices")


def _neighbours(slices: DataFrame, row: Column, forward: bool) -> DataFrame:
    """(_pid, _nb): the last row (``forward``: the first) of the nearest slice before (behind) each slice.

    One row for each slice, so the window over all of them is small, and so is what is broadcast."""
    edge = slices.groupBy("_pid").agg((F.min if forward else F.max)(row).alias("_row"))
    w = Window.orderBy(F.col("_pid").desc() if forward else F.col("_pid"))
    return F.broadcast(edge.select("_pid", F.lag("_row").over(w).alias("_nb")))


def _same_key(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(f"_nb.{k}"))
    return out


def _shift_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], prefix: str, forward: bool) -> DataFrame:
    slices = sliced(df, keys, order)
    carried = list(dict.fromkeys([*order, *cols]))
    w = Window.partitionBy("_pid", *keys).orderBy(*[F.col(c).desc() if forward else F.col(c) for c in order])
    d = slices.withColumns({f"{prefix}{c}": F.lag(c).over(w) for c in carried} | {"_edge": F.lag(F.lit(1)).over(w).isNull()})
    near = _neighbours(slices, F.struct(*dict.fromkeys([*keys, *carried])), forward)
    j = d.join(near, "_pid", "left")
    take = F.col("_edge") & _same_key(keys)
    fixed = {f"{prefix}{c}": F.when(take, F.col(f"_nb.{c}")).otherwise(F.col(f"{prefix}{c}")) for c in carried}
    return j.withColumns(fixed).drop("_edge", "_nb", "_pid")


def previous_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """Add ``prev_<c>`` for each order and value column: the previous row of the series ordered by
    ``order`` (unique within the key)."""
    return _shift_row(df, keys, order, cols, prefix, forward=False)


def next_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], prefix: str = "next_") -> DataFrame:
    """Add ``next_<c>``: the following row of the series (LEAD)."""
    return _shift_row(df, keys, order, cols, prefix, forward=True)


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str | Column, name: str) -> DataFrame:
    """Cumulative sum of ``value`` along the series (rows up to and including the current one)."""
    slices = sliced(df.withColumn("_v", F.col(value) if isinstance(value, str) else value), keys, order)
    w = (Window.partitionBy("_pid", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    totals = slices.groupBy("_pid", *keys).agg(F.sum("_v").alias("_t"))         # slices + keys rows
    wb = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(F.col("_pid").alias("_p"), *[F.col(k).alias(f"_b_{k}") for k in keys], F.coalesce(F.sum("_t").over(wb), F.lit(0)).alias("_before"))
    on = [F.col("_pid") == F.col("_p")] + [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys]
    return (slices.withColumn("_in", F.sum("_v").over(w)).join(before, on, "left")
            .withColumn(name, F.col("_in") + F.col("_before"))
            .drop("_pid", "_v", "_in", "_before", "_p", *[f"_b_{k}" for k in keys]))


def carried_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """The last ``value`` (a struct) of the series that isn't null, up to and including the current row."""
    slices = sliced(df, keys, order)
    w = Window.partitionBy("_pid", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the last value of any key in each slice: of the slice's first key there can be none between it and the slice
    some = slices.filter(F.col(value).isNotNull()).groupBy("_pid").agg(
        F.max(F.struct(*keys, *order, F.col(value).alias("_x"))).alias("_row"))
    pids = slices.groupBy("_pid").agg(F.lit(1).alias("_one")).join(some, "_pid", "left")
    w_before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    near = F.broadcast(pids.select("_pid", F.last("_row", ignorenulls=True).over(w_before).alias("_nb")))     # one row a slice
    j = slices.withColumn("_here", F.last(value, ignorenulls=True).over(w)).join(near, "_pid", "left")
    return (j.withColumn(name, F.coalesce("_here", F.when(_same_key(keys), F.col("_nb._x"))))
            .drop("_pid", "_here", "_nb"))


def with_halo(df: DataFrame, ts: str, bucket_seconds: int, before: int = 0, after: int = 0) -> DataFrame:
    """Add ``_bucket`` and ``_halo``.  A row is in its own bucket; it is also copied, with
    ``_halo = true``, into the next bucket when it lies within ``before`` seconds of that bucket's
    start, and into the previous bucket when within ``after`` seconds of its own bucket's start.
    Requires ``before, after <= bucket_seconds``."""
    if before > bucket_seconds or after > bucket_seconds:
        raise ValueError("halo wider than a bucket")
    s = epoch_seconds(ts)
    own = F.floor(s / F.lit(bucket_seconds)).cast("long")
    start = own * F.lit(bucket_seconds)
    entries = [F.struct(own.alias("b"), F.lit(False).alias("h"))]
    if before:
        entries.append(F.when(s + F.lit(before) >= start + F.lit(bucket_seconds),
                              F.struct((own + 1).alias("b"), F.lit(True).alias("h"))))
    if after:
        entries.append(F.when(s - F.lit(after) < start,
                              F.struct((own - 1).alias("b"), F.lit(True).alias("h"))))
    arr = F.filter(F.array(*entries), lambda x: x.isNotNull())
    return (df.withColumn("_e", F.explode(arr))
            .withColumns({"_bucket": F.col("_e.b"), "_halo": F.col("_e.h")}).drop("_e"))
