"""Silver cleaning and alignment.

Per-series work is expressed with the skew-safe helpers of ``series``: windows are partitioned
by (key, time bucket), never by the key alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.functions.columns import dround
from wattline.operators import series as S
from wattline.session import materialized


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row per key, the one with the greatest ``order`` tuple.

    Written as ``max(struct(order..., cols...))`` per key: an aggregate with a map-side partial
    step, so a key repeated millions of times is reduced inside each task before the shuffle."""
    packed = F.struct(*[F.col(c) for c in list(order) + [c for c in cols if c not in order]])
    return df.groupBy(*keys).agg(F.max(packed).alias("_w")).select(*keys, "_w.*")


def gaps(df: DataFrame, key: str, ts: str, tiebreak: Sequence[str], nominal_seconds: int,
         factor: float = 1.5) -> DataFrame:
    """Consecutive samples further apart than factor x nominal step."""
    p = S.previous_row(df.select(key, ts, *tiebreak), [key], [ts, *tiebreak], [])
    diff = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col(f"prev_{ts}").cast("timestamp"))
    return (p.filter(F.col(f"prev_{ts}").isNotNull())
            .select(F.col(key), F.col(f"prev_{ts}").alias("gap_start"), F.col(ts).alias("gap_end"),
                    diff.alias("gap_us"))
            .filter(F.col("gap_us") > F.lit(int(factor * nominal_seconds * 1_000_000))))


def fill_linear(series: DataFrame, key: str, ts: str, value: str, step_hours: int = 1,
                max_fill: int = 6) -> DataFrame:
    """Complete the regular grid between a key's first and last sample.  Missing steps are
    interpolated linearly in time when the gap has at most ``max_fill`` missing steps; longer gaps
    stay NULL; nothing is extrapolated.  Driven by the previous sample, so no calendar join: each sample gives
    itself and the steps missing before it."""
    p = S.previous_row(series.select(key, ts, value), [key], [ts], [value])
    step_us = step_hours * 3_600_000_000
    since = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col(f"prev_{ts}").cast("timestamp"))
    missing = F.coalesce((since / F.lit(step_us)).cast("long") - 1, F.lit(0))
    g = p.withColumn("_k", missing.cast("int")).withColumn("_i", F.explode(F.sequence(F.lit(0), F.greatest("_k", F.lit(0)))))
    own = F.col("_i") == 0
    interp = F.col(f"prev_{value}") + (F.col(value) - F.col(f"prev_{value}")) * F.col("_i") / (F.col("_k") + 1)
    at = F.col(f"prev_{ts}") + F.make_dt_interval(hours=F.col("_i") * F.lit(step_hours))
    filled = F.when(~own & (F.col("_k") <= max_fill), dround(interp, 4))
    return g.select(F.col(key), F.when(own, F.col(ts)).otherwise(at).alias(ts), F.when(own, F.col(value)).otherwise(filled).alias(value),
                    filled.isNotNull().alias("is_filled"))


def zscore_outliers(series: DataFrame, key: str, ts: str, value: str, lookback_seconds: int = 86_400,
                    step_seconds: int = 3_600, min_count: int = 12, z: float = 3.0,
                    bucket_seconds: int | None = None) -> DataFrame:
    """Z-score of each sample against the samples of the previous ``lookback`` (24 h), with at
    least ``min_count`` of them; sd = 0 gives no z.  Windows run per (key, week), or a shorter bucket
    for dense keys, with a 24 h halo.  Where a key's day alone is too much for one task, the window is put
    together from whole buckets of minutes and the two that it cuts (``_look_back_sums``)."""
    bucket_seconds = bucket_seconds or S.fitted(series, [key], ts, S.WEEK)
    rows = series.select(key, ts, value)
    if bucket_seconds < lookback_seconds:
        s = _look_back_sums(rows, key, ts, value, lookback_seconds, step_seconds, bucket_seconds)
    else:
        h = S.with_halo(rows, ts, bucket_seconds, before=lookback_seconds)
        t = S.epoch_seconds(ts).cast("long")
        w = (Window.partitionBy(key, "_bucket").orderBy(t)
             .rangeBetween(-lookback_seconds, -step_seconds))
        v = F.col(value).cast("decimal(18,4)")
        s = h.withColumns({
            "n": F.count(F.col(value)).over(w),
            "_s1": F.sum(v).over(w).cast("double"),
            "_s2": F.sum(v * v).over(w).cast("double"),
        }).filter(~F.col("_halo"))
    mean = F.col("_s1") / F.col("n")
    var = (F.col("_s2") - F.col("_s1") * F.col("_s1") / F.col("n")) / (F.col("n") - 1)
    s = s.withColumn("_var", F.when(F.col("n") >= 2, var))
    sd = F.when(F.col("_var") > 0, F.sqrt("_var")).otherwise(F.lit(0.0))
    zc = F.when((F.col("n") >= min_count) & (sd > 0), (F.col(value) - mean) / sd)
    out = s.withColumn("z", dround(zc, 4))
    return out.select(key, ts, value, "n", "z",
                      F.coalesce(F.abs(F.col("z")) > F.lit(z), F.lit(False)).alias("is_outlier"))


def _look_back_sums(rows: DataFrame, key: str, ts: str, value: str, lookback: int, step: int, most: int) -> DataFrame:
    """Count, sum and sum of squares (``n``, ``_s1``, ``_s2``) of the samples from ``lookback`` to ``step`` seconds before
    each row, for keys so dense that a bucket must be shorter than the look-back.

    Buckets divide both times, so the window of a row in bucket b is: the later part of bucket b - lookback,
    the whole buckets in between, and the earlier part of bucket b - step, cut at the row's own place in its
    bucket.  Rows are copied to the two buckets that cut them; the whole buckets are summed first, and a window
    runs over one row for each (key, bucket).  Sums are exact decimals, so the way they are put together
    doesn't show."""
    whole = gcd(lookback, step)
    size = max(d for d in range(1, whole + 1) if whole % d == 0 and (d <= most or d == 1))
    far, near = lookback // size, step // size
    t = S.epoch_seconds(ts).cast("long")
    v = F.col(value).cast("decimal(18,4)")
    own = rows.withColumns({"_b": F.floor(t / size).cast("long"), "_v": v}).withColumn("_o", t - F.col("_b") * size)
    totals = own.groupBy(key, "_b").agg(F.count(value).alias("_n"), F.sum("_v").alias("_1"), F.sum(F.col("_v") * F.col("_v")).alias("_2"))
    between = Window.partitionBy(key).orderBy("_b").rangeBetween(-(far - 1), -(near + 1))
    middle = totals.select(F.col(key).alias("_k"), F.col("_b").alias("_mb"), *[F.sum(c).over(between).alias(f"_m{c}") for c in ("_n", "_1", "_2")])
    roles = F.explode(F.array(*[F.struct((F.col("_b") + d).alias("b"), F.lit(r).alias("r")) for d, r in ((0, "own"), (far, "far"), (near, "near"))]))
    copies = own.withColumn("_x", roles).withColumns({"_b": F.col("_x.b"), "_r": F.col("_x.r")}).drop("_x")
    w = Window.partitionBy(key, "_b").orderBy("_o")
    after, before = w.rangeBetween(0, Window.unboundedFollowing), w.rangeBetween(Window.unboundedPreceding, 0)

    def cut(x, name: str):
        parts = [F.sum(F.when(F.col("_r") == r, x)).over(frame) for r, frame in (("far", after), ("near", before))]
        return F.coalesce(parts[0], F.lit(0)) + F.coalesce(parts[1], F.lit(0)) + F.coalesce(F.col(f"_m{name}"), F.lit(0))

    one = F.when(F.col(value).isNotNull(), 1).otherwise(0).cast("long")
    on = F.col(key).eqNullSafe(F.col("_k")) & (F.col("_b") == F.col("_mb"))
    out = copies.join(middle, on, "left").withColumns({"n": cut(one, "_n"), "_s1": cut(F.col("_v"), "_1").cast("double"),
                                                       "_s2": cut(F.col("_v") * F.col("_v"), "_2").cast("double")})
    return out.filter(F.col("_r") == "own").select(key, ts, value, "n", "_s1", "_s2")


def iqr_outliers(df: DataFrame, key: str, value: str, fence: float = 1.5,
                 accuracy: int = 100_000) -> DataFrame:
    """W4 (IQR): quartiles per key from the mergeable quantile sketch (exact for groups smaller
    than ``accuracy``), fences q1 - 1.5 IQR and q3 + 1.5 IQR, and the count of samples outside."""
    q = df.groupBy(key).agg(F.percentile_approx(value, [0.25, 0.75], accuracy).alias("_q"),
                            F.count(F.col(value)).alias("n"))
    q = q.select(key, "n", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")).withColumns({
        "lo_fence": dround(F.col("q1") - F.lit(fence) * F.col("iqr"), 4),
        "hi_fence": dround(F.col("q3") + F.lit(fence) * F.col("iqr"), 4)})
    q = materialized(q, "fences")     # a plain scan, so that Spark can split a hot key of the rows it meets
    flagged = df.select(key, value).join(q.select(key, "lo_fence", "hi_fence"), key).groupBy(key).agg(
        F.count_if((F.col(value) < F.col("lo_fence")) | (F.col(value) > F.col("hi_fence"))).alias("n_outliers"))
    return q.join(flagged, key).withColumn("iqr", dround("iqr", 4))


def scd2(snapshots: DataFrame, key: str, at: str, tracked: Sequence[str]) -> DataFrame:
    """Versions with valid_from (inclusive), valid_to (exclusive, NULL when open), is_current;
    a snapshot opens a version only when a tracked column differs (NULL-safe) from the previous
    snapshot of the key, so equal consecutive snapshots collapse.  The window is per key and a key
    has one row per snapshot, so groups are small."""
    w = Window.partitionBy(key).orderBy(at)
    cur = F.struct(*[F.col(c) for c in tracked])
    changed = ~F.coalesce(cur.eqNullSafe(F.lag(cur).over(w)), F.lit(False)) | F.lag(F.lit(1)).over(w).isNull()
    v = snapshots.withColumn("_chg", changed).filter("_chg").drop("_chg")
    w2 = Window.partitionBy(key).orderBy(at)
    return (v.withColumnRenamed(at, "valid_from")
            .withColumn("valid_to", F.lead("valid_from").over(w2.orderBy("valid_from")))
            .withColumn("is_current", F.col("valid_to").isNull())
            .withColumn("version", F.row_number().over(Window.partitionBy(key).orderBy("valid_from"))))


def point_in_time(facts: DataFrame, versions: DataFrame, key: str, ts: str) -> DataFrame:
    """Each fact with the version valid at its time: equi join on the key plus
    valid_from <= ts < valid_to (open version: valid_to NULL).  A key has few versions, so the
    range condition only filters a bounded fan-out of the equi join."""
    v = versions.withColumnRenamed(key, "_vk")
    cond = ((facts[key] == v["_vk"]) & (facts[ts] >= v["valid_from"])
            & (v["valid_to"].isNull() | (facts[ts] < v["valid_to"])))
    return facts.join(v, cond, "left").drop("_vk")


def flatline_runs(df: DataFrame, key: str, order: Sequence[str], value: str, min_len: int = 6,
                  nonzero: bool = False) -> DataFrame:
    """Runs of at least ``min_len`` equal consecutive values (islands), with ``nonzero`` only of
    readings that are neither zero nor missing (a plant at rest isn't a stuck sensor).  A run starts where the
    value differs from the previous sample's; the run id is the running count of starts; runs are
    then ordinary groups (partial aggregation, so a very long run is no hot spot)."""
    p = S.previous_row(df.select(key, *order, value), [key], list(order), [value])
    start = (F.col(f"prev_{order[0]}").isNull() | ~F.col(value).eqNullSafe(F.col(f"prev_{value}"))).cast("long")
    r = S.running_total(p.select(key, *order, value, start.alias("_start")), [key], list(order), "_start", "_run")
    runs = r.groupBy(key, "_run").agg(F.first(value).alias(value), F.min(order[0]).alias("run_start"),
                                      F.max(order[0]).alias("run_end"), F.count(F.lit(1)).alias("run_length"))
    runs = runs.filter(F.col(value) != 0) if nonzero else runs
    return runs.filter(F.col("run_length") >= min_len).drop("_run")


def energy_integral(df: DataFrame, key: str, ts: str, tiebreak: Sequence[str], mw: str,
                    gap_limit_seconds: int = 7200) -> DataFrame:
    """MWh per (key, day) by the trapezoid rule over irregular samples; an interval longer
    than the gap limit contributes nothing."""
    n = S.next_row(df.select(key, ts, *tiebreak, mw), [key], [ts, *tiebreak], [mw])
    dt_us = F.unix_micros(F.col(f"next_{ts}").cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp"))
    e = (F.col(mw) + F.col(f"next_{mw}")) / F.lit(2.0) * (dt_us / F.lit(3.6e9))
    ok = F.col(f"next_{ts}").isNotNull() & (dt_us <= F.lit(gap_limit_seconds * 1_000_000))
    i = n.filter(ok).select(key, F.to_date(ts).alias("day"), e.cast("decimal(38,9)").alias("_e"))
    return i.groupBy(key, "day").agg(dround(F.sum("_e").cast("double"), 4).alias("mwh"),
                                     F.count(F.lit(1)).alias("n_intervals"))


def asof_join(left: DataFrame, right: DataFrame, key: str, ts: str, right_ts: str,
              right_cols: Sequence[str], tolerance_seconds: int = 7200) -> DataFrame:
    """For each left row, the last right row of the same key with right_ts <= ts (equal times
    match), or NULLs when that row is older than the tolerance.

    No range join: both sides are unioned, ordered by (key, time) with right rows first on ties, and the
    last right row is carried along balanced slices of that order (``series.carried_last``), so a key
    with a third of all rows fills many slices and no task."""
    rvals = [right_ts, *right_cols]
    lstruct = F.struct(*[F.col(c) for c in left.columns])
    rstruct = F.struct(*[F.col(c) for c in rvals])
    ltype = left.select(lstruct.alias("x")).schema["x"].dataType
    rtype = right.select(rstruct.alias("x")).schema["x"].dataType
    u = (left.select(F.col(key).alias("_k"), F.col(ts).alias("_t"), F.lit(1).alias("_o"), lstruct.alias("_l"), F.lit(None).cast(rtype).alias("_r"))
         .unionByName(right.select(F.col(key).alias("_k"), F.col(right_ts).alias("_t"), F.lit(0).alias("_o"), F.lit(None).cast(ltype).alias("_l"),
                                   rstruct.alias("_r"))))
    got = S.carried_last(u, ["_k"], ["_t", "_o"], "_r", "_m").filter(F.col("_o") == 1)
    age = F.unix_micros(F.col("_t").cast("timestamp")) - F.unix_micros(F.col(f"_m.{right_ts}").cast("timestamp"))
    fresh = F.col("_k").isNotNull() & (age <= F.lit(tolerance_seconds * 1_000_000))
    return got.select("_l.*", *[F.when(fresh, F.col(f"_m.{c}")).alias(c) for c in rvals])


def calendar(series: DataFrame, key: str, ts: str, step: str = "1 hour") -> DataFrame:
    """The regular grid of each key from its first to its last sample (a per-key generator,
    not a cross join: each key's grid is exploded from its own [min, max])."""
    r = series.groupBy(key).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    return r.select(key, F.explode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL {step}"))).alias(ts))


def calendar_gaps(series: DataFrame, key: str, ts: str, step: str = "1 hour") -> DataFrame:
    """Grid points with no sample (left anti join of the grid against the samples)."""
    return calendar(series, key, ts, step).join(series.select(key, ts), [key, ts], "left_anti")


def fallback_fill(series: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """Grid rows with no sample take the mean of the same key and hour of day; ``is_imputed``
    marks them.  The means are an aggregate joined back, not a window over the key."""
    grid = calendar(series, key, ts).join(series.select(key, ts, value), [key, ts], "left")
    means = (series.groupBy(key, F.hour(ts).alias("_hod"))
             .agg((F.sum(F.col(value).cast("decimal(28,4)")).cast("double") / F.count(value)).alias("_m")))
    g = grid.withColumn("_hod", F.hour(ts)).join(means, [key, "_hod"], "left")
    return g.select(key, ts, F.coalesce(F.col(value), dround("_m", 4)).alias(value),
                    (F.col(value).isNull() & F.col("_m").isNotNull()).alias("is_imputed"))
