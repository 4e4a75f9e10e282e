"""Projections and derived columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.functions.columns import carbon_offset, dround, hash_uniform
from wattline.session import materialized


def dispatch_measures(df: DataFrame, sources: Sequence[str], demand: str, ppa: Column,
                      curtail_share: float = 0.3, carbon_factor: float = 0.42) -> DataFrame:
    """P7-P12 on a row holding per-source generation and demand:

    total = round(sum of sources, 1); balance = total - demand; curtailment = max(0, 0.3 balance);
    spot = ppa x demand / total (total <= 0 -> divisor 1); revenue = total x ppa;
    curtailment cost = curtailment x ppa; carbon = total x factor."""
    total = dround(sum((F.coalesce(F.col(s), F.lit(0.0)) for s in sources), F.lit(0.0)), 1)
    out = df.withColumns({"ppa_price": ppa, "total_generation_mw": total})
    bal = F.col("total_generation_mw") - F.col(demand)
    out = out.withColumn("balance_mw", dround(bal, 1))
    gen = F.col("total_generation_mw")
    return out.withColumns({
        "curtailment_mw": dround(F.greatest(F.lit(0.0), F.col("balance_mw") * F.lit(curtail_share)), 1),
        "spot_price": dround(F.col("ppa_price") * F.col(demand) / F.when(gen > 0, gen).otherwise(F.lit(1.0)), 2),
        "revenue": dround(gen * F.col("ppa_price"), 2),
        "carbon_offset_tco2e": dround(carbon_offset(gen, carbon_factor), 2),
    }).withColumn("curtailment_cost", dround(F.col("curtailment_mw") * F.col("ppa_price"), 2))


def unpivot_sources(wide: DataFrame, ids: Sequence[str], values: Sequence[str],
                    name: str = "source_type", value: str = "capacity_mw") -> DataFrame:
    """P13 + F2: wide per-source columns -> (source, value) rows; zero and NULL values dropped."""
    long = wide.unpivot(list(ids), list(values), name, value)
    return long.filter(F.col(value).isNotNull() & (F.col(value) != 0))


def split_units(df: DataFrame, cap: str = "capacity_mw", unit_mw: int = 100) -> DataFrame:
    """One row per unit; n = max(1, floor(cap / 100)), unit capacity = round(cap / n, 1)."""
    n = F.greatest(F.lit(1), F.floor(F.col(cap) / F.lit(unit_mw)).cast("int"))
    return (df.withColumn("n_units", n)
            .withColumn("unit_no", F.explode(F.sequence(F.lit(1), F.col("n_units"))))
            .withColumn("unit_capacity_mw", dround(F.col(cap) / F.col("n_units"), 1)))


def _sliced(df: DataFrame, order: Sequence[str], partitions: int | None) -> DataFrame:
    """``df`` range-partitioned on ``order`` with its slice number ``_pid``, written once to the
    shared folder.  Range bounds are sampled anew whenever the plan is run, so slices are only
    comparable between two uses once they stand in the data."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id())
    return materialized(ranged, "slices")


def dense_sequence(df: DataFrame, order: Sequence[str], name: str = "seq",
                   partitions: int | None = None) -> DataFrame:
    """1-based position of each row in ``order`` (keys must be unique), without a global window.

    Slice k (see ``_sliced``) holds the k-th range of the order.  Prefix sums of the row counts per
    slice (one row per slice, broadcast) give each slice's offset; a window inside the slice gives
    the place in it."""
    tagged = _sliced(df, order, partitions)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_pid").orderBy(*order)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + F.row_number().over(inside))
            .drop("_pid", "_off"))


def sequence_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "seq",
                    partitions: int | None = None) -> DataFrame:
    """0-based position of each row among the rows of its ``keys``, in ``order`` (unique with the keys),
    without a window over a key: slices of the order of all rows (see ``_sliced``), the key's rows in earlier
    slices, and a window inside key and slice."""
    tagged = _sliced(df, [*keys, *order], partitions)
    counts = tagged.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", *keys, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_pid", *keys).orderBy(*order)
    return (tagged.join(offsets, ["_pid", *keys])
            .withColumn(name, F.col("_off") + F.row_number().over(inside) - 1)
            .drop("_pid", "_off"))


def surrogate_ids(df: DataFrame, order: Sequence[str], prefix: str = "PLT", width: int = 4,
                  name: str = "plant_code") -> DataFrame:
    """``PLT-0001`` style ids in running order of ``order``."""
    s = dense_sequence(df, order, "_seq")
    return s.withColumn(name, F.format_string(f"{prefix}-%0{width}d", F.col("_seq"))).drop("_seq")


def currency_columns(df: DataFrame, amount: str, dataset: str, currency_of: Mapping[str, str],
                     currencies: Sequence[str] = ("usd", "gil")) -> DataFrame:
    """The raw amount plus one column per currency, filled only for that currency's datasets,
    so amounts in different currencies never meet in one column."""
    m = F.create_map(*[x for k, v in currency_of.items() for x in (F.lit(k), F.lit(v))])
    cur = F.element_at(m, F.col(dataset))
    return df.withColumn("currency", cur).withColumns(
        {f"{amount}_{c}": F.when(F.col("currency") == c, F.col(amount)) for c in currencies})


def utc_normalize(df: DataFrame, ts: str, tz: Column, name: str = "ts_utc") -> DataFrame:
    """Local wall-clock time in zone ``tz`` -> UTC, as TIMESTAMP_NTZ."""
    return df.withColumn(name, F.to_utc_timestamp(F.col(ts).cast("timestamp"), tz).cast("timestamp_ntz"))


def derive_scenario(base: DataFrame, mapping: DataFrame, key: str, caps: Sequence[str]) -> DataFrame:
    """Derived node set, driven by a mapping table (``key``, ff_id, ``overrides`` map of capacity by
    source, jitter_lo, jitter_hi, add_tidal).  Each capacity = the node's override (default 0) x a
    jitter within the node's bounds, drawn from (derived id, source) by hash; the added source
    x [0.8, 1.2]; demand x [0.85, 1.15]; peak x [0.9, 1.1], 2 decimals."""
    k = F.col("ff_id")
    out = base.join(mapping, key)
    for c in caps:
        draw = hash_uniform(k, c, F.col("jitter_lo"), F.col("jitter_hi"))
        mw = F.coalesce(F.try_element_at("overrides", F.lit(c)), F.lit(0.0))
        out = out.withColumn(f"ff_{c}", dround(mw * draw, 0).cast("long"))
    return (out.withColumn("ff_tidal", dround(F.col("add_tidal") * hash_uniform(k, "tidal", 0.8, 1.2), 0).cast("long"))
            .withColumn("ff_demand", dround(F.col("base_demand") * hash_uniform(k, "demand", 0.85, 1.15), 0).cast("long"))
            .withColumn("ff_peak_mult", dround(F.col("peak_mult") * hash_uniform(k, "peak", 0.9, 1.1), 2)))


def anonymize(df: DataFrame, id_col: str, salt: str, name_col: str | None = None,
              coarse: Mapping[str, int] | None = None) -> DataFrame:
    """Keyed hash of the id (equal ids stay equal, so joins still hold), names masked and
    numeric columns coarsened to the given number of digits."""
    out = df.withColumn(id_col, F.sha2(F.concat(F.lit(salt), F.col(id_col).cast("string")), 256))
    if name_col:
        out = out.withColumn(name_col, F.concat(F.substring(F.col(name_col), 1, 3), F.lit("***")))
    for c, digits in (coarse or {}).items():
        out = out.withColumn(c, F.round(F.col(c), digits))
    return out


def explode_nested(stories: DataFrame, tasks: str = "tasks", owner: str = "owner",
                   state: str = "state", default_state: str = "backlog") -> DataFrame:
    """P25: one row per nested task; owner text 'a, b' split into trimmed non-empty labels, missing
    state -> default."""
    flat = stories.select("*", F.inline(F.col(tasks))).drop(tasks)
    labels = F.filter(F.transform(F.split(F.col(owner), ","), lambda x: F.trim(x)), lambda x: x != "")
    return flat.withColumn("labels", labels).withColumn(state, F.coalesce(F.col(state), F.lit(default_state)))


def running_total(df: DataFrame, order: Sequence[str], weight: str, name: str,
                  partitions: int | None = None) -> DataFrame:
    """Running sum of ``weight`` in the order of ``order`` (keys must be unique), without a global
    window: a window per slice (see ``_sliced``) gives the sum inside it, and prefix sums of the
    totals per slice (one row per slice, broadcast) add what the earlier ranges hold.  Unique keys
    keep the ranges balanced."""
    tagged = _sliced(df, order, partitions)
    totals = tagged.groupBy("_pid").agg(F.sum(weight).alias("_t"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + F.sum(weight).over(inside))
            .drop("_pid", "_off"))


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """Exact discrete quantiles (the value at 1-based rank ceil(p x n) of the sorted non-NULL
    values, the SQL ``percentile_disc`` rule) as one row with columns q0, q1, ...

    Distributed and skew-safe: rows are first counted per distinct value (a hash aggregate with a
    map-side partial step, so a value held by a third of all rows becomes one row before any
    shuffle); a running total of those counts in value order (``running_total``, balanced range
    partitions over unique values) gives each value's rank interval, and the value whose interval
    holds a wanted rank is picked.  n is a scalar subquery over the counts.  ``percentile_approx`` is the
    cheaper choice when a rank error of n / accuracy is acceptable."""
    v = df.select(F.col(col).alias("_v")).filter(F.col("_v").isNotNull())
    counts = v.groupBy("_v").agg(F.count(F.lit(1)).alias("_c"))
    n = counts.select(F.coalesce(F.sum("_c"), F.lit(0))).scalar()
    cum = running_total(counts, ["_v"], "_c", "_cum")
    targets = [F.greatest(F.lit(1), F.ceil(F.lit(p) * n)) for p in probs]

    def holds(t: Column) -> Column:
        return (F.col("_cum") - F.col("_c") < t) & (F.col("_cum") >= t)
    wanted = None
    for t in targets:
        wanted = holds(t) if wanted is None else (wanted | holds(t))
    picked = cum.filter(wanted)
    return picked.agg(*[F.max(F.when(holds(t), F.col("_v"))).alias(f"q{i}")
                        for i, t in enumerate(targets)])
