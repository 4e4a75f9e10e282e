"""Joins (J1-J3, J7-J12, L1) and the size-checked broadcast they use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Bytes (as JSON text) up to which a side is broadcast.
BROADCAST_BYTES = 32 << 20


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000_000, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only behind a proven bound: a job looks at ``max_rows + 1`` rows at most (the
    limit stops the scan early) and adds up their size.  Beyond ``max_rows`` rows or ``max_bytes`` bytes the
    frame is returned as is and the planner keeps a shuffle join (AQE may still broadcast it from
    runtime statistics)."""
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    n, held = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and held <= max_bytes else df


def through_days(fact: DataFrame, days: DataFrame, partition: str, day: str) -> DataFrame:
    """The rows of a fact stored by day whose day is in ``days`` (a filtered calendar; broadcast if it is small).

    The calendar's filter runs first and its days become the partition filter of the fact's scan (dynamic
    partition pruning), so directories of other days are never opened.  Its first and last day are
    looked up beforehand: Spark prunes by a side only if that has a comparison in its filter, and
    the bounds narrow the listing as well."""
    kept = days.select(F.col(day).alias("_day")).filter(F.col("_day").isNotNull()).distinct()
    n, lo, hi = kept.agg(F.count(F.lit(1)), F.min("_day"), F.max("_day")).first()
    if not n:
        return fact.limit(0)
    kept = kept.filter(F.col("_day").between(F.lit(lo), F.lit(hi)))
    kept = F.broadcast(kept) if n <= 100_000 else kept
    return fact.filter(F.col(partition).between(F.lit(lo), F.lit(hi))).join(kept, F.col(partition) == F.col("_day"), "left_semi")


def full_outer(a: DataFrame, b: DataFrame, keys: Sequence[str], tag: str = "match") -> DataFrame:
    """Full outer equi join on keys, with which side(s) each key came from."""
    ma, mb = "_in_a", "_in_b"
    j = a.withColumn(ma, F.lit(True)).join(b.withColumn(mb, F.lit(True)), list(keys), "full")
    return j.withColumn(tag, F.when(F.col(ma) & F.col(mb), "both").when(F.col(ma).isNotNull(), "left_only")
                        .otherwise("right_only")).drop(ma, mb)


def strict_pairing(base: DataFrame, mapping: DataFrame, derived: DataFrame, base_key: str, map_base: str,
                   map_derived: str, derived_key: str) -> DataFrame:
    """Base -> mapping -> derived through two inner equi joins.  Strict: a base row with no
    mapping, or a mapping with no derived row, is an error (checked with anti joins first)."""
    missing_map = base.join(mapping, base[base_key] == mapping[map_base], "left_anti").count()
    used = mapping.join(base, mapping[map_base] == base[base_key], "left_semi")
    missing_derived = used.join(derived, used[map_derived] == derived[derived_key], "left_anti").count()
    if missing_map or missing_derived:
        raise ValueError(f"mapping not 1-1: {missing_map} base rows unmapped, {missing_derived} mapped ids missing")
    j = base.join(mapping, base[base_key] == mapping[map_base])
    return j.join(derived, j[map_derived] == derived[derived_key])


def anti(a: DataFrame, b: DataFrame, on: Column | Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key is absent from ``b`` (left anti)."""
    return a.join(b, on, "left_anti")


def coverage(registry: DataFrame, facts: DataFrame, key: str, fact_key: str) -> DataFrame:
    """Each registry key with ``is_covered`` (a left semi join's complement, computed with one
    left join against the distinct fact keys)."""
    seen = facts.select(F.col(fact_key).alias("_fk")).distinct().withColumn("_seen", F.lit(True))
    j = registry.join(seen, registry[key] == seen["_fk"], "left")
    return j.select(*registry.columns, F.coalesce(F.col("_seen"), F.lit(False)).alias("is_covered"))


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Union target and source, keep per key the row with the greatest ``order`` tuple
    (``max(struct)`` aggregate: partial aggregation, no per-key window); a re-run with the same
    source gives the same result."""
    u = target.unionByName(source)
    rest = [c for c in u.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in list(order) + rest])
    return u.groupBy(*keys).agg(F.max(packed).alias("_w")).select(*keys, "_w.*")


def reconcile(desired: DataFrame, current: DataFrame, key: str, cols: Sequence[str],
              set_cols: Sequence[str] = ()) -> DataFrame:
    """Desired vs current by key -> created / updated / unchanged / orphan, with the list of
    differing columns.  Array columns in ``set_cols`` compare as sets (order and repeats ignored)."""
    def norm(df: DataFrame, side: str) -> DataFrame:
        out = [F.col(key)]
        for c in cols:
            v = F.array_sort(F.array_distinct(F.col(c))) if c in set_cols else F.col(c)
            out.append(v.alias(f"{side}_{c}"))
        return df.select(*out, F.lit(True).alias(f"{side}_present"))

    j = norm(desired, "d").join(norm(current, "c"), key, "full")
    diffs = F.filter(F.array(*[F.when(~F.col(f"d_{c}").eqNullSafe(F.col(f"c_{c}")), F.lit(c)) for c in cols]),
                     lambda x: x.isNotNull())
    outcome = (F.when(F.col("c_present").isNull(), "created").when(F.col("d_present").isNull(), "orphan")
               .when(F.size(diffs) > 0, "updated").otherwise("unchanged"))
    return j.select(key, outcome.alias("outcome"),
                    F.when(F.col("d_present") & F.col("c_present"), diffs)
                    .otherwise(F.array().cast("array<string>")).alias("changed_columns"))


def prefix_lookup(declared: DataFrame, lists: DataFrame, name: str = "declared_name",
                  list_name: str = "list_name", position: str = "position", width: int = 4) -> DataFrame:
    """L1: exact case-insensitive match; else the first list (lowest position) whose trimmed
    lower-case name shares the first ``width`` characters; else an error row.

    The list side is first reduced to one winner per lower-case name and one per prefix
    (``min_by`` aggregates), so every declared row joins to at most one row of each: no pairs are
    formed inside a shared prefix, however many names share it."""
    lo = F.lower(F.col(list_name))
    by_name = lists.groupBy(lo.alias("_k")).agg(F.min_by(list_name, position).alias("_exact"))
    by_prefix = (lists.select(list_name, position, F.substring(F.trim(lo), 1, width).alias("_k"))
                 .groupBy("_k").agg(F.min_by(list_name, position).alias("_prefix")))
    d = declared.select(F.col(name), F.lower(F.col(name)).alias("_d"),
                        F.substring(F.trim(F.lower(F.col(name))), 1, width).alias("_dp"))
    j = (d.join(by_name, d["_d"] == by_name["_k"], "left").drop("_k")
         .join(by_prefix, (d["_dp"] == by_prefix["_k"]) & (d["_dp"] != ""), "left").drop("_k"))
    return j.select(name, F.coalesce("_exact", "_prefix").alias(list_name),
                    F.when(F.col("_exact").isNotNull(), "exact").when(F.col("_prefix").isNotNull(), "prefix")
                    .otherwise("error").alias("match_kind"))
