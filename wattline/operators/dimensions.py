"""Dimensions that grow load by load (W5, D1, D2, D4, P15): snapshots are merged into stored versions, and
surrogate keys go on from the stored maximum, so a key that was given out never changes.

A dimension stands under one folder: ``versions`` (partitioned by a hash bucket of the natural key; a load
rewrites only the buckets that it changes), ``loads`` (the snapshot times merged so far, one row each) and
``keys`` (natural key to surrogate key, append only).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.operators.derive import dense_sequence
from wattline.operators.silver import scd2
from wattline.session import materialized
from wattline.sources.bronze import exists

BUCKETS = 64


def bucket(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def merged_versions(stored: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str], at: dt.datetime,
                    next_load: dt.datetime | None) -> DataFrame:
    """The versions of the keys that a snapshot taken at ``at`` changes; other keys are not in the result.

    ``stored`` has (key, tracked..., valid_from, valid_to); a snapshot is complete, and a key that it lacks
    counts as unchanged.  A newer snapshot expires versions and opens others; a late one splits the version
    that it falls into: what it says holds until ``next_load``, the next snapshot that was merged before, and
    what that one said goes on from there.  A second snapshot of the same time replaces the first.  The
    result is what all snapshots together would give in order of time."""
    time = F.lit(at).cast("timestamp_ntz")
    seen = snapshot.select(key, F.struct(*tracked).alias("_new"))
    valid = stored.filter((F.col("valid_from") <= time) & (F.col("valid_to").isNull() | (F.col("valid_to") > time)))
    before = valid.select(F.col(key).alias("_k"), F.struct(*tracked).alias("_old"))
    # of the keys that the snapshot changes: what held at the start of each version, at the next load, and now
    changed = seen.join(before, F.col(key).eqNullSafe(F.col("_k")), "left").filter(
        F.col("_old").isNull() | ~F.col("_new").eqNullSafe(F.col("_old")))
    changed = materialized(changed.select(key, "_new"), "changed-keys")
    old = stored.join(changed.select(key), key, "left_semi")
    points = old.filter(F.col("valid_from") != time).select(key, *tracked, F.col("valid_from").alias("_at"))
    if next_load is not None:
        after = F.lit(next_load).cast("timestamp_ntz")
        points = points.unionByName(old.filter((F.col("valid_from") < after) & (F.col("valid_to").isNull() | (F.col("valid_to") > after)))
                                    .select(key, *tracked, after.alias("_at")))
    points = points.unionByName(changed.select(key, "_new.*", time.alias("_at")))
    return scd2(points, key, "_at", tracked)


def stable_keys(spark: SparkSession, path: str, rows: DataFrame, natural: Sequence[str], name: str) -> DataFrame:
    """``rows`` with their surrogate key.  Natural keys that the table at ``path`` knows keep theirs;
    new ones are numbered from the stored maximum, in natural order, and appended to it.  Natural keys are
    not null; a repeated one gets one key."""
    known = spark.read.parquet(path) if exists(spark, path) else None
    new = rows.select(*natural).distinct()
    top = 0
    if known is not None:
        new = new.join(known.select(*natural), list(natural), "left_anti")
        top = known.agg(F.max(name)).first()[0] or 0
    numbered = dense_sequence(new, list(natural), "_seq").select(*natural, (F.col("_seq") + top).alias(name))
    numbered.write.mode("append").parquet(path)
    return rows.join(spark.read.parquet(path), list(natural))


def load_snapshot(spark: SparkSession, path: str, snapshot: DataFrame, key: str, tracked: Sequence[str], at: dt.datetime,
                  surrogate: str, buckets: int = BUCKETS) -> None:
    """Merge one snapshot into the dimension at ``path``.  Only buckets with a changed key are written
    (staged, then dynamic partition overwrite); a load that changes nothing writes nothing but its time."""
    versions, loads = f"{path}/versions", f"{path}/loads"
    times = [r.at for r in spark.read.parquet(loads).distinct().collect()] if exists(spark, loads) else []   # one row a load
    cols = [key, *tracked, "valid_from", "valid_to", "is_current", "version"]
    if exists(spark, versions):
        stored = spark.read.parquet(versions)
    else:
        stored = spark.createDataFrame([], scd2(snapshot.withColumn("_at", F.lit(at).cast("timestamp_ntz")), key, "_at", tracked)
                                       .select(*cols).schema).withColumns({surrogate: F.lit(0).cast("long"), "bucket": F.lit(0)})
    later = min((t for t in times if t > at), default=None)
    fresh = materialized(merged_versions(stored, snapshot, key, tracked, at, later).select(*cols), "fresh-versions")
    if fresh.take(1):
        keyed = stable_keys(spark, f"{path}/keys", fresh, [key, "valid_from"], surrogate).withColumn("bucket", bucket(key, buckets))
        touched = keyed.select("bucket").distinct()                                 # ``buckets`` rows at most
        rest = (stored.join(F.broadcast(touched), "bucket", "left_semi")
                .join(fresh.select(key).distinct(), key, "left_anti"))
        out = materialized(rest.select(*keyed.columns).unionByName(keyed), "versions")
        # one sorted range of keys for each task: a bucket is split when it is large
        (out.repartitionByRange("bucket", key).sortWithinPartitions("bucket", key, "valid_from")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(versions))
    spark.createDataFrame([(at,)], "at timestamp_ntz").coalesce(1).write.mode("append").parquet(loads)


def versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/versions").drop("bucket")
