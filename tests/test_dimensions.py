"""Dimensions loaded snapshot by snapshot: any order of loads gives the versions of all of them, keys stay."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from wattline.operators import dimensions as D
from wattline.session import scratch_path


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def plain_versions(snapshots):
    """{(key, from): (values, to)} of all snapshots ({day: {key: values}}) in order."""
    out = {}
    for key in {k for s in snapshots.values() for k in s}:
        points = [(n, s[key]) for n, s in sorted(snapshots.items()) if key in s]
        kept = [p for i, p in enumerate(points) if i == 0 or p[1] != points[i - 1][1]]
        for (n, v), after in zip(kept, [*kept[1:], None]):
            out[key, day(n)] = (v, day(after[0]) if after else None)
    return out


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


@pytest.mark.parametrize("seed", range(3))
def test_loads_in_any_order(spark, seed):
    r = random.Random(seed)
    days = [0, 3, 5, 9, 20]
    snapshots = {n: {k: (r.choice("ab"), r.choice([1, None])) for k in range(12)} for n in days}
    snapshots[days[-1]][99] = ("new", 1)
    order = days[:]
    r.shuffle(order)
    path, given, merged = scratch_path(spark, "t_dim"), {}, {}
    for n in [*order, order[1]]:                       # the last load comes a second time
        merged[n] = snapshots[n]
        df = spark.createDataFrame([(k, *v) for k, v in snapshots[n].items()], "id long, grade string, size int")
        D.load_snapshot(spark, path, df, "id", ["grade", "size"], day(n), "id_key", buckets=4)
        rows = D.versions(spark, path).collect()
        assert {(x.id, x.valid_from): ((x.grade, x.size), x.valid_to) for x in rows} == plain_versions(merged)
        assert len({x.id_key for x in rows}) == len(rows) and all(x.is_current == (x.valid_to is None) for x in rows)
        now = {(x.id, x.valid_from): x.id_key for x in rows}
        assert all(given[k] == v for k, v in now.items() if k in given)
        assert all(v > max(given.values(), default=0) for k, v in now.items() if k not in given)
        given |= now


def test_only_touched_buckets_are_written(spark):
    path = scratch_path(spark, "t_dim_files")
    base = spark.range(200).select("id", F.lit("a").alias("grade"))
    D.load_snapshot(spark, path, base, "id", ["grade"], day(0), "id_key", buckets=16)
    before = files(f"{path}/versions")
    D.load_snapshot(spark, path, base, "id", ["grade"], day(1), "id_key", buckets=16)
    assert files(f"{path}/versions") == before                       # nothing has changed
    one = base.withColumn("grade", F.when(F.col("id") == 7, "b").otherwise(F.col("grade")))
    D.load_snapshot(spark, path, one, "id", ["grade"], day(2), "id_key", buckets=16)
    after = files(f"{path}/versions")
    touched = spark.range(7, 8).select(D.bucket("id", 16)).first()[0]
    assert {f for f, t in before.items() if after.get(f) != t} == {f for f in before if f"bucket={touched}/" in f}
    assert D.versions(spark, path).count() == 201


def test_keys_go_on_from_the_maximum(spark):
    path = scratch_path(spark, "t_keys")
    first = D.stable_keys(spark, path, spark.createDataFrame([("b",), ("d",), ("b",)], "n string"), ["n"], "k")
    assert sorted((r.n, r.k) for r in first.collect()) == [("b", 1), ("b", 1), ("d", 2)]
    second = D.stable_keys(spark, path, spark.createDataFrame([("c",), ("d",), ("a",)], "n string"), ["n"], "k")
    assert sorted((r.n, r.k) for r in second.collect()) == [("a", 3), ("c", 4), ("d", 2)]
    assert D.stable_keys(spark, path, spark.createDataFrame([], "n string"), ["n"], "k").count() == 0
