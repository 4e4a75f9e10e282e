"""Compaction of small files only, interrupted runs, and retention by year, month and day folders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.test_dimensions import files
from wattline.session import scratch_path
from wattline.sources import bronze as B
from wattline.sources import compaction as P


def test_plan_is_first_fit_and_leaves_large_files():
    names = [("d1", f"f{k}", size) for k, size in enumerate([100, 80, 60, 50, 30, 20, 10, 74])] + [("d2", "x", 5), ("d3", "y", 1), ("d3", "z", 1)]
    bins = P.plan(names, 100)
    size = {n: s for _, n, s in names}
    assert all(sum(size[n] for n in ns) <= 100 and len(ns) > 1 for _, ns in bins)
    assert {n for _, ns in bins for n in ns} == {"f2", "f4", "f5", "f6", "f7", "y", "z"}      # 80 and 100 are full, 50 finds no place, x is alone
    assert P.plan([], 100) == []


def table(spark, path):
    """Two directories of small files, one of them hot, and one full-sized file in each; a name with a space."""
    small = spark.range(3000).select(F.expr("CASE WHEN id < 2500 THEN 'a b' ELSE 'c%d' END").alias("p"), "id", (F.col("id") * 0.5).alias("v"))
    small.repartition(12).write.partitionBy("p").parquet(path)
    big = spark.range(10_000, 60_000).select(F.expr("CASE WHEN id % 2 = 0 THEN 'a b' ELSE 'c%d' END").alias("p"), "id", F.rand(1).alias("v"))
    big.coalesce(1).write.mode("append").partitionBy("p").parquet(path)
    return spark.read.parquet(path)


def test_compaction_keeps_full_sized_files_and_content(spark):
    path = scratch_path(spark, "t compact")
    rows = sorted(map(tuple, table(spark, path).collect()))
    before = files(path)
    large = {f: t for f, t in before.items() if len(open(f, "rb").read()) > 100_000}
    assert len(large) == 2 and len(before) > 20
    assert P.compact(spark, path, ["id"], target=8 << 10) == len(before) - 2
    spark.catalog.refreshByPath(path)
    after = files(path)
    assert {f: t for f, t in after.items() if f in before} == large and len(after) < len(before)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == rows
    assert sum("a b" in f or "a%20b" in f for f in after) > 2             # the hot directory has several new files
    again = files(path)
    assert P.compact(spark, path, ["id"], target=1 << 10) == 0 and files(path) == again


@pytest.mark.parametrize("cut", ["stage", "swap"])
def test_interrupted_compaction(spark, monkeypatch, cut):
    path = scratch_path(spark, "t_cut")
    rows = sorted(map(tuple, table(spark, path).collect()))

    def fail(spark, run):
        fs, done = P._fs(spark, f"{run}/swaps/_SUCCESS")
        if cut == "swap":                                                 # one file is in, one of those that it replaces is gone
            s = spark.read.parquet(f"{run}/swaps").orderBy("bin").first()
            at, uri = spark._jvm.org.apache.hadoop.fs.Path, spark._jvm.java.net.URI
            fs.rename(at(uri(s.new)), at(at(uri(s.dir)), s.name))
            fs.delete(at(uri(s.old[0])), False)
        else:
            fs.delete(done, False)
        raise RuntimeError("lost")
    real = P._swap
    monkeypatch.setattr(P, "_swap", fail)
    with pytest.raises(RuntimeError):
        P.compact(spark, path, target=8 << 10)
    monkeypatch.setattr(P, "_swap", real)
    P.recover(spark, path)
    spark.catalog.refreshByPath(path)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == rows and P.WORK not in "".join(files(path))


def test_bin_larger_than_a_task_is_one_sorted_file(spark, monkeypatch):
    """Rows are sorted by slices; the slices of a bin still become one file, in order."""
    path = scratch_path(spark, "t_slices")
    spark.range(20_000).select(F.expr("CASE WHEN id < 15000 THEN 'x' ELSE 'y' END").alias("p"), (F.col("id") * 7919 % 3).alias("a"), "id").repartition(
        6).write.partitionBy("p").parquet(path)
    monkeypatch.setattr(P, "SLICE", 8 << 10)
    seen, real = [], P._join_slices

    def watch(spark, stage, bins):
        rows = spark.read.parquet(stage).groupBy("_bin", F.col("_metadata.file_path")).count().collect()
        seen.extend((r["_bin"], r["count"]) for r in rows)
        real(spark, stage, bins)
    monkeypatch.setattr(P, "_join_slices", watch)
    P.compact(spark, path, ["a", "id"])
    assert len(seen) > 8 and max(n for _, n in seen) < 5_000              # no task has held a bin
    spark.catalog.refreshByPath(path)
    got = {f: [tuple(r) for r in spark.read.parquet(f).select("a", "id").coalesce(1).collect()] for f in files(path)}
    assert len(got) == 2 and all(rows == sorted(rows) for rows in got.values())
    assert sorted(i for rows in got.values() for _, i in rows) == list(range(20_000))


def test_evolved_files_compact_together(spark):
    path = scratch_path(spark, "t_evolved")
    spark.range(5).write.parquet(path)
    spark.range(5, 9).withColumn("more", F.col("id") * 2).write.mode("append").parquet(path)
    P.compact(spark, path)
    spark.catalog.refreshByPath(path)
    got = {r.id: r.more for r in spark.read.parquet(path).collect()}
    assert got == {k: None if k < 5 else 2 * k for k in range(9)} and len(files(path)) == 1


@pytest.mark.parametrize("unit,partition", [("yyyy", "year"), ("yyyy-MM", "month"), ("yyyy-MM-dd", "event_date")])
def test_retention_by_period(spark, unit, partition):
    path = scratch_path(spark, "t_retain")
    days = spark.range(0, 800, 5).select(F.expr("CAST(date_add(DATE'2022-06-01', CAST(id AS INT)) AS TIMESTAMP_NTZ)").alias("ts"))
    days.withColumn(partition, F.date_format("ts", unit)).coalesce(1).write.partitionBy(partition).parquet(path)
    rows = [r.ts for r in days.collect()]
    before = files(path)
    B.retain(spark, path, partition, "ts", "2024-03-10", 9)
    limit = dt.datetime(2023, 6, 10)
    spark.catalog.refreshByPath(path)
    assert sorted(r.ts for r in spark.read.parquet(path).collect()) == [t for t in rows if t >= limit]
    later = {f: t for f, t in before.items() if f.split(partition + "=")[1][:7] > "2023-06" and unit != "yyyy" or "2024" in f.split("=")[1][:4]}
    assert later.items() <= files(path).items()                           # later periods aren't rewritten
