"""Compaction that leaves full-sized files alone.

A plan over the file listing packs the small files of each directory into bins of about the target size (first
fit, largest first).  One Spark job reads the small files only, gives every row the bin of its file and writes the
rows in order, ``SLICE`` bytes a task.  A bin of several slices is then put together in their order, without a
sort, so that no task holds a bin: one file for each bin.  The new files are swapped in directory by directory:

1. the job writes to ``_compaction/<run>/stage`` under the table (readers skip it);
2. the list of what replaces what is written beside it; from here on the run is decided;
3. each new file moves into its directory, then the files it replaces are deleted.

A run that broke off before step 2 leaves the table as it was; after it, ``recover`` (which every run calls
first) finishes the swap.  During step 3 readers can see rows of one bin twice, so a table is compacted
between loads, by one process.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from wattline.sources.bronze import at_once

TARGET = 256 << 20
#: A file below this share of the target is small.
SMALL = 0.75
#: Bytes of the files whose rows one task sorts.
SLICE = 32 << 20
#: Files that one job reads.
FILES_A_JOB = 20_000
WORK = "_compaction"
_SWAPS = "bin int, dir string, old array<string>, new string, name string"


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def data_files(spark: SparkSession, path: str) -> list[tuple[str, str, int]]:
    """(directory, file, bytes) of a table's data files, by listing only."""
    fs, at = _fs(spark, path)
    base, out = fs.makeQualified(at).toUri().toString().rstrip("/"), []
    found = fs.listFiles(at, True)
    while found.hasNext():
        f = found.next()
        uri = f.getPath().toUri().toString()
        if not any(p[:1] in ("_", ".") for p in uri[len(base) + 1:].split("/")):
            out.append((uri.rsplit("/", 1)[0], uri, f.getLen()))
    return sorted(out)


def plan(files: Sequence[tuple[str, str, int]], target: int = TARGET) -> list[tuple[str, list[str]]]:
    """(directory, files) of each bin: small files of one directory, together at most ``target`` bytes, two at least."""
    small: dict[str, list[tuple[int, str]]] = {}
    for where, name, size in files:
        if size < SMALL * target:
            small.setdefault(where, []).append((size, name))
    out = []
    for where in sorted(small):
        bins: list[tuple[int, list[str]]] = []
        for size, name in sorted(small[where], key=lambda f: (-f[0], f[1])):
            for k, (held, names) in enumerate(bins):
                if held + size <= target:
                    bins[k] = (held + size, names + [name])
                    break
            else:
                bins.append((size, [name]))
        out += [(where, names) for _, names in bins if len(names) > 1]
    return out


def recover(spark: SparkSession, path: str) -> None:
    """Finish or drop runs that broke off."""
    fs, work = _fs(spark, f"{path}/{WORK}")
    if not fs.exists(work):
        return
    for run in fs.listStatus(work):
        here = run.getPath().toString()
        if fs.exists(_fs(spark, f"{here}/swaps/_SUCCESS")[1]):
            _swap(spark, here)
        fs.delete(run.getPath(), True)
    fs.delete(work, True)


def _swap(spark: SparkSession, run: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    uri = spark._jvm.java.net.URI
    fs, _ = _fs(spark, run)
    for s in spark.read.schema(_SWAPS).parquet(f"{run}/swaps").orderBy("bin").collect():       # a row for each new file
        new, there = path(uri(s.new)), path(path(uri(s.dir)), s.name)
        if fs.exists(new):
            fs.rename(new, there)
        for old in s.old:
            fs.delete(path(uri(old)), False)


def compact(spark: SparkSession, path: str, order: Sequence[str] = (), target: int = TARGET) -> int:
    """Compact the table at ``path`` in place; returns the number of files that were replaced.

    Rows of a bin are sorted by ``order``.  Full-sized files keep their names and times."""
    recover(spark, path)
    found = data_files(spark, path)
    sizes = {name: size for _, name, size in found}
    bins, replaced = plan(found, target), 0
    while bins:
        take, files = 0, 0
        while take < len(bins) and (not take or files + len(bins[take][1]) <= FILES_A_JOB):
            files += len(bins[take][1])
            take += 1
        _rewrite(spark, path, bins[:take], order, sum(sizes[n] for _, ns in bins[:take] for n in ns))
        replaced, bins = replaced + files, bins[take:]
    return replaced


def _rewrite(spark: SparkSession, path: str, bins: list[tuple[str, list[str]]], order: Sequence[str], size: int) -> None:
    run = f"{path}/{WORK}/{uuid.uuid4().hex[:12]}"
    stage = f"{run}/stage"
    names = [n for _, ns in bins for n in ns]
    # a listing and a scan may write the root of the same file with one slash or three
    of = spark.createDataFrame([(re.sub("^([^:/]+):/+", r"\1:/", n), k) for k, (_, ns) in enumerate(bins) for n in ns], "_file string, _bin int").withColumn("_part", F.hash("_file"))
    rows = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(*[_plain(spark, n) for n in names])
    tagged = rows.withColumn("_file", F.regexp_replace(F.col("_metadata.file_path"), "^([^:/]+):/+", "$1:/")).withColumn("_at", F.col("_metadata.row_index")).join(F.broadcast(of), "_file").drop("_file")   # FILES_A_JOB rows
    # file and row make the order one without equals: a frequent value is no large slice
    by = ["_bin", *order, "_part", "_at"]
    (tagged.repartitionByRange(max(1, -(-size // SLICE)), *by).sortWithinPartitions(*by).drop("_part", "_at")
     .write.partitionBy("_bin").parquet(stage))
    _join_slices(spark, stage, len(bins))
    if spark.read.parquet(stage).count() != rows.count():           # both from the files' footers
        raise RuntimeError(f"compaction of {path} lost rows; its files are as they were")
    fs, _ = _fs(spark, stage)
    swaps = []
    for k, (where, old) in enumerate(bins):
        for i, f in enumerate(fs.listStatus(_fs(spark, f"{stage}/_bin={k}")[1])):
            name = f.getPath().getName()
            swaps.append((k, where, old if i == 0 else [], f.getPath().toUri().toString(), f"compact-{k:05d}-{name}"))
    spark.createDataFrame(swaps, _SWAPS).coalesce(1).write.parquet(f"{run}/swaps")
    _swap(spark, run)
    fs.delete(_fs(spark, run)[1], True)
    _drop_empty(spark, path)


def _join_slices(spark: SparkSession, stage: str, bins: int) -> None:
    """One file for each bin: the slices of a bin are read one after the other by one task."""
    def join(k: int, slices: list[str]) -> None:
        whole = spark.read.parquet(slices[0]).coalesce(1)
        for s in slices[1:]:
            whole = whole.union(spark.read.schema(whole.schema).parquet(s).coalesce(1))
        whole.coalesce(1).write.parquet(f"{stage}/_whole/{k}")
        fs, at = _fs(spark, f"{stage}/_bin={k}")
        made = [f.getPath() for f in fs.listStatus(_fs(spark, f"{stage}/_whole/{k}")[1]) if f.getPath().getName().endswith(".parquet")]
        fs.delete(at, True)
        fs.mkdirs(at)
        for f in made:
            fs.rename(f, _fs(spark, f"{at}/{f.getName()}")[1])
    joins = []
    for k in range(bins):
        fs, at = _fs(spark, f"{stage}/_bin={k}")
        slices = sorted(f.getPath().toString() for f in fs.listStatus(at))        # named by task: in the order of the slices
        if len(slices) > 1:
            joins.append(lambda k=k, slices=slices: join(k, slices))
    if joins:
        at_once(spark, joins, max(1, spark.sparkContext.defaultParallelism))


def _plain(spark: SparkSession, uri: str) -> str:
    """The path that a reader takes for a listed URI (which is encoded)."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def _drop_empty(spark: SparkSession, path: str) -> None:
    fs, work = _fs(spark, f"{path}/{WORK}")
    if fs.exists(work) and not fs.listStatus(work):
        fs.delete(work, False)

