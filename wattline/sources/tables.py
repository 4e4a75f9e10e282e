"""Scans of the driver's Parquet tables and the energy views bound to them.

The energy tables do not exist in the driver's data, so each view renames and derives columns of a
driver table.  Every view is a lazy projection over a Parquet scan: Catalyst prunes the columns a
query does not use and pushes its filters into the scan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.session import ensure_checkpoint_dir

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def money(c: str | Column) -> Column:
    """Amounts with two decimals are summed as DECIMAL so totals do not depend on row order."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> sensor samples: (ts, node_id, source_type, mw, raw, msg_offset)."""
    ev = scan(spark, sf_dir, "events")
    return ev.select(
        F.col("ts"),
        F.col("user_id").alias("node_id"),
        F.col("event_type").alias("source_type"),
        F.col("value").alias("mw"),
        F.col("props").alias("raw"),
        F.col("event_id").alias("msg_offset"),
    )


def generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> metered generation facts, one row per (gen_order, gen_line)."""
    li = scan(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("gen_order"),
        F.col("l_linenumber").alias("gen_line"),
        F.col("l_suppkey").alias("plant_id"),
        F.col("l_partkey").alias("asset_id"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_quantity").alias("mwh"),
        F.col("l_extendedprice").alias("revenue"),
        (F.col("l_quantity") * F.col("l_discount")).alias("curtailed"),
        F.col("l_discount").alias("curtail_rate"),
        F.col("l_tax").alias("spot_adj"),
        F.col("l_linestatus").alias("status"),
        F.col("l_returnflag").alias("flag"),
    )


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation ⋈ region -> grid nodes (25 rows by the TPC-H definition, so a bounded broadcast)."""
    n = scan(spark, sf_dir, "nation")
    r = scan(spark, sf_dir, "region")
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("node_id"),
        F.col("n_name").alias("node_name"),
        F.col("r_name").alias("region"),
    )


#: Size on disk up to which the plant table is broadcast (a few times that in memory).
PLANT_BROADCAST_BYTES = 16 << 20


def files_of(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, modification time) of the files at or directly under ``path``, by listing only."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    return sorted((str(f.getPath()), f.getLen(), f.getModificationTime()) for f in listed if f.isFile())


#: Version of what is derived; raised when the meaning of a derived table changes, so older ones aren't read.
DERIVED = 4


def derived(spark: SparkSession, source: str, name: str, write: Callable[[str], None], end: str = "_SUCCESS") -> str:
    """Folder of what is derived from the files at ``source``: named after their state, made by
    ``write`` unless a finished one (which has the file ``end``) is there."""
    state = hashlib.sha256(repr((DERIVED, files_of(spark, source))).encode()).hexdigest()[:16]
    path = f"{ensure_checkpoint_dir(spark)}/wattline/{name}-{state}"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{end}")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        write(path)
    return path


def plants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier ⋈ nodes -> plants.  The node side is bounded (25 rows) and broadcast.  The plant
    side grows with the data: it carries a broadcast hint only while its files are under
    ``PLANT_BROADCAST_BYTES``, so a fact table joined to it is never chosen as the broadcast side
    from a small file-size estimate; above the bound the join stays a shuffle join (AQE splits
    skewed partitions)."""
    s = scan(spark, sf_dir, "supplier")
    out = s.join(F.broadcast(nodes(spark, sf_dir)), s.s_nationkey == F.col("node_id")).select(
        F.col("s_suppkey").alias("plant_id"),
        F.col("s_name").alias("plant_name"),
        F.col("node_id"),
        F.col("node_name"),
        F.col("region"),
        F.greatest(F.abs(F.col("s_acctbal")), F.lit(1.0)).alias("capacity_mw"),
        F.col("s_acctbal").alias("acctbal"),
    )
    size = sum(f[1] for f in files_of(spark, f"{sf_dir.rstrip('/')}/supplier.parquet"))
    return F.broadcast(out) if size <= PLANT_BROADCAST_BYTES else out


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders ⋈ customer -> demand readings per node, tagged with a dataset (market segment)."""
    o = scan(spark, sf_dir, "orders")
    c = scan(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("reading_id"),
        F.col("c_nationkey").alias("node_id"),
        F.col("o_orderdate").alias("ts"),
        (F.col("o_totalprice") / 1000).alias("demand_mw"),
        F.col("c_mktsegment").alias("dataset"),
        F.col("o_orderstatus").alias("status"),
    )


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part -> asset registry (asset_id, asset_name, make, model, size_class, list_price)."""
    p = scan(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("asset_id"),
        F.col("p_name").alias("asset_name"),
        F.col("p_brand").alias("make"),
        F.col("p_type").alias("model"),
        F.col("p_size").alias("size_class"),
        F.col("p_retailprice").alias("list_price"),
    )
