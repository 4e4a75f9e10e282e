"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattline.session import ensure_checkpoint_dir

#: Characters that separate words and that the contracts call white space.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared folder named by ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark)}/wattline-llm/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage is cut, executors may be lost,
    and values fixed at the time of writing (row ids, slices) stay as they are."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows and bytes of an Arrow batch at most: a Python worker holds a batch of whole texts.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def map_batches(df: DataFrame, run, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with small batches (session settings, read when the plan runs)."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and leave every other character."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def uniform(*keys: Column, seed: int) -> Column:
    """A reproducible draw in [0, 1) from the key columns (53 bits of a 64-bit hash)."""
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11)
    return h.cast("double") / F.lit(float(1 << 53))
