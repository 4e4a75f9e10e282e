"""Operational tables (A13-A15, A19, A21, D1-D5): incidents, catalog, snapshots, dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.operators import series as S
from wattline.operators.derive import dense_sequence, sequence_within

INCIDENT_PREFIX = "[INCIDENT]"
ASSET_PREFIX = "[ASSET]"


def incident_title(severity: Column, title: Column) -> Column:
    return F.concat(F.lit(INCIDENT_PREFIX + " ["), severity, F.lit("] "), title)


def incident_episodes(log: DataFrame) -> DataFrame:
    """Each log row with its incident ``episode``: the number of closes of the same full
    title before it.  A close ends an episode, so the next alert opens a new one.  The running
    count is bucketed by day per title (``series.running_total``), never one window per title."""
    t = log.withColumn("full_title", incident_title(F.col("severity"), F.col("title")))
    closes = (F.col("action") == "close").cast("long")
    r = S.running_total(t.withColumn("_c", closes), ["full_title"], ["ts", "seq"], "_c", "_closes")
    # a close belongs to the episode it ends
    return r.withColumn("episode", F.col("_closes") - F.col("_c")).drop("_c", "_closes")


def incident_cards(log: DataFrame) -> DataFrame:
    """One card per (title, episode): the first alert body opens it (``min_by``), later alerts
    are comments (counted here; listed by ``incident_comments``), a close marks it closed."""
    opened, at = F.col("action") == "open", F.struct("ts", "seq")
    return (incident_episodes(log).groupBy("full_title", "episode").agg(
        F.min(F.when(opened, F.col("ts"))).alias("opened_at"),
        F.min_by(F.when(opened, F.col("body")), F.when(opened, at)).alias("description"),
        (F.count_if(opened) - 1).alias("n_comments"),
        F.min(F.when(F.col("action") == "close", F.col("ts"))).alias("closed_at"))
        .filter(F.col("opened_at").isNotNull()))


def incident_comments(log: DataFrame) -> DataFrame:
    """The comment rows (every alert after the opening one), in order, one row each —
    comments are never collected into one array, whatever an incident's size."""
    e = incident_episodes(log).filter(F.col("action") == "open")
    first = e.groupBy("full_title", "episode").agg(F.min(F.struct("ts", "seq")).alias("_first"))
    return (e.join(first, ["full_title", "episode"])
            .filter(F.struct("ts", "seq") != F.col("_first")).drop("_first"))


def table_catalog(stats: DataFrame, as_of: str) -> DataFrame:
    """One asset card per table — title, row count, freshness and a description of lines
    joined by blank lines; re-running replaces the card (the key is the title)."""
    desc = F.concat_ws("\n\n",
                       F.concat(F.lit("**Table**: `"), F.col("table_name"), F.lit("`")),
                       F.concat(F.lit("**Row count**: "), F.format_number(F.col("row_count"), 0)),
                       F.concat(F.lit("**Freshness**: "), F.coalesce(F.date_format("freshness", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("unknown"))),
                       F.concat(F.lit("**Updated**: "), F.lit(as_of)))
    return stats.select(F.concat(F.lit(ASSET_PREFIX + " "), F.col("table_name")).alias("title"),
                        "table_name", "row_count", "freshness", desc.alias("description"))


#: Children in one array at most.
NESTED = 1000


def nested_snapshot(parents: DataFrame, children: DataFrame, key: str, child_key: str,
                    child_cols: Sequence[str], order: str, most: int = NESTED) -> DataFrame:
    """Each parent with the array of its children sorted by ``order``; a parent without
    children keeps an empty array.  A parent with more than ``most`` children has several rows, numbered by
    ``part`` from 0, so an array is bounded whatever a parent holds; children are numbered by slices of
    their order (``derive.sequence_within``), never in one window per parent."""
    cols = [order, *[x for x in child_cols if x != order]]
    placed = sequence_within(children.select(F.col(child_key).alias(key), *cols), [key], cols, "_n")
    kids = placed.groupBy(key, F.floor(F.col("_n") / most).cast("long").alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("_n", F.struct(*cols).alias("x")))).alias("children"))
    kids = kids.withColumn("children", F.transform("children", lambda c: c["x"]))
    j = parents.join(kids, key, "left")
    empty = F.array().cast(kids.schema["children"].dataType)
    return j.withColumns({"part": F.coalesce("part", F.lit(0).cast("long")), "children": F.coalesce(F.col("children"), empty)})


def with_surrogate(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Dense 1..n surrogate key in key order (``dense_sequence``: range partitions plus
    per-partition offsets, no single-partition window)."""
    return dense_sequence(df, list(order), name)


def calendar_dim(lo: Column, hi: Column, source: DataFrame, southern: bool = True) -> DataFrame:
    """D3: one row per hour between the bounds (one generator row -> the hours of the span),
    with day, month, hour of day, weekday flag and meteorological season."""
    b = source.agg(lo.alias("_lo"), hi.alias("_hi"))
    h = b.select(F.explode(F.sequence(F.date_trunc("hour", "_lo").cast("timestamp_ntz"),
                                      F.date_trunc("hour", "_hi").cast("timestamp_ntz"),
                                      F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    m = F.month("hour")
    summer, winter = ([12, 1, 2], [6, 7, 8]) if southern else ([6, 7, 8], [12, 1, 2])
    season = (F.when(m.isin(summer), "summer").when(m.isin(winter), "winter")
              .when(m.isin([3, 4, 5]), "autumn" if southern else "spring").otherwise("spring" if southern else "autumn"))
    return h.select("hour", F.to_date("hour").alias("day"), F.trunc("hour", "month").alias("month"),
                    F.hour("hour").alias("hour_of_day"), F.dayofweek("hour").isin([1, 7]).alias("is_weekend"),
                    season.alias("season"))


def lineage(rows: DataFrame, source: str, batch: str, table: str, offset: str) -> DataFrame:
    """Which source and batch fed which table: row count and offset range."""
    return rows.groupBy(F.col(source).alias("_source"), F.col(batch).alias("_batch_id"),
                        F.col(table).alias("table_name")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(offset).alias("min_offset"), F.max(offset).alias("max_offset"))
