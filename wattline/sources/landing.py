"""File feeds beside the topics (S20): how their records look, and readers that keep what is broken.

* ``trading``: one JSON object for each trade, nested and pretty-printed over several lines; records end with the
  record separator (0x1E), so files can be split at any record.
* ``erp``: fixed-width records (``ERP_WIDTHS``); a record of another length is corrupt.
* ``meter``: records of fields delimited by ``|`` and tagged H (header), D (reading) or T (trailer); a reading
  with another number of fields is corrupt.

Every reader gives one row for each record: ``node_id``, ``metric``, ``_dataset``, ``is_corrupt``, ``raw`` (the
record as it came, where it is corrupt) and ``file``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Feed -> (topic and field that the test binding fills it from, last digit of props.k of damaged records).
FEEDS = {"trading": ("dispatch", "total_generation_mw", 3), "erp": ("plants", "capacity_mw", 5), "meter": ("scada", "solar_mw", 8)}
SEPARATOR = "\x1e"
TRADE = ("trade struct<id: string, node_id: string, market: struct<name: string, dataset: string>, "
         "legs: array<struct<leg: int, mwh: string>>>, _corrupt_record string")
#: Field -> width, in order.
ERP_WIDTHS = {"record_id": 20, "node_id": 24, "metric": 28, "_dataset": 10}
METER_FIELDS = 5


def write(feed: str, rows: DataFrame, path: str) -> None:
    """Files of a feed from (offset, node_id, metric, _dataset, damaged); damaged records are cut, or have a field too many."""
    {"trading": _write_trading, "erp": _write_erp, "meter": _write_meter}[feed](rows, path)


def read(spark: SparkSession, feed: str, path: str) -> DataFrame:
    return {"trading": read_trading, "erp": read_erp, "meter": read_meter}[feed](spark, path)


def _write_trading(rows: DataFrame, path: str) -> None:
    legs = F.array(F.struct(F.lit(1).alias("leg"), F.col("metric").alias("mwh")), F.struct(F.lit(2).alias("leg"), F.lit("0").alias("mwh")))
    trade = F.struct(F.struct(F.col("offset").cast("string").alias("id"), "node_id",
                              F.struct(F.lit("spot").alias("name"), F.col("_dataset").alias("dataset")).alias("market"), legs.alias("legs")).alias("trade"))
    text = F.to_json(trade, {"pretty": "true"})
    out = rows.select(text.alias("_t"), "damaged")
    cut = F.when(F.col("damaged"), F.expr("substring(_t, 1, length(_t) - 1)")).otherwise(F.col("_t"))
    out.select(cut.alias("value")).write.mode("overwrite").option("lineSep", SEPARATOR).text(path)


def read_trading(spark: SparkSession, path: str) -> DataFrame:
    """The volume of a trade is the sum of its legs; NULL if one of them is no number."""
    t = (spark.read.schema(TRADE).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
         .option("allowSingleQuotes", "false").option("lineSep", SEPARATOR).json(path))
    legs = F.transform("trade.legs", lambda x: x["mwh"].try_cast("double"))
    total = F.when(F.forall(legs, lambda v: v.isNotNull()), F.aggregate(legs, F.lit(0.0), lambda a, v: a + v))
    bad = F.col("_corrupt_record").isNotNull()
    return t.select(_unless(bad, F.col("trade.node_id")).alias("node_id"), _unless(bad, total).alias("metric"),
                    _unless(bad, F.col("trade.market.dataset")).alias("_dataset"), bad.alias("is_corrupt"),
                    F.col("_corrupt_record").alias("raw"), F.col("_metadata.file_path").alias("file"))


def _unless(bad: Column, value: Column) -> Column:
    return F.when(~bad, value)


def _write_erp(rows: DataFrame, path: str) -> None:
    fields = rows.select(F.col("offset").cast("string").alias("record_id"), "node_id", "metric", "_dataset", "damaged")
    line = F.concat(*[F.rpad(F.coalesce(F.col(c), F.lit("")), w, " ") for c, w in ERP_WIDTHS.items()])
    out = fields.select(line.alias("_t"), "damaged")
    cut = F.when(F.col("damaged"), F.expr("substring(_t, 1, length(_t) - 5)")).otherwise(F.col("_t"))
    out.select(cut.alias("value")).write.mode("overwrite").text(path)


def read_erp(spark: SparkSession, path: str) -> DataFrame:
    t = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    bad, at, field = F.length("value") != sum(ERP_WIDTHS.values()), 1, {}
    for name, width in ERP_WIDTHS.items():
        field[name] = _unless(bad, F.nullif(F.trim(F.substring("value", at, width)), F.lit("")))
        at += width
    return t.select(field["node_id"].alias("node_id"), field["metric"].try_cast("double").alias("metric"),
                    field["_dataset"].alias("_dataset"), bad.alias("is_corrupt"), F.when(bad, F.col("value")).alias("raw"), "file")


def _write_meter(rows: DataFrame, path: str) -> None:
    reading = F.concat_ws("|", F.lit("D"), F.col("offset").cast("string"), F.coalesce("node_id", F.lit("")), F.coalesce("metric", F.lit("")),
                          F.coalesce("_dataset", F.lit("")))
    lines = rows.select(F.when(F.col("damaged"), F.concat(reading, F.lit("|?"))).otherwise(reading).alias("value"))
    around = rows.sparkSession.createDataFrame([("H|meter",), ("T|end",)], "value string")
    lines.unionByName(around).write.mode("overwrite").text(path)


def read_meter(spark: SparkSession, path: str) -> DataFrame:
    t = spark.read.text(path).select("value", F.split("value", "[|]").alias("f"), F.col("_metadata.file_path").alias("file"))
    t = t.filter(~F.get("f", F.lit(0)).isin("H", "T"))
    bad = (F.size("f") != METER_FIELDS) | (F.get("f", F.lit(0)) != "D")

    def field(k: int) -> Column:
        return _unless(bad, F.nullif(F.get("f", F.lit(k)), F.lit("")))
    return t.select(field(2).alias("node_id"), field(3).try_cast("double").alias("metric"), field(4).alias("_dataset"),
                    bad.alias("is_corrupt"), F.when(bad, F.col("value")).alias("raw"), "file")
